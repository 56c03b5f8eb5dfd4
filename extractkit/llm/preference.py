"""Quality classifier: Bradley-Terry scores learnt from preference pairs.

A document labelled good is preferred to one labelled bad. Scores are linear in features of the text
and learnt by logistic loss on feature differences of such pairs. The threshold is the score that
leaves most of both classes on their side.

Every labelled document that isn't held out is learnt from. All pairs of the two classes would be as
many as their product, so each document of the larger class meets ``PARTNERS`` of the smaller (all, if
fewer), and each of the smaller as many times as that makes. Rows are dealt to groups for it; each step of
the fit is one pass over all groups, of which only sums reach the driver. Centre, scale and threshold come
from all these documents too, none from a sample or a grid.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.llm.tables import saved
from extractkit.operators.prefix import running_total

#: Documents of the larger class in a group, and documents of the smaller that each of them meets.
GROUP, PARTNERS = 4096, 32
#: Score of a document at the threshold.
CUT = 0.7
FEATURES = (
    "words",
    "word_length",
    "symbols",
    "exclamations",
    "bars",
    "capitals",
    "digits",
    "distinct",
    "stutter",
    "repeated_pairs",
    "repeated_lines",
    "commonest",
    "other_signs",
    "line_words",
)


def features_of(text: str | None) -> list[float]:
    """The features of one text; an empty or null text has zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    raw = text.encode("utf-8", "surrogatepass")
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    letters = sum(map(len, words))
    signs = len(raw.translate(None, KEPT))
    pairs = set(zip(words, words[1:], strict=False))
    return [
        math.log1p(n),
        min(letters / n, 30.0),
        min(sum(map(text.count, "#*$%&<>")) / n, 3.0),
        min(text.count("!") / n, 2.0),
        min(text.count("|") / n, 1.0),
        (len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size,
        (len(raw) - len(raw.translate(None, b"0123456789"))) / size,
        len(seen) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(pairs) / max(1, n - 1),
        1 - len(set(lines)) / max(1, len(lines)),
        max(seen.values()) / n,
        min(signs / size, 1.0),
        math.log1p(n / max(1, len(lines))),
    ]


#: Bytes that are not counted as signs: letters, digits, white space, common punctuation, beyond ASCII.
KEPT = bytes(
    b for b in range(256) if b > 127 or chr(b).isalnum() or chr(b) in " \t\n\x0b\x0c\r.,;:'\"-()?"
)


def featured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with a column __features array<double>."""
    kept = docs.drop("__features", text_col)
    rows = kept.withColumn("__features", F.array().cast("array<double>"))
    n = len(kept.columns)
    names = [*kept.columns, "__features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features_of(t) for t in batch.column(n).to_pylist()]
            columns = [*batch.columns[:n], pa.array(made, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*kept.columns, text_col).mapInArrow(run, rows._jdf.schema().toDDL())


def _sums(groups: DataFrame, make, width: int) -> np.ndarray:
    """Sum over all groups, in their order, of the ``width`` numbers that ``make`` returns for one.

    ``make`` is given the group's number and the features (rows by features) and weights of the larger
    class, then of the smaller.
    """
    f = len(FEATURES) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i, group in enumerate(batch.column(0).to_pylist()):
                sides = [batch.column(k)[i].values.to_numpy().reshape(-1, f) for k in (1, 2)]
                made.append(make(group, *[x for side in sides for x in (side[:, :-1], side[:, -1])]))
            columns = [batch.column(0), pa.array(made, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["group", "sums"])

    found = groups.mapInArrow(run, "group long, sums array<double>").toPandas().sort_values("group")
    return np.array(found["sums"].tolist(), dtype=float).reshape(-1, width).sum(axis=0)


def _dealt(train: DataFrame, larger: int, n: int, m: int) -> DataFrame:
    """``n`` groups as (group, many, few): flat features and weight of each row of the larger and the smaller class.

    The larger class is dealt out by a hash. The smaller is dealt into ``m`` shards, and every group gets
    one of them, so that none lacks a class; shard k is first in group k.
    """
    at = F.xxhash64("__features", F.lit(5))
    many = train.where(F.col("q") == larger).withColumn("group", F.pmod(at, F.lit(n)))
    few = train.where(F.col("q") != larger).withColumn("shard", F.pmod(at, F.lit(m)))
    every = F.sequence("shard", F.lit(n - 1).cast("long"), F.lit(m).cast("long"))
    both = many.unionByName(few.withColumn("group", F.explode(every)).drop("shard"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        flat = []
        for side in (frame["q"] == larger, frame["q"] != larger):
            own = frame[side].sort_values("order", kind="stable")
            values = np.array(own["__features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
            flat.append(np.column_stack([values, own["weight"].to_numpy(float)]).ravel())
        return pd.DataFrame({"group": [int(frame["group"].iloc[0])], "many": flat[:1], "few": flat[1:]})

    both = both.withColumn("order", F.xxhash64("__features", F.lit(6)))
    packed = both.groupBy("group").applyInPandas(pack, "group long, many array<double>, few array<double>")
    return saved(packed, "preference-groups")


def _moments(centre: np.ndarray, shards: int):
    """A function of one group: weights, and weighted sums and squares of features less ``centre``, each row once."""

    def make(group, many, many_weight, few, few_weight) -> np.ndarray:
        out = np.zeros(1 + 2 * len(FEATURES))
        for rows, weight in ((many, many_weight), (few, few_weight))[: 1 + (group < shards)]:
            off = rows - centre
            out += np.concatenate([[weight.sum()], weight @ off, weight @ (off * off)])
        return out

    return make


def _slope_and_curve(weights: np.ndarray, centre: np.ndarray, scale: np.ndarray, sign: int):
    """A function of one group: sums of the weights, slopes and curvatures of its pairs."""
    f = len(FEATURES)

    def make(_, many, many_weight, few, few_weight) -> np.ndarray:
        out = np.zeros(1 + f + f * f)
        many, few = (many - centre) / scale, (few - centre) / scale
        row = np.arange(len(many))
        for k in range(min(PARTNERS, len(few))):
            j = (row + k) % len(few)
            differ, pair = sign * (many - few[j]), many_weight * few_weight[j]
            p = 1 / (1 + np.exp(-np.clip(differ @ weights, -30, 30)))
            out[0] += pair.sum()
            out[1 : 1 + f] += differ.T @ (pair * (p - 1))
            out[1 + f :] += ((differ * (pair * p * (1 - p))[:, None]).T @ differ).ravel()
        return out

    return make


def _linear(weights: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> Column:
    total = F.lit(-float(weights @ (centre / scale)))
    for k, w in enumerate(weights / scale):
        total = total + F.col("__features")[k] * float(w)
    return total


def _threshold(train: DataFrame, linear: Column) -> float:
    """Of all scores the one that leaves the most of both classes, as shares, on their side.

    The least if several do; half way to the next lower score.
    """
    scores = train.groupBy(linear.alias("score")).agg(
        F.sum(F.when(F.col("q") == 1, F.col("weight")).otherwise(0)).alias("up"),
        F.sum(F.when(F.col("q") == 0, F.col("weight")).otherwise(0)).alias("down"),
    )
    scores = saved(scores, "training-scores")
    up, down = scores.agg(F.sum("up"), F.sum("down")).first()
    gain = (F.col("down") * F.lit(up) - F.col("up") * F.lit(down)).alias("gain")
    ranked, _ = running_total(scores.select("score", gain), ["score"], "gain")
    best = ranked.agg(F.max_by("score", F.struct("before", -F.col("score")))).first()[0]
    below = scores.where(F.col("score") < best).agg(F.max("score")).first()[0]
    return best if below is None else (best + below) / 2


def fit(train: DataFrame, ridge: float = 1e-3, steps: int = 25):
    """Weights, centre and scale of the features, and the threshold of the score.

    ``train`` has __features, q (1 good, 0 bad) and weight, the number of documents alike in these. Newton
    steps on the mean logistic loss of feature differences, with a small ridge. None where one of the classes
    has no row.
    """
    rows = {r["q"]: r["n"] for r in train.groupBy("q").agg(F.count("*").alias("n")).collect()}
    if len(rows) < 2:
        return None
    f = len(FEATURES)
    larger = max(rows, key=lambda q: (rows[q], q))
    n, m = -(-rows[larger] // GROUP), -(-rows[1 - larger] // GROUP)
    groups = _dealt(train, larger, n, m)
    sums = _sums(groups, _moments(np.zeros(f), m), 1 + 2 * f)
    centre = sums[1 : 1 + f] / sums[0]
    scale = np.sqrt(_sums(groups, _moments(centre, m), 1 + 2 * f)[1 + f :] / sums[0])
    scale[scale < 1e-9] = 1.0
    weights = np.zeros(f)
    for _ in range(steps):
        step = _slope_and_curve(weights, centre, scale, 1 if larger else -1)
        sums = _sums(groups, step, 1 + f + f * f)
        slope = sums[1 : 1 + f] / sums[0] + ridge * weights
        curve = sums[1 + f :].reshape(f, f) / sums[0]
        move = np.linalg.solve(curve + ridge * np.eye(f), slope)
        weights -= move * min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return weights, centre, scale, _threshold(train, _linear(weights, centre, scale))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the text, with held_out boolean, score double and predicted int.

    Scores are 0 to 1, higher where label 1 is likelier; predicted is 1 from 0.7 on. Labels of held
    out ids are not learnt from; ids labelled both ways and null labels or ids neither. Without a
    label of either class every score is 0.7. Rows are scored each, repeated ones alike; null and
    empty texts have zeros as features. Other columns stay; those of the three names are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    rows = learnt = saved(featured(docs.select(id_col, text_col), text_col), "features")
    if len(docs.columns) > 2:
        rows = featured(docs, text_col)  # once more, rather than have whole rows written with them
    known = (
        labels.where(F.col("quality").isin(0, 1))
        .groupBy(id_col)
        .agg(F.min("quality").alias("q"), F.max("quality").alias("most"))
        .where(F.col("q") == F.col("most"))
        .select(id_col, "q")
    )
    alike = learnt.where(~held_out(id_col)).join(known, id_col).groupBy("q", "__features")
    model = fit(saved(alike.agg(F.count("*").alias("weight")), "train"))
    if model is None:
        score = F.lit(CUT)
    else:
        weights, centre, scale, cut = model
        linear = _linear(weights, centre, scale) - float(cut)
        score = 1 / (1 + F.exp(-(linear + math.log(CUT / (1 - CUT)))))
    out = rows.withColumns({"held_out": held_out(id_col), "score": score}).drop("__features")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not rejected; rows with a null id are scored like others."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    scores = scored(docs.select(whole, F.col(id_col), F.col("text")), labels, id_col)
    return scores.where("predicted = 1").select("__row.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), labels)
