"""A small student model: fitted on the train split, it predicts records for other prompts.

Bernoulli naive Bayes in closed form. A prompt's features are its word pairs, hashed into a fixed number of buckets.
Fitting counts, for each bucket, the prompts that have it by output and class: one aggregate of the train rows, of at
most one row a bucket. The model is a table of that size: per bucket the weight it adds to each output's score,
as an integer, so that sums don't depend on the order of rows. Predicting joins the buckets of a prompt with it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.operators.prompts import serialize_completion
from extractkit.schema import DAMAGE_FIELDS, SEVERITIES, SEVERITY_FIELD
from extractkit.session import kept

# Buckets of word pairs; the model has one row each, about a hundred bytes.
WIDTH = 1 << 12
# Weights are logarithms times this, rounded.
SCALE = 1 << 20
# The bucket every prompt has: its weights are what holds without any pair.
ALWAYS = -1
WORD = r"[0-9A-Za-z_]+"

_CLASSES = (*DAMAGE_FIELDS, *(f"{SEVERITY_FIELD}_{s}" for s in SEVERITIES))


def buckets(prompt: Column, width: int = WIDTH) -> Column:
    """The distinct buckets of a prompt's word pairs, in no order; none for null or fewer than two words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(prompt, F.lit(""))), F.lit(WORD), F.lit(0))
    following = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))
    numbers = F.transform(
        F.array_compact(pairs), lambda p: F.conv(F.substring(F.md5(p), 1, 7), 16, 10).cast("int") % width
    )
    return F.array_distinct(numbers)


def _labels(record: Column) -> dict[str, Column]:
    """One boolean per output class; null where the record lacks it."""
    severity = F.try_variant_get(record, f"$.{SEVERITY_FIELD}", "string")
    known = F.when(severity.isin(*SEVERITIES), severity)
    flags = {f: F.when(J.kind(J.member(record, f"$.damage.{f}")) == "BOOLEAN", F.try_variant_get(record, f"$.damage.{f}", "boolean")) for f in DAMAGE_FIELDS}
    return flags | {f"{SEVERITY_FIELD}_{s}": known == s for s in SEVERITIES}


def _scaled(logarithm: Column) -> Column:
    return F.round(F.ln(logarithm) * SCALE).cast("bigint")


def _model(counts: DataFrame, sizes: dict[str, int], rows: int, width: int) -> DataFrame:
    """bucket and one integer weight per class, ``ALWAYS`` included.

    For a flag the weight is that of true less that of false; each severity has its own.
    """
    every = counts.sparkSession.range(width).select(F.col("id").cast("int").alias("bucket"))
    seen = every.join(counts, "bucket", "left").fillna(0)

    def has(n: Column, of: int) -> tuple[Column, Column]:
        """Weight of having the bucket over not having it, and the weight of not having it."""
        share = (n + 1).cast("double") / F.lit(float(of + 2))
        return _scaled(share) - _scaled(1 - share), _scaled(1 - share)

    weights, bases, priors = {}, {}, {}
    for c, size in sizes.items():
        weights[c], bases[c] = has(F.col(f"n_{c}"), size)
        classes = len(SEVERITIES)
        if c in DAMAGE_FIELDS:
            weight, base = has(F.col("n") - F.col(f"n_{c}"), rows - size)
            weights[c], bases[c] = weights[c] - weight, bases[c] - base
            classes = 2
        prior = _scaled(F.lit(size + 1).cast("double") / F.lit(float(rows + classes)))
        if c in DAMAGE_FIELDS:
            prior = prior - _scaled(F.lit(rows - size + 1).cast("double") / F.lit(float(rows + classes)))
        priors[c] = prior
    always = seen.agg(*[F.sum(bases[c]).alias(c) for c in sizes])
    always = always.select(F.lit(ALWAYS).alias("bucket"), *[(F.col(c) + priors[c]).alias(c) for c in sizes])
    return seen.select("bucket", *[weights[c].alias(c) for c in sizes]).unionByName(always)


@dataclass(frozen=True)
class Student:
    """The fitted model: ``width`` + 1 rows of integer weights, kept in the shared folder."""

    model: DataFrame
    width: int

    def scores(self, prompts: DataFrame, key: str = "id") -> DataFrame:
        """key and the summed weight of each class. ``key`` must identify a row."""
        asked = prompts.select(key, F.concat(buckets(F.col("prompt"), self.width), F.array(F.lit(ALWAYS))).alias("__b"))
        rows = asked.select(key, F.explode("__b").alias("bucket"))
        # width rows: the size is a parameter, not the data's
        met = rows.join(F.broadcast(self.model), "bucket")
        return met.groupBy(key).agg(*[F.sum(c).alias(c) for c in _CLASSES])

    def predict(self, prompts: DataFrame, key: str = "id") -> DataFrame:
        """key, raw_output: the predicted record as completion text.

        A flag is true where its weight is above zero; of equal severities the lower one holds.
        """
        by_severity = {s: F.col(f"{SEVERITY_FIELD}_{s}") for s in SEVERITIES}
        best = reduce(F.greatest, by_severity.values())
        named = F.coalesce(*[F.when(score == best, s) for s, score in by_severity.items()])
        flags = [(F.col(f) > 0).alias(f) for f in DAMAGE_FIELDS]
        decided = self.scores(prompts, key).select(key, *flags, named.alias("severity"))
        return decided.select(key, serialize_completion().alias("raw_output"))


def fit_student(train: DataFrame, width: int = WIDTH) -> Student:
    """Fit on ``prompt`` and ``completion``; rows whose completion is no full record are left out.

    Two aggregates over the rows, of one row and of at most ``width``. Without usable rows every class is as
    likely, and predictions say so.
    """
    parsed = J.parse_columns(train.select("prompt", "completion"), {"__record": F.col("completion")})
    labelled = parsed.select(buckets(F.col("prompt"), width).alias("__b"), *[c.alias(n) for n, c in _labels(F.col("__record")).items()])
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _CLASSES])
    rows = kept(labelled.withColumn("__full", F.coalesce(full, F.lit(False))), "student").where("__full")
    sizes = rows.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(c) for c in _CLASSES]).first().asDict()
    counts = rows.select(F.explode("__b").alias("bucket"), *_CLASSES).groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(f"n_{c}") for c in _CLASSES]
    )
    every = sizes.pop("rows")
    return Student(kept(_model(counts, sizes, every, width), "model"), width)
