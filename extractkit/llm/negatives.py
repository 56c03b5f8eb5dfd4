"""Hard negatives by Fagin's threshold algorithm over integer vectors.

Vectors become integers, so every score is an exact integer inner product. Rows are scanned in blocks of
``BLOCK`` rows; each block holds one list of its rows per dimension, sorted by that component. An anchor
reads all lists at once, from the top where its own component is positive and from the bottom where it is
negative (sorted access), and scores the rows it meets (random access). The sum of what the lists show at the depth
reached bounds every row not met yet. A window of scores wants its first k rows; the anchor stops when that
bound lies strictly below the kth score of each of its windows, or below the window itself where it has
fewer. Strictly, since a row with an equal score may have a smaller id.

Two passes over the rows: the first finds the positives (rows of the same label, read from lists of that
label alone), the second the negatives in the windows that the positives' scores open. What a task found so far
carries over to its next blocks and lets them stop earlier.

The anchors are the stated query set. They reach the tasks in parts of at most ``BROADCAST_BYTES``, one pass
over the rows for each part; rows are never shuffled, and a task returns at most k rows a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from extractkit.llm.tables import saved

#: Rows with lists of their own.
BLOCK = 8_192
#: Bytes of anchors and windows sent to the tasks at once.
BROADCAST_BYTES = 32 << 20
#: Integers up to here are exact as doubles.
EXACT = 1 << 53
LONGEST = 1 << 63

FOUND = "anchor long, window int, row long, id long, score long"


def integer_vectors(
    df: DataFrame, id_col: str, vector_col: str, label: Column, scale: float = 256.0
) -> DataFrame:
    """row, id, label, vector: components floor(scale * x); rows that can't take part are left out.

    Those are rows with a null id, label or vector, or a component that is null or not finite.
    """
    finite = F.forall(
        vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    )
    usable = df.where(F.col(id_col).isNotNull() & label.isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(scale)))
    rows = usable.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector")
    )
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


@dataclass
class Windows:
    """What one anchor looks for: the first ``k`` rows by (score down, id, row) in [low, high] of each window."""

    low: list[int]
    high: list[int]
    k: int
    rows: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.rows = [np.empty((0, 3), dtype=np.int64) for _ in self.low]

    def settled(self, bound: int) -> bool:
        """Whether no row scored at most ``bound`` can change any window."""
        return all(
            bound < (found[-1, 0] if len(found) == self.k else low)
            for low, found in zip(self.low, self.rows, strict=True)
        )

    def offer(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        for i, (low, high, found) in enumerate(zip(self.low, self.high, self.rows, strict=True)):
            if len(found) == self.k:
                low = found[-1, 0]
            fits = np.flatnonzero((scores >= low) & (scores <= high))
            if not len(fits):
                continue
            if len(fits) > self.k:
                least = np.partition(scores[fits], -self.k)[-self.k]
                fits = fits[scores[fits] >= least]
            both = np.concatenate([found, np.stack([scores[fits], ids[fits], rows[fits]], axis=1)])
            self.rows[i] = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[: self.k]]


class Lists:
    """The sorted lists of one block of rows."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.rows, self.labels = vectors, ids, rows, labels
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(vectors.T, self.order, axis=1)

    def search(self, vector: np.ndarray, wanted: np.ndarray, windows: Windows) -> None:
        """Threshold algorithm for one anchor; ``wanted`` marks the rows that may be found."""
        n, width = self.vectors.shape
        up, down = np.flatnonzero(vector > 0), np.flatnonzero(vector < 0)
        if not len(up) + len(down):
            # all scores are zero: no list says anything
            windows.offer(np.zeros(int(wanted.sum()), np.int64), self.ids[wanted], self.rows[wanted])
            return
        unmet = np.ones(n, dtype=bool)
        depth, reach = 0, max(1, n // (2 * width))
        while depth < n:
            reach = min(reach, n)
            unmet[self.order[up, n - reach : n - depth].ravel()] = False
            unmet[self.order[down, depth:reach].ravel()] = False
            met = np.flatnonzero(~unmet & wanted)
            if len(met):
                scores = self.vectors[met] @ vector if 2 * len(met) < n else (self.vectors @ vector)[met]
                windows.offer(scores.astype(np.int64), self.ids[met], self.rows[met])
                wanted = wanted & unmet
            bound = int(
                self.sorted[up, n - reach] @ vector[up] + self.sorted[down, reach - 1] @ vector[down]
            )
            if not wanted.any() or windows.settled(bound):
                return
            depth, reach = reach, 2 * reach


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Rows of integers, short ones filled with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return out


def _exact(vectors: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type whose inner products are exact; an error where 64 bits are not enough."""
    largest = max(1, vectors.shape[1])
    for side in (vectors, anchors):
        largest *= max([1, int(side.max(initial=0)), -int(side.min(initial=0))])
    if largest >= LONGEST:
        raise OverflowError("inner products exceed 64 bits")
    kind = np.float64 if largest < EXACT else np.int64
    return vectors.astype(kind), anchors.astype(kind)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of ``BLOCK`` rows; the last may have fewer."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, BLOCK - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == BLOCK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _scan(rows: DataFrame, anchors: list, k: int, same: bool) -> DataFrame:
    """First k rows of each window of these anchors, as each task found them.

    ``anchors`` are tuples (row, label, vector, lows, highs); ``same``: rows of the anchor's own label, not
    the anchor itself, else rows of other labels.
    """
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        width = max((len(a[2]) for a in known), default=0)
        queries = _matrix([a[2] for a in known], width)
        windows = [Windows(list(a[3]), list(a[4]), k) for a in known]
        by_label: dict[int, list[int]] = {}
        for i, anchor in enumerate(known):
            by_label.setdefault(anchor[1], []).append(i)
        for block in _blocks(batches):
            number, ids, labels = (block.column(c).to_numpy() for c in ("row", "id", "label"))
            column = block.column("vector").combine_chunks()
            sizes = np.diff(column.offsets.to_numpy())
            most = max(width, int(sizes.max()))
            if (sizes == most).all():
                vectors = column.flatten().to_numpy().reshape(len(ids), most)
            else:
                vectors = _matrix(column.to_pylist(), most)
            if most > width:
                # an anchor has zeros where it has no component
                vectors = vectors[:, :width]
            vectors, exact = _exact(vectors, queries)
            if same:
                for label in np.unique(labels):
                    own = np.flatnonzero(labels == label)
                    if int(label) in by_label:
                        lists = Lists(vectors[own], ids[own], number[own], labels[own])
                        for i in by_label[int(label)]:
                            lists.search(exact[i], lists.rows != known[i][0], windows[i])
            else:
                lists = Lists(vectors, ids, number, labels)
                for label, members in by_label.items():
                    wanted = labels != label
                    for i in members:
                        lists.search(exact[i], wanted, windows[i])
        found = [
            (known[i][0], w, *map(int, (r[2], r[1], r[0])))
            for i, window in enumerate(windows)
            for w, rows_ in enumerate(window.rows)
            for r in rows_
        ]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["anchor", "window", "row", "id", "score"],
        )

    return rows.select("row", "id", "label", "vector").mapInArrow(run, FOUND)


def _searched(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """First k rows of every window of all anchors, ranked from 1; the anchors part by part."""
    size = anchors.agg(
        F.coalesce(F.sum(F.size("vector") * 8 + F.size("lows") * 16 + 64), F.lit(0)).alias("n")
    ).first()["n"]
    n = max(1, -(-size // BROADCAST_BYTES))
    parts = anchors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n)))
    found = None
    for part in range(n):
        known = parts.where(F.col("part") == part).select("row", "label", "vector", "lows", "highs").collect()
        task = _scan(rows, [tuple(r) for r in known], k, same)
        best = W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
        first = saved(task.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "found")
        found = first if found is None else found.unionByName(first)
    return found


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``id``; ``label`` an expression on the columns of ``df``. A row's score is
    its inner product with the anchor, in integers floor(scale * x). An anchor's positives are its first
    ``positives`` other rows of the same label; per positive, the first ``negatives`` rows of another label
    are returned whose score is between the two percentages of the positive's. Higher scores come first,
    then smaller ids, then earlier rows.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Repeated
    rows are rows of their own: each may be found, and each anchor among them has rows of its own. Of two vectors
    of unequal length the shorter one is filled with zeros. Where no positive or negative exists there is no row;
    an empty table gives none. Other columns don't matter. Scores beyond 64 bits stop the job.
    """
    rows = integer_vectors(df, id_col, vector_col, label, scale)
    anchors = saved(rows.where(is_anchor), "anchors")
    everything = F.array(F.lit(1 - LONGEST)), F.array(F.lit(LONGEST - 1))
    open_ = anchors.withColumns({"lows": everything[0], "highs": everything[1]})
    near = _searched(rows, open_, positives, same=True).select(
        F.col("anchor").alias("row"), "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # ceil(low * score / 100) and floor(high * score / 100), of an exact product
    share = F.col("positive_score").cast("decimal(20,0)")
    low = F.ceil(share * percent[0] / 100).cast("long")
    high = F.floor(share * percent[1] / 100).cast("long")
    near = near.withColumns({"low": low, "high": high}).where("low <= high")
    windows = near.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score", "low", "high"))).alias("w")
    )
    asked = saved(
        anchors.join(windows, "row").withColumns({"lows": F.col("w.low"), "highs": F.col("w.high")}), "windows"
    )
    found = _searched(rows, asked, negatives, same=False)
    owners = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("w").alias("window", "p"))
    return found.join(owners, ["anchor", "window"]).select(
        "anchor_id",
        F.col("p.positive_id").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("p.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: anchors with ids divisible by 50, labels of ids divisible by 7 shifted by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings, F.col("id") % 50 == 0, label)
