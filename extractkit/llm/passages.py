"""Passages of ``least`` words or more that stand in two places, wherever they begin and end.

Words are the whole text's, across line ends: runs of anything but ASCII white space, A-Z lower-cased.
A place repeats if the ``least`` words from it stand in another place too, of this or another text.

- Every place has a key: the least hash of the ``GRAM``-word sequences within its ``least`` words. It
  depends on these words alone, so equal passages have equal keys in any surroundings. Places that
  follow each other mostly share their key and are one row, a run.
- Keys that can't be had from two places go with their runs; that loses none.
- What is left is compared place by place, by key and a hash of all words. Groups are never expanded
  into pairs.
- Places that follow each other are joined to maximal passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extractkit.llm.tables import saved, small_side
from extractkit.llm.textscan import SPACES, constants, groups, lowered, mix, word_bounds, word_class, word_hashes

GRAM = 8
#: Places in one run at most.
RUN = 1000
_CLASS = word_class(SPACES)
_RUNS = "gram long, n int, row long, id long, at long, hashes array<long>, starts array<int>, ends array<int>"
_PLACES = "gram long, hash long, row long, id long, at long, start long, end long"


def _rolled(hashes: np.ndarray, words: int, seed: int) -> np.ndarray:
    n = max(0, len(hashes) - words + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(constants(seed, words)):
        out += hashes[k : k + n] * factor
    return mix(out)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    n, have = len(values) - width + 1, 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[: len(values) - step], values[step:])
        have += step
    return values[:n]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), kind))


def _runs(docs: DataFrame, least: int) -> DataFrame:
    """The runs of ``docs`` (row, id, text); offsets in code points, each less the one before."""
    gram = min(GRAM, least)

    def of_text(hashes, starts, ends):
        grams = _rolled(hashes, gram, 47)
        key, whole = _least_of(grams, least - gram + 1), _rolled(hashes, least, 43)
        ordered = np.sort(grams)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        bounds = np.unique(np.concatenate([first, np.arange(0, len(key), RUN), [len(key)]]))
        often = np.isin(key[bounds[:-1]], twice)
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            begins, stops = starts[a:b], ends[a + least - 1 : b + least - 1]
            yield key[a], 1 + often[k], a, whole[a:b], np.diff(begins, prepend=0), np.diff(stops, prepend=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = lowered(batch.column(2).to_pylist())
            for a, b in groups(texts):
                joined, starts, ends, text = word_bounds(texts[a:b], _CLASS)
                hashes = word_hashes(joined, starts, ends)
                points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                begin = np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])
                owner, found = [], []
                for k in range(b - a):
                    i, j = bounds[k], bounds[k + 1]
                    if j - i >= least:
                        base = points[begin[k]]
                        places = points[starts[i:j]] - base, points[ends[i:j]] - base
                        more = list(of_text(hashes[i:j], *places))
                        owner += [a + k] * len(more)
                        found += more
                if not found:
                    continue
                key, n, at, whole, begins, stops = zip(*found, strict=True)
                which = pa.array(owner, pa.int64())
                columns = [
                    pa.array(np.array(key, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(n, dtype=np.int32)),
                    batch.column(0).take(which),
                    batch.column(1).take(which),
                    pa.array(np.array(at, dtype=np.int64)),
                    _lists([w.view(np.int64) for w in whole], pa.int64()),
                    _lists(begins, pa.int32()),
                    _lists(stops, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, _RUNS.replace(",", "").split()[::2])

    return docs.mapInArrow(run, _RUNS)


def _places(runs: DataFrame) -> DataFrame:
    """One row per place of the runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(5).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.cumsum(sizes) - sizes
            which = np.repeat(np.arange(len(sizes)), sizes)

            def summed(column: pa.Array) -> pa.Array:
                sums = np.cumsum(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.concatenate([[0], sums])[first]
                return pa.array(sums - before[which])

            at = batch.column(4).to_numpy(zero_copy_only=False)[which] + np.arange(len(which)) - first[which]
            take = pa.array(which)
            columns = [
                batch.column(0).take(take),
                batch.column(5).flatten(),
                batch.column(2).take(take),
                batch.column(3).take(take),
                pa.array(at),
                summed(batch.column(6)),
                summed(batch.column(7)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _PLACES.replace(",", "").split()[::2])

    return runs.mapInArrow(run, _PLACES)


def shared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> DataFrame:
    """One row per maximal passage that repeats: id, start, end (code points), n_words, removed.

    ``removed`` is false for passages whose every ``least`` words stand there first, by id (a null id
    comes first), row and place, and true for those of which every ``least`` words stand elsewhere
    before; where the one turns into the other, two passages overlap by less than ``least`` words.
    Passages must be equal word by word: of a near copy the equal stretches of ``least`` words or more
    are found. Null and short texts have none; rows that repeat an id are rows of their own. Other
    columns of ``docs`` are not read.
    """
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
    )
    runs = saved(_runs(named, least), "passage-runs", "zstd")
    often = runs.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    often = saved(often, "passage-keys")
    near = runs.join(small_side(often, often.count()), "gram", "left_semi")
    equal = Window.partitionBy("gram", "hash")
    order = F.struct(F.col("id").isNotNull(), "id", "row", "at")
    places = (
        _places(near.select(runs.columns))
        .withColumns({"n": F.count("*").over(equal), "first": F.min(order).over(equal)})
        .where("n > 1")
        .select("row", "id", "at", "start", "end", (order != F.col("first")).alias("removed"))
    )
    # places that follow each other have the same difference of place and rank
    rank = F.row_number().over(Window.partitionBy("row", "removed").orderBy("at"))
    spans = places.withColumn("island", F.col("at") - rank).groupBy("row", "id", "removed", "island")
    return spans.agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.count("*") + least - 1).alias("n_words")
    ).select(F.col("id").alias(id_col), "start", "end", "n_words", "removed")
