"""Paragraphs placed by content: passages that stand in two places, wherever they begin and end.

Words are the whole text's, across line ends. Of every ``least`` words in a row, the ``window`` first
places compete, and the one with the least hash of its five words begins a paragraph of ``PART`` words.
Both choice and paragraph depend on these ``least`` words alone, so a passage of ``least`` words has a
whole paragraph in common with its copies in any surroundings. Paragraphs whose words are found once
are dropped; those that follow each other in a text, and repeat as often and from the same first row,
are joined to one span. Spans have ``PART`` words or more, and copies of a passage have the same spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extractkit.llm.tables import saved, small_side
from extractkit.llm.textscan import (
    SPACES,
    constants,
    groups,
    lowered,
    mix,
    released,
    word_bounds,
    word_class,
    word_hashes,
)

WORDS = 5
#: Bytes of texts that a task is given at once, and those scanned at once.
BATCH_BYTES, SCAN_BYTES = 4 << 20, 1 << 18
_CLASS = word_class(SPACES)
_LOW = np.uint64(0xFFFFFFFF)
_TEXTS = "row long, id long, seen long, keys array<long>, at array<int>, start array<int>, end array<int>"


def part_words(least: int) -> int:
    """Words of a paragraph, so that ``least`` words always hold one."""
    return max(WORDS, least * 16 // 25)


def rolled_shingles(hashes: np.ndarray) -> np.ndarray:
    """Hash of the five words from each place, as in ``textscan.shingles``."""
    n = max(0, len(hashes) - WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(constants(23, WORDS)):
        out += hashes[k : k + n] * factor
    return mix(out)


def places_of(hashes: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """First words of the paragraphs in the joined words of several texts, ascending."""
    part = part_words(least)
    if len(hashes) < least:
        return np.empty(0, dtype=np.int64)
    starts = len(hashes) - part + 1
    # ties go to the first place
    best = rolled_shingles(hashes)[:starts] & ~_LOW | np.arange(starts, dtype=np.uint64)
    have, width = 1, least - part + 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    inside = text[: len(best)] == text[least - 1 :]
    return np.unique(best[inside] & _LOW).astype(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _texts(docs: DataFrame, least: int) -> DataFrame:
    """Per text of ``docs`` (row, id, seen, text) its paragraphs: key, first word, code points."""
    part = part_words(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = constants(53, part)
        for batch in released(batches):
            texts = lowered(batch.column(3).to_pylist())
            for a, b in groups(texts, SCAN_BYTES):
                joined, starts, ends, text = word_bounds(texts[a:b], _CLASS)
                hashes = word_hashes(joined, starts, ends)
                first = places_of(hashes, text, least)
                if not len(first):
                    continue
                key = np.zeros(len(first), dtype=np.uint64)
                for k in range(part):
                    key += hashes[first + k] * factors[k]
                points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
                begin = np.cumsum([0, *(len(t) + 1 for t in texts[a : b - 1])])
                owner = text[first]
                base = points[begin][owner]
                counts = np.bincount(owner, minlength=b - a)
                word = np.searchsorted(text, np.arange(b - a))[owner]
                which = np.flatnonzero(counts)
                rows = pa.array(a + which)
                columns = [
                    *(batch.column(k).take(rows) for k in range(3)),
                    _lists(mix(key).view(np.int64), counts[which], pa.int64()),
                    _lists((first - word).astype(np.int32), counts[which], pa.int32()),
                    _lists((points[starts[first]] - base).astype(np.int32), counts[which], pa.int32()),
                    _lists((points[ends[first + part - 1]] - base).astype(np.int32), counts[which], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, _TEXTS.replace(",", "").split()[::2])

    return docs.mapInArrow(run, _TEXTS)


def spans(docs: DataFrame, least: int) -> DataFrame:
    """Spans of ``docs`` (id, text, seen) that repeat: row, id, seen, at (first word), n_words, start, end.

    ``seen`` is a hash of the text; texts are not shuffled. Copies that overlap in one text (one word
    over and over) are one span, which may have no copy elsewhere.
    """
    part = part_words(least)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "id", "seen", "text")
    texts = saved(_texts(numbered, least), "placed", "zstd", BATCH_BYTES)
    again = (
        texts.select("row", F.explode("keys").alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.min("row").alias("lead"))
        .where("n > 1")
    )
    again = saved(again, "placed-again")
    each = texts.select("row", "id", "seen", F.posexplode(F.arrays_zip("keys", "at", "start", "end")).alias("k", "p"))
    each = each.select("row", "id", "seen", "k", F.col("p.keys").alias("key"), "p.at", "p.start", "p.end")
    met = each.join(small_side(again, again.count()), "key")
    # paragraphs that follow each other have the same difference of place and rank
    rank = F.row_number().over(Window.partitionBy("row", "n", "lead").orderBy("k"))
    return (
        met.withColumn("island", F.col("k") - rank)
        .groupBy("row", "id", "seen", "n", "lead", "island")
        .agg(
            F.min("at").alias("at"),
            (F.max("at") - F.min("at") + part).alias("n_words"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
        )
        .drop("n", "lead", "island")
    )
