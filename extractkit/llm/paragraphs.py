"""Substring dedup: passages that repeat across documents, exactly or nearly.

Two kinds of paragraphs are compared, each with its like:

- *lines* of ``least`` words or more; lines of more than ``LONG`` words are cut further where a word that
  ends a sentence has a hash of a certain form, ``least`` words or more after the last cut.
- *spans* of the word stream of the whole text, placed by content (``anchors``): every passage of
  ``least`` words that stands elsewhere too holds a whole one, inside longer lines or over short ones.

Both go the same way, by their five-word shingles:

- Equal paragraphs are collapsed first.
- MinHash: ``BANDS`` bands of ``ROWS`` values. A pair at similarity s shares a band with probability
  1 - (1 - s^ROWS)^BANDS: 0.9995 at 0.75.
- Paragraphs that collide in a band are paired with the least of the band and their neighbour; of bands whose
  members these links do not hold together, all members of different components are compared as well.
- Pairs are checked by the exact Jaccard similarity of whole shingle sets.
- Components of the links are the clusters; the first paragraph of each stays, by document id and
  place, the others are marked for removal.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.anchors import BATCH_BYTES, rolled_shingles, spans
from extractkit.llm.graph import components
from extractkit.llm.ngram_join import SCAN_BYTES, SETS, grouped, set_columns, spanning_links
from extractkit.llm.tables import saved, small_side
from extractkit.llm.textscan import (
    SPACES,
    constants,
    groups,
    lowered,
    mix,
    released,
    shingles,
    word_bounds,
    word_class,
    word_hashes,
)

BANDS, ROWS = 20, 4
LONG = 100
WORDS = 5
_CLASS = word_class(SPACES)
_ROWS = (
    "doc long, paragraph long, start long, end long, n_words long, pid long, d1 long, d2 long, bands array<long>"
)


def cut(text: str, least: int) -> list[tuple[int, int, int, int]]:
    """Paragraphs of a text with at least so many words: number, start, end, words.

    Numbers count all paragraphs; offsets are code points.
    """
    found, number, at = [], 0, 0
    for line in text.split("\n"):
        parts = [(at, at + len(line))]
        if len(line) > 2 * LONG:
            words = line.split(" ")
            if len(words) > LONG:
                parts, first, n, place = [], at, 0, at
                for word in words:
                    place += len(word) + 1
                    n += bool(word)
                    if n >= least and word.endswith(".") and zlib.crc32(word.encode()) % 4 == 0:
                        parts.append((first, place - 1))
                        first, n = place, 0
                if first < at + len(line):
                    parts.append((first, at + len(line)))
        for start, end in parts:
            if end - start >= 2 * least - 1:
                n = len(text[start:end].split())
                if n >= least:
                    found.append((number, start, end, n))
            number += 1
        at += len(line) + 1
    return found


def _min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """Band keys of each (non-empty) set."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    factors = constants(41, BANDS * ROWS)
    out = np.empty((len(sets), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band, dtype=np.uint64)
        for row in range(ROWS):
            low = np.minimum.reduceat(flat * factors[band * ROWS + row] >> np.uint64(32), first)
            key = mix(key + low)
        out[:, band] = key
    return out


def _scan(docs: DataFrame, least: int, whole: bool) -> DataFrame:
    """One row per paragraph of ``docs`` (id, text): places and band keys, or whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            all_ids, all_texts = batch.column(0), batch.column(1).to_pylist()
            raw = [b"" if t is None else t.encode() for t in all_texts]
            for a, b in groups(raw, SCAN_BYTES):
                rows, places, texts = [], [], []
                for i in range(a, b):
                    for place in cut(all_texts[i] or "", least):
                        rows.append(i)
                        places.append(place)
                        texts.append(all_texts[i][place[1] : place[2]].encode().lower())
                if not rows:
                    continue
                sets = shingles(texts, WORDS, _CLASS)
                ids = all_ids.take(pa.array(rows, pa.int64()))
                number = np.array(places, dtype=np.int64)
                pid, d1, d2 = _digests(ids, number[:, 0], sets, 0)
                if whole:
                    yield set_columns(pa.array(pid), sets)
                else:
                    yield _row_columns(ids, number, pid, d1, d2, _min_hashes(sets))

    return docs.mapInArrow(run, SETS if whole else _ROWS)


def _digests(ids: pa.Array, number: np.ndarray, sets: list[np.ndarray], kind: int) -> tuple[np.ndarray, ...]:
    """Paragraph ids and two digests of the shingle sets, different for each kind of paragraph."""
    f, tag = constants(37, 1)[0], np.uint64(kind)
    d1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64) + tag
    d2 = np.array([mix(s * f).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    own = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    pid = mix(mix(own.view(np.uint64) + mix(d1)) + number.astype(np.uint64))
    return pid.view(np.int64), d1.view(np.int64), d2.view(np.int64)


def _row_columns(ids, number, pid, d1, d2, keys) -> pa.RecordBatch:
    offsets = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
    columns = [
        ids,
        *(pa.array(number[:, k]) for k in range(4)),
        *(pa.array(x) for x in (pid, d1, d2)),
        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
    ]
    return pa.RecordBatch.from_arrays(columns, _ROWS.replace(",", "").split()[::2])


def _span_rows(docs: DataFrame) -> DataFrame:
    """Rows and sets of the spans of ``docs`` (id, text, spans); ``paragraph`` is the first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            texts, lists = lowered(batch.column(1).to_pylist()), batch.column(2)
            for a, b in groups(texts, SCAN_BYTES):
                joined, starts, ends, text = word_bounds(texts[a:b], _CLASS)
                rolled = rolled_shingles(word_hashes(joined, starts, ends))
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                rows, places, sets = [], [], []
                for i in range(a, b):
                    first, stop = bounds[i - a], bounds[i - a + 1]
                    for span in lists[i].as_py():
                        if first + span["at"] + span["n_words"] <= stop:
                            at = first + span["at"]
                            rows.append(i)
                            places.append((span["at"], span["start"], span["end"], span["n_words"]))
                            sets.append(np.unique(rolled[at : at + span["n_words"] - WORDS + 1]))
                # whole sets are long: a few hundred spans at once
                for i in range(0, len(rows), 500):
                    some, number = sets[i : i + 500], np.array(places[i : i + 500], dtype=np.int64)
                    ids = batch.column(0).take(pa.array(rows[i : i + 500], pa.int64()))
                    pid, d1, d2 = _digests(ids, number[:, 0], some, 1)
                    one = _row_columns(ids, number, pid, d1, d2, mix(_min_hashes(some) + np.uint64(1)))
                    more = set_columns(pa.array(pid), some)
                    yield pa.RecordBatch.from_arrays([*one.columns, *more.columns], [*one.schema.names, *more.schema.names])

    return docs.mapInArrow(run, f"{_ROWS}, {SETS}")


def _placed(named: DataFrame, least: int) -> DataFrame:
    """The rows and sets of all spans that repeat; rows that repeat id and text repeat their spans."""
    seen = named.withColumn("seen", F.xxhash64("text"))
    found = saved(spans(seen, least), "spans")
    span = F.struct("at", "n_words", "start", "end")
    listed = found.groupBy("id", "seen").agg(F.collect_set(span).alias("spans"))
    listed = listed.withColumnsRenamed({"id": "own", "seen": "hash"})
    same = F.col("id").eqNullSafe(F.col("own")) & (F.col("seen") == F.col("hash"))
    held = seen.join(small_side(listed, found.count()), same)
    return saved(_span_rows(held.select("id", "text", "spans")), "span-sets", batch=BATCH_BYTES)


def repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 50,
    percent: int = 75,
) -> DataFrame:
    """One row per paragraph that repeats: id, kind, paragraph, start, end, n_words, cluster, removed.

    ``kind`` is line or span, ``paragraph`` the number of the line or the first word of the span; start
    and end are code points. ``cluster`` is the same number for all paragraphs of a cluster; ``removed``
    is false for the first of it by id and paragraph. Every passage of ``least`` words that is equal
    word by word to one elsewhere (and does not overlap it) holds a span; spans begin and end up to ``least`` - 32 words (at 50)
    inside it, and passages of 32 words may be found as well. Of near copies, lines are found by
    similarity and other passages by their equal stretches. Equality is of two 64-bit digests.
    Null and empty texts have no paragraphs; a null id comes first in
    that order; rows that repeat an id and its text repeat its paragraphs as well. An empty table gives
    no rows. Other columns of ``docs`` are not read.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    lines = _scan(named, least, False).withColumn("kind", F.lit("line"))
    lines = saved(lines, "paragraphs", batch=BATCH_BYTES)
    placed = _placed(named, least)
    rows = lines.unionByName(placed.select(*lines.drop("kind").columns, F.lit("span").alias("kind")))
    classes = saved(
        rows.groupBy("d1", "d2").agg(
            F.min("pid").alias("rep"),
            F.count("*").alias("n"),
            F.min_by("bands", "pid").alias("bands"),
        ),
        "paragraph-classes",
    )
    listed = classes.select(F.explode("bands").alias("sig"), F.col("rep").alias("id"))
    met = saved(grouped(listed), "collisions")
    wanted = saved(met.select("id").distinct(), "wanted")
    asked = small_side(wanted, wanted.count())
    sources = saved(
        lines.join(asked, F.col("pid") == F.col("id"), "left_semi").select(F.col("doc").alias("id")).distinct(),
        "sources",
    )
    from_ = named.join(small_side(sources, sources.count()), named["id"].eqNullSafe(sources["id"]), "left_semi")
    sets = _scan(from_, least, True).unionByName(placed.select("id", "size", "bits", "wide", "shingles"))
    sets = sets.join(asked, "id", "left_semi").dropDuplicates(["id"])
    sets = saved(sets, "shingle-sets", batch=BATCH_BYTES)
    links = components(spanning_links(met, sets, percent))
    single = classes.select("d1", "d2", "rep", "n")
    cluster = single.join(links, single["rep"] == links["id"], "left").select(
        "d1",
        "d2",
        F.coalesce("component", "rep").alias("cluster"),
        ((F.col("n") > 1) | F.col("component").isNotNull()).alias("again"),
    )
    cluster = saved(cluster.where("again").drop("again"), "clusters")
    members = rows.drop("bands").join(small_side(cluster, cluster.count(), 300_000), ["d1", "d2"])
    members = saved(members.select("doc", "kind", "paragraph", "start", "end", "n_words", "cluster"), "members")
    order = F.struct(F.col("doc").isNotNull(), "doc", "paragraph", "start")
    first = saved(members.groupBy("cluster").agg(F.min(order).alias("first")), "firsts")
    return members.join(small_side(first, first.count(), 300_000), "cluster").select(
        F.col("doc").alias(id_col),
        "kind",
        "paragraph",
        "start",
        "end",
        "n_words",
        "cluster",
        (order != F.col("first")).alias("removed"),
    )
