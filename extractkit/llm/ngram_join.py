"""N-gram Jaccard join by PartEnum signatures: exact, at a threshold, on sets of word shingles.

Two sets link when their intersection is at least ``percent`` per cent of their union. PartEnum
cuts the hashed shingle domain into parts. Sets of sizes a <= b that link differ in at most
d = floor((100 - p) (a + b) / (100 + p)) elements, so among d + 1 parts one is equal in both. Only
sizes of one band, or either side of a band's edge, need to meet; each such *family* of sizes has
its own number of parts, and a set lists as many parts as its own size can need.

- **First pass**: a signature is the content of one part. Most groups of equal signatures hold few
  sets, and the pairs in them are checked.
- **Second pass**: the members of larger groups (a passage that very many documents share, or many
  near copies) are joined again by their rarest shingles: of the elements of a set, ordered by how
  common they are, one of the first floor((100 - p) size / 100) + 1 is in every set it links with.
  How common is read off a table of fixed size, counted over all sets of this pass; any order
  common to all sets is right. Both sets of a pair that met in a large group are in this pass, so no
  pair is lost.
- **Parts empty in both** agree without saying anything. A set lists its empty parts only where its
  non-empty ones would not suffice for the guarantee.

Groups are never expanded into all pairs. Each member is paired with the least member and its
neighbour; after checking and joining components, groups of four or more whose members already hang
together need nothing else. In the others, all members of different components are compared.

Checks count the intersection of whole shingle sets. Before that, pairs go whose bitmaps of shingles
differ in more bits than the sets may differ in elements; that loses none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from extractkit.llm.graph import components
from extractkit.llm.tables import TASK_ROWS, gathered, saved, small_side
from extractkit.llm.textscan import (
    SPACES,
    constants,
    groups,
    lowered,
    mix,
    released,
    shingles,
    word_class,
)

#: Sets in one group of equal signatures before they are joined by rare shingles instead.
GROUP = 6
#: Bytes of text scanned at once; a scan holds about forty times as much.
SCAN_BYTES = 1 << 18
#: Groups that two sets of a group may both have been in just before, for the pair to be left out.
EARLIER = 4
#: Pairs whose whole sets one task compares.
CHECKED = 20_000
#: Size ratio of a band.
BAND = 3
#: Counters of the table of how common shingles are.
COUNTERS = 1 << 17
#: Bits of a set's bitmap.
BITS = 2048
#: Sets of more elements have a wider bitmap too, which is compared before whole sets travel.
LARGE, WIDE = 1000, 32_768

_CLASS = word_class(SPACES)


#: Families made once per worker task.
_FAMILIES: dict = {}


def _family(low: int, high: int, smaller: int, percent: int):
    """Of a family of sizes low..high, where the smaller set of a pair has at most ``smaller``.

    Returns the number of parts, and per size the parts listed and the differences allowed.
    """
    made = (low, high, smaller, percent)
    if made in _FAMILIES:
        return _FAMILIES[made]
    size = np.arange(low, high + 1)
    a = np.minimum(size, smaller)
    larger = np.minimum(high, np.where(size > smaller, size, 100 * size // percent))
    need = (100 - percent) * (a + larger) // (100 + percent)
    parts = int(1.1 * (need.max() + 1)) + 2
    full = 1 - np.exp(-size / parts)
    listed = np.minimum(parts, np.ceil((need + 1) / full * 1.05 + 2).astype(np.int64))
    _FAMILIES[made] = (parts, np.maximum.accumulate(listed), need)
    return _FAMILIES[made]


def families(size: int, percent: int) -> list[tuple[int, int, int]]:
    """The families a set of ``size`` elements belongs to, as (low, high, smaller)."""
    low = 1
    while low * BAND <= size:
        low *= BAND
    found = [(low, low * BAND - 1, low * BAND - 1)]
    for edge in (low, low * BAND):
        lowest, highest = -(-edge * percent // 100), 100 * (edge - 1) // percent
        if lowest <= edge - 1 and edge <= highest and lowest <= size <= highest:
            found.append((lowest, highest, edge - 1))
    return found


def _parts(points: np.ndarray, n: int) -> np.ndarray:
    """Part of each point when the range of 32-bit numbers is cut into ``n``."""
    return (points * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _tag(low: int, high: int, second: bool) -> np.uint64:
    return mix(np.array([(low * 1_000_003 + high) * 2 + second], dtype=np.uint64))[0]


#: Hashes of the numbers of a family's parts, made once per worker task.
_PARTS: dict = {}


def _part_hashes(n: int, low: int, high: int) -> np.ndarray:
    if (n, low, high) not in _PARTS:
        _PARTS[n, low, high] = mix(np.arange(n, dtype=np.uint64) + _tag(low, high, False))
    return _PARTS[n, low, high]


def signatures(sorted_set: np.ndarray, percent: int, content: np.ndarray | None = None) -> np.ndarray:
    """First pass: signatures of one set of 64-bit hashes in ascending order; ``content`` is ``mix`` of them."""
    size = len(sorted_set)
    out = []
    points = sorted_set >> np.uint64(32)
    if content is None:
        content = mix(sorted_set)
    for low, high, smaller in families(size, percent):
        n, listed, need = _family(low, high, smaller, percent)
        count = int(listed[size - low])
        part = _parts(points, n)
        new = np.ones(size, dtype=bool)
        np.not_equal(part[1:], part[:-1], out=new[1:])
        cut = np.flatnonzero(new)
        filled = part[cut]
        first = max(low, -(-size * percent // 100)) - low
        last = min(size, smaller) - low
        within = np.searchsorted(filled, listed[first : last + 1])
        blank = bool((within <= need[first : last + 1]).any())
        keep = filled < count
        sums = np.add.reduceat(content, cut)[keep]
        used = filled[keep]
        if blank:
            empty = np.setdiff1d(np.arange(count), filled)
            used = np.concatenate([used, empty])
            sums = np.concatenate([sums, np.zeros(len(empty), dtype=np.uint64)])
        out.append(mix(mix(sums + used.view(np.uint64)) ^ _part_hashes(n, low, high)[used]))
    return np.concatenate(out)


def _counter(a_set: np.ndarray) -> np.ndarray:
    return (a_set & np.uint64(COUNTERS - 1)).astype(np.int64)


def rarest(a_set: np.ndarray, percent: int, counts: np.ndarray) -> np.ndarray:
    """Second pass: signatures from the rarest shingles, one of which any linking set shares."""
    first = (100 - percent) * len(a_set) // 100 + 1
    order = np.lexsort((a_set, counts[_counter(a_set)]))[:first]
    some = a_set[order]
    return np.concatenate(
        [mix(some ^ _tag(low, high, True)) for low, high, _ in families(len(a_set), percent)]
    )


def _per_batch(words: int, make):
    """A function for mapInArrow that hands ids and shingle sets of a batch to ``make``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            texts = lowered(batch.column(1).to_pylist())
            for a, b in groups(texts, SCAN_BYTES):
                sets = shingles(texts[a:b], words, _CLASS)
                yield from make(batch.column(0).slice(a, b - a), sets)

    return run


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all sets, one set after the other, and where each begins and the last ends."""
    bounds = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return np.concatenate([*sets, np.empty(0, dtype=np.uint64)]), bounds


def _digests(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    flat, bounds = _joined(sets)

    def summed(factor: int) -> pa.Array:
        sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(mix(flat * constants(factor, 1)[0]), out=sums[1:])
        return pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))

    size = pa.array(np.diff(bounds))
    yield pa.RecordBatch.from_arrays([ids, size, summed(31), summed(37)], ["id", "size", "d1", "d2"])


def _listed(keys_of):
    """Batches of (sig, id) from a function of one set and ``mix`` of it."""

    def make(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        flat, bounds = _joined(sets)
        content = mix(flat)
        each = [keys_of(s, content[a : a + len(s)]) if len(s) else s for s, a in zip(sets, bounds, strict=False)]
        owner = np.repeat(ids.to_numpy(zero_copy_only=False), [len(x) for x in each])
        keys = np.concatenate(each).view(np.int64)
        for i in range(0, len(keys), 100_000):
            part = [pa.array(keys[i : i + 100_000]), pa.array(owner[i : i + 100_000], pa.int64())]
            yield pa.RecordBatch.from_arrays(part, ["sig", "id"])

    return make


def _counted(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    counter, n = np.unique(_counter(np.concatenate(sets)), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(counter), pa.array(n)], ["counter", "n"])


def _bitmap(a_set: np.ndarray, n: int) -> np.ndarray:
    bits = np.zeros(n, dtype=bool)
    bits[(a_set >> np.uint64(20)) & np.uint64(n - 1)] = True
    return np.packbits(bits).view(np.int64)


#: Columns of sets.
SETS = "id long, size long, bits array<long>, wide array<long>, shingles array<long>"


def set_columns(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    """Ids with size, bitmap and shingles of their sets."""

    def arrays(parts: list[np.ndarray]) -> pa.Array:
        flat = np.concatenate([*parts, np.empty(0, dtype=np.uint64).view(np.int64)])
        offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    size = pa.array(np.array([len(s) for s in sets], dtype=np.int64))
    bits = arrays([_bitmap(s, BITS) for s in sets])
    none = np.empty(0, dtype=np.int64)
    wide = arrays([_bitmap(s, WIDE) if len(s) > LARGE else none for s in sets])
    whole = arrays([s.view(np.int64) for s in sets])
    columns = [ids, size, bits, wide, whole]
    return pa.RecordBatch.from_arrays(columns, SETS.replace(",", "").split()[::2])


def _whole(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    yield set_columns(ids, sets)


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents with the given distinct ids; broadcast only below a counted bound."""
    return docs.join(small_side(ids, ids.count()), "id", "left_semi")


def grouped(listed: DataFrame) -> DataFrame:
    """Signatures listed by two sets or more, with the group's least id, size and neighbour."""
    group = Window.partitionBy("sig")
    return listed.select(
        "sig",
        "id",
        F.min("id").over(group).alias("hub"),
        F.max("id").over(group).alias("top"),
        F.count("*").over(group).alias("n"),
        F.lag("id").over(group.orderBy("id")).alias("before"),
    ).where("hub < top").drop("top")


def _star(groups: DataFrame) -> DataFrame:
    ends = F.explode(F.array_distinct(F.array("hub", "before"))).alias("a")
    return groups.select(ends, F.col("id").alias("b")).where("a < b").distinct()


def _near(words: int, percent: int):
    """False only for pairs that can't link: sizes too far apart, or too many different bits."""
    apart = sum(
        F.bit_count(F.col(f"bits{i}a").bitwiseXOR(F.col(f"bits{i}b"))) for i in range(words)
    )
    sizes = F.greatest("na", "nb") * percent <= F.least("na", "nb") * 100
    return sizes & (apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


def _bits(sets: DataFrame, words: int) -> DataFrame:
    """Bitmaps as columns bits0 and on, folded to so many 64-bit words."""
    folded = [
        reduce(Column.bitwiseOR, [F.col("bits")[i] for i in range(k, BITS // 64, words)])
        for k in range(words)
    ]
    return sets.select("id", "size", *[x.alias(f"bits{k}") for k, x in enumerate(folded)])


def _side(rows: DataFrame, end: str) -> DataFrame:
    names = {"id": end, "size": f"n{end}", "shingles": f"set{end}"}
    return rows.withColumnsRenamed({x: names.get(x, x + end) for x in rows.columns})


def _checked(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    met, known = pairs.count(), sets.count()
    bits, near = gathered(_bits(sets, BITS // 64), known), _near(BITS // 64, percent)
    close = gathered(pairs, met).join(_side(bits, "a"), "a").join(_side(bits, "b"), "b").where(near)
    close = saved(gathered(close.select("a", "b", "na", "nb"), max(met, known)), "close-pairs")
    wide = sets.where(F.col("size") > LARGE).select("id", "wide")
    large = F.least("na", "nb") > LARGE
    both = close.where(large).join(_side(wide, "a"), "a").join(_side(wide, "b"), "b")
    apart = F.aggregate(
        F.zip_with("widea", "wideb", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda n, x: n + x,
    )
    both = both.where(apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
    close = close.where(~large).select("a", "b").unionByName(both.select("a", "b"))
    close = saved(gathered(close, met), "close-pairs")
    whole, left = sets.select("id", "shingles"), close.count()
    close = small_side(close, left, TASK_ROWS).join(_side(whole, "a"), "a").join(_side(whole, "b"), "b")
    common = F.size(F.array_intersect("seta", "setb"))
    union = F.size("seta") + F.size("setb") - common
    close = close.where(common * 100 >= union * percent).select("a", "b")
    return saved(gathered(close, max(left, known), CHECKED).distinct(), "links")


def _apart(groups: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a group's members that are in different components and may link.

    Sets that share a passage meet in a group for each of its rare shingles. Of groups with the same members one
    is looked at. In the others a pair is left out where one of the last ``EARLIER`` groups of both, in an
    order of all groups that keeps those with the same hub together, is the same: it was made there. Pairs are
    judged by whole bitmaps as they are made.
    """
    known = groups.join(joined, "id", "left").select(
        "sig", "id", "hub", F.coalesce("component", "id").alias("c")
    )
    members = [F.sum(F.shiftright(F.xxhash64("id", F.lit(i)), 32)).alias(f"x{i}") for i in range(3)]
    parts = known.groupBy("sig", "c").agg(F.count("*").alias("count"), *members)
    mixed = (
        parts.groupBy("sig")
        .agg(
            F.max_by("c", F.struct("count", "c")).alias("main"),
            F.count("*").alias("parts"),
            F.sum("count").alias("n"),
            *[F.sum(f"x{i}").alias(f"x{i}") for i in range(3)],
        )
        .where("parts > 1")
    )
    once = mixed.groupBy("x0", "x1", "x2", "n").agg(F.min_by(F.struct("sig", "main"), "sig").alias("of")).select("of.*")
    of_set = Window.partitionBy("id").orderBy("hub", "sig")
    earlier = F.array_compact(F.array(*[F.lag("sig", i).over(of_set) for i in range(1, EARLIER + 1)]))
    open_ = known.join(once, "sig").withColumn("earlier", earlier).drop("hub")
    open_ = saved(open_.join(_bits(sets, BITS // 64), "id"), "open")
    # of two components one is not the group's largest
    left, right = _side(open_.where("c <> main"), "a"), _side(open_, "b")
    return (
        left.join(
            right,
            (F.col("siga") == F.col("sigb"))
            & (F.col("ca") != F.col("cb"))
            & ((F.col("cb") == F.col("mainb")) | (F.col("a") < F.col("b")))
            & ~F.arrays_overlap("earliera", "earlierb")
            & _near(BITS // 64, percent),
        )
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def hub_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that link, but for links within components of the others.

    ``sets`` has the columns of ``set_columns`` for all their ids.
    """
    # whole sets travel to be checked: one pair of each id first, then what isn't joined by that
    met = pairs.count()
    pairs = gathered(pairs, met)
    one = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    one = gathered(saved(gathered(one, met), "first-pairs"), met)
    links = _checked(sets, one, percent)
    joined = gathered(components(links), 2 * links.count())
    ends = joined.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    rest = pairs.join(one, ["a", "b"], "left_anti").join(ends, "a", "left")
    rest = rest.join(ends.withColumnsRenamed({"a": "b", "ca": "cb"}), "b", "left")
    rest = rest.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    return links.unionByName(_checked(sets, saved(gathered(rest, met), "pairs"), percent))


def spanning_links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span the components of all links within the groups ``met``.

    ``met`` is from ``grouped``; ``sets`` has the columns of ``set_columns`` for its ids.
    """
    rows = met.count()
    met = gathered(met, rows)
    links = hub_links(saved(gathered(_star(met), 2 * rows), "pairs"), sets, percent)
    joined = gathered(components(links), 2 * links.count())
    met = met.where("n > 3")
    more = _apart(gathered(met, met.count()), joined, gathered(sets, sets.count()), percent)
    return links.unionByName(_checked(sets, saved(more, "pairs"), percent))


def links_of(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """Links (a, b) between the ids of ``docs`` (id, text) that span every component.

    Ids must not be null. Rows that share an id count as one document.
    """
    shape = "sig long, id long"
    first = docs.mapInArrow(_per_batch(words, _listed(lambda s, content: signatures(s, percent, content))), shape)
    groups = saved(grouped(first), "groups")
    n = groups.count()
    large = gathered(groups, n).where(F.col("n") > GROUP).select("id").distinct()
    large = saved(gathered(large, n), "dense-ids")
    dense = _only(docs, large)
    counters = (
        dense.mapInArrow(_per_batch(words, _counted), "counter long, n long")
        .groupBy("counter")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.zeros(COUNTERS, dtype=np.int64)
    table[counters["counter"].to_numpy(np.int64)] = counters["n"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    second = dense.mapInArrow(
        _per_batch(words, _listed(lambda s, _: rarest(s, percent, shared.value))), shape
    )
    again = saved(grouped(second), "groups")
    met = groups.where(F.col("n") <= GROUP).unionByName(again)
    n = met.count()
    ids = saved(gathered(gathered(met, n).select("id").distinct(), n), "pair-ids")
    sets = saved(_only(docs, ids).mapInArrow(_per_batch(words, _whole), SETS), "shingle-sets")
    return spanning_links(met, sets, percent)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id.

    - Words are runs of anything but ASCII white space, A-Z lower-cased.
    - Null or empty texts, and texts without words, have no shingles and are linked with nothing.
    - Exact copies (equal shingle sets) are collapsed first and linked by that.
    - A null id is returned with its n_shingles and a null component_id; it links with nothing.
    - Rows that share an id count as one document: all get the component that any of them reaches.
    - An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shape = "id long, size long, d1 long, d2 long"
    rows = saved(named.mapInArrow(_per_batch(words, _digests), shape), "shingle-digests")
    n = rows.count()
    filled = gathered(rows, n).where(F.col("id").isNotNull() & (F.col("size") > 0))
    copies = (
        filled.groupBy("d1", "d2", "size")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
    )
    copies = saved(gathered(copies, n), "copy-classes")
    copies = small_side(copies, copies.count()).select("d1", "d2", "size", "first")
    merged = (
        filled.join(copies, ["d1", "d2", "size"])
        .where("id > first")
        .select(F.col("first").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    merged = gathered(saved(gathered(merged, n), "copies"), n)
    # an id with several texts stays if any of them is not a copy
    left_over = filled.join(copies, ["d1", "d2", "size"], "left").where("first is null or id = first")
    dropped = merged.select(F.col("b").alias("id")).distinct()
    dropped = dropped.join(left_over.select("id").distinct(), "id", "left_anti")
    dropped = saved(gathered(dropped, n), "copy-ids")
    kept = named.where("id is not null").join(
        small_side(dropped, dropped.count()), "id", "left_anti"
    )
    links = links_of(kept, words, percent)
    joined = components(links.unionByName(merged)).withColumnRenamed("id", "node")
    found = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(joined, rows["id"] == joined["node"], "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), found.alias("component_id")
    )
