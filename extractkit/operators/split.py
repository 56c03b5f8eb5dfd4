"""Seeded shuffle with exact split sizes, without ever ranking in one task.

Order is md5(seed:key), then a hash of the whole row. The leading hash bits give evenly filled buckets; a
bucket's count is all a row needs besides its rank inside the bucket. Rows that share a key share a bucket,
so a bucket far above the others means a key that repeats; then rows are ranked by ranges instead.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from extractkit.functions import draws
from extractkit.operators.prefix import running_total
from extractkit.schema import SPLITS

# Default split sizes and seed.
TRAIN_SIZE = 800
VALID_SIZE = 100
TEST_SIZE = 100
SPLIT_SEED = 42

# What one task sorts: at most so many rows, and about so many bytes.
ROWS_PER_TASK = 1_000_000
BYTES_PER_TASK = 1 << 30
# Rows whose length is measured for that.
MEASURED_ROWS = 1_000
# Bound on the bucket counts that the driver sums up and broadcasts, one row each.
MOST_BUCKETS = 65_536
# A bucket so many times as full as a task should be holds a key that repeats.
HOT = 4

Size = int | float


def _hashed(df: DataFrame, key: str, seed: int, buckets: int) -> DataFrame:
    absent = F.raise_error(F.lit(f"a row has no {key}, which decides its split")).cast("string")
    named = F.coalesce(F.col(key).cast("string"), absent)
    df = df.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}:"), named)))
    lead = draws.word_value(draws.word(F.col("__hash"), 0))
    return df.withColumn("__bucket", F.shiftright(lead * F.lit(buckets).cast("bigint"), 32).cast("int"))


def _tie(df: DataFrame) -> Column:
    """Orders rows of equal key by what they hold."""
    unhashed = ("map<", "variant")
    return F.xxhash64(
        *[
            F.to_json(F.struct(field.name)) if any(t in field.dataType.simpleString() for t in unhashed) else field.name
            for field in df.schema.fields
        ]
    )


def _counts(hashed: DataFrame) -> dict[int, int]:
    """Rows of each bucket that has any, in the order of buckets; at most ``MOST_BUCKETS``."""
    return dict(sorted(hashed.groupBy("__bucket").agg(F.count("*").alias("n")).toArrow().to_pandas().values.tolist()))


def _cuts(train: Size, valid: Size, total: int) -> tuple[int, int]:
    """Last ranks of train and valid. A size is rows if an int, a share of all rows (rounded down) if a float."""
    first, second = (math.floor(total * size) if isinstance(size, float) else size for size in (train, valid))
    return first, first + second


def _hot(counts: dict[int, int], buckets: int, rows_per_task: int) -> bool:
    """Whether a bucket is far above what distinct keys would fill it with."""
    return max(counts.values(), default=0) > HOT * max(rows_per_task, sum(counts.values()) // buckets)


def row_bytes(df: DataFrame) -> float:
    """Mean length of ``MEASURED_ROWS`` rows written as JSON."""
    some = df.limit(MEASURED_ROWS).select(F.octet_length(F.to_json(F.struct(*df.columns))).alias("n"))
    return some.agg(F.avg("n")).head()[0] or 0.0


def default_buckets(df: DataFrame, rows_per_task: int = ROWS_PER_TASK, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """Enough buckets, of one task each, for tasks of a bounded size; counts the rows.

    The length of a row is measured on ``MEASURED_ROWS`` rows, where there are enough for it to matter.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    wanted = -(-total // rows_per_task)
    if total > configured * MEASURED_ROWS:
        wanted = max(wanted, math.ceil(total * row_bytes(df) / bytes_per_task))
    return min(MOST_BUCKETS, max(configured, wanted))


def _ranked_by_bucket(hashed: DataFrame, tie: Column, buckets: int, counts: dict[int, int]) -> DataFrame:
    before = [0, *accumulate(counts.values())][: len(counts)]
    table = hashed.sparkSession.createDataFrame(
        pa.table({"__bucket": pa.array(counts, pa.int32()), "__before": pa.array(before, pa.int64())})
    )
    in_bucket = W.partitionBy("__bucket").orderBy("__hash", tie)
    placed = hashed.repartitionById(buckets, F.col("__bucket")).withColumn("__place", F.row_number().over(in_bucket))
    return placed.join(F.broadcast(table), "__bucket").withColumn("__rank", F.col("__before") + F.col("__place"))


def _ranked_by_range(hashed: DataFrame, tie: Column, buckets: int, total: int) -> DataFrame:
    """Ranks where a key has too many rows for a task: the range of a key is cut by its rows."""
    rows = hashed.select("*", tie.alias("__tie"), F.monotonically_increasing_id().alias("__row"), F.lit(1).alias("__one"))
    ranked, _ = running_total(rows, ["__hash", "__tie", "__row"], "__one", "__before")
    ranked = ranked.withColumn("__rank", F.col("__before") + 1)
    task = F.expr(f"CAST((__rank - 1) * {buckets} DIV {total} AS INT)")
    return ranked.repartitionById(buckets, task).sortWithinPartitions("__rank")


def split_exact(
    df: DataFrame,
    key: str = "id",
    train: Size = TRAIN_SIZE,
    valid: Size = VALID_SIZE,
    seed: int = SPLIT_SEED,
    buckets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``split`` and ``pos``, the row's 1-based line in its split. What is left over is test.

    A first pass over the key counts the buckets, then the rows are shuffled once. Partition i of the
    result holds bucket i in order, so the result as a whole is in shuffled order. The number of
    buckets sets task size, never the result; unless given, it follows from the rows and their
    length, and ``MOST_BUCKETS`` at most are made.

    Rows of a repeated key stand next to each other in an order that follows from what they hold; equal
    rows can't be told apart. Where a key has more rows than a task should sort, all rows are ranked by
    ranges, which writes them once and shuffles them three times. A null key stops the job.
    """
    buckets = min(buckets or default_buckets(df, rows_per_task), MOST_BUCKETS)
    kept = [F.col(c) for c in df.columns]
    hashed, tie = _hashed(df, key, seed, buckets), _tie(df)
    counts = _counts(hashed)
    total = sum(counts.values())
    if _hot(counts, buckets, rows_per_task):
        ranked = _ranked_by_range(hashed, tie, buckets, total)
    else:
        ranked = _ranked_by_bucket(hashed, tie, buckets, counts)
    first, last = _cuts(train, valid, total)
    rank = F.col("__rank")
    name = F.when(rank <= first, SPLITS[0]).when(rank <= last, SPLITS[1]).otherwise(SPLITS[2])
    pos = F.when(rank <= first, rank).when(rank <= last, rank - first).otherwise(rank - last)
    return ranked.select(*kept, name.alias("split"), pos.alias("pos"))


def assign_splits(
    df: DataFrame,
    key: str = "id",
    train: Size = TRAIN_SIZE,
    valid: Size = VALID_SIZE,
    seed: int = SPLIT_SEED,
    buckets: int = MOST_BUCKETS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``split`` alone: the same membership as ``split_exact`` with no shuffle of the rows.

    Two cut points in hash order are found from the bucket counts and the one bucket each cut
    falls into; then every row is placed by comparing its hash with them. Where a cut falls between
    rows of one key, or into a bucket that is too full to sort, it is left to ``split_exact``. A
    null key stops the job.
    """
    kept, buckets = [F.col(c) for c in df.columns], min(buckets, MOST_BUCKETS)
    hashed = _hashed(df, key, seed, buckets)
    counts = _counts(hashed)
    numbers, upto = list(counts), list(accumulate(counts.values()))
    total = upto[-1] if upto else 0
    cuts = _cuts(train, valid, total)
    # per cut inside the rows, its bucket and its place there
    inside = {}
    for cut in cuts:
        if 0 < cut < total:
            at = bisect_left(upto, cut)
            inside[cut] = (numbers[at], cut - (upto[at] - counts[numbers[at]]))
    full = {bucket: counts[bucket] for bucket, _ in inside.values()}
    whole = max(full.values(), default=0) > HOT * max(rows_per_task, total // buckets)
    found: dict[tuple[int, int], str] = {}
    if inside and not whole:
        place = F.row_number().over(W.partitionBy("__bucket").orderBy("__hash"))
        wanted = [(bucket, rest + i) for bucket, rest in inside.values() for i in (0, 1)]
        near = hashed.where(F.col("__bucket").isin(*full)).select("__bucket", "__hash").withColumn("__place", place)
        either = F.struct("__bucket", F.col("__place").alias("p")).isin(
            *[F.struct(F.lit(b).alias("__bucket"), F.lit(p).alias("p")) for b, p in wanted]
        )
        found = {(r["__bucket"], r["__place"]): r["__hash"] for r in near.where(either).collect()}
        whole = any(found[b, p] == found.get((b, p + 1)) for b, p in inside.values())
    if whole:
        return split_exact(df, key, train, valid, seed, rows_per_task=rows_per_task).drop("pos")

    def within(cut: int) -> Column:
        return F.col("__hash") <= found[inside[cut]] if cut in inside else F.lit(cut > 0)

    name = F.when(within(cuts[0]), SPLITS[0]).when(within(cuts[1]), SPLITS[1]).otherwise(SPLITS[2])
    return hashed.select(*kept, name.alias("split"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))


def count_gate(df: DataFrame, expected: int, strict: bool = False) -> DataFrame:
    """One row: expected, found, ok. In strict mode a wrong count stops the query."""
    gate = df.agg(F.count("*").alias("found")).select(
        F.lit(expected).cast("bigint").alias("expected"), "found", (F.col("found") == expected).alias("ok")
    )
    if strict:
        message = F.format_string("expected %d records, found %d", F.col("expected"), F.col("found"))
        gate = gate.withColumn("ok", F.when(F.col("ok"), True).otherwise(F.raise_error(message).cast("boolean")))
    return gate


def missing_splits(
    df: DataFrame, by: str, expected: tuple[str, ...] = SPLITS, strict: bool = False
) -> DataFrame:
    """The (by, split) combinations that should be there and are not.

    In strict mode a missing one, or an empty table, is an error at once.
    """
    present = df.select(by, "split").distinct()
    wanted = df.select(by).distinct().select(by, F.explode(F.array(*[F.lit(s) for s in expected])).alias("split"))
    missing = wanted.join(present, [by, "split"], "left_anti")
    if strict:
        if df.isEmpty():
            raise ValueError("required input is empty")
        if first := missing.head():
            raise ValueError(f"required input is missing: {by} {first[by]}, split {first['split']}")
    return missing


def first_n(df: DataFrame, n: int | None, order: str = "pos") -> DataFrame:
    """The first n rows in the given order; all of them when n is None.

    ``order`` numbers the rows from 1 without gaps, as ``pos`` of a split does.
    """
    return df if n is None else df.filter(F.col(order) <= n)
