"""Intermediate tables in the shared folder, and reading the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.session import fresh_path

#: Rows of one or two numbers that may be broadcast: about 40 MB.
BROADCAST_ROWS = 1_000_000


#: Rows of a few numbers that one task takes.
TASK_ROWS = 250_000


#: Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of rows sent to a Python worker at once; the JVM's buffers and the worker's are a few times that.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def saved(df: DataFrame, label: str, codec: str | None = None, batch: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, an executor may be lost.

    What the write shuffled is deleted when it is done. With ``batch``, Python workers get rows of about so
    many bytes at a time.
    """
    spark = df.sparkSession
    path, wanted = fresh_path(spark, label), {CLEANUP: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        df.write.parquet(path, compression=codec)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint where its counted rows are within the bound; else unchanged."""
    return F.broadcast(df) if rows <= most else df


def gathered(df: DataFrame, rows: int, most: int = TASK_ROWS) -> DataFrame:
    """``df``, of ``rows`` counted rows or made from so many, in no more tasks than these need.

    A few rows are one task's, which groups and joins them without a shuffle: otherwise each step on a small
    table has as many tasks as a large one's.
    """
    return df.coalesce(max(1, -(-rows // most)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
