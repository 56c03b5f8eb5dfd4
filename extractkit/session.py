"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import extractkit

# Settings the JSON operators need for the same results as a last-key-wins parser.
REQUIRED_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}
# The JVM never compiles methods over 8000 bytes of bytecode. With the limit there, a stage too
# long for one compiled method runs as several, each of which is.
SPEED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every operator relies on; safe to call again.

    Predictors and tokenizers defined in this package travel to the workers by value, so the
    workers need not have it installed.
    """
    cloudpickle.register_pickle_by_value(extractkit)
    for name, value in (REQUIRED_CONF | SPEED_CONF).items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only where the setting is absent in a local run is a temporary folder made and registered,
    once per Spark context; on a cluster, where executors don't share such a folder, that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="extractkit-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and not again when an executor is lost."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Repartition a scan that has too few tasks for the work each of its rows means.

    A scan is cut by bytes read, which says little when a row is an id that becomes a kilobyte,
    or a long text to tokenize. Without ``rows_per_task`` nothing is shuffled once the scan has a
    task per core; with it, the rows are counted and shuffled if tasks would be larger than that.
    """
    tasks = df.rdd.getNumPartitions()
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task is not None:
        wanted = max(wanted, -(-df.count() // rows_per_task))
    return df if tasks >= wanted else df.repartition(wanted)
