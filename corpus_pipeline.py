"""The corpus pipeline: documents in, packed training sequences out.

Each stage is one operator of ``extractkit.llm`` and works on all rows the stage before kept. All but
the last return the columns of ``documents``; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.llm import decontaminate, ngram_join, packing, preference, secrets
from extractkit.llm.tables import read, saved

VOCABULARY = "word_bpe_49k.json"
#: Words the packing stage keeps per worker, whose workers also hold what the stages before left.
CACHED_WORDS = 250_000

#: How files are cut into tasks must not follow the number of executors alive while rows are told apart by place.
CUT = "spark.sql.files.minPartitionNum"
#: Rows in one Arrow batch: Python workers hold a batch in several forms, and documents may be long.
BATCH_ROWS = 1000


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return preference.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id, of equal ids the first; a null id is the last.

    Rows are told apart by their place, not by id: of an id's several texts each has its own group, and
    of a repeated row one stays. ``docs`` must read alike each time, as a written table does; how its
    files are cut is fixed for the session, since a lost executor would change it between two jobs.
    """
    if spark.conf.get(CUT, None) is None:
        spark.conf.set(CUT, str(spark.sparkContext.defaultParallelism))
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    groups = ngram_join.near_duplicates(numbered, id_col="__row")
    rows = saved(groups.join(numbered.select("__row", "doc_id"), "__row"), "groups")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    first = rows.groupBy("component_id").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = rows.join(first, "component_id").where(F.col("__row") != F.col("first.__row")).select("__row")
    return numbered.join(gone, "__row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark text go."""
    return _counted(decontaminate.removed(docs, read(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark."""
    return _counted(secrets.scan(docs, redact="[SECRET]").select(*docs.columns))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.packed(docs, public_tokenizers.path(VOCABULARY), cached=CACHED_WORDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit),
]

#: A fitted classifier and a tokenizer's ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    cut = spark.conf.get(CUT, None) or str(spark.sparkContext.defaultParallelism)
    with _settings(spark, **{CUT: cut, "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        for number, (_, stage) in enumerate(STAGES):
            docs = saved(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
