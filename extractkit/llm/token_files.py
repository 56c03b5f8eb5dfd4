"""Token-id files: documents in ascending id order, coded in checksummed blocks.

A folder of Parquet files whose rows are chunks: part and chunk (their order), documents (id and
number of ids, in order) and data, the coded ids of whole documents. Rows of ``documents`` are dealt
out by ranges of the id, so writing sorts in parallel and nothing passes through one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from extractkit.llm.tables import saved, small_side
from extractkit.llm.token_coder import decode, encode
from extractkit.llm.tokens import kept
from extractkit.session import fresh_path

#: Ids of whole documents gathered into one chunk; a longer document is a chunk of its own.
CHUNK = 8 << 20


def write(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text, append the end id, and write the ids in ascending order of the id column.

    Null and empty texts are the end id alone. Null ids come first; rows that repeat an id stay, in
    the order of a hash of their text. An empty table writes no chunk. Other columns are not written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = kept(tokenizer), TaskContext.get().partitionId()
        owners, parts, total, number = [], [], 0, 0

        def chunk() -> pa.RecordBatch:
            documents = [{"id": i, "n": len(x)} for i, x in zip(owners, parts, strict=True)]
            columns = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([total], pa.int64()),
                pa.array([documents], pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))),
                pa.array([encode(np.concatenate(parts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "chunk", "ids", "documents", "data"])

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for owner, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if parts and total + len(ids) > CHUNK:
                    yield chunk()
                    owners, parts, total, number = [], [], 0, number + 1
                owners.append(owner)
                parts.append(ids)
                total += len(ids)
        if parts:
            yield chunk()

    shape = "part int, chunk int, ids long, documents array<struct<id:long,n:long>>, data binary"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    rows.mapInArrow(run, shape).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document: id, start (ids of all documents before it), n_tokens, ids array<int>.

    Every block's checksum is tested; a damaged file raises.
    """
    return _read(spark, path, True)


def _read(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    chunks = spark.read.parquet(path)
    sizes = saved(chunks.select("part", "chunk", "ids"), "chunk-sizes")
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n"))  # one row per task that wrote
    parts = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    placed = sizes.withColumn("inner", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    placed = placed.join(small_side(parts, parts.count()), "part")
    placed = saved(placed.select("part", "chunk", (F.col("base") + F.col("inner")).alias("at")), "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                documents = batch.column(2)[row].as_py()
                ids = decode(batch.column(3)[row].as_py())
                n = np.array([d["n"] for d in documents], dtype=np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends, n, strict=True)]
                columns = [
                    pa.array([batch.column(0)[row].as_py()] * len(n), pa.int32()),
                    pa.array([batch.column(1)[row].as_py()] * len(n), pa.int32()),
                    pa.array([d["id"] for d in documents], pa.int64()),
                    pa.array(ends - n),
                    pa.array(n),
                    pa.array(crc, pa.int64()),
                ]
                names = ["part", "chunk", "id", "inner", "n_tokens", "ids_crc32"]
                if whole:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    shape = "part int, chunk int, id long, inner long, n_tokens long, ids_crc32 long"
    rows = chunks.select("part", "chunk", "documents", "data").mapInArrow(
        run, shape + ", ids array<int>" * whole
    )
    rows = rows.join(small_side(placed, placed.count()), ["part", "chunk"])
    return rows.withColumn("start", F.col("at") + F.col("inner")).drop("part", "chunk", "at", "inner")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents, read the files back, and return places, lengths and checksums."""
    path = fresh_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer)
    return _read(docs.sparkSession, path, False).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )
