"""What queries leave on disk between their steps, and scans that work on many texts at once."""

import glob
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from extractkit.llm import ngram_join, preference, tables


def test_saved_leaves_no_shuffle_files(spark):
    """They stayed until the driver happened to collect its garbage."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in found for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    rows = spark.range(200_000).groupBy(F.xxhash64("id").alias("x")).agg(F.max("id").alias("id"))
    kept = tables.saved(rows.repartition(7, "id"), "shuffled")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert kept.count() == 200_000 and spark.conf.get(tables.CLEANUP) == "false"


def test_accepted_writes_no_whole_rows(spark, monkeypatch):
    """The features of a stage's rows were written with the rows, texts included."""
    docs = [(i, " ".join(f"w{k % (2 + i % 9)}" for k in range(30)) + "!" * (i % 2 * 9), "src") for i in range(60)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    written = []
    monkeypatch.setattr(preference, "saved", lambda df, label: written.append(df) or tables.saved(df, label))
    got = {r.doc_id for r in preference.accepted(docs, labels).collect()}
    assert got == set(range(0, 60, 2))
    assert written and not any(f in df.schema.simpleString() for df in written for f in ("text", "source"))


def test_digests_and_signatures_hash_a_batch_at_once(monkeypatch):
    sets = [np.sort(np.random.default_rng(i).integers(0, 1 << 63, i % 40, dtype=np.uint64)) for i in range(400)]
    ids, calls, mix = pa.array(range(len(sets)), pa.int64()), [], ngram_join.mix
    want = [[int(mix(s * ngram_join.constants(f, 1)[0]).sum(dtype=np.uint64)) for s in sets] for f in (31, 37)]
    first = [ngram_join.signatures(s, 75) for s in sets if len(s)]
    monkeypatch.setattr(ngram_join, "mix", lambda h: calls.append(1) or mix(h))
    (batch,) = ngram_join._digests(ids, sets)
    assert len(calls) == 2  # one for each set and digest before
    assert [batch.column(k).to_numpy().view(np.uint64).tolist() for k in (2, 3)] == want
    listed = ngram_join._listed(lambda s, content: ngram_join.signatures(s, 75, content))
    got = np.concatenate([b.column(0).to_numpy().view(np.uint64) for b in listed(ids, sets)])
    assert got.tolist() == np.concatenate(first).tolist()
