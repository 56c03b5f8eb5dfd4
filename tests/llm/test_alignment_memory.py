"""What the alignment's tasks hold at once."""

import numpy as np
from pyspark.sql import functions as F

from extractkit.llm import alignment, tables
from tests.llm.test_negatives_simhash_alignment import PATHS


def test_batches_follow_bytes_not_rows(spark, monkeypatch):
    """A task got up to 10,000 rows or 64 MB of links at once."""
    monkeypatch.setattr(alignment, "BATCH_BYTES", 20_000)
    most = spark.sparkContext.accumulator(0)
    rows = spark.range(400, numPartitions=2).select("id", F.repeat(F.lit("x"), 1000).alias("text"))

    def run(batches):
        for batch in batches:
            if batch.nbytes > 40_000:
                most.add(1)
            yield batch

    before = spark.conf.get(tables.BATCH)
    made = tables.saved(rows.mapInArrow(run, "id long, text string"), "batches", batch=alignment.BATCH_BYTES)
    assert made.count() == 400 and most.value == 0
    assert spark.conf.get(tables.BATCH) == before


def test_every_pass_is_saved_in_small_batches(spark, monkeypatch):
    """No pass over texts or links runs later, under the session's own batch size; small batches change nothing."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in draw.integers(0, 90, 40)) for _ in range(50)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, alignment.digest(docs, *PATHS).collect()))
    asked, saved = [], alignment.saved

    def noted(df, label, codec=None, batch=None):
        asked.append((label, batch))
        return saved(df, label, codec, batch)

    monkeypatch.setattr(alignment, "BATCH_BYTES", 500)
    monkeypatch.setattr(alignment, "saved", noted)
    made = alignment.digest(docs, *PATHS)
    assert "MapInArrow" not in made._jdf.queryExecution().toString()
    assert sorted(map(tuple, made.collect())) == want
    assert {(x, 500) for x in ("links", "pairs", "sums")} <= set(asked)
