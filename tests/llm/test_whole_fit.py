"""The classifier learns from every labelled document that isn't held out."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from extractkit.llm import preference

KNOWN = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]


def rows_of(spark, n, of):
    """``n`` labelled documents, not held out, that repeat ``of`` different ones."""
    docs, labels = [], []
    draw = np.random.default_rng(3)
    kinds = [(draw.integers(3, 40), draw.random() < 0.3) for _ in range(of)]
    for at, i in enumerate(KNOWN[:n]):
        size, bad = kinds[at % of]
        noise = at % of % 7 == 0
        text = " ".join(f"w{k % (5 if bad != noise else 30)}" for k in range(size)) + "!" * (size % 4)
        docs.append((i, text))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_copies_of_all_documents_change_nothing(spark):
    """Pairs were drawn by chance, so the scores of the same documents followed their number."""
    once, twice = rows_of(spark, 60, 60), rows_of(spark, 120, 60)
    want = {r.doc_id: r.score for r in preference.scored(*once).collect()}
    got = {r.doc_id: r.score for r in preference.scored(*twice).collect()}
    assert len(set(want.values())) > 5
    assert {i: got[i] for i in want} == pytest.approx(want, abs=1e-9)


def test_groups_hold_every_row(spark, monkeypatch):
    """Groups and shards much smaller than the classes: sums are over all rows, the threshold over all scores."""
    monkeypatch.setattr(preference, "GROUP", 8)
    docs, labels = rows_of(spark, 90, 90)
    rows = preference.featured(docs).join(labels, "doc_id").groupBy(F.col("quality").alias("q"), "__features")
    train = rows.agg(F.count("*").alias("weight"))
    weights, centre, scale, cut = preference.fit(train)
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = np.array([preference.features_of(texts[i]) for i in sorted(texts)])
    good = np.array([r.quality for r in sorted(labels.collect())]) == 1
    assert centre == pytest.approx(made.mean(axis=0))
    assert scale == pytest.approx(np.where(made.std(axis=0) < 1e-9, 1, made.std(axis=0)))
    scores = (made - centre) / scale @ weights
    sides = [(scores[good] >= c).mean() + (scores[~good] < c).mean() for c in scores]
    assert (scores[good] >= cut).mean() + (scores[~good] < cut).mean() == pytest.approx(max(sides))
    assert max(sides) > 1.2
