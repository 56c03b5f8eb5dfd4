"""Each registered query against a plain reading of its contract, on a whole small table."""

import hashlib
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from extractkit.llm.queries import QUERIES, VOCABULARY
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def ids(texts):
    coder = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return {i: [*coder.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}


def rows_of(spark, name):
    return QUERIES[name](spark, SMALL).collect()


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_quality_rules(spark, texts):
    got = rows_of(spark, "op1_quality_rules")
    assert len(got) == len(texts)
    for r in got:
        want = brute.counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and not r.rejected_by)


def test_substring_dedup(spark, texts):
    from extractkit.llm.paragraphs import cut

    got = [r for r in rows_of(spark, "op2_substring_dedup") if r.kind == "line"]
    sets = {
        (i, number): brute.shingle_set(t[a:b]) for i, t in texts.items() for number, a, b, _ in cut(t, 50)
    }
    want = defaultdict(set)
    for key, first in brute.classes(sets).items():
        want[first].add(key)
    want = {k: v for k, v in want.items() if len(v) > 1}
    found = defaultdict(set)
    for r in got:
        found[r.cluster].add((r.doc_id, r.paragraph))
    assert {frozenset(v) for v in found.values()} == {frozenset(v) for v in want.values()}
    assert {(r.doc_id, r.paragraph) for r in got if not r.removed} == set(want)


def test_packing(spark, ids):
    got = rows_of(spark, "op3_best_fit_packing")
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        starts = range(0, len(ids[i]), 4096)
        want = [(k, s, min(4096, len(ids[i]) - s)) for k, s in enumerate(starts)]
        assert sorted(parts) == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(map(len, ids.values())) // 4096) + 1


def test_license_scan(spark, texts):
    got = rows_of(spark, "op4_license_scan")
    lines = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0",
        "MIT": "Released under the MIT License",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    }
    want = {(i, k) for i, t in texts.items() for k, line in lines.items() if line in t}
    assert {(r.doc_id, r.license) for r in got} == want
    assert all(texts[r.doc_id][r.start : r.end] == lines[r.license] for r in got)


def test_quality_classifier(spark, texts):
    got = rows_of(spark, "op5_quality_classifier")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    quality = {r.doc_id: r.quality for r in labels}
    assert len(got) == len(texts)
    right = [r.predicted == quality[r.doc_id] for r in got if r.held_out and r.doc_id in quality]
    assert sum(right) >= 0.9 * len(right)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_decontamination(spark, texts):
    got = rows_of(spark, "op6_decontamination")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for r in got:
        words, places, met = brute.hits(texts[r.doc_id], items)
        digest = hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest()
        want = (len(words), len(places), len(met), digest, bool(places))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want
    assert any(r.contaminated for r in got)


def test_token_files(spark, ids):
    got = {r.doc_id: r for r in rows_of(spark, "op7_token_files")}
    at = 0
    for i in sorted(ids):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids[i]), crc(ids[i]))
        at += len(ids[i])
    assert len(got) == len(ids)


def test_warc(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: r for r in rows_of(spark, "op8_warc")}
    first = {}
    for r in rows:
        first[r.html] = min(r.page_id, first.get(r.html, r.page_id))
    assert len(got) == len(rows)
    for r in rows:
        raw = r.html.encode()
        again = len(raw) >= 100 and first[r.html] != r.page_id
        want = (r.page_id, len(raw), hashlib.sha256(raw).hexdigest())
        want += ("revisit", first[r.html]) if again else ("response", None)
        assert tuple(got[r.page_id]) == want


def test_secret_scan(spark, texts):
    for r in rows_of(spark, "op9_secret_scan"):
        spans = brute.secrets(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert r.n_assign == spans.count("assign:") and r.n_access == spans.count("access:")
        assert r.n_hex == spans.count("hex:") and set(spans.split(",")) <= set(r.spans.split(",")) | {""}


def test_ngram_join(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows_of(spark, "op10_ngram_jaccard_join")}
    sets = {i: brute.shingle_set(t) for i, t in texts.items()}
    assert got == {i: (len(sets[i]), c) for i, c in brute.classes(sets).items()}


def test_pipeline(spark, texts):
    """Each stage does its own job on what the one before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = dict(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        now = {r.doc_id: r.text for r in rows}
        assert set(now) <= set(kept) and len(now) == len(rows)
        if name == "quality classifier":
            scores = rows_of(spark, "op5_quality_classifier")
            assert set(now) == {r.doc_id for r in scores if r.predicted}
        elif name == "n-gram Jaccard join":
            first = brute.classes({i: brute.shingle_set(t) for i, t in kept.items()})
            assert set(now) == {i for i, c in first.items() if i == c}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            for i, t in kept.items():
                words, places, _ = brute.hits(t, items)
                assert (i in now) == (len(places) <= 0.5 * len(words))
                assert i not in now or (now[i] == t) == (not places)
        else:
            assert not any(brute.secrets(t) for t in now.values())
            assert all(now[i] == t for i, t in kept.items() if not brute.secrets(t))
        assert all(r.n_chars == len(r.text) for r in rows if r.text != texts[r.doc_id])
        kept = now
    packed = corpus_pipeline.best_fit(spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(kept)
    assert corpus_pipeline.run(spark, SMALL).count() == len(packed)
