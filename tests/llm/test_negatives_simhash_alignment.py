"""Hard negatives, SimHash and token alignment against plain readings, with their edges."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from extractkit.llm import alignment, negatives, simhash
from extractkit.llm.queries import ALIGNED, QUERIES
from tests.conftest import SMALL
from tests.llm import brute

PATHS = [public_tokenizers.path(name) for name in ALIGNED]
VECTORS = "vec_id long, embedding array<float>, label int, row long, id string, score int"
TEXTS = "doc_id long, text string, chunk int, place int, row long, n_a int, links string, tie int, copy int"


# --- hard negatives -----------------------------------------------------------------------------


def _mined(df):
    return sorted(tuple(r) for r in negatives.digest(df).collect())


def test_hard_negatives_of_the_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SMALL).collect())
    assert got == brute.hard_negatives([tuple(r) for r in rows]) and got


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_hard_negatives_with_ties_nulls_and_repeats(spark, spread, monkeypatch):
    """Few values make many equal scores; windows of all kinds, also empty ones."""
    monkeypatch.setattr(negatives, "BLOCK", 64)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", 700)
    draw = np.random.default_rng(spread)
    vectors = (draw.integers(-spread, spread + 1, (300, 5)) / 256).tolist()
    rows = [(i, v, int(draw.integers(0, 3)), 1, "x", 2) for i, v in enumerate(vectors)]
    rows += [
        (None, vectors[0], 1, 1, "x", 2),
        (50, None, 1, 1, "x", 2),
        (100, vectors[1], None, 1, "x", 2),
        (150, [*vectors[2][:4], None], 1, 1, "x", 2),
        (200, [*vectors[2][:4], float("nan")], 1, 1, "x", 2),
        (250, [*vectors[2][:4], float("inf")], 1, 1, "x", 2),
        (250, vectors[3], 1, 1, "x", 2),
        (250, vectors[3], 1, 1, "x", 2),
        (7, [], 2, 1, "x", 2),
        (350, [0.0] * 5, 2, 1, "x", 2),
        (400, vectors[5][:3], 2, 1, "x", 2),
    ]
    got = _mined(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert got == brute.hard_negatives([(r[0], r[2], r[1]) for r in rows])


def test_hard_negatives_of_nothing(spark):
    assert _mined(spark.createDataFrame([], VECTORS)) == []
    only = spark.createDataFrame([(50, [0.5, 0.5], 1, 1, "x", 2)], VECTORS)
    assert _mined(only) == []


def test_large_components_stay_exact(spark):
    """Beyond the integers a double holds scores are summed as 64-bit integers; beyond those is an error."""
    rows = [(i, [float(1 << 20) + i, 3.0 * i], i % 3, 1, "x", 2) for i in range(60)]
    df = spark.createDataFrame(rows, VECTORS.replace("float", "double"))
    assert _mined(df) == brute.hard_negatives([(r[0], r[2], r[1]) for r in rows])
    huge = spark.createDataFrame([(i, [1e12], i % 2, 1, "x", 2) for i in range(60)], VECTORS)
    with pytest.raises(Exception, match="64 bits"):
        _mined(huge)


def test_threshold_stops_early():
    """Rows that can't matter are not scored: the bound falls below the windows long before the lists end."""
    draw = np.random.default_rng(1)
    vectors = np.concatenate([draw.integers(-5, 6, (4000, 2)), draw.integers(900, 1000, (20, 2))]).astype(float)
    n = len(vectors)
    lists = negatives.Lists(vectors, np.arange(n), np.arange(n), np.zeros(n, dtype=np.int64))
    seen = []
    windows = negatives.Windows([-(1 << 40)], [1 << 40], 5)
    offer = windows.offer
    windows.offer = lambda s, i, r: (seen.extend(i.tolist()), offer(s, i, r))
    lists.search(np.array([3.0, 2.0]), np.ones(n, dtype=bool), windows)
    want = np.lexsort((np.arange(n), -(vectors @ [3.0, 2.0])))[:5]
    assert windows.rows[0][:, 1].tolist() == want.tolist()
    assert len(seen) == len(set(seen)) < n // 2


# --- SimHash ------------------------------------------------------------------------------------


def test_simhash_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    _check_simhash(QUERIES["op12_simhash"](spark, SMALL).collect(), rows)


def _check_simhash(got, rows):
    want = brute.edited(rows)
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t in rows}
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    by_text = {}
    for r in got:
        n, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        for text, fingerprint in ((texts[r.doc_id], r.fingerprint), (edited, r.edited_fingerprint)):
            assert by_text.setdefault(text, fingerprint) == fingerprint and len(fingerprint) == 16
        assert r.near_edited == 1 - (prints[r.doc_id] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
    order = sorted(prints, reverse=True)
    for k, i in enumerate(order):
        r = next(x for x in got if x.doc_id == i)
        assert r.near_next == 1 - (prints[i] ^ prints[order[(k + 1) % len(order)]]).bit_count() / 64
        near = sum((prints[i] ^ x).bit_count() <= 3 for x in prints.values()) - 1
        assert r.n_near == (near if i % 20 == 0 else None)


def test_simhash_over_many_chunks(spark, monkeypatch):
    """Ids with gaps and below zero, odd texts; the order is cut in many places."""
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 7)
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(90)]
    ids = draw.choice(10_000, 200, replace=False) - 500
    rows = [(int(i), " ".join(draw.choice(words, int(draw.integers(0, 60))))) for i in ids]
    rows[:5] = [(rows[k][0], t) for k, t in enumerate([None, "", " \n", "É́ß\U0001f600 " * 9, "x" * 70_000])]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "y", 5, 6) for r in rows], TEXTS).repartition(5)
    _check_simhash(simhash.digest(df).collect(), rows)


def test_simhash_of_repeats_and_nulls(spark, monkeypatch):
    """One id with most rows is cut into several chunks; rows stay as many as they were."""
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 10)
    rows = [(5, f"text number {i} of one id") for i in range(80)] + [(5, "same")] * 9
    rows += [(None, "a b c"), (None, None)] + [(i, f"other {i}") for i in range(6, 40)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "y", 5, 6) for r in rows], TEXTS).repartition(3)
    chunks = simhash.edited_copies(df).where("id = 5 and not copy").select("chunk").distinct().count()
    assert chunks > 3
    got = simhash.digest(df).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 2
    order = sorted((5, t) for t in {t for i, t in rows if i == 5})
    assert len({r.fingerprint for r in got if r.doc_id == 5}) <= len(order)
    assert simhash.digest(df.limit(0)).count() == 0
    one = simhash.digest(df.where("doc_id = 6")).collect()
    assert [(r.n_chars, r.near_edited <= 1, r.near_next) for r in one] == [(7, True, 1.0)]


def test_fingerprint_is_the_sign_of_the_votes(spark):
    texts = ["Alpha beta gamma", "alpha BETA gamma beta", "a", ""]
    got = simhash.fingerprints(spark.createDataFrame([(t, t) for t in texts], "name string, text string"), "text")
    got = {r.name: r.fingerprint for r in got.collect()}
    words = sorted({w for t in texts for w in t.lower().split()})
    hashes = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    hashes = {r.w: r.h & (2**64 - 1) for r in hashes}
    for text in texts:
        votes = [0] * 64
        for w in text.lower().split():
            for bit in range(64):
                votes[bit] += max(1, len(w) - 2) * (1 if hashes[w] >> bit & 1 else -1)
        assert got[text] & (2**64 - 1) == sum(1 << bit for bit in range(64) if votes[bit] > 0)


@pytest.mark.parametrize(("radius", "blocks"), [(0, 1), (1, 2), (3, 4), (3, 6), (5, 8)])
def test_block_tables_find_every_pair(spark, radius, blocks):
    draw = np.random.default_rng(radius)
    base = draw.integers(-(2**63), 2**63, 40)
    near = [int(x) ^ sum(1 << int(b) for b in draw.choice(63, int(draw.integers(0, 8)), replace=False)) for x in base for _ in range(6)]
    every = sorted({*map(int, base), *near, 0, -1, -(2**63)})
    df = spark.createDataFrame([(x,) for x in [*every, *every[:9], None]], "fingerprint long")
    asked = df.where("fingerprint % 3 = 0")
    got = sorted((r.query, r.found, r.distance) for r in simhash.within(asked, df, radius, blocks).collect())
    full = 2**64 - 1
    want = sorted(
        (q, x, ((q ^ x) & full).bit_count())
        for q in every
        if (abs(q) % 3 == 0)
        for x in every
        if ((q ^ x) & full).bit_count() <= radius
    )
    assert got == want


# --- alignment ----------------------------------------------------------------------------------


def _aligned(df):
    return {r.doc_id: tuple(r)[1:] for r in alignment.digest(df, *PATHS).collect()}


def test_alignment_of_the_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, SMALL).collect()}
    assert got == brute.alignment({r.doc_id: r.text for r in rows}, *PATHS)


ODD = [
    None,
    "",
    " ",
    "  ",
    "a  b",
    " a b ",
    "a \nb\n c\t d",
    "<|endoftext|> </s> <0x41> <s><unk>",
    "x\u2581y \u2581",
    "É́ \u0301a ﬁ ① Å",
    "\U0001f600\U0001f600 \u3000 \xa0 z",
    "\x00 \x1c \x85",
    "it's we'll I'd  've",
    "一二三 四五",
    "same words same words",
    "same words same words",
]


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 40)
    draw = np.random.default_rng(5)
    words = [f"word{i}" for i in range(500)]
    texts = [*ODD, " ".join(draw.choice(words, 60_000)), "y" * 30_000]
    rows = [(i, t, 1, 2, 3, 4, "z", 5, 6) for i, t in enumerate(texts)]
    got = _aligned(spark.createDataFrame(rows, TEXTS).repartition(3))
    assert got == brute.alignment(dict(enumerate(texts)), *PATHS)


def test_alignment_of_repeats_nulls_and_nothing(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "three"), (2, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "z", 5, 6) for r in rows], TEXTS)
    got = sorted(tuple(r)[:5] for r in alignment.digest(df.fillna({"doc_id": -1}), *PATHS).collect())
    assert [r[0] for r in got] == [-1, 1, 1, 2] and got[1] == got[2] and got[3][1:] == (0, 0, 0, 0)
    assert alignment.digest(df, *PATHS).where("doc_id is null").count() == 1
    assert alignment.digest(df.limit(0), *PATHS).count() == 0


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*PATHS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(" ab'1.\n\t\u3000é\u2581\x1c", max_size=30) | st.text(max_size=12), max_size=6))
def test_pieces_give_the_whole_text(aligner, texts):
    """Cutting and caching change nothing."""
    texts = [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    whole = aligner.sides[0].tokenizer
    for text, (counts, shown, links) in zip(texts, aligner.documents(texts), strict=True):
        if not counts[0]:
            continue
        a = whole.encode(" " + text, add_special_tokens=False).ids
        b = aligner.sides[1].model.encode(text)
        assert [int(x) for g in shown.split(";") for x in g.split("|")[0].split(",")] == a
        assert [int(x) for g in shown.split(";") for x in g.split("|")[1].split(",")] == b
        assert counts == (len(a), len(b), shown.count(";") + 1, len(links))


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_PIECES", 30)
    draw = np.random.default_rng(8)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 200, 40)) for _ in range(60)]
    small, large = alignment.Aligner(*PATHS), alignment.Aligner(*PATHS)
    want = [(c, s, x.tolist()) for c, s, x in large.documents(texts)]
    got = [(c, s, x.tolist()) for t in texts for c, s, x in small.documents([t])]
    assert got == want


def test_pointer_jumping_on_a_long_chain():
    """Tokens that overlap like bricks are one group, however long."""
    n = 5000
    first = np.arange(0, 2 * n, 2), np.arange(2, 2 * n + 2, 2)
    second = np.array([0, *range(1, 2 * n - 1, 2), 2 * n - 1]), np.array([*range(1, 2 * n, 2), 2 * n])
    end = alignment.jumped(alignment.successors((first[0], second[0]), (first[1], second[1])))
    assert set(end.tolist()) == {n - 1}
