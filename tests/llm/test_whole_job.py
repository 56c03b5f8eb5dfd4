"""Cases that an operator once returned in part."""

import re
from collections import defaultdict

import numpy as np

from extractkit.llm import licenses, paragraphs, passages, warc
from extractkit.llm.queries import QUERIES as LLM_QUERIES
from extractkit.session import fresh_path
from tests.conftest import SMALL
from tests.llm import brute

WORDS = [f"w{i}" for i in range(100)]


def test_warc_headers_of_any_length(spark):
    urls = ["http://a/", "data:," + "x" * 100_000, "http://b/?q=" + "é" * 9000, None, "http://c/"]
    # the end of the header on both sides of where the first search stops
    urls += ["u" * n for n in range(16_054, 16_204, 7)]
    rows = [(i, url, f"page {i} " * 20) for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc-test")
    warc.write(pages.coalesce(1), path)
    got = warc.read(spark, path).collect()
    found = {r.record_id: (r.url, bytes(r.payload).decode()) for r in got}
    assert len(got) == len(rows)
    for i, url, html in rows:
        kept, text = found[f"<urn:page-{i}>"]
        kept = kept and kept.encode("ISO-8859-1").decode()
        assert (kept, text) == (url, html)


def _shared_by_brute_force(texts, least):
    """(doc, start, end, words, removed) by looking at every run of ``least`` words."""
    words = {i: list(brute.SPACED.finditer((t or "").translate(brute.LOWER))) for i, t in texts.items()}
    seen = defaultdict(list)
    for i in sorted(words):
        for k in range(len(words[i]) - least + 1):
            seen[tuple(m[0] for m in words[i][k : k + least])].append((i, k))
    status = {p: p != v[0] for v in seen.values() if len(v) > 1 for p in v}
    found = set()
    for (i, k), removed in status.items():
        if status.get((i, k - 1)) is not removed:
            j = k
            while status.get((i, j + 1)) is removed:
                j += 1
            last = j + least - 1
            found.add((i, words[i][k].start(), words[i][last].end(), last - k + 1, removed))
    return found


def test_passages_in_other_lines_and_over_short_lines(spark):
    draw = np.random.default_rng(5)

    def prose(n):
        return [f"w{x}" for x in draw.integers(0, 10**6, n)]

    texts = {}
    for n in (49, 50, 51, 53, 59, 80, 200):
        passage = prose(n)
        for copy in range(3):
            words = [*prose(int(draw.integers(0, 90))), *passage, *prose(int(draw.integers(0, 90)))]
            width = (10**6, 7, 30)[copy]
            lines = (" ".join(words[i : i + width]) for i in range(0, len(words), width))
            texts[len(texts)] = "é " + "\n".join(lines)
    texts[len(texts)] = "na " * 2500
    texts[len(texts)] = " ".join([*WORDS[:30], *["na"] * 49, *WORDS[:60], *WORDS[:60]])
    texts[len(texts)] = None
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = passages.shared(docs).collect()
    want = _shared_by_brute_force(texts, 50)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert {3, 4, 5, 18, 19, 20} <= {r.doc_id for r in got} and not {0, 1, 2} & {r.doc_id for r in got}


def test_dedup_finds_passages_in_other_lines_and_over_short_lines(spark):
    draw = np.random.default_rng(8)

    def prose(n):
        return [f"w{x}" for x in draw.integers(0, 10**6, n)]

    texts, planted = {}, {}
    for n in [50, 51, 55, 60, 75, 120, 400] * 8:
        passage = prose(n)
        for copy in range(3):
            before = prose(int(draw.integers(0, 90)))
            words = [*before, *passage, *prose(int(draw.integers(0, 90)))]
            width = (10**6, 7, 30)[copy]
            lines = (" ".join(words[i : i + width]) for i in range(0, len(words), width))
            planted[len(texts)] = (len(before), n)
            texts[len(texts)] = "\n".join(lines)
    clean = {len(texts) + i: " ".join(prose(300)) for i in range(50)}
    rows = [*texts.items(), *clean.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = defaultdict(list)
    for r in paragraphs.repeated(docs).where("kind = 'span'").collect():
        got[r.doc_id].append(r)
    assert set(got) == set(planted)
    for i, (first, n) in planted.items():
        span = [m.span() for m in re.finditer(r"\S+", texts[i])]
        for r in got[i]:
            # inside the passage, whole words, no more than the placing may lose at its ends
            assert first <= r.paragraph and r.paragraph + r.n_words <= first + n
            assert (r.start, r.end) == (span[r.paragraph][0], span[r.paragraph + r.n_words - 1][1])
        assert sum(r.n_words for r in got[i]) >= max(32, n - 36)
        # the first document of the three keeps its copy; the words next to a passage may be in a span
        # of two copies alone, whose first is another
        assert sum(r.n_words for r in got[i] if r.removed == (i % 3 > 0)) >= max(32, n - 36)
        assert i % 3 or not any(r.removed for r in got[i])


def test_dedup_holds_every_passage_that_two_documents_share(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    words = {i: [m for m in re.finditer(r"\S+", t or "")] for i, t in rows}
    owners = defaultdict(set)
    for i, found in words.items():
        low = [m.group().lower() if m.group().isascii() else m.group() for m in found]
        for k in range(len(low) - 49):
            owners[tuple(low[k : k + 50])].add((i, k))
    want = {(i, k) for places in owners.values() if len({i for i, _ in places}) > 1 for i, k in places}
    found = defaultdict(list)
    for r in LLM_QUERIES["op2_substring_dedup"](spark, SMALL).collect():
        found[r.doc_id].append((r.start, r.end))
    missed = set()
    for i, k in want:
        a, b = words[i][k].start(), words[i][k + 49].end()
        if not any(start < b and a < end for start, end in found[i]):
            missed.add(i)
    assert len({i for i, _ in want}) >= 10 and not missed


def test_passages_of_the_smallest_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = LLM_QUERIES["op2_shared_passages"](spark, SMALL).collect()
    assert {tuple(r) for r in got} == _shared_by_brute_force(dict(map(tuple, rows)), 50)


def test_equal_notices_in_a_row(spark):
    texts = []
    for name in ("MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0"):
        texts += [(name, n, "\n".join([licenses.TEMPLATES[name]] * n)) for n in (1, 2, 3)]
    texts.append(("MIT", 2, "Released under the MIT License released under the MIT licence"))
    texts.append(("MIT", 2, "Released under the MIT licence released under the MIT License"))
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(texts)], "doc_id long, text string")
    got = defaultdict(list)
    for r in licenses.scan(docs).orderBy("doc_id", "start").collect():
        got[r.doc_id].append((r.license, r.start, r.end))
    for i, (name, n, text) in enumerate(texts):
        assert [x[0] for x in got[i]] == [name] * n
        assert all(a[2] <= b[1] for a, b in zip(got[i], got[i][1:]))
        assert n > 1 or got[i] == [(name, 0, len(text))]


def test_notices_with_as_many_other_words_as_the_coverage_allows(spark):
    texts = [("MIT", 4, "x Released under an MIT License")]
    for name in ("MIT", "CC-BY-NC-4.0", "Apache-2.0", "CC-BY-4.0"):
        words = [w.decode() for w in licenses.words_of(licenses.TEMPLATES[name])]
        for k in range(len(words)):
            texts.append((name, len(words) - 1, " ".join(["x", *words[:k], "other", *words[k + 1 :], "y"])))
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(texts)], "doc_id long, text string")
    got = [(r.doc_id, r.license, r.matched_words) for r in licenses.scan(docs).orderBy("doc_id").collect()]
    assert got == [(i, name, n) for i, (name, n, _) in enumerate(texts)]
