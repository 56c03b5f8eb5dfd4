"""Benchmark decontamination: texts are streamed through a suffix automaton of the test items.

Words are runs of letters and digits and of all characters beyond ASCII, A-Z lower-cased. A window
is ``window`` consecutive words of an item, or all words of a shorter item; words of a text inside
any occurrence of a window are hit.

The automaton is broadcast. Its size is bounded: items are taken in blocks of at most
``BLOCK_WORDS`` words (a longer single item is a block of its own), and beyond one block the texts
are scanned once for each, so any number of items works.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.automaton import Automaton
from extractkit.llm.tables import saved
from extractkit.llm.textscan import released

#: Words of items in one automaton, about 100 MB in a worker.
BLOCK_WORDS = 100_000
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same class as a table: other bytes become spaces, A-Z small letters.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(TABLE).split()


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    block, total = [], 0
    for item, text in items.select(item_col, text_col).toLocalIterator():
        words = words_of(text)
        if block and total + len(words) > BLOCK_WORDS:
            yield block
            block, total = [], 0
        block.append((item, words))
        total += len(words)
    yield block


def scan(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words long, hit_spans array<array<long>>, hit_items array<string>.

    Spans are (first word, word after the last), merged, ascending; items are ids as text, distinct,
    sorted as text. Null texts and null item texts have no words; rows of items with a null id are
    left out of hit_items but their windows count. Repeated rows are each scanned. Empty tables
    give no rows, or no hits. Columns of the three names in ``docs`` are replaced.
    """
    added = ["n_words", "hit_spans", "hit_items"]
    kept = docs.drop(*added)
    found = kept.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "hit_spans": F.array().cast("array<array<long>>"),
            "hit_items": F.array().cast("array<string>"),
        }
    )
    names = kept.columns
    place, n = names.index(text_col), len(names)
    shape = found._jdf.schema().toDDL()
    for number, block in enumerate(_blocks(items, item_col, item_text_col)):
        if number:
            found = saved(found, "scanned")
        shared = docs.sparkSession.sparkContext.broadcast(vars(Automaton(block, window)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = Automaton.__new__(Automaton)
            vars(automaton).update(shared.value)
            for batch in released(batches):
                texts = batch.column(place).to_pylist()
                spans_before = batch.column(n + 1).to_pylist()
                items_before = batch.column(n + 2).to_pylist()
                counts, spans, met = [], [], []
                for text, old, have in zip(texts, spans_before, items_before, strict=True):
                    words = words_of(text)
                    new, from_ = automaton.scan(words)
                    counts.append(len(words))
                    spans.append(merged([*map(tuple, old), *new]) if old else new)
                    met.append(sorted({*have, *(str(i) for i in from_ if i is not None)}))
                columns = [
                    pa.array(counts, pa.int64()),
                    pa.array([[list(s) for s in x] for x in spans], pa.list_(pa.list_(pa.int64()))),
                    pa.array(met, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:n], *columns], [*names, *added]
                )

        found = found.mapInArrow(run, shape)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _without(text: str, spans: list[list[int]]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw = text.encode()
    bounds = [m.span() for m in re.finditer(WORD, raw.lower())]
    out, at = [], 0
    for first, after in spans:
        out.append(raw[at : bounds[first][0]])
        at = bounds[after - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def removed(
    docs: DataFrame, items: DataFrame, window: int = 10, most: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``docs`` without benchmark passages.

    Spans of hit words are cut out of the text; rows of which more than ``most`` of the words are hit
    go altogether. Other rows and columns are unchanged.
    """
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    found = scan(docs, items, window, text_col).where(hit <= F.col("n_words") * most)
    place, spans = found.columns.index(text_col), found.columns.index("hit_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            rows = zip(batch.column(place).to_pylist(), batch.column(spans).to_pylist(), strict=True)
            arrays = list(batch.columns)
            arrays[place] = pa.array([_without(t, s) if s else t for t, s in rows], pa.string())
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    cut = found.mapInArrow(run, found._jdf.schema().toDDL())
    return cut.select(*docs.columns)


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, items met and a hash of their ids."""
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return scan(docs.select("doc_id", "text"), items).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )
