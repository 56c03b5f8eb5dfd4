"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers cut the same bytes, a space and the text. Every token points to the farthest-right token
that overlaps it (itself included; of two that end together, the first tokenizer's). Doubling all
pointers at once, until none moves, leads each token to the last one of its group: groups part where a token of
each side ends. A link is a pair of tokens, one of each side, with a byte in common.

Neither tokenizer joins across a single space between visible characters, so texts are cut there, and
equal pieces, mostly words, are encoded and aligned once while they are cached. That the vocabularies allow it
is checked when they are loaded; else, and for a text with a piece whose tokens don't give its bytes back, whole
texts are encoded. Links are written as pairs of ids. Their counts over the corpus come from a second pass, and
each document's sums over its links from a third, which gets the counts in parts of at most ``PART`` id
pairs.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.tables import saved
from extractkit.llm.textscan import groups, release, released

#: Pieces and their characters kept by a task between groups of texts.
CACHED_PIECES, CACHED_CHARS = 200_000, 16_000_000
#: Longer pieces are the first to be forgotten.
LONGEST_KEPT = 64
#: New pieces encoded as one text.
JOINED = 512
#: Texts handed to a library in one call, whose result takes far more memory than the ids.
AT_ONCE = 16
#: Id pairs sent to the tasks at once: 16 bytes each.
PART = 2_000_000
#: Links counted at once.
COUNTED = 4_000_000
#: Bytes of texts or links that a task gets at once.
BATCH_BYTES = 8 << 20

#: Space between visible characters; white space of any kind next to it makes it no cut.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space but the space itself.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _byte_of() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves, the rest,
    in order, for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """First tokenizer: a byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of()
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [
            bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode() for name in names
        ]
        shape = json.loads(self.tokenizer.to_str())
        before = shape["pre_tokenizer"] or {}
        self.cuts = (
            shape["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", False)
            and not before.get("add_prefix_space", True)
            and all(t["special"] for t in shape["added_tokens"])
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), AT_ONCE):
            coded = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            out += [np.array(c.ids, dtype=np.int64) for c in coded]
        return out


class Pieces:
    """Second tokenizer: a sentencepiece model, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        # no piece goes on over a space that follows something else
        self.cuts = not any(re.search("[^▁]▁", name) for name in names)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """``texts`` begin with the space that the model adds."""
        out = []
        for at in range(0, len(texts), AT_ONCE):
            coded = self.model.encode([t[1:] for t in texts[at : at + AT_ONCE]], num_threads=1)
            out += [np.array(ids, dtype=np.int64) for ids in coded]
        return out


def successors(starts: tuple[np.ndarray, np.ndarray], ends: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Per token, those of the first side before those of the second, its farthest-right overlapping token."""
    n = len(starts[0])
    # the last token of the other side that starts before this one's end
    over = np.searchsorted(starts[1], ends[0], side="left") - 1
    under = np.searchsorted(starts[0], ends[1], side="left") - 1
    first = np.where(ends[1][over] > ends[0], n + over, np.arange(n))
    second = np.where(ends[0][under] >= ends[1], under, n + np.arange(len(starts[1])))
    return np.concatenate([first, second])


def jumped(pointer: np.ndarray) -> np.ndarray:
    """Where each pointer leads in the end: successor doubling until nothing moves."""
    while True:
        after = pointer[pointer]
        if np.array_equal(after, pointer):
            return pointer
        pointer = after


class Aligner:
    """Tokens, groups and links of pieces of text, kept by number. A piece is given without the space before it."""

    def __init__(self, first: str, second: str):
        self.sides = ByteLevel(first), Pieces(second)
        self.size = [np.array([len(b) for b in side.bytes], dtype=np.int64) for side in self.sides]
        self.cuts = all(side.cuts for side in self.sides)
        self.ids = max(map(len, self.size))
        # decimal ids with the sign that stands before them: none, comma, bar, semicolon
        self.decimal = [sign + str(i) for sign in ("", ",", "|", ";") for i in range(self.ids)]
        self.number: dict[str, int] = {}
        self.chars = 0
        # per piece: how often met; tokens of each side, groups, links; whether its tokens give its bytes
        self.met = np.empty(0, dtype=np.int64)
        self.counts = np.empty((0, 4), dtype=np.int64)
        self.right = np.empty(0, dtype=bool)
        self.shown: list[str] = []
        self.links = np.empty((0, 2), dtype=np.int32)

    def _same(self, side: int, ids: np.ndarray, data: bytes) -> bool:
        table = self.sides[side].bytes
        return int(self.size[side][ids].sum()) == len(data) and b"".join(map(table.__getitem__, ids.tolist())) == data

    def _encoded(self, pieces: list[str]) -> tuple[list[int], np.ndarray, list[np.ndarray], np.ndarray]:
        """The order in which pieces follow, the number of their tokens by side, all ids by side in that
        order, and which pieces' tokens give their bytes; the others have none."""
        plain, odd = [], []
        for i, piece in enumerate(pieces):
            regular = self.cuts and piece and not (piece[0].isspace() or piece[-1].isspace())
            (plain if regular else odd).append(i)
        runs = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        texts = ["".join([" " + pieces[i] for i in run]) for run in runs]
        coded = [side.encode(texts) for side in self.sides] if texts else [[], []]
        order, lengths, ids, right = [], [np.empty((0, 2), np.int64)], ([], []), []
        for k, run in enumerate(runs):
            data = texts[k].encode()
            ends = np.cumsum([1 + len(pieces[i].encode()) for i in run])
            numbers = []
            for side in (0, 1):
                token_ends = np.cumsum(self.size[side][coded[side][k]])
                if self._same(side, coded[side][k], data) and np.isin(ends, token_ends).all():
                    numbers.append(np.diff(np.searchsorted(token_ends, ends) + 1, prepend=0))
            if len(numbers) < 2:
                odd.extend(run)
                continue
            order += run
            lengths.append(np.stack(numbers, axis=1))
            right.append(np.ones(len(run), dtype=bool))
            for side in (0, 1):
                ids[side].append(coded[side][k])
        if odd:
            alone = [side.encode([" " + pieces[i] for i in odd]) for side in self.sides]
            for i, *both in zip(odd, *alone, strict=True):
                data = (" " + pieces[i]).encode()
                good = all(self._same(side, both[side], data) for side in (0, 1))
                order.append(i)
                lengths.append(np.array([[len(x) if good else 0 for x in both]], dtype=np.int64))
                right.append(np.array([good]))
                for side in (0, 1):
                    ids[side].extend(both[side : side + 1] if good else [])
        none = np.empty(0, dtype=np.int64)
        return (
            order,
            np.concatenate(lengths),
            [np.concatenate([none, *x]) for x in ids],
            np.concatenate([none.astype(bool), *right]),
        )

    def align(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray, list[str], np.ndarray]:
        """The order in which pieces follow; then counts, right and group text of each, and all links in turn."""
        place, lengths, ids, right = self._encoded(pieces)
        ends = [np.cumsum(self.size[side][ids[side]]) for side in (0, 1)]
        starts = [e - self.size[side][i] for side, (e, i) in enumerate(zip(ends, ids, strict=True))]
        n, m = map(len, ids)
        if not n:
            return place, np.zeros((len(pieces), 4), np.int64), right, [""] * len(pieces), self.links[:0]
        terminal = jumped(successors(tuple(starts), tuple(ends)))
        # a group's last token of the first side names it, so groups are in order of place
        leaders = np.flatnonzero(np.bincount(terminal, minlength=n))
        named = np.zeros(n, dtype=np.int64)
        named[leaders] = np.arange(len(leaders))
        group = named[terminal]
        owner = [np.repeat(np.arange(len(pieces)), lengths[:, side]) for side in (0, 1)]
        # links: one for each stretch between ends of either side
        cuts = np.sort(np.concatenate(ends), kind="stable")
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        first, second = (np.searchsorted(e, cuts, side="left") for e in ends)
        links = np.stack([ids[0][first], ids[1][second]], axis=1).astype(np.int32)
        counts = np.stack(
            [
                lengths[:, 0],
                lengths[:, 1],
                np.bincount(owner[0][leaders], minlength=len(pieces)),
                np.bincount(owner[0][first], minlength=len(pieces)),
            ],
            axis=1,
        )
        # a1,a2|b1;a3|b2: both sides are in order of group already, so this is a merge
        side = np.repeat([0, 1], [n, m])
        order = np.argsort(2 * group + side, kind="stable")
        changed = [np.diff(x[order], prepend=-1) != 0 for x in (np.concatenate(owner), group, side)]
        sign = np.select(changed, [0, 3, 2], default=1)
        parts = list(map(self.decimal.__getitem__, (sign * self.ids + np.concatenate(ids)[order]).tolist()))
        bounds = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))]).tolist()
        shown = ["".join(parts[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        return place, counts, right, shown, links

    def _forget(self) -> None:
        """Keep the half of the pieces that were met most often."""
        names = list(self.number)
        short = np.fromiter(map(len, names), np.int64, len(names)) <= LONGEST_KEPT
        worth = np.where(short, self.met, -1)
        kept = np.sort(np.argsort(-worth, kind="stable")[: min(CACHED_PIECES // 2, int(short.sum()))])
        self.number = {names[i]: new for new, i in enumerate(kept.tolist())}
        self.chars = sum(map(len, self.number))
        first = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
        self.links = self.links[_ranges(first[kept], self.counts[kept, 3])]
        self.met, self.counts, self.right = self.met[kept] // 2, self.counts[kept], self.right[kept]
        self.shown = [self.shown[i] for i in kept.tolist()]

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct pieces; new ones are aligned and kept."""
        if len(self.number) > CACHED_PIECES or self.chars > CACHED_CHARS:
            self._forget()
        new = [p for p in pieces if p not in self.number]
        if new:
            order, counts, right, shown, links = self.align(new)
            self.number.update(zip([new[i] for i in order], range(len(self.number), len(self.number) + len(new)), strict=True))
            self.met = np.concatenate([self.met, np.zeros(len(new), dtype=np.int64)])
            self.counts = np.concatenate([self.counts, counts])
            self.right = np.concatenate([self.right, right])
            self.shown += shown
            self.links = np.concatenate([self.links, links])
            self.chars += sum(map(len, new))
        return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[tuple[int, ...], str, np.ndarray]]:
        """Per text: (n_a, n_b, n_groups, n_links), the groups' text, and its links."""
        for first, last in groups(texts := [t or "" for t in texts]):
            some = texts[first:last]
            odd = {i: _pieces(t) if self.cuts else [t] if t else [] for i, t in enumerate(some) if not self.cuts or _odd(t)}
            cut = pc.split_pattern(pa.array(["" if i in odd else t for i, t in enumerate(some)], pa.string()), " ")
            coded = cut.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            others = sorted({p for pieces in odd.values() for p in pieces}.difference(distinct))
            known = self._numbers(distinct + others)
            number = known[coded.indices.to_numpy()]
            place = dict(zip(distinct + others, known.tolist(), strict=True)) if odd else {}
            self.met += np.bincount(number, minlength=len(self.met))
            begins = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
            bounds = cut.offsets.to_pylist()
            for i, text in enumerate(some):
                at = np.array([place[p] for p in odd[i]], dtype=np.int64) if i in odd else number[bounds[i] : bounds[i + 1]]
                if not self.right[at].all():
                    # a piece alone may fail where the text as a whole does not
                    _, counts, right, shown, links = self.align([text])
                    yield (tuple(counts[0].tolist()), shown[0], links) if right[0] else ((0, 0, 0, 0), "", links[:0])
                    continue
                counts = self.counts[at]
                shown = ";".join(map(self.shown.__getitem__, at.tolist()))
                yield tuple(counts.sum(axis=0).tolist()), shown, self.links[_ranges(begins[at], counts[:, 3])]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    total = np.cumsum(sizes)
    every = int(total[-1]) if len(total) else 0
    return np.arange(every) + np.repeat(starts - (total - sizes), sizes)


def _odd(text: str) -> bool:
    """Whether the text is empty or has white space at an end, or a space next to other white space."""
    if not text or "  " in text or text[0].isspace() or text[-1].isspace():
        return True
    return any(c in text and (" " + c in text or c + " " in text) for c in _OTHER_SPACE)


def _pieces(text: str) -> list[str]:
    """Pieces of a text, each without the space before it."""
    if not text:
        return []
    first, *rest = _CUT.split(" " + text)
    return [first[1:], *rest]


def _codes(links: np.ndarray) -> np.ndarray:
    """One number for each pair of ids."""
    return (links[:, 0] << 32) | links[:, 1]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row, n_a, n_b, n_groups, n_links, groups (text), links (binary: 32-bit ids, pair by pair).

    ``first`` and ``second`` are the vocabulary files, which every node must have. Null and empty texts, and texts
    whose tokens don't give back their bytes, have no tokens. Repeated rows give one row each, null
    ids stay, an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "row", *_NUMBERS, "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first, second)
        for batch in released(batches):
            # only the texts of one group are Python strings at a time; a range is as long as its text
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for begin, end in groups([range(size) for size in sizes]):
                texts = batch.column(2).slice(begin, end - begin).to_pylist()
                counts, shown, links = zip(*aligner.documents(texts), strict=True)
                columns = [
                    batch.column(0).slice(begin, end - begin),
                    batch.column(1).slice(begin, end - begin),
                    *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True)),
                    pa.array(shown, pa.large_string()).cast(pa.string()),
                    pa.array([pair.astype("<i4").tobytes() for pair in links], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        del aligner
        release()

    shape = f"`{id_col}` {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"
    numbered = docs.select(id_col, F.monotonically_increasing_id().alias("row"), text_col)
    return numbered.mapInArrow(run, shape)


def _decoded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all links of a batch and the number of links of each row."""
    column = column.cast(pa.binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    pairs = np.frombuffer(raw.tobytes(), dtype="<i4").reshape(-1, 2).astype(np.int64)
    return _codes(pairs), np.diff(bounds) // 8


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, n, best: how many links of all documents hold each pair of ids; whether none of b's has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged():
            new, n = np.unique(np.concatenate([np.empty(0, np.int64), *waiting]), return_counts=True)
            both, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            total = np.bincount(place, np.concatenate([counts, n]), minlength=len(both))
            return both, total.astype(np.int64)

        def out():
            columns = [pa.array(codes >> 32), pa.array(codes & 0xFFFFFFFF), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "n"])

        for batch in released(batches):
            for at in range(0, batch.num_rows, 256):
                part, _ = _decoded(batch.column(0).slice(at, 256))
                waiting.append(part)
                held += len(part)
                if held > COUNTED:
                    codes, counts = merged()
                    waiting, held = [], 0
                    if len(codes) > COUNTED:
                        yield out()
                        codes, counts = codes[:0], counts[:0]
        codes, counts = merged()
        waiting = []
        yield out()
        del codes, counts
        release()

    parts = links.select("links").mapInArrow(run, "a long, b long, n long")
    summed = saved(parts.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs", batch=BATCH_BYTES)
    highest = summed.groupBy("b").agg(F.max("n").alias("highest"))
    return summed.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_sums(links: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best, count_sum: over each row's links, how many are their b id's best, and the sum of counts."""
    counts = saved(counts, "counts")
    parts = max(1, -(-counts.count() // PART))
    dealt = counts.withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(parts)))
    total = None
    for part in range(parts):
        known = dealt.where(F.col("part") == part).select("a", "b", "n", "best").toArrow()
        a, b, n, best = (c.to_numpy() for c in known.columns)
        codes = (a << 32) | b
        order = np.argsort(codes)
        shared = links.sparkSession.sparkContext.broadcast((codes[order], np.where(best, n, -n)[order]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            codes, numbers = shared.value
            for batch in released(batches):
                sums = []
                for at in range(0, batch.num_rows, 256):
                    asked, sizes = _decoded(batch.column(1).slice(at, 256))
                    found = np.zeros(len(asked), dtype=np.int64)
                    if len(codes):
                        place = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
                        found = np.where(codes[place] == asked, numbers[place], 0)
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    for values in ((found > 0).astype(np.int64), np.abs(found)):
                        running = np.concatenate([[0], np.cumsum(values)])
                        sums.append(running[ends[1:]] - running[ends[:-1]])
                none = np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.concatenate([none, *sums[::2]])),
                        pa.array(np.concatenate([none, *sums[1::2]])),
                    ],
                    ["row", "n_best", "count_sum"],
                )

        one = links.select("row", "links").mapInArrow(run, "row long, n_best long, count_sum long")
        total = one if total is None else total.unionByName(one)
    if parts == 1:
        return total
    return total.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def digest(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The contract's columns: counts, the hash of the groups' text, sums over links."""
    digested = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    made = aligned(docs, first, second).withColumn("groups_sha256", digested).drop("groups")
    links = saved(made, "links", "zstd", BATCH_BYTES)
    sums = saved(link_sums(links, pair_counts(links)), "sums", batch=BATCH_BYTES)
    return links.drop("links").join(sums, "row").select(
        "doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"
    )
