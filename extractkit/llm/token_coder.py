"""Adaptive context-mixing range coder for blocks of token ids.

A chunk of ids is cut into blocks of ``BLOCK``; every block has its own model, coder and checksum, so
each can be read alone, with the chunk's table of shares. Up to ``LANES`` blocks of a chunk are coded in step
with each other, one id of each at a time, as numpy vectors; the models of more would not stay in a core's cache.

For each id, in its block:

- The order-2 and order-1 models remember the id that last followed the last two ids, and the last
  one, with a count of how often that held.
- The order-0 model has the share of each id in the chunk, which is written before the blocks.
- The probability of an id is a mixture of the three: ``a`` for the order-2 id, ``(1 - a) * b`` for the
  order-1 id and the rest for the order-0 model. The weights ``a`` and ``b`` are learnt on the way, for each
  pair of counts and for whether the two models agree.

An id is one step of the coder. Places and sizes are whole numbers below 2 ** 53 in float64, where sums, products
and roundings give the same everywhere, so that reading follows writing exactly. Ranges have 48 bits; words of
16 bits are put out, with carries added at the end.

Ids are below 65,536.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids in a block; slots of the order-1 and order-2 models.
BLOCK, SLOTS = 1024, 512
#: Blocks coded together.
LANES = 3072
MAGIC = b"IDC2"
ONE = 1 << 16
#: Sum of the shares of the order-0 model.
SHARES = 1 << 18
#: Counts of the order-1 and order-2 models end here.
MOST = 3
#: Weights move to these, by ``RATE`` of the way.
NEVER, ALWAYS, RATE = 1 / 1024, 127 / 128, 1 / 16
#: Weights at the start, by count.
_START = np.array([0.04, 0.3, 0.5, 0.7])
# the next count by the former one plus 1, where the id was the one told; else it falls outside
_AFTER = np.array([0, *np.minimum(np.arange(MOST + 1) + 1, MOST), 0])
# cells of models that agree come after the others: both numbers differ in the count alone
_AGREE = np.array([16] * 4 + [0])
_SECOND = np.array([1, 2])
# by model that had the id: what a weight keeps and where it moves
_MOVE2 = RATE * np.array([ALWAYS, NEVER, NEVER])
_KEEP1, _MOVE1 = np.array([1, 1 - RATE, 1 - RATE]), RATE * np.array([0, ALWAYS, NEVER])
_LEAST, _TOP = float(1 << 32), float(1 << 48)


class _Shares:
    """The order-0 model: share of each id, those before it, and the id of each place."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.given = ids, size
        self.size, self.first = np.ones(ONE), np.zeros(ONE)
        self.size[ids] = size
        self.first[ids] = np.cumsum(size) - size
        self.at = np.repeat(ids, size).astype(np.uint16)

    @classmethod
    def of(cls, ids: np.ndarray) -> _Shares:
        counts = np.bincount(ids, minlength=1)
        met = np.flatnonzero(counts)
        size = 1 + counts[met] * (SHARES - len(met)) // len(ids)
        size[np.argmax(size)] += SHARES - size.sum()
        return cls(met, size)

    def packed(self) -> bytes:
        gaps = np.diff(self.ids, prepend=0).astype("<u2").tobytes()
        return zlib.compress(gaps + self.given.astype("<u4").tobytes())

    @classmethod
    def unpacked(cls, data: bytes) -> _Shares:
        try:
            raw = zlib.decompress(data)
        except zlib.error as wrong:
            raise ValueError("damaged table of shares") from wrong
        n = len(raw) // 6
        ids = np.cumsum(np.frombuffer(raw, "<u2", n).astype(np.int64))
        size = np.frombuffer(raw, "<u4", n, 2 * n).astype(np.int64)
        if len(raw) % 6 or size.sum() != SHARES or ids[-1] >= ONE:
            raise ValueError("damaged table of shares")
        return cls(ids, size)


class _Writer:
    """Puts out words of each block; a word may hold a carry until the end."""

    def __init__(self, lanes: int, most: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, _TOP)
        self.width = 2 * most + 4
        self.words = np.zeros(lanes * self.width, dtype=np.int32)
        self.begin = np.arange(lanes) * self.width
        self.next = self.begin.copy()

    def take(self, n: int, lo: np.ndarray, size: np.ndarray) -> None:
        self.low[:n] += lo
        self.range[:n] = size
        due = np.flatnonzero(size < _LEAST)
        while len(due):
            size = self.range.take(due) * ONE
            self.range[due] = size
            self._shift(due)
            due = due[size < _LEAST]

    def _shift(self, due: np.ndarray) -> None:
        """The top words of these blocks go out."""
        low, at = self.low.take(due), self.next.take(due)
        word = np.floor(low * (1 / _LEAST))
        self.words[at] = word.astype(np.int32)
        self.next[due] = at + 1
        self.low[due] = (low - word * _LEAST) * ONE

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all blocks, block after block, and their number per block."""
        n = len(self.low)
        for _ in range(3):
            self._shift(np.arange(n))
        lengths = self.next - self.begin
        words = self.words.reshape(n, -1)[np.arange(self.width) < lengths[:, None]]
        while len(over := np.flatnonzero(words >= ONE)):
            words[over - 1] += words[over] >> 16
            words[over] &= ONE - 1
        return words, lengths


class _Reader:
    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.words = words.astype(np.float64)
        first = np.cumsum(lengths) - lengths
        #: Distance of the code from the low end of the range.
        self.code = sum(self.words[first + k] * 2.0 ** (32 - 16 * k) for k in range(3))
        self.range = np.full(len(lengths), _TOP)
        self.next = first + 3

    def take(self, n: int, lo: np.ndarray, size: np.ndarray) -> None:
        self.code[:n] -= lo
        self.range[:n] = size
        due = np.flatnonzero(size < _LEAST)
        while len(due):
            size = self.range.take(due) * ONE
            self.range[due] = size
            at = self.next.take(due)
            self.code[due] = self.code.take(due) * ONE + self.words.take(at, mode="clip")
            self.next[due] = at + 1
            due = due[size < _LEAST]


def _run(coder: _Writer | _Reader, shares: _Shares, counts: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Code ids (a row for each place in a block), or read them; counts of ids per block must not increase."""
    lanes, steps = len(counts), int(counts.max(initial=0))
    out = np.zeros((steps, lanes), dtype=np.uint16) if ids is None else ids
    # the id that followed last and its count, in one number
    told1, told2 = (np.zeros(lanes * SLOTS, dtype=np.int32) for _ in range(2))
    kinds = 2 * len(_START) ** 2
    weight2 = np.tile(np.repeat(_START, len(_START)), 2 * lanes)
    weight1 = np.tile(_START, 2 * lanes * len(_START))
    slots, cells = np.arange(lanes) * SLOTS, np.arange(lanes) * kinds
    # which model had the id: order 2, 1 or 0, each with its row
    rows = np.arange(lanes)
    lows, sizes, told = np.zeros((3, lanes)), np.zeros((3, lanes)), np.zeros((3, lanes), dtype=np.int64)
    now = before = np.zeros(lanes, dtype=np.int64)
    here = np.searchsorted(-counts, -np.arange(steps)).tolist()
    for t, n in enumerate(here):
        if n < len(rows):
            rows, slots, cells, now, before = rows[:n], slots[:n], cells[:n], now[:n], before[:n]
            lows, sizes, told = (np.zeros((3, n), dtype=x.dtype) for x in (lows, sizes, told))
        slot1 = now * 40503
        slot2 = slot1 + before
        before = now * 60493
        slot1 >>= 4
        slot1 &= SLOTS - 1
        slot1 += slots
        slot2 >>= 5
        slot2 &= SLOTS - 1
        slot2 += slots
        was1, was2 = told1.take(slot1).astype(np.int64), told2.take(slot2).astype(np.int64)
        # cell by count of order 2, count of order 1, and whether both name the same id
        cell = was2 & 3
        cell <<= 2
        cell |= was1 & 3
        cell += cells
        cell += _AGREE.take(was1 ^ was2, mode="clip")
        a, b = weight2.take(cell), weight1.take(cell)
        size = coder.range[:n]
        two = np.floor(size * a, out=sizes[0])
        lows[1] = two
        one = size - two
        one *= b
        one = np.floor(one, out=sizes[1])
        ends = np.add(two, one, out=lows[2])
        unit = size - ends
        unit *= 1 / SHARES
        np.floor(unit, out=unit)
        np.right_shift(was2, 2, out=told[0])
        np.right_shift(was1, 2, out=told[1])
        if ids is None:
            code = coder.code[:n]
            model = (code >= two).astype(np.int64)
            model += code >= ends
            place = code - ends
            place /= unit
            told[2] = other = shares.at.take(place.astype(np.int64), mode="clip")
            at = model * n
            at += rows
            now = told.take(at)
            out[t, :n] = now
        else:
            now = ids[t, :n].astype(np.int64)
            other = now
            model = (now != told[0]).astype(np.int64)
            model *= _SECOND.take((now != told[1]).view(np.int8))
            at = model * n
            at += rows
        np.multiply(unit, shares.size.take(other), out=sizes[2])
        unit *= shares.first.take(other)
        lows[2] += unit
        coder.take(n, lows.take(at), sizes.take(at))
        a *= 1 - RATE
        a += _MOVE2.take(model)
        weight2[cell] = a
        b *= _KEEP1.take(model)
        b += _MOVE1.take(model)
        weight1[cell] = b
        base = now * 4
        was1 -= base
        was1 += 1
        told1[slot1] = (base + _AFTER.take(was1, mode="clip")).astype(np.int32)
        was2 -= base
        was2 += 1
        told2[slot2] = (base + _AFTER.take(was2, mode="clip")).astype(np.int32)
    return out


def _lanes(blocks: int) -> list[tuple[int, int]]:
    """Ranges of blocks that are coded together, about even."""
    cuts = np.linspace(0, blocks, -(-blocks // LANES) + 1).astype(np.int64).tolist()
    return list(zip(cuts, cuts[1:], strict=False))


def _checks(ids: np.ndarray) -> list[int]:
    raw = ids.astype("<u4").tobytes()
    return [zlib.crc32(raw[i : i + 4 * BLOCK]) for i in range(0, len(raw), 4 * BLOCK)]


def encode(ids: np.ndarray) -> bytes:
    """One chunk: magic, ids, blocks, per block words and checksum, the order-0 model, then the words."""
    n = len(ids)
    if n and int(ids.max()) >= ONE:
        raise ValueError("ids must be below 65536")
    blocks = -(-n // BLOCK)
    counts = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    table, coded = b"", [(np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64))]
    if blocks:
        shares = _Shares.of(ids)
        table = shares.packed()
        places = np.zeros(blocks * BLOCK, dtype=np.uint16)
        places[:n] = ids
        places = places.reshape(blocks, BLOCK)
        for a, b in _lanes(blocks):
            writer = _Writer(b - a, int(counts[a]))
            _run(writer, shares, counts[a:b], np.ascontiguousarray(places[a:b, : counts[a]].T))
            coded.append(writer.finish())
    words, lengths = map(np.concatenate, zip(*coded, strict=True))
    return b"".join(
        [
            struct.pack("<4sQII", MAGIC, n, blocks, len(table)),
            lengths.astype("<u4").tobytes(),
            np.array(_checks(ids), dtype="<u4").tobytes(),
            table,
            words.astype("<u2").tobytes(),
        ]
    )


def decode(chunk: bytes) -> np.ndarray:
    """The ids of a chunk; ValueError if it is damaged."""
    if len(chunk) < 20 or chunk[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    _, n, blocks, size = struct.unpack_from("<4sQII", chunk)
    begin = 20 + 8 * blocks + size
    if blocks != -(-n // BLOCK) or len(chunk) < begin or (len(chunk) - begin) % 2:
        raise ValueError("damaged chunk header")
    lengths = np.frombuffer(chunk, "<u4", blocks, 20).astype(np.int64)
    checks = np.frombuffer(chunk, "<u4", blocks, 20 + 4 * blocks)
    words = np.frombuffer(chunk, "<u2", -1, begin) if len(chunk) > begin else np.empty(0, dtype=np.uint16)
    if lengths.sum() != len(words) or (lengths < 3).any():
        raise ValueError("damaged chunk table")
    if not blocks:
        return np.empty(0, dtype=np.uint32)
    counts = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    shares = _Shares.unpacked(chunk[begin - size : begin])
    first = np.concatenate([[0], np.cumsum(lengths)])
    parts = []
    with np.errstate(all="ignore"):  # a damaged block may lead anywhere, and fails its checksum
        for a, b in _lanes(blocks):
            reader = _Reader(words[first[a] : first[b]], lengths[a:b])
            parts.append(_run(reader, shares, counts[a:b], None).T.ravel())
    ids = np.concatenate(parts)[:n].astype(np.uint32)
    wrong = np.flatnonzero(np.array(_checks(ids), dtype=np.uint32) != checks)
    if len(wrong):
        raise ValueError(f"checksum of block {wrong[0]} differs")
    return ids
