"""Words of many texts at once: byte scans and 64-bit hashes in numpy.

Texts are UTF-8 bytes, so a word class given by ASCII characters is a table over the 256 byte
values; bytes above 0x7F belong to no ASCII delimiter and stay inside words. Work goes block by
block, so that memory does not follow the length of a text by more than its own bytes.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
GROUP_BYTES = 2 << 20
#: Longer words are hashed on their own.
BLOCK = 1 << 20

SPACES = b" \t\n\x0b\x0c\r"


def release() -> None:
    """Give freed memory back: workers live on between tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not the GNU C library


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after each, what was freed while it was worked on goes back."""
    for batch in batches:
        yield batch
        del batch
        release()


_STEPS = [np.uint64(k) for k in (30, 0xBF58476D1CE4E5B9, 27, 0x94D049BB133111EB, 31)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of the public splitmix64 generator."""
    h = h ^ (h >> _STEPS[0])
    h *= _STEPS[1]
    h ^= h >> _STEPS[2]
    h *= _STEPS[3]
    h ^= h >> _STEPS[4]
    return h


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers made from a seed."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


#: Tables made once per worker task.
_MADE: dict = {}


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "powers" in _MADE:
        return _MADE["powers"]
    base = int(constants(11, 1)[0])
    up = np.full(BLOCK + 1, base, dtype=np.uint64)
    down = np.full(BLOCK + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    _MADE["powers"] = (
        constants(7, 256),
        np.cumprod(up, dtype=np.uint64),
        np.cumprod(down, dtype=np.uint64),
    )
    return _MADE["powers"]


def word_class(outside: bytes) -> np.ndarray:
    """Table over byte values: True for bytes of words."""
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


def groups(texts: list[bytes], most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` bytes together, at least one text each."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        if i > first and total + len(text) > most:
            yield first, i
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def word_bounds(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, ...]:
    """The joined bytes, and start, end and text number of each word."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = table[joined]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    last = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    return joined, starts, ends, np.searchsorted(last, starts, side="right")


def word_hashes(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over random values of its bytes."""
    values, up, down = _powers()
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + BLOCK, side="right"))
        if j <= i:
            word = joined[base : ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            i += 1
            continue
        size = int(ends[j - 1] - base)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[joined[base : base + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


def lowered(texts: list[str | None]) -> list[bytes]:
    """UTF-8 with A-Z lower-cased; null is empty."""
    return [b"" if t is None else t.encode().lower() for t in texts]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def shingles(texts: list[bytes], words: int, table: np.ndarray) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words``-word shingles.

    A text of fewer words has its whole sequence as the one shingle; without words it has none.
    """
    out: list[np.ndarray] = []
    factors = constants(23, words)
    for a, b in groups(texts):
        joined, starts, ends, row = word_bounds(texts[a:b], table)
        hashes = word_hashes(joined, starts, ends)
        bounds = np.searchsorted(row, np.arange(b - a + 1))
        n = max(0, len(hashes) - words + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(words):
            rolled += hashes[k : k + n] * factors[k]
        rolled = mix(rolled)
        for k in range(b - a):
            i, j = bounds[k], bounds[k + 1]
            if j - i >= words:
                out.append(distinct(rolled[i : j - words + 1]))
            elif j > i:
                short = (hashes[i:j] * factors[: j - i]).sum(dtype=np.uint64)
                out.append(mix(np.array([short + np.uint64(j - i)], dtype=np.uint64)))
            else:
                out.append(np.empty(0, dtype=np.uint64))
    return out
