"""Repeatable random draws from md5 of (seed, key, stream).

One md5 gives four 8-digit hex words, so ten draws cost three digests. The draws depend on the
row's key only: any partitioning, retry or engine with md5 gives the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS_PER_DIGEST = 4
_WORD_RANGE = 2**32


def digest(key: Column, seed: int, stream: str) -> Column:
    """32 hex digits for this seed, key and stream name."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(f":{stream}")))


def word(hex_digest: Column, slot: int) -> Column:
    """Word 0-3 of a digest, still as hex text."""
    return F.substring(hex_digest, 8 * slot + 1, 8)


def word_threshold(p: float) -> str:
    """Hex text t with ``word < t`` exactly when the word, as a fraction of 2^32, is below p."""
    return format(math.ceil(p * _WORD_RANGE), "08x")


def bernoulli(hex_word: Column, p: float) -> Column:
    """True with probability p. Fixed-width hex compares like the number, so no conversion."""
    if p <= 0.0:
        return F.lit(False)
    if p >= 1.0:
        return F.lit(True)
    return hex_word < F.lit(word_threshold(p))


def word_value(hex_word: Column) -> Column:
    """The word as BIGINT."""
    return F.conv(hex_word, 16, 10).cast("bigint")


def pick_index(hex_word: Column, n: int) -> Column:
    """0-based index, every one of n equally likely."""
    return F.pmod(word_value(hex_word), F.lit(n).cast("bigint"))
