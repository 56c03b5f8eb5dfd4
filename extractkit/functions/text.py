"""Text expressions: strip, blank test, and the two ways of cutting a JSON block out of text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(texts: Iterable[str]) -> Column:
    """A constant array, written as one SQL literal: far quicker to build than a column per text."""
    return F.expr(f"array({', '.join(map(sql_literal, texts))})")


def contains_any(column: str, phrases: Iterable[str]) -> Column:
    """Whether any of the phrases occurs in the named column; stops at the first."""
    return F.expr(" or ".join(f"contains(`{column}`, {sql_literal(p)})" for p in phrases))


def strip_text(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(F.ltrim(text, F.lit(WHITESPACE)) == "", F.lit(True))


def strip_line(text: Column) -> Column:
    """``strip_text`` for JSONL: a line that starts and ends in braces is known to be stripped."""
    return F.when(text.startswith("{") & text.endswith("}"), text).otherwise(strip_text(text))


def json_block_greedy(text: Column) -> Column:
    """First ``{`` through the last ``}``; empty when there is no such span."""
    start = F.instr(text, "{")
    end = F.length(text) - F.length(F.substring_index(text, "}", -1))
    return F.when((start > 0) & (end >= start), F.substring(text, start, end - start + 1)).otherwise("")


def json_block_balanced(text: Column) -> Column:
    """First ``{`` to where the brace depth is back at zero; empty if it never is.

    Braces inside string literals count too. The fold steps from brace to brace, not from
    character to character.
    """
    tail = F.substring(text, F.instr(text, "{"), F.length(text))
    pieces = F.regexp_extract_all(tail, F.lit(r"[{}][^{}]*"), F.lit(0))
    begin = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("closed"))

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(piece.startswith("{"), 1).otherwise(-1)
        closes = depth == 0
        moved = F.struct(
            depth.alias("depth"),
            (acc["size"] + F.when(closes, 1).otherwise(F.length(piece))).alias("size"),
            closes.alias("closed"),
        )
        return F.when(acc["closed"], acc).otherwise(moved)

    def finish(acc: Column) -> Column:
        return F.when(acc["closed"], acc["size"]).otherwise(0)

    size = F.aggregate(pieces, begin, step, finish)
    return F.when(F.instr(text, "{") > 0, F.substring(text, F.instr(text, "{"), size)).otherwise("")
