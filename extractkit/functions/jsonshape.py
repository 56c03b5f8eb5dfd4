"""Whether a text is well-formed JSON, told from its structure alone, at any size and depth.

The reader behind ``parse_columns`` has limits (below); a text past one of them is null to it, as is a
text that isn't JSON. These expressions tell the two apart. The text is reduced step by step: escapes,
then strings, then numbers and words become one character each, white space goes, and what remains is brackets, commas
and those characters. Which of them may follow which is one pattern. Brackets are then removed from the inside out, while that
shortens the text; what is nested deeper is folded over once, run by run of brackets, with a text of the open ones as stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the JSON reader takes at most. Depth counts the array that seals a text.
MOST_DEPTH = 1_000
MOST_NUMBER = 1_000
MOST_NAME = 50_000
MOST_STRING = 20_000_000
MOST_BYTES = 128 << 20

#: Levels removed from the inside out before the fold.
_ROUNDS = 48
#: They go on while a round leaves at most this share of the text.
_LEFT = (15, 16)

_STRING, _VALUE, _KEY = "\x01", "\x02", "\x03"
_ESCAPE = r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})'
_QUOTED = r'"[^"\\\x00-\x1F]*+"'
_SCALAR = r"true|false|null|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+"
_RAW_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
# what must not stand at the start, after each kind of character, and at the end
_BEGIN = r"[^\x02{\[]"
_WRONG = (
    rf"^(?:{_BEGIN}|$)|\{{[^\x03}}]|\[[^\x02{{\[\]]|,[^\x03\x02{{\[]|\x03{_BEGIN}|[\x02}}\]][^,}}\]]|[{{\[,\x03]$"
)
#: Of two commas, or a comma and a bracket, side by side: not in the same kind of bracket.
_MIXED = r"ck|kc|\[[k}]|\{[c\]]|c\}|k\]"
_STACK = "struct<ok:boolean,open:string>"
_ROUND = "struct<rest:string,more:boolean>"


def _replaced(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _outline(text: Column) -> Column:
    """Brackets, commas, keys and values, one character each."""
    plain = _replaced(_replaced(text, _ESCAPE, "X"), _QUOTED, _STRING)
    bare = _replaced(_replaced(plain, _SCALAR, _VALUE), r"[ \t\n\r]++", "")
    return F.translate(_replaced(bare, _STRING + ":", _KEY), _STRING, _VALUE)


def _closed(outline: Column) -> Column:
    """Whether brackets pair up and commas stand where their kind of bracket wants them."""
    # a comma before a key belongs in an object (k), any other in an array (c)
    marks = F.translate(F.replace(outline, F.lit("," + _KEY), F.lit("k")), "," + _KEY + _VALUE, "c")

    def round_(s: Column, _: Column) -> Column:
        def judged(less: Column) -> Column:
            # a deep chain loses one level a round: the fold takes it at once
            more = (less != "") & (F.length(less) * _LEFT[1] <= F.length(s["rest"]) * _LEFT[0])
            return F.struct(less.alias("rest"), more.alias("more")).cast(_ROUND)

        return F.when(s["more"], _bound(_replaced(s["rest"], r"\{k*+\}|\[c*+\]", ""), judged)).otherwise(s)

    def step(s: Column, run: Column) -> Column:
        kind = F.substring(run, 1, 1)
        n = F.length(run)
        wanted = F.translate(F.reverse(run), "]}ck", "[{[{")
        fits = F.right(s["open"], n) == wanted
        left = F.when(kind.isin("c", "k"), s["open"]).otherwise(F.left(s["open"], F.length(s["open"]) - n))
        pushed = F.struct(s["ok"].alias("ok"), F.concat(s["open"], run).alias("open")).cast(_STACK)
        matched = F.struct(fits.alias("ok"), left.alias("open")).cast(_STACK)
        return F.when(~s["ok"], s).when(kind.isin("{", "["), pushed).otherwise(matched)

    start = F.struct(F.lit(True).alias("ok"), F.lit("").alias("open")).cast(_STACK)

    def settled(rest: Column) -> Column:
        # marks beside a bracket that holds them are judged there; what remains stands between two of its members
        bare = _replaced(_replaced(rest, r"(?<=[\[{])[ck]++|[ck]++(?=[\]}])", ""), r"(?<=[ck])[ck]++", "")
        runs = F.regexp_extract_all(bare, F.lit(r"[\[{]++|[\]}]++|[ck]"), F.lit(0))
        folded = F.aggregate(runs, start, step, lambda s: s["ok"] & (s["open"] == ""))
        return F.when(rest == "", True).when(rest.rlike(_MIXED), False).otherwise(folded)

    first = F.struct(marks.alias("rest"), F.lit(True).alias("more")).cast(_ROUND)
    rounds = F.array_repeat(F.lit(0), _ROUNDS)
    return _bound(F.aggregate(rounds, first, round_, lambda s: s["rest"]), settled)


def well_formed(text: Column) -> Column:
    """Whether the text is exactly one JSON value, however large or deep; null for null."""
    return F.when(
        ~text.rlike(_RAW_CONTROL), _bound(_outline(text), lambda o: F.when(~o.rlike(_WRONG), _closed(o)).otherwise(False))
    ).otherwise(text.isNull() & F.lit(None).cast("boolean"))


def may_exceed(text: Column) -> Column:
    """False where no limit of the reader can be the reason that it read nothing."""
    brackets = F.length(text) - F.length(F.translate(text, "[{", ""))
    large = (F.length(text) > MOST_NAME) | (brackets >= MOST_DEPTH - 1) | text.rlike(rf"[0-9.eE+\-]{{{MOST_NUMBER + 1}}}")
    return F.when(F.length(text) > MOST_NUMBER, large).otherwise(False)


def past_limits(text: Column, value: Column) -> Column:
    """Whether ``text``, parsed to ``value``, is JSON that the reader didn't take for its size or depth.

    The structure is looked at only where nothing was read and a limit can be the reason.
    """
    unread = text.isNotNull() & value.isNull()
    shape = F.when(may_exceed(text), well_formed(text)).otherwise(False)
    return F.when(unread, shape).otherwise(False)


def reading(text: Column, value: Column) -> Column:
    """What became of a text parsed to ``value``: json, past_limits, or not_json (null included)."""
    return F.when(value.isNotNull(), "json").when(past_limits(text, value), "past_limits").otherwise("not_json")
