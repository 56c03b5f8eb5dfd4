"""Secret scan: keyword automaton, anchored expressions near hits, embedded checksums.

One pass of an Aho-Corasick automaton over the whole text finds the keywords; expressions are tried
only where a keyword starts, from left to right. Hex runs have no keyword and are found by their own
expression. Kinds, in the order used for spans that start together:

- assign, access, hex: an assigned password, token or key; a cloud access key; 32 or more hex digits
- repo, package: tokens of code hosts and package registries whose last six characters are the CRC-32
  of the thirty before, in base 62
- jwt: a signed token whose header decodes to JSON that names its algorithm

Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keywords, expressions and lengths of the kinds of secrets.
KINDS = ("assign", "access", "hex", "repo", "package", "jwt")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KEYWORDS = {word: "assign" for word in ASSIGN_WORDS} | {
    "akia": "access",
    "ghp_": "repo",
    "gho_": "repo",
    "ghu_": "repo",
    "ghs_": "repo",
    "ghr_": "repo",
    "npm_": "package",
    "eyj": "jwt",
}
EITHER_CASE = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ASSIGN_WORDS
)
ASSIGN = rf"""(?:{EITHER_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
REPO = r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
PACKAGE = r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
JWT = r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of an ASCII text as six base-62 digits."""
    rest, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = BASE62[digit] + digits
    return digits


def _signed(found: re.Match) -> bool:
    return checksum62(found[1]) == found[2]


def _header(found: re.Match) -> bool:
    part = found[1]
    try:
        header = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def scanner():
    """A function from a text to its spans (start, kind number, end), sorted."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    hexes = re.compile(HEX)
    tests = {
        "assign": (re.compile(ASSIGN), lambda m: len(m[1]) >= 8),
        "access": (re.compile(ACCESS), lambda m: len(m[0]) >= 16),
        "repo": (re.compile(REPO), _signed),
        "package": (re.compile(PACKAGE), _signed),
        "jwt": (re.compile(JWT), _header),
    }

    def spans(text: str) -> list[tuple[int, int, int]]:
        found = [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
        # bytes.lower() changes A-Z alone, so offsets stay
        small = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        starts: dict[str, list[int]] = {}
        for last, (length, kind) in automaton.iter(small):
            starts.setdefault(kind, []).append(last - length + 1)
        for kind, at in starts.items():
            expression, valid = tests[kind]
            free = 0
            for start in sorted(at):
                if start >= free and (m := expression.match(text, start)):
                    free = m.end()
                    if valid(m):
                        found.append((start, KINDS.index(kind), free))
        return sorted(found)

    return spans


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text_col: str = "text", redact: str | None = None) -> DataFrame:
    """``docs`` with columns secret_kinds array<string>, secret_spans string, base_spans string.

    Spans read kind:start:end, comma-joined, by start and then kind; base_spans has those of the
    first three kinds. With ``redact`` the text is returned with each span replaced by it, spans that
    overlap by one mark together. A null text has no spans and stays null; an empty table gives an
    empty result. Columns of these three names in ``docs`` are replaced.
    """
    added = ["secret_kinds", "secret_spans", "base_spans"]
    kept = docs.drop(*added)
    names = kept.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_of = scanner()
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = [spans_of(t) if t else [] for t in texts]
            columns = [
                pa.array([[KINDS[k] for _, k, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([_shown(f) for f in found], pa.string()),
                pa.array([_shown([s for s in f if s[1] < 3]) for f in found], pa.string()),
            ]
            arrays = list(batch.columns)
            if redact is not None:
                clean = [t and _redacted(t, f, redact) for t, f in zip(texts, found, strict=True)]
                arrays[place] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(arrays + columns, [*names, *added])

    shape = f"{kept._jdf.schema().toDDL()}, secret_kinds array<string>, secret_spans string, base_spans string"
    return kept.mapInArrow(run, shape)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a hash of their spans, all spans."""
    found = scan(docs.select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("secret_kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2("base_spans", 256).alias("base_sha256"),
        F.col("secret_spans").alias("spans"),
    )
