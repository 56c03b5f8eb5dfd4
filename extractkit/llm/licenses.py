"""License scan: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Words are runs of letters and digits, A-Z lower-cased. A fingerprint is ``GRAM`` consecutive words; of
each window of ``WINDOW`` of a template's fingerprints the one with the least hash is indexed. Both are
less for a template where they would exceed the run of equal words that is left when as many of its words
as the coverage allows are other ones or missing, so each such text has a hit. Every run of words of
a text is looked up. Each hit that no match of its template covers is a candidate: text and template are
aligned from it to both sides within a band: 1 for equal words, -1 for unequal, missing and extra ones.

The templates are given on the driver and few; the index is broadcast with the function.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from extractkit.llm.decontaminate import WORD, words_of

GRAM, WINDOW, BAND = 3, 3, 8

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version"
    ),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction"
    ),
}


def index_of(templates: dict[str, list[bytes]], least: float = 0.8) -> dict[tuple, list[tuple[str, int]]]:
    """Indexed fingerprints: the words, and the templates and places they stand at."""
    index: dict[tuple, list[tuple[str, int]]] = {}
    for name, words in templates.items():
        if len(words) < GRAM:
            continue
        equal = min(len(words), max(1, math.ceil(least * len(words))))
        run = -(-equal // (len(words) - equal + 1))
        size = min(GRAM, run)
        wide = min(WINDOW, run - size + 1)
        grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        hashes = [zlib.crc32(b" ".join(g)) for g in grams]
        chosen = set()
        for i in range(max(1, len(grams) - wide + 1)):
            window = range(i, min(i + wide, len(grams)))
            chosen.add(min(window, key=lambda k: (hashes[k], -k)))
        for i in sorted(chosen):
            index.setdefault(grams[i], []).append((name, i))
    return index


def extend(template: list[bytes], words: list[bytes]) -> tuple[int, int]:
    """Best alignment of openings of both, within the band: equal words, and words of the text used."""
    best, best_key = (0, 0), (0, 0)
    # by words of the text used: score, equal words
    above = {j: (-j, 0) for j in range(min(len(words), BAND) + 1)}
    for i, word in enumerate(template, 1):
        row: dict[int, tuple[int, int]] = {}
        for j in range(max(0, i - BAND), min(len(words), i + BAND) + 1):
            cells = [(near[0] - 1, near[1]) for near in (above.get(j), row.get(j - 1)) if near]
            if j - 1 in above:
                same = word == words[j - 1]
                cells.append((above[j - 1][0] + (1 if same else -1), above[j - 1][1] + same))
            if cells:
                row[j] = max(cells)
                if row[j] > best_key:
                    best_key, best = row[j], (row[j][1], j)
        above = row
    return best


def align(template: list[bytes], words: list[bytes], place: int, at: int, size: int) -> tuple[int, int, int]:
    """Best alignment through the ``size`` equal words at ``place`` of the text and ``at`` of the
    template: equal words, first word and word after the last in the text."""
    after, end = place + size, at + size
    right, more = extend(template[end:], words[after : after + len(template) - end + BAND])
    left, less = extend(template[:at][::-1], words[max(0, place - at - BAND) : place][::-1])
    return left + size + right, place - less, after + more


def find(words: list[bytes], templates, index, least: float) -> list[tuple[str, float, int, int, int]]:
    """Matches in a text: name, coverage, equal words, first word, word after the last."""
    hits: dict[str, list[tuple[int, int, int]]] = {}
    for size in {len(gram) for gram in index}:
        for place, gram in enumerate(zip(*(words[k:] for k in range(size)), strict=False)):
            if gram in index:
                for name, at in index[gram]:
                    hits.setdefault(name, []).append((place, at, size))
    found = []
    for name, places in hits.items():
        # the word after the last match; hits inside it are part of it
        done = 0
        for place, at, size in sorted(places):
            if place < done:
                continue
            equal, first, after = align(templates[name], words, place, at, size)
            if equal >= least * len(templates[name]):
                found.append((name, equal / len(templates[name]), equal, first, after))
                done = after
    # of matches that overlap the one with most equal words stays
    kept: list[tuple[str, float, int, int, int]] = []
    for match in sorted(found, key=lambda m: (-m[2], -m[1], m[3], m[0])):
        if all(match[4] <= m[3] or m[4] <= match[3] for m in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: m[3])


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = 0.8,
) -> DataFrame:
    """One row per match: id, license, coverage, matched_words, start and end in code points.

    Coverage is the share of the template's words that are matched, at least ``least``. Null and
    empty texts match nothing; repeated rows are scanned each; null ids stay null; templates of
    fewer than ``GRAM`` words match nothing; an empty table gives no rows. Other columns are not read.
    """
    coded = {k: words_of(v) for k, v in (TEMPLATES if templates is None else templates).items()}
    coded = {k: v for k, v in coded.items() if v}
    index = index_of(coded, least)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                matches = find(words_of(text), coded, index, least)
                if matches:
                    raw = text.encode()
                    bounds = [m.span() for m in re.finditer(WORD, raw.lower())]
                    for name, share, equal, first, after in matches:
                        start, end = bounds[first][0], bounds[after - 1][1]
                        rows.append(row)
                        span = len(raw[:start].decode()), len(raw[:end].decode())
                        out.append((name, share, equal, *span))
            names, shares, equals, starts, ends = zip(*out, strict=True) if out else [()] * 5
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(names, pa.string()),
                pa.array(shares, pa.float64()),
                pa.array(equals, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array(ends, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, [id_col, "license", "coverage", "matched_words", "start", "end"]
            )

    shape = f"`{id_col}` {kind}, license string, coverage double, matched_words long, start long, end long"
    return docs.select(id_col, text_col).mapInArrow(run, shape)
