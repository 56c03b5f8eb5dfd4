"""Token ids of whole texts with the tokenizers library, word by word through a cache.

The vocabulary drops white space and never joins across it, so a text has the ids of its words one
after the other. Words are the runs between ASCII white space. Plain words are cut into the pieces that the
vocabulary never joins; each distinct piece is encoded by the library once per worker while the cache holds
it. Other new words go to the library a hundred to a text, with one of the vocabulary's special tokens between
them, whose id shows where each word ends.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words and their characters kept between batches.
CACHED_WORDS, CACHED_CHARS = 400_000, 32_000_000
#: For each word that may be kept, pieces and their characters; words are soon made again from them.
PIECES, PIECE_CHARS = 2, 40
#: New words joined to one text for the library.
JOINED = 100
#: Characters of text split at once.
SPLIT_CHARS = 4 << 20
#: Id appended to each document.
END = 1

#: The rules of a vocabulary whose plain words are cut into pieces here.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Suffix of the last token of a piece.
LAST = "</w>"
#: Plain words: no apostrophe, which has rules of its own, and no mark of a special token.
_PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+").fullmatch
_ALL_PLAIN = re.compile("[\n!-&(-;=-~À-ÖØ-öø-ÿ]*").fullmatch
_PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n")


class Encoder:
    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [token.content for token in added.values()]
        self.mark = next(
            (
                (token.content, number)
                for number, token in added.items()
                if token.special and not (token.lstrip or token.rstrip or token.single_word)
            ),
            None,
        )
        self.merges = self._merges(path)
        self._clear()
        self._clear_pieces()

    def _merges(self, path: str):
        """A tokenizer of the vocabulary's merges alone, where its rules are ``RULES``; else None.

        Its texts are pieces in lower case with a space after each.
        """
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model = rules["model"]
        suffix = model.get("end_of_word_suffix")
        if {k: rules.get(k) for k in RULES} != RULES or model["type"] != "BPE" or suffix != LAST:
            return None
        if any("<" not in token for token in self.added) or model.get("dropout"):
            return None
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        made = Tokenizer.from_file(path)
        made.normalizer = normalizers.Sequence([])
        bytes_ = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.wide = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), bytes_])
        self.ascii = pre_tokenizers.CharDelimiterSplit(" ")
        self.ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        self.ends[[k for token, k in model["vocab"].items() if token.endswith(LAST)]] = True
        return made

    def _merged(self, pieces: list[str], cut) -> tuple[np.ndarray, np.ndarray] | None:
        """Numbers of ids and the ids of pieces, after ``cut`` at spaces; None if ends don't tell pieces apart."""
        self.merges.pre_tokenizer = cut
        texts = [" ".join(pieces[i : i + 1000]) for i in range(0, len(pieces), 1000)]
        coded = self.merges.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.concatenate([np.empty(0, np.uint32), *[np.array(c.ids, dtype=np.uint32) for c in coded]])
        ends = np.flatnonzero(self.ends[flat])
        return (np.diff(ends, prepend=-1), flat) if len(ends) == len(pieces) else None

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Numbers of ids and the ids of plain words, by their distinct pieces."""
        if len(self.piece) > PIECES * self.cached or self.piece_chars > PIECE_CHARS * self.cached:
            self._clear_pieces()
        pieces = _PIECE.findall("\n".join(words).lower())
        at = np.fromiter(map(self.piece.get, pieces, repeat(-1)), np.int64, len(pieces))
        if len(unknown := np.flatnonzero(at < 0)):
            new = [pieces[i] for i in unknown.tolist()]
            if not self._learn_pieces(set(new)):
                return None
            at[unknown] = np.fromiter(map(self.piece.__getitem__, new), np.int64, len(new))
        n = self.piece_size[at]
        ends = np.cumsum(n)
        breaks = ends[at == 0]
        ids = _gathered(self.piece_flat, self.piece_size, at, self.piece_first)
        return np.diff(breaks, prepend=0, append=n.sum()), ids

    def _learn_pieces(self, new: set[str]) -> bool:
        sides = [x for x in new if x.isascii()], [x for x in new if not x.isascii()]
        made = [self._merged(x, cut) for x, cut in zip(sides, (self.ascii, self.wide), strict=True)]
        if None in made:
            return False
        at = len(self.piece)
        self.piece.update(zip([*sides[0], *sides[1]], range(at, at + len(new)), strict=True))
        self.piece_size = np.concatenate([self.piece_size, *[n for n, _ in made]])
        self.piece_flat = np.concatenate([self.piece_flat, *[ids for _, ids in made]])
        self.piece_first = np.cumsum(self.piece_size) - self.piece_size
        self.piece_chars += sum(map(len, new))
        return True

    def _clear_pieces(self) -> None:
        # the break between words is a piece without ids
        self.piece: dict[str, int] = {"\n": 0}
        self.piece_size, self.piece_flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)
        self.piece_first = np.zeros(1, dtype=np.int64)
        self.piece_chars = 0

    def _clear(self) -> None:
        # no word has a space: that is the end of a text
        self.number: dict[str, int] = {" ": 0}
        self.size, self.flat = np.ones(1, dtype=np.int64), np.full(1, END, dtype=np.uint32)
        self.first = np.zeros(1, dtype=np.int64)
        self.chars = 0

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        flat = np.array([i for ids in coded for i in ids], dtype=np.uint32)
        return np.array([len(ids) for ids in coded], dtype=np.int64), flat

    def _coded(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of ids and the ids of each ``JOINED`` words in turn."""
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for i in range(0, len(parts), 100):
            some = parts[i : i + 100]
            if self.mark is None:
                yield from map(self._alone, some)
                continue
            mark, number = self.mark
            coded = self.tokenizer.encode_batch_fast(
                [mark.join(part) for part in some], add_special_tokens=False
            )
            for part, code in zip(some, coded, strict=True):
                ids = np.array(code.ids, dtype=np.uint32)
                is_mark = ids == number
                ends = np.flatnonzero(is_mark)
                plain = " ".join(part)
                if len(ends) != len(part) - 1 or any(token in plain for token in self.added):
                    yield self._alone(part)
                else:
                    bounds = np.concatenate([[-1], ends, [len(ids)]])
                    yield np.diff(bounds) - 1, ids[~is_mark]

    def _learn(self, new: list[str]) -> None:
        plain, other = [], new
        if self.merges is not None:
            plain, other = new, []
            if not _ALL_PLAIN("\n".join(new)):
                plain, other = [w for w in new if _PLAIN(w)], [w for w in new if not _PLAIN(w)]
        made = self._plain(plain) if plain else None
        if made is None:
            plain, other = [], new
        sizes, flats = zip(*[made] * bool(plain), *self._coded(other), strict=True)
        at = len(self.number)
        self.number.update(zip([*plain, *other], range(at, at + len(new)), strict=True))
        self.size = np.concatenate([self.size, *sizes])
        self.flat = np.concatenate([self.flat, *flats])
        self.first = np.cumsum(self.size) - self.size
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, with the end id; null is empty."""
        texts = [t or "" for t in texts]
        at = 0
        while at < len(texts):
            first, total = at, 0
            while at < len(texts) and (at == first or total + len(texts[at]) <= SPLIT_CHARS):
                total += len(texts[at])
                at += 1
            yield from self._encoded(texts[first:at])

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        met = split.flatten().dictionary_encode()
        words = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) > self.cached or self.chars > CACHED_CHARS:
            self._clear()
        known = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        if len(unknown := np.flatnonzero(known < 0)):
            self._learn(new := [words[i] for i in unknown.tolist()])
            known[unknown] = np.fromiter(map(self.number.__getitem__, new), np.int64, len(new))
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        place = np.insert(known[met.indices.to_numpy()], last, 0)
        ids = _gathered(self.flat, self.size, place, self.first)
        ends = np.cumsum(self.size[place])[last + np.arange(len(last))]
        yield from np.split(ids, ends[:-1])


#: The encoder a worker made last, by its file.
_KEPT: dict[str, Encoder] = {}


def kept(path: str, cached: int = CACHED_WORDS) -> Encoder:
    """An encoder that the worker's next tasks use again, with the words and pieces it knows."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = Encoder(path, cached)
    _KEPT[path].cached = cached
    return _KEPT[path]


def _gathered(flat: np.ndarray, size: np.ndarray, at: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """The ids of the words with the numbers ``at``, one after the other."""
    if first is None:
        first = np.cumsum(size) - size
    n = size[at]
    ends = np.cumsum(n)
    return flat[np.arange(n.sum()) + np.repeat(first[at] - (ends - n), n)]
