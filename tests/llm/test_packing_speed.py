"""Packing and its encoder do work that follows what is new, with the same results."""

import public_tokenizers
import numpy as np
from tokenizers import Tokenizer

from extractkit.llm import packing
from extractkit.llm.tokens import END, Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_best_fit_by_tokens_is_the_general_one():
    """A limit on pieces that never binds, without weight, gives the general search (3.8 s of CPU for 20,000 lengths, by room 0.04)."""
    draw = np.random.default_rng(8)
    for n, top in ((0, 9), (1, 9), (400, 100), (700, 30), (3000, 4096)):
        lengths = np.sort(draw.integers(1, top + 20, n))[::-1]
        want = packing.best_fit(lengths, (top, 10**9, None), weights=(1.0, 0.0, 0.0))
        got = packing.best_fit(lengths, (top, None, None))
        for a, b in zip(got, want, strict=True):
            assert a.tolist() == b.tolist()


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **rest):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **rest)


def test_the_library_sees_each_piece_of_plain_words_once():
    """Words that differ in case and signs alone went to the library each."""
    coder, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    coder.tokenizer = Counted(coder.tokenizer)
    texts = ["Prose, prose; (PROSE) prose... Élan élan! 12 x-ray 3x X", "prose: aµb it's <|endoftext|>x", None]
    got = [x.tolist() for x in coder.encode(texts)]
    assert got == [[*plain.encode(t or "", add_special_tokens=False).ids, END] for t in texts]
    seen = "".join(coder.tokenizer.texts).lower()
    assert "it's" in seen and "prose" not in seen and "ray" not in seen


def test_odd_words_are_the_library_s():
    draw = np.random.default_rng(2)
    signs = [chr(c) for c in range(0x180)] + ["the", "ing", "́", " ", "ﬁ", "Σ", "語", "<|", "|>", " ", " "]
    texts = ["".join(draw.choice(signs, draw.integers(0, 12))) for _ in range(5000)]
    coder, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    coded = plain.encode_batch_fast(texts, add_special_tokens=False)
    assert [x.tolist() for x in coder.encode(texts)] == [[*c.ids, END] for c in coded]
