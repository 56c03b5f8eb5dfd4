"""A worker gives each distinct piece to the library once, in whatever words, batches and tasks it stands."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from extractkit.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Zorblat, zorblat. (zorblat)", "zorblat! quix7zorblat", None, "", "naïve Zorblat's <|endoftext|> 中文 quix"]


def test_a_piece_is_encoded_once(monkeypatch):
    encoder, given = tokens.Encoder(PATH, 3), []
    merged = encoder._merged
    monkeypatch.setattr(encoder, "_merged", lambda pieces, cut: given.extend(pieces) or merged(pieces, cut))
    monkeypatch.setattr(tokens, "PIECES", 100)
    monkeypatch.setattr(tokens, "PIECE_CHARS", 1000)
    for text in TEXTS:
        list(encoder.encode([text]))
    assert len(given) == len(set(given)) and {"zorblat", "quix"} <= set(given)


def test_ids_are_the_librarys_however_little_is_kept():
    whole = Tokenizer.from_file(PATH)
    for cached in (0, 3, 1000):
        encoder = tokens.Encoder(PATH, cached)
        for _ in range(2):
            found = [x for i in range(0, len(TEXTS), 2) for x in encoder.encode(TEXTS[i : i + 2])]
            for text, ids in zip(TEXTS, found, strict=True):
                wanted = [*whole.encode(text or "", add_special_tokens=False).ids, tokens.END]
                assert np.array_equal(ids, np.array(wanted, dtype=np.uint32))


def test_tasks_of_a_worker_share_an_encoder():
    one = tokens.kept(PATH, 5)
    assert tokens.kept(PATH, 7) is one and one.cached == 7
