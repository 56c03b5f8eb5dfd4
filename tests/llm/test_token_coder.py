"""The coder of token ids: one step an id, exact at its edges."""

import numpy as np
import pytest

from extractkit.llm import token_coder, tokens


def _text(n: int) -> np.ndarray:
    draw = np.random.default_rng(3)
    return np.resize(np.concatenate([draw.zipf(1.3, 3000) % 49_000, draw.integers(0, 400, 1500)]), n)


@pytest.mark.parametrize("side", ["_Writer", "_Reader"])
def test_an_id_is_one_step(side, monkeypatch):
    """It was up to six: two bits and four digits, 5.1 microseconds an id both ways."""
    ids, steps = _text(5000), []
    raw = token_coder.encode(ids)

    class Counted(getattr(token_coder, side)):
        def take(self, n, lo, size):
            steps.append(n)
            super().take(n, lo, size)

    monkeypatch.setattr(token_coder, side, Counted)
    assert token_coder.encode(ids) == raw and (token_coder.decode(raw) == ids).all()
    assert sum(steps) == len(ids)


def test_smaller_than_ids_by_digits():
    """Ids of one chunk share a table; digits that each block learnt anew took 11.5 bits an id."""
    ids = np.random.default_rng(5).integers(0, 300, 60_000) * 160
    assert 8 * len(token_coder.encode(ids)) / len(ids) < 8.5


def test_carries_and_rare_ids():
    """Ids that the table makes all but sure, with rare ones between, put carries out over many words."""
    draw = np.random.default_rng(7)
    for top in (2, 40, 65_536):
        ids = np.where(draw.random(30_000) < 0.999, top - 1, draw.integers(0, top, 30_000))
        assert (token_coder.decode(token_coder.encode(ids)) == ids).all()
    every = np.arange(token_coder.ONE)
    assert (token_coder.decode(token_coder.encode(every)) == every).all()


def test_damage_raises_or_changes_no_id():
    ids = _text(3000)
    raw = token_coder.encode(ids)
    for at in range(0, len(raw), 97):
        bad = bytearray(raw)
        bad[at] ^= 4
        try:
            got = token_coder.decode(bytes(bad))
        except ValueError:
            continue
        assert (got == ids).all()


def test_tasks_of_a_worker_share_an_encoder(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "_KEPT", {})
    path = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.kept(path) is tokens.kept(path)
