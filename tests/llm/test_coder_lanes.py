"""Blocks of a chunk are coded so many at a time, with the same bytes whatever their number."""

import numpy as np
import pytest

from extractkit.llm import token_coder


@pytest.mark.parametrize("n", [0, 1, 1024, 1025, 5000, 9 * 1024 + 17])
def test_bytes_do_not_depend_on_lanes(monkeypatch, n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 40_000).astype(np.uint32)
    whole, groups, run = token_coder.encode(ids), [], token_coder._run
    monkeypatch.setattr(token_coder, "LANES", 2)
    monkeypatch.setattr(token_coder, "_run", lambda c, s, counts, x: groups.append(len(counts)) or run(c, s, counts, x))
    assert token_coder.encode(ids) == whole
    assert np.array_equal(token_coder.decode(whole), ids)
    assert max(groups, default=0) <= 2 and sum(groups) == 2 * -(-n // token_coder.BLOCK)
