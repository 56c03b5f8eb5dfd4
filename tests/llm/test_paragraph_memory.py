"""Op2's scans take texts in small parts and give freed memory back after each batch."""

import pyarrow as pa
import pytest

from extractkit.llm import anchors, paragraphs, textscan


class Held:
    """A table whose mapInArrow runs here, over the given batches."""

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, run, shape):
        return list(run(iter(self.batches)))

    def select(self, *columns):
        return self


TEXTS = [" ".join(f"w{k}x{i}" for i in range(3000)) for k in range(40)]


def _batch(**more):
    n = len(TEXTS)
    return pa.RecordBatch.from_pydict({**more, "text": TEXTS} if more else {"id": list(range(n)), "text": TEXTS})


@pytest.fixture
def seen(monkeypatch):
    freed, sizes, groups = [], [], textscan.groups

    def spied(texts, most=textscan.GROUP_BYTES):
        for a, b in groups(texts, most):
            sizes.append(sum(map(len, texts[a:b])))
            yield a, b

    monkeypatch.setattr(textscan, "release", lambda: freed.append(1))
    monkeypatch.setattr(anchors, "groups", spied)
    monkeypatch.setattr(paragraphs, "groups", spied)
    return freed, sizes


@pytest.mark.parametrize("whole", [False, True])
def test_lines(seen, whole):
    freed, sizes = seen
    found = paragraphs._scan(Held(_batch(), _batch()), 50, whole)
    assert sum(b.num_rows for b in found) > 0
    assert len(freed) == 2 and max(sizes) <= 1 << 18 and sum(sizes) == 2 * sum(map(len, TEXTS))


def test_anchors(seen):
    freed, sizes = seen
    n = list(range(len(TEXTS)))
    found = anchors._texts(Held(_batch(row=n, id=n, seen=n)), 50)
    assert pa.concat_tables([pa.Table.from_batches([b]) for b in found])["row"].to_pylist() == n
    assert len(freed) == 1 and max(sizes) <= 1 << 18 and sum(sizes) == sum(map(len, TEXTS))
