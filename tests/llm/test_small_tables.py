"""Small tables are worked on by as many tasks as their rows need, with the same results."""

import pytest

from extractkit.llm import graph, ngram_join, tables


@pytest.fixture
def wide(spark):
    """As many shuffle partitions as for large tables, none of them joined."""
    values = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


EDGES = [(k, k + 1) for k in range(1, 60)] + [(k, 100) for k in range(101, 160)] + [(200, 200), (201, None), (7, 3)]


def _components(spark):
    return graph.components(spark.createDataFrame(EDGES, "a long, b long"))


def test_few_edges_are_one_tasks(wide):
    found = _components(wide)
    assert len(found.inputFiles()) == 1
    assert found.rdd.getNumPartitions() <= 2
    wanted = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)}
    assert {r.id: r.component for r in found.collect()} == wanted


def test_many_edges_give_the_same(wide, monkeypatch):
    monkeypatch.setattr(graph, "gathered", lambda df, rows: tables.gathered(df, rows, 10))
    found = _components(wide)
    assert len(found.inputFiles()) > 1
    wanted = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)}
    assert {r.id: r.component for r in found.collect()} == wanted
    assert found.count() == len(wanted)


def test_join_gives_the_same_in_one_task_and_in_many(wide, monkeypatch):
    word = "w{}".format
    texts = [" ".join(word(10 * (k // 9) + i) for i in range(60)) + f" end{k % 9}" * (k % 3) for k in range(60)]
    docs = wide.createDataFrame([*enumerate(texts), (60, None), (61, "")], "doc_id long, text string")
    one = {tuple(r) for r in ngram_join.near_duplicates(docs).collect()}
    monkeypatch.setattr(ngram_join, "gathered", lambda df, rows, most=5: tables.gathered(df, rows, 5))
    monkeypatch.setattr(graph, "gathered", lambda df, rows: tables.gathered(df, rows, 5))
    assert {tuple(r) for r in ngram_join.near_duplicates(docs).collect()} == one
    assert len(one) == 62 and len({r[2] for r in one}) < 30
