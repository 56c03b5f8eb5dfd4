"""Line numbers at any number of blocks, and the running totals behind them."""

import pytest
from pyspark.sql import functions as F

from extractkit.operators.prefix import running_total
from extractkit.sources import jsonl

FILES = {"a b%20c.txt": 4000, "b[1]{2}.txt": 1, "c.txt": 0, "d.txt": 2500, "e.txt": 3}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("lines")
    for name, n in FILES.items():
        (path / name).write_text("".join(f"{name} {i}\n" if i % 5 else "  \n" for i in range(n)))
    return str(path)


@pytest.fixture
def many_blocks(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "5000")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("at_once", [200_000, 12, 1])
@pytest.mark.parametrize("per_file", [True, False])
def test_numbers_do_not_depend_on_the_number_of_blocks(spark, folder, many_blocks, monkeypatch, at_once, per_file):
    monkeypatch.setattr(jsonl, "BLOCKS_AT_ONCE", at_once)
    got = jsonl.numbered_scan(spark, folder, per_file).collect()
    want, base = set(), 0
    for name, n in FILES.items():
        want |= {(base + i + 1, f"{name} {i}" if i % 5 else "  ") for i in range(n)}
        base += 0 if per_file else n
    assert len(got) == sum(FILES.values())
    if per_file:
        by_name = {}
        for r in got:
            by_name.setdefault(r.file, []).append(r.line_no)
        assert sorted(map(len, by_name.values())) == sorted(n for n in FILES.values() if n)
        assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_name.values())
    else:
        assert {(r.line_no, r.raw) for r in got} == want
    assert all(r.non_blank == bool(r.raw.strip()) for r in got)


def test_lines_are_not_shuffled(spark, folder, many_blocks, monkeypatch):
    """Whatever the number of blocks, nothing but broadcasts stands between the scan and the result."""
    for at_once in (200_000, 1):
        monkeypatch.setattr(jsonl, "BLOCKS_AT_ONCE", at_once)
        for per_file in (True, False):
            plan = jsonl.numbered_scan(spark, folder, per_file)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan
            for word in ("SinglePartition", "hashpartitioning", "rangepartitioning", "SortMergeJoin", "Window"):
                assert word not in plan


def test_running_totals(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 13).alias("v"), F.lit(1).alias("before"))
    df = df.withColumn("v", F.when(F.col("k") % 10 != 3, F.col("v")))
    got, total = running_total(df.repartition(6), ["k"], "v", "sum_before", start=5)
    rows, at = sorted(got.collect()), 5
    for r in rows:
        assert r.sum_before == at
        at += r.v or 0
    assert total == at - 5 and len(rows) == 5000
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    empty, none = running_total(df.limit(0), ["k"], "v", "sum_before")
    assert (empty.count(), none) == (0, 0)


@pytest.mark.parametrize("at_once", [200_000, 2])
def test_part_files_in_the_order_they_were_written(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(jsonl, "BLOCKS_AT_ONCE", at_once)
    order = ["00000", "09999", "10000", "99999", "100000", "1000000"]
    want = []
    (tmp_path / "split=train").mkdir()
    for part in order:
        for piece in ("000", "001", "1000"):
            text = f"{part} {piece}"
            want.append(text)
            name = f"part-{part}-0c1d-c9.c{piece}.json"
            (tmp_path / "split=train" / name).write_text(f'{{"prompt":"{text}","completion":"c"}}\n')
    got = jsonl.read_split(spark, str(tmp_path), "train").sort("line_no").collect()
    assert [(r.line_no, r.prompt) for r in got] == list(enumerate(want, 1))
