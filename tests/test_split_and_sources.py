"""Exact splits, numbered scans over many blocks, JSONL round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from extractkit.operators import split as S
from extractkit.operators.generate import generate_pairs
from extractkit.sources import jsonl as L


def expected_split(keys, train, valid, seed=42):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    names = ["train"] * train + ["valid"] * valid
    out, place = {}, {}
    for i, key in enumerate(order):
        name = names[i] if i < len(names) else "test"
        place[name] = place.get(name, 0) + 1
        out[key] = (name, place[name])
    return out


@pytest.mark.parametrize(
    "n,train,valid,buckets",
    [(10, 8, 1, 4), (1000, 800, 100, None), (1000, 800, 100, 300), (50, 0, 0, 3), (50, 80, 10, 3), (37, 0.8, 0.1, 5), (0, 8, 1, 2)],
)
def test_split_exact(spark, n, train, valid, buckets):
    df = spark.range(n).withColumn("payload", F.col("id") * 2)
    got = {r.id: (r.split, r.pos) for r in S.split_exact(df, train=train, valid=valid, buckets=buckets).collect()}
    sizes = [int(n * s) if isinstance(s, float) else s for s in (train, valid)]
    assert got == expected_split(range(n), *sizes)
    members = {r.id: r.split for r in S.assign_splits(df, train=train, valid=valid, buckets=buckets or 64).collect()}
    assert members == {k: s for k, (s, _) in got.items()}


def test_split_ignores_partitioning_and_keeps_columns(spark):
    df = generate_pairs(spark.range(100)).select("id", "prompt", "completion")
    one = S.split_exact(df.repartition(1), train=80, valid=10, buckets=1).orderBy("id").collect()
    many = S.split_exact(df.repartition(16), train=80, valid=10, buckets=16).orderBy("id").collect()
    assert one == many and one[0].asDict().keys() == {"id", "prompt", "completion", "split", "pos"}


def test_string_keys(spark):
    df = spark.range(200).select(F.concat(F.lit("k"), "id").alias("name"))
    got = {r.name: (r.split, r.pos) for r in S.split_exact(df, "name", 100, 50).collect()}
    assert got == expected_split([f"k{i}" for i in range(200)], 100, 50)


def test_split_plan_shuffles_rows_once_and_never_into_one_task(spark):
    df = generate_pairs(spark.range(100)).select("id", "prompt", "completion")
    plan = S.split_exact(df)._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.split("\n") if "Exchange" in line and "BroadcastExchange" not in line]
    assert len(rows) == 1 and "shufflepartitionidpassthrough" in rows[0]
    assert "SinglePartition" not in plan


def skewed(spark, n=4000):
    """Half of the rows share one key; some rows are equal in all columns."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id"))
    return spark.range(n).select(key.alias("key"), (F.col("id") % 1500).alias("n"))


@pytest.mark.parametrize("train,valid", [(800, 100), (0.6, 0.2), (1999, 2), (0, 0), (5000, 10)])
def test_a_key_with_half_of_the_rows(spark, train, valid):
    df, n = skewed(spark), 4000
    hashes = {r.key: hashlib.md5(f"42:{r.key}".encode()).hexdigest() for r in df.select("key").distinct().collect()}
    sizes = [int(n * s) if isinstance(s, float) else s for s in (train, valid)]
    names = (["train"] * sizes[0] + ["valid"] * sizes[1] + ["test"] * n)[:n]
    results = {}
    for label, most in (("ranges", 100), ("buckets", 1_000_000)):
        rows = S.split_exact(df, "key", train, valid, buckets=16, rows_per_task=most).collect()
        place = {"train": 0, "valid": sizes[0], "test": sum(sizes)}
        rank = [place[r.split] + r.pos for r in rows]
        # the result is in order as a whole, without gaps, and keys are in the order of their hashes
        assert rank == list(range(1, n + 1))
        assert [r.split for r in rows] == names
        assert [hashes[r.key] for r in rows] == sorted(hashes[r.key] for r in rows)
        results[label] = [(r.key, r.n) for r in rows]
        members = S.assign_splits(df, "key", train, valid, buckets=16, rows_per_task=most).collect()
        assert sorted((r.key, r.n, r.split) for r in members) == sorted((r.key, r.n, r.split) for r in rows)
    assert results["ranges"] == results["buckets"]
    assert sorted(results["ranges"]) == sorted((r.key, r.n) for r in df.collect())


def test_a_hot_key_is_cut_into_several_tasks(spark):
    rows = S.split_exact(skewed(spark), "key", 0.8, 0.1, buckets=16, rows_per_task=100)
    sizes = rows.groupBy(F.spark_partition_id()).count().select("count").collect()
    assert max(r["count"] for r in sizes) <= 4000 // 16 + 1


def test_columns_without_a_hash_and_clashing_names(spark):
    df = spark.range(40).selectExpr("id % 2 AS id", "map('a', id) AS m", "'x' AS before", "parse_json('[1]') AS v")
    rows = S.split_exact(df, train=10, valid=10, buckets=4).selectExpr("id", "m['a'] AS a", "before", "split", "pos")
    again = S.split_exact(df.repartition(7), train=10, valid=10, buckets=9, rows_per_task=1)
    again = again.selectExpr("id", "m['a'] AS a", "before", "split", "pos")
    assert sorted(rows.collect()) == sorted(again.collect())


def test_buckets_follow_rows_and_bytes(spark):
    df = spark.range(5000).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert S.default_buckets(df, rows_per_task=100) == 50
    assert S.default_buckets(df, bytes_per_task=100_000) >= 50
    assert S.default_buckets(df) == 4
    assert S.default_buckets(df, bytes_per_task=1) == S.MOST_BUCKETS


def test_counts_gate_and_first_n(spark):
    df = S.split_exact(spark.range(10), train=8, valid=1)
    assert {r.split: r.n_rows for r in S.split_counts(df).collect()} == {"train": 8, "valid": 1, "test": 1}
    assert tuple(S.count_gate(df, 10).first()) == (10, 10, True)
    assert tuple(S.count_gate(df.limit(9), 10).first()) == (10, 9, False)
    with pytest.raises(Exception, match="expected 10 records, found 9"):
        S.count_gate(df.limit(9), 10, strict=True).collect()
    train = df.filter("split = 'train'")
    assert [r.pos for r in S.first_n(train, 3).collect()] == [1, 2, 3]
    assert S.first_n(train, None).count() == 8


def test_missing_splits(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "valid"), ("a", "test"), ("b", "train")], "src string, split string")
    assert sorted(tuple(r) for r in S.missing_splits(df, "src").collect()) == [("b", "test"), ("b", "valid")]


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "1b")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def write_files(folder, files, newline="\n"):
    for i, lines in enumerate(files):
        (folder / f"part-{i:05d}.txt").write_text(newline.join(lines) + newline, newline="")


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_numbered_scan_over_many_blocks(spark, tmp_path, small_blocks, newline):
    rng = random.Random(1)
    files = [[rng.choice(["", " ", "x" * rng.randint(1, 90)]) for _ in range(n)] for n in (500, 1, 90, 300)]
    write_files(tmp_path, files, newline)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    per_file = L.numbered_scan(spark, str(tmp_path)).collect()
    got = sorted((r.file[-9:-4], r.line_no, r.raw, r.non_blank) for r in per_file)
    want = [(f"{i:05d}", n, t, bool(t.strip())) for i, lines in enumerate(files) for n, t in enumerate(lines, 1)]
    assert got == sorted(want)
    whole = L.numbered_scan(spark, str(tmp_path), per_file=False).collect()
    assert sorted((r.line_no, r.raw) for r in whole) == list(enumerate([t for f in files for t in f], 1))


def test_numbered_scan_reads_a_long_block_table_in_runs(spark, tmp_path, small_blocks, monkeypatch):
    files = [[f"line {i}" for i in range(200)]] * 3
    write_files(tmp_path, files)
    monkeypatch.setattr(L, "BLOCKS_AT_ONCE", 0)
    rows = L.numbered_scan(spark, str(tmp_path), per_file=False).collect()
    assert sorted((r.line_no, r.raw) for r in rows) == list(enumerate([t for f in files for t in f], 1))


def test_load_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"prompt":"a","completion":"b"}\n\n \t\n  {"prompt":"c"}  \n')
    assert sorted(tuple(r) for r in L.load_jsonl(spark, str(path)).collect()) == [("a", "b"), ("c", None)]
    path.write_text('{"prompt":"a"}\n{"prompt":\n')
    with pytest.raises(Exception, match="line is not JSON"):
        L.load_jsonl(spark, str(path)).collect()
    assert [r.prompt for r in L.load_jsonl(spark, str(path), strict=False).collect()].count(None) == 1


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("é\n\"\\\t ", "{}"), ("", " x ")], "prompt string, completion string")
    L.write_jsonl(rows, str(tmp_path / "out"))
    assert sorted(L.load_jsonl(spark, str(tmp_path / "out")).collect()) == sorted(rows.collect())


def test_split_files_keep_the_shuffled_order(spark, tmp_path):
    df = S.split_exact(generate_pairs(spark.range(500)), train=400, valid=50, buckets=7)
    L.write_splits(df, str(tmp_path / "s"))
    for name, size in (("train", 400), ("valid", 50), ("test", 50)):
        read = L.read_split(spark, str(tmp_path / "s"), name)
        want = df.filter(F.col("split") == name).select(F.col("pos").alias("line_no"), "prompt", "completion")
        assert read.count() == size and read.exceptAll(want).count() == 0
    with pytest.raises(ValueError, match="unknown split"):
        L.read_split(spark, str(tmp_path / "s"), "dev")


def test_whole_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\nb\n")
    assert [r.value for r in L.read_whole_text(spark, str(tmp_path)).collect()] == ["a\nb\n"]
