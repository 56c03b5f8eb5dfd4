"""Rows are kept or the job stops: caps, null keys, re-planned scans, failing predictors."""

import pytest

from extractkit import session
from extractkit.operators import evaluate as A
from extractkit.operators import split as S
from extractkit.operators.extract import _answer
from extractkit.sources.jsonl import numbered_scan

GOLD = '{"damage":{"mould":true},"overall_severity":"low"}'


def test_evaluate_scores_all_rows(spark):
    gold = spark.range(1, 501).selectExpr("id", "id AS pos", f"'{GOLD}' AS completion")
    found = gold.selectExpr("id", f"'{GOLD}' AS raw_output")
    report = A.evaluate(gold, found).collect()
    assert {r.denom for r in report} == {500}


@pytest.mark.parametrize("job", [S.split_exact, S.assign_splits])
def test_null_keys_stop_a_split(spark, job):
    rows = spark.range(30).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS id")
    with pytest.raises(Exception, match="decides its split"):
        job(rows, buckets=4).collect()


def test_numbered_scan_after_a_change_of_layout(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(20_000).selectExpr("concat('line ', id) AS value").coalesce(1).write.text(path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "20000")
        lines = numbered_scan(spark, path)
        assert lines.count() == lines.selectExpr("max(line_no)").head()[0] == 20_000
        lines = numbered_scan(spark, path)
        spark.conf.set(key, "70000")
        with pytest.raises(Exception, match="blocks changed"):
            lines.selectExpr("sum(line_no)", "sum(length(raw))").collect()
    finally:
        spark.conf.set(key, before)


def test_scratch_folder_must_be_shared(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_one_bad_prompt_costs_few_calls():
    calls = []

    def predict(prompts):
        calls.append(len(prompts))
        if "bad" in prompts:
            raise ValueError("no")
        return ["ok"] * len(prompts)

    replies, errors = _answer(predict, ["good"] * 700 + ["bad"] + ["good"] * 299)
    assert len(calls) <= 21 and replies.count("ok") == 999 and errors[700] == "ValueError: no"
    replies, errors = _answer(lambda prompts: ["one"], ["a", "b", "c"])
    assert len(replies) == len(errors) == 3


def test_strict_required_input(spark):
    rows = spark.createDataFrame([("a", "train"), ("a", "valid")], "by string, split string")
    with pytest.raises(ValueError, match="split test"):
        S.missing_splits(rows, "by", strict=True)
    with pytest.raises(ValueError, match="empty"):
        S.missing_splits(rows.limit(0), "by", strict=True)


def test_repeated_keys_in_an_unconfigured_session(spark):
    from extractkit.operators.compare import flatten_table
    from extractkit.session import REQUIRED_CONF

    for setting in REQUIRED_CONF:
        spark.conf.unset(setting)
    texts = spark.createDataFrame([(1, '{"a":1,"a":2}')], "id int, t string")
    assert [(r.path, r.value) for r in flatten_table(texts, "t").collect()] == [("a", "2")]
