"""Scoring and comparison edges."""

import json

import pytest
from pyspark.sql import functions as F

from extractkit.operators import compare as C
from extractkit.operators.evaluate import evaluate
from extractkit.operators.generate import generate_pairs
from extractkit.operators.split import split_exact
from extractkit.operators.student import fit_student
from extractkit.schema import DAMAGE_FIELDS


def record(severity="low", **flags):
    return {"damage": {**dict.fromkeys(DAMAGE_FIELDS, False), **flags}, "overall_severity": severity}


def report(spark, rows, max_examples=None):
    """rows: (gold text, raw output or None for no prediction)"""
    def text(x):
        return x if x is None or isinstance(x, str) else json.dumps(x)

    gold = spark.createDataFrame([(i, i + 1, text(g)) for i, (g, _) in enumerate(rows)], "id int, pos int, completion string")
    pred = spark.createDataFrame([(i, text(p)) for i, (_, p) in enumerate(rows) if p is not None], "id int, raw_output string")
    return {r.field: (r.correct, r.denom, r.pct) for r in evaluate(gold, pred, max_examples).collect()}


def test_perfect_and_wrapped(spark):
    got = report(spark, [(record(), record()), (record(mould=True), "Sure: " + json.dumps(record(mould=True)) + " done.")])
    assert all(v == (2, 2, 100.0) for v in got.values()) and len(got) == 12


def test_denominators(spark):
    got = report(spark, [
        (record(), record(mould=True)),
        ({}, record()),
        ("oops", record()),
        ([1], record()),
        (None, record()),
        (record(), "{}"),
        (record(), "no block"),
        (record(), '{"damage":'),
        (record(), None),
        (record(), json.dumps(record()) + " or {x}"),
    ])
    assert got["json"] == (1, 10, 10.0)
    assert got["mould"] == (0, 1, 0.0) and got["odor_present"] == (1, 1, 100.0) and got["overall_severity"] == (1, 1, 100.0)


def test_missing_null_and_types(spark):
    gold = record(mould=True)
    del gold["damage"]["ceiling_damage"]
    pred = record(mould=1, ceiling_damage=None)
    got = report(spark, [(gold, pred)])
    assert got["ceiling_damage"][0] == 1 and got["mould"][0] == 0
    nothing = {"other": 1}
    assert all(v[0] == 1 for v in report(spark, [(nothing, {"x": 1})]).values())
    for falsy in (None, {}, [], "", 0, False):
        assert report(spark, [(nothing, {"damage": falsy})])["mould"][0] == 1
    for truthy in ("x", [1], 3, True):
        got = report(spark, [(nothing, {"damage": truthy})])
        assert got["mould"][0] == 0 and got["overall_severity"][0] == 1


def test_no_rows(spark):
    got = report(spark, [(record(), record())], max_examples=0)
    assert got["json"] == (0, 0, None) and got["mould"] == (0, 0, 0.0) and got["overall_severity"] == (0, 0, 0.0)


def test_first_examples_by_position(spark):
    rows = [(record(), record()), (record(), "none"), (record(), "none")]
    assert report(spark, rows, max_examples=2)["json"] == (1, 2, 50.0)


def outputs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id int, raw_output string")


A = {
    1: '{"a":1,"b":{"c":true}} tail}',
    2: '{"k":null}',
    3: "{}",
    4: "no json",
    5: '{"a":1}',
    6: '{"a":1}',
    7: '{"n":1.0,"s":"1","l":[1,2]}',
    8: '{"a.b":1}',
    10: '{"t":true}',
}
B = {
    1: 'x {"a":1,"b":{"c":false},"d":2}',
    2: '{"z":null}',
    3: "text {}",
    4: '{"a":1}',
    5: "{broken}",
    7: '{"n":1,"s":1,"l":[2,1]}',
    8: '{"a":{"b":1}}',
    9: '{"a":1}',
    10: '{"t":1}',
}
EXPECTED = {
    1: (None, 3, 1), 2: (None, 2, 2), 3: (None, 0, 0), 4: ("no_json_a", None, None), 5: ("no_json_b", None, None),
    6: ("no_json_b", None, None), 7: (None, 3, 1), 8: (None, 1, 1), 9: ("no_json_a", None, None), 10: (None, 1, 0),
}


def test_compare_models(spark):
    rows = C.compare_models(outputs(spark, A), outputs(spark, B)).collect()
    assert {r.id: (r.rejected, r["keys"], r.matches) for r in rows} == EXPECTED
    pct = {r.id: r.pct for r in rows}
    assert pct[3] is None and pct[4] is None and pct[2] == 100.0 and pct[1] == pytest.approx(100 / 3)


def test_agreement(spark):
    total = C.model_agreement(C.compare_models(outputs(spark, A), outputs(spark, B))).first()
    assert tuple(total)[:4] == (6, 4, 10, 5) and total.pct == 50.0


def test_long_form_agrees_with_row_form(spark):
    a, b = outputs(spark, A), outputs(spark, B)
    summary = {r.id: (r["keys"], r.matches) for r in C.compare_summary(C.compare_models(a, b)).collect()}
    assert summary == {k: v[1:] for k, v in EXPECTED.items() if v[0] is None and v[1]}
    paths = C.compare_paths(a, b).collect()
    counted = {k: (sum(r.id == k for r in paths), sum(r.is_match for r in paths if r.id == k)) for k in summary}
    assert counted == summary and {r.id for r in paths} == set(summary)
    assert C.path_union(a, b).distinct().count() == len(paths)


def test_mismatches(spark):
    rows = C.compare_mismatches(C.compare_paths(outputs(spark, A), outputs(spark, B))).filter("id in (1, 7)").collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, "b.c", "true", "false"), (1, "d", "<missing>", "2"), (7, "l", "[1,2]", "[2,1]"), (7, "s", '"1"', "1"),
    ]


def test_paths_are_matched_without_a_second_shuffle(spark):
    for compared in (C.compare_models, C.compare_paths):
        plan = compared(outputs(spark, A), outputs(spark, B))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == plan.count("Exchange hashpartitioning") == 2


def test_student_learns(spark):
    rows = split_exact(generate_pairs(spark.range(600)).select("id", "prompt", "completion"), train=500, valid=0)
    student = fit_student(rows.filter("split = 'train'"))
    test = rows.filter("split = 'test'")
    got = {r.field: r.pct for r in evaluate(test, student.predict(test), max_examples=None).collect()}
    assert got["json"] == 100.0
    assert min(got[f] for f in DAMAGE_FIELDS) > 75.0 and got["overall_severity"] > 60.0
