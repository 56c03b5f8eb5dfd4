"""One hand case per rule and per stop, and a rule-by-rule check against a plain Python reading."""

import json

import pytest

from extractkit.operators.validate import missing_keys, validate_by_code, validate_lines, validate_summary
from extractkit.functions import jsonvalue as J
from extractkit.schema import DAMAGE_FIELDS
from pyspark.sql import functions as F


def line(completion, prompt="p"):
    text = completion if isinstance(completion, str) else json.dumps(completion)
    return json.dumps({"prompt": prompt, "completion": text})


def record(severity="low", **flags):
    return {"damage": {**dict.fromkeys(DAMAGE_FIELDS, False), **flags}, "overall_severity": severity}


def without(key):
    done = record()
    del done["damage"][key]
    return done


D, S = "completion.damage", "completion.overall_severity"
CASES = {
    "good": (line(record()), []),
    "good with space and extra keys": ("  " + json.dumps({"prompt": "p", "completion": json.dumps({**record(), "x": 1}), "y": 2}) + "\t", []),
    "blank": (" \t　", []),
    "empty": ("", []),
    "not json": ("{oops", [("V01", "")]),
    "text after json": (line(record()) + " x", [("V01", "")]),
    "list": ("[1]", [("V02", "")]),
    "number": ("7", [("V02", "")]),
    "no prompt": ('{"completion":"x"}', [("V03", "prompt")]),
    "no keys": ("{}", [("V03", "prompt")]),
    "prompt number, no completion": ('{"prompt":1}', [("V04", "prompt"), ("V03", "completion")]),
    "prompt blank, no completion": ('{"prompt":" "}', [("V05", "prompt"), ("V03", "completion")]),
    "completion blank": ('{"prompt":"p","completion":" "}', [("V05", "completion"), ("V06", "completion")]),
    "completion number": ('{"prompt":"p","completion":3}', [("V04", "completion")]),
    "completion null": ('{"prompt":"p","completion":null}', [("V04", "completion")]),
    "both wrong": ('{"prompt":null,"completion":[]}', [("V04", "prompt"), ("V04", "completion")]),
    "prompt blank, rest good": (line(record(), prompt="\n"), [("V05", "prompt")]),
    "completion not json": (line("{"), [("V06", "completion")]),
    "completion list": (line("[1]"), [("V07", "completion")]),
    "completion string": (line('"x"'), [("V07", "completion")]),
    "completion empty object": (line({}), [("V08", D), ("V12", S)]),
    "completion spaced object": (line(" {} "), [("V08", D), ("V12", S)]),
    "damage list, severity null": (line({"damage": [], "overall_severity": None}), [("V09", D), ("V13", S)]),
    "damage null": (line({"damage": None, "overall_severity": "low"}), [("V09", D)]),
    "damage string": (line({"damage": "{}", "overall_severity": "low"}), [("V09", D)]),
    "damage empty": (line({"damage": {}, "overall_severity": "high"}), [("V10", f"{D}.{f}") for f in DAMAGE_FIELDS]),
    "flag missing": (line(without("mould")), [("V10", f"{D}.mould")]),
    "flags not boolean": (
        line(record(mould="true", broken_plaster=1, odor_present=None)),
        [("V11", f"{D}.broken_plaster"), ("V11", f"{D}.mould"), ("V11", f"{D}.odor_present")],
    ),
    "severity absent": (line({"damage": record()["damage"]}), [("V12", S)]),
    "severity other": (line(record("severe")), [("V13", S)]),
    "severity case": (line(record("Low")), [("V13", S)]),
    "severity number": (line(record(1)), [("V13", S)]),
    "severity object": (line(record({"low": 1})), [("V13", S)]),
    "last duplicate counts": ('{"prompt":1,"prompt":"p","completion":' + json.dumps(json.dumps(record())) + "}", []),
}


@pytest.fixture(scope="module")
def validated(spark):
    df = spark.createDataFrame([(name, raw) for name, (raw, _) in CASES.items()], "name string, raw string")
    return validate_lines(df).cache()


def test_cases(validated):
    got = {r.name: [(e.code, e.path) for e in r.errors] for r in validated.collect()}
    assert got == {name: want for name, (_, want) in CASES.items()}


def test_blank_lines_are_not_counted(validated):
    assert sorted(r.name for r in validated.filter("not non_blank").collect()) == ["blank", "empty"]


def test_summary(validated):
    errors = sum(len(want) for _, want in CASES.values())
    assert tuple(validate_summary(validated).first()) == (errors, len(CASES) - 2, False)
    assert tuple(validate_summary(validated.limit(0)).first()) == (0, 0, True)


def test_by_code(validated):
    rows = validate_by_code(validated).collect()
    assert sum(r.n_errors for r in rows) == sum(len(want) for _, want in CASES.values())
    assert {r.code for r in rows} == {f"V{i:02d}" for i in range(1, 14)}


def test_null_line(spark):
    df = spark.createDataFrame([(None,)], "raw string")
    assert tuple(validate_lines(df).select("errors", "non_blank").first()) == ([], False)


def test_missing_keys(spark):
    df = spark.createDataFrame([('{"b":null}',), ("{}",), ('{"a":1,"b":2,"c":3}',)], "t string")
    df = J.parse_columns(df, {"v": F.col("t")})
    assert [r.missing for r in missing_keys(df, "v", ("c", "a", "b")).collect()] == [["c", "a"], ["c", "a", "b"], []]
