"""Hand cases for text cutting, strict parsing and flattening."""

import json
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.functions.severity import severity_bucket
from extractkit.functions.text import WHITESPACE, is_blank, json_block_balanced, json_block_greedy, strip_text
from extractkit.operators.compare import flatten_table
from extractkit.operators.prompts import PLACEHOLDER, reject_empty, render_output, render_prompt


def column(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = J.parse_columns(df, {"v": F.col("t")}).orderBy("i").select(F.to_json("v")).collect()
    return [r[0] for r in rows]


BLOCKS = [
    ("x {a} y {b} z", "{a} y {b}", "{a}"),
    ('} {"k":"}"}', '{"k":"}"}', '{"k":"}'),
    ("{{}", "{{}", ""),
    ("none", "", ""),
    ("}{", "", ""),
    ("", "", ""),
    ("a{\n{b}\n}c}", "{\n{b}\n}c}", "{\n{b}\n}"),
    ("é{ü}", "{ü}", "{ü}"),
]


def test_blocks(spark):
    texts = [b[0] for b in BLOCKS]
    assert column(spark, texts, json_block_greedy) == [b[1] for b in BLOCKS]
    assert column(spark, texts, json_block_balanced) == [b[2] for b in BLOCKS]


def balanced_by_sums(text):
    """Running sums of braces over what follows the text before the first one; the first zero ends it."""
    _, brace, rest = text.partition("{")
    block = brace + rest
    sums = list(accumulate((c == "{") - (c == "}") for c in block))
    return block[: sums.index(0) + 1] if 0 in sums else ""


def test_balanced_block_against_characters(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("{}ab\n\"é") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    assert column(spark, texts, json_block_balanced) == [balanced_by_sums(t) for t in texts]


def test_strip(spark):
    texts = [WHITESPACE + "a b" + WHITESPACE, " ", "", "x​", "　é "]
    assert column(spark, texts, strip_text) == [t.strip() for t in texts]
    assert column(spark, texts + [None], is_blank) == [not t.strip() for t in texts] + [True]


def test_whitespace_is_all_of_it():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_strict_parse_hand_cases(spark):
    bad = ['{"a":1} x', "[1,]", "{'a':1}", "", "1,2", "1],[2", "],[", '"abc', '"x\\"', "01", "tru", "NaN", "{", " "]
    assert parsed(spark, bad + [None]) == [None] * (len(bad) + 1)
    good = ['{"a":1,"a":2}', ' {"b":[1,null]} ', "null", '"s"', "-1", '{"a":{}}']
    assert parsed(spark, good) == ['{"a":2}', '{"b":[1,null]}', "null", '"s"', "-1", '{"a":{}}']


def test_strict_parse_agrees_with_python_on_mutations(spark):
    base = ['{"a": [1, 2.5, "x"], "b": {"c": true, "d": null}}', '"te\\"xt"', "[[], {}, -3e2]"]
    rng = random.Random(5)
    texts = []
    for _ in range(1500):
        t = list(rng.choice(base))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(t) + 1)
            if rng.random() < 0.5 and at < len(t):
                del t[at]
            else:
                t.insert(at, rng.choice('{}[],:" 1ae\\'))
        texts.append("".join(t))

    def ok(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    assert [p is not None for p in parsed(spark, texts)] == [ok(t) for t in texts]


def flat(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return sorted(tuple(r) for r in flatten_table(df, "t").collect())


def test_flatten_shapes(spark):
    assert flat(spark, '{"d":{"x":true,"y":{"z":1}},"s":"low","l":[1],"e":{}}') == [
        (0, "d.x", "true", "boolean"),
        (0, "d.y.z", "1", "number"),
        (0, "l", "[1]", "array"),
        (0, "s", '"low"', "string"),
    ]
    assert flat(spark, "{}", "[1]", "no", '{"a":null}') == [(3, "a", "null", "null")]


def test_flatten_any_depth_and_braces_in_strings(spark):
    deep = "1"
    for i in range(40):
        deep = f'{{"k{i}":{deep}}}'
    path = ".".join(f"k{i}" for i in reversed(range(40)))
    assert flat(spark, deep) == [(0, path, "1", "number")]
    assert flat(spark, '{"a":"}}\\"{","b":{"c":{"d":2}}}') == [(0, "a", '"}}\\"{"', "string"), (0, "b.c.d", "2", "number")]
    assert flat(spark, '{"l":[{"a":{}},{"b":{"c":1}}],"m":{"n":[]}}') == [
        (0, "l", '[{"a":{}},{"b":{"c":1}}]', "array"),
        (0, "m.n", "[]", "array"),
    ]


def test_numbers_have_one_form(spark):
    assert [r[2] for r in flat(spark, '{"a":1,"b":1.0,"c":1e0,"d":0.5,"e":5e-1,"f":"1.0"}')] == [
        "1", "1", "1", "0.5", "0.5", '"1.0"',
    ]


@pytest.mark.parametrize("count,level", [(0, "low"), (2, "low"), (3, "moderate"), (5, "moderate"), (6, "high"), (10, "high")])
def test_severity(spark, count, level):
    assert spark.range(1).select(severity_bucket(F.lit(count))).first()[0] == level


def test_render_prompt_is_literal(spark):
    template = f"<{PLACEHOLDER}|{PLACEHOLDER}>"
    texts = ["a$1\\b", PLACEHOLDER]
    assert column(spark, texts, lambda t: render_prompt(template, t)) == ["<a$1\\b|a$1\\b>", f"<{PLACEHOLDER}|{PLACEHOLDER}>"]


def test_reject_empty(spark):
    df = spark.createDataFrame([(1, " a "), (2, "  "), (3, None)], "id int, narrative string")
    accepted, rejected = reject_empty(df, "[{narrative_text}]")
    assert [(r.id, r.prompt) for r in accepted.collect()] == [(1, "[a]")]
    assert sorted((r.id, r.reason) for r in rejected.collect()) == [(2, "empty_narrative"), (3, "empty_narrative")]
    _, rejected = reject_empty(df.filter("id = 1"), " ")
    assert [r.reason for r in rejected.collect()] == ["empty_prompt"]


def test_output_ladder(spark):
    df = spark.createDataFrame([(1, 'x {"b": 1, "a": [ 2 ]} y'), (2, "x {a} y"), (3, "plain"), (4, "open {")], "id int, raw_output string")
    assert {r.id: r.output for r in render_output(df).collect()} == {
        1: '{"a":[2],"b":1}', 2: "{a}", 3: "plain", 4: "open {",
    }
