"""JSON past the reader's limits is told from texts that are no JSON."""

import json
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from extractkit.functions import jsonshape as S
from extractkit.functions import jsonvalue as J
from extractkit.operators import compare as C
from extractkit.operators import evaluate as A
from extractkit.operators.validate import validate_lines

GOLD = '{"damage":{"mould":true},"overall_severity":"low"}'
LONG = '{"a":"' + "x" * 21_000_000 + '"}'
DEEP = "[" * 1_100 + "1" + "]" * 1_100
DEEP_OBJECT = '{"a":' * 1_100 + "[1,2]" + "}" * 1_100


def is_json(text):
    def never(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=never)
    except ValueError:
        return False
    return True


def shapes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.ok for r in df.select("i", S.well_formed(F.col("t")).alias("ok")).sort("i").collect()]


HAND = ["", " ", "1", "-0", "01", "1.", "+1", "1 2", "NaN", "tru", "truefalse", '"a" "b"', '"a\nb"', '"a', '"\\x"', "\\n"]
HAND += ["1\\n5", "[]", "{}", "[,]", "[1,]", "[1,2]", "[1 ,\t2]", '{"a":1}', '{"a"}', '{"a":1,}', '{"a":1,2}', "[1:2]"]
HAND += ['["a":1]', "[}", "{]", "[[]", "[]]", '{"a":[}]', '[{"a":1},"b":2]', '{"a":{"b":1},3}', "\x01", "[\x02]", "{\x03\x02}"]
HAND += [' { "a" : [ 1 , { } ] } ', '["\\u00e9\\n\\"", "\\\\"]', '["\\u00g9"]', "﻿1", "[1]x", "{}{}", ",", '"k":1']


def test_well_formed_by_hand(spark):
    assert shapes(spark, HAND) == [is_json(t) for t in HAND]
    assert shapes(spark, [None]) == [None]


PIECES = st.sampled_from(
    ["{", "}", "[", "]", ",", ":", '"', '"a"', '"k":', "1", "-2.5e3", "true", "null", " ", "\n", "\\", '"\\""', "\x01", "k", "c"]
)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join) | st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(max_size=5),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3),
).map(json.dumps), min_size=150, max_size=200))
def test_well_formed_on_random_texts(spark, texts):
    texts = [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    assert shapes(spark, texts) == [is_json(t) for t in texts]


@pytest.mark.parametrize("depth", [1, 47, 48, 49, 61, 62, 63, 109, 110, 111, 172, 173, 5_000])
def test_nesting_of_any_depth(spark, depth):
    """Around the rounds from the inside out and the numbers of the stack."""
    lists, objects = "[" * depth + "]" * depth, '{"a":' * depth + "1" + "}" * depth
    mixed = '[{"a":' * depth + '[1,{"b":2}]' + ',"c":3},[]]' * depth
    wrong = [lists[:-1], lists + "]", lists[:-1] + "}", objects[:-1], objects[:-1] + "]", mixed[:-1] + "}"]
    wrong += ["[" * depth + '"k":1' + "]" * depth, '{"a":' * depth + '{"b":1,2}' + "}" * depth]
    assert shapes(spark, [lists, objects, mixed, *wrong]) == [True] * 3 + [False] * len(wrong)


def readings(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = J.parse_columns(df, {"v": F.col("t")})
    return [r.s for r in parsed.select("i", S.reading(F.col("t"), F.col("v")).alias("s")).sort("i").collect()]


def test_every_limit_of_the_reader(spark):
    number = "1" * S.MOST_NUMBER
    name = '{"' + "n" * S.MOST_NAME + '":1}'
    deep = "[" * (S.MOST_DEPTH - 1) + "]" * (S.MOST_DEPTH - 1)
    assert readings(spark, [number, name, deep, GOLD]) == ["json"] * 4
    past = [number + "1", name.replace("n", "nn", 1), f"[{deep}]", f"0.{number}1", LONG, DEEP, DEEP_OBJECT]
    assert readings(spark, past) == ["past_limits"] * len(past)
    bad = [number + "x", name[:-1], f"[{deep}", LONG[:-1], LONG + "x", DEEP[:-1] + "}", "x" * 60_000, "", None]
    assert readings(spark, bad) == ["not_json"] * len(bad)


def pair(prompt, completion):
    return json.dumps({"prompt": prompt, "completion": completion})


def test_validation_has_its_own_code(spark):
    lines = [
        pair("p", GOLD),
        pair("p" * 20_000_001, GOLD),
        pair("p", GOLD[:-1] + ',"x":' + DEEP + "}"),
        pair("p", DEEP_OBJECT),
        pair(" ", DEEP_OBJECT[:-1] + "]"),
        DEEP[:-1],
        DEEP,
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, raw string")
    got = {r.i: [(e.code, e.path) for e in r.errors] for r in validate_lines(df).collect()}
    assert all(code == "V10" for code, _ in got.pop(0))
    assert got == {
        1: [("V14", "")],
        2: [("V14", "completion")],
        3: [("V14", "completion")],
        4: [("V05", "prompt"), ("V06", "completion")],
        5: [("V01", "")],
        6: [("V14", "")],
    }


def test_evaluation_names_the_reason(spark):
    gold = [(0, GOLD), (1, GOLD), (2, GOLD), (3, GOLD), (4, DEEP_OBJECT), (5, "oops"), (6, "[1]"), (7, "{}")]
    found = [(0, GOLD), (1, f"x {DEEP_OBJECT} y"), (2, "none"), (4, GOLD), (5, GOLD), (6, LONG), (7, "a {} b")]
    paired = A.pair_gold_pred(
        spark.createDataFrame(gold, "id long, completion string"), spark.createDataFrame(found, "id long, raw_output string"),
        reasons=True,
    )
    got = {r.id: (r.gold_reason, r.pred_reason) for r in paired.collect()}
    assert got == {
        0: (None, None),
        1: (None, "past_limits"),
        2: (None, "not_json"),
        3: (None, "no_row"),
        4: ("past_limits", None),
        5: ("not_json", None),
        6: ("no_object", "past_limits"),
        7: ("no_object", "no_object"),
    }
    counts = {(r.side, r.reason): r.n_rows for r in A.unusable(paired).collect()}
    assert counts[("pred", "past_limits")] == 2 and counts[("gold", "no_object")] == 2 and sum(counts.values()) == 9


def test_comparison_names_the_reason(spark):
    left = [(0, GOLD), (1, DEEP_OBJECT), (2, GOLD), (3, "none"), (4, "[1]"), (5, GOLD)]
    right = [(0, GOLD), (1, GOLD), (2, DEEP_OBJECT), (3, DEEP_OBJECT), (4, GOLD)]
    sides = [spark.createDataFrame(s, "id long, raw_output string") for s in (left, right)]
    got = {r.id: r.rejected for r in C.compare_models(*sides).collect()}
    assert got == {0: None, 1: "past_limits_a", 2: "past_limits_b", 3: "no_json_a", 4: "no_json_a", 5: "no_json_b"}


def test_flattening_names_the_reason(spark):
    rows = [(0, GOLD), (1, DEEP_OBJECT), (2, "{}"), (3, "[1]"), (4, DEEP[:-1]), (5, LONG), (6, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: r.reason for r in C.flatten_rejected(df, "text").collect()}
    assert got == {1: "past_limits", 2: "no_leaves", 3: "no_json", 4: "no_json", 5: "past_limits", 6: "no_json"}


def test_structure_of_random_brackets(spark):
    draw = random.Random(3)

    def value(depth):
        if depth == 0 or draw.random() < 0.2:
            return draw.choice(["1", '"a"', "[]", "{}", "null"])
        inner = [value(depth - 1) for _ in range(draw.choice([1, 1, 1, 2, 3]))]
        if draw.random() < 0.5:
            return "[" + ", ".join(inner) + "]"
        return "{" + ",".join(f'"k{i}":{x}' for i, x in enumerate(inner)) + "}"

    texts = [value(draw.randrange(12)) for _ in range(300)]
    # chains around them, of both kinds and with members before and after, deeper than the rounds reach
    for text in texts[:40]:
        for _ in range(120):
            text = draw.choice(["[%s]", "[1,%s]", "[%s,[]]", '{"a":%s}', '{"a":1,"b":%s,"c":{}}', "[[2],%s,[[3]]]"]) % text
        texts.append(text)
    for text in list(texts):
        at = draw.randrange(len(text))
        texts.append(text[:at] + draw.choice('[]{},:1"') + text[at + draw.choice([0, 1]) :])
    texts += ["1,2", "[1],[2]", '{"a":[1,"b":2]}', '[{"a":1,2}]', "[]]", "[[]", "[}", "{]", '[[],"a":[]]', '{"a":[],[]}', ""]

    def holds(text):
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    got = {r.id: r.ok for r in df.select("id", S.well_formed(F.col("text")).alias("ok")).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != holds(t)] == []


def test_deep_chains_are_folded_by_runs(spark):
    df = spark.range(2_000).select(F.concat(F.repeat(F.lit("["), F.lit(20_000)), F.repeat(F.lit("]"), F.lit(20_000))).alias("t"))
    began = time.time()
    assert df.where(S.well_formed(F.col("t"))).count() == 2_000
    # level by level this took minutes
    assert time.time() - began < 60
