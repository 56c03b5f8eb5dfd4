"""The closed-form student against plain Python, and its edges."""

import hashlib
import json
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from extractkit.operators import student as ST
from extractkit.schema import DAMAGE_FIELDS, SEVERITIES, SEVERITY_FIELD

WIDTH = 64


def features(prompt):
    words = re.findall(ST.WORD, (prompt or "").lower())
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
    return {int(hashlib.md5(p.encode()).hexdigest()[:7], 16) % WIDTH for p in pairs}


def scaled(x):
    return math.floor(math.log(x) * ST.SCALE + 0.5)


def fitted(rows):
    """Scores of one output and class for a set of features: log prior and log shares, rounded one by one."""
    records = [(features(p), r) for p, r in rows]

    def side(test):
        chosen = [f for f, r in records if test(r)]
        seen = Counter(b for f in chosen for b in f)
        has = [scaled((seen[b] + 1) / (len(chosen) + 2)) for b in range(WIDTH)]
        lacks = [scaled(1 - (seen[b] + 1) / (len(chosen) + 2)) for b in range(WIDTH)]
        return len(chosen), has, lacks

    def score(test, classes, asked):
        n, has, lacks = side(test)
        return scaled((n + 1) / (len(records) + classes)) + sum(has[b] if b in asked else lacks[b] for b in range(WIDTH))

    def predict(prompt):
        asked = features(prompt)
        damage = {
            f: score(lambda r: r["damage"][f], 2, asked) > score(lambda r: not r["damage"][f], 2, asked)
            for f in DAMAGE_FIELDS
        }
        by = [score(lambda r, s=s: r[SEVERITY_FIELD] == s, len(SEVERITIES), asked) for s in SEVERITIES]
        return {"damage": damage, SEVERITY_FIELD: SEVERITIES[by.index(max(by))]}

    return predict


def examples(n, seed):
    draw = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(30)]
    out = []
    for _ in range(n):
        prompt = " ".join(draw.choice(words, int(draw.integers(0, 25))))
        damage = {f: bool(draw.random() < 0.2 + 0.6 * (words[i] in prompt.split())) for i, f in enumerate(DAMAGE_FIELDS)}
        out.append((prompt, {"damage": damage, SEVERITY_FIELD: SEVERITIES[sum(damage.values()) % 3]}))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, prompt string, completion string, bucket int, n long, all string")


def test_predictions_equal_plain_sums(spark):
    train, test = examples(120, 1), examples(40, 2)
    left_out = ["oops", "{}", None, '{"damage":{"mould":true},"overall_severity":"low"}']
    left_out.append(json.dumps(train[0][1] | {SEVERITY_FIELD: "severe"}))
    left_out.append(json.dumps({"damage": dict.fromkeys(DAMAGE_FIELDS, 1), SEVERITY_FIELD: "low"}))
    rows = [(i, p, json.dumps(r), 1, 2, "x") for i, (p, r) in enumerate(train)]
    rows += [(1000 + i, train[i][0], c, 1, 2, "x") for i, c in enumerate(left_out)]
    student = ST.fit_student(frame(spark, rows).repartition(3), WIDTH)
    assert student.model.count() == WIDTH + 1
    asked = [*(p for p, _ in test), None, "", "one", "new words only", train[0][0] + " É́"]
    got = student.predict(frame(spark, [(i, p, None, 1, 2, "x") for i, p in enumerate(asked)]))
    want = fitted(train)
    assert {r.id: json.loads(r.raw_output) for r in got.collect()} == {i: want(p) for i, p in enumerate(asked)}


def test_nothing_to_learn_from(spark):
    """Without usable rows no flag outweighs the other side, and the first severity holds."""
    student = ST.fit_student(frame(spark, [(1, "a b", "oops", 1, 2, "x")]), WIDTH)
    got = student.predict(frame(spark, [(1, "a b c", None, 1, 2, "x")])).collect()
    record = json.loads(got[0].raw_output)
    assert not any(record["damage"].values()) and record[SEVERITY_FIELD] == SEVERITIES[0]
    assert student.predict(frame(spark, [])).count() == 0


def test_repeats_of_a_pair_count_once(spark):
    df = spark.createDataFrame([("a b a b A B",), ("x",), (None,)], "prompt string")
    got = [sorted(r.b) for r in df.select(ST.buckets(F.col("prompt"), WIDTH).alias("b")).collect()]
    assert got == [sorted(features("a b a b")), [], []]
