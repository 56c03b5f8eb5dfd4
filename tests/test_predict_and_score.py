"""The predictor job: what is asked, how often, and what is scored; tokenizers called batch by batch."""

import json
import os
from collections import Counter

import pytest

from extractkit.operators import evaluate as A
from extractkit.operators import extract as X
from extractkit.operators import encode
from extractkit.operators.encode import encode_batches, encode_tokens, word_tokenizer

GOLD = '{"damage":{"mould":true},"overall_severity":"low"}'


def recording(folder, fails_at=None):
    """A predictor that notes every prompt it is asked; it kills its worker at one of them while a mark is there."""

    def make():
        def predict(prompts):
            if fails_at in prompts and os.path.exists(f"{folder}/broken"):
                os._exit(1)
            with open(f"{folder}/calls-{os.getpid()}", "a") as out:
                out.writelines(json.dumps(p) + "\n" for p in prompts)
            if "bad" in prompts:
                raise ValueError("bad prompt")
            return [None if p == "" else f"said {p}: {GOLD}" for p in prompts]

        return predict

    return make


def calls(folder):
    found = Counter()
    for name in os.listdir(folder):
        if name.startswith("calls-"):
            with open(f"{folder}/{name}") as lines:
                found.update(map(json.loads, lines))
    return found


def test_each_prompt_is_asked_once(spark, tmp_path):
    rows = [(i, f"p{i % 40}", 1) for i in range(200)] + [(500, None, 1), (501, "", 1), (501, "", 1), (None, "p1", 1)]
    df = spark.createDataFrame(rows, "id long, prompt string, prompt_key int").repartition(4)
    log = str(tmp_path / "log")
    got = X.extract_logged(df, recording(str(tmp_path)), log, waves=3).collect()
    assert len(got) == 204
    assert {(r.id, r.raw_output) for r in got} == {(i, f"said {p}: {GOLD}" if p else "") for i, p, _ in rows}
    assert calls(tmp_path) == Counter({f"p{i}": 1 for i in range(40)} | {"": 1})
    again = X.extract_logged(df, recording(str(tmp_path)), log, waves=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert calls(tmp_path) == Counter({f"p{i}": 1 for i in range(40)} | {"": 1})
    assert X.extract_logged(df.limit(0), recording(str(tmp_path)), log).count() == 0


def test_a_lost_worker_does_not_ask_again(spark, tmp_path):
    """The job dies in some wave; run again, it asks what the log lacks and nothing else."""
    df = spark.createDataFrame([(i, f"p{i}") for i in range(120)], "id long, prompt string").repartition(4)
    (tmp_path / "broken").write_text("")
    log = str(tmp_path / "log")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark makes of a dead worker
        X.extract_logged(df, recording(str(tmp_path), "p77"), log, waves=6).collect()
    (tmp_path / "broken").unlink()
    written = {r.raw_output.split(":")[0][5:] for r in spark.read.parquet(f"{log}/*").collect()}
    assert 0 < len(written) < 120
    before = calls(tmp_path)
    got = X.extract_logged(df, recording(str(tmp_path), "p77"), log, waves=6).collect()
    assert {(r.id, r.raw_output) for r in got} == {(i, f"said p{i}: {GOLD}") for i in range(120)}
    after = calls(tmp_path)
    assert set(after) == {f"p{i}" for i in range(120)}
    assert all(after[p] == before[p] == 1 for p in written)


def test_failed_prompts_keep_their_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "bad"), (2, "good"), (3, "bad")], "id long, prompt string")
    log = str(tmp_path / "log")
    for _ in range(2):
        got = {r.id: (r.raw_output, r.error) for r in X.extract_logged(df, recording(str(tmp_path)), log).collect()}
        assert got[1] == got[3] == ("", "ValueError: bad prompt") and got[2][1] is None
    assert calls(tmp_path)["good"] <= 2


def test_unusable_gold_is_never_asked(spark, tmp_path):
    rows = [(1, "a", GOLD), (2, "b", "oops"), (3, "c", "{}"), (4, "d", "[1]"), (5, "e", None), (6, "f", GOLD)]
    gold = spark.createDataFrame(rows, "id long, prompt string, completion string")
    report = X.predict_and_score(gold, recording(str(tmp_path)), str(tmp_path / "log")).collect()
    assert set(calls(tmp_path)) == {"a", "f"}
    by = {r.field: (r.correct, r.denom) for r in report}
    assert by["json"] == (2, 6) and by["mould"] == (2, 2) and by["overall_severity"] == (2, 2)
    plain = gold.selectExpr("id", f"'{GOLD}' AS raw_output")
    assert sorted(map(tuple, report)) == sorted(map(tuple, A.evaluate(gold, plain).collect()))


def test_own_tokenizer_equals_the_built_in(spark):
    texts = [("a b", "c"), ("ab", "cd e"), ("", ""), (None, "x y"), ("É́ ß", None), ("w " * 900, "end")]
    rows = [(i, *t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, prompt string, completion string, ids int").repartition(2)
    got = {r.id: (r.ids, r.prompt_len) for r in encode_batches(df, word_tokenizer).collect()}
    want = {r.id: (r.ids, r.prompt_len) for r in encode_tokens(df.fillna("")).collect()}
    assert got == want and len(got[5][0]) == 512
    assert encode_batches(df.limit(0), word_tokenizer).count() == 0


def test_tokenizer_is_called_once_a_batch(spark, tmp_path):
    def make():
        def tokenize(texts):
            with open(tmp_path / "calls", "a") as out:
                out.write(f"{len(texts)}\n")
            return [[1] * len(t) for t in texts]

        return tokenize

    df = spark.range(2_500).selectExpr("id", "'ab' AS prompt", "'c' AS completion").coalesce(1)
    assert encode_batches(df, make).where("size(ids) = 3 and prompt_len = 2").count() == 2_500
    assert len((tmp_path / "calls").read_text().split()) == 1
    with pytest.raises(Exception, match="lists of ids"):
        encode_batches(df, lambda: lambda texts: [[]]).collect()


def test_a_call_of_the_tokenizer_has_bounded_text(spark, tmp_path):
    def make():
        def tokenize(texts):
            with open(tmp_path / "calls", "a") as out:
                out.write(f"{sum(map(len, texts))}\n")
            return [[len(t)] * len(t) for t in texts]

        return tokenize

    long = "repeat('ab', 20000)"
    df = spark.range(300).selectExpr("id", f"if(id = 7, null, {long}) AS prompt", "'c' AS completion").coalesce(1)
    got = encode_batches(df, make).where("prompt_len = 512 and size(ids) = 512 and ids[0] = 40001")
    assert got.count() == 299
    calls = [int(x) for x in (tmp_path / "calls").read_text().split()]
    # a batch of all 300 rows would be 24 MB in one call
    assert max(calls) <= encode.CALL_BYTES + 80_001 and sum(calls) == 299 * 80_001 + 1
