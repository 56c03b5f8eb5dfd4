"""Generated pairs: bank, rates, round trips."""

import itertools

from pyspark.sql import functions as F

from extractkit.functions.draws import bernoulli, word_threshold
from extractkit.operators.evaluate import evaluate
from extractkit.operators.extract import batch_extract, phrase_extract, phrase_predictor
from extractkit.operators.generate import damage_flags, generate_pairs, narrative_lookup
from extractkit.operators.phrases import INTROS, PHRASES, phrase_table
from extractkit.operators.validate import validate_lines, validate_summary
from extractkit.schema import DAMAGE_FIELDS, NARRATIVE_FIELDS, RECORD_TYPE

# Expected marginals of the flag rates.
MARGINALS = {
    "floor_water_damage": 0.75, "carpet_damage": 0.6375, "odor_present": 0.60, "broken_plaster": 0.45,
    "mould": 0.375, "cabinet_damage": 0.30, "appliance_damage": 0.225, "ceiling_damage": 0.20,
    "electrical_damage": 0.1875, "structural_crack": 0.15,
}
SEVERITY_SHARES = {"low": 0.2645, "moderate": 0.4663, "high": 0.2692}


def ids(spark, n):
    return spark.range(n)


def test_no_phrase_contains_another():
    phrases = [p for f in PHRASES for flag in PHRASES[f] for p in PHRASES[f][flag]] + [i for i in INTROS if i]
    assert set(PHRASES) == set(DAMAGE_FIELDS) == set(NARRATIVE_FIELDS)
    assert len(phrases) == len(set(phrases)) == 146
    assert not [(a, b) for a, b in itertools.permutations(phrases, 2) if a in b]
    assert not [p for p in phrases if ". " in p.rstrip()]


def test_phrase_table(spark):
    rows = phrase_table(spark).collect()
    assert len(rows) == 141
    assert all(r.phrase == PHRASES[r.field][r.flag][r.idx] and r.n == len(PHRASES[r.field][r.flag]) for r in rows)


def test_thresholds(spark):
    assert word_threshold(0.75) == "c0000000" and word_threshold(0.25) == "40000000"
    edge = spark.range(1).select(bernoulli(F.lit("ffffffff"), 1.0), bernoulli(F.lit("00000000"), 0.0)).first()
    assert tuple(edge) == (True, False)


def test_rates(spark):
    n = 40_000
    flags = damage_flags(ids(spark, n)).cache()
    means = flags.agg(*[F.avg(F.col(f).cast("int")).alias(f) for f in DAMAGE_FIELDS]).first()
    for field, want in MARGINALS.items():
        assert abs(means[field] - want) < 0.012, field
    shares = {r.severity: r["count"] / n for r in flags.groupBy("severity").count().collect()}
    for level, want in SEVERITY_SHARES.items():
        assert abs(shares[level] - want) < 0.012, level
    wet = [f for f in DAMAGE_FIELDS if f not in ("floor_water_damage", "ceiling_damage", "structural_crack")]
    assert flags.filter(~F.col("floor_water_damage") & (sum(F.col(f).cast("int") for f in wet) > 0)).count() == 0


def test_same_rows_whatever_the_partitioning(spark):
    one = generate_pairs(ids(spark, 300).repartition(1)).orderBy("id").collect()
    many = generate_pairs(ids(spark, 300).repartition(16)).orderBy("id").collect()
    assert one == many


def test_narrative_is_its_looked_up_sentences(spark):
    pairs = generate_pairs(ids(spark, 200))
    told = {r.id: r.narrative for r in pairs.collect()}
    rows = narrative_lookup(pairs.select("id", *DAMAGE_FIELDS)).collect()
    assert len(rows) == 2000
    by_id = {}
    for r in sorted(rows, key=lambda r: (r.id, r.ord)):
        by_id.setdefault(r.id, []).append(r.phrase)
    for key, sentences in by_id.items():
        text = " ".join(sentences)
        assert told[key].endswith(text) and told[key][: -len(text)] in INTROS


def test_completion_has_record_type(spark):
    pairs = generate_pairs(ids(spark, 100))
    record = F.from_json("completion", RECORD_TYPE)
    same = [record["damage"][f] == F.col(f) for f in DAMAGE_FIELDS] + [record["overall_severity"] == F.col("severity")]
    assert pairs.filter(~F.forall(F.array(*same), lambda x: x)).count() == 0
    first = pairs.first().completion
    assert first.startswith('{"damage":{"broken_plaster":') and " " not in first


def test_generated_lines_are_valid(spark):
    lines = generate_pairs(ids(spark, 300)).select("id", F.to_json(F.struct("prompt", "completion")).alias("raw"))
    assert tuple(validate_summary(validate_lines(lines)).first()) == (0, 300, True)


def test_phrase_extract_inverts_generation(spark):
    pairs = generate_pairs(ids(spark, 400))
    read = phrase_extract(pairs.select("id", "narrative")).drop("narrative")
    told = pairs.select(*read.columns)
    assert read.exceptAll(told).count() == 0 and told.exceptAll(read).count() == 0


def test_evaluating_the_inverse_is_perfect(spark):
    pairs = generate_pairs(ids(spark, 120))
    from extractkit.operators.prompts import serialize_completion

    outputs = phrase_extract(pairs.select("id", "narrative")).select("id", serialize_completion().alias("raw_output"))
    report = evaluate(pairs, outputs, max_examples=None).collect()
    assert len(report) == 12 and all(r.correct == r.denom == 120 and r.pct == 100.0 for r in report)


def test_batch_extract_keeps_failed_rows(spark):
    df = spark.createDataFrame([(1, ""), (2, "  "), (3, PHRASES["mould"][True][0])], "id long, prompt string")
    rows = {r.id: r for r in batch_extract(df, phrase_predictor).collect()}
    assert (rows[1].raw_output, rows[1].error) == ("", "ValueError: empty prompt")
    assert (rows[2].raw_output, rows[2].error) == ("", None)
    assert '"mould":true' in rows[3].raw_output and rows[3].error is None


def test_predictor_is_built_once_per_task(spark):
    counter = spark.sparkContext.accumulator(0)

    def make():
        counter.add(1)
        return lambda prompts: [None] * len(prompts)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 90, 1, 3).select("id", F.lit("p").alias("prompt"))
        assert batch_extract(df, make).filter("raw_output = ''").count() == 90
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert counter.value == 3
