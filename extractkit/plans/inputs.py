"""Inputs for the registered queries, derived by Spark from the given tables.

The tables hold no labelled narratives, so labelled pairs, damaged lines and model outputs are
derived from table keys with md5 draws; real text comes from ``documents``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.functions import draws
from extractkit.operators.generate import damage_flags, generate_pairs
from extractkit.operators.prompts import prefix_prompt, serialize_completion
from extractkit.schema import DAMAGE_FIELDS, SEVERITIES, SEVERITY_FIELD
from extractkit.session import spread

FIXTURE_SEED = 7
DEFECTS = 16
FLIP_RATE = 0.05
SEVERITY_RATE = 0.10

# Upper bounds of the share of model outputs in each form; the rest is a plain wrapped record.
OUTPUT_FORMS = (
    ("cut", 0.03),
    ("prose", 0.04),
    ("key_missing", 0.05),
    ("two_blocks", 0.08),
    ("null_severity", 0.10),
    ("empty_object", 0.12),
    ("no_row", 0.14),
    ("extra_keys", 0.20),
)
EXTRA_KEYS = ',"notes":{"by":"m","tags":["x",1],"none":{},"deep":{"er":1,"e":null}}}'

# Upper bounds of the share of gold completions in each defective form.
GOLD_FORMS = (("{}", 0.01), ("oops", 0.02), ("[1]", 0.03))


# A generated pair is about a kilobyte.
PAIRS_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan.select(*columns)) if columns else scan


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_pairs(spread(document_ids(spark, sf_dir), PAIRS_PER_TASK))


def order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_pairs(spread(order_ids(spark, sf_dir), PAIRS_PER_TASK))


def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, prompt around the document's whole text, generated completion."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    return damage_flags(docs).select(
        "id", prefix_prompt(F.col("text")).alias("prompt"), serialize_completion().alias("completion")
    )


def fixture_word(stream: str, slot: int = 0) -> Column:
    return draws.word(draws.digest(F.col("id"), FIXTURE_SEED, stream), slot)


def json_string(text: Column) -> Column:
    """The text as a JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("s"))), r'(?s)^\{"s":(.*)\}$', 1)


def pair_line(prompt: Column, completion: Column) -> Column:
    return F.to_json(F.struct(prompt.alias("prompt"), completion.alias("completion")))


def bad_lines(df: DataFrame) -> DataFrame:
    """id, raw: one JSON line per pair, fifteen sixteenths of them damaged in one of many ways."""
    prompt, done = F.col("prompt"), F.col("completion")
    line = pair_line(prompt, done)
    severity_text = F.concat(F.lit(f',"{SEVERITY_FIELD}":"'), F.col("severity"), F.lit('"'))
    flag_broken = done
    for old, new in (
        ('"mould":true,', ""),
        ('"mould":false,', ""),
        ('"odor_present":true', '"odor_present":"true"'),
        ('"odor_present":false', '"odor_present":0'),
    ):
        flag_broken = F.replace(flag_broken, F.lit(old), F.lit(new))
    no_severity = F.replace(done, severity_text, F.lit(""))
    bad_severity = F.replace(done, severity_text, F.lit(f',"{SEVERITY_FIELD}":"severe"'))
    p, c = json_string(prompt), json_string(done)
    damaged = [
        F.concat(F.lit(" "), line, F.lit("\t")),
        F.lit("  \t"),
        F.substring(line, 1, F.length(line) - 1),
        F.concat(F.lit("["), line, F.lit("]")),
        F.concat(F.lit('{"completion":'), c, F.lit("}")),
        F.concat(F.lit('{"prompt":'), p, F.lit("}")),
        F.concat(F.lit('{"prompt":17,"completion":'), c, F.lit("}")),
        F.concat(F.lit('{"prompt":'), p, F.lit(',"completion":null}')),
        pair_line(F.lit(" "), done),
        pair_line(prompt, F.lit("  ")),
        pair_line(prompt, F.substring(done, 2, F.length(done))),
        pair_line(prompt, F.concat(F.lit("["), done, F.lit("]"))),
        pair_line(prompt, F.lit(f'{{"{SEVERITY_FIELD}":"low"}}')),
        pair_line(prompt, F.lit(f'{{"damage":[],"{SEVERITY_FIELD}":null}}')),
        pair_line(prompt, flag_broken),
        pair_line(prompt, F.when(F.col("id") % 2 == 0, no_severity).otherwise(bad_severity)),
    ]
    defect = F.col("__defect")
    raw = F.when(defect == 0, damaged[0])
    for number in range(1, DEFECTS):
        raw = raw.when(defect == number, damaged[number])
    return df.withColumn("__defect", draws.pick_index(fixture_word("defect"), DEFECTS)).select(
        "id", raw.alias("raw")
    )


def spaced_lines(df: DataFrame) -> DataFrame:
    """id, raw: good lines, some set off by spaces, and one in eight replaced by blanks."""
    line = pair_line(F.col("prompt"), F.col("completion"))
    form = draws.pick_index(fixture_word("space"), 8)
    return df.select(
        "id",
        F.when(form == 0, F.lit(" \t ")).when(form == 1, F.concat(F.lit("  "), line, F.lit(" "))).otherwise(line)
        .alias("raw"),
    )


def gold(df: DataFrame) -> DataFrame:
    """id, completion: some gold completions are unusable."""
    word = fixture_word("gold")
    completion = None
    for text, bound in GOLD_FORMS:
        below = word < F.lit(draws.word_threshold(bound))
        completion = F.when(below, text) if completion is None else completion.when(below, text)
    return df.select("id", completion.otherwise(F.col("completion")).alias("completion"))


def model_outputs(df: DataFrame, model: str) -> DataFrame:
    """id, raw_output: completions with flags flipped and severity changed, in varied wrapping."""
    digests = {f"__m{i}": draws.digest(F.col("id"), FIXTURE_SEED, f"{model}{i}") for i in range(3)}

    def word(i: int) -> Column:
        return draws.word(F.col(f"__m{i // 4}"), i % 4)

    flipped = {f: F.col(f) != draws.bernoulli(word(i), FLIP_RATE) for i, f in enumerate(DAMAGE_FIELDS)}
    turned = (
        F.when(F.col("severity") == SEVERITIES[0], SEVERITIES[1])
        .when(F.col("severity") == SEVERITIES[1], SEVERITIES[2])
        .otherwise(SEVERITIES[0])
    )
    severity = F.when(draws.bernoulli(word(10), SEVERITY_RATE), turned).otherwise(F.col("severity"))
    bounds = dict(OUTPUT_FORMS)
    lowest = max(b for b in bounds.values() if b < bounds["no_row"])
    answered = (word(11) < F.lit(draws.word_threshold(lowest))) | (
        word(11) >= F.lit(draws.word_threshold(bounds["no_row"]))
    )
    out = df.withColumns(digests).filter(answered).withColumns({**flipped, "severity": severity})
    out = out.withColumn("__body", serialize_completion())
    body = F.col("__body")
    quoted = F.concat(F.lit('"'), F.col("severity"), F.lit('"}'))
    no_mould = F.replace(F.replace(body, F.lit('"mould":true,'), F.lit("")), F.lit('"mould":false,'), F.lit(""))
    forms = {
        "cut": F.concat(F.lit("Answer: "), F.substring(body, 1, F.length(body) - 1)),
        "prose": F.lit("I can not tell."),
        "key_missing": F.concat(F.lit("Answer: "), no_mould, F.lit(" done.")),
        "two_blocks": F.concat(F.lit("Answer: "), body, F.lit(" or {maybe} done.")),
        "null_severity": F.concat(F.lit("Answer: "), F.replace(body, quoted, F.lit("null}"))),
        "empty_object": F.lit("Answer: {} done."),
        "no_row": F.lit(None).cast("string"),
        "extra_keys": F.concat(F.substring(body, 1, F.length(body) - 1), F.lit(EXTRA_KEYS)),
    }
    raw = None
    for name, bound in OUTPUT_FORMS:
        below = word(11) < F.lit(draws.word_threshold(bound))
        raw = F.when(below, forms[name]) if raw is None else raw.when(below, forms[name])
    plain = F.concat(F.lit("Answer: "), body, F.lit(" done."))
    return out.select("id", raw.otherwise(plain).alias("raw_output"))


def write_apart(texts: DataFrame, path: str) -> None:
    """The texts (id, value) in files of their own, ``path/id=<id>/``; an id's in one task are lines of one file.

    As ``partitionBy("id")`` does it, which on a file system of the machine starts four processes for each file to set
    its rights and that of its checksum; there the tasks open the files themselves, in a new folder that all share.
    """
    spark = texts.sparkSession
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = named.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.getScheme() != "file":
        texts.write.partitionBy("id").text(path)
        return
    files.mkdirs(named)
    root = files.makeQualified(named).toUri().getPath()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out, final, at, n = None, "", None, 0

        def close() -> None:
            # a task run again puts the same file in the place
            if out is not None:
                out.close()
                os.replace(out.name, final)

        for batch in batches:
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None or id_ != at:
                    close()
                    folder = f"{root}/id={'__HIVE_DEFAULT_PARTITION__' if id_ is None else id_}"
                    os.makedirs(folder, exist_ok=True)
                    final, at = f"{folder}/part-{task.partitionId():05}.txt", id_
                    out = open(f"{folder}/.{task.taskAttemptId()}", "wb")
                out.write((value or "").encode() + b"\n")
                n += 1
        close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    sorted_ = texts.select("id", "value").sortWithinPartitions("id")
    sorted_.mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


#: Forms of ``sized_texts``; levels and digits beyond what the JSON reader takes.
SIZED_FORMS = 5
DEEP, DIGITS = 1_100, 1_200


def sized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, form, record: documents as JSON that is fine (0), cut (1), too deep (2), too deep and wrongly
    closed (3), or next to a number that is too long (4)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    value = json_string(F.coalesce("text", F.lit("")))
    opened, closed = F.repeat(F.lit("["), F.lit(DEEP)), F.repeat(F.lit("]"), F.lit(DEEP - 1))
    whole = F.concat(F.lit('{"text":'), value, F.lit("}"))
    form = F.pmod("doc_id", F.lit(SIZED_FORMS))
    record = (
        F.when(form == 0, whole)
        .when(form == 1, F.substring(whole, 1, F.length(whole) - 1))
        .when(form == 2, F.concat(opened, value, closed, F.lit("]")))
        .when(form == 3, F.concat(opened, value, closed, F.lit("}")))
        .otherwise(F.concat(F.lit('{"n":1'), F.repeat(F.lit("0"), F.lit(DIGITS)), F.lit(',"text":'), value, F.lit("}")))
    )
    return docs.select(F.col("doc_id").alias("id"), form.alias("form"), record.alias("record"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, record: one nested JSON object per event."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "props")
    record = F.concat(
        F.lit('{"id":'),
        F.col("event_id").cast("string"),
        F.lit(',"kind":'),
        json_string(F.col("event_type")),
        F.lit(',"props":'),
        F.col("props"),
        F.lit(',"none":{},"list":[1,{"x":2}],"nil":null,"user":{"ids":{"main":'),
        F.col("user_id").cast("string"),
        F.lit(',"other":{}}}}'),
    )
    return events.select(F.col("event_id").alias("id"), record.alias("record"))
