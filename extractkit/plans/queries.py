"""The registered queries: (spark, sf_dir) -> DataFrame, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.functions import draws
from extractkit.functions import jsonvalue as J
from extractkit.functions.jsonshape import reading
from extractkit.functions.severity import severity_bucket, true_count
from extractkit.functions.text import WHITESPACE, json_block_balanced, json_block_greedy, strip_text
from extractkit.operators import compare as C
from extractkit.operators import encode as E
from extractkit.operators import evaluate as A
from extractkit.operators import extract as X
from extractkit.operators import generate as G
from extractkit.operators import prompts as P
from extractkit.operators import split as S
from extractkit.operators import validate as V
from extractkit.operators.phrases import PHRASES
from extractkit.operators.student import fit_student
from extractkit.plans import inputs as I
from extractkit.schema import DAMAGE_FIELDS, REQUIRED_KEYS, SPLITS
from extractkit.session import configure, fresh_path, kept
from extractkit.sources import jsonl as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARES = {"train": 0.8, "valid": 0.1}
MISSING_SHARES = {"train": 0.8, "valid": 0.02}


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


def _joined(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda x: x.cast("string")), " ")


# --- generation ---------------------------------------------------------------------------------


@register
def bernoulli_flags(spark, sf_dir):
    """One independent draw per order at the base rate of each field."""
    ids = I.order_ids(spark, sf_dir)
    flags = [
        draws.bernoulli(draws.word(draws.digest(F.col("id"), G.SEED, f"one{i // 4}"), i % 4), r.p).alias(r.field)
        for i, r in enumerate(G.RATES)
    ]
    return ids.select("id", *flags)


@register
def pick_phrase(spark, sf_dir):
    """One uniform pick per order from each of the lists of phrases."""
    picked = []
    for i, (field, flag) in enumerate((f, b) for f in DAMAGE_FIELDS for b in (True, False)):
        options = PHRASES[field][flag]
        word = draws.word(draws.digest(F.col("id"), G.SEED, f"one{i // 4}"), i % 4)
        at = draws.pick_index(word, len(options)).cast("int") + 1
        name = f"{field}_{'stated' if flag else 'denied'}"
        picked.append(F.element_at(F.array(*[F.lit(o) for o in options]), at).alias(name))
    return I.order_ids(spark, sf_dir).select("id", *picked)


@register
def damage_flags(spark, sf_dir):
    return G.damage_flags(I.order_ids(spark, sf_dir))


@register
def true_counts(spark, sf_dir):
    return G.damage_flags(I.order_ids(spark, sf_dir)).select("id", true_count().alias("n_true"))


@register
def severity_buckets(spark, sf_dir):
    """Rows per severity and flag count."""
    counted = G.damage_flags(I.order_ids(spark, sf_dir)).select(true_count().alias("n_true"))
    return (
        counted.groupBy(severity_bucket(F.col("n_true")).alias("severity"), "n_true")
        .agg(F.count("*").alias("n_rows"))
    )


@register
def serialize_completion(spark, sf_dir):
    return G.damage_flags(I.order_ids(spark, sf_dir)).select("id", P.serialize_completion().alias("completion"))


@register
def narrative_lookup(spark, sf_dir):
    return G.narrative_lookup(G.damage_flags(I.document_ids(spark, sf_dir)))


@register
def build_narrative(spark, sf_dir):
    return G.build_narrative(G.damage_flags(I.document_ids(spark, sf_dir))).select("id", "narrative")


@register
def prefix_prompt(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), P.prefix_prompt(F.col("text")).alias("prompt"))


@register
def generate_pairs(spark, sf_dir):
    return I.order_pairs(spark, sf_dir)


# --- prompts and text ---------------------------------------------------------------------------


@register
def render_prompt(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("id"), P.render_prompt(P.PROMPT_TEMPLATE, F.col("text")).alias("prompt")
    )


@register
def strip_padded_text(spark, sf_dir):
    """Documents and conversation turns with whitespace of every kind put around them."""
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    turns = I.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "turn", "text")
    padded = F.concat(F.lit(WHITESPACE), F.col("text"), F.lit(WHITESPACE))
    return docs.union(turns).select("id", "turn", strip_text(padded).alias("stripped"))


@register
def reject_empty(spark, sf_dir):
    """Prompt status of every document, one in eight blanked out."""
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    blanked = F.when(draws.pick_index(I.fixture_word("blank"), 8) == 0, F.lit("\t \n")).otherwise(F.col("text"))
    checked = P.with_prompt_status(docs.select("id", blanked.alias("narrative")), P.PROMPT_TEMPLATE)
    return checked.select("id", "reason", F.when(F.col("reason").isNull(), F.col("prompt")).alias("prompt"))


@register
def json_blocks_greedy(spark, sf_dir):
    outputs = I.model_outputs(I.pairs(spark, sf_dir), "a")
    return outputs.select("id", json_block_greedy(F.col("raw_output")).alias("block"))


@register
def json_blocks_balanced(spark, sf_dir):
    outputs = I.model_outputs(I.pairs(spark, sf_dir), "a")
    return outputs.select("id", json_block_balanced(F.col("raw_output")).alias("block"))


@register
def safe_parse(spark, sf_dir):
    """Whether each greedy block parses, and its severity."""
    outputs = I.model_outputs(I.pairs(spark, sf_dir), "a")
    blocks = outputs.select("id", json_block_greedy(F.col("raw_output")).alias("block"))
    parsed = J.parse_columns(blocks, {"value": F.col("block")})
    return parsed.select(
        "id",
        F.col("value").isNotNull().alias("ok"),
        F.try_variant_get("value", "$.overall_severity", "string").alias("severity"),
    )


@register
def render_output(spark, sf_dir):
    """What is shown for each raw output; objects as canonical JSON, keys sorted."""
    return P.render_output(I.model_outputs(I.pairs(spark, sf_dir), "a")).select("id", "output")


@register
def json_flatten(spark, sf_dir):
    return C.flatten_table(I.event_records(spark, sf_dir), "record")


@register
def json_limits(spark, sf_dir):
    """Which texts are JSON, which are not, and which are JSON past the reader's limits."""
    parsed = J.parse_columns(I.sized_texts(spark, sf_dir), {"value": F.col("record")})
    return parsed.select("id", reading(F.col("record"), F.col("value")).alias("status"))


@register
def flatten_rejected(spark, sf_dir):
    return C.flatten_rejected(I.sized_texts(spark, sf_dir), "record")


@register
def missing_keys(spark, sf_dir):
    """Required keys missing from each line; null where the line is not a JSON object."""
    lines = J.parse_columns(I.bad_lines(I.pairs(spark, sf_dir)), {"value": strip_text(F.col("raw"))})
    return V.missing_keys(lines, "value", REQUIRED_KEYS).select(
        "id", F.when(J.is_object_text(F.col("value"), strip_text(F.col("raw"))), F.array_join("missing", "|")).alias("missing")
    )


# --- files --------------------------------------------------------------------------------------


def _written_lines(spark: SparkSession, lines: DataFrame, label: str) -> str:
    """The path of a fresh text folder holding the lines in id order, file after file."""
    path = fresh_path(spark, label)
    lines.repartitionByRange("id").sortWithinPartitions("id").select("raw").write.text(path)
    return path


@register
def load_jsonl(spark, sf_dir):
    path = _written_lines(spark, I.spaced_lines(I.pairs(spark, sf_dir)), "lines")
    return L.load_jsonl(spark, path)


@register
def numbered_scan(spark, sf_dir):
    path = _written_lines(spark, I.bad_lines(I.pairs(spark, sf_dir)), "numbered")
    return L.numbered_scan(spark, path, per_file=False).select("line_no", "raw", "non_blank")


@register
def first_lines(spark, sf_dir):
    """The first hundred lines of a folder that aren't blank, in the order of files and lines."""
    path = _written_lines(spark, I.spaced_lines(I.pairs(spark, sf_dir)), "lines")
    return L.first_lines(spark, path, A.MAX_EXAMPLES)


@register
def validate_file(spark, sf_dir):
    """Every error in a folder of lines, by line number."""
    path = _written_lines(spark, I.bad_lines(I.order_pairs(spark, sf_dir)), "checked")
    return V.validate_file(spark, path, per_file=False).select("line_no", "code", "path")


@register
def prompt_files(spark, sf_dir):
    """Narratives in files of their own, some blank, asked with a template from a file."""
    path = fresh_path(spark, "job")
    spark.createDataFrame([(P.PROMPT_TEMPLATE,)], "value string").coalesce(1).write.text(f"{path}/template")
    blanked = F.when(draws.pick_index(I.fixture_word("blank"), 8) == 0, F.lit(" \t ")).otherwise(F.col("narrative"))
    texts = I.pairs(spark, sf_dir).select("id", blanked.alias("value"))
    I.write_apart(texts, f"{path}/narratives")
    answered, rejected = X.prompt_files(
        spark, f"{path}/template", f"{path}/narratives", X.phrase_predictor, f"{path}/checked"
    )
    number = F.regexp_extract("file", r"/id=(-?\d+)/", 1).cast("bigint").alias("id")
    return answered.select(number, F.lit(None).cast("string").alias("reason"), "output").unionByName(
        rejected.select(number, "reason", F.lit(None).cast("string").alias("output"))
    )


@register
def jsonl_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "pairs")
    L.write_jsonl(I.pairs(spark, sf_dir), path)
    return L.load_jsonl(spark, path)


@register
def split_files(spark, sf_dir):
    """The three split folders, written and read back; the line number is the split position."""
    path = fresh_path(spark, "splits")
    L.write_splits(S.split_exact(I.pairs(spark, sf_dir), **SHARES), path)
    parts = [L.read_split(spark, path, s).withColumn("split", F.lit(s)) for s in SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- splits and gates ---------------------------------------------------------------------------


@register
def split_exact(spark, sf_dir):
    return S.split_exact(I.order_ids(spark, sf_dir), **SHARES)


@register
def assign_splits(spark, sf_dir):
    return S.assign_splits(I.order_ids(spark, sf_dir), **SHARES)


@register
def split_counts(spark, sf_dir):
    return S.split_counts(S.assign_splits(I.order_ids(spark, sf_dir), **SHARES))


@register
def missing_splits(spark, sf_dir):
    """Splits each document source has no row in."""
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    return S.missing_splits(S.assign_splits(docs, **MISSING_SHARES), "source")


@register
def count_gate(spark, sf_dir):
    return S.count_gate(I.document_ids(spark, sf_dir), S.TRAIN_SIZE + S.VALID_SIZE + S.TEST_SIZE)


@register
def first_n(spark, sf_dir):
    """The test rows an evaluation run would take: the first hundred by position."""
    rows = S.split_exact(I.order_ids(spark, sf_dir), **SHARES).filter(F.col("split") == "test")
    return S.first_n(rows, A.MAX_EXAMPLES).select("id", "pos")


# --- validation ---------------------------------------------------------------------------------


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.validate_lines(I.bad_lines(I.order_pairs(spark, sf_dir)))


@register
def validate_lines(spark, sf_dir):
    return _validated(spark, sf_dir).select("id", V.errors_text(F.col("errors")).alias("errors"), "non_blank")


@register
def validate_summary(spark, sf_dir):
    return V.validate_summary(_validated(spark, sf_dir))


@register
def validate_by_code(spark, sf_dir):
    return V.validate_by_code(_validated(spark, sf_dir))


# --- extraction and evaluation ------------------------------------------------------------------


@register
def batch_extract(spark, sf_dir):
    """A deterministic predictor over every prompt, some emptied or blanked first."""
    form = draws.pick_index(I.fixture_word("call"), 32)
    prompts = I.pairs(spark, sf_dir).select(
        "id", F.when(form == 0, "").when(form == 1, "  ").otherwise(F.col("prompt")).alias("prompt")
    )
    return X.batch_extract(prompts, X.phrase_predictor)


@register
def evaluate_predictor(spark, sf_dir):
    """A predictor asked for every prompt with usable gold, and scored over all of them."""
    pairs = I.pairs(spark, sf_dir)
    rows = pairs.select("id", "prompt").join(I.gold(pairs), "id")
    return X.predict_and_score(rows, X.phrase_predictor, fresh_path(spark, "replies"), waves=2)


@register
def phrase_extract(spark, sf_dir):
    return X.phrase_extract(I.pairs(spark, sf_dir).select("id", "narrative")).drop("narrative")


def _paired(spark: SparkSession, sf_dir: str, reasons: bool = False) -> DataFrame:
    pairs = I.pairs(spark, sf_dir)
    return A.pair_gold_pred(I.gold(pairs), I.model_outputs(pairs, "a"), reasons=reasons)


@register
def pair_gold_pred(spark, sf_dir):
    severity = "$.overall_severity"
    return _paired(spark, sf_dir).select(
        "id",
        "gold_ok",
        "pred_ok",
        F.when(F.col("gold_ok"), F.try_variant_get("gold", severity, "string")).alias("gold_severity"),
        F.when(F.col("pred_ok"), F.try_variant_get("pred", severity, "string")).alias("pred_severity"),
    )


@register
def eval_unusable(spark, sf_dir):
    """Why gold and predicted texts can't be scored."""
    return A.unusable(_paired(spark, sf_dir, reasons=True))


@register
def eval_report(spark, sf_dir):
    pairs = I.pairs(spark, sf_dir)
    return A.evaluate(I.gold(pairs), I.model_outputs(pairs, "a"), max_examples=None)


def _metric(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    return A.evaluate_pairs(_paired(spark, sf_dir)).filter(F.col("metric") == metric).drop("metric")


@register
def eval_validity(spark, sf_dir):
    return _metric(spark, sf_dir, "validity")


@register
def eval_fields(spark, sf_dir):
    return _metric(spark, sf_dir, "field_accuracy")


@register
def eval_severity(spark, sf_dir):
    return _metric(spark, sf_dir, "severity_accuracy")


def _student(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Test rows and what a student fitted on the train rows predicts for them."""
    pairs = I.pairs(spark, sf_dir).select("id", "prompt", "completion")
    rows = kept(S.split_exact(pairs, **SHARES), "split")
    student = fit_student(rows.filter(F.col("split") == "train"))
    test = rows.filter(F.col("split") == "test")
    return test, student.predict(test)


@register
def student_predict(spark, sf_dir):
    """The record a fitted student gives for each test prompt."""
    return _student(spark, sf_dir)[1]


@register
def student_eval(spark, sf_dir):
    """Fit on the train split, predict the test split, score it."""
    return A.evaluate(*_student(spark, sf_dir))


# --- comparison ---------------------------------------------------------------------------------


def _outputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pairs = I.pairs(spark, sf_dir)
    return I.model_outputs(pairs, "a"), I.model_outputs(pairs, "b")


@register
def path_union(spark, sf_dir):
    return C.path_union(*_outputs(spark, sf_dir))


@register
def compare_paths(spark, sf_dir):
    return C.compare_paths(*_outputs(spark, sf_dir))


@register
def compare_summary(spark, sf_dir):
    return C.compare_summary(C.compare_models(*_outputs(spark, sf_dir)))


@register
def compare_mismatches(spark, sf_dir):
    return C.compare_mismatches(C.compare_paths(*_outputs(spark, sf_dir)))


@register
def compare_models(spark, sf_dir):
    return C.compare_models(*_outputs(spark, sf_dir))


@register
def model_agreement(spark, sf_dir):
    return C.model_agreement(C.compare_models(*_outputs(spark, sf_dir)))


# --- encoding -----------------------------------------------------------------------------------


@register
def encode_tokens(spark, sf_dir):
    encoded = E.encode_tokens(I.text_pairs(spark, sf_dir))
    return encoded.select("id", F.col("prompt_len").cast("bigint").alias("prompt_len"), _joined(F.col("ids")).alias("ids"))


@register
def encode_with(spark, sf_dir):
    """The same by a tokenizer outside Spark, batch by batch."""
    encoded = E.encode_batches(I.text_pairs(spark, sf_dir), E.word_tokenizer)
    return encoded.select("id", F.col("prompt_len").cast("bigint").alias("prompt_len"), _joined(F.col("ids")).alias("ids"))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.encode_pairs(I.text_pairs(spark, sf_dir))


@register
def pad_mask(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "id",
        _joined(F.col("input_ids")).alias("input_ids"),
        _joined(F.col("attention_mask")).alias("attention_mask"),
    )


@register
def label_mask(spark, sf_dir):
    return _encoded(spark, sf_dir).select("id", _joined(F.col("labels")).alias("labels"))


@register
def all_masked(spark, sf_dir):
    return E.all_masked(_encoded(spark, sf_dir)).select("id")


