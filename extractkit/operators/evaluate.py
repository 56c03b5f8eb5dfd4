"""Score raw model output against gold completions: validity, per-field and severity accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.functions.jsonshape import reading
from extractkit.functions.text import json_block_greedy
from extractkit.operators.split import first_n
from extractkit.schema import DAMAGE_FIELDS, SEVERITY_FIELD

# Rows evaluated by a full and by a quick run.
MAX_EXAMPLES = 100


def parse_gold(gold: DataFrame, key: str = "id", reasons: bool = False) -> DataFrame:
    """key, gold (VARIANT), gold_ok: parses, and is a non-empty object. With reasons: gold_reason where it isn't."""
    return _parsed(gold.select(key, F.coalesce("completion", F.lit("")).alias("__text")), key, "gold", reasons)


def parse_predictions(predictions: DataFrame, key: str = "id", reasons: bool = False) -> DataFrame:
    """key, pred (VARIANT), pred_ok, from the greedy JSON block of ``raw_output``; pred_reason as for gold."""
    block = json_block_greedy(F.coalesce("raw_output", F.lit("")))
    return _parsed(predictions.select(key, block.alias("__text")), key, "pred", reasons)


def _parsed(texts: DataFrame, key: str, name: str, reasons: bool) -> DataFrame:
    text = F.col("__text")
    usable = J.is_object_text(F.col(name), text) & ~J.is_empty_object_text(text)
    parsed = J.parse_columns(texts, {name: text})
    columns = [F.col(key), F.col(name), usable.alias(f"{name}_ok")]
    if reasons:
        found = reading(text, F.col(name))
        reason = F.when(~usable, F.when(found == "json", "no_object").otherwise(found))
        columns.append(reason.alias(f"{name}_reason"))
    return parsed.select(*columns)


def pair_gold_pred(gold: DataFrame, predictions: DataFrame, key: str = "id", reasons: bool = False) -> DataFrame:
    """Every gold row with its prediction, if any: gold, gold_ok, pred, pred_ok.

    With ``reasons`` also gold_reason and pred_reason, which cost a larger plan. A reason says why a side can't be scored: not_json, past_limits (JSON too large or deep to read),
    no_object (also the empty object), no_row; null where it can.
    """
    predicted = parse_predictions(predictions, key, reasons)
    if not reasons:
        paired = parse_gold(gold, key).join(predicted, key, "left")
        return paired.withColumn("pred_ok", F.coalesce("pred_ok", F.lit(False)))
    paired = parse_gold(gold, key, reasons).join(predicted.withColumn("__there", F.lit(True)), key, "left")
    absent = F.when(F.col("__there").isNull(), "no_row").otherwise(F.col("pred_reason"))
    return paired.withColumns({"pred_ok": F.coalesce("pred_ok", F.lit(False)), "pred_reason": absent}).drop("__there")


def unusable(paired: DataFrame) -> DataFrame:
    """side, reason, n_rows of pairs with reasons: why rows count as invalid, a row of both sides once for each."""
    sides = [F.struct(F.lit(s).alias("side"), F.col(f"{s}_reason").alias("reason")) for s in ("gold", "pred")]
    reasons = paired.select(F.inline_outer(F.array(*sides))).where("reason is not null")
    return reasons.groupBy("side", "reason").agg(F.count("*").alias("n_rows"))


def score_rows(paired: DataFrame) -> DataFrame:
    """Per row: ``valid`` and one match flag per output.

    Missing and null are the same on either side. A damage value that is neither an object nor
    empty matches nothing.
    """
    outputs = (*DAMAGE_FIELDS, SEVERITY_FIELD)
    paths = ["$.damage", *[f"$.damage.{f}" for f in DAMAGE_FIELDS], f"$.{SEVERITY_FIELD}"]
    texts = {f"__{s}": F.array(*[F.to_json(J.member(F.col(s), p)) for p in paths]) for s in ("gold", "pred")}
    usable = _damage_usable(F.col("__gold")[0]) & _damage_usable(F.col("__pred")[0])
    valid, same = F.col("valid"), F.col("__same")
    matches = {f"__{name}": valid & same[i + 1] for i, name in enumerate(outputs)}
    for f in DAMAGE_FIELDS:
        matches[f"__{f}"] &= F.col("__usable")
    scored = paired.withColumn("valid", F.col("gold_ok") & F.col("pred_ok")).withColumns(texts)
    scored = scored.withColumns({"__same": F.zip_with("__gold", "__pred", J.same_text), "__usable": usable})
    return scored.withColumns(matches).drop(*texts, "__same", "__usable")


def _damage_usable(text: Column) -> Column:
    return F.coalesce(text.startswith("{"), F.lit(False)) | ~J.is_truthy_text(text)


def evaluate_pairs(paired: DataFrame) -> DataFrame:
    """metric, field, correct, denom, pct: one aggregate over the rows, then twelve report rows.

    Validity is over all rows, null when there are none. Accuracies are over valid predictions,
    0.0 when there are none.
    """
    outputs = (*DAMAGE_FIELDS, SEVERITY_FIELD)
    totals = score_rows(paired).agg(
        F.count("*").alias("total"),
        F.count_if("valid").alias("valid"),
        *[F.count_if(f"__{o}").alias(o) for o in outputs],
    )

    def line(metric: str, field: str, correct: str, denom: str) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(field).alias("field"),
            F.col(correct).alias("correct"),
            F.col(denom).alias("denom"),
        )

    lines = [line("validity", "json", "valid", "total")]
    lines += [line("field_accuracy", f, f, "valid") for f in DAMAGE_FIELDS]
    lines += [line("severity_accuracy", SEVERITY_FIELD, SEVERITY_FIELD, "valid")]
    report = totals.select(F.inline(F.array(*lines)))
    pct = F.try_divide(F.lit(100.0) * F.col("correct"), F.col("denom"))
    zero = F.when(F.col("metric") != "validity", F.lit(0.0))
    return report.withColumn("pct", F.coalesce(pct, zero))


def evaluate(
    gold: DataFrame,
    predictions: DataFrame,
    max_examples: int | None = None,
    key: str = "id",
    order: str = "pos",
) -> DataFrame:
    """The evaluation report over the first ``max_examples`` gold rows (None: all)."""
    return evaluate_pairs(pair_gold_pred(first_n(gold, max_examples, order), predictions, key))
