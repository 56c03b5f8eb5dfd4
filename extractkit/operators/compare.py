"""Compare two sets of model outputs key by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.functions.jsonshape import past_limits
from extractkit.functions.once import pin
from extractkit.functions.text import json_block_balanced

MISSING = "<missing>"


def flatten_table(df: DataFrame, text: str, key: str = "id") -> DataFrame:
    """key, path, value, type for each leaf of the JSON object in ``text``; other texts give no rows.

    ``explode_outer`` keeps the optimizer from filtering on, and so repeating, the flattening.
    """
    leaves = with_leaves(df.select(key, text), text, "__leaves")
    rows = leaves.select(key, F.explode_outer("__leaves").alias("path", "leaf")).filter(F.col("path").isNotNull())
    return rows.select(
        key, "path", J.canonical(F.col("leaf")).alias("value"), J.type_class(F.col("leaf")).alias("type")
    )


def flatten_rejected(df: DataFrame, text: str, key: str = "id") -> DataFrame:
    """key, reason of the texts that ``flatten_table`` has no rows for: no_json, past_limits, no_leaves."""
    leaves = with_leaves(df.select(key, text), text, "__leaves", reasons=True)
    reason = _reason("__leaves", "").otherwise(F.when(F.size("__leaves") == 0, "no_leaves"))
    return pin(leaves.select(key, reason.alias("reason")), "reason").where("reason is not null")


def with_leaves(df: DataFrame, text: str, out: str, reasons: bool = False) -> DataFrame:
    """Add the path -> leaf text map of the object in ``text``, null when it holds no JSON object, and with
    ``reasons`` ``<out>_past``: whether it is null only because the text is too large or too deep to read."""
    df = J.parse_columns(df, {f"__{out}_value": F.col(text)})
    value = F.col(f"__{out}_value")
    leaves = F.when(J.is_object_text(value, F.col(text)), J.flatten_leaves(value, F.col(text)))
    added = {out: leaves}
    if reasons:
        added[f"{out}_past"] = past_limits(F.col(text), value)
    return df.withColumns(added).drop(f"__{out}_value")


def _reason(leaves: str, suffix: str) -> Column:
    """Why there are no leaves, as the first branches of a case."""
    lacking = F.col(leaves).isNull()
    return F.when(lacking & F.col(f"{leaves}_past"), f"past_limits{suffix}").when(lacking, f"no_json{suffix}")


def match_outputs(left: DataFrame, right: DataFrame, key: str = "id", reasons: bool = True) -> DataFrame:
    """key, rejected (only with ``reasons``), and per key a map of path -> (a, b, is_match).

    The one join pairs the raw texts; they are parsed and matched inside the row, so eleven paths
    per text never become eleven shuffled rows. A text without a JSON object, or absent, rejects
    its key (no_json_a, no_json_b); one that is JSON but past the reader's limits has its own reason
    (past_limits_a, past_limits_b).
    """
    block = json_block_balanced(F.coalesce("raw_output", F.lit("")))
    a = left.select(key, block.alias("__text_a"))
    b = right.select(key, block.alias("__text_b"))
    paired = a.join(b, key, "full_outer")
    for side in ("a", "b"):
        paired = with_leaves(paired, f"__text_{side}", side, reasons)
    both = F.map_zip_with(
        F.col("a"),
        F.col("b"),
        lambda path, x, y: F.struct(x.alias("a"), y.alias("b"), J.same_text(x, y).alias("is_match")),
    )
    rejected = [_reason("a", "_a").otherwise(_reason("b", "_b")).alias("rejected")] if reasons else []
    return paired.select(key, *rejected, both.alias("paths"))


def compare_models(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """key, rejected, keys, matches, pct. Rejected rows have no counts; no keys gives a null pct."""
    matched = match_outputs(left, right, key)
    values = F.map_values(F.col("paths"))
    keys = F.when(F.col("paths").isNotNull(), F.size("paths")).cast("bigint")
    matches = F.when(
        F.col("paths").isNotNull(), F.size(F.filter(values, lambda v: v["is_match"]))
    ).cast("bigint")
    return matched.select(key, "rejected", keys.alias("keys"), matches.alias("matches")).withColumn(
        "pct", F.try_divide(F.lit(100.0) * F.col("matches"), F.col("keys"))
    )


def compare_summary(compared: DataFrame, key: str = "id") -> DataFrame:
    """key, keys, matches, pct of the keys that ``compare_models`` accepted and found paths in."""
    return pin(compared, "keys").filter(F.col("keys") > 0).select(key, "keys", "matches", "pct")


def compare_paths(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """One row per path of either output of each accepted key: key, path, value_a, value_b, is_match.

    ``value_a`` / ``value_b`` are ``<missing>`` where the side has no such path. Missing and null
    count as equal. Keys that ``compare_models`` rejects have no rows. Paths appear after the join,
    so they are never shuffled.
    """
    matched = match_outputs(left, right, key, reasons=False)
    rows = matched.select(key, F.explode_outer("paths").alias("path", "pair")).filter(F.col("path").isNotNull())
    return rows.select(
        key,
        "path",
        _shown(F.col("pair.a")).alias("value_a"),
        _shown(F.col("pair.b")).alias("value_b"),
        F.col("pair.is_match").alias("is_match"),
    )


def _shown(leaf: Column) -> Column:
    return F.coalesce(J.canonical(leaf), F.lit(MISSING))


def path_union(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Distinct paths of both outputs of each accepted key."""
    return compare_paths(left, right, key).select(key, "path")


def compare_mismatches(compared: DataFrame, key: str = "id") -> DataFrame:
    """Paths that differ, with both values, in order of key and path within each partition."""
    differing = compared.filter(~F.col("is_match")).select(key, "path", "value_a", "value_b")
    return differing.sortWithinPartitions(key, "path")


def model_agreement(compared: DataFrame) -> DataFrame:
    """One row over all keys: compared and rejected texts, keys, matches, pct."""
    totals = compared.agg(
        F.count_if(F.col("rejected").isNull()).alias("compared"),
        F.count("rejected").alias("rejected"),
        F.coalesce(F.sum("keys"), F.lit(0).cast("bigint")).alias("keys"),
        F.coalesce(F.sum("matches"), F.lit(0).cast("bigint")).alias("matches"),
    )
    return totals.withColumn("pct", F.try_divide(F.lit(100.0) * F.col("matches"), F.col("keys")))
