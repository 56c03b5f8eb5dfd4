"""Rule check of training-data lines. Every line yields the list of rules it breaks.

Rules in order; "ends" means later rules are not looked at for that line:
V01 not JSON (ends), V14 JSON that is too large or too deep to read (ends; also for the completion, in
place of V06), V02 not an object (ends), V03 prompt / completion absent (ends),
V04 not a string, V05 empty after strip, V06 completion is not JSON (ends), V07 completion not an
object (ends), V08 no damage, V09 damage not an object, V10 damage key absent, V11 damage value not
boolean, V12 no severity, V13 severity not in the enum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.functions.jsonshape import past_limits
from extractkit.functions.text import is_blank, strip_line, text_array
from extractkit.schema import DAMAGE_FIELDS, REQUIRED_KEYS, SEVERITIES, SEVERITY_FIELD
from extractkit.sources.jsonl import numbered_scan

ERROR_TYPE = "array<struct<code:string,path:string>>"
_DAMAGE = "completion.damage"
_SEVERITY = f"completion.{SEVERITY_FIELD}"


def _none() -> Column:
    return F.expr(f"cast(array() as {ERROR_TYPE})")


def _only(code: str, path: str = "") -> Column:
    return F.expr(f"array(named_struct('code', '{code}', 'path', '{path}'))")


def _found(*checks: tuple[Column, str, str]) -> Column:
    """The errors whose condition holds, in the given order."""
    return F.concat(*[F.when(holds, _only(code, path)).otherwise(_none()) for holds, code, path in checks])


def _text_errors(key: str) -> Column:
    """V04 and V05 for one present key."""
    text = F.col(f"__{key}_text")
    return _found((text.isNull(), "V04", key), (text.isNotNull() & is_blank(text), "V05", key))


def _unread(text: Column, value: Column, code: str, path: str = "") -> Column:
    """``code`` for a text that isn't JSON, V14 for one past the reader's limits."""
    return F.when(past_limits(text, value), _only("V14", path)).otherwise(_only(code, path))


def _flag(field: str) -> Column:
    return J.member(F.col("__damage"), f"$.{field}")


def _field_error(field: Column) -> Column:
    """V10 or V11 for one damage field; null where it is boolean."""
    value = F.try_element_at(F.col("__damage_map"), field)
    code = F.when(value.isNull(), "V10").when(J.kind(value) != "BOOLEAN", "V11")
    return F.when(code.isNotNull(), F.struct(code.alias("code"), F.concat(F.lit(f"{_DAMAGE}."), field).alias("path")))


def _record_errors() -> Column:
    """V08-V13 for a completion that is an object."""
    fields = text_array(DAMAGE_FIELDS)
    damage_errors = (
        F.when(F.col("__flags_ok"), _none())
        .when(F.col("__damage").isNull(), _only("V08", _DAMAGE))
        .when(F.col("__damage_map").isNull(), _only("V09", _DAMAGE))
        .otherwise(F.array_compact(F.transform(fields, _field_error)).cast(ERROR_TYPE))
    )
    severity_errors = (
        F.when(F.col("__severity_ok"), _none())
        .when(F.col("__severity").isNull(), _only("V12", _SEVERITY))
        .otherwise(_only("V13", _SEVERITY))
    )
    return F.concat(damage_errors, severity_errors)


def validate_lines(df: DataFrame, line: str = "raw") -> DataFrame:
    """Add ``errors`` and ``non_blank``. Narrow: no shuffle, each text parsed once.

    The tests a good line passes are computed first; the branches that name the fault in a bad
    one are entered only where such a test fails.
    """
    kept = [F.col(c) for c in df.columns]
    prompt, completion = REQUIRED_KEYS
    out = _staged(df, line)
    text = F.col(f"__{completion}_text")
    content = (
        F.when(text.isNull(), _none())
        .when(F.col("__record").isNull(), _unread(text, F.col("__record"), "V06", completion))
        .when(~J.is_object_text(F.col("__record"), text), _only("V07", completion))
        .otherwise(_record_errors())
    )
    errors = (
        F.when(F.col("__line") == "", _none())
        .when(F.col("__root").isNull(), _unread(F.col("__line"), F.col("__root"), "V01"))
        .when(~F.col("__line").startswith("{"), _only("V02"))
        .when(F.col(f"__{prompt}").isNull(), _only("V03", prompt))
        .when(F.col(f"__{completion}").isNull(), F.concat(_text_errors(prompt), _only("V03", completion)))
        .otherwise(F.concat(_text_errors(prompt), _text_errors(completion), content))
    )
    return out.select(*kept, errors.alias("errors"), (F.col("__line") != "").alias("non_blank"))


def _staged(df: DataFrame, line: str) -> DataFrame:
    """Parsed parts of each line and the tests a good one passes, one projection after another."""
    completion = REQUIRED_KEYS[1]
    out = df.withColumn("__line", strip_line(F.coalesce(F.col(line), F.lit(""))))
    out = J.parse_columns(out, {"__root": F.col("__line")})
    out = out.withColumns({f"__{k}": J.member(F.col("__root"), f"$.{k}") for k in REQUIRED_KEYS})
    out = out.withColumns(
        {
            f"__{k}_text": F.when(
                J.kind(F.col(f"__{k}")) == "STRING", F.try_variant_get(F.col(f"__{k}"), "$", "string")
            )
            for k in REQUIRED_KEYS
        }
    )
    out = J.parse_columns(out, {"__record": F.col(f"__{completion}_text")})
    out = out.withColumns(
        {
            "__damage": J.member(F.col("__record"), "$.damage"),
            "__severity": J.member(F.col("__record"), f"$.{SEVERITY_FIELD}"),
        }
    )
    all_boolean = reduce(lambda a, b: a & b, [J.kind(_flag(f)) == "BOOLEAN" for f in DAMAGE_FIELDS])
    in_enum = F.to_json("__severity").isin([f'"{s}"' for s in SEVERITIES])
    out = out.withColumns(
        {
            "__flags_ok": F.coalesce(all_boolean, F.lit(False)),
            "__severity_ok": F.coalesce(in_enum, F.lit(False)),
        }
    )

    # The map is built only for a damage value at fault.
    as_map = F.try_variant_get("__damage", "$", "map<string,variant>")
    return out.withColumn("__damage_map", F.when(~F.col("__flags_ok"), as_map))


def validate_file(spark: SparkSession, path: str, per_file: bool = True) -> DataFrame:
    """file, line_no, code, path: one row per error of the lines of a file or folder.

    Lines without errors are counted for the numbers of the others and then dropped: only lines at
    fault meet the table of blocks. Numbers are as in ``sources.jsonl.numbered_scan``.
    """

    def at_fault(lines: DataFrame) -> DataFrame:
        found = validate_lines(lines).select("file", "block", "row", F.inline_outer("errors"))
        return found.filter(F.col("code").isNotNull())

    return numbered_scan(spark, path, per_file, narrow=at_fault)


def errors_text(errors: Column) -> Column:
    """The error list as ``code:path|code:path``.

    The size test also keeps the rules out of ``transform``, whose input is interpreted: a column
    read twice is computed on its own first.
    """
    listed = F.array_join(F.transform(errors, lambda e: F.concat_ws(":", e["code"], e["path"])), "|")
    return F.when(F.size(errors) > 0, listed).otherwise("")


def validate_summary(validated: DataFrame) -> DataFrame:
    """One row: error count, non-blank line count, verdict."""
    totals = validated.agg(
        F.coalesce(F.sum(F.size("errors").cast("bigint")), F.lit(0).cast("bigint")).alias("n_errors"),
        F.count_if("non_blank").alias("n_lines"),
    )
    return totals.withColumn("is_valid", F.col("n_errors") == 0)


def validate_by_code(validated: DataFrame) -> DataFrame:
    """Errors per rule and path.

    The outer form of inline: the inner one makes the optimizer add a filter on ``errors`` and
    push the whole rule expression below every projection it is built from.
    """
    rows = validated.select(F.inline_outer("errors")).filter(F.col("code").isNotNull())
    return rows.groupBy("code", "path").agg(F.count("*").alias("n_errors"))


def missing_keys(df: DataFrame, value: str, required: tuple[str, ...], out: str = "missing") -> DataFrame:
    """Add the required keys an object lacks, in required order."""
    lacking = F.array(
        *[F.when(J.member(F.col(value), f"$.{k}").isNull(), F.lit(k)) for k in required]
    )
    return df.withColumn(out, F.array_compact(lacking))
