"""Prompt rendering, empty-input gate, completion text, and the final output form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions import jsonvalue as J
from extractkit.functions.once import pin
from extractkit.functions.text import is_blank, json_block_balanced, strip_text
from extractkit.schema import DAMAGE_FIELDS, SEVERITIES, SEVERITY_FIELD

PLACEHOLDER = "{narrative_text}"

# Short form, put in front of the narrative in training pairs.
PROMPT_PREFIX = "Inspection notes follow; list what they establish as a damage record in JSON.\n-----\n"

# Long form with the record described in words, used when asking a model.
PROMPT_TEMPLATE = (
    f"Inspection notes:\n-----\n{PLACEHOLDER}\n-----\n"
    "From these notes alone, fill in a damage record and reply with that record as JSON text. "
    f"Its key {SEVERITY_FIELD} holds one of the words {', '.join(SEVERITIES)}. "
    "Its key damage holds an object in which each of the following keys is true if the notes establish "
    f"it, and otherwise false: {', '.join(DAMAGE_FIELDS)}.\n"
)


def render_prompt(template: str, narrative: Column) -> Column:
    """Every placeholder replaced by the narrative, literally."""
    return F.replace(F.lit(template), F.lit(PLACEHOLDER), narrative)


def prefix_prompt(narrative: Column, prefix: str = PROMPT_PREFIX) -> Column:
    return F.concat(F.lit(prefix), narrative)


def with_prompt_status(df: DataFrame, template: str, narrative: str = "narrative") -> DataFrame:
    """Add the rendered prompt and why a row can not be used (null when it can).

    Reasons: ``empty_narrative``, then ``empty_prompt``.
    """
    rendered = render_prompt(template, F.col("__stripped"))
    return (
        df.withColumn("__stripped", strip_text(F.coalesce(F.col(narrative), F.lit(""))))
        .withColumn("prompt", rendered)
        .withColumn(
            "reason",
            F.when(F.col("__stripped") == "", "empty_narrative").when(is_blank(F.col("prompt")), "empty_prompt"),
        )
        .drop("__stripped")
    )


def reject_empty(df: DataFrame, template: str, narrative: str = "narrative") -> tuple[DataFrame, DataFrame]:
    """(accepted with ``prompt``, rejected with ``reason``)."""
    checked = pin(with_prompt_status(df, template, narrative), "reason")
    return (
        checked.filter(F.col("reason").isNull()).drop("reason"),
        checked.filter(F.col("reason").isNotNull()).drop("prompt"),
    )


def serialize_completion() -> Column:
    """Compact record text, keys in schema order, from the ten flag columns and ``severity``."""
    damage = F.struct(*[F.col(f) for f in DAMAGE_FIELDS]).alias("damage")
    return F.to_json(F.struct(damage, F.col("severity").alias(SEVERITY_FIELD)))


def render_output(df: DataFrame, raw: str = "raw_output", out: str = "output") -> DataFrame:
    """Parsed block as JSON text if it parses, else the block, else the whole raw text."""
    df = df.withColumn("__block", json_block_balanced(F.col(raw)))
    df = J.parse_columns(df, {"__value": F.col("__block")})
    shown = F.coalesce(F.to_json("__value"), F.nullif(F.col("__block"), F.lit("")), F.col(raw))
    return df.withColumn(out, shown).drop("__block", "__value")
