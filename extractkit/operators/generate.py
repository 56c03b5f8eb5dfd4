"""Labelled training pairs, correct by construction: flags first, then text that states them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions import draws
from extractkit.functions.severity import severity_bucket, true_count
from extractkit.functions.text import text_array
from extractkit.operators.phrases import INTROS, PHRASES, PhraseBank, phrase_table
from extractkit.operators.prompts import PROMPT_PREFIX, prefix_prompt, serialize_completion
from extractkit.schema import DAMAGE_FIELDS, NARRATIVE_FIELDS


@dataclass(frozen=True)
class FlagRate:
    """Probability that a flag is true; with ``given``, only where that flag is true."""

    field: str
    p: float
    given: str | None = None


# Flag rates.
RATES = (
    FlagRate("floor_water_damage", 0.75),
    FlagRate("carpet_damage", 0.85, "floor_water_damage"),
    FlagRate("broken_plaster", 0.6, "floor_water_damage"),
    FlagRate("mould", 0.5, "floor_water_damage"),
    FlagRate("odor_present", 0.8, "floor_water_damage"),
    FlagRate("electrical_damage", 0.25, "floor_water_damage"),
    FlagRate("ceiling_damage", 0.2),
    FlagRate("cabinet_damage", 0.4, "floor_water_damage"),
    FlagRate("appliance_damage", 0.3, "floor_water_damage"),
    FlagRate("structural_crack", 0.15),
)
SEED = 42


def _digest_columns(stream: str, draws_needed: int, key: Column, seed: int) -> dict[str, Column]:
    count = -(-draws_needed // draws.WORDS_PER_DIGEST)
    return {f"__{stream}{i}": draws.digest(key, seed, f"{stream}{i}") for i in range(count)}


def _word(stream: str, draw: int) -> Column:
    block, slot = divmod(draw, draws.WORDS_PER_DIGEST)
    return draws.word(F.col(f"__{stream}{block}"), slot)


def damage_flags(df: DataFrame, key: str = "id", seed: int = SEED, rates: tuple[FlagRate, ...] = RATES) -> DataFrame:
    """Add the ten flags and ``severity``."""
    digests = _digest_columns("flag", len(rates), F.col(key), seed)
    base = {r.field: draws.bernoulli(_word("flag", i), r.p) for i, r in enumerate(rates) if r.given is None}
    dependent = {
        r.field: F.col(r.given) & draws.bernoulli(_word("flag", i), r.p)
        for i, r in enumerate(rates)
        if r.given is not None
    }
    kept = [F.col(c) for c in df.columns]
    out = df.withColumns(digests).withColumns(base).withColumns(dependent)
    out = out.select(*kept, *DAMAGE_FIELDS)
    return out.withColumn("severity", severity_bucket(true_count()))


def build_narrative(
    df: DataFrame,
    key: str = "id",
    seed: int = SEED,
    bank: PhraseBank | None = None,
    intros: list[str] | None = None,
) -> DataFrame:
    """Add ``narrative``: an intro and one sentence per field, in narrative order.

    The bank is a constant in the plan, so rows are neither joined nor shuffled.
    """
    bank, intros = bank or PHRASES, intros if intros is not None else INTROS
    digests = _digest_columns("pick", len(NARRATIVE_FIELDS) + 1, F.col(key), seed)

    def place(draw: int, size: Column) -> Column:
        return F.pmod(draws.word_value(_word("pick", draw)), size).cast("int") + 1

    sentences = []
    for draw, field in enumerate(NARRATIVE_FIELDS):
        stated, denied = bank[field][True], bank[field][False]
        options = F.when(F.col(field), text_array(stated)).otherwise(text_array(denied))
        size = F.when(F.col(field), len(stated)).otherwise(len(denied))
        sentences.append(F.element_at(options, place(draw, size)))
    intro = F.element_at(text_array(intros), place(len(NARRATIVE_FIELDS), F.lit(len(intros))))
    narrative = F.concat(intro, F.concat_ws(" ", *sentences))
    return df.withColumns(digests).withColumn("narrative", narrative).drop(*digests)


def narrative_lookup(
    df: DataFrame, key: str = "id", seed: int = SEED, bank: PhraseBank | None = None
) -> DataFrame:
    """The sentence picks as rows (key, ord, field, flag, idx, phrase), by joining the phrase table.

    The phrase table has as many rows as the bank has sentences, whatever the data's size.
    """
    bank = bank or PHRASES
    digests = _digest_columns("pick", len(NARRATIVE_FIELDS) + 1, F.col(key), seed)
    picks = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.col(field).alias("flag"),
                F.when(F.col(field), draws.pick_index(_word("pick", i), len(bank[field][True])))
                .otherwise(draws.pick_index(_word("pick", i), len(bank[field][False])))
                .alias("idx"),
            )
            for i, field in enumerate(NARRATIVE_FIELDS)
        ]
    )
    rows = df.withColumns(digests).select(F.col(key), F.inline(picks))
    phrases = phrase_table(df.sparkSession, bank).drop("n")
    return rows.join(F.broadcast(phrases), ["field", "flag", "idx"]).select(
        key, "ord", "field", "flag", "idx", "phrase"
    )


def generate_pairs(
    ids: DataFrame,
    key: str = "id",
    seed: int = SEED,
    rates: tuple[FlagRate, ...] = RATES,
    bank: PhraseBank | None = None,
    intros: list[str] | None = None,
    prefix: str = PROMPT_PREFIX,
) -> DataFrame:
    """key, ten flags, severity, narrative, prompt, completion. No shuffle."""
    labelled = damage_flags(ids.select(key), key, seed, rates)
    told = build_narrative(labelled, key, seed, bank, intros)
    return told.withColumns(
        {"prompt": prefix_prompt(F.col("narrative"), prefix), "completion": serialize_completion()}
    )
