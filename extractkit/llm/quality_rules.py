"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure is above a cutoff. Cutoffs are chosen per stratum on
labelled documents: of the documents labelled good, at most a share ``risk`` may be rejected by all
rules together, with confidence ``1 - failure`` for all strata at once.

- The cutoffs of all rules form one fixed list of levels, from the most lenient on.
- Each stratum gets an equal part of ``failure`` (Bonferroni).
- Within a stratum a level passes if the exact binomial tail P(X <= rejected good documents) at
  ``risk`` is at most that part. The first level that fails ends the list (fixed-sequence testing,
  which needs no further correction), and the last that passed is used. With too few labels none
  passes, and no rule is on in that stratum.

The levels don't depend on the labels, so every labelled row is a holdout row.

DataFrame functions only: words, lines and windows are arrays of the row, so nothing is exploded or
shuffled but one small row per document, to meet its label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.functions.once import pin
from extractkit.llm.tables import saved, small_side

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule: measure of a row of ``counts``, and the cutoffs of the levels, the most lenient first.
RULES = {
    "symbols_per_word": ("n_symbols / n_words", [2.0, 1.0, 0.5, 0.3, 0.2, 0.15, 0.1]),
    "exclamations_per_word": ("n_exclamations / n_words", [2.0, 1.5, 1.0, 0.8, 0.5, 0.3, 0.2]),
    "capitals_per_char": ("n_capitals / word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "repeated_lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "repeated_words": ("n_repeat_words / n_words", [0.48, 0.46, 0.44, 0.42, 0.4, 0.35, 0.3]),
}
LEVELS = 7


def _without(text: Column, characters: str) -> Column:
    """Code points of the text that are not among the characters."""
    return F.length(F.translate(text, characters, ""))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with counts of it as long columns; null counts as empty.

    n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, n_capitals,
    n_exclamations. Columns of these names in ``docs`` are replaced.
    """
    made = (
        "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_capitals n_exclamations"
    ).split()
    kept = [c for c in docs.columns if c not in made and c != text_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        *kept,
        text.alias("_t"),
        F.array_remove(F.split(text, BLANKS), "").alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    cut = pin(cut, "_w", "_l")
    windows = F.when(
        F.size("_w") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3),
            lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
        ),
    ).otherwise(F.array().cast("array<long>"))
    hashed = pin(cut.withColumn("_h", windows), "_h")
    # windows side by side in hash order; places of those equal to a neighbour
    ordered = pin(
        hashed.withColumn(
            "_s",
            F.when(
                F.size(F.array_distinct("_h")) < F.size("_h"),
                F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
            ),
        ),
        "_s",
    )

    def same(e: Column, j: Column) -> Column:
        return F.coalesce(F.get("_s", j)["x"] == e["x"], F.lit(False))

    repeated = F.sort_array(
        F.filter(
            F.transform(
                "_s", lambda e, j: F.when(same(e, j - 1) | same(e, j + 1), e["i"]).otherwise(-1)
            ),
            lambda i: i >= 0,
        )
    )
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    length = F.length("_t")
    values = {
        "n_words": F.size("_w"),
        "word_chars": _without(F.col("_t"), " \t\n\x0b\x0c\r"),
        "n_symbols": length - _without(F.col("_t"), SYMBOLS),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_capitals": length - _without(F.col("_t"), CAPITALS),
        "n_exclamations": length - _without(F.col("_t"), "!"),
    }
    return ordered.select(*kept, *[x.cast("long").alias(n) for n, x in values.items()])


def base_failed() -> Column:
    """Too short, or mostly repeated word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _measure(rule: str) -> Column:
    over, under = RULES[rule][0].split(" / ")
    return F.coalesce(F.try_divide(over, under), F.lit(0.0))


def _tail(k: Column, n: Column, p: float) -> Column:
    """Exact P(X <= k) for X ~ Binomial(n, p), summed in logarithms."""
    first = n * F.log(F.lit(1 - p))

    odds = F.log(F.lit(p / (1 - p)))

    def add(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(a["total"], term)
        total = top + F.log(F.exp(a["total"] - top) + F.exp(term - top))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.filter(F.sequence(F.lit(0).cast("long"), k), lambda j: j > 0)
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.exp(F.aggregate(steps, start, add, lambda a: a["total"]))


def thresholds(good: DataFrame, stratum: str, risk: float = 0.05, failure: float = 0.05) -> DataFrame:
    """Per stratum of the good rows of ``counts``: the cutoff of each rule, null where it is off.

    Columns: stratum, n_good, and one double per rule. Null strata are a stratum of their own ("").
    """
    levels = [
        F.sum(F.greatest(*[(_measure(r) > cuts[k]).cast("long") for r, (_, cuts) in RULES.items()]))
        for k in range(LEVELS)
    ]
    held = good.groupBy(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum")).agg(
        F.count("*").alias("n_good"), F.array(*levels).alias("rejected")
    )
    held = saved(held, "holdout")
    part = failure / max(1, held.count())

    def passes(k: Column) -> Column:
        # beyond its mean the tail is above one half
        few = k <= F.col("n_good") * risk
        return F.when(few, _tail(k, F.col("n_good"), risk) <= part).otherwise(False)

    # the place of the first failure is one more than the number that passed before it
    n = F.array_position(F.transform("rejected", passes), False)
    last = F.when(n == 0, LEVELS).otherwise(n - 1).cast("int")
    chosen = [
        F.when(last > 0, F.get(F.array(*map(F.lit, cuts)), last - 1)).alias(rule)
        for rule, (_, cuts) in RULES.items()
    ]
    return held.select("stratum", "n_good", *chosen)


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum: str = "lang",
    risk: float = 0.05,
    failure: float = 0.05,
) -> DataFrame:
    """Per row of ``docs``: id, stratum, the counts, base_failed, rejected_by array<string>, kept.

    ``labels`` has id_col and quality (1: good); an id labelled good in any row is good, labels
    without a document and null labels are ignored. Only good documents that pass the base rules are
    held out. Repeated rows of ``docs`` are judged each; null ids have no label; without labels, or
    with an empty table, no learnt rule is on.
    """
    rows = docs.select(id_col, F.col(stratum).cast("string").alias("_stratum"), text_col)
    rows = saved(
        counts(rows, text_col)
        .withColumn("base_failed", base_failed())
        .withColumn("_stratum", F.coalesce("_stratum", F.lit(""))),
        "counts",
    )
    good = labels.where("quality = 1").select(id_col).distinct()
    held = rows.where(~F.col("base_failed")).join(good, id_col, "left_semi")
    cutoffs = saved(thresholds(held, "_stratum", risk, failure), "cutoffs").drop("n_good")
    cutoffs = small_side(cutoffs.withColumnRenamed("stratum", "_stratum"), cutoffs.count())
    out = rows.join(cutoffs, "_stratum", "left")
    over = F.array_compact(F.array(*[F.when(_measure(r) > F.col(r), F.lit(r)) for r in RULES]))
    return out.withColumn("rejected_by", over).withColumn(
        "kept", ~F.col("base_failed") & (F.size(over) == 0)
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rejected_by",
    )
