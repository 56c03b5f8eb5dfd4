"""Strict JSON parsing to VARIANT, type tests without casts, and flattening to dot paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.session import REQUIRED_CONF

# The characters JSON allows around values.
JSON_SPACE = " \t\n\r"


def parse_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add one VARIANT column per entry; null where the text is not exactly one JSON value, and where it is
    one that the reader doesn't take for its size or depth: ``jsonshape.past_limits`` tells which.

    ``try_parse_json`` ignores text after the value. So the text is parsed as the first of two
    array elements, the second being the text's own hash: the pair comes back whole only if the
    text was one complete value. Two projections, each text parsed once. The settings that decide
    on repeated keys are applied to the session here, whether or not the caller configured it.
    """
    for setting, value in REQUIRED_CONF.items():
        df.sparkSession.conf.set(setting, value)
    staged = {f"__{name}": F.struct(text.alias("t"), _seal(text).alias("seal")) for name, text in columns.items()}
    df = df.withColumns(staged)
    df = df.withColumns({name: _sealed_array(F.col(name)) for name in staged})
    opened = {
        name: F.when(
            F.try_variant_get(F.col(f"__{name}")["arr"], "$[1]", "string") == F.col(f"__{name}")["seal"],
            F.variant_get(F.col(f"__{name}")["arr"], "$[0]", "variant"),
        )
        for name in columns
    }
    return df.withColumns(opened).drop(*staged)


def _seal(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def _sealed_array(pair: Column) -> Column:
    joined = F.concat(F.lit("["), pair["t"], F.lit(","), pair["seal"], F.lit("]"))
    return F.struct(F.try_parse_json(joined).alias("arr"), pair["seal"].alias("seal"))


def member(value: Column, path: str) -> Column:
    """The VARIANT at a ``$.a.b`` path; SQL null when absent, variant null when it is null."""
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """Type name, e.g. BOOLEAN, STRING, VOID; objects and arrays start with OBJECT / ARRAY."""
    return F.schema_of_variant(value)


def is_object_text(value: Column, text: Column) -> Column:
    """Whether ``text``, parsed to ``value``, is an object: decided by its first character."""
    return value.isNotNull() & F.ltrim(text, F.lit(JSON_SPACE)).startswith("{")


def is_empty_object_text(text: Column) -> Column:
    return text.rlike(rf"^[{JSON_SPACE}]*\{{[{JSON_SPACE}]*\}}[{JSON_SPACE}]*$")


def canonical(text: Column) -> Column:
    """Compact JSON text with numbers written one way: 1.0 and 1e0 become 1."""
    number = text.try_cast("double")
    whole = (F.abs(number) < F.lit(float(2**53))) & (number == F.floor(number).cast("double"))
    plain = F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
    return F.when(_is_number(text) & text.rlike(r"^-?[0-9]+(\.0+$|(\.[0-9]+)?[eE])"), plain).otherwise(text)


def same_text(a: Column, b: Column) -> Column:
    """Equality of two compact JSON texts, missing (SQL null) equal to JSON null."""
    a, b = F.coalesce(a, F.lit("null")), F.coalesce(b, F.lit("null"))
    return F.when(a == b, True).otherwise(canonical(a) == canonical(b))


def is_truthy_text(text: Column) -> Column:
    """False for missing, null, false, zero, and empty text, list or object."""
    return F.coalesce(~canonical(text).isin("null", "false", "0", '""', "[]", "{}"), F.lit(False))


def flatten_leaves(value: Column, text: Column) -> Column:
    """MAP of dot path -> compact JSON text for the object ``text``, parsed to ``value``.

    Each round opens one more object level, until no leaf is an object; there are never more
    levels than opening braces, so nothing is cut off. Lists are leaves, empty objects vanish.
    """
    as_map = "map<string,variant>"
    state = "struct<leaves:array<struct<path:string,v:variant>>,open:boolean>"

    def members(v: Column) -> Column:
        return F.map_entries(F.try_variant_get(v, "$", as_map))

    def opened(leaf: Column) -> Column:
        inner = F.transform(
            members(leaf["v"]),
            lambda e: F.struct(F.concat(leaf["path"], F.lit("."), e["key"]).alias("path"), e["value"].alias("v")),
        )
        return F.coalesce(inner, F.array(leaf))

    def has_object(leaves: Column) -> Column:
        return F.exists(leaves, lambda leaf: F.try_variant_get(leaf["v"], "$", as_map).isNotNull())

    def step(acc: Column, _: Column) -> Column:
        more = F.flatten(F.transform(acc["leaves"], opened))
        # Bound once by the one-element array, so the level is opened once.
        moved = F.transform(F.array(more), lambda m: F.struct(m.alias("leaves"), has_object(m).alias("open")))[0]
        return F.when(acc["open"], moved.cast(state)).otherwise(acc)

    top = F.transform(members(value), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("v")))
    start = F.struct(top.alias("leaves"), F.lit(True).alias("open")).cast(state)
    levels = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    rounds = F.array_repeat(F.lit(0), levels - 1)
    leaves = F.aggregate(rounds, start, step, lambda acc: acc["leaves"])
    return F.map_from_entries(
        F.transform(leaves, lambda leaf: F.struct(leaf["path"].alias("path"), F.to_json(leaf["v"]).alias("text")))
    )


def type_class(text: Column) -> Column:
    """One of object, array, string, boolean, null, number, from compact JSON text."""
    return (
        F.when(text.startswith('"'), "string")
        .when(_is_number(text), "number")
        .when(text.startswith("["), "array")
        .when(text.startswith("{"), "object")
        .when(text == "null", "null")
        .otherwise("boolean")
    )


def _is_number(text: Column) -> Column:
    """JSON text starting with ``-`` or a digit; no other JSON text sorts between them."""
    return (text >= "-") & (text < ":")
