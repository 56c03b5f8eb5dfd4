"""Keep costly columns from being computed again by the filters that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; filters on the named columns stay above the point where they are computed.

    The optimizer pushes a filter below projections by writing the column's whole expression into
    it, through every projection it was built from, so a long chain is computed many times over.
    It does not push below a generator that yields the column, here one row per row.
    """
    others = [F.col(c) for c in df.columns if c not in names]
    return df.select(*others, F.inline_outer(F.array(F.struct(*names)))).select(*df.columns)
