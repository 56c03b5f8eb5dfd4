"""Running totals over a whole table without ranking it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from extractkit.session import kept


def running_total(
    df: DataFrame, order: list[str], value: str, out: str = "before", start: int = 0
) -> tuple[DataFrame, int]:
    """``df`` with ``out``, the sum of ``value`` over all rows before in ``order`` plus ``start``; and the sum of all.

    Rows are dealt into ranges of ``order``, of one task each. Totals per range, one number for each task, are summed
    up first; then every range adds up its own rows from there. ``order`` should tell rows apart; rows
    it doesn't are in one range, in any order. Null values count as nothing.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = kept(ranged, "ranged")
    totals = ranged.groupBy("__range").agg(F.coalesce(F.sum(value), F.lit(0)).alias("n")).collect()
    bases, total = [], start
    for r in sorted(totals):
        bases.append((r["__range"], total))
        total += r["n"]
    known = df.sparkSession.createDataFrame(bases, "__range int, __base long")
    earlier = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = ranged.join(F.broadcast(known), "__range").withColumn(
        out, F.col("__base") + F.coalesce(F.sum(value).over(earlier), F.lit(0))
    )
    return summed.select(*df.columns, out), total - start
