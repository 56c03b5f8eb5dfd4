"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.tables import gathered, saved


def _nearest(edges: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))


def _turned(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """Edges (u, v) of each of the pairs of columns ``ends`` of each row."""
    both = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends])
    return rows.select(F.inline(both))


def components(edges: DataFrame) -> DataFrame:
    """Components as (id, component): the least id that can be reached.

    ``edges`` has columns a, b; direction, loops, repeats and rows with a null don't matter. Nodes
    without an edge are not returned. Alternating star contraction: each round links neighbours to
    the least node seen, until every edge leads straight to a root. Neighbour lists are never
    gathered: only minima are, summed up before the shuffle. Edges that one task takes aren't shuffled.
    """
    rows = edges.count()
    pairs = (
        gathered(edges, rows)
        .where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = saved(gathered(pairs, rows), "edges")
    while True:
        both = _turned(gathered(pairs, rows), ("u", "v"), ("v", "u"))
        large = (
            both.join(_nearest(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = down.join(_nearest(down), "u")
        small = _turned(joined, ("v", "least"), ("u", "least")).where(F.col("u") != F.col("v")).distinct()
        # a round has a row for each edge and each node that isn't a root at most
        after = saved(gathered(small, 2 * rows), "edges")
        rows = after.count()
        after = gathered(after, rows)
        roots = after.select(F.col("v").alias("u")).distinct()
        settled = after.join(roots, "u", "left_semi").isEmpty()
        if settled:
            several = after.groupBy("u").count().where("count > 1").isEmpty()
            if several:
                break
        pairs = after
    return after.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        after.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
