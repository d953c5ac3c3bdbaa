"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregations and two equi-joins whose sides both come from a shuffle, so a node
that holds most links is split by the skew join.  A round's table is written to the shared folder
before the next one reads it; the loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.shared import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``edges(a, b)`` of longs to ``(node, root)``: each node that has a link, and the smallest
    node it can reach (the root itself is listed too)."""
    e = (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    e = stored(e, f"{folder}/links-0")
    before = _state(e)
    step = 0
    while before[0]:
        step += 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).distinct()
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(down, F.col("a") == F.col("u")).filter(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        e = small.unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        e = stored(e, f"{folder}/links-{step}")
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
