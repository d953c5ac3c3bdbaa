"""Exact values at given ranks of every group, whatever a group holds (A-16).

Equal values are counted first (combined map-side).  The counted values are range-partitioned on
(group, value) and written with their partition; one row per group and partition then tells in which
partition a rank lies, and only that partition's values of the group are summed up.  So a group that
holds most rows is sorted by as many tasks as any other data of its size.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.session import checkpoint_dir


def values_at_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column]) -> DataFrame:
    """Per group: ``n`` and, per name in ``ranks``, the value at that 0-based rank of the sorted values.

    A rank is an expression of ``n``, the group's number of non-null values; groups without any are left out.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/ranks-{uuid.uuid4().hex}"
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranged = counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    written = spark.read.schema(ranged.schema).parquet(path)
    # one row per group and partition that holds some of it
    parts = written.groupBy(*keys, "_part").agg(F.sum("_c").alias("_m"))
    sizes = parts.groupBy(*keys).agg(F.sum("_m").alias("n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.withColumn("_begin", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    located = begins.alias("b").join(sizes.alias("s"), same).select(*[F.col(f"b.{k}").alias(k) for k in keys], "_part", "_begin", "_m", "n")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items()])
    located = located.withColumn("_want", F.filter(wanted, lambda w: (w["rank"] >= F.col("_begin")) & (w["rank"] < F.col("_begin") + F.col("_m"))))
    located = located.filter(F.size("_want") > 0)
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys] + [F.col("w._part") == F.col("l._part")]
    hit = written.alias("w").join(located.alias("l"), same).select(*[F.col(f"w.{k}").alias(k) for k in keys], "w._part", "_v", "_c", "_begin", "_want", "n")
    running = Window.partitionBy(*keys, "_part").orderBy("_v")
    ends = hit.withColumn("_end", F.col("_begin") + F.sum("_c").over(running))
    picked = ends.select(*keys, "n", "_v", F.explode(F.filter("_want", lambda w: (w["rank"] < F.col("_end")) & (w["rank"] >= F.col("_end") - F.col("_c")))).alias("_w"))
    return picked.groupBy(*keys).agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("_w.name") == name, F.col("_v"))).alias(name) for name in ranks]
    )
