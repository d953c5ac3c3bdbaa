"""Surrogate ids and first/last-wins de-duplication.

* ``ordered_index`` gives dense 1-based ids in the order of a natural key (SERIAL ids of a
  dimension loaded in name order, N-01).  The keys alone are range-partitioned and written with
  their partition and place in it; the ids are numbered from that one written table, so they
  are unique whatever is recomputed, and joined back to the rows.  No step funnels the rows
  through a single task.
* ``first_by`` / ``last_by`` keep one row per key by an explicit sequence (source order).
  They are ``min_by``/``max_by`` aggregates, so Spark combines them map-side: a key holding a
  third of all rows costs one partial struct per task, not a third of the data in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.session import checkpoint_dir


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def ordered_index(df: DataFrame, order_cols: Sequence[str], id_col: str, start: int = 1) -> DataFrame:
    """Append ``id_col``: the 1-based position of each row in ``order_cols`` order.

    Rows must be unique on ``order_cols`` (call ``distinct`` first).  The numbered keys are
    written to the shared checkpoint folder when this is called.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    keys = df.select(*order_cols)
    ranged = keys.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    # monotonically_increasing_id = (partition index << 33) + position inside the partition.
    ranged.withColumn("_mid", F.monotonically_increasing_id()).write.parquet(path)
    mid = F.col("_mid")
    written = (
        spark.read.schema(keys.schema.add("_mid", "long")).parquet(path)
        .withColumn("_part", F.shiftright(mid, 33))
        .withColumn("_pos", mid - F.shiftleft(F.shiftright(mid, 33), 33))
    )
    # One row per partition: the size of this table is bounded by the partition count,
    # which is what makes broadcasting it safe.
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = written.join(F.broadcast(offsets), "_part").select(
        *order_cols, (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("int").alias(id_col)
    )
    if len(df.columns) == len(order_cols):
        return numbered.select(*df.columns, id_col)
    ids = numbered.select(*[F.col(c).alias(f"_k_{c}") for c in order_cols], id_col)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in order_cols])
    return df.join(ids, same).select(*df.columns, id_col)


def first_by(df: DataFrame, keys: Sequence[str], seq: Sequence, values: Sequence[str]) -> DataFrame:
    """One row per ``keys``: ``values`` of the row with the smallest ``seq`` (first wins)."""
    order = F.struct(*_cols(seq))
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), order).alias("_v")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def last_by(df: DataFrame, keys: Sequence[str], seq: Sequence, values: Sequence[str]) -> DataFrame:
    """One row per ``keys``: ``values`` of the row with the largest ``seq`` (last wins)."""
    order = F.struct(*_cols(seq))
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("_v")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])
