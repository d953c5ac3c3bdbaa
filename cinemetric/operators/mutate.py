"""Batch mutations (W-01..W-09): set-oriented forms of the source's CRUD calls.

Each operator takes the current table and a change table and returns the new table (and,
where the source reports one, a per-key outcome).  All of them are joins on the key —
anti-joins for inserts/deletes, a full outer join or union + ``max_by`` for upserts — so
the cost is one shuffle of each side on the key, whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.operators.keys import first_by


def _ntz(as_of) -> Column:
    from cinemetric.plans.events import ntz

    return ntz(as_of)


def _order(seq: str | Sequence[str]) -> Column:
    return F.struct(*([seq] if isinstance(seq, str) else seq))


def insert_if_absent(current: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | Sequence[str]
                     ) -> tuple[DataFrame, DataFrame]:
    """W-01 (``ON CONFLICT DO NOTHING``): change rows whose key is new are appended; of a key
    that the batch repeats, the first row by ``seq``.  Returns (table, inserted)."""
    cols = current.columns
    values = [c for c in cols if c not in keys]
    fresh = changes.join(current.select(*keys), list(keys), "left_anti")
    order = [seq] if isinstance(seq, str) else list(seq)
    fresh = (first_by(fresh, keys, order, values) if values else fresh.select(*keys).distinct()).select(*cols)
    return current.unionByName(fresh), fresh


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """W-02 (``ON CONFLICT DO UPDATE`` / ``$set`` with upsert): of a key that the batch repeats
    the largest ``seq`` wins; columns that the batch does not hold keep their current value
    (NULL on added rows).  Rows with a NULL key are no changes."""
    cols = current.columns
    given = [c for c in cols if c in changes.columns and c not in keys]
    known = changes.dropna(subset=list(keys))
    batch = known.groupBy(*keys).agg(F.max_by(F.struct(F.lit(True).alias("_hit"), *given), _order(seq)).alias("_v"))
    if given == [c for c in cols if c not in keys]:  # whole rows: replace
        rows = batch.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in given]).select(*cols)
        return current.join(batch.select(*keys), list(keys), "left_anti").unionByName(rows)
    merged = current.withColumn("_cur", F.lit(True)).join(batch, list(keys), "full")
    return merged.select(*[
        c if c in keys or c not in given else F.when(F.col("_v._hit"), F.col(f"_v.{c}")).otherwise(F.col(c)).alias(c)
        for c in cols
    ])


def strict_insert(current: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | Sequence[str], as_of=None,
                  stamp_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """W-03: insert where a duplicate key is an error.  Of a key that the batch repeats, the
    first row by ``seq`` (which must be unique) is inserted and the later ones are refused.
    ``stamp_cols`` are set to ``as_of``.  Returns (table, outcome per change row)."""
    batch = changes
    for c in stamp_cols:
        batch = batch.withColumn(c, _ntz(as_of))
    firsts = batch.groupBy(*keys).agg(F.min(_order(seq)).alias("_first"))
    exists = current.select(*keys).distinct().withColumn("_exists", F.lit(True))
    judged = batch.join(firsts, list(keys)).join(exists, list(keys), "left").withColumn(
        "outcome",
        F.when(F.col("_exists").isNotNull(), F.lit("duplicate key"))
        .when(_order(seq) != F.col("_first"), F.lit("duplicate in batch"))
        .otherwise(F.lit("inserted")),
    ).drop("_first", "_exists")
    good = judged.filter(F.col("outcome") == "inserted").select(*current.columns)
    return current.unionByName(good), judged


def partial_update(current: DataFrame, changes: DataFrame, keys: Sequence[str], fields: Sequence[str],
                   as_of=None, updated_at: str | None = None) -> DataFrame:
    """W-04: only the listed ``fields`` change, and only where the change row supplies a
    value (NULL = not supplied; an empty change is a no-op).  ``updated_at`` is set to
    ``as_of`` on rows that matched a change."""
    ch = changes.select(*keys, *[F.col(f).alias(f"_new_{f}") for f in fields]).withColumn("_hit", F.lit(True))
    j = current.join(ch, list(keys), "left")
    out = j
    for f in fields:
        out = out.withColumn(f, F.coalesce(F.col(f"_new_{f}"), F.col(f)))
    if updated_at:
        out = out.withColumn(updated_at, F.when(F.col("_hit"), _ntz(as_of)).otherwise(F.col(updated_at)))
    return out.select(*current.columns)


def delete_keys(current: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """W-05: (table without the keys, keys that existed and were deleted)."""
    k = keys_df.select(*keys).distinct()
    return current.join(k, list(keys), "left_anti"), k.join(current.select(*keys), list(keys), "left_semi")


def cascade_delete(tables: dict[str, DataFrame], keys_df: DataFrame, key: str) -> dict[str, DataFrame]:
    """W-06/W-07: delete the keys from the parent and every child table holding ``key``."""
    k = keys_df.select(key).distinct()
    return {name: t.join(k, key, "left_anti") for name, t in tables.items()}


def guarded_delete(current: DataFrame, keys_df: DataFrame, key: str, references: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """W-08 (ON DELETE RESTRICT): requested keys still referenced are refused with their
    reference count; the others are deleted.  Returns (table, outcome per requested key)."""
    req = keys_df.select(key).distinct().join(current.select(key), key, "left_semi")
    refs = None
    for r in references:
        part = r.select(key)
        refs = part if refs is None else refs.unionByName(part)
    counts = refs.join(req, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("ref_count"))
    outcome = req.join(counts, key, "left").select(
        key,
        F.coalesce("ref_count", F.lit(0)).alias("ref_count"),
        F.when(F.col("ref_count").isNull(), F.lit("deleted")).otherwise(F.lit("refused")).alias("outcome"),
    )
    gone = outcome.filter(F.col("outcome") == "deleted").select(key)
    return current.join(gone, key, "left_anti"), outcome


def fk_checked_insert(current: DataFrame, changes: DataFrame, fk: str, parent: DataFrame, parent_key: str
                      ) -> tuple[DataFrame, DataFrame]:
    """W-09: change rows whose ``fk`` has no parent are refused with a reason."""
    parents = parent.select(F.col(parent_key).alias(fk)).distinct().withColumn("_ok", F.lit(True))
    judged = changes.join(parents, fk, "left").withColumn(
        "outcome", F.when(F.col("_ok").isNull(), F.lit(f"unknown {fk}")).otherwise(F.lit("inserted"))
    ).drop("_ok")
    good = judged.filter(F.col("outcome") == "inserted").select(*current.columns)
    return current.unionByName(good), judged
