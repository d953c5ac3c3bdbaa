"""Null placement of the two source engines (O-01..O-04), written out explicitly.

The relational engine sorts nulls as the largest value (ASC → nulls last, DESC → nulls
first); the document store sorts them as the smallest (ASC → first, DESC → last), which is
also Spark's default.  Every ordered query in the library spells its null placement out and
ends with a unique key so ``limit`` is deterministic.
"""

from __future__ import annotations


from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_asc(c) -> Column:
    """Relational ASC (nulls last)."""
    return _col(c).asc_nulls_last()


def pg_desc(c) -> Column:
    """Relational DESC without a NULLS clause (nulls first)."""
    return _col(c).desc_nulls_first()


def asc_nulls_last(c) -> Column:
    return _col(c).asc_nulls_last()


def desc_nulls_last(c) -> Column:
    return _col(c).desc_nulls_last()


def mongo_asc(c) -> Column:
    """Document-store ASC (null lowest, so first)."""
    return _col(c).asc_nulls_first()


def mongo_desc(c) -> Column:
    """Document-store DESC (null lowest, so last)."""
    return _col(c).desc_nulls_last()


def top_k(df, order: list[Column], limit: int | None, offset: int = 0):
    """ORDER BY ... [OFFSET n] LIMIT k.  A plain order+limit plans as TakeOrderedAndProject
    (per-partition top-k, then one task merges k rows from every partition), never a full
    global sort.  ``limit=None`` returns every row."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out
