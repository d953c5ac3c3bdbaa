"""Embedded-array maintenance (R-01..R-09) as higher-order column expressions.

Each operator rewrites one array column of every row of a document table in a single
projection (no explode/regroup), so it costs one scan and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Pred = Callable[[Column], Column]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by_fields(**values) -> Pred:
    """Element predicate: every given field equals the given value (id, or id + job)."""
    def pred(x: Column) -> Column:
        out = F.lit(True)
        for k, v in values.items():
            out = out & (x[k] == F.lit(v))
        return out
    return pred


def append_if_absent(arr, element: Column, match: Pred) -> Column:
    """R-04 (``$push`` guarded by a match): add ``element`` unless an element matches; a
    missing array becomes ``[element]``."""
    base = _c(arr)
    return (
        F.when(base.isNull(), F.array(element))
        .when(F.exists(base, match), base)
        .otherwise(F.array_append(base, element))
    )


def update_all(arr, match: Pred, update: Callable[[Column], Column]) -> Column:
    """R-05 (all matches, e.g. genre rename)."""
    return F.transform(_c(arr), lambda x: F.when(match(x), update(x)).otherwise(x))


def update_first(arr, match: Pred, update: Callable[[Column], Column]) -> Column:
    """R-05 (first match only: cast, crew, company)."""
    a = _c(arr)
    first = F.array_position(F.transform(a, match), F.lit(True))  # 1-based, 0 = none
    return F.transform(a, lambda x, i: F.when(i + 1 == first, update(x)).otherwise(x))


def remove_matching(arr, match: Pred) -> Column:
    """R-06 (``$pull``)."""
    return F.filter(_c(arr), lambda x: ~F.coalesce(match(x), F.lit(False)))


def first_matching(arr, match: Pred) -> Column:
    """R-07: the first matching element or NULL (``get`` does not fail on an empty array)."""
    return F.get(F.filter(_c(arr), match), 0)


def with_fields(arr, *required: str) -> Column:
    """R-08: keep elements that carry every ``required`` field."""
    def ok(x: Column) -> Column:
        out = F.lit(True)
        for f in required:
            out = out & x[f].isNotNull()
        return out
    return F.filter(_c(arr), ok)
