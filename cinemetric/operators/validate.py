"""Constraint checking as DataFrame columns (V-01..V-06).

A rule set is data: a list of ``Rule(name, violated)`` where ``violated`` is a boolean
Column.  ``check`` adds a ``reasons`` array (names of the broken rules, in rule order);
``split`` returns the accepted and rejected rows.  Row-local rules are plain expressions;
uniqueness and foreign keys need other rows and are computed with an aggregation or a
semi-join and attached as flag columns first (``flag_duplicates`` / ``flag_missing_parent``),
never with a per-key window, so a hot key is combined map-side instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_null(c: str) -> Rule:
    return Rule(f"{c} is required", _c(c).isNull())


def not_blank(c: str) -> Rule:
    return Rule(f"{c} is blank", _c(c).isNull() | (F.trim(_c(c)) == ""))


def positive(c: str) -> Rule:
    return Rule(f"{c} must be > 0", _c(c) <= 0)


def in_range(c: str, lo, hi) -> Rule:
    return Rule(f"{c} must be in [{lo}, {hi}]", (_c(c) < F.lit(lo)) | (_c(c) > F.lit(hi)))


def max_length(c: str, n: int) -> Rule:
    return Rule(f"{c} longer than {n}", F.length(_c(c)) > n)


def one_of(c: str, values: Sequence) -> Rule:
    return Rule(f"{c} not allowed", ~_c(c).isin(*values))


def integral_or_null(c: str) -> Rule:
    """Document type rule ``['int', 'null']`` on a column that may hold text."""
    x = _c(c).cast("string")
    return Rule(f"{c} must be an integer", x.isNotNull() & x.try_cast("bigint").isNull())


def flagged(flag_col: str, name: str) -> Rule:
    """A rule whose verdict was computed by a set operation (``flag_*``)."""
    return Rule(name, F.col(flag_col))


def check(df: DataFrame, rules: Sequence[Rule], reasons: str = "reasons") -> DataFrame:
    """Append ``reasons``: the names of all rules the row breaks (NULL verdicts pass)."""
    names = [F.when(F.coalesce(r.violated, F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn(reasons, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def split(df: DataFrame, rules: Sequence[Rule], reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reasons column, rejected rows with their reasons)."""
    checked = check(df, rules, reasons)
    ok = F.size(reasons) == 0
    return checked.filter(ok).drop(reasons), checked.filter(~ok)


def flag_duplicates(df: DataFrame, keys: Sequence[str], seq: Sequence[str], flag: str) -> DataFrame:
    """UNIQUE(keys): the first row in ``seq`` order holds the key, later rows get ``flag``.
    The holder is found with a ``min`` aggregation (combined map-side) and joined back."""
    order = F.struct(*[F.col(s) for s in seq])
    holders = df.groupBy(*keys).agg(F.min(order).alias("_holder"))
    return (
        df.join(holders, list(keys), "left")
        .withColumn(flag, F.struct(*[F.col(s) for s in seq]) != F.col("_holder"))
        .drop("_holder")
    )


def flag_missing_parent(df: DataFrame, cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str], flag: str) -> DataFrame:
    """FOREIGN KEY: ``flag`` is true when non-null ``cols`` have no parent row (NULL keys pass)."""
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, cols)]).distinct().withColumn("_found", F.lit(True))
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return df.join(keys, list(cols), "left").withColumn(flag, present & F.col("_found").isNull()).drop("_found")


def reject_with_children(
    parent_rejects: DataFrame, key: str, children: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """N-13: rows of every child table whose ``key`` belongs to a rejected parent row are
    dropped too (left anti-join per child)."""
    bad = parent_rejects.select(key).distinct()
    return {name: child.join(bad, key, "left_anti") for name, child in children.items()}


def reject_input_rows(
    tables: dict[str, tuple[DataFrame, Sequence[Rule]]], key: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """N-13: one input row feeds a parent row and its child rows (all carrying ``key``).  If
    any of them breaks a rule, the whole input row is rejected: the parent and *every* child
    of that key.  Returns (accepted tables, rejected keys with the reasons, table-qualified).

    Set-based: the failing keys of all tables are unioned and aggregated once, then each table
    is anti-joined with them — no per-row transaction, no ordering between tables."""
    failures = None
    for name, (df, rules) in tables.items():
        bad = check(df, rules).select(key, F.explode("reasons").alias("reason")).select(
            key, F.concat(F.lit(f"{name}: "), F.col("reason")).alias("reason")
        )
        failures = bad if failures is None else failures.unionByName(bad)
    # collect_set de-duplicates map-side: a key's set is bounded by the distinct rule names
    rejected = failures.groupBy(key).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    accepted = {name: df.join(rejected.select(key), key, "left_anti") for name, (df, _) in tables.items()}
    return accepted, rejected


def retain(df: DataFrame, ts: str, as_of, ttl_seconds: int) -> DataFrame:
    """V-03: TTL as a filter: keep rows with ``ts >= as_of - ttl`` (a row exactly at the
    limit stays)."""
    from cinemetric.plans.events import ntz

    return df.filter(F.col(ts) >= ntz(as_of) - F.make_dt_interval(secs=F.lit(ttl_seconds)))


# TTLs of the time-bounded collections, in seconds.
TTL_SECONDS = {"events": 2592000, "sessions": 7776000, "recommendations": 86400}


# ---------------------------------------------------------------------------------------
# Rule sets of the declared schemas (V-01, V-02, V-04, V-05)
# ---------------------------------------------------------------------------------------


def movie_rules() -> list[Rule]:
    return [not_null("movie_id"), positive("movie_id"), not_null("title"), max_length("title", 255),
            max_length("language", 50)]


def rating_rules(max_rating: float = 10.0) -> list[Rule]:
    return [not_null("user_id"), not_null("movie_id"), not_null("rating"), in_range("rating", 0, max_rating)]


def event_rules() -> list[Rule]:
    """V-02 for the events collection: required type/timestamp, type enum, nullable ints."""
    from cinemetric.plans.events import EVENT_TYPES

    return [not_null("type"), not_null("ts"), one_of("type", EVENT_TYPES), integral_or_null("user_id"),
            integral_or_null("movie_id")]


def required(*cols: str) -> list[Rule]:
    """V-05: required document fields."""
    return [not_null(c) for c in cols]
