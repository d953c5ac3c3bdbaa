"""Table constraints compiled from one description per table (V-01, V-06, J-15).

A ``TableRules`` says what a row must satisfy: per column NOT NULL, length and bounds; PRIMARY KEY
and UNIQUE keys; references to parent tables.  ``check_tables`` decides whole tables, parents
before children:

1. row-local rules are one boolean expression each, references one left join each with the keys
   of the parent's *accepted* rows; the rows and their reasons are written once;
2. each key is one aggregation over the written rows without a reason (its smallest place in the
   order of arrival holds it, combined map-side), and only keys that occur more than once are
   joined back, so a table without repeats moves no row.

A row that breaks a local rule or a reference holds no key.  All keys of a table are judged on the
same rows: a row refused for one key still counts as holder of another.  NULL in a key or a
reference satisfies it, as in SQL, but primary key columns must not be NULL.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.operators.validate import Rule, check, max_length, not_null, positive
from cinemetric.session import checkpoint_dir


@dataclass(frozen=True)
class Field:
    """One column's rules; bounds are inclusive."""

    name: str
    required: bool = False
    longest: int | None = None
    low: float | None = None
    high: float | None = None
    positive: bool = False

    def rules(self) -> list[Rule]:
        out = [not_null(self.name)] if self.required else []
        if self.positive:
            out.append(positive(self.name))
        if self.low is not None:
            out.append(Rule(f"{self.name} below {self.low:g}", F.col(self.name) < self.low))
        if self.high is not None:
            out.append(Rule(f"{self.name} above {self.high:g}", F.col(self.name) > self.high))
        if self.longest is not None:
            out.append(max_length(self.name, self.longest))
        return out


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str
    #: Whether the parent's delete takes the child's rows along.
    cascades: bool = True

    @property
    def reason(self) -> str:
        return f"unknown {self.column} in {self.parent}"


@dataclass(frozen=True)
class TableRules:
    primary_key: tuple[str, ...]
    fields: tuple[Field, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = field(default=())

    def local_rules(self) -> list[Rule]:
        given = {f.name: f for f in self.fields}
        keyed = [not_null(c) for c in self.primary_key if not (c in given and given[c].required)]
        return keyed + [r for f in self.fields for r in f.rules()]

    def keys(self) -> list[tuple[str, ...]]:
        return [self.primary_key, *self.unique]


def duplicate_reason(key: Sequence[str]) -> str:
    return f"duplicate ({', '.join(key)})"


_MOVIE = Reference("movie_id", "movies", "movie_id")

# The declared tables.
CATALOGUE_RULES: dict[str, TableRules] = {
    "movies": TableRules(("movie_id",), (Field("movie_id", positive=True), Field("title", True, 255), Field("language", longest=50))),
    "genres": TableRules(("genre_id",), (Field("genre_name", True, 100),), (("genre_name",),)),
    "production_companies": TableRules(("company_id",), (Field("name", True, 255),), (("name",),)),
    "ratings": TableRules(("rating_id",), (Field("rating", low=0, high=10),), (("user_id", "movie_id"),), (_MOVIE,)),
    "keywords": TableRules(("keyword_id",), (Field("keyword_name", True),), (("keyword_name",),)),
    "people": TableRules(("person_id",), (Field("name", longest=255),), (("tmdb_id",),)),
    "users": TableRules(
        ("user_id",), (Field("username", longest=50), Field("password_hash", longest=255), Field("role", longest=20)), (("username",),)
    ),
    "movie_genres": TableRules(("movie_id", "genre_id"), references=(_MOVIE, Reference("genre_id", "genres", "genre_id"))),
    "movie_production_companies": TableRules(
        ("movie_id", "company_id"), references=(_MOVIE, Reference("company_id", "production_companies", "company_id"))
    ),
    "movie_keywords": TableRules(("movie_id", "keyword_id"), references=(_MOVIE, Reference("keyword_id", "keywords", "keyword_id"))),
    "movie_cast": TableRules(
        ("movie_id", "person_id"), (Field("character", longest=255), Field("credit_id", longest=50)), (("credit_id",),),
        (_MOVIE, Reference("person_id", "people", "person_id", cascades=False)),
    ),
    "movie_crew": TableRules(
        ("movie_id", "person_id", "job"),
        (Field("department", longest=100), Field("job", longest=100), Field("credit_id", longest=50)), (("credit_id",),),
        (_MOVIE, Reference("person_id", "people", "person_id", cascades=False)),
    ),
}


def parents_first(rules: Mapping[str, TableRules]) -> list[str]:
    """Table names, each behind the tables that it refers to."""
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"tables refer to each other: {' -> '.join([*path, name])}")
        for r in rules[name].references:
            if r.parent in rules and r.parent != name:
                visit(r.parent, (*path, name))
        if name not in order:
            order.append(name)

    for name in rules:
        visit(name, ())
    return order


def _flag_orphans(rows: DataFrame, reference: Reference, parent: DataFrame, flag: str) -> DataFrame:
    # accepted parents are unique on the key, so the join keeps the number of rows
    keys = parent.select(F.col(reference.parent_column).alias("_parent"), F.lit(True).alias("_found"))
    joined = rows.join(keys, F.col(reference.column) == F.col("_parent"), "left")
    return joined.withColumn(flag, F.col(reference.column).isNotNull() & F.col("_found").isNull()).drop("_parent", "_found")


def _repeats(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that several rows without a reason carry, with the place of the first."""
    named = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    free = rows.filter((F.size("reasons") == 0) & named)
    holders = free.groupBy(*key).agg(F.min("_place").alias("_holder"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return holders.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "_holder")


def check_table(rows: DataFrame, rules: TableRules, parents: Mapping[str, DataFrame], order: Sequence[str], folder: str) -> DataFrame:
    """``rows`` with ``reasons`` (names of the broken rules); ``order`` is the order of arrival."""
    spark = rows.sparkSession
    columns = rows.columns
    flags = []
    for i, reference in enumerate(rules.references):
        rows = _flag_orphans(rows, reference, parents[reference.parent], f"_orphan{i}")
        flags.append(Rule(reference.reason, F.col(f"_orphan{i}")))
    # rows that arrive at one place are told apart by the place they are written to
    place = F.struct(*[F.col(c) for c in order], F.monotonically_increasing_id().alias("_row"))
    local = check(rows, [*rules.local_rules(), *flags]).select(*columns, "reasons", place.alias("_place"))
    local.write.parquet(folder)
    written = spark.read.schema(local.schema).parquet(folder)
    out, clash = written, []
    for n, key in enumerate(rules.keys()):
        repeats = _repeats(written, key).withColumnRenamed("_holder", f"_holder{n}")
        same = reduce(Column.__and__, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(key)])
        out = out.join(repeats, same & (F.size("reasons") == 0), "left").drop(*[f"_k{i}" for i in range(len(key))])
        later = F.col(f"_holder{n}").isNotNull() & (F.col("_place") != F.col(f"_holder{n}"))
        clash.append(F.when(later, F.lit(duplicate_reason(key))))
    reasons = F.concat("reasons", F.array_compact(F.array(*clash)))
    return out.select(*columns, reasons.alias("reasons"))


def check_tables(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules], order: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Every table of ``tables`` with the ``reasons`` of its rows."""
    out: dict[str, DataFrame] = {}
    for name in parents_first({n: rules[n] for n in tables}):
        spark = tables[name].sparkSession
        folder = f"{checkpoint_dir(spark)}/checked-{uuid.uuid4().hex}/{name}"
        parents = {r.parent: accepted(out[r.parent]) for r in rules[name].references}
        out[name] = check_table(tables[name], rules[name], parents, order[name], folder)
        if any(r.parent == name for n in tables for r in rules[n].references):
            # children read the verdicts, not the steps that led to them
            out[name].write.parquet(f"{folder}-verdicts")
            out[name] = spark.read.schema(out[name].schema).parquet(f"{folder}-verdicts")
    return out


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") == 0).drop("reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") > 0)


def reason_counts(checked: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, reason, rows``: how often each rule is broken, and how many rows are accepted."""
    out = None
    for name, df in checked.items():
        said = F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
        part = df.select(F.explode(said).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
        part = part.select(F.lit(name).alias("table_name"), "reason", "rows")
        out = part if out is None else out.unionByName(part)
    return out


def cascade_children(rules: Mapping[str, TableRules], table: str) -> list[tuple[str, str]]:
    """(child table, its column) that a delete in ``table`` takes along."""
    return [(n, r.column) for n, t in rules.items() for r in t.references if r.parent == table and r.cascades]
