"""Benchmark probe set (Q-42) and latency reporting (A-16, A-17).

The probes are the source's six comparison lookups.  Their ``LIMIT`` had no ``ORDER BY``
(any k rows); here each orders by its key so the answer is deterministic (O-09).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.operators.order_statistics import values_at_ranks

from cinemetric.functions.ordering import top_k
from cinemetric.plans import search as S
from cinemetric.plans.common import ilike_contains, search_docs_of, year_range


def _matches(docs: DataFrame, list_col: str, text: str, *fields: str) -> DataFrame:
    """One row per (movie, matching list element): the array form of a bridge join."""
    hits = F.explode(F.filter(list_col, lambda x: x["name"].ilike(f"%{text}%"))).alias("_m")
    return docs.select("movie_id", "title", "released_date", hits).select(
        "movie_id", "title", "released_date", *[F.col(f"_m.{f}").alias(a) for f, a in fields]
    )


def probe_title(cat, text: str, limit: int = 50) -> DataFrame:
    m = cat.movies.filter(ilike_contains("title", text)).select("movie_id", "title", "released_date")
    return top_k(m, [F.col("movie_id")], limit)


def probe_genre(cat, genre: str, limit: int = 50) -> DataFrame:
    docs = search_docs_of(cat)
    if docs is not None:  # one scan of the search documents
        m = _matches(docs, "genre_list", genre, ("id", "genre_id"))
        return top_k(m, [F.col("movie_id"), F.col("genre_id")], limit).drop("genre_id")
    g = cat.genres.filter(ilike_contains("genre_name", genre)).select("genre_id")
    pairs = cat.movie_genres.join(g, "genre_id", "left_semi")
    m = cat.movies.select("movie_id", "title", "released_date").join(pairs, "movie_id")
    return top_k(m, [F.col("movie_id"), F.col("genre_id")], limit).drop("genre_id")


def probe_year_range(cat, year_from: int, year_to: int, limit: int = 50) -> DataFrame:
    m = cat.movies.filter(year_range("released_date", year_from, year_to)).select("movie_id", "title", "released_date")
    return top_k(m, [F.col("movie_id")], limit)


def probe_actor(cat, actor: str, limit: int = 50) -> DataFrame:
    docs = search_docs_of(cat)
    if docs is not None:  # one scan of the search documents
        m = _matches(docs, "cast_list", actor, ("id", "person_id"), ("character", "character"))
        return top_k(m, [F.col("movie_id"), F.col("person_id")], limit).select(
            "movie_id", "title", "released_date", "character"
        )
    p = cat.people.filter(ilike_contains("name", actor)).select("person_id")
    cast = cat.movie_cast.join(p, "person_id", "left_semi")
    m = cat.movies.select("movie_id", "title", "released_date").join(cast, "movie_id")
    return top_k(m, [F.col("movie_id"), F.col("person_id")], limit).select("movie_id", "title", "released_date", "character")


def probe_combined(cat, genre: str, actor: str, year_from: int, year_to: int, sort_by: str = "popularity",
                   limit: int = 50) -> DataFrame:
    return S.combined_search(cat, genre=genre, actor=actor, year_start=year_from, year_end=year_to, sort_by=sort_by,
                             limit=limit)


def probe_deep_fetch(cat, movie_id: int | None = None) -> DataFrame:
    """Deep fetch of one movie (the first id when none is given)."""
    # the first id is a scalar sub-query: computed once, then a plain filter in each branch
    key = cat.movies.select(F.min("movie_id")).scalar() if movie_id is None else F.lit(movie_id)
    return S.deep_fetch(cat, movie_id=key)


def latency_summary(measurements: DataFrame, keys: list[str], latency: str = "latency_ms") -> DataFrame:
    """A-16: per group: mean, median, p95 (= the value at 0-based rank ``int(0.95 n)`` of
    the sorted latencies when n >= 20, else the max), min, max, total, ops/s, runs.

    Median and p95 are exact and taken by rank from range-partitioned values
    (``values_at_ranks``); no task sorts a whole group and no list of latencies is built."""
    n = F.col("n")
    ranks = {"_p95": F.floor(n * 0.95), "_low": F.floor((n - 1) / 2), "_high": F.floor(n / 2)}
    picked = values_at_ranks(measurements, keys, latency, ranks)
    sums = measurements.groupBy(*keys).agg(
        F.avg(latency).alias("avg_latency_ms"), F.min(latency).alias("min_latency_ms"), F.max(latency).alias("max_latency_ms"),
        F.sum(latency).alias("total_time_ms"), F.count(F.lit(1)).alias("runs"),
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    agg = sums.alias("a").join(picked.alias("b"), same, "left").select("a.*", "_p95", ((F.col("_low") + F.col("_high")) / 2).alias("median_latency_ms"))
    return agg.select(
        *keys,
        F.round("avg_latency_ms", 3).alias("avg_latency_ms"),
        F.round("median_latency_ms", 3).alias("median_latency_ms"),
        F.round(F.when(F.col("runs") >= 20, F.col("_p95")).otherwise(F.col("max_latency_ms")), 3).alias("p95_latency_ms"),
        F.round("min_latency_ms", 3).alias("min_latency_ms"),
        F.round("max_latency_ms", 3).alias("max_latency_ms"),
        F.round("total_time_ms", 3).alias("total_time_ms"),
        F.round(F.when(F.col("total_time_ms") > 0, F.col("runs") / (F.col("total_time_ms") / 1000)).otherwise(0.0), 2)
        .alias("ops_per_sec"),
        "runs",
    )


# Which direction wins for each reported metric.
LOWER_IS_BETTER = ("avg_latency_ms", "median_latency_ms", "p95_latency_ms", "min_latency_ms", "max_latency_ms",
                   "total_time_ms")
HIGHER_IS_BETTER = ("ops_per_sec",)


def metric_winner(summary: DataFrame, key: str, side_col: str, a: str, b: str) -> DataFrame:
    """A-17: pivot two engines' summaries and name the winner of each metric
    (lower latency / higher throughput wins, equal values tie)."""
    metrics = list(LOWER_IS_BETTER) + list(HIGHER_IS_BETTER)
    longf = summary.select(
        key, side_col,
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("x"),
    ).select(key, side_col, "x.metric", "x.v")
    wide = longf.groupBy(key, "metric").agg(
        F.max(F.when(F.col(side_col) == a, F.col("v"))).alias(a), F.max(F.when(F.col(side_col) == b, F.col("v"))).alias(b)
    )
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    a_wins = F.when(lower, F.col(a) < F.col(b)).otherwise(F.col(a) > F.col(b))
    return wide.withColumn(
        "winner", F.when(F.col(a) == F.col(b), F.lit("tie")).when(a_wins, F.lit(a)).otherwise(F.lit(b))
    )


def line_measurements(cat) -> DataFrame:
    """Measurements as a timing loop leaves them: a test, an engine and
    the time of one run."""
    return cat.tables.lineitem.select(
        F.concat(F.lit("test "), (F.col("l_linenumber") % 3).cast("string")).alias("test"),
        F.when(F.col("l_suppkey") % 2 == 0, "a").otherwise("b").alias("engine"),
        (F.col("l_quantity").cast("int") * 4 + F.col("l_partkey") % 4).cast("double").alias("latency_ms"),
    )


def latency_report(cat) -> DataFrame:
    """A-16 over every measurement."""
    return latency_summary(line_measurements(cat), ["test", "engine"])


def latency_winners(cat) -> DataFrame:
    """A-17: which engine wins each metric of each test."""
    return metric_winner(latency_report(cat), "test", "engine", "a", "b").select("test", "metric", "winner")
