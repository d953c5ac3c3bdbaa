"""Staging rows and change batches derived from the driver tables.

The ingest, validation and mutation operators take the raw shapes the source loads (CSV
text columns, repeated keys in source order, change batches).  These builders produce
those shapes from the driver tables so the operators run over whole tables at every scale:

* ``movie_file_rows`` — the cleaned movies file: all text, literal lists, two date formats;
* ``rating_rows`` / ``cast_rows`` / ``crew_rows`` / ``people_rows`` — credit and rating rows
  *before* de-duplication, with their source-order columns;
* ``rating_changes`` — a later batch of ratings (line 6 of each order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source-order columns of the line-level staging rows (a row's position in the load).
LINE_SEQ = ["l_shipdate", "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def movie_file_rows(cat) -> DataFrame:
    """Movies as the cleaned CSV holds them (all strings).  Even ids carry ``yyyy-MM-dd``,
    odd ids ``d/M/yyyy`` release dates; runtime is written as a float."""
    d = cat.movie_documents
    date = F.to_date("release_date")
    release = F.when(F.col("id") % 2 == 0, F.col("release_date")).otherwise(
        F.concat_ws("/", F.dayofmonth(date).cast("string"), F.month(date).cast("string"), F.year(date).cast("string"))
    )
    lit_list = lambda c: F.regexp_replace(F.to_json(F.coalesce(c, F.array())), '"', "'")
    return d.select(
        F.col("id").cast("long").alias("seq"),
        F.when(F.col("adult"), "True").otherwise("False").alias("adult"),
        F.col("genres_literal").alias("genres"),
        F.col("id").cast("string").alias("id"),
        F.col("original_language"),
        F.col("title").alias("original_title"),
        "overview",
        F.format_string("%.2f", F.col("popularity")).alias("popularity"),
        F.lit(None).cast("string").alias("poster_path"),
        lit_list(F.col("production_companies")).alias("production_companies"),
        release.alias("release_date"),
        F.format_string("%.1f", F.col("runtime")).alias("runtime"),
        F.lit(None).cast("string").alias("tagline"),
    )


def _line_rows(cat, line: int, *order_cols: str) -> DataFrame:
    return cat.line_orders(line).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", *order_cols
    )


def rating_rows(cat, line: int = 5) -> DataFrame:
    """Every rating row of the load, duplicates included (last one per key wins later)."""
    rows = _line_rows(cat, line, "o_custkey")
    return rows.select(
        F.col("o_custkey").alias("user_id"),
        (F.col("l_partkey") + 1).cast("int").alias("movie_id"),
        (F.col("l_quantity") / 10).cast("decimal(3,1)").alias("rating"),
        F.col("l_shipdate").alias("created_at"),
        *LINE_SEQ,
    )


def rating_changes(cat) -> DataFrame:
    """A later batch: line-6 rows, one per (user, movie) (last by source order)."""
    rows = rating_rows(cat, 6)
    return rows.groupBy("user_id", "movie_id").agg(
        F.max_by("rating", F.struct(*LINE_SEQ)).alias("rating"), F.max("l_shipdate").alias("created_at")
    )


def cast_rows(cat) -> DataFrame:
    rows = _line_rows(cat, 3, "o_custkey", "o_orderpriority")
    return rows.select(
        (F.col("l_partkey") + 1).cast("int").alias("movie_id"),
        (F.col("o_custkey") + 1).cast("int").alias("person_id"),
        F.col("o_orderpriority").alias("character"),
        (F.col("l_quantity").cast("int") % 10).alias("cast_order"),
        F.concat(F.lit("c"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias(
            "credit_id"
        ),
        *LINE_SEQ,
    )


def crew_rows(cat) -> DataFrame:
    rows = _line_rows(cat, 4, "o_custkey", "o_orderpriority", "o_orderstatus")
    return rows.select(
        (F.col("l_partkey") + 1).cast("int").alias("movie_id"),
        (F.col("o_custkey") + 1).cast("int").alias("person_id"),
        F.col("o_orderstatus").alias("department"),
        F.col("o_orderpriority").alias("job"),
        *LINE_SEQ,
    )


def people_rows(cat) -> DataFrame:
    """Person records as every cast row carries them: tmdb id (missing for every seventh
    customer), name, gender and a profile path that changes from row to row."""
    rows = _line_rows(cat, 3, "o_custkey", "o_orderpriority")
    cust = cat.tables.customer.select("c_custkey", "c_name")
    j = rows.join(cust, rows.o_custkey == cust.c_custkey)
    return j.select(
        F.when(F.col("o_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey") + 1).cast("long").alias("tmdb_id"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 4).cast("int").alias("gender"),
        F.concat(F.lit("/p/"), F.col("o_orderpriority")).alias("profile_path"),
        *LINE_SEQ,
    )


def links(cat) -> DataFrame:
    """movieId → tmdbId bridge: part key → movie id, missing for every ninth part."""
    part = cat.tables.part.select("p_partkey")
    return part.select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.when(F.col("p_partkey") % 9 == 0, F.lit(None)).otherwise(F.col("p_partkey") + 1).cast("string").alias("tmdbId"),
    )


def small_ratings(cat) -> DataFrame:
    """Ratings keyed by the pre-bridge movie id (``ratings_small`` shape)."""
    r = rating_rows(cat)
    return r.select(
        F.col("user_id").alias("userId"), (F.col("movie_id") - 1).alias("movieId"),
        F.col("rating").cast("double").alias("rating"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("created_at")).alias("timestamp"),
    )


def _literal(arr) -> F.Column:
    """A list as the catalogue files write it: Python-style single-quoted text."""
    return F.regexp_replace(F.to_json(F.coalesce(arr, F.array())), '"', "'")


def movie_document_rows(cat) -> DataFrame:
    """Movie documents file rows by column name (all text; lists single-quoted)."""
    d = cat.movie_documents
    return d.select(
        F.col("id").cast("string").alias("id"), "title", F.col("title").alias("original_title"), "release_date",
        F.when(F.col("adult"), "True").otherwise("False").alias("adult"),
        F.col("popularity").cast("string").alias("popularity"), F.col("runtime").cast("string").alias("runtime"),
        F.col("genres_literal").alias("genres"), _literal(F.col("production_companies")).alias("production_companies"),
    )


def credit_document_rows(cat) -> DataFrame:
    """Credits file rows: movie id and single-quoted cast / crew lists."""
    c = cat.credit_documents
    return c.select(F.col("id").cast("string").alias("id"), _literal(F.col("cast")).alias("cast"),
                    _literal(F.col("crew")).alias("crew"))


def keyword_rows(cat) -> DataFrame:
    """Keywords file rows: movie id and its single-quoted keyword list (ids by name order)."""
    kw = cat.movie_keywords.join(cat.keywords, "keyword_id")
    lists = kw.groupBy("movie_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("keyword_id").cast("long").alias("id"),
                                             F.col("keyword_name").alias("name")))).alias("kw")
    )
    return lists.select(F.col("movie_id").cast("long").alias("seq"), F.col("movie_id").cast("string").alias("id"),
                        _literal(F.col("kw")).alias("keywords"))
