"""Constraint checks of all twelve tables over raw load rows (V-01, V-06, J-15).

``raw_tables`` derives what a load offers to each table from the driver tables: every row of the
source, with missing names, over-long texts, ids out of bounds, repeated keys and dangling references
left in, and ``seq`` as the order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.operators import constraints as C

#: Line numbers repeat within an order, so rows of one place are ordered by their values.
ARRIVAL = {
    "ratings": ["seq", "movie_id", "user_id", "rating"],
    "movie_cast": ["seq", "movie_id", "person_id", "character", "cast_order"],
    "movie_crew": ["seq", "movie_id", "person_id", "job", "credit_id"],
}


def _every(column: str, n: int, then, otherwise) -> Column:
    lift = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(F.col(column) % n == 0, lift(then)).otherwise(lift(otherwise))


def _credit_lines(cat, line: int) -> DataFrame:
    return cat.line_orders(line).select(
        (F.col("l_partkey") + 1).cast("int").alias("movie_id"), (F.col("o_custkey") + 1).cast("int").alias("person_id"),
        "o_orderpriority", "o_orderstatus", "l_orderkey", F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_orderkey") * 10 + line).cast("long").alias("seq"),
    )


def raw_tables(cat) -> dict[str, DataFrame]:
    t = cat.tables
    part = t.part.select("p_partkey", "p_name", "p_brand")
    long_name = F.when(F.col("p_partkey") % 43 == 0, F.repeat("p_name", 60)).otherwise(F.col("p_name"))
    movies = part.select(
        _every("p_partkey", 29, 0, F.col("p_partkey") + 1).cast("int").alias("movie_id"),
        _every("p_partkey", 31, None, long_name).alias("title"),
        _every("p_partkey", 41, F.repeat("p_brand", 8), F.col("p_brand")).alias("language"),
        (F.col("p_partkey") * 2).cast("long").alias("seq"),
    )
    again = part.filter(F.col("p_partkey") % 37 == 0).select(
        (F.col("p_partkey") + 1).cast("int").alias("movie_id"), F.lit("Second").alias("title"), F.col("p_brand").alias("language"),
        (F.col("p_partkey") * 2 + 1).cast("long").alias("seq"),
    )
    genres = t.nation.select(
        (F.col("n_nationkey") + 1).cast("int").alias("genre_id"), F.col("n_name").alias("genre_name"), F.col("n_nationkey").cast("long").alias("seq")
    ).unionByName(
        t.region.select(
            (F.col("r_regionkey") + 100).cast("int").alias("genre_id"),
            F.when(F.col("r_regionkey") == 1, F.lit("NATION_1")).otherwise(_every("r_regionkey", 5, None, F.col("r_name"))).alias("genre_name"),
            (F.col("r_regionkey") + 1000).cast("long").alias("seq"),
        )
    )
    companies = t.supplier.select(
        (F.col("s_suppkey") + 1).cast("int").alias("company_id"),
        F.when(F.col("s_suppkey") % 53 == 0, "Supplier duplicate").otherwise(_every("s_suppkey", 59, None, F.col("s_name"))).alias("name"),
        F.col("s_suppkey").cast("long").alias("seq"),
    )
    keywords = part.select(
        (F.col("p_partkey") + 1).cast("int").alias("keyword_id"), _every("p_partkey", 61, None, F.col("p_name")).alias("keyword_name"),
        F.col("p_partkey").cast("long").alias("seq"),
    )
    customer = t.customer.select("c_custkey", "c_name")
    people = customer.select(
        (F.col("c_custkey") + 1).cast("int").alias("person_id"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(_every("c_custkey", 67, F.col("c_custkey") + 2, F.col("c_custkey") + 1)).cast("long").alias("tmdb_id"),
        _every("c_custkey", 71, F.repeat("c_name", 20), F.col("c_name")).alias("name"), F.col("c_custkey").cast("long").alias("seq"),
    )
    users = customer.select(
        _every("c_custkey", 73, None, F.col("c_custkey")).cast("int").alias("user_id"),
        _every("c_custkey", 79, "guest", F.col("c_name")).alias("username"), F.lit(None).cast("string").alias("password_hash"),
        _every("c_custkey", 83, F.repeat(F.lit("r"), 21), "user").alias("role"), F.col("c_custkey").cast("long").alias("seq"),
    )
    rating_lines = [
        cat.line_orders(n).select("o_custkey", "l_partkey", "l_quantity", (F.col("l_orderkey") * 10 + n).cast("long").alias("seq")) for n in (5, 6)
    ]
    ratings = rating_lines[0].unionByName(rating_lines[1]).select(
        F.col("seq").alias("rating_id"), _every("o_custkey", 97, None, F.col("o_custkey")).cast("int").alias("user_id"),
        (_every("l_partkey", 89, 10_000_000, 1) + F.col("l_partkey")).cast("int").alias("movie_id"),
        (F.col("l_quantity").cast("int") % 13).cast("decimal(3,1)").alias("rating"), "seq",
    )
    lines = {n: cat.lines(n).select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_orderkey") * 10 + n).cast("long").alias("seq")) for n in (1, 2, 7)}
    movie_id = (F.col("l_partkey") + 1).cast("int").alias("movie_id")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    cast, crew = _credit_lines(cat, 3), _credit_lines(cat, 4)
    return {
        "movies": movies.unionByName(again),
        "genres": genres,
        "production_companies": companies,
        "ratings": ratings,
        "keywords": keywords,
        "people": people,
        "users": users,
        "movie_genres": lines[1].join(suppliers, "l_suppkey").select(movie_id, (F.col("s_nationkey") + 1).cast("int").alias("genre_id"), "seq"),
        "movie_production_companies": lines[2].select(movie_id, (F.col("l_suppkey") + 1).cast("int").alias("company_id"), "seq"),
        "movie_keywords": lines[7].select(movie_id, (F.col("l_orderkey") % 500 + 1).cast("int").alias("keyword_id"), "seq"),
        "movie_cast": cast.select(
            "movie_id", "person_id", F.col("o_orderpriority").alias("character"), (F.col("qty") % 10).alias("cast_order"),
            F.concat(F.lit("c"), (F.col("l_orderkey") % 5000).cast("string")).alias("credit_id"), "seq",
        ),
        "movie_crew": crew.select(
            "movie_id", "person_id", F.col("o_orderstatus").alias("department"),
            _every("qty", 47, F.repeat("o_orderpriority", 20), F.col("o_orderpriority")).alias("job"),
            F.concat(F.lit("w"), F.col("l_orderkey").cast("string"), _every("qty", 31, F.repeat(F.lit("x"), 50), "")).alias("credit_id"), "seq",
        ),
    }


def checked_tables(cat) -> dict[str, DataFrame]:
    raw = raw_tables(cat)
    return C.check_tables(raw, C.CATALOGUE_RULES, {name: ARRIVAL.get(name, ["seq"]) for name in raw})


def schema_reason_counts(cat) -> DataFrame:
    """How often each constraint of the twelve tables is broken, and accepted rows per table."""
    return C.reason_counts(checked_tables(cat))


def rejected_credits(cat) -> DataFrame:
    """Refused cast and crew rows with the rules they break (credit_id and composite keys)."""
    checked = checked_tables(cat)
    out = None
    for name in ("movie_cast", "movie_crew"):
        part = C.rejected(checked[name]).select(
            F.lit(name).alias("table_name"), "seq", "movie_id", "person_id", "credit_id", F.array_join("reasons", "; ").alias("reasons")
        )
        out = part if out is None else out.unionByName(part)
    return out
