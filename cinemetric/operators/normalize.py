"""Set-oriented load of the relational catalogue (N-01..N-14).

The source loads one CSV row at a time inside a transaction; here every step is one
DataFrame job over the whole staging table:

* dimensions (genres, companies, keywords) = distinct names with ordered surrogate ids;
* bridges = joins on the name + ``distinct``;
* "last wins" / "first wins" upserts = ``max_by`` / ``min_by`` over an explicit ``seq``
  (Spark has no stable CSV row order, so staging rows carry their source position).

Surrogate ids are assigned in name order (``ordered_index``) rather than in first-seen
order, so they do not depend on how the input was split into partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.operators.keys import first_by, last_by, ordered_index


def dimension_from_lists(staged: DataFrame, list_col: str, id_col: str, name_col: str, start: int = 1) -> DataFrame:
    """N-01/N-03/N-04: unique non-empty ``name`` values of an ``array<struct<...,name>>``
    column with dense ids in name order."""
    names = (
        staged.select(F.explode(list_col).alias("x"))
        .select(F.col("x.name").alias(name_col))
        .filter(F.col(name_col).isNotNull() & (F.col(name_col) != ""))
        .distinct()
    )
    return ordered_index(names, [name_col], id_col, start).select(id_col, name_col)


def bridge_from_lists(staged: DataFrame, key: str, list_col: str, dim: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """N-02: unique (movie, dimension id) pairs, joined on the name."""
    pairs = staged.select(key, F.explode(list_col).alias("x")).select(key, F.col("x.name").alias(name_col))
    return pairs.join(dim, name_col).select(key, id_col).distinct()


def upsert_people(credits: DataFrame, seq: Sequence[str]) -> DataFrame:
    """N-05/N-06: people from credit rows ``(tmdb_id, name, gender, profile_path, seq...)``.
    With a tmdb_id the *last* row wins name/gender/profile.  Without one, a row is a person
    that is known already, with a tmdb_id or without, when (name, profile_path) match
    null-safely; the first row of a new person keeps its gender."""
    with_id = last_by(credits.filter(F.col("tmdb_id").isNotNull()), ["tmdb_id"], seq, ["name", "gender", "profile_path"])
    no_id = credits.filter(F.col("tmdb_id").isNull())
    # null-safe grouping: a NULL profile_path forms its own group, as IS NOT DISTINCT FROM does
    anon = first_by(no_id, ["name", "profile_path"], seq, ["gender"]).withColumn("tmdb_id", F.lit(None).cast("long"))
    named = with_id.select(F.col("name").alias("_name"), F.col("profile_path").alias("_path"))
    anon = anon.join(
        named, F.col("name").eqNullSafe(F.col("_name")) & F.col("profile_path").eqNullSafe(F.col("_path")), "left_anti"
    )
    people = with_id.select("tmdb_id", "name", "gender", "profile_path").unionByName(
        anon.select("tmdb_id", "name", "gender", "profile_path")
    )
    return ordered_index(people, ["tmdb_id", "name", "profile_path"], "person_id")


def first_credit(rows: DataFrame, keys: Sequence[str], seq: Sequence[str], values: Sequence[str]) -> DataFrame:
    """N-07/N-08: ``ON CONFLICT DO NOTHING`` on ``keys`` — the first row in ``seq`` wins."""
    return first_by(rows, keys, seq, values)


def upsert_movies(rows: DataFrame, seq: Sequence[str], values: Sequence[str], created_at: str = "created_at") -> DataFrame:
    """N-09: the last row wins every column, ``created_at`` stays from the first row."""
    last = last_by(rows, ["movie_id"], seq, values)
    first = first_by(rows, ["movie_id"], seq, [created_at])
    return last.join(first, "movie_id")


def upsert_ratings(rows: DataFrame, seq: Sequence[str]) -> DataFrame:
    """N-10: per (user, movie) the rating of the last row and the created_at of the first —
    both in one aggregation pass."""
    order = F.struct(*[F.col(s) for s in seq])
    return rows.groupBy("user_id", "movie_id").agg(
        F.max_by("rating", order).alias("rating"),
        F.min_by("created_at", order).alias("created_at"),
        F.max_by("created_at", order).alias("updated_at"),
    )


def synthetic_users(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """N-11: existing users are kept; every other user id seen in ratings is added with
    ``is_synthetic = true``."""
    seen = ratings.select("user_id").distinct()
    new = seen.join(users.select("user_id"), "user_id", "left_anti").withColumn("is_synthetic", F.lit(True))
    return users.select("user_id", F.coalesce("is_synthetic", F.lit(False)).alias("is_synthetic")).unionByName(new)


def remap_rating_ids(ratings: DataFrame, links: DataFrame) -> DataFrame:
    """N-12 / J-14: drop links without a tmdb id, cast it to int, inner-join the ratings on
    ``movieId`` and replace it with the tmdb id (column order userId, movieId, rating,
    timestamp)."""
    bridge = links.filter(F.col("tmdbId").isNotNull()).select("movieId", F.col("tmdbId").cast("int").alias("tmdbId"))
    joined = ratings.join(bridge, "movieId")
    return joined.select("userId", F.col("tmdbId").alias("movieId"), "rating", "timestamp")


def remap_counts(ratings: DataFrame, merged: DataFrame) -> DataFrame:
    """A-18 for N-12: ratings before the id remap, after it, and lost (one pass each side,
    no join between them)."""
    sides = ratings.select(F.lit(0).alias("_side")).unionByName(merged.select(F.lit(1).alias("_side")))
    return sides.agg(
        F.count_if(F.col("_side") == 0).alias("original_ratings"),
        F.count_if(F.col("_side") == 1).alias("merged_ratings"),
    ).withColumn("lost_ratings", F.col("original_ratings") - F.col("merged_ratings"))


def load_counts(accepted: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    """A-18: one audit row: input = ok + errors."""
    flags = accepted.select(F.lit(True).alias("_ok")).unionByName(rejected.select(F.lit(False).alias("_ok")))
    return flags.agg(
        F.lit(label).alias("file"), F.count(F.lit(1)).alias("input"), F.count_if("_ok").alias("ok"),
        F.count_if(~F.col("_ok")).alias("errors"),
    )
