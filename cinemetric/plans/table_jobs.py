"""Batches against stored tables (W-01, W-02, W-05..W-07, S-12, S-13): the tables that result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.operators.constraints import CATALOGUE_RULES, cascade_children
from cinemetric.operators.key_ranges import KeyRangeTable, cascade
from cinemetric.session import checkpoint_dir
from cinemetric.sources import staging as ST

RATING_KEY = ["movie_id", "user_id"]


def _folder(cat) -> str:
    return f"{checkpoint_dir(cat.spark)}/tables-{uuid.uuid4().hex}"


def _table(cat, folder: str, name: str, rows: DataFrame, keys: list[str]) -> KeyRangeTable:
    return KeyRangeTable(cat.spark, f"{folder}/{name}", keys).create(rows)


def _ratings(cat) -> KeyRangeTable:
    return _table(cat, _folder(cat), "ratings", cat.ratings.select("user_id", "movie_id", "rating"), RATING_KEY)


def ratings_table_upserted(cat) -> DataFrame:
    """W-02 / S-12: the ratings table after the line-6 batch, repeated keys included."""
    table = _ratings(cat)
    table.upsert(ST.rating_rows(cat, 6), ST.LINE_SEQ)
    return table.read()


def ratings_table_inserted(cat) -> DataFrame:
    """W-01 / S-13: the same batch inserted, known keys skipped."""
    table = _ratings(cat)
    table.insert_if_absent(ST.rating_rows(cat, 6), ST.LINE_SEQ)
    return table.read()


def ratings_table_deleted(cat) -> DataFrame:
    """W-05: the ratings table without the keys of the line-6 batch (unknown keys are none)."""
    table = _ratings(cat)
    table.delete(ST.rating_rows(cat, 6).select(*RATING_KEY).distinct())
    return table.read()


def _as_rows(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    out = None
    for name, (df, columns) in tables.items():
        part = df.select(F.lit(name).alias("table_name"), F.concat_ws(":", *[F.col(c).cast("string") for c in columns]).alias("key"))
        out = part if out is None else out.unionByName(part)
    return out


#: Keys of the tables that a movie's delete takes along.
MOVIE_CHILD_KEYS = {
    "ratings": ["movie_id", "user_id"], "movie_genres": ["movie_id", "genre_id"],
    "movie_production_companies": ["movie_id", "company_id"], "movie_keywords": ["movie_id", "keyword_id"],
    "movie_cast": ["movie_id", "person_id"], "movie_crew": ["movie_id", "person_id", "job"],
}


def movie_cascade_tables(cat) -> DataFrame:
    """W-06: keys left in the movies table and its six children after the movies without a
    popularity are deleted."""
    folder = _folder(cat)
    movies = _table(cat, folder, "movies", cat.movies.select("movie_id", "title", "popularity"), ["movie_id"])
    names = [name for name, _ in cascade_children(CATALOGUE_RULES, "movies")]
    children = {n: _table(cat, folder, n, getattr(cat, n).select(*MOVIE_CHILD_KEYS[n]), MOVIE_CHILD_KEYS[n]) for n in names}
    gone = movies.read().filter(F.col("popularity").isNull()).select("movie_id")
    cascade(movies, list(children.values()), gone, "movie_id")
    return _as_rows({"movies": (movies.read(), ["movie_id"]), **{n: (t.read(), t.keys) for n, t in children.items()}})


def movie_document_cascade(cat) -> DataFrame:
    """W-06, document flavour: movie documents without a release date go with their credits, keywords
    and all their ratings."""
    folder = _folder(cat)
    movies = _table(cat, folder, "movies", cat.movie_documents.select("id", "title", "release_date"), ["id"])
    credits = _table(cat, folder, "credits", cat.credit_documents.select("id", "cast"), ["id"])
    keywords = _table(cat, folder, "keywords", cat.movie_keywords.select(F.col("movie_id").alias("id")).distinct(), ["id"])
    ratings = _table(cat, folder, "ratings", cat.rating_documents.select("movieId", "userId", "rating"), ["movieId", "userId"])
    gone = movies.read().filter(F.col("release_date").isNull()).select("id")
    cascade(movies, [credits, keywords, ratings], gone, "id")
    return _as_rows({
        "movies": (movies.read(), ["id"]), "credits": (credits.read(), ["id"]), "keywords": (keywords.read(), ["id"]),
        "ratings": (ratings.read(), ["movieId", "userId"]),
    })


def user_cascade_tables(cat) -> DataFrame:
    """W-07: users of one genre go with their ratings; both tables as they are left."""
    folder = _folder(cat)
    users = _table(cat, folder, "users", cat.user_profiles, ["user_id"])
    ratings = _table(cat, folder, "ratings", cat.ratings.select("user_id", "movie_id", "rating"), ["user_id", "movie_id"])
    gone = users.read().filter(F.col("favorite_genre") == "BUILDING").select("user_id")
    cascade(users, [ratings], gone, "user_id")
    return _as_rows({"users": (users.read(), ["user_id"]), "ratings": (ratings.read(), ["user_id", "movie_id"])})
