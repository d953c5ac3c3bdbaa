"""Text look-ups over stored trigram postings, and siblings as class rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.functions.ordering import pg_asc, top_k
from cinemetric.operators.text_index import TextIndex
from cinemetric.session import checkpoint_dir


def _index(cat, rows: DataFrame, key: str, text: str) -> TextIndex:
    return TextIndex(cat.spark, f"{checkpoint_dir(cat.spark)}/text-{uuid.uuid4().hex}", key, text).build(rows)


def titles_found(cat, text: str) -> DataFrame:
    """F-03: every movie whose title holds the text."""
    rows = cat.movies.select("movie_id", "title", "released_date")
    return _index(cat, rows, "movie_id", "title").search(text)


def people_found(cat, text: str, limit: int | None = 50) -> DataFrame:
    """Q-30: people by name, from the postings."""
    found = _index(cat, cat.people.select("person_id", "name", "gender"), "person_id", "name").search(text)
    return top_k(found, [pg_asc("name"), F.col("person_id")], limit)


def movies_found(cat, text: str, limit: int | None = 50) -> DataFrame:
    """Q-30: movies by title, from the postings."""
    found = _index(cat, cat.movies.select("movie_id", "title"), "movie_id", "title").search(text)
    return top_k(found, [pg_asc("title"), F.col("movie_id")], limit)


def _classes(bridge: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    member = F.struct(F.col(name).alias("n"), F.col(key).alias("k"))
    return bridge.join(dim, key).groupBy("movie_id").agg(F.array_sort(F.collect_list(member)).alias("members"))


def class_rows(cat, key: str, name: str) -> DataFrame:
    """Q-19 / Q-20 for every link: one row per movie with its members; a link's siblings are the members
    but itself, so the output grows with the links and not with their squares."""
    bridge, dim = (cat.movie_genres, cat.genres) if key == "genre_id" else (cat.movie_production_companies, cat.production_companies)
    rows = _classes(bridge, dim, key, name)
    return rows.select("movie_id", F.size("members").alias("n_members"), F.array_join(F.transform("members", lambda m: m["n"]), ", ").alias("names"))


def siblings_of(cat, requests: DataFrame, key: str, name: str) -> DataFrame:
    """Q-19 / Q-20 for a request table of (movie, member): each request's siblings."""
    bridge, dim = (cat.movie_genres, cat.genres) if key == "genre_id" else (cat.movie_production_companies, cat.production_companies)
    wanted = requests.select("movie_id", key).distinct()
    members = _classes(bridge.join(wanted.select("movie_id").distinct(), "movie_id", "left_semi"), dim, key, name)
    rest = F.filter("members", lambda m: m["k"] != F.col(key))
    return wanted.join(members, "movie_id").select("movie_id", key, F.array_join(F.transform(rest, lambda m: m["n"]), ", ").alias("others"))


def company_siblings_requested(cat) -> DataFrame:
    """Q-20 for one request per company: its link with the smallest movie id."""
    requests = cat.movie_production_companies.groupBy("company_id").agg(F.min("movie_id").alias("movie_id"))
    return siblings_of(cat, requests, "company_id", "name")
