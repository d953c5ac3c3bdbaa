"""Queries over the document model (Q-11, Q-26, Q-33..Q-40).

Inputs are the catalogue's ``movie_documents`` (``id``, scalars, ``release_date`` text,
``genres`` / ``production_companies`` as ``array<struct<id,name>>``), ``credit_documents``
(``id``, ``cast``, ``crew`` arrays) and ``rating_documents`` (``userId, movieId, rating,
timestamp``).  Array predicates are higher-order functions evaluated inside the scan's
whole-stage code; lookups are joins with pre-aggregated sides.

Document-store conventions: regex terms are case-insensitive regexes; sorts put NULL lowest
(``mongo_asc``/``mongo_desc``); "natural order" is taken to be ascending document id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.functions.cleaning import contains_any_field, names_joined, title_fallback
from cinemetric.functions.ordering import mongo_asc, mongo_desc, top_k


def _rx(pattern: str) -> str:
    return "(?i)" + pattern


def _rating_stats(ratings: DataFrame, ids: DataFrame | None) -> DataFrame:
    r = ratings if ids is None else ratings.join(ids, "movieId", "left_semi")
    # exact: ratings hold one decimal place, so sum them as decimals and divide once
    return r.groupBy("movieId").agg(
        F.sum(F.col("rating").cast("decimal(3,1)")).alias("_s"), F.count(F.lit(1)).alias("num_ratings")
    )


def combined_search(
    movies: DataFrame,
    credits: DataFrame,
    ratings: DataFrame,
    genre: str | None = None,
    actor: str | None = None,
    year_start: int | None = None,
    year_end: int | None = None,
    sort_by: str = "popularity",
    limit: int = 100,
    title: str | None = None,
) -> DataFrame:
    """Q-11: document flavour of the combined search.  The actor filter is a semi-join with
    all credits whose cast names match."""
    docs = movies
    preds = []
    if title:
        t = F.col("title").rlike(_rx(title))
        if "original_title" in movies.columns:
            t = t | F.col("original_title").rlike(_rx(title))
        preds.append(t)
    if genre:
        preds.append(F.exists("genres", lambda g: g["name"].rlike(_rx(genre))))
    if year_start and year_end:
        preds.append(F.col("release_date").between(f"{year_start}-01-01", f"{year_end}-12-31"))
    for p in preds:
        docs = docs.filter(p)
    if actor:
        hits = credits.filter(F.exists("cast", lambda c: c["name"].rlike(_rx(actor)))).select("id")
        docs = docs.join(hits, "id", "left_semi")
    filtered = bool(preds) or bool(actor)
    ids = docs.select(F.col("id").alias("movieId")) if filtered else None
    stats = _rating_stats(ratings, ids)
    out = docs.join(stats, docs.id == stats.movieId, "left")
    avg = F.coalesce(F.col("_s").cast("double") / F.col("num_ratings"), F.lit(0.0))
    out = out.select(
        F.col("id").alias("movie_id"),
        title_fallback(F.col("original_title") if "original_title" in movies.columns else F.lit(None), F.col("title")).alias("title"),
        F.col("release_date").alias("released_date"),
        F.coalesce(F.nullif(F.col("popularity"), F.lit(0.0)), F.lit(0.0)).alias("popularity_out"),
        avg.alias("avg_rating"),
        F.coalesce("num_ratings", F.lit(0)).alias("num_ratings"),
        F.coalesce(names_joined("genres"), F.lit("")).alias("genres"),
        "popularity",
    )
    if sort_by == "rating":
        order = [mongo_desc("avg_rating"), mongo_desc("popularity"), F.col("movie_id")]
    else:
        order = [mongo_desc("popularity"), F.col("movie_id")]
    return top_k(out, order, limit).drop("popularity").withColumnRenamed("popularity_out", "popularity")


def _rating_tier(tier: str) -> Column | None:
    r = F.coalesce(F.col("rating"), F.lit(0.0))
    return {
        "excellent": (r >= 4.0) & (r <= 5.0),
        "high": (r >= 3.0) & (r < 4.0),
        "medium": (r >= 2.0) & (r < 3.0),
        "low": r < 2.0,
    }.get(tier)


def ratings_list(
    ratings: DataFrame,
    movie_id: int | None = None,
    user_id: int | None = None,
    tier: str = "all",
    sort_by: str = "created_desc",
    limit: int | None = 200,
) -> DataFrame:
    """Q-26 / O-10: filters over the whole table, sorted and paged."""
    r = ratings
    if movie_id is not None:
        r = r.filter(F.col("movieId") == movie_id)
    if user_id is not None:
        r = r.filter(F.col("userId") == user_id)
    cond = _rating_tier(tier)
    if cond is not None:
        r = r.filter(cond)
    keys = {
        "created_asc": [mongo_asc("timestamp")],
        "rating_desc": [mongo_desc("rating")],
        "rating_asc": [mongo_asc("rating")],
        "movie_id": [mongo_asc("movieId")],
        "user_id": [mongo_asc("userId")],
    }.get(sort_by, [mongo_desc("timestamp")])
    return top_k(r, keys + [F.col("userId"), F.col("movieId")], limit)


def ratings_list_counts(ratings: DataFrame, movie_id=None, user_id=None, tier="all") -> DataFrame:
    """Q-26 counters: all ratings and ratings left after the filters."""
    r = ratings
    preds = [p for p in (
        F.col("movieId") == movie_id if movie_id is not None else None,
        F.col("userId") == user_id if user_id is not None else None,
        _rating_tier(tier),
    ) if p is not None]
    cond = None
    for p in preds:
        cond = p if cond is None else cond & p
    filtered = F.count_if(cond) if cond is not None else F.count(F.lit(1))
    return r.agg(F.count(F.lit(1)).alias("total_ratings"), filtered.alias("total_filtered"))


def _distinct_embedded(movies: DataFrame, field: str, id_alias: str, name_alias: str) -> DataFrame:
    items = movies.select(F.col("id").alias("movie_id"), F.explode(field).alias("x")).filter(
        F.col("x.id").isNotNull() & (F.col("x.name").isNull() | (F.col("x.name") != ""))
    )
    return items.groupBy(F.col("x.id").alias(id_alias)).agg(
        F.min_by(F.col("x.name"), F.col("movie_id")).alias(name_alias), F.min("movie_id").alias("movie_id")
    )


def distinct_genres(movies: DataFrame) -> DataFrame:
    """Q-33 / A-13: unique genres of the embedded lists, name from the first movie carrying
    the id, with that movie as a sample; by name.  ``min_by`` is combined map-side."""
    out = _distinct_embedded(movies, "genres", "genre_id", "genre_name")
    return out.orderBy(mongo_asc("genre_name"), "genre_id")


def distinct_companies(movies: DataFrame, text: str | None = None, limit: int | None = 100) -> DataFrame:
    """Q-34: unique companies (first occurrence per id), optional case-insensitive name
    substring, by name, first ``limit``."""
    items = movies.select(F.col("id").alias("movie_id"), F.explode("production_companies").alias("x")).filter(
        F.col("x.id").isNotNull() & F.col("x.name").isNotNull()
    )
    if text:
        items = items.filter(F.lower(F.col("x.name")).contains(text.lower()))
    out = items.groupBy(F.col("x.id").alias("company_id")).agg(
        F.min_by(F.col("x.name"), F.col("movie_id")).alias("name"), F.min("movie_id").alias("movie_id")
    )
    return top_k(out, [mongo_asc("name"), F.col("company_id")], limit)


def genre_movies(movies: DataFrame, genre_id, limit: int = 50) -> DataFrame:
    """Q-35: movies whose genres hold this id (int or text form, C-23), popularity DESC."""
    key = str(genre_id).strip()
    hit = movies.filter(F.exists("genres", lambda g: F.trim(g["id"].cast("string")) == F.lit(key)))
    out = hit.select(
        F.col("id").alias("movie_id"), F.coalesce(F.col("original_title") if "original_title" in movies.columns else F.lit(None), F.col("title")).alias("title"),
        F.col("release_date").alias("released_date"), "popularity",
    )
    return top_k(out, [mongo_desc("popularity"), F.col("movie_id")], limit).drop("popularity")


def genre_movie_count(movies: DataFrame, genre_id) -> DataFrame:
    key = str(genre_id).strip()
    hit = movies.filter(F.exists("genres", lambda g: F.trim(g["id"].cast("string")) == F.lit(key)))
    return hit.agg(F.count(F.lit(1)).alias("movie_count"))


def company_movies(movies: DataFrame, company_id, limit: int = 50) -> DataFrame:
    """Q-36: movies listing the company (each counted once), first ``limit`` by id."""
    key = str(company_id).strip()
    hit = movies.filter(F.exists("production_companies", lambda c: F.trim(c["id"].cast("string")) == F.lit(key)))
    out = hit.select(F.col("id").alias("movie_id"), "title", F.col("release_date").alias("released_date"))
    return top_k(out, [F.col("movie_id")], limit)


def _credit_rows(movies: DataFrame, credits: DataFrame, field: str) -> DataFrame:
    titles = movies.select("id", F.col("title").alias("_title"))
    # J-13: a credit whose movie is missing gets the label "Movie #<id>"; one join row per credits document
    label = F.coalesce("_title", F.concat(F.lit("Movie #"), F.col("id").cast("string"))).alias("movie_title")
    titled = credits.select("id", field).join(titles, "id", "left").select("id", label, field)
    return titled.select("id", "movie_title", F.posexplode(field).alias("pos", "c"))


def cast_list(movies: DataFrame, credits: DataFrame, text: str | None = None, limit: int | None = 100) -> DataFrame:
    """Q-37 / R-02: one row per cast element with its movie title; optional lower-case
    substring over title, name and character; first ``limit`` by (movie id, position)."""
    rows = _credit_rows(movies, credits, "cast").select(
        F.col("id").alias("movie_id"), "pos", "movie_title", F.col("c.id").alias("person_id"),
        F.col("c.name").alias("name"), F.col("c.character").alias("character"), F.col("c.order").alias("cast_order"),
    )
    if text:
        rows = rows.filter(contains_any_field(["movie_title", "name", "character"], text))
    return top_k(rows, [F.col("movie_id"), F.col("pos")], limit).drop("pos")


def crew_list(movies: DataFrame, credits: DataFrame, text: str | None = None, limit: int | None = 100) -> DataFrame:
    """Q-38 / R-03: one row per crew element; filter over title, name, job, department."""
    rows = _credit_rows(movies, credits, "crew").select(
        F.col("id").alias("movie_id"), "pos", "movie_title", F.col("c.id").alias("person_id"),
        F.col("c.name").alias("name"), F.col("c.job").alias("job"), F.col("c.department").alias("department"),
    )
    if text:
        rows = rows.filter(contains_any_field(["movie_title", "name", "job", "department"], text))
    return top_k(rows, [F.col("movie_id"), F.col("pos")], limit).drop("pos")


def valid_elements(arr, *required: str) -> Column:
    """R-08: elements that carry all ``required`` fields (non-null)."""
    return F.filter(arr, lambda x: _all_present(x, required))


def _all_present(x, fields) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & x[f].isNotNull()
    return out


def movie_details(movies: DataFrame, credits: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Q-39 (batch form): each movie with its genres, companies, cast and crew, keeping only
    elements that carry an id and a name."""
    docs = movies if ids is None else movies.join(ids, "id", "left_semi")
    out = docs.join(credits, "id", "left")
    return out.select(
        F.col("id").alias("movie_id"), "title",
        valid_elements(F.coalesce("genres", F.array()), "id", "name").alias("genres"),
        valid_elements(F.coalesce("production_companies", F.array()), "id", "name").alias("production_companies"),
        valid_elements(F.coalesce("cast", F.array()), "id", "name").alias("cast"),
        valid_elements(F.coalesce("crew", F.array()), "id", "name").alias("crew"),
    )


def movie_details_as_text(details: DataFrame) -> DataFrame:
    return details.select(
        "movie_id", "title",
        names_joined("genres").alias("genre_names"),
        names_joined("production_companies").alias("company_names"),
        names_joined("cast").alias("cast_names"),
        F.array_join(F.transform("crew", lambda c: F.concat_ws(":", c["name"], c["job"])), ", ").alias("crew_jobs"),
    )


def movies_by_genre_name(movies: DataFrame, name: str, limit: int | None = 20) -> DataFrame:
    """Q-40: exact genre name, numeric ids only (F-13), popularity DESC."""
    hit = movies.filter(F.exists("genres", lambda g: g["name"] == F.lit(name)) & F.col("id").isNotNull())
    out = hit.select(F.col("id").alias("movie_id"), "title", "popularity")
    return top_k(out, [mongo_desc("popularity"), F.col("movie_id")], limit)


def popular_movies(movies: DataFrame, limit: int = 20) -> DataFrame:
    """Q-40: most popular documents."""
    out = movies.select(F.col("id").alias("movie_id"), "title", "popularity")
    return top_k(out, [mongo_desc("popularity"), F.col("movie_id")], limit)


def movies_page(movies: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-40: paged listing by id DESC."""
    out = movies.select(F.col("id").alias("movie_id"), "title", "release_date")
    return top_k(out, [mongo_desc("movie_id")], limit, offset)


def genre_names_of(movies: DataFrame) -> DataFrame:
    """Q-41 document flavour: (movie, genre id, genre name) with defaults 0 / 'Unknown'."""
    rows = movies.select(F.col("id").alias("movie_id"), F.posexplode("genres").alias("pos", "g"))
    return rows.select(
        "movie_id", "pos", F.coalesce(F.col("g.id"), F.lit(0)).alias("genre_id"),
        F.coalesce(F.col("g.name"), F.lit("Unknown")).alias("genre_name"),
    )


def genre_movies_all(movies: DataFrame, per_genre: int = 50) -> DataFrame:
    """Q-35 for every embedded genre id: its ``per_genre`` most popular documents."""
    from cinemetric.plans.common import top_k_per_group

    # each document once per distinct genre id it lists
    rows = movies.select(F.col("id").alias("movie_id"), "title", F.col("release_date").alias("released_date"),
                         "popularity", F.explode(F.array_distinct(F.transform("genres", lambda g: g["id"]))).alias("genre_id"))
    top = top_k_per_group(rows, ["genre_id"], [mongo_desc("popularity"), F.col("movie_id")], per_genre, ["movie_id"])
    return top.select("genre_id", "movie_id", "title", "released_date")


def genre_movie_counts(movies: DataFrame) -> DataFrame:
    """Q-35 counts for every embedded genre id (a document counts once per genre)."""
    ids = movies.select(F.col("id"), F.explode(F.array_distinct(F.transform("genres", lambda g: g["id"]))).alias("genre_id"))
    return ids.groupBy("genre_id").agg(F.count(F.lit(1)).alias("movie_count"))


def company_movies_all(movies: DataFrame, per_company: int = 50) -> DataFrame:
    """Q-36 for every embedded company id: first ``per_company`` documents by id, each once."""
    from cinemetric.plans.common import top_k_per_group

    rows = movies.select(F.col("id").alias("movie_id"), "title", F.col("release_date").alias("released_date"),
                         F.explode(F.array_distinct(F.transform("production_companies", lambda c: c["id"]))).alias("company_id"))
    top = top_k_per_group(rows, ["company_id"], [F.col("movie_id")], per_company, ["movie_id"])
    return top.select("company_id", "movie_id", "title", "released_date")
