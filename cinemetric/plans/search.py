"""Catalogue search and drill-down queries (relational model).

Every function takes a catalogue (an object exposing the relational views as DataFrames,
see ``cinemetric.sources.catalogue.Catalogue``) plus plain parameters and returns a lazy
DataFrame.  Point lookups of the source application are written in their batch form:
``movie_ids``/``person_ids``/``company_ids`` take a DataFrame of keys (``None`` = every key).

Result conventions follow the source application: the relational engine's null placement
(``pg_asc``/``pg_desc``), zero-as-null or null-as-zero output conversions, and the same page
sizes; a unique key is appended to each order so paging is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.functions.ordering import asc_nulls_last, desc_nulls_last, pg_asc, pg_desc, top_k
from cinemetric.plans.common import (
    all_of,
    avg_at_least,
    avg_below,
    exact_avg,
    ilike_contains,
    keep_movies,
    facts_of,
    nested_lists,
    resort,
    search_docs_of,
    null_as_zero,
    rating_stats,
    top_k_per_group,
    year_range,
    zero_as_null,
)

# ---------------------------------------------------------------------------------------
# Q-01 full details, Q-43 deep fetch
# ---------------------------------------------------------------------------------------


def _sorted(arr: str, fields: list[str]) -> Column:
    """Sort an array of structs whose leading fields are sort keys, then drop the keys."""
    return F.transform(F.array_sort(F.col(arr)), lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def movie_full_details(cat, movie_ids: DataFrame | None = None) -> DataFrame:
    """Q-01: base row + exact AVG/COUNT of ratings + genres (by name), cast (by cast_order,
    nulls last), crew (by department, job, name) and companies (by name) as arrays.

    The four lists come out of one aggregation over the union of the four bridge tables
    (``nested_lists``) and meet the movies in one join; the arrays hold one movie's credits."""
    docs = search_docs_of(cat)
    if docs is not None:  # one scan: the lists are embedded in the search documents
        return _details_from_documents(keep_movies(docs, movie_ids))
    movies = keep_movies(cat.movies, movie_ids)
    stats = facts_of(cat, False).select("movie_id", "rating_sum", "rating_count")
    people = cat.people.select("person_id", "name", "gender")
    g = keep_movies(cat.movie_genres, movie_ids).join(cat.genres, "genre_id")
    c = keep_movies(cat.movie_cast, movie_ids).join(people, "person_id")
    w = keep_movies(cat.movie_crew, movie_ids).join(people, "person_id")
    p = keep_movies(cat.movie_production_companies, movie_ids).join(cat.production_companies, "company_id")
    lists = nested_lists({
        "genres": (g, F.struct(F.col("genre_name").alias("k0"), "genre_id", "genre_name")),
        "cast": (c, F.struct(F.col("cast_order").isNull().alias("k0"), F.col("cast_order").alias("k1"),
                             F.col("person_id").alias("k2"), "person_id", "name", "gender", "character", "cast_order")),
        "crew": (w, F.struct(F.col("department").alias("k0"), F.col("job").alias("k1"), F.col("name").alias("k2"),
                             F.col("person_id").alias("k3"), "person_id", "name", "gender", "department", "job")),
        "production_companies": (p, F.struct(F.col("name").alias("k0"), F.col("company_id").alias("k1"),
                                             "company_id", "name")),
    })
    lists = lists.select(
        "movie_id",
        _sorted("genres", ["genre_id", "genre_name"]).alias("genres"),
        _sorted("cast", ["person_id", "name", "gender", "character", "cast_order"]).alias("cast"),
        _sorted("crew", ["person_id", "name", "gender", "department", "job"]).alias("crew"),
        _sorted("production_companies", ["company_id", "name"]).alias("production_companies"),
    )
    out = movies.join(stats, "movie_id", "left").join(lists, "movie_id", "left")
    empty = F.array()
    return out.select(
        "movie_id",
        "title",
        "adult",
        "overview",
        "language",
        zero_as_null("popularity").alias("popularity"),
        "released_date",
        "runtime",
        zero_as_null(exact_avg()).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("num_ratings"),
        F.coalesce("genres", empty).alias("genres"),
        F.coalesce("cast", empty).alias("cast"),
        F.coalesce("crew", empty).alias("crew"),
        F.coalesce("production_companies", empty).alias("production_companies"),
    )


def _details_from_documents(docs: DataFrame) -> DataFrame:
    """Q-01 from the stored search documents: the embedded lists re-ordered as the relational
    form orders them (genres / companies by name, cast by cast_order NULLS LAST, crew by
    department, job, name)."""
    f = lambda name: (name, lambda x: x[name])
    return docs.select(
        "movie_id", "title", "adult", "overview", "language",
        zero_as_null("popularity").alias("popularity"), "released_date", "runtime",
        zero_as_null(exact_avg()).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("num_ratings"),
        resort("genre_list", [lambda x: x["name"]],
               [("genre_id", lambda x: x["id"]), ("genre_name", lambda x: x["name"])]).alias("genres"),
        resort("cast_list", [lambda x: x["cast_order"].isNull(), lambda x: x["cast_order"], lambda x: x["id"]],
               [("person_id", lambda x: x["id"]), f("name"), f("gender"), f("character"), f("cast_order")]).alias("cast"),
        resort("crew_list", [lambda x: x["department"], lambda x: x["job"], lambda x: x["name"], lambda x: x["id"]],
               [("person_id", lambda x: x["id"]), f("name"), f("gender"), f("department"), f("job")]).alias("crew"),
        resort("company_list", [lambda x: x["name"], lambda x: x["id"]],
               [("company_id", lambda x: x["id"]), f("name")]).alias("production_companies"),
    )


def details_as_text(details: DataFrame) -> DataFrame:
    """Flatten the nested arrays of ``movie_full_details`` into ordered text columns."""

    def joined(arr: str, render) -> Column:
        return F.array_join(F.transform(arr, render), "; ")

    return details.select(
        "movie_id",
        "title",
        "adult",
        "overview",
        "language",
        "popularity",
        "released_date",
        "runtime",
        "avg_rating",
        "num_ratings",
        joined("genres", lambda g: g["genre_name"]).alias("genre_names"),
        joined(
            "cast",
            lambda c: F.concat_ws(" | ", c["name"], c["character"], F.coalesce(c["cast_order"].cast("string"), F.lit("-"))),
        ).alias("cast_text"),
        joined("crew", lambda c: F.concat_ws(" | ", c["name"], c["department"], c["job"])).alias("crew_text"),
        joined("production_companies", lambda c: c["name"]).alias("company_names"),
    )


def deep_fetch(cat, movie_ids: DataFrame | None = None, movie_id: Column | None = None) -> DataFrame:
    """Q-43: movie + genres[] + companies[] as ``{id, name}`` lists, ``[]`` when none.
    The two correlated ``json_agg`` sub-queries become one two-list aggregation + one join.
    ``movie_id`` (a literal or scalar sub-query Column) restricts every branch by a plain
    filter, which needs no join at all."""
    def pick(df: DataFrame) -> DataFrame:
        df = keep_movies(df, movie_ids)
        return df.filter(F.col("movie_id") == movie_id) if movie_id is not None else df

    docs = search_docs_of(cat)
    if docs is not None:  # one scan of the search documents
        out = pick(docs).select(
            "movie_id", "title", "released_date", "overview", "runtime",
            F.array_sort("genre_list").alias("genres"), F.array_sort("company_list").alias("production_companies"),
        )
        return out
    movies = pick(cat.movies).select("movie_id", "title", "released_date", "overview", "runtime")
    g = pick(cat.movie_genres).join(cat.genres, "genre_id")
    c = pick(cat.movie_production_companies).join(cat.production_companies, "company_id")
    lists = nested_lists({
        "genres": (g, F.struct(F.col("genre_id").alias("id"), F.col("genre_name").alias("name"))),
        "production_companies": (c, F.struct(F.col("company_id").alias("id"), F.col("name").alias("name"))),
    })
    out = movies.join(lists, "movie_id", "left")
    return out.select(
        "movie_id",
        "title",
        "released_date",
        "overview",
        "runtime",
        F.coalesce(F.array_sort("genres"), F.array()).alias("genres"),
        F.coalesce(F.array_sort("production_companies"), F.array()).alias("production_companies"),
    )


def deep_fetch_as_text(df: DataFrame) -> DataFrame:
    render = lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x["name"])
    return df.select(
        "movie_id",
        "title",
        "released_date",
        "overview",
        "runtime",
        F.array_join(F.transform("genres", render), ", ").alias("genres_text"),
        F.array_join(F.transform("production_companies", render), ", ").alias("companies_text"),
    )


# ---------------------------------------------------------------------------------------
# Q-02..Q-09 user search functions
# ---------------------------------------------------------------------------------------


def title_search(cat, text: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-02: title ILIKE, exact AVG, rating count, all genre names; AVG DESC NULLS LAST,
    popularity DESC (nulls first)."""
    docs = search_docs_of(cat)
    if docs is not None:  # one scan of the search documents (facts already attached)
        out = docs.filter(ilike_contains("title", text))
    else:
        out = cat.movies.filter(ilike_contains("title", text)).join(facts_of(cat), "movie_id", "left")
    out = out.select(
        "movie_id",
        "title",
        "released_date",
        zero_as_null("popularity").alias("popularity"),
        "runtime",
        "overview",
        zero_as_null(exact_avg()).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("num_ratings"),
        "genres",
        F.col("popularity").alias("_pop"),
        exact_avg().alias("_avg"),
    )
    return top_k(out, [desc_nulls_last("_avg"), pg_desc("_pop"), F.col("movie_id")], limit, offset).drop("_pop", "_avg")


def _movies_with_avg(cat, movies: DataFrame, with_count: bool) -> DataFrame:
    stats = facts_of(cat, False).select("movie_id", "rating_sum", "rating_count")
    out = movies.join(stats, "movie_id", "left").withColumn("avg_rating", exact_avg())
    if with_count:
        out = out.withColumn("num_ratings", F.coalesce("rating_count", F.lit(0)))
    return out.drop("rating_sum", "rating_count")


def genre_search(cat, genre_name: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-03: movies of the genre with this exact name; AVG + COUNT; popularity DESC."""
    docs = search_docs_of(cat)
    if docs is not None:  # one scan: exact-name array predicate on the embedded genres
        hit = docs.filter(F.exists("genre_list", lambda g: g["name"] == F.lit(genre_name)))
        out = hit.select("movie_id", "title", "released_date", "popularity", exact_avg().alias("avg_rating"),
                         F.coalesce("rating_count", F.lit(0)).alias("num_ratings"))
    else:
        genre = cat.genres.filter(F.col("genre_name") == genre_name).select("genre_id")
        ids = cat.movie_genres.join(genre, "genre_id", "left_semi").select("movie_id")
        movies = keep_movies(cat.movies, ids).select("movie_id", "title", "released_date", "popularity")
        out = _movies_with_avg(cat, movies, True)
    out = top_k(out, [pg_desc("popularity"), F.col("movie_id")], limit, offset)
    return out.withColumn("popularity", F.col("popularity").cast("double"))


def company_search(cat, company_name: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-04: movies of the company with this exact name; AVG only; popularity DESC."""
    docs = search_docs_of(cat)
    if docs is not None:  # one scan: exact-name array predicate on the embedded companies
        hit = docs.filter(F.exists("company_list", lambda c: c["name"] == F.lit(company_name)))
        out = hit.select("movie_id", "title", "released_date", "popularity", exact_avg().alias("avg_rating"))
    else:
        comp = cat.production_companies.filter(F.col("name") == company_name).select("company_id")
        ids = cat.movie_production_companies.join(comp, "company_id", "left_semi").select("movie_id")
        movies = keep_movies(cat.movies, ids).select("movie_id", "title", "released_date", "popularity")
        out = _movies_with_avg(cat, movies, False)
    out = top_k(out, [pg_desc("popularity"), F.col("movie_id")], limit, offset)
    return out.withColumn("popularity", F.col("popularity").cast("double"))


def date_range_search(cat, start: str, end: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-05: inclusive release-date range (pushed to the scan as a range); date DESC."""
    movies = cat.movies.filter(F.col("released_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    out = movies.select("movie_id", "title", "released_date", F.col("popularity").cast("double").alias("popularity"), "runtime")
    return top_k(out, [pg_desc("released_date"), F.col("movie_id")], limit, offset)


def min_rating_search(cat, min_rating: float, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-06: rated movies only, HAVING AVG >= min (exact); AVG DESC."""
    docs = search_docs_of(cat)
    rated = (F.col("rating_count") > 0) & avg_at_least(min_rating)
    if docs is not None:  # one scan of the search documents
        out = docs.filter(rated)
    else:
        out = cat.movies.join(facts_of(cat, False).filter(rated), "movie_id")
    out = out.select(
        "movie_id", "title", "released_date", exact_avg().alias("avg_rating"), F.col("rating_count").alias("num_ratings")
    )
    return top_k(out, [pg_desc("avg_rating"), F.col("movie_id")], limit, offset)


def actor_search(cat, name_text: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-07: one row per (movie, character) of cast members whose name matches; AVG of the
    movie's ratings; release date DESC."""
    people = cat.people.filter(ilike_contains("name", name_text)).select("person_id")
    roles = cat.movie_cast.join(people, "person_id", "left_semi").select("movie_id", "character").distinct()
    movies = cat.movies.select("movie_id", "title", "released_date").join(roles, "movie_id")
    stats = facts_of(cat, False).select("movie_id", "rating_sum", "rating_count")
    out = movies.join(stats, "movie_id", "left").select(
        "movie_id", "title", "released_date", "character", exact_avg().alias("avg_rating")
    )
    return top_k(out, [pg_desc("released_date"), F.col("movie_id"), asc_nulls_last("character")], limit, offset)


def crew_search(cat, name_text: str, job: str | None = None, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-08: one row per matching crew credit (duplicates kept); release date DESC."""
    people = cat.people.filter(ilike_contains("name", name_text)).select("person_id")
    crew = cat.movie_crew.join(people, "person_id", "left_semi")
    if job:
        crew = crew.filter(F.col("job") == job)
    out = cat.movies.select("movie_id", "title", "released_date").join(crew, "movie_id")
    out = top_k(out, [pg_desc("released_date"), F.col("movie_id"), F.col("person_id"), F.col("job")], limit, offset)
    return out.select("movie_id", "title", "released_date", "job", "department")


def keyword_search(cat, keyword_text: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Q-09: one row per matching (movie, keyword) pair (duplicates kept); popularity DESC."""
    kw = cat.keywords.filter(ilike_contains("keyword_name", keyword_text)).select("keyword_id")
    pairs = cat.movie_keywords.join(kw, "keyword_id", "left_semi")
    out = cat.movies.select("movie_id", "title", "released_date", "popularity").join(pairs, "movie_id")
    out = top_k(out, [pg_desc("popularity"), F.col("movie_id"), F.col("keyword_id")], limit, offset)
    return out.select("movie_id", "title", "released_date", F.col("popularity").cast("double").alias("popularity"))


# ---------------------------------------------------------------------------------------
# Q-10 combined search, Q-12 ratings browse
# ---------------------------------------------------------------------------------------


def combined_search(
    cat,
    genre: str | None = None,
    actor: str | None = None,
    year_start: int | None = None,
    year_end: int | None = None,
    sort_by: str = "popularity",
    limit: int = 100,
    title: str | None = None,
) -> DataFrame:
    """Q-10: optional title / genre (partial) / actor (partial) / year-range filters, each
    applied as a semi-join only when given (join elision); every movie kept with AVG 0 when
    unrated; the genre list shows all genres of the movie."""
    pred = all_of([ilike_contains("title", title) if title else None, year_range("released_date", year_start, year_end)])
    docs = search_docs_of(cat)
    if docs is not None:
        # one scan: the genre / actor filters are array predicates on the search documents
        out = docs.filter(all_of([
            pred,
            F.exists("genre_list", lambda g: g["name"].ilike(f"%{genre}%")) if genre else None,
            F.exists("cast_list", lambda c: c["name"].ilike(f"%{actor}%")) if actor else None,
        ]) if (pred is not None or genre or actor) else F.lit(True))
        return _combined_output(out, sort_by, limit)
    movies = cat.movies.select("movie_id", "title", "released_date", "popularity")
    if pred is not None:
        movies = movies.filter(pred)
    if genre:
        g = cat.genres.filter(ilike_contains("genre_name", genre)).select("genre_id")
        movies = movies.join(cat.movie_genres.join(g, "genre_id", "left_semi").select("movie_id"), "movie_id", "left_semi")
    if actor:
        p = cat.people.filter(ilike_contains("name", actor)).select("person_id")
        movies = movies.join(cat.movie_cast.join(p, "person_id", "left_semi").select("movie_id"), "movie_id", "left_semi")
    return _combined_output(movies.join(facts_of(cat), "movie_id", "left"), sort_by, limit)


def _combined_output(out: DataFrame, sort_by: str, limit: int | None) -> DataFrame:
    avg0 = F.coalesce(exact_avg(), F.lit(0.0))
    out = out.select(
        "movie_id",
        "title",
        "released_date",
        null_as_zero("popularity").alias("popularity_out"),
        avg0.alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("num_ratings"),
        F.coalesce("genres", F.lit("")).alias("genres"),
        "popularity",
    )
    if sort_by == "rating":
        order = [desc_nulls_last("avg_rating"), desc_nulls_last("popularity"), F.col("movie_id")]
    else:
        order = [desc_nulls_last("popularity"), F.col("movie_id")]
    out = top_k(out, order, limit)
    return out.drop("popularity").withColumnRenamed("popularity_out", "popularity")


RATING_TIERS = ("excellent", "high", "medium", "low", "all")


def _avg_tier(tier: str) -> Column | None:
    """C-19 on an average (HAVING): no upper bound on 'excellent'."""
    if tier == "excellent":
        return avg_at_least(4.0)
    if tier == "high":
        return avg_at_least(3.0) & avg_below(4.0)
    if tier == "medium":
        return avg_at_least(2.0) & avg_below(3.0)
    if tier == "low":
        return avg_below(2.0)
    return None


def _browse_groups(cat, tier: str, movie_id: int | None, user_id: int | None) -> DataFrame:
    cond = _avg_tier(tier)
    if movie_id is None and user_id is None:
        groups = facts_of(cat).filter(F.col("rating_count") > 0)
        return groups.filter(cond) if cond is not None else groups
    ratings = cat.ratings
    if movie_id is not None:
        ratings = ratings.filter(F.col("movie_id") == movie_id)
    if user_id is not None:
        # movies this user rated; the average stays over all users' ratings (J-06)
        rated = cat.ratings.filter(F.col("user_id") == user_id).select("movie_id")
        ratings = ratings.join(rated, "movie_id", "left_semi")
    stats = rating_stats(ratings).filter(F.col("rating_count") > 0)
    stats = stats.filter(cond) if cond is not None else stats
    # the genre list of the page comes from the facts as well (all genres of the movie)
    return stats.join(facts_of(cat).select("movie_id", "genres"), "movie_id", "left")


def ratings_browse(
    cat,
    tier: str = "all",
    sort_by: str = "rating_desc",
    movie_id: int | None = None,
    user_id: int | None = None,
    limit: int = 100,
    seed: int = 42,
) -> DataFrame:
    """Q-12: rated movies with an AVG tier (HAVING), optional movie / rated-by-user filters,
    six sort modes (``random``: the smallest seeded hashes of the movie ids, the same for any
    partitions of the input, O-07)."""
    docs = search_docs_of(cat)
    if docs is not None and movie_id is None and user_id is None:  # one scan of the search documents
        cond = _avg_tier(tier)
        movies = docs.filter((F.col("rating_count") > 0) & (cond if cond is not None else F.lit(True)))
    else:
        groups = _browse_groups(cat, tier, movie_id, user_id)
        movies = cat.movies.select("movie_id", "title", "released_date", "popularity").join(groups, "movie_id")
    out = movies.select(
        "movie_id",
        "title",
        "released_date",
        zero_as_null("popularity").alias("popularity_out"),
        zero_as_null(exact_avg()).alias("avg_rating"),
        F.col("rating_count").alias("num_ratings"),
        "genres",
        "popularity",
        exact_avg().alias("_avg"),
    )
    orders = {
        "rating_desc": [desc_nulls_last("_avg")],
        "rating_asc": [asc_nulls_last("_avg")],
        "popularity_desc": [desc_nulls_last("popularity")],
        "title": [pg_asc("title")],
        "release_date": [desc_nulls_last("released_date")],
    }
    order = orders.get(sort_by, [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("movie_id").cast("string")))]) + [F.col("movie_id")]
    out = top_k(out, order, limit)
    return out.drop("popularity", "_avg").withColumnRenamed("popularity_out", "popularity")


def ratings_browse_count(cat, tier: str = "all", movie_id: int | None = None, user_id: int | None = None) -> DataFrame:
    """Q-12 total: number of movies passing the filters and the HAVING tier (A-07)."""
    groups = _browse_groups(cat, tier, movie_id, user_id)
    rated = groups.select("movie_id").join(cat.movies.select("movie_id"), "movie_id", "left_semi")
    return rated.agg(F.count(F.lit(1)).alias("total_movies"))


# ---------------------------------------------------------------------------------------
# Q-13..Q-24 dimension drill-downs
# ---------------------------------------------------------------------------------------


def genre_movies(cat, genre_id: int, text: str | None = None, limit: int = 100) -> DataFrame:
    """Q-13: movies of a genre (optionally title ILIKE), by title."""
    ids = cat.movie_genres.filter(F.col("genre_id") == genre_id).select("movie_id")
    movies = cat.movies.join(ids, "movie_id").select("movie_id", "title", "released_date")
    if text:
        movies = movies.filter(ilike_contains("title", text))
    return top_k(movies, [pg_asc("title"), F.col("movie_id")], limit)


def genre_movie_counts(cat, genre_ids: DataFrame | None = None) -> DataFrame:
    """Q-13 counts in batch form: bridge rows per genre."""
    bridge = cat.movie_genres if genre_ids is None else cat.movie_genres.join(genre_ids, "genre_id", "left_semi")
    return bridge.groupBy("genre_id").agg(F.count(F.lit(1)).alias("movie_count"))


def company_top_movies(cat, company_id: int, limit: int = 10) -> DataFrame:
    """Q-14: a company's movies by popularity DESC with each movie's AVG (the correlated
    scalar sub-query becomes one pre-aggregation)."""
    ids = cat.movie_production_companies.filter(F.col("company_id") == company_id).select("movie_id")
    movies = cat.movies.join(ids, "movie_id").select("movie_id", "title", "released_date", "popularity")
    out = _movies_with_avg(cat, movies, False)  # correlated AVG sub-query → one join
    out = top_k(out, [pg_desc("popularity"), F.col("movie_id")], limit)
    return out.select(
        "movie_id", "title", "released_date", zero_as_null("popularity").alias("popularity"),
        zero_as_null("avg_rating").alias("avg_rating"),
    )


def company_profiles(cat, company_ids: DataFrame | None = None, samples: int = 5) -> DataFrame:
    """Q-15 in batch form: per company its linked-movie count and up to ``samples`` titles
    (alphabetical; the source list is unordered).  The sample is a salted per-company top-k,
    so a company with a huge catalogue never materialises its whole title list."""
    comps = cat.production_companies
    if company_ids is not None:
        comps = comps.join(company_ids, "company_id", "left_semi")
    links = cat.movie_production_companies.join(comps.select("company_id"), "company_id", "left_semi")
    counts = links.groupBy("company_id").agg(F.count("movie_id").alias("movie_count"))
    titled = links.join(cat.movies.select("movie_id", "title"), "movie_id").filter(F.col("title").isNotNull())
    first = top_k_per_group(titled, ["company_id"], [F.col("title"), F.col("movie_id")], samples, ["movie_id"])
    sample = first.groupBy("company_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("title", "movie_id"))), lambda x: x["title"]).alias("sample_movies")
    )
    return comps.join(counts, "company_id", "left").join(sample, "company_id", "left").select(
        "company_id",
        "name",
        F.coalesce("movie_count", F.lit(0)).alias("movie_count"),
        F.coalesce("sample_movies", F.array()).alias("sample_movies"),
    )


def company_movies_recent(cat, company_id: int, limit: int = 50) -> DataFrame:
    """Q-16: a company's movies, release date DESC NULLS LAST."""
    ids = cat.movie_production_companies.filter(F.col("company_id") == company_id).select("movie_id")
    movies = cat.movies.join(ids, "movie_id").select(
        "movie_id", "title", "released_date", F.col("popularity").cast("double").alias("popularity")
    )
    return top_k(movies, [desc_nulls_last("released_date"), F.col("movie_id")], limit)


def _link_list(bridge: DataFrame, dim: DataFrame, dim_key: str, dim_name: str, movies: DataFrame,
               movie_id: int | None, dim_id: int | None, limit: int) -> DataFrame:
    if movie_id is not None:
        bridge = bridge.filter(F.col("movie_id") == movie_id)
    if dim_id is not None:
        bridge = bridge.filter(F.col(dim_key) == dim_id)
    out = bridge.join(movies.select("movie_id", F.col("title").alias("movie_title")), "movie_id", "left").join(
        dim.select(dim_key, dim_name), dim_key, "left"
    )
    return top_k(out.select("movie_id", dim_key, "movie_title", dim_name), [F.col("movie_id"), F.col(dim_key)], limit)


def movie_genre_list(cat, movie_id: int | None = None, genre_id: int | None = None, limit: int | None = 100) -> DataFrame:
    """Q-17: movie-genre links with titles and names, by (movie_id, genre_id)."""
    return _link_list(cat.movie_genres, cat.genres, "genre_id", "genre_name", cat.movies, movie_id, genre_id, limit)


def movie_company_list(cat, movie_id: int | None = None, company_id: int | None = None, limit: int = 100) -> DataFrame:
    """Q-18: movie-company links, same shape."""
    comps = cat.production_companies.withColumnRenamed("name", "company_name")
    return _link_list(cat.movie_production_companies, comps, "company_id", "company_name", cat.movies, movie_id, company_id, limit)


def link_list_summary(links: DataFrame, dim_key: str) -> DataFrame:
    """Distinct movie / dimension ids in a link page (A-14)."""
    return links.agg(
        F.count_distinct("movie_id").alias("unique_movies"), F.count_distinct(dim_key).alias("unique_dims")
    )


def _siblings(requests: DataFrame, bridge: DataFrame, dim: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """For each requested (movie, dimension id) link: the movie's *other* dimension rows.

    The movie's list is aggregated once per movie and joined to the requests; each request
    keeps the list minus itself.  No self-join, so no pair rows are ever produced."""
    lists = bridge.join(dim, key).groupBy("movie_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(key).alias("k")))).alias("_all")
    )
    out = requests.select("movie_id", key).join(lists, "movie_id", "left")
    return out.select(
        "movie_id", key,
        F.filter(F.coalesce("_all", F.array()), lambda x: x["k"] != F.col(key)).alias(alias),
    )


def sibling_genres(cat, requests: DataFrame | None = None) -> DataFrame:
    """Q-19 in batch form: for every requested (movie, genre) link (default: all links) the
    movie's other genres, by name."""
    req = cat.movie_genres if requests is None else requests
    return _siblings(req, cat.movie_genres, cat.genres, "genre_id", "genre_name", "other_genres")


def siblings_as_text(df: DataFrame, alias: str) -> DataFrame:
    cols = [c for c in df.columns if c != alias]
    return df.select(*cols, F.array_join(F.transform(alias, lambda x: x["n"]), ", ").alias(alias))


def sibling_companies(cat, movie_id: int, company_id: int) -> DataFrame:
    """Q-20: the other companies of a movie."""
    links = cat.movie_production_companies.filter((F.col("movie_id") == movie_id) & (F.col("company_id") != company_id))
    out = links.join(cat.production_companies, "company_id").select("company_id", "name")
    return out.orderBy(pg_asc("name"), "company_id")


def sibling_genres_of(cat, movie_id: int, genre_id: int) -> DataFrame:
    """Q-19 point form: the other genres of a movie, by name."""
    links = cat.movie_genres.filter((F.col("movie_id") == movie_id) & (F.col("genre_id") != genre_id))
    return links.join(cat.genres, "genre_id").select("genre_id", "genre_name").orderBy(pg_asc("genre_name"), "genre_id")


def person_credit_counts(cat, person_ids: DataFrame | None = None) -> DataFrame:
    """Q-21 counts in batch form: cast and crew credits per person (0 when none)."""
    people = cat.people if person_ids is None else cat.people.join(person_ids, "person_id", "left_semi")
    cast = cat.movie_cast.groupBy("person_id").agg(F.count(F.lit(1)).alias("cast_count"))
    crew = cat.movie_crew.groupBy("person_id").agg(F.count(F.lit(1)).alias("crew_count"))
    return people.select("person_id", "name").join(cast, "person_id", "left").join(crew, "person_id", "left").select(
        "person_id", "name", F.coalesce("cast_count", F.lit(0)).alias("cast_count"),
        F.coalesce("crew_count", F.lit(0)).alias("crew_count"),
    )


def person_cast_roles(cat, person_ids: DataFrame | None = None, per_person: int = 25) -> DataFrame:
    """Q-21 roles in batch form: each person's first ``per_person`` cast roles by cast_order
    NULLS LAST, release date DESC NULLS LAST (salted per-person top-k)."""
    cast = cat.movie_cast if person_ids is None else cat.movie_cast.join(person_ids, "person_id", "left_semi")
    rows = cast.join(cat.movies.select("movie_id", "title", "released_date"), "movie_id")
    order = [asc_nulls_last("cast_order"), desc_nulls_last("released_date"), F.col("movie_id")]
    top = top_k_per_group(rows, ["person_id"], order, per_person, ["movie_id"])
    return top.select("person_id", "movie_id", "title", "character", "cast_order", "released_date")


def person_crew_roles(cat, person_ids: DataFrame | None = None, per_person: int = 25) -> DataFrame:
    """Q-21 crew roles: release date DESC NULLS LAST, department, job."""
    crew = cat.movie_crew if person_ids is None else cat.movie_crew.join(person_ids, "person_id", "left_semi")
    rows = crew.join(cat.movies.select("movie_id", "title", "released_date"), "movie_id")
    order = [desc_nulls_last("released_date"), pg_asc("department"), pg_asc("job"), F.col("movie_id")]
    top = top_k_per_group(rows, ["person_id"], order, per_person, ["movie_id", "job"])
    return top.select("person_id", "movie_id", "title", "department", "job", "released_date")


def cast_list(cat, search: str | None = None, limit: int = 100) -> DataFrame:
    """Q-22: cast credits whose title or person name matches; title, cast_order NULLS LAST."""
    rows = cat.movie_cast.join(cat.movies.select("movie_id", "title"), "movie_id").join(
        cat.people.select("person_id", "name"), "person_id"
    )
    if search:
        rows = rows.filter(ilike_contains("title", search) | ilike_contains("name", search))
    out = rows.select(
        "movie_id", "person_id", F.col("title").alias("movie_title"), F.col("name").alias("person_name"), "character", "cast_order"
    )
    return top_k(out, [pg_asc("movie_title"), pg_asc("cast_order"), F.col("movie_id"), F.col("person_id")], limit)


def cast_list_by_key(cat, movie_id: int | None = None, person_id: int | None = None) -> DataFrame:
    """Q-23: cast credits of a movie and/or person (unlimited), names default 'Unknown'.
    The per-row keyed lookup becomes two left joins."""
    cast = cat.movie_cast
    if movie_id is not None:
        cast = cast.filter(F.col("movie_id") == movie_id)
    if person_id is not None:
        cast = cast.filter(F.col("person_id") == person_id)
    return _titled_credits(cat, cast).select(
        "movie_id", "person_id", "movie_title", "person_name", "character", "cast_order"
    )


def _titled_credits(cat, credits: DataFrame) -> DataFrame:
    out = credits.join(cat.movies.select("movie_id", F.col("title").alias("_t")), "movie_id", "left").join(
        cat.people.select("person_id", F.col("name").alias("_n")), "person_id", "left"
    )
    # the source looks both up in one keyed cross join: a miss on either side loses both names
    both = F.col("_t").isNotNull() & F.col("_n").isNotNull()
    return out.withColumn("movie_title", F.when(both, F.col("_t")).otherwise(F.lit("Unknown"))).withColumn(
        "person_name", F.when(both, F.col("_n")).otherwise(F.lit("Unknown"))
    ).drop("_t", "_n")


def crew_list(cat, search: str | None = None, limit: int = 100) -> DataFrame:
    """Q-24: crew credits whose title or person name matches; title, department, job."""
    rows = cat.movie_crew.join(cat.movies.select("movie_id", "title"), "movie_id").join(
        cat.people.select("person_id", "name"), "person_id"
    )
    if search:
        rows = rows.filter(ilike_contains("title", search) | ilike_contains("name", search))
    out = rows.select(
        "movie_id", "person_id", F.col("title").alias("movie_title"), F.col("name").alias("person_name"), "department", "job"
    )
    return top_k(
        out, [pg_asc("movie_title"), pg_asc("department"), pg_asc("job"), F.col("movie_id"), F.col("person_id")], limit
    )


def crew_list_by_key(cat, movie_id: int | None = None, person_id: int | None = None) -> DataFrame:
    """Q-24 keyed form (unlimited), names default 'Unknown'."""
    crew = cat.movie_crew
    if movie_id is not None:
        crew = crew.filter(F.col("movie_id") == movie_id)
    if person_id is not None:
        crew = crew.filter(F.col("person_id") == person_id)
    return _titled_credits(cat, crew).select("movie_id", "person_id", "movie_title", "person_name", "department", "job")


# ---------------------------------------------------------------------------------------
# Q-25 ratings list, Q-27 recent, Q-28 find, Q-29 autocomplete, Q-30..Q-32 lists, Q-41
# ---------------------------------------------------------------------------------------


def rating_tier(tier: str, c: str = "rating") -> Column | None:
    """C-19 on a single rating: excellent is 4..5 inclusive."""
    r = F.col(c)
    dec = lambda v: F.lit(v).cast("decimal(3,1)")
    return {
        "excellent": (r >= dec(4.0)) & (r <= dec(5.0)),
        "high": (r >= dec(3.0)) & (r < dec(4.0)),
        "medium": (r >= dec(2.0)) & (r < dec(3.0)),
        "low": r < dec(2.0),
    }.get(tier)


def _filtered_ratings(cat, movie_id, user_id, tier) -> DataFrame:
    preds = [
        F.col("movie_id") == movie_id if movie_id is not None else None,
        F.col("user_id") == user_id if user_id is not None else None,
        rating_tier(tier),
    ]
    cond = all_of(preds)
    return cat.ratings.filter(cond) if cond is not None else cat.ratings


def ratings_list(cat, movie_id=None, user_id=None, tier="all", sort_by="created_desc", limit=50) -> DataFrame:
    """Q-25: filtered ratings with six sort modes (no NULLS clause needed: keys are non-null)."""
    r = _filtered_ratings(cat, movie_id, user_id, tier)
    orders = {
        "created_asc": [pg_asc("created_at")],
        "rating_desc": [pg_desc("rating")],
        "rating_asc": [pg_asc("rating")],
        "movie_id": [pg_asc("movie_id")],
        "user_id": [pg_asc("user_id")],
    }
    order = orders.get(sort_by, [pg_desc("created_at")]) + [F.col("rating_id")]
    out = r.select("rating_id", "user_id", "movie_id", F.col("rating").cast("double").alias("rating"), "created_at")
    return top_k(out, order, limit)


def ratings_list_counts(cat, movie_id=None, user_id=None, tier="all") -> DataFrame:
    """Q-25 counters: all ratings and the filtered ones, in one pass over the table."""
    cond = all_of([
        F.col("movie_id") == movie_id if movie_id is not None else None,
        F.col("user_id") == user_id if user_id is not None else None,
        rating_tier(tier),
    ])
    filtered = F.count_if(cond) if cond is not None else F.count(F.lit(1))
    return cat.ratings.agg(F.count(F.lit(1)).alias("total_ratings"), filtered.alias("total_filtered"))


def recent_movies(movies: DataFrame, limit: int = 100) -> DataFrame:
    """Q-27: most recently created movies (created_at DESC, nulls first)."""
    out = movies.select("movie_id", "title", "released_date", zero_as_null("popularity").alias("popularity"), "created_at")
    return top_k(out, [pg_desc("created_at"), F.col("movie_id")], limit).drop("created_at")


def movie_find(cat, text: str, limit: int = 100) -> DataFrame:
    """Q-28 / U-01: title hits (first ``limit`` by title; a title hit carries no popularity)
    plus, when the text is a number, the movie with that id placed first (``rank`` 0) unless
    it is already among the hits."""
    hits = cat.movies.filter(ilike_contains("title", text)).select("movie_id", "title", "released_date")
    hits = top_k(hits, [pg_asc("title"), F.col("movie_id")], limit).select(
        F.lit(1).alias("rank"), "movie_id", "title", "released_date", F.lit(None).cast("double").alias("popularity")
    )
    if not text.isdigit():
        return hits
    by_id = cat.movies.filter(F.col("movie_id") == int(text)).select(
        F.lit(0).alias("rank"), "movie_id", "title", "released_date", F.col("popularity").cast("double").alias("popularity")
    )
    return by_id.join(hits.select("movie_id"), "movie_id", "left_anti").unionByName(hits)


def autocomplete_movies(cat, prefix: str, limit: int = 20) -> DataFrame:
    """Q-29: fewer than two characters → no rows; else title ILIKE, by title."""
    movies = cat.movies.select("movie_id", "title", "released_date")
    if len(prefix) < 2:
        return movies.limit(0)
    return top_k(movies.filter(ilike_contains("title", prefix)), [pg_asc("title"), F.col("movie_id")], limit)


def autocomplete_people(cat, prefix: str, limit: int = 20) -> DataFrame:
    """Q-29 people: name ILIKE, by name, with the gender label (C-15)."""
    from cinemetric.functions.cleaning import gender_label

    people = cat.people.select("person_id", "name", "gender", gender_label("gender").alias("gender_display"))
    if len(prefix) < 2:
        return people.limit(0)
    return top_k(people.filter(ilike_contains("name", prefix)), [pg_asc("name"), F.col("person_id")], limit)


def name_search(dim: DataFrame, key: str, name: str, text: str, limit: int = 50) -> DataFrame:
    """Q-30: ILIKE over a dimension's name, by name (genres, companies, people, movies)."""
    return top_k(dim.filter(ilike_contains(name, text)), [pg_asc(name), F.col(key)], limit)


def list_dimension(dim: DataFrame, key: str, order_col: str, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Q-31: ordered (optionally paged) listing of a dimension."""
    return top_k(dim, [pg_asc(order_col), F.col(key)], limit, offset)


def list_links(bridge: DataFrame, movie_id: int | None = None) -> DataFrame:
    """Q-32: bridge rows, optionally for one movie."""
    return bridge.filter(F.col("movie_id") == movie_id) if movie_id is not None else bridge


def movie_genre_names(cat, movie_ids: DataFrame | None = None) -> DataFrame:
    """Q-41 in batch form: (movie_id, genre_id, genre_name) by name within each movie."""
    return keep_movies(cat.movie_genres, movie_ids).join(cat.genres, "genre_id").select(
        "movie_id", "genre_id", "genre_name"
    )


# ---------------------------------------------------------------------------------------
# Batch forms of the per-key drill-downs: every key at once, each key's page as a salted
# per-group top-k (a key holding a third of the rows is ranked by many tasks, not one).
# ---------------------------------------------------------------------------------------


def genre_movies_all(cat, text: str | None = None, per_genre: int = 100) -> DataFrame:
    """Q-13 for every genre: its first ``per_genre`` movies by title (optionally ILIKE)."""
    movies = cat.movies.select("movie_id", "title", "released_date")
    if text:
        movies = movies.filter(ilike_contains("title", text))
    rows = cat.movie_genres.join(movies, "movie_id")
    top = top_k_per_group(rows, ["genre_id"], [pg_asc("title"), F.col("movie_id")], per_genre, ["movie_id"])
    return top.select("genre_id", "movie_id", "title", "released_date")


def company_top_movies_all(cat, per_company: int = 10) -> DataFrame:
    """Q-14 for every company: top ``per_company`` movies by popularity DESC (nulls first),
    with each movie's AVG rating."""
    rows = cat.movie_production_companies.join(
        cat.movies.select("movie_id", "title", "released_date", "popularity"), "movie_id"
    )
    top = top_k_per_group(rows, ["company_id"], [pg_desc("popularity"), F.col("movie_id")], per_company, ["movie_id"])
    out = _movies_with_avg(cat, top, False)
    return out.select(
        "company_id", "movie_id", "title", "released_date", zero_as_null("popularity").alias("popularity"),
        zero_as_null("avg_rating").alias("avg_rating"),
    )


def company_movies_recent_all(cat, per_company: int = 50) -> DataFrame:
    """Q-16 for every company: latest ``per_company`` movies (release date DESC NULLS LAST)."""
    rows = cat.movie_production_companies.join(
        cat.movies.select("movie_id", "title", "released_date", F.col("popularity").cast("double").alias("popularity")),
        "movie_id",
    )
    top = top_k_per_group(rows, ["company_id"], [desc_nulls_last("released_date"), F.col("movie_id")], per_company,
                          ["movie_id"])
    return top.select("company_id", "movie_id", "title", "released_date", "popularity")


def sibling_companies_all(cat, requests: DataFrame | None = None) -> DataFrame:
    """Q-20 in batch form: for every requested (movie, company) link (default: all links)
    the movie's other companies, by name."""
    req = cat.movie_production_companies if requests is None else requests
    return _siblings(req, cat.movie_production_companies, cat.production_companies, "company_id", "name",
                     "other_companies")


def ratings_latest_per_user(cat, per_user: int = 50) -> DataFrame:
    """Q-25 for every user: the user's ``per_user`` newest ratings."""
    r = cat.ratings.select("rating_id", "user_id", "movie_id", F.col("rating").cast("double").alias("rating"), "created_at")
    return top_k_per_group(r, ["user_id"], [pg_desc("created_at"), F.col("rating_id")], per_user, ["rating_id"])
