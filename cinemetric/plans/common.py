"""Building blocks shared by the catalogue queries.

Ratings are always reduced to one row per movie (exact decimal sum + count) *before* they
meet a bridge table, so no join fans rating rows out and no ``count(distinct)`` is needed to
undo a fan-out.  When only some movies are wanted, the ratings are first semi-joined to those
movie ids: the semi-join and the aggregation share one hash partitioning on ``movie_id``, and
AQE broadcasts the id list when it turns out small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_movies(df: DataFrame, movie_ids: DataFrame | None, key: str = "movie_id") -> DataFrame:
    """Restrict ``df`` to the movie ids of ``movie_ids`` (``None`` = all)."""
    if movie_ids is None:
        return df
    # a semi-join ignores repeated keys on its right side, so no distinct() (and no extra
    # aggregation + shuffle) is needed here
    return df.join(movie_ids.select(F.col(key)), key, "left_semi")


def rating_stats(ratings: DataFrame, movie_ids: DataFrame | None = None) -> DataFrame:
    """Per movie: ``rating_sum`` (exact decimal) and ``rating_count``."""
    return (
        keep_movies(ratings, movie_ids)
        .groupBy("movie_id")
        .agg(F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count"))
    )


def exact_avg(sum_col: str = "rating_sum", count_col: str = "rating_count") -> Column:
    """AVG of a decimal column computed as one division of the exact sum (NULL if no rows)."""
    return F.when(F.col(count_col) > 0, F.col(sum_col).cast("double") / F.col(count_col))


def avg_at_least(bound: float, sum_col: str = "rating_sum", count_col: str = "rating_count") -> Column:
    """``AVG(x) >= bound`` evaluated exactly: ``sum >= bound * count`` in decimal."""
    return F.col(sum_col) >= F.lit(bound).cast("decimal(10,4)") * F.col(count_col)


def avg_below(bound: float, sum_col: str = "rating_sum", count_col: str = "rating_count") -> Column:
    return F.col(sum_col) < F.lit(bound).cast("decimal(10,4)") * F.col(count_col)


def zero_as_null(c) -> Column:
    """``float(x) if x else None`` (C-12): 0 and NULL both become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c.cast("double"), F.lit(0.0))


def null_as_zero(c) -> Column:
    """``float(x) if x else 0`` (C-13)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double"), F.lit(0.0))


def name_list(df: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """``STRING_AGG(DISTINCT name, ', ' ORDER BY name)`` per key (A-03).  ``collect_set`` is
    combined map-side, and a set per key is bounded by the distinct names it can hold."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(name)), ", ").alias(alias))


def movie_facts(cat, with_genres: bool = True) -> DataFrame:
    """Per movie, in ONE aggregation: exact ``rating_sum`` / ``rating_count`` and the
    sorted distinct genre names (``genres``).

    Rating rows and genre rows are unioned (never joined, so nothing fans out) and grouped
    by ``movie_id``; sum, count and the name set all combine map-side, so a movie holding a
    third of all ratings costs one partial row per task.  Queries join this once to their
    candidate movies instead of re-deriving the candidates inside each enrichment branch.
    """
    named = cat.movie_genres.join(cat.genres, "genre_id").select("movie_id", "genre_name") if with_genres else None
    return facts_from(cat.ratings, named)


def facts_from(ratings: DataFrame, named_genres: DataFrame | None) -> DataFrame:
    """``movie_facts`` over explicit inputs: ratings ``(movie_id, rating)`` and genre names
    ``(movie_id, genre_name)`` (``None`` = ratings only)."""
    facts = ratings.select("movie_id", "rating", F.lit(None).cast("string").alias("genre_name"))
    if named_genres is not None:
        genre_rows = named_genres.select("movie_id", F.lit(None).cast("decimal(3,1)").alias("rating"), "genre_name")
        facts = facts.unionByName(genre_rows)
    aggs = [F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count")]
    if named_genres is not None:
        names = F.array_sort(F.collect_set("genre_name"))
        aggs.append(F.when(F.size(names) > 0, F.array_join(names, ", ")).alias("genres"))
    return facts.groupBy("movie_id").agg(*aggs)


def refresh_facts(facts: DataFrame, ratings: DataFrame, named_genres: DataFrame, changed: DataFrame) -> DataFrame:
    """Incremental maintenance of the stored facts after a change batch: rows of the
    ``changed`` movies are re-aggregated from the (new) ratings and genres and replace the old
    rows; all other rows are kept as they are.

    The semi-join to the changed ids stands behind the aggregation: Spark moves it in front of it
    where the ids are few enough to broadcast, so that cost grows with the batch; where they are
    not, ratings combine map-side and tasks sort one row per movie, not every rating."""
    ids = changed.select("movie_id").distinct()
    fresh = facts_from(ratings, named_genres).join(ids, "movie_id", "left_semi")
    return facts.join(ids, "movie_id", "left_anti").unionByName(fresh)


def facts_of(cat, with_genres: bool = True) -> DataFrame:
    """The per-movie facts: the stored table when the catalogue was materialised (the load
    job keeps it current), else computed on the fly by ``movie_facts``."""
    stored = getattr(cat, "stored_facts", None)
    if stored is not None:
        return stored
    return movie_facts(cat, with_genres)


def search_documents(cat) -> DataFrame:
    """One search document per movie: scalars, exact rating facts, the genre-name list and
    the embedded genre / company / cast lists (sorted by id), built with one list aggregation
    (``nested_lists``) and two joins.  The load writes it; probe-style queries then filter it
    with higher-order array predicates in a single scan instead of joining bridges."""
    people = cat.people.select("person_id", "name", "gender")
    lists = nested_lists({
        "genre_list": (cat.movie_genres.join(cat.genres, "genre_id"),
                       F.struct(F.col("genre_id").alias("id"), F.col("genre_name").alias("name"))),
        "company_list": (cat.movie_production_companies.join(cat.production_companies, "company_id"),
                         F.struct(F.col("company_id").alias("id"), F.col("name").alias("name"))),
        "cast_list": (cat.movie_cast.join(people, "person_id"),
                      F.struct(F.col("person_id").alias("id"), "name", "character", "gender", "cast_order")),
        "crew_list": (cat.movie_crew.join(people, "person_id"),
                      F.struct(F.col("person_id").alias("id"), "job", "name", "gender", "department")),
    })
    movies = cat.movies.select("movie_id", "title", "adult", "language", "released_date", "overview", "runtime",
                               "popularity")
    out = movies.join(facts_of(cat), "movie_id", "left").join(lists, "movie_id", "left")
    return out.select(
        *movies.columns, "rating_sum", "rating_count", "genres",
        *[F.coalesce(F.array_sort(c), F.array()).alias(c)
          for c in ("genre_list", "company_list", "cast_list", "crew_list")],
    )


def resort(arr, keys, fields) -> Column:
    """Re-order an array of structs by ``keys`` (functions of an element, compared in order,
    then by the output fields) and reshape each element to ``fields`` ((name, function))."""
    keyed = F.transform(arr, lambda x: F.struct(*[k(x).alias(f"k{i}") for i, k in enumerate(keys)],
                                                *[f(x).alias(n) for n, f in fields]))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(*[x[n].alias(n) for n, _ in fields]))


def search_docs_of(cat) -> DataFrame | None:
    """The stored search documents when the catalogue was materialised, else ``None``."""
    return getattr(cat, "stored_search", None)


def ilike_contains(c, text: str) -> Column:
    """``c ILIKE '%text%'`` (F-03); ``%`` and ``_`` inside ``text`` stay wildcards."""
    c = F.col(c) if isinstance(c, str) else c
    return c.ilike(f"%{text}%")


def year_range(c, year_start: int | None, year_end: int | None) -> Column | None:
    """``EXTRACT(YEAR FROM c) BETWEEN a AND b`` written as a date range so Parquet min/max
    statistics can prune; applied only when both ends are given (F-08)."""
    if year_start is None or year_end is None:
        return None
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.make_date(F.lit(int(year_start)), F.lit(1), F.lit(1))) & (
        c < F.make_date(F.lit(int(year_end) + 1), F.lit(1), F.lit(1))
    )


def all_of(preds: Sequence[Column | None]) -> Column | None:
    """AND of the given optional predicates (F-17)."""
    out = None
    for p in preds:
        if p is None:
            continue
        out = p if out is None else (out & p)
    return out


def nested_lists(parts: dict[str, tuple[DataFrame, Column]], key: str = "movie_id") -> DataFrame:
    """Several per-key lists in ONE aggregation.

    ``parts`` maps an output name to (rows, element struct).  The rows of all parts are
    unioned with one struct column per part (NULL in the other parts' rows) and grouped
    once; ``collect_list`` skips NULLs, so each output list holds only its own part.  One
    shuffle on ``key`` replaces one aggregation and one join per list.
    """
    names = list(parts)
    union = None
    for name, (rows, elem) in parts.items():
        part = rows.select(F.col(key), elem.alias(name))
        # the other parts' struct columns are filled with NULLs by the union itself
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    return union.groupBy(key).agg(*[F.collect_list(n).alias(n) for n in names])


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, salt_from: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of every group in ``order``.

    One salted level before the group's own window: rows are spread over B salt buckets per group
    (B = ``spark.sql.shuffle.partitions``, at least 32) and each (group, bucket) keeps its first
    ``k``, of which Spark drops most before the exchange (a window group limit per task).  A group
    holding a third of the table is therefore ranked by B tasks, and the last window sees at most
    ``k * B`` rows of one group.
    """
    b = buckets or max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_from]), F.lit(b)))
    for by in ([*keys, "_salt"], [*keys]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        salted = salted.withColumn("_r", rank).filter(F.col("_r") <= k)
    return salted.drop("_salt", "_r")
