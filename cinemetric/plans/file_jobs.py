"""Loads from files (S-01, S-04, S-05, S-07..S-11, S-14): staged rows are written as the source's files, read
back by the library's readers and parsed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.functions import cleaning as C
from cinemetric.session import checkpoint_dir
from cinemetric.sources import ingest as I
from cinemetric.sources import staging as ST

DOCUMENTS_PER_FILE = 1000


def _folder(cat) -> str:
    return f"{checkpoint_dir(cat.spark)}/files-{uuid.uuid4().hex}"


def movies_from_csv(cat) -> DataFrame:
    """S-01 / S-11 / S-14: the movies file written, scanned by position and parsed."""
    rows = ST.movie_file_rows(cat).drop("seq")
    names = rows.columns
    # the file has a column between release_date and runtime that no load uses
    rows = rows.select(*names[:10], F.lit(None).cast("string").alias("unused"), *names[10:])
    path = _folder(cat)
    I.write_csv(rows, path)
    parsed = I.read_movies_csv(cat.spark, path)
    return parsed.select(
        "movie_id", "title", "adult", F.col("popularity").cast("double").alias("popularity"), "released_date", "runtime",
        F.size("genres").alias("genre_count"), F.size("production_companies").alias("company_count"),
    )


def ratings_from_csv(cat) -> DataFrame:
    """S-04 (S-14): the ratings file, split by Spark, parsed to typed rows."""
    path = _folder(cat)
    I.write_csv(ST.small_ratings(cat), path)
    rows = I.by_position(I.read_csv_strings(cat.spark, path, multi_line=False), {"userId": 0, "movieId": 1, "rating": 2, "timestamp": 3})
    return I.parse_rating_rows(rows).select("user_id", "movie_id", "rating", "created_at")


def keyword_documents_from_csv(cat) -> DataFrame:
    """S-07: keyword documents."""
    path = _folder(cat)
    I.write_csv(ST.keyword_rows(cat).select("id", "keywords"), path)
    docs = I.parse_keyword_documents(I.read_csv_strings(cat.spark, path, multi_line=False))
    return docs.select(F.col("id").cast("int").alias("id"), F.size("keywords").alias("n"), C.names_joined("keywords").alias("names"))


def rating_documents_replaced(cat) -> DataFrame:
    """S-08: rating documents loaded twice; the second load replaces the first."""
    source, target = _folder(cat), _folder(cat)
    I.write_csv(ST.small_ratings(cat), source)
    for _ in range(2):
        I.replace_table(I.parse_rating_documents(I.read_csv_strings(cat.spark, source, multi_line=False)), target)
    return cat.spark.read.parquet(target).select(F.col("userId").cast("int").alias("userId"), F.col("movieId").cast("int").alias("movieId"), "rating", "timestamp")


def documents_from_json_arrays(cat) -> DataFrame:
    """S-09: files of one JSON array each, loaded into a table that they replace."""
    source, target = _folder(cat), _folder(cat)
    docs = cat.movie_documents.select("id", "title", "runtime", "genres")
    files = F.ceil(docs.count() / F.lit(DOCUMENTS_PER_FILE))
    arrays = docs.groupBy(F.pmod(F.xxhash64("id"), files).alias("file")).agg(F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(source)
    I.replace_table(I.read_json_array(cat.spark, source, docs.schema), target)
    return cat.spark.read.parquet(target).select("id", "title", "runtime", F.coalesce(C.names_joined("genres"), F.lit("")).alias("genre_names"))


def links_from_csv(cat) -> DataFrame:
    """S-10."""
    path = _folder(cat)
    I.write_csv(ST.links(cat), path)
    return I.read_links(cat.spark, path).select("movieId", F.col("tmdbId").cast("int").alias("tmdbId"))


def pruned_movie_columns(cat) -> DataFrame:
    """F-21: the raw movies file without the columns that the cleaned one does not keep."""
    raw = ST.movie_file_rows(cat).drop("seq").withColumns({c: F.lit("x") for c in I.PRUNED_MOVIE_COLUMNS if c != "imdb_id"})
    kept = I.prune_columns(raw)
    return kept.select("id", F.lit(",".join(sorted(kept.columns))).alias("columns"))


def movie_embedded_objects(cat) -> DataFrame:
    """S-05 / N-14: collection, countries and languages of the movie documents, from their texts."""
    d = cat.movie_documents
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    code = F.substring("original_language", -2, 2)
    rows = d.select(
        F.col("id").cast("string").alias("id"), "title",
        F.when(F.col("id") % 3 == 0, text("{'id': ", F.col("id").cast("string"), ", 'name': 'Set ", F.col("original_language"), "', 'poster_path': None}"))
        .when(F.col("id") % 3 == 1, "nan").alias("belongs_to_collection"),
        F.when(F.col("id") % 5 == 0, "[]").when(F.col("id") % 7 == 0, "no list").otherwise(text("[{'iso_3166_1': '", code, "', 'name': \"Land's end\"}, {'iso_3166_1': 'XX', 'name': 'X'}]")).alias("production_countries"),
        text('[{"iso_639_1": "', code, '", "name": "', F.col("original_language"), '"}]').alias("spoken_languages"),
    )
    docs = I.parse_movie_documents(rows)
    joined = lambda c, f: F.coalesce(F.array_join(F.transform(c, lambda x: F.concat(x[f], F.lit("="), x["name"])), ", "), F.lit("-"))
    return docs.select(
        F.col("id").cast("int").alias("id"), "belongs_to_collection.name", joined("production_countries", "iso_3166_1").alias("countries"),
        joined("spoken_languages", "iso_639_1").alias("languages"),
    )


def presentation(cat) -> DataFrame:
    """C-09, C-14, C-16..C-18, C-20, C-24, C-37 over every movie."""
    m = cat.movies
    rated = C.rating_band(F.col("runtime") / 5)
    words = F.split("overview", " ")
    return m.select(
        "movie_id", C.format_date("released_date").alias("released"), C.format_datetime(F.col("released_date").cast("timestamp_ntz")).alias("released_at"),
        C.format_popularity("popularity").alias("popularity"), C.runtime_hours("runtime").alias("hours"), rated.alias("colour"),
        C.poster_url(F.concat(F.lit("/"), F.col("movie_id").cast("string"), F.lit(".jpg")), "https://images/w500").alias("poster"),
        C.clean_name(F.when(F.col("movie_id") % 5 == 0, "   ").otherwise(F.concat(F.lit("  "), F.col("title"), F.lit(" ")))).alias("name"),
        C.is_missing(F.when(F.col("movie_id") % 3 == 0, float("nan")).otherwise(F.col("popularity").cast("double"))).alias("missing"),
        F.array_join(C.first_n(words, 2), " ").alias("lead"),
        C.icontains_regex(F.concat("title", F.lit(" (a.b)")), C.regex_literal("(A.B")).alias("literal_hit"),
        C.icontains_regex(F.concat("title", F.lit(" (aXb)")), C.regex_literal("(A.B")).alias("literal_miss"),
    )


def cast_order_measures(cat) -> DataFrame:
    """C-33: size, least, greatest and mean of an array, per credits document."""
    orders = F.filter(F.transform("cast", lambda x: x["order"]), lambda x: x.isNotNull())
    d = cat.credit_documents.select("id", orders.alias("o"))
    total = F.aggregate("o", F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("id", F.size("o").alias("n"), F.array_min("o").alias("least"), F.array_max("o").alias("greatest"), F.try_divide(total.cast("double"), F.size("o").cast("double")).alias("mean"))
