"""Catalogue file sources and sinks (S-01..S-14).

Readers return raw string columns plus ``seq``, the row's position in its source: file, block of
the file, place in the block.  Only files whose fields may hold line breaks are read unsplit, one
task per file (``multi_line``); all others are split by Spark.  Parsing is a
separate pure step (``parse_*``) so the same code cleans files and staged DataFrames.
Sinks write through Spark writers; upserts into a stored table write a new version next to
it instead of overwriting the files being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetric.functions import cleaning as C
from cinemetric.operators import mutate as W
from cinemetric.operators import validate as V

# Positions of the cleaned movies file columns used by the relational load.
MOVIE_POSITIONS = {
    "adult": 0, "genres": 1, "id": 2, "original_language": 3, "original_title": 4, "overview": 5,
    "popularity": 6, "poster_path": 7, "production_companies": 8, "release_date": 9, "runtime": 11, "tagline": 12,
}


def read_csv_strings(spark: SparkSession, path: str, header: bool = True, multi_line: bool = True) -> DataFrame:
    """Quoted CSV as all-string columns, plus ``seq`` (S-14: Spark splits the read into tasks
    itself; there is no manual chunking)."""
    df = (
        spark.read.option("header", header).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("encoding", "UTF-8").csv(path)
    )
    # file order: (file, position); Spark orders its read by file size, so the position alone is not enough
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    position = F.struct(*place, F.monotonically_increasing_id().alias("at"))
    return df.withColumn("seq", position)


def by_position(df: DataFrame, positions: dict[str, int]) -> DataFrame:
    cols = [c for c in df.columns if c != "seq"]
    return df.select("seq", *[F.col(f"`{cols[i]}`").alias(name) for name, i in positions.items() if i < len(cols)])


def parse_movie_rows(rows: DataFrame) -> DataFrame:
    """S-01: typed relational movie rows.  ``movie_id`` is parsed strictly (a bad id is
    rejected later by the rules); lists go through the literal-list parser (C-01)."""
    return rows.select(
        "seq",
        (F.trim("id")).try_cast(T.IntegerType()).alias("movie_id"),
        F.col("original_title").alias("title"),
        C.strict_bool("adult").alias("adult"),
        "overview",
        F.col("original_language").alias("language"),
        C.to_popularity("popularity").alias("popularity"),
        C.two_format_date("release_date").alias("released_date"),
        C.tolerant_int("runtime").cast("int").alias("runtime"),
        "poster_path",
        "tagline",
        C.literal_list("genres").alias("genres"),
        C.literal_list("production_companies").alias("production_companies"),
    )


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_movie_rows(by_position(read_csv_strings(spark, path), MOVIE_POSITIONS))


def parse_keyword_rows(rows: DataFrame) -> DataFrame:
    """S-02: (movie_id, keywords list)."""
    return rows.select("seq", (F.trim("id")).try_cast(T.IntegerType()).alias("movie_id"),
                       C.literal_list("keywords").alias("keywords"))


def parse_credit_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S-03: (movie_id, cast list, crew list); rows without a movie id are returned
    separately as errors."""
    typed = rows.select(
        "seq",
        (F.trim("id")).try_cast(T.IntegerType()).alias("movie_id"),
        C.literal_list("cast", C.CAST_ITEM).alias("cast"),
        C.literal_list("crew", C.CREW_ITEM).alias("crew"),
    )
    return V.split(typed, [V.not_null("movie_id")])


def parse_rating_rows(rows: DataFrame) -> DataFrame:
    """S-04: (user_id, movie_id, rating DECIMAL(3,1), created_at from epoch seconds)."""
    return rows.select(
        "seq",
        (F.trim("userId")).try_cast(T.IntegerType()).alias("user_id"),
        (F.trim("movieId")).try_cast(T.IntegerType()).alias("movie_id"),
        C.to_rating("rating").alias("rating"),
        C.epoch_to_timestamp("timestamp").alias("created_at"),
    )


def parse_movie_documents(rows: DataFrame) -> DataFrame:
    """S-05 / N-14: movie documents by column name with tolerant coercion (C-05..C-07) and
    the JSON-first list parser (C-02) keeping unparseable text in ``*_raw``; rows without
    a usable id are dropped (F-22)."""
    def col(name):
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    def text(name):
        return F.when(~F.lower(F.trim(col(name))).isin("nan") & col(name).isNotNull(), col(name))

    def one(name):
        """A single object, read as a list of one."""
        listed = F.when(F.trim(col(name)).startswith("{"), F.concat(F.lit("["), F.trim(col(name)), F.lit("]")))
        return F.get(C.jsonish(listed)[0], 0)

    countries, _ = C.jsonish(col("production_countries"), C.COUNTRY_ITEM)
    languages, _ = C.jsonish(col("spoken_languages"), C.LANGUAGE_ITEM)
    genres, genres_raw = C.jsonish(col("genres"))
    companies, companies_raw = C.jsonish(col("production_companies"))
    out = rows.select(
        C.tolerant_int(col("id")).alias("id"),
        *[text(n).alias(n) for n in ("imdb_id", "title", "original_title", "original_language", "overview",
                                     "tagline", "homepage", "release_date", "status")],
        C.tolerant_bool(col("adult")).alias("adult"),
        C.tolerant_bool(col("video")).alias("video"),
        C.tolerant_int(col("budget")).alias("budget"),
        C.tolerant_int(col("revenue")).alias("revenue"),
        C.tolerant_float(col("runtime")).alias("runtime"),
        C.tolerant_float(col("popularity")).alias("popularity"),
        C.tolerant_float(col("vote_average")).alias("vote_average"),
        C.tolerant_int(col("vote_count")).alias("vote_count"),
        genres.alias("genres"), genres_raw.alias("genres_raw"),
        companies.alias("production_companies"), companies_raw.alias("production_companies_raw"),
        one("belongs_to_collection").alias("belongs_to_collection"), countries.alias("production_countries"),
        languages.alias("spoken_languages"),
    )
    return out.filter(F.col("id").isNotNull())


def parse_credit_documents(rows: DataFrame) -> DataFrame:
    """S-06: credits documents with cast/crew parsed (raw text kept when unparseable)."""
    cast, cast_raw = C.jsonish("cast", C.CAST_ITEM)
    crew, crew_raw = C.jsonish("crew", C.CREW_ITEM)
    out = rows.select(C.tolerant_int("id").alias("id"), cast.alias("cast"), cast_raw.alias("cast_raw"),
                      crew.alias("crew"), crew_raw.alias("crew_raw"))
    return out.filter(F.col("id").isNotNull())


def parse_keyword_documents(rows: DataFrame) -> DataFrame:
    """S-07."""
    kw, kw_raw = C.jsonish("keywords")
    return rows.select(C.tolerant_int("id").alias("id"), kw.alias("keywords"), kw_raw.alias("keywords_raw")).filter(
        F.col("id").isNotNull()
    )


def parse_rating_documents(rows: DataFrame) -> DataFrame:
    """S-08: rating documents; rows without user or movie are dropped, duplicates kept."""
    out = rows.select(
        C.tolerant_int("userId").alias("userId"), C.tolerant_int("movieId").alias("movieId"),
        C.tolerant_float("rating").alias("rating"), C.tolerant_int("timestamp").alias("timestamp"),
    )
    return out.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull())


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S-09: a file holding one JSON array of documents (multi-line)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """S-10: movieId → tmdbId bridge."""
    raw = read_csv_strings(spark, path, multi_line=False)
    return raw.select((F.col("movieId")).try_cast(T.IntegerType()).alias("movieId"),
                      C.tolerant_int("tmdbId").alias("tmdbId"))


# Raw movie-file columns the cleaned file does not keep.
PRUNED_MOVIE_COLUMNS = ("belongs_to_collection", "budget", "homepage", "imdb_id", "production_countries",
                        "spoken_languages", "status", "title", "video", "vote_average", "vote_count")


def prune_columns(df: DataFrame, columns=PRUNED_MOVIE_COLUMNS) -> DataFrame:
    """F-21: drop raw columns (absent ones are ignored)."""
    return df.drop(*[c for c in columns if c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """S-11: CSV with a header, no index column (replaces ``path``)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S-08/S-09: drop-and-insert load of a whole table."""
    df.write.mode("overwrite").format(fmt).save(path)


def upsert_into(spark: SparkSession, current_path: str, changes: DataFrame, key: str, seq: str, out_path: str) -> None:
    """S-12: keyed ``$set``-upsert of a change batch, in ``seq`` order, into a stored table; rows
    with a NULL key are skipped.  The result is written as a new version at ``out_path``."""
    current = spark.read.parquet(current_path)
    merged = W.upsert(current, changes, [key], seq)
    merged.write.mode("overwrite").parquet(out_path)


def insert_new(spark: SparkSession, current_path: str, batch: DataFrame, key: str, seq: str, out_path: str) -> None:
    """S-13: batch insert where a duplicate unique key is skipped; the first row by ``seq`` stays."""
    current = spark.read.parquet(current_path)
    table, _ = W.insert_if_absent(current, batch, [key], seq)
    table.write.mode("overwrite").parquet(out_path)
