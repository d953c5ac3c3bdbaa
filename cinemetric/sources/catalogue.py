"""The media catalogue as DataFrames derived from the driver tables.

The relational schema (movies, ratings, genres, companies, people, cast, crew, keywords and
their bridges) plus the event stream and user profiles are projections of the star-schema
test tables.  The mapping is fixed by the project's fixture definition; every view is a lazy
DataFrame, so a query that needs two of them reads only the columns and rows it uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetric.operators.keys import last_by, ordered_index
from cinemetric.sources.tables import ParquetTables


# Columns of the line items and of their orders that the catalogue views use.
LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")


def _movie_id(c: str):
    return (F.col(c) + 1).cast("int")


def media_events_from(raw: DataFrame) -> DataFrame:
    """The media event shape (type names of the funnel, nullable user/movie, session =
    user and day) from the raw event feed.  Works on batch and streaming DataFrames."""
    ev = raw.select("event_id", "ts", "event_type", "user_id", "props")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    renamed = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "signup", "search")
        .when(F.col("event_type") == "error", "add_to_cart")
        .otherwise(F.col("event_type"))
    )
    return ev.select(
        "event_id",
        "ts",
        renamed.alias("type"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(k + 1).alias("movie_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("ts").cast("date").cast("string")).alias(
            "session_id"
        ),
    )


class Catalogue:
    """Catalogue views over one data folder.  Views are cached per instance (the Python
    objects, not the data), so one query that uses a view twice lets Spark reuse the scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.tables = ParquetTables(spark, folder)

    # -- relational tables --------------------------------------------------------------

    @cached_property
    def movies(self) -> DataFrame:
        t = self.tables
        part = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
        orders = t.orders.select("o_orderkey", "o_orderdate")
        j = part.join(orders, part.p_partkey == orders.o_orderkey, "left")
        return j.select(
            _movie_id("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            (F.col("p_size") % 10 == 0).alias("adult"),
            F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("overview"),
            F.col("p_brand").alias("language"),
            F.when(F.col("p_partkey") % 13 == 0, F.lit(None))
            .otherwise(F.col("p_retailprice").cast("decimal(10,2)"))
            .alias("popularity"),
            F.when(F.col("p_partkey") % 17 == 0, F.lit(None))
            .otherwise(F.col("o_orderdate").cast("date"))
            .alias("released_date"),
            F.col("p_size").alias("runtime"),
        )

    @cached_property
    def ratings(self) -> DataFrame:
        """Last rating per (user, movie) wins, ordered by ship date then order/supplier/quantity."""
        rows = self.line_orders(5).select(
            F.col("o_custkey").alias("user_id"),
            _movie_id("l_partkey").alias("movie_id"),
            (F.col("l_quantity") / 10).cast("decimal(3,1)").alias("rating"),
            F.col("l_shipdate").alias("created_at"),
            "l_orderkey",
            "l_suppkey",
            "l_quantity",
        )
        latest = last_by(
            rows,
            ["user_id", "movie_id"],
            ["created_at", "l_orderkey", "l_suppkey", "l_quantity"],
            ["rating", "created_at"],
        )
        return latest.select(
            (F.col("user_id").cast("bigint") * 1000000 + F.col("movie_id")).alias("rating_id"),
            "user_id",
            "movie_id",
            "rating",
            "created_at",
        )

    @cached_property
    def genres(self) -> DataFrame:
        return self.tables.nation.select(
            (F.col("n_nationkey") + 1).alias("genre_id"), F.col("n_name").alias("genre_name")
        )

    @cached_property
    def movie_genres(self) -> DataFrame:
        items = self.lines(1).select("l_partkey", "l_suppkey")
        sup = self.tables.supplier.select("s_suppkey", "s_nationkey")
        return (
            items.join(sup, items.l_suppkey == sup.s_suppkey)
            .select(_movie_id("l_partkey").alias("movie_id"), (F.col("s_nationkey") + 1).alias("genre_id"))
            .distinct()
        )

    @cached_property
    def production_companies(self) -> DataFrame:
        return self.tables.supplier.select(_movie_id("s_suppkey").alias("company_id"), F.col("s_name").alias("name"))

    @cached_property
    def movie_production_companies(self) -> DataFrame:
        return (
            self.lines(2)
            .select(_movie_id("l_partkey").alias("movie_id"), _movie_id("l_suppkey").alias("company_id"))
            .distinct()
        )

    @cached_property
    def people(self) -> DataFrame:
        return self.tables.customer.select(
            _movie_id("c_custkey").alias("person_id"),
            F.col("c_name").alias("name"),
            (F.col("c_custkey") % 4).cast("int").alias("gender"),
        )

    def lines(self, number: int) -> DataFrame:
        """Line items of one line number.  After ``materialize`` stages the line items
        (partitioned by line number) this reads one partition directory only."""
        staged = self.__dict__.get("staged_lines")
        if staged is not None:
            return staged.filter(F.col("l_linenumber") == number)
        return self.tables.lineitem.filter(F.col("l_linenumber") == number)

    def line_orders(self, number: int) -> DataFrame:
        """Line items of one line number with their order's columns (inner join).  Staged
        line items already carry the order columns, so no join runs then."""
        staged = self.__dict__.get("staged_lines")
        if staged is not None:
            return staged.filter((F.col("l_linenumber") == number) & F.col("o_orderkey").isNotNull())
        items = self.lines(number).select(*LINE_COLUMNS)
        orders = self.tables.orders.select(*ORDER_COLUMNS)
        return items.join(orders, items.l_orderkey == orders.o_orderkey)

    def _line_orders(self, line: int, *cols: str) -> DataFrame:
        return self.line_orders(line).select("l_orderkey", "l_partkey", "l_quantity", *cols)

    @cached_property
    def movie_cast(self) -> DataFrame:
        rows = self._line_orders(3, "o_custkey", "o_orderpriority")
        agg = rows.groupBy("l_partkey", "o_custkey").agg(
            F.min("o_orderpriority").alias("character"),
            F.min(F.col("l_quantity").cast("int") % 10).alias("cast_order"),
        )
        return agg.select(
            _movie_id("l_partkey").alias("movie_id"),
            _movie_id("o_custkey").alias("person_id"),
            "character",
            F.when(F.col("cast_order") == 5, F.lit(None)).otherwise(F.col("cast_order")).alias("cast_order"),
        )

    @cached_property
    def movie_crew(self) -> DataFrame:
        rows = self._line_orders(4, "o_custkey", "o_orderpriority", "o_orderstatus")
        agg = rows.groupBy("l_partkey", "o_custkey", "o_orderpriority").agg(
            F.min("o_orderstatus").alias("department")
        )
        return agg.select(
            _movie_id("l_partkey").alias("movie_id"),
            _movie_id("o_custkey").alias("person_id"),
            "department",
            F.col("o_orderpriority").alias("job"),
        )

    @cached_property
    def movie_keyword_names(self) -> DataFrame:
        part = self.tables.part.select("p_partkey", "p_name", "p_type")
        words = F.array(
            F.regexp_extract("p_name", "^[a-z]+", 0),
            F.regexp_extract("p_name", "[a-z]+$", 0),
            F.lower("p_type"),
        )
        return part.select(
            _movie_id("p_partkey").alias("movie_id"), F.explode(words).alias("keyword_name")
        ).distinct()

    @cached_property
    def keywords(self) -> DataFrame:
        names = self.movie_keyword_names.select("keyword_name").distinct()
        return ordered_index(names, ["keyword_name"], "keyword_id").select("keyword_id", "keyword_name")

    @cached_property
    def movie_keywords(self) -> DataFrame:
        return self.movie_keyword_names.join(self.keywords, "keyword_name").select("movie_id", "keyword_id")

    # -- event side -----------------------------------------------------------------------

    @cached_property
    def media_events(self) -> DataFrame:
        return media_events_from(self.tables.events)

    @cached_property
    def user_profiles(self) -> DataFrame:
        return self.tables.customer.filter(F.col("c_custkey") % 3 != 0).select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("favorite_genre")
        )

    # -- document flavour -------------------------------------------------------------------

    @cached_property
    def movie_documents(self) -> DataFrame:
        """Movies in the document model: ``id``, scalars, ``release_date`` as ISO text, and
        ``genres`` / ``production_companies`` as ``array<struct<id,name>>`` (sorted by id),
        plus the loader's single-quoted literal text of the genre list (``genres_literal``)."""
        def embedded(bridge: DataFrame, dim: DataFrame, key: str, name: str, alias: str) -> DataFrame:
            items = bridge.join(dim, key).select(
                "movie_id", F.struct(F.col(key).cast("long").alias("id"), F.col(name).alias("name")).alias("x")
            )
            return items.groupBy("movie_id").agg(F.array_sort(F.collect_list("x")).alias(alias))

        g = embedded(self.movie_genres, self.genres, "genre_id", "genre_name", "genres")
        c = embedded(self.movie_production_companies, self.production_companies, "company_id", "name",
                     "production_companies")
        docs = self.movies.join(g, "movie_id", "left").join(c, "movie_id", "left")
        return docs.select(
            F.col("movie_id").alias("id"),
            "title",
            "adult",
            "overview",
            F.col("language").alias("original_language"),
            F.col("popularity").cast("double").alias("popularity"),
            F.date_format("released_date", "yyyy-MM-dd").alias("release_date"),
            F.col("runtime").cast("double").alias("runtime"),
            "genres",
            "production_companies",
            F.regexp_replace(F.to_json(F.coalesce("genres", F.array())), '"', "'").alias("genres_literal"),
        )

    @cached_property
    def credit_documents(self) -> DataFrame:
        """Credits documents: ``id`` (movie) with ``cast`` and ``crew`` arrays of structs in
        credit order (cast by order, crew by person then job)."""
        people = self.people.select("person_id", "name", "gender")
        cast = self.movie_cast.join(people, "person_id").select(
            "movie_id",
            F.struct(
                F.coalesce("cast_order", F.lit(99)).alias("_k"),
                F.col("person_id").cast("long").alias("id"), "name", "gender", "character",
                F.col("cast_order").alias("order"),
                F.concat(F.lit("c"), F.col("movie_id").cast("string"), F.lit("-"), F.col("person_id").cast("string")).alias("credit_id"),
            ).alias("x"),
        )
        crew = self.movie_crew.join(people, "person_id").select(
            "movie_id",
            F.struct(
                F.col("person_id").cast("long").alias("id"), "job", "name", "gender", "department",
                F.concat(F.lit("w"), F.col("movie_id").cast("string"), F.lit("-"), F.col("person_id").cast("string"),
                         F.lit("-"), F.col("job")).alias("credit_id"),
            ).alias("x"),
        )
        drop_key = lambda arr: F.transform(arr, lambda x: x.dropFields("_k"))
        cast_docs = cast.groupBy("movie_id").agg(drop_key(F.array_sort(F.collect_list("x"))).alias("cast"))
        crew_docs = crew.groupBy("movie_id").agg(F.array_sort(F.collect_list("x")).alias("crew"))
        return cast_docs.join(crew_docs, "movie_id", "full").select(
            F.col("movie_id").alias("id"), F.coalesce("cast", F.array()).alias("cast"),
            F.coalesce("crew", F.array()).alias("crew"),
        )

    @cached_property
    def rating_documents(self) -> DataFrame:
        """Ratings documents: ``userId, movieId, rating (double), timestamp (epoch seconds)``."""
        return self.ratings.select(
            F.col("user_id").alias("userId"),
            F.col("movie_id").alias("movieId"),
            F.col("rating").cast("double").alias("rating"),
            F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("created_at")).alias(
                "timestamp"
            ),
        )


# Views written by ``materialize`` and the column each is clustered on (range-partitioned
# and sorted, so Parquet row-group statistics prune point and range lookups on that key).
STORED_VIEWS = {
    "movies": "movie_id", "ratings": "movie_id", "genres": "genre_id", "movie_genres": "movie_id",
    "production_companies": "company_id", "movie_production_companies": "movie_id", "people": "person_id",
    "movie_cast": "movie_id", "movie_crew": "movie_id", "keywords": "keyword_id", "movie_keywords": "movie_id",
    "media_events": "ts", "user_profiles": "user_id", "movie_documents": "id", "credit_documents": "id",
    "rating_documents": "movieId",
}


# Views derived from other catalogue views; written in the second phase of ``materialize``.
DERIVED_VIEWS = ("movie_documents", "credit_documents", "rating_documents")


def materialize(cat: Catalogue, folder: str, files_per_view: int | None = None) -> "StoredCatalogue":
    """Write every catalogue view as Parquet under ``folder`` (one directory per view) and
    return a catalogue that reads them.

    Three phases: the line items are staged once (one scan, one join with their orders,
    partitioned by line number); the base tables are derived from the staged lines and the
    small raw tables and written; the document views and the per-movie facts are derived
    from the *written* base tables.  Each phase starts from files (short lineage: a lost
    executor recomputes from Parquet, not from the raw joins), and shared inputs are
    computed once."""
    from cinemetric.plans.common import movie_facts, search_documents

    spark = cat.spark

    def write(name: str, df: DataFrame) -> None:
        key = STORED_VIEWS.get(name, "movie_id")
        # without an explicit count, AQE sizes the range partitions (advisory partition size),
        # so file sizes follow the data: one small file locally, ~128 MB files at scale
        ranged = df.repartitionByRange(files_per_view, key) if files_per_view else df.repartitionByRange(key)
        ranged.sortWithinPartitions(key).write.mode("overwrite").parquet(f"{folder}/{name}")

    # phase 0: the line items, scanned and joined with their orders ONCE, written partitioned
    # by line number; every line-based view then reads one partition directory, no join
    t = cat.tables
    items = t.lineitem.select(*LINE_COLUMNS)
    orders = t.orders.select(*ORDER_COLUMNS)
    staged = items.join(orders, items.l_orderkey == orders.o_orderkey, "left")
    staged.write.mode("overwrite").partitionBy("l_linenumber").parquet(f"{folder}/_staged_lines")
    base = Catalogue(spark, t.folder)
    base.__dict__["staged_lines"] = spark.read.parquet(f"{folder}/_staged_lines")
    # phase 1: base views (independent jobs, submitted concurrently)
    _write_all(write, {name: getattr(base, name) for name in STORED_VIEWS if name not in DERIVED_VIEWS})
    # phase 2: a catalogue whose base views are the written tables
    stored_base = Catalogue(spark, cat.tables.folder)
    for name in STORED_VIEWS:
        if name not in DERIVED_VIEWS:
            stored_base.__dict__[name] = spark.read.parquet(f"{folder}/{name}")
    derived = {name: getattr(stored_base, name) for name in DERIVED_VIEWS}
    derived["movie_facts"] = movie_facts(stored_base)
    _write_all(write, derived)
    # phase 3: per-movie search documents, from the written base tables and facts
    docs_base = StoredCatalogue(spark, folder, cat.tables.folder)
    write("movie_search", search_documents(docs_base))
    return StoredCatalogue(spark, folder, cat.tables.folder)


def _write_all(write, views: dict[str, DataFrame], threads: int = 4) -> None:
    """Run independent write jobs concurrently (Spark schedules jobs from several driver
    threads side by side, so small writes no longer leave most executors idle)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(write, name, df) for name, df in views.items()]:
            f.result()


class StoredCatalogue:
    """Catalogue whose views are the Parquet tables written by ``materialize``; anything
    else (raw tables, derived helpers) comes from a catalogue over the raw folder."""

    def __init__(self, spark: SparkSession, folder: str, raw_folder: str):
        self.spark = spark
        self.folder = folder
        self._raw = Catalogue(spark, raw_folder)
        self.tables = self._raw.tables
        # staging builders (loads jobs) read the staged line items too
        self._raw.__dict__["staged_lines"] = spark.read.parquet(f"{folder}/_staged_lines")

    @property
    def stored_facts(self) -> DataFrame:
        """Per-movie rating sum/count and genre list written by ``materialize``."""
        return getattr(self, "movie_facts")  # instance cache first, then __getattr__

    @property
    def stored_search(self) -> DataFrame:
        """Per-movie search documents written by ``materialize``."""
        return getattr(self, "movie_search")

    def __getattr__(self, name: str):
        if name in STORED_VIEWS or name in ("movie_facts", "movie_search"):
            df = self.spark.read.parquet(f"{self.folder}/{name}")
            self.__dict__[name] = df
            return df
        return getattr(self._raw, name)
