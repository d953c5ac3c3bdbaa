"""Dimensions with their bridges, upserts of movies, and the tables that single changes leave
(N-03, N-04, N-09, Q-27, W-03, W-08, W-09, R-04, R-05, V-03, M-04, M-05, T-01, T-04, A-14)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.operators import arrays as R
from cinemetric.operators import mutate as W
from cinemetric.operators import normalize as N
from cinemetric.operators import validate as V
from cinemetric.operators.routing import route
from cinemetric.plans import events as E
from cinemetric.plans import loads as L
from cinemetric.plans import search as S
from cinemetric.session import checkpoint_dir
from cinemetric.sources import ingest as I
from cinemetric.sources import staging as ST


def company_bridge(cat) -> DataFrame:
    """N-03."""
    movies = L.parsed_movies(cat)
    dim = N.dimension_from_lists(movies, "production_companies", "company_id", "name")
    return N.bridge_from_lists(movies, "movie_id", "production_companies", dim, "company_id", "name")


def keyword_dimension(cat) -> DataFrame:
    """N-04."""
    return N.dimension_from_lists(L.keywords_loaded(cat), "keywords", "keyword_id", "keyword_name")


def keyword_bridge(cat) -> DataFrame:
    rows = L.keywords_loaded(cat)
    dim = N.dimension_from_lists(rows, "keywords", "keyword_id", "keyword_name")
    return N.bridge_from_lists(rows, "movie_id", "keywords", dim, "keyword_id", "keyword_name")


def _movie_feed(cat) -> DataFrame:
    """Movie rows as two files bring them: every movie, then every fourth again under a new title and with
    one genre more."""
    m = cat.movies.select("movie_id", "title", "popularity", "released_date")
    genres = cat.movie_genres.groupBy("movie_id").agg(F.sort_array(F.collect_list("genre_id")).alias("genre_ids"))
    first = m.join(genres, "movie_id", "left").withColumns({"seq": F.col("movie_id").cast("long"), "created_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("movie_id") % 700)})
    later = m.filter(F.col("movie_id") % 4 == 0).select(
        "movie_id", F.concat("title", F.lit(" (new)")).alias("title"), F.lit(None).cast("decimal(10,2)").alias("popularity"), "released_date",
        F.array(F.lit(99)).alias("genre_ids"), (F.col("movie_id") + 10_000_000).cast("long").alias("seq"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    return first.select(later.columns).unionByName(later)


def movies_upserted(cat) -> DataFrame:
    """N-09: the last row wins every column, created_at stays from the first, genres add up."""
    feed = _movie_feed(cat)
    movies = N.upsert_movies(feed, ["seq"], ["title", "popularity", "released_date"])
    bridge = feed.select("movie_id", F.explode("genre_ids").alias("genre_id")).distinct().groupBy("movie_id").agg(F.count(F.lit(1)).alias("genres"))
    out = movies.join(bridge, "movie_id", "left")
    return out.select("movie_id", "title", "popularity", "released_date", "created_at", F.coalesce("genres", F.lit(0)).alias("genres"))


def recent_movies(cat) -> DataFrame:
    """Q-27 over the upserted movies."""
    return S.recent_movies(movies_upserted(cat))


def ratings_after_strict_insert(cat, as_of) -> DataFrame:
    """W-03: the table that strict inserts leave; the batch repeats keys and holds known ones."""
    current = cat.ratings.select("user_id", "movie_id", "rating", "created_at")
    batch = ST.rating_rows(cat, 6).withColumn("_n", F.monotonically_increasing_id())
    order = [*ST.LINE_SEQ, "rating"]
    unique = batch.groupBy("user_id", "movie_id", *order).agg(F.first("created_at").alias("created_at"))
    table, _ = W.strict_insert(current, unique, ["user_id", "movie_id"], order, as_of, ["created_at"])
    return table


def companies_after_guarded_delete(cat, text: str) -> DataFrame:
    """W-08: the companies left; those without a movie go."""
    asked = cat.production_companies.filter(F.col("name").ilike(f"%{text}%")).select("company_id")
    linked = cat.movie_production_companies.filter(F.col("company_id") % 2 == 0)
    table, _ = W.guarded_delete(cat.production_companies, asked, "company_id", [linked])
    return table


def cast_after_checked_insert(cat) -> DataFrame:
    """W-09: cast rows of even movies stand; the others are offered, and those of movies without a
    popularity are refused."""
    rows = cat.movie_cast.select("movie_id", "person_id", "character", "cast_order")
    movies = cat.movies.filter(F.col("popularity").isNotNull()).select("movie_id")
    even = F.col("movie_id") % 2 == 0
    table, _ = W.fk_checked_insert(rows.filter(even), rows.filter(~even), "movie_id", movies, "movie_id")
    return table


def documents_company_edits(cat) -> DataFrame:
    """R-04 / R-05 on companies: one appended by id where absent, the first match renamed."""
    d = cat.movie_documents
    element = F.struct(F.lit(3).cast("long").alias("id"), F.lit("ADDED").alias("name"))
    added = R.append_if_absent("production_companies", element, R.by_fields(id=3))
    renamed = R.update_first(added, lambda x: x["name"].contains("0"), lambda x: x.withField("name", F.lit("FIRST")))
    return d.select(F.col("id").alias("movie_id"), F.array_join(F.transform(renamed, lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x["name"])), ", ").alias("companies"))


def documents_credit_edits(cat) -> DataFrame:
    """R-04 / R-05 on cast and crew: the first cast member's character, the crew member with an id and a job."""
    c = cat.credit_documents
    cast = R.update_first("cast", lambda x: x["name"].contains("1"), lambda x: x.withField("character", F.lit("EDITED")))
    crew = R.update_all("crew", lambda x: x["job"] == "1-URGENT", lambda x: x.withField("department", F.lit("D")))
    return c.select(
        "id", F.array_join(F.transform(cast, lambda x: F.concat_ws("=", x["name"], x["character"])), ", ").alias("cast"),
        F.array_join(F.transform(crew, lambda x: F.concat_ws("=", x["name"], x["job"], x["department"])), ", ").alias("crew"),
    )


def sessions_retained(cat, as_of) -> DataFrame:
    """V-03 on sessions: those that started within their time to live."""
    return V.retain(E.sessions(cat.media_events), "started_at", as_of, 20 * 86400).select("session_id", "started_at")


def recommendation_lists(cat) -> DataFrame:
    """Lists per user and day from what the user viewed: ``user_id, generated_at, algorithm, movies``."""
    seen = cat.media_events.filter("user_id IS NOT NULL AND movie_id IS NOT NULL AND type = 'page_view'")
    day = (F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(20))).alias("generated_at")
    counted = seen.groupBy("user_id", day, "movie_id").agg(F.count(F.lit(1)).alias("n"))
    item = F.struct((-F.col("n")).alias("k"), "movie_id", F.col("n").cast("double").alias("score"), F.lit("viewed").alias("reason"))
    listed = counted.groupBy("user_id", "generated_at").agg(F.sort_array(F.collect_list(item)).alias("movies"))
    return listed.withColumn("algorithm", F.lit("views")).withColumn("movies", F.transform("movies", lambda x: x.dropFields("k")))


def recommendations_read(cat, as_of) -> DataFrame:
    """M-05 / V-03: the newest list of each user that has not expired."""
    return E.latest_recommendations(recommendation_lists(cat), as_of)


def viewing_durations(cat) -> DataFrame:
    """M-04 with durations in the feed."""
    events = cat.media_events.withColumn("duration_ms", F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 10_000) * 37))
    return E.viewing_history(events)


def routed_events(cat) -> DataFrame:
    """T-01: what routing the raw feed counts in its one pass."""
    raw = cat.tables.events.select("event_id", F.col("event_type").alias("type"), "ts", F.col("user_id").cast("string").alias("user_id"), F.regexp_extract("props", "[0-9]+", 0).alias("movie_id"))
    routed = route(raw, V.event_rules(), f"{checkpoint_dir(cat.spark)}/routed-{uuid.uuid4().hex}")
    counts = [(k, int(v)) for k, v in routed.counts.items() if v]
    written = routed.accepted.agg(F.lit("written accepted").alias("measure"), F.count(F.lit(1)).alias("n"))
    return cat.spark.createDataFrame(counts, "measure string, n long").unionByName(written)


def deliveries_once(cat) -> DataFrame:
    """T-04 as a batch: each event id once, however often it was delivered."""
    events = cat.media_events
    again = events.filter(F.col("event_id") % 3 == 0)
    delivered = events.unionByName(again).unionByName(again)
    once = delivered.groupBy("event_id").agg(F.min(F.struct("ts", "type")).alias("e"))
    return once.select("event_id", "e.ts", "e.type")


def link_page_summary(cat) -> DataFrame:
    """A-14."""
    return S.link_list_summary(cat.movie_genres, "genre_id")
