"""Event analytics edge cases, streaming = batch, ingest round trips, latency summary."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cinemetric.plans import events as E
from cinemetric.plans import probes as P
from cinemetric.plans import search as S
from cinemetric.sources import ingest as I
from cinemetric.sources import staging as ST
from cinemetric.streaming import events_stream as T

EV = "event_id long, ts timestamp_ntz, type string, user_id long, movie_id int, session_id string"


def test_funnel_without_searches_gives_null_rate(spark):
    t = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(1, t, "page_view", 1, 5, "s1"), (2, t, "purchase", 1, 5, "s1")], EV)
    r = E.conversion_funnel(df, "2024-01-10 00:00:00").collect()[0]
    assert r.search_count == 0 and r.search_to_view_rate is None
    assert r.view_to_cart_rate == 0.0 and r.overall_conversion_rate == 100.0


def test_add_to_set_counts_explicit_null(spark):
    t = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(1, t, "page_view", None, 5, "s"), (2, t, "page_view", 3, 5, "s"),
                                (3, t, "page_view", 3, None, "s")], EV)
    r = E.event_funnel(df, "2024-01-10 00:00:00").collect()[0]
    assert (r["count"], r.unique_user_count, r.unique_movie_count) == (3, 2, 2)


def test_trending_rounds_half_even_before_sorting(spark):
    as_of = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([(1, as_of, "search", 1, 7, "s"), (2, as_of, "click", 1, 7, "s")], EV)
    r = E.trending(df, "2024-01-31 00:00:00").collect()
    assert len(r) == 1 and r[0].trending_score == 0.5 and r[0].total_events == 1


def test_rating_tier_bounds(spark, cat):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.9, 2.0, 2.9, 3.0, 3.9, 4.0, 5.0, 5.1])],
                               "i int, rating double").withColumn("rating", F.col("rating").cast("decimal(3,1)"))
    tiers = {t: sorted(r.i for r in df.filter(S.rating_tier(t)).collect()) for t in ("excellent", "high", "medium", "low")}
    assert tiers == {"excellent": [5, 6], "high": [3, 4], "medium": [1, 2], "low": [0]}


def test_null_order_helpers(spark):
    from cinemetric.functions.ordering import mongo_asc, mongo_desc, pg_asc, pg_desc

    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "i int, v double")
    order = lambda c: [r.i for r in df.orderBy(c, "i").collect()]
    assert order(pg_desc("v")) == [2, 1, 3] and order(pg_asc("v")) == [3, 1, 2]
    assert order(mongo_asc("v")) == [2, 3, 1] and order(mongo_desc("v")) == [1, 3, 2]


def _sentinel(spark, folder, cat, days):
    """One far-later page view: the next micro-batch advances the watermark past every
    real window/session, so append mode emits them (as a live feed would)."""
    from cinemetric.streaming.events_stream import RAW_EVENT_SCHEMA

    last = cat.tables.events.agg(F.max("ts")).collect()[0][0]
    row = [(10**12, last + dt.timedelta(days=days), 1, "view", 0.0, '{"k": 1}')]
    spark.createDataFrame(row, RAW_EVENT_SCHEMA).write.parquet(folder)


def _run_twice(spark, scratch, cat, job, name, days):
    src = os.path.join(scratch, "in")
    cat.tables.events.write.parquet(os.path.join(src, "a"))
    out = os.path.join(scratch, name)
    T.run_to_parquet(job(T.event_stream(spark, src, file_glob="*.parquet")), spark, name + os.path.basename(scratch), out)
    _sentinel(spark, os.path.join(src, "z"), cat, days)
    T.run_to_parquet(job(T.event_stream(spark, src, file_glob="*.parquet")), spark, name + os.path.basename(scratch), out)
    return spark.read.parquet(out)


def test_stream_view_counts_equal_batch(spark, cat, scratch):
    got = _run_twice(spark, scratch, cat, lambda s: T.view_counts(s, "1 hour", "0 seconds"), "t02", 1)
    got = got.select("movie_id", F.date_format("window_start", "yyyy-MM-dd HH:00").alias("bucket"), "views")
    want = E.movie_view_buckets(cat.media_events, "hour")
    # the sentinel's batch moves the watermark a day past the data: every real window is closed
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_sessions_equal_batch(spark, cat, scratch):
    got = _run_twice(spark, scratch, cat, T.session_rollup, "t03", 5)
    want = E.sessions(cat.media_events).select("session_id", "started_at", "ended_at", "page_views", "events")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_dedup(spark, cat, scratch):
    src = os.path.join(scratch, "in")
    ev = cat.tables.events
    ev.write.parquet(os.path.join(src, "a"))
    ev.orderBy("event_id").limit(50).write.parquet(os.path.join(src, "b"))  # redelivered events
    out = os.path.join(scratch, "dedup")
    T.run_to_parquet(T.deduplicated(T.event_stream(spark, src, file_glob="*.parquet")), spark,
                     "t04-" + os.path.basename(scratch), out)
    got = spark.read.parquet(out)
    assert got.count() == ev.count() and got.select("event_id").distinct().count() == ev.count()


def test_stream_validated_ingest(spark, cat, scratch):
    src = os.path.join(scratch, "in")
    cat.tables.events.write.parquet(os.path.join(src, "a"))
    stream = T.event_stream(spark, src, file_glob="*.parquet")
    acc, rej = os.path.join(scratch, "acc"), os.path.join(scratch, "rej")
    from cinemetric.session import stream_checkpoint

    q = T.validated_ingest(stream, acc, rej, stream_checkpoint(spark, "t01-" + os.path.basename(scratch)))
    q.trigger(availableNow=True).start().awaitTermination()
    n_acc, n_rej = spark.read.parquet(acc).count(), spark.read.parquet(rej).count()
    assert n_acc + n_rej == cat.tables.events.count() and n_rej == 0


def test_movies_csv_round_trip(spark, cat, scratch):
    rows = ST.movie_file_rows(cat).drop("seq")
    cols = rows.columns
    # the cleaned file has an unused column between release_date and runtime
    rows = rows.select(*cols[:10], F.lit(None).cast("string").alias("unused"), *cols[10:])
    path = os.path.join(scratch, "movies_csv")
    I.write_csv(rows.coalesce(1), path)
    parsed = I.read_movies_csv(spark, path)
    want = cat.movies.select("movie_id", "title", "adult", "released_date", "runtime",
                             F.col("popularity").cast("decimal(10,2)").alias("popularity"))
    got = parsed.select("movie_id", "title", "adult", "released_date", "runtime", "popularity")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    g = parsed.select("movie_id", F.size("genres").alias("n"))
    ref = cat.movie_genres.groupBy("movie_id").count()
    assert g.join(ref, "movie_id", "left").filter(F.coalesce("count", F.lit(0)) != F.col("n")).count() == 0


def test_json_array_and_links(spark, scratch):
    p = os.path.join(scratch, "a.json")
    with open(p, "w") as f:
        f.write('[{"id": 1, "name": "x"},\n {"id": 2, "name": "y"}]')
    assert I.read_json_array(spark, p).count() == 2
    lp = os.path.join(scratch, "links.csv")
    with open(lp, "w") as f:
        f.write("movieId,imdbId,tmdbId\n1,114709,862.0\n2,113497,\n")
    got = {r.movieId: r.tmdbId for r in I.read_links(spark, lp).collect()}
    assert got == {1: 862, 2: None}


def test_latency_summary_and_winner(spark):
    rows = [("title", "pg", float(i)) for i in range(1, 21)] + [("title", "mongo", 5.0)] * 3
    df = spark.createDataFrame(rows, "test string, engine string, latency_ms double")
    s = {r.engine: r for r in P.latency_summary(df, ["test", "engine"]).collect()}
    assert s["pg"].p95_latency_ms == 20.0 and s["pg"].median_latency_ms == 10.5 and s["pg"].runs == 20
    assert s["mongo"].p95_latency_ms == 5.0 and s["mongo"].ops_per_sec == 200.0
    w = {r.metric: r.winner for r in P.metric_winner(P.latency_summary(df, ["test", "engine"]), "test", "engine", "pg", "mongo").collect()}
    assert w["min_latency_ms"] == "pg" and w["max_latency_ms"] == "mongo" and w["ops_per_sec"] == "mongo"
