"""Operators exercised on literal inputs: recent movies, recommendations, nested
aggregates, sinks, point forms of drill-downs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cinemetric.operators import mutate as W
from cinemetric.plans import events as E
from cinemetric.plans import search as S
from cinemetric.sources import ingest as I


def test_recent_movies_nulls_first(spark):
    t = dt.datetime(2024, 1, 1)
    m = spark.createDataFrame(
        [(1, "a", None, 0.0, t), (2, "b", None, 5.0, None), (3, "c", None, None, t + dt.timedelta(days=1))],
        "movie_id int, title string, released_date date, popularity double, created_at timestamp_ntz")
    out = S.recent_movies(m).collect()
    assert [r.movie_id for r in out] == [2, 3, 1]   # DESC without NULLS clause: NULL first
    assert out[2].popularity is None                  # 0 shown as missing (C-12)


def test_latest_recommendations(spark):
    rec = "struct<movie_id:int,score:double,reason:string>"
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 30, 12), "a", [(5, 0.9, "x"), (6, 0.8, "y")]),
         (1, dt.datetime(2024, 1, 30, 18), "b", [(7, 0.7, "z")]),
         (2, dt.datetime(2024, 1, 28), "a", [(8, 0.5, "old")])],
        f"user_id int, generated_at timestamp_ntz, algorithm string, movies array<{rec}>")
    out = E.latest_recommendations(df, "2024-01-31 00:00:00").collect()
    assert [(r.user_id, r.algorithm, r.movie_id, r.position) for r in out] == [(1, "b", 7, 0)]


def test_movie_aggregates_nested(spark, cat):
    agg = E.movie_aggregates(cat.media_events, "2024-01-31 00:00:00")
    row = agg.orderBy(F.col("views.total").desc(), "movie_id").first()
    assert sum(row.views.hourly.values()) == row.views.total == sum(row.views.daily.values())
    assert row.engagement.click_rate is None or row.engagement.click_rate >= 0


def test_sessions_and_activity(spark):
    t = dt.datetime(2024, 1, 5, 10)
    ev = spark.createDataFrame(
        [(1, t, "page_view", None, 5, "s"), (2, t + dt.timedelta(seconds=90), "rating_submitted", 3, None, "s")],
        "event_id long, ts timestamp_ntz, type string, user_id long, movie_id int, session_id string")
    s = E.sessions(ev).collect()[0]
    assert s.user_id is None and s.duration_seconds == 90 and s.page_views == 1 and s.events == 2
    a = E.activity_summary(ev).collect()[0]
    assert a.user_id == 3 and a.total_ratings == 1 and a.total_views == 0


def test_point_forms(spark, cat):
    sib = S.sibling_genres_of(cat, 2, 1).collect()
    links = cat.movie_genres.filter("movie_id = 2").collect()
    assert len(sib) == len([r for r in links if r.genre_id != 1])
    gid = cat.movie_genres.orderBy("genre_id").first().genre_id
    summary = S.link_list_summary(S.movie_genre_list(cat, genre_id=gid), "genre_id").collect()[0]
    assert summary.unique_dims == 1
    counts = S.person_credit_counts(cat, cat.people.filter("person_id = 2").select("person_id")).collect()
    assert len(counts) == 1
    assert S.autocomplete_movies(cat, "r").count() == 0


def test_cascade_user_and_sinks(spark, scratch):
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    ratings = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "user_id int, movie_id int")
    out = W.cascade_delete({"users": users, "ratings": ratings}, spark.createDataFrame([(2,)], "user_id int"), "user_id")
    assert out["users"].count() == 1 and out["ratings"].count() == 1
    base = os.path.join(scratch, "t0")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(base)
    I.upsert_into(spark, base, spark.createDataFrame([(2, "B0", 1), (2, "B", 2), (None, "x", 3), (3, "c", 4)], "id long, v string, seq int"), "id", "seq",
                  os.path.join(scratch, "t1"))
    got = sorted((r.id, r.v) for r in spark.read.parquet(os.path.join(scratch, "t1")).collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]
    I.insert_new(spark, base, spark.createDataFrame([(2, "B", 1), (4, "d", 2), (4, "a", 3)], "id long, v string, seq int"), "id", "seq",
                 os.path.join(scratch, "t2"))
    got = sorted((r.id, r.v) for r in spark.read.parquet(os.path.join(scratch, "t2")).collect())
    assert got == [(1, "a"), (2, "b"), (4, "d")]


class _Cat:
    def __init__(self, movies):
        self.movies = movies


def test_movie_find_union_semantics(spark):
    m = spark.createDataFrame(
        [(12, "Film 12", None, 0.0), (7, "Apollo 12", None, 3.5), (99, "Other", None, 1.0)],
        "movie_id int, title string, released_date date, popularity double")
    hit_has_id = S.movie_find(_Cat(m), "12").orderBy("rank", "title").collect()
    assert [(r.rank, r.movie_id, r.popularity) for r in hit_has_id] == [(1, 7, None), (1, 12, None)]
    m2 = m.filter("movie_id != 12").unionByName(
        spark.createDataFrame([(12, "Twelve", None, 0.0)], "movie_id int, title string, released_date date, popularity double"))
    got = S.movie_find(_Cat(m2), "12").orderBy("rank", "title").collect()
    assert [(r.rank, r.movie_id, r.popularity) for r in got] == [(0, 12, 0.0), (1, 7, None)]


def test_refreshed_facts_join_one_row_per_movie(spark):
    # before: every rating and every change row was sorted for the joins, several times over in one task
    from decimal import Decimal

    from cinemetric.plans.common import facts_from, refresh_facts

    old = [(1, Decimal("1.0")), (1, Decimal("2.0")), (2, Decimal("3.0")), (4, Decimal("4.0")), (None, Decimal("5.0"))]
    ratings = spark.createDataFrame(old, "movie_id int, rating decimal(3,1)")
    genres = spark.createDataFrame([(1, "B"), (1, "A"), (2, "A"), (3, "C"), (None, "D")], "movie_id int, genre_name string")
    new = ratings.unionByName(spark.createDataFrame([(1, Decimal("6.0")), (5, Decimal("7.0"))], ratings.schema))
    changed = spark.createDataFrame([(1,), (1,), (3,), (5,), (6,), (None,)], "movie_id int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = refresh_facts(facts_from(ratings, genres), new, genres, changed)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = facts_from(new.filter("movie_id is null or movie_id < 9"), genres).collect()
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert plan.count("LeftSemi") == 1
