"""Invariants from the test strategy: they hold for any input, so they run on the driver data."""

from pyspark.sql import functions as F

from cinemetric.operators import validate as V
from cinemetric.plans import events as E
from cinemetric.plans import loads as L
from cinemetric.plans import search as S
from cinemetric.plans.common import movie_facts


def test_bridge_keys_unique(cat):
    for df, keys in ((L.movie_genre_bridge(cat), ["movie_id", "genre_id"]), (cat.movie_keywords, ["movie_id", "keyword_id"]),
                     (L.cast_first_wins(cat), ["movie_id", "person_id"]),
                     (L.crew_first_wins(cat), ["movie_id", "person_id", "job"])):
        assert df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_combined_search_without_filters_returns_every_movie(cat):
    n = cat.movies.count()
    assert S.combined_search(cat, limit=None).count() == n
    assert S.combined_search(cat, limit=None).select("movie_id").distinct().count() == n


def test_funnel_counts_bounded_by_sessions(cat):
    r = E.conversion_funnel(cat.media_events, "2024-02-10 00:00:00").collect()[0]
    for c in (r.search_count, r.view_count, r.cart_count, r.purchase_count):
        assert 0 <= c <= r.total_sessions


def test_accepted_plus_rejected_is_input(cat):
    rows = L.checked_rating_rows(cat)
    ok, bad = rows.filter(F.size("reasons") == 0), rows.filter(F.size("reasons") > 0)
    assert ok.count() + bad.count() == rows.count()
    acc, rej = V.split(cat.movies.select("movie_id", "title", "language"), V.movie_rules())
    assert acc.count() + rej.count() == cat.movies.count()


def test_fanout_count_distinct_equals_preaggregated(cat):
    # the source's COUNT(DISTINCT rating_id) over ratings x genres equals the per-movie count
    fan = (cat.movies.select("movie_id").join(cat.ratings, "movie_id", "left").join(cat.movie_genres, "movie_id", "left")
           .groupBy("movie_id").agg(F.count_distinct("rating_id").alias("n")))
    pre = movie_facts(cat, False).select("movie_id", F.col("rating_count").alias("m"))
    diff = fan.join(pre, "movie_id", "left").filter(F.coalesce("m", F.lit(0)) != F.col("n"))
    assert diff.count() == 0
