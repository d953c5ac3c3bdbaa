"""Event analytics (E-01..E-07) and the event-derived tables (M-01..M-05).

Input: an events DataFrame with ``event_id, ts (timestamp_ntz), type, user_id, movie_id,
session_id`` (the catalogue's ``media_events``).  Every time window is relative to an
explicit ``as_of`` instant; nothing reads the wall clock.

All groupings are hash aggregations with map-side partial aggregation, so a hot user,
session or movie is combined per task before the shuffle.  The document store's
``$addToSet`` + ``$size`` counts an explicit null as a member; that is reproduced as
``count(distinct x) + max(x is null)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.functions.ordering import top_k

# The event types of the validated events collection, in declaration order.
EVENT_TYPES = (
    "page_view", "search", "click", "add_to_cart", "remove_from_cart", "checkout", "purchase", "rating_submitted",
)
# Funnel stages and trending weights of the source pipelines.
FUNNEL_TYPES = ("search", "page_view", "add_to_cart", "purchase")
TREND_WEIGHTS = {"page_view": 1.0, "search": 0.5, "add_to_cart": 3.0, "purchase": 10.0}
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def ntz(ts) -> Column:
    """A ``timestamp_ntz`` literal (no session time zone involved)."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    if isinstance(ts, _dt.datetime):
        ts = ts.isoformat(sep=" ")
    return F.lit(str(ts)).cast("timestamp_ntz")


def since(as_of, days: int, ts: str = "ts") -> Column:
    """``ts >= as_of - days`` (F-16; no upper bound).  Constant-folded to a literal, so it is
    pushed into the Parquet scan as a range filter."""
    return F.col(ts) >= ntz(as_of) - F.make_dt_interval(days=F.lit(days))


def set_size(c: str) -> Column:
    """``$size`` of ``$addToSet``: distinct values, an explicit null counting as one."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def event_funnel(events: DataFrame, as_of, days: int = 30) -> DataFrame:
    """E-01: per event type in the window: count, unique users, unique movies; count DESC."""
    out = events.filter(since(as_of, days)).groupBy(F.col("type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("count"),
        set_size("user_id").alias("unique_user_count"),
        set_size("movie_id").alias("unique_movie_count"),
    )
    return out.orderBy(F.col("count").desc(), "event_type")


def top_movies_by_views(events: DataFrame, k: int = 10) -> DataFrame:
    """E-02: page views and unique viewers per movie; top ``k`` by views."""
    views = events.filter((F.col("type") == "page_view") & F.col("movie_id").isNotNull())
    out = views.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("view_count"), set_size("user_id").alias("unique_viewer_count")
    )
    return top_k(out, [F.col("view_count").desc(), F.col("movie_id")], k)


def hourly_activity(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    """E-03: events per hour of day in the window, with an ``H:00-(H+1):00`` label."""
    out = events.filter(since(as_of, days)).groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("event_count"))
    label = F.concat(F.col("hour").cast("string"), F.lit(":00-"), (F.col("hour") + 1).cast("string"), F.lit(":00"))
    return out.select("hour", "event_count", label.alias("hour_label")).orderBy("hour")


def user_engagement(events: DataFrame, profiles: DataFrame, as_of, days: int = 30, k: int = 20) -> DataFrame:
    """E-04: per known user in the window: totals by type, last activity, score
    ``views + 2*searches + 10*purchases``, joined to the profile (kept when absent); top ``k``."""
    per_user = (
        events.filter(F.col("user_id").isNotNull() & since(as_of, days))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("type") == "page_view").alias("page_views"),
            F.count_if(F.col("type") == "search").alias("searches"),
            F.count_if(F.col("type") == "purchase").alias("purchases"),
            F.max("ts").alias("last_activity"),
        )
        .withColumn("engagement_score", F.col("page_views") + 2 * F.col("searches") + 10 * F.col("purchases"))
    )
    # rank first, then look up profiles for the k winners only
    top = top_k(per_user, [F.col("engagement_score").desc(), F.col("user_id")], k)
    return top.join(profiles, "user_id", "left").select(
        "user_id", "total_events", "page_views", "searches", "purchases", "engagement_score", "last_activity",
        "favorite_genre",
    )


def day_name(dow: Column) -> Column:
    out = F.lit("Unknown")
    for i in range(len(DAY_NAMES), 0, -1):
        out = F.when(dow == i, F.lit(DAY_NAMES[i - 1])).otherwise(out)
    return out


def facets(events: DataFrame, as_of, days: int = 30, top_movies: int = 5) -> dict[str, DataFrame]:
    """E-05: four aggregations over one filtered input (``$facet``).  Each facet is its own
    lazy DataFrame; the caller may ``cache`` the filtered input if it runs them together."""
    base = events.filter(since(as_of, days))
    by_type = base.groupBy(F.col("type").alias("event_type")).agg(F.count(F.lit(1)).alias("count"))
    by_dow = base.groupBy(F.dayofweek("ts").alias("dow")).agg(F.count(F.lit(1)).alias("count"))
    by_day = by_dow.select(day_name(F.col("dow")).alias("day"), "count", "dow").orderBy("dow").drop("dow")
    movies = base.filter(F.col("movie_id").isNotNull()).groupBy("movie_id").agg(F.count(F.lit(1)).alias("events"))
    summary = base.agg(
        F.count(F.lit(1)).alias("total_events"),
        set_size("user_id").alias("unique_user_count"),
        set_size("session_id").alias("unique_session_count"),
        F.min("ts").alias("min_date"),
        F.max("ts").alias("max_date"),
    )
    return {
        "by_type": by_type.orderBy(F.col("count").desc(), "event_type"),
        "by_day_of_week": by_day,
        "top_movies": top_k(movies, [F.col("events").desc(), F.col("movie_id")], top_movies),
        "summary": summary,
    }


def facet_counts(events: DataFrame, as_of, days: int = 30) -> DataFrame:
    """E-05a..c in ONE pass: event counts by type, by weekday and by movie as one long table
    ``(facet, key, count)`` from a single scan with ``GROUPING SETS`` (Spark expands each
    row once per set and aggregates them in one shuffle).  The per-facet ordering / top-k of
    ``facets`` can be applied to the rows of each facet."""
    base = events.filter(since(as_of, days)).select(
        "type", F.dayofweek("ts").alias("dow"), "movie_id"
    )
    g = base.groupingSets([["type"], ["dow"], ["movie_id"]], "type", "dow", "movie_id").agg(
        F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_gid")
    )
    # grouping_id bits follow (type, dow, movie_id): 3 = by type, 5 = by weekday, 6 = by movie
    facet = F.when(F.col("_gid") == 3, "by_type").when(F.col("_gid") == 5, "by_day_of_week").otherwise("top_movies")
    key = (
        F.when(F.col("_gid") == 3, F.col("type"))
        .when(F.col("_gid") == 5, day_name(F.col("dow")))
        .otherwise(F.col("movie_id").cast("string"))
    )
    out = g.select(facet.alias("facet"), key.alias("key"), "count")
    # top_movies counts only events that name a movie
    return out.filter(~((F.col("facet") == "top_movies") & F.col("key").isNull()))


def conversion_funnel(events: DataFrame, as_of, days: int = 30) -> DataFrame:
    """E-06: per session the stages reached (independent flags), then session counts and
    percentage rates; a zero denominator gives NULL instead of an error."""
    per_session = (
        events.filter(since(as_of, days) & F.col("type").isin(*FUNNEL_TYPES))
        .groupBy("session_id")
        .agg(*[F.max((F.col("type") == t).cast("int")).alias(f"had_{t}") for t in FUNNEL_TYPES])
    )
    totals = per_session.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("had_search").cast("bigint").alias("search_count"),
        F.sum("had_page_view").cast("bigint").alias("view_count"),
        F.sum("had_add_to_cart").cast("bigint").alias("cart_count"),
        F.sum("had_purchase").cast("bigint").alias("purchase_count"),
    )

    def rate(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) * 100

    return totals.select(
        "total_sessions", "search_count", "view_count", "cart_count", "purchase_count",
        rate("view_count", "search_count").alias("search_to_view_rate"),
        rate("cart_count", "view_count").alias("view_to_cart_rate"),
        rate("purchase_count", "cart_count").alias("cart_to_purchase_rate"),
        rate("purchase_count", "total_sessions").alias("overall_conversion_rate"),
    )


def decay_weight(as_of, ts: str = "ts", type_col: str = "type", rate: float = 0.1) -> Column:
    """C-28: ``type weight * exp(-rate * age_in_days)``; unknown types weigh 0."""
    age_days = F.timestamp_diff("MICROSECOND", F.col(ts), ntz(as_of)).cast("double") / 86400e6
    weight = F.lit(0.0)
    for t, w in reversed(list(TREND_WEIGHTS.items())):
        weight = F.when(F.col(type_col) == t, F.lit(w)).otherwise(weight)
    return weight * F.exp(F.lit(-rate) * age_days)


def trending_scores(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    """E-07 before ranking: decayed score (half-even rounded to 2 places), event count and
    unique users per movie in the window."""
    window = events.filter(
        F.col("type").isin(*TREND_WEIGHTS) & F.col("movie_id").isNotNull() & since(as_of, days)
    )
    return window.groupBy("movie_id").agg(
        F.bround(F.sum(decay_weight(as_of)), 2).alias("trending_score"),
        F.count(F.lit(1)).alias("total_events"),
        set_size("user_id").alias("unique_user_count"),
    )


def trending(events: DataFrame, as_of, days: int = 7, k: int = 20) -> DataFrame:
    """E-07: top ``k`` movies by rounded trending score."""
    return top_k(trending_scores(events, as_of, days), [F.col("trending_score").desc(), F.col("movie_id")], k)


# ---------------------------------------------------------------------------------------
# M-01..M-05 tables declared by the document schema (definitions marked ours in SURVEY)
# ---------------------------------------------------------------------------------------


def movie_view_buckets(events: DataFrame, unit: str = "hour") -> DataFrame:
    """M-01 counters in long form: page views per movie per hour (``yyyy-MM-dd HH:00``) or
    day (``yyyy-MM-dd``).  The long form is what scales; ``movie_aggregates`` nests it."""
    fmt = "yyyy-MM-dd HH:00" if unit == "hour" else "yyyy-MM-dd"
    views = events.filter((F.col("type") == "page_view") & F.col("movie_id").isNotNull())
    return views.groupBy("movie_id", F.date_format("ts", fmt).alias("bucket")).agg(
        F.count(F.lit(1)).alias("views")
    )


def movie_engagement(events: DataFrame, as_of, trend_days: int = 7) -> DataFrame:
    """M-01 scalars: total page views, click / add-to-cart / purchase rates per page view,
    and the E-07 trending score (NULL when the movie had no weighted event in the window)."""
    scored = F.col("type").isin(*TREND_WEIGHTS) & since(as_of, trend_days)
    per_movie = events.filter(F.col("movie_id").isNotNull()).groupBy("movie_id").agg(
        F.bround(F.sum(F.when(scored, decay_weight(as_of))), 2).alias("trending_score"),
        F.count_if(F.col("type") == "page_view").alias("views_total"),
        F.count_if(F.col("type") == "click").alias("_clicks"),
        F.count_if(F.col("type") == "add_to_cart").alias("_carts"),
        F.count_if(F.col("type") == "purchase").alias("_buys"),
    )
    pv = F.col("views_total").cast("double")
    return per_movie.select(
        "movie_id",
        "views_total",
        F.try_divide(F.col("_clicks").cast("double"), pv).alias("click_rate"),
        F.try_divide(F.col("_carts").cast("double"), pv).alias("add_to_cart_rate"),
        F.try_divide(F.col("_buys").cast("double"), pv).alias("conversion_rate"),
        "trending_score",
        ntz(as_of).alias("computed_at"),
    )


def movie_aggregates(events: DataFrame, as_of) -> DataFrame:
    """M-01 documents: engagement scalars plus ``views.hourly`` / ``views.daily`` maps."""
    def nested(unit: str, name: str) -> DataFrame:
        b = movie_view_buckets(events, unit)
        return b.groupBy("movie_id").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "views"))).alias(name))

    eng = movie_engagement(events, as_of)
    out = eng.join(nested("hour", "hourly"), "movie_id", "left").join(nested("day", "daily"), "movie_id", "left")
    return out.select(
        "movie_id",
        F.struct("hourly", "daily", F.col("views_total").alias("total")).alias("views"),
        F.struct("click_rate", "add_to_cart_rate", "conversion_rate").alias("engagement"),
        "trending_score",
        "computed_at",
    )


def sessions(events: DataFrame) -> DataFrame:
    """M-02: one row per session: first user (by time), start, end, duration, page views."""
    per = events.groupBy("session_id").agg(
        F.min_by("user_id", F.struct("ts", "event_id")).alias("user_id"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.count_if(F.col("type") == "page_view").alias("page_views"),
        F.count(F.lit(1)).alias("events"),
    )
    return per.withColumn(
        "duration_seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    ).select("session_id", "user_id", "started_at", "ended_at", "duration_seconds", "page_views", "events")


def activity_summary(events: DataFrame) -> DataFrame:
    """M-03: per known user: views, searches, ratings submitted, purchases, last activity."""
    return events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count_if(F.col("type") == "page_view").alias("total_views"),
        F.count_if(F.col("type") == "search").alias("total_searches"),
        F.count_if(F.col("type") == "rating_submitted").alias("total_ratings"),
        F.count_if(F.col("type") == "purchase").alias("total_purchases"),
        F.max("ts").alias("last_active"),
    )


def viewing_history(events: DataFrame) -> DataFrame:
    """M-04 in long form: (user, movie, viewed_at) of each known user's movie page views;
    ``duration_seconds`` comes from ``duration_ms`` when the input carries it."""
    views = events.filter((F.col("type") == "page_view") & F.col("user_id").isNotNull() & F.col("movie_id").isNotNull())
    dur = (F.col("duration_ms") / 1000).cast("int") if "duration_ms" in events.columns else F.lit(None).cast("int")
    return views.select("user_id", "movie_id", F.col("ts").alias("viewed_at"), dur.alias("duration_seconds"))


def latest_recommendations(recs: DataFrame, as_of, ttl_seconds: int = 86400) -> DataFrame:
    """M-05: the newest unexpired recommendation list per user, one row per movie.
    ``recs``: ``user_id, generated_at, algorithm, movies: array<struct<movie_id,score,reason>>``."""
    live = recs.filter(F.col("generated_at") >= ntz(as_of) - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    newest = live.groupBy("user_id").agg(
        F.max_by(F.struct("generated_at", "algorithm", "movies"), "generated_at").alias("r")
    )
    return newest.select(
        "user_id", F.col("r.generated_at").alias("generated_at"), F.col("r.algorithm").alias("algorithm"),
        F.posexplode("r.movies").alias("position", "m"),
    ).select("user_id", "generated_at", "algorithm", "position", "m.movie_id", "m.score", "m.reason")
