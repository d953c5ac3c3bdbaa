"""Event aggregates kept as mergeable partial states (M-01, E-07, T-02).

A state row sums up the events of one (movie, hour); a second table holds when each user last
sent a weighted event for a movie.  Both merge by sum and maximum, so old state plus the state of
new events is the state of all of them, in any order and grouping:

* counts per event type add up;
* the trending score decays exponentially, so an hour's events are weighed relative to the hour's
  begin, and any later instant only multiplies the hour's mass;
* users seen since an instant are those whose last event is not before it.

``EventState`` stores them.  A batch is folded in by writing its state under its batch id (a replay
writes the same again), and ``compact`` merges the batches written so far into key-range tables, whose
manifest names the last batch that they hold: readers take the tables and the batches behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetric.operators.key_ranges import KeyRangeTable
from cinemetric.plans.events import TREND_WEIGHTS, ntz

COUNTED = ("page_view", "search", "click", "add_to_cart", "purchase")
HOURS = "movie_id int, hour timestamp_ntz, weighted long, mass double, " + ", ".join(f"{t} long" for t in COUNTED)
USERS = "movie_id int, user_key string, last_ts timestamp_ntz"
DECAY_PER_DAY = 0.1


def _days(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later).cast("double") / 86400e6


def _weight() -> Column:
    weight = F.lit(0.0)
    for name, w in TREND_WEIGHTS.items():
        weight = F.when(F.col("type") == name, F.lit(w)).otherwise(weight)
    return weight


def hour_states(events: DataFrame) -> DataFrame:
    """One row per (movie, hour) that has events."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    rows = events.filter(F.col("movie_id").isNotNull()).withColumn("hour", hour)
    mass = _weight() * F.exp(F.lit(DECAY_PER_DAY) * _days(F.col("ts"), F.col("hour")))
    return rows.groupBy(F.col("movie_id").cast("int").alias("movie_id"), "hour").agg(
        F.count_if(F.col("type").isin(*TREND_WEIGHTS)).alias("weighted"), F.sum(mass).alias("mass"),
        *[F.count_if(F.col("type") == t).alias(t) for t in COUNTED],
    )


def user_states(events: DataFrame) -> DataFrame:
    """One row per movie and user with a weighted event; an event without a user counts as one user."""
    rows = events.filter(F.col("movie_id").isNotNull() & F.col("type").isin(*TREND_WEIGHTS))
    key = F.coalesce(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("-")).alias("user_key")
    return rows.groupBy(F.col("movie_id").cast("int").alias("movie_id"), key).agg(F.max("ts").alias("last_ts"))


def merge_hours(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("weighted", "mass", *COUNTED)]
    return rows.groupBy("movie_id", "hour").agg(*sums)


def merge_users(rows: DataFrame) -> DataFrame:
    return rows.groupBy("movie_id", "user_key").agg(F.max("last_ts").alias("last_ts"))


class EventState:
    """The two state tables under one folder."""

    def __init__(self, spark: SparkSession, path: str, target_rows: int = 2_000_000):
        self.spark, self.path = spark, path.rstrip("/")
        self._tables = {
            "hours": (KeyRangeTable(spark, f"{self.path}/hours", ["movie_id", "hour"], target_rows), HOURS, merge_hours, hour_states),
            "users": (KeyRangeTable(spark, f"{self.path}/users", ["movie_id", "user_key"], target_rows), USERS, merge_users, user_states),
        }
        for table, schema, _, _ in self._tables.values():
            if not table.versions():
                table.create(spark.createDataFrame([], schema), note="-1")

    def add(self, batch_id: int, events: DataFrame) -> None:
        """Fold a batch in; the same batch again changes nothing."""
        for name, (_, _, _, state_of) in self._tables.items():
            state_of(events).write.mode("overwrite").parquet(f"{self.path}/batches/{name}/batch={batch_id}")

    def _batches(self, name: str) -> list[int]:
        table = self._tables[name][0]
        root = table._path(f"{self.path}/batches/{name}")
        if not table._fs.exists(root):
            return []
        found = [f.getPath() for f in table._fs.listStatus(root)]
        return sorted(int(p.getName().split("=")[1]) for p in found if table._fs.exists(table._path(p, "_SUCCESS")))

    def _open(self, name: str) -> tuple[int, DataFrame | None]:
        """Last complete batch, and the rows of the batches that the table does not hold yet."""
        table, schema, _, _ = self._tables[name]
        held = int(table.note())
        new = [b for b in self._batches(name) if b > held]
        if not new:
            return held, None
        return new[-1], self.spark.read.schema(schema).parquet(*[f"{self.path}/batches/{name}/batch={b}" for b in new])

    def read(self, name: str) -> DataFrame:
        table, _, merge, _ = self._tables[name]
        _, new = self._open(name)
        return table.read() if new is None else merge(table.read().unionByName(new))

    def compact(self) -> None:
        """Merge the written batches into the tables; only ranges that they touch are rewritten."""
        for name, (table, _, merge, _) in self._tables.items():
            last, new = self._open(name)
            if new is not None:
                table.change(merge(new), lambda rows, batch, merge=merge: merge(rows.unionByName(batch)), note=str(last))

    # -- what the states answer ---------------------------------------------------------------

    def trending_scores(self, as_of, days: int = 7) -> DataFrame:
        """E-07 before ranking.  The window must begin with an hour: its hours count as a whole."""
        instant = ntz(as_of)
        begin = instant - F.make_dt_interval(days=F.lit(days))
        decayed = F.col("mass") * F.exp(F.lit(-DECAY_PER_DAY) * _days(instant, F.col("hour")))
        hours = self.read("hours").filter((F.col("hour") >= begin) & (F.col("weighted") > 0))
        scores = hours.groupBy("movie_id").agg(F.bround(F.sum(decayed), 2).alias("trending_score"), F.sum("weighted").alias("total_events"))
        seen = self.read("users").filter(F.col("last_ts") >= begin).groupBy("movie_id").agg(F.count(F.lit(1)).alias("unique_user_count"))
        return scores.join(seen, "movie_id")

    def movie_aggregates(self, as_of, days: int = 7) -> DataFrame:
        """M-01 documents with nested hourly and daily maps of page views."""
        hours = self.read("hours")
        views = hours.filter("page_view > 0").withColumn("day", F.date_format("hour", "yyyy-MM-dd"))
        hourly = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.date_format("hour", "yyyy-MM-dd HH:00"), F.col("page_view")))))
        by_hour = views.groupBy("movie_id").agg(hourly.alias("hourly"))
        by_day = views.groupBy("movie_id", "day").agg(F.sum("page_view").alias("n"))
        by_day = by_day.groupBy("movie_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", "n")))).alias("daily"))
        totals = hours.groupBy("movie_id").agg(*[F.sum(t).alias(t) for t in COUNTED])
        scores = self.trending_scores(as_of, days).select("movie_id", "trending_score")
        out = totals.join(by_hour, "movie_id", "left").join(by_day, "movie_id", "left").join(scores, "movie_id", "left")
        per_view = lambda c: F.try_divide(F.col(c).cast("double"), F.col("page_view").cast("double"))
        return out.select(
            "movie_id", F.struct("hourly", "daily", F.col("page_view").alias("total")).alias("views"),
            F.struct(per_view("click").alias("click_rate"), per_view("add_to_cart").alias("add_to_cart_rate"), per_view("purchase").alias("conversion_rate")).alias("engagement"),
            "trending_score", ntz(as_of).alias("computed_at"),
        )
