"""Structured Streaming versions of the event jobs (T-01..T-04).

The source has no streaming operators; its only time-driven behaviour is the events TTL.
These jobs re-aim the batch operators at an unbounded event feed: a file stream of raw
event parquet files, mapped to the media-event shape, with event-time watermarks so state
is bounded.  Checkpoints live under the shared ``spark.checkpoint.dir`` (see
``cinemetric.session.stream_checkpoint``), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetric.operators import validate as V
from cinemetric.session import stream_checkpoint
from cinemetric.sources.catalogue import media_events_from

# Schema of the raw event feed.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def event_stream(spark: SparkSession, folder: str, file_glob: str = "events*.parquet", max_files: int | None = None) -> DataFrame:
    """Raw event files arriving in ``folder`` → streaming DataFrame of media events, plus
    ``event_time``: watermarks need a session-zone ``TIMESTAMP`` (the session zone is
    pinned to UTC, so it shows the same wall clock as ``ts``)."""
    reader = (
        spark.readStream.schema(RAW_EVENT_SCHEMA).option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_event_time(media_events_from(reader.parquet(folder)))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", F.col("ts").cast("timestamp"))


def validated_ingest(events: DataFrame, accepted_path: str, rejected_path: str, checkpoint: str):
    """T-01: every micro-batch is split by the V-02 rules into an accepted and a rejected
    parquet sink (``foreachBatch``: both writes use the batch id, so a replayed batch
    overwrites its own output instead of duplicating it)."""
    rules = V.event_rules()

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = V.check(batch.drop("event_time"), rules)
        ok = F.size("reasons") == 0
        checked.filter(ok).drop("reasons").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{accepted_path}/batch_id={batch_id}"
        )
        checked.filter(~ok).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{rejected_path}/batch_id={batch_id}"
        )

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def view_counts(events: DataFrame, unit: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """T-02: page views per movie per event-time window; windows close (and are emitted in
    append mode) once the watermark passes them."""
    views = events.filter((F.col("type") == "page_view") & F.col("movie_id").isNotNull())
    return (
        views.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", unit).alias("w"), "movie_id")
        .agg(F.count(F.lit(1)).alias("views"))
        .select("movie_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "views")
    )


def folded_states(events: DataFrame, state, checkpoint: str):
    """T-02 for open windows: every micro-batch is folded into the partial states, which answer at any
    time.  A batch is stored under its id, so a replayed one counts once."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        state.add(batch_id, batch)

    return events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)


def session_rollup(events: DataFrame, gap: str = "24 hours", lateness: str = "25 hours") -> DataFrame:
    """T-03: session roll-up with a session window per session id (M-02 as a stream)."""
    return (
        events.withWatermark("event_time", lateness)
        .groupBy("session_id", F.session_window("event_time", gap).alias("s"))
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count_if(F.col("type") == "page_view").alias("page_views"),
            F.count(F.lit(1)).alias("events"),
        )
        .select("session_id", "started_at", "ended_at", "page_views", "events")
    )


def deduplicated(events: DataFrame, lateness: str = "30 days") -> DataFrame:
    """T-04: drop repeated deliveries of an event id; state for an id expires with the
    watermark, which plays the part of the events TTL."""
    return events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"]).drop("event_time")


def run_to_parquet(df: DataFrame, spark: SparkSession, name: str, out_path: str, mode: str = "append"):
    """Start ``df`` as a parquet sink with a checkpoint under the shared folder and process
    everything currently available (``availableNow``)."""
    q = (
        df.writeStream.format("parquet").outputMode(mode).option("path", out_path)
        .option("checkpointLocation", stream_checkpoint(spark, name)).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q
