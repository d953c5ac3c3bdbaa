"""Streams with timers against their batch results, restarts included."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cinemetric.plans import events as E
from cinemetric.streaming import events_stream as T
from cinemetric.streaming import timed_state as TS

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    TS.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _file(spark, folder, name, rows):
    """Raw events (id, hours after the start, user, type)."""
    raw = [(i, T0 + dt.timedelta(hours=h), u, t, 0.0, '{"k": 5}') for i, h, u, t in rows]
    spark.createDataFrame(raw, T.RAW_EVENT_SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def _run(spark, job, folder, name, out):
    stream = T.event_stream(spark, folder, file_glob="*.parquet")
    T.run_to_parquet(job(stream), spark, name, out)
    return spark.read.parquet(out)


def test_sessions_by_timer_equal_batch(spark, store, scratch):
    src, out, name = os.path.join(scratch, "in"), os.path.join(scratch, "out"), "t03-" + os.path.basename(scratch)
    first = [(1, 1.0, 7, "view"), (2, 3.5, 7, "click"), (3, 2.0, 8, "view"), (11, 1.5, 9, "view")]
    later = [(4, 5.0, 7, "view"), (5, 0.5, 7, "view"), (6, 3.0, 8, "purchase")]
    _file(spark, src, "a", first)
    _run(spark, lambda s: TS.sessions(s, dt.timedelta(hours=4), "10 hours"), src, name, out)
    _file(spark, src, "b", later)  # a restart: earlier and later events of the open sessions
    _run(spark, lambda s: TS.sessions(s, dt.timedelta(hours=4), "10 hours"), src, name, out)
    _file(spark, src, "c", [(900, 200.0, 1, "view")])
    got = _run(spark, lambda s: TS.sessions(s, dt.timedelta(hours=4), "10 hours"), src, name, out)
    _file(spark, os.path.join(scratch, "all"), "x", first + later)
    events = T.media_events_from(spark.read.schema(T.RAW_EVENT_SCHEMA).parquet(os.path.join(scratch, "all", "x")))
    want = E.sessions(events)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.filter(F.col("session_id").startswith("9:")).first()["user_id"] is None  # event 11 has no user


def test_deliveries_and_retention(spark, store, scratch):
    src, name = os.path.join(scratch, "in"), "t04-" + os.path.basename(scratch)
    ttl = dt.timedelta(hours=24)
    jobs = {
        "once": lambda s: TS.first_deliveries(s, ttl, "1 hour").select("event_id", "ts"),
        "kept": lambda s: TS.retained(s, "session_id", ttl, "1 hour"),
    }
    files = [
        [(1, 1.0, 7, "view"), (2, 2.0, 8, "view"), (1, 1.0, 7, "view")],
        [(1, 1.5, 7, "view"), (3, 5.0, 7, "view")],  # id 1 again, in a later batch
        [(4, 40.0, 9, "view")], [(2, 41.0, 9, "view")],  # id 2 after its time to live: a new event
        [(5, 400.0, 9, "view")],
    ]
    for n, rows in enumerate(files):
        _file(spark, src, f"f{n}", rows)
        got = {k: _run(spark, job, src, f"{name}-{k}", os.path.join(scratch, k)) for k, job in jobs.items()}
    hours = lambda r: (r["ts"] - T0).total_seconds() / 3600
    once = sorted((r["event_id"], hours(r)) for r in got["once"].collect())
    assert once == [(1, 1.0), (2, 2.0), (2, 41.0), (3, 5.0), (4, 40.0), (5, 400.0)]
    kept = {(r["session_id"], hours(r), r["expired"]) for r in got["kept"].collect()}
    assert {("7:2024-01-01", 5.0, True), ("8:2024-01-01", 2.0, True), ("9:2024-01-02", 41.0, True)} <= kept
    assert ("7:2024-01-01", 1.5, True) not in kept and not any(h == 400.0 and e for _, h, e in kept)


def test_folded_stream_equals_batch(spark, scratch):
    from cinemetric.operators.partial_states import EventState

    src, check = os.path.join(scratch, "in"), os.path.join(scratch, "check")
    state = EventState(spark, os.path.join(scratch, "state"), target_rows=3)
    rows = [[(i, h, u, t) for i, (h, u, t) in enumerate(part, 20 * n)] for n, part in enumerate([
        [(1.0, 7, "view"), (1.2, 8, "purchase"), (3.0, 7, "click")], [(1.4, 7, "view"), (30.0, 9, "view")], [(2.0, 8, "view"), (31.0, 9, "purchase")],
    ])]
    for n, part in enumerate(rows):
        _file(spark, src, f"f{n}", part)
        stream = T.event_stream(spark, src, file_glob="*.parquet")
        T.folded_states(stream, state, check).trigger(availableNow=True).start().awaitTermination()
        if n == 1:
            state.compact()
    events = T.media_events_from(spark.read.schema(T.RAW_EVENT_SCHEMA).parquet(*[os.path.join(src, f"f{n}") for n in range(3)]))
    as_of = "2024-01-05 00:00:00"
    rows_of = lambda d: sorted(map(tuple, d.select("movie_id", "trending_score", "total_events", "unique_user_count").collect()))
    assert rows_of(state.trending_scores(as_of, 4)) == rows_of(E.trending_scores(events, as_of, 4))
    state.add(1, events.limit(0))  # a batch that the tables hold already
    assert rows_of(state.trending_scores(as_of, 4)) == rows_of(E.trending_scores(events, as_of, 4))
