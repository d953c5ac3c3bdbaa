"""Streams with state per key and event-time timers (T-03, T-04, V-03).

* ``sessions``: one state per session id (first event, user, last event, counters).  A timer
  stands ``gap`` behind the last event; when the watermark passes it the session is emitted with its
  user and its state goes.  An event within the gap moves the timer.
* ``first_deliveries``: the first delivery of an event id goes through; its state goes ``ttl`` after the
  event's time, so a key is remembered as long as the events collection would keep it.
* ``retained``: the last row of each key, withdrawn (``expired = true``) once its time to live has passed.

State lives in RocksDB and is checkpointed with the query, so a restarted query goes on with its timers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSIONS = (
    "session_id string, user_id long, started_at timestamp_ntz, ended_at timestamp_ntz, duration_seconds long, "
    "page_views long, events long"
)
_EPOCH = dt.datetime(1970, 1, 1)


def use_state_store(spark: SparkSession) -> None:
    """Timers and several states per key need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _micros(ts: pd.Series) -> pd.Series:
    return (ts - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)


def _when(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=int(micros))


class _Sessions(StatefulProcessor):
    def __init__(self, gap: dt.timedelta):
        self.gap = int(gap.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "first long, event long, user long, last long, views long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.state.get() if self.state.exists() else None
        for part in rows:
            at = _micros(part["ts"])
            order = pd.DataFrame({"at": at, "event": part["event_id"], "user": part["user_id"]}).sort_values(["at", "event"])
            first = order.iloc[0]
            user = None if pd.isna(first["user"]) else int(first["user"])
            new = (int(first["at"]), int(first["event"]), user, int(at.max()), int((part["type"] == "page_view").sum()), len(part))
            if known is not None:
                lead = min(tuple(known)[:3], new[:3], key=lambda x: x[:2])
                new = (*lead, max(known[3], new[3]), known[4] + new[4], known[5] + new[5])
            known = new
        if known is not None:
            self.state.update(known)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(known[3] // 1000 + self.gap)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, _, user, last, views, n = self.state.get()
        self.state.clear()
        yield pd.DataFrame({
            "session_id": [key[0]], "user_id": pd.array([user], dtype="Int64"), "started_at": [_when(first)], "ended_at": [_when(last)],
            "duration_seconds": [(last - first) // 1_000_000], "page_views": [views], "events": [n],
        })

    def close(self) -> None:
        pass


def sessions(events: DataFrame, gap: dt.timedelta = dt.timedelta(hours=24), lateness: str = "1 hour") -> DataFrame:
    """T-03: M-02 rows of sessions that no event has reached for ``gap``."""
    rows = events.filter("session_id IS NOT NULL").withWatermark("event_time", lateness)
    rows = rows.select("session_id", "event_id", "user_id", "type", "ts", "event_time")
    return rows.groupBy("session_id").transformWithStateInPandas(_Sessions(gap), outputStructType=SESSIONS, outputMode="append", timeMode="eventTime")


class _First(StatefulProcessor):
    def __init__(self, ttl: dt.timedelta, columns: list[str]):
        self.ttl, self.columns = int(ttl.total_seconds() * 1000), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = self.state.exists()
        for part in rows:
            if not seen and len(part):
                seen = True
                at = int(_micros(part["ts"]).iloc[0])
                self.state.update((at,))
                self.handle.registerTimer(at // 1000 + self.ttl)
                yield part.iloc[:1][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_deliveries(events: DataFrame, ttl: dt.timedelta = dt.timedelta(days=30), lateness: str = "1 hour") -> DataFrame:
    """T-04: each event id once; rows without an id are no deliveries."""
    rows = events.filter("event_id IS NOT NULL").withWatermark("event_time", lateness)
    columns = [c for c in rows.columns if c != "event_time"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "event_time")
    return rows.groupBy("event_id").transformWithStateInPandas(_First(ttl, columns), outputStructType=schema, outputMode="append", timeMode="eventTime")


class _Retained(StatefulProcessor):
    def __init__(self, ttl: dt.timedelta, key: str):
        self.ttl, self.key = int(ttl.total_seconds() * 1000), key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "at long")

    def _row(self, key, at: int, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]], "ts": [_when(at)], "expired": [expired]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.state.get()[0] if self.state.exists() else None
        last = max([int(_micros(part["ts"]).max()) for part in rows if len(part)] + ([] if old is None else [old]), default=None)
        if last is not None and last != old:
            self.state.update((last,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last // 1000 + self.ttl)
            yield self._row(key, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = self.state.get()[0]
        self.state.clear()
        yield self._row(key, at, True)

    def close(self) -> None:
        pass


def retained(rows: DataFrame, key: str, ttl: dt.timedelta, lateness: str = "1 hour") -> DataFrame:
    """V-03 as a stream: ``key, ts, expired``; a key's last time, and its withdrawal ``ttl`` after it."""
    kind = dict(rows.dtypes)[key]
    given = rows.filter(f"`{key}` IS NOT NULL").withWatermark("event_time", lateness).select(key, "ts", "event_time")
    return given.groupBy(key).transformWithStateInPandas(
        _Retained(ttl, key), outputStructType=f"{key} {kind}, ts timestamp_ntz, expired boolean", outputMode="append", timeMode="eventTime"
    )
