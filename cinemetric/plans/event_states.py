"""Event aggregates from partial states: old state plus new batches (M-01, E-07, T-02)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.operators.partial_states import EventState
from cinemetric.plans.events import ntz
from cinemetric.session import checkpoint_dir

#: Where the registered queries cut the feed: what is older is compacted, what is newer comes in two batches.
CUTS = ("2024-01-10 00:00:00", "2024-01-20 13:30:00")


def _state(cat) -> EventState:
    state = EventState(cat.spark, f"{checkpoint_dir(cat.spark)}/event-state-{uuid.uuid4().hex}")
    events = cat.media_events
    first, second = (F.col("ts") < ntz(c) for c in CUTS)
    state.add(0, events.filter(first))
    state.compact()
    state.add(1, events.filter(~first & second))
    state.add(1, events.filter(~first & second))  # delivered again
    state.add(2, events.filter(~second))
    return state


def trending_from_states(cat, as_of) -> DataFrame:
    return _state(cat).trending_scores(as_of)


def movie_aggregate_documents(cat, as_of) -> DataFrame:
    """M-01 with its nested maps, as text."""
    text = lambda c: F.coalesce(F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", "), F.lit(""))
    docs = _state(cat).movie_aggregates(as_of)
    return docs.select(
        "movie_id", text("views.hourly").alias("hourly"), text("views.daily").alias("daily"), F.col("views.total").alias("views_total"),
        "engagement.click_rate", "engagement.add_to_cart_rate", "engagement.conversion_rate", "trending_score",
    )


def view_counts_from_states(cat) -> DataFrame:
    """T-02: page views per movie and hour, as the folded stream holds them."""
    hours = _state(cat).read("hours").filter("page_view > 0")
    return hours.select("movie_id", F.date_format("hour", "yyyy-MM-dd HH:00").alias("bucket"), F.col("page_view").alias("views"))
