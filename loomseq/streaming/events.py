"""Streams of events: sessions, windows, de-duplication, joins with tables, and per-key state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, events): runs of a user's events with pauses below gap. The same on tables and streams."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    s = F.session_window("ts", gap)
    return e.groupBy("user_id", s).agg(F.count("*").alias("events")).select("user_id", F.col("session_window.start").alias("start"), "events")


def windows(events: DataFrame, size: str = "1 hour", step: str | None = None, late: str = "1 hour") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size, step) if step else F.window("ts", size)
    return e.groupBy(w, "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "events", "value")


def first_seen(events: DataFrame, key: list[str], late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key) if events.isStreaming else events.dropDuplicates(key)


def with_table(events: DataFrame, table: DataFrame, on: str) -> DataFrame:
    return events.join(table, on, "left")


def running_totals(events: DataFrame) -> DataFrame:
    """(user_id, events, value) after each batch, from state kept by user."""

    def step(key, parts, state: GroupState):
        n, v = state.get if state.exists else (0, 0.0)
        for pdf in parts:
            n, v = n + len(pdf), v + float(pdf["value"].sum())
        state.update((n, v))
        yield pd.DataFrame({"user_id": [key[0]], "events": [n], "value": [v]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, events long, value double", "events long, value double", "update", GroupStateTimeout.NoTimeout)


def tee(stream: DataFrame, *sinks, **options):
    """Each batch goes to all sinks (functions of a DataFrame), written once each."""

    def each(batch: DataFrame, _):
        batch.persist()
        for s in sinks:
            s(batch)
        batch.unpersist()

    return stream.writeStream.foreachBatch(each).options(**options)
