"""Structured Streaming forms of the series operators. Event time is naive; watermarks need a TIMESTAMP, so it is cast (session time zone UTC)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", delay)


def resample(df: DataFrame, keys: list[str], ts: str, value: str, width: str = "1 minute", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Means per tumbling or sliding window; state is dropped once the watermark has passed a window."""
    w = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    x = event_time(df, ts, delay).groupBy(*keys, w).agg(F.avg(value).alias(value), F.count("*").alias("n"))
    return x.select(*keys, F.col("window.start").cast("timestamp_ntz").alias("start"), value, "n")


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str = "2 hours", delay: str = "10 minutes") -> DataFrame:
    x = event_time(df, ts, delay).groupBy(*keys, F.session_window("event_time", gap)).agg(F.count("*").alias("n"))
    return x.select(*keys, F.col("session_window.start").cast("timestamp_ntz").alias("start"), F.col("session_window.end").cast("timestamp_ntz").alias("end"), "n")


def dedupe(df: DataFrame, keys: list[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    return event_time(df, ts, delay).dropDuplicatesWithinWatermark(keys)


def adaptive_sampling(df: DataFrame, key: str, order: str, sec: str, corr: str, threshold: float = 0.9, burst_sec: float = 10.0) -> DataFrame:
    """The NORMAL/BURST machine of `operators.states` over a stream. Rows of a recording must arrive in order between batches; inside one they are sorted. `adaptive_sampling_late` takes rows in any order."""
    kind = df.schema[key].dataType.simpleString(), df.schema[order].dataType.simpleString()

    def run(k, batches, state):
        mode, begun = state.get if state.exists else ("NORMAL", 0.0)
        rows = []
        for r in pd.concat(list(batches)).sort_values(order).itertuples(index=False):
            was, t = mode, float(getattr(r, sec))
            if mode == "NORMAL" and getattr(r, corr) < threshold:
                mode, begun = "BURST", t
            elif mode == "BURST" and t - begun > burst_sec:
                mode = "NORMAL"
            rows.append((k[0], getattr(r, order), was, mode))
        state.update((mode, begun))
        yield pd.DataFrame(rows, columns=[key, order, "mode", "next_mode"])

    return df.groupBy(key).applyInPandasWithState(run, f"{key} {kind[0]}, {order} {kind[1]}, mode string, next_mode string", "mode string, begun double", "append", GroupStateTimeout.NoTimeout)


def adaptive_sampling_late(df: DataFrame, key: str, order: str, ts: str, corr: str, threshold: float = 0.9, burst_sec: float = 10.0, delay: str = "10 minutes", idle_hours: float = 24.0) -> DataFrame:
    """The same machine over rows that come late and out of order: (key, order, mode, next_mode), as the batch gives them in order of time, then of `order` (a whole number).

    A recording's state is its mode and the rows that the watermark has not reached, at most those of `delay`. A timer
    at the earliest of them fires when the watermark passes, and rows go through the machine in order of event time.
    Rows behind the watermark are dropped by Spark. A recording without rows for `idle_hours` of event time loses its
    state and would begin anew in NORMAL.
    """
    kind = df.schema[key].dataType.simpleString(), df.schema[order].dataType.simpleString()
    names = [key, order, "mode", "next_mode"]

    def run(k, batches, state):
        mode, begun, last, held = state.get if state.exists else ("NORMAL", 0.0, 0, "[]")
        pending = json.loads(held)
        if not state.hasTimedOut:
            for pdf in batches:
                low = (pdf["__c"] < threshold).tolist()
                pending += [[int(t), int(i), c] for t, i, c in zip(pdf["__t"].tolist(), pdf[order].tolist(), low)]
        passed = state.getCurrentWatermarkMs() * 1000
        ready = sorted(r for r in pending if r[0] <= passed)
        pending = [r for r in pending if r[0] > passed]
        rows = []
        for t, i, low in ready:
            was, sec = mode, t / 1e6
            if mode == "NORMAL" and low:
                mode, begun = "BURST", sec
            elif mode == "BURST" and sec - begun > burst_sec:
                mode = "NORMAL"
            last = t
            rows.append((k[0], i, was, mode))
        if not pending and state.hasTimedOut and passed - last > idle_hours * 3600e6:
            state.remove()
        else:
            state.update((mode, begun, last, json.dumps(pending)))
            fires = min(r[0] for r in pending) if pending else max(last, passed) + int(idle_hours * 3600e6)
            state.setTimeoutTimestamp(max(fires // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(rows, columns=names)

    rows = event_time(df, ts, delay).select(key, order, "event_time", F.unix_micros("event_time").alias("__t"), F.col(corr).cast("double").alias("__c"))
    return rows.groupBy(key).applyInPandasWithState(run, f"{key} {kind[0]}, {order} {kind[1]}, mode string, next_mode string", "mode string, begun double, last long, held string", "append", GroupStateTimeout.EventTimeTimeout)
