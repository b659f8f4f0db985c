"""Structured Streaming forms of the incremental behaviour: deduplication, change detection, windows, idempotent sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import times, urls


def first_sightings(stream: DataFrame, key: str, ts: str, keep: str = "30 days") -> DataFrame:
    """The first row of each key within the watermark's span; keys are forgotten after it."""
    return stream.withWatermark(ts, keep).dropDuplicatesWithinWatermark([key])


def daily_sightings(stream: DataFrame, url: str, ts: str, late: str = "1 day") -> DataFrame:
    """The first row of each URL and day."""
    keyed = stream.withColumn("dedup_key", urls.dedup_key(F.col(url), times.day_bucket(F.col(ts)))).withWatermark(ts, late)
    return keyed.dropDuplicatesWithinWatermark(["dedup_key"])


def week_counts(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Counts in ISO weeks, which begin on Monday."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "7 days", "7 days", "4 days"), *keys).agg(F.count(F.lit(1)).alias("n"))


def sliding_rate(stream: DataFrame, ts: str, key: str, window: str = "60 seconds", slide: str = "1 second", late: str = "1 minute") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window, slide), key).agg(F.count(F.lit(1)).alias("n"))


def dated(stream: DataFrame, ts: str, arrival: Column) -> DataFrame:
    """Rows without a time take their arrival's, so that a watermark does not drop them."""
    return stream.withColumn(ts, F.coalesce(ts, arrival))


_CHANGE_OUT = "key string, hash string, previous_hash string, first_seen timestamp, last_seen timestamp, status string"


def changes(stream: DataFrame, key: Column, value_hash: Column, ts: str, keep_ms: int | None = 30 * 86_400_000) -> DataFrame:
    """Each sighting with its key's previous hash: new, seen_again or changed. State goes keep_ms after the last sighting.

    Without keep_ms it stays, for replays of bounded data: a time-out keeps an available-now run going.
    """

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = state.exists
        last, first = state.get if known else (None, None)
        # Arrow cuts a key's rows into frames that are in no order: all are sorted together, as times and small numbers of hashes
        numbers: dict = {}
        times_, held = [], []
        for frame in frames:
            times_.append(frame["ts"].to_numpy())
            held.append(np.fromiter((numbers.setdefault(None if pd.isna(h) else h, len(numbers)) for h in frame["hash"]), np.int64, len(frame)))
        texts = [*sorted(h for h in numbers if h is not None), None]  # no hash comes last
        rank = {h: n for n, h in enumerate(texts)}
        codes, seen = np.array([rank[h] for h in numbers])[np.concatenate(held)], np.concatenate(times_)
        order = np.lexsort((codes, seen))
        codes, seen = codes[order], seen[order]
        hashes = np.array(texts, object)[codes]
        # an empty text stands for no earlier hash: columns of nulls only make frames of other types
        previous = np.array([*texts[:-1], ""], object)[np.roll(codes, 1)]
        previous[0] = last or ""
        changed = (np.roll(codes, 1) != codes) & (np.roll(codes, 1) < len(texts) - 1) & (codes < len(texts) - 1)
        changed[0] = last is not None and hashes[0] is not None and last != hashes[0]
        status = np.where(changed, "changed", "seen_again").astype(object)
        if not known:
            status[0] = "new"
        if first is None and not np.isnat(seen[0]):
            first = pd.Timestamp(seen[0]).to_pydatetime()
        state.update((hashes[-1], first))
        if keep_ms is not None:
            state.setTimeoutDuration(keep_ms)
        begun = np.datetime64("NaT" if first is None else first, "ns")
        for start in range(0, len(seen), 10_000):
            part = slice(start, start + 10_000)
            yield pd.DataFrame({"key": group[0], "hash": hashes[part], "previous_hash": previous[part], "first_seen": begun, "last_seen": seen[part], "status": status[part]})

    rows = stream.select(key.alias("key"), value_hash.alias("hash"), F.col(ts).cast("timestamp").alias("ts"))
    return rows.groupBy("key").applyInPandasWithState(step, _CHANGE_OUT, "hash string, first_seen timestamp", "append", GroupStateTimeout.NoTimeout if keep_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def failure_streaks(stream: DataFrame, key: str, failed: str, ts: str) -> DataFrame:
    """The number of consecutive failures of each key after each micro-batch."""

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        for frame in frames:
            for bad in frame.sort_values("ts")["failed"]:
                streak = streak + 1 if bad else 0
        state.update((streak,))
        yield pd.DataFrame({"key": [group[0]], "streak": [streak]})

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(failed).alias("failed"), F.col(ts).alias("ts"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, streak long", "streak long", "update", GroupStateTimeout.NoTimeout)


def idempotent_sink(merge: Callable[[DataFrame], None], done: Callable[[int], bool], mark: Callable[[int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges each batch once, whatever is replayed."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not done(batch_id):
            merge(batch)
            mark(batch_id)

    return sink
