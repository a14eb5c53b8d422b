"""Structured Streaming forms of the stateful operators; each also takes a batch, so the two can be held against each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def debounce(events: DataFrame, key: str, kind: str, ts: str = "ts", gap: str = "2 seconds", late: str = "10 seconds") -> DataFrame:
    """(key, starts, ends, kind, n): bursts of events of a key that lie less than ``gap`` apart, with the kind of the last event."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    out = rows.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.max_by(kind, ts).alias(kind), F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("starts"), F.col("w.end").alias("ends"), kind, "n")


def deduplicate(events: DataFrame, keys: tuple[str, ...], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first event of each key; a stream forgets keys that are older than ``late``."""
    if events.isStreaming:
        return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.min_by(F.struct(*rest), ts).alias("__r")).select(*keys, "__r.*").select(*events.columns)


def tumbling(events: DataFrame, keys: tuple[str, ...], value: str, size: str, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """(keys…, starts, ends, n, mean) of windows; rows later than the watermark are dropped by a stream."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    out = rows.groupBy(*keys, F.window(ts, size).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return out.select(*keys, F.col("w.start").alias("starts"), F.col("w.end").alias("ends"), "n", "mean")


def progress(events: DataFrame, keys: tuple[str, ...], outcome: str) -> DataFrame:
    """Running totals for output mode update: n, completed, failed."""
    return events.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(outcome) == "completed").alias("completed"), F.count_if(F.col(outcome) == "failed").alias("failed"))


def breaker_step(state: tuple[str, int, list[int], float, float], ok: bool, now: float, failures: int = 5, window: int = 20, least: int = 10, share: float = 0.5, first: float = 60.0, most: float = 600.0) -> tuple[str, int, list[int], float, float]:
    """The next (state, failures in a row, last outcomes, cool-down, opened at) of a circuit breaker.

    CLOSED opens on ``failures`` in a row, or on that share of failures in the last ``window`` if ``least`` were seen. OPEN lets a
    probe through after its cool-down (HALF_OPEN); a probe that fails opens again with twice the cool-down, one that works closes."""
    name, row, seen, cool, since = state
    if name == "OPEN" and now - since >= cool:
        name = "HALF_OPEN"
    if name == "OPEN":
        return name, row, seen, cool, since
    seen = [*seen, int(not ok)][-window:]
    if ok:
        return ("CLOSED", 0, [] if name == "HALF_OPEN" else seen, first if name == "HALF_OPEN" else cool, since)
    row += 1
    if name == "HALF_OPEN":
        return "OPEN", row, seen, min(2 * cool, most), now
    if row >= failures or (len(seen) >= least and sum(seen) >= share * len(seen)):
        return "OPEN", row, seen, cool, now
    return name, row, seen, cool, since


def circuit_breaker(events: DataFrame, key: str, ok: str, ts: str = "ts") -> DataFrame:
    """(key, ts, state) after each event (key, ts, ok), in order of time within a key.

    A stream keeps a breaker for each key; a batch folds each key's log, which is bounded by what one service can have called."""
    kind = dict(events.dtypes)[key]
    schema = f"{key} {kind}, {ts} timestamp, state string"
    rows = events.select(key, F.col(ts).cast("timestamp").alias(ts), ok)

    def fold(state: tuple, part: pd.DataFrame) -> tuple[tuple, list[str]]:
        names = []
        for t, good in zip(part[ts], part[ok], strict=True):
            state = breaker_step(state, bool(good), t.timestamp())
            names.append(state[0])
        return state, names

    start = ("CLOSED", 0, [], 60.0, 0.0)
    if not events.isStreaming:

        def whole(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(ts, kind="stable")
            return part.assign(state=fold(start, part)[1])[[key, ts, "state"]]

        return rows.groupBy(key).applyInPandas(whole, schema)

    def update(_: tuple, parts: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        part = pd.concat(parts).sort_values(ts, kind="stable")
        name, row, seen, cool, since = held.get if held.exists else start
        state, names = fold((name, row, list(seen), cool, since), part)
        held.update(state)
        yield part.assign(state=names)[[key, ts, "state"]]

    return rows.groupBy(key).applyInPandasWithState(update, schema, "name string, row int, seen array<int>, cool double, since double", "append", "NoTimeout")


def apply_once(stream: DataFrame, keys: tuple[str, ...], read: Callable[[], DataFrame], write: Callable[[DataFrame], None], checkpoint: str):
    """Starts a query that writes each key once: of every micro-batch, what the target does not hold yet. A batch that is run again
    after a failure so adds nothing twice."""

    def put(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates(list(keys)).join(read().select(*keys), list(keys), "left_anti")
        write(new)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
