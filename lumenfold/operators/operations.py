"""Operations: rates, coverage, schedules, routing, registry scores, determinism, and band joins over machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rate(part: Column, whole: Column) -> Column:
    """0 where there is nothing."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("double")


def hit_rates(events: DataFrame, keys: tuple[str, ...], source: str) -> DataFrame:
    """(keys…, lookups, hits by tier, hit_rate) of lookup events whose source is l1, l2, l3 or miss."""
    tiers = [F.count_if(F.col(source) == t).alias(t) for t in ("l1", "l2", "l3")]
    out = events.groupBy(*keys).agg(F.count("*").alias("lookups"), *tiers)
    return out.withColumn("hit_rate", rate(F.col("l1") + F.col("l2") + F.col("l3"), F.col("lookups")))


def command_stats(calls: DataFrame, command: str, seconds: str, ok: Column) -> DataFrame:
    """(command, n, succeeded, success_rate, total, mean, longest)."""
    out = calls.groupBy(command).agg(F.count("*").alias("n"), F.count_if(ok).alias("succeeded"), F.sum(seconds).alias("total"), F.avg(seconds).alias("mean"), F.max(seconds).alias("longest"))
    return out.withColumn("success_rate", rate(F.col("succeeded"), F.col("n")))


def overall_progress(rows: DataFrame, done: str, total: str) -> DataFrame:
    return rows.agg(F.sum(done).alias("done"), F.sum(total).alias("total")).withColumn("percent", rate(F.col("done") * 100, F.col("total")))


def language_coverage(models: DataFrame, languages: DataFrame) -> DataFrame:
    """One row (covered, missing, percent): wanted languages that some model's pairs reach. models: (model_id, pairs array of 'a-b')."""
    reached = models.select(F.explode("pairs").alias("p")).select(F.element_at(F.split("p", "-"), -1).alias("lang")).distinct().withColumn("here", F.lit(1))
    out = languages.select("lang").distinct().join(reached, "lang", "left").agg(F.count("here").alias("covered"), (F.count("*") - F.count("here")).alias("missing"))
    return out.withColumn("percent", rate(F.col("covered") * 100, F.col("covered") + F.col("missing")))


def gap_advice(missing: Column) -> Column:
    """Many gaps ask for the broadest model family, some for a middle one, few for single pairs."""
    n = F.size(missing)
    return F.when(n > 10, "broad_multilingual").when(n > 5, "multilingual_and_pairs").when(n > 0, "single_pairs").otherwise("none")


def queue_health(queue: DataFrame, now) -> DataFrame:
    """(open, oldest_open_seconds, expired_leases) of (state, created, claim_until)."""
    at = F.unix_timestamp(F.lit(now).cast("timestamp"))
    waiting = F.col("state").isin("PENDING", "CLAIMED")
    return queue.agg(F.count_if(waiting).alias("open"), (at - F.min(F.when(waiting, F.unix_timestamp(F.col("created").cast("timestamp"))))).alias("oldest_open_seconds"), F.count_if((F.col("state") == "CLAIMED") & (F.unix_timestamp(F.col("claim_until").cast("timestamp")) < at)).alias("expired_leases"))


def similar_machines(runs: DataFrame, system: DataFrame, cores: int, ram_gb: float, newest: int = 100, near_cores: int = 2, near_ram: float = 4.0) -> DataFrame:
    """Of the newest runs, those on machines near to the given one."""
    last = runs.orderBy(F.desc("ts"), "run_id").limit(newest)
    return last.join(system, "run_id").filter((F.abs(F.col("cores") - cores) <= near_cores) & (F.abs(F.col("ram_gb") - ram_gb) <= near_ram))


def untried_model(cells: DataFrame, attempts: DataFrame, keys: tuple[str, ...], other: str) -> DataFrame:
    """Cells for which the other model was never tried, with it as retry_with."""
    tried = attempts.filter(F.col("model_id") == other).select(*keys).distinct()
    return cells.select(*keys).distinct().join(tried, list(keys), "left_anti").withColumn("retry_with", F.lit(other))


def pair_outcomes(pairs: DataFrame, first: str, second: str, passed: Column, similarity: Column, least: float = 0.95) -> DataFrame:
    """(outcome, n, share): identical, equivalent (similar enough and both passed) or divergent outputs of the same input."""
    outcome = F.when(F.col(first) == F.col(second), "identical").when((similarity >= least) & passed, "equivalent").otherwise("divergent")
    out = pairs.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    return out.withColumn("share", rate(F.col("n"), F.sum("n").over(W.partitionBy())))  # three rows at most


def route(unit_kind: Column, text: Column, rules: tuple[tuple[str | None, str | None, str], ...], default: str) -> Column:
    """The backend of the first rule (kind, pattern, backend) that matches; None matches all."""
    out = None
    for kind, pattern, backend in rules:
        match = (F.lit(True) if kind is None else unit_kind == kind) & (F.lit(True) if pattern is None else text.rlike(pattern))
        out = F.when(match, backend) if out is None else out.when(match, backend)
    return F.lit(default) if out is None else out.otherwise(default)


def bypasses_lookup(mode: Column, matches: Column) -> Column:
    """BYPASS and REFRESH skip the memory where their filter matches; NORMAL and VALIDATE never do."""
    return mode.isin("BYPASS", "REFRESH") & matches


def updates_cache(mode: Column, matches: Column) -> Column:
    """Only BYPASS leaves the memory as it is."""
    return ~((mode == "BYPASS") & matches)


def source_changed(mtime: Column, old_mtime: Column, digest: Column, old_digest: Column) -> Column:
    """Equal times mean no change; else the digests decide. An unknown old digest is a change."""
    return F.when(mtime == old_mtime, False).otherwise(F.coalesce(digest != old_digest, F.lit(True)))


def within_window(minute: Column, start: int, end: int) -> Column:
    """Minutes of the day; a window may go over midnight."""
    return (minute >= start) & (minute < end) if start <= end else (minute >= start) | (minute < end)


def run_times(day: Column, start: int, end: int, n: int) -> Column:
    """n equally spaced times of a day's window, in minutes of the day."""
    span = (end - start) % 1440
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.timestamp_seconds(F.unix_timestamp(day.cast("timestamp")) + (start + F.floor(i * span / n)) * 60))


def retry_delay(attempt: Column, jitter: Column, table: tuple[float, ...] = (2.0, 4.0, 8.0), spread: float = 0.2) -> Column:
    """Seconds before the next attempt; the last entry repeats; jitter from 0 to 1 moves it by up to a fifth."""
    base = F.element_at(F.array(*map(F.lit, table)), F.least(attempt + 1, F.lit(len(table))).cast("int"))
    return base * (1 - spread + 2 * spread * jitter)


def memory_estimate(size: Column, batch: Column) -> Column:
    """MB that a model of a size class needs for a batch."""
    base = F.when(size == "small", 500).when(size == "medium", 1500).when(size == "large", 5000).otherwise(10_000)
    return base * (1 + 0.3 * (batch - 1))


def stop_action(failures_in_a_row: Column, running: Column, interrupted: Column, most: int = 3) -> Column:
    return F.when(running, "SKIP").when(failures_in_a_row >= most, "CIRCUIT_BREAK").when(interrupted, "RESUME").otherwise("PROCEED")
