"""Records of runs, queues, caches and models: roll-ups, expiry, histories, scores, slots and merges, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.operators.operations import rate

# -- roll-ups


def issue_metrics(issues: DataFrame, by: tuple[str, ...] = ("validator",)) -> DataFrame:
    """(by…, errors, warnings, affected) of issues (pair_id, validator, severity)."""
    return issues.groupBy(*by).agg(F.count_if(F.col("severity") == "ERROR").alias("errors"), F.count_if(F.col("severity") == "WARNING").alias("warnings"), F.countDistinct("pair_id").alias("affected"))


def ratio_metrics(pairs: DataFrame, ratio: Column) -> DataFrame:
    """One row (n, mean_ratio, max_ratio)."""
    return pairs.agg(F.count("*").alias("n"), F.avg(ratio).alias("mean_ratio"), F.max(ratio).alias("max_ratio"))


def regressed(now: DataFrame, before: DataFrame, key: str, rate_: str, fingerprint: str, tolerance: float = 0.05) -> DataFrame:
    """(key, delta, regressed): the rate fell by more than the tolerance though the fingerprint is the same."""
    old = before.select(key, F.col(rate_).alias("__rate"), F.col(fingerprint).alias("__print"))
    joined = now.join(old, key)
    delta = F.col(rate_) - F.col("__rate")
    return joined.select(key, delta.alias("delta"), ((delta < -tolerance) & F.col(fingerprint).eqNullSafe(F.col("__print"))).alias("regressed"))


def sums_by(rows: DataFrame, by: str, value: str, unknown: str = "unknown") -> DataFrame:
    """(by, n, total): sums by a column whose nulls are one group."""
    return rows.groupBy(F.coalesce(F.col(by), F.lit(unknown)).alias(by)).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def worst(rows: DataFrame, by: tuple[str, ...], status: str, order: tuple[str, ...] = ("PASS", "WARN", "FAIL")) -> DataFrame:
    """The worst status of each group; order goes from the best to the worst."""
    ranks = F.array(*map(F.lit, order))
    return rows.groupBy(*by).agg(F.element_at(ranks, F.max(F.array_position(ranks, F.col(status))).cast("int")).alias(status))


def progress(tasks: DataFrame, by: tuple[str, ...], status: str, seconds: str) -> DataFrame:
    """(by…, completed, failed, pending, rate, eta_seconds): eta is the mean time of completed tasks for each pending one."""
    done = F.col(status) == "COMPLETED"
    out = tasks.groupBy(*by).agg(F.count_if(done).alias("completed"), F.count_if(F.col(status) == "FAILED").alias("failed"), F.count_if(F.col(status) == "PENDING").alias("pending"), F.avg(F.when(done, F.col(seconds))).alias("__mean"), F.count("*").alias("__n"))
    return out.withColumn("rate", rate(F.col("completed"), F.col("__n"))).withColumn("eta_seconds", F.col("__mean") * F.col("pending")).drop("__mean", "__n")


def failure_shares(samples: DataFrame, pair: tuple[str, str], failed: Column) -> DataFrame:
    """(pair…, samples, failures, share) of pairs, whichever way round they are named."""
    a, b = (F.col(c) for c in pair)
    out = samples.groupBy(F.least(a, b).alias(pair[0]), F.greatest(a, b).alias(pair[1])).agg(F.count("*").alias("samples"), F.count_if(failed).alias("failures"))
    return out.withColumn("share", rate(F.col("failures"), F.col("samples")))


def distinct_sizes(rows: DataFrame, *columns: str) -> DataFrame:
    """One row with the number of distinct values of each column."""
    return rows.agg(*(F.countDistinct(c).alias(f"distinct_{c}") for c in columns))


# -- expiry and histories


def expired(rows: DataFrame, ts: str, now, seconds: int, states: tuple[str, ...] = (), state: str = "status") -> DataFrame:
    """Rows older than that, of the given states only if any are given."""
    old = F.col(ts) < F.lit(now) - F.expr(f"INTERVAL {seconds} SECONDS")
    return rows.filter(old & F.col(state).isin(*states) if states else old)


def live(rows: DataFrame, ts: str, now, seconds: int, states: tuple[str, ...] = (), state: str = "status") -> DataFrame:
    """What ``expired`` leaves; rows of null times stay."""
    old = F.col(ts) < F.lit(now) - F.expr(f"INTERVAL {seconds} SECONDS")
    return rows.filter(~F.coalesce(old & F.col(state).isin(*states) if states else old, F.lit(False)))


def stale_runs(starts: DataFrame, ends: DataFrame, key: str, ts: str, now, hours: int = 1) -> DataFrame:
    """Runs that began hours ago and never ended, closed with a timeout."""
    return expired(starts, ts, now, hours * 3600).join(ends.select(key), key, "left_anti").withColumn("status", F.lit("timeout"))


def newest(rows: DataFrame, order: str, key: str, n: int) -> DataFrame:
    """The last n rows, a report."""
    return rows.orderBy(F.desc(order), F.desc(key)).limit(n)


def kept_by_lru(entries: DataFrame, key: str, used: str, size: int) -> DataFrame:
    """(key, kept): the entries that a cache of a size holds, those used last."""
    last = entries.groupBy(key).agg(F.max(used).alias("__used"))
    held = last.orderBy(F.desc("__used"), key).limit(size).select(key, F.lit(True).alias("kept"))
    return last.select(key).join(held, key, "left").fillna(False, ["kept"])


def cache_key(name: str, **parts: Column) -> Column:
    """name:k=v of the parts in order of their names, without nulls."""
    return F.concat_ws(":", F.lit(name), *(F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in sorted(parts.items())))


def without_prefix(entries: DataFrame, key: str, prefix: str) -> DataFrame:
    return entries.filter(~F.col(key).startswith(prefix))


# -- queues, holds, slots


def retranslate_queue(events: DataFrame, key: str, *keep: str) -> DataFrame:
    """(key, keep…, retry_count): one entry for each key, counted up by each further event."""
    return events.groupBy(key).agg(*(F.max(c).alias(c) for c in keep), F.count("*").alias("retry_count"))


def priority_score(priority: Column, seconds: Column) -> Column:
    """The order of a sorted queue: by priority, then time."""
    return priority * 1e10 + seconds


def merged_tiers(*tiers: DataFrame) -> DataFrame:
    """(file, issues): the issues of all tiers (file, issues array) of each file."""
    every = tiers[0]
    for t in tiers[1:]:
        every = every.unionByName(t)
    return every.select("file", F.explode_outer("issues").alias("i")).groupBy("file").agg(F.array_sort(F.collect_set("i")).alias("issues"))


def row_faults(rows: DataFrame, required: tuple[str, ...], enums: dict[str, tuple[str, ...]], forbidden: tuple[str, ...] = ()) -> Column:
    """The faults of a row: missing fields, values outside their lists, columns that must not be there."""
    faults = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", f"missing:{c}") for c in required]
    faults += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), f"value:{c}") for c, v in enums.items()]
    faults += [F.lit(f"forbidden:{c}") for c in forbidden if c in rows.columns]
    return F.array_compact(F.array(*faults))


def models_tried(attempts: DataFrame, keys: tuple[str, ...], model: str = "model_id") -> DataFrame:
    return attempts.select(*keys, model).distinct()


def slots_free(leases: DataFrame, at: str, until: str, now, capacity: int) -> DataFrame:
    """One row (held, free) of leases that are on at a time."""
    on = (F.col(at) <= F.lit(now)) & (F.col(until) > F.lit(now))
    return leases.agg(F.count_if(on).alias("held")).withColumn("free", F.greatest(F.lit(0), F.lit(capacity) - F.col("held")))


def should_launch(trigger: Column, seconds_since: Column, cooldown: int, alive: Column) -> Column:
    """(launch, reason): a trigger that is on, past its cool-down, with no live process."""
    reason = F.when(alive, "running").when(~trigger, "not_triggered").when(F.coalesce(seconds_since, F.lit(cooldown)) < cooldown, "cooling_down").otherwise("ok")
    return F.struct((reason == "ok").alias("launch"), reason.alias("reason"))


def remediations(metrics: DataFrame, rules: tuple[tuple[str, float, int, str], ...], now) -> DataFrame:
    """(name, value, action) of metrics (name, value, last_action) above their rule's threshold and past its cool-down in seconds."""
    table = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(t).alias("most"), F.lit(c).alias("cool"), F.lit(a).alias("action")) for n, t, c, a in rules))
    out = metrics.select("*", F.explode(F.filter(table, lambda r: r["rule"] == F.col("name"))).alias("r"))
    since = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last_action").cast("timestamp"))
    return out.filter((F.col("value") > F.col("r.most")) & F.coalesce(since >= F.col("r.cool"), F.lit(True))).select("name", "value", "r.action")


# -- choice of models and sizes


def model_score(optimal: Column, device: Column, parameters: Column, backend: Column, size_mb: Column, prefer_quality: bool) -> Column:
    """Device 10, parameters by the billion (+5 for quality, -2 else), backend 5 or 3, less the size by the thousand MB."""
    billions = F.coalesce(parameters / 1e9, F.lit(0.0))
    return F.when(optimal == device, 10.0).otherwise(0.0) + billions * (5.0 if prefer_quality else -2.0) + F.when(backend == "ctranslate2", 5.0).when(backend == "huggingface", 3.0).otherwise(0.0) - size_mb / 1000


def preferred(requests: DataFrame, preferences: DataFrame) -> DataFrame:
    """requests (src, tgt) with (model, rule): of the pair, else of the target for any source, else of all. preferences: (src, tgt, model),
    null for any, few rows."""
    p = F.broadcast(preferences)  # a table of settings
    pair = p.filter("src is not null and tgt is not null").select("src", "tgt", F.col("model").alias("__pair"))
    multi = p.filter("src is null and tgt is not null").groupBy("tgt").agg(F.min("model").alias("__multi"))
    every = p.filter("src is null and tgt is null").agg(F.min("model").alias("__all"))
    out = requests.join(F.broadcast(pair), ["src", "tgt"], "left").join(F.broadcast(multi), "tgt", "left").join(F.broadcast(every.withColumn("__one", F.lit(1))), F.lit(1) == F.col("__one"), "left")
    model, rule = F.coalesce("__pair", "__multi", "__all"), F.when(F.col("__pair").isNotNull(), "pair").when(F.col("__multi").isNotNull(), "multilingual").when(F.col("__all").isNotNull(), "global")
    return out.withColumn("model", model).withColumn("rule", rule).drop("__pair", "__multi", "__all", "__one")


def next_batch_size(size: Column, total: Column, ema: Column, streak: Column, least: int = 4, most: int = 50, threshold: float = 0.15, cut: float = 0.75, grow: float = 1.1, before: int = 5) -> Column:
    """Smaller if too many batches fall back, larger after a row of successes, the same with less than three batches."""
    smaller = F.greatest(F.lit(least), F.floor(size * cut).cast("int"))
    larger = F.least(F.lit(most), F.greatest(size + 1, F.ceil(size * grow).cast("int")))
    return F.when(total < 3, size).when((ema > threshold) & (smaller != size), smaller).when((streak >= before) & (size < most), larger).otherwise(size).cast("int")


def halved(size: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(size / 2)).cast("int")


def updated_weight(weight: Column, success: Column, error: Column, pace: float = 0.1) -> Column:
    """Up by a tenth of the pace after a good forecast, down by a fifth after a bad one, between 0.1 and 2."""
    out = F.when(success & (error < 0.2), weight * (1 + 0.1 * pace)).when(error > 0.5, weight * (1 - 0.2 * pace)).otherwise(weight)
    return F.greatest(F.lit(0.1), F.least(F.lit(2.0), out))


def with_defaults(rows: DataFrame, name: str, value: str, defaults: dict[str, float]) -> DataFrame:
    """(name, value) with the defaults of names that are not there. defaults: few."""
    spark = rows.sparkSession
    known = F.broadcast(spark.range(1).select(F.explode(F.create_map(*(F.lit(x) for k, v in defaults.items() for x in (k, v)))).alias(name, "__default")))
    return known.join(rows.select(name, value), name, "left").select(name, F.coalesce(value, "__default").alias(value))


# -- verdicts


def stop_scope(verdict: Column) -> Column:
    """(stop, scope, mark_rows) that follow from a reviewer's verdict."""
    stop = verdict.isin("REJECT_SYSTEMIC", "REJECT_ISOLATED")
    return F.struct(stop.alias("stop"), F.when(verdict == "REJECT_SYSTEMIC", "portfolio").when(stop, "shard").otherwise("none").alias("scope"), (stop | (verdict == "BLOCKED_EXTERNAL")).alias("mark_rows"))


def risk_flags(flags: dict[str, Column]) -> Column:
    """The names of the conditions that hold, each once."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), n) for n, c in flags.items())))


def by_severity(failures: Column, ranks: tuple[str, ...], other: str = "FAIL_OTHER") -> Column:
    """(primary, all): failure classes by rank, unknown ones last, the first of them; ``other`` for none."""
    order = F.array(*map(F.lit, ranks))
    ranked = F.array_sort(F.transform(failures, lambda f: F.struct(F.when(F.array_position(order, f) > 0, F.array_position(order, f)).otherwise(len(ranks) + 1).alias("rank"), f.alias("f"))))
    names = F.transform(ranked, lambda x: x["f"])
    return F.struct(F.coalesce(F.get(names, F.lit(0)), F.lit(other)).alias("primary"), names.alias("all"))


def not_allowed(requested: Column, allowed: Column) -> Column:
    """Requested locales that the profile does not list."""
    return F.array_except(requested, allowed)


def named_anywhere(config: Column, names: tuple[str, ...]) -> Column:
    """Blocked names that occur as a whole value anywhere in a JSON text."""
    return F.array_compact(F.array(*(F.when(config.rlike(r'"' + n.replace(".", r"\.") + r'"\s*(?:[,}\]]|$)'), n) for n in names)))


def forces(mode: Column, matches: Column) -> Column:
    return (mode == "FORCE") & matches


def matches_filters(text: Column, lang: Column, include: str | None, exclude: str | None, langs: tuple[str, ...] = ()) -> Column:
    """The include pattern and the languages, if given, hold, and the exclude pattern does not."""
    out = F.lit(True) if include is None else text.rlike(include)
    out = out if exclude is None else out & ~text.rlike(exclude)
    return out & lang.isin(*langs) if langs else out


def changed_keys(before: Column, after: Column) -> Column:
    """Keys of two maps whose values differ, or that only one has, in order."""
    keys = F.array_union(F.map_keys(before), F.map_keys(after))
    return F.array_sort(F.filter(keys, lambda k: ~F.try_element_at(before, k).eqNullSafe(F.try_element_at(after, k))))


def json_fingerprint(record: Column) -> Column:
    """sha256 of a struct as JSON; its fields in the order of their names are the caller's."""
    return F.sha2(F.to_json(record), 256)


def masked_for_log(text: Column, most: int = 200) -> Column:
    """Runs of letters outside ASCII as a mark, at most so many characters."""
    return F.left(F.regexp_replace(text, r"[^\x00-\x7F]+", "[non-ascii]"), F.lit(most))


def alternation(signals: tuple[str, ...]) -> str:
    """A pattern of literal alternatives, the longest first."""
    import re

    return "|".join(map(re.escape, sorted(set(signals), key=lambda s: (-len(s), s))))


def family_of(path: Column, families: tuple[str, ...]) -> Column:
    """The first part of a path that is a known family."""
    return F.get(F.filter(F.split(F.lower(path), "/"), lambda p: p.isin(*(f.lower() for f in families))), F.lit(0))


def mapped_language(code: Column, table: dict[str, str]) -> Column:
    """A model family's code of a language; itself if it is not listed."""
    known = F.create_map(*(F.lit(x) for k, v in table.items() for x in (k, v)))
    return F.coalesce(F.try_element_at(known, code), code)


def recent_slots(rows: DataFrame, by: tuple[str, ...], order: str, n: int) -> DataFrame:
    """The last n rows of each group by a partial top-n: no group is gathered in one task before it is reduced."""
    rest = [c for c in rows.columns if c not in by]
    bucket = F.pmod(F.xxhash64(*rest), F.lit(64))
    first = rows.withColumn("__b", bucket).withColumn("__rn", F.row_number().over(W.partitionBy(*by, "__b").orderBy(F.desc(order)))).filter(F.col("__rn") <= n).drop("__rn", "__b")
    return first.withColumn("__rn", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(order)))).filter(F.col("__rn") <= n).drop("__rn")
