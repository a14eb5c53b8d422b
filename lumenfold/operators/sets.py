"""Upserts, latest rows, deduplication, samples, queues with leases, and joins to the newest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The last row of each key by order: a partial aggregate, no window, so a hot key is reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*").select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...], kept: tuple[str, ...] = (), overwrite: bool = True) -> DataFrame:
    """Rows of both tables, one for each key: the new one, but the old one's columns named in ``kept`` (as created_at); or the old one
    where there is one, without overwrite. Each side has a key once."""
    other = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *(F.col(c).alias(f"__new_{c}") for c in other), F.lit(True).alias("__is_new"))
    joined = old.withColumn("__is_old", F.lit(True)).join(renamed, list(keys), "full")

    def pick(c: str) -> Column:
        mine, theirs = F.col(c), F.col(f"__new_{c}")
        if not overwrite or c in kept:
            return F.when(F.col("__is_old"), mine).otherwise(theirs).alias(c)
        return F.when(F.col("__is_new"), theirs).otherwise(mine).alias(c)

    return joined.select(*keys, *(pick(c) for c in other)).select(*old.columns)


def insert_new(seen: DataFrame, new: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The rows of new whose key is not seen, the first of each key."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*").select(*new.columns)
    return first.join(seen.select(*keys), list(keys), "left_anti")


def unresolved(failures: DataFrame, resolved: DataFrame, keys: tuple[str, ...], ts: str = "ts") -> DataFrame:
    """Each key's latest failure, unless it was resolved at that time or later."""
    last = latest(failures, keys, (ts,))
    marks = resolved.groupBy(*keys).agg(F.max(ts).alias("__resolved"))
    return last.join(marks, list(keys), "left").filter(F.col("__resolved").isNull() | (F.col("__resolved") < F.col(ts))).drop("__resolved")


def duplicates(rows: DataFrame, keys: tuple[str, ...], least: int = 2) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def shared_values(rows: DataFrame, value: str, owner: str, least_length: int = 8, least: int = 2) -> DataFrame:
    """(value, owners): values of some length that at least two owners share."""
    out = rows.filter(F.length(value) >= least_length).groupBy(value).agg(F.sort_array(F.collect_set(owner)).alias("owners"))
    return out.filter(F.size("owners") >= least)


def same_rendering(units: DataFrame, source: str, rendered: str, least_length: int = 5) -> DataFrame:
    """Rows whose normalised rendering stands for at least two different sources."""
    key = F.lower(F.trim(F.regexp_replace(rendered, r"\s+", " ")))
    rows = units.withColumn("__k", key).filter(F.length("__k") >= least_length)
    shared = rows.groupBy("__k").agg(F.min(source).alias("__a"), F.max(source).alias("__b")).filter(F.col("__a") != F.col("__b"))
    return rows.join(shared.select("__k"), "__k", "left_semi").drop("__k")


#: Shares that a stratum's rows are dealt out into before the first of each are ranked together.
SHARES = 64


def _first_of_each(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], most: Column) -> DataFrame:
    """rows with __rn, their rank within ``by``, up to ``most``: the first of each share are found first, so that no task ranks a
    whole stratum. order ends with a hash, whose value deals the rows out."""
    dealt = rows.withColumn("__s", F.pmod(F.xxhash64(order[-1]), F.lit(SHARES)))
    near = dealt.withColumn("__rn", F.row_number().over(W.partitionBy(*by, "__s").orderBy(*order))).filter(F.col("__rn") <= most).drop("__rn", "__s")
    return near.withColumn("__rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("__rn") <= most)


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """About n rows: max(1, floor(n * share)) of each stratum, the first by md5(key|seed), which any engine computes alike."""
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("__n"))
    total = F.sum("__n").over(W.partitionBy())
    quotas = sizes.select(stratum, F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("__n") / total)).alias("__quota"))
    ordered = rows.withColumn("__h", F.concat(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), F.col(key).cast("string"))).join(F.broadcast(quotas), stratum)
    return _first_of_each(ordered, (stratum,), ("__h",), F.col("__quota")).drop("__h", "__rn", "__quota").select(*rows.columns)


def interleaved_sample(rows: DataFrame, strata: tuple[str, ...], key: str, n: int, forced: Column | None = None, seed: int = 0) -> DataFrame:
    """n rows, one of each stratum in turn by sha256(seed:key), those that are forced first."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = F.lit(1) if forced is None else F.when(forced, 0).otherwise(1)
    out = _first_of_each(rows.withColumn("__f", first).withColumn("__h", h), strata, ("__f", "__h"), F.lit(n))
    return out.orderBy("__f", "__rn", *strata, "__h").limit(n).drop("__f", "__h", "__rn")


def representativeness(rows: DataFrame, sample: DataFrame, stratum: str) -> DataFrame:
    """One row (score): 0.6 * covered strata + 0.4 * max(0, 1 - variation of the sample's strata sizes)."""
    sizes = sample.groupBy(stratum).agg(F.count("*").alias("__n"))
    cv = sizes.agg(F.count("*").alias("covered"), F.coalesce(F.try_divide(F.stddev_pop("__n"), F.avg("__n")), F.lit(0.0)).alias("cv"), F.lit(1).alias("one"))
    every = rows.agg(F.countDistinct(stratum).alias("strata"), F.lit(1).alias("one"))
    return cv.join(every, "one").select((0.6 * F.coalesce(F.try_divide("covered", "strata"), F.lit(0.0)) + 0.4 * F.greatest(F.lit(0.0), 1 - F.col("cv"))).alias("score"))


def corpus_version(rows: DataFrame, key: str) -> DataFrame:
    """(version): 12 digits of the sha256 of the sorted ids.

    The order of ids in one string needs them in one place: for corpora that fit; ``corpus_fingerprint`` has no such bound."""
    joined = F.array_join(F.sort_array(F.collect_list(F.col(key).cast("string"))), ",")
    return rows.agg(F.substring(F.sha2(joined, 256), 1, 12).alias("version"))


def corpus_fingerprint(rows: DataFrame, key: str) -> DataFrame:
    """(version): like ``corpus_version``, from an order-free sum of id hashes, which is aggregated where the rows lie."""
    return rows.agg(F.hex(F.sum(F.xxhash64(F.col(key).cast("string")).cast("decimal(38,0)")).cast("string").cast("binary")).alias("version"))


def uncertainty(retry: Column, quality: Column, errors: Column) -> Column:
    """0.4 * retry + 0.3 * (1 - quality, 0.5 if unknown) + 0.3 if there are errors, between 0 and 1."""
    u = 0.4 * F.coalesce(retry, F.lit(0)) + 0.3 * (1 - F.coalesce(quality, F.lit(0.5))) + F.when(errors > 0, 0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), u))


def next_tasks(tasks: DataFrame, n: int) -> DataFrame:
    """The first n pending tasks whose dependencies are all completed. tasks: (task_id, status, priority, created, depends_on).

    Dependencies are joined one by one, so the completed ids are never gathered."""
    pending = tasks.filter("status = 'PENDING'")
    done = tasks.filter("status = 'COMPLETED'").select(F.col("task_id").alias("__dep"))
    blocked = pending.select("task_id", F.explode("depends_on").alias("__dep")).join(done, "__dep", "left_anti").select("task_id").distinct()
    return pending.join(blocked, "task_id", "left_anti").orderBy("priority", "created", "task_id").limit(n)


def claimable(queue: DataFrame, now, n: int) -> DataFrame:
    """The n oldest entries that are pending or whose claim has run out. queue: (id, state, created, claim_until)."""
    free = (F.col("state") == "PENDING") | ((F.col("state") == "CLAIMED") & (F.col("claim_until") < F.lit(now)))
    return queue.filter(free).orderBy("created", "id").limit(n)


def claim(queue: DataFrame, owner: str, now, lease_seconds: int, n: int) -> DataFrame:
    """The queue after an owner's claim of the n oldest free entries: owner, lease and one more attempt."""
    taken = claimable(queue, now, n).select("id", F.lit(True).alias("__taken"))
    mine = F.coalesce(F.col("__taken"), F.lit(False))
    until = F.lit(now).cast("timestamp") + F.expr(f"INTERVAL {lease_seconds} SECONDS")
    kind = dict(queue.dtypes)["claim_until"]
    return queue.join(F.broadcast(taken), "id", "left").withColumn("state", F.when(mine, "CLAIMED").otherwise(F.col("state"))).withColumn("owner", F.when(mine, owner).otherwise(F.col("owner"))).withColumn("claim_until", F.when(mine, until.cast(kind)).otherwise(F.col("claim_until"))).withColumn("attempts", F.col("attempts") + mine.cast("int")).drop("__taken")


def settle(queue: DataFrame, done: DataFrame, state: str) -> DataFrame:
    """The queue after owners of claims set a state (APPLIED, PENDING, DEAD): (id, owner) that do not hold the claim change nothing."""
    marks = done.select("id", F.col("owner").alias("__owner"))
    hit = (F.col("state") == "CLAIMED") & (F.col("owner") == F.col("__owner"))
    return queue.join(marks, "id", "left").withColumn("state", F.when(hit, state).otherwise(F.col("state"))).drop("__owner")


def requeue_expired(queue: DataFrame, now) -> DataFrame:
    out = (F.col("state") == "CLAIMED") & (F.col("claim_until") < F.lit(now))
    return queue.withColumn("owner", F.when(out, F.lit(None)).otherwise(F.col("owner"))).withColumn("state", F.when(out, "PENDING").otherwise(F.col("state")))


def active(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], now, until: str = "expires", released: str = "released") -> DataFrame:
    """Each key's latest claim or hold, if it is neither released nor run out."""
    return latest(rows, keys, order).filter(~F.col(released) & (F.col(until).isNull() | (F.col(until) > F.lit(now))))


def missing_receipts(tickets: DataFrame, receipts: DataFrame, keys: tuple[str, ...], ts: str = "ts") -> DataFrame:
    """Tickets' keys whose latest receipt does not pass, or which have none."""
    passing = latest(receipts, keys, (ts,)).filter("passed").select(*keys)
    return tickets.select(*keys).distinct().join(passing, list(keys), "left_anti")
