"""Window operators over run outcomes, verdicts and work cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.functions.text import let


def _last(keys: tuple[str, ...], order: tuple[str, ...], first: int, last: int = 0):
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(first, last)


def newest(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], n: int) -> DataFrame:
    """The newest n rows of each key."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))
    return rows.withColumn("__rn", place).filter(F.col("__rn") <= n).drop("__rn")


def moving_average(rows: DataFrame, value: str, keys: tuple[str, ...], order: tuple[str, ...], n: int = 5) -> DataFrame:
    """moving: the mean of the last n rows, this one included."""
    return rows.withColumn("moving", F.avg(value).over(_last(keys, order, 1 - n)))


def regressions(rows: DataFrame, value: str, keys: tuple[str, ...], order: tuple[str, ...], n: int = 5, drop: float = 0.15) -> DataFrame:
    """Rows that lie at least ``drop`` below the mean of the up to n rows before them: before, drop."""
    out = rows.withColumn("before", F.avg(value).over(_last(keys, order, -n, -1)))
    return out.withColumn("drop", F.col("before") - F.col(value)).filter(F.col("drop") >= drop)


def adaptive_threshold(rows: DataFrame, value: str, keys: tuple[str, ...], order: tuple[str, ...], static: int, low: float = 0.7, high: float = 0.9, n: int = 20, least: int = 5) -> DataFrame:
    """(keys…, threshold) by the mean of the newest n rows: one less below ``low``, one more from ``high`` on, between 1 and 5; the
    static threshold with fewer than ``least`` rows."""
    means = newest(rows, keys, order, n).groupBy(*keys).agg(F.avg(value).alias("__m"), F.count(value).alias("__n"))
    moved = F.when(F.col("__n") < least, static).when(F.col("__m") < low, static - 1).when(F.col("__m") >= high, static + 1).otherwise(static)
    return means.select(*keys, F.when(F.col("__n") < least, F.lit(static)).otherwise(F.greatest(F.lit(1), F.least(F.lit(5), moved))).cast("long").alias("threshold"))


def rolling_rate(rows: DataFrame, bad: Column, keys: tuple[str, ...], order: tuple[str, ...], n: int = 20, flip: float = 0.2) -> DataFrame:
    """rate: the share of bad rows among the last n; flips: a full window whose rate is above ``flip``."""
    w = _last(keys, order, 1 - n)
    return rows.withColumn("rate", F.avg(F.when(bad, 1.0).otherwise(0.0)).over(w)).withColumn("flips", (F.count(F.lit(1)).over(w) == n) & (F.col("rate") > flip))


def trailing_streak(rows: DataFrame, bad: Column, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """(keys…, streak): how many rows follow the last bad one. Two aggregations and no window, so a hot key does not gather."""
    last = F.struct(*order)
    marks = rows.groupBy(*keys).agg(F.max(F.when(bad, last)).alias("__last"))
    joined = rows.join(marks, list(keys))
    return joined.groupBy(*keys).agg(F.count_if(F.col("__last").isNull() | (last > F.col("__last"))).alias("streak"))


def quantile_waves(rows: DataFrame, score: str, key: str, waves: int = 10) -> DataFrame:
    """wave: rank // max(1, n / waves), at most waves - 1; ranks follow (score, key).

    Ranks are made in ranges of the score: rows are counted by range, so that no task holds them all."""
    total = rows.count()
    cuts = max(1, total // 50_000)
    edges = sorted(set(rows.agg(F.percentile_approx(score, [i / cuts for i in range(1, cuts)], 10_000)).first()[0] or ())) if cuts > 1 else []
    part = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(score))) if edges else F.lit(0)
    parts = rows.withColumn("__part", part)
    counts = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    rank = F.row_number().over(W.partitionBy("__part").orderBy(score, key)) - 1 + F.col("__start")
    per = max(1.0, total / waves)
    return parts.join(F.broadcast(starts), "__part").withColumn("wave", F.least(F.lit(waves - 1), F.floor(rank / per)).cast("long")).drop("__part", "__start")


def wave_score(size: Column, tier: Column, missing: Column, hits: Column) -> Column:
    """Each part between 0 and 1; known text counts against."""
    return size + tier / 3 + missing - hits


def shards(cells: DataFrame, done: DataFrame, keys: tuple[str, ...], order: str, size: int = 250) -> DataFrame:
    """(keys…, shard, shard_id, and the cell) of what is not done; a shard's cells are those of all cells, done or not."""
    number = F.floor((F.row_number().over(W.partitionBy(*keys).orderBy(order)) - 1) / size)
    out = cells.withColumn("shard", number).withColumn("shard_id", F.substring(F.sha2(F.concat_ws("|", *keys, F.col("shard").cast("string")), 256), 1, 16))
    return out.join(done.select(order), order, "left_anti")


def round_robin(rows: DataFrame, group: str, order: str) -> DataFrame:
    """round and turn of each row: rounds take one row of each group, groups with more rows first."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("__n"))
    sizes = sizes.select(group, F.row_number().over(W.orderBy(F.desc("__n"), group)).cast("long").alias("turn"))
    return rows.withColumn("round", F.row_number().over(W.partitionBy(group).orderBy(order)).cast("long")).join(F.broadcast(sizes), group)


def adaptive_ema(rows: DataFrame, value: str, keys: tuple[str, ...], order: str, calm: float = 0.3, wild: float = 0.7, limit: float = 0.3, n: int = 10) -> DataFrame:
    """(keys…, ema, alpha): the moving average after a key's last row; its step is ``wild`` when the last n rows (3 at least) vary by
    more than ``limit``, and stays as it was with fewer. An ordered fold within the JVM."""
    sorted_ = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])
    folded = rows.groupBy(*keys).agg(sorted_.alias("__v"))

    def step(s: Column, v: Column) -> Column:
        last = F.when(F.size(s["last"]) >= n, F.concat(F.slice(s["last"], 2, n - 1), F.array(v))).otherwise(F.concat(s["last"], F.array(v)))

        def moved(x: Column) -> Column:
            spread = F.sqrt(F.greatest(x["squares"] / x["n"] - (x["sum"] / x["n"]) ** 2, F.lit(0.0)))
            alpha = F.when(x["n"] < 3, s["alpha"]).when((x["sum"] != 0) & (spread * x["n"] / F.nullif(x["sum"], F.lit(0.0)) > limit), F.lit(wild)).otherwise(F.lit(calm))
            return let(alpha, lambda a: F.struct(F.when(s["ema"].isNull(), v).otherwise(a * v + (1 - a) * s["ema"]).alias("ema"), a.alias("alpha"), x["last"].alias("last")))

        total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, y: a + f(y))
        sums = lambda xs: F.struct(xs.alias("last"), F.size(xs).alias("n"), total(xs, lambda y: y).alias("sum"), total(xs, lambda y: y * y).alias("squares"))
        return let(let(last, sums), moved)

    start = F.struct(F.lit(None).cast("double").alias("ema"), F.lit(calm).alias("alpha"), F.array().cast("array<double>").alias("last"))
    out = folded.withColumn("__s", F.aggregate("__v", start, step))
    return out.select(*keys, F.col("__s.ema").alias("ema"), F.col("__s.alpha").alias("alpha"))


def volatility(rows: DataFrame, value: str, keys: tuple[str, ...], order: tuple[str, ...], n: int = 10, limit: float = 0.3) -> DataFrame:
    """cv of the last n rows, and whether it is above the limit."""
    w = _last(keys, order, 1 - n)
    return rows.withColumn("cv", F.try_divide(F.stddev_pop(value).over(w), F.avg(value).over(w))).withColumn("volatile", F.coalesce(F.col("cv") > limit, F.lit(False)))


def greedy_batches(rows: DataFrame, keys: tuple[str, ...], order: str, cost: str, most_rows: int, most_cost: int) -> DataFrame:
    """batch: rows in order, a new batch where the next row would break either limit; a row above the cost limit is alone."""
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, cost))).alias("__r"))

    def step(s: Column, r: Column) -> Column:
        full = (s["n"] > 0) & ((s["n"] + 1 > most_rows) | (s["cost"] + r[cost] > most_cost))
        batch = s["batch"] + full.cast("int")
        return F.struct(batch.alias("batch"), F.when(full, 1).otherwise(s["n"] + 1).alias("n"), (F.when(full, F.lit(0)).otherwise(s["cost"]) + r[cost]).cast("long").alias("cost"), F.concat(s["out"], F.array(F.struct(r[order].alias(order), batch.cast("long").alias("batch")))).alias("out"))

    kind = dict(rows.dtypes)[order]
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("cost"), F.array().cast(f"array<struct<{order}:{kind},batch:bigint>>").alias("out"))
    return packed.select(*keys, F.explode(F.aggregate("__r", start, step)["out"]).alias("__b")).select(*keys, "__b.*")


def fixed_chunks(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], size: int) -> DataFrame:
    """chunk: size rows each, in order."""
    return rows.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1) / size))


def length_variance(rows: DataFrame, text: str, keys: tuple[str, ...]) -> DataFrame:
    """(keys…, mean, variance, cv, factor) of text lengths; factor 0.6 where they vary by more than a half."""
    n = F.length(text).cast("double")
    out = rows.groupBy(*keys).agg(F.avg(n).alias("mean"), F.var_pop(n).alias("variance"))
    return out.withColumn("cv", F.coalesce(F.try_divide(F.sqrt("variance"), "mean"), F.lit(0.0))).withColumn("factor", F.when(F.col("cv") > 0.5, 0.6).otherwise(1.0))
