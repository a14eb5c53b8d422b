"""Roll-ups, baselines, comparisons, distributions, tests, outliers, recommendations and retention over benchmark tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.functions import stats

#: Hours of each kind of window.
WINDOWS = {"hourly": 1, "daily": 24, "weekly": 168, "monthly": 720}
#: Days that rows of each table are kept.
RETENTION_DAYS = {"benchmark_results": 90, "benchmark_runs": 365, "benchmark_trends": 730}


def rollup(points: DataFrame, kind: str, start, keys: tuple[str, ...] = ("model_id", "device")) -> DataFrame:
    """Statistics of (keys…, ts, throughput, duration, memory) by windows of one kind, on a grid from ``start``'s hour on.

    Percentiles interpolate linearly. Empty windows have no row; memory may be null."""
    seconds = WINDOWS[kind] * 3600
    grid = F.date_trunc("hour", F.lit(start).cast("timestamp"))
    number = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(grid)) / seconds)
    p = F.percentile("throughput", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    out = points.withColumn("number", number).filter("number >= 0").groupBy(*keys, "number").agg(F.count("*").alias("sample_count"), F.avg("throughput").alias("avg_throughput"), p.alias("p"), F.avg("duration").alias("avg_duration"), F.avg("memory").alias("avg_memory"))
    begin = F.timestamp_seconds(F.unix_timestamp(grid) + F.col("number") * seconds)
    return out.select(*keys, F.lit(kind).alias("time_window"), begin.alias("window_start"), F.timestamp_seconds(F.unix_timestamp(grid) + (F.col("number") + 1) * seconds).alias("window_end"), "sample_count", "avg_throughput", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"), "avg_duration", "avg_memory")


def rollup_all(points: DataFrame, start, keys: tuple[str, ...] = ("model_id", "device")) -> DataFrame:
    """All four kinds."""
    return reduce(DataFrame.unionByName, (rollup(points, kind, start, keys) for kind in WINDOWS))


def baseline(points: DataFrame, as_of, days_back: int = 30, keys: tuple[str, ...] = ("model_id", "device"), least: int = 10) -> DataFrame:
    """avg, p50 and p95 of the days before as_of; groups of fewer rows have none."""
    since = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days_back} DAYS")
    ts = F.col("ts").cast("timestamp")
    rows = points.filter((ts >= since) & (ts <= F.lit(as_of).cast("timestamp")))
    out = rows.groupBy(*keys).agg(F.count("*").alias("sample_count"), F.avg("throughput").alias("avg_throughput"), F.percentile("throughput", F.array(F.lit(0.5), F.lit(0.95))).alias("p"))
    return out.filter(F.col("sample_count") >= least).select(*keys, "sample_count", "avg_throughput", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"))


def change_percent(current: Column, base: Column) -> Column:
    """0 where the base is not positive."""
    return F.when(base > 0, (current - base) / base * 100).otherwise(0.0)


def compare_performance(points: DataFrame, base_date, current_date, keys: tuple[str, ...] = ("model_id",)) -> DataFrame:
    """The day's averages of base_date against those of the seven days up to current_date; status says which side is missing."""
    day = F.to_date("ts")
    base, current = day == F.to_date(F.lit(base_date)), (day > F.date_sub(F.to_date(F.lit(current_date)), 7)) & (day <= F.to_date(F.lit(current_date)))
    part = lambda c: F.when(c, F.col("throughput"))
    out = points.groupBy(*keys).agg(F.avg(part(base)).alias("base_avg"), F.percentile(part(base), 0.95).alias("base_p95"), F.avg(part(current)).alias("current_avg"), F.percentile(part(current), 0.95).alias("current_p95"))
    status = F.when(F.col("base_avg").isNull(), "no_baseline").when(F.col("current_avg").isNull(), "no_current").otherwise("ok")
    return out.withColumn("avg_change", change_percent(F.col("current_avg"), F.col("base_avg"))).withColumn("p95_change", change_percent(F.col("current_p95"), F.col("base_p95"))).withColumn("status", status)


def comparison(runs: DataFrame, results: DataFrame, by: str, values: list | None = None, other: dict | None = None, since=None) -> DataFrame:
    """count, means and range of the results by a field of the runs, for some of its values and other fields fixed."""
    for name, value in (other or {}).items():
        runs = runs.filter(F.col(name) == value)
    if values is not None:
        runs = runs.filter(F.col(by).isin(*values))
    if since is not None:
        runs = runs.filter(F.col("ts") >= F.lit(since))
    joined = results.join(runs.select("run_id", by), "run_id")
    return joined.groupBy(by).agg(F.count("*").alias("n"), F.avg("throughput").alias("avg_throughput"), F.avg("duration").alias("avg_duration"), F.avg("memory").alias("avg_memory"), F.min("throughput").alias("min_throughput"), F.max("throughput").alias("max_throughput"))


def summarise(rows: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean, population variance and deviation, range, median, count, 95 % interval and variation of a value."""
    v = F.col(value)
    low, high = stats.confidence_interval(v)
    return rows.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("variance"), F.stddev_pop(v).alias("deviation"), F.min(v).alias("min"), F.max(v).alias("max"), F.median(v).alias("median"), low.alias("ci_low"), high.alias("ci_high"), stats.variation(v).alias("cv"))


def welch(rows: DataFrame, group: Column, a, b, value: str) -> DataFrame:
    """Welch's test of two groups: one row."""
    x, y = F.when(group == a, F.col(value)), F.when(group == b, F.col(value))
    out = rows.agg(*(f(v).alias(n + s) for s, v in (("a", x), ("b", y)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))))
    ea, eb = F.coalesce("va", F.lit(0.0)) / F.col("na"), F.coalesce("vb", F.lit(0.0)) / F.col("nb")
    flat = ea + eb == 0
    out = out.withColumn("t", F.when(flat, 0.0).otherwise((F.col("ma") - F.col("mb")) / F.sqrt(F.nullif(ea + eb, F.lit(0.0)))))
    df = F.when(flat, (F.col("na") + F.col("nb") - 2).cast("double")).otherwise((ea + eb) ** 2 / F.nullif(ea**2 / (F.col("na") - 1) + eb**2 / (F.col("nb") - 1), F.lit(0.0)))
    out = out.withColumn("df", df).withColumn("p", stats.p_value(F.col("t"), F.col("df")))
    spread = F.sqrt((F.coalesce("va", F.lit(0.0)) + F.coalesce("vb", F.lit(0.0))) / 2)
    return out.withColumn("effect", F.when(spread > 0, F.abs(F.col("ma") - F.col("mb")) / F.nullif(spread, F.lit(0.0))).otherwise(0.0)).withColumn("significant", F.col("p") < 0.05).withColumn("confidence", F.when(F.col("p") < 0.01, "high").when(F.col("p") < 0.05, "medium").otherwise("low"))


def outliers(rows: DataFrame, value: str, keys: tuple[str, ...], method: str = "iqr") -> DataFrame:
    """Rows beyond 1.5 interquartile ranges of the quartiles (from 4 rows on), or 3 population deviations from the mean (from 3 on).

    The bounds are aggregated by key and joined back, so a large group is not gathered in one task."""
    v = F.col(value)
    if method == "iqr":
        bounds = rows.groupBy(*keys).agg(F.count(v).alias("__n"), F.percentile(v, F.array(F.lit(0.25), F.lit(0.75))).alias("__q"))
        span = F.col("__q")[1] - F.col("__q")[0]
        bounds = bounds.filter((F.col("__n") >= 4) & (span > 0)).select(*keys, (F.col("__q")[0] - 1.5 * span).alias("__low"), (F.col("__q")[1] + 1.5 * span).alias("__high"))
    else:
        bounds = rows.groupBy(*keys).agg(F.count(v).alias("__n"), F.avg(v).alias("__m"), F.stddev_pop(v).alias("__s")).filter("__n >= 3 and __s > 0")
        bounds = bounds.select(*keys, (F.col("__m") - 3 * F.col("__s")).alias("__low"), (F.col("__m") + 3 * F.col("__s")).alias("__high"))
    return rows.join(bounds, list(keys)).filter((v < F.col("__low")) | (v > F.col("__high"))).drop("__low", "__high")


def histogram(rows: DataFrame, value: str, edges: tuple[float, ...], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, le, n): how many values are at most each edge, and infinity; one pass."""
    counts = rows.groupBy(*keys).agg(*(F.count_if(F.col(value) <= e).alias(f"__{i}") for i, e in enumerate(edges)), F.count(value).alias("__all"))
    cells = F.array(*(F.struct(F.lit(float(e)).alias("le"), F.col(f"__{i}").alias("n")) for i, e in enumerate(edges)), F.struct(F.lit(float("inf")).alias("le"), F.col("__all").alias("n")))
    return counts.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")


def histogram_stats(rows: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def nearest_rank_stats(rows: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """p50 by nearest rank; p95 only from 21 values on and p99 from 101 on, else the maximum."""
    out = rows.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("total"), F.sort_array(F.collect_list(value)).alias("__v"))
    at = lambda p: F.get("__v", F.floor(F.col("n") * p).cast("int"))
    return out.withColumn("p50", at(0.5)).withColumn("p95", F.when(F.col("n") > 20, at(0.95)).otherwise(F.col("max"))).withColumn("p99", F.when(F.col("n") > 100, at(0.99)).otherwise(F.col("max"))).drop("__v")


def speedup(runs: DataFrame, results: DataFrame, fast: str, slow: str) -> DataFrame:
    """Models that ran on both devices: mean throughput on each, and the ratio."""
    joined = results.join(runs.filter(F.col("device").isin(fast, slow)).select("run_id", "model_id", "device"), "run_id")
    out = joined.groupBy("model_id").agg(F.avg(F.when(F.col("device") == fast, F.col("throughput"))).alias("fast"), F.avg(F.when(F.col("device") == slow, F.col("throughput"))).alias("slow"))
    return out.filter("fast is not null and slow is not null").withColumn("ratio", F.try_divide("fast", "slow"))


def coverage_matrix(rows: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n) of all combinations of the two small dimensions, 0 where there are none."""
    cells = rows.select(row).distinct().join(F.broadcast(rows.agg(F.collect_set(column).alias("__c"))), how="inner").select(row, F.explode("__c").alias(column))
    return cells.join(rows.groupBy(row, column).agg(F.count("*").alias("n")), [row, column], "left").fillna({"n": 0})


def safe_batch_size(runs: DataFrame, results: DataFrame, device: str, limit: float, margin: float = 0.2, least: int = 3) -> DataFrame:
    """(batch_size, n, peak): the largest batch of at least some samples whose peak memory leaves the margin."""
    joined = results.join(runs.filter(F.col("device") == device).select("run_id"), "run_id", "left_semi").filter("not failed")
    out = joined.groupBy("batch_size").agg(F.count("*").alias("n"), F.max("memory").alias("peak")).filter((F.col("n") >= least) & (F.col("peak") <= limit * (1 - margin)))
    return out.orderBy(F.desc("batch_size")).limit(1)


#: Default weights of throughput, memory, compatibility and health.
WEIGHTS = {"throughput": 1.0, "memory": 0.8, "compatibility": 0.6, "health": 0.4}


def recommend(runs: DataFrame, results: DataFrame, memory_limit: float | None = None, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """(model_id, score, confidence) of the model with the best run: weighted throughput, frugality and success."""
    sums = results.groupBy("run_id").agg(F.avg("throughput").alias("tps"), F.max("memory").alias("peak"), F.avg(F.when(F.col("failed"), 0.0).otherwise(1.0)).alias("good"))
    frugal = F.when(F.col("peak") > 0, 10000 / F.col("peak") * weights["memory"]).otherwise(0.0)
    score = F.col("tps") * weights["throughput"] + frugal + F.col("good") * 100 * weights["health"]
    if memory_limit is not None:
        score = F.when(F.col("peak") > memory_limit, score * 0.5).otherwise(score)
    scored = runs.select("run_id", "model_id").join(sums, "run_id").withColumn("score", score)
    best = scored.agg(F.max_by(F.struct("model_id", "score"), F.struct("score", F.col("run_id"))).alias("b")).filter("b is not null").select("b.*")
    return best.withColumn("confidence", F.least(F.lit(1.0), F.col("score") / 10))


def feedback_accuracy(feedback: DataFrame) -> DataFrame:
    """(total, followed, success_rate, mape_throughput, mape_memory) of (followed, success, predicted_x, actual_x) rows, one pass."""
    def mape(name: str) -> Column:
        usable = (F.col("success") == 1) & (F.col(f"actual_{name}") > 0)
        return F.avg(F.when(usable, F.abs(F.col(f"predicted_{name}") - F.col(f"actual_{name}")) / F.col(f"actual_{name}") * 100))

    return feedback.agg(F.count("*").alias("total"), F.count_if(F.col("followed")).alias("followed"), F.avg("success").alias("success_rate"), mape("throughput").alias("mape_throughput"), mape("memory").alias("mape_memory"))


def expired(rows: DataFrame, as_of, days: int, ts: str = "ts") -> DataFrame:
    return rows.filter(F.col(ts).cast("timestamp") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


def retention_status(tables: dict[str, DataFrame], as_of, days: dict[str, int]) -> DataFrame:
    """(table, total, to_delete, oldest) for each table with a ts column."""
    def status(name: str, rows: DataFrame) -> DataFrame:
        old = F.col("ts").cast("timestamp") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days[name]} DAYS")
        return rows.agg(F.count("*").alias("total"), F.count_if(old).alias("to_delete"), F.min("ts").alias("oldest")).select(F.lit(name).alias("table"), "*")

    return reduce(DataFrame.unionByName, (status(n, t) for n, t in tables.items()))


def age_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n, oldest, newest) of tables with a ts column."""
    return reduce(DataFrame.unionByName, (t.agg(F.count("*").alias("n"), F.min("ts").alias("oldest"), F.max("ts").alias("newest")).select(F.lit(n).alias("table"), "*") for n, t in tables.items()))


def pattern_stats(calls: DataFrame, keep: int = 1000) -> DataFrame:
    """Per query name: count, total, min, max, mean and hit rate over its newest calls. calls: (name, ts, id, ms, hit)."""
    newest = calls.withColumn("__rn", F.row_number().over(W.partitionBy("name").orderBy(F.desc("ts"), F.desc("id")))).filter(F.col("__rn") <= keep)
    return newest.groupBy("name").agg(F.count("*").alias("n"), F.sum("ms").alias("total"), F.min("ms").alias("min"), F.max("ms").alias("max"), F.avg("ms").alias("mean"), F.avg(F.col("hit").cast("double")).alias("hit_rate"))
