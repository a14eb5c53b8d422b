"""Queries over benchmark runs and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions import stats
from lumenfold.operators import analytics
from lumenfold.operators.query_builder import RunQuery, compare_runs, list_runs, runs_page
from lumenfold.plans.registry import query
from lumenfold.sources.tables import logical, read, system_info, with_tables

START, AS_OF = "2024-01-01 00:00:00", "2024-01-29 00:00:00"
#: The day that orders are seen from.
ORDERS_AS_OF = "1998-01-01"


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles at a fixed number of places, so that sums in another order give the same rows."""
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _builder(spark: SparkSession, sf_dir: str) -> RunQuery:
    return RunQuery(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), system_info(spark, sf_dir))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logical(spark, sf_dir, "metrics").select(F.col("site").alias("model_id"), "ts", F.col("value").alias("throughput"), F.col("value").alias("duration"), F.lit(None).cast("double").alias("memory"))


_COMPARE = "count(*) AS n, round(avg(throughput), 6) AS avg_throughput, round(avg(duration), 6) AS avg_duration, round(avg(memory), 6) AS avg_memory, round(min(throughput), 6) AS min_throughput, round(max(throughput), 6) AS max_throughput"


@query(with_tables(f"SELECT model_id, {_COMPARE} FROM results JOIN runs USING (run_id) WHERE device = 'F' GROUP BY model_id"))
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.comparison(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), "model_id", other={"device": "F"}))


@query(with_tables(f"SELECT device, {_COMPARE} FROM results JOIN runs USING (run_id) WHERE model_id = '1-URGENT' AND device IN ('F', 'O') GROUP BY device"))
def device_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.comparison(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), "device", ["F", "O"], {"model_id": "1-URGENT"}))


@query(with_tables("SELECT p.run_id, p.model_id, p.device, p.ts, count(r.run_id) AS n_results FROM (SELECT * FROM runs ORDER BY ts DESC, run_id LIMIT 50 OFFSET 100) p LEFT JOIN results r USING (run_id) GROUP BY ALL"))
def runs_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = logical(spark, sf_dir, "runs").select("run_id", "model_id", "device", "ts")
    return list_runs(runs, logical(spark, sf_dir, "results"), 50, 100)


@query(with_tables("SELECT p.run_id, count(r.run_id) AS n_results, round(avg(throughput), 6) AS avg_throughput, (SELECT count(*) FROM runs) AS total, (SELECT count(*) FROM runs) > 60 AS has_more FROM (SELECT * FROM runs ORDER BY ts DESC, run_id LIMIT 20 OFFSET 40) p LEFT JOIN results r USING (run_id) GROUP BY p.run_id"))
def runs_dashboard_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = runs_page(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), 20, 40)
    return rounded(page.select("run_id", "n_results", "avg_throughput", "total", "has_more"))


@query(with_tables("SELECT run_id, model_id FROM runs WHERE device = 'O' AND EXISTS (SELECT 1 FROM results WHERE results.run_id = runs.run_id AND throughput BETWEEN 1900 AND 2000)"))
def query_semi_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _builder(spark, sf_dir).by_device("O").by_throughput_range(1900, 2000).build().select("run_id", "model_id")


@query(with_tables("SELECT run_id FROM runs WHERE model_id = '2-HIGH' AND ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1996-12-31' ORDER BY ts, run_id LIMIT 25 OFFSET 5"))
def query_filters_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime

    q = _builder(spark, sf_dir).by_model("2-HIGH").by_date_range(datetime(1996, 1, 1), datetime(1996, 12, 31))
    return q.sort_by("ts").limit(25).offset(5).build().select("run_id")


@query(with_tables("SELECT run_id FROM runs WHERE run_id IN (SELECT run_id FROM system_info WHERE ram_gb >= 9000 AND ram_gb <= 9900 AND upper(gpu_model) LIKE '%1%')"))
def query_hardware_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _builder(spark, sf_dir).by_hardware(ram_gb_min=9000, ram_gb_max=9900, gpu_model="1").build().select("run_id")


@query(with_tables("SELECT run_id, model_id FROM runs WHERE run_id IN (SELECT run_id FROM system_info WHERE cores = 7 AND ram_gb BETWEEN 5000 * 0.8 AND 5000 * 1.2)"))
def query_hardware_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _builder(spark, sf_dir).find_similar_hardware(7, 5000.0).select("run_id", "model_id")


@query(with_tables("SELECT a.v AS avg, s.v AS total, c.v AS n FROM (SELECT round(avg(throughput), 6) v FROM results WHERE run_id IN (SELECT run_id FROM runs WHERE device = 'P')) a, (SELECT round(sum(duration), 6) v FROM results WHERE run_id IN (SELECT run_id FROM runs WHERE device = 'P')) s, (SELECT cast(count(memory) AS double) v FROM results WHERE run_id IN (SELECT run_id FROM runs WHERE device = 'P')) c"))
def query_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _builder(spark, sf_dir).by_device("P")
    one = F.lit(1).alias("one")
    parts = [q.aggregate(m, f).select(one, F.round("value", 6).alias(n)) for m, f, n in (("throughput", "avg", "avg"), ("duration", "sum", "total"), ("memory", "count", "n"))]
    return parts[0].join(parts[1], "one").join(parts[2], "one").drop("one")


@query(with_tables("SELECT model_id AS \"group\", round(coalesce(avg(throughput), 0), 6) AS mean FROM runs LEFT JOIN results USING (run_id) GROUP BY model_id"))
def group_mean_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_builder(spark, sf_dir).group_by("model_id", "throughput"))


@query(with_tables("SELECT run_id, round(avg(throughput), 6) AS mean FROM results WHERE run_id IN (SELECT run_id FROM runs ORDER BY ts DESC, run_id LIMIT 100) GROUP BY run_id ORDER BY avg(throughput) DESC, run_id LIMIT 10"))
def find_best_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_builder(spark, sf_dir).find_best(k=10))


@query(with_tables("SELECT run_id, round(avg(throughput), 6) AS avg, round(min(throughput), 6) AS min, round(max(throughput), 6) AS max, count(throughput) AS n FROM results WHERE run_id IN (1, 2, 3, 32, 33) GROUP BY run_id"))
def compare_runs_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(compare_runs(logical(spark, sf_dir, "results"), [1, 2, 3, 32, 33]))


@query(with_tables("SELECT count(*) AS n_runs, count(DISTINCT model_id) AS n_models, count(DISTINCT device) AS n_devices, round(avg(total_seconds), 6) AS avg_seconds FROM runs"))
def dashboard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(logical(spark, sf_dir, "runs").agg(F.count("*").alias("n_runs"), F.countDistinct("model_id").alias("n_models"), F.countDistinct("device").alias("n_devices"), F.avg("total_seconds").alias("avg_seconds")))


@query(with_tables("SELECT model_id, device, count(DISTINCT run_id) AS n_runs, round(avg(throughput), 6) AS avg_throughput, round(max(throughput), 6) AS best FROM results JOIN runs USING (run_id) GROUP BY ALL"))
def dashboard_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = logical(spark, sf_dir, "results").join(logical(spark, sf_dir, "runs"), "run_id")
    return rounded(joined.groupBy("model_id", "device").agg(F.countDistinct("run_id").alias("n_runs"), F.avg("throughput").alias("avg_throughput"), F.max("throughput").alias("best")))


def _rollup_sql(kind: str) -> str:
    s = analytics.WINDOWS[kind] * 3600
    return with_tables(f"SELECT model_id, '{kind}' AS time_window, TIMESTAMP '{START}' + number * INTERVAL {s} SECOND AS window_start, TIMESTAMP '{START}' + (number + 1) * INTERVAL {s} SECOND AS window_end, count(*) AS sample_count, round(avg(value), 6) AS avg_throughput, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(avg(value), 6) AS avg_duration, cast(NULL AS double) AS avg_memory FROM (SELECT site AS model_id, value, cast(floor((epoch(ts) - epoch(TIMESTAMP '{START}')) / {s}) AS bigint) AS number FROM metrics) GROUP BY model_id, number")


def _rollup(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = analytics.rollup(_points(spark, sf_dir), kind, START, ("model_id",))
        return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))

    run.__name__ = f"rollup_{kind}"
    return query(_rollup_sql(kind))(run)


for _kind in analytics.WINDOWS:
    _rollup(_kind)


@query(with_tables(f"SELECT site AS model_id, count(*) AS sample_count, round(avg(value), 6) AS avg_throughput, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM metrics WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}' GROUP BY site HAVING count(*) >= 10"))
def baseline_min10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.baseline(_points(spark, sf_dir), AS_OF, 7, ("model_id",)))


@query(with_tables("SELECT *, CASE WHEN base_avg > 0 THEN round((current_avg - base_avg) / base_avg * 100, 4) ELSE 0.0 END AS avg_change, CASE WHEN base_p95 > 0 THEN round((current_p95 - base_p95) / base_p95 * 100, 4) ELSE 0.0 END AS p95_change, CASE WHEN base_avg IS NULL THEN 'no_baseline' WHEN current_avg IS NULL THEN 'no_current' ELSE 'ok' END AS status FROM (SELECT site AS model_id, round(avg(value) FILTER (WHERE cast(ts AS date) = DATE '2024-01-05'), 4) AS base_avg, round(quantile_cont(value, 0.95) FILTER (WHERE cast(ts AS date) = DATE '2024-01-05'), 4) AS base_p95, round(avg(value) FILTER (WHERE cast(ts AS date) > DATE '2024-01-21' AND cast(ts AS date) <= DATE '2024-01-28'), 4) AS current_avg, round(quantile_cont(value, 0.95) FILTER (WHERE cast(ts AS date) > DATE '2024-01-21' AND cast(ts AS date) <= DATE '2024-01-28'), 4) AS current_p95 FROM metrics GROUP BY site)"))
def baseline_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.compare_performance(_points(spark, sf_dir), "2024-01-05", "2024-01-28")
    for c in ("base_avg", "base_p95", "current_avg", "current_p95"):
        out = out.withColumn(c, F.round(c, 4))
    change = lambda a, b: F.round(analytics.change_percent(F.col(a), F.col(b)), 4)
    return out.withColumn("avg_change", change("current_avg", "base_avg")).withColumn("p95_change", change("current_p95", "base_p95"))


@query(with_tables(f"SELECT model_id, n, round(mean, 4) AS mean, round(variance, 4) AS variance, round(deviation, 4) AS deviation, min, max, round(median, 4) AS median, round(mean - half, 4) AS ci_low, round(mean + half, 4) AS ci_high, round(deviation / mean, 6) AS cv FROM (SELECT *, CASE WHEN n > 1 THEN {stats.t_critical_sql('(n - 1)')} * s / sqrt(n) ELSE 0 END AS half FROM (SELECT site AS model_id, count(value) AS n, avg(value) AS mean, var_pop(value) AS variance, stddev_pop(value) AS deviation, round(min(value), 4) AS min, round(max(value), 4) AS max, median(value) AS median, stddev_samp(value) AS s FROM metrics GROUP BY site))"))
def stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.summarise(_points(spark, sf_dir), "throughput", ("model_id",))
    return rounded(out, 4).drop("cv").join(out.select("model_id", F.round("cv", 6).alias("cv")), "model_id")


@query(with_tables(f"SELECT run_id, n, round(mean - half, 6) AS ci_low, round(mean + half, 6) AS ci_high FROM (SELECT run_id, count(*) AS n, avg(duration) AS mean, CASE WHEN count(*) > 1 THEN {stats.t_critical_sql('(count(*) - 1)')} * stddev_samp(duration) / sqrt(count(*)) ELSE 0 END AS half FROM results GROUP BY run_id)"))
def stats_ci95(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = stats.confidence_interval(F.col("duration"))
    return rounded(logical(spark, sf_dir, "results").groupBy("run_id").agg(F.count("*").alias("n"), low.alias("ci_low"), high.alias("ci_high")), 6)


@query(f"SELECT na, nb, round(ma, 4) AS ma, round(mb, 4) AS mb, round(t, 4) AS t, round(df, 2) AS df, CASE WHEN abs(t) < {stats.t_critical_sql('df')} THEN 0.10 WHEN abs(t) < 2.576 THEN 0.03 ELSE 0.005 END AS p, round(abs(ma - mb) / sqrt((va + vb) / 2), 6) AS effect FROM (SELECT *, (ma - mb) / sqrt(va / na + vb / nb) AS t, power(va / na + vb / nb, 2) / (power(va / na, 2) / (na - 1) + power(vb / nb, 2) / (nb - 1)) AS df FROM (SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS na, count(*) FILTER (WHERE l_returnflag = 'N') AS nb, avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS ma, avg(l_quantity) FILTER (WHERE l_returnflag = 'N') AS mb, var_samp(l_quantity) FILTER (WHERE l_returnflag = 'A') AS va, var_samp(l_quantity) FILTER (WHERE l_returnflag = 'N') AS vb FROM lineitem))")
def stats_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.welch(read(spark, sf_dir, "lineitem"), F.col("l_returnflag"), "A", "N", "l_quantity")
    return out.select("na", "nb", F.round("ma", 4).alias("ma"), F.round("mb", 4).alias("mb"), F.round("t", 4).alias("t"), F.round("df", 2).alias("df"), "p", F.round("effect", 6).alias("effect"))


@query(with_tables("SELECT event_id, site, value FROM metrics JOIN (SELECT site, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, count(value) AS n FROM metrics GROUP BY site) USING (site) WHERE n >= 4 AND b > a AND (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a))"))
def outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.outliers(logical(spark, sf_dir, "metrics").select("event_id", "site", "value"), "value", ("site",)).select("event_id", "site", "value")


@query(with_tables("SELECT event_id, site, value FROM metrics JOIN (SELECT site, avg(value) AS m, stddev_pop(value) AS s, count(value) AS n FROM metrics GROUP BY site) USING (site) WHERE n >= 3 AND s > 0 AND abs(value - m) > 3 * s"))
def outliers_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.outliers(logical(spark, sf_dir, "metrics").select("event_id", "site", "value"), "value", ("site",), "zscore").select("event_id", "site", "value")


_EDGES = (0.5, 1.0, 5.0, 10.0, 50.0, 100.0, 500.0)


@query(with_tables("SELECT site, le, count(*) FILTER (WHERE value <= le) AS n FROM metrics, (SELECT unnest([0.5, 1.0, 5.0, 10.0, 50.0, 100.0, 500.0, 'infinity'::double]::double[]) AS le) GROUP BY ALL"))
def histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.histogram(logical(spark, sf_dir, "metrics"), "value", _EDGES, ("site",))


@query(with_tables("SELECT user_id, n, round(mean, 6) AS mean, min, max, round(total, 4) AS total, v[cast(floor(n * 0.5) AS int) + 1] AS p50, CASE WHEN n > 20 THEN v[cast(floor(n * 0.95) AS int) + 1] ELSE max END AS p95, CASE WHEN n > 100 THEN v[cast(floor(n * 0.99) AS int) + 1] ELSE max END AS p99 FROM (SELECT user_id, count(value) AS n, avg(value) AS mean, min(value) AS min, max(value) AS max, sum(value) AS total, list_sort(list(value)) AS v FROM metrics GROUP BY user_id)"))
def nearest_rank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.nearest_rank_stats(logical(spark, sf_dir, "metrics"), "value", ("user_id",))
    return out.withColumn("mean", F.round("mean", 6)).withColumn("total", F.round("total", 4))


@query(with_tables("SELECT model_id, round(fast, 6) AS fast, round(slow, 6) AS slow, round(fast / slow, 6) AS ratio FROM (SELECT model_id, avg(throughput) FILTER (WHERE device = 'F') AS fast, avg(throughput) FILTER (WHERE device = 'O') AS slow FROM results JOIN runs USING (run_id) GROUP BY model_id) WHERE fast IS NOT NULL AND slow IS NOT NULL"))
def gpu_cpu_speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.speedup(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), "F", "O"))


@query("SELECT lang, source, count(d.doc_id) AS n FROM (SELECT DISTINCT lang FROM documents) CROSS JOIN (SELECT DISTINCT source FROM documents) LEFT JOIN documents d USING (lang, source) GROUP BY ALL")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.coverage_matrix(read(spark, sf_dir, "documents"), "lang", "source")


@query(with_tables("SELECT batch_size, count(*) AS n, max(memory) AS peak FROM results WHERE NOT failed AND run_id IN (SELECT run_id FROM runs WHERE device = 'F') GROUP BY batch_size HAVING count(*) >= 3 AND max(memory) <= 140000 * 0.8 ORDER BY batch_size DESC LIMIT 1"))
def oom_safe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.safe_batch_size(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), "F", 140000.0)
    return out


@query(with_tables("SELECT model_id, round(score, 4) AS score, least(1.0, score / 10) AS confidence FROM (SELECT *, CASE WHEN peak > 50000 THEN base * 0.5 ELSE base END AS score FROM (SELECT runs.run_id, model_id, peak, tps + CASE WHEN peak > 0 THEN 10000 / peak * 0.8 ELSE 0 END + good * 100 * 0.4 AS base FROM runs JOIN (SELECT run_id, avg(throughput) AS tps, max(memory) AS peak, avg(CASE WHEN failed THEN 0.0 ELSE 1.0 END) AS good FROM results GROUP BY run_id) s ON s.run_id = runs.run_id)) ORDER BY score DESC, run_id DESC LIMIT 1"))
def recommend_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.recommend(logical(spark, sf_dir, "runs"), logical(spark, sf_dir, "results"), 50000.0).withColumn("score", F.round("score", 4))


@query(with_tables(f"SELECT 'runs' AS \"table\", count(*) AS total, count(*) FILTER (WHERE ts < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 365 DAY) AS to_delete, min(ts) AS oldest FROM runs UNION ALL SELECT 'metrics', count(*), count(*) FILTER (WHERE ts < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 730 DAY), min(ts) FROM metrics"))
def retention_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: logical(spark, sf_dir, t).select("ts") for t in ("runs", "metrics")}
    return analytics.retention_status(tables, ORDERS_AS_OF, {"runs": 365, "metrics": 730})


@query(with_tables("SELECT 'runs' AS \"table\", count(*) AS n, min(ts) AS oldest, max(ts) AS newest FROM runs UNION ALL SELECT 'metrics', count(*), min(ts), max(ts) FROM metrics"))
def data_age_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.age_summary({t: logical(spark, sf_dir, t).select("ts") for t in ("runs", "metrics")})


@query(with_tables("SELECT site AS name, count(*) AS n, round(sum(value), 4) AS total, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(avg(CASE WHEN lang < 4 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts DESC, event_id DESC) AS rn FROM metrics) WHERE rn <= 1000 GROUP BY site"))
def query_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = logical(spark, sf_dir, "metrics").selectExpr("site AS name", "ts", "event_id AS id", "value AS ms", "lang < 4 AS hit")
    return analytics.pattern_stats(calls).withColumn("total", F.round("total", 4)).withColumn("mean", F.round("mean", 6)).withColumn("hit_rate", F.round("hit_rate", 6))
