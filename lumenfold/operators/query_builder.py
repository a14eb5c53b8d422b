"""A fluent query over benchmark runs: predicates collect, and one lazy plan comes out.

Conditions on results or on the machine become semi-joins, so runs are never multiplied and then made distinct, and a table that no
condition names is not read."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunQuery:
    """runs: (run_id, model_id, device, ts, …); results: (run_id, throughput, …); system: (run_id, cores, ram_gb, gpu_model)."""

    runs: DataFrame
    results: DataFrame | None = None
    system: DataFrame | None = None
    _where: tuple[Column, ...] = field(default=())
    _results: tuple[Column, ...] = field(default=())
    _system: tuple[Column, ...] = field(default=())
    _order: tuple[Column, ...] = field(default=())
    _limit: int | None = None
    _offset: int = 0

    def where(self, *conditions: Column) -> RunQuery:
        return replace(self, _where=self._where + conditions)

    def by_model(self, model_id: str) -> RunQuery:
        return self.where(F.col("model_id") == model_id)

    def by_device(self, device: str) -> RunQuery:
        return self.where(F.col("device") == device)

    def by_source_lang(self, lang: str) -> RunQuery:
        return self.where(F.col("src_lang") == lang)

    def by_target_lang(self, lang: str) -> RunQuery:
        return self.where(F.col("tgt_lang") == lang)

    def by_language_pair(self, source: str, target: str) -> RunQuery:
        return self.by_source_lang(source).by_target_lang(target)

    def by_corpus_category(self, category: str) -> RunQuery:
        return self.where(F.col("corpus_category") == category)

    def by_tags(self, *tags: str, match_all: bool = True) -> RunQuery:
        """All tags, or any of them."""
        held = [F.array_contains("tags", t) for t in tags]
        if not held:
            return self
        together = held[0]
        for h in held[1:]:
            together = together & h if match_all else together | h
        return self.where(together)

    def by_date_range(self, start=None, end=None) -> RunQuery:
        """Both ends belong to the range."""
        return self.where(*([F.col("ts") >= F.lit(start)] if start is not None else []), *([F.col("ts") <= F.lit(end)] if end is not None else []))

    def by_hardware(self, cpu_cores: int | None = None, ram_gb_min: float | None = None, ram_gb_max: float | None = None, gpu_model: str | None = None) -> RunQuery:
        """The GPU's name contains gpu_model in any case."""
        named = [F.col("cores") == cpu_cores] if cpu_cores is not None else []
        named += [F.col("ram_gb") >= ram_gb_min] if ram_gb_min is not None else []
        named += [F.col("ram_gb") <= ram_gb_max] if ram_gb_max is not None else []
        named += [F.col("gpu_model").ilike(f"%{gpu_model}%")] if gpu_model is not None else []
        return replace(self, _system=self._system + tuple(named))

    def by_throughput_range(self, least: float | None = None, most: float | None = None) -> RunQuery:
        """Runs with a result in the range."""
        named = [F.col("throughput") >= least] if least is not None else []
        named += [F.col("throughput") <= most] if most is not None else []
        return replace(self, _results=self._results + tuple(named))

    def sort_by(self, name: str, ascending: bool = True) -> RunQuery:
        return replace(self, _order=(*self._order, F.col(name).asc() if ascending else F.col(name).desc()))

    def limit(self, n: int) -> RunQuery:
        return replace(self, _limit=n)

    def offset(self, n: int) -> RunQuery:
        return replace(self, _offset=n)

    def build(self) -> DataFrame:
        """The runs; without an order, the newest first, then by id."""
        out = self.runs
        for condition in self._where:
            out = out.filter(condition)
        for table, conditions in ((self.system, self._system), (self.results, self._results)):
            if conditions:
                together = conditions[0]
                for c in conditions[1:]:
                    together = together & c
                out = out.join(table.filter(together).select("run_id"), "run_id", "left_semi")
        if self._order or self._limit is not None or self._offset:
            out = out.orderBy(*(self._order or (F.col("ts").desc(),)), "run_id")
        if self._offset:
            out = out.offset(self._offset)
        return out if self._limit is None else out.limit(self._limit)

    def with_results(self) -> DataFrame:
        """Each run with its machine and the list of its results."""
        lists = self.results.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(*(c for c in self.results.columns if c != "run_id")))).alias("results"))
        out = self.build().join(lists, "run_id", "left")
        return out if self.system is None else out.join(self.system, "run_id", "left")

    def aggregate(self, metric: str, func: str = "avg") -> DataFrame:
        """One row (value): avg, min, max, sum or count of a metric over the results of the runs; nulls do not count, null if none."""
        calls = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": lambda c: F.nullif(F.count(c), F.lit(0))}
        return self.results.join(self.build().select("run_id"), "run_id", "left_semi").agg(calls[func](metric).cast("double").alias("value"))

    def group_by(self, name: str, metric: str) -> DataFrame:
        """(group, mean) of a metric by a field of the runs; 0 for a group without values."""
        return self.build().select("run_id", F.col(name).alias("group")).join(self.results.select("run_id", metric), "run_id", "left").groupBy("group").agg(F.coalesce(F.avg(metric), F.lit(0.0)).alias("mean"))

    def find_best(self, metric: str = "throughput", k: int = 1) -> DataFrame:
        """(run_id, mean): the k best of the newest 10 * k runs by a metric's mean; ties by id."""
        newest = self.limit(10 * k).build().select("run_id")
        means = self.results.join(newest, "run_id").groupBy("run_id").agg(F.avg(metric).alias("mean"))
        return means.orderBy(F.desc_nulls_last("mean"), "run_id").limit(k)

    def find_similar_hardware(self, cores: int, ram_gb: float, gpu_family: str | None = None, tolerance: float = 0.2) -> DataFrame:
        """Runs on machines of as many cores, memory within the tolerance, and a GPU of the family."""
        out = self.by_hardware(cpu_cores=cores, ram_gb_min=ram_gb * (1 - tolerance), ram_gb_max=ram_gb * (1 + tolerance))
        return (replace(out, _system=(*out._system, F.startswith(F.col("gpu_model"), F.lit(gpu_family)))) if gpu_family else out).build()


def list_runs(runs: DataFrame, results: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of runs, newest first, with the number of their results."""
    page = runs.orderBy(F.desc("ts"), "run_id").offset(offset).limit(limit)
    return page.join(results.select("run_id", F.lit(1).alias("one")), "run_id", "left").groupBy(*page.columns).agg(F.count("one").alias("n_results"))


def compare_runs(results: DataFrame, run_ids: list, metric: str = "throughput") -> DataFrame:
    """avg, min, max and count of a metric for each of the runs."""
    return results.filter(F.col("run_id").isin(*run_ids)).groupBy("run_id").agg(F.avg(metric).alias("avg"), F.min(metric).alias("min"), F.max(metric).alias("max"), F.count(metric).alias("n"))


def runs_page(runs: DataFrame, results: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A page of runs with aggregates of their results, the total, and whether more follow."""
    page = runs.orderBy(F.desc("ts"), "run_id").offset(offset).limit(limit)
    sums = results.join(page.select("run_id"), "run_id", "left_semi").groupBy("run_id").agg(F.count("*").alias("n_results"), F.avg("throughput").alias("avg_throughput"))
    total = runs.agg(F.count("*").alias("total"))
    return page.join(sums, "run_id", "left").fillna({"n_results": 0}).join(F.broadcast(total)).withColumn("has_more", F.col("total") > offset + limit)
