"""Reading and writing stores: runs with their results, exports, archives, corpora of files, and logs of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The stored tables' columns.
SCHEMAS: dict[str, str] = {
    "benchmark_runs": "run_id string, model_id string, device string, batch_sizes array<int>, iterations int, corpus_category string, purpose string, tags array<string>, total_duration_seconds double, timestamp_utc timestamp, metadata map<string,string>, src_lang string, tgt_lang string",
    "system_info": "run_id string, cpu_model string, cpu_cores int, total_ram_gb double, gpu_model string, gpu_vram_gb double",
    "benchmark_results": "run_id string, sample_id string, model_id string, device string, batch_size int, duration_seconds double, tokens_input int, tokens_output int, throughput_tokens_per_sec double, peak_memory_mb double, errors array<string>",
    "tm_entries": "tm_key string, source_text string, translation string, site_id string, src_lang string, tgt_lang string, context string, timestamp timestamp, metadata map<string,string>, field_name string, config_fingerprint string, model_id string",
}
#: Bytes that a row takes in an export, about.
ROW_BYTES = {"csv": 200, "json": 300}


def conform(rows: DataFrame, schema: str) -> DataFrame:
    """rows with exactly the schema's columns: those it lacks are null, those it does not name go."""
    wanted = T._parse_datatype_string(schema)
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields))


def save(rows: DataFrame, path: str, partition: str | None = None) -> None:
    writer = rows.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["benchmark_runs"]).parquet(path)


def as_json(rows: DataFrame, key: str) -> DataFrame:
    """(key, json): each row as one document."""
    return rows.select(key, F.to_json(F.struct(*rows.columns)).alias("json"))


def from_json(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Documents as rows; what cannot be read is dropped, what the schema does not name is ignored, what it lacks is null."""
    return rows.select(F.from_json(column, schema, {"mode": "PERMISSIVE"}).alias("r")).filter("r is not null").select("r.*")


def delete_run(tables: dict[str, DataFrame], run_ids: DataFrame) -> dict[str, DataFrame]:
    """All tables without the runs, children included."""
    return {name: t.join(run_ids.select("run_id"), "run_id", "left_anti") for name, t in tables.items()}


def integrity(runs: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """(problem, n): repeated run ids, and rows without a run, by table."""
    out = runs.groupBy("run_id").count().filter("count > 1").agg(F.lit("duplicate run_id").alias("problem"), F.count("*").alias("n"))
    for name, t in children.items():
        out = out.union(t.join(runs.select("run_id"), "run_id", "left_anti").agg(F.lit(f"{name} without run").alias("problem"), F.count("*").alias("n")))
    return out


def export_filter(rows: DataFrame, runs: DataFrame, start=None, end=None, models: list | None = None, devices: list | None = None, ts: str | None = None) -> DataFrame:
    """Rows of a table for an export: by its own time, or by its runs'."""
    def within(df: DataFrame, column: str) -> DataFrame:
        df = df if start is None else df.filter(F.col(column) >= F.lit(start))
        return df if end is None else df.filter(F.col(column) <= F.lit(end))

    wanted = runs
    if models is not None:
        wanted = wanted.filter(F.col("model_id").isin(*models))
    if devices is not None:
        wanted = wanted.filter(F.col("device").isin(*devices))
    if ts is not None:
        rows = within(rows, ts)
    else:
        wanted = within(wanted, "ts")
    return rows.join(wanted.select("run_id"), "run_id", "left_semi")


def export(rows: DataFrame, path: str, kind: str = "csv", compress: bool = False) -> None:
    """CSV with a header, or lines of JSON, by Spark's own writers."""
    writer = rows.write.mode("overwrite").option("compression", "gzip" if compress else "none")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def export_estimate(rows: DataFrame) -> DataFrame:
    """(n, csv_bytes, json_bytes)."""
    return rows.agg(F.count("*").alias("n")).select("n", *((F.col("n") * b).alias(f"{k}_bytes") for k, b in ROW_BYTES.items()))


def archive(rows: DataFrame, before, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(what is archived, what stays)."""
    old = F.col(ts).cast("timestamp") < F.lit(before).cast("timestamp")
    return rows.filter(old), rows.filter(~old | old.isNull())


def restore(live: DataFrame, archived: DataFrame, key: str) -> DataFrame:
    """Both; rows that are live already stay as they are."""
    return live.unionByName(archived.join(live.select(key), key, "left_anti"))


def rotation(archives: DataFrame, keep: int) -> DataFrame:
    """The archives beyond the newest ``keep``."""
    newest = archives.orderBy(F.desc("created"), F.desc("name")).limit(keep)
    return archives.join(newest.select("name"), "name", "left_anti")


#: Categories by the first part of a path.
CATEGORIES = {"blog": "blog", "products": "products", "kb": "kb", "docs": "documentation", "documentation": "documentation", "reference": "api", "api": "api"}


def category_of(path: Column) -> Column:
    first = F.lower(F.get(F.split(path, "/"), F.lit(0)))
    out = F
    for name, category in CATEGORIES.items():
        out = out.when(first.contains(name), category)
    return out.otherwise("general")


def sample_id(path: Column, category: Column) -> Column:
    return F.concat_ws("_", category, F.substring(F.md5(path), 1, 8))


def markdown_corpus(spark: SparkSession, root: str, categories: list | None = None, tokens: tuple[int, int] | None = None, sample: int | None = None, seed: int = 42) -> DataFrame:
    """(id, path, category, tokens, text) of all .md files under a folder; a sample is the first by md5(path|seed)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", True).load(root)
    base = F.lit(root.rstrip("/").split(":")[-1].lstrip("/"))
    out = files.select(F.regexp_replace("path", r"^file:/*", "").alias("full"), F.decode("content", "UTF-8").alias("text"))
    out = out.withColumn("path", F.substr("full", F.length(base) + 2)).withColumn("category", category_of(F.col("path")))
    out = out.select(sample_id(F.col("path"), F.col("category")).alias("id"), "path", "category", F.floor(F.length("text") / 4).alias("tokens"), "text")
    out = out if categories is None else out.filter(F.col("category").isin(*categories))
    out = out if tokens is None else out.filter(F.col("tokens").between(*tokens))
    return out if sample is None else out.orderBy(F.md5(F.concat("path", F.lit(f"|{seed}"))), "path").limit(sample)


def is_translated_name(name: Column, langs: tuple[str, ...]) -> Column:
    return name.rlike(rf"\.({'|'.join(langs)})\.md$")


def translated_path(path: Column, lang: Column | str, source: str = "en") -> Column:
    """/en/ becomes /xx/ where there is one, else name.md becomes name.xx.md."""
    lang = F.lit(lang) if isinstance(lang, str) else lang
    return F.when(F.contains(path, F.lit(f"/{source}/")), F.replace(path, F.lit(f"/{source}/"), F.concat(F.lit("/"), lang, F.lit("/")))).otherwise(F.regexp_replace(path, F.lit(r"\.md$"), F.concat(F.lit("."), lang, F.lit(".md"))))


def locale_pairs(files: DataFrame, langs: tuple[str, ...], path: str = "path") -> DataFrame:
    """A row for each file and language, with the path of the translation."""
    return files.withColumn("lang", F.explode(F.array(*map(F.lit, langs)))).withColumn("target", translated_path(F.col(path), F.col("lang")))


def needs_translation(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(path, lang) of sources whose target is missing or older. sources: (path, lang, target, mtime); targets: (target, mtime)."""
    old = targets.select("target", F.col("mtime").alias("__t"))
    return sources.join(old, "target", "left").filter(F.col("__t").isNull() | (F.col("mtime") > F.col("__t"))).select("path", "lang")


def parse_log(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Events of JSON lines; malformed ones are skipped."""
    return from_json(lines, column, schema)


def job_summary(events: DataFrame) -> DataFrame:
    """(job_id, n, hits, first, last, model) of events (job_id, ts, source, model)."""
    return events.groupBy("job_id").agg(F.count("*").alias("n"), F.count_if(F.col("source") != "miss").alias("hits"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.max_by("model", "ts").alias("model"))


def tail(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the JSON events that are added to a folder."""
    return spark.readStream.schema(schema).json(path)
