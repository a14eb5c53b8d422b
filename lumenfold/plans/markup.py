"""Queries over markdown that is written back, nested records and checks of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import markup
from lumenfold.plans.registry import query
from lumenfold.plans.texts import SOURCE, TARGET
from lumenfold.sources.tables import read


@query(f"SELECT doc_id, md5(s) AS unchanged, md5(replace(replace(s, '# Head one', '# KOPF'), '- item b', '- PUNKT')) AS translated FROM (SELECT doc_id, {SOURCE} AS s FROM documents WHERE position('# Head one' IN text) = 0 AND position('- item b' IN text) = 0)")
def markdown_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page with its own units put back, and with a heading and a list item translated."""
    pages = read(spark, sf_dir, "documents").filter("position('# Head one' IN text) = 0 AND position('- item b' IN text) = 0").selectExpr("doc_id", f"{SOURCE} AS text")
    units = pages.select("doc_id", F.explode(markup.spans("text")).alias("u")).select("doc_id", "u.*")
    same = markup.apply_translations(pages, units.select("doc_id", "addr", F.col("text").alias("translation"))).select("doc_id", F.md5("rebuilt").alias("unchanged"))
    new = F.when((F.col("kind") == "heading") & (F.col("text") == "Head one"), "KOPF").when((F.col("kind") == "item") & (F.col("text") == "item b"), "PUNKT")
    other = markup.apply_translations(pages, units.select("doc_id", "addr", new.alias("translation"))).select("doc_id", F.md5("rebuilt").alias("translated"))
    return same.join(other, "doc_id")


@query("SELECT event_id, 'a[0].k' AS path, cast(json_extract(props, '$.k') AS varchar) AS value, '{\"a\": [{\"k\": \"x' || event_type || '\"}, {\"n\": 1}]}' AS changed FROM events")
def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", F.concat(F.lit('{"a": ['), "props", F.lit(', {"n": 1}]}')).alias("r"))
    found = rows.select("event_id", F.explode(markup.nested(F.col("r"), "a.k")).alias("v"), markup.with_nested(F.col("r"), "a[0].k", F.concat(F.lit("x"), "event_type")).alias("changed"))
    return found.select("event_id", "v.path", "v.value", "changed")


@query("SELECT doc_id, '---' || chr(10) || 'lang: ' || lang || chr(10) || 'note: \"a: b\"' || chr(10) || 'size: ' || cast(n_chars AS varchar) || chr(10) || 'steps: |-' || chr(10) || '  - one' || chr(10) || '  - ' || source || chr(10) || '---' || chr(10) AS front FROM documents")
def front_matter_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(F.lit("steps"), F.concat(F.lit("- one\n- "), "source"), F.lit("lang"), F.col("lang"), F.lit("size"), F.col("n_chars").cast("string"), F.lit("note"), F.lit("a: b"))
    return read(spark, sf_dir, "documents").select("doc_id", markup.front_matter_text(fields).alias("front"))


@query(f"WITH p AS (SELECT doc_id, {SOURCE} AS s, {TARGET} AS t FROM documents), n AS (SELECT doc_id, abs(len(string_split(t, chr(10))) - len(string_split(s, chr(10)))) / len(string_split(s, chr(10))) * 100 AS drift, t FROM p) SELECT doc_id, drift > 20 AS far, drift > 10 AND drift <= 20 AS off, regexp_matches(t, '(?s)^---\\n.*?extra: .*?\\n---\\n') AS new_keys FROM n")
def yaml_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{SOURCE} AS s", f"{TARGET} AS t")
    has = lambda found, severity, message: F.exists(found, lambda i: (i["severity"] == severity) & (i["message"] == message))
    structure, fields = markup.yaml_structure(F.col("s"), F.col("t")), markup.yaml_fields(F.col("s"), F.col("t"))
    return pages.select("doc_id", has(structure, "ERROR", "lines drift").alias("far"), has(structure, "WARNING", "lines drift").alias("off"), has(fields, "WARNING", "new keys").alias("new_keys"))


@query("SELECT doc_id, lang <> 'de' AS wrong_folder, source = 'src3' AS step_up FROM documents")
def file_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", F.lit("content"), F.lit("de"), F.when(F.col("source") == "src3", "..").otherwise(F.col("source")), F.concat(F.col("doc_id").cast("string"), F.lit(".md")))
    found = markup.placement(path, F.col("lang"))
    has = lambda message: F.exists(found, lambda i: i["message"] == message)
    return read(spark, sf_dir, "documents").select("doc_id", has("not in the language's folder").alias("wrong_folder"), has("step up").alias("step_up"))
