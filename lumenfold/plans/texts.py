"""Queries over documents, translation memory and source/translation pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators import memory, quality
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.sources.tables import pairs, read, with_tables

NL = "chr(10)"


def _md(parts: list[str]) -> str:
    return " || ".join(parts)


def _case(rest: int, then: str, other: str) -> str:
    return f"CASE WHEN doc_id % 24 = {rest} THEN {then} ELSE {other} END"


def _lines(*parts: str) -> list[str]:
    out = []
    for p in parts:
        out += [p, NL]
    return out


_ID = "cast(doc_id AS varchar(20))"
#: A markdown document of each supplied one, its whole text included, and a translation with one defect for each remainder of its id, the same in both engines.
SOURCE = _md(_lines("'---'", f"'title: \"Title ' || {_ID} || '\"'", "'description: \"About the part with `id` and more words here\"'", "'---'", "'# Head one'", "''", "text", "''", "'- item a'", "'- item b'", "'- item c'", "''", "'```py'", f"'print(' || {_ID} || ')'", "'```'", "''", "'See `code` and {{< note >}} range 18-22.'", "''", "'| a | b |'", "'|---|---|'", "'| 1 | 2 |'", "'| 3 | 4 |'", "''", "'## Part two'", "''", f"'Read [the page](http://h.example/' || {_ID} || ') now.'"))
TARGET = _md(_lines("'---'", f"'title: \"' || {_case(1, chr(39) + 'A title that has become very much longer than it was ' + chr(39), chr(39) + 'Titel ' + chr(39))} || {_ID} || '\"'", _case(2, "'description: \"About the part with `id and more words here\"'", _case(3, "'description: \"' || repeat('very long ', 20) || '\"'", "'description: \"About the part with `id` and more words here\"'")), _case(4, "'extra: \"x\"'", "'---'"), _case(4, "'---'", "''"), "'# Head one'", _case(5, "'# Head' || chr(10) || '# Head' || chr(10) || '# Head' || chr(10) || '# Head' || chr(10)", "''"), _case(6, "repeat(chr(10), 60)", "text"), _case(7, "'I cannot help with that.'", "''"), _case(8, "''", "'- item a' || chr(10) || '- item b' || chr(10) || '- item c'"), "''", _case(9, "''", "'```py'"), f"'print(' || {_ID} || {_case(10, chr(39) + ' )' + chr(39), chr(39) + ')' + chr(39))}", "'```'", "''", f"'Siehe `' || {_case(11, 'chr(1082) || chr(1086) || chr(100)', chr(39) + 'code' + chr(39))} || '` und {{{{< note >}}}} Bereich ' || {_case(12, chr(39) + '1822' + chr(39), chr(39) + '18-22' + chr(39))} || {_case(13, chr(39) + '..' + chr(39), chr(39) + '.' + chr(39))}", _case(14, "'{PLACEHOLDER_3}'", "''"), "'| a | b |'", _case(15, "''", "'|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || '| 3 | 4 |'"), "''", _case(16, "''", "'## Part two'"), _case(17, "'The European Union says.'", "''"), _case(18, "'Lies die Seite.'", f"'Lies [die Seite](http://h.example/' || {_ID} || ').'"), _case(19, "'caf' || chr(195) || chr(169)", "''"), _case(20, "'{{% tip %}}'", "''"), _case(21, "'**bold'", "''")))
TARGET = TARGET.replace("{{{{<", "{{<").replace(">}}}}", ">}}")
DOC_PAIRS = f"pairs_md AS (SELECT doc_id, {SOURCE} AS s, {TARGET} AS t FROM documents)"


def _doc_pairs(spark: SparkSession, sf_dir: str, source: str = SOURCE, target: str = TARGET) -> DataFrame:
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{source} AS s", f"{target} AS t")


def _n(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


_BODY = "regexp_replace({x}, '(?s)^---\\n.*?\\n---\\n', '')"
_HEAD, _FENCE = "(?m)^#{1,6} ", "(?m)^\\s*```"
#: Gates as SQL, for those that RE2 can say.
_GATES = {
    "heading_surplus": f"{_n('t', _HEAD)} > {_n('s', _HEAD)} + 3",
    "heading_deficit": f"{_n('t', '(?m)^## ')} < {_n('s', '(?m)^## ')}",
    "table_rows": f"{_n('s', '(?m)^[|]')} >= 4 AND ({_n('t', '(?m)^[|]')} < 0.5 * {_n('s', '(?m)^[|]')} OR {_n('t', '(?m)^[|]')} > 2 * {_n('s', '(?m)^[|]')})",
    "newline_explosion": "length(s) - length(replace(s, chr(10), '')) >= 10 AND length(t) - length(replace(t, chr(10), '')) > 2.5 * (length(s) - length(replace(s, chr(10), '')))",
    "fence_parity": f"{_n('t', _FENCE)} % 2 = 1 OR {_n('t', _FENCE)} < {_n('s', _FENCE)}",
    "empty_body": f"length(trim({_BODY.format(x='t')})) < 50 AND length(trim({_BODY.format(x='s')})) > 200",
    "shortcode_leak": "regexp_matches(t, '[{][{][<%]') AND NOT regexp_matches(s, '[{][{][<%]')",
    "placeholder_leak": "regexp_matches(t, '[{]?PLACEHOLDER_[0-9]+[}]?')",
    "foreign_policy": "regexp_matches(t, '(?i)\\b(GDPR|European (Union|Parliament|Commission))\\b') AND NOT regexp_matches(s, '(?i)\\b(GDPR|European (Union|Parliament|Commission))\\b')",
    "line_count": "abs(1 - len(string_split(t, chr(10))) / len(string_split(s, chr(10)))) >= 0.4 - 1e-9",
    "list_structure": f"{_n('s', '(?m)^[ ]*(?:[-*+]|[0-9]+[.]) ')} > 0 AND {_n('t', '(?m)^[ ]*(?:[-*+]|[0-9]+[.]) ')} = 0",
    "markdown_syntax": f"{_n('t', '[*][*]')} % 2 = 1 AND {_n('s', '[*][*]')} % 2 = 0",
    "refusal": "regexp_matches(t, '(?i)\\b(I''m sorry, but I|I cannot (assist|help)|As an AI|here is the translation)\\b')",
}


@query(f"WITH {DOC_PAIRS} SELECT doc_id, {', '.join(f'({v}) AS {k}' for k, v in _GATES.items())} FROM pairs_md")
def write_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gates that SQL can say; write_gate_report has all."""
    return _doc_pairs(spark, sf_dir).select("doc_id", *(quality.GATES[g](F.col("s"), F.col("t")).alias(g) for g in _GATES))


@query()
def write_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gates, also those whose patterns look around, which the oracle's engine cannot."""
    return quality.gate_report(_doc_pairs(spark, sf_dir), "s", "t").select("doc_id", "gates")


@query()
def write_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.write_decision(_doc_pairs(spark, sf_dir), "s", "t").select("doc_id", "blocked_by", F.md5("text").alias("text_md5"))


@query()
def validator_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every issue of every validator, and the decision over them."""
    out = quality.validate(_doc_pairs(spark, sf_dir), "s", "t")
    return out.withColumn("decision", quality.decide(F.col("issues"), F.col("doc_id") % 3)).select("doc_id", "decision", F.explode_outer("issues").alias("i")).select("doc_id", "decision", "i.*")


_W = "len(regexp_extract_all({x}, '[A-Za-z0-9_]+'))"


@query(with_tables("SELECT pair_id, length(source) >= 10 AND length(translation) > 3 * length(source) AS chars_error, length(source) >= 10 AND length(translation) > 2 * length(source) AND length(translation) <= 3 * length(source) AS chars_warning FROM pairs"))
def length_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.length_anomaly(F.col("source"), F.col("translation"))
    has = lambda severity: F.exists(found, lambda i: (i["severity"] == severity) & (i["message"] == "characters"))
    return pairs(spark, sf_dir).select("pair_id", has("ERROR").alias("chars_error"), has("WARNING").alias("chars_warning"))


@query(with_tables("SELECT pair_id, CASE WHEN length(trim(source)) >= 100 AND length(trim(translation)) < 0.3 * length(trim(source)) THEN 'ERROR' WHEN length(trim(source)) >= 100 AND length(trim(translation)) > 4.0 * length(trim(source)) THEN 'WARNING' END AS severity FROM pairs"))
def length_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("pair_id", F.get(quality.length_ratio(F.col("source"), F.col("translation")), F.lit(0))["severity"].alias("severity"))


@query(with_tables("SELECT pair_id, CASE WHEN abs(1 - b / a) >= 0.4 - 1e-9 THEN 'FAIL' WHEN abs(1 - b / a) >= 0.2 - 1e-9 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT pair_id, len(string_split(source, chr(10))) AS a, len(string_split(translation, chr(10))) AS b FROM pairs)"))
def line_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.abs(1 - F.size(quality.lines(F.col("translation"))) / F.size(quality.lines(F.col("source"))))
    return pairs(spark, sf_dir).select("pair_id", F.when(r >= 0.4 - 1e-9, "FAIL").when(r >= 0.2 - 1e-9, "WARN").otherwise("PASS").alias("status"))


@query("SELECT doc_id, len(list_filter(l, lambda x: regexp_matches(x, '[؀-ۿЀ-ӿ֐-׿一-鿿]'))) / greatest(1, len(l)) > 0.06 AS mixed FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) >= 15) AS l FROM documents)")
def script_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", (F.size(quality.script_mixing(F.col("text"), "de")) > 0).alias("mixed"))


@query("SELECT doc_id, len(p) > len(list_distinct(p)) AS repeated FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+\\s+'), lambda x: lower(trim(x))), lambda x: length(x) > 5) AS p FROM documents)")
def sentence_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", (F.size(quality.sentence_duplication(F.col("text"))) > 0).alias("repeated"))


_TOKENS = "list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+', ' ', 'g'), ' '), lambda w: w <> '')"


@query(f"WITH w AS (SELECT doc_id, {_TOKENS} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS g FROM w WHERE len(w) >= 3) SELECT doc_id, cast(max(n) AS bigint) AS most FROM (SELECT doc_id, g, count(*) AS n FROM g GROUP BY doc_id, g) GROUP BY doc_id")
def ngram_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = read(spark, sf_dir, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w")).filter("size(w) >= 3")
    return words.select("doc_id", tx.largest_count(tx.ngram_hashes(F.col("w"), 3), True).cast("bigint").alias("most"))


@query(f"WITH w AS (SELECT doc_id, {_TOKENS} AS l, unnest({_TOKENS}) AS w FROM documents) SELECT doc_id, w AS word, n, round(n / total, 6) AS share FROM (SELECT doc_id, w, count(*) AS n, any_value(len(l)) AS total, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, w) AS rn FROM w GROUP BY doc_id, w) WHERE rn <= 5 AND total >= 10 AND n / total > 0.2")
def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words above a fifth of a text of ten words or more, the top five."""
    words = read(spark, sf_dir, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w")).filter("size(w) >= 10").select("doc_id", F.size("w").alias("total"), F.explode("w").alias("word"))
    n = words.groupBy("doc_id", "word", "total").agg(F.count("*").alias("n")).filter("n / total > 0.2")  # four at most
    return n.select("doc_id", "word", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("SELECT doc_id, source || ':' || lang || ':xx:' || md5(trim(regexp_replace(nfc_normalize(text), '[\\s]+', ' ', 'g'))) AS tm_key FROM documents")
def tm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.memory_key(F.col("source"), F.col("lang"), F.lit("xx"), F.col("text")).alias("tm_key"))


_HASH = "md5(trim(regexp_replace({c} || text, '[\\s]+', ' ', 'g')))"


@query("WITH r AS (SELECT doc_id, text, source, lang, CASE WHEN doc_id % 3 = 0 THEN 'title' ELSE '' END AS f, CASE WHEN doc_id % 5 = 0 THEN 'ctx' ELSE '' END AS c FROM documents), e AS (SELECT CASE WHEN doc_id % 2 = 0 AND f <> '' THEN source || ':' || f || ':' || lang || ':xx:' || md5(text) ELSE source || ':' || lang || ':xx:' || md5(text) END AS k, min(doc_id) AS translation FROM r WHERE doc_id % 7 <> 0 GROUP BY 1) SELECT doc_id, tier, source_kind FROM (SELECT doc_id, cast(CASE WHEN f <> '' AND x.k IS NOT NULL THEN 1 WHEN y.k IS NOT NULL THEN 3 ELSE 0 END AS bigint) AS tier, CASE WHEN (f <> '' AND x.k IS NOT NULL) OR y.k IS NOT NULL THEN 'exact' ELSE 'miss' END AS source_kind FROM r LEFT JOIN e x ON x.k = source || ':' || f || ':' || lang || ':xx:' || md5(text) LEFT JOIN e y ON y.k = source || ':' || lang || ':xx:' || md5(text))")
def tm_exact_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id", "md5(text) AS text", "source AS site", "lang AS src", "'xx' AS tgt", "CASE WHEN doc_id % 3 = 0 THEN 'title' ELSE '' END AS field", "CASE WHEN doc_id % 5 = 0 THEN 'ctx' ELSE '' END AS context")
    stored = docs.filter("doc_id % 7 <> 0").withColumn("field", F.when(F.col("doc_id") % 2 == 0, F.col("field")).otherwise("")).withColumn("context", F.lit(""))
    entries = memory.with_key(stored).groupBy("tm_key").agg(F.min("doc_id").cast("string").alias("translation")).withColumn("model_id", F.lit("m"))
    found = memory.exact_lookup(docs.withColumnRenamed("doc_id", "request_id"), entries)
    # without a field its key is the plain one: that tier counts as plain
    tier = F.when((F.col("tier") == 1) & (F.col("field") != ""), 1).when((F.col("tier") == 0) & (F.col("field") != "") & (F.col("context") == ""), 1).when(F.col("tier").isNotNull(), 3).otherwise(0)
    return found.select(F.col("request_id").alias("doc_id"), tier.cast("bigint").alias("tier"), F.col("source").alias("source_kind"))


_SAID = "'A text of the source ' || source || ' written in ' || lang || ' by ' || cast(n_chars % 7 AS varchar(9))"


@query(f"WITH d AS (SELECT DISTINCT {_SAID} AS source, md5(text) AS translation FROM documents), x AS (SELECT source, count(*) AS n, min(translation) AS first FROM d GROUP BY source HAVING count(*) > 1) SELECT x.source, n, first, min(d.translation) AS second, levenshtein(left(first, 200), left(min(d.translation), 200)) AS distance FROM x JOIN d ON d.source = x.source AND d.translation > first GROUP BY x.source, n, first ORDER BY x.source LIMIT 500")
def tm_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = read(spark, sf_dir, "documents").selectExpr(f"{_SAID} AS source", "md5(text) AS translation")
    return memory.inconsistent(entries).select("source", "n", "first", "second", F.col("distance").cast("bigint").alias("distance"))


@query("WITH p AS (SELECT q.vec_id AS query_id, v.vec_id AS entry_id, 1 / (1 + list_distance(q.embedding::double[], v.embedding::double[]) ** 2) AS s FROM embeddings q JOIN embeddings v ON q.label = v.label WHERE q.vec_id % 20 = 0) SELECT query_id, entry_id, round(s, 5) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, entry_id) AS rn FROM p WHERE s >= 0.3) WHERE rn <= 5")
def semantic_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read(spark, sf_dir, "embeddings")
    found = memory.semantic_search(v.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "entry_id"), ("label",), 5, 0.3)
    return found.select("query_id", "entry_id", F.round("similarity", 5).alias("similarity"))


_PARAGRAPHS = "SELECT DISTINCT doc_id, substr(sha256(p), 1, 16) AS h FROM (SELECT doc_id, trim(regexp_replace(unnest(regexp_split_to_array(text, '\\n\\s*\\n')), '\\s+', ' ', 'g')) AS p FROM documents) WHERE length(p) >= 40"


@query(f"WITH p AS ({_PARAGRAPHS}), c AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1) SELECT d.doc_id, round(coalesce(r, 0), 6) AS ratio FROM documents d LEFT JOIN (SELECT doc_id, avg(CASE WHEN h IN (SELECT h FROM c) THEN 1.0 ELSE 0.0 END) AS r FROM p GROUP BY doc_id) x USING (doc_id)")
def paragraph_hit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(memory.shared_paragraphs(read(spark, sf_dir, "documents"), "doc_id", F.col("text")))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE n_chars < 100) AS incomplete, count(*) FILTER (WHERE lang NOT IN ('en', 'de', 'fr')) AS unknown_language, count(*) FILTER (WHERE n_chars >= 100 AND lang IN ('en', 'de', 'fr')) AS healthy, round(count(*) FILTER (WHERE n_chars >= 100 AND lang IN ('en', 'de', 'fr')) * 100.0 / count(*), 6) AS health FROM documents")
def tm_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = read(spark, sf_dir, "documents").selectExpr("CASE WHEN n_chars < 100 THEN '' ELSE text END AS text", "lang AS tgt", "source")
    return rounded(memory.integrity(entries, ("text", "source"), ("en", "de", "fr")))


@query("SELECT doc_id, n_chars // 4 AS est_tokens, round(len(regexp_extract_all(text, '[A-Za-z]')) / len(regexp_extract_all(text, '\\p{L}')), 6) AS ascii_share, 'body:' || substr(sha256(text), 1, 16) || ':' || cast(length(text) AS varchar) AS fingerprint FROM documents WHERE regexp_matches(text, '\\p{L}')")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    share = tx.ratio(F.regexp_count(t, F.lit("[A-Za-z]")), tx.letters(t))
    return read(spark, sf_dir, "documents").filter(t.rlike(r"\p{L}")).select("doc_id", tx.estimated_tokens(t).alias("est_tokens"), F.round(share, 6).alias("ascii_share"), tx.unit_fingerprint(F.lit("body"), t).alias("fingerprint"))


@query("SELECT page_id, a.anchor, a.url FROM (SELECT page_id, unnest(list_zip(regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1), regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1))) AS z FROM pages), LATERAL (SELECT z[2] AS anchor, z[1] AS url) a")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (r'<a href="([^"]*)">[^<]*</a>', r'<a href="[^"]*">([^<]*)</a>')]
    zipped = F.arrays_zip(parts[1].alias("anchor"), parts[0].alias("url"))
    return read(spark, sf_dir, "pages").select("page_id", F.explode(zipped).alias("l")).select("page_id", "l.*")
