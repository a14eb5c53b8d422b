"""Queries over languages: detection, purity, overwriting, and the write gates that know the target's language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import language as lg
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.plans.texts import NL, _lines, _md
from lumenfold.sources.tables import read

_LANGS = list(lg.FUNCTION_WORDS)
_HITS = ", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in lg.FUNCTION_WORDS[k])}))) AS {k}" for k in _LANGS)
_SUM, _MOST = " + ".join(_LANGS), f"greatest({', '.join(_LANGS)})"
#: Of equal counts the last language in order counts, as the larger struct does.
_BEST = "CASE " + " ".join(f"WHEN {k} = {_MOST} THEN '{k}'" for k in sorted(_LANGS, reverse=True)) + " END"
_DETECTED = f"h AS (SELECT doc_id, lang AS own, source, {_HITS} FROM (SELECT doc_id, lang, source, regexp_split_to_array(lower(text), '[^\\p{{L}}]+') AS w FROM documents)), d AS (SELECT doc_id, own, source, CASE WHEN {_SUM} > 0 THEN {_BEST} END AS detected, CASE WHEN {_SUM} > 0 THEN {_MOST} / ({_SUM}) ELSE 0.0 END AS confidence FROM h)"


@query(f"WITH {_DETECTED} SELECT doc_id, detected, round(confidence, 6) AS confidence, detected IS NULL OR (detected = own AND confidence >= 0.5) AS verified FROM d")
def language_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text", lg.detect(F.col("text")).alias("d"))
    return rounded(docs.select("doc_id", F.col("d.lang").alias("detected"), F.col("d.confidence").alias("confidence"), lg.verified(F.col("text"), F.col("lang")).alias("verified")))


@query(f"WITH {_DETECTED} SELECT n.doc_id, CASE WHEN o.doc_id IS NULL THEN CASE WHEN n.good THEN 'ALLOW' ELSE 'BLOCK' END WHEN o.good AND NOT n.good THEN 'BLOCK' WHEN o.good AND n.good AND o.confidence > n.confidence + 0.05 THEN 'BLOCK' WHEN NOT o.good AND NOT n.good THEN 'REQUEUE' ELSE 'ALLOW' END AS decision FROM (SELECT *, coalesce(detected = own, true) AS good FROM d) n LEFT JOIN (SELECT x.doc_id + 1 AS doc_id, x.confidence, coalesce(x.detected = y.own, true) AS good FROM d x JOIN d y ON y.doc_id = x.doc_id + 1) o ON o.doc_id = n.doc_id")
def overwrite_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as the new text over the one before it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    both = docs.join(docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("text").alias("old")), "doc_id", "left")
    return both.select("doc_id", lg.overwrite_decision(F.col("old"), F.col("text"), F.col("lang")).alias("decision"))


@query()
def language_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return rounded(docs.select("doc_id", lg.purity(F.col("text"), F.col("lang")).alias("purity"), lg.paragraph_mismatch(F.col("text"), F.col("lang")).alias("foreign_paragraphs")))


def _at(rest: int, then: str, other: str) -> str:
    return f"CASE WHEN doc_id % 12 = {rest} THEN {then} ELSE {other} END"


_ID = "cast(doc_id AS varchar(20))"
#: A page in English and its translation into a language of another script, with one defect for each remainder of its id.
PAGE = _md(_lines("'---'", "'title: \"Widget Guide | Site\"'", "'description: \"About the widget part and its use\"'", "'keywords: a, b'", "'summary: >'", "'  This text goes over lines and says a good deal'", "'  about the part.'", "'provenance:'", f"'  content_hash: h' || {_ID}", "'---'", "'# Widget Guide here'", "''", "text", "''", "'Use the following lines to begin with it:'", "''", "'```py'", "'run()'", "'```'", "''", "'The part is made for the use of all who work with it.'"))
COPY = _md(_lines("'---'", f"'title: \"' || {_at(1, chr(39) + 'Руководство' + chr(39), chr(39) + 'Руководство | Сайт' + chr(39))} || '\"'", _at(2, "'description: \"About the widget part and its use\"'", "'description: \"О части и её применении\"'"), _at(3, "'keywords: a, b, c, d'", "'keywords: a, b'"), "'summary: >'", _at(4, "'  Текст'", "'  Этот текст идёт через строки и говорит многое'"), _at(5, "'  title: потерян'", "'  о части.'"), "'provenance:'", _at(6, "'  content_hash: old'", f"'  content_hash: h' || {_ID}"), "'---'", _at(7, "'# Widget Guide here'", "'# Руководство здесь'"), "''", "'Текст документа ' || " + _ID + " || ' здесь.'", "''", _at(8, "'К:'", "'Используйте следующие строки для начала:'"), "''", "'```py'", "'run()'", "'```'", "''", _at(9, "repeat('The part is made for the use of all who work with it.' || chr(10), 5)", "'Часть создана для всех, кто с ней работает.'"), _at(10, "'Это widget and the part здесь.'", "''")))
_FRONT = "regexp_extract({x}, '(?s)^---\\n(.*?)\\n---\\n', 1)"
_FIELD = "regexp_replace(regexp_extract({f}, '(?m)^{n}: *(.*)$', 1), '^[\"'']|[\"'']$', '', 'g')"


def _f(x: str, n: str) -> str:
    return _FIELD.format(f=_FRONT.format(x=x), n=n)


_HASH = "regexp_extract({f}, '(?m)^provenance:[ \\t]*\\n(?:[ \\t]+.*\\n)*?[ \\t]+content_hash: *(.*)$', 1)"
_KEYS = "len(list_filter(string_split({k}, ','), lambda x: trim(x) <> ''))"
_SQL_GATES = {
    "description_reverted": f"length(trim({_f('s', 'description')})) >= 20 AND regexp_full_match(trim({_f('t', 'description')}), '[\\x00-\\x7F]+')",
    "stale_hash": " AND ".join((f"{_HASH.format(f=_FRONT.format(x='s'))} <> ''", f"{_HASH.format(f=_FRONT.format(x='t'))} <> ''", f"{_HASH.format(f=_FRONT.format(x='s'))} <> {_HASH.format(f=_FRONT.format(x='t'))}")),
    "seo": f"(regexp_matches({_f('s', 'title')}, '\\s[|–—-]\\s') AND NOT regexp_matches({_f('t', 'title')}, '\\s[|–—-]\\s')) OR ({_KEYS.format(k=_f('t', 'keywords'))} >= {_KEYS.format(k=_f('s', 'keywords'))} + 2 AND {_KEYS.format(k=_f('t', 'keywords'))} >= 1.5 * {_KEYS.format(k=_f('s', 'keywords'))} AND {_KEYS.format(k=_f('s', 'keywords'))} > 0)",
    "key_leak": f"len(list_intersect(list_distinct(regexp_extract_all(regexp_extract({_FRONT.format(x='t')}, '(?m)^summary: >\\n((?:[ \\t]+.*\\n)+)', 1), '(?m)^[ \\t]+([A-Za-z_][A-Za-z0-9_]*):', 1)), ['title', 'description', 'keywords', 'summary', 'provenance'])) > 0",
    "multiline_scalar": f"(length(trim(regexp_replace(regexp_extract({_FRONT.format(x='t')}, '(?m)^summary: >\\n((?:[ \\t]+.*\\n)+)', 1), '\\s+', ' ', 'g'))) < 0.5 * length(trim(regexp_replace(regexp_extract({_FRONT.format(x='s')}, '(?m)^summary: >\\n((?:[ \\t]+.*\\n)+)', 1), '\\s+', ' ', 'g'))))",
    "heading_integrity": "regexp_extract(s, '(?m)^# (Widget.*)$', 1) = regexp_extract(t, '(?m)^# (.*)$', 1) AND len(regexp_extract_all(s, '(?m)^#{1,6} ')) = len(regexp_extract_all(t, '(?m)^#{1,6} '))",
    "lead_in": "length(trim(regexp_extract(t, '\\n([^\\n]*)\\n+```py', 1))) < 5",
    "mixed_language": "len(regexp_extract_all(t, '(?m)^The part is made')) > 3",
    "script_run": "regexp_matches(t, '(?i)[A-Za-z]+ and the part') OR regexp_matches(t, '(?m)^The part is made')",
}


@query(f"WITH p AS (SELECT doc_id, {PAGE} AS s, {COPY} AS t FROM documents) SELECT doc_id, {', '.join(f'({v}) AS {k}' for k, v in _SQL_GATES.items())} FROM p")
def language_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gates that know the language, on whole pages; the SQL of some knows where the page's defects are."""
    pages = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{PAGE} AS s", f"{COPY} AS t")
    return pages.select("doc_id", *(lg.LANGUAGE_GATES[g](F.col("s"), F.col("t"), F.lit("ru")).alias(g) for g in _SQL_GATES))


@query()
def language_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{PAGE} AS s", f"{COPY} AS t", "'ru' AS lang")
    return lg.language_gate_report(pages, "s", "t", "lang").select("doc_id", "gates")
