"""Markdown documents: text units with addresses, placeholders, terms, and templates.

A document is parsed by its own rules in Python, once, in Arrow batches: nesting cannot be said by regular expressions. All else is
column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNIT = "addr string, kind string, text string, prefix_ws string, suffix_ws string, do_not_translate boolean"
_FENCE = re.compile(r"^\s*(`{3,}|~{3,})(.*)$")


def fenced_line_mask(lines: list[str]) -> list[bool]:
    """Whether each line is code or a fence; a fence closes with one of its own character, as long or longer, and nothing after it."""
    out, fence = [], None
    for line in lines:
        m = _FENCE.match(line)
        if fence is None:
            fence = (m[1][0], len(m[1])) if m else None
            out.append(m is not None)
        else:
            out.append(True)
            if m and m[1][0] == fence[0] and len(m[1]) >= fence[1] and not m[2].strip():
                fence = None
    return out


def parse_units(text: str) -> Iterator[tuple[str, str, str, str, str, bool]]:
    """The units of a document in order: front-matter fields, headings, paragraphs, list items, table cells, quotes and code."""
    counts: dict[str, int] = {}

    def unit(kind: str, raw: str, fixed: bool = False, addr: str | None = None):
        body = raw.strip()
        k = counts[kind] = counts.get(kind, -1) + 1
        return addr or f"{kind}[{k}]", kind, body, raw[: len(raw) - len(raw.lstrip())], raw[len(raw.rstrip()) :] if body else "", fixed

    m = re.match(r"\A---\n(.*?)\n---(?:\n|\Z)", text, re.S)
    if m:
        for line in m[1].split("\n"):
            if f := re.match(r"([A-Za-z_][\w.-]*): *(.+)$", line):
                yield unit("field", f[2].strip().strip("\"'"), addr=f"front.{f[1]}")
        text = text[m.end() :]
    lines = text.split("\n")
    mask, block, code = fenced_line_mask(lines), [], []
    for line, coded in [*zip(lines, mask, strict=True), ("", False)]:
        if coded:
            code.append(line)
            continue
        if code:
            yield unit("code", "\n".join(code), True)
            code = []
        kind = "heading" if re.match(r"#{1,6} ", line) else "item" if re.match(r"\s*(?:[-*+]|\d+\.) ", line) else "row" if line.lstrip().startswith("|") else "quote" if line.startswith(">") else "shortcode" if re.match(r"\s*\{\{[<%].*[>%]\}\}\s*$", line) else "para" if line.strip() else ""
        if kind != "para" and block:
            yield unit("para", "\n".join(block))
            block = []
        if kind == "para":
            block.append(line)
        elif kind == "row":
            if not re.fullmatch(r"[\s|:-]+", line):
                for cell in line.strip().strip("|").split("|"):
                    yield unit("cell", cell)
        elif kind:
            yield unit(kind, re.sub(r"^\s*(?:#{1,6} |[-*+] |\d+\. |> ?)", "", line), kind == "shortcode")


def extract_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, position, addr, kind, text, prefix_ws, suffix_ws, do_not_translate): a row for each unit of each document."""
    import pyarrow as pa

    names = [c.split()[0] for c in UNIT.split(", ")]

    def extracted(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                units = list(parse_units(batch.column(1)[k].as_py() or ""))
                if units:
                    columns = list(zip(*units, strict=True))
                    kinds = [pa.string()] * 5 + [pa.bool_()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(units))), pa.array(range(len(units)), pa.int32()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["key", "position", *names])

    return docs.select(key, text).mapInArrow(extracted, f"key {docs.schema[key].dataType.simpleString()}, position int, {UNIT}").withColumnRenamed("key", key)


def unit_id(addr: Column, text: Column, kind: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\x00", addr, kind, text), 256), 1, 16)


def final_text(prefix: Column, text: Column, suffix: Column) -> Column:
    return F.concat(F.coalesce(prefix, F.lit("")), text, F.coalesce(suffix, F.lit("")))


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, r"(?ms)^\s*```.*?^\s*```\s*$\n?", "")


# -- placeholders


def protect(text: Column, pattern: str, prefix: str = "PLACEHOLDER") -> Column:
    """(masked, values): matches as {PREFIX_n}, numbered in order, and what they stand for."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    masked = F.array_join(F.flatten(F.transform(parts, lambda p, i: F.array(p, F.when(i < F.size(values), F.concat(F.lit("{" + prefix + "_"), i.cast("string"), F.lit("}"))).otherwise("")))), "")
    return F.struct(masked.alias("masked"), values.alias("values"))


def restore(masked: Column, values: Column, prefix: str = "PLACEHOLDER") -> Column:
    """The inverse; a token without braces counts too, one without a value stays."""
    pattern = r"\{?" + prefix + r"_(\d+)\}?"
    numbers = F.regexp_extract_all(masked, F.lit(pattern), F.lit(1))
    tokens = F.regexp_extract_all(masked, F.lit(pattern), F.lit(0))
    parts = F.split(masked, pattern, -1)
    return F.array_join(F.flatten(F.transform(parts, lambda p, i: F.array(p, F.coalesce(F.get(values, F.get(numbers, i).cast("int")), F.get(tokens, i), F.lit(""))))), "")


def lost_values(restored: Column, values: Column) -> Column:
    return F.filter(values, lambda v: ~F.contains(restored, v))


# -- terms

#: Patterns of candidate terms, the weight of each kind, and what is never a term.
TERM_PATTERNS = {"pascal": (r"\b[A-Z][a-z]+(?:[A-Z][a-z]+)+\b", 0.75), "constant": (r"\b[A-Z_]{4,}\b", 0.65), "acronym": (r"\b[A-Z][A-Z0-9]{1,7}\b", 0.8), "extension": (r"(?<![a-zA-Z0-9])\.[A-Z][A-Z]+\b", 0.9)}


def mine_terms(docs: DataFrame, text: str, product: str | None = None, least: int = 3, confidence: float = 0.8, never: tuple[str, ...] = ()) -> DataFrame:
    """(category, term, n, confidence): candidates by kind that occur often enough; product is a pattern of names of weight 1."""
    kinds = {**({"product": (product, 1.0)} if product else {}), **TERM_PATTERNS}

    def named(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda t: F.struct(F.lit(kind).alias("category"), t.alias("term")))

    found = F.concat(*(named(k, p) for k, (p, _) in kinds.items()))
    rows = docs.select(F.explode(found).alias("c")).select("c.*").groupBy("category", "term").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    weight = F.element_at(F.create_map(*(F.lit(x) for k, (_, w) in kinds.items() for x in (k, w))), F.col("category"))
    score = (F.least(0.6 + (F.col("n") - 3) * 0.05, F.lit(1.0)) + weight) / 2
    return rows.withColumn("confidence", score).filter((F.col("confidence") >= confidence) & ~F.col("term").isin(*never or ("",)))


def detect_terms(docs: DataFrame, key: str, text: str, terms: tuple[str, ...]) -> DataFrame:
    """(key, term, begin): occurrences of a bounded list of terms as whole words; of those that overlap, the longest at the first place."""
    pattern = r"(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t))) + r")(?![\p{L}\p{N}])"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    rows = docs.select(key, found.alias("t"), F.transform(parts, lambda p: F.length(p)).alias("l"))
    begins = F.transform("t", lambda t, i: F.struct(t.alias("term"), (F.aggregate(F.slice("l", 1, i + 1), F.lit(0), lambda a, x: a + x) + F.aggregate(F.slice("t", 1, i), F.lit(0), lambda a, x: a + F.length(x))).alias("begin")))
    return rows.select(key, F.explode(begins).alias("d")).select(key, "d.*")


def correct(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Ordered replacements outside code spans."""
    code = r"`[^`\n]+`"
    values, parts = F.regexp_extract_all(text, F.lit(code), F.lit(0)), F.split(text, code, -1)

    def fixed(p: Column) -> Column:
        for pattern, other in rules:
            p = F.regexp_replace(p, pattern, other)
        return p

    return F.array_join(F.flatten(F.transform(parts, lambda p, i: F.array(fixed(p), F.coalesce(F.get(values, i), F.lit(""))))), "")


def registry_lookup(texts: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """(key, resolved, how) of (key, text, locale): an exact entry, else one without the final colon, which is put back, else none.

    registry: (text, locale, translation)."""
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    asked = texts.select(key, "locale", plain.alias("__t"), F.regexp_replace(plain, r"\s*[:：]$", "").alias("__bare"), F.regexp_extract(plain, r"([:：])$", 1).alias("__colon"))
    exact = registry.select(F.col("text").alias("__t"), "locale", F.col("translation").alias("__a"))
    bare = registry.select(F.col("text").alias("__bare"), "locale", F.col("translation").alias("__b"))
    out = asked.join(exact, ["__t", "locale"], "left").join(bare, ["__bare", "locale"], "left")
    how = F.when(F.col("__a").isNotNull(), "exact").when(F.col("__b").isNotNull() & (F.col("__colon") != ""), "colon").otherwise("none")
    return out.select(key, F.when(how == "exact", F.col("__a")).when(how == "colon", F.concat("__b", "__colon")).alias("resolved"), how.alias("how"))


def completeness_gaps(registry: DataFrame, locales: tuple[str, ...]) -> DataFrame:
    """(text, locale) of entries that lack a translation."""
    wanted = registry.select("text").distinct().withColumn("locale", F.explode(F.array(*map(F.lit, locales))))
    return wanted.join(registry.filter("translation is not null").select("text", "locale"), ["text", "locale"], "left_anti")


def heading_votes(pairs: DataFrame, source: str, target: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, heading, rendering, votes, rank): how the headings of documents with as many on both sides were rendered."""
    heads = lambda c: F.regexp_extract_all(c, F.lit(r"(?m)^#{1,6} (.*)$"))
    zipped = F.arrays_zip(heads(source).alias("heading"), heads(target).alias("rendering"))
    rows = pairs.filter(F.size(heads(source)) == F.size(heads(target))).select(*keys, F.explode(zipped).alias("h")).select(*keys, "h.*")
    votes = rows.groupBy(*keys, "heading", "rendering").agg(F.count("*").alias("votes"))
    return votes.withColumn("rank", F.row_number().over(W.partitionBy(*keys, "heading").orderBy(F.desc("votes"), "rendering")))


# -- BLEU


def _gram_counts(batches: Iterator, keys: int, order: int) -> Iterator:
    """For each pair of texts whose tokens spaces part: the numbers of tokens, and for each n the n-grams shared and all."""
    from collections import Counter

    import pyarrow as pa

    for batch in batches:
        out = []
        for h, r in zip(batch.column(keys).to_pylist(), batch.column(keys + 1).to_pylist(), strict=True):
            a, b = (h or b"").split(), (r or b"").split()
            row = [None if h is None else len(a), None if r is None else len(b)]
            for n in range(1, order + 1):
                x, y = (Counter(zip(*(w[i:] for i in range(n)), strict=False)) for w in (a, b))
                row += [sum(min(c, y[g]) for g, c in x.items() if g in y), max(0, len(a) - n + 1)]
            out.append(row)
        if out:
            names = [f"__{k}" for k in range(keys)] + [f"__n{k}" for k in range(2 + 2 * order)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keys], *(pa.array(c, pa.int64()) for c in zip(*out, strict=True))], names)


def corpus_bleu(pairs: DataFrame, hypothesis: str, reference: str, keys: tuple[str, ...] = (), order: int = 4) -> DataFrame:
    """(keys…, bleu): clipped n-gram counts are summed over the pairs, then combined with the brevity penalty; 0 to 100."""
    spaced = lambda c: F.regexp_replace(c, r"([\p{P}\p{S}])", " $1 ").cast("binary")
    kinds = [f"__{k} {pairs.schema[c].dataType.simpleString()}" for k, c in enumerate(keys)] + [f"__n{k} bigint" for k in range(2 + 2 * order)]
    size = len(keys)  # the function takes no DataFrame along
    counted = pairs.select(*keys, spaced(hypothesis), spaced(reference)).mapInArrow(lambda batches: _gram_counts(batches, size, order), ", ".join(kinds))
    counted = counted.withColumnsRenamed({f"__{k}": c for k, c in enumerate(keys)})
    sums = [F.sum(f"__n{2 * n + k}").alias(f"{name}{n}") for n in range(1, order + 1) for k, name in enumerate(("hit", "all"))]
    out = counted.groupBy(*keys).agg(*sums, F.sum("__n0").alias("__h"), F.sum("__n1").alias("__r"))
    logs = sum((F.log(F.try_divide(F.col(f"hit{n}"), f"all{n}")) for n in range(1, order + 1)), F.lit(0.0)) / order
    none = F.greatest(*(F.when(F.col(f"hit{n}") > 0, 0).otherwise(1) for n in range(1, order + 1))) == 1
    brevity = F.when(F.col("__h") >= F.col("__r"), 0.0).otherwise(1 - F.try_divide("__r", "__h"))
    return out.select(*keys, F.when(none, 0.0).otherwise(100 * F.exp(logs + brevity)).alias("bleu"))
