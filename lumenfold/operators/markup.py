"""Writing markdown back: units with their places, translations put in, nested front matter, fences, and checks of what was written.

A unit's place is a span of characters, so putting the units' own texts back gives the document unchanged, whatever is in it."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lumenfold.operators.documents import fenced_line_mask
from lumenfold.operators.quality import INLINE, body, count, front_matter, issue, issues, keys_of, lines

# -- units and their places

_FRONT = re.compile(r"\A---\n(.*?)\n---(?:\n|\Z)", re.S)
_MARKER = re.compile(r"^\s*(?:#{1,6} |[-*+] |\d+\. |> ?)")


def unit_spans(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(address, kind, begin, end) of a document's units that may be translated: the addresses are those of ``parse_units``."""
    counts: dict[str, int] = {}
    names: dict[str, int] = {}

    def unit(kind: str, begin: int, end: int, addr: str | None = None):
        k = counts[kind] = counts.get(kind, -1) + 1
        raw = text[begin:end]
        inner = raw.strip()
        at = begin + len(raw) - len(raw.lstrip())
        return (addr or f"{kind}[{k}]", kind, at, at + len(inner))

    at = 0
    if m := _FRONT.match(text):
        line_at = m.start(1)
        for line in m[1].split("\n"):
            if f := re.match(r"([A-Za-z_][\w.-]*): *(.+)$", line):
                value = f[2].strip()
                inner = value.strip("\"'")
                begin = line_at + f.start(2) + (len(f[2]) - len(f[2].lstrip())) + (len(value) - len(value.lstrip("\"'")) if inner else 0)
                k = names[f[1]] = names.get(f[1], -1) + 1  # a key that repeats is told apart
                yield unit("field", begin, begin + len(inner), f"front.{f[1]}" + (f"[{k}]" if k else ""))
            line_at += len(line) + 1
        at = m.end()
    rows = text[at:].split("\n")
    first = last = None
    for line, coded in [*zip(rows, fenced_line_mask(rows), strict=True), ("", False)]:
        kind = "" if coded or not line.strip() else "heading" if re.match(r"#{1,6} ", line) else "item" if re.match(r"\s*(?:[-*+]|\d+\.) ", line) else "row" if line.lstrip().startswith("|") else "quote" if line.startswith(">") else "" if re.match(r"\s*\{\{[<%].*[>%]\}\}\s*$", line) else "para"
        if kind == "para":
            first, last = at if first is None else first, at + len(line)
        elif first is not None:
            yield unit("para", first, last)
            first = None
        if kind == "row" and not re.fullmatch(r"[\s|:-]+", line):
            inner = line.strip().strip("|")
            place = at + line.index(inner)
            for cell in inner.split("|"):
                yield unit("cell", place, place + len(cell))
                place += len(cell) + 1
        elif kind in ("heading", "item", "quote"):
            yield unit(kind, at + _MARKER.match(line).end(), at + len(line))
        at += len(line) + 1


def put_in(text: str, translations: dict[str, str]) -> str:
    """The document with the units at these addresses replaced; addresses that it has not are left out."""
    out, at = [], 0
    for addr, _, begin, end in sorted(unit_spans(text), key=lambda u: u[2]):
        new = translations.get(addr)
        if new is not None and begin >= at:
            out += [text[at:begin], new]
            at = end
    return "".join([*out, text[at:]])


SPAN = ArrayType(StructType([StructField("addr", StringType()), StructField("kind", StringType()), StructField("begin", IntegerType()), StructField("end", IntegerType()), StructField("text", StringType())]))


@pandas_udf(SPAN)
def spans(text: pd.Series) -> pd.Series:
    """(addr, kind, begin, end, text) of each unit."""
    return text.map(lambda t: [] if t is None else [{"addr": a, "kind": k, "begin": b, "end": e, "text": t[b:e]} for a, k, b, e in unit_spans(t)])


@pandas_udf(StringType())
def rebuilt(text: pd.Series, addrs: pd.Series, texts: pd.Series) -> pd.Series:
    """The document with the units at the addresses replaced by the texts beside them."""
    return pd.Series([None if t is None else put_in(t, dict(zip(a, x, strict=True))) if a is not None and len(a) else t for t, a, x in zip(text, addrs, texts, strict=True)])


def apply_translations(docs: DataFrame, units: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with ``rebuilt``, the text with its units (key, addr, translation) replaced. A document's units are gathered, no more."""
    own = units.filter(F.col("translation").isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("addr", "translation"))).alias("__units"))
    return docs.join(own, key, "left").withColumn("rebuilt", rebuilt(F.col(text), F.col("__units.addr"), F.col("__units.translation"))).drop("__units")


def sole_leaf(found: Column, node: Column) -> Column:
    """ONE, MANY or NONE: how many units lie at an address or under it."""
    n = F.size(F.filter(found, lambda u: (u["addr"] == node) | F.startswith(u["addr"], F.concat(node, F.lit("."))) | F.startswith(u["addr"], F.concat(node, F.lit("[")))))
    return F.when(n == 0, "NONE").when(n == 1, "ONE").otherwise("MANY")


def paired_units(source: DataFrame, translated: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, kind, source, translation): units side by side by their place among those of their kind; what one side lacks is null."""
    return source.select(key, "kind", "addr", F.col("text").alias("source")).join(translated.select(key, "kind", "addr", F.col("text").alias("translation")), [key, "kind", "addr"], "full")


# -- nested front matter, as JSON


def nested_values(data: object, pattern: str) -> list[tuple[str, object]]:
    """(indexed path, value) of what a dotted path reaches; lists on the way are walked through."""
    found = [("", data)]
    for part in pattern.split("."):
        step = []
        for path, value in found:
            items = [(f"{path}[{i}]", v) for i, v in enumerate(value)] if isinstance(value, list) else [(path, value)]
            step += [(f"{p}.{part}" if p else part, v[part]) for p, v in items if isinstance(v, dict) and v.get(part) is not None]
        found = step
    return found


def with_nested_value(data: object, path: str, value: object) -> object:
    """data with a value at an indexed path; KeyError or IndexError if the way there is missing."""
    steps = [int(i) if i else name for name, i in re.findall(r"([^.\[\]]+)|\[(\d+)\]", path)]
    at = data
    for s in steps[:-1]:
        at = at[s]
    at[steps[-1]] = value
    return data


def nested(record: Column, pattern: str) -> Column:
    """array of (path, value as JSON) of a JSON text."""

    @pandas_udf(ArrayType(StructType([StructField("path", StringType()), StructField("value", StringType())])))
    def found(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: None if r is None else [{"path": p, "value": json.dumps(v, ensure_ascii=False)} for p, v in nested_values(json.loads(r), pattern)])

    return found(record)


def with_nested(record: Column, path: str, value: Column) -> Column:
    """A JSON text with a string at an indexed path; unchanged where the way there is missing."""

    @pandas_udf(StringType())
    def put(rows: pd.Series, values: pd.Series) -> pd.Series:
        def one(r: str | None, v: str | None) -> str | None:
            try:
                return None if r is None else json.dumps(with_nested_value(json.loads(r), path, v), ensure_ascii=False)
            except (KeyError, IndexError, TypeError):
                return r

        return pd.Series([one(r, v) for r, v in zip(rows, values, strict=True)])

    return put(record, value)


def literal_style(value: Column) -> Column:
    """Lists or several paragraphs over several lines are written as they are."""
    return F.contains(value, F.lit("\n")) & (value.rlike(r"(?m)^\s*[-*+]\s+") | F.contains(value, F.lit("\n\n")) | value.rlike(r"(?m)^\s*\d+\.\s+"))


def front_matter_text(fields: Column) -> Column:
    """A map of names and strings as front matter, its names in order; several lines as a literal block, quotes where they are needed."""
    def line(e: Column) -> Column:
        v = e["value"]
        quoted = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(v, r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
        plain = F.when(v.rlike(r"""^[\s]|[\s]$|^$|^[-?:,\[\]{}#&*!|>'"%@`]|: |:$| #"""), quoted).otherwise(v)
        block = F.concat(F.lit("|-\n  "), F.regexp_replace(v, r"\n(?=[^\n])", "\n  "))
        return F.concat(e["key"], F.lit(": "), F.when(F.contains(v, F.lit("\n")), block).otherwise(plain))

    return F.concat(F.lit("---\n"), F.array_join(F.transform(F.array_sort(F.map_entries(fields)), line), "\n"), F.lit("\n---\n"))


# -- fences and code


@pandas_udf(ArrayType(StructType([StructField("begin", IntegerType()), StructField("end", IntegerType())])))
def fence_spans(text: pd.Series) -> pd.Series:
    """Character spans of fenced code, the fences included."""

    def found(t: str | None) -> list[dict] | None:
        if t is None:
            return None
        rows, out, at, begin = t.split("\n"), [], 0, None
        for line, coded in [*zip(rows, fenced_line_mask(rows), strict=True), ("", False)]:
            if coded and begin is None:
                begin = at
            elif not coded and begin is not None:
                out.append({"begin": begin, "end": at - 1})
                begin = None
            at += len(line) + 1
        return out

    return text.map(found)


def reopened_fences(text: Column) -> Column:
    """Fenced blocks that hold what looks like the opening of another."""
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(r"(?ms)^```[^\n]*\n(.*?)^```[ \t]*$")), lambda b: b.rlike(r"(?m)^```\w")))


def inline_code_restored(s: Column, t: Column) -> Column:
    """The translation with its code spans replaced by the source's, in order, if there are as many; null else."""
    a = F.regexp_extract_all(s, F.lit(f"({INLINE})"))
    parts = F.split(t, INLINE, -1)
    return F.when((F.size(parts) - 1 == F.size(a)), F.array_join(F.flatten(F.transform(parts, lambda p, i: F.array(p, F.coalesce(F.get(a, i), F.lit(""))))), ""))


# -- checks


def yaml_structure(s: Column, t: Column, warn: float = 10.0, error: float = 20.0) -> Column:
    """Drift of the number of lines in per cent, section comments and literal blocks that are gone."""
    a, b = F.size(lines(s)), F.size(lines(t))
    drift = F.abs(b - a) / a * 100
    marks = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r"(?m)^(#\s*\w+)")))
    literal = lambda x: count(x, r"(?m):\s*[|>][-+]?\s*$")
    return issues(issue("YAMLStructure", "ERROR", "lines drift", drift > error), issue("YAMLStructure", "WARNING", "lines drift", (drift > warn) & (drift <= error)), issue("YAMLStructure", "WARNING", "comment lost", F.size(F.array_except(marks(s), marks(t))) > 0), issue("YAMLStructure", "ERROR", "literal block lost", literal(t) < literal(s)))


def yaml_fields(s: Column, t: Column) -> Column:
    """The front matter's form, its keys, and tabs or control characters in it."""
    opened = t.startswith("---")
    front = front_matter(t)
    broken = F.exists(F.split(front, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w.-]*:[^\s]") & ~x.rlike(r"^[A-Za-z_][\w.-]*://"))
    return issues(issue("YAML", "ERROR", "front matter does not end", opened & (front == "")), issue("YAML", "ERROR", "a key without a space behind it", broken), issue("YAML", "ERROR", "keys lost", F.size(F.array_except(keys_of(s), keys_of(t))) > 0), issue("YAML", "WARNING", "new keys", F.size(F.array_except(keys_of(t), keys_of(s))) > 0), issue("YAML", "ERROR", "tab or control character", front.rlike(r"(?m)^\t|[\x00-\x08\x0B\x0C\x0E-\x1F]")))


def glued_identifiers(s: Column, t: Column, pattern: str = r"[A-Za-z]\w*(?:[._][A-Za-z]\w*)+") -> Column:
    """Dotted or underscored identifiers of the source that stand in the translation fused to a letter."""
    found = F.array_distinct(F.regexp_extract_all(s, F.lit(rf"(?<![\p{{L}}\p{{N}}_.])({pattern})(?![\p{{L}}\p{{N}}_])")))
    glued = lambda x: F.call_function("rlike", t, F.concat(F.lit(r"\p{L}\Q"), x, F.lit(r"\E|\Q"), x, F.lit(r"\E\p{L}")))
    return F.filter(found, glued)


def protected_fields(s: Column, t: Column, modes: dict[str, str]) -> Column:
    """Fields by mode: passthrough keeps its line, ignore is not there; translate and computed are free."""
    own = lambda x, f: F.regexp_extract(front_matter(x), rf"(?m)^{f}: *(.*)$", 1)
    found = [issue("FrontmatterProtection", "ERROR", f"changed {f}", own(s, f) != own(t, f)) for f, m in modes.items() if m == "passthrough"]
    found += [issue("FrontmatterProtection", "ERROR", f"present {f}", front_matter(t).rlike(rf"(?m)^{f}:")) for f, m in modes.items() if m == "ignore"]
    return issues(*found)


def placement(path: Column, lang: Column, root: str = "content") -> Column:
    """A translated file lies under its root, in its language's folder, as markdown, with no step up in its path."""
    parts = F.split(path, "/")
    return issues(issue("FilePlacement", "ERROR", "not under the root", F.get(parts, F.lit(0)) != root), issue("FilePlacement", "ERROR", "not in the language's folder", ~F.array_contains(parts, lang)), issue("FilePlacement", "ERROR", "not markdown", ~path.rlike(r"\.md$")), issue("FilePlacement", "ERROR", "step up", F.array_contains(parts, F.lit(".."))))


def similarity_issue(cosine: Column, length: Column, least: int = 200) -> Column:
    """Texts of some length whose vectors are too far apart."""
    return issues(issue("SemanticSimilarity", "ERROR", "far from the source", (length >= least) & (cosine < 0.40)), issue("SemanticSimilarity", "WARNING", "far from the source", (length >= least) & (cosine >= 0.40) & (cosine < 0.55)))


def intake_failures(now: Column, old: Column, english: Column, was_english: Column, leak: str) -> Column:
    """R2 leaked instructions, R1 a description that has become English, R3 fences that are gone."""
    fences = lambda x: count(x, r"(?m)^\s*```")
    return F.array_compact(F.array(F.when(now.rlike(leak), "R2"), F.when(english & F.coalesce(~was_english, F.lit(False)), "R1"), F.when(F.coalesce(fences(now) < fences(old), F.lit(False)), "R3")))


def review_key(source: Column, translation: Column, lang: Column, config: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", F.sha2(body(source), 256), F.sha2(body(translation), 256), lang, config), 256)


@pandas_udf(StringType())
def without_repeats(text: pd.Series) -> pd.Series:
    """Paragraphs of over 30 characters that occur three times or more stand once; code is left alone, and so are repeats that have a
    heading between each two of them."""

    def once(t: str | None) -> str | None:
        if t is None:
            return None
        m = _FRONT.match(t)
        front, rest = (t[: m.end()], t[m.end() :]) if m else ("", t)
        parts, at = [], 0  # (text, is a paragraph)
        for chunk in re.split(r"(```.*?```)", rest, flags=re.S):
            if chunk.startswith("```"):
                parts.append((chunk, False))
            else:
                for piece in re.split(r"(\n{2,})", chunk):
                    parts.append((piece, not re.fullmatch(r"\n*", piece)))
        places: dict[str, list[int]] = {}
        headings = [i for i, (p, _) in enumerate(parts) if re.match(r"#{1,6}[ \t]", p.strip())]
        for i, (p, ok) in enumerate(parts):
            if ok and len(p.strip()) > 30:
                places.setdefault(p.strip(), []).append(i)
        gone = set()
        for found in places.values():
            apart = all(any(a <= h < b for h in headings) for a, b in zip(found, found[1:], strict=False))
            if len(found) >= 3 and not apart:
                gone.update(found[1:])
        out = []
        for i, (p, _) in enumerate(parts):
            if i in gone:
                if out and re.fullmatch(r"\n{2,}", out[-1]):
                    out.pop()
                continue
            out.append(p)
        return front + "".join(out)

    return text.map(once)
