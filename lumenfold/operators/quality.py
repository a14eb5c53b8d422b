"""Checks of a source text against its translation: validators that list issues, write gates, and the decision over both.

Everything is a column expression, so a row's checks run in one pass, in the JVM, without a shuffle. A validator is a function of the
source and the translation that gives an array of issues; ``register`` adds one. A gate gives true where it objects."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.text import SCRIPT_OF, SCRIPTS, largest_count, let, letters, ngram_hashes, ratio, tokens

ISSUES = "array<struct<validator:string,severity:string,message:string>>"
Check = Callable[[Column, Column], Column]


def issue(validator: str, severity: str, message: str, when: Column) -> Column:
    """One issue, or null."""
    return F.when(when, F.struct(F.lit(validator).alias("validator"), F.lit(severity).alias("severity"), F.lit(message).alias("message")))


def issues(*found: Column) -> Column:
    return F.array_compact(F.array(*found)).cast(ISSUES)


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


# -- parts of a document

FRONT = r"(?s)\A---\n.*?\n---\n"
#: What shows that UTF-8 was read in another encoding.
MOJIBAKE = "Ã.|â€|Â[ ©®°»]"
HEADING, ITEM, FENCE, LINK = r"(?m)^#{1,6} ", r"(?m)^\s*(?:[-*+]|\d+\.) ", r"(?m)^\s*```", r"\[[^\]]*\]\([^)]*\)"
URL, SHORTCODE, PLACEHOLDER, INLINE = r"\]\(([^)\s]+)", r"\{\{[<%][^}]*[>%]\}\}", r"\{?PLACEHOLDER_\d+\}?", r"`[^`\n]+`"


def front_matter(text: Column) -> Column:
    return F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1)


def body(text: Column) -> Column:
    return F.regexp_replace(text, FRONT, "")


def field(text: Column, name: str) -> Column:
    """A scalar field of the front matter, without quotes; empty if it is not there."""
    return F.regexp_replace(F.regexp_extract(front_matter(text), rf"(?m)^{name}: *(.*)$", 1), r"^[\"']|[\"']$", "")


def keys_of(text: Column) -> Column:
    return F.regexp_extract_all(front_matter(text), F.lit(r"(?m)^([A-Za-z_][A-Za-z0-9_]*):"))


def without_code(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?s)```.*?```", ""), INLINE, "")


def fences(text: Column) -> Column:
    """The fenced blocks, their fences included."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(```[^\n]*\n.*?```)"))


def links(text: Column) -> Column:
    """(anchor, url) pairs."""
    both = F.regexp_extract_all(text, F.lit(r"\[([^\]]*)\]\([^)\s]+"), F.lit(1)), F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\(([^)\s]+)"), F.lit(1))
    return F.arrays_zip(both[0].alias("anchor"), both[1].alias("url"))


def urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(URL))


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def clean_for_detection(text: Column) -> Column:
    """Without front matter, code, links, addresses, shortcodes, placeholders, dotted and Pascal-case names; single spaces."""
    steps = (FRONT, r"(?s)```.*?```", INLINE, r"!?\[[^\]]*\]\([^)]*\)", r"https?://\S+", SHORTCODE, PLACEHOLDER, r"\b\w+(?:\.\w+)+\b", r"\b[A-Z][a-z0-9]+(?:[A-Z][a-z0-9]+)+\b", r"\s+")
    return F.trim(reduce(lambda t, p: F.regexp_replace(t, p, " "), steps, text))


# -- validators


def length_ratio(s: Column, t: Column) -> Column:
    a, b = F.length(F.trim(s)), F.length(F.trim(t))
    r = b / F.nullif(a, F.lit(0))
    return issues(issue("Completeness", "ERROR", "translation is much shorter", (a >= 100) & (r < 0.3)), issue("Completeness", "WARNING", "translation is much longer", (a >= 100) & (r > 4.0)))


def completeness(s: Column, t: Column) -> Column:
    return F.concat(issues(issue("Completeness", "ERROR", "translation is empty", (F.trim(s) != "") & (F.trim(t) == "")), issue("Completeness", "ERROR", "placeholder left", count(t, PLACEHOLDER) > count(s, PLACEHOLDER))), length_ratio(s, t))


def trailing_section(s: Column, t: Column) -> Column:
    last = F.element_at(F.split(s, r"(?m)^## "), -1)
    found = urls(last)
    return issues(issue("Completeness", "WARNING", "last section lost its links", (count(s, r"(?m)^## ") > 0) & (F.size(found) > 0) & ~F.exists(found, lambda u: F.contains(t, u))))


#: Factors for languages that are longer or shorter than their source.
LENGTH_FACTORS = {"de": 1.2, "ar": 0.8, "zh": 0.7}


def length_anomaly(s: Column, t: Column, factor: float = 1.0) -> Column:
    a, b = F.length(s), F.length(t)
    w, v = count(s, r"\b\w+\b"), count(t, r"\b\w+\b")
    chars, words = b / F.nullif(a, F.lit(0)), v / F.nullif(w, F.lit(0))
    on = a >= 10
    return issues(issue("LengthAnomaly", "ERROR", "characters", on & (chars > 3 * factor)), issue("LengthAnomaly", "WARNING", "characters", on & (chars > 2 * factor) & (chars <= 3 * factor)), issue("LengthAnomaly", "ERROR", "words", on & (words > 2.5 * factor)), issue("LengthAnomaly", "WARNING", "words", on & (words > 1.8 * factor) & (words <= 2.5 * factor)))


def script_mixing(t: Column, lang: str, most: float = 0.06) -> Column:
    """Over 6 % of the lines of 15 characters hold letters of a script that the language is not written in."""
    own = SCRIPT_OF.get(lang)
    names = ("arabic", "cyrillic", "hebrew", "devanagari", "thai") if lang in ("zh", "ja", "ko") else tuple(SCRIPTS)
    forbidden = "[" + "".join(SCRIPTS[n] for n in names if n != own) + "]"
    long = F.filter(lines(t), lambda x: F.length(F.trim(x)) >= 15)
    return issues(issue("LanguageConsistency", "ERROR", "foreign script", ratio(F.size(F.filter(long, lambda x: x.rlike(forbidden))), F.size(long)) > most))


def repetition(s: Column, t: Column) -> Column:
    """A run of three words occurs more often than the source's own runs allow."""
    most = lambda text, least: let(tokens(text), lambda w: F.when(F.size(w) >= least, largest_count(ngram_hashes(w, 3), True)).otherwise(0))

    def judged(x: Column) -> Column:
        high, low = F.greatest(F.lit(3), F.floor(1.5 * x["ceiling"]).cast("int") + 1), F.greatest(F.lit(2), F.floor(1.2 * x["ceiling"]).cast("int") + 1)
        return issues(issue("Repetition", "ERROR", "repeated words", x["n"] >= high), issue("Repetition", "WARNING", "repeated words", (x["n"] >= low) & (x["n"] < high)))

    return let(F.struct(most(t, 3).alias("n"), most(s, 30).alias("ceiling")), judged)


def sentence_duplication(t: Column) -> Column:
    parts = F.filter(F.transform(F.split(t, r"[.!?]+\s+"), lambda x: F.lower(F.trim(x))), lambda x: F.length(x) > 5)
    return let(parts, lambda p: issues(issue("Repetition", "WARNING", "repeated sentence", F.size(p) > F.size(F.array_distinct(p)))))


def heading_repetition(t: Column, most: int = 4) -> Column:
    heads = F.regexp_extract_all(t, F.lit(r"(?m)^#{1,6} (.*)$"))
    return issues(issue("Repetition", "ERROR", "repeated word in a heading", F.exists(heads, lambda h: largest_count(tokens(h)) > most)))


def multiset_differs(a: Column, b: Column) -> Column:
    return F.array_sort(a) != F.array_sort(b)


def placeholders(s: Column, t: Column) -> Column:
    found = F.struct(*(F.regexp_extract_all(x, F.lit(r"(\{[A-Z][A-Z_]*_\d+\})")).alias(n) for n, x in (("a", s), ("b", t))))

    def judged(x: Column) -> Column:
        lost, new = F.size(F.array_except(x["a"], x["b"])) > 0, F.size(F.array_except(x["b"], x["a"])) > 0
        return issues(issue("Placeholder", "ERROR", "missing placeholder", lost), issue("Placeholder", "ERROR", "extra placeholder", new), issue("Placeholder", "WARNING", "other order or number", ~lost & ~new & (x["a"] != x["b"])))

    return let(found, judged)


def link_check(s: Column, t: Column) -> Column:
    return let(F.struct(urls(s).alias("a"), urls(t).alias("b")), lambda x: issues(issue("Link", "ERROR", "number of links", F.size(x["a"]) != F.size(x["b"])), issue("Link", "ERROR", "missing address", F.size(F.array_except(x["a"], x["b"])) > 0), issue("Link", "WARNING", "new address", F.size(F.array_except(x["b"], x["a"])) > 0)))


def structure(s: Column, t: Column) -> Column:
    far = lambda p, most: F.abs(count(s, p) - count(t, p)) > most
    heads = lambda x: F.transform(F.regexp_extract_all(x, F.lit(r"(?m)^(#{1,6}) ")), lambda h: F.length(h))

    def judged(x: Column) -> Column:
        n, m = F.size(x["a"]), F.size(x["b"])
        drift = F.when(n >= 10, F.greatest(F.lit(2), F.floor(n * 0.05).cast("int"))).otherwise(0)
        same_heads = F.size(x["h"]) == F.size(x["g"])
        return issues(issue("Structure", "ERROR", "number of headings", ~same_heads), issue("Structure", "WARNING", "heading levels", same_heads & (x["h"] != x["g"])), issue("Structure", "WARNING", "list items", far(ITEM, 2)), issue("Structure", "ERROR", "code block count", F.abs(n - m) > drift), issue("Structure", "ERROR", "code block changed", (n == m) & (x["a"] != x["b"])), issue("Structure", "ERROR", "links and images", far(LINK, 0)), issue("Structure", "WARNING", "bold", far(r"\*\*[^*\n]+\*\*", 2)))

    return let(F.struct(fences(s).alias("a"), fences(t).alias("b"), heads(s).alias("h"), heads(t).alias("g")), judged)


def shortcodes(s: Column, t: Column) -> Column:
    a, b = (F.regexp_extract_all(x, F.lit(f"({SHORTCODE})")) for x in (s, t))
    fewer = F.exists(F.array_distinct(a), lambda x: F.size(F.filter(a, lambda y: y == x)) > F.size(F.filter(b, lambda y: y == x)))
    return issues(issue("ShortcodePreservation", "ERROR", "missing shortcode", fewer), issue("ShortcodePreservation", "WARNING", "extra shortcode", F.size(F.array_except(b, a)) > 0))


def preserved(pattern: str, name: str = "RegexPreservation") -> Check:
    """All matches of a pattern survive."""
    return lambda s, t: issues(issue(name, "ERROR", "match lost", F.size(F.array_except(*(F.regexp_extract_all(x, F.lit(f"({pattern})")) for x in (s, t)))) > 0))


def terminology(terms: tuple[str, ...]) -> Check:
    """A term of the source is not in the translation, or as often."""

    def check(s: Column, t: Column) -> Column:
        found = []
        for term in terms:
            p = rf"(?<![A-Za-z0-9]){term}(?![A-Za-z0-9])"
            a, b = count(s, p), count(t, p)
            found += [issue("TerminologyPreservation", "ERROR", f"lost {term}", (a > 0) & (b == 0)), issue("TerminologyPreservation", "WARNING", f"number of {term}", (a > 0) & (b > 0) & (a != b))]
        return issues(*found)

    return check


def front_matter_keys(s: Column, t: Column) -> Column:
    a, b = keys_of(s), keys_of(t)
    return issues(issue("FrontmatterIntegrity", "ERROR", "keys differ", multiset_differs(a, b)), issue("FrontmatterIntegrity", "WARNING", "key order", ~multiset_differs(a, b) & (a != b)))


def markdown_in_metadata(s: Column, t: Column) -> Column:
    return issues(issue("MetadataMarkdownContamination", "ERROR", "heading mark in a field", front_matter(t).rlike(r"(?m)^[A-Za-z_]+: *[\"']?#+ ")))


VALIDATORS: dict[str, Check] = {
    "completeness": completeness, "trailing_section": trailing_section, "length_anomaly": length_anomaly, "repetition": repetition, "sentence_duplication": lambda s, t: sentence_duplication(t), "heading_repetition": lambda s, t: heading_repetition(t),
    "placeholders": placeholders, "links": link_check, "structure": structure, "shortcodes": shortcodes, "front_matter_keys": front_matter_keys, "markdown_in_metadata": markdown_in_metadata,
}


def register(name: str, check: Check) -> None:
    VALIDATORS[name] = check


def validate(pairs: DataFrame, source: str = "source", translation: str = "translation", names: tuple[str, ...] | None = None) -> DataFrame:
    """issues of each pair by the named validators, in their order; nulls are empty texts."""
    s, t = (F.coalesce(F.col(c), F.lit("")) for c in (source, translation))
    both = let(F.struct(s.alias("s"), t.alias("t")), lambda x: F.concat(*(VALIDATORS[n](x["s"], x["t"]) for n in names or VALIDATORS)))
    return pairs.withColumn("issues", both)


def of_severity(found: Column, severity: str) -> Column:
    return F.filter(found, lambda i: i["severity"] == severity)


#: Validators whose errors reject at once; errors, retries and warnings that each mode bears.
CRITICAL = ("Placeholder", "CodeBlock", "Link", "Structure", "ShortcodePreservation", "SemanticSimilarity")
MODES = {"strict": (1, 1, False, False), "normal": (2, 2, True, False), "lenient": (5, 2, True, False), "fast": (2, 0, True, True)}


def decide(found: Column, retries: Column, mode: str = "normal") -> Column:
    """ACCEPT, RETRY or REJECT by the first rule that holds."""
    most, again, warnings_pass, accept_in_the_end = MODES[mode]
    errors, warnings = of_severity(found, "ERROR"), of_severity(found, "WARNING")
    critical = F.exists(errors, lambda i: i["validator"].isin(*CRITICAL) | (i["validator"] == "Repetition") | F.lower(i["message"]).rlike("placeholder|code block|link"))
    good = (F.size(errors) == 0) & (F.lit(True) if warnings_pass else F.size(warnings) == 0)
    return F.when(critical, "REJECT").when(F.size(errors) >= most, "REJECT").when(good, "ACCEPT").when(retries < again, "RETRY").otherwise("ACCEPT" if accept_in_the_end else "REJECT")


# -- write gates: true where the gate objects


def _newlines(x: Column) -> Column:
    return count(x, "\n")


def _prose_lines(t: Column) -> Column:
    return F.filter(lines(without_code(body(t))), lambda x: F.trim(x) != "")


#: Fields of the front matter whose backticks come in pairs.
BACKTICKED = ("title", "description", "summary", "linkTitle")


def paired_backticks(t: Column) -> Column:
    """A backtick at the end of each such field, within its quotes, that has an odd number of them."""
    front = F.regexp_extract(t, f"({FRONT})", 1)
    fixed = front
    for n in BACKTICKED:
        value = rf"""(?s)\A(.*?\n{n}: *(?:"[^\n]*(?=" *\n)|'[^\n]*(?=' *\n)|[^\n]*?(?= *\n)))"""
        fixed = F.when(count(field(t, n), "`") % 2 == 1, F.regexp_replace(fixed, value, "$1`")).otherwise(fixed)
    return F.concat(fixed, F.substr(t, F.length(front) + 1))


#: What a repair of prose leaves alone: code, links, shortcodes, HTML, addresses and steps up in a path.
PROTECTED = r"(?s)```.*?```|`[^`\n]+`|!?\[[^\]\n]*\]\([^)\n]*\)|\{\{[<%].*?[>%]\}\}|<[A-Za-z/!][^>\n]*>|https?://\S+|(?:\.\./)+"
TWO_PERIODS = r"(?<!\.)\.\.(?!\.)"


def in_prose(text: Column, change: Callable[[Column], Column]) -> Column:
    """text with its prose, what lies between protected spans, changed."""
    def joined(x: Column) -> Column:
        return F.array_join(F.flatten(F.transform(x["prose"], lambda p, i: F.array(change(p), F.coalesce(F.get(x["kept"], i), F.lit(""))))), "")

    return let(F.struct(F.split(text, PROTECTED, -1).alias("prose"), F.regexp_extract_all(text, F.lit(PROTECTED), F.lit(0)).alias("kept")), joined)


def has_in_prose(text: Column, pattern: str) -> Column:
    return F.exists(F.split(text, PROTECTED, -1), lambda p: p.rlike(pattern))


GATES: dict[str, Check] = {
    "code_block": lambda s, t: F.size(fences(t)) < F.size(fences(s)),
    "heading_surplus": lambda s, t: count(t, HEADING) > count(s, HEADING) + 3,
    "heading_deficit": lambda s, t: count(t, r"(?m)^## ") < count(s, r"(?m)^## "),
    "front_matter_keys": lambda s, t: multiset_differs(keys_of(s), keys_of(t)),
    "front_matter_backticks": lambda s, t: reduce(lambda a, b: a | b, (count(field(t, n), "`") % 2 == 1 for n in BACKTICKED)),
    "double_periods": lambda s, t: has_in_prose(t, TWO_PERIODS) & ~has_in_prose(s, TWO_PERIODS),
    "foreign_policy": lambda s, t: t.rlike(r"(?i)\b(GDPR|European (Union|Parliament|Commission))\b") & ~s.rlike(r"(?i)\b(GDPR|European (Union|Parliament|Commission))\b"),
    "table_rows": lambda s, t: (count(s, r"(?m)^\|") >= 4) & ((count(t, r"(?m)^\|") < 0.5 * count(s, r"(?m)^\|")) | (count(t, r"(?m)^\|") > 2 * count(s, r"(?m)^\|"))),
    "newline_explosion": lambda s, t: (_newlines(s) >= 10) & (_newlines(t) > 2.5 * _newlines(s)),
    "description_growth": lambda s, t: (F.length(field(s, "description")) >= 30) & (F.length(field(t, "description")) > 3 * F.length(field(s, "description"))),
    "fence_count": lambda s, t: (count(s, FENCE) >= 4) & (count(t, FENCE) < count(s, FENCE) - 2),
    "fence_parity": lambda s, t: (count(t, FENCE) % 2 == 1) | (count(t, FENCE) < count(s, FENCE)),
    "empty_body": lambda s, t: (F.length(F.trim(body(t))) < 50) & (F.length(F.trim(body(s))) > 200),
    "shortcode_leak": lambda s, t: t.rlike(r"\{\{[<%]") & ~s.rlike(r"\{\{[<%]"),
    "inline_code": lambda s, t: (count(s, INLINE) == count(t, INLINE)) & F.exists(F.arrays_zip(F.regexp_extract_all(s, F.lit(f"({INLINE})")).alias("a"), F.regexp_extract_all(t, F.lit(f"({INLINE})")).alias("b")), lambda p: (~p["a"].rlike(r"[^\x00-\x7F]")) & p["b"].rlike(r"[^\x00-\x7F]")),
    "encoding": lambda s, t: t.rlike(MOJIBAKE) & ~s.rlike(MOJIBAKE),
    "code_truncated": lambda s, t: F.exists(F.arrays_zip(fences(s).alias("a"), fences(t).alias("b")), lambda p: (count(p["a"], r"(?m)^.*\S.*$") >= 10) & (count(p["b"], r"(?m)^.*\S.*$") < 0.7 * count(p["a"], r"(?m)^.*\S.*$"))),
    "refusal": lambda s, t: F.concat(front_matter(t), F.lit("\n"), without_code(body(t))).rlike(r"(?i)\b(I'm sorry, but I|I cannot (assist|help)|As an AI|here is the translation)\b"),
    "placeholder_leak": lambda s, t: t.rlike(PLACEHOLDER),
    "dropped_link": lambda s, t: F.size(trailing_section(s, t)) > 0,
    "dash_range": lambda s, t: F.exists(F.regexp_extract_all(s, F.lit(r"\b(\d+-\d+)\b")), lambda r: ~F.contains(t, r) & F.contains(t, F.regexp_replace(r, "-", ""))),
    "homoglyph_in_code": lambda s, t: F.exists(F.regexp_extract_all(t, F.lit(f"({INLINE})")), lambda c: c.rlike(r"[A-Za-z]") & c.rlike(r"[\x{0370}-\x{03FF}\x{0400}-\x{04FF}]")),
    "seo_length": lambda s, t: (F.length(field(t, "title")) >= F.length(field(s, "title")) + 15) & (F.length(field(t, "title")) >= 1.5 * F.length(field(s, "title"))),
    "line_count": lambda s, t: F.abs(1 - F.size(lines(t)) / F.size(lines(s))) >= 0.4 - 1e-9,
    "list_structure": lambda s, t: (count(s, ITEM) > 0) & (count(t, ITEM) == 0),
    "markdown_syntax": lambda s, t: (count(t, r"\*\*") % 2 == 1) & (count(s, r"\*\*") % 2 == 0),
}
#: Gates whose objection is repaired in the text that the gates after them see.
REPAIRS: dict[str, Callable[[Column], Column]] = {"double_periods": lambda t: in_prose(t, lambda p: F.regexp_replace(p, TWO_PERIODS, ".")), "front_matter_backticks": paired_backticks}


def gate_report(pairs: DataFrame, source: str = "source", translation: str = "translation", names: tuple[str, ...] | None = None) -> DataFrame:
    """gates: the names of all gates that object, in order."""
    s, t = (F.coalesce(F.col(c), F.lit("")) for c in (source, translation))
    return pairs.withColumn("gates", F.array_compact(F.array(*(F.when(GATES[n](s, t), n) for n in names or GATES))))


def write_decision(pairs: DataFrame, source: str = "source", translation: str = "translation", zero_defect: bool = False) -> DataFrame:
    """blocked_by: the first gate that objects; text: the translation after repairs. Repairing gates block only with zero_defect."""
    out = pairs.withColumn("text", F.coalesce(translation, F.lit("")))
    s = F.coalesce(F.col(source), F.lit(""))
    blocks = []
    for name, gate in GATES.items():
        if name in REPAIRS and not zero_defect:
            out = out.withColumn("text", F.when(gate(s, F.col("text")), REPAIRS[name](F.col("text"))).otherwise(F.col("text")))
        else:
            blocks.append(F.when(gate(s, F.col("text")), name))
    return out.withColumn("blocked_by", F.coalesce(*blocks))


# -- units


#: Fixed value: how short descriptions of an interface begin.
SHORT_API = r"^(Gets?|Sets?|Indicates?|Enables?|Disables?|Represents?)\s"


def unit_issues(kind: Column, s: Column, t: Column, non_latin: Column) -> Column:
    """The names of a unit's defects."""
    prose = ratio(count(t, "[A-Za-z]"), letters(t)) > 0.85
    paragraphs = F.transform(F.split(t, r"\n\s*\n"), lambda p: F.trim(p))
    run = F.when(F.size(paragraphs) >= 3, F.exists(F.sequence(F.lit(0), F.size(paragraphs) - 3), lambda i: (F.get(paragraphs, i) != "") & (F.get(paragraphs, i) == F.get(paragraphs, i + 1)) & (F.get(paragraphs, i) == F.get(paragraphs, i + 2)))).otherwise(False)
    found = {
        "mojibake": t.rlike(MOJIBAKE) & ~s.rlike(MOJIBAKE),
        "shortcode_leak": GATES["shortcode_leak"](s, t),
        "inline_code": GATES["inline_code"](s, t),
        "empty": (F.length(s) > 20) & (F.length(t) < 0.1 * F.length(s)),
        "cell_growth": (kind == "cell") & (F.length(s) > 0) & (F.length(t) > 3 * F.length(s)),
        "short_api_growth": non_latin & (F.length(s) <= 60) & s.rlike(SHORT_API) & (F.length(t) > 3 * F.length(s)),
        "untranslated": non_latin & (kind == "heading") & ((s == t) | prose),
        "duplicate_run": run,
        "newlines": (_newlines(s) >= 3) & (_newlines(t) > 2.5 * _newlines(s)),
    }
    return F.array_compact(F.array(*(F.when(c, n) for n, c in found.items())))
