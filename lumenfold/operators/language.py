"""Which language a text is in, by script and function words, and what follows from it: purity, hits, gates that know the target language.

``detect`` gives (lang, confidence) as a column: a language of its own script by the share of that script's letters, a Latin one by the
share of its function words among all known function words. Texts that hold neither are of no language, and pass."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.text import SCRIPT_OF, SCRIPTS, let, letters, ratio
from lumenfold.operators.quality import PROTECTED, body, clean_for_detection, count, field, front_matter, lines, without_code

#: Frequent function words of languages in Latin letters.
FUNCTION_WORDS = {
    "de": ("der", "die", "das", "und", "nicht", "ist", "ein", "eine", "mit", "auf", "für", "werden"),
    "en": ("the", "and", "of", "to", "is", "that", "with", "for", "this", "are", "from", "was"),
    "es": ("el", "los", "las", "y", "que", "una", "por", "con", "para", "del", "es", "como"),
    "fr": ("le", "les", "et", "des", "une", "est", "pour", "dans", "que", "avec", "sur", "du"),
    "it": ("il", "gli", "e", "che", "una", "per", "con", "della", "sono", "non", "di", "nel"),
}
#: Languages that detectors take for each other.
SIMILAR = (("ms", "id"), ("cs", "sk"), ("hr", "sr", "bs"), ("nb", "da", "no"))
NON_LATIN = tuple(SCRIPT_OF)


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), r"[^\p{L}]+")


def _hits(words: Column, known: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda x: x.isin(*known)))


def detect(text: Column) -> Column:
    """struct(lang, confidence); lang is null where nothing speaks for any language."""

    def judged(w: Column) -> Column:
        hits = [(k, _hits(w["words"], v)) for k, v in FUNCTION_WORDS.items()]
        every = reduce(lambda a, b: a + b, (n for _, n in hits))
        best = F.array_max(F.array(*(F.struct(n.alias("n"), F.lit(k).alias("lang")) for k, n in hits)))
        latin = F.struct(F.when(every > 0, best["lang"]).alias("lang"), ratio(best["n"], every).alias("confidence"))
        out = latin
        for name in dict.fromkeys(SCRIPT_OF.values()):
            share = ratio(F.regexp_count(w["text"], F.lit(f"[{SCRIPTS[name]}]")), w["letters"])
            first = next(k for k, v in SCRIPT_OF.items() if v == name)
            out = F.when(share > 0.5, F.struct(F.lit(first).alias("lang"), share.cast("double").alias("confidence"))).otherwise(out)
        return out

    return let(F.struct(words_of(text).alias("words"), text.alias("text"), letters(text).alias("letters")), judged)


def same_or_similar(a: Column, b: Column) -> Column:
    """Equal, of one group of similar languages, or written in one script that is not Latin."""
    groups = [a.isin(*g) & b.isin(*g) for g in SIMILAR] + [a.isin(*(k for k, v in SCRIPT_OF.items() if v == s)) & b.isin(*(k for k, v in SCRIPT_OF.items() if v == s)) for s in dict.fromkeys(SCRIPT_OF.values())]
    return reduce(lambda x, y: x | y, groups, a == b)


def mismatch(text: Column, expected: Column, least: float = 0.8, longer_than: int = 50) -> Column:
    """A text of some length that is surely of another language; unknown languages pass."""
    return let(F.struct(detect(text).alias("d"), F.length(text).alias("n"), expected.alias("e")), lambda x: (x["n"] > longer_than) & (x["d"]["confidence"] >= least) & F.coalesce(~same_or_similar(x["d"]["lang"], x["e"]), F.lit(False)))


def verified(text: Column, expected: Column, least: float = 0.5) -> Column:
    """The text is of the expected language, or of a similar one, or nothing is known about it."""
    return let(F.struct(detect(text).alias("d"), expected.alias("e")), lambda x: F.when(x["d"]["lang"].isNull(), True).otherwise(same_or_similar(x["d"]["lang"], x["e"]) & (x["d"]["confidence"] >= least)))


def sentences(text: Column, least_letters: int = 40) -> Column:
    return F.filter(F.split(clean_for_detection(text), r"(?<=[.!?])\s+|\n+"), lambda x: letters(x) >= least_letters)


def purity(text: Column, expected: Column, least_letters: int = 40) -> Column:
    """The share of the judged sentences that are of the expected language; null if there is none."""
    return let(F.struct(sentences(text, least_letters).alias("s"), expected.alias("e")), lambda x: F.try_divide(F.size(F.filter(x["s"], lambda y: verified(y, x["e"]))).cast("double"), F.size(x["s"])))


def paragraph_mismatch(text: Column, expected: Column, longer_than: int = 50) -> Column:
    """The share of paragraphs of some length, code aside, that are surely of another language; null if there is none."""
    parts = F.filter(F.split(without_code(body(text)), r"\n\s*\n"), lambda p: F.length(F.trim(p)) > longer_than)
    return let(F.struct(parts.alias("p"), expected.alias("e")), lambda x: F.try_divide(F.size(F.filter(x["p"], lambda y: mismatch(y, x["e"]))).cast("double"), F.size(x["p"])))


def strong_script_evidence(text: Column, lang: str, least: float = 0.3) -> Column:
    """Enough letters of a script that only the target language's family uses."""
    script = SCRIPT_OF.get(lang)
    return F.lit(False) if script is None else ratio(F.regexp_count(text, F.lit(f"[{SCRIPTS[script]}]")), letters(text)) >= least


def suspicious_entries(entries: DataFrame, text: str, lang: str, share: float = 0.05, key: str = "tm_key") -> DataFrame:
    """A hashed sample of entries whose text is surely of another language than theirs."""
    drawn = entries.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1_000_000)) < int(share * 1_000_000))
    return drawn.filter(mismatch(F.col(text), F.col(lang), 0.85))


def overwrite_decision(old: Column, new: Column, expected: Column, margin: float = 0.05) -> Column:
    """ALLOW, BLOCK or REQUEUE of a new text over an existing one (null: none), by the languages of both."""

    def judged(x: Column) -> Column:
        good = lambda d: F.coalesce(same_or_similar(d["lang"], x["e"]), F.lit(True))
        a, b = good(x["a"]), good(x["b"])
        better = F.coalesce(x["a"]["confidence"] > x["b"]["confidence"] + margin, F.lit(False))
        return F.when(x["none"], F.when(b, "ALLOW").otherwise("BLOCK")).when(a & ~b, "BLOCK").when(a & b & better, "BLOCK").when(~a & ~b, "REQUEUE").otherwise("ALLOW")

    return let(F.struct(detect(F.coalesce(old, F.lit(""))).alias("a"), detect(new).alias("b"), expected.alias("e"), old.isNull().alias("none")), judged)


# -- write gates that know the target's language: true where the gate objects

ASCII_LINE = r"^[A-Za-z0-9\s.,;:!?\-'\"()\[\]{}@#$%^&*+=/<>|~`_\\]+$"
#: Function words of Romance and Germanic languages that give Latin runs in other scripts away.
FOREIGN_RUN = r"(?i)\b[A-Za-z]+(?: [A-Za-z]+)* (?:the|and|der|die|und|les|des|una|para|della|voor|het) [A-Za-z]+\b"
#: A scalar over several lines: its name and its indented lines.
BLOCK = r"(?m)^([A-Za-z_][A-Za-z0-9_]*): *[>|][-+]?\n((?:[ \t]+.*(?:\n|\z)|\n)+)"


def english_lines(text: Column) -> Column:
    """Lines outside code that are English in a text of another script: long prose, headings, and last cells of table rows."""
    plain = F.transform(lines(F.regexp_replace(body(text), r"(?s)```.*?(?:```|\z)", "")), lambda x: F.trim(x))
    heading = lambda x: x.rlike(r"^#{1,6}\s+[A-Za-z0-9\s.,\-_()'\"]+$")

    def cell(x: Column) -> Column:
        last = F.trim(F.regexp_replace(F.element_at(F.split(F.regexp_replace(x, r"^\|+|\|+$", ""), r"\|"), -1), r"`[^`]+`", ""))
        return let(last, lambda c: (F.length(c) >= 25) & ~c.rlike("^:?-+:?$") & c.rlike(ASCII_LINE) & let(F.split(c, r"\s+"), lambda w: (F.size(w) >= 4) & (F.size(F.filter(w, lambda y: y.rlike("^[a-z]{3,}$"))) / F.size(w) >= 0.4)))

    prose = lambda x: (F.length(x) >= 20) & ~x.rlike(r"^\{\{") & (F.size(F.split(x, r"\s+")) >= 5) & x.rlike(ASCII_LINE)
    return F.size(F.filter(plain, lambda x: F.when(x.startswith("#"), heading(x)).when(x.startswith("|") & (F.length(x) >= 20), cell(x)).when(x.startswith("|"), False).otherwise(prose(x))))


def blocks(text: Column) -> Column:
    """(name, value) of the front matter's scalars over several lines, their lines joined by spaces."""
    front = F.concat(front_matter(text), F.lit("\n"))
    both = [F.regexp_extract_all(front, F.lit(BLOCK), F.lit(k)) for k in (1, 2)]
    return F.transform(F.arrays_zip(both[0].alias("name"), both[1].alias("value")), lambda x: F.struct(x["name"].alias("name"), F.trim(F.regexp_replace(x["value"], r"\s+", " ")).alias("value")))


def scalar_lost(s: Column, t: Column, lang: Column) -> Column:
    """A scalar over several lines is gone, much shorter, or as it was."""
    least = F.when(lang.isin("zh", "ja", "ko"), 0.2).otherwise(0.5)

    def judged(x: Column) -> Column:
        def lost(b: Column) -> Column:
            kept = F.get(F.filter(x["b"], lambda y: y["name"] == b["name"]), F.lit(0))["value"]
            single = F.trim(F.call_function("regexp_extract", F.concat(F.lit("\n"), x["f"]), F.concat(F.lit(r"\n"), b["name"], F.lit(r": *([^>|\n][^\n]*)")), F.lit(1)))
            value = F.coalesce(kept, single)
            return (F.length(value) == 0) | (F.length(value) < least * F.length(b["value"])) | ((lang != "en") & (value == b["value"]))

        return F.exists(x["a"], lost)

    return let(F.struct(blocks(s).alias("a"), blocks(t).alias("b"), front_matter(t).alias("f")), judged)


def key_swallowed(s: Column, t: Column) -> Column:
    """A scalar over several lines holds a line that begins with one of the source's keys."""
    keys = F.regexp_extract_all(front_matter(s), F.lit(r"(?m)^([A-Za-z_][A-Za-z0-9_]*):"))
    values = F.regexp_extract_all(F.concat(front_matter(t), F.lit("\n")), F.lit(BLOCK), F.lit(2))
    inner = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(r"(?m)^[ \t]+([A-Za-z_][A-Za-z0-9_]*):"))))
    return F.arrays_overlap(inner, keys)


def lead_in_lost(s: Column, t: Column) -> Column:
    """A paragraph of 20 characters or more before a fenced block has become one of less than 5."""
    before = lambda x: F.transform(F.regexp_extract_all(body(x), F.lit(r"(?s)(?:\A|```[^`\n]*\n.*?```|\n)([^\n`]*)\n+```[^\n]*\n.*?```"), F.lit(1)), lambda y: F.trim(y))
    return let(F.arrays_zip(before(s).alias("a"), before(t).alias("b")), lambda z: F.exists(z, lambda p: (F.length(p["a"]) >= 20) & p["b"].isNotNull() & (F.length(p["b"]) < 5)))


def nested_field(text: Column, parent: str, name: str) -> Column:
    return F.regexp_replace(F.regexp_extract(front_matter(text), rf"(?m)^{parent}:[ \t]*\n(?:[ \t]+.*\n)*?[ \t]+{name}: *(.*)$", 1), r"^[\"']|[\"']$", "")


def seo_damaged(s: Column, t: Column) -> Column:
    """A title's separator is gone, or there are more keywords by two and by half."""
    separator = r"\s[|–—-]\s"
    listed = lambda x: F.size(F.filter(F.split(field(x, "keywords"), ","), lambda k: F.trim(k) != ""))
    return (field(s, "title").rlike(separator) & ~field(t, "title").rlike(separator)) | ((listed(t) >= listed(s) + 2) & (listed(t) >= 1.5 * listed(s)) & (listed(s) > 0))


def headings_untranslated(s: Column, t: Column, lang: Column) -> Column:
    """With equal numbers of headings, a heading of several words is left as it was in a language of another script."""
    heads = lambda x: F.regexp_extract_all(without_code(x), F.lit(r"(?m)^#{1,6} (.*)$"))
    return lang.isin(*NON_LATIN) & let(F.struct(heads(s).alias("a"), heads(t).alias("b")), lambda x: (F.size(x["a"]) == F.size(x["b"])) & F.exists(F.arrays_zip(x["a"].alias("a"), x["b"].alias("b")), lambda p: (p["a"] == p["b"]) & p["a"].rlike(r"[a-z]{3,} [A-Za-z]{3,}")))


Gate = Callable[[Column, Column, Column], Column]
LANGUAGE_GATES: dict[str, Gate] = {
    "language_mismatch": lambda s, t, lang: mismatch(clean_for_detection(t), lang, 0.8, 0),
    "file_purity": lambda s, t, lang: F.coalesce(paragraph_mismatch(t, lang) > 0.1, F.lit(False)),
    "soft_contamination": lambda s, t, lang: F.coalesce(paragraph_mismatch(t, lang) > 0.02, F.lit(False)),
    "heading_integrity": headings_untranslated,
    "mixed_language": lambda s, t, lang: lang.isin(*NON_LATIN) & (english_lines(t) > 3),
    "description_reverted": lambda s, t, lang: lang.isin(*NON_LATIN) & (F.length(F.trim(field(s, "description"))) >= 20) & F.trim(field(t, "description")).rlike(r"^[\x00-\x7F]+$"),
    "multiline_scalar": scalar_lost,
    "script_run": lambda s, t, lang: lang.isin(*NON_LATIN) & F.exists(F.split(without_code(body(t)), PROTECTED, -1), lambda p: p.rlike(FOREIGN_RUN)),
    "stale_hash": lambda s, t, lang: (nested_field(s, "provenance", "content_hash") != "") & (nested_field(t, "provenance", "content_hash") != "") & (nested_field(s, "provenance", "content_hash") != nested_field(t, "provenance", "content_hash")),
    "lead_in": lambda s, t, lang: lead_in_lost(s, t),
    "seo": lambda s, t, lang: seo_damaged(s, t),
    "page_language": lambda s, t, lang: mismatch(clean_for_detection(body(t)), lang, 0.85, 50),
    "key_leak": lambda s, t, lang: key_swallowed(s, t),
}


def brand_missing(brands: tuple[str, ...], fields: tuple[str, ...] = ("title", "head_title", "seoTitle")) -> Gate:
    """A brand's name that a title of the source holds is not in the translation's."""
    has = lambda x, b: F.contains(F.lower(x), F.lit(b.lower()))
    return lambda s, t, lang: reduce(lambda a, b: a | b, (has(field(s, f), b) & ~has(field(t, f), b) for f in fields for b in brands))


def title_drift(is_index: Column) -> Gate:
    """An index page's title must stay what it is."""
    return lambda s, t, lang: is_index & (F.trim(field(s, "title")) != "") & front_matter(t).rlike("(?m)^title:") & (F.trim(field(s, "title")) != F.trim(field(t, "title")))


def ignored_field_present(fields: tuple[str, ...]) -> Gate:
    return lambda s, t, lang: front_matter(t).rlike(rf"(?m)^(?:{'|'.join(fields)}):")


def other_identifier_named(pattern: str) -> Gate:
    """The translated description names an identifier that the source's page does not."""
    return lambda s, t, lang: F.size(F.array_except(F.regexp_extract_all(field(t, "description"), F.lit(f"({pattern})")), F.regexp_extract_all(s, F.lit(f"({pattern})")))) > 0


def restore_identifiers(s: Column, t: Column, pattern: str, fields: tuple[str, ...] = ("title", "linkTitle")) -> Column:
    """The translation with fields set back to the source's value where that is a protected identifier."""
    out = t
    for f in fields:
        line, own = rf"(?m)^{f}: *.*$", F.regexp_extract(front_matter(s), rf"(?m)^({f}: *.*)$", 1)
        quoted = F.regexp_replace(own, r"([\\$])", r"\\$1")
        head = F.regexp_extract(out, r"(?s)\A(---\n.*?\n---\n)", 1)
        fixed = F.concat(F.regexp_replace(head, F.lit(line), quoted), F.substr(out, F.length(head) + 1))
        out = F.when(field(s, f).rlike(f"^(?:{pattern})$") & (field(s, f) != field(t, f)), fixed).otherwise(out)
    return out


def without_adjacent_links(text: Column) -> Column:
    """A link that stands twice in a row stands once."""
    return F.regexp_replace(text, r"(\*{0,2}\[[^\]\n]+\]\([^)\n]+\)\*{0,2})[ \t]*\1", "$1")


def language_gate_report(pairs: DataFrame, source: str, translation: str, lang: str, names: tuple[str, ...] | None = None) -> DataFrame:
    """gates: the names of all these gates that object, in order."""
    s, t = (F.coalesce(F.col(c), F.lit("")) for c in (source, translation))
    return pairs.withColumn("gates", F.array_compact(F.array(*(F.when(LANGUAGE_GATES[n](s, t, F.col(lang)), n) for n in names or LANGUAGE_GATES))))
