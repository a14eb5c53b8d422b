"""Text as column expressions: normal forms, keys, tokens, n-grams, scripts, and two Arrow functions where the JVM has none."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

#: Letters of each script as a character class.
SCRIPTS = {
    "arabic": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}",
    "cyrillic": r"\x{0400}-\x{04FF}",
    "hebrew": r"\x{0590}-\x{05FF}",
    "chinese": r"\x{4E00}-\x{9FFF}",
    "japanese": r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}",
    "korean": r"\x{AC00}-\x{D7AF}",
    "devanagari": r"\x{0900}-\x{097F}",
    "thai": r"\x{0E00}-\x{0E7F}",
}
#: The script of each language that is not written in Latin letters.
SCRIPT_OF = {"ar": "arabic", "fa": "arabic", "ur": "arabic", "ru": "cyrillic", "uk": "cyrillic", "bg": "cyrillic", "sr": "cyrillic", "he": "hebrew", "zh": "chinese", "ja": "japanese", "ko": "korean", "hi": "devanagari", "th": "thai"}


@pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode normal form C, which the JVM's functions lack; only for text that is not ASCII, see ``normalise``."""
    import unicodedata

    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def let(value: Column, use) -> Column:
    """use(value), where value is computed once for each row however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalise(text: Column, composed: bool = False) -> Column:
    """NFC, runs of space as one, trimmed. composed: the text is known to be NFC, so all stays in the JVM."""
    return collapse(text if composed else nfc(text))


def text_hash(text: Column, composed: bool = False) -> Column:
    return F.md5(F.encode(normalise(text, composed), "UTF-8"))


def memory_key(site: Column, source: Column, target: Column, text: Column, field: Column | None = None, context: Column | None = None, composed: bool = False) -> Column:
    """site[:field]:source:target:md5 of the normal form; the context goes before the text, a zero byte between."""
    full = text if context is None else F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\x00"), text)).otherwise(text)
    hashed = text_hash(full, composed)
    plain = F.concat_ws(":", site, source, target, hashed)
    return plain if field is None else F.when(F.coalesce(field, F.lit("")) != "", F.concat_ws(":", site, field, source, target, hashed)).otherwise(plain)


def edit_distance(a: Column, b: Column, most: int = 200) -> Column:
    """Of the first ``most`` characters."""
    return F.levenshtein(F.left(a, F.lit(most)), F.left(b, F.lit(most)))


def estimated_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, marks, digits and underscores."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}_]+", " "), " "), lambda w: w != "")


def ngrams(words: Column, n: int) -> Column:
    """Joined runs of n words; none if there are fewer."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def ngram_hashes(words: Column, n: int) -> Column:
    """64-bit hashes of the runs of n words, for counting; none if there are fewer."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))).otherwise(F.array().cast("array<bigint>"))


def largest_count(values: Column, hashed: bool = False) -> Column:
    """How often the most frequent element occurs: the longest run of the sorted array. hashed: the elements are 64-bit hashes."""
    step = lambda s, v: let(F.when(s["last"] == v, s["run"] + 1).otherwise(1), lambda run: F.struct(F.greatest(s["best"], run).alias("best"), run.alias("run"), v.alias("last")))
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("run"), (F.lit(0).cast("bigint") if hashed else F.lit("")).alias("last"))
    return F.aggregate(F.sort_array(values), start, step)["best"]


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{L}"))


def script_ratio(text: Column, script: str) -> Column:
    """Letters of a script among all letters."""
    return ratio(F.regexp_count(text, F.lit(f"[{SCRIPTS[script]}]")), letters(text))


def ascii_prose(text: Column, least: float = 0.85) -> Column:
    return ratio(F.regexp_count(text, F.lit("[A-Za-z]")), letters(text)) > least


def technical_density(text: Column, terms: tuple[str, ...]) -> Column:
    """Words of known terms among all words, 1 at most."""
    hits = reduce(lambda a, b: a + b, (F.regexp_count(F.lower(text), F.lit(rf"(?<![\p{{L}}\p{{N}}]){t.lower()}(?![\p{{L}}\p{{N}}])")) * len(t.split()) for t in terms))
    return F.least(F.lit(1.0), ratio(hits, F.size(tokens(text))))


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, trimmed, without a leading front matter."""
    body = F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")
    return F.filter(F.transform(F.split(body, r"\n\s*\n"), lambda p: collapse(p)), lambda p: p != "")


def paragraph_hashes(text: Column, least: int = 40) -> Column:
    return F.transform(F.filter(paragraphs(text), lambda p: F.length(p) >= least), lambda p: F.substring(F.sha2(p, 256), 1, 16))


def has_duplicate_run(text: Column) -> Column:
    """Three equal paragraphs in a row."""
    p = paragraphs(text)
    return F.when(F.size(p) >= 3, F.exists(F.sequence(F.lit(0), F.size(p) - 3), lambda i: (F.get(p, i) == F.get(p, i + 1)) & (F.get(p, i) == F.get(p, i + 2)))).otherwise(F.lit(False))


def cell_id(*parts: Column) -> Column:
    """sha256 of the parts with zero bytes between."""
    return F.sha2(F.concat_ws("\x00", *parts), 256)


def unit_fingerprint(kind: Column, text: Column) -> Column:
    return F.concat_ws(":", kind, F.substring(F.sha2(text, 256), 1, 16), F.length(text).cast("string"))


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's similarity, which the JVM has not."""
    from difflib import SequenceMatcher

    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x.strip(), y.strip()).ratio() for x, y in zip(a, b, strict=True)])


@pandas_udf(StringType())
def repair_mojibake(text: pd.Series) -> pd.Series:
    """Text whose UTF-8 was read as Windows-1252, read again; as it is where that does not work."""

    def repaired(t: str | None) -> str | None:
        try:
            return t if t is None or not any(c in t for c in "ÃÂâ") else t.encode("cp1252").decode("utf-8")
        except UnicodeError:
            return t

    return text.map(repaired)


def invisible_removed(text: Column, source: Column) -> Column:
    """Without zero-width and direction marks that the source does not hold."""
    marks = "\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
    return reduce(lambda t, m: F.when(F.contains(source, F.lit(m)), t).otherwise(F.translate(t, m, "")), marks, text)


def needs_space(before: Column, after: Column) -> Column:
    """Two letters or digits that would be glued, unless one is of a script written without spaces."""
    word, glued = r"[\p{L}\p{N}]", rf"[{SCRIPTS['chinese']}{SCRIPTS['japanese']}{SCRIPTS['thai']}]"
    return before.rlike(word) & after.rlike(word) & ~before.rlike(glued) & ~after.rlike(glued)


def duration_text(seconds: Column) -> Column:
    """As 2h 5m, 3m 4s or 12.5s."""
    whole = F.floor(seconds).cast("long")
    h, m, s = (whole / 3600).cast("long"), (whole % 3600 / 60).cast("long"), whole % 60
    return F.when(seconds < 60, F.concat(F.format_number(seconds, 1), F.lit("s"))).when(seconds < 3600, F.concat(m.cast("string"), F.lit("m "), s.cast("string"), F.lit("s"))).otherwise(F.concat(h.cast("string"), F.lit("h "), m.cast("string"), F.lit("m")))
