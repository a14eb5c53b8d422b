"""Secret scan: candidates, and a random forest that removes false positives. DataFrame functions only on the main path.

A candidate is one of: a run of 16 or more of the characters that keys are written in, within a word, unless it has neither a letter
nor a digit; a value of 8 or more characters that is assigned to a name which speaks for a secret, whatever it is made of; the first
line of a private key. Its features are its length, its shares of digits and upper case, transitions between character classes
and common letter pairs, its entropy, what share of it dictionary words cover, known prefixes, the words before and after it, whether
something is assigned to it, whether its name speaks for it, and its path.

The forest is grown on the driver from labelled findings (a bounded table, by default the built-in ones), whose features come from the
same expressions, and becomes one SQL expression, so scoring needs no Python. A finding counts if the trees' mean is ``LEAST`` or more.

Defined results. Null text or path: no candidates, an empty path. Empty tables give empty ones. A candidate that repeats is a finding
at each place; equal rows have equal findings. Long texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import random
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm.common import Scratch

LEAST, TREES, DEPTH = 0.5, 25, 6
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Words that dictionary coverage counts, prefixes of issued keys, and words that speak for or against a secret.
DICTIONARY = ("about", "access", "after", "again", "alpha", "already", "application", "article", "because", "before", "between", "button", "child", "class", "client", "code", "commit", "common", "complete", "component", "config", "content", "context", "control", "count", "country", "create", "data", "default", "description", "development", "different", "document", "driver", "element", "entry", "error", "event", "example", "field", "file", "find", "first", "format", "function", "general", "google", "group", "handler", "header", "history", "house", "http", "image", "import", "index", "information", "input", "instance", "interface", "international", "internal", "issue", "item", "language", "large", "learn", "license", "line", "link", "list", "local", "machine", "management", "message", "method", "model", "module", "name", "national", "network", "number", "object", "open", "option", "order", "output", "package", "page", "parameter", "party", "people", "place", "point", "policy", "private", "process", "product", "program", "property", "public", "query", "question", "read", "record", "release", "request", "resource", "response", "result", "right", "sample", "school", "script", "section", "security", "select", "server", "service", "session", "simple", "site", "source", "standard", "start", "state", "static", "string", "style", "support", "system", "table", "template", "test", "text", "time", "title", "type", "update", "user", "value", "version", "view", "water", "width", "window", "word", "work", "world", "write", "year")
PREFIXES = ("-----BEGIN ", "AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk_live_", "rk_live_", "sk-", "xoxb-", "xoxp-", "npm_", "pypi-", "eyJ", "SG.")
FOR = ("token", "secret", "passw", "pwd", "apikey", "api_key", "api-key", "auth", "bearer", "credential", "private", "access_key", "client_key", "key")
AGAINST = ("commit", "sha1", "sha256", "sha-", "md5", "checksum", "digest", "integrity", "etag", "uuid", "guid", "revision", "hash", "blob", "image", "base64", "fingerprint", "build", "http", "href", "src=")
PATHS = ("test", "example", "fixture", "mock", "sample", "lock", "vendor", "snapshot", "changelog")
FEATURES = ("length", "digits", "upper", "switches", "cases", "pairs", "vowels", "entropy", "covered", "hexadecimal", "prefix", "speaks_for", "speaks_against", "assigned", "named", "in_tests")


#: A value behind a mark of assignment, in quotes or not, that takes up the rest of a word.
VALUE = r"(?:^|[=:>(]|[\"'`])([^\s\"'`=:,;<>(){}\[\]]{8,})[\"'`,;.)}\]]*$"
#: A name that speaks for a secret, and a mark of assignment at the end.
NAMED = r"(?i)(?:(?:token|secret|passw[a-z]*|passphrase|pwd|api[_-]?key|(?:access|client|private)[_-]?key|private|credential|bearer)s?|(?<![A-Za-z])(?:key|auth))(?:[_.-][A-Za-z0-9_.-]*)?[\"'`\]]*\s*(?:=>|:=|=|:)\s*[\"'`(]*$"


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(id, place, secret, before, after, path): place counts words from 0."""
    words = F.split(text, r"[\x20\x09-\x0D]+")
    word, last = (lambda i: F.get("words", i)), (lambda i: F.get("words", i - 1))
    mark = lambda w: F.endswith(w, F.lit("=")) | F.endswith(w, F.lit(":")) | F.endswith(w, F.lit(">"))
    # long words, words with or behind a mark of assignment, and the first words of private keys
    may = lambda i: (F.length(word(i)) >= 8) & ((F.length(word(i)) >= 16) | F.contains(word(i), F.lit("=")) | F.contains(word(i), F.lit(":")) | F.coalesce(mark(last(i)), F.lit(False)) | F.endswith(word(i), F.lit("-----BEGIN")))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), may)
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), words.alias("words")).filter("words is not null")
    rows = rows.select("id", "path", "words", F.explode(at).alias("place"))
    near = lambda d: F.coalesce(F.get("words", F.col("place") + d), F.lit(""))
    rows = rows.select("id", "path", "place", near(0).alias("word"), F.concat_ws(" ", near(-3), near(-2), near(-1)).alias("before"), near(1).alias("after"), F.concat_ws(" ", *(near(d) for d in range(5))).alias("line"))
    runs = F.regexp_extract_all("word", F.lit(f"({RUN})"))
    # signs behind a run that could be a key are no part of it
    value = F.regexp_replace(F.regexp_extract("word", VALUE, 1), rf"^({RUN})[!*&#$?~^|]+$", "$1")
    rows = rows.select("*", runs.alias("runs"), value.alias("value"))
    # what stands between the name and the value: the word up to the value
    head = F.concat_ws(" ", "before", F.left("word", F.greatest(F.position("value", "word") - 1, F.lit(0))))
    assigned = F.when((F.col("value") != "") & head.rlike(NAMED), F.array("value")).otherwise(F.array().cast("array<string>"))
    private = F.regexp_extract("line", r"^(-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----)", 1)
    found = F.when(private != "", F.array(private)).otherwise(F.array_distinct(F.concat(assigned, F.filter("runs", lambda r: ~F.exists(assigned, lambda v: F.contains(v, r))))))
    rows = rows.select("id", "path", "place", "word", "before", "after", F.explode(found).alias("secret")).filter(F.col("secret").rlike("[A-Za-z0-9]"))
    head = F.left("word", F.greatest(F.position("secret", "word") - 1, F.lit(0)))
    return rows.withColumn("before", F.right(F.concat_ws(" ", "before", head), F.lit(80))).withColumn("after", F.left("after", F.lit(40))).select("id", "place", "secret", "before", "after", "path")


def features(rows: DataFrame) -> DataFrame:
    """rows with FEATURES, as doubles."""
    s, n, low = F.col("secret"), F.length("secret"), F.lower("secret")
    share = lambda c: c / n
    count = lambda p, x=s: F.regexp_count(x, F.lit(p))
    has = lambda x, words: F.when(F.lower(x).rlike("|".join(w.replace("-", r"\-") for w in words)), 1.0).otherwise(0.0)
    chars = F.split(s, "")
    each = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(F.split(s, ""), lambda d: d == c)) / n)
    values = {
        "length": F.least(n, F.lit(400)),
        "digits": share(count("[0-9]")),
        "upper": share(count("[A-Z]")),
        "switches": share(count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")),
        "cases": share(count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z]{2})(?=[a-z])")),
        "pairs": share(count("(?=th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|nt|ng|se|ha|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur|ei)", low)),
        "vowels": share(count("[aeiouy]", low)),
        "entropy": F.aggregate(each, F.lit(0.0), lambda a, p: a - p * F.log2(p)),
        "covered": 1 - F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "hexadecimal": F.when(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 1.0).otherwise(0.0),
        "prefix": F.when(s.rlike("^(?:" + "|".join(p.replace(".", r"\.").replace("-", r"\-") for p in PREFIXES) + ")"), 1.0).otherwise(0.0),
        "speaks_for": has(F.col("before"), FOR),
        "speaks_against": has(F.concat_ws(" ", "before", "after"), AGAINST),
        "assigned": F.when(F.col("before").rlike(r"(?:=|:|=>|:=)[\s\"'`]*$"), 1.0).otherwise(0.0),
        "named": F.when(F.col("before").rlike(NAMED), 1.0).otherwise(0.0),
        "in_tests": has(F.col("path"), PATHS),
    }
    return rows.select("*", *(values[f].cast("double").alias(f) for f in FEATURES))


# -- the forest


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list:
    """Trees as nested (feature, threshold, low, high) with shares of label 1 at the leaves; rows are drawn with replacement for each
    tree, a root's number of features for each split."""
    draw = random.Random(seed)
    wide = max(1, round(len(FEATURES) ** 0.5))

    def node(rows: np.ndarray, left: int):
        share = float(y[rows].mean())
        if left == 0 or len(rows) < 6 or share in (0.0, 1.0):
            return share
        best = None
        for f in draw.sample(range(x.shape[1]), wide):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            values, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(values[1:] > values[:-1])
            if not len(cut):
                continue
            a, b = cut + 1.0, len(rows) - cut - 1.0
            p, q = ones[cut] / a, (ones[-1] - ones[cut]) / b
            impurity = a * p * (1 - p) + b * q * (1 - q)
            k = int(impurity.argmin())
            if best is None or impurity[k] < best[0]:
                best = float(impurity[k]), f, float((values[cut[k]] + values[cut[k] + 1]) / 2)
        if best is None:
            return share
        _, f, t = best
        low = x[rows, f] <= t
        return f, t, node(rows[low], left - 1), node(rows[~low], left - 1)

    return [node(np.array(draw.choices(range(len(y)), k=len(y))), depth) for _ in range(trees)] if len(y) else [0.0]


def as_sql(tree) -> str:
    """A tree as a SQL expression over FEATURES."""
    if isinstance(tree, float):
        return f"{tree:.6f}D"
    f, t, low, high = tree
    return f"if({FEATURES[f]} <= {t!r}D, {as_sql(low)}, {as_sql(high)})"


@cache
def builtin_findings(count: int = 3000, seed: int = 5) -> tuple[tuple, ...]:
    """(secret, before, after, path, label): findings as scanners report them, labelled, from rules and a seed."""
    draw = random.Random(seed)
    hexa, alnum, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    run = lambda chars, n: "".join(draw.choices(chars, k=n))
    word = lambda: draw.choice(DICTIONARY)
    junk = lambda: "".join(run("bcdfghklmnprstvz", 1) + run("aeiou", 1) + (run("nrst", 1) if draw.random() < 0.4 else "") for _ in range(draw.randint(1, 3)))
    plain = lambda: draw.choice((word, junk))()
    rows = []
    for i in range(count):
        secret = i % 2 == 0
        path = draw.choice(("src1", "src7", "app/settings.py", "deploy/values.yaml", "notes.txt", "web/page.html", "src/main.go", "")) if secret or draw.random() < 0.6 else draw.choice(("tests/fixtures/a.json", "package-lock.json", "vendor/lib.js", "examples/sample.md", "CHANGELOG.md"))
        before, after = f"{plain()} {plain()} {plain()}", plain()
        if secret:
            kind = draw.random()
            if kind < 0.3:  # issued keys, also without a word about them
                value = draw.choice(PREFIXES[1:-2]) + run(draw.choice((alnum, hexa, base)), draw.randint(16, 40))
            elif kind < 0.34:
                value = f"-----BEGIN {draw.choice(('', 'RSA ', 'EC ', 'OPENSSH '))}PRIVATE KEY-----"
            elif kind < 0.6:  # what people choose
                value = draw.choice(("".join(word() for _ in range(draw.randint(2, 5))), "".join(plain() for _ in range(draw.randint(3, 6))), word() + str(draw.randint(1, 9999)), junk() + junk() + draw.choice("!#$%") + run("0123456789", 2), word().capitalize() + "-" + word() + str(draw.randint(1, 99)), run(alnum, draw.randint(8, 15))))
                value = value if len(value) >= 8 else value + word()
            else:
                value = draw.choice((run(hexa, draw.choice((32, 40, 64))), run(hexa, 40).upper(), run(alnum, draw.randint(20, 48)), run(base, draw.randint(24, 64)) + draw.choice(("", "=", "=="))))
            name = draw.choice(FOR)
            name = name.upper() if draw.random() < 0.3 else name
            mark = draw.choice((f"{name} = \"", f"{name}: ", f"{name}=", f"{word()}_{name} = '", f"\"{name}\": \"", f"{name} := ", f"{name} => '"))
            if kind >= 0.6 and draw.random() < 0.15:
                mark = f"{name} \""
            if kind < 0.34 and draw.random() < 0.7:
                mark = ""
            before = f"{before} {mark}".strip()
        else:
            kind = draw.randrange(12)
            if kind == 0:
                value, before = run(hexa, draw.choice((32, 40, 64))), f"{plain()} {draw.choice(AGAINST[:16])} {draw.choice(('', '=', ':'))}".strip()
            elif kind == 1:
                value = "-".join(run(hexa, k) for k in (8, 4, 4, 4, 12))
            elif kind == 2:
                value = draw.choice("_-/").join(plain() for _ in range(draw.randint(3, 6)))
            elif kind == 3:
                value = "".join(plain().capitalize() for _ in range(draw.randint(3, 5)))
            elif kind == 4:
                value, before = run(base, draw.randint(40, 300)), f"{word()} image base64"
            elif kind == 5:
                value, before = f"{plain()}_{plain()}_{plain()}_{draw.randint(0, 9999)}", f"{draw.choice(('name', 'id', 'field', 'topic'))} ="
            elif kind == 6:
                value = draw.choice(("-", "=", "_")) * draw.randint(4, 20) + plain() + draw.choice(("-", "_")) * draw.randint(10, 20)
            elif kind == 7:
                value, before = draw.choice(("x" * draw.randint(8, 50), "your_" + word() + "_token_here", "example_" + word() + "_key", "0123456789abcdef0123456789abcdef", "changeme-changeme-changeme", "<redacted>", "{{" + word().upper() + "}}", "process.env." + word().upper())), f"{plain()} {draw.choice(FOR)} ="
            elif kind == 8:
                value = f"{junk()}{junk()}{junk()}{draw.randint(0, 99)}{junk()}"
            elif kind == 9:  # long words of one case, and repeats
                value = draw.choice((lambda: "".join(plain() for _ in range(draw.randint(3, 8))), lambda: "".join(plain() for _ in range(4)).upper(), lambda: draw.choice("abxz") * draw.randint(16, 90)))()
            elif kind == 10:  # long numbers
                value = run("0123456789", draw.randint(16, 24))
            else:  # plain words behind a name that only looks like one
                value, before = plain() + plain() + plain(), f"{plain()} {draw.choice(('the keyword:', 'Note:', 'keyword:', 'author:', 'monkey ='))}"
            value = value if len(value) >= 16 or kind in (7, 11) else value + "_" + word() + "_" + word()
        rows.append((value, before, after, path, int(secret)))
    return tuple(rows)


def labelled(spark: SparkSession, rows: tuple[tuple, ...]) -> DataFrame:
    """Labelled findings as an inline table."""
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join(f"({', '.join(map(quoted, r))})" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(secret, before, after, path, label)")


def train(findings: DataFrame) -> Column:
    """The score of a row with FEATURES; findings: (secret, before, after, path, label), a bounded table."""
    rows = features(findings).select(*FEATURES, "label").collect()
    x, y = np.array([r[:-1] for r in rows], float).reshape(-1, len(FEATURES)), np.array([r[-1] for r in rows], float)
    trees = grow(x, y)
    return F.expr(f"({' + '.join(map(as_sql, trees))}) / {len(trees)}D")


def held_out_quality(findings: DataFrame, parts: int = 5, least: float = LEAST) -> tuple[float, float]:
    """(recall, precision) on every parts-th finding by a hash of its secret, of a forest grown from the others."""
    part = F.crc32(F.encode("secret", "UTF-8")) % parts == 0
    scored = features(findings.filter(part)).withColumn("score", train(findings.filter(~part)))
    hit, said, real = scored.agg(*(F.sum(F.when(c, 1).otherwise(0)) for c in ((F.col("score") >= least) & (F.col("label") == 1), F.col("score") >= least, F.col("label") == 1))).first()
    return (hit or 0) / max(1, real or 0), (hit or 0) / max(1, said or 0)


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source", least: float = LEAST) -> DataFrame:
    """(key, place, secret, length, score): the findings that the forest leaves, place in words."""
    score = train(labelled(docs.sparkSession, builtin_findings()) if findings is None else findings)
    found = Scratch(docs.sparkSession, "secrets").put("candidates", candidates(docs, key, text, path))
    scored = features(found).withColumn("score", F.round(score, 6)).filter(F.col("score") >= least)
    return scored.select(F.col("id").alias(key), "place", "secret", F.length("secret").alias("length"), "score")
