"""Markdown written back, gates that know the language, and records: by hand and by brute force."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lumenfold.operators import language, markup, quality, records
from lumenfold.operators.documents import parse_units


def one(spark, *columns, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(*columns).first()


PAGE = """---
title: "The Page"
tags: [a, b]
---
# Head *one*

First para
goes on.
- item a
  - item b

| a | b |
|---|---|
| 1 |  2 |

> said

```py
# no heading
```

{{< note >}}

Last | one
"""


def test_units_put_back_are_the_document():
    draw = random.Random(1)
    pieces = ["# Head", "para one", "  - item", "", "```", "| a | b |", "|---|---|", "> q", "{{< x >}}", "1. one", "   ", "---", "\ttab", "~~~", "key: value"]
    for text in [PAGE, "", "---\n", "---\na: b\n---\nx", *("\n".join(draw.choices(pieces, k=draw.randint(1, 14))) for _ in range(300))]:
        found = list(markup.unit_spans(text))
        assert markup.put_in(text, {a: text[b:e] for a, _, b, e in found}) == text
        assert all(text[b:e] == text[b:e].strip() for _, _, b, e in found) and len({a for a, *_ in found}) == len(found)
        again = markup.put_in(text, {a: text[b:e] + "" for a, _, b, e in found[:1]})
        assert again == text


def test_units_stand_where_parsing_finds_them():
    mine = {a: PAGE[b:e] for a, _, b, e in markup.unit_spans(PAGE)}
    assert mine == {a: t for a, k, t, *_ in parse_units(PAGE) if k not in ("code", "shortcode")}
    assert mine["front.title"] == "The Page" and mine["para[0]"] == "First para\ngoes on." and mine["cell[3]"] == "2"
    new = markup.put_in(PAGE, {"heading[0]": "Kopf", "cell[2]": "eins", "front.title": "Die Seite", "gone[7]": "x"})
    assert "# Kopf\n" in new and "| eins |  2 |" in new and 'title: "Die Seite"' in new and "# no heading" in new


def test_translations_go_to_their_documents(spark):
    docs = spark.createDataFrame([(1, PAGE), (2, "plain"), (3, None)], "doc_id long, text string")
    units = spark.createDataFrame([(1, "heading[0]", "Kopf"), (1, "para[0]", None), (2, "para[0]", "schlicht"), (9, "para[0]", "x")], "doc_id long, addr string, translation string")
    got = {r.doc_id: r.rebuilt for r in markup.apply_translations(docs, units).collect()}
    assert got[1] == PAGE.replace("Head *one*", "Kopf") and got[2] == "schlicht" and got[3] is None
    leaf = docs.filter("doc_id = 1").select(*(markup.sole_leaf(markup.spans("text"), F.lit(x)).alias(x) for x in ("front", "heading", "para", "quote[0]", "none"))).first()
    assert leaf.asDict() == {"front": "MANY", "heading": "ONE", "para": "MANY", "quote[0]": "ONE", "none": "NONE"}


def test_nested_values(spark):
    data = {"a": {"b": [{"c": 1}, {"c": None}, {"c": {"d": "x"}}, 5]}, "e": [[1]]}
    assert markup.nested_values(data, "a.b.c") == [("a.b[0].c", 1), ("a.b[2].c", {"d": "x"})]
    assert markup.nested_values(data, "a.b.c.d") == [("a.b[2].c.d", "x")] and markup.nested_values(data, "z") == []
    for path, value in markup.nested_values(data, "a.b.c"):
        assert markup.nested_values(markup.with_nested_value(json.loads(json.dumps(data)), path, "new"), "a.b.c")[0 if "[0]" in path else 1] == (path, "new")
    with pytest.raises((KeyError, IndexError)):
        markup.with_nested_value(data, "a.b[9].c", 1)
    rows = spark.createDataFrame([(json.dumps(data),), (None,), ("{}",)], "r string")
    got = rows.select(markup.nested(F.col("r"), "a.b.c").alias("v"), markup.with_nested(F.col("r"), "a.b[0].c", F.lit("ä")).alias("w")).collect()
    assert [len(r.v) if r.v is not None else None for r in got] == [2, None, 0] and got[1].w is None and got[2].w == "{}" and json.loads(got[0].w)["a"]["b"][0]["c"] == "ä"


def test_front_matter_reads_back(spark):
    values = {"b": "plain", "a": "with: colon", "c": "- item\n- more", "d": "", "e": "# no", "f": 'quo"te: x'}
    text = one(spark, markup.front_matter_text(F.create_map(*(F.lit(x) for kv in values.items() for x in kv))).alias("x"), z=1).x
    assert text == '---\na: "with: colon"\nb: plain\nc: |-\n  - item\n  - more\nd: ""\ne: "# no"\nf: "quo\\"te: x"\n---\n'
    row = one(spark, *(markup.literal_style(F.lit(v)).alias(f"k{i}") for i, v in enumerate(("a\nb", "- a\n- b", "a\n\nb", "1. x\ny", "- a"))), z=1)
    assert tuple(row) == (False, True, True, True, False)


def test_fences_and_code(spark):
    t = "a\n```py\nx\n```\nb\n```\nopen"
    row = spark.createDataFrame([(t,)], "t string").select(markup.fence_spans("t").alias("s"), markup.reopened_fences(F.lit("```\na\n```py\nb\n```\n")).alias("r")).first()
    assert [t[a:b] for a, b in row.s] == ["```py\nx\n```", "```\nopen"] and row.r == 1
    got = one(spark, markup.inline_code_restored(F.lit("use `a` and `b`"), F.lit("nimm `á` und `б`")).alias("x"), markup.inline_code_restored(F.lit("use `a`"), F.lit("nimm")).alias("y"), z=1)
    assert got.x == "nimm `a` und `b`" and got.y is None


def test_repeats_are_dropped_but_not_between_headings(spark):
    p, q = "This paragraph is said again and again by mistake.", "Returns the same instance for chaining of calls."
    text = f"---\na: b\n---\n{p}\n\nx\n\n{p}\n\n```\n{p}\n```\n\n{p}\n\n# A\n\n{q}\n\n# B\n\n{q}\n\n# C\n\n{q}\n"
    got = spark.createDataFrame([(text,), (None,), ("short",)], "t string").select(markup.without_repeats("t").alias("x")).collect()
    assert got[0].x.count(p) == 2 and got[0].x.count(q) == 3 and got[0].x.startswith("---\na: b\n---\n") and got[1].x is None and got[2].x == "short"
    links = one(spark, language.without_adjacent_links(F.lit("see [a](b) [a](b) and **[c](d)****[c](d)**, [a](b)")).alias("x"), z=1).x
    assert links == "see [a](b) and **[c](d)**, [a](b)"


def test_checks_of_files(spark):
    s, t = "use System.Text here and my_name too", "nutze dieSystem.Text hier und my_name auch"
    row = one(spark, markup.glued_identifiers(F.lit(s), F.lit(t)).alias("g"), F.size(markup.placement(F.lit("content/de/x.md"), F.lit("de"))).alias("ok"), F.size(markup.placement(F.lit("static/fr/../x.txt"), F.lit("de"))).alias("bad"), F.size(markup.protected_fields(F.lit("---\na: 1\nb: 2\n---\n"), F.lit("---\na: 2\nb: 2\nc: 3\n---\n"), {"a": "passthrough", "b": "passthrough", "c": "ignore", "d": "translate"})).alias("modes"), z=1)
    assert row.g == ["System.Text"] and (row.ok, row.bad, row.modes) == (0, 4, 2)
    yaml = one(spark, *(F.transform(markup.yaml_fields(F.lit("---\na: 1\nb: 2\n---\n"), F.lit(x)), lambda i: i["message"]).alias(f"k{k}") for k, x in enumerate(("---\na: 1\nb: 2\n---\n", "---\na:1\nc: 2\n---\n", "---\na: 1\n"))), z=1)
    assert yaml.k0 == [] and set(yaml.k1) == {"a key without a space behind it", "keys lost", "new keys"} and "front matter does not end" in yaml.k2
    far = one(spark, *(F.size(F.filter(markup.similarity_issue(F.lit(c), F.lit(n)), lambda i: i["severity"] == v)).alias(f"k{k}") for k, (c, n, v) in enumerate(((0.39, 200, "ERROR"), (0.39, 199, "ERROR"), (0.5, 300, "WARNING"), (0.55, 300, "WARNING")))), z=1)
    assert tuple(far) == (1, 0, 1, 0)
    r = one(spark, markup.intake_failures(F.lit("Preserve all formatting"), F.lit("```\nx\n```"), F.lit(True), F.lit(False), "Preserve all formatting").alias("x"), z=1).x
    assert r == ["R2", "R1", "R3"]


# -- gates


def test_double_periods_in_prose_only(spark):
    keep = "see [x](../y.md), `1..5`, ../up/../two, http://a.b/c..d, {{< r a..b >}} <a href='x..y'> wait... ```\nfor 1..3\n```"
    row = one(spark, quality.REPAIRS["double_periods"](F.lit(keep + " End.. So")).alias("x"), quality.GATES["double_periods"](F.lit("a"), F.lit(keep)).alias("no"), quality.GATES["double_periods"](F.lit("a"), F.lit("End.. So")).alias("yes"), z=1)
    assert row.x == keep + " End. So" and not row.no and row.yes


def test_language_gates_by_hand(spark):
    ru = "Это предложение написано на русском языке и говорит о многом для всех."
    en = "This sentence is written in English and it is about the work that we do."
    front = lambda **f: "---\n" + "".join(f"{k}: {v}\n" for k, v in f.items()) + "---\n"
    cases = {
        "language_mismatch": ("x", en, True), "page_language": (en, ru, False), "mixed_language": ("x", "\n".join([en] * 4), True), "script_run": ("x", f"{ru} we see the house {ru}", True),
        "description_reverted": (front(description="A text of some length"), front(description="A text of some length"), True), "stale_hash": ("---\nprovenance:\n  content_hash: a\n---\n", "---\nprovenance:\n  x: 1\n  content_hash: b\n---\n", True),
        "seo": (front(title="A | B", keywords="a, b"), front(title="А | Б", keywords="a, b, c"), False), "multiline_scalar": ("---\ns: >\n  one two three four\n  five\n---\n", "---\ns: раз два три четыре\n---\n", False),
        "key_leak": ("---\ntitle: a\ns: >\n  b\n---\n", "---\ntitle: a\ns: >\n  b\n  title: c\n---\n", True), "lead_in": ("Run this to begin the work:\n\n```\nx\n```", "а\n\n```\nx\n```", True),
        "heading_integrity": ("# Get the value", "# Get the value", True), "file_purity": ("x", f"{ru}\n\n{en}", True), "soft_contamination": ("x", ru, False),
    }
    assert set(cases) == set(language.LANGUAGE_GATES)
    row = one(spark, *(language.LANGUAGE_GATES[g](F.lit(s), F.lit(t), F.lit("ru")).alias(g) for g, (s, t, _) in cases.items()), z=1)
    assert row.asDict() == {g: want for g, (_, _, want) in cases.items()}
    row = one(spark, language.brand_missing(("Acme",))(F.lit(front(title="Acme Go")), F.lit(front(title="Го")), F.lit("ru")).alias("a"), language.title_drift(F.lit(True))(F.lit(front(title="A")), F.lit(front(title="B")), F.lit("ru")).alias("b"), language.ignored_field_present(("draft",))(F.lit("x"), F.lit(front(draft="true")), F.lit("ru")).alias("c"), language.other_identifier_named(r"[A-Z]\w+\.[A-Z]\w+")(F.lit("of Ab.Cd"), F.lit(front(description="of Xy.Za")), F.lit("ru")).alias("d"), language.restore_identifiers(F.lit(front(title="Doc.Save", x="1")), F.lit(front(title="Док", x="2") + "title: y"), r"\w+\.\w+").alias("e"), z=1)
    assert (row.a, row.b, row.c, row.d) == (True,) * 4 and row.e == front(title="Doc.Save", x="2") + "title: y"


def test_overwriting(spark):
    de, en, ru = "Das ist nicht der Weg und die Zeit", "This is the way of the work that", "Это русский текст"
    cases = {(None, de): "ALLOW", (None, en): "BLOCK", (de, en): "BLOCK", (en, de): "ALLOW", (en, ru): "REQUEUE", (de, de): "ALLOW"}
    rows = spark.createDataFrame([(a, b) for a, b in cases], "a string, b string").withColumn("d", language.overwrite_decision(F.col("a"), F.col("b"), F.lit("de"))).collect()
    assert {(r.a, r.b): r.d for r in rows} == cases


# -- records


def test_records_by_hand(spark):
    config = '{"primary": "m1", "list": ["bad", "x"], "deep": {"k": "worse"}}'
    row = one(spark, records.named_anywhere(F.lit(config), ("bad", "worse", "m2")).alias("a"), records.not_allowed(F.array(F.lit("de"), F.lit("xx")), F.array(F.lit("de"))).alias("b"), records.changed_keys(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3), F.lit("c"), F.lit(1))).alias("c"), records.by_severity(F.array(F.lit("X"), F.lit("LOW"), F.lit("HIGH")), ("HIGH", "LOW")).alias("d"), records.by_severity(F.array().cast("array<string>"), ("HIGH",)).alias("e"), records.should_launch(F.lit(True), F.lit(5), 10, F.lit(False)).alias("f"), records.priority_score(F.lit(2), F.lit(7.0)).alias("g"), z=1)
    assert row.a == ["bad", "worse"] and row.b == ["xx"] and row.c == ["a", "b", "c"] and tuple(row.d) == ("HIGH", ["HIGH", "LOW", "X"]) and row.e.primary == "FAIL_OTHER" and tuple(row.f) == (False, "cooling_down") and row.g == 2e10 + 7
    assert re.fullmatch(records.alternation(("ab", "abc", "a.c")), "abc") and records.alternation(("ab", "abc", "a.c")) == "a\\.c|abc|ab"
    got = {r.name: r.value for r in records.with_defaults(spark.createDataFrame([("x", 0.5)], "name string, value double"), "name", "value", {"x": 1.0, "y": 0.8}).collect()}
    assert got == {"x": 0.5, "y": 0.8}
    rows = spark.range(1000).selectExpr("id", "id % 3 AS g", "(id * 7919) % 1000 AS at")
    want = {g: sorted((i * 7919 % 1000 for i in range(1000) if i % 3 == g), reverse=True)[:4] for g in range(3)}
    kept = records.recent_slots(rows, ("g",), "at", 4).collect()
    assert {g: sorted((r.at for r in kept if r.g == g), reverse=True) for g in range(3)} == want
