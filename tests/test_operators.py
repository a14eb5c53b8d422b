"""Operators on small fixtures: expected values by hand, empty and null input, streams against batches."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenfold.functions import stats
from lumenfold.functions import text as tx
from lumenfold.operators import analytics, documents, ledger, memory, operations, quality, sets, windows
from lumenfold.operators.query_builder import RunQuery
from lumenfold.sources import stores
from lumenfold.streaming import operators as streaming

NOW = datetime(2024, 3, 10, 12)


@pytest.fixture(scope="module")
def runs(spark):
    rows = [("run_001", "small", "cpu", NOW - timedelta(days=2), ["cpu", "baseline"], "technical"), ("run_002", "large", "cpu", NOW - timedelta(days=1), ["cpu", "large_model"], "technical"), ("run_003", "small", "cuda", NOW, ["gpu", "performance"], "general")]
    return spark.createDataFrame(rows, "run_id string, model_id string, device string, ts timestamp, tags array<string>, corpus_category string")


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame([("run_001", 80.0, 1.0, 500.0, False), ("run_002", 40.0, 1.0, 1500.0, False), ("run_003", 240.0, 1.0, None, False)], "run_id string, throughput double, duration double, memory double, failed boolean")


@pytest.fixture(scope="module")
def system(spark):
    return spark.createDataFrame([("run_001", 12, 32.0, None), ("run_002", 12, 32.0, None), ("run_003", 16, 64.0, "RTX 3080")], "run_id string, cores int, ram_gb double, gpu_model string")


def ids(df):
    return [r.run_id for r in df.collect()]


def test_query_builder(runs, results, system):
    q = RunQuery(runs, results, system)
    assert len(ids(q.by_model("small").build())) == 2 and len(ids(q.by_device("cpu").build())) == 2
    assert ids(q.by_hardware(ram_gb_min=60).build()) == ["run_003"] and ids(q.by_hardware(gpu_model="rtx").build()) == ["run_003"]
    assert ids(q.by_tags("gpu").build()) == ["run_003"] and len(ids(q.by_tags("gpu", "baseline", match_all=False).build())) == 2
    assert ids(q.by_date_range(start=NOW - timedelta(hours=12)).build()) == ["run_003"]
    assert ids(q.sort_by("ts").build())[0] == "run_001" and ids(q.limit(2).build()) == ["run_003", "run_002"] and len(ids(q.limit(2).offset(2).build())) == 1
    assert ids(q.by_throughput_range(50, 100).build()) == ["run_001"] and ids(q.find_similar_hardware(12, 30.0)) and not ids(q.find_similar_hardware(12, 10.0))
    assert q.aggregate("throughput").first().value == 120 and q.by_model("none").aggregate("throughput", "count").first().value is None
    assert {r.group: r.mean for r in q.group_by("model_id", "throughput").collect()} == {"small": 160, "large": 40}
    assert ids(q.find_best(k=1)) == ["run_003"] and len(q.with_results().filter("size(results) = 1").collect()) == 3


def test_rollup_percentiles_interpolate(spark):
    points = spark.createDataFrame([("m", "d", datetime(2024, 1, 1, 3, i), 100.0 + 10 * i, 1 + 0.1 * i, 500.0 if i else None) for i in range(10)], "model_id string, device string, ts timestamp, throughput double, duration double, memory double")
    row = analytics.rollup(points, "hourly", "2024-01-01 00:30:00").first()
    assert (row.sample_count, row.p50) == (10, 145) and row.p95 == pytest.approx(185.5) and row.p99 == pytest.approx(189.1) and row.avg_memory == 500
    assert row.window_start == datetime(2024, 1, 1, 3) and analytics.rollup_all(points, "2024-01-01").count() == 4
    assert analytics.baseline(points, "2024-01-02").count() == 1 and analytics.baseline(points.limit(9), "2024-01-02").count() == 0


def test_statistics(spark):
    values = lambda xs: spark.createDataFrame([(float(x),) for x in xs], "v double")
    row = analytics.summarise(values([10, 20, 30, 40, 50]), "v").first()
    assert (row["mean"], row.variance, row["median"]) == (30, 200, 30)
    one = analytics.summarise(values([42]), "v").first()
    assert (one.ci_low, one.ci_high) == (42, 42)
    groups = spark.createDataFrame([("a", float(x)) for x in (100, 105, 110, 95, 100)] + [("b", float(x)) for x in (50, 55, 60, 45, 50)], "g string, v double")
    test = analytics.welch(groups, F.col("g"), "a", "b", "v").first()
    assert test.significant and test.p == 0.005 and test.df == pytest.approx(8) and test.confidence == "high"
    flat = analytics.welch(spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, v double"), F.col("g"), "a", "b", "v").first()
    assert (flat.t, flat.df) == (0, 2)
    keyed = lambda xs: spark.createDataFrame([("k", i, float(x)) for i, x in enumerate(xs)], "k string, i int, v double")
    assert {r.i for r in analytics.outliers(keyed([10, 12, 11, 13, 12.5, 11.5, 100, -50]), "v", ("k",)).collect()} == {6, 7}
    assert [r.i for r in analytics.outliers(keyed([10.0 + 0.1 * (i % 3) for i in range(20)] + [100]), "v", ("k",), "zscore").collect()] == [20]
    assert analytics.outliers(keyed(range(10, 15)), "v", ("k",)).count() == 0
    assert [stats.t_critical_value(x) for x in (1, 7.5, 120, 500)] == [12.706, pytest.approx(2.3995), 1.98, 1.96]
    near = {n: analytics.nearest_rank_stats(keyed(range(n)), "v", ("k",)).first() for n in (20, 21, 101)}
    assert near[20].p95 == 19 and near[21].p95 == 19 and near[101].p99 == 99 and near[20].p50 == 10


def test_windows(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate("RAAAARAAAAAAAAAAAAAAA")] + [("b", i, "A") for i in range(14)], "k string, t int, v string")
    bad = F.col("v") == "R"
    assert {r.k: r.streak for r in windows.trailing_streak(rows, bad, ("k",), ("t",)).collect()} == {"a": 15, "b": 14}
    last = {(r.k, r.t): (r.rate, r.flips) for r in windows.rolling_rate(rows, bad, ("k",), ("t",)).collect()}
    assert last["a", 18][1] is False and last["a", 20] == (pytest.approx(0.05), False)
    score = spark.createDataFrame([(i, float(i)) for i in range(25)], "i long, s double")
    waves = [r.wave for r in windows.quantile_waves(score, "s", "i").orderBy("i").collect()]
    assert waves == [min(9, int(i // 2.5)) for i in range(25)]
    batches = windows.greedy_batches(spark.createDataFrame([("k", i, c) for i, c in enumerate((5, 5, 5, 50, 1, 1, 1, 1))], "k string, i int, c long"), ("k",), "i", "c", 3, 12)
    assert [r.batch for r in batches.orderBy("i").collect()] == [0, 0, 1, 2, 3, 3, 3, 4]
    cells = spark.createDataFrame([("en", i) for i in range(7)], "lang string, i int")
    assert sorted({(r.i, r.shard) for r in windows.shards(cells, cells.filter("i = 1"), ("lang",), "i", 3).collect()}) == [(0, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2)]


def test_sets(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, v string, created int")
    new = spark.createDataFrame([(2, "c", 30), (3, None, 40)], "id int, v string, created int")
    assert sorted(map(tuple, sets.upsert(old, new, ("id",), ("created",)).collect())) == [(1, "a", 10), (2, "c", 20), (3, None, 40)]
    assert sorted(map(tuple, sets.upsert(old, new, ("id",), overwrite=False).collect())) == [(1, "a", 10), (2, "b", 20), (3, None, 40)]
    queue = spark.createDataFrame([(1, "PENDING", NOW, None, None, 0), (2, "CLAIMED", NOW, NOW - timedelta(1), "x", 1), (3, "CLAIMED", NOW, NOW + timedelta(1), "y", 1), (4, "APPLIED", NOW, None, None, 1)], "id int, state string, created timestamp, claim_until timestamp, owner string, attempts int")
    mine = sets.claim(queue, "me", NOW, 60, 5)
    assert sorted((r.id, r.attempts) for r in mine.filter("owner = 'me'").collect()) == [(1, 1), (2, 2)]
    done = sets.settle(mine, spark.createDataFrame([(1, "me"), (3, "me")], "id int, owner string"), "APPLIED")
    assert {r.id: r.state for r in done.collect()} == {1: "APPLIED", 2: "CLAIMED", 3: "CLAIMED", 4: "APPLIED"}
    tasks = spark.createDataFrame([(1, "COMPLETED", "P1", 1, []), (2, "PENDING", "P1", 2, [1]), (3, "PENDING", "P0", 3, [1, 2]), (4, "PENDING", "P2", 1, [])], "task_id int, status string, priority string, created int, depends_on array<int>")
    assert [r.task_id for r in sets.next_tasks(tasks, 5).collect()] == [2, 4]
    assert sets.latest(old.limit(0), ("id",), ("created",)).count() == 0


def test_each_outcome_of_a_cell(spark):
    changes = [{"supported": False}, {"excluded": True}, {"source_exists": False}, {"source_readable": False}, {"source_yaml_ok": False}, {"source_empty": True}, {"licence_blocked": True}, {"on_hold": True}, {"rejected": True, "source_unchanged": True}, {"attempts": 5}, {"target_exists": False}, {"trusted": False}, {"source_hash_changed": True}, {"profile_changed": True}, {"protection_changed": True}, {"lineage_denied": True}, {}]
    rows = [tuple((ledger.HEALTHY | c).values()) + (i,) for i, c in enumerate(changes)]
    got = ledger.classify(spark.createDataFrame(rows, [*ledger.HEALTHY, "i"])).orderBy("i").collect()
    assert [r.reason for r in got] == [r for *_, r in ledger.OUTCOMES] + ["up_to_date"]
    both = spark.createDataFrame([(False, True)], "supported boolean, excluded boolean")
    assert ledger.classify(both).first().reason == "unsupported_locale"


def test_memory(spark):
    key = spark.range(1).select(tx.memory_key(F.lit("s"), F.lit("en"), F.lit("de"), F.lit(" é  x "), F.lit("title"), F.lit("ctx")).alias("k"), tx.text_hash(F.lit("a  b")).alias("h")).first()
    import hashlib

    assert key.k == "s:title:en:de:" + hashlib.md5("ctx\0 é x".encode()).hexdigest() and key.h == hashlib.md5(b"a b").hexdigest()
    entry = lambda i, f, c, tr: (i, "s", "en", "de", "hello", f, c, tr, "m")
    stored = spark.createDataFrame([entry(1, "", "", "bare"), entry(2, "title", "", "field"), entry(3, "title", "ctx", "both")], "i int, site string, src string, tgt string, text string, field string, context string, translation string, model_id string")
    asked = spark.createDataFrame([(1, "s", "en", "de", "hello", "title", "ctx"), (2, "s", "en", "de", "hello", "title", "other"), (3, "s", "en", "de", "hello", "body", None), (4, "s", "en", "de", "bye", None, None)], "request_id int, site string, src string, tgt string, text string, field string, context string")
    got = {r.request_id: r.translation for r in memory.exact_lookup(asked, memory.with_key(stored)).collect()}
    assert got == {1: "both", 2: "field", 3: "bare", 4: None}
    vectors = spark.createDataFrame([(i, "p" if i < 6 else "q", [1.0, i / 10, 0.0, 0.0]) for i in range(8)] + [(9, "p", [1.0, 0.0, 0.0, 0.0])], "entry_id int, part string, embedding array<float>")
    found = memory.semantic_search(spark.createDataFrame([(1, "p", [1.0, 0.0, 0.0, 0.0])], "query_id int, part string, embedding array<float>"), vectors, ("part",), 3, 0.9)
    assert [(r.entry_id, round(r.similarity, 4)) for r in found.orderBy("rank").collect()] == [(0, 1.0), (9, 1.0), (1, round(1 / 1.01, 4))]


def test_operations(spark):
    pairs = spark.createDataFrame([("a", "a", True, 1.0), ("a", "b", True, 0.96), ("a", "b", False, 0.96), ("a", "z", True, 0.1)], "x string, y string, ok boolean, s double")
    got = {r.outcome: (r.n, r.share) for r in operations.pair_outcomes(pairs, "x", "y", F.col("ok"), F.col("s")).collect()}
    assert got == {"identical": (1, 0.25), "equivalent": (1, 0.25), "divergent": (2, 0.5)}
    models = spark.createDataFrame([("m", ["en-de", "en-fr"]), ("n", [])], "model_id string, pairs array<string>")
    row = operations.language_coverage(models, spark.createDataFrame([("de",), ("ja",), ("fr",), ("ko",)], "lang string")).first()
    assert (row.covered, row.missing, row.percent) == (2, 2, 50)
    day = spark.createDataFrame([(datetime(2024, 1, 1),)], "d timestamp").select(operations.run_times(F.col("d"), 1380, 60, 2).alias("t"), operations.within_window(F.lit(30), 1380, 60).alias("w")).first()
    assert day.t == [datetime(2024, 1, 1, 23), datetime(2024, 1, 2)] and day.w
    flags = spark.range(1).select(operations.bypasses_lookup(F.lit("REFRESH"), F.lit(True)).alias("a"), operations.updates_cache(F.lit("BYPASS"), F.lit(True)).alias("b"), operations.source_changed(F.lit(2), F.lit(1), F.lit("x"), F.lit("x")).alias("c"), operations.source_changed(F.lit(2), F.lit(1), F.lit("x"), F.lit(None).cast("string")).alias("d")).first()
    assert tuple(flags) == (True, False, False, True)
    assert operations.overall_progress(spark.createDataFrame([(1, 4), (1, 4)], "d int, t int"), "d", "t").first().percent == 25
    assert operations.hit_rates(pairs.limit(0), ("x",), "y").count() == 0


def issues_of(spark, s, t, names=None):
    row = quality.validate(spark.createDataFrame([(s, t)], "source string, translation string"), names=names).first()
    return {(i.validator, i.severity, i.message) for i in row.issues}


@pytest.mark.parametrize(
    ("name", "s", "t", "message"),
    [
        ("completeness", "a " * 100, "a", "translation is much shorter"), ("completeness", "a", "x PLACEHOLDER_1", "placeholder left"), ("trailing_section", "x\n## End\n[a](http://u)", "x\n## Ende", "last section lost its links"), ("length_anomaly", "ten letters", "ten letters " * 4, "characters"),
        ("repetition", "short", "one two three " * 3, "repeated words"), ("sentence_duplication", "", "The same one. Other one. The same one. End.", "repeated sentence"), ("heading_repetition", "", "# no no no no no", "repeated word in a heading"), ("placeholders", "{NAME_1} x", "x", "missing placeholder"),
        ("links", "[a](u1) [b](u2)", "[a](u1)", "missing address"), ("structure", "# a\n```\nx\n```\n", "# a\n```\ny\n```\n", "code block changed"), ("structure", "# a\n## b", "# a", "number of headings"), ("shortcodes", "{{< n >}} {{< n >}}", "{{< n >}}", "missing shortcode"), ("front_matter_keys", "---\na: 1\nb: 2\n---\n", "---\na: 1\n---\n", "keys differ"), ("markdown_in_metadata", "", "---\na: '# x'\n---\n", "heading mark in a field"),
    ],
)
def test_validators_object_and_pass(spark, name, s, t, message):
    assert message in {m for *_, m in issues_of(spark, s, t, (name,))}
    assert not issues_of(spark, "One good text here.", "Ein guter Text hier.", (name,)) and not issues_of(spark, None, None, (name,))


def test_decision(spark):
    def decide(found, retries=0, mode="normal"):
        df = spark.createDataFrame([(found, retries)], f"i {quality.ISSUES}, r int")
        return df.select(quality.decide(F.col("i"), F.col("r"), mode).alias("d")).first().d

    error, warning = ("LengthAnomaly", "ERROR", "m"), ("LengthAnomaly", "WARNING", "m")
    assert [decide([]), decide([warning]), decide([error]), decide([error], 2), decide([error] * 2), decide([("Link", "ERROR", "m")]), decide([warning], 0, "strict"), decide([error], 0, "fast")] == ["ACCEPT", "ACCEPT", "RETRY", "REJECT", "REJECT", "REJECT", "RETRY", "ACCEPT"]


def test_markdown_units_and_placeholders(spark):
    text = "---\ntitle: \"T\"\n---\n# Head\n\npara one\nmore\n\n- item\n\n````py\n```\nx\n````\n| a | b |\n|---|---|\n| 1 | 2 |\n{{< note >}}\n> quote"
    got = documents.extract_units(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).orderBy("position").collect()
    assert [(r.kind, r.text) for r in got] == [("field", "T"), ("heading", "Head"), ("para", "para one\nmore"), ("item", "item"), ("code", "````py\n```\nx\n````"), ("cell", "a"), ("cell", "b"), ("cell", "1"), ("cell", "2"), ("shortcode", "{{< note >}}"), ("quote", "quote")]
    assert documents.fenced_line_mask(["```", "~~~", "```", "x"]) == [True, True, True, False]
    df = spark.createDataFrame([("use `a` and `b`",)], "t string").select("t", documents.protect(F.col("t"), "`[^`]+`").alias("p"))
    row = df.select("t", "p.*", documents.restore(F.col("p.masked"), F.col("p.values")).alias("back"), documents.restore(F.lit("PLACEHOLDER_1 {PLACEHOLDER_7}"), F.col("p.values")).alias("odd")).first()
    assert row.masked == "use {PLACEHOLDER_0} and {PLACEHOLDER_1}" and row.back == row.t and row.odd == "`b` {PLACEHOLDER_7}"
    bleu = documents.corpus_bleu(spark.createDataFrame([("the cat sat on the mat", "the cat sat on the mat")], "h string, r string"), "h", "r").first().bleu
    assert bleu == pytest.approx(100)
    terms = documents.detect_terms(spark.createDataFrame([(1, "New York Times in New York")], "k int, t string"), "k", "t", ("New York", "New York Times")).collect()
    assert [(r.term, r.begin) for r in terms] == [("New York Times", 0), ("New York", 18)]


def test_stores(spark, tmp_path, runs, results):
    (tmp_path / "blog").mkdir()
    (tmp_path / "blog" / "a.md").write_text("x" * 40)
    (tmp_path / "b.md").write_text("y")
    got = {r.path: (r.category, r.tokens) for r in stores.markdown_corpus(spark, str(tmp_path)).collect()}
    assert got == {"blog/a.md": ("blog", 10), "b.md": ("general", 0)}
    stores.save(stores.conform(runs, stores.SCHEMAS["benchmark_runs"]), str(tmp_path / "runs"), "model_id")
    assert stores.read_runs(spark, str(tmp_path / "runs")).count() == 3
    back = stores.from_json(stores.as_json(runs, "run_id"), "json", "run_id string, device string, new int").collect()
    assert {r.run_id: (r.device, r.new) for r in back} == {"run_001": ("cpu", None), "run_002": ("cpu", None), "run_003": ("cuda", None)}
    stores.export(results, str(tmp_path / "csv"), compress=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    old, live = stores.archive(runs, NOW)
    assert stores.restore(live, old, "run_id").count() == 3 and stores.restore(runs, old, "run_id").count() == 3
    paths = spark.createDataFrame([("c/en/a.md",), ("c/a.md",)], "path string")
    assert [r.target for r in stores.locale_pairs(paths, ("de",)).collect()] == ["c/de/a.md", "c/a.de.md"]


def stream_of(spark, tmp_path, batches, schema):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # the source reads by age
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def collected(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def test_streams_give_what_batches_give(spark, tmp_path):
    at = lambda s: (NOW + timedelta(seconds=s)).isoformat()
    batches = [[{"k": "a", "ts": at(0), "kind": "new"}, {"k": "a", "ts": at(1.9), "kind": "edit"}, {"k": "b", "ts": at(0), "kind": "new"}], [{"k": "a", "ts": at(4.1), "kind": "del"}], [{"k": "z", "ts": at(100), "kind": "new"}], [{"k": "z", "ts": at(200), "kind": "new"}]]
    schema = "k string, ts timestamp, kind string"
    got = collected(spark, streaming.debounce(stream_of(spark, tmp_path, batches, schema), "k", "kind"), "bursts").filter("k <> 'z'")
    batch = streaming.debounce(spark.read.schema(schema).json(str(tmp_path / "in")), "k", "kind").filter("k <> 'z'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) and {(r.k, r.kind, r.n) for r in got.collect()} == {("a", "edit", 2), ("a", "del", 1), ("b", "new", 1)}


def test_breaker_stream(spark, tmp_path):
    at = lambda s: (NOW + timedelta(seconds=s)).isoformat()
    log = [(t, False) for t in range(5)] + [(30, True), (70, False), (150, True), (200, True), (210, True)]
    batches = [[{"k": "a", "ts": at(t), "ok": ok} for t, ok in log[i : i + 4]] for i in range(0, len(log), 4)]
    schema = "k string, ts timestamp, ok boolean"
    got = collected(spark, streaming.circuit_breaker(stream_of(spark, tmp_path, batches, schema), "k", "ok"), "breaker")
    want = ["CLOSED"] * 4 + ["OPEN", "OPEN", "OPEN", "OPEN", "CLOSED", "CLOSED"]
    assert [r.state for r in got.orderBy("ts").collect()] == want
    assert [r.state for r in streaming.circuit_breaker(spark.read.schema(schema).json(str(tmp_path / "in")), "k", "ok").orderBy("ts").collect()] == want


def test_sink_writes_once(spark, tmp_path):
    stream = stream_of(spark, tmp_path, [[{"id": 1}, {"id": 1}], [{"id": 1}, {"id": 2}]], "id int")
    target = str(tmp_path / "out")
    spark.createDataFrame([], "id int").write.parquet(target)
    q = streaming.apply_once(stream, ("id",), lambda: spark.read.parquet(target), lambda df: df.write.mode("append").parquet(target), str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]


def test_write_decision_pairs_backticks(spark):
    front = "---\ntitle: \"A `b\"\ndescription: 'x `y` z'\nsummary: the `c\nlinkTitle: say \"d` \nother: `e\n---\n# H\n\ntitle: a `b stays\n"
    want = "---\ntitle: \"A `b`\"\ndescription: 'x `y` z'\nsummary: the `c`\nlinkTitle: say \"d`` \nother: `e\n---\n# H\n\ntitle: a `b stays\n"
    pairs = spark.createDataFrame([(1, want, front), (2, "title: `a", "title: `a"), (3, None, None)], "id long, source string, translation string")
    got = {r.id: r for r in quality.write_decision(pairs).collect()}
    assert got[1].text == want and got[1].blocked_by is None
    assert got[2].text == "title: `a" and got[3].text == ""
    assert quality.write_decision(pairs, zero_defect=True).filter("id = 1").first().blocked_by == "front_matter_backticks"
