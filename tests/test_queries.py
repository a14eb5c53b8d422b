"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import pytest

from lumenfold.plans import all_queries

SF = "/root/testdata/sf0.001"
REGISTRY = all_queries()


def connect(sf):
    con = pytest.importorskip("duckdb").connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="module")
def ducks():
    """The smallest tables, and larger ones for queries that find nothing there."""
    return {sf: connect(sf) for sf in (SF, SF.replace("0.001", "0.01"))}


def plain(frame):
    def cell(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return str([str(x) for x in v])
        if v is None or v != v:
            return "null"
        if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
            return "inf" if math.isinf(v) else repr(round(float(v), 5) + 0.0)
        return str(v)

    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(REGISTRY.SQL))
def test_query_is_its_sql(spark, ducks, name):
    for sf, duck in ducks.items():
        want = plain(duck.execute(REGISTRY.SQL[name]).df())
        assert plain(REGISTRY.QUERIES[name](spark, sf).toPandas()) == want
        if want[1]:
            return
    raise AssertionError("no row on either size proves nothing")


@pytest.mark.parametrize("name", sorted(set(REGISTRY.QUERIES) - set(REGISTRY.SQL)))
def test_query_runs(spark, name):
    assert REGISTRY.QUERIES[name](spark, SF).count() > 0


def test_entry_without_the_pipeline(spark, monkeypatch):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    monkeypatch.setattr(entry, "llm_queries", None)
    assert set(entry.queries()) == set(REGISTRY.QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """Documents whose ends are far behind their 260th character."""
    path = str(tmp_path_factory.mktemp("long"))
    data = [(i, "Words of the part that go on, " * 12 + f"\n\nAt last the end number {i} comes.\n\n## Late {i}\n\nIt is so. It is so. It is so.", "en" if i % 2 else "de", "s") for i in range(30)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["markdown_units", "unit_quality", "heading_votes", "write_gate_report", "validator_issues"])
def test_pairs_hold_whole_texts(spark, long_texts, name):
    got = REGISTRY.QUERIES[name](spark, long_texts)
    if name == "markdown_units":
        assert sum("At last the end number" in r.text for r in got.collect()) == 30
    elif name == "unit_quality":
        assert got.filter("doc_id = 0").count() > 10
    elif name == "heading_votes":
        assert {r.heading for r in got.collect()} >= {"Late 0", "Late 23"}
    elif name == "write_gate_report":
        # only one side's empty lines stand for the text; the late heading goes with it
        assert "heading_deficit" in got.filter("doc_id = 6").first().gates and "heading_deficit" not in got.filter("doc_id = 0").first().gates
    else:
        assert got.filter("message = 'repeated sentence'").select("doc_id").distinct().count() == 29


def test_corpus_bleu_of_whole_texts(spark, long_texts):
    import unicodedata
    from collections import Counter

    from lumenfold.plans.texts import _doc_pairs

    sums = {}
    for r in _doc_pairs(spark, long_texts).join(spark.read.parquet(f"{long_texts}/documents.parquet").select("doc_id", "lang"), "doc_id").collect():
        assert "At last the end number" in r.s
        h, s = ("".join(f" {c} " if unicodedata.category(c)[0] in "PS" else c for c in x).split() for x in (r.t, r.s))
        got = sums.setdefault(r.lang, Counter())
        got["h"], got["r"] = got["h"] + len(h), got["r"] + len(s)
        for n in range(1, 5):
            a, b = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (h, s))
            got["hit", n] += sum((a & b).values())
            got["all", n] += sum(a.values())
    want = {k: 100 * math.exp(sum(math.log(c["hit", n] / c["all", n]) for n in range(1, 5)) / 4 + min(0, 1 - c["r"] / c["h"])) for k, c in sums.items()}
    assert {r.lang: r.bleu for r in REGISTRY.QUERIES["corpus_bleu"](spark, long_texts).collect()} == pytest.approx(want, abs=1e-3)
