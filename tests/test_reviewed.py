"""Cases of the review of round 3: queries on odd or larger tables against their twins."""

import inspect
import time

import duckdb
import pandas as pd

from paragrid.llm import bpe
from paragrid.operators import graph
from paragrid.plans import catalog, corpus, runs  # noqa: F401  corpus and runs add their queries
from paragrid.sources import laws, portals, readers
from test_catalog import canon


def against_twin(spark, folder, name, **tables):
    """The query's rows over ``tables`` (name to DuckDB SQL), written below ``folder``, against those of its SQL; how many there are."""
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for table, sql in tables.items():
        con.sql(f"copy ({sql}) to '{folder}/{table}.parquet' (format parquet)")
        con.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    got, want = catalog.QUERIES[name](spark, str(folder)).toPandas(), con.sql(catalog.ORACLE_SQL[name]).df()
    assert canon(got) == canon(want)
    return len(got)


def test_references_as_the_twin_reads_them(spark, tmp_path):
    page = (
        "<!DOCTYPE html><html><head><title>a &quot;b&quot; &amp;lt; &amp</title></head><body>x &amp;copy; &copy; &auml; &#228; y&amp<script>if (a && b &amp; c) {}</script>"
        '<p>&lt;i&gt; &nbsp;z</p><a href="?a=1&amp;b=2">l</a></body></html>'
    )
    assert against_twin(spark, tmp_path, "q45_html_parse", pages=f"select 1::bigint as page_id, 'u' as url, '{page}' as html union all select 2, 'u', '<title>k &amp;</title><body><p>&copy &middot;</body>'") == 2


def test_suppliers_that_share_a_file_name(spark, tmp_path):
    keys = "(4, 1), (9004, 1), (18004, 1), (9004, 2), (5, 1), (9005, 1), (6, 1), (9006, 1), (7, 1), (9007, 1)"
    assert against_twin(spark, tmp_path, "q61_repository_scan", supplier=f"select k::bigint as s_suppkey, 'Supplier ' || k as s_name, n::integer as s_nationkey from (values {keys}) t(k, n)") == 10


def test_laws_of_many_sections(spark, tmp_path):
    """Crumbs are folded once a law: four thousand sections take seconds; folded anew for each section they took hours."""
    began = time.monotonic()
    supplier = "select i::bigint as s_suppkey, 'Supplier ' || i as s_name, 1 + (i % 50 = 0)::integer as s_nationkey from range(4000) t(i)"
    assert against_twin(spark, tmp_path, "q76_rerender", supplier=supplier) == 3999
    assert time.monotonic() - began < 90


def test_crumbs_of_outlines(spark):
    unit = "<gliederungseinheit><gliederungskennzahl>{0}</gliederungskennzahl><gliederungsbez>{1}</gliederungsbez></gliederungseinheit>"
    norm = "<norm><metadaten><enbez>{}</enbez>{}</metadaten></norm>"
    norms = [("§ 1", ""), ("§ 2", unit.format("010", "A")), ("", unit.format("010010", "B")), ("§ 3", ""), ("§ 4", unit.format("020", "C"))]
    xml = "<dokumente><norm><metadaten><jurabk>J</jurabk></metadaten></norm>" + "".join(norm.format(*n) for n in norms) + "</dokumente>"
    frame = spark.createDataFrame([("b", xml.encode()), ("n", None)], "bjnr string, xml binary")
    rows = {r["bjnr"]: r for r in laws.parse_laws(frame, "fixed").collect()}
    assert [(s["number"], s["breadcrumb"]) for s in rows["b"]["sections"]] == [("§ 1", []), ("§ 2", ["A"]), ("§ 3", ["A", "B"]), ("§ 4", ["C"])]
    assert rows["n"]["error"] == "no document" and rows["n"]["sections"] is None


def test_leaves_of_hubs_are_not_opened(spark, monkeypatch):
    """Both ends of each pair hang on one of two hubs with three hundred leaves, which join at one root: a few rows a pair, and no leaf of a hub among them."""
    crossed, write = [], graph.files.materialize

    def held(frame, name):
        out = write(frame, name)
        crossed.extend([out.count()] if name == "graph-crossed" else [])
        return out

    monkeypatch.setattr(graph.files, "materialize", held)
    edges = [("root", hub) for hub in "ab"] + [(hub, f"{hub}{i}") for hub in "ab" for i in range(300)]
    steps = spark.createDataFrame(edges + [(y, x) for x, y in edges], "src string, dst string")
    pairs = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(60)] + [("a0", "a1"), ("a", "a7"), ("a", "b")], "source string, target string")
    found = {(r["source"], r["target"]): r["path"] for r in graph.paths_between(steps, pairs, 4).collect()}
    want = {(f"a{i}", f"b{i}"): [f"a{i}", "a", "root", "b", f"b{i}"] for i in range(60)}
    assert found == want | {("a0", "a1"): ["a0", "a", "a1"], ("a", "a7"): ["a", "a7"], ("a", "b"): ["a", "root", "b"]}
    assert sum(crossed) < 300  # of one hub opened for each pair there would be 18000


def test_pages_are_handed_on_in_small_parts():
    """Tokens of many pages are not held together, and every page keeps its row and its place."""
    page = "<p class=jnenbez>1. Kopf</p><div class=jnhtml><p>" + "wort " * 20000 + "</p></div>"
    parts = list(portals._pages(iter([pd.Series([page] * 25 + [None, "kurz"]), pd.Series([], dtype=object), pd.Series(["<title>x</title>"])]), True))
    assert len(parts) == 4 and max(map(len, parts)) <= 11 and sum(map(len, parts)) == 28
    errors = [e for p in parts for e in p["error"]]
    assert errors == [None] * 25 + ["no document", None, None] and parts[-1]["tokens"][0][0][1] == "title"


def test_a_worker_holds_few_words_between_stages():
    """An idle worker's word cache counts towards its executor's memory in every later stage."""
    default = inspect.signature(bpe.CachedEncoder).parameters["cache_words"].default
    assert default <= 400_000 and bpe.CHARACTERS <= 2_000_000


def test_metadata_of_laws_are_not_listed_in_the_driver(spark, tmp_path):
    """Every metadata file gives one row, and the plan names none of them."""
    held = {"C1": b'{"title": "t", "jurabk": "j"}', "a b+c": b'{"title": 7}', "utf16": '{"title": "ü"}'.encode("utf-16"), "sig": b'\xef\xbb\xbf {"jurabk": "k"}'}
    broken = {"cut": b'{"title": ', "empty": b"", "list": b'[{"title": "x"}, {"title": "y"}]', "bytes": b'{"title": "\xff\xfe\xfa"}'}
    for folder, data in (held | broken | {"_hidden": b"{}"}).items():
        (tmp_path / "laws" / folder / "deeper").mkdir(parents=True)
        (tmp_path / "laws" / folder / "meta.json").write_bytes(data)
        (tmp_path / "laws" / folder / "deeper" / "meta.json").write_bytes(data)
    (tmp_path / "laws" / "none").mkdir()
    (tmp_path / "laws" / "file").write_text("{}")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        metas = readers.law_metas(spark, root, "title string, jurabk string")
        got = {r["folder"]: (r["title"], r["jurabk"], r["error"]) for r in metas.collect()}
        assert got == {"C1": ("t", "j", None), "a b+c": ("7", None, None), "utf16": ("ü", None, None), "sig": (None, "k", None)} | dict.fromkeys(broken, (None, None, "corrupt"))
        assert metas.count() == 8 and metas.inputFiles() == []
