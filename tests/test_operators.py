"""Folds, manifest algebra, events, rendering, export and graph."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paragrid.operators import diff, events, export, folds, graph, render


def manifest(spark, items):
    return spark.createDataFrame(sorted(items.items()), "path string, sha256 string")


pairs = st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("123"), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_diff_laws(spark, a, b):
    old, new = manifest(spark, a), manifest(spark, b)
    assert diff.manifest_diff(old, old).count() == 0
    back = diff.apply_diff(old, diff.manifest_diff(old, new))
    assert {r["path"]: r["sha256"] for r in back.collect()} == b


def test_write_plan(spark):
    old = manifest(spark, {"a": "1", "b": "1", "c": "1"})
    new = spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("b", "1", 2), ("d", "1", 1)], "path string, sha256 string, pos int")
    assert {tuple(r) for r in diff.write_plan(old, new).collect()} == {("a", "unchanged"), ("b", "unchanged"), ("d", "written"), ("c", "deleted")}
    assert {r["action"] for r in diff.write_plan(old, new, deletes=False).collect()} == {"unchanged", "written"}


def test_snapshot_action(spark):
    rows = spark.createDataFrame([(None, None, None, None), (True, True, None, None), (True, False, True, True), (True, False, True, False)], "k boolean, h boolean, s boolean, p boolean")
    act = lambda **o: [r[0] for r in rows.select(diff.snapshot_action(F.col("k"), F.col("h"), F.col("s"), F.col("p"), **o)).collect()]
    assert act() == ["write", "skip", "skip", "skip"]
    assert act(check=True) == ["write", "unchanged", "fetched", "write"]
    assert act(force=True) == ["write"] * 4


def test_index_merge_and_rebuild(spark):
    old = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    new = spark.createDataFrame([("a", None), ("c", 3)], "k string, v int")
    assert {tuple(r) for r in diff.merge_index(old, new, "k").collect()} == {("a", None, "new"), ("b", None, "old"), ("c", 3, "new")}
    meta = spark.createDataFrame([("s", "B", "h", "new"), ("", "C", "h", "x")], "slug string, bjnr string, source_xml_sha256 string, title string")
    known = spark.createDataFrame([("s", "old", "u")], "slug string, title string, zip_url string")
    assert [tuple(r) for r in diff.rebuild_index(meta, known).collect()] == [("s", "B", "h", "old", "u")]


def test_report_and_new_rows(spark):
    r = diff.run_report(spark.createDataFrame([(x,) for x in ("skip", "write", "fetched", "failed")], "action string")).first().asDict()
    assert r == {"total": 4, "fetched": 2, "unchanged": 2, "written": 1, "failed": 1}
    rows = spark.createDataFrame([("a", None), ("a", "1")], "k string, v string")
    assert [tuple(x) for x in diff.new_rows(rows, rows.where("v is null"), ["k", "v"]).collect()] == [("a", "1")]


def test_folds(spark):
    kinds = [(1, "A"), (2, "B"), (None, "x"), (3, "C"), (None, "y"), (2, "D"), (None, "z"), (1, "E"), (None, "w")]
    rows = spark.createDataFrame([("d", i, k, l) for i, (k, l) in enumerate(kinds)], "doc string, pos int, depth int, label string").repartition(3)
    got = {r["label"]: list(r["stack"]) for r in folds.heading_stack(rows, "doc", ["pos"], "depth", "label").where("depth is null").collect()}
    assert got == {"x": ["A", "B"], "y": ["A", "B", "C"], "z": ["A", "D"], "w": ["E"]}
    steps = F.array(*(F.struct(F.lit(d).cast("int").alias("depth"), F.lit(x).alias("label")) for d, x in ((1, "B1"), (1, "B2"), (2, "C"), (1, "B3"))))
    one = lambda mode: [list(x) for x in spark.range(1).select(folds.crumb_fold(steps, mode)).first()[0]]
    assert one("compat") == [["B1"], ["B1", "B2"], ["B1", "B2", "C"], ["B1", "B3"]] and one("fixed") == [["B1"], ["B2"], ["B2", "C"], ["B3"]]
    with pytest.raises(ValueError):
        folds.crumb_fold(steps, "other")
    numbers = spark.createDataFrame([("d", i, n) for i, n in enumerate([1, 1, 5, 2, 0])], "doc string, pos int, n int")
    assert [r["renumbered"] for r in folds.renumber(numbers, "doc", "pos", "n").orderBy("pos").collect()] == [1, 2, 5, 6, 7]
    twice = spark.createDataFrame([(2, "b", "x"), (1, "b", "y"), (3, "c", None)], "pos int, celex string, title string")
    assert {tuple(r) for r in folds.stable_dedup(twice, "celex", "pos").collect()} == {(1, "b", "y"), (3, "c", None)}


def test_date_windows(spark):
    a, z = dt.date(2020, 1, 1), dt.date(2020, 4, 1)
    got = [(str(r[0]), str(r[1])) for r in folds.date_windows(spark, a, z, 31).orderBy("window_start").collect()]
    assert got == [("2020-01-01", "2020-02-01"), ("2020-02-01", "2020-03-03"), ("2020-03-03", "2020-04-01")]
    assert folds.date_windows(spark, z, a, 30).count() == 0
    with pytest.raises(ValueError):
        folds.date_windows(spark, a, z, 0)


META = "bjnr string, jurabk string, title string, stand_datum string, sha_after string"


def test_events(spark):
    changes = spark.createDataFrame(
        [("laws/A/paragraphs/0010.md", "A"), ("laws/A/paragraphs/0002.md", "A"), ("laws/A/meta.json", "M"), ("laws/B/annexes/0001.md", "D"), ("laws/C/x.md", "M"), ("laws/Gone/x.md", "D"), ("README.md", "M")],
        "path string, status string",
    )
    meta = spark.createDataFrame([("A", "AG", "T" * 90, "2024-01-01", "s"), ("B", None, "b", "2024-01-01", "s"), ("C", "CG", "c", None, "s")], META)
    before = spark.createDataFrame([("A", "old")], "bjnr string, sha_before string")
    laws = events.affected_laws(changes, meta, before)
    groups = {r["effective_date"]: r for r in events.event_groups(laws, "2024-06-30").collect()}
    assert sorted(groups) == ["2024-01-01", "2024-06-30"]
    first = groups["2024-01-01"]
    assert first["event_id"] == "2024-01-01-stand-2laws" and [x["bjnr"] for x in first["laws"]] == ["A", "B"]
    assert list(first["laws"][0]["sections_added"]) == ["§ 10", "§ 2"] and first["laws"][0]["sha_before"] == "old" and first["laws"][1]["sha_before"] is None
    assert groups["2024-06-30"]["event_id"] == "2024-06-30-stand-C"
    frame = events.event_groups(laws, "2024-06-30")
    said = {r[0]: r[1] for r in frame.select("effective_date", events.commit_message(F.col("effective_date"), F.col("laws"), "tool")).collect()}
    assert said["2024-06-30"] == "law(CG): stand 2024-06-30\n\nc\n\nBJNR: C\ntooling: tool\n"
    assert said["2024-01-01"] == "feat(data): 2 laws - stand 2024-01-01\n\nAG, B\n\ntooling: tool\n"
    title = spark.range(1).select(events.short_title(F.lit("T" * 81))).first()[0]
    assert len(title) == 80 and title.endswith("...")
    assert spark.range(1).select(events.handle_list(F.split(F.lit("abcdefg"), ""))).first()[0] == "a, b, c, d, e, +2 more"
    empty = spark.createDataFrame([], "event_id string, content_sha256 string")
    log = events.commit_log(frame, empty, "2024-07-01 10:00:00", "tool")
    assert log.count() == 2 and events.commit_log(frame, log, "2024-07-02 10:00:00", "tool").count() == 0
    payload = events.event_payload(frame, schema_version="v2", tool="tool").where("year = '2024'").first()
    assert payload["verification"]["method"] == events.VERIFICATION


ABSATZ = "array<struct<absatz:string,intro:string,saetze:array<struct<nummer:int,text:string>>>>"


def section(spark, heading, crumbs, absaetze):
    return spark.createDataFrame([(heading, crumbs, absaetze)], f"h string, c array<string>, a {ABSATZ}").select(
        render.section_markdown(schema_version="v2", bjnr=F.lit("B1"), jurabk=F.lit(None).cast("string"), kind=F.lit("paragraph"), number=F.lit("§ 1"), heading=F.col("h"), breadcrumb=F.col("c"), stand_datum=F.lit(None).cast("string"), absaetze=F.col("a")).alias("md")
    )


def test_section_markdown(spark):
    md = section(spark, "Zweck", ["Teil: 1"], [("1", "", [(1, "Eins.")]), ("2", "Vor", [(1, "a"), (2, "b")]), ("3", "", []), ("4", "", [(1, "x"), (2, "y")])]).first()["md"]
    assert md.startswith('---\nschema_version: v2\nbjnr: B1\njurabk: ""\ntype: paragraph\nnumber: "§ 1"\nheading: Zweck\nbreadcrumb:\n  - "Teil: 1"\nstand_datum: ""\nsource_xml: source.xml\n---\n\n# § 1 Zweck\n\n')
    assert md.endswith("(1) Eins.\n\n(2) Vor <sup>1</sup>a <sup>2</sup>b\n\n(3)\n\n(4) <sup>1</sup>x <sup>2</sup>y\n")
    bare = section(spark, "", [], []).first()["md"]
    assert bare.endswith("breadcrumb: []\nstand_datum: \"\"\nsource_xml: source.xml\n---\n\n# § 1\n")


def test_parse_of_render_is_stable(spark):
    frame = section(spark, 'A "b": c', ["x", "y: z"], [("1", "", [(1, "Text: --- ja")])])
    p = frame.select(render.parse_frontmatter(F.col("md")).alias("p")).first()["p"]
    assert p["scalars"]["heading"] == 'A "b": c' and list(p["lists"]["breadcrumb"]) == ["x", "y: z"]
    again = section(spark, p["scalars"]["heading"], list(p["lists"]["breadcrumb"]), [("1", "", [(1, "Text: --- ja")])])
    assert again.first()["md"] == frame.first()["md"]
    for broken in ("no block", "---\nopen: x\n"):
        q = spark.range(1).select(render.parse_frontmatter(F.lit(broken)).alias("p")).first()["p"]
        assert q["scalars"] == {} and q["body"] == broken


def test_other_markdown(spark):
    one = spark.range(1)
    art = one.select(render.article_markdown(schema_version="v2", celex=F.lit("32016R0679"), doc_type=F.lit("eu-verordnung"), language=F.lit("de"), title=F.lit("T"), number=F.lit("5"), heading=F.lit(""), paragraphs=F.array(F.lit(" a "), F.lit(""), F.lit("b")))).first()[0]
    assert art.endswith("---\n# Artikel 5 - T\n\na\n\nb\n") and 'heading: ""' in art
    sec = one.select(render.ordinal_markdown(schema_version="v2", short=F.lit("VwV"), ordinal=F.lit("2.1"), heading=F.lit(None).cast("string"), text=F.lit(" x\n"))).first()[0]
    assert sec.endswith('heading: ""\n---\n# 2.1\n\nx\n') and "ordinal_padded: 02.01" in sec
    dec = one.select(render.decision_markdown(ecli=F.lit("E"), court=F.lit("BGH"), date=F.lit("2024-01-01"), case_no=F.lit("1"), decision_type=F.lit("Urteil"), leitsaetze=F.array(F.lit("a"), F.lit("b")), tenor=F.array().cast("array<string>"), gruende=F.array(F.lit("g"), F.lit("h")), normrefs=F.array(F.lit("§ 1")))).first()[0]
    assert dec.endswith("# BGH 1 — Urteil\n\n## Leitsätze\n\n1. a\n2. b\n\n## Gründe\n\ng\n\nh\n") and 'normrefs:\n  - "§ 1"' in dec
    assert one.select(render.section_counts(F.array(F.lit("b"), F.lit("a"), F.lit("b")))).first()[0] == {"a": 1, "b": 2}


def test_export(spark, tmp_path):
    kind = "bjnr string, path string, heading string, number string, type string, breadcrumb array<string>, text string"
    sections = spark.createDataFrame([("B", "laws/B/annexes/0001.md", "", "", "annex", [], " t\n"), ("B", "laws/B/paragraphs/0002.md", "", "", "paragraph", ["x"], "u"), ("Z", "laws/Z/paragraphs/1.md", "", "", "", [], "no meta")], kind)
    meta = spark.createDataFrame([("B", "", None, None, "slug", {"a": 1}), ("A", "J", "t", None, "s", {}), ("C", "J", "t", None, "s", {})], "bjnr string, jurabk string, title string, stand_datum string, gii_slug string, section_counts map<string,int>")
    records = export.corpus_records(sections, meta)
    export.write_corpus(records, str(tmp_path / "c"))
    lines = [json.loads(r[0]) for p in sorted((tmp_path / "c").glob("part-*")) for r in spark.read.text(str(p)).collect()]
    assert [x["path"] for x in lines] == ["laws/B/paragraphs/0002.md", "laws/B/annexes/0001.md"]
    assert lines[1]["text"] == "t" and lines[1]["title"] == "B" and lines[1]["jurabk"] is None and list(lines[0]) == sorted(lines[0])
    assert [tuple(r) for r in export.by_abbreviation(meta).collect()] == [("J", "A")]
    assert export.summary_markdown(export.export_report(records, meta), "x").endswith("| 3 | 2 |\n")
    assert export.canonical_json({"b": 1, "a": "ü"}) == '{\n  "a": "ü",\n  "b": 1\n}\n'
    assert export.init_tables(spark, "pg_test", {"t": "a int"}) == ["t"] and export.init_tables(spark, "pg_test", {"t": "a int"}) == []


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b", "cites"), ("b", "c", "cites"), ("c", "a", "defines"), ("a", "d", "amends")], "src string, dst string, kind string")
    seeds = spark.createDataFrame([("a",)], "id string")
    near = {(r["node"], r["depth"]) for r in graph.neighbours(edges, seeds, 2, graph.EXPANDED).collect()}
    assert near == {("a", 0), ("b", 1), ("c", 2)}
    assert sorted(">".join(r["path"]) for r in graph.paths(edges, "a", 3).collect()) == ["a>b", "a>b>c", "a>d"]
    kind = "src string, dst string, kind string, valid_from date, confidence double"
    stored = spark.createDataFrame([("a", "b", "cites", None, 0.5)], kind)
    fresh = spark.createDataFrame([("a", "b", "cites", None, 0.9), ("a", "b", "cites", dt.date(2020, 1, 1), 0.7), ("a", "b", "cites", dt.date(2020, 1, 1), 0.8)], kind)
    assert sorted(r["confidence"] for r in graph.upsert_edges(stored, fresh).collect()) == [0.5, 0.8]
    assert [r["valid"] for r in graph.valid_rows(edges.limit(1).withColumn("kind", F.lit("x")), graph.EDGE_KINDS).collect()] == [False]
    held = graph.intervals(spark.createDataFrame([("k", dt.date(2020, 1, 1)), ("k", dt.date(2021, 1, 1))], "k string, d date"), "k", "d")
    assert [r["d"].year for r in graph.valid_at(held, F.lit(dt.date(2021, 1, 1))).collect()] == [2021]
    zero = spark.range(1).select(graph.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0]
    assert zero is None
    ranks = {r["node"]: r["score"] for r in graph.centrality(edges, 2).collect()}
    assert abs(ranks["d"] - (0.15 + 0.85 * (0.15 + 0.85 * 1.0) / 2)) < 1e-9


def test_neighbours_of_cycles_hubs_and_nulls(spark):
    arcs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", None), ("b", "b"), (None, "z"), ("a", None), ("a", "b")] + [("h", f"x{i}") for i in range(50)] + [(f"x{i}", "h") for i in range(50)]
    edges = spark.createDataFrame(arcs, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("a",), ("h",), (None,), ("nowhere",)], "id string")
    got = sorted(map(tuple, graph.neighbours(edges, seeds, 4).collect()), key=str)
    want = {}
    for seed in ("a", "h", None, "nowhere"):
        best, front = {seed: 0}, {seed}
        for hop in range(1, 5):
            front = {d for s, d in arcs if s in front and s is not None} - set(best)
            best.update(dict.fromkeys(front, hop))
        want |= {(seed, node): depth for node, depth in best.items()}
    assert got == sorted(((s, n, d) for (s, n), d in want.items()), key=str)
    assert [tuple(r) for r in graph.neighbours(edges.limit(0), seeds.where("id = 'a'"), 3).collect()] == [("a", "a", 0)]


def test_centrality_names(spark):
    arcs = {("a", "b"), ("b", "a"), ("a", None), ("c", "a"), ("c", "c")}
    got = {r["node"]: r["score"] for r in graph.centrality(spark.createDataFrame([*arcs, *arcs, (None, "y")], "src string, dst string"), 3).collect()}
    nodes = {x for arc in arcs for x in arc}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(3):
        rank = {n: 0.15 + 0.85 * sum(rank[s] / sum(x == s for x, _ in arcs) for s, d in arcs if d == n) for n in nodes}
    assert got.keys() == rank.keys() and all(abs(got[n] - rank[n]) < 1e-9 for n in nodes)
    assert graph.centrality(spark.createDataFrame([], "src string, dst string"), 2).count() == 0
