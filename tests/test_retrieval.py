"""Block bounds against scoring everything, meeting frontiers against all paths, segments against one window."""

import random

import pytest
from pyspark.sql import functions as F

from paragrid.operators import folds, graph, retrieval


def test_search_is_exhaustive(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(300)]
    docs = [(i * 3, " ".join(rng.choices(words, weights=[1 / (n + 1) for n in range(300)], k=rng.randint(1, 60)))) for i in range(1200)]
    docs += [(7, "selten selten Wort"), (7, "noch ein Wort"), (8, None), (10, ""), (None, "selten"), (-5, "Selten §"), (11, "x " * 20000), (13, "w1 w2"), (14, "w1 w2")]
    queries = [(q, " ".join(rng.choices(words, k=4))) for q in range(40)] + [(100, "SELTEN wort"), (101, "gibtsnicht"), (102, None), (103, ""), (None, "w1"), (104, "w1 w1 w2")]
    index = retrieval.build(spark.createDataFrame(docs, "doc long, body string"), "doc", "body", str(tmp_path / "index"))
    asked = spark.createDataFrame(queries, "q long, body string")
    got = sorted(map(tuple, retrieval.search(spark, index, asked, "q", "body", k=5).collect()))
    every = {}
    for r in retrieval.exhaustive(spark, index, asked, "q", "body").collect():
        every.setdefault(r["query_id"], []).append((-r["score"], r["id"]))
    want = sorted((q, n, d, -s) for q, rows in every.items() for n, (s, d) in enumerate(sorted(rows)[:5], 1))
    assert got == want and {r[0] for r in got} == {*range(40), 100, 104}
    assert [r[2] for r in got if r[0] == 100] == [7, -5]
    # a document is scored by hand: its words, its length, the documents that hold the word
    counted = {}
    for d, t in docs:
        if d is not None and (own := (t or "").lower().replace("§", "").split()):
            counted.setdefault(d, []).extend(own)
    import math

    mean = 1000 * sum(map(len, counted.values())) // len(counted)
    df = sum("selten" in v for v in counted.values()), sum("wort" in v for v in counted.values())
    m = 250 + 750000 * len(counted[7]) // mean
    score = sum(math.floor(1000 * math.log(1 + (len(counted) - f + 0.5) / (f + 0.5))) * (2200000000 * 2 // (2000 + 6 * m // 5)) for f in df)
    assert next(r for r in got if r[0] == 100)[3] == score and index.documents == len(counted)


def test_search_opens_few_windows(spark, tmp_path):
    docs = spark.range(4000).select("id", F.concat(F.lit("gemein "), F.when(F.col("id") % 1000 == 5, F.lit("gemein selten")).otherwise(F.lit("anders hier"))).alias("body"))
    index = retrieval.build(docs, "id", "body", str(tmp_path / "index"))
    asked = retrieval.ask(spark, index, spark.createDataFrame([(1, "gemein selten")], "q long, body string"), "q", "body")
    reach, chosen = retrieval.windows(index.blocks(spark), asked, 4)
    assert reach.count() == 63 and chosen.count() == 4
    empty = retrieval.build(docs.where("false"), "id", "body", str(tmp_path / "empty"))
    assert retrieval.search(spark, empty, docs, "id", "body").count() == 0


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_paths_meet(spark, depth):
    rng = random.Random(depth)
    edges = {(rng.randint(0, 14), rng.randint(0, 14)) for _ in range(45)}
    rows = [*sorted(edges), (3, 3), (None, 4), (4, None), next(iter(edges))]
    pairs = [(a, b) for a in range(15) for b in range(0, 15, 4)] + [(2, 2), (None, 1), (99, 1), (0, 4)]
    frame = spark.createDataFrame(rows, "src int, dst int")
    got = graph.paths_between(frame, spark.createDataFrame(pairs, "source int, target int"), depth).collect()

    def walk(path):
        for a, b in edges:
            if a == path[-1] and b not in path:
                yield [*path, b]
                if len(path) < depth:
                    yield from walk([*path, b])

    want = sorted((p[0], p[-1], p) for a in range(15) for p in walk([a]) if p[-1] % 4 == 0)
    assert sorted(map(tuple, got)) == want
    one = {tuple(r["path"]) for r in graph.paths(frame.where("src <> dst"), 0, depth).collect()}
    assert {tuple(r["path"]) for r in got if r["source"] == 0} == {p for p in one if p[-1] % 4 == 0}


def test_star_stays_closed(spark, monkeypatch):
    """A hub of 20 000 spokes, asked for from a spoke and to one: the spokes are not walked."""
    spokes = spark.range(1, 20001)
    edges = spokes.selectExpr("0L as src", "id as dst").unionAll(spokes.selectExpr("id", "0L"))
    sizes, keep = [], graph.files.materialize
    monkeypatch.setattr(graph.files, "materialize", lambda df, name: (out := keep(df, name), sizes.append((name, out.count())))[0])
    got = graph.paths_between(edges, spark.createDataFrame([(5, 9), (0, 7), (8, 0)], "source long, target long"), 2).collect()
    assert sorted(r["path"] for r in got) == [[0, 7], [5, 0, 9], [8, 0]]
    assert max(n for name, n in sizes if name != "graph-steps") < 20


@pytest.mark.parametrize("segments", [1, 3, 8])
def test_segments(spark, segments):
    rng = random.Random(segments)
    rows = [(rng.choice(["a", "b", None]) if n % 3 else "a", n, rng.choice([None, None, 1, 2, 3, 6]), rng.choice([f"h{n}", f"h{n}", None])) for n in range(600)]
    frame = spark.createDataFrame(rows, "doc string, pos int, depth int, label string").withColumns({"segment": F.lit("mine"), "row": F.lit(1), "p1": F.lit(2)})
    got = folds.heading_stack_scan(frame, "doc", ["pos"], "depth", "label", segments=segments)
    stacks = {None: {}}
    want = []
    for doc, pos, depth, label in rows:
        live = stacks.setdefault(doc, {})
        if depth:
            for k in [k for k in live if k >= depth]:
                del live[k]
            live[depth] = label
        want.append((pos, [live[k] for k in sorted(live) if live[k] is not None]))
    assert got.columns == [*frame.columns, "stack"]
    assert sorted((r["pos"], list(r["stack"])) for r in got.collect()) == want
    assert folds.heading_stack_scan(frame.where("false"), "doc", ["pos"], "depth", "label").count() == 0


def test_no_task_holds_a_long_document(spark):
    rows = spark.range(200000).selectExpr("'one' as doc", "id as pos", "case when id % 50 = 0 then 1 when id % 7 = 0 then 2 end as depth", "string(id) as label")
    seen = []
    keep = folds.files.materialize

    def spy(df, name):
        out = keep(df, name)
        seen.extend(r["count"] for r in out.groupBy("segment").count().collect())
        return out

    folds.files.materialize, old = spy, folds.files.materialize
    try:
        got = folds.heading_stack_scan(rows, "doc", ["pos"], "depth", "label", segments=16)
        assert got.where("size(stack) = 0").count() == 0
    finally:
        folds.files.materialize = old
    assert len(seen) >= 4 and max(seen) < 200000 / 2 and sum(seen) == 200000
