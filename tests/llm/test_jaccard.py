import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paragrid.llm import jaccard
from paragrid.llm.components import connected_components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(doc_id, n, component) of each row; a component is named by its least id."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                root[top(i)] = top(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[top(k)] = min(d, least.get(top(k), d))
    return sorted(((d, len(sets[k]), least.get(top(k), d) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


def run(frame, **options):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame, **options).collect()), key=str)


def near_copies(seed, groups=6, size=9):
    """Groups of copies with edits around the threshold, chains, and a passage that unlike texts share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(1, 6)))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(r.randint(40, 150))]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randint(0, 5)):
                own[r.randrange(len(own))] = word()
            if r.random() < 0.3:
                base = own
            rows.append(own)
    rows += [[word() for _ in range(r.randint(20, 60))] + passage + [word() for _ in range(r.randint(0, 40))] for _ in range(12)]
    r.shuffle(rows)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block": 3}), (3, {})])
def test_brute_force(spark, seed, options):
    rows = near_copies(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(frame, **options) == brute(rows)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    assert run(edge_docs) == brute(edge_rows)
    assert run(no_docs) == []
    unnamed = [(None, "eins zwei drei vier fünf sechs"), (None, "eins zwei drei vier fünf sechs sieben"), (4, None)]
    assert run(spark.createDataFrame(unnamed, "doc_id long, text string")) == brute(unnamed)


def test_hashes_follow_the_words():
    texts = ["", None, "A b\tC", "a B c", "a bc", "x" * 300 + " y", " a b c d e f ", "a b c d e", "é É", "\x0ba\x0cb"]
    got = list(jaccard.shingle_sets(pa.array(texts)))
    want = [shingles(t) for t in texts]
    for a, x in zip(got, want):
        assert len(a) == len(x)
        for b, y in zip(got, want):
            assert np.array_equal(a, b) == (x == y)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sets(st.integers(0, 40), min_size=1)), min_size=2, max_size=30))
def test_trees_lose_no_pair(members):
    mixed = [(k, c, np.unique(jaccard._mix(np.array(sorted(s), dtype=np.uint64) + np.uint64(1)))) for k, (c, s) in enumerate(members)]
    rows = [(k, c, len(s), int.from_bytes(jaccard.bitmap(s), "little"), 8 * len(jaccard.bitmap(s))) for k, c, s in mixed]
    tree = jaccard.build_tree(rows, leaf=2, fan=2)
    found = {frozenset((a[0], b[0])) for a, b in jaccard.tree_pairs(tree, tree)}
    half = len(rows) // 2
    across = {frozenset((a[0], b[0])) for a, b in jaccard.tree_pairs(jaccard.build_tree(rows[:half], 2, 2), jaccard.build_tree(rows[half:], 2, 2))} if half else set()
    for i, (_, c, s) in enumerate(mixed):
        for j, (_, d, t) in enumerate(mixed[:i]):
            common = len(np.intersect1d(s, t))
            if c != d and 100 * common >= 80 * (len(s) + len(t) - common):
                assert frozenset((i, j)) in found
                assert j >= half or i < half or frozenset((i, j)) in across


def test_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(15)] + [(7, 7), (200, 201), (201, 200)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = top(a), top(b)
            root[max(p, q)] = min(p, q)
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage(spark, edge_docs, edge_rows):
    out = jaccard.jaccard_stage(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert kept == {c for _, _, c in brute(edge_rows)} - {None}  # the row without an id is a copy of one with an id


def test_stage_leaves_one_row_of_each_group(spark):
    near = [" ".join(f"n{i}" if i != 90 + k else f"x{k}" for i in range(100)) for k in range(3)]
    other = [" ".join(f"{c}{i}" for i in range(100)) for c in "abcd"]
    rows = [(1, near[0]), (2, near[1]), (2, other[0]), (3, other[1]), (3, other[1]), (3, other[1]), (None, other[2]), (None, other[2]), (None, other[3]), (None, other[3] + " ende"), (9, None), (9, "")]
    out = jaccard.jaccard_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    got = [tuple(r) for r in out.collect()]
    last = [r for r in got if (r[1] or "").startswith("d0")]
    assert len(last) == 1 and last[0] in rows
    want = [(1, near[0]), (2, other[0]), (3, other[1]), (None, other[2]), (9, None), (9, "")]
    assert sorted((r for r in got if r not in last), key=str) == sorted(want, key=str)


def test_sets_that_share_half_a_name(spark, monkeypatch):
    """With names cut to two bits most first halves are shared; the second ones then tell the sets apart."""
    whole = jaccard.set_names

    def short(shingles):
        low, high = whole(shingles)
        return (low, high) if low is None else (low & 3, high)

    def key(shingles, taken=frozenset()):  # tasks find the module's own functions by name, so this one is patched too
        low, high = short(shingles)
        return high if low in taken else low

    monkeypatch.setattr(jaccard, "class_key", key)
    rows = [(k, " ".join(f"w{k % 9}x{i}" if i != 80 + k else "neu" for i in range(100 + 20 * (k % 5)))) for k in range(40)] + [(50, None), (51, "w0x0 w0x1")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "set_names", short)
    signed = jaccard._signatures(frame.selectExpr("doc_id", "text", "xxhash64(text) as mark"), 5)
    assert len(jaccard._taken_names(signed)) > 1
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame).collect()), key=str)
    assert got == brute(rows)


def test_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.op7_ngram_jaccard(spark, small).collect()), key=str)
    assert got == brute(rows)
