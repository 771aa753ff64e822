import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paragrid.llm import negatives, shared


def brute(rows, step=100):
    """Sorted result rows; ``rows`` are (vec_id, vector, label) after the change of labels."""
    held = []
    for v, x, y in rows:
        if y is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        held.append((v, [math.floor(256 * float(c)) for c in x], y))
    out = []
    for a, (va, xa, ya) in enumerate(held):
        if va is None or va % step:
            continue
        score = [sum(p * q for p, q in zip(xa, x)) for _, x, _ in held]
        place = lambda i: (-score[i], held[i][0] is None, held[i][0] or 0, i)
        for p in sorted((i for i in range(len(held)) if i != a and held[i][2] == ya), key=place)[:5]:
            near = [i for i in range(len(held)) if held[i][2] != ya and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(va, held[p][0], rank, held[n][0], score[p], score[n]) for rank, n in enumerate(sorted(near, key=place)[:5], 1)]
    return sorted(out, key=str)


def run(frame, step=100, **kw):
    rows = shared.materialize(negatives.taking_part(frame), "test-rows")
    return sorted((tuple(r) for r in negatives.mine(rows, F.col("vec_id") % step == 0, **kw).collect()), key=str)


def made(n, seed=1, labels=4, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width)) * 0.4 + 0.3
    return [(i, [float(x) for x in (centres[i % labels] + rng.normal(size=width) * 0.2).astype(np.float32)], int(i % labels if i % 9 else 0)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_small_trees_blocks_and_groups(spark):
    rows = made(400)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert run(frame, 20, tree_rows=37, block=3, group=2) == brute(rows, 20)


def test_edges(spark):
    rows = made(60, seed=2) + [
        (100, None, 1), (100, [0.1], None), (200, [0.2, None], 1), (300, [float("nan")], 2), (400, [float("inf")], 1), (None, [0.4] * 6, 1),
        (500, [], 3), (600, [0.5, 0.4], 2), (700, [-0.5] * 6, 1), (800, [0.0] * 6, 0), (900, [1e4] * 6, 1), (901, [1e4] * 6, 2), (0, *made(1)[0][1:]),
    ]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", score string, uid int").repartition(3)
    assert run(frame) == brute(rows)
    assert run(frame.where("false")) == [] and run(frame.where("vec_id % 100 <> 0")) == []


def test_ties_and_copies(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(40)] + [(0, [0.5, 0.25], 0)] * 3
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert run(frame, 10, tree_rows=8, block=2, group=1) == brute(rows, 10)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 90), st.integers(1, 3))
def test_bounds_hold(seed, n, labels):
    """Each node's bounds hold for all its rows, its labels are its rows', and children share out their parent."""
    rng = np.random.default_rng(seed)
    v, label = rng.integers(-300, 300, (n, 3)), rng.integers(0, labels, n)
    tree = negatives.grow(v, label, np.arange(n), np.arange(n), leaf_rows=4)
    anchors = rng.integers(-300, 300, (5, 3))
    low, high = negatives.reach(anchors, tree.centre, tree.radius)
    for k in range(len(tree.begin)):
        rows = slice(tree.begin[k], tree.end[k])
        scores = anchors @ tree.v[rows].T
        assert (scores >= low[:, [k]]).all() and (scores <= high[:, [k]]).all()
        assert (tree.low[k], tree.high[k]) == (tree.label[rows].min(), tree.label[rows].max())
        if tree.left[k] >= 0:
            left, right = tree.left[k], tree.right[k]
            assert (tree.begin[left], tree.end[left], tree.end[right]) == (tree.begin[k], tree.begin[right], tree.end[k])
        else:
            assert tree.end[k] - tree.begin[k] <= 4
    assert sorted(tree.uid.tolist()) == list(range(n))


def test_nodes_are_pruned():
    """Rows outside the window, above or below, are not looked at, nor rows beneath the k-th."""
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.integers(0, 9, (640, 4)) + at for at in range(0, 5000, 500)])
    tree = negatives.grow(v, np.ones(len(v), dtype=np.int64), np.arange(len(v)), np.arange(len(v)))
    anchor = np.array([[1, 1, 1, 1]])
    leaves = int((tree.left < 0).sum())
    for low, high in ((8000, 8100), (negatives.NONE, negatives.LAST)):
        s = negatives.Searches(anchor, np.array([0]), np.array([-1]), np.array([0]), np.array([low]), np.array([high]), same=False, k=5)
        s.walk(tree)
        scores = (v @ anchor[0])
        want = np.sort(scores[(scores >= low) & (scores <= high)])[::-1][:5]
        assert s.score[0].tolist() == want.tolist() and s.leaves < leaves / 4


def test_exact_products():
    a = np.array([[1 << 40, 1], [3, 1 << 20]])
    assert negatives.products(a, np.array([[1 << 20, 5]])).tolist() == [[(1 << 60) + 5], [8 << 20]]
    with pytest.raises(ValueError):
        negatives.products(a, a)


def test_query(spark, small):
    rows = [(v, x, (y + 1) % 10 if y is not None and v is not None and v % 7 == 0 else y) for v, x, y in map(tuple, spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect())]
    assert sorted((tuple(r) for r in negatives.op12_hard_negatives(spark, small).collect()), key=str) == brute(rows)
