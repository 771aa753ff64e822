import math
import re
import string
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paragrid.llm import lexical

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, k=50):
    """item_id: ordered (doc_id, score)."""
    held = [(d, Counter(t), len(t)) for d, t in ((d, terms(x)) for d, x in docs) if t]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    df = Counter(t for _, c, _ in held for t in c)
    out = {}
    for i, own in asked.items():
        scores = []
        for at, (d, c, n) in enumerate(held):
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, at))
        if scores:
            out[i] = [(None if none else d, -s) for s, none, d, _ in sorted(scores)[:k]]
    return out


def run(spark, docs, items, **kw):
    out = {}
    for r in sorted(lexical.search(docs, items, **kw).collect(), key=lambda r: (str(r["item_id"]), r["rank"])):
        own = out.setdefault(r["item_id"], [])
        own.append((r["doc_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


ITEMS = [(1, "wort1 wort2 WORT2"), (2, "alpha1 alpha2, EXTRA-ende"), (3, None), (4, "  "), (5, "日本語 текст"), (5, "zwei"), (None, "ein drei"), (6, "gibt es nicht xyzzy"), (7, "L" * 50 + " aaaa" * 3)]


def test_terms():
    text = "Ab-c_9ÄÖ\x00z\x7f“q”  [x]`y{z}"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40)))
def test_radix_order(keys):
    keys = np.array(keys, dtype=np.uint64)
    assert lexical.radix_order(keys).tolist() == np.argsort(keys, kind="stable").tolist()


def test_edges(spark, edge_docs, edge_rows, no_docs):
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    clashing = edge_docs.withColumns({c: F.lit(1) for c in ("uid", "n", "terms", "tfs", "item_id", "score", "rank")})
    assert run(spark, clashing, items) == brute(edge_rows, ITEMS)
    assert run(spark, clashing, items, k=2, block_pairs=3) == brute(edge_rows, ITEMS, 2)
    assert run(spark, no_docs, items) == {} and run(spark, edge_docs, items.where("false")) == {}


def test_small_steps(monkeypatch):
    """A bounded number of matches at a time gives the same best documents, ties included."""
    rng = np.random.default_rng(3)
    heads, items = np.array([0, 2, 5, 6]), np.array([0, 1, 0, 1, 2, 2])
    lists = [np.sort(rng.choice(3, rng.integers(1, 4), replace=False)) for _ in range(300)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    terms_, tfs, docs = np.concatenate(lists), rng.integers(1, 3, ends[-1]), [(False, d, d) for d in range(300)]
    best = []
    for matches in (7, 1 << 20):
        block = lexical.Accumulator(heads, items, np.array([500, 300, 200]), 3, 10)
        block.add(docs, np.full(300, 100), ends, terms_, tfs, matches)
        best.append(block.best)
    assert best[0] == best[1] and all(len(b) == 10 for b in best[0])


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    got = {}
    for r in sorted(lexical.op11_ranked_search(spark, small).collect(), key=lambda r: (r["item_id"], r["rank"])):
        got.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
    assert got == brute(docs, items)
