import hashlib
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paragrid.llm import exactdup

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    """(doc_id, keep_id, size, kept, digest) of each row."""
    groups = defaultdict(list)
    for k, (d, t) in enumerate(rows):
        groups[(t or "").translate(FOLD)].append(((d is not None, d or 0), k))
    out = []
    for t, own in groups.items():
        last = max(own)[1]
        out += [(rows[k][0], rows[last][0], len(own), k == last, hashlib.sha256(t.encode()).hexdigest()) for _, k in own]
    return sorted(out, key=str)


def run(frame, **kw):
    return sorted((tuple(r) for r in exactdup.dedup_exact(frame, **kw).collect()), key=str)


CASES = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, "ÄBC"), (5, "äbc"), (6, None), (7, ""), (None, "abc"), (None, "nur"), (None, "NUR"), (9, "x" * 300_000), (10, "X" * 300_000)]


def test_brute_force(spark):
    frame = spark.createDataFrame(CASES, "doc_id long, text string").repartition(3)
    assert run(frame) == brute(CASES)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    clashing = edge_docs.withColumns({c: F.lit(1) for c in ("key", "digest", "uid", "size", "norm", "keep_id", "first")})
    assert run(clashing) == brute(edge_rows)
    assert run(no_docs) == []


@pytest.mark.parametrize("weak", ["key", "digest", "both"])
def test_chains_of_colliding_texts(spark, monkeypatch, weak):
    """Weak hashes: chains hold many texts, entries hold several; bytes still decide."""
    if weak != "digest":
        monkeypatch.setattr(exactdup, "key_of", lambda t: F.pmod(F.xxhash64(t), F.lit(3)))
    if weak != "key":
        monkeypatch.setattr(exactdup, "digest_of", lambda t: F.unhex(F.lpad(F.hex(F.pmod(F.hash(t), F.lit(4))), 2, "0")))
    rows = CASES[:10] + [(100 + k, f"text {k % 17}") for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = lambda found: sorted(str(r[:4]) for r in found)  # noqa: E731  the digest is the weak one
    assert plain(run(frame, capacity=2)) == plain(brute(rows))


def test_directory_doubles_only_where_it_must(spark):
    keys = [(k << 40, b"a") for k in range(200)] + [((1 << 63) - 1 - (k << 55), b"b") for k in range(30)] + [(-5, b"c")]
    entries = spark.createDataFrame([(k, d) for k, d in keys], "key long, digest binary")
    rows = exactdup.hash_directory(entries, capacity=8).collect()
    assert sum(r["entries"] for r in rows) == len(keys) and all(r["entries"] <= 8 for r in rows)
    depth = {(r["depth"], r["prefix"]): r["entries"] for r in rows}
    for (d, p) in depth:
        assert not any((d - up, p >> up) in depth for up in range(1, d))  # ranges don't overlap
        parent = sum(1 for k, _ in keys if (k % (1 << 64)) >> (64 - d + 1) == p >> 1) if d > 1 else 9
        assert parent > 8  # no split without an overfull parent
    assert len({d for d, _ in depth}) > 2


def test_one_key_is_one_bucket(spark):
    entries = spark.range(50).selectExpr("7L as key", "cast(cast(id as string) as binary) as digest")
    rows = exactdup.hash_directory(entries, capacity=4).collect()
    assert [(r["depth"], r["entries"]) for r in rows] == [(exactdup.DEEPEST, 50)]


def test_index_files(spark):
    """Each bucket lies in one file, and a key's entries are numbered."""
    frame = spark.range(500).selectExpr("id as doc_id", "concat('t', id % 300) as text")
    _, directory, buckets = exactdup.build_index(frame, capacity=16)
    per = buckets.select("first", F.input_file_name().alias("f")).groupBy("first").agg(F.countDistinct("f").alias("files"), F.count("*").alias("n")).collect()
    assert all(r["files"] == 1 and r["n"] <= 16 for r in per) and len(per) == directory.count()
    assert buckets.count() == 300 and buckets.where("link <> 1").isEmpty()
