import math
import os
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from paragrid.llm import quality


def measure(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    hit = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_of_edge_texts(spark, edge_docs, edge_rows, no_docs):
    more = [(900, "a b c a b c a b c"), (901, "x " * 5000), (902, "a b c d a b c e a b"), (903, "#a\n#a\n\n#a\n "), (904, "q\x1cw\x85e f")]
    frame = edge_docs.select("doc_id", "text", "lang").unionAll(spark.createDataFrame([(*r, "de") for r in more], "doc_id long, text string, lang string"))
    got = sorted((str(r["doc_id"]), *(r[n] for n in NAMES)) for r in quality.measure(frame).collect())
    assert got == sorted((str(d), *measure(t)) for d, t in [*edge_rows, *more])
    assert quality.measure(no_docs).count() == 0


def tail(x, n, p):
    log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(k)) for k in range(x + 1)))


def test_binomial_tail(spark):
    cases = [(0, 10, 0.01), (3, 100, 0.02), (20, 3000, 0.005), (0, 200_000, 0.0025)]
    for x, n, p in cases:
        got = spark.sql(f"select {quality.log_tail('x', 'n', p)} from values ({x}L, {n}L) as t(x, n)").first()[0]
        want = math.log(tail(x, n, p)) if n < 10_000 else n * math.log1p(-p)
        assert abs(got - want) < 1e-6 * max(1, abs(want))


RATED = "doc_id long, stratum string, base_failed boolean, score long"


def brute_cutoffs(rows, alpha, delta):
    """Strata by labels; the share of the level; the strictest cutoff before the first that fails."""
    held = {}
    for _, s, _, score in rows:
        held.setdefault(s, []).append(score)
    sizes = sorted(map(len, held.values()), reverse=True)
    k = max((i for i, n in enumerate(sizes, 1) if (1 - alpha) ** n <= delta / i), default=0)
    out = {}
    for s, scores in held.items():
        if k and len(scores) >= sizes[k - 1]:
            cutoff = quality.TOP + quality.GRID
            while cutoff > 1000 and tail(sum(x >= cutoff - quality.GRID for x in scores), len(scores), alpha) <= delta / k:
                cutoff -= quality.GRID
            out[s] = cutoff
    return out


def test_certified_cutoffs_hold_their_bound(spark):
    # thirty of 4000 good documents score high, a few of 300 do, 250 do not at all, 40 are too few to say
    rows = [(i, "a", False, 3000 + 50 * i if i < 30 else i % 1500) for i in range(4000)]
    rows += [(5000 + i, "b", False, 7999 - 400 * i if i < 5 else 10) for i in range(300)] + [(6000 + i, None, False, 20) for i in range(250)] + [(7000 + i, "d", False, i) for i in range(40)]
    rated = spark.createDataFrame([*rows, (8000, "a", True, 9), (3999, "a", False, 8000)], RATED)
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in rows] + [(3999, 0, 0), (8000, 1, 0)], "doc_id long, quality int, toxic int")
    for alpha in (0.01, 0.02, 0.05):
        got = {r["stratum"]: r["cutoff"] for r in quality.certify(rated, labels, alpha=alpha).collect()}
        assert got == brute_cutoffs([r for r in rows if r[0] != 3999], alpha, quality.DELTA)
    assert set(got) == {"a", "b", None} and got[None] == 1000
    assert quality.certify(rated.where("stratum = 'd'"), labels).count() == 0


def test_small_strata_reject_planted_junk(spark, tmp_path):
    """Production parameters: 220 labels a stratum are enough for four strata; junk goes, good documents stay."""
    clean = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    junk = lambda k: " ".join(f"w{k}x{i}###" for i in range(60))
    docs = [(1000 * j + i, clean(i), lang) for j, lang in enumerate(("de", "en", "es", None)) for i in range(220)]
    bad = [(9000 + j, junk(j), lang) for j, lang in enumerate(("de", "en", "es", None, "xx"))]
    frame = spark.createDataFrame(docs + bad, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(d, 1, 0) for d, *_ in docs] + [(9000, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = {r["doc_id"] for r in quality.quality_stage(spark, frame, str(tmp_path)).collect()}
    assert out == {d for d, *_ in docs} | {9004}  # the last one's stratum has no labels


def test_verdicts_and_stage(spark, edge_docs, tmp_path):
    spark.createDataFrame([(9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = quality.quality_stage(spark, edge_docs, str(tmp_path))
    assert out.columns == edge_docs.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert 5 in kept and 0 not in kept and 1 not in kept


def test_stage_judges_each_row(spark, tmp_path):
    spark.createDataFrame([(9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    good = [" ".join(f"wort{k}x{i}" for i in range(80)) for k in range(4)]
    rows = [(None, good[0], "de"), (None, "zu kurz", "de"), (None, None, "de"), (None, good[1], None), (7, good[2], "en"), (7, "auch zu kurz", "en"), (8, good[3], "en"), (8, good[3], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = quality.quality_stage(spark, docs, str(tmp_path))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted((r for r in rows if r[1] in good), key=str)


def test_query(spark, small):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    want = con.sql(quality.ORACLE_SQL["op10_quality_rules"])
    got = quality.op10_quality_rules(spark, small)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
    assert got.where(F.col("base_failed") & F.col("kept")).count() == 0


def test_query_rejects_more_than_the_base_rule(spark):
    """On a table with enough labels the verdict is not the base rule's, and equals its SQL."""
    place = "/root/testdata/sf0.01"
    if not os.path.isdir(place):
        pytest.skip("no test data here")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{place}/{t}.parquet'")
    want = con.sql(quality.ORACLE_SQL["op10_quality_rules"]).df().set_index("doc_id")["kept"].to_dict()
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.op10_quality_rules(spark, place).collect()}
    assert {d: k for d, (_, k) in got.items()} == want
    assert sum(not base and not kept for base, kept in got.values()) > 0
