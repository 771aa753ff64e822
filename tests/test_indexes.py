"""Vector cells against all cosines, and manifest trees against the whole difference."""

import numpy as np
from pyspark.sql import functions as F

from paragrid.operators import diff, merkle, vectors


def rows_of(spark, n, width=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return spark.createDataFrame([(i, [float(v) for v in centres[i % 12] + rng.normal(size=width) * 0.6]) for i in range(n)], "vec_id long, embedding array<double>")


def test_recall(spark):
    rows = vectors.usable(rows_of(spark, 1500))
    queries = rows.where("vec_id % 20 = 0")
    cells = vectors.fit(rows, cells=24, sample=600)
    index = vectors.assign(rows, cells)
    truth = vectors.exact(rows, queries, block=30)
    assert index.count() == 1500 and truth.count() == 75 * 12
    few = vectors.recall(vectors.search(rows, index, cells, queries, probes=6), truth).first()
    all_ = vectors.recall(vectors.search(rows, index, cells, queries, probes=24), truth).first()
    assert few["queries"] == 75 and few["found"] >= 0.9 * few["neighbours"] and all_["found"] >= 0.99 * all_["neighbours"]
    ranks = vectors.search(rows, index, cells, queries, probes=6).groupBy("query_id").agg(F.max("rank").alias("r"), F.count("*").alias("n")).collect()
    assert all(r["r"] == r["n"] == 12 for r in ranks)


def test_vector_edges(spark):
    rows = rows_of(spark, 30).unionAll(spark.createDataFrame([(100, None), (101, []), (102, [0.0] * 16), (103, [float("nan")] * 16), (None, [1.0] * 16), (104, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    sound = vectors.usable(rows)
    assert sorted(r["vec_id"] for r in sound.collect()) == [*range(30), 104]
    cells = vectors.fit(sound, cells=4)
    found = vectors.search(sound, vectors.assign(sound, cells), cells, sound, k=3, probes=4)
    truth = vectors.exact(sound, sound, k=3)
    assert sorted((r["query_id"], r["vec_id"]) for r in found.collect()) == sorted((r["query_id"], r["vec_id"]) for r in truth.collect())
    assert vectors.fit(sound.where("false"), cells=4) is None and vectors.exact(sound, sound.where("false")).count() == 0


def test_tree_reads_what_differs(spark, tmp_path):
    old = spark.range(4000).selectExpr("concat('laws/L', id % 200, '/p', id, '.md') as path", "sha2(cast(id as string), 256) as sha256")
    change = F.when(F.col("path").startswith("laws/L7/"), F.lit("neu")).otherwise(F.col("sha256"))
    new = old.where("path <> 'laws/L8/p8.md'").select("path", change.alias("sha256")).unionAll(spark.createDataFrame([("laws/L9/x.md", "1"), ("top", "2"), (None, "3")], "path string, sha256 string"))
    for name, rows in (("old", old), ("new", new), ("same", old)):
        merkle.write_manifest(rows, str(tmp_path / name), buckets=64)
    got, want = merkle.diff(spark, str(tmp_path / "old"), str(tmp_path / "new")), diff.manifest_diff(old, new.where("path is not null"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 23
    a, b = merkle.changed_rows(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    assert a.count() == 60 and b.count() == 61  # three laws of two hundred, and a file beside them
    changed = merkle.changed_buckets(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    assert len(changed) <= 4
    for file in (tmp_path / "old").glob("*/bucket=*/*.parquet"):
        if int(file.parent.name.removeprefix("bucket=")) not in changed:
            file.write_bytes(b"broken")  # reading it would fail
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert merkle.diff(spark, str(tmp_path / "old"), str(tmp_path / "new")).count() == 23
    merkle.write_manifest(old, str(tmp_path / "again"), buckets=64)
    assert merkle.changed_buckets(spark, str(tmp_path / "again"), str(tmp_path / "same")) == [] and merkle.diff(spark, str(tmp_path / "again"), str(tmp_path / "same")).count() == 0
