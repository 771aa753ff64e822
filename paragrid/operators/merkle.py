"""Manifests with hash trees: what is equal below a prefix is never read.

A manifest (path, sha256) is written as rows by bucket, with two levels of nodes
above them: a node for each prefix, the first ``depth`` parts of a path, and a
node for each bucket of prefixes.  A node's hash is the sum and the exclusive or
of its rows' hashes, 128 bits that don't depend on order, so it is made by plain
aggregation, a folder of very many files included.  A difference compares
buckets, then the prefixes of unequal buckets, then the rows of unequal prefixes.

A null path is no row; equal paths count as often as they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import diff as manifests

DEPTH, BUCKETS = 2, 64
NODE = ["n", "h1", "h2"]


def prefix_of(path: Column, depth: int) -> Column:
    """The first ``depth`` parts of a path, never the file itself."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 1, F.least(F.lit(depth), F.size(parts) - 1)), "/")


def _folded(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.bit_xor("h2").alias("h2"))


def write_manifest(rows: DataFrame, root: str, *, depth: int = DEPTH, buckets: int = BUCKETS) -> None:
    """Write ``rows`` (path, sha256) with their tree below ``root``; both sides of a difference have one depth and bucket count."""
    prefix = prefix_of(F.col("path"), depth)
    held = rows.where("path is not null").select("path", "sha256", prefix.alias("prefix"), F.pmod(F.xxhash64(prefix), F.lit(buckets)).cast("int").alias("bucket"))
    shares = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)  # writers of a bucket, so one of a hot prefix has several where there are many tasks
    held.repartition(F.col("bucket"), F.pmod(F.xxhash64("path"), F.lit(shares))).sortWithinPartitions("bucket", "prefix", "path").write.partitionBy("bucket").parquet(f"{root}/rows")
    spark = rows.sparkSession
    stored = spark.read.parquet(f"{root}/rows")
    hashed = stored.select("bucket", "prefix", F.lit(1).cast("long").alias("n"), (F.xxhash64("path", "sha256") % (1 << 40)).alias("h1"), F.xxhash64("sha256", F.lit(7), "path").alias("h2"))
    _folded(hashed, "bucket", "prefix").repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/nodes")
    _folded(spark.read.parquet(f"{root}/nodes"), "bucket").coalesce(1).write.parquet(f"{root}/buckets")  # one row a bucket


def _unequal(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys whose nodes differ, or that one side has not."""
    a = old.select(key, F.struct(*NODE).alias("a"))
    return a.join(new.select(key, F.struct(*NODE).alias("b")), key, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(key)


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets that differ; at most as many as a manifest has."""
    kind = "bucket int, n long, h1 long, h2 long"
    read = lambda root: spark.read.schema(kind).parquet(f"{root}/buckets")
    return sorted(r["bucket"] for r in _unequal(read(old), read(new), "bucket").collect())


def changed_rows(spark: SparkSession, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """The rows of both manifests below prefixes that differ; files of equal buckets are not opened."""
    own = F.col("bucket").isin(changed_buckets(spark, old, new))  # prunes partitions
    nodes, rows = "prefix string, n long, h1 long, h2 long, bucket int", "path string, sha256 string, prefix string, bucket int"
    read = lambda root, name, kind: spark.read.schema(kind).parquet(f"{root}/{name}").where(own)
    prefixes = _unequal(read(old, "nodes", nodes), read(new, "nodes", nodes), "prefix")
    a, b = (read(root, "rows", rows).join(prefixes, "prefix", "left_semi").select("path", "sha256") for root in (old, new))
    return a, b


def diff(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(path, status, before, after) between two written manifests, as ``manifest_diff`` of their rows."""
    return manifests.manifest_diff(*changed_rows(spark, old, new))
