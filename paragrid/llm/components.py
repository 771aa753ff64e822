"""Connected components of an edge table by alternating large and small stars.

Every round is two pre-aggregated minima and two joins that adaptive execution
can split; nothing is collected.  Each round's edges are written to the shared
folder, so lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1000003)).first())


def connected_components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) of longs to (node, component), the component being its least node.

    Self-loops, repeated and reversed edges are fine; nodes without an edge do
    not appear; no edges give no rows; an edge with a null end is no edge.
    """
    spark = edges.sparkSession
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = shared.materialize(now, "component-edges")
    state = _state(now)
    for _ in range(max_rounds if state[0] else 0):
        both = now.select("u", "v").unionAll(now.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = shared.materialize(large, "component-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = shared.materialize(small, "component-small")
        changed, state = state, _state(after)
        shared.drop_files(large)
        shared.drop_files(now)
        now = after
        shared.release(spark)
        if changed == state:
            break
    else:
        if state[0]:
            raise RuntimeError("components did not settle")
    stars = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.unionAll(roots.join(stars.select("node"), "node", "left_anti"))
