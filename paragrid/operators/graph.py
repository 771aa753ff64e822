"""Typed citation graph: keys, upserts, neighbours, paths, vectors, fused ranks, centrality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import files
from ..sources.files import shared_root

#: Node and edge kinds of the documented model.
NODE_KINDS = ("law", "section", "decision", "concept", "court", "authority", "person_role")
EDGE_KINDS = ("cites", "amends", "defines", "applies_to", "interprets", "overrules", "implements", "part_of", "supersedes", "similar_to")
EXPANDED = ("cites", "applies_to", "defines")
SEED_SIZE, DEPTH, CONFIDENT = 12, 2, 0.8


def node_id(kind: str, *parts: Column) -> Column:
    """Kind-prefixed key."""
    return F.concat_ws(":", F.lit(kind), *parts)


def valid_rows(rows: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Adds ``valid``: the kind is one of the allowed."""
    return rows.withColumn("valid", F.coalesce(F.col("kind").isin(*allowed), F.lit(False)))


def upsert_edges(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored edges and the fresh ones that are new by (src, dst, kind, valid_from); of equal fresh ones the most confident."""
    keys = ["src", "dst", "kind", "valid_from"]
    best = fresh.groupBy(*keys).agg(F.max("confidence").alias("confidence"))
    seen = stored.select(*(F.col(k).alias(f"_{k}") for k in keys))
    match = F.lit(True)
    for k in keys:
        match = match & best[k].eqNullSafe(seen[f"_{k}"])
    return stored.select(*keys, "confidence").unionByName(best.join(seen, match, "left_anti"))


def fan_out(edges: DataFrame, least: float = CONFIDENT) -> DataFrame:
    """Confident edges with how many their source has of that kind."""
    return edges.where(F.col("confidence") >= least).withColumn("fan_out", F.count("*").over(Window.partitionBy("src", "kind")))


def neighbours(edges: DataFrame, seeds: DataFrame, depth: int = DEPTH, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """(seed, node, depth): nodes reached, each at its least depth.

    A hop goes on from the nodes that it was the first to reach, so a cycle or a
    hub met again opens nothing; each hop's nodes are written once.
    """
    if kinds:
        edges = edges.where(F.col("kind").isin(*kinds))
    step = files.materialize(edges.select("src", "dst").distinct(), "graph-steps")
    front = seeds.select(F.col("id").alias("seed"), F.col("id").alias("node")).distinct()
    found = front.withColumn("depth", F.lit(0))
    for hop in range(1, depth + 1):
        reached = front.join(step, F.col("node") == F.col("src")).select("seed", F.col("dst").alias("node")).distinct()
        known = found.select(F.col("seed").alias("_seed"), F.col("node").alias("_node"))
        front = reached.join(known, F.col("seed").eqNullSafe(F.col("_seed")) & F.col("node").eqNullSafe(F.col("_node")), "left_anti")
        front = files.materialize(front, "graph-front") if hop < depth else front
        found = found.unionByName(front.withColumn("depth", F.lit(hop)))
    return found


def paths(edges: DataFrame, source: str, depth: int = 3) -> DataFrame:
    """Simple paths from a node, as arrays, up to a depth."""
    step = edges.select("src", "dst").distinct()
    front = step.where(F.col("src") == source).select(F.array("src", "dst").alias("path"))
    out = front
    for _ in range(depth - 1):
        front = front.join(step, F.element_at("path", -1) == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.array_append("path", F.col("dst")).alias("path"))
        out = out.unionByName(front)
    return out


def paths_between(edges: DataFrame, pairs: DataFrame, depth: int = 3) -> DataFrame:
    """(source, target, path): all simple paths of at most ``depth`` edges of each (source, target), as arrays.

    Two frontiers grow towards each other, ``depth`` steps in all, each pair's
    next step on the side whose frontier has fewer edges to cross, so a hub at one
    end is not opened while the other end is cheaper.  An edge of a path is crossed
    by one side or the other; paths are then put together out of crossed edges
    alone, and only along nodes near enough to the target to arrive in time.
    Only inner nodes are opened up to, those that one neighbour leads to and another
    one follows; a pair's own ends are looked up.  So the leaves of a hub cost
    nothing, while its other neighbours are held for each pair that opens it.
    Null nodes, loops, and pairs of one node twice have no paths.
    """
    pair = ["source", "target"]
    step = files.materialize(edges.select("src", "dst").where("src <> dst").distinct(), "graph-steps")
    around = step.select(F.lit(True).alias("out"), F.col("src").alias("at"), F.col("dst").alias("by")).unionAll(step.select(F.lit(False), "dst", "src"))
    around = around.groupBy("at").agg(*(f(F.when(F.col("out") == out, F.col("by"))).alias(f"{n}_{out}") for out in (True, False) for n, f in (("least", F.min), ("most", F.max))))
    only = (F.col("least_True") == F.col("most_True")) & (F.col("least_False") == F.col("most_False")) & (F.col("least_True") == F.col("least_False"))
    inner = files.materialize(around.where(F.col("least_True").isNotNull() & F.col("least_False").isNotNull() & ~only).select(F.col("at").alias("next")), "graph-inner")
    every = step.select(F.lit(True).alias("ahead"), F.col("src").alias("node"), F.col("dst").alias("next"))
    every = every.unionAll(step.select(F.lit(False), "dst", "src"))
    arcs = files.materialize(every.join(inner, "next", "left_semi").select("ahead", "node", "next"), "graph-arcs")
    degrees = arcs.groupBy("ahead", "node").agg(F.count("*").alias("cost"))
    ends = pairs.select(*pair).where("source <> target").distinct()
    front = ends.select(*pair, F.explode(F.array(F.struct(F.lit(True).alias("ahead"), F.col("source").alias("node")), F.struct(F.lit(False).alias("ahead"), F.col("target").alias("node")))).alias("e")).select(*pair, "e.*")
    front = found = files.materialize(front, "graph-front")
    crossed = None
    for _ in range(depth):
        costs = front.join(degrees, ["ahead", "node"], "left").groupBy(*pair).agg(
            F.coalesce(F.sum(F.when(F.col("ahead"), F.col("cost"))), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(~F.col("ahead"), F.col("cost"))), F.lit(0)).alias("b")
        )
        turn = costs.select(*pair, (F.col("a") <= F.col("b")).alias("ahead"))
        moving = front.join(turn, [*pair, "ahead"])
        goal = F.when(F.col("ahead"), F.col("target")).otherwise(F.col("source"))
        arrived = moving.withColumn("next", goal).join(every, ["ahead", "node", "next"], "left_semi").select(*pair, "ahead", "node", "next")
        grown = files.materialize(moving.join(arcs, ["ahead", "node"]).where(F.col("next") != goal).select(*pair, "ahead", "node", "next").unionAll(arrived), "graph-crossed")
        crossed = grown if crossed is None else crossed.unionAll(grown)
        fresh = grown.select(*pair, "ahead", F.col("next").alias("node")).distinct().join(found, [*pair, "ahead", "node"], "left_anti")
        # No path goes on from its target, nor comes through its source; the side that did not move keeps its frontier.
        fresh = fresh.where(F.col("node") != F.when(F.col("ahead"), F.col("target")).otherwise(F.col("source")))
        front = files.materialize(fresh.unionByName(front.join(turn, [*pair, "ahead"], "left_anti")), "graph-front")
        found = found.unionByName(front).distinct()
    at = F.when(F.col("ahead"), F.col("node")).otherwise(F.col("next"))
    to = F.when(F.col("ahead"), F.col("next")).otherwise(F.col("node"))
    used = files.materialize(crossed.select(*pair, at.alias("u"), to.alias("v")).distinct(), "graph-used")
    left = near = ends.select(*pair, F.col("target").alias("v"), F.lit(0).alias("left"))
    for hop in range(1, depth):
        near = used.join(near.select(*pair, "v"), [*pair, "v"]).select(*pair, F.col("u").alias("v")).distinct().join(left.select(*pair, "v"), [*pair, "v"], "left_anti")
        near = files.materialize(near.withColumn("left", F.lit(hop)), "graph-near")
        left = left.unionByName(near)
    useful = files.materialize(used.join(left, [*pair, "v"]), "graph-useful")
    walk, out = ends.select(*pair, F.array("source").alias("path")), None
    for hop in range(depth):
        ahead = walk.withColumn("u", F.element_at("path", -1)).join(useful.where(F.col("left") < depth - hop), [*pair, "u"])
        walk = ahead.where(~F.array_contains("path", F.col("v"))).select(*pair, F.array_append("path", F.col("v")).alias("path"))
        there = F.element_at("path", -1) == F.col("target")
        out = walk.where(there) if out is None else out.unionAll(walk.where(there))
        walk = walk.where(~there)
    return out


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; null if a length is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def vector_seed(vectors: DataFrame, probe: DataFrame, k: int = SEED_SIZE) -> DataFrame:
    """The k rows most alike to the probe, ties by id; a probe of several rows is an error."""
    held = vectors.select("vec_id", "embedding", probe.select("embedding").scalar().alias("_probe"))
    scored = held.select("vec_id", F.round(cosine(F.col("embedding"), F.col("_probe")), 6).alias("score"))
    return scored.orderBy(F.desc("score"), "vec_id").limit(k)


def mean_vectors(members: DataFrame, key: str) -> DataFrame:
    """(key, pos, value): mean of the members' vectors, position by position."""
    return members.select(key, F.posexplode("embedding").alias("pos", "value")).groupBy(key, "pos").agg(F.avg(F.col("value").cast("double")).alias("value"))


def fused_rank(vector: DataFrame, graph: DataFrame, key: str, alpha: float, beta: float) -> DataFrame:
    """alpha * vector score + beta * graph score, a missing one counting zero."""
    both = vector.select(key, F.col("score").alias("_v")).join(graph.select(key, F.col("score").alias("_g")), key, "full")
    return both.select(key, (alpha * F.coalesce("_v", F.lit(0.0)) + beta * F.coalesce("_g", F.lit(0.0))).alias("score"))


def lexical_or_vector(rows: DataFrame, lexical: Column, vector: Column) -> DataFrame:
    """Adds ``score``: the vector score where there is an embedding, else the lexical one."""
    return rows.withColumn("score", F.when(F.col("embedding").isNull(), lexical).otherwise(vector))


def centrality(edges: DataFrame, rounds: int = 5, damping: float = 0.85) -> DataFrame:
    """(node, score) after fixed rounds of rank passing along (src, dst); shares are of 1 for each node.

    Mass at nodes without an outgoing edge is not passed on.  Names become
    numbers once, in a written table, and come back at the end, so the rounds
    move and compare numbers alone.  The shares stay partitioned by source for
    all rounds; they and each round's scores go to the shared folder, so a lost
    executor costs no round and plans don't grow.
    """
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    links = files.materialize(edges.select("src", "dst").where("src is not null").distinct(), "graph-links")
    named = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("no", F.monotonically_increasing_id())
    named = files.materialize(named, "graph-names")  # the numbers are what was written
    from_, to = (named.select(F.col("node").alias(f"_{end}"), F.col("no").alias(f"{end}_no")) for end in ("src", "dst"))
    numbered = links.join(from_, F.col("src") == F.col("_src")).join(to, F.col("dst").eqNullSafe(F.col("_dst"))).select(F.col("src_no").alias("src"), F.col("dst_no").alias("dst"))
    shares = numbered.withColumn("n", F.count("*").over(Window.partitionBy("src"))).checkpoint()
    nothing = named.select(F.col("no").alias("dst"), F.lit(0.0).alias("got")).repartition("dst").checkpoint()
    ranks = nothing.select(F.col("dst").alias("node"), F.lit(1.0).alias("score"))
    for k in range(rounds):  # one exchange a round: the sums are partitioned by node, as the next join needs
        passed = shares.join(ranks, F.col("src") == F.col("node")).select("dst", (F.col("score") / F.col("n")).alias("got"))
        ranks = passed.unionAll(nothing).groupBy(F.col("dst").alias("node")).agg((F.lit(1 - damping) + damping * F.sum("got")).alias("score"))
        ranks = ranks if k == rounds - 1 else ranks.checkpoint()
    return ranks.withColumnRenamed("node", "no").join(named, "no").select("node", "score")


def concept_lookup(nodes: DataFrame, edges: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, id, src): concepts whose label is a term, whatever its case, with the nodes that define them; null without one.

    ``nodes``: id, kind, label; ``edges``: src, dst, kind; ``terms``: term.
    """
    concepts = nodes.where("kind = 'concept'").select("id", F.lower("label").alias("_label"))
    found = terms.select("term").distinct().join(concepts, F.lower("term") == F.col("_label")).select("term", "id")
    return found.join(edges.where("kind = 'defines'").select("src", F.col("dst").alias("id")).distinct(), "id", "left").select("term", "id", "src")


def valid_at(rows: DataFrame, day: Column) -> DataFrame:
    """Rows whose half-open validity holds the day; an open end never ends."""
    return rows.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day < F.col("valid_to"))))


def intervals(rows: DataFrame, key: str, start: str, *order: str) -> DataFrame:
    """Adds valid_from and valid_to: each row holds until the next of its key."""
    window = Window.partitionBy(key).orderBy(start, *order)
    return rows.withColumns({"valid_from": F.col(start), "valid_to": F.lead(start).over(window)})
