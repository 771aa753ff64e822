"""Hard-negative mining by ball trees with bounds above and below.

1. Rows that take part are range-partitioned by label; a task writes a ball tree
   of every ``TREE_ROWS`` rows to a file of the shared folder.  A node knows its
   centre, its radius and its range of labels.
2. Anchors are written in blocks of ``BLOCK`` rows.  A work item is a block and a
   group of at most ``GROUP`` trees: it holds one tree at a time, and carries each
   search's current k-th score from tree to tree.
3. The inner product of an anchor and any row of a node lies within
   ``anchor . centre -+ |anchor| radius``.  A node is left out when all its rows
   are above or below the search's window of scores, when all are strictly below
   the current k-th, or when its labels rule it out.  Whole trees are left out
   before their files are opened.
4. Positives are one search with no window among rows of the anchor's label;
   negatives are one search for each positive, with its window, among all others.
   The groups' results are merged by a window of at most k rows a group.

Bounds are widened by more than their rounding error; scores are exact integers.

Edge cases: rows with a null label or vector, or a null or non-finite component,
take no part; shorter vectors are filled up with zeros; a null vec_id is no
anchor and comes after all others among equal scores; repeated rows are rows of
their own, so an anchor's copy can be its positive; rows that agree in score and
vec_id have no order of their own; a score beyond 62 bits raises an error; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

#: Rows of a tree and of a leaf, anchors of a block, and trees of a work item.
TREE_ROWS, LEAF_ROWS, BLOCK, GROUP = 16384, 64, 256, 64
#: Window, in hundredths of the positive's score, and how many positives and negatives.
LOW, HIGH, POSITIVES, NEGATIVES = 80, 100, 5, 5
NONE = -(1 << 62)  # below all scores
LAST = (1 << 63) - 1
TREES = "path string, n long, low long, high long, centre array<double>, radius double"
BLOCKS = "path string, n long"
HITS = "anchor_uid long, search long, score long, uid long, vec_id long"


def taking_part(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """uid, vec_id, label and the integer vector of the rows that take part."""
    picked = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = picked.where(F.col("label").isNotNull() & F.col("x").isNotNull()).where(~bad)
    return kept.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.transform("x", lambda x: F.floor(x * 256)).alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows of ``width`` columns, filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all of ``b``."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    high = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * width
    if high < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if high < 1 << 62:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if any(abs(x) >= 1 << 62 for x in exact.ravel()):
        raise ValueError("a score is beyond 62 bits")
    return exact.astype(np.int64)


@dataclass
class Tree:
    """Rows in order of leaves, and nodes; node 0 is the root and a leaf has no children."""

    v: np.ndarray
    label: np.ndarray
    vec_id: np.ndarray
    uid: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def save(self, uri: str) -> None:
        filesystem, path = shared.open_fs(uri)
        with filesystem.open_output_stream(path, compression=None) as out:
            np.savez(out, **vars(self))

    @classmethod
    def load(cls, uri: str) -> Tree:
        filesystem, path = shared.open_fs(uri)
        with filesystem.open_input_file(path) as source, np.load(source) as held:
            return cls(**{name: held[name] for name in held.files})


def grow(v: np.ndarray, label: np.ndarray, vec_id: np.ndarray, uid: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A ball tree: nodes of several labels split between labels, others across their widest direction."""
    order, x = np.argsort(label, kind="stable"), v.astype(float)
    nodes: list[list] = []
    todo = [(0, len(label), -1, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        own = order[begin:end]
        centre = x[own].mean(axis=0)
        away = ((x[own] - centre) ** 2).sum(axis=1)
        labels = label[own]
        me = len(nodes)
        nodes.append([begin, end, -1, -1, centre, float(np.sqrt(away.max())), int(labels.min()), int(labels.max())])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if end - begin <= leaf_rows:
            continue
        if nodes[me][6] < nodes[me][7]:
            borders = np.flatnonzero(labels[1:] != labels[:-1]) + 1  # in order of labels until they are told apart
            cut = int(borders[np.abs(borders - len(own) // 2).argmin()])
        else:
            far = x[own[away.argmax()]]
            farther = x[own[((x[own] - far) ** 2).sum(axis=1).argmax()]]
            order[begin:end] = own[np.argsort(x[own] @ (farther - far), kind="stable")]
            cut = len(own) // 2
        todo += [(begin, begin + cut, me, 0), (begin + cut, end, me, 1)]
    begin, end, left, right, centre, radius, low, high = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(v[order], label[order], vec_id[order], uid[order], begin, end, left, right, centre, radius, low, high)


def reach(anchors: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner products of each anchor with any row of each ball, widened for rounding."""
    width = min(anchors.shape[1], centre.shape[1])
    a = anchors.astype(float)
    length = np.sqrt((a**2).sum(axis=1))
    middle = a[:, :width] @ centre[:, :width].T
    spread_ = np.outer(length, radius)
    slack = 1e-9 * (np.outer(length, np.sqrt((centre**2).sum(axis=1))) + spread_) + 1e-6
    return middle - spread_ - slack, middle + spread_ + slack


class Searches:
    """The searches of a block: each has an anchor, a window of scores, and its best k so far."""

    def __init__(self, v: np.ndarray, label: np.ndarray, uid: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, *, same: bool, k: int):
        self.v, self.label, self.uid, self.anchor, self.low, self.high, self.same, self.k = v, label, uid, anchor, low, high, same, k
        n = len(anchor)
        self.score = np.full((n, k), NONE, dtype=np.int64)
        self.found = np.full((n, k), LAST, dtype=np.int64)  # uid
        self.named = np.full((n, k), LAST, dtype=np.int64)  # vec_id
        self.leaves = 0

    def open(self, lowest: np.ndarray, highest: np.ndarray, low_label: int, high_label: int) -> np.ndarray:
        """Which searches a node with these bounds for each anchor may serve."""
        label = self.label[self.anchor]
        fits = (label >= low_label) & (label <= high_label) if self.same else (label != low_label) | (low_label != high_label)
        return fits & (highest[self.anchor] >= np.maximum(self.low, self.score[:, -1])) & (lowest[self.anchor] <= self.high)

    def walk(self, tree: Tree) -> None:
        """Take the best of a tree, higher nodes first."""
        lowest, highest = reach(self.v, tree.centre, tree.radius)
        todo = [0]
        while todo:
            at = todo.pop()
            active = np.flatnonzero(self.open(lowest[:, at], highest[:, at], tree.low[at], tree.high[at]))
            if not len(active):
                continue
            children = [c for c in (int(tree.left[at]), int(tree.right[at])) if c >= 0]
            if children:
                todo += sorted(children, key=lambda c: highest[:, c].max())
            else:
                self._leaf(tree, slice(int(tree.begin[at]), int(tree.end[at])), active)

    def _leaf(self, tree: Tree, rows: slice, active: np.ndarray) -> None:
        self.leaves += 1
        anchors, back = np.unique(self.anchor[active], return_inverse=True)
        scores = products(self.v[anchors], tree.v[rows])[back]
        alike = tree.label[rows][None, :] == self.label[anchors][back][:, None]
        fits = (alike if self.same else ~alike) & (tree.uid[rows][None, :] != self.uid[anchors][back][:, None])
        fits &= (scores >= np.maximum(self.low, self.score[:, -1])[active][:, None]) & (scores <= self.high[active][:, None])
        some = fits.any(axis=1)
        active, scores, fits = active[some], scores[some], fits[some]
        if not len(active):
            return
        of = lambda values: np.broadcast_to(values[rows], scores.shape)
        score = np.concatenate([self.score[active], np.where(fits, scores, NONE)], axis=1)
        named = np.concatenate([self.named[active], np.where(fits, of(tree.vec_id), LAST)], axis=1)
        found = np.concatenate([self.found[active], np.where(fits, of(tree.uid), LAST)], axis=1)
        best = np.lexsort((found, named, -score), axis=1)[:, : self.k]
        for mine, new in ((self.score, score), (self.named, named), (self.found, found)):
            mine[active] = np.take_along_axis(new, best, axis=1)


def plant_trees(rows: DataFrame, width: int, *, tree_rows: int = TREE_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Trees of all rows, as files; the manifest has their root's bounds, and names files of finished tasks only."""
    spark = rows.sparkSession
    folder = shared.scratch_path(spark, "ball-trees")
    shared.make_dir(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            names = table["vec_id"].fill_null(LAST).to_numpy()
            tree = grow(_matrix(table["v"].chunk(0), width), table["label"].to_numpy(), names, table["uid"].to_numpy(), leaf_rows)
            path = f"{folder}/tree-{uuid.uuid4().hex}.npz"
            tree.save(path)
            held.clear()
            cells = [path], [len(tree.uid)], [int(tree.low[0])], [int(tree.high[0])], [tree.centre[0].tolist()], [float(tree.radius[0])]
            kinds = pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], ["path", "n", "low", "high", "centre", "radius"])

        for batch in batches:
            while len(batch):
                room = tree_rows - sum(map(len, held))
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(map(len, held)) == tree_rows:
                    yield flush()
        if held:
            yield flush()

    parts = max(1, -(-rows.count() // tree_rows))
    ranged = rows.repartitionByRange(parts, "label", F.xxhash64("uid")).select("uid", "vec_id", "label", "v")
    return shared.materialize(ranged.mapInArrow(write, TREES), "ball-manifest")


def write_blocks(anchors: DataFrame, n: int, block: int) -> DataFrame:
    """Anchors (uid, label, v, positives) as files of at most ``block`` rows."""
    spark = anchors.sparkSession
    folder = shared.scratch_path(spark, "anchor-blocks")
    shared.make_dir(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), block):
                path = f"{folder}/block-{uuid.uuid4().hex}.arrow"
                filesystem, place = shared.open_fs(path)
                own = batch.slice(at, block)
                with filesystem.open_output_stream(place, compression=None) as out, pa.ipc.new_stream(out, own.schema) as stream:
                    stream.write_batch(own)
                yield pa.RecordBatch.from_pydict({"path": [path], "n": [len(own)]})

    dealt = anchors.repartition(max(1, -(-n // block)), F.xxhash64("uid"))
    return shared.materialize(dealt.mapInArrow(write, BLOCKS), "anchor-manifest")


def run_searches(blocks: DataFrame, trees: DataFrame, width: int, *, same: bool, k: int, group: int = GROUP) -> DataFrame:
    """Every block against every group of trees: each search's best k of the group."""
    spark = blocks.sparkSession
    n_blocks, n_trees = blocks.count(), trees.count()
    cores = spark.sparkContext.defaultParallelism
    groups = max(-(-n_trees // group), min(n_trees, -(-cores // max(1, n_blocks))), 1)
    numbered = trees.withColumn("lot", F.expr(f"pmod(xxhash64(path), {groups})"))
    lots = numbered.groupBy("lot").agg(F.collect_list(F.struct("path", "low", "high", "centre", "radius")).alias("trees"))  # about ``group`` trees
    work = blocks.select(F.col("path").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("lot")).join(lots, "lot")
    work = work.repartition(max(1, n_blocks * groups), F.xxhash64("block", "lot")).select("block", "trees")

    def one(block: str, trees_: list[dict]) -> pa.RecordBatch:
        filesystem, place = shared.open_fs(block)
        with filesystem.open_input_stream(place, compression=None) as source:
            table = pa.ipc.open_stream(source).read_all().combine_chunks()
        v, uid, label = _matrix(table["v"].chunk(0), width), table["uid"].to_numpy(), table["label"].to_numpy()
        windows = [(a, p, low, high) for a, own in enumerate(table["windows"].to_pylist()) for p, low, high in ((w["search"], w["low"], w["high"]) for w in own)]
        anchor, search, low, high = (np.array(c, dtype=np.int64) for c in zip(*windows, strict=True)) if windows else (np.zeros(0, dtype=np.int64),) * 4
        held = Searches(v, label, uid, anchor, low, high, same=same, k=k)
        roots = [reach(v, np.array([t["centre"]]), np.array([t["radius"]])) for t in trees_]
        for at in sorted(range(len(trees_)), key=lambda t: -roots[t][1].max(initial=0)):
            lowest, highest = roots[at]
            if held.open(lowest[:, 0], highest[:, 0], trees_[at]["low"], trees_[at]["high"]).any():
                held.walk(Tree.load(trees_[at]["path"]))
        row, column = np.nonzero(held.score > NONE)
        names = held.named[row, column]
        cells = uid[anchor[row]], search[row], held.score[row, column], held.found[row, column], names
        masks = None, None, None, None, names == LAST
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64(), mask=m) for c, m in zip(cells, masks, strict=True)], ["anchor_uid", "search", "score", "uid", "vec_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, trees_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield one(block, trees_)
        shared.trim()

    return work.mapInArrow(run, HITS)


def _first(hits: DataFrame, k: int) -> DataFrame:
    """Each search's first ``k`` of its groups' results, numbered from 1."""
    own = Window.partitionBy("anchor_uid", "search").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    return hits.withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k)


def mine(rows: DataFrame, is_anchor: Column, *, low: int = LOW, high: int = HIGH, positives: int = POSITIVES, negatives: int = NEGATIVES, tree_rows: int = TREE_ROWS, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The operator: rows (uid, vec_id, label, v) to each anchor's negatives for each of its positives.

    ``low`` and ``high`` are hundredths of the positive's score; ``rows`` is read
    more than once, so give a written table.
    """
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    trees = plant_trees(rows, max(1, width), tree_rows=tree_rows)
    anchors = rows.where(is_anchor)
    n = anchors.count()
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("search"), F.lit(NONE).cast("long").alias("low"), F.lit(LAST).cast("long").alias("high")))
    blocks = write_blocks(anchors.select("uid", "label", "v", any_score.alias("windows")), n, block)
    near = shared.materialize(_first(run_searches(blocks, trees, max(1, width), same=True, k=positives, group=group), positives), "positives")

    # The least and the greatest integer that 100 times stays within the window, without leaving 64 bits.
    least = F.expr(f"score div 100 * {low} - cast(floor(-(score % 100) * {low} / 100) as bigint)")
    most = F.expr(f"score div 100 * {high} + cast(floor((score % 100) * {high} / 100) as bigint)")
    windowed = near.select("anchor_uid", F.struct(F.col("nth").cast("long").alias("search"), least.alias("low"), most.alias("high")).alias("w"))
    per_anchor = windowed.groupBy("anchor_uid").agg(F.collect_list("w").alias("windows"))  # at most ``positives``
    asked = anchors.join(per_anchor, F.col("uid") == F.col("anchor_uid")).select("uid", "label", "v", "windows")
    blocks = write_blocks(asked, n, block)
    far = _first(run_searches(blocks, trees, max(1, width), same=False, k=negatives, group=group), negatives)

    ids = anchors.select(F.col("uid").alias("anchor_uid"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor_uid", F.col("nth").cast("long").alias("search"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = far.select("anchor_uid", "search", F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(pairs, ["anchor_uid", "search"]).join(ids, "anchor_uid").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: hard negatives of every hundredth vector, after every seventh changed its label."""
    rows = taking_part(spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = shared.materialize(rows.withColumn("label", label), "negative-rows")
    return mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE_SQL = {
    "op12_hard_negatives": f"""
with e as (
  select row_number() over () as uid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.uid as a, a.vec_id as anchor_id, e.uid, e.vec_id, a.label = e.label as same, list_inner_product(a.v, e.v)::bigint as score
  from e a join e on true where a.vec_id % 100 = 0),
p as (
  select a, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by a order by score desc, vec_id, uid) as nth
  from s where same and uid <> a qualify nth <= {POSITIVES})
select p.anchor_id, positive_id, row_number() over (partition by a, nth order by score desc, vec_id, s.uid)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from p join s using (a) where not same and {LOW} * positive_score <= 100 * score and 100 * score <= {HIGH} * positive_score
qualify rank <= {NEGATIVES}"""
}
