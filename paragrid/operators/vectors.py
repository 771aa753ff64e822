"""An approximate vector index: k-means cells, residuals in one byte a component, exact scores at the end.

Fitting looks at a sample of at most ``SAMPLE`` vectors, those with the least
hashes of their ids: cells and the components' scales come from it.  Every row is
then put into its nearest cell, and its residual is rounded to bytes.  A search
looks into the ``probes`` cells nearest to each query, ranks their rows by the
rounded scores, and scores the first ``refine`` times k by the vectors themselves.

Scores are cosines.  Null, empty and zero vectors, and those with a null or
non-finite component, are in no cell; a shorter vector ends in zeros.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import files

#: Vectors that are fitted on, rounds of k-means, rows of a cell that one task holds, and queries beside them.
SAMPLE, ROUNDS, SHARE, BLOCK = 16384, 8, 8192, 512
CODES = "vec_id long, cell int, code binary"


@dataclass(frozen=True)
class Cells:
    """Centres as unit vectors, and what a step of a residual's byte is worth in each component."""

    centres: np.ndarray
    steps: np.ndarray

    def nearest(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """The ``n`` cells nearest to each row, nearest first."""
        return np.argsort(-(x @ self.centres.T), axis=1, kind="stable")[:, :n]


def _units(lists: list, width: int) -> np.ndarray:
    x = np.zeros((len(lists), width))
    for row, own in zip(x, lists, strict=True):
        row[: min(len(own), width)] = own[:width]
    return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-300)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that have a direction."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return rows.where(sound)


def fit(rows: DataFrame, *, cells: int, sample: int = SAMPLE, rounds: int = ROUNDS) -> Cells | None:
    """Cells out of a bounded sample; None without rows.  The sample is the same however rows are partitioned."""
    held = [r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not held:
        return None
    x = _units(held, max(map(len, held)))
    centres = x[: min(cells, len(x))].copy()  # the sample is in random order
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = x[own == c].mean(axis=0)
        centres /= np.maximum(np.sqrt((centres**2).sum(axis=1, keepdims=True)), 1e-300)
    own = (x @ centres.T).argmax(axis=1)
    return Cells(centres, np.maximum(np.abs(x - centres[own]).max(axis=0) / 127, 1e-9))


def assign(rows: DataFrame, cells: Cells) -> DataFrame:
    """vec_id, cell and code of every row, written once by cell, so a search opens the cells it looks into."""
    width = cells.centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _units(batch.column(1).to_pylist(), width)
            own = cells.nearest(x)[:, 0] if len(x) else np.zeros(0, dtype=int)
            code = np.clip(np.rint((x - cells.centres[own]) / cells.steps), -127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], ["vec_id", "cell", "code"])

    spark = rows.sparkSession
    path = files.scratch_path(spark, "vector-cells")
    rows.select("vec_id", "embedding").mapInArrow(run, CODES).write.partitionBy("cell").parquet(path)
    return spark.read.schema("vec_id long, code binary, cell int").parquet(path)


def search(rows: DataFrame, index: DataFrame, cells: Cells, queries: DataFrame, *, k: int = 12, probes: int = 8, refine: int = 4) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other rows among those of the cells it looks into."""
    width, best = cells.centres.shape[1], k * refine

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _units(batch.column(1).to_pylist(), width)
            near = cells.nearest(x, probes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.tolist(), pa.list_(pa.int32()))], ["query_id", "query", "cells"])

    looked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).mapInArrow(look, "query_id long, query array<double>, cells array<int>")
    looked = files.materialize(looked.select("query_id", "query", F.explode("cells").alias("cell")), "vector-probes")
    # A task holds one share of a cell's rows and one block of the queries that look there.
    rows_of = index.groupBy("cell").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    asks_of = looked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = rows_of.join(asks_of, "cell")
    mine = index.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("vec_id"), F.col("shares")).cast("int").alias("share"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "code")
    asks = looked.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block"), "query_id", "query")

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "guess": []})
        x = cells.centres[key[0]] + np.frombuffer(b"".join(left["code"]), dtype=np.int8).reshape(len(left), width) * cells.steps
        guess = _units(list(right["query"]), width) @ x.T
        ids, asked = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        guess[ids[None, :] == asked[:, None]] = -np.inf
        n = min(best, len(ids))
        top = np.argpartition(-guess, n - 1, axis=1)[:, :n]
        made = pd.DataFrame({"query_id": np.repeat(asked, n), "vec_id": ids[top].ravel(), "guess": np.take_along_axis(guess, top, axis=1).ravel()})
        return made[made["guess"] > -np.inf]

    group = ["cell", "share", "block"]
    guessed = mine.groupBy(*group).cogroup(asks.groupBy(*group)).applyInPandas(score, "query_id long, vec_id long, guess double")
    by = lambda column: Window.partitionBy("query_id").orderBy(F.desc(column), "vec_id")
    chosen = guessed.withColumn("nth", F.row_number().over(by("guess"))).where(F.col("nth") <= best).select("query_id", "vec_id")
    held = chosen.join(rows, "vec_id").join(queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), "query_id")
    exact = held.select("query_id", "vec_id", F.round(_cosine("embedding", "query"), 6).alias("score"))
    return exact.withColumn("rank", F.row_number().over(by("score"))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cosine(a: str, b: str) -> Column:
    """Cosine of two usable vectors, the shorter one filled up with zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.coalesce(p, F.lit(0.0)) * F.coalesce(q, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def exact(rows: DataFrame, queries: DataFrame, *, k: int = 12, block: int = BLOCK) -> DataFrame:
    """query_id, vec_id: the ``k`` best by all cosines, block by block of the queries; what recall is held against."""
    spark = rows.sparkSession
    asked = files.materialize(queries.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() // block)))).alias("block")), "vector-queries")
    found = []
    for r in asked.select("block").distinct().collect():
        own = [(q["vec_id"], q["embedding"]) for q in asked.where(F.col("block") == r["block"]).collect()]  # about ``block`` queries
        width = max(len(v) for _, v in own)
        ids, x = np.array([i for i, _ in own]), _units([v for _, v in own], width)

        def run(batches: Iterator[pa.RecordBatch], ids=ids, x=x, width=width) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mine, y = batch.column(0).to_numpy(), _units(batch.column(1).to_pylist(), width)
                scores = np.round(x @ y.T, 6)
                scores[ids[:, None] == mine[None, :]] = -np.inf
                n = min(len(mine), 4 * k)
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n else np.zeros((len(ids), 0), dtype=int)
                cells = np.repeat(ids, n), mine[top].ravel(), np.take_along_axis(scores, top, axis=1).ravel()
                keep = cells[2] > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cells], ["query_id", "vec_id", "score"])

        found.append(rows.select("vec_id", "embedding").mapInArrow(run, "query_id long, vec_id long, score double"))
    every = found[0] if found else spark.createDataFrame([], "query_id long, vec_id long, score double")
    for more in found[1:]:
        every = every.unionByName(more)
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "vec_id", "score")


def recall(found: DataFrame, truth: DataFrame, *, tie: float = 1e-6) -> DataFrame:
    """One row: queries, their true neighbours, and how many of these the search has, or has one as near for."""
    worst = truth.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    good = found.join(worst, "query_id").groupBy("query_id", "n").agg(F.count_if(F.col("score") >= F.col("least") - tie).alias("got"))
    all_ = worst.join(good.select("query_id", "got"), "query_id", "left")
    return all_.agg(F.count("*").alias("queries"), F.sum("n").alias("neighbours"), F.coalesce(F.sum(F.least("got", "n")), F.lit(0)).alias("found"))
