"""Shared-folder scratch space and executor-side file access.

Intermediate tables and operator files live in the folder that the cluster
names in ``spark.checkpoint.dir``; every executor and the driver see it.  A
folder of our own is set only where that setting is missing and the master is
local, as in tests.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import scratch_path, shared_root

#: Rows in one Arrow batch sent to Python: bounds worker memory with long texts.
ARROW_ROWS = 1024
#: Stored bytes of a table for each partition of its shuffles, so that partitions don't grow with the input.
PART_BYTES = 64 << 20


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and survives lost executors: the written files are the only
    copy any later stage depends on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_files(df: DataFrame) -> None:
    """Delete the shared files behind a materialized frame once nothing reads them."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_root(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.replace("file:///", "file:/").startswith(root.replace("file:///", "file:/")):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def with_new_texts(docs: DataFrame, changed: DataFrame, mark_of: Callable[[Column], Column]) -> DataFrame:
    """``docs`` with the texts of ``changed`` (doc_id, mark, kept_text); a row that loses all its words goes.

    A row is found by its id and its text's mark, null-safe; n_chars follows the
    text.  Rows travel as one struct, so no name of a caller's column matters.
    """
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("id"), mark_of(F.col("row.text").cast("string")).alias("own"))
    news = changed.select(F.col("doc_id").alias("new_id"), F.col("mark").alias("new_mark"), F.col("kept_text").alias("new_text")).dropDuplicates(["new_id", "new_mark"])
    joined = rows.join(news, F.col("id").eqNullSafe(F.col("new_id")) & F.col("own").eqNullSafe(F.col("new_mark")), "left")
    left = joined.where(F.col("new_text").isNull() | F.col("new_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("new_text"), "n_chars": F.char_length("new_text").cast("long")}
    own = {name: F.col("row").getField(name) for name in docs.columns}
    return left.select(*(F.when(F.col("new_text").isNotNull(), new[name]).otherwise(cell).alias(name) if name in new else cell.alias(name) for name, cell in own.items()))


def bound_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of each Arrow batch so that long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_parts(table: DataFrame) -> int:
    """Partitions for a shuffle: the session's count, and at least one for each ``PART_BYTES`` of the files that ``table`` reads."""
    leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [leaf for leaf in (leaves.apply(k) for k in range(leaves.size())) if leaf.nodeName() == "LogicalRelation"]  # others don't know their size
    size = sum(int(str(leaf.stats().sizeInBytes())) for leaf in files)
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; used inside executor tasks."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def make_dir(uri: str) -> None:
    """Create a shared folder, parents included."""
    filesystem, path = open_fs(uri)
    filesystem.create_dir(path, recursive=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps before the next step writes its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Give freed memory back to the system, Arrow's too, so that an idle Python worker holds little of its executor's bound."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
