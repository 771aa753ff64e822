"""Files in the folder that driver and executors share: scratch places, and a sink of one file for each row (``tree``)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

MANIFEST = "path string, action string"


def shared_root(spark: SparkSession) -> str:
    """URI of the shared folder, ``spark.checkpoint.dir``; a folder of our own only where the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="paragrid-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root if "://" in root else "file://" + root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; ``name`` is only a readable hint."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Compare-and-write of ``rows`` (path, data) below ``root``, as one commit: (path, action) of each row.

    A row is ``written`` or, with equal bytes in place, ``unchanged``; one whose
    data is null is ``deleted`` or ``absent``.  See ``tree``: nothing below
    ``root`` changes before the commit, so a task that is run again decides the
    same, and a job that fails leaves everything as it was.
    """
    from . import tree

    return tree.write(rows, root)


def delete_files(rows: DataFrame, root: str) -> DataFrame:
    """Deletes the files ``rows`` (path) name below ``root``, as one commit: (path, action)."""
    return write_files(rows.selectExpr("path", "cast(null as binary) as data"), root)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark opens."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folders(rows: DataFrame, root: str) -> DataFrame:
    """Deletes the folders ``rows`` (path) name below ``root``, if they are there: (path, action), when evaluated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            actions = []
            for path in batch.column(0).to_pylist():
                filesystem, place = pafs.FileSystem.from_uri(f"{root}/{path}")
                there = filesystem.get_file_info(place).type == pafs.FileType.Directory
                if there:
                    filesystem.delete_dir(place)
                actions.append("deleted" if there else "absent")
            yield pa.RecordBatch.from_pydict({"path": batch.column(0), "action": actions})

    return rows.select("path").mapInArrow(run, MANIFEST)
