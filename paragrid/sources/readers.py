"""Scans: listings, archives, detail pages, data-repository files.

Every reader goes through Spark's own sources, so any path that Spark opens will
do.  The metadata of laws are listed in tasks instead where Arrow opens the path
(``file_of_each_folder``), as a source keeps the names of all files in the
driver.  Network access is not part of the engine; a crawler drops files, and
the readers take it from there.
"""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Iterator
from itertools import batched
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import decision_date
from ..functions.keys import slug_from_link

MEMBERS = T.StructType([
    T.StructField("xml_filename", T.StringType()),
    T.StructField("xml", T.BinaryType()),
    T.StructField("extra_files", T.MapType(T.StringType(), T.BinaryType())),
    T.StructField("error", T.StringType()),
])
LISTING_LIMIT = 1000
#: Names that a task hands on, and files that it looks for, at once.
NAMES = 512


def spread(df: DataFrame, small: int = 128 << 20) -> DataFrame:
    """A small table in fewer files than there are cores, dealt over all cores; any other table as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < small and len(df.inputFiles()) < cores else df


def law_listing(spark: SparkSession, path: str) -> DataFrame:
    """pos, title, link (https) and slug of the law listing; rows without both are skipped."""
    rows = spark.read.format("xml").option("rowTag", "item").schema("title string, link string").load(path)
    filled = rows.where("trim(coalesce(title, '')) <> '' and trim(coalesce(link, '')) <> ''")
    link = F.regexp_replace(F.trim("link"), "^http://", "https://")
    return filled.select(F.trim("title").alias("title"), link.alias("link"), slug_from_link(link).alias("slug"))


def decision_listing(spark: SparkSession, path: str, limit: int | None = None, court: str | None = None) -> DataFrame:
    """Decisions that have an ECLI; the court filter comes after the limit, as published."""
    schema = "gericht string, entscheidungsdatum string, aktenzeichen string, ecli string, link string"
    rows = spark.read.format("xml").option("rowTag", "item").option("ignoreNamespace", "true").schema(schema).load(path)
    out = rows.where("trim(coalesce(ecli, '')) <> ''").select(
        F.trim("gericht").alias("court"), decision_date(F.col("entscheidungsdatum")).alias("date"), F.trim("aktenzeichen").alias("case_no"), F.trim("ecli").alias("ecli"), F.trim("link").alias("zip_url")
    )
    if limit is not None:
        out = out.limit(limit)
    return out.where(F.upper("court") == court.upper()) if court else out


def _open(data: bytes | None, ordered: bool) -> tuple:
    if data is None:
        return None, None, None, "no archive"
    try:
        with zipfile.ZipFile(io.BytesIO(bytes(data))) as archive:
            names = [n for n in archive.namelist() if not n.endswith("/")]
            found = [n for n in (sorted(names) if ordered else names) if n.lower().endswith(".xml")]
            if not found:
                return None, None, None, "no XML member"
            return found[0], archive.read(found[0]), {n: archive.read(n) for n in names if n != found[0]}, None
    except (zipfile.BadZipFile, OSError, RuntimeError) as e:
        return None, None, None, str(e)


def _members(ordered: bool):
    @F.pandas_udf(MEMBERS)
    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_open(d, ordered) for d in data], columns=MEMBERS.names)

    return run


def archives(spark: SparkSession, path: str, *, ordered: bool, only: DataFrame | None = None) -> DataFrame:
    """First XML member of each archive, by sorted name (laws) or in archive order (decisions).

    Archives without one keep their row with ``error``; large archives are read
    one at a time by Spark's binary source.  ``only`` (path) names those to open.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    if only is not None:
        files = files.join(only.select("path").distinct(), "path", "left_semi")
    opened = files.select("path", _members(ordered)(F.col("content")).alias("m"))
    stem = F.regexp_replace(F.element_at(F.split("m.xml_filename", "/"), -1), r"\.[^.]*$", "")
    return opened.select("path", stem.alias("stem"), "m.*")


def file_fingerprints(spark: SparkSession, path: str, *, etag: bool = False) -> DataFrame:
    """Size and time of each file as a map without empty values: what a HEAD request would say.

    ``etag`` adds an entity tag, the MD5 of the content, which reads the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    tag = F.md5("content") if etag else F.lit(None).cast("string")
    marks = F.create_map(
        F.lit("etag"), tag, F.lit("content_length"), F.col("length").cast("string"), F.lit("last_modified"), F.col("modificationTime").cast("string")
    )
    return files.select("path", F.map_filter(marks, lambda k, v: v.isNotNull() & (v != "")).alias("fingerprint"))


def listing_json(raw: Column) -> Column:
    """Rows (celex, title, date) of a SPARQL JSON result; rows without a CELEX fall away."""
    cell = "struct<value:string>"
    parsed = F.from_json(raw, f"struct<results:struct<bindings:array<struct<celex:{cell},title:{cell},date:{cell}>>>>")
    value = lambda b, k: F.coalesce(b[k]["value"], F.lit(""))
    rows = F.transform(
        F.coalesce(parsed["results"]["bindings"], F.array().cast(f"array<struct<celex:{cell},title:{cell},date:{cell}>>")),
        lambda b: F.struct(value(b, "celex").alias("celex"), F.trim(value(b, "title")).alias("title"), F.left(value(b, "date"), F.lit(10)).alias("date")),
    )
    return F.filter(rows, lambda r: r["celex"] != "")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing rows of JSON result files, in file order."""
    files = spark.read.text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("file"))
    return files.select("file", F.posexplode(listing_json(F.col("value"))).alias("pos", "r")).select("file", "pos", "r.*")


def clamp_delta(n: int) -> int:
    """Rows of a delta query: none below one, at most the service's limit."""
    return 0 if n < 1 else min(n, LISTING_LIMIT)


def clamp_window(n: int) -> int:
    """Rows of a window query: between one and the service's limit."""
    return min(max(n, 1), LISTING_LIMIT)


def delta_query(listing: DataFrame, since: str, pattern: str, limit: int = 100) -> DataFrame:
    """Latest distinct rows since a date; date ties by key and title."""
    rows = listing.where((F.col("date") >= since) & F.col("celex").rlike(pattern)).select("celex", "title", "date").distinct()
    return rows.orderBy(F.desc("date"), "celex", "title").limit(clamp_delta(limit))


def window_query(listing: DataFrame, start: str, end: str, pattern: str, limit: int = LISTING_LIMIT) -> DataFrame:
    """Distinct rows of [start, end), earliest first."""
    inside = (F.col("date") >= start) & (F.col("date") < end)
    return listing.where(inside & F.col("celex").rlike(pattern)).select("celex", "title", "date").distinct().orderBy("date", "celex", "title").limit(clamp_window(limit))


def collect_capped(rows: DataFrame, order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` raw rows of a backfill, repeated ids included; none below one."""
    return rows.orderBy(*order).limit(max(cap, 0))


def distinct_capped(rows: DataFrame, key: str, order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` distinct ids over all windows of a backfill, each with its first row."""
    others = [c for c in rows.columns if c != key and c not in order]
    first = rows.groupBy(key).agg(F.min(F.struct(*order, *others)).alias("_row")).select(key, "_row.*")
    return first.orderBy(*order, key).limit(max(cap, 0)).select(*rows.columns)


def console_lines(rows: DataFrame, widths: dict[str, int]) -> DataFrame:
    """One text column, ``line``: the columns cut and padded to their widths, two blanks between, as lists are printed."""
    cells = [F.rpad(F.left(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(n)), n, " ") for c, n in widths.items()]
    return rows.select(F.rtrim(F.concat_ws("  ", *cells)).alias("line"))

def section_files(spark: SparkSession, root: str) -> DataFrame:
    """Rendered section files: bjnr, folder, file, text; paragraphs sort before annexes."""
    files = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(f"{root}/laws", wholetext=True)
    where = F.col("_metadata.file_path")
    cut = r"/laws/([^/]+)/(paragraphs|annexes)/([^/]+)$"
    named = files.select(*(F.regexp_extract(where, cut, k).alias(n) for k, n in ((1, "bjnr"), (2, "folder"), (3, "file"))), F.col("value").alias("text"))
    return named.where("bjnr <> ''").withColumn("folder_order", F.when(F.col("folder") == "paragraphs", 0).otherwise(1))


def _names(filesystem: pafs.FileSystem, place: str) -> Iterator[str]:
    """Names in a folder but those that are hidden from Spark's readers; a local folder is not held as a whole."""
    if isinstance(filesystem, pafs.LocalFileSystem):
        with os.scandir(place) as found:
            yield from (f.name for f in found if f.name[0] not in "._")
    else:
        yield from (f.base_name for f in filesystem.get_file_info(pafs.FileSelector(place)) if f.base_name[0] not in "._")


def _decoded(data: bytes) -> str | None:
    try:
        return data.decode(json.detect_encoding(data))
    except UnicodeDecodeError:
        return None


def file_of_each_folder(spark: SparkSession, path: str, name: str) -> DataFrame:
    """folder, text: the file ``name`` of each folder in ``path`` that has one; the text is null where it can't be decoded.

    One task lists the folders' names, and the tasks they are dealt over open the
    files, so that the driver holds neither.  What Arrow can't open goes through
    Spark's own source, whose driver lists all files.
    """
    path = path if "://" in path else "file://" + path
    try:
        pafs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, OSError):  # no scheme of Arrow's, or its library is not there
        own = spark.read.format("binaryFile").load(f"{path}/*/{name}")
        folder = F.element_at(F.split("path", "/"), -2)
        return own.select(folder.alias("folder"), F.udf(lambda data: _decoded(bytes(data)), "string")("content").alias("text"))

    def listed(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batched(_names(*pafs.FileSystem.from_uri(path)), NAMES):
            yield pa.RecordBatch.from_pydict({"folder": pa.array(some, pa.string())})

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, place = pafs.FileSystem.from_uri(path)
        for some in (s for batch in batches for s in batched(batch.column(0).to_pylist(), NAMES)):
            found = filesystem.get_file_info([f"{place}/{folder}/{name}" for folder in some])
            there = [(folder, f.path) for folder, f in zip(some, found, strict=True) if f.type == pafs.FileType.File]
            texts = []
            for _, file in there:
                with filesystem.open_input_stream(file, compression=None) as source:
                    texts.append(_decoded(source.read()))
            yield pa.RecordBatch.from_pydict({"folder": pa.array([folder for folder, _ in there], pa.string()), "text": pa.array(texts, pa.string())})

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = spark.range(1, numPartitions=1).mapInArrow(listed, "folder string").repartition(parts)
    return names.mapInArrow(opened, "folder string, text string")


def law_metas(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Laws of a data repository, one row for each ``laws/<bjnr>/meta.json``: folder, its metadata, and ``error`` for a corrupt one.

    One that is empty, not in a Unicode encoding or no object is corrupt too.
    """
    full = T._parse_datatype_string(schema).add("_corrupt", T.StringType())
    files = file_of_each_folder(spark, f"{root}/laws", "meta.json")
    rows = files.select("folder", F.coalesce(F.col("text").rlike(r"^\s*\{"), F.lit(False)).alias("_object"), F.from_json("text", full, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_meta"))
    fields = [F.when(F.col("_object"), F.col("_meta").getField(n)).alias(n) for n in full.names[:-1]]
    return rows.select("folder", *fields, F.when(~F.col("_object") | F.col("_meta._corrupt").isNotNull(), "corrupt").alias("error"))


def json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents by an explicit schema; a missing path or a corrupt document gives no row."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    full = T._parse_datatype_string(schema).add("_corrupt", T.StringType())
    return spark.read.schema(full).option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path).where("_corrupt is null").drop("_corrupt")


def promulgation(raw: Column) -> Column:
    """Promulgation event out of its JSON: the effective date falls back to the stand date, then to empty."""
    v = F.try_parse_json(raw)
    text = lambda path: F.try_variant_get(v, path, "string")
    names = lambda path: F.coalesce(F.try_variant_get(v, path, "array<string>"), F.array().cast("array<string>"))
    return F.struct(
        F.coalesce(text("$.eli"), F.lit("")).alias("eli"),
        F.coalesce(F.nullif(text("$.effectiveDate"), F.lit("")), F.nullif(text("$.stand_datum"), F.lit("")), F.lit("")).alias("effective_date"),
        text("$.promulgationDate").alias("promulgation_date"),
        text("$.bgblCitation").alias("bgbl_citation"),
        text("$.amendingAct.title").alias("amending_act_title"),
        names("$.affectedLaws").alias("affected_law_ids"),
        names("$.affectedSections").alias("affected_sections"),
        raw.alias("raw"),
    )


def data_root(argument: str | None, default: str) -> str:
    """Data folder: the argument, else CORPUS_DATA_ROOT, else a sibling of the default."""
    return argument or os.environ.get("CORPUS_DATA_ROOT") or str(PurePosixPath(default).parent / "corpus-data")


def float_setting(name: str, default: float) -> float:
    """A non-negative number out of the environment; a bad one is the default."""
    try:
        return max(0.0, float(os.environ.get(name, default)))
    except ValueError:
        return default
