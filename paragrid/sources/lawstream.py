"""Laws of any length: a pull parser that hands on one row a norm.

``laws.parse_laws`` holds a law as one value.  Here a task opens a file, reads it
as a stream and holds one norm and a batch of finished ones, so a law may be larger
than a worker's memory.  The breadcrumb is the stream's only state.  A file that
breaks off in the middle counts as an error as a whole, as it does there.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import files, laws

#: Norms that a task holds before it hands them on.
BATCH = 64
NORMS = (
    T.StructType().add("bjnr", T.StringType()).add("nth", T.LongType()).add("jurabk", T.StringType()).add("standangabe", T.ArrayType(laws.STAND))
    .add("enbez", T.StringType()).add("titel", T.StringType()).add("breadcrumb", T.ArrayType(T.StringType())).add("absaetze", T.ArrayType(laws.ABSATZ)).add("error", T.StringType())
)


def norms(stream: BinaryIO) -> Iterator[ET.Element]:
    """The norms of an XML stream, each dropped when the next one is asked for; a norm in a norm is part of it."""
    above: list[ET.Element] = []
    inside = 0
    for event, node in ET.iterparse(stream, ("start", "end")):
        if event == "start":
            above.append(node)
            inside += node.tag == "norm"
            continue
        above.pop()
        inside -= node.tag == "norm"
        if inside:
            continue
        if node.tag == "norm":
            yield node
        if above:
            above[-1].remove(node)


def law_rows(bjnr: str, stream: BinaryIO, crumb_mode: str = "compat") -> Iterator[dict]:
    """One row for each norm with head data and breadcrumb, and at the end one with the error, if there is one."""
    less = {"compat": 0, "fixed": 1}[crumb_mode]
    blank = dict.fromkeys(NORMS.names) | {"bjnr": bjnr}
    head, crumb = None, []
    try:
        for nth, node in enumerate(norms(stream)):
            if head is None:
                head = laws._head(node)
            if node.find("metadaten") is None:
                continue
            norm = laws._norm(node)
            if norm["crumb_label"] is not None:
                kept = crumb if norm["crumb_depth"] is None else crumb[: max(norm["crumb_depth"] - less, 0)]
                crumb = [*kept, norm["crumb_label"]]
            yield blank | {"nth": nth, "jurabk": head["jurabk"], "standangabe": head["standangabe"], "breadcrumb": crumb} | {k: norm[k] for k in ("enbez", "titel", "absaetze")}
        if head is None:
            raise ValueError("no norm")
    except (ET.ParseError, ValueError, zipfile.BadZipFile) as e:
        yield blank | {"error": str(e)}


def _opened(path: str, crumb_mode: str) -> Iterator[dict]:
    """Rows of an XML file, or of the first XML member of an archive by name; the law's key is its name without an ending."""
    filesystem, place = pafs.FileSystem.from_uri(path)
    stem = lambda name: name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    with filesystem.open_input_file(place) as raw:
        if not place.lower().endswith(".zip"):
            yield from law_rows(stem(place), raw, crumb_mode)
            return
        try:
            with zipfile.ZipFile(raw) as archive:
                found = sorted(n for n in archive.namelist() if n.lower().endswith(".xml"))
                if not found:
                    raise ValueError("no XML member")
                with archive.open(found[0]) as member:
                    yield from law_rows(stem(found[0]), member, crumb_mode)
        except (ValueError, zipfile.BadZipFile) as e:
            yield dict.fromkeys(NORMS.names) | {"bjnr": stem(place), "error": str(e)}


def norm_table(spark: SparkSession, path: str, *, crumb_mode: str = "compat") -> DataFrame:
    """The norms of all ``.xml`` and ``.zip`` files below ``path`` and the errors, written once.

    Spark lists the files, all but those of no bytes, and tasks open them.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where(F.lower("path").rlike(r"\.(xml|zip)$"))
    schema = to_arrow_schema(NORMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                held: list[dict] = []
                for row in _opened(place, crumb_mode):
                    held.append(row)
                    if len(held) == BATCH:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    dealt = found.select("path").repartition(F.xxhash64("path"))
    return files.materialize(dealt.mapInArrow(run, NORMS), "norms")


def section_table(norm_rows: DataFrame) -> DataFrame:
    """``laws.section_table`` over norms: one row for each section, ``seq`` being its norm's place; laws with an error have none."""
    from ..functions.dates import first_stand_date
    from ..functions.keys import classify_designator
    from ..operators.folds import occurrence_no, with_occurrence

    broken = norm_rows.where("error is not null").select("bjnr").distinct()
    sound = norm_rows.where("error is null").join(broken, "bjnr", "left_anti")
    stand = first_stand_date(F.transform("standangabe", lambda s: s["kommentar"]))
    rows = sound.withColumns({"c": classify_designator(F.col("enbez")), "stand_datum": stand}).where("c is not null")
    rows = rows.select(
        "bjnr", "jurabk", "stand_datum", F.col("nth").alias("seq"), "c.kind", "c.padded", F.col("enbez").alias("number"), F.col("titel").alias("heading"), "breadcrumb", "absaetze"
    )
    folder = F.when(F.col("kind") == "annex", "annexes").otherwise("paragraphs")
    counted = occurrence_no(rows.withColumn("folder", folder), ["bjnr", "folder", "padded"], "seq")
    name = F.concat(with_occurrence(F.col("padded"), F.col("occurrence")), F.lit(".md"))
    return counted.withColumn("path", F.concat_ws("/", F.lit("laws"), "bjnr", "folder", name)).drop("occurrence")
