"""Folds along document order, as windows within a document wherever one exists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it: a lambda's variable is never inlined."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _through(doc: str | list[str], *order: str):
    return Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def heading_stack(rows: DataFrame, doc: str, order: list[str], depth: str, label: str, levels: int = 6) -> DataFrame:
    """Adds ``stack``, the live headings at each row from the outermost in.

    A row with a null depth is a leaf.  Slot k holds the last heading of depth k
    and is live while no shallower heading came after it.
    """
    window = _through(doc, *order)
    place = F.row_number().over(Window.partitionBy(doc).orderBy(*order))
    out = rows.withColumn("_at", place)
    for k in range(1, levels + 1):
        own = F.col(depth) == k
        out = out.withColumns({
            f"_p{k}": F.max(F.when(own, F.col("_at"))).over(window),
            f"_l{k}": F.last(F.when(own, F.col(label)), ignorenulls=True).over(window),
        })
    slots = []
    for k in range(1, levels + 1):
        shallower = [F.coalesce(F.col(f"_p{j}"), F.lit(0)) for j in range(1, k)]
        above = F.greatest(F.lit(0), F.lit(0), *shallower)
        slots.append(F.when(F.col(f"_p{k}") > above, F.col(f"_l{k}")))
    stack = F.filter(F.array(*slots), lambda x: x.isNotNull())
    return out.withColumn("stack", stack).drop("_at", *(f"_{c}{k}" for c in "pl" for k in range(1, levels + 1)))


def heading_stack_scan(rows: DataFrame, doc: str, order: list[str], depth: str, label: str, levels: int = 6, segments: int | None = None) -> DataFrame:
    """``heading_stack`` for documents of any length: one may span many tasks.

    Rows are cut by range of document and order into ``segments`` (the session's
    shuffle partitions unless given).  Of a segment only the last heading of each
    depth matters to what follows, so these are scanned along the document, at most
    one row a segment, and each segment starts with what came before it.
    """
    spark = rows.sparkSession
    held = [F.col(c) for c in order]
    parts = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.select(F.struct("*").alias("row"), F.col(doc).alias("doc"), F.struct(*held).alias("at"), F.col(depth).alias("depth"), F.col(label).alias("label"))
    cut = files.materialize(cut.repartitionByRange(parts, "doc", "at").withColumn("segment", F.spark_partition_id()), "segments")
    inside = Window.partitionBy("doc", "segment").orderBy("at")
    through = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A heading's place is (segment, number in it); the greatest place of a depth is its last heading.
    placed = cut.withColumn("place", F.struct("segment", F.row_number().over(inside).alias("nth"), "label"))
    last = lambda k: F.max(F.when(F.col("depth") == k, F.col("place")))
    ends = placed.groupBy("doc", "segment").agg(*(last(k).alias(f"p{k}") for k in range(1, levels + 1)))
    before = Window.partitionBy("doc").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("doc").alias("_doc"), F.col("segment").alias("_segment"), *(F.max(f"p{k}").over(before).alias(f"c{k}") for k in range(1, levels + 1)))
    # Both sides stay as they are: the rows' exchange by (doc, segment) serves the window and the join.
    mine = placed.select("*", *(last(k).over(through).alias(f"p{k}") for k in range(1, levels + 1)))
    both = mine.join(carried, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("segment") == F.col("_segment")))
    slots, above = [], F.struct(F.lit(-1).alias("segment"), F.lit(0).alias("nth"))
    for k in range(1, levels + 1):
        own = F.coalesce(f"p{k}", f"c{k}")
        spot = F.struct(own["segment"].alias("segment"), own["nth"].alias("nth"))
        live = own.isNotNull() & (spot > above)
        slots.append(F.when(live, own["label"]))
        above = F.when(live, spot).otherwise(above)
    return both.select("row.*", F.filter(F.array(*slots), lambda x: x.isNotNull()).alias("stack"))


def crumb_fold(steps: Column, mode: str = "compat") -> Column:
    """Breadcrumb after each of ``array<struct<depth,label>>``.

    ``compat`` keeps ``depth`` entries before the new label, as the source does,
    so top-level siblings pile up to two; ``fixed`` keeps ``depth - 1``.  A null
    depth keeps all.
    """
    if mode not in ("compat", "fixed"):
        raise ValueError(f"unknown mode {mode!r}")
    less = 0 if mode == "compat" else 1
    empty = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        cut = F.when(s["depth"].isNull(), acc["crumb"]).otherwise(F.slice(acc["crumb"], 1, F.greatest(s["depth"] - less, F.lit(0))))
        crumb = F.array_append(cut, s["label"])
        return F.struct(crumb.alias("crumb"), F.array_append(acc["out"], crumb).alias("out"))

    start = F.struct(empty.alias("crumb"), F.array().cast("array<array<string>>").alias("out"))
    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def segment_by_marker(rows: DataFrame, doc: str, order: list[str], marker: Column) -> DataFrame:
    """Adds ``segment``: 0 before the first marker row, then one more at each."""
    return rows.withColumn("segment", F.sum(F.when(marker, 1).otherwise(0)).over(_through(doc, *order)))


def renumber(rows: DataFrame, doc: str | list[str], order: str, number: str) -> DataFrame:
    """Adds ``renumbered``: max(last + 1, number) along the order.

    The fold has a closed form: with the row's place i it is i plus the running
    maximum of (number - i).
    """
    place = F.row_number().over(Window.partitionBy(doc).orderBy(order))
    placed = rows.withColumn("_at", place)
    running = F.max(F.col(number) - F.col("_at")).over(_through(doc, order))
    return placed.withColumn("renumbered", F.greatest(F.col("_at") + running, F.col("_at"))).drop("_at")


def occurrence_no(rows: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """Adds ``occurrence``: 0 for the first row of a key, then 1, 2, ..."""
    order = [order] if isinstance(order, str) else order
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def with_occurrence(base: Column, occurrence: Column) -> Column:
    """File base with ``__n`` from the second occurrence on."""
    return F.when(occurrence == 0, base).otherwise(F.concat(base, F.lit("__"), occurrence.cast("string")))


def stable_dedup(rows: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each key by the order, found by a pre-aggregated minimum of whole rows."""
    others = [c for c in rows.columns if c not in (key, order)]
    first = rows.groupBy(key).agg(F.min_by(F.struct(order, *others), order).alias("_row"))
    return first.select(key, "_row.*").select(*rows.columns)


def date_windows(spark: SparkSession, start: dt.date, end: dt.date, days: int) -> DataFrame:
    """Half-open windows from start to end, the last one clipped; days below one are refused at once."""
    if days < 1:
        raise ValueError("a window has at least one day")
    if start >= end:
        return spark.createDataFrame([], "window_start date, window_end date")
    begun = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end) - F.expr("interval 1 day"), F.make_dt_interval(F.lit(days)))).alias("window_start")
    )
    return begun.select(F.col("window_start").cast("date").alias("window_start"), F.least(F.date_add("window_start", days), F.lit(end)).alias("window_end"))


def window_of(day: Column, start: Column, days: int) -> Column:
    """Start of the window a day lies in, without a range join."""
    return F.date_add(start, (F.floor(F.datediff(day, start) / F.lit(days)) * days).cast("int"))


def first_filled(*texts: Column) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts))
