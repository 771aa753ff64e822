"""Manifest algebra: what changed, what to write, what to fetch, how indexes merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, status) of added, modified and deleted paths of two (path, sha256) manifests."""
    both = old.select("path", F.col("sha256").alias("before")).join(new.select("path", F.col("sha256").alias("after")), "path", "full")
    status = F.when(F.col("before").isNull(), "A").when(F.col("after").isNull(), "D").when(F.col("before") != F.col("after"), "M")
    return both.select("path", status.alias("status"), "before", "after").where("status is not null")


def apply_diff(old: DataFrame, diff: DataFrame) -> DataFrame:
    """The newer manifest out of the older and their difference."""
    kept = old.select("path", "sha256").join(diff.select("path"), "path", "left_anti")
    return kept.unionByName(diff.where("status <> 'D'").select("path", F.col("after").alias("sha256")))


def write_plan(old: DataFrame, new: DataFrame, *, deletes: bool = True) -> DataFrame:
    """(path, action) of a compare-and-write: written, unchanged, deleted.

    Of two new rows with one path the later by ``pos`` wins, if there is a
    ``pos``; ``deletes`` is off for sinks that never remove files.
    """
    if "pos" in new.columns:
        new = new.groupBy("path").agg(F.max_by("sha256", "pos").alias("sha256"))
    known = old.select("path", F.col("sha256").alias("before"))
    fresh = new.select("path", "sha256").join(known, "path", "left")
    plan = fresh.select("path", F.when(F.col("before") == F.col("sha256"), "unchanged").otherwise("written").alias("action"))
    if not deletes:
        return plan
    return plan.unionByName(old.select("path").join(new.select("path"), "path", "left_anti").withColumn("action", F.lit("deleted")))


def merge_index(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old and new index rows by key; the new row wins whole, absent keys stay."""
    columns = [c for c in old.columns if c != key]
    a, b = old.withColumn("_old", F.lit(True)).alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    both = a.join(b, key, "full")
    return both.select(key, *(F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in columns), F.when(F.col("b._new"), "new").otherwise("old").alias("origin"))


def rebuild_index(meta: DataFrame, old: DataFrame) -> DataFrame:
    """Index rows out of law metadata: the old title before the new one, the old link or none."""
    known = old.select("slug", F.col("title").alias("old_title"), F.col("zip_url").alias("old_url"))
    return meta.where("coalesce(slug, '') <> ''").join(known, "slug", "left").select(
        "slug",
        "bjnr",
        "source_xml_sha256",
        F.coalesce(F.nullif("old_title", F.lit("")), "title").alias("title"),
        F.coalesce("old_url", F.lit("")).alias("zip_url"),
    )


def snapshot_action(known: Column, head_equal: Column, hash_equal: Column, present: Column, *, check: bool = False, force: bool = False) -> Column:
    """skip, unchanged, fetched or write, in this order of tests."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = F.when(yes(hash_equal) & yes(present) & F.lit(not force), "fetched").otherwise("write")
    out = F.when(yes(known) & yes(head_equal) & F.lit(not force), "unchanged").otherwise(out)
    return F.when(yes(known) & F.lit(not check and not force), "skip").otherwise(out)


def verify(raw: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Per key: whether the stored form is canonical and whether its recorded hash is right."""
    return raw.join(meta, key, "left").select(
        key,
        F.coalesce(F.col("canonical") == F.col("stored"), F.lit(False)).alias("is_canonical"),
        F.coalesce(F.sha2("stored", 256) == F.col("recorded_sha256"), F.lit(False)).alias("hash_matches"),
    )


def run_report(outcomes: DataFrame, outcome: str = "action") -> DataFrame:
    """One row of counters; what was not written counts as unchanged, fetched or not."""
    c = F.col(outcome)
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(c.isin("fetched", "write")).alias("fetched"),
        F.count_if(~c.isin("write", "failed")).alias("unchanged"),
        F.count_if(c == "write").alias("written"),
        F.count_if(c == "failed").alias("failed"),
    )


def new_rows(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Idempotent append: rows whose keys are not stored yet, null-safe."""
    seen = stored.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    match = None
    for k in keys:
        own = rows[k].eqNullSafe(seen[f"_{k}"])
        match = own if match is None else match & own
    return rows.join(seen, match, "left_anti")
