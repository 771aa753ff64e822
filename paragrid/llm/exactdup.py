"""Exact deduplication by an extendible-hash index on shared files.

Main path: DataFrame and SQL functions only.  Texts are equal when they are
identical after A-Z are lower-cased; of equal texts the row with the largest id
stays.

1. One scan gives every row a 64-bit key and a digest; texts are not shuffled.
2. Equal (key, digest) collapse to one entry with its last row and its size,
   pre-aggregated, so a text that a third of all rows hold is one row a task.
3. The directory starts with two buckets and doubles: a bucket of more than
   ``capacity`` entries is split by the next bits of its keys, and only such
   buckets are.  A bucket is a range of keys, named by (depth, prefix).
4. Entries go to owner tasks by ranges of buckets; each writes its buckets, in
   order of keys, as one file of the index.  Entries with one key are a chain.
5. Bytes decide: texts of keys with two rows or more are compared by grouping on
   the whole text, combined before the shuffle.  If a chain's entry turns out to
   hold two texts, its rows are told apart by their texts.

Edge cases: a null text counts as empty; a null id is smaller than any other, so
such a row stays only among its like, and it is then keep_id null; of rows equal
in id and text one stays; an empty table gives an empty index and no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

#: Entries of a bucket, the most bits of a key that a directory uses, and the share of all rows from which a key is hot.
CAPACITY, DEEPEST, HOT = 1 << 16, 62, 1000


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null is empty."""
    plain = F.coalesce(text, F.lit(""))
    folded = F.translate(plain, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(plain) == F.char_length(plain), F.lower(plain)).otherwise(folded)  # ASCII has a fast way


def key_of(text: Column) -> Column:
    """The index key of a normalised text."""
    return F.xxhash64(text)


def digest_of(text: Column) -> Column:
    """The digest that tells the entries of a chain apart."""
    return F.unhex(F.sha2(text, 256))


def keyed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid, doc_id, key and digest of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col).cast("string")).alias("norm"))
    return texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", key_of(F.col("norm")).alias("key"), digest_of(F.col("norm")).alias("digest"))


def entries_of(keyed: DataFrame) -> DataFrame:
    """One entry for each (key, digest): the row that stays, and how many there are."""
    grouped = keyed.groupBy("key", "digest").agg(F.max(F.struct("doc_id", "uid")).alias("last"), F.count("*").alias("size"))
    return grouped.select("key", "digest", F.col("last.doc_id").alias("keep_id"), F.col("last.uid").alias("keep_uid"), "size")


def _prefix(depth: Column) -> Column:
    """The first ``depth`` bits of the key, one bit or more."""
    return F.call_function("shiftrightunsigned", F.col("key"), (F.lit(64) - depth).cast("int"))


def hash_directory(entries: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """depth, prefix and number of entries of each bucket that has any.

    A round counts the open buckets' entries at the depth at which they should
    fit, and sums the counts up to all depths on the way, so a bucket's own depth
    is the least at which it is not overfull.  Where keys agree in more bits than
    chance has them, rounds look twice as far each time; keys that agree in
    ``DEEPEST`` bits stay in one bucket, however many they are.
    """
    spark = entries.sparkSession
    open_keys, begin, reach, done = entries.select("key"), 1, 0, None
    most = entries.count()
    while most:
        reach = max(2 * reach, math.ceil(math.log2(max(2, most / capacity))))
        end = min(DEEPEST, begin + reach)
        finest = open_keys.select(_prefix(F.lit(end)).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("entries"))
        levels = finest.select(F.explode(F.sequence(F.lit(begin), F.lit(end))).alias("depth"), "prefix", "entries")
        levels = levels.groupBy("depth", F.call_function("shiftright", F.col("prefix"), F.lit(end) - F.col("depth")).alias("prefix")).agg(F.sum("entries").alias("entries"))
        levels = shared.materialize(levels, "hash-levels")
        full = F.col("entries") > capacity
        parents = levels.where(full).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        split = levels.withColumn("parent", F.expr("shiftright(prefix, 1)")).join(parents, ["depth", "parent"], "left_semi")
        settled = levels.where(F.col("depth") == begin).unionByName(split.select(levels.columns)).where(~full | (F.col("depth") == DEEPEST))
        done = settled if done is None else done.unionByName(settled)
        over = levels.where(full & (F.col("depth") == end) & (F.col("depth") < DEEPEST))
        most = over.agg(F.max("entries")).first()[0]
        if most:
            heavy = over.select("prefix")
            open_keys = open_keys.withColumn("prefix", _prefix(F.lit(end))).join(heavy, "prefix", "left_semi").select("key")
            begin = end + 1
    if done is None:
        return spark.createDataFrame([], "depth int, prefix long, entries long")
    return done.select(F.col("depth").cast("int").alias("depth"), "prefix", "entries")


def build_index(docs: DataFrame, *, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' keys, the directory, and the buckets' entries, all on shared files.

    Buckets: first (where the bucket's range of keys begins, in its upper 63 bits),
    key, digest, link (place in the key's chain, from 1), keep_id, keep_uid, size.
    """
    keyed = shared.materialize(keyed_rows(docs, id_col=id_col, text_col=text_col), "hash-rows")
    entries = shared.materialize(entries_of(keyed), "hash-entries")
    directory = shared.materialize(hash_directory(entries, capacity=capacity), "hash-directory")
    depths = sorted(r["depth"] for r in directory.select("depth").distinct().collect())  # at most DEEPEST numbers
    looked = entries.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths or [1]])))
    looked = looked.withColumn("prefix", _prefix(F.col("depth")))
    placed = looked.join(directory.select("depth", "prefix"), ["depth", "prefix"])
    first = F.call_function("shiftleft", F.col("prefix"), (F.lit(63) - F.col("depth")).cast("int"))
    owned = placed.withColumn("first", first).repartitionByRange(shared.shuffle_parts(entries), "first")  # a bucket has one owner
    chained = owned.withColumn("link", F.row_number().over(Window.partitionBy("first", "key").orderBy("digest")))
    buckets = chained.select("first", "key", "digest", "link", "keep_id", "keep_uid", "size")
    buckets = shared.materialize(buckets, "hash-buckets")
    shared.drop_files(entries)
    return keyed, directory, buckets


def hot_keys(buckets: DataFrame, parts: int) -> DataFrame:
    """key and shares: in how many shares its rows are dealt, for keys with a thousandth of all rows or more, so at most a thousand."""
    total = buckets.agg(F.sum("size")).first()[0] or 0
    keys = buckets.groupBy("key").agg(F.sum("size").alias("rows")).where(F.col("rows") * HOT >= total)
    return keys.select("key", F.ceil(F.col("rows") * parts / F.lit(max(1, total))).cast("int").alias("shares"))


def join_by_key(rows: DataFrame, table: DataFrame, on: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with what ``table`` has for them; a hot key's rows are dealt over tasks, and its entries copied to each.

    A merge join at every size, as ``table`` grows with the rows.
    """
    hot = F.broadcast(hot)  # at most a thousand rows of two numbers
    dealt = rows.join(hot, "key", "left").withColumn("share", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("shares")), F.lit(0).cast("long")))
    copied = table.join(hot, "key", "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("shares", F.lit(1)).cast("long") - 1)))
    return dealt.drop("shares").join(copied.drop("shares").hint("merge"), [*on, "share"], how).drop("share")


def same_bytes(docs: DataFrame, buckets: DataFrame, hot: DataFrame, *, text_col: str = "text") -> DataFrame:
    """key, digest, and the number of different texts of each entry whose key has two rows or more."""
    repeated = buckets.groupBy("key").agg(F.sum("size").alias("rows")).where("rows > 1").select("key")
    texts = docs.select(normalised(F.col(text_col).cast("string")).alias("norm")).withColumn("key", key_of(F.col("norm")))
    compared = join_by_key(texts, repeated, ["key"], hot, "left_semi").groupBy("key", "norm").agg(F.count("*").alias("rows"))
    return compared.groupBy("key", digest_of(F.col("norm")).alias("digest")).agg(F.count("*").alias("texts"))


def dedup_exact(docs: DataFrame, *, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The operator: doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    keyed, _, buckets = build_index(docs, capacity=capacity, id_col=id_col, text_col=text_col)
    shared.release(docs.sparkSession)
    hot = shared.materialize(hot_keys(buckets, shared.shuffle_parts(docs)), "hash-hot")
    mixed = shared.materialize(same_bytes(docs, buckets, hot, text_col=text_col).where("texts > 1").select("key", "digest"), "hash-mixed")
    found = buckets.select("key", "digest", "keep_id", "keep_uid", "size")
    rows = join_by_key(keyed, found, ["key", "digest"], hot)
    out = ["doc_id", "keep_id", F.col("size").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept")]
    if mixed.isEmpty():
        return rows.select(*out, F.lower(F.hex("digest")).alias("text_sha256"))

    # Entries that hold several texts: their rows' texts are read again and are the groups themselves.
    single = rows.join(mixed, ["key", "digest"], "left_anti").select(*out, "key", "digest")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col).cast("string")).alias("norm"))
    texts = texts.withColumns({"key": key_of(F.col("norm")), "digest": digest_of(F.col("norm"))}).join(mixed, ["key", "digest"], "left_semi")
    texts = shared.materialize(texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "norm", "key", "digest"), "hash-texts")
    groups = texts.groupBy("norm").agg(F.max(F.struct("doc_id", "uid")).alias("last"), F.count("*").alias("size"))
    groups = groups.select("norm", F.col("last.doc_id").alias("keep_id"), F.col("last.uid").alias("keep_uid"), "size")
    told = texts.join(groups, "norm").select(*out, "key", "digest")
    return single.unionByName(told).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: which row of its group of equal texts stays, for every document."""
    return dedup_exact(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))


QUERIES = {"op13_exact_dedup": op13_exact_dedup}
ORACLE_SQL = {
    "op13_exact_dedup": f"""
with t as (
  select doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from t"""
}
