"""Line deduplication within one word edit, across the corpus.

Main path: DataFrame and SQL functions only.  A line is its sequence of words.
A line with a word is dropped if an earlier line, in order of (doc_id, line
number), is equal.  The edit bound is one word for lines of at least
``min_words`` words, where that is a similarity of 0.8 or more, and zero below:
such a line is also dropped if an earlier one of at least ``min_words`` words is
within one insertion, deletion or substitution.  Blank lines stay.

1. Equal lines collapse to one with its earliest place (pre-aggregated).
2. Two lines within one edit share the first or the last half of their words.
   Only lines with a half that another line shares go on; this loses none.
3. Deletion neighbourhood: such a line emits the hash of its words, and of its
   words without each one, with that place.  In a run of equal words all
   deletions are one variant, whose place is the whole run.  A line without one
   word equals another whole line: one insertion.  Two lines without a word at
   places that meet are equal: one substitution.  The earliest line of each key
   and place decides, so a key shared by very many lines stays an aggregate of at
   most as many places as there are different lines, and no pairs are made.
4. The line and its witness are compared word by word before it is dropped.
   Where that fails, which takes equal hashes of different variants, the line is
   held against all earlier lines of its keys.

Edge cases: a null text has no lines and stays null; an empty text has one empty
line; lines at the same (doc_id, line number), as in repeated rows, do not drop
each other; a null doc_id sorts first; an empty table gives no rows; extra
columns are ignored by the query and kept by the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared
from .quality import words_of

MIN_WORDS = 5


def line_table(rows: DataFrame, min_words: int) -> DataFrame:
    """doc_id, mark, line_no, n, two hashes of the words, and the hashes of the line's halves.

    The first ``n div 2`` words and the rest are hashed once each; the line's two
    hashes are made of these.
    """
    lines = rows.select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    split = lines.select("doc_id", "mark", F.col("line_no").cast("long").alias("line_no"), words_of(F.col("line")).alias("w"))
    counted = split.withColumn("n", F.size("w"))
    parted = counted.withColumns({"a": F.expr("xxhash64(1, slice(w, 1, n div 2))"), "b": F.expr("xxhash64(2, slice(w, n div 2 + 1, n))")})
    odd = "array(a, xxhash64(2, slice(w, n - n div 2 + 1, n div 2)))"
    even = "array(a, b, xxhash64(1, slice(w, 1, n div 2 - 1)), xxhash64(2, slice(w, n div 2 + 2, n)))"
    return parted.select(
        "doc_id",
        "mark",
        "line_no",
        "n",
        F.xxhash64("a", "b", "n").alias("h1"),
        F.xxhash64(F.lit(17), "b", "n", "a").alias("h2"),
        F.when(F.col("n") >= min_words, F.expr(f"if(n % 2 = 1, {odd}, {even})")).alias("halves"),
    )


def prefix_xor(rows: DataFrame, source: str, out: str, block: int = 64) -> DataFrame:
    """Adds ``out``: for each element of an array of longs, the xor of all before it; blockwise, so long lines stay cheap."""
    grow = "(acc, x) -> array_append(acc, get(acc, size(acc) - 1) ^ x)"
    made = rows.withColumn(
        "_inner",
        F.expr(f"transform(sequence(0, (size({source}) - 1) div {block}), k -> aggregate(slice({source}, k * {block} + 1, {block}), array(0L), {grow}))"),
    )
    made = made.withColumn("_heads", F.expr("aggregate(transform(_inner, p -> get(p, size(p) - 1)), array(0L), (acc, x) -> array_append(acc, get(acc, size(acc) - 1) ^ x))"))
    # zip_with takes each array once; a lambda that names an array may have it made again for every element
    joined = F.expr("flatten(zip_with(_inner, slice(_heads, 1, size(_inner)), (p, before) -> transform(slice(p, 1, size(p) - 1), v -> v ^ before)))")
    return made.withColumn(out, joined).drop("_inner", "_heads")


def deletion_keys(words: DataFrame) -> DataFrame:
    """Adds ``keys``, ``lows`` and ``highs``: the key of the whole line, then of the line without one word of each run of equal words.

    The places of the first and last word of the run say where it was, from 1; the
    whole line has place 0.  A key is the xor of the hashes of (word, place), so all of a line's keys come
    from running xors over its places before and after a deletion.
    """
    placed = words.withColumns({
        "x": F.expr("transform(w, (h, i) -> xxhash64(h, i))"),
        "y": F.expr("transform(w, (h, i) -> xxhash64(h, i - 1))"),
    })
    summed = prefix_xor(prefix_xor(placed, "x", "px"), "y", "py")
    last = "size(w) - 1"
    whole = summed.withColumns({"tx": F.expr(f"get(px, {last}) ^ get(x, {last})"), "ty": F.expr(f"get(py, {last}) ^ get(y, {last})")})
    runs = whole.withColumn("heads", F.expr("filter(sequence(0, size(w) - 1), i -> i = 0 or get(w, i) <> get(w, i - 1))"))
    keys = F.expr("concat(array(tx), transform(heads, i -> get(px, i) ^ ty ^ get(py, i) ^ get(y, i)))")
    lows = F.expr("concat(array(0), transform(heads, i -> i + 1))")
    highs = F.expr("concat(array(0), slice(heads, 2, size(heads)), array(size(w)))")
    return runs.withColumns({"keys": keys, "lows": lows, "highs": highs}).drop("x", "y", "px", "py", "tx", "ty", "heads")


def within_one_edit(x: str, y: str) -> Column:
    """Whether two arrays are within one insertion, deletion or substitution."""
    same = f"coalesce(array_position(zip_with({x}, {y}, (a, b) -> a <=> b), false), 0)"
    at = f"cast({same} as int)"
    return F.expr(
        f"{x} = {y}"
        f" or (size({x}) = size({y}) and slice({x}, {at} + 1, size({x})) = slice({y}, {at} + 1, size({y})))"
        f" or (size({x}) = size({y}) + 1 and slice({x}, {at} + 1, size({x})) = slice({y}, {at}, size({y})))"
        f" or (size({x}) + 1 = size({y}) and slice({x}, {at}, size({x})) = slice({y}, {at} + 1, size({y})))"
    )


def _candidates(distinct: DataFrame) -> DataFrame:
    """The distinct lines with a half that another line has."""
    halves = distinct.select("h1", "h2", F.explode("halves").alias("half"))
    shares = halves.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("half")
    return halves.join(shares, "half").select("h1", "h2").distinct()


def near_dropped(distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """h1, h2 of the distinct lines that an earlier, different line within one edit drops."""
    spark = rows.sparkSession
    chosen = shared.materialize(distinct.join(_candidates(distinct), ["h1", "h2"], "left_semi").select("h1", "h2", "at"), "line-chosen")
    shared.release(spark)
    per_doc = chosen.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.mark").alias("mark")).agg(
        F.collect_list(F.struct("h1", "h2", F.col("at.line_no").alias("line_no"))).alias("wanted")
    )
    texts = rows.alias("r").join(
        per_doc.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & F.col("r.mark").eqNullSafe(F.col("p.mark"))
    )
    picked = texts.select(F.col("r.doc_id").alias("doc_id"), F.split("r.text", "\n").alias("lines"), "p.wanted").select(
        "doc_id", F.explode(F.transform("wanted", lambda x: F.struct(x["h1"], x["h2"], x["line_no"], F.get("lines", x["line_no"].cast("int")).alias("line")))).alias("x")
    )
    words = picked.select(
        F.col("x.h1").alias("h1"),
        F.col("x.h2").alias("h2"),
        F.struct("doc_id", F.col("x.line_no").alias("line_no"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2")).alias("at"),
        F.transform(words_of(F.col("x.line")), lambda w: F.xxhash64(w)).alias("w"),
    )
    words = shared.materialize(deletion_keys(words), "line-candidates")
    shared.release(spark)

    # (key, low, high): place 0 is the whole line, low to high a run of which one word is left out
    variants = words.select("h1", "h2", "at", F.explode(F.arrays_zip("keys", "lows", "highs")).alias("v"))
    variants = variants.select("h1", "h2", "at", F.col("v.keys").alias("key"), F.col("v.lows").alias("low"), F.col("v.highs").alias("high"))
    shares = words.select("h1", F.explode("keys").alias("key")).groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
    met = shared.materialize(variants.join(shares.where("lo <> hi").select("key"), "key"), "line-variants")
    shared.release(spark)
    by_place = met.groupBy("key", "low", "high").agg(F.min("at").alias("first"))
    by_key = by_place.groupBy("key").agg(
        F.min(F.when(F.col("low") == 0, F.col("first"))).alias("whole"),
        F.min(F.when(F.col("low") > 0, F.col("first"))).alias("cut"),
        F.collect_list(F.when(F.col("low") > 0, F.struct("low", "high", "first"))).alias("firsts"),  # at most one a line and a line's words
    )
    here = F.filter("firsts", lambda f: (f["low"] <= F.col("high")) & (f["high"] >= F.col("low")))
    joined = met.join(by_key, "key").withColumn("first", F.array_min(F.transform(here, lambda f: f["first"])))
    witness = F.when(F.col("low") == 0, F.col("cut")).otherwise(F.least("first", "whole"))
    early = joined.select("h1", "h2", "at", witness.alias("by")).where("by < at and (by.h1 <> h1 or by.h2 <> h2)")
    early = early.groupBy("h1", "h2").agg(F.min("by").alias("by"))
    mine = words.select("h1", "h2", "w").dropDuplicates(["h1", "h2"])
    other = mine.select(F.col("h1").alias("y1"), F.col("h2").alias("y2"), F.col("w").alias("y"))

    def verified(pairs: DataFrame) -> DataFrame:
        held = pairs.join(mine, ["h1", "h2"]).join(other, (F.col("by.h1") == F.col("y1")) & (F.col("by.h2") == F.col("y2")))
        return held.select("h1", "h2", within_one_edit("w", "y").alias("near"))

    checked = shared.materialize(verified(early), "line-checked")
    failed = checked.where("not near").select("h1", "h2")
    near = checked.where("near").select("h1", "h2")
    if failed.isEmpty():
        return near
    again = met.join(failed, ["h1", "h2"]).select("key", "h1", "h2", "at")
    every = again.join(met.select("key", F.col("at").alias("by")), "key").where("by < at and (by.h1 <> h1 or by.h2 <> h2)").select("h1", "h2", "by").distinct()
    return near.unionAll(verified(every).where("near").select("h1", "h2").distinct())


def line_flags(rows: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, mark and, for each line in order, whether it is dropped."""
    spark = rows.sparkSession
    lines = shared.materialize(line_table(rows, min_words), "line-table")
    distinct = (
        lines.where("n > 0")
        .groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "line_no", "mark", "halves")).alias("at"), F.count("*").alias("seen"))
        .select("h1", "h2", "at", "seen", "at.halves")
    )
    distinct = shared.materialize(distinct, "line-distinct")
    shared.release(spark)
    near = shared.materialize(near_dropped(distinct, rows), "line-near").distinct()
    shared.release(spark)
    decided = (
        distinct.select("h1", "h2", F.struct("at.doc_id", "at.line_no").alias("first"), "seen")
        .join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
        .where("seen > 1 or near")
    )
    flagged = lines.join(decided, ["h1", "h2"], "left").select(
        "doc_id",
        "mark",
        "line_no",
        F.coalesce((F.col("n") > 0) & (F.coalesce("near", F.lit(False)) | (F.struct("doc_id", "line_no") > F.col("first"))), F.lit(False)).alias("drop"),
    )
    flags = flagged.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(F.struct("line_no", "drop"))).alias("f"))
    flags = shared.materialize(flags.select("doc_id", "mark", F.transform("f", lambda x: x["drop"]).alias("drops")), "line-flags")
    shared.drop_files(lines)
    shared.drop_files(distinct)
    shared.release(spark)
    return flags


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The operator: doc_id, mark, text, n_lines, n_dropped and kept_text of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    flags = line_flags(rows, min_words=min_words)
    joined = rows.alias("r").join(
        flags.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("r.mark").eqNullSafe(F.col("f.mark")), "left"
    )
    lined = joined.select("r.doc_id", "r.mark", "r.text", "f.drops", F.split("r.text", "\n").alias("lines"))
    return lined.select(
        "doc_id",
        "mark",
        "text",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("drops", lambda d: d)), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.filter("lines", lambda x, i: ~F.coalesce(F.get("drops", i), F.lit(False))), "\n").alias("kept_text"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: lines and dropped lines of every document, and the digest of what stays."""
    done = dedup_lines(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return done.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).alias("n_lines"), "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without the dropped lines; one that loses all its words goes.

    A null or blank text stays as it is; rows that repeat id and text spare each
    other; n_chars follows the text; an empty table gives no rows.
    """
    changed = dedup_lines(docs).where("n_dropped > 0").select("doc_id", "mark", "kept_text")
    return shared.with_new_texts(docs, changed, lambda text: F.xxhash64(text))


ORACLE_SQL = {
    "op4_line_dedup": rf"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents),
w as (
  select *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from l),
e as (select doc_id, line_no, w from w where len(w) >= {MIN_WORDS}),
v as (
  select doc_id, line_no, 0 as place, array_to_string(w, chr(1)) as k from e
  union all
  select doc_id, line_no, i as place, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), chr(1)) as k
  from (select *, unnest(range(1, len(w) + 1)) as i from e)),
m as (select k, place, min(struct_pack(d := doc_id, l := line_no)) as f from v group by all),
q as (select k, min(f) filter (where place = 0) as whole, min(f) filter (where place > 0) as cut from m group by k),
x as (select array_to_string(w, chr(1)) as k, min(struct_pack(d := doc_id, l := line_no)) as f from w where len(w) > 0 group by all),
d as (
  select doc_id, line_no from w join x on k = array_to_string(w, chr(1)) where len(w) > 0 and f < struct_pack(d := doc_id, l := line_no)
  union
  select distinct doc_id, line_no from v join m using (k, place) join q using (k)
  where m.f < struct_pack(d := doc_id, l := line_no)
    or (place > 0 and q.whole < struct_pack(d := doc_id, l := line_no))
    or (place = 0 and q.cut < struct_pack(d := doc_id, l := line_no)))
select w.doc_id, count(*) as n_lines, count(d.doc_id) as n_dropped,
  sha256(coalesce(string_agg(w.line, chr(10) order by w.line_no) filter (where d.doc_id is null), '')) as kept_sha256
from w left join d using (doc_id, line_no) group by w.doc_id"""
}

QUERIES = {"op4_line_dedup": op4_line_dedup}
