"""Quality rules whose cutoffs carry a proven bound on false rejection.

Main path: DataFrame and SQL functions only.  ``measure`` counts words, symbols,
repeated lines and repeated three-word windows of whole texts.  ``rates`` makes
one score of the rules: the largest rate in units of its rule's floor, where a
thousand stands for a rate at its floor.  ``certify`` takes the labelled good
documents that pass the base rule as holdout and selects, for each stratum, the
strictest cutoff of the score whose false-rejection rate is below ``alpha`` by
an exact binomial test.

Multiple testing.  Within a stratum cutoffs are tested in a fixed order, from
the mildest to the strictest, up to the first that fails, so the level is spent
once.  Over strata it is ``delta / k``: the ``k`` strata with the most labels
share it, with the largest ``k`` for which each of them could certify a cutoff
at all, which depends on the numbers of labels alone.  So with probability
``1 - delta`` no stratum loses ``alpha`` or more of its good documents to a
cutoff.  A single stratum needs ln(delta) / ln(1 - alpha) labels, 149 with the
parameters here, four need 217 each; a stratum with too few certifies nothing
and then rejects nothing beyond the base rule.  No cutoff below the floors is
looked for.

Edge cases: a null or empty text has zero words and fails the base rule; a null
stratum is a stratum of its own; contradictory labels of one document do not
count as good; repeated rows are measured each; an empty table gives no rows; an
absent label gives no cutoff; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Floors of the rules' rates, in thousandths: no document is rejected for a lower one.
RULES = {"symbol_rate": 50, "dup_line_rate": 300, "repeat_rate": 300, "long_word_rate": 200}
ALPHA, DELTA = 0.02, 0.05
#: Scores are whole thousandths of a floor up to TOP; a cutoff is a multiple of GRID, at least a thousand.
GRID, TOP = 125, 8000


def words_of(text: Column) -> Column:
    """Words of a text, null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda x: x != "")


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", with_mark: bool = False) -> DataFrame:
    """doc_id, stratum and the counts of each document; on demand the text's mark too.

    Windows are found by sorting one long for each: a hash in the high bits and
    the position in as many low bits as the text needs.  Neighbours with equal
    hashes are compared word by word, so a hash collision adds nothing.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).cast("string").alias("text")
    )
    marked = ["mark"] if with_mark else []
    split = base.withColumn("mark", F.xxhash64("text")).select(
        "doc_id",
        "stratum",
        *marked,
        words_of(F.col("text")).alias("w"),
        F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "doc_id",
        "stratum",
        *marked,
        "w",
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("shiftleft(1L, cast(greatest(1, ceil(log2(size(w) + 1))) as int)) - 1").alias("low"),
    )
    keyed = counted.withColumn(
        "s",
        F.expr(
            "if(n_words < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, cast(n_words as int) - 3),"
            " i -> (xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)) & ~low) | cast(i as bigint))))"
        ),
    )
    same = (
        "coalesce((x & ~low) = (get(s, {j}) & ~low), false)"
        " and get(w, cast(x & low as int)) = get(w, cast(get(s, {j}) & low as int))"
        " and get(w, cast(x & low as int) + 1) = get(w, cast(get(s, {j}) & low as int) + 1)"
        " and get(w, cast(x & low as int) + 2) = get(w, cast(get(s, {j}) & low as int) + 2)"
    )
    found = keyed.withColumn(
        "p",
        F.expr(f"sort_array(transform(filter(s, (x, i) -> ({same.format(j='i - 1')}) or ({same.format(j='i + 1')})), x -> x & low))"),
    )
    return found.select(
        "doc_id",
        "stratum",
        *marked,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.expr(
            "if(size(p) = 0, 0L, 3L + aggregate(zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1),"
            " (a, b) -> least(3L, b - a)), 0L, (t, v) -> t + v))"
        ).alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def rates(measured: DataFrame, rules: dict[str, int] = RULES) -> DataFrame:
    """Whole thousandths of each rule, larger is worse, and the score of them all."""
    thousandths = {
        "symbol_rate": "1000 * n_symbols div greatest(word_chars, 1)",
        "dup_line_rate": "1000 * n_dup_lines div greatest(n_lines, 1)",
        "repeat_rate": "1000 * n_repeat_words div greatest(n_words, 1)",
        "long_word_rate": "least(1000, 20 * word_chars div greatest(n_words, 1))",
    }
    rated = measured.withColumns({k: F.expr(v) for k, v in thousandths.items()})
    return rated.withColumn("score", F.least(F.lit(TOP).cast("long"), F.greatest(F.lit(0).cast("long"), *(F.expr(f"1000 * {r} div {floor}") for r, floor in rules.items()))))


def log_tail(x: str, n: str, p: float) -> str:
    """SQL of ln P(Bin(n, p) <= x), summed term by term in logarithms."""
    odds, first = math.log(p / (1 - p)), math.log1p(-p)
    return (
        f"aggregate(if({x} < 1, cast(array() as array<bigint>), sequence(1L, {x})),"
        f" named_struct('l', {n} * {first!r}D, 's', {n} * {first!r}D),"
        f" (a, k) -> named_struct('l', a.l + ln(({n} - k + 1) / k) + {odds!r}D,"
        f" 's', greatest(a.s, a.l + ln(({n} - k + 1) / k) + {odds!r}D)"
        f" + ln(1 + exp(-abs(a.s - (a.l + ln(({n} - k + 1) / k) + {odds!r}D))))),"
        " a -> a.s)"
    )


def certify(rated: DataFrame, labels: DataFrame, *, alpha: float = ALPHA, delta: float = DELTA, grid: int = GRID) -> DataFrame:
    """stratum, cutoff: reject at ``score >= cutoff``.  One row at most for each stratum."""
    good = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .groupBy("label_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where("quality = 1 and toxic = 0")
    )
    held = rated.where("not base_failed").join(good, rated["doc_id"] == good["label_id"], "left_semi")
    bucket = F.expr(f"if(score < 1000, 0L, score div {grid})")
    counts = shared.materialize(held.groupBy("stratum", bucket.alias("bucket")).agg(F.count("*").alias("n")), "quality-counts")
    sizes = counts.groupBy("stratum").agg(F.sum("n").alias("total"))  # one row a stratum
    ranked = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.desc("total"), F.asc_nulls_first("stratum"))))
    able = F.expr(f"if(total * {math.log1p(-alpha)!r}D <= ln({delta!r}D / k), k, null)")
    shares = ranked.withColumn("strata", F.max(able).over(Window.partitionBy(F.lit(0)))).where("k <= strata")
    shares = shares.select("stratum", "total", F.expr(f"ln({delta!r}D / strata)").alias("level"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bucket"))
    above = counts.withColumn("x", F.sum("n").over(down)).where("bucket > 0")
    tested = shares.alias("s").join(above.alias("a"), F.col("s.stratum").eqNullSafe(F.col("a.stratum")), "left").select(
        "s.stratum", F.expr(f"if(bucket is null, false, if(x > {alpha!r}D * total, true, {log_tail('x', 'total', alpha)} > level))").alias("fails"), "bucket"
    )
    least = -(-1000 // grid)
    worst = F.max(F.expr("if(fails, bucket, null)"))
    return tested.groupBy("stratum").agg((F.greatest(F.coalesce(worst + 1, F.lit(least).cast("long")), F.lit(least).cast("long")) * grid).alias("cutoff"))


def verdicts(measured: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``measured`` with ``kept``; ``measured`` is read twice, so give a written table."""
    rated = rates(measured)
    cut = certify(rated, labels, **options).withColumnRenamed("stratum", "cut_stratum")
    joined = rated.join(cut, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    return joined.withColumn("kept", F.expr("not (base_failed or coalesce(score >= cutoff, false))"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: counts, base rule and certified verdict of every document."""
    measured = shared.materialize(measure(spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))), "quality-measures")
    return verdicts(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with all their columns.

    A verdict follows from the text and the stratum alone, so a row goes by its
    id, text mark and stratum, never by its id.  A null or empty text goes, as the
    base rule asks for fifty words; repeated rows stay or go together; an empty
    table gives no rows; without labels the base rule alone decides.
    """
    measured = shared.materialize(measure(docs.select("doc_id", "lang", "text"), with_mark=True), "quality-measures")
    out = verdicts(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("not kept")
    out = out.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("stratum").alias("_stratum"))
    same = docs["doc_id"].eqNullSafe(out["_id"]) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(out["_mark"])
    return docs.join(out, same & docs["lang"].cast("string").eqNullSafe(out["_stratum"]), "left_anti")


_SCORE = ", ".join(f"1000 * {r} // {floor}" for r, floor in RULES.items())

ORACLE_SQL = {
    "op10_quality_rules": rf"""
with d as (
  select row_number() over () as rid, doc_id, lang as stratum, coalesce(text, '') as text from documents),
w as (
  select rid, doc_id, stratum, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d),
t as (
  select rid, unnest(range(1, len(w) - 1)) as i, w from w where len(w) >= 3),
k as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t from t),
r as (
  select rid, i from (select rid, i, count(*) over (partition by rid, t) as c from k) where c > 1),
c as (
  select rid, count(distinct i + j) as n from r, (values (0), (1), (2)) v(j) group by rid),
m as (
  select w.doc_id, w.stratum, len(w.w)::bigint as n_words,
    length(array_to_string(w.w, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words
  from w left join c using (rid)),
b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    1000 * n_symbols // greatest(word_chars, 1) as symbol_rate,
    1000 * n_dup_lines // greatest(n_lines, 1) as dup_line_rate,
    1000 * n_repeat_words // greatest(n_words, 1) as repeat_rate,
    least(1000, 20 * word_chars // greatest(n_words, 1)) as long_word_rate
  from m),
sc as (select *, least({TOP}, greatest(0, {_SCORE}))::bigint as score from b),
g as (
  select doc_id from labels group by doc_id having min(quality) = 1 and max(coalesce(toxic, 0)) = 0),
h as (
  select stratum, case when score < 1000 then 0 else score // {GRID} end as bucket, count(*) as n from sc
  where not base_failed and doc_id in (select doc_id from g) group by all),
z as (
  select stratum, sum(n)::bigint as total, row_number() over (order by sum(n) desc, stratum nulls first) as k from h group by stratum),
l as (
  select stratum, total, ln({DELTA} / (select max(k) from z where total * ln(1 - {ALPHA!r}::double) <= ln({DELTA} / k))) as level from z
  where k <= (select max(k) from z where total * ln(1 - {ALPHA!r}::double) <= ln({DELTA} / k))),
s as (select stratum, bucket, sum(n) over (partition by stratum order by bucket desc)::bigint as x from h),
f as (
  select l.stratum, s.bucket, case when x > {ALPHA!r} * total then true else
    ln(list_sum(list_transform(range(0, x + 1), lambda q: exp(lgamma(total + 1) - lgamma(q + 1) - lgamma(total - q + 1)
      + q * ln({ALPHA!r}::double) + (total - q) * ln(1 - {ALPHA!r}::double))))) > level end as fails
  from l left join s on l.stratum is not distinct from s.stratum and s.bucket > 0),
cut as (
  select stratum as cut_stratum, greatest(1000, coalesce((max(case when fails then bucket end) + 1) * {GRID}, 1000)) as cutoff from f group by stratum)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or coalesce(score >= cutoff, false)) as kept
from sc left join cut on sc.stratum is not distinct from cut.cut_stratum"""
}

QUERIES = {"op10_quality_rules": op10_quality_rules}
