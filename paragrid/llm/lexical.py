"""Ranked lexical search by sort-based accumulation.

1. One scan finds each document's length in terms and its frequencies of the
   terms that some item asks for; nothing else of a text is kept.
2. Counts over all documents (their number, their terms, and the documents of
   each term asked for) give integer weights.
3. Documents are range-partitioned by id.  A task turns its documents' matches
   into arrays of (item, document, impact), a bounded number at a time, sorts
   the packed keys with a radix sort, sums equal keys with ``reduceat``, and
   selects each item's best with a heap.
4. The tasks' best are merged in two levels, so no group grows with the tasks.

Items are taken in blocks of at most about ``TERMS`` (item, term) pairs, and each
block against all documents; a block's terms are the only thing that all tasks
get.  Terms of more than 32 bytes go by a 256-bit name.

Edge cases: a null or empty text has no term, counts in neither number nor
length, and is never found; an item without a term finds nothing; rows of one
item_id are one item with all their terms, null being an id of its own; repeated
document rows are ranked each, equal scores by id, null last; an empty table on
either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

#: Results of an item, (item, term) pairs of a block, and matches that are sorted at a time.
K, TERMS, MATCHES = 50, 1 << 17, 1 << 21
#: Every byte that no term holds becomes a blank; A-Z fold; bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
FOUND = "doc_id long, n long, terms array<int>, tfs array<long>"
BEST = "item_id long, doc_id long, uid long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(FOLD).split()


def name_of(term: bytes) -> bytes:
    """The term, or 33 bytes for a longer one."""
    return term if len(term) <= 32 else b"\0" + blake2b(term, digest_size=32).digest()


def item_terms(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id and term, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = {(i, name_of(t)) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in terms_of(text or b"")}
            ids, terms = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def match_documents(docs: DataFrame, number: dict[bytes, int], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, and the numbers and frequencies of the given terms, for every document with a term."""
    longest = max(map(len, number), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, terms, tfs, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                for word, tf in Counter(words).items():
                    at = number.get(word if len(word) <= 32 else name_of(word)) if longest else None
                    if at is not None:
                        terms.append(at)
                        tfs.append(tf)
                ids.append(doc_id)
                lengths.append(len(words))
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )
        shared.trim()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    return rows.mapInArrow(run, FOUND)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """Order of unsigned keys: a stable pass for each 16 bits in use, which numpy does as a radix sort."""
    order, top = np.arange(len(keys)), int(keys.max()) if len(keys) else 0
    for shift in range(0, max(1, top.bit_length()), 16):
        digit = (keys[order] >> np.uint64(shift)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


class Accumulator:
    """Scores documents against a block's items; ``best`` holds each item's best so far."""

    def __init__(self, heads: np.ndarray, items: np.ndarray, weights: np.ndarray, n_items: int, k: int):
        self.heads, self.items, self.weights, self.k = heads, items, weights, k
        self.best: list[list[tuple]] = [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, dtype=np.int64)  # a score must be above 0, and reach an item's k-th

    def add(self, docs: list[tuple], m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, matches: int = MATCHES) -> None:
        """Documents as (order among ties, doc_id, uid), their m, and their terms, which end at ``ends``."""
        counts = np.diff(self.heads)
        owner = np.repeat(np.arange(len(docs)), np.diff(ends))
        impact = self.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner]))
        made = np.concatenate([[0], np.cumsum(counts[terms])])[ends]  # matches before each document
        at = 0
        while at < len(docs):
            end = max(at + 1, min(int(np.searchsorted(made, made[at] + matches, side="right")) - 1, at + 65536, len(docs)))
            own = slice(int(ends[at]), int(ends[end]))
            self._sum(docs, at, owner[own], terms[own], impact[own], counts)
            at = end

    def _sum(self, docs: list[tuple], at: int, owner: np.ndarray, terms: np.ndarray, impact: np.ndarray, counts: np.ndarray) -> None:
        each = counts[terms]
        total = int(each.sum())
        if not total:
            return
        place = np.arange(total) - np.repeat(np.cumsum(each) - each, each) + np.repeat(self.heads[terms], each)
        keys = (self.items[place].astype(np.uint64) << np.uint64(16)) | np.repeat(owner - at, each).astype(np.uint64)
        order = radix_order(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sums, keys = np.add.reduceat(np.repeat(impact, each)[order], starts), keys[starts]
        item, doc = (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(0xFFFF)).astype(np.int64) + at
        high = (sums > 0) & (sums >= self.least[item])
        item, doc, sums = item[high], doc[high], sums[high]
        if not len(item):
            return
        heads = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        for begin, end in zip(heads, [*heads[1:], len(item)], strict=True):
            mine, scores = int(item[begin]), sums[begin:end]
            if len(scores) > self.k:
                cut = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
                keep = np.flatnonzero(scores >= cut)
            else:
                keep = range(len(scores))
            rows = [(int(-scores[j]), *docs[int(doc[begin + j])]) for j in keep]
            self.best[mine] = heapq.nsmallest(self.k, self.best[mine] + rows)
            if len(self.best[mine]) == self.k:
                self.least[mine] = -self.best[mine][-1][0]


def score_block(matches: DataFrame, pairs: list[tuple], number: dict[bytes, int], *, k: int) -> DataFrame:
    """Each task's best documents of each item, for the items of one block."""
    stats = matches.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = stats["n"], stats["l"] or 1
    df = np.zeros(len(number), dtype=np.int64)
    for r in matches.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # at most a block's terms
        df[r["term"]] = r["df"]
    weights = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    ids = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
    place = {i: at for at, i in enumerate(ids)}
    by_term = sorted((number[t], place[i]) for i, t in pairs)
    items = np.array([i for _, i in by_term], dtype=np.int64)
    heads = np.searchsorted(np.array([t for t, _ in by_term]), np.arange(len(number) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Accumulator(heads, items, weights, len(ids), k)
        for batch in batches:
            uids, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            n = batch.column(2).to_numpy()
            if len(n) and 50 * int(n.max()) * n_docs < 1 << 63:
                m = 50 + 50 * n * n_docs // n_terms
            else:
                m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)
            lists = batch.column(3)
            ends = lists.offsets.to_numpy().astype(np.int64)
            used = slice(int(ends[0]), int(ends[-1]))
            terms, tfs, ends = lists.values.to_numpy()[used], batch.column(4).values.to_numpy()[used], ends - ends[0]
            docs = [(d is None, d or 0, u) for d, u in zip(doc_ids, uids, strict=True)]
            block.add(docs, m, ends, terms, tfs)
        rows = [(ids[at], None if none else d, u, -s) for at, best in enumerate(block.best) for s, none, d, u in best]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "uid", "score"])
        shared.trim()

    ranged = matches.repartitionByRange(shared.shuffle_parts(matches), "doc_id", "uid")
    return ranged.select("uid", "doc_id", "n", "terms", "tfs").mapInArrow(run, BEST)


def search(docs: DataFrame, items: DataFrame, *, k: int = K, block_pairs: int = TERMS) -> DataFrame:
    """The operator: item_id, rank, doc_id, score of each item's ``k`` best documents."""
    spark = docs.sparkSession
    pairs = shared.materialize(item_terms(items), "search-terms")
    n_blocks = max(1, -(-pairs.count() // block_pairs))
    found = []
    for block in range(n_blocks):  # one block unless there are very many items
        own = [(r["item_id"], bytes(r["term"])) for r in pairs.where(F.expr(f"pmod(xxhash64(item_id), {n_blocks}) = {block}")).collect()]
        number = {t: at for at, t in enumerate(sorted({t for _, t in own}))}
        matches = match_documents(docs, number).withColumn("uid", F.monotonically_increasing_id())
        matches = shared.materialize(matches, "search-matches")
        found.append(shared.materialize(score_block(matches, own, number, k=k), "search-best"))
        shared.drop_files(matches)
        shared.release(spark)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("uid")]
    some = Window.partitionBy("item_id", F.expr("pmod(xxhash64(uid), 64)")).orderBy(*order)
    best = best.withColumn("nth", F.row_number().over(some)).where(F.col("nth") <= k)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the fifty best documents of each benchmark item."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The pattern of a term, as fixed by the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLE_SQL = {
    "op11_ranked_search": rf"""
with fold as (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') as t from documents),
d as (select uid, doc_id, t, len(t) as n from fold where len(t) > 0),
s as (select count(*)::bigint as nn, sum(n)::bigint as ll from d),
f as (select uid, doc_id, n, term, count(*)::bigint as tf from (select uid, doc_id, n, unnest(t) as term from d) group by all),
w as (select term, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)))::bigint as w from f, s group by term, nn),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term from benchmark),
r as (
  select item_id, uid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))))::bigint as score
  from q join f using (term) join w using (term), s group by all)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last, uid)::int as rank, doc_id, score
from r where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id nulls last, uid) <= {K}"""
}
