"""Best-fit packing by bin completion over the histogram of piece lengths.

The plan never sees rows: pieces of one length are interchangeable, so the
driver works on at most ``capacity`` counts and yields patterns (the lengths in
a sequence) with multiplicities.  The search takes the largest remaining length
and enumerates, fullest first and lazily, all undominated fillings of the rest of
its sequence, each as often as it can be had and then fewer times.  A filling is
dominated if some of its pieces, or none, can give way to one larger piece left
over, or several to one as large.  Nodes are pruned by the waste that an
improvement could still afford, by the lower bound of what is left, and if what
is left was met before with as few sequences; best-fit decreasing completes each
node to keep incumbents.  The search ends at the lower bound; ``node_limit``
bounds its nodes, and with None it is exact.  Pieces then find their slot by
their rank within their length, a running count inside each partition plus the
partition's offset, so a length that a third of all pieces share is dealt out
evenly.

Edge cases: a null text counts as empty and is one piece with the end id alone;
repeated rows are packed each; a text of any length is cut only into
full-capacity pieces and a rest; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import bpe, shared

Pattern = tuple[tuple[int, int], ...]  # ((length, copies), ...)
PIECES = "part int, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: sequences that any packing needs."""
    if not counts:
        return 0
    hist = np.zeros(capacity + 2, dtype=object)
    for length, n in counts.items():
        hist[length] += n
    number, tokens = np.cumsum(hist), np.cumsum(hist * np.arange(capacity + 2))
    best = -(-int(tokens[-1]) // capacity)
    half = capacity // 2
    for a in range(1, half + 1):
        large = number[capacity] - number[capacity - a]
        middle = number[capacity - a] - number[half]
        free = middle * capacity - (tokens[capacity - a] - tokens[half])
        small = tokens[half] - tokens[a - 1]
        best = max(best, int(large + middle + max(0, -(-(small - free) // capacity))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts; equal sequences stay one entry."""
    groups: dict[int, list[list]] = {}  # residual: [[pattern, multiplicity], ...]
    free = np.zeros(capacity + 1, dtype=bool)

    def put(residual: int, pattern: Pattern, n: int) -> None:
        if n:
            groups.setdefault(residual, []).append([pattern, n])
            free[residual] = True

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = int(np.argmax(free[length:])) + length
            if not free[at]:
                each = capacity // length
                full, rest = divmod(left, each)
                put(capacity - each * length, ((length, each),), full)
                put(capacity - rest * length, ((length, rest),), 1 if rest else 0)
                break
            entry = groups[at][-1]
            each = min(at // length, left)
            n = min(entry[1], left // each)
            entry[1] -= n
            if not entry[1]:
                groups[at].pop()
                free[at] = bool(groups[at])
            put(at - each * length, (*entry[0], (length, each)), n)
            left -= n * each
    return [(p, n) for entries in groups.values() for p, n in entries]


def _bits(values) -> int:
    out = 0
    for v in values:
        out |= 1 << v
    return out


def _dominated(filling: tuple[int, ...], counts: dict[int, int], room: int) -> bool:
    """Whether a piece left over could take the place of none or some of the filling's, and be larger or one for several."""
    need = Counter(filling)
    spare = _bits(x for x, n in counts.items() if x <= room and n > need.get(x, 0))
    single = several = 0  # sums of one piece, of two or more
    for x in filling:
        several |= (several | single) << x
        single |= 1 << x
    if several & spare:
        return True
    reach, width, waste = (1 | single | several) << 1, 1, room - sum(filling)  # sums that grow by one to ``width``
    if not waste:
        return False
    while width < waste:
        step = min(width, waste - width)
        reach |= reach << step
        width += step
    return bool(reach & spare)


def exact_fillings(counts: dict[int, int], total: int) -> Iterator[tuple[int, ...]]:
    """All multisets of the pieces that sum to ``total``, largest pieces first, lazily."""
    sizes = sorted((x for x, n in counts.items() if n and x <= total), reverse=True)
    reach = [1]  # reach[k]: sums of any number of copies of the k smallest sizes
    for x in reversed(sizes):
        sums, step = reach[-1], x
        while step <= total:
            sums |= sums << step
            step *= 2
        reach.append(sums & ((1 << (total + 1)) - 1))
    n = len(sizes)
    chosen: list[int] = []  # places in ``sizes``, not falling
    at, left = 0, total
    while True:
        if not left:
            yield tuple(sizes[k] for k in chosen)
        while at < n and (not left or sizes[at] > left or not reach[n - at] >> left & 1 or chosen[-counts[sizes[at]] :].count(at) == counts[sizes[at]]):
            at = n if not left or not reach[n - at] >> left & 1 else at + 1
        if at < n:
            chosen.append(at)
            left -= sizes[at]
        elif chosen:
            at = chosen.pop()
            left += sizes[at]
            at += 1
        else:
            return


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated fillings of ``room`` that waste at most ``waste``, fullest first; None in the place of a dominated one."""
    if counts.get(room):  # dominates all others
        yield (room,)
        return
    for lost in range(min(room, waste) + 1):
        for filling in exact_fillings(counts, room - lost):
            yield None if _dominated(filling, counts, room) else filling


def plan_packing(counts: dict[int, int], capacity: int, *, node_limit: int | None = 200) -> tuple[list[tuple[Pattern, int]], int]:
    """Patterns with multiplicities, and the lower bound they are held against."""
    counts = {k: v for k, v in counts.items() if v}
    bound, total = lower_bound(counts, capacity), sum(k * v for k, v in counts.items())
    size = lambda plan: sum(n for _, n in plan)
    best = best_fit(counts, capacity)
    least, nodes = size(best), 0
    met: dict[frozenset, int] = {}

    def children(left: dict[int, int], lost: int) -> Iterator[tuple[dict[int, int], tuple[Pattern, int], int] | tuple[()]]:
        top = max(left)
        rest = left | {top: left[top] - 1}
        for filling in fillings(rest, capacity - top, (least - 1) * capacity - total - lost):
            if filling is None:  # it counts as a node, so a limit bounds the time too
                yield ()
                continue
            need = Counter((top, *filling))
            pattern, spill = tuple(sorted(need.items(), reverse=True)), capacity - top - sum(filling)
            for times in range(min(left[x] // n for x, n in need.items()), 0, -1):
                after = {x: n - times * need.get(x, 0) for x, n in left.items()}
                yield {x: n for x, n in after.items() if n}, (pattern, times), lost + times * spill

    stack = [(children(counts, 0), [], 0)] if least > bound else []
    while stack and least > bound and (node_limit is None or nodes < node_limit):
        branch, made, used = stack[-1]
        child = next(branch, None)
        if child is None:
            stack.pop()
            continue
        nodes += 1
        if not child:
            continue
        left, step, lost = child
        sequences = used + step[1]
        if lost > (least - 1) * capacity - total or sequences + lower_bound(left, capacity) >= least:
            continue
        key = frozenset(left.items())
        if met.get(key, least) <= sequences:
            continue
        met[key] = sequences
        candidate = [*made, step, *best_fit(left, capacity)]
        if size(candidate) < least:
            best, least = candidate, size(candidate)
        if left:
            stack.append((children(left, lost), [*made, step], sequences))
    return best, bound


def slot_runs(plan: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """length: rows of (first rank, copies, first sequence, offset), ordered by rank."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: Counter[int] = Counter()
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length, copies in pattern:
            runs.setdefault(length, []).append((rank[length], copies, sequence, offset))
            rank[length] += copies * times
            offset += copies * length
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in runs.items()}


def cut_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece, with its rank among equal lengths of its partition."""
    shared.bound_batches(docs.sparkSession, bpe.ROWS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, end = TaskContext.get().partitionId(), Counter(), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, coded in zip(batch.column(0).to_pylist(), bpe.encoder(tokenizer_path).encode_batch(batch.column(1).to_pylist()), strict=True):
                ids = coded + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    out.append((part, doc_id, piece, at // 4, length, zlib.crc32(own), seen[length]))
                    seen[length] += 1
            names = ("part", "doc_id", "piece", "start", "length", "ids_crc32", "nth")
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        shared.trim()

    return rows.mapInArrow(cut, PIECES)


def place_pieces(pieces: DataFrame, capacity: int, *, node_limit: int | None = 200) -> DataFrame:
    """Adds sequence_id and offset; ``pieces`` is read more than once, so give a written table."""
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    plan, _ = plan_packing(counts, capacity, node_limit=node_limit)
    runs = slot_runs(plan)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        F.col("length").alias("o_length"), F.col("part").alias("o_part"), F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base")
    )
    ranked = pieces.join(offsets, (F.col("length") == F.col("o_length")) & (F.col("part") == F.col("o_part"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for own in np.unique(length):
                rows, table = np.flatnonzero(length == own), runs[int(own)]
                run = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                nth, copy = np.divmod(rank[rows] - run[:, 0], run[:, 1])
                sequence[rows], offset[rows] = run[:, 2] + nth, run[:, 3] + copy * own
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 0, node_limit: int | None = 200) -> DataFrame:
    """The operator: every document's pieces with their sequence and place."""
    pieces = shared.materialize(cut_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id), "packing-pieces")
    return place_pieces(pieces, capacity, node_limit=node_limit)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sequences of at most 2048 tokens."""
    return packing_stage(spark, spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), sf_dir)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of the documents it is given.

    A null or empty text is one piece of the end id; every row is packed, repeated
    ones too; a null id stays null; an empty table gives no rows.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
