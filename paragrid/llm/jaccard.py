"""Exact Jaccard self-join of word shingles, resolved to components.

1. Documents with equal shingle sets collapse to one class.
2. A count sketch over all documents ranks shingles; of each set only its
   rarest ``n - ceil(0.8 n) + 1`` can be the first in common with a partner, so
   only these are dealt out.  Any fixed ranking gives exact results; the sketch
   only keeps frequent shingles out.
3. Shingles that two classes of like size share are found by a pre-aggregated
   minimum and maximum.  Their members are first held against these two pivots,
   by bitmap and then by whole sets, which joins large groups of copies in
   linear work.
4. Shingles whose members still lie in several components go to signature
   trees: nodes hold OR-combined bitmaps and size ranges, and a dual traversal
   drops node pairs whose largest possible overlap is too small or that already
   are one component.  What survives is verified on the whole sets.

No step caps partners or candidates.  A shingle with more unresolved members
than ``block`` is traversed in pairs of blocks.

Edge cases: a text with one to four words has its whole sequence as one shingle;
a null text or one without words has no shingle and is its own component; a null
doc_id takes part and can be no component id unless alone; repeated rows share a
class; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared
from .components import connected_components

WIDTH, PERCENT = 5, 80
SKETCH_BITS = 20
SLOTS = 32  # rows that carry a task's sketch
BLOCK = 1024
LEAST = 16  # of a class's open shingles, so many tell which one answers for a pair
TAKEN_NAMES = 100_000  # at most so many halves of names go to all tasks
CHUNK = 1 << 18  # bytes hashed at once

_RNG = np.random.default_rng(20240501)
_PLAIN = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _PLAIN.copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base, extended as longer words come."""

    def __init__(self):
        self.table = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.table):
            grown = np.full(max(n, 2 * len(self.table)), _BASE, dtype=np.uint64)
            grown[0] = 1
            self.table = np.multiply.accumulate(grown)
        return self.table


_POWERS = _Powers()


def word_hashes(data: np.ndarray, bounds: np.ndarray, *, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each document, the number of words before it; ``fold`` takes A-Z as a-z."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edge = bounds[:-1][bounds[:-1] < n]
    begins[edge] = solid[edge]
    starts = np.flatnonzero(begins)
    before = np.searchsorted(starts, bounds, side="left")
    if not len(starts):
        return np.empty(0, dtype=np.uint64), before
    lengths = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, lengths)
    values = np.where(solid[starts[0] :], (_BYTE if fold else _PLAIN)[data[starts[0] :]], np.uint64(0))
    values *= _POWERS.upto(int(lengths.max()))[place]
    return _mix(np.add.reduceat(values, starts - starts[0])), before


def _combine(words: np.ndarray, width: int) -> np.ndarray:
    out = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k]
    return _mix(out + np.uint64(width))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a null text has none."""
    held: list[bytes] = []
    weight = 0

    def flush() -> Iterator[np.ndarray]:
        bounds = np.cumsum([0, *map(len, held)])
        words, before = word_hashes(np.frombuffer(b"".join(held), dtype=np.uint8), bounds)
        for a, b in zip(before[:-1], before[1:], strict=True):
            own = words[a:b]
            yield np.unique(_combine(own, min(width, len(own)))) if len(own) else own

    for text in texts:
        data = (text.as_py() or "").encode()
        if held and weight + len(data) > CHUNK:
            yield from flush()
            held, weight = [], 0
        held.append(data)
        weight += len(data)
    if held:
        yield from flush()


def set_names(shingles: np.ndarray) -> tuple[int, int] | tuple[None, None]:
    """The two signed halves of a shingle set's 128-bit name."""
    if not len(shingles):
        return None, None
    low, high = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype=np.int64).tolist()
    return low, high


def class_key(shingles: np.ndarray, taken: frozenset[int] = frozenset()) -> int | None:
    """Name of a shingle set: a half of its 128-bit name, the other one where several sets share the first."""
    low, high = set_names(shingles)
    return high if low in taken else low


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many first shingles in rank order must be looked at."""
    return n - (-(-percent * n // 100)) + 1


def signature_size(n: int, each: int = 4) -> int:
    """Bits of the signature of ``n`` shingles: a power of two, at least ``each`` for each."""
    return max(256, 1 << (each * n - 1).bit_length())


def bitmap(shingles: np.ndarray, each: int = 4) -> bytes:
    """The signature: one bit for each shingle's hash."""
    size = signature_size(len(shingles), each)
    bits = np.zeros(size, dtype=np.uint8)
    bits[(shingles >> np.uint64(20)) % np.uint64(size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: int, size: int, to: int) -> int:
    while size > to:
        size //= 2
        bits = (bits >> size) | (bits & ((1 << size) - 1))
    return bits


def _needed(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m shingles that reaches the threshold."""
    return -(-percent * (n + m) // (100 + percent))


class Node:
    """A signature-tree node over a run of members (name, component, size, bits, bit count)."""

    __slots__ = ("bits", "component", "kids", "largest", "least", "members", "width")

    def __init__(self, members: list[tuple], kids: list[Node] | None = None):
        self.members, self.kids = members, kids or []
        self.least, self.largest = min(m[2] for m in members), max(m[2] for m in members)
        self.width = min(m[4] for m in members)
        below = [(k.bits, k.width) for k in self.kids] or [(m[3], m[4]) for m in members]
        self.bits = 0
        for bits, width in below:
            self.bits |= _fold(bits, width, self.width)
        parts = {m[1] for m in members}
        self.component = parts.pop() if len(parts) == 1 else None


def build_tree(members: list[tuple], leaf: int = 8, fan: int = 4) -> Node:
    """Members sorted by size, then by lowest set bit, so that alike sets share nodes."""
    ordered = sorted(members, key=lambda m: (m[2].bit_length(), m[3] & -m[3], m[2], m[0]))
    level = [Node(ordered[i : i + leaf]) for i in range(0, len(ordered), leaf)]
    while len(level) > 1:
        level = [
            Node([m for k in level[i : i + fan] for m in k.members], level[i : i + fan]) for i in range(0, len(level), fan)
        ]
    return level[0]


def _may_reach(member: tuple, node: Node, percent: int) -> bool:
    """Whether the member's largest possible overlap with anything below ``node`` suffices."""
    n = member[2]
    if 100 * node.largest < percent * n or 100 * n < percent * node.least:
        return False
    width = min(member[4], node.width)
    missing = (_fold(member[3], member[4], width) & ~_fold(node.bits, node.width, width)).bit_count()
    return n - missing >= _needed(n, max(node.least, -(-percent * n // 100)), percent)


def _pair_fits(a: tuple, b: tuple, percent: int) -> bool:
    n, m = a[2], b[2]
    if 100 * min(n, m) < percent * max(n, m):
        return False
    width = min(a[4], b[4])
    x, y = _fold(a[3], a[4], width), _fold(b[3], b[4], width)
    need = _needed(n, m, percent)
    return n - (x & ~y).bit_count() >= need and m - (y & ~x).bit_count() >= need


def tree_pairs(x: Node, y: Node, percent: int = PERCENT) -> Iterator[tuple]:
    """Member pairs of different components that the bitmaps cannot rule out; ``x is y`` for a self-join."""
    stack = [(x, y)]
    while stack:
        p, q = stack.pop()
        if p.component is not None and p.component == q.component:
            continue
        if 100 * p.largest < percent * q.least or 100 * q.largest < percent * p.least:
            continue
        if p is not q:
            if not any(_may_reach(m, q, percent) for m in p.members) or not any(_may_reach(m, p, percent) for m in q.members):
                continue
        if not p.kids and not q.kids:
            for i, a in enumerate(p.members):
                for b in p.members[i + 1 :] if p is q else q.members:
                    if a[1] != b[1] and a[0] != b[0] and _pair_fits(a, b, percent):
                        yield a, b
        elif p is q:
            stack += [(k, o) for i, k in enumerate(p.kids) for o in p.kids[i:]]
        elif q.kids and (not p.kids or len(q.members) >= len(p.members)):
            stack += [(p, k) for k in q.kids]
        else:
            stack += [(k, q) for k in p.kids]


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, both halves of the class's name and text mark of every row, and each task's sketch as rows with a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        names = ("doc_id", "n", "cls", "other", "mark", "slot", "sketch")
        for batch in batches:
            sizes, keys, others, found = [], [], [], [np.empty(0, dtype=np.uint64)]
            for own in shingle_sets(batch.column(1), width):
                sizes.append(len(own))
                low, high = set_names(own)
                keys.append(low)
                others.append(high)
                found.append(own)
            slots = (np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
            sketch += np.bincount(slots, minlength=len(sketch)).astype(np.uint32)
            none = [None] * len(sizes)
            cols = (batch.column(0), sizes, keys, others, batch.column(2), none, none)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        rows = sketch.reshape(SLOTS, -1)
        used = [k for k in range(SLOTS) if rows[k].any()]
        none = [None] * len(used)
        cols = (none, none, none, none, none, used, [rows[k].tobytes() for k in used])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        del sketch, rows, cols
        shared.trim()

    return docs.mapInArrow(run, "doc_id long, n long, cls long, other long, mark long, slot int, sketch binary")


def _taken_names(signed: DataFrame) -> frozenset[int]:
    """First halves that several sets share: of n sets about n * n / 2**65, a few even for ten billion."""
    halves = signed.where("cls is not null").groupBy("cls").agg(F.min("other").alias("lo"), F.max("other").alias("hi"))
    found = halves.where("lo <> hi").select("cls").limit(TAKEN_NAMES + 1).collect()
    if len(found) > TAKEN_NAMES:
        raise ValueError("too many shingle sets share half of their names")
    return frozenset(r["cls"] for r in found)


def _sketch(signed: DataFrame) -> np.ndarray:
    """Sum of all tasks' sketches: a fixed number of counters, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(data.as_buffer(), dtype=np.uint32).astype(np.uint64)
                sums[slot] = sums[slot] + own if slot in sums else own
        capped = [np.minimum(v, 2**32 - 1).astype(np.uint32).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(capped, pa.binary())], ["slot", "sketch"])

    parts = signed.where("slot is not null").select("slot", "sketch").repartition(SLOTS, "slot").mapInArrow(add, "slot int, sketch binary")
    out = np.zeros((SLOTS, (1 << SKETCH_BITS) // SLOTS), dtype=np.uint32)
    for row in parts.collect():  # SLOTS rows
        out[row["slot"]] = np.frombuffer(row["sketch"], dtype=np.uint32)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, counts, width: int, percent: int, taken: frozenset[int]) -> DataFrame:
    """cls, n, bitmap and the shingles of the prefix, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        for batch in batches:
            out = []
            for own in shingle_sets(batch.column(1), width):
                if len(own):
                    order = np.argsort(table[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                    first = own[order[: prefix_length(len(own), percent)]].astype(np.int64)
                    out.append((class_key(own, taken), len(own), bitmap(own), first))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["cls", "n", "bits", "shingles"])
        shared.trim()

    return docs.mapInArrow(run, "cls long, n long, bits binary, shingles array<long>")


def _whole_sets(texts: DataFrame, width: int, taken: frozenset[int]) -> DataFrame:
    """cls and whole set; rows whose class is not the wanted one fall away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for want, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width), strict=True):
                if class_key(own, taken) == want:
                    keys.append(want)
                    sets.append(own.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "shingles"])
        shared.trim()

    return texts.mapInArrow(run, "cls long, shingles array<long>")


def _sets_of(pairs: DataFrame, rows: DataFrame, members: DataFrame, width: int, taken: frozenset[int]) -> DataFrame:
    """Whole sets of the classes in ``pairs``, each from the text of one row."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    chosen = members.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("mark").alias("rep_mark"))
    chosen = shared.materialize(chosen, "jaccard-chosen")
    texts = rows.join(chosen, F.col("doc_id") == F.col("rep")).select("cls", "text")
    unnamed = rows.where("doc_id is null").dropDuplicates(["mark"])  # classes that only rows without an id have
    texts = texts.unionAll(unnamed.join(chosen.where("rep is null"), F.col("mark") == F.col("rep_mark")).select("cls", "text"))
    sets = _whole_sets(texts, width, taken)
    repeats = members.join(chosen, ["cls"], "left_semi").where("doc_id is not null").groupBy("cls", "doc_id").count().where("count > 1")
    if not repeats.isEmpty():  # rows that repeat an id
        sets = sets.dropDuplicates(["cls"])
    sets = shared.materialize(sets, "jaccard-sets")
    shared.release(rows.sparkSession)
    return sets


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out."""
    left = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    both = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, x, m, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                one = (0, 0, n, int.from_bytes(x, "little"), 8 * len(x))
                keep.append(_pair_fits(one, (0, 0, m, int.from_bytes(y, "little"), 8 * len(y)), percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "na", "x", "nb", "y").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                joined = np.concatenate((p, q))
                joined.sort(kind="stable")
                common = int((joined[1:] == joined[:-1]).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _streamed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((token, i, j), its rows) of batches sorted by these three columns."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != at:
                if held:
                    yield at, held
                at, held = row[:3], []
            held.append(row[3:])
    if held:
        yield at, held


def _group_pairs(at: tuple, members: list[tuple[int, tuple]], percent: int) -> Iterator[tuple]:
    """Pairs of a group, or of the two blocks of a divided one, that signatures cannot rule out."""
    if at[1] != at[2]:
        x, y = ([m for s, m in members if s == side] for side in (0, 1))
        if x and y:
            yield from tree_pairs(build_tree(x), build_tree(y), percent)
    elif len(members) > 1:
        tree = build_tree([m for _, m in members]) if len(members) > 16 else Node([m for _, m in members])
        yield from tree_pairs(tree, tree, percent)


def _dealt_groups(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j")


def _tree_members(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """Of ``rows`` (token, i, j, side, cls, comp, n, bits, least), the members that have a plausible partner in their group.

    Two classes often meet in very many groups.  ``least`` holds a class's first
    open tokens: a pair that has a smaller one in common is left to that group,
    so the least of them answers for it and no pair is lost.
    """
    names = ["token", "i", "j", "side", "cls", "comp"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for at, held in _streamed_groups(batches):
            members = [(side, (cls, comp, n, int.from_bytes(bits, "little"), 8 * len(bits))) for side, cls, comp, n, bits, _ in held]
            smaller = {row[1]: {t for t in row[5] if t < at[0]} for row in held}
            hopeful = {m[0] for a, b in _group_pairs(at, members, percent) if smaller[a[0]].isdisjoint(smaller[b[0]]) for m in (a, b)}
            out += [(*at, side, m[0], m[1]) for side, m in members if m[0] in hopeful]
            if len(out) > 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        cols = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return _dealt_groups(rows, parts).mapInArrow(run, "token long, i int, j int, side int, cls long, comp long")


def _tree_links(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links (a, b) between components, verified on the whole sets of ``rows`` (token, i, j, side, cls, comp, shingles).

    Within a group a link joins its two components, whose other pairs need no
    look; so a group gives fewer links than it has members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        failed: set[tuple[int, int]] = set()
        out: list[tuple[int, int]] = []

        def arrow() -> pa.RecordBatch:
            cols = ([p[0] for p in out], [p[1] for p in out])
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

        for at, held in _streamed_groups(batches):
            sets = {cls: np.array(x, dtype=np.int64) for _, cls, _, x in held}
            signs = {cls: int.from_bytes(bitmap(x.view(np.uint64), 32), "little") for cls, x in sets.items()}
            members = [(side, (cls, comp, len(sets[cls]), signs[cls], signature_size(len(sets[cls]), 32))) for side, cls, comp, _ in held]
            root = {comp: comp for _, _, comp, _ in held}

            def top(x: int, root: dict = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for a, b in _group_pairs(at, members, percent):
                pair = (min(a[0], b[0]), max(a[0], b[0]))
                p, q = top(a[1]), top(b[1])
                if p == q or pair in failed:
                    continue
                joined = np.concatenate((sets[a[0]], sets[b[0]]))
                joined.sort(kind="stable")
                common = int((joined[1:] == joined[:-1]).sum())
                if 100 * common >= percent * (len(joined) - common):
                    root[max(p, q)] = min(p, q)
                    out.append(pair)
                else:
                    failed.add(pair)
            if len(failed) > 500_000:  # only saves repeats
                failed.clear()
            if len(out) > 8192:
                yield arrow()
        yield arrow()

    return _dealt_groups(rows, parts).mapInArrow(run, "a long, b long")


def _resolve(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """doc_id, n, cls and text mark of every row, and the component of each class that is linked to another."""
    spark = docs.sparkSession
    shared.bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))

    signed = shared.materialize(_signatures(rows, width), "jaccard-signatures")
    taken = _taken_names(signed)
    cls = F.when(F.col("cls").isin(*taken), F.col("other")).otherwise(F.col("cls")) if taken else F.col("cls")
    members = signed.where("slot is null").select("doc_id", "n", cls.alias("cls"), "mark")
    counts = spark.sparkContext.broadcast(_sketch(signed))  # 4 MB, a fixed size
    dealt = shared.materialize(_prefixes(rows, counts, width, percent, taken), "jaccard-prefixes")
    classes = shared.materialize(dealt.select("cls", "n", "bits").dropDuplicates(["cls"]), "jaccard-classes")
    tokens = dealt.select("cls", "n", F.explode("shingles").alias("token"))
    shares = tokens.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("token")
    links = shared.materialize(tokens.join(shares, "token"), "jaccard-links")
    shared.drop_files(dealt)
    shared.release(spark)

    # Partners differ in size by a factor of at most 100 / percent, so by one band at most; the base is a little wider.
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(101 / percent))).cast("int")
    banded = links.select("cls", F.explode(F.array(F.xxhash64("token", band), F.xxhash64("token", band + 1))).alias("token"))
    ends = banded.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    groups = shared.materialize(banded.join(ends, "token").select("token", "cls", "lo", "hi").distinct(), "jaccard-groups")
    shared.drop_files(links)
    shared.release(spark)

    stars = (
        groups.select(F.col("cls").alias("a"), F.explode(F.array("lo", "hi")).alias("b"))
        .where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    stars = shared.materialize(stars, "jaccard-stars")
    hopeful = shared.materialize(_plausible(stars, classes, percent), "jaccard-hopeful")
    edges = shared.materialize(_verified(hopeful, _sets_of(hopeful, rows, members, width, taken), percent), "jaccard-edges")
    shared.release(spark)
    linked = shared.materialize(connected_components(edges), "jaccard-parts")

    placed = groups.join(linked.withColumnRenamed("node", "cls"), "cls", "left").select(
        "token", "cls", F.coalesce("component", "cls").alias("comp")
    )
    placed = shared.materialize(placed, "jaccard-placed")
    open_tokens = (  # of up to three members every pair has met as a pivot pair
        placed.groupBy("token")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
        .where("lo <> hi and size > 3")
        .select("token", F.expr(f"cast(ceil(size / {block}) as int)").alias("blocks"))
    )
    split = (
        placed.join(open_tokens, "token")
        .withColumn("mine", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "token",
            F.least("mine", "other").alias("i"),
            F.greatest("mine", "other").alias("j"),
            (F.col("mine") > F.col("other")).cast("int").alias("side"),
            "cls",
            "comp",
        )
    )
    parts = shared.shuffle_parts(classes)
    first = split.groupBy("cls").agg(F.slice(F.array_sort(F.collect_set("token")), 1, LEAST).alias("least"))
    known = shared.materialize(classes.join(first, "cls"), "jaccard-open")
    armed = split.join(known, "cls").select("token", "i", "j", "side", "cls", "comp", "n", "bits", "least")
    hopeful = shared.materialize(_tree_members(armed, percent, parts), "jaccard-members")
    shared.release(spark)
    if not hopeful.isEmpty():
        whole = _sets_of(hopeful.select(F.col("cls").alias("a"), F.col("cls").alias("b")), rows, members, width, taken)
        late = shared.materialize(_tree_links(hopeful.join(whole, "cls").select("token", "i", "j", "side", "cls", "comp", "shingles"), percent, parts), "jaccard-late")
        shared.release(spark)
        linked = shared.materialize(connected_components(edges.unionAll(late)), "jaccard-all-parts")

    return members, linked.withColumnRenamed("node", "cls")


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    members, parts = _resolve(docs, **options)
    named = (
        members.where("cls is not null")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("first_id"))
        .join(parts, "cls", "left")
        .select("cls", "first_id", F.coalesce("component", "cls").alias("comp"))
    )
    named = named.join(named.groupBy("comp").agg(F.min("first_id").alias("component_id")), "comp").select("cls", "component_id")
    full = members.join(named, "cls", "left")
    return full.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the components of all documents."""
    return jaccard_components(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component, that with the least id; rows without a shingle stay.

    A row's key is its id and text mark, null-safe, so a different text with the
    id of a dropped one stays; of rows with equal keys one stays.  A row without
    an id stays only if no row of its component has one.
    """
    members, parts = _resolve(docs)
    keys = members.where("cls is not null").groupBy("doc_id", "mark", "cls").agg(F.count("*").alias("seen"))
    keys = shared.materialize(keys, "jaccard-keys")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    least = keys.groupBy("cls").agg(F.min(row).alias("first")).join(parts, "cls", "left")
    least = least.select("cls", "first", F.coalesce("component", "cls").alias("comp"))
    stays = least.join(least.groupBy("comp").agg(F.min("first").alias("stay")), "comp").select("cls", "stay.doc_id", "stay.mark")
    judged = keys.join(stays.select("cls", F.struct("doc_id", "mark").alias("stay")), "cls")
    own = F.struct("doc_id", "mark").eqNullSafe(F.col("stay"))
    judged = judged.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), own.alias("_stays"), "seen").where("not _stays or seen > 1")
    judged = shared.materialize(judged, "jaccard-judged")

    def same(found: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(found["_mark"])

    single = docs.join(judged, same(judged), "left_anti")
    twice = judged.where("_stays")
    if twice.isEmpty():
        return single
    repeated = docs.join(twice, same(twice), "left_semi").select(F.struct("*").alias("row"))  # whatever the caller's columns are called
    repeated = repeated.select("row", F.col("row.doc_id").alias("id"), F.xxhash64(F.col("row.text").cast("string")).alias("own"))
    return single.unionAll(repeated.dropDuplicates(["id", "own"]).select("row.*"))


QUERIES = {"op7_ngram_jaccard": op7_ngram_jaccard}
ORACLE_SQL: dict[str, str] = {}
