"""Exact removal of repeated strings by prefix-free parsing and suffix arrays.

A string is a run of symbols: the bytes of a text, or its words (by a 64-bit
hash each).  A window is ``length`` symbols.

Parse of the corpus.  A window's trigger is the gram with the least rolling hash
inside it (the leftmost of equals), so equal windows have the same trigger at
the same place.  A maximal run of windows with one trigger is a phrase; phrases
overlap by all but one symbol of a window, so a window lies inside exactly one
phrase of each place it occurs at.  The parse is a table of (document, phrase)
with phrases named by a 128-bit hash; equal ones collapse to a count.  A trigger
seen once repeats nothing; one whose phrases are all equal repeats all of its
windows.  Neither needs any text.

Corpus order.  The distinct phrases of every other trigger meet in shards of
whole triggers (``repeated_windows``).  There, rolling-hash triggers cut the
phrases into short ones; the suffix array of the dictionary (one copy of each
short phrase) and the suffix array of the parse (the sequence of their ranks)
combine into the order of all windows: first by the rest of the short phrase a
window starts in, then by the place of what follows in the parse.  Neighbours
that agree on ``length`` symbols, by the parse's common prefixes and range
minima over them, are one class, and a class repeats if its phrases' counts in
the corpus parse sum to two or more.  Strings that many phrases share are sorted
once, in the dictionary.

A trigger with more than ``shard_phrases`` distinct phrases is parsed again with
finer triggers (``_finer``): the windows that lie alike around the trigger, a
block at a time, take the string they all hold as their trigger.  The same steps
then apply, down to blocks of one window, so no group has to fit one task.

Edge cases: a null text counts as empty; a text shorter than a window loses
nothing; rows that repeat both id and text are separate occurrences and get
equal results; equal ids with different texts are kept apart; a null id is
allowed; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared
from .jaccard import word_hashes

LENGTH = 400  # bytes
PASSAGE_WORDS = 51  # words: passages of over fifty
GRAM = {"bytes": 64, "words": 8}  # symbols of a corpus trigger
CUT = {"bytes": (8, 32), "words": (2, 8)}  # symbols of a trigger inside a shard, and one in how many is one
STRIDE = {"bytes": 1, "words": 8}  # bytes of a symbol
CHUNK = 1 << 16  # symbols hashed at once: their hashes fit a core's cache
POSITION_BITS = 24
SHARD_PHRASES = 4096
SHARD_BYTES = 1 << 18  # phrase bytes put in order at once, of whole triggers; their ranks fit a core's cache too
PART_BYTES = 1 << 20  # phrase bytes handed on at once
BLOCK = 32  # windows of a finer phrase; an eighth of it at the next level

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = [np.uint64(int(x) | 1) for x in _RNG.integers(1, 2**63, 16, dtype=np.uint64)]
_LOW = np.uint64((1 << POSITION_BITS) - 1)


def _seeds(symbols: np.ndarray) -> np.ndarray:
    return _BYTE[symbols] if symbols.dtype == np.uint8 else symbols


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` symbols at each position; ``gram`` is a power of two."""
    out, width, level = _seeds(symbols), 1, 0
    while width < gram:
        out = out[:-width] * _STEP[level] + out[width:]
        width, level = 2 * width, level + 1
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def parse_phrases(symbols: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Phrases of the texts between ``bounds``: text, first window, last window, trigger's place, trigger's hash."""
    empty = np.empty(0, dtype=np.int64)
    sizes = np.diff(bounds)
    if len(symbols) < length or not (sizes >= length).any():
        return empty, empty, empty, empty, empty.astype(np.uint64)
    hashes = gram_hashes(symbols, gram)
    marked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    least = (sliding_min(marked, length - gram + 1) & _LOW).astype(np.int64)
    document = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    start = np.arange(len(least))
    valid = start + length <= bounds[document + 1]
    start, least, document = start[valid], least[valid], document[valid]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (document[1:] != document[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return document[first], start[first], start[last], least[first], hashes[least[first]]


def _word_pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``CHUNK`` bytes that end between words."""
    at = 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data) and data[to] not in b" \t\n\x0b\x0c\r":
            to += 1
        yield data[at:to]
        at = to


def symbols_of(data: bytes, unit: str) -> np.ndarray:
    """The symbols of a text: its bytes, or a hash of each word."""
    if unit == "bytes":
        return np.frombuffer(data, dtype=np.uint8)
    parts = [word_hashes(np.frombuffer(p, dtype=np.uint8), np.array([0, len(p)]), fold=False)[0] for p in _word_pieces(data)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def symbols_of_all(texts: Iterable[bytes], unit: str) -> Iterator[np.ndarray]:
    """The symbols of each text; words of short texts are hashed together."""
    held: list[bytes] = []
    weight = 0

    def hashed() -> Iterator[np.ndarray]:
        words, before = word_hashes(np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum([0, *map(len, held)]), fold=False)
        yield from (words[a:b] for a, b in zip(before[:-1], before[1:], strict=True))

    for data in texts:
        if unit == "bytes" or len(data) > CHUNK:
            if held:
                yield from hashed()
                held, weight = [], 0
            yield symbols_of(data, unit)
            continue
        if held and weight + len(data) > CHUNK:
            yield from hashed()
            held, weight = [], 0
        held.append(data)
        weight += len(data)
    if held:
        yield from hashed()


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last."""
    starts, ends, at = [], [], 0
    for piece in _word_pieces(data):
        solid = ~np.isin(np.frombuffer(piece, dtype=np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
        edge = np.diff(np.concatenate(([0], solid.astype(np.int8), [0])))
        starts.append(np.flatnonzero(edge == 1) + at)
        ends.append(np.flatnonzero(edge == -1) + at)
        at += len(piece)
    return (np.concatenate(starts), np.concatenate(ends)) if starts else (np.empty(0, dtype=np.int64),) * 2


def _segments(texts: pa.Array, length: int, unit: str) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Batches of ((row, offset), joined symbols, bounds); a long text comes in overlapping segments."""
    names: list[tuple[int, int]] = []
    parts: list[np.ndarray] = []
    weight = 0
    for row, own in enumerate(symbols_of_all(((text.as_py() or "").encode() for text in texts), unit)):
        for at in range(0, len(own) - length + 1, CHUNK):
            part = own[at : at + CHUNK + length - 1]
            names.append((row, at))
            parts.append(part)
            weight += len(part)
            if weight >= CHUNK:
                yield names, np.concatenate(parts), np.cumsum([0, *map(len, parts)])
                names, parts, weight = [], [], 0
    if names:
        yield names, np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def _phrase_table(docs: DataFrame, length: int, unit: str) -> DataFrame:
    """doc_id, mark, first and last window, trigger's distance from the first, trigger, and the phrase's two name halves."""
    names = ("doc_id", "mark", "s", "e", "anchor", "trig", "p1", "p2")
    stride = STRIDE[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            for segment, joined, bounds in _segments(batch.column(2), length, unit):
                doc, s, e, at, trig = parse_phrases(joined, bounds, length, GRAM[unit])
                raw = joined.tobytes()
                named = np.frombuffer(
                    b"".join(digest(raw[a:b]) for a, b in zip((s * stride).tolist(), ((e + length) * stride).tolist(), strict=True)), dtype=np.int64
                ).reshape(-1, 2)
                row = np.array([r for r, _ in segment])[doc]
                shift = (np.array([a for _, a in segment]) - bounds[:-1])[doc]
                cols = (ids.take(pa.array(row)), marks[row], s + shift, e + shift, at - s, trig.astype(np.int64), named[:, 0], named[:, 1])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)

    return docs.mapInArrow(run, "doc_id long, mark long, s long, e long, anchor long, trig long, p1 long, p2 long")


def suffix_ranks(code: np.ndarray, stop: np.ndarray, depth: int, have: int) -> np.ndarray:
    """Place of each suffix in the order of suffixes that end at ``stop``, to ``depth`` symbols; equal ones share a place.

    ``code`` orders by the first ``have`` symbols.  Prefix doubling on those
    that are not yet alone; a suffix that ends sorts before one that goes on.
    """
    n = len(code)
    order = np.argsort(code, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = code[order][1:] != code[order][:-1]
    head = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    shared_by = np.repeat(np.diff(np.append(head, n)), np.diff(np.append(head, n)))
    act = order[shared_by > 1]
    while len(act) and have < depth:
        act = act[stop[act] - act >= have]
        step = min(have, depth - have)
        after = act + step
        follow = np.where(after < stop[act], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort((rank[act] << 32) | follow, kind="stable")
        act, follow = act[by], follow[by]
        if not len(act):
            break
        group = rank[act]
        fresh = np.ones(len(act), dtype=bool)
        fresh[1:] = group[1:] != group[:-1]
        new = fresh.copy()
        new[1:] |= follow[1:] != follow[:-1]
        place = np.arange(len(act))
        base = np.maximum.accumulate(np.where(fresh, place, 0))
        run = np.maximum.accumulate(np.where(new, place, 0))
        rank[act] = group + run - base
        sizes = np.bincount(run, minlength=len(act))
        act = act[sizes[run] > 1]
        have += step
    return rank


def _first_codes(symbols: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, int]:
    """Keys that order suffixes by their first symbols, and by how many."""
    if symbols.dtype != np.uint8:
        return np.unique(symbols, return_inverse=True)[1].astype(np.uint64) + np.uint64(1), 1
    n = len(symbols)
    wide = np.concatenate((symbols.astype(np.uint64) + np.uint64(1), np.zeros(7, dtype=np.uint64)))
    code = np.zeros(n, dtype=np.uint64)
    for k in range(7):  # seven symbols of nine bits
        code = (code << np.uint64(9)) | wide[k : k + n]
    over = np.uint64(9) * (7 - np.minimum(stop - np.arange(n), 7)).astype(np.uint64)
    return (code >> over) << over, 7


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Symbols that the strings at ``a`` and ``b`` have in common, at most ``most``."""
    out = np.zeros(len(a), dtype=np.int64)
    steps = [1]
    if symbols.dtype == np.uint8:  # eight at once, then one by one
        padded = np.concatenate((symbols, np.zeros(8, dtype=np.uint8)))
        eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(np.uint64).ravel()
        steps = [8, 1]
    for step in steps:
        source = eight if step == 8 else symbols
        last = len(source) - 1
        todo = np.arange(len(a))
        while len(todo):
            at = out[todo]
            go = (at < most[todo]) & (source[np.minimum(a[todo] + at, last)] == source[np.minimum(b[todo] + at, last)])
            todo = todo[go]
            out[todo] += step
    return np.minimum(out, most)


def _range_min(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs whose length is a power of two."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def repeated_windows(phrases: list[bytes], weights: list[int], length: int, unit: str = "bytes") -> list[np.ndarray]:
    """For each phrase, which of its windows occur twice or more in the corpus parse.

    ``weights`` are the phrases' counts there.
    """
    kind = np.uint8 if unit == "bytes" else np.uint64
    text = np.frombuffer(b"".join(phrases), dtype=kind)
    bounds = np.cumsum([0, *(len(p) // STRIDE[unit] for p in phrases)])
    n, sizes = len(text), np.diff(bounds)
    owner = np.repeat(np.arange(len(phrases)), sizes)
    end = bounds[owner + 1]

    # short phrases: from each cut to the end of the next cut's gram, or to the end of the phrase
    gram, one_in = CUT[unit]
    place = np.arange(n)
    cut = np.zeros(n, dtype=bool)
    if n >= gram:
        cut[: n - gram + 1] = gram_hashes(text, gram) % np.uint64(one_in) == 0
    cut &= place + gram <= end
    cut[bounds[:-1][sizes > 0]] = True
    begin = np.flatnonzero(cut)
    follows = np.append(begin[1:], n)
    last = follows >= end[begin]  # the last short phrase of its phrase
    until = np.where(last, end[begin], np.minimum(follows + gram, end[begin]))
    raw, stride = text.tobytes(), STRIDE[unit]
    known: dict[bytes, int] = {}
    short = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip((begin * stride).tolist(), (until * stride).tolist(), strict=True)])

    # suffix array of the dictionary
    entries = np.frombuffer(b"".join(known), dtype=kind)
    entry = np.cumsum([0, *(len(k) // stride for k in known)])
    stop = np.repeat(entry[1:], np.diff(entry))
    code, have = _first_codes(entries, stop)
    rank = suffix_ranks(code, stop, length, have)

    # suffix array of the parse, with the common prefixes of its neighbours
    parse_stop = np.searchsorted(begin, end[begin], side="left")
    parse = suffix_ranks(rank[entry[short]], parse_stop, length, 1)
    sorted_parse = np.argsort(parse, kind="stable")
    a, b = begin[sorted_parse[:-1]], begin[sorted_parse[1:]]
    prefix = _common(text, a, b, np.minimum(length, np.minimum(end[a] - a, end[b] - b)))
    minima = _range_min(prefix)

    # all windows in corpus order
    at = np.flatnonzero(place + length <= end)
    of = np.searchsorted(begin, at, side="right") - 1
    rest = until[of] - at  # symbols up to the end of the short phrase
    first = rank[entry[short[of]] + at - begin[of]]
    weight = np.asarray(weights, dtype=np.int64)[owner[at]]
    twice = np.bincount(first, weights=weight, minlength=len(rank))[first] >= 2
    at, of, rest, first, weight = at[twice], of[twice], rest[twice], first[twice], weight[twice]
    found = np.zeros(n, dtype=bool)
    if len(at):
        whole = rest >= length
        then = np.where(whole, 0, parse[np.minimum(of + 1, len(parse) - 1)])
        order = np.argsort((first << 32) | then, kind="stable")
        at, rest, first, then, weight, whole = (x[order] for x in (at, rest, first, then, weight, whole))
        same = first[1:] == first[:-1]
        lo, hi = then[:-1], then[1:]
        open_ = same & ~whole[1:] & (lo < hi)
        reach = np.full(len(same), length)
        if open_.any():
            lo, hi = lo[open_], hi[open_]
            level = np.int64(np.floor(np.log2(hi - lo)))
            least = np.empty(len(lo), dtype=np.int64)
            for k in np.unique(level):
                rows = level == k
                least[rows] = np.minimum(minima[k][lo[rows]], minima[k][hi[rows] - (1 << int(k))])
            reach[open_] = rest[1:][open_] - gram + least
        group = np.concatenate(([0], np.cumsum(~(same & (reach >= length)))))
        total = np.bincount(group, weights=weight)
        found[at[total[group] >= 2]] = True
    return [found[x : y - length + 1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def runs_of(flags: np.ndarray) -> list[dict]:
    """Maximal runs of true flags as {lo, hi}, both inclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"lo": int(a), "hi": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RUNS = "trig long, p1 long, p2 long, runs array<struct<lo:long,hi:long>>"
PHRASES = "trig long, p1 long, p2 long, n long, anchor long, bytes binary"


def _sorted_shards(dictionary: DataFrame, length: int, unit: str, parts: int) -> DataFrame:
    """Runs of repeated windows of each phrase; shards of whole triggers are put in order in turn, in ``parts`` tasks."""
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeated_windows([r[4] for r in rows], [r[3] for r in rows], length, unit) if rows else []
        out = [(*r[:3], runs_of(f)) for r, f in zip(rows, flags, strict=True) if f.any()]
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), kind)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["trig", "p1", "p2", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and weight >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, weight = [], 0
                held.append(row)
                weight += len(row[4])
        yield solve(held)
        shared.trim()

    dealt = dictionary.repartition(parts, "trig").sortWithinPartitions("trig")
    return dealt.select("trig", "p1", "p2", "n", "bytes").mapInArrow(run, RUNS)


def _pieces(phrases: DataFrame, length: int, unit: str, block: int) -> DataFrame:
    """Finer phrases: the windows of each phrase by blocks of their distance to the trigger.

    All windows of a block hold one string; with its place it is the trigger of
    the finer phrase.
    """
    names = ("trig", "p1", "p2", "n", "lo", "anchor", "count", "finer", "q1", "q2")
    stride = STRIDE[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for trig, p1, p2, n, anchor, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                windows = len(data) // stride - length + 1
                for b in range((anchor - windows + 1) // block, anchor // block + 1):
                    lo, hi = max(0, anchor - (b + 1) * block + 1), min(windows - 1, anchor - b * block)
                    if lo > hi:
                        continue
                    core = data[(anchor - b * block) * stride : max(0, anchor - (b + 1) * block + 1 + length) * stride]
                    held = trig.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True) + core
                    finer = xxhash.xxh3_64_intdigest(held)
                    name = xxhash.xxh3_128_digest(data[lo * stride : (hi + length) * stride])
                    out.append((trig, p1, p2, n, lo, anchor - lo, hi - lo + 1, finer - (finer >> 63 << 64), *np.frombuffer(name, dtype=np.int64).tolist()))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return phrases.select("trig", "p1", "p2", "n", "anchor", "bytes").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _finer(phrases: DataFrame, length: int, unit: str, shard_phrases: int, block: int) -> DataFrame:
    """Runs of repeated windows for the phrases of frequent triggers, by a parse with finer triggers."""
    stride = STRIDE[unit]
    pieces = shared.materialize(_pieces(phrases, length, unit, block), "suffix-pieces")
    triggers = _repeating(pieces, "finer", ("q1", "q2"), F.sum("n"))
    known = shared.materialize(pieces.join(triggers, "finer"), "suffix-finer")
    mixed = known.where("mixed").groupBy("finer", "q1", "q2").agg(F.sum("n").alias("total"), F.min(F.struct("trig", "p1", "p2", "lo", "anchor", "count")).alias("at"))
    held = mixed.select("finer", "q1", "q2", "total", "at.*").join(phrases.select("trig", "p1", "p2", "bytes"), ["trig", "p1", "p2"])
    cut = F.expr(f"substring(bytes, cast(lo * {stride} + 1 as int), cast((count + {length - 1}) * {stride} as int))")
    dictionary = held.select(F.col("finer").alias("trig"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.col("total").alias("n"), "anchor", cut.alias("bytes"))
    found = _settled(shared.materialize(dictionary, "suffix-dictionary"), length, unit, shard_phrases, max(1, block // 8))
    found = found.select(F.col("trig").alias("finer"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), "runs")
    whole = known.where("not mixed").select("trig", "p1", "p2", F.col("lo"), (F.col("lo") + F.col("count") - 1).alias("hi"))
    part = known.where("mixed").join(found, ["finer", "q1", "q2"]).select("trig", "p1", "p2", "lo", F.explode("runs").alias("r"))
    part = part.select("trig", "p1", "p2", (F.col("lo") + F.col("r.lo")).alias("lo"), (F.col("lo") + F.col("r.hi")).alias("hi"))
    return whole.unionAll(part).groupBy("trig", "p1", "p2").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def _settled(dictionary: DataFrame, length: int, unit: str, shard_phrases: int, block: int) -> DataFrame:
    """``RUNS`` of the phrases of all mixed triggers; ``dictionary`` is a written table of ``PHRASES``."""
    sizes = shared.materialize(dictionary.groupBy("trig").agg(F.count("*").alias("size")).where(F.col("size") > shard_phrases).select("trig"), "suffix-frequent")
    parts = shared.shuffle_parts(dictionary)
    if sizes.isEmpty():
        return _sorted_shards(dictionary, length, unit, parts)
    frequent = shared.materialize(dictionary.join(sizes, "trig", "left_semi"), "suffix-frequent-phrases")
    rare = dictionary.join(sizes, "trig", "left_anti")
    return _sorted_shards(rare, length, unit, parts).unionAll(_finer(frequent, length, unit, shard_phrases, block))


def _repeating(phrases: DataFrame, trigger: str, names: tuple[str, str], seen) -> DataFrame:
    """The triggers seen twice or more, and whether their phrases differ; a written table."""
    ends = [f(p).alias(f"{f.__name__}_{p}") for p in names for f in (F.min, F.max)]
    p, q = names
    rows = phrases.groupBy(trigger).agg(seen.alias("seen"), *ends).where("seen >= 2")
    rows = rows.selectExpr(trigger, f"min_{p} <> max_{p} or min_{q} <> max_{q} as mixed")
    return shared.materialize(rows, "suffix-triggers")  # a side of its own lets adaptive execution split a frequent trigger


def _dictionary(docs: DataFrame, chosen: DataFrame, length: int, unit: str) -> DataFrame:
    """The symbols of one occurrence of each wanted phrase."""
    per_doc = chosen.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("trig", "p1", "p2", "n", "s", "e", "anchor")).alias("wanted"))
    texts = docs.alias("d").join(
        per_doc.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & F.col("d.mark").eqNullSafe(F.col("w.mark"))
    )
    stride = STRIDE[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            trig, p1, p2, n, s, e, anchor = wanted.flatten().flatten()
            first, until = (s.to_numpy() * stride).tolist(), ((e.to_numpy() + length) * stride).tolist()
            held, weight, done, row = [], 0, 0, 0
            texts = (text.as_py().encode() for text in batch.column(0))
            for own, count in zip(symbols_of_all(texts, unit), wanted.value_lengths().to_pylist(), strict=True):
                data = own.tobytes()
                held += [data[a:b] for a, b in zip(first[row : row + count], until[row : row + count], strict=True)]
                weight += sum(map(len, held[len(held) - count :]))
                row += count
                if weight >= PART_BYTES or row == len(first):
                    cols = [c.slice(done, row - done) for c in (trig, p1, p2, n, anchor)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(held, pa.binary())], ["trig", "p1", "p2", "n", "anchor", "bytes"])
                    held, weight, done = [], 0, row

    made = texts.select("d.text", "w.wanted").mapInArrow(run, PHRASES)
    return made.dropDuplicates(["trig", "p1", "p2"])  # rows that repeat id and text give a phrase twice


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, unit: str = "bytes", shard_phrases: int = SHARD_PHRASES, block: int = BLOCK) -> DataFrame:
    """doc_id, mark, spans: symbol intervals [a, b) that repeat, for the documents that have any; they may overlap.

    ``docs`` has doc_id, mark (a hash of the text) and text.
    """
    spark = docs.sparkSession
    phrases = shared.materialize(_phrase_table(docs.select("doc_id", "mark", "text"), length, unit), "suffix-phrases")
    triggers = _repeating(phrases, "trig", ("p1", "p2"), F.count("*"))
    known = shared.materialize(phrases.join(triggers, "trig"), "suffix-repeated")
    shared.drop_files(phrases)
    shared.release(spark)

    mixed = known.where("mixed").groupBy("trig", "p1", "p2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "s", "e", "anchor")).alias("at"))
    dictionary = shared.materialize(_dictionary(docs, mixed.select("trig", "p1", "p2", "n", "at.*"), length, unit), "suffix-dictionary")
    shared.release(spark)
    found = shared.materialize(_settled(dictionary, length, unit, shard_phrases, block), "suffix-runs")
    shared.drop_files(dictionary)

    whole = known.where("not mixed").select("doc_id", "mark", F.col("s").alias("a"), (F.col("e") + length).alias("b"))
    part = (
        known.where("mixed")
        .join(found, ["trig", "p1", "p2"])
        .select("doc_id", "mark", "s", F.explode("runs").alias("r"))
        .select("doc_id", "mark", (F.col("s") + F.col("r.lo")).alias("a"), (F.col("s") + F.col("r.hi") + length).alias("b"))
    )
    spans = whole.unionAll(part).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    spans = shared.materialize(spans, "suffix-spans")
    shared.drop_files(known)
    shared.drop_files(found)
    shared.release(spark)
    return spans


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted, disjoint and not touching."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, unit: str = "bytes", passage_words: int | None = None, with_text: bool = False, **options) -> DataFrame:
    """The operator: doc_id, mark, n_bytes, n_removed (bytes), n_spans, kept_sha256, and the kept text on demand.

    ``unit`` says what ``length`` counts.  Every occurrence goes, the first too.
    The kept text drops a character of which some bytes are removed.  With
    ``passage_words``, n_passages and n_passage_words tell besides how many runs
    of words, and how many words in them, lie in strings of that many words that
    occur elsewhere too; they don't change what is removed.
    """
    spark = docs.sparkSession
    shared.bound_batches(spark)
    rows = _keyed(docs, id_col, text_col)
    spans = repeated_spans(rows, length=length, unit=unit, **options)
    if passage_words:
        passages = repeated_spans(rows, length=passage_words, unit="words", **options).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("spans").alias("passages"))
        both = spans.join(passages, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "full")
        spans = both.select(F.coalesce("doc_id", "_id").alias("doc_id"), F.coalesce("mark", "_mark").alias("mark"), "spans", "passages")
    else:
        spans = spans.withColumn("passages", F.lit(None).cast("array<struct<a:long,b:long>>"))
    joined = rows.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("d.mark").eqNullSafe(F.col("s.mark")), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "mark", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "n_passages", "n_passage_words")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            out = []
            for doc_id, mark, text, found, passages in zip(*(batch.column(k) for k in range(5)), strict=True):
                data, at, parts, gone = text.as_py().encode(), 0, [], 0
                merged = merge_spans(found.as_py() or [])
                if merged and unit == "words":
                    starts, ends = word_places(data)
                    merged = [(int(starts[a]), int(ends[b - 1])) for a, b in merged]
                for a, b in merged:
                    parts.append(data[at:a])
                    gone, at = gone + b - a, b
                parts.append(data[at:])
                kept = b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode() if with_text else None
                sha = hashlib.sha256(b"".join(parts)).hexdigest()
                said = merge_spans(passages.as_py() or [])
                out.append((doc_id.as_py(), mark.as_py(), len(data), gone, len(merged), sha, kept, len(said), sum(b - a for a, b in said)))
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return joined.select("d.doc_id", "d.mark", "d.text", "s.spans", "s.passages").mapInArrow(
        run, "doc_id long, mark long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, n_passages long, n_passage_words long"
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: bytes of 400-byte strings that start twice or more anywhere.

    Besides, the runs of words that lie in strings of ``PASSAGE_WORDS`` words
    found twice or more: passages too short for the contract's length.
    """
    done = remove_repeats(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), passage_words=PASSAGE_WORDS)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_words")


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without passages of over fifty words that occur twice or more, in one document or several.

    Every occurrence goes, the first too; what stands between words stays, and
    n_chars follows the text.  A document that loses all its words goes; one
    that had none stays.  A null text stays null.
    """
    done = remove_repeats(docs, length=PASSAGE_WORDS, unit="words", with_text=True)
    changed = done.where("n_removed > 0").select("doc_id", "mark", "kept_text")
    return shared.with_new_texts(docs, changed, lambda text: F.xxhash64(F.coalesce(text, F.lit(""))))


QUERIES = {"op6_suffix_dedup": op6_suffix_dedup}
ORACLE_SQL: dict[str, str] = {}
