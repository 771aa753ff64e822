"""SentencePiece segmentations sampled without replacement by Gumbel top-k.

The lattice of a text is the chain of the lattices of its units (a run of blanks
with the word after it), because no piece crosses one.  Weights
are Zipf's: a piece of rank r weighs ``1 / (r + 3)``; a character that is no
piece falls back to its bytes.  The search is A* over sets of segmentations: the
root set's best member is an ordinary sample with a Gumbel value.  What leaves a
sample is a set whose bound is a Gumbel value of its mass, truncated at the
sample's; the set with the largest bound is opened next, its best member leaves
at a place drawn by mass, and the set keeps the rest under a bound truncated
again.  So samples come distinct and in the order of their perturbed
log-probabilities.  With kappa the first value not returned,
a sample of probability p is included with probability 1 - exp(-p e^-kappa).

All random numbers are hashes of (seed, row key, place), so a row's samples do
not depend on partitions, batches or retries.

Edge cases: a null text counts as empty and has the one segmentation of the
dummy prefix; a text with fewer than ``k`` segmentations returns them all, each
with inclusion 1; equal rows get equal samples; a null key is a key of its own; long
words need no enumeration, only one state for each character; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import gc
import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

BLANK = 0x2581  # fixed value: the model's mark for a blank
UNITS = re.compile(r" *[^ ]+| +")
ROWS, CHARACTERS = 1024, 4_000_000  # rows of an Arrow batch, and characters whose words share one lattice
UNITS_AT_ONCE, WALKS_AT_ONCE = 8192, 16384  # built and walked together, so that arrays stay small
SAMPLES = "doc_id long, sample int, n_tokens long, ids_crc32 long, log_prob double, perturbed double, inclusion double, round_trip boolean"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hash inputs."""
    x = _mix(x)
    x *= _B
    x += _A
    x = _mix(x)
    x >>= np.uint64(11)
    u = x.astype(np.float64)
    u += 0.5
    u *= 2.0**-53
    return u


_PLACES = (_A, np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_BELOW_1 = np.nextafter(1.0, 0.0)  # the largest sum rounds to 1


def uniform(seed: np.ndarray, *places) -> np.ndarray:
    """Numbers in (0, 1) from a seed and up to three places."""
    with np.errstate(over="ignore"):
        x = np.asarray(seed, dtype=np.uint64).copy()
        for place, odd in zip(places, _PLACES, strict=False):
            x = x + np.asarray(place, dtype=np.uint64) * odd
        return np.minimum(_unit(np.atleast_1d(x)), _BELOW_1).reshape(x.shape)


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


class PieceModel:
    """Pieces of a SentencePiece file as a trie in arrays.

    A node's children are found from its base, a number of its own: the child by a
    character of class c is at base + c, if ``parents`` holds the base there.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.library.vocab_size()
        kinds = [(i, self.library.id_to_piece(i)) for i in range(count)]
        special = {i for i, _ in kinds if self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i)}
        self.byte_ids = np.zeros(256, dtype=np.int64)
        raw: list[bytes] = [b""] * count
        for i, piece in kinds:
            if self.library.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value], raw[i] = i, bytes([value])
            elif i not in special:
                raw[i] = piece.replace("▁", " ").encode()
        self.spelled = pa.array(raw, pa.binary())
        pieces = {p: i for i, p in kinds if i not in special}
        self.longest = max(map(len, pieces))
        self.weights = np.zeros(count)
        self.weights[list(pieces.values())] = -np.log(np.arange(len(pieces)) + 3.0)
        self.byte_weight = -np.log(len(pieces) + 3.0)
        self._plant(pieces)

    def _plant(self, pieces: dict[str, int]) -> None:
        classes = {c: n for n, (c, _) in enumerate(Counter("".join(pieces)).most_common(), 1)}  # 0: in no piece
        self.classes = np.zeros(sys.maxunicode + 1, dtype=np.int64)
        self.classes[list(map(ord, classes))] = list(classes.values())
        self.classes[0x20], self.classes[BLANK] = self.classes[BLANK], 0  # a text's own mark is no blank
        children: dict[str, list[str]] = {}
        for node in {p[:n] for p in pieces for n in range(1, len(p) + 1)}:
            children.setdefault(node[:-1], []).append(node)
        bases, used, taken, low = {}, set(), bytearray(), 0
        for node in sorted(children, key=lambda x: (x != "", -len(children[x]), x)):  # the root's base is 0
            own = sorted(classes[x[-1]] for x in children[node])
            at, tries = max(low, own[0]) if node else own[0], 0
            while True:
                at = free if (free := taken.find(0, at)) >= 0 else max(at, len(taken))
                base = at - own[0]
                taken.extend(bytes(max(base + own[-1] + 1 - len(taken), 0)))
                if base not in used and not any(taken[base + c] for c in own):
                    break
                at, tries = at + 1, tries + 1
            if tries > 16 and node:
                low = max(low, at)  # crowded below
            bases[node] = base
            used.add(base)
            for c in own:
                taken[base + c] = 1
        none = len(taken)  # base of nodes without children
        self.parents = np.full(none + len(classes) + 1, -1, dtype=np.int64)
        self.bases, self.ends = np.full(none, none, dtype=np.int64), np.full(none, -1, dtype=np.int64)
        for node, below in children.items():
            for x in below:
                at = bases[node] + classes[x[-1]]
                self.parents[at], self.bases[at], self.ends[at] = bases[node], bases.get(x, none), pieces.get(x, -1)

    def spell(self, ids: np.ndarray) -> bytes:
        """UTF-8 of token ids with the dummy prefix."""
        _, ends, letters = self.spelled.take(pa.array(ids)).buffers()
        return letters[: int(np.frombuffer(ends, dtype=np.int32)[len(ids)])].to_pybytes() if letters else b""

    def decode(self, ids: list[int]) -> str:
        """The text of token ids, without the dummy prefix."""
        return self.spell(np.asarray(ids, dtype=np.int64)).decode("utf-8", "replace")[1:]

    def encode(self, text: str) -> list[int]:
        """The library's own segmentation."""
        return self.library.encode(text)


@dataclass
class Lattice:
    """Arcs of all units, sorted by state; a state is a character place, one more at each unit's end."""

    start: np.ndarray  # first state of each unit
    last: np.ndarray  # final state of each unit
    first_arc: np.ndarray  # by state; states without arcs are final, so the first arc behind them marks a unit's end
    source: np.ndarray
    go: np.ndarray  # first arc of the state that the arc leads to
    log_p: np.ndarray  # given the state
    through: np.ndarray  # the state's probability through the arc; infinite at its last one
    rest: np.ndarray  # probability of the state's other arcs
    piece: np.ndarray  # token id, or -1 - n for the n-th character that falls back to bytes
    fallback: list[np.ndarray]  # token ids of these characters

    def options(self, arc: int) -> tuple[int, int]:
        """First and one past the last arc of an arc's state."""
        state = int(self.source[arc])
        return int(self.first_arc[state]), int(self.first_arc[state + 1])


def units_of(text: str) -> list[str]:
    """Units of a text behind the dummy prefix; one without its blank has exactly one before it."""
    if "  " in text or text[:1] in ("", " ") or text[-1] == " ":
        return UNITS.findall(" " + text)
    return text.split(" ")


def number_units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Numbers of all units of all texts in order, how many each text has, and the distinct units by number."""
    odd = [i for i, t in enumerate(texts) if "  " in t or t[:1] in ("", " ") or t[-1] == " "]
    if odd:
        own = set(odd)
        plain = [i for i in range(len(texts)) if i not in own]
        lists = [pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " "), pa.array([units_of(texts[i]) for i in odd], pa.list_(pa.string()))]
        split = pa.concat_arrays(lists).take(pa.array(np.argsort(np.array(plain + odd))))
    else:
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded = split.flatten().dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), np.diff(split.offsets.to_numpy()).astype(np.int64), coded.dictionary


def build_lattice(units: list[str], model: PieceModel) -> Lattice:
    """Lattices of distinct units, with every state's arc probabilities; a unit's numbers do not depend on the others."""
    return join_lattices([_build_some(units[at : at + UNITS_AT_ONCE], model) for at in range(0, max(len(units), 1), UNITS_AT_ONCE)])


def _build_some(units: list[str], model: PieceModel) -> Lattice:
    units = [u if u[0] == " " else " " + u for u in units]
    points = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)
    classes = np.concatenate((model.classes[points], np.zeros(model.longest, dtype=np.int64)))
    sizes = np.array([len(u) for u in units], dtype=np.int64)
    ends = np.cumsum(sizes)
    unit = np.repeat(np.arange(len(units)), sizes)
    place = np.arange(len(points))
    left = ends[unit] - place  # characters to the unit's end
    by_size: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # place, token id or -1 - n for the n-th fallback, weight
    live, base = place, np.zeros(len(points), dtype=np.int64)
    single = np.zeros(len(points), dtype=bool)
    for size in range(1, model.longest + 1):
        at = base + classes[live + (size - 1)]
        go = np.flatnonzero((model.parents[at] == base) & (left[live] >= size))  # a place stops at the first string that begins no piece
        if not len(go):
            break
        live, at = live[go], at[go]
        base, ids = model.bases[at], model.ends[at]
        own = np.flatnonzero(ids >= 0)
        if size == 1:
            single[live[own]] = True
        by_size.append((live[own], ids[own], model.weights[ids[own]]))
    alone = np.flatnonzero(~single)
    if len(alone):
        wide = points[alone] >= 0x80  # others are one byte, so their token is known
        fallback = [chr(c).encode() for c in points[alone[wide]].tolist()]
        ids, widths = np.empty(len(alone), dtype=np.int64), np.ones(len(alone), dtype=np.int64)
        ids[~wide], ids[wide] = model.byte_ids[points[alone[~wide]]], -1 - np.arange(len(fallback))
        widths[wide] = [len(b) for b in fallback]
        extra = (alone, ids, widths * model.byte_weight)
        by_size[:1] = [tuple(map(np.concatenate, zip(by_size[0], extra, strict=True)))] if by_size else [extra]
    else:
        fallback = []

    # Mass of what can follow each state, from the units' ends backwards; a size has one arc at most from each state.
    states = len(points) + len(units)
    log_mass = np.full(states, -np.inf)
    log_mass[ends + np.arange(len(units))] = 0.0
    reach = int(sizes.max()) if len(sizes) else 0
    origins = [own + unit[own] for own, _, _ in by_size]
    steps = []
    for size, (origin, (own, _, weight)) in enumerate(zip(origins, by_size, strict=True), 1):
        away = left[own]
        order = np.argsort(away.astype(np.uint16) if reach < 65536 else away, kind="stable")
        steps.append((size, origin[order], weight[order], np.searchsorted(away[order], np.arange(reach + 2)).tolist()))
    for away in range(1, reach + 1):
        for size, state, weight, bound in steps[:away]:
            a, b = bound[away], bound[away + 1]
            if a < b:
                own = state[a:b]
                log_mass[own] = np.logaddexp(log_mass[own], weight[a:b] + log_mass[own + size])
    del steps
    # Arcs by state, the longest first: it is the likeliest as a rule.
    taken = np.zeros(states, dtype=np.int64)
    ranks = []
    for origin in origins:
        rank = taken[origin]
        ranks.append(rank)
        taken[origin] = rank + 1
    first_arc = np.concatenate(([0], np.cumsum(taken)))
    total = int(first_arc[-1])
    source, go, piece = (np.empty(total, dtype=t) for t in (np.int32, np.int64, np.int32))
    log_p, through, rest = np.empty(total), np.empty(total), np.empty(total)
    sums = np.zeros(states)
    for size, origin, (_, ids, weight), rank in reversed(list(zip(range(1, len(by_size) + 1), origins, by_size, ranks, strict=True))):
        at = first_arc[origin + 1] - 1 - rank
        each = np.minimum(weight + log_mass[origin + size] - log_mass[origin], 0.0)
        sums[origin] = run = sums[origin] + np.exp(each)
        source[at], go[at], piece[at], log_p[at] = origin, first_arc[origin + size], ids, each
        through[at] = np.where(rank == 0, np.inf, run)
        rest[at] = np.where(taken[origin] == 1, 0.0, -np.expm1(each))
    starts = np.concatenate(([0], ends[:-1])) + np.arange(len(units))
    coded = [model.byte_ids[list(b)] for b in fallback]
    return Lattice(starts, ends + np.arange(len(units)), first_arc, source, go, log_p, through, rest, piece, coded)


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for ``sizes[0]`` numbers, then the next run."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _behind(part: Lattice, states: int, arcs: int, odd: int) -> tuple[np.ndarray, ...]:
    """Arrays of a lattice that stands behind so many states, arcs and fallback characters."""
    piece = np.where(part.piece < 0, part.piece - odd, part.piece) if odd and part.fallback else part.piece
    return part.start + states, part.last + states, part.first_arc + arcs, part.source + np.int32(states), part.go + arcs, part.log_p, part.through, part.rest, piece


def join_lattices(parts: list[Lattice]) -> Lattice:
    """The units of all parts in order."""
    if len(parts) == 1:
        return parts[0]
    moved, states, arcs, fallback = [], 0, 0, []
    for part in parts:
        moved.append(_behind(part, states, arcs, len(fallback)))
        states, arcs, fallback = states + len(part.first_arc) - 1, arcs + len(part.log_p), fallback + part.fallback
    arrays = list(zip(*moved, strict=True))
    arrays[2] = (*(x[:-1] for x in arrays[2][:-1]), arrays[2][-1])
    return Lattice(*map(np.concatenate, arrays), fallback)


def take_units(lattice: Lattice, units: np.ndarray) -> Lattice:
    """The lattice of some units without fallback characters."""
    begin, sizes = lattice.start[units], lattice.last[units] - lattice.start[units] + 1
    first, counts = lattice.first_arc[begin], lattice.first_arc[lattice.last[units] + 1] - lattice.first_arc[begin]
    states, arcs = _runs(begin, sizes), _runs(first, counts)
    new = np.cumsum(sizes) - sizes
    each = lattice.first_arc[states + 1] - lattice.first_arc[states]
    return Lattice(
        new, new + sizes - 1, np.concatenate(([0], np.cumsum(each))), lattice.source[arcs] + np.repeat(new - begin, counts).astype(np.int32),
        lattice.go[arcs] + np.repeat(np.cumsum(counts) - counts - first, counts), lattice.log_p[arcs], lattice.through[arcs], lattice.rest[arcs], lattice.piece[arcs], [],
    )


class UnitStore:
    """Lattices of units that batches repeat, up to a number of states; a worker keeps one for each model."""

    def __init__(self, limit: int = 1_600_000):
        self.limit, self.index, self.lattice, self.room = limit, pa.array([], pa.string()), None, []

    def extend(self, own: Lattice) -> Lattice:
        """The stored units, then the new ones, which stand in the store's room until the next call."""
        if self.lattice is None:
            return own
        held = self.lattice
        have = [held.start, held.last, held.first_arc[:-1], held.source, held.go, held.log_p, held.through, held.rest, held.piece]
        arrays = []
        for at, (old, new) in enumerate(zip(have, _behind(own, len(held.first_arc) - 1, len(held.log_p), 0), strict=True)):
            size = len(old) + len(new)
            if at == len(self.room):
                self.room.append(old)
            if len(self.room[at]) < size:
                self.room[at] = np.empty(size + size // 4, dtype=old.dtype)
                self.room[at][: len(old)] = old
            self.room[at][len(old) : size] = new
            arrays.append(self.room[at][:size])
        cut = [len(old) for old in have]
        cut[2] += 1  # the last bound is the first of the new ones
        self.lattice = Lattice(*(x[:n] for x, n in zip(arrays, cut, strict=True)), [])
        return Lattice(*arrays, own.fallback)

    def learn(self, new: pa.StringArray, own: Lattice, times: np.ndarray) -> None:
        """Keep those of the new units that a batch had twice or more."""
        held = 0 if self.lattice is None else len(self.lattice.first_arc) - 1
        odd = np.zeros(len(own.first_arc), dtype=bool)
        odd[own.source[own.piece < 0]] = True
        bad = np.cumsum(odd)
        good = np.flatnonzero((times >= 2) & (bad[own.last] - bad[own.start] + odd[own.start] == 0))
        good = good[np.cumsum(own.last[good] - own.start[good] + 1) <= self.limit - held]
        if len(good):
            self.index = pa.concat_arrays([self.index, new.take(pa.array(good))])
            self.lattice = self.extend(take_units(own, good))


def walk(lattice: Lattice, arc: np.ndarray, stop: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples arcs from the state with each first arc to its unit's end, the first arc behind it: all arcs in order, and how many each walk has.

    ``key``: the hash input of each walk's first step; next ones are ``_PLACES[2]`` apart.
    """
    parts, counts = [np.empty(0, dtype=np.int64)], np.zeros(len(arc), dtype=np.int64)
    for begin in range(0, len(arc), WALKS_AT_ONCE):
        which = np.flatnonzero(arc[begin : begin + WALKS_AT_ONCE] != stop[begin : begin + WALKS_AT_ONCE])
        at, goal, x = arc[begin + which], stop[begin + which], key[begin + which]
        count, steps = counts[begin : begin + WALKS_AT_ONCE], []
        while len(which):
            u = _unit(x)
            more = np.flatnonzero(lattice.through[at] <= u)
            while len(more):  # no number reaches a state's last arc's
                on = at[more] + 1
                at[more] = on
                more = more[lattice.through[on] <= u[more]]
            steps.append((which, at))
            count[which] += 1
            at = lattice.go[at]
            live = np.flatnonzero(at != goal)
            which, at, goal, x = which[live], at[live], goal[live], x[live] + _PLACES[2]
        first = np.cumsum(count) - count
        found = np.empty(int(count.sum()), dtype=np.int64)
        for n, (own, arcs) in enumerate(steps):
            found[first[own] + n] = arcs
        parts.append(found)
    return np.concatenate(parts), counts


@dataclass
class Path:
    """A sample, and the set of those that leave it: where, with what mass, and below which value."""

    arcs: np.ndarray
    pieces: np.ndarray  # of these arcs
    ends: np.ndarray  # arcs through each word
    value: float
    log_p: float
    first: int  # place of masses[0]
    masses: np.ndarray  # of the members that leave the sample at each place, over the sample's mass before ``first``
    scale: float  # logarithm of that mass
    bound: float  # value of the best member
    barred: list[int]  # arcs at ``first`` that other samples took


def _truncated(log_mass: float, value: float, u: float) -> float:
    """The largest value in a set of a mass, given that it is below ``value``."""
    if log_mass == -np.inf:
        return -np.inf
    free = log_mass - math.log(-math.log(u))
    return -(max(-value, -free) + math.log1p(math.exp(-abs(value - free))))


def _make_path(lattice: Lattice, arcs: np.ndarray, ends: np.ndarray, value: float, u: float, fork: int, barred: list[int]) -> Path:
    """``fork``: place at which the sample left its parent; before it other sets are responsible."""
    first = max(fork, 0)
    each = lattice.log_p[arcs]
    tail = each[first:]
    before = tail.cumsum() - tail
    if len(before) and before[-1] < -700.0:  # what leaves later has no mass that a float can tell from zero
        before = before[: int(np.searchsorted(-before, 700.0))]
    rest = lattice.rest[arcs[first : first + len(before)]]
    if barred:
        begin, end = lattice.options(int(arcs[first]))
        rest[0] = max(rest[0] - np.exp(lattice.log_p[barred]).sum(), 0.0) if len(barred) + 1 < end - begin else 0.0
    masses = np.exp(before) * rest
    total = float(masses.sum())
    scale = float(each[:first].sum())
    bound = _truncated(scale + math.log(total), value, u) if total > 0 else -np.inf
    return Path(arcs, lattice.piece[arcs], ends, value, float(each.sum()), first, masses, scale, bound, barred)


def _leave(lattice: Lattice, arc: int, barred: list[int], u: float) -> int:
    """An arc of the same state other than ``arc`` and ``barred``, in proportion."""
    options = [x for x in range(*lattice.options(arc)) if x != arc and x not in barred]
    log_p = lattice.log_p[options]
    weight = np.cumsum(np.exp(log_p - log_p.max()))
    return options[min(int(np.searchsorted(weight, u * weight[-1], side="right")), len(options) - 1)]


def sample_batch(texts: list[str], keys: list[int], model: PieceModel, *, k: int, seed: int = 0, store: UnitStore | None = None) -> list[tuple[list[Path], float, Lattice]]:
    """For each text its paths in falling order of value, kappa, and the batch's lattice."""
    flat, sizes, distinct = number_units(texts)
    numbers = pc.index_in(distinct, value_set=store.index).fill_null(-1).to_numpy().astype(np.int64) if store else np.full(len(distinct), -1)
    fresh = np.flatnonzero(numbers < 0)
    known = len(store.index) if store else 0
    numbers[fresh] = known + np.arange(len(fresh))
    flat = numbers[flat]
    new = distinct.take(pa.array(fresh))
    lattice = own = build_lattice(new.to_numpy(zero_copy_only=False).tolist(), model)
    if store:
        lattice = store.extend(own)
    begin, stop = lattice.first_arc[lattice.start], lattice.first_arc[lattice.last]
    seeds = _mix(np.array([((x or 0) ^ (seed * 0x5851F42D4C957F2D)) & (2**64 - 1) for x in keys], dtype=np.uint64) + _A)
    unnamed = [i for i, x in enumerate(keys) if x is None]
    seeds[unnamed] = _mix(~seeds[unnamed])
    word_ends = np.cumsum(sizes)
    words = [flat[e - n : e] for e, n in zip(word_ends.tolist(), sizes.tolist(), strict=True)]
    places = np.arange(int(sizes.max()) if len(sizes) else 0).astype(np.uint64) * _PLACES[1]  # of a row's words
    arc, counts = walk(lattice, begin[flat], stop[flat], np.concatenate([s + places[:n] for s, n in zip(seeds, sizes.tolist(), strict=True)]))
    through = np.cumsum(counts)
    roots = gumbel(uniform(seeds, 1 << 41))
    # for each turn: value of a new path's set, value of what an opened set keeps, place, arc
    dice = [[uniform(seeds, (1 << 42) + n, turn).tolist() for n in range(4)] for turn in range(k)]
    paths: list[list[Path]] = []
    done = 0
    for i, (e, n) in enumerate(zip(word_ends.tolist(), sizes.tolist(), strict=True)):
        ends = through[e - n : e] - done
        paths.append([_make_path(lattice, arc[done : done + int(ends[-1])], ends, float(roots[i]), dice[0][0][i], -1, [])])
        done += int(ends[-1])
    for turn in range(1, k):
        forks = []
        for i, made in enumerate(paths):
            best = max(made, key=lambda p: p.bound)
            value = best.bound
            if value == -np.inf or len(made) < turn:
                continue
            grown = best.masses.cumsum()
            t = int(grown.searchsorted(dice[turn][2][i] * grown[-1], side="right"))
            if t == len(grown):
                t = int(np.flatnonzero(best.masses)[-1])
            barred = best.barred if t == 0 else []
            at = best.first + t
            new_arc = _leave(lattice, int(best.arcs[at]), barred, dice[turn][3][i])
            best.masses[t] = 0.0
            left = float(best.masses.sum())
            best.bound = _truncated(best.scale + math.log(left), value, dice[turn][1][i]) if left > 0 else -np.inf
            forks.append((i, best, at, int(best.ends.searchsorted(at, side="right")), value, new_arc, [*barred, int(best.arcs[at])]))
        if not forks:
            break
        starts, stops, inputs = [], [], []
        turned = seeds + np.array([turn], dtype=np.uint64) * _PLACES[0]
        for i, best, t, word, _, new_arc, _ in forks:
            open_words = words[i][word:]
            starts.append(begin[open_words])
            starts[-1][0] = lattice.go[new_arc]
            stops.append(stop[open_words])
            inputs.append(places[word : len(words[i])] + turned[i])
            inputs[-1][:1] += np.array([t - (int(best.ends[word - 1]) if word else 0) + 1], dtype=np.uint64) * _PLACES[2]
        arc, counts = walk(lattice, np.concatenate(starts), np.concatenate(stops), np.concatenate(inputs))
        done = at = 0
        for i, best, t, word, value, new_arc, barred in forks:
            ends = np.cumsum(counts[at : at + len(words[i]) - word])
            at += len(ends)
            arcs = np.concatenate((best.arcs[:t], [new_arc], arc[done : done + int(ends[-1])]))
            done += int(ends[-1])
            paths[i].append(_make_path(lattice, arcs, np.concatenate((best.ends[:word], ends + (t + 1))), value, dice[turn][0][i], t, barred))
    if store:
        store.learn(new, own, np.bincount(flat, minlength=known + len(new))[known:])
    return [(made, max(p.bound for p in made) if len(made) == k else -np.inf, lattice) for made in paths]


def path_ids(lattice: Lattice, path: Path) -> np.ndarray:
    """Token ids of a path."""
    ids = path.pieces
    odd = np.flatnonzero(ids < 0) if lattice.fallback else ()
    if not len(odd):
        return ids
    parts, at = [], 0
    for k in odd.tolist():
        parts += [ids[at:k], lattice.fallback[-1 - int(ids[k])]]
        at = k + 1
    return np.concatenate([*parts, ids[at:]])


def pieces_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of a bounded number of characters; a longer text is a run of its own."""
    begin = weight = 0
    for end, text in enumerate(texts):
        if weight and weight + len(text) > CHARACTERS:
            yield begin, end
            begin, weight = end, 0
        weight += len(text)
    yield begin, len(texts)


_MODELS: dict[str, PieceModel] = {}
_STORES: dict[str, UnitStore] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model of a file, loaded once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def sample_segmentations(docs: DataFrame, model_path: str, *, k: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The operator: ``k`` distinct segmentations of every row, or all if there are fewer."""
    shared.bound_batches(docs.sparkSession, ROWS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        store = _STORES.setdefault(model_path, UnitStore())
        names = [x.strip().split(" ")[0] for x in SAMPLES.split(",")]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
        gc.disable()  # nothing here makes cycles
        try:
            for batch in batches:
                names_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                if not texts:
                    continue
                out = []
                for a, b in pieces_of(texts):
                    for doc_id, text, (made, kappa, lattice) in zip(names_of[a:b], texts[a:b], sample_batch(texts[a:b], names_of[a:b], model, k=k, seed=seed, store=store), strict=True):
                        spelled = (" " + text).encode()
                        for rank, path in enumerate(made):
                            ids = path_ids(lattice, path)
                            chance = 1.0 if kappa == -np.inf else float(-np.expm1(-np.exp(min(path.log_p - kappa, 700.0))))
                            back = model.spell(ids) == spelled
                            out.append((doc_id, rank, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), path.log_p, path.value, chance, back))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        finally:
            gc.enable()
            shared.trim()

    return rows.mapInArrow(run, SAMPLES)


def op8_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: two distinct sampled segmentations of every document."""
    import public_tokenizers

    return sample_segmentations(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op8_gumbel_segmentations": op8_gumbel_segmentations}
ORACLE_SQL: dict[str, str] = {}
