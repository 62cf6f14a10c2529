"""Elias-Fano sequences and an n-gram trie of three levels over them.

A trie holds one shard's words, pairs and triples. Level 1 is the sorted sequence of the
words' 64-bit keys; as a successor, a word is its rank in the trie's dictionary. Each level
below is one monotone sequence: the ranks of a node's successors, ascending, shifted by
where the siblings before them ended, so that the whole level never decreases. Monotone
pointers say where each node's successors start. A lookup goes down from the context:
it takes the context's two pointers and the shift before the first, and seeks the
successor of (shift + rank) between the pointers only.

Every node has its smoothed probability, quantised to 16 bits, and a word also the weight
that it leaves to the shorter context; a pair's follows from these two. ``saved`` writes the arrays
of a trie to one file and maps it, so a large shard is paged in as asked.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Codes are -1024 times the base-2 logarithm of a probability; this one means "not there".
STEP, MISSING = 1024.0, np.uint16(0xFFFF)

_U1, _U6 = np.uint64(1), np.uint64(6)


class EliasFano:
    """A sequence of 64-bit integers that doesn't decrease."""

    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.low_bits, self.low, self.high, self.ones = size, low_bits, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high_part = (values >> np.uint64(low_bits)) if low_bits else values
        at = high_part.astype(np.int64) + np.arange(n)
        words = (int(at[-1]) >> 6) + 2 if n else 1
        high = np.zeros(words, np.uint64)
        np.bitwise_or.at(high, at >> 6, _U1 << (at & 63).astype(np.uint64))
        ones = np.zeros(words + 1, np.int64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        return cls(n, low_bits, _pack(values & np.uint64((1 << low_bits) - 1), low_bits), high, ones)

    def _lows(self, at: np.ndarray) -> np.ndarray:
        return _unpack(self.low, self.low_bits, at)

    def _before(self, bucket: np.ndarray) -> np.ndarray:
        """How many elements have a high part below ``bucket``: its ones before the bucket-th zero."""
        out = np.zeros(len(bucket), np.int64)
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        inner = np.flatnonzero(bucket > 0)
        k = bucket[inner].astype(np.int64) - 1
        past = k >= zeros[-1]
        word = np.minimum(np.searchsorted(zeros, k, side="right") - 1, len(self.high) - 1)
        rest = (k - zeros[word]).astype(np.uint64)
        bits = ~self.high[word]
        place = np.zeros(len(k), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            count = np.bitwise_count(bits & ((_U1 << w) - _U1)).astype(np.uint64)
            right = rest >= count
            rest = np.where(right, rest - count, rest)
            place += np.where(right, w, np.uint64(0))
            bits = np.where(right, bits >> w, bits)
        found = word * 64 + place.astype(np.int64) - k
        out[inner] = np.where(past, self.size, np.minimum(found, self.size))
        return out

    def _window(self, at: np.ndarray) -> np.ndarray:
        """The 64 bits of the high parts that begin at each place; none past the end."""
        at = np.minimum(at, (len(self.high) - 1) * 64)
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        after = self.high[np.minimum(word + 1, len(self.high) - 1)] << (np.uint64(63) - shift) << _U1
        return (self.high[word] >> shift) | np.where(word + 1 < len(self.high), after, np.uint64(0))

    def _ones_from(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand in a row from each place, at most 64."""
        zeros = ~self._window(at)
        return np.bitwise_count((zeros & -zeros) - _U1).astype(np.int64)

    def find(self, x: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
        """Index from ``first`` up to ``last`` of the first element not less than each ``x`` if it equals it, else -1."""
        x = np.asarray(x, np.uint64)
        if not self.size or not len(x):
            return np.full(len(x), -1, np.int64)
        bucket = x >> np.uint64(self.low_bits)
        # successor search among the elements that share the high part, within the given range
        lo = self._before(bucket)
        hi = lo + self._ones_from(lo + np.minimum(bucket, np.uint64(64 * len(self.high))).astype(np.int64))
        full = np.flatnonzero(hi - lo == 64)
        hi[full] = self._before(bucket[full] + _U1)
        lo = np.maximum(lo, first)
        if last is not None:
            hi = np.minimum(hi, last)
        low = x & np.uint64((1 << self.low_bits) - 1)
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._lows(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        inside = np.flatnonzero(lo < end)
        out = np.full(len(x), -1, np.int64)
        hit = inside[self._lows(lo[inside]) == low[inside]]
        out[hit] = lo[hit]
        return out

    def _place(self, at: np.ndarray) -> np.ndarray:
        """Where in the high parts the ones of these indexes stand."""
        word = np.searchsorted(self.ones, at, side="right") - 1
        rest = (at - self.ones[word]).astype(np.uint64)
        bits = self.high[word]
        place = np.zeros(len(at), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            count = np.bitwise_count(bits & ((_U1 << w) - _U1)).astype(np.uint64)
            right = rest >= count
            rest = np.where(right, rest - count, rest)
            place += np.where(right, w, np.uint64(0))
            bits = np.where(right, bits >> w, bits)
        return word * 64 + place.astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The elements at these indexes."""
        at = np.asarray(at, np.int64)
        return self._value(at, self._place(at))

    def _value(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        return ((place - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(at)

    def two(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The elements at these indexes, and those after them."""
        at = np.asarray(at, np.int64)
        place = self._place(at)
        ahead = self._window(place + 1)
        after = place + 1 + np.bitwise_count((ahead & -ahead) - _U1).astype(np.int64)
        far = np.flatnonzero(ahead == 0)
        after[far] = self._place(at[far] + 1)
        return self._value(at, place), self._value(at + 1, after)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones]


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Fixed-width fields in 64-bit words, with one spare word."""
    out = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits:
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
        word, shift = (at >> _U6).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(out, word, values << shift)
        over = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def _unpack(words: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(at), np.uint64)
    place = at.astype(np.uint64) * np.uint64(bits)
    word, shift = (place >> _U6).astype(np.int64), place & np.uint64(63)
    value = words[word] >> shift
    over = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))
    value[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return value & np.uint64((1 << bits) - 1)


def to_code(p: np.ndarray) -> np.ndarray:
    """Quantise probabilities."""
    return np.minimum(np.rint(-np.log2(p) * STEP), 65534).astype(np.uint16)


def from_code(code: np.ndarray) -> np.ndarray:
    """The probability of a code; 0 for what is missing."""
    return np.where(code == MISSING, 0.0, np.exp2(code / -STEP))


class Level:
    """Successors of the nodes of the level above: their ranks, where each node's start, and their codes."""

    def __init__(self, ids: EliasFano, pointers: EliasFano, codes: np.ndarray):
        self.ids, self.pointers, self.codes = ids, pointers, codes

    @classmethod
    def of(cls, parent: np.ndarray, rank: np.ndarray, parents: int, codes: np.ndarray) -> Level:
        """From nodes sorted by (number of the parent, rank)."""
        starts = np.searchsorted(parent, np.arange(parents + 1))
        full = np.flatnonzero(np.diff(starts))
        shift = np.zeros(parents, np.int64)
        shift[full[1:]] = np.cumsum(rank[starts[full[:-1] + 1] - 1])
        return cls(EliasFano.of(rank + shift[parent]), EliasFano.of(starts), codes)

    def find(self, parent: np.ndarray, runs: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Numbers of the successors ``rank`` of parents, each with as many as its run; -1 where parent or word is none."""
        out = np.full(len(rank), -1, np.int64)
        asked = np.flatnonzero((parent >= 0) & (runs > 0))
        if not self.ids.size or not len(asked):
            return out
        first, last = (x.astype(np.int64) for x in self.pointers.two(parent[asked]))
        shift = np.zeros(len(first), np.uint64)
        later = np.flatnonzero((first > 0) & (first < last))
        shift[later] = self.ids.get(first[later] - 1)
        runs, ends = runs[asked], np.cumsum(runs)[asked]
        row = np.repeat(ends - runs - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        some = np.repeat(first < last, runs) & (rank[row] >= 0)
        row, group = row[some], np.repeat(np.arange(len(asked)), runs)[some]
        out[row] = self.ids.find(shift[group] + rank[row].astype(np.uint64), first[group], last[group])
        return out

    def code(self, number: np.ndarray) -> np.ndarray:
        return coded(self.codes, number)


def coded(codes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The codes of nodes by number, ``MISSING`` for -1."""
    return np.where(number >= 0, codes[np.maximum(number, 0)], MISSING) if len(codes) else np.full(len(number), MISSING)


class Trie:
    """Smoothed probabilities of the words, pairs and triples of one shard."""

    SEQUENCES = ("words", "pairs", "pair_pointers", "triples", "triple_pointers")
    VALUES = ("word_counts", "word_codes", "word_rest", "pair_codes", "triple_codes")

    def __init__(self, **parts: EliasFano | np.ndarray):
        for name in (*self.SEQUENCES, *self.VALUES):
            setattr(self, name, parts[name])
        self.level2 = Level(self.pairs, self.pair_pointers, self.pair_codes)
        self.level3 = Level(self.triples, self.triple_pointers, self.triple_codes)

    @classmethod
    def build(cls, words: tuple, pairs: tuple, triples: tuple, k2: float, k3: float, base: Callable, context_counts: Callable, pair_counts: Callable) -> Trie:
        """From words (key, count), pairs (index into ``words``, rank, count) and triples (index into ``pairs``, rank, count).

        Rows come in any order and repeat. ``base`` gives the probabilities of counts of
        words. ``context_counts`` and ``pair_counts`` give counts that this shard can't tell
        by itself, or -1, for keys and for keys with ranks. A node's probability is its
        count over its context's count and the prior, which is the weight left to the
        shorter context.
        """
        held = pairs[2] > 0, triples[2] > 0
        some = words[1] > 0
        some[pairs[0][held[0]]] = True
        keys, counts = merged(words[0][some], words[1][some])
        number = np.searchsorted(keys, words[0])
        known = context_counts(keys)
        context = np.where(known >= 0, known, counts)
        size = 1 + int(max(pairs[1].max(initial=0), triples[1].max(initial=0)))
        pair_of = number[pairs[0]] * size + pairs[1]
        pair, p_counts = merged(pair_of[held[0]], pairs[2][held[0]])
        above, rank = pair // size, pair % size
        known = pair_counts(keys[above], rank)
        p_counts = np.where(known >= 0, known, p_counts)
        parent = np.searchsorted(pair, pair_of[triples[0][held[1]]])
        triple, t_counts = merged(parent * size + triples[1][held[1]], triples[2][held[1]])
        level2 = Level.of(above, rank, len(keys), to_code(p_counts / (context[above] + k2)))
        level3 = Level.of(triple // size, triple % size, len(pair), to_code(t_counts / (p_counts[triple // size] + k3)))
        return cls(
            words=EliasFano.of(keys), word_counts=counts, word_codes=to_code(base(counts)), word_rest=to_code(k2 / (context + k2)),
            pairs=level2.ids, pair_pointers=level2.pointers, pair_codes=level2.codes,
            triples=level3.ids, triple_pointers=level3.pointers, triple_codes=level3.codes,
        )

    def saved(self, path: str) -> Trie:
        """The same trie over a memory-mapped file."""
        sequences = {n: getattr(self, n) for n in self.SEQUENCES}
        parts = [getattr(self, n) for n in self.VALUES] + [a for s in sequences.values() for a in s.arrays()]
        offsets, at = [], 0
        with open(path, "wb") as f:
            for a in parts:
                at += f.write(b"\0" * (-at % 8))
                offsets.append(at)
                at += f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * 8)
        mapped = np.memmap(path, np.uint8, "r")
        views = [mapped[o : o + a.nbytes].view(a.dtype) for o, a in zip(offsets, parts, strict=True)]
        n = len(self.VALUES)
        again = {name: EliasFano(s.size, s.low_bits, *views[n + 3 * i : n + 3 + 3 * i]) for i, (name, s) in enumerate(sequences.items())}
        return Trie(**again, **dict(zip(self.VALUES, views, strict=False)))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the counts of equal keys added."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(counts[order].astype(np.int64), at)
