"""Sizes of the matching blocks of many pairs of texts at once, as difflib's
SequenceMatcher finds them without junk: the longest common substring, of equal ones the
first in a, then in b, and the same again on both sides of it.

A step takes the areas that are left (a part of a beside one of b) and all places where
they have a gram of q letters in common, which hold every block of q letters or more.
Places on a diagonal are runs; the longest of each area is its block, and what the block
leaves of the others goes on. Then come shorter grams, in the areas between the blocks.
Each step is over the areas of all pairs, so its cost is that of arrays, not of letters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Lengths of grams; the first two are for areas of more than WIDE cells only.
GRAMS = (64, 16, 4, 2, 1)
WIDE = 1 << 26
#: Places that are held at once; an area with more of them is split letter by letter.
MOST_PLACES = 1 << 20
#: Letters of a batch of pairs, unless one pair has more.
BATCH = 1 << 17

Areas = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # starts and stops in a, then in b


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def order(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, which are below `most`, and their places; equal keys in order."""
    bits = len(keys).bit_length()
    if most < 1 << (63 - bits):
        both = np.sort(keys << bits | np.arange(len(keys)))
        return both >> bits, both & ((1 << bits) - 1)
    at = np.argsort(keys, kind="stable")
    return keys[at], at


def edges(sorted_keys: np.ndarray, step: int = 0) -> np.ndarray:
    """Where a key isn't the one before it plus `step`."""
    return np.flatnonzero(np.concatenate(([True], np.diff(sorted_keys) != step)))


def both_sides(keys: np.ndarray, n: int) -> np.ndarray:
    """Places of the keys that are among the first n and the others, and of a few more, by a hash."""
    bits = len(keys).bit_length() + 3
    at = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    seen = np.zeros((2, 1 << bits), dtype=bool)
    seen[0, at[:n]] = seen[1, at[n:]] = True
    return np.flatnonzero((seen[0] & seen[1])[at])


class Pairs:
    """A batch of pairs in two arrays of letters, a free place after each text."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        lengths = np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)], dtype=np.int64).reshape(-1, 2)
        self.sizes = np.zeros(len(a))
        starts = np.cumsum(lengths + 1, axis=0) - lengths - 1
        free = np.zeros(1, dtype=np.uint32)
        sides = [np.concatenate([t for x in side for t in (x, free)]) for side in (a, b)]
        self.split = len(sides[0])
        self.pair = np.repeat(np.arange(len(a)), lengths[:, 0] + 1)
        letters = np.concatenate(sides)
        used = np.zeros(int(letters.max()) + 1, dtype=np.int64)
        used[letters] = 1
        self.known = {1: ((np.cumsum(used) - 1)[letters], int(used.sum()))}
        self.bits = max(len(side) for side in sides).bit_length()
        areas: Areas = (starts[:, 0], starts[:, 0] + lengths[:, 0], starts[:, 1], starts[:, 1] + lengths[:, 1])
        for q in GRAMS:
            areas = self.step(areas, q)

    def grams(self, q: int) -> tuple[np.ndarray, int]:
        """A number for the gram that begins at each place, and their bound."""
        if q not in self.known:
            half, most = self.grams(q // 2)
            if most >= 1 << 24:  # numbered anew, so that numbers stay small
                known, half = np.unique(half, return_inverse=True)
                half, most = half.astype(np.int64), len(known)
            codes = half * most
            codes[: -(q // 2)] += half[q // 2 :]
            most *= most
            self.known[q] = codes, most
        return self.known[q]

    def step(self, areas: Areas, q: int) -> Areas:
        """Takes all blocks of q letters or more out of the areas; what is left, in order."""
        begin = [areas[0] << self.bits | areas[2]]  # where areas begin and stop, also at blocks
        stop = [areas[1] << self.bits | areas[3]]
        todo = [areas]
        while todo:
            a, a_stop, b, b_stop = todo.pop()
            wide = (a_stop - a >= q) & (b_stop - b >= q)
            if q > 4:
                wide &= (a_stop - a) * (b_stop - b) > WIDE
            if not wide.any():
                continue
            own: Areas = (a[wide], a_stop[wide], b[wide], b_stop[wide])
            for block_a, block_b, size in self.blocks(own, q, todo):
                self.sizes += np.bincount(self.pair[block_a], size, len(self.sizes))
                begin.append(block_a + size << self.bits | block_b + size)
                stop.append(block_a << self.bits | block_b)
        begins, stops = np.sort(np.concatenate(begin)), np.sort(np.concatenate(stop))
        low = (1 << self.bits) - 1
        a, a_stop, b, b_stop = begins >> self.bits, stops >> self.bits, begins & low, stops & low
        left = (a < a_stop) & (b < b_stop)
        return a[left], a_stop[left], b[left], b_stop[left]

    def blocks(self, areas: Areas, q: int, again: list[Areas]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks as places in a, in b and sizes; areas with too many places get one
        block and go to `again`."""
        a, a_stop, b, b_stop = areas
        counts_a, counts_b = a_stop - a - q + 1, b_stop - b - q + 1
        places = np.concatenate((ranges(a, counts_a), ranges(b, counts_b) + self.split))
        area = np.concatenate((np.repeat(np.arange(len(a)), counts_a), np.repeat(np.arange(len(a)), counts_b)))
        codes, most = self.grams(q)
        if len(a) * most >= 1 << 62:
            known, codes = np.unique(codes, return_inverse=True)
            codes, most = codes.astype(np.int64), len(known)
        keys, n_a = area * most + codes[places], int(counts_a.sum())
        if q > 2:  # most grams are in one text only
            kept = both_sides(keys, n_a)
            keys, places, area, n_a = keys[kept], places[kept], area[kept], int(np.searchsorted(kept, n_a))
            if not len(keys):
                return
        keys, at = order(keys, len(a) * most)
        first = edges(keys)
        counts = np.diff(np.append(first, len(keys)))
        in_a = np.add.reduceat((at < n_a).astype(np.int64), first)
        in_b = counts - in_a
        shared = (in_a > 0) & (in_b > 0)
        first, in_a, in_b = first[shared], in_a[shared], in_b[shared]
        where = area[at[first]]
        many = np.bincount(where, in_a * in_b, len(a)) > MOST_PLACES
        for k in np.flatnonzero(many):
            found = self.longest(a[k], a_stop[k], b[k], b_stop[k])
            yield tuple(np.array([x]) for x in found)
            x, y, size = found
            again.append((np.array([a[k], x + size]), np.array([x, a_stop[k]]), np.array([b[k], y + size]), np.array([y, b_stop[k]])))
        kept = ~many[where]
        first, in_a, in_b, where = first[kept], in_a[kept], in_b[kept], where[kept]
        if not len(first):
            return
        heads = edges(where)
        total = np.cumsum(np.add.reduceat(in_a * in_b, heads))
        for part in np.split(np.arange(len(heads)), edges(total // MOST_PLACES)[1:]):
            own = slice(heads[part[0]], heads[part[-1] + 1] if part[-1] + 1 < len(heads) else None)
            places_a = places[at[ranges(first[own], in_a[own])]]
            beside = np.repeat(in_b[own], in_a[own])
            x = np.repeat(places_a, beside)
            y = places[at[ranges(np.repeat(first[own] + in_a[own], in_a[own]), beside)]] - self.split
            yield from self.rounds(*self.runs(x, y, q, a), q)

    def runs(self, x: np.ndarray, y: np.ndarray, q: int, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of grams to runs on a diagonal, by area: places in a, in b, sizes, areas."""
        low = (1 << self.bits) - 1
        keys = np.sort((y - x + low) << self.bits | x)
        first = edges(keys, 1)
        size = np.diff(np.append(first, len(keys))) + q - 1
        x = keys[first] & low
        y = (keys[first] >> self.bits) - low + x
        area, at = order(np.searchsorted(a, x, "right") - 1, len(a))
        return x[at], y[at], size[at], area

    def rounds(self, x: np.ndarray, y: np.ndarray, size: np.ndarray, area: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The longest run of each area is a block; what lies wholly before or after it
        goes on, as far as it still has the least size."""
        while len(x):
            first = edges(area)
            counts = np.diff(np.append(first, len(x)))
            longest = np.maximum.reduceat(size, first)
            place = np.where(size == np.repeat(longest, counts), x << self.bits | y, np.iinfo(np.int64).max)
            best = np.minimum.reduceat(place, first)
            block_x, block_y = best >> self.bits, best & ((1 << self.bits) - 1)
            yield block_x, block_y, longest
            to_x, to_y, taken = (np.repeat(v, counts) for v in (block_x, block_y, longest))
            before = np.minimum(size, np.minimum(to_x - x, to_y - y))
            skip = np.maximum(0, np.maximum(to_x + taken - x, to_y + taken - y))
            left, right = before >= least, size - skip >= least
            which = np.repeat(np.arange(len(first)), counts)
            x, y, size, area = (
                np.concatenate(v)
                for v in (
                    (x[left], (x + skip)[right]),
                    (y[left], (y + skip)[right]),
                    (before[left], (size - skip)[right]),
                    (which[left], which[right] + len(first)),
                )
            )

    def longest(self, a: int, a_stop: int, b: int, b_stop: int) -> tuple[int, int, int]:
        """The block of one area, by the lengths of all runs that end at a letter of a."""
        codes = self.known[1][0]
        beside = codes[b + self.split : b_stop + self.split]
        best = (0, 0, 0)
        ends = np.zeros(len(beside) + 1, dtype=np.int64)
        for x in range(a, a_stop):
            ends[1:] = np.where(beside == codes[x], ends[:-1] + 1, 0)
            at = int(ends.argmax())
            if ends[at] > best[2]:
                size = int(ends[at])
                best = (x - size + 1, int(b) + at - size, size)
        return best


def matched(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The sum of the sizes of each pair's matching blocks; texts are arrays of code points."""
    out = np.zeros(len(a))
    todo: list[int] = []
    letters = 0
    for k in range(len(a)):
        todo.append(k)
        letters += len(a[k]) + len(b[k])
        if letters >= BATCH or k + 1 == len(a):
            out[todo] = Pairs([a[j] for j in todo], [b[j] for j in todo]).sizes
            todo, letters = [], 0
    return out
