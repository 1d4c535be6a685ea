"""BPE merges by a segment tree over the ranks of adjacent pairs.

The lowest-rank pair is merged, the leftmost first among equals, until no pair has a rank. A tree's
leaves are the ranks of the pairs that begin at each symbol, every other node is the lower of its
children: the root names the lowest rank, a walk down finds its leftmost place, and a merge changes
three leaves and what is above them. A string of n symbols takes O(n log n) steps however long it is.

Short strings are merged side by side as the rows of numpy arrays, long ones one by one.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np

NO_RANK = 1 << 40
# Strings up to this length are merged side by side; so many of them at once.
SHORT, AT_ONCE = 64, 8192


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """So many values from each start on, end to end."""
    places = np.repeat(starts - np.cumsum(counts) + counts, counts)
    places += np.arange(len(places))
    return values[places]


class Merges:
    """Merges over symbols; every string is given as the symbols it begins with."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], symbols: int):
        """pairs: (left, right) -> (rank, merged symbol)."""
        self.pairs, self.symbols = pairs, symbols
        keys = np.array([a * symbols + b for a, b in pairs], dtype=np.int64)
        values = np.array(list(pairs.values()), dtype=np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        last = [np.iinfo(np.int64).max]
        self.keys = np.concatenate([keys[order], last])
        self.ranks = np.concatenate([values[order, 0], [NO_RANK]])
        self.merged = np.concatenate([values[order, 1], [-1]])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged symbols of pairs; a symbol of -1 is in no pair."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.symbols + right)
        found = np.searchsorted(self.keys, keys)
        hit = self.keys[found] == keys
        return np.where(hit, self.ranks[found], NO_RANK), np.where(hit, self.merged[found], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> list[tuple[int, ...]]:
        """The symbols of each string after all merges; the strings stand one after the other."""
        merged, counts = self.merge_flat(symbols, lengths)
        flat, ends = merged.tolist(), np.cumsum(counts).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]

    def merge_flat(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same symbols end to end, and how many each string has."""
        starts = np.cumsum(lengths) - lengths
        places = np.flatnonzero(lengths == 1)
        done = [(places, symbols[starts[places]], np.ones(len(places), dtype=np.int64))]
        for i in np.flatnonzero(lengths > SHORT).tolist():
            ids = self.merge_long(symbols[starts[i] : starts[i] + lengths[i]].tolist())
            done.append((np.array([i]), np.array(ids, dtype=np.int64), np.array([len(ids)])))
        least, size = 2, 1
        while least <= SHORT:
            most = min(size + 1, SHORT)
            places = np.flatnonzero((lengths >= least) & (lengths <= most))
            for k in range(0, len(places), AT_ONCE):
                part = places[k : k + AT_ONCE]
                done.append((part, *self.merge_short(symbols, starts[part], lengths[part], size)))
            least, size = most + 1, 2 * size
        places, merged, each = map(np.concatenate, zip(*done))
        counts, first = np.zeros((2, len(lengths)), dtype=np.int64)
        counts[places], first[places] = each, np.cumsum(each) - each
        return gather(merged, first, counts), counts

    def merge_short(
        self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Strings of up to size + 1 symbols, as from merge_flat(); the state of each is a row of flat arrays."""
        rows, width = len(lengths), size + 2  # the last column of a row stays empty
        places = starts[:, None] + np.arange(width)
        table = symbols.take(np.minimum(places, len(symbols) - 1)).astype(np.int64)
        table[np.arange(width) >= lengths[:, None]] = -1
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        after[np.arange(width) >= lengths[:, None] - 1] = width - 1
        before = np.tile(np.arange(-1, width - 1), (rows, 1)).ravel()
        tree = np.full((rows, 2 * size), NO_RANK, dtype=np.int64)
        merged = np.full((rows, width), -1, dtype=np.int64)
        tree[:, size:], merged[:, :size] = self.look_up(table[:, :size], table[:, 1 : size + 1])
        level = size // 2
        while level:
            pairs = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(pairs[:, 0::2], pairs[:, 1::2])
            level //= 2
        ids, after, merged, nodes = table.ravel(), after.ravel(), merged.ravel(), tree.ravel()
        levels, active = range(size.bit_length() - 1), np.arange(rows)
        while len(active := active[nodes.take(active * 2 * size + 1) < NO_RANK]):
            base, top = active * width, active * 2 * size
            low, i = nodes.take(top + 1), np.ones(len(active), dtype=np.int64)
            for _ in levels:
                i += i
                i += nodes.take(top + i) != low
            at = i - size
            here = base + at
            gone = after.take(here)
            nearest = after.take(base + gone)
            symbol = merged.take(here)
            ids[here], ids[base + gone], after[here] = symbol, -1, nearest
            before[base + nearest] = at
            left = before.take(here)
            has = np.flatnonzero(left >= 0)
            first = np.concatenate([symbol, ids.take((base + left)[has])])
            second = np.concatenate([ids.take(base + nearest), symbol[has]])
            rank, product = self.look_up(first, second)
            row = np.concatenate([top, top[has], top])
            place = np.concatenate([at, left[has], gone])
            rank = np.concatenate([rank, np.full(len(active), NO_RANK)])
            merged[np.concatenate([here, (base + left)[has]])] = product
            leaf = np.flatnonzero(place < size)  # no pair begins at the last symbol
            row, i = row[leaf], place[leaf] + size
            nodes[row + i] = rank[leaf]
            for _ in levels:
                lower = np.minimum(nodes.take(row + i), nodes.take(row + (i ^ 1)))
                i >>= 1
                nodes[row + i] = lower
        left = table >= 0
        return table[left], left.sum(axis=1)

    def merge_long(self, string: list[int]) -> tuple[int, ...]:
        ids, n = list(string), len(string)
        size = 1 << (n - 2).bit_length()
        get, none, merges = self.pairs.get, (NO_RANK, -1), self.pairs
        nodes = [NO_RANK] * (2 * size)
        nodes[size : size + n - 1] = [get(pair, none)[0] for pair in zip(ids, ids[1:])]
        for i in range(size - 1, 0, -1):
            nodes[i] = min(nodes[2 * i], nodes[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := nodes[1]) != NO_RANK:
            i = 1
            while i < size:
                i += i
                if nodes[i] != low:
                    i += 1
            at = i - size
            gone = after[at]
            ids[at] = merges[ids[at], ids[gone]][1]
            ids[gone] = -1
            nearest = after[at] = after[gone]
            changed = [(gone, NO_RANK)] if gone < n - 1 else []
            if nearest < n:
                before[nearest] = at
                changed.append((at, get((ids[at], ids[nearest]), none)[0]))
            else:
                changed.append((at, NO_RANK))
            if (left := before[at]) >= 0:
                changed.append((left, get((ids[left], ids[at]), none)[0]))
            for place, rank in changed:
                i = place + size
                nodes[i] = rank
                while i > 1:
                    rank = min(rank, nodes[i ^ 1])
                    i >>= 1
                    if nodes[i] == rank:
                        break
                    nodes[i] = rank
        return tuple([i for i in ids if i >= 0])


class Remembered:
    """Results by key, of which the latest are kept: about twice `most`, besides given first ones."""

    def __init__(self, many, first: dict | None = None, most: int = 250_000):
        """many: the results of a list of keys."""
        self.many, self.first, self.most = many, first or {}, most
        self.known, self.older = dict(self.first), {}

    def of(self, keys: list) -> list:
        known = self.known  # a plain dict: only from one does a set subtract by look-ups
        new = set(keys).difference(known)
        if not new:
            return list(map(known.__getitem__, keys))
        if len(known) >= len(self.first) + self.most:
            self.older, self.known = known, dict(self.first)
            known = self.known
            new = set(keys).difference(known)
        older = self.older
        again = {k: older[k] for k in new if k in older}
        known.update(again)
        rest = list(new.difference(again))
        known.update(zip(rest, self.many(rest)))
        values = list(map(known.__getitem__, keys))
        for key in rest:
            if len(key) > SHORT:
                del known[key]
        return values


class Numbers(dict):
    """Keys by number, and the symbols of each number; a key that is looked up and not there gets the next number.

    `new` are the keys that wait for their symbols, in the order of their numbers.
    """

    def __init__(self, first: dict):
        """first: symbols by key."""
        super().__init__(zip(first, range(len(first))))
        self.new: list = []
        self.counts = np.fromiter(map(len, first.values()), dtype=np.int64, count=len(first))
        self.starts = np.cumsum(self.counts) - self.counts
        self.symbols = np.array([i for ids in first.values() for i in ids], dtype=np.uint32)

    def __missing__(self, key) -> int:
        number = self[key] = len(self.counts) + len(self.new)
        self.new.append(key)
        return number

    def add(self, symbols: np.ndarray, counts: np.ndarray) -> None:
        """The symbols of the new keys."""
        self.starts = np.concatenate([self.starts, len(self.symbols) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.symbols = np.concatenate([self.symbols, symbols])
        self.new = []

    def forget(self, last: list) -> None:
        """Drop the long ones of the keys added last, with their symbols; their numbers stay unused."""
        first = len(self.counts) - len(last)
        begin, kept = self.starts[first], self.counts[first:].copy()
        for place, key in enumerate(last):
            if len(key) > SHORT:
                del self[key]
                kept[place] = 0
        left = gather(self.symbols, self.starts[first:], kept)
        self.symbols = np.concatenate([self.symbols[:begin], left])
        self.counts = np.concatenate([self.counts[:first], kept])
        self.starts = np.concatenate([self.starts[:first], begin + np.cumsum(kept) - kept])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the numbers end to end, and how many each has."""
        counts = self.counts[numbers]
        return gather(self.symbols, self.starts[numbers], counts), counts


class RememberedFlat:
    """As Remembered, for results that are symbols, which are held and given in arrays."""

    def __init__(self, many, first: dict | None = None, most: int = 250_000):
        """many: the symbols of a list of keys end to end, and how many each has."""
        self.many, self.first, self.most = many, first or {}, most
        self.known, self.older = Numbers(self.first), Numbers({})

    def of(self, texts: Iterable[list]) -> list[np.ndarray]:
        """Symbols of each text, a list of keys; the keys of one text are let go before the next one's are made."""
        symbols, counts, keys = self.counted(texts)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(keys)].tolist()
        return [symbols[a:b] for a, b in zip([0, *ends], ends)]

    def each(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the keys end to end, and how many each key has."""
        return self.counted([keys])[:2]

    def counted(self, texts: Iterable[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the texts end to end, how many each key has, and how many keys each text has."""
        if len(self.known.counts) >= len(self.first) + self.most:
            self.older, self.known = self.known, Numbers(self.first)
        known = self.known
        number = known.__getitem__
        numbers = [np.fromiter(map(number, keys), dtype=np.int64, count=len(keys)) for keys in texts]
        if new := known.new:
            known.add(*self.look_up(new))
        symbols, counts = known.of(np.concatenate([np.zeros(0, dtype=np.int64), *numbers]))
        if max(map(len, new), default=0) > SHORT:
            known.forget(new)
        return symbols, counts, np.array(list(map(len, numbers)), dtype=np.int64)

    def look_up(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the keys and how many each has, those known before not made again."""
        older = self.older
        before = np.fromiter(map(older.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        made, made_counts = self.many([key for key, number in zip(keys, before.tolist()) if number < 0])
        counts, starts = np.zeros((2, len(keys)), dtype=np.int64)
        again = before >= 0
        held, held_counts = older.of(before[again])
        counts[again], counts[~again] = held_counts, made_counts
        starts[again] = np.cumsum(held_counts) - held_counts
        starts[~again] = len(held) + np.cumsum(made_counts) - made_counts
        return gather(np.concatenate([held, made.astype(np.uint32)]), starts, counts), counts
