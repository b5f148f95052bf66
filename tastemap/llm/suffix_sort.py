r"""External induced suffix sorting with common-prefix values, as used by operator 5.

``repeated(text, length)`` tells at which positions of a text a string of ``length`` symbols
starts that starts anywhere else too. The text is sorted by induction (Nong, Zhang and Chan;
Bingmann, Fischer and Osipov give the external form):

* positions are S or L as their suffix is smaller or larger than the next one; an S after an
  L is a seed. Strings between seeds are named in order, and the string of names, at most
  half as long, is sorted the same way, recursively, until names are unique;
* from the sorted seeds a left-to-right pass induces the L suffixes, and from those a
  right-to-left pass the S suffixes: each suffix taken from a priority queue puts the one
  before it back in, keyed by its first symbol;
* with each suffix goes the length of the prefix it shares with its neighbour, capped at
  ``length``. Two suffixes induced one after the other for the same symbol share one symbol
  more than the minimum between those that induced them.

The queues live on disk beyond a fixed buffer. At byte level a queue is a row of buckets,
one for each symbol, first in first out (entries for a symbol come in sorted order), filled
and drained in arrays. In the recursion, whose alphabet is as large as its text, it is a
heap that moves its larger half to sorted runs. Text, order and prefix values are memory-
mapped files. All files belong to one task, in its own scratch folder, and go with it: a
lost task starts again from its input.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np

BUFFER = 4 << 20  # entries held in memory by one row of buckets
HEAP = 1 << 19  # and by one heap


class RunHeap:
    """A priority queue of tuples; the larger half of a full heap goes to a run on disk."""

    def __init__(self, folder: str, limit: int | None = None):
        limit = HEAP if limit is None else limit
        self._folder, self._limit, self._heap, self._runs = folder, limit, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._limit:
            self._heap.sort()
            half = len(self._heap) // 2
            with tempfile.NamedTemporaryFile(dir=self._folder, delete=False) as out:
                for at in range(half, len(self._heap), 10_000):
                    pickle.dump(self._heap[at:min(at + 10_000, len(self._heap))], out)
            del self._heap[half:]
            run = self._read(out.name)
            heapq.heappush(self._runs, (next(run), len(self._runs), run))

    @staticmethod
    def _read(name: str) -> Iterator[tuple]:
        with open(name, "rb") as run:
            while block := run.peek(1) and pickle.load(run):
                yield from block
        os.unlink(name)

    def __bool__(self) -> bool:
        return bool(self._heap or self._runs)

    def top(self) -> tuple:
        if self._runs and not (self._heap and self._heap[0] < self._runs[0][0]):
            return self._runs[0][0]
        return self._heap[0]

    def pop(self) -> tuple:
        if self._runs and not (self._heap and self._heap[0] < self._runs[0][0]):
            item, number, run = heapq.heappop(self._runs)
            following = next(run, None)
            if following is not None:
                heapq.heappush(self._runs, (following, number, run))
            return item
        return heapq.heappop(self._heap)


class BucketQueue:
    """For each symbol a first-in-first-out row of (position, source rank) pairs; buckets
    are appended to files when the buffer is full."""

    def __init__(self, folder: str, symbols: int, limit: int = BUFFER):
        self._folder, self._limit, self._held = folder, limit, 0
        self._rows: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self._files: dict[int, str] = {}

    def push(self, symbols: np.ndarray, positions: np.ndarray, ranks: np.ndarray) -> None:
        if not len(symbols):
            return
        order = np.argsort(symbols, kind="stable")
        pairs = np.stack([positions[order], ranks[order]], axis=1).astype(np.int64)
        kinds, first = np.unique(symbols[order], return_index=True)
        for symbol, part in zip(kinds.tolist(), np.split(pairs, first[1:])):
            self._rows[symbol].append(part)
        self._held += len(symbols)
        if self._held > self._limit:
            for symbol, parts in enumerate(self._rows):
                if parts:
                    name = self._files.setdefault(symbol, os.path.join(self._folder, f"bucket-{id(self)}-{symbol}"))
                    with open(name, "ab") as out:
                        for part in parts:
                            part.tofile(out)
                    parts.clear()
            self._held = 0

    def drain(self, symbol: int) -> np.ndarray:
        parts, self._rows[symbol] = self._rows[symbol], []
        self._held -= sum(map(len, parts))
        if symbol in self._files:
            name = self._files.pop(symbol)
            parts.insert(0, np.fromfile(name, np.int64).reshape(-1, 2))
            os.unlink(name)
        return np.concatenate(parts) if parts else np.empty((0, 2), np.int64)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S positions. The last symbol is the unique smallest one, an S."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])  # a run's type is decided where it ends
    rises = text[change] < text[change + 1]
    run = np.searchsorted(change, np.arange(n - 1))
    return np.append(rises[run], True)


def seeds_of(types: np.ndarray) -> np.ndarray:
    return np.flatnonzero(types[1:] & ~types[:-1]) + 1


def seed_names(text: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order-preserving names of the strings from each seed to the next, inclusive. If one is
    a prefix of another the longer one is smaller, so the shorter is padded with a symbol
    above all others."""
    ends = np.append(seeds[1:], seeds[-1]) + 1
    base = np.uint64(int(text.max()) + 2)
    step = max(1, int(63 // np.log2(float(base))))
    names, open_, at = np.zeros(len(seeds), np.int64), np.arange(len(seeds)), 0
    while len(open_):  # the next `step` symbols refine the names of the strings still longer
        key = np.zeros(len(open_), np.uint64)
        for k in range(step):
            place = seeds[open_] + at + k
            inside = place < ends[open_]
            key = key * base + np.where(inside, text[np.minimum(place, len(text) - 1)], base - np.uint64(1)).astype(np.uint64)
        keys = np.zeros(len(seeds), np.uint64)
        keys[open_] = key
        order = np.lexsort((keys, names))
        fresh = np.ones(len(seeds), bool)
        fresh[1:] = (names[order][1:] != names[order][:-1]) | (keys[order][1:] != keys[order][:-1])
        names[order] = np.cumsum(fresh) - 1
        at += step
        open_ = open_[seeds[open_] + at < ends[open_]]
    return names


def heap_order(text: list[int], folder: str) -> list[int]:
    """Sorted suffixes of a text over any integers that ends in its unique smallest one."""
    array = np.array(text, np.int64)
    if len(np.unique(array)) == len(array):
        return np.argsort(array).tolist()
    types = suffix_types(array)
    starts = seeds_of(types)
    names = seed_names(array, starts)
    seeds = starts[heap_order(names.tolist(), folder)].tolist()
    larger, queue, count, k = [], RunHeap(folder), 0, 0
    while queue or k < len(seeds):
        if queue and (k == len(seeds) or queue.top()[0] <= text[seeds[k]]):
            p = queue.pop()[2]
            larger.append(p)
        else:
            p = seeds[k]
            k += 1
        if p and text[p - 1] >= text[p]:
            queue.push((text[p - 1], count, p - 1))
            count += 1
    out, queue, count, k, small = [], RunHeap(folder), 0, len(larger) - 1, types.tolist()
    while queue or k >= 0:
        if queue and (k < 0 or -queue.top()[0] >= text[larger[k]]):
            p = queue.pop()[2]
        else:
            p = larger[k]
            k -= 1
        out.append(p)
        if p and small[p - 1]:
            queue.push((-text[p - 1], count, p - 1))
            count += 1
    out.append(len(text) - 1)
    return out[::-1]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, at most ``cap``."""
    out, left = np.zeros(len(a), np.int32), np.arange(len(a))
    for k in range(cap):
        pa, pb = a[left] + k, b[left] + k
        inside = np.maximum(pa, pb) < len(text)
        left, pa, pb = left[inside], pa[inside], pb[inside]
        left = left[text[pa] == text[pb]]
        if not len(left):
            break
        out[left] += 1
    return out


def _between(values: np.ndarray, ranks: np.ndarray, last: int | None) -> np.ndarray:
    """Minimum of ``values`` from after each rank's predecessor (``last`` for the first) up to
    it; 0 for the first without predecessor."""
    first = ranks[0] if last is None else last
    edges = np.concatenate([[first], ranks])
    if last is None:
        edges = edges[1:]
    out = np.minimum.reduceat(values[first + 1:ranks[-1] + 1], edges[:-1] - first) if len(edges) > 1 else np.empty(0, values.dtype)
    return np.concatenate([[-1], out]) if last is None else out


def _run(text: np.ndarray, at: int, cap: int) -> int:
    part = text[at:at + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


class Inducer:
    """One pass: takes suffixes in order, with prefix values, and queues what they induce."""

    def __init__(self, text: np.ndarray, queue: BucketQueue, wanted: np.ndarray, size: int, cap: int, folder: str, name: str):
        self.text, self.queue, self.wanted, self.cap = text, queue, wanted, cap
        self.order = np.memmap(os.path.join(folder, f"{name}-order"), np.int64, "w+", shape=max(1, size))
        self.common = np.memmap(os.path.join(folder, f"{name}-common"), np.int32, "w+", shape=max(1, size))
        self.done = 0
        self.last: dict[int, int] = {}  # symbol -> source rank of its last induced suffix

    def take(self, positions: np.ndarray, common: np.ndarray) -> None:
        n = len(positions)
        ranks = np.arange(self.done, self.done + n)
        self.order[self.done:self.done + n], self.common[self.done:self.done + n] = positions, common
        self.done += n
        keep = positions > 0
        before = positions[keep] - 1
        keep_too = self.wanted[before]
        before = before[keep_too]
        self.queue.push(self.text[before], before, ranks[keep][keep_too])

    def drain(self, symbol: int) -> None:
        """Take all queued suffixes of a symbol, and those that they queue for it in turn."""
        while len(pairs := self.queue.drain(symbol)):
            ranks = pairs[:, 1]
            low = _between(self.common, ranks, self.last.get(symbol))
            self.last[symbol] = int(ranks[-1])
            self.take(pairs[:, 0], np.minimum(low + 1, self.cap))


def repeated(text: np.ndarray, length: int, folder: str, limit: int = BUFFER) -> np.ndarray:
    """Positions where a string of ``length`` symbols starts that starts elsewhere too. ``text``
    holds small integers and ends in its unique smallest, 0; equal separators below all other
    symbols keep strings apart (a match never holds one: callers see to it)."""
    n, symbols = len(text), int(text.max()) + 1
    types = suffix_types(text)
    starts = seeds_of(types)
    if not len(starts):
        return np.empty(0, np.int64)
    seeds = starts[heap_order(seed_names(text, starts).tolist(), folder)]
    shared = np.concatenate([[0], _common(text, seeds[:-1], seeds[1:], length)]).astype(np.int32)
    first = text[seeds]
    edges = np.searchsorted(first, np.arange(symbols + 1))

    left = Inducer(text, BucketQueue(folder, symbols, limit), ~types, n, length, folder, "left")
    parts: list[tuple[int, int]] = []
    for symbol in range(symbols):
        begin = left.done
        left.drain(symbol)
        parts.append((begin, left.done))
        a, b = edges[symbol], edges[symbol + 1]
        if b > a:
            common = shared[a:b].copy()
            common[0] = 0 if left.done == begin else min(
                _run(text, int(left.order[left.done - 1]), length), _run(text, int(seeds[a]), length))
            left.take(seeds[a:b], common)

    right = Inducer(text, BucketQueue(folder, symbols, limit), types, n, length, folder, "right")
    for symbol in range(symbols - 1, -1, -1):
        begin = right.done
        if symbol == int(text[-1]):  # nothing induces the last suffix
            right.take(np.array([n - 1]), np.array([0], np.int32))
        right.drain(symbol)
        a, b = parts[symbol]
        if b > a:
            positions = np.array(left.order[a:b])[::-1]
            common = np.concatenate([np.array(left.common[a + 1:b])[::-1], [0]])
            common = np.concatenate([[0], common[:-1]]).astype(np.int32)
            common[0] = 0 if right.done == begin else min(
                _run(text, int(right.order[right.done - 1]), length), _run(text, int(positions[0]), length))
            right.take(positions, common)
    hit = right.common[:right.done] >= length
    return np.array(right.order[:right.done])[hit | np.append(hit[1:], False)]
