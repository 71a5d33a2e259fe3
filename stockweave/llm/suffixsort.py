"""Suffix sorting by induction, with queues that go to disk.

All suffixes of a string of numbers are ranked from those of its LMS positions (where a rise
begins after a fall). The LMS substrings are named in order; if names repeat, the string of
names is ranked first, by the same function. The others are induced: a suffix is ordered by its
first symbol and the rank of the suffix after it, so falling ones are found from smaller
symbols upwards and rising ones from larger symbols downwards. Symbols are taken in ranges; a
range's queue holds tuples (position, rank of the next suffix) pushed by ranges before it, and
tuples beyond a bound in memory lie in an unnamed temporary file of the task, as the runs of
Spark's own sorts do. Inside a range, chains of suffixes are ranked by doubling.

Common prefixes of neighbours are compared in words of eight bytes, up to the length asked for.
"""

from __future__ import annotations

import tempfile

import numpy as np

QUEUE_BYTES = 64 << 20  # of tuples in memory
RANGES = 16


class Queues:
    """One queue of (position, rank) tuples for each range of symbols."""

    def __init__(self, n: int, limit: int):
        self.parts: list[list] = [[] for _ in range(n)]
        self.limit, self.held, self.file = limit, 0, None

    def push(self, to: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        if not len(to):
            return
        order = np.argsort(to, kind="stable")
        to, position, rank = to[order], position[order], rank[order]
        cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(to)], strict=True):
            self.parts[to[a]].append((position[a:b], rank[a:b]))
        self.held += 16 * len(to)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    both = np.stack([part[0], part[1]]).astype(np.int64)
                    self.file.write(both.tobytes())
                    parts[k] = (at, both.shape[1])
        self.held = 0

    def pop(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        positions, ranks = [], []
        for first, second in self.parts[which]:
            if not isinstance(first, np.ndarray):
                self.file.seek(first)
                both = np.frombuffer(self.file.read(16 * second), dtype=np.int64)
                first, second = both[: len(both) // 2], both[len(both) // 2 :]
            else:
                self.held -= 16 * len(first)
            positions.append(first)
            ranks.append(second)
        self.parts[which] = []
        if not positions:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(positions), np.concatenate(ranks)


def _regroup(order: np.ndarray, head: np.ndarray, rank: np.ndarray, key) -> bool:
    """Split groups of equal rank by `key(elements)`; False if all ranks differ already."""
    alone = head.copy()
    alone[:-1] &= head[1:]
    slots = np.flatnonzero(~alone)
    if not len(slots):
        return False
    some = order[slots]
    keys = rank[some] * np.int64(1 << 31) + key(some)
    by_key = np.argsort(keys)
    keys, some = keys[by_key], some[by_key]
    new = np.ones(len(slots), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    order[slots], head[slots] = some, new
    rank[some] = np.maximum.accumulate(np.where(new, slots, 0))
    return True


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group heads, rank of each element: the first place of its group)."""
    order = np.argsort(key)
    head = np.ones(len(key), dtype=bool)
    head[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
    return order, head, rank


def _rank_range(symbol: np.ndarray, known: np.ndarray, parent: np.ndarray, floor: np.ndarray):
    """Order of a range's members by (symbol, rank of the next suffix).

    `known` has that rank where parent is -1; else the next suffix is member `parent`, whose
    rank is at least `floor`, and no known rank lies between it and its equals.
    """
    span = np.int64(1 << 31)
    order, head, rank = _grouped(symbol * span + np.where(parent < 0, known, floor))
    if (parent >= 0).any():
        jump = parent.copy()
        while _regroup(order, head, rank, lambda x: rank[jump[x]]):
            # members resolved already don't jump; the others still have someone to jump to
            jump = np.where(jump >= 0, jump[jump], -1)
    return order


def _members(position, known, extra, extra_rank, text, wanted, low, high):
    """All suffixes of a range: those popped, those before `extra`, and what chains to them."""
    before = extra - 1
    good = (before >= 0) & wanted[before] & (text[before] >= low) & (text[before] <= high)
    positions = [position, before[good]]
    ranks = [known, extra_rank[good]]
    parents = [np.full(len(position) + int(good.sum()), -1, dtype=np.int64)]
    front, at, count = np.concatenate(positions), 0, len(parents[0])
    while len(front):
        nxt = front - 1
        good = (nxt >= 0) & wanted[nxt] & (text[nxt] >= low) & (text[nxt] <= high)
        parents.append(at + np.flatnonzero(good))
        at, front = count, nxt[good]
        positions.append(front)
        ranks.append(np.zeros(len(front), dtype=np.int64))
        count += len(front)
    return np.concatenate(positions), np.concatenate(ranks), np.concatenate(parents)


def _by_substrings(
    symbol: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(order, group heads) of LMS substrings; equal ones form a group.

    Symbols tell rising from falling, so substrings that are equal so far end at the same place:
    a group goes on, several symbols at a time, only until its members differ or end.
    """
    bits = int(symbol.max()).bit_length()

    def ahead(some: np.ndarray, done: int, take: int) -> np.ndarray:
        key = np.zeros(len(some), dtype=np.int64)
        first, last = starts[some] + done, ends[some]
        for k in range(take):
            at = first + k
            key = (key << bits) | np.where(at <= last, symbol[np.minimum(at, last)], 0)
        return key

    done = max(1, 62 // bits)
    order, head, rank = _grouped(ahead(np.arange(len(starts)), 0, done))
    take = max(1, (62 - len(starts).bit_length()) // bits)
    slots = np.arange(len(starts))
    while True:
        tied = ~(head[slots] & np.append(head, True)[slots + 1])
        some = order[slots]
        going = tied & (starts[some] + done <= ends[some])
        slots, some = slots[going], some[going]
        if not len(slots):
            return order, head
        keys = (rank[some] << (take * bits)) | ahead(some, done, take)
        by_key = np.argsort(keys)
        keys, some = keys[by_key], some[by_key]
        new = np.ones(len(slots), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        order[slots], head[slots] = some, new
        rank[some] = np.maximum.accumulate(np.where(new, slots, 0))
        done += take


def suffix_ranks(text: np.ndarray, queue_bytes: int = QUEUE_BYTES) -> np.ndarray:
    """The place of every suffix among all, for numbers from 0 whose last one is unique."""
    text = text.astype(np.int64)
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    # a suffix rises if the next different symbol is larger; the last one counts as rising
    step = np.sign(np.diff(text))
    known = np.append(step, 1)
    at = np.where(known != 0, np.arange(n), n - 1)
    rises = known[np.minimum.accumulate(at[::-1])[::-1]] > 0
    lms = np.zeros(n, dtype=bool)
    lms[1:] = rises[1:] & ~rises[:-1]
    lms[n - 1] = True
    starts = np.flatnonzero(lms)

    # name the LMS substrings, each up to and including the next LMS position
    symbol = 2 * text + rises + 1
    order, head = _by_substrings(symbol, starts, np.append(starts[1:], n - 1))
    names = np.cumsum(head) - 1
    if names[-1] + 1 < len(starts):
        named = np.empty(len(starts), dtype=np.int64)
        named[order] = names
        order = np.empty(len(starts), dtype=np.int64)
        order[suffix_ranks(named, queue_bytes)] = np.arange(len(starts))
    seeds = starts[order]

    # places: each symbol's bucket holds its falling suffixes, then its rising ones
    size = np.bincount(text)
    falling = np.bincount(text[~rises], minlength=len(size))
    bucket = np.cumsum(size) - size
    share = max(1, n // RANGES)
    range_of = np.cumsum(size) // share  # symbols of a range are neighbours
    edges = np.flatnonzero(np.concatenate([[True], range_of[1:] != range_of[:-1]]))
    range_of = np.searchsorted(edges, np.arange(len(size)), "right") - 1
    low, high = edges, np.append(edges[1:], len(size)) - 1
    out = np.empty(n, dtype=np.int64)

    seed_symbol = text[seeds]
    first = np.searchsorted(seed_symbol, seed_symbol)
    seed_rank = bucket[seed_symbol] + falling[seed_symbol] + np.arange(len(seeds)) - first
    seed_cut = np.searchsorted(range_of[seed_symbol], np.arange(len(edges) + 1))
    queues = Queues(len(edges), queue_bytes)
    falls = ~rises
    ranked: list[np.ndarray] = []
    for r in range(len(edges)):
        popped, rank = queues.pop(r)
        some = slice(seed_cut[r], seed_cut[r + 1])
        position, known, parent = _members(
            popped, rank, seeds[some], seed_rank[some], text, falls, low[r], high[r]
        )
        symbols = text[position]
        order = _rank_range(symbols - low[r], known, parent, bucket[text[position[parent]]])
        position, symbols = position[order], symbols[order]
        place = bucket[symbols] + np.arange(len(order)) - np.searchsorted(symbols, symbols)
        out[position] = place
        ranked.append(position)
        source = np.concatenate([position, seeds[some]])
        rank = np.concatenate([place, seed_rank[some]])
        before = source - 1
        good = (before >= 0) & falls[before] & (text[before] > high[r])
        queues.push(range_of[text[before[good]]], before[good], rank[good])

    queues = Queues(len(edges), queue_bytes)
    rising = bucket + falling
    final = np.zeros(0, dtype=np.int64)
    for r in range(len(edges) - 1, -1, -1):
        popped, rank = queues.pop(r)
        source = ranked.pop()
        if low[r] <= text[n - 1] <= high[r]:  # nothing follows the last suffix
            final = np.array([n - 1])
            out[n - 1] = rising[text[n - 1]]
            source = np.concatenate([source, final])
        else:
            final = np.zeros(0, dtype=np.int64)
        position, known, parent = _members(
            popped, rank, source, out[source], text, rises, low[r], high[r]
        )
        symbols = text[position]
        order = _rank_range(symbols - low[r], known, parent, rising[text[position[parent]]])
        position, symbols = position[order], symbols[order]
        place = rising[symbols] + np.arange(len(order)) - np.searchsorted(symbols, symbols)
        out[position] = place
        source = np.concatenate([source, position])
        before = source - 1
        good = (before >= 0) & rises[before] & (text[before] < low[r])
        queues.push(range_of[text[before[good]]], before[good], out[source[good]])
    return out


def window_classes(
    raw: np.ndarray, borders: np.ndarray, length: int, queue_bytes: int = QUEUE_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """(position, class) of the windows of `length` bytes that occur twice or more.

    `borders` are those of the strings that `raw` consists of; windows don't cross them.
    """
    strings = len(borders) - 1
    # every string ends with a symbol of its own, smaller than all bytes
    text = np.empty(len(raw) + strings, dtype=np.int64)
    owner = np.repeat(np.arange(strings), np.diff(borders))
    at = np.arange(len(raw)) + owner
    text[at] = raw.astype(np.int64) + strings
    text[borders[1:] + np.arange(strings)] = np.arange(strings)
    ranks = suffix_ranks(text, queue_bytes)[at]
    room = borders[1:][owner] - np.arange(len(raw)) >= length
    position = np.flatnonzero(room)
    position = position[np.argsort(ranks[position])]
    # windows of one class are neighbours, with nothing shorter between them
    words = np.zeros(len(raw) + 8, dtype=np.uint64)
    words[: len(raw)] = raw
    for step in (1, 2, 4):
        words[:-step] |= words[step:] << np.uint64(8 * step)
    same = np.arange(1, len(position))
    for k in range(0, length, 8):
        k = max(0, min(k, length - 8))
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) if length >= 8 else np.uint64((1 << 8 * length) - 1)
        a, b = words[position[same - 1] + k] & mask, words[position[same] + k] & mask
        same = same[a == b]
    joined = np.zeros(len(position), dtype=bool)
    joined[same] = True
    number = np.cumsum(~joined)
    keep = joined.copy()
    keep[:-1] |= joined[1:]
    return position[keep], number[keep]
