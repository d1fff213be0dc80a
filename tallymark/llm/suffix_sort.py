"""Suffix array and common-prefix values of many short rows by induced sorting.

Rows are laid end to end, each closed by a separator below every byte. Only the S*
suffixes (smaller than their follower, after a larger symbol) are sorted: their
substrings are named in order and the rows of names ranked by doubling. All other
suffixes are induced. A pass over the symbols in rising order takes suffixes from the
queue of each symbol and puts their L-type predecessors into the queue of the
predecessor's symbol; a pass in falling order does the same for S-type ones. What comes
later into a queue is never smaller, so a priority queue over (symbol, rank of the
follower) is one first-in-first-out queue per symbol. Every entry carries the length
of the prefix it shares with the entry before: one more than the least such value
between the two followers.

Queues keep at most `MEMORY` entries in memory together; beyond it they go to a
scratch file, in Spark's own local folders where it runs in a task, which is gone with
the call.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

MEMORY = 1 << 22
PACKED = 7  # symbols of 9 bits in one key
ENTRY = np.dtype([("at", "<i4"), ("shared", "<i4")])


class Queues:
    """One disk-backed first-in-first-out queue of (suffix, shared prefix) per symbol."""

    def __init__(self, symbols: int, folder: str, memory: int = MEMORY):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.file = tempfile.TemporaryFile(dir=folder)
        self.memory, self.held = memory, 0

    def put(self, symbol: int, at: np.ndarray, shared: np.ndarray) -> None:
        entries = np.empty(len(at), ENTRY)
        entries["at"], entries["shared"] = at, shared
        self.parts[symbol].append(entries)
        self.held += len(at)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    self.file.seek(0, os.SEEK_END)
                    parts[i] = (self.file.tell(), len(part))
                    self.file.write(part.tobytes())
        self.held = 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a symbol so far, in order; the queue is empty afterwards."""
        found = []
        for part in self.parts[symbol]:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1] * ENTRY.itemsize), ENTRY)
            else:
                self.held -= len(part)
            found.append(part)
        self.parts[symbol] = []
        entries = np.concatenate(found) if found else np.zeros(0, ENTRY)
        return entries["at"].astype(np.int64), entries["shared"].astype(np.int64)

    def close(self) -> None:
        self.file.close()


def scratch_folder() -> str | None:
    """A local folder of Spark's for this task, or the default one outside of tasks."""
    folders = os.environ.get("SPARK_LOCAL_DIRS", "")
    return folders.split(",")[0] or None


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is S-type; separators are."""
    step = np.sign(np.diff(text.astype(np.int16)))
    changes = np.flatnonzero(step)
    small = np.ones(len(text), bool)
    if len(changes):
        small[: changes[-1] + 1] = np.repeat(step[changes] > 0, np.diff(changes, prepend=-1))
    small[text == 0] = True
    return small


def _runs(text: np.ndarray) -> np.ndarray:
    """How many equal symbols begin at each place."""
    changes = np.append(np.flatnonzero(np.diff(text)), len(text) - 1)
    return np.repeat(changes, np.diff(changes, prepend=-1)) - np.arange(len(text)) + 1


def _refined(names: np.ndarray, rows: np.ndarray, key: np.ndarray) -> bool:
    """Tell rows of equal names apart by a key; whether any were. `rows` holds all of a name or none.

    A name is the number of rows with a smaller one, so the others keep theirs.
    """
    old = names[rows]
    order = np.lexsort((key, old)) if len(names) > len(rows) or old.any() else np.argsort(key)
    old, key = old[order], key[order]
    first = np.ones(len(rows), bool)
    first[1:] = old[1:] != old[:-1]
    new = first.copy()
    new[1:] |= key[1:] != key[:-1]
    place = np.arange(len(rows))
    names[rows[order]] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
    return bool((new & ~first).any())


def _star_ranks(text: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Ranks of the S* suffixes, each up to its separator; equal ones share a rank."""
    sizes = np.append(np.diff(stars), 0) + 1
    sizes[text[stars] == 0] = 1
    names = np.zeros(len(stars), np.int64)
    for at in range(0, int(sizes.max()), PACKED):
        # only names of several substrings, one of which goes on, can still be told apart
        open_ = (np.bincount(names) > 1) & (np.bincount(names, sizes > at) > 0)
        rows = np.flatnonzero(open_[names])
        # a substring that ends sorts after one that goes on: there its last symbol is of L-type
        key = np.zeros(len(rows), np.int64)
        for i in range(at, at + PACKED):
            symbol = text[np.minimum(stars[rows] + i, len(text) - 1)].astype(np.int64)
            key = key << 9 | np.where(i < sizes[rows], symbol, 511)
        _refined(names, rows, key)
    # doubling over the rows of names; the separator, smallest of all, ends a row
    last = np.flatnonzero(text[stars] == 0)
    row_end = np.repeat(last, np.diff(last, prepend=-1))
    names += 1
    names[last] = 0
    step, told = 1, True
    while told and step <= len(stars):
        rows = np.flatnonzero((np.bincount(names) > 1)[names] & (names > 0))
        follow = rows + step
        told = _refined(names, rows, np.where(follow <= row_end[rows], names[np.minimum(follow, len(stars) - 1)], 0))
        step *= 2
    return names


def _shared(text: np.ndarray, left: np.ndarray, right: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffix pairs, up to their separators."""
    # eight bytes from each place on, the first lowest; separators are never inside a compared span
    data = np.append(text.astype(np.uint64), np.zeros(8, np.uint64))
    eight = data[:-8].copy()
    for i in range(1, 8):
        eight |= data[i : i - 8] << np.uint64(8 * i)
    most = np.minimum(row_end[left] - left, row_end[right] - right)
    found = np.zeros(len(left), np.int64)
    rows = np.flatnonzero(most > 0)
    while len(rows):
        apart = eight[left[rows] + found[rows]] ^ eight[right[rows] + found[rows]]
        lowest = apart & (~apart + np.uint64(1))
        found[rows] += np.where(apart == 0, 8, np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3)
        rows = rows[(apart == 0) & (found[rows] < most[rows])]
    return np.minimum(found, most)


def _induce(queues: Queues, symbol: int, wanted: np.ndarray, text: np.ndarray, own: tuple, behind) -> tuple[np.ndarray, np.ndarray]:
    """Put the wanted predecessors of a symbol's entries into their queues.

    `own` are the symbol's entries so far; entries of the same symbol that they lead
    to join them, round by round. Then what `behind` returns for them is scanned as
    well. Returns the symbol's own entries, complete.
    """
    at, shared = own
    begin, past = 0, -1
    while begin < len(at):
        before = at[begin:] - 1
        hit = np.flatnonzero((before >= 0) & wanted[before] & (text[before] == symbol)) + begin
        begin = len(at)
        if len(hit):
            least = _least_between(shared, hit, past)
            past = int(hit[-1])
            at, shared = np.concatenate([at, at[hit] - 1]), np.concatenate([shared, least])
    after_at, after_shared = behind(at)
    scan, values = np.concatenate([at, after_at]), np.concatenate([shared, after_shared])
    before = scan - 1
    hit = np.flatnonzero((before >= 0) & wanted[before])
    hit = hit[text[before[hit]] != symbol]
    order = np.argsort(text[before[hit]], kind="stable")
    hit = hit[order]
    if not len(hit):
        return at, shared
    targets, first = np.unique(text[before[hit]], return_index=True)
    for target, a, b in zip(targets, first, np.append(first[1:], len(hit)), strict=True):
        rows = hit[a:b]
        queues.put(int(target), before[rows], _least_between(values, rows, -1))
    return at, shared


def _least_between(shared: np.ndarray, hit: np.ndarray, past: int) -> np.ndarray:
    """One more than the least value after the previous hit, up to each hit.

    Without a previous hit the follower before came from another symbol: one symbol
    is shared.
    """
    starts = np.append(past, hit[:-1]) + 1
    least = np.minimum.reduceat(shared[: hit[-1] + 1], starts) + 1
    if past < 0:
        least[0] = 1
    return least


def suffix_order(rows: list[bytes], memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes, shared, row ends): places in the laid out rows, in order, without separators.

    shared[i] is the length of the prefix that suffixes i - 1 and i share. A place's
    row is found by its row end, the place of its separator.
    """
    sizes = np.array([len(r) for r in rows], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(sizes.sum() + len(rows)), np.uint16)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(rows), np.uint8).astype(np.uint16) + 1
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), ends
    row_end = np.repeat(ends, sizes + 1)
    small, runs = _types(text), _runs(text)
    star = small & np.append(False, ~small[:-1])
    star[ends] = True
    stars = np.flatnonzero(star)
    stars = stars[np.argsort(_star_ranks(text, stars), kind="stable")]
    star_shared = np.zeros(len(stars), np.int64)
    star_shared[1:] = _shared(np.where(inside, text - 1, 0), stars[:-1], stars[1:], row_end)
    star_symbol = text[stars]
    cuts = np.searchsorted(star_symbol, np.arange(258))

    def met(one: np.ndarray, other: np.ndarray) -> int:
        """Shared prefix where L-type and S-type suffixes of one symbol meet."""
        return int(min(runs[one[-1]], runs[other[0]])) if len(one) and len(other) else 0

    folder = scratch_folder()
    rising, falling = Queues(257, folder, memory), Queues(257, folder, memory)
    large: list = []

    def stars_behind(symbol: int):
        def behind(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rows = slice(cuts[symbol], cuts[symbol + 1])
            values = star_shared[rows].copy()
            if len(values):
                values[0] = met(at, stars[rows])
            return stars[rows], values

        return behind

    sorted_large = Queues(257, folder, memory)
    for symbol in range(257):
        own = _induce(rising, symbol, ~small, text, rising.take(symbol), stars_behind(symbol))
        sorted_large.put(symbol, *own)
    rising.close()
    place = small & inside

    def large_behind(symbol: int):
        def behind(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found, values = sorted_large.take(symbol)
            large.append((found, values))
            # falling: entry i shares with the one above it
            down = np.append(0, values[:0:-1]) if len(values) else values
            if len(found):
                down[0] = met(at, found[::-1])
            return found[::-1], down

        return behind

    order: list[tuple[np.ndarray, np.ndarray]] = []
    for symbol in range(256, 0, -1):
        at, shared = _induce(falling, symbol, place, text, falling.take(symbol), large_behind(symbol))
        found, values = large.pop()
        up = np.append(met(found, at[::-1]), shared[:0:-1]) if len(at) else shared
        if len(values):
            values = np.append(0, values[1:])
        order.append((np.concatenate([found, at[::-1]]), np.concatenate([values, up])))
    falling.close()
    sorted_large.close()
    order.reverse()
    return np.concatenate([o[0] for o in order]), np.concatenate([o[1] for o in order]), row_end
