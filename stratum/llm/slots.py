"""Bin plans over a histogram of sizes, and handing their places to rows.

Sizes are whole numbers up to the capacity, so a multiset of any number of
pieces is a histogram of at most ``capacity`` counts.  A plan works on runs:
``count`` equal pieces go to ``count`` consecutive bins that have the same
room, in one step.  Its length is bounded by the capacity, not by the number
of pieces, and its result equals placing the pieces one by one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


class RoomTree:
    """A segment tree over capacities: the smallest room that fits, in log(capacity) steps.

    Leaf ``r`` tells whether a run of bins with exactly ``r`` free places is open.
    """

    def __init__(self, capacity: int):
        self.width = 1 << max(1, capacity.bit_length())
        self.any = bytearray(2 * self.width)

    def mark(self, room: int, present: bool) -> None:
        i = room + self.width
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def least(self, size: int) -> int | None:
        """The smallest marked room of at least ``size``."""
        i = size + self.width
        if self.any[i]:
            return size
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.width
            i //= 2
        return None


@dataclass
class Plan:
    """Runs of places: ranks ``first .. first + count`` of ``size`` go to bins ``bin ..`` at ``offset``."""

    capacity: int
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # size, first, count, bin, offset
    bins: int = 0
    used: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        self.tree = RoomTree(self.capacity)
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> runs of bins (first, count)

    def _place(self, size: int, first_bin: int, count: int, offset: int) -> None:
        rank = self.used.get(size, 0)
        self.runs.append((size, rank, count, first_bin, offset))
        self.used[size] = rank + count

    def _leave(self, room: int, first_bin: int, count: int) -> None:
        if room and count:
            self.open.setdefault(room, []).append((first_bin, count))
            self.tree.mark(room, True)

    def new_bins(self, sizes: tuple[int, ...], count: int) -> None:
        """``count`` new bins, each with pieces of these sizes."""
        if not count:
            return
        at = 0
        for size in sizes:
            self._place(size, self.bins, count, at)
            at += size
        self._leave(self.capacity - at, self.bins, count)
        self.bins += count

    def best_fit(self, size: int, count: int) -> None:
        """Place ``count`` pieces of a size, each where the least room stays; open bins for the rest."""
        while count and (room := self.tree.least(size)) is not None:
            first, there = self.open[room].pop()
            n = min(count, there)
            if there > n:
                self.open[room].append((first + n, there - n))
            if not self.open[room]:
                self.tree.mark(room, False)
            self._place(size, first, n, self.capacity - room)
            self._leave(room - size, first, n)
            count -= n
        each = self.capacity // size
        self.new_bins((size,) * each, count // each)
        self.new_bins((size,) * (count % each), int(count % each > 0))

    def arrays(self) -> dict[str, np.ndarray]:
        """The runs in the order of size and rank, for lookups."""
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 5)
        return {"key": (runs[:, 0] << RANK_BITS) + runs[:, 1], "first": runs[:, 1], "bin": runs[:, 3], "offset": runs[:, 4]}


RANK_BITS = 48


def best_fit_decreasing(sizes: dict[int, int], capacity: int) -> Plan:
    plan = Plan(capacity)
    for size in sorted(sizes, reverse=True):
        plan.best_fit(size, sizes[size])
    return plan


def match_large(sizes: dict[int, int], capacity: int) -> Plan:
    """Large-item matching: of pieces above a third of the capacity, two at most share a bin.

    From the largest down, each is paired with the largest other one that
    still fits (for two to a bin this greedy rule needs the fewest bins); the
    smaller pieces, from the largest down, then go where the least room stays.
    """
    plan = Plan(capacity)
    left = {s: n for s, n in sizes.items() if 3 * s > capacity and n}
    order = sorted(left, reverse=True)
    for size in order:
        for other in order:  # descending: the first that fits is the largest
            n = left[size]
            if not n:
                break
            if other > size or other + size > capacity or not left[other]:
                continue
            pairs = n // 2 if other == size else min(n, left[other])
            plan.new_bins((size, other), pairs)
            left[size] -= pairs
            left[other] -= pairs
        plan.new_bins((size,), left[size])
        left[size] = 0
    for size in sorted((s for s in sizes if 3 * s <= capacity), reverse=True):
        plan.best_fit(size, sizes[size])
    return plan


def place(runs: dict[str, np.ndarray], size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of the pieces with these sizes and ranks."""
    at = np.searchsorted(runs["key"], (size << RANK_BITS) + rank, side="right") - 1
    return runs["bin"][at] + rank - runs["first"][at], runs["offset"][at]
