"""Packing plan for integer lengths by a linear grouping scheme, worked out on the histogram of lengths.

1. Lengths above ``capacity / 4`` are *large*. In descending order they are cut into groups of equal cardinality, and
   each group is rounded up to its largest length: few sizes remain.
2. Configurations of rounded sizes that fill a sequence are optimised as a linear program by column generation (a
   configuration holds at most three large lengths, so the best column is found exactly), and their counts rounded down.
3. Actual lengths take the slots of their group, which frees the rounding again.
4. What is left of the large ones and all small ones are placed best fit, longest first, into the tightest sequence.

The histogram has at most ``capacity`` entries whatever the number of documents, and sequences are handled as runs of
equal ones, so time and memory of the plan do not grow with the data. A plan row says: the documents of this length with
ranks [rank, rank + count) go to sequences [sequence, sequence + count), one each, at this offset.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np

GROUPS = 192
#: Columns at most; the method is right with any number, only less tight.
MAX_COLUMNS = 4_000


class Plan:
    def __init__(self, capacity: int, histogram: dict[int, int]):
        if any(not 0 < n <= capacity for n in histogram):
            raise ValueError(f"lengths must be 1 to {capacity}")
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, rank, count, sequence, offset
        self.used: dict[int, int] = defaultdict(int)
        self.open: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # free tokens -> (first sequence, count)
        left = {n: c for n, c in histogram.items() if c}
        if capacity in left:
            self._fill([(capacity, 1)], left.pop(capacity))
        large = {n: c for n, c in left.items() if n * 4 > capacity}
        for slots, count in configurations(capacity, large):
            self._substitute(slots, count, left)
        for n in sorted(left, reverse=True):
            if left[n]:
                self._best_fit(n, left[n])
        self.rows.sort()

    def _place(self, length: int, first: int, count: int, offset: int) -> None:
        self.rows.append((length, self.used[length], count, first, offset))
        self.used[length] += count

    def _fill(self, items: list[tuple[int, int]], count: int) -> None:
        """``count`` new sequences, each with these (length, times)."""
        first, at = self.sequences, 0
        self.sequences += count
        for length, times in items:
            for _ in range(times):
                self._place(length, first, count, at)
                at += length
        if at < self.capacity:
            self.open[self.capacity - at].append((first, count))

    def _substitute(self, slots: list[tuple[list[int], int]], count: int, left: dict[int, int]) -> None:
        """Give the slots of ``count`` configurations, (lengths of the group, slots), to actual lengths."""
        while count:
            run, items = count, defaultdict(int)
            for lengths, times in slots:
                heads = [n for n in lengths if left[n]]
                if left[heads[0]] >= times:
                    items[heads[0]] += times
                    run = min(run, left[heads[0]] // times)
                else:
                    run = 1
                    for n in heads:
                        take = min(times, left[n])
                        items[n] += take
                        times -= take
                        if not times:
                            break
            for n, times in items.items():
                left[n] -= times * run
            self._fill([*items.items()], run)
            count -= run

    def _best_fit(self, length: int, count: int) -> None:
        while count:
            free = next((f for f in range(length, self.capacity) if self.open.get(f)), None)
            if free is None:
                per = self.capacity // length
                if count >= per:
                    self._fill([(length, per)], count // per)
                if count % per:
                    self._fill([(length, count % per)], 1)
                return
            first, n = self.open[free].popleft()
            per = min(free // length, count)
            run = min(n, count // per)
            if run < n:
                self.open[free].appendleft((first + run, n - run))
            for k in range(per):
                self._place(length, first, run, self.capacity - free + k * length)
            count -= per * run
            if free - per * length:
                self.open[free - per * length].append((first, run))


def configurations(capacity: int, large: dict[int, int], groups: int = GROUPS):
    """Yield ([(lengths of a group, slots), ...], whole count) for the rounded-down optimum over rounded sizes.

    A length that holds more than a group's cardinality makes a group by itself, so a group's lengths are never shared
    between groups."""
    if not large:
        return
    quota = -(-sum(large.values()) // groups)
    parts: list[list[int]] = []
    filled = quota
    for n in sorted(large, reverse=True):
        if filled + large[n] > quota:
            parts.append([])
            filled = 0
        parts[-1].append(n)
        filled += large[n]
    sizes = np.array([p[0] for p in parts])  # rounded up to the largest
    demand = np.array([sum(large[n] for n in p) for p in parts], float)
    k = len(parts)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    for _ in range(MAX_COLUMNS):
        column = _best_column(inverse.sum(axis=0), sizes, capacity)
        if column is None:
            break
        direction, level = inverse @ column, inverse @ demand
        ratio = np.where(direction > 1e-12, level / np.where(direction > 1e-12, direction, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    for j, x in enumerate(np.linalg.solve(basis, demand)):
        whole = int(np.floor(x + 1e-7))
        if whole > 0:
            yield [(parts[i], int(basis[i, j])) for i in range(k) if basis[i, j]], whole


def _best_column(price: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray | None:
    """The configuration of up to three sizes with the largest price, if that is above 1."""
    best, which = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i in np.argsort(price):
        if price[i] > 0:
            better = price[i] > best[sizes[i]:]
            best[sizes[i]:][better] = price[i]
            which[sizes[i]:][better] = i
    room = capacity - sizes[:, None] - sizes[None, :]
    pairs = np.where(room >= 0, price[:, None] + price[None, :] + best[np.maximum(room, 0)], -np.inf)
    singles = price + best[capacity - sizes]
    a, b = np.unravel_index(pairs.argmax(), pairs.shape)
    column = np.zeros(len(sizes))
    if pairs[a, b] >= singles.max():
        value, picks = pairs[a, b], [a, b, which[room[a, b]]]
    else:
        a = int(singles.argmax())
        value, picks = singles[a], [a, which[capacity - sizes[a]]]
    if value <= 1 + 1e-9:
        return None
    for i in picks:
        if i >= 0:
            column[i] += 1
    return column
