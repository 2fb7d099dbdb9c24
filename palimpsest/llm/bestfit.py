"""Best-fit-decreasing over a balanced tree of remaining capacities."""

from __future__ import annotations

from collections.abc import Iterable


class CapacityTree:
    """A treap of (remaining capacity, bin): the tightest bin that fits in O(log bins)."""

    def __init__(self) -> None:
        self._root: list | None = None
        self._seed = 0x9E3779B97F4A7C15

    def _priority(self) -> int:
        self._seed = (self._seed * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF
        return self._seed >> 20

    @staticmethod
    def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below `key`, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = CapacityTree._split(node[3], key)
            node[3] = low
            return node, high
        low, high = CapacityTree._split(node[2], key)
        node[2] = high
        return low, node

    @staticmethod
    def _merge(a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = CapacityTree._merge(a[3], b)
            return a
        b[2] = CapacityTree._merge(a, b[2])
        return b

    def add(self, remaining: int, which: int) -> None:
        key = (remaining, which)
        low, high = self._split(self._root, key)
        self._root = self._merge(self._merge(low, [key, self._priority(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity of at least `size`."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        found = node[0]
        _, rest = self._split(high, (found[0], found[1] + 1))
        self._root = self._merge(low, rest)
        return found


#: Where the items of one size go: (bin, how many), in the order in which bins took them.
Runs = list[tuple[int, int]]


def best_fit_decreasing(counts: Iterable[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[tuple[int, Runs]], list[int]] | None:
    """Pack indivisible items, given as (size, number), largest first, each into the tightest bin that holds it.

    A bin that took an item is still the tightest that holds another of that size, if it
    holds one at all; so it takes as many as it can at once, and the work is by distinct
    size. Returns the runs of each size and what each bin holds. Ties go by bin number, so
    the result is a function of the sizes alone. None if more than `most` bins are needed;
    an item above `capacity` is an error.
    """
    tree, loads, where = CapacityTree(), [], []
    for size, left in sorted(counts, reverse=True):
        if size > capacity:
            raise ValueError(f"an item of size {size} exceeds the capacity {capacity}")
        runs: Runs = []
        while left:
            found = tree.take(size)
            if found is None:
                if len(loads) == most:
                    return None
                found = (capacity, len(loads))
                loads.append(0)
            room, which = found
            n = min(left, room // size)
            runs.append((which, n))
            loads[which] += n * size
            left -= n
            tree.add(room - n * size, which)
        where.append((size, runs))
    return where, loads


def near_equal(counts: Iterable[tuple[int, int]], bins: int) -> list[tuple[int, Runs]]:
    """Best-fit-decreasing of (size, number) at the least capacity found that needs no more than `bins` bins.

    An item above the fair share gets a bin of its own, and the fair share of the other
    bins is worked out without it; then the capacity rises from the fair share in small
    relative steps until everything fits.
    """
    left = [[s, n] for s, n in sorted(counts, reverse=True) if n]
    total, alone = sum(s * n for s, n in left), []
    while left and bins - len(alone) > 1 and left[0][0] * (bins - len(alone)) > total:
        alone.append(left[0][0])
        total -= left[0][0]
        left[0][1] -= 1
        if not left[0][1]:
            left.pop(0)
    out: dict[int, Runs] = {}
    for k, size in enumerate(alone):
        out.setdefault(size, []).append((k, 1))
    if left:
        rest = bins - len(alone)
        fair, step = max(-(-total // rest), left[0][0]), 0.0
        while (found := best_fit_decreasing(map(tuple, left), int(fair * (1 + step)) + (step > 0), rest)) is None:
            step = step * 1.5 if step else 1 / 65536
        for size, runs in found[0]:
            out.setdefault(size, []).extend((len(alone) + b, n) for b, n in runs)
    return sorted(out.items(), reverse=True)
