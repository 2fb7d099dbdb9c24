"""A grouping genetic algorithm for bin packing over a histogram of sizes.

Only sizes matter to a packing, so an individual is a list of bin patterns with the number
of bins that follow each. Its size depends on the capacity alone, not on the items: a
histogram of at most `capacity` sizes stands for any number of documents.
"""

from __future__ import annotations

import bisect
import json
import random

#: A pattern: (size, copies) pairs, largest size first.
Pattern = tuple[tuple[int, int], ...]
Solution = dict[Pattern, int]


def fill(pattern: Pattern) -> int:
    return sum(s * k for s, k in pattern)


def bins(solution: Solution) -> int:
    return sum(solution.values())


def fitness(solution: Solution, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then the mean squared fill, which rewards full bins beside empty ones."""
    n = bins(solution)
    return (-n, sum(m * (fill(p) / capacity) ** 2 for p, m in solution.items()) / max(1, n))


def _with(pattern: Pattern, size: int, copies: int) -> Pattern:
    held = dict(pattern)
    held[size] = held.get(size, 0) + copies
    return tuple(sorted(held.items(), reverse=True))


def best_fit(counts: dict[int, int], capacity: int, start: Solution | None = None, order: list[int] | None = None) -> Solution:
    """Put every item into the tightest bin that holds it, many equal bins at a time.

    Sizes go in `order`, largest first by default. Equal bins take items of one size
    together; the last of them may take fewer.
    """
    by_room: dict[int, dict[Pattern, int]] = {}
    rooms: list[int] = []

    def put(pattern: Pattern, n: int) -> None:
        room = capacity - fill(pattern)
        held = by_room.get(room)
        if held is None:
            held = by_room[room] = {}
            bisect.insort(rooms, room)
        held[pattern] = held.get(pattern, 0) + n

    for p, n in (start or {}).items():
        put(p, n)
    for size in order or sorted(counts, reverse=True):
        left = counts.get(size, 0)
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left >= each:
                    put(((size, each),), left // each)
                if left % each:
                    put(((size, left % each),), 1)
                break
            room = rooms[at]
            held = by_room[room]
            pattern = next(iter(held))
            n = held.pop(pattern)
            if not held:
                del by_room[room]
                rooms.pop(at)
            each = min(room // size, left)
            take = min(n, left // each)
            put(_with(pattern, size, each), take)
            if n > take:
                put(pattern, n - take)
            left -= each * take
    out: Solution = {}
    for held in by_room.values():
        for p, n in held.items():
            out[p] = out.get(p, 0) + n
    return out


def cross(a: Solution, b: Solution, counts: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """Inject whole well-filled bins of `b` into `a`, remove duplicates, best-fit the displaced.

    The injected bins use up items; bins of `a` that would need items already used are
    dissolved, fullest bins kept first; whatever no kept bin holds is best-fitted.
    """
    left = dict(counts)
    child: Solution = {}

    def keep(pattern: Pattern, n: int) -> None:
        n = min([n, *(left[s] // k for s, k in pattern)])
        if n > 0:
            for s, k in pattern:
                left[s] -= n * k
            child[pattern] = child.get(pattern, 0) + n

    best = sorted(b.items(), key=lambda x: (-fill(x[0]), x[0]))
    for p, n in best[: max(1, len(best) // 2)]:
        if rng.random() < 0.5:
            keep(p, rng.randint(1, n))
    for p, n in sorted(a.items(), key=lambda x: (-fill(x[0]), x[0])):
        keep(p, n)
    return best_fit({s: n for s, n in left.items() if n}, capacity, child)


def mutate(a: Solution, capacity: int, rng: random.Random) -> Solution:
    """Dissolve the worst-filled bins and some others, and best-fit their items in a shaken order."""
    kept, loose = {}, {}
    worst = {p for p, _ in sorted(a.items(), key=lambda x: (fill(x[0]), x[0]))[: max(2, len(a) // 50)]}
    for p, n in a.items():
        out = n if p in worst else sum(1 for _ in range(min(n, 3)) if rng.random() < 0.05)
        if n > out:
            kept[p] = n - out
        for s, k in p if out else ():
            loose[s] = loose.get(s, 0) + k * out
    order = sorted(loose, key=lambda s: -s * (1 + 0.1 * rng.random()))
    return best_fit(loose, capacity, kept, order)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: total size, and items above half a bin with what can't join them."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for k in sorted({s for s in counts if s <= capacity // 2} | {0}):
        big = sum(n for s, n in counts.items() if s > capacity - k)
        half = {s: n for s, n in counts.items() if capacity // 2 < s <= capacity - k}
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity // 2 and s)
        room = sum(half.values()) * capacity - sum(s * n for s, n in half.items())
        best = max(best, big + sum(half.values()) + max(0, -(-(small - room) // capacity)))
        if k > capacity // 4:
            break
    return best


def evolve(counts: dict[int, int], capacity: int, population: list[Solution], generations: int, seed: int, size: int = 8, bound: int | None = None) -> list[Solution]:
    """An island's epoch: one generation at least, and no more once a solution meets `bound`, which nothing can beat."""
    rng = random.Random(seed)
    goal = lower_bound(counts, capacity) if bound is None else bound
    people = list(population) or [best_fit(counts, capacity)]
    rank = lambda s: fitness(s, capacity)
    while len(people) < size:
        people.append(mutate(people[0], capacity, rng))
    for age in range(generations):
        people.sort(key=rank, reverse=True)
        if age and bins(people[0]) <= goal:
            break
        children = []
        for _ in range(size // 2):
            a, b = (max(rng.sample(people, 2), key=rank) for _ in range(2))
            child = cross(a, b, counts, capacity, rng)
            children.append(mutate(child, capacity, rng) if rng.random() < 0.5 else child)
        people = sorted(people + children, key=rank, reverse=True)[:size]
    return sorted(people, key=rank, reverse=True)


def dump(solution: Solution) -> str:
    return json.dumps([[list(map(list, p)), n] for p, n in sorted(solution.items())])


def load(text: str) -> Solution:
    return {tuple((s, k) for s, k in p): n for p, n in json.loads(text)}
