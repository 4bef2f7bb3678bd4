"""Bin packing by bin completion: branch and bound over what is put beside the largest item.

Items are given as counts by size, so equal items are packed together however many there are. At every node the largest size left
is completed by fillings of the rest of its bin, the ones with least waste first. A filling is left out if another one dominates it,
that is, if its items can be put into the other's items as into bins. A filling is used for as many bins as the counts allow, then
for fewer. Branches end where the waste so far cannot lead to fewer bins than the best solution known; best-fit decreasing
gives the first one, and others from the nodes met on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

#: (number of bins, ((size, how often), ...)): bins that are filled alike.
Pattern = tuple[int, tuple[tuple[int, int], ...]]
#: Fillings tried in a node and looked at for these, nodes in all, and nodes between two best-fit completions.
WIDTH, LOOKED, NODES, EVERY = 24, 500, 3000, 50
#: Up to so many items all ways of putting them into others are tried.
TRIED_ITEMS = 8


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: every item, the largest first, goes into the fullest bin that takes it."""
    gaps: dict[int, list[list]] = {}        # gap -> [[bins, filling], ...]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            gap = min((g for g in gaps if g >= size), default=None)
            bins, filling = gaps[gap].pop() if gap is not None else (left, ())
            room = capacity if gap is None else gap
            if gap is not None and not gaps[gap]:
                del gaps[gap]
            each = min(room // size, left)
            used = min(bins, left // each)
            gaps.setdefault(room - each * size, []).append([used, (*filling, (size, each))])
            left -= used * each
            if gap is not None and used < bins:
                gaps.setdefault(room, []).append([bins - used, filling])
    return [(bins, filling) for groups in gaps.values() for bins, filling in groups]


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: large items need a bin each, what does not fit beside them needs more."""
    best = 0
    for k in {0, *(s for s in counts if 2 * s <= capacity)}:
        alone = sum(n for s, n in counts.items() if s > capacity - k)
        half = [(s, n) for s, n in counts.items() if capacity / 2 < s <= capacity - k]
        free = sum(n * (capacity - s) for s, n in half)
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        best = max(best, alone + sum(n for _, n in half) + max(0, -(-(small - free) // capacity)))
    return best


def _fits_into(items: list[int], bins: list[int]) -> bool:
    """Whether the items (falling) can be put into bins of these sizes; for many items whether first-fit can do it."""
    rooms = list(bins)
    for size in items:
        k = next((k for k, room in enumerate(rooms) if room >= size), None)
        if k is None:
            break
        rooms[k] -= size
    else:
        return True
    if len(items) > TRIED_ITEMS:
        return False
    tried = set()
    for k, room in enumerate(bins):
        if room >= items[0] and room not in tried:
            tried.add(room)
            if _fits_into(items[1:], [*bins[:k], room - items[0], *bins[k + 1:]]):
                return True
    return False


def _flat(filling: tuple[tuple[int, int], ...]) -> list[int]:
    return [s for s, n in filling for _ in range(n)]


def _with_sum(sizes: list[int], counts: dict[int, int], reach: list[int], at: int, target: int) -> Iterator[tuple]:
    """Fillings of just this sum from the sizes up to place ``at``, larger items first."""
    if not target:
        yield ()
        return
    while at >= 0 and reach[at + 1] >> target & 1:
        size = sizes[at]
        for n in range(min(counts[size], target // size), 0, -1):
            if reach[at] >> (target - n * size) & 1:
                for rest in _with_sum(sizes, counts, reach, at - 1, target - n * size):
                    yield ((size, n), *rest)
        at -= 1


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, tuple]]:
    """(waste, filling) of the undominated fillings of a room that waste no more than given, the least waste first."""
    sizes = sorted(s for s, n in counts.items() if n and s <= room)
    reach = [1]                             # bit k: some items of the sizes so far sum up to k
    mask = (1 << (room + 1)) - 1
    for s in sizes:
        sums, left, step = reach[-1], min(counts[s], room // s), 1
        while left:
            n = min(step, left)
            sums |= sums << (n * s) & mask
            left, step = left - n, step * 2
        reach.append(sums)
    found: list[list[int]] = []
    looked = 0
    for lost in range(min(waste, room) + 1):
        if not reach[-1] >> (room - lost) & 1:
            continue
        for filling in _with_sum(sizes, counts, reach, len(sizes) - 1, room - lost):
            looked += 1
            items = _flat(filling)
            if not any(_fits_into(items, other) for other in found):
                found.append(items)
                yield lost, filling
            if len(found) == WIDTH or looked == LOOKED:
                return


def _taken(counts: dict[int, int], largest: int, filling: tuple, bins: int) -> dict[int, int]:
    out = dict(counts)
    for size, n in ((largest, 1), *filling):
        out[size] -= n * bins
        if not out[size]:
            del out[size]
    return out


def _merged(largest: int, filling: tuple) -> tuple:
    return ((largest, 1 + filling[0][1]), *filling[1:]) if filling and filling[0][0] == largest else ((largest, 1), *filling)


def _choices(counts: dict[int, int], capacity: int, slack: int, after: tuple | None) -> Iterator[tuple]:
    """(waste, filling, bins) for the largest size. Bins of one largest size are filled in the order of their fillings: what follows
    takes fillings behind ``after`` only, so no set of bins is met twice."""
    largest = max(counts)
    for lost, filling in fillings(counts | {largest: counts[largest] - 1}, capacity - largest, slack):
        if after is not None and after[0] == largest and (lost, filling) in after[1]:
            continue
        items = dict(_merged(largest, filling))
        most = min(counts[s] // n for s, n in items.items())
        if lost:
            most = min(most, slack // lost)
        bins = most
        while bins:
            yield lost, filling, bins
            bins = bins // 2 if bins > 8 else bins - 1


def complete(counts: dict[int, int], capacity: int, nodes: int | None = None) -> list[Pattern]:
    """Bins for all items, as few as were found; at most ``nodes`` nodes are looked at."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("sizes must lie between 1 and the capacity")
    total, bound = sum(s * n for s, n in counts.items()), least_bins(counts, capacity)
    best = best_fit(counts, capacity)
    fewest, own = sum(n for n, _ in best), False
    nodes = NODES if nodes is None else nodes
    # a frame: what is left, bins and waste so far, its choices, and the fillings of this largest size that are done with
    path: list[Pattern] = []
    frames = [(counts, 0, 0, None, None, set())]
    while frames and nodes > 0:
        left, used, wasted, choices, after, done = frames[-1]
        # until the search has a solution of its own, one as good as best-fit's is welcome
        slack = (fewest - own) * capacity - total - wasted
        if choices is None:
            choices = _choices(left, capacity, slack, after)
            frames[-1] = (left, used, wasted, choices, after, done)
        choice = next(choices, None) if slack >= 0 else None
        while choice is not None and choice[0] * choice[2] > slack:
            choice = next(choices, None)
        if choice is None:
            frames.pop()
            if path:
                path.pop()
            continue
        nodes -= 1
        lost, filling, bins = choice
        largest = max(left)
        done.add((lost, filling))
        rest = _taken(left, largest, filling, bins)
        path.append((bins, _merged(largest, filling)))
        used, wasted = used + bins, wasted + lost * bins
        if not rest:
            if used < fewest or not own:
                best, fewest, own = list(path), used, True
            path.pop()
            if fewest == bound:
                break
            continue
        if nodes % EVERY == 0:
            tail = best_fit(rest, capacity)
            if used + sum(n for n, _ in tail) < fewest:
                best, own = path + tail, True
                fewest = sum(n for n, _ in best)
        frames.append((rest, used, wasted, None, (largest, set(done)), set(done) if max(rest) == largest else set()))
    return best
