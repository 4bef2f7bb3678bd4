"""Suffix array by linear grouping (the first linear-time construction without recursion, U. Baier, 2016).

Phase 1 sorts the suffixes into groups of equal Lyndon prefix. It starts with groups of equal first letter and takes the groups
from the last to the first. Every suffix of a group points to the previous suffix of a smaller group; suffixes that are pointed to
move behind their group, those with more pointers further.

Phase 2 walks over the suffix array from its start: the suffix before each finished one, and the previous smaller suffixes of
that, are next in their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Positions of all suffixes in ascending order. ``text`` holds small non-negative integers; a suffix that is the
    beginning of another one comes first."""
    n = len(text)
    if not n:
        return []
    order = np.argsort(text, kind="stable")
    letters = text[order]
    starts = np.nonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))[0]
    sizes = np.diff(np.append(starts, n))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    in_group = np.empty(n, np.int64)
    in_group[order] = np.repeat(starts, sizes)
    row, place, group = order.tolist(), place.tolist(), in_group.tolist()
    size = [0] * n
    for a, b in zip(starts.tolist(), sizes.tolist()):
        size[a] = b
    previous = [-1] * n

    end = n
    while end > 0:
        start = group[row[end - 1]]
        pointed: dict[int, int] = {}
        members = row[start:end]
        members.sort()
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            most = max(pointed.values())
            if most == 1:
                _split(list(pointed), row, place, group, size)
            else:
                by_number: dict[int, list[int]] = {}
                for j, k in pointed.items():
                    by_number.setdefault(k, []).append(j)
                for k in sorted(by_number, reverse=True):
                    _split(by_number[k], row, place, group, size)
        end = start

    out, following, done = [0] * n, list(range(n)), [False] * n
    # the suffix of the last position is followed by nothing, which is smaller than any letter
    s = n - 1
    while s >= 0:
        g = group[s]
        out[following[g]] = s
        following[g] += 1
        done[s] = True
        s = previous[s]
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[following[g]] = s
            following[g] += 1
            done[s] = True
            s = previous[s]
    return out


def _split(moved: list[int], row: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Takes suffixes out of their groups into new groups right behind what is left of them."""
    touched = set()
    for j in moved:
        g = group[j]
        touched.add(g)
        size[g] -= 1
        last = g + size[g]
        at, other = place[j], row[last]
        row[at], row[last] = other, j
        place[other], place[j] = at, last
    new = {g: g + size[g] for g in touched}
    for j in moved:
        g = new[group[j]]
        group[j] = g
        size[g] += 1
