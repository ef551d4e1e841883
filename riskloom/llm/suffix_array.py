"""Suffix array by grouping, without recursion or renaming.

Phase 1 sorts the suffixes into groups, each holding the suffixes that share their longest Lyndon prefix. Groups
start as the first symbols and are finished from the largest to the smallest: each member points at the
nearest suffix before it in a smaller group; the suffixes pointed at continue with the finished group's prefix, so they leave
their group upwards, those pointed at more often further up.
Phase 2 fills the groups from the left: when a suffix is emitted, the chain of suffixes before it that end
their Lyndon prefix there take the next places of their groups. Both phases take linear time.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. The last symbol must be smaller than all others."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    first = np.argsort(symbols, kind="stable")
    ordered = symbols[first]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    starts = np.flatnonzero(new)
    begin = np.empty(n, np.int64)
    begin[first] = np.repeat(starts, np.diff(np.append(starts, n)))
    where = np.empty(n, np.int64)
    where[first] = np.arange(n)
    room = np.zeros(n, np.int64)
    room[starts] = np.diff(np.append(starts, n))
    group, place, order, size = begin.tolist(), where.tolist(), first.tolist(), room.tolist()
    before = [-2] * n  # nearest earlier suffix in a smaller group; -2 is unknown

    end = n - 1
    while end > 0:
        start = group[order[end]]
        if start == end:  # one member
            s = order[end]
            j = s - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[s] = j
            if j >= 0:
                g = group[j]
                size[g] -= 1
                last = g + size[g]
                if last != g:
                    at = place[j]
                    other = order[last]
                    order[at], place[other] = other, at
                    order[last], place[j] = j, last
                    group[j] = last
                size[last] = 1
            end = start - 1
            continue
        count: dict[int, int] = {}
        for s in sorted(order[start : end + 1]):
            j = s - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[s] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        if count:
            most = max(count.values())
            if most == 1:
                levels = [list(count)]
            else:
                levels = [[] for _ in range(most)]
                for j, c in count.items():
                    levels[most - c].append(j)
            for level in levels:  # pointed at most often first
                moved: dict[int, list[int]] = {}
                for j in level:
                    g = group[j]
                    size[g] -= 1
                    last = g + size[g]
                    at = place[j]
                    if at != last:
                        other = order[last]
                        order[at], place[other] = other, at
                        order[last], place[j] = j, last
                    if g in moved:
                        moved[g].append(j)
                    else:
                        moved[g] = [j]
                for g, members in moved.items():
                    fresh = g + size[g]
                    if fresh != g:
                        for j in members:
                            group[j] = fresh
                    size[fresh] = len(members)
        end = start - 1

    result = [-1] * n
    result[0] = n - 1
    free = list(range(n))  # next place of the group that starts here
    emitted = bytearray(n)
    emitted[n - 1] = 1
    before[n - 1] = -1
    for s in result:  # grows ahead of the loop
        j = s - 1
        while j >= 0 and not emitted[j]:
            emitted[j] = 1
            g = group[j]
            result[free[g]] = j
            free[g] += 1
            j = before[j]
    return np.array(result, np.int64)
