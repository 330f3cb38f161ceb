"""Linear suffix array construction by grouping."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of whole numbers of which the last is smaller than all others.

    First suffixes are grouped by their first symbol. Groups are processed in
    descending order; when a group's turn comes, its members share their Lyndon
    prefix. For each member the previous smaller suffix is found by following
    pointers of members already done. A suffix to which l members of the group
    point is longer by l copies of their prefix: for l in descending order, such
    suffixes leave their group and become a new one right above it. After the
    lowest group all suffixes are grouped by Lyndon prefix, in order. A second
    pass from the smallest suffix on then emits each group's order: the suffix
    before the one just read, and what its pointers lead to, take the next free
    place of their groups. No string is renamed and nothing recurses.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.searchsorted(ranked, ranked)
    members = order.tolist()  # groups side by side, each from its start on
    group = np.empty(n, dtype=np.int64)
    group[order] = first
    group = group.tolist()  # where the group of a suffix starts
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    place = place.tolist()
    sizes = np.bincount(first, minlength=n).tolist()
    smaller = [-1] * n

    end = n
    while end > 0:
        begin = group[members[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(members[begin:end]) if end - begin > 1 else members[begin:end]:
            p = i - 1
            while p >= 0 and group[p] >= begin:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, count in pointed.items():
            by_count.setdefault(count, []).append(p)
        for count in sorted(by_count, reverse=True):
            left: dict[int, int] = {}
            for p in by_count[count]:
                old = group[p]
                size = sizes[old] - 1
                sizes[old] = size
                spot, at = old + size, place[p]
                if at != spot:
                    other = members[spot]
                    members[at], place[other] = other, at
                    members[spot], place[p] = p, spot
                left[old] = left.get(old, 0) + 1
            for old, moved in left.items():
                new = old + sizes[old]
                sizes[new] = moved
                if new != old:
                    for x in range(new, new + moved):
                        group[members[x]] = new
        end = begin

    out = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    if n:
        out[0] = n - 1
        placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            start = group[j]
            out[free[start]] = j
            free[start] += 1
            placed[j] = 1
            j = smaller[j]
    return np.array(out, dtype=np.int64)
