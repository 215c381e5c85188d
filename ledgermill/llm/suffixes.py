"""Linear grouping construction of a suffix array."""

from __future__ import annotations

from collections import Counter, defaultdict


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order; the last symbol must be the least, once.

    Suffixes are first grouped by their Lyndon prefixes. Groups are taken from the greatest down. A member's
    previous smaller suffix is the nearest to its left in a lower group; whoever is that for the same
    number of members of the group, and was in one group before, starts with the same longer prefix
    and leaves to a group of its own, just above the rest. Then the smallest suffix is emitted, and
    with each suffix those whose Lyndon prefix ends there, found along the pointers, each to the
    front of what its group has left. Nothing is renamed or sorted again.
    """
    n = len(text)
    if not n:
        return []
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            start = i
        place[s], group[s] = i, start
        size[start] += 1

    before = [-1] * n
    end = n
    while end > 0:
        first = group[order[end - 1]]
        if end - first == 1:
            s = order[first]
            p = s - 1
            while p >= 0 and group[p] >= first:
                p = before[p]
            before[s] = p
            rounds = ((p,),) if p >= 0 else ()
        else:
            heads: Counter[int] = Counter()
            for s in sorted(order[first:end]):
                p = s - 1
                while p >= 0 and group[p] >= first:
                    p = before[p]
                before[s] = p
                if p >= 0:
                    heads[p] += 1
            by_count = defaultdict(list)
            for p, k in heads.items():
                by_count[k].append(p)
            rounds = [by_count[k] for k in sorted(by_count, reverse=True)]
        for leaving in rounds:
            moved: dict[int, int] = {}
            for p in leaving:
                g = group[p]
                to = moved[g] = moved.get(g, g + size[g]) - 1
                other, at = order[to], place[p]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
            for p in leaving:
                group[p] = moved[group[p]]
            for g, to in moved.items():
                left = to - g
                if left:
                    size[to] = size[g] - left
                    size[g] = left
        end = first

    out, front, done = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not done[p]:
            g = group[p]
            out[front[g]] = p
            front[g] += 1
            done[p] = True
            p = before[p]
    return out
