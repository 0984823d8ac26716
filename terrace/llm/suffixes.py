"""Suffix arrays by linear grouping (after Baier, 2016)."""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """The start positions of all suffixes of ``text`` in ascending order.

    First the suffixes are grouped by their longest Lyndon prefix, the part up to the
    next smaller suffix. Groups start as the suffixes of one first byte and are
    processed from the largest down. A processed group is final: each member points to
    its previous smaller suffix, which lies in a smaller group, and whatever a group's
    members point to moves to a new group just above its own, one for each number of
    pointers, with its prefix grown by so many copies of the processed one. Every
    member points once, so all moves together are as many as there are suffixes.

    Then one pass over the array emits each group's order: a suffix comes behind its
    prefix as the next smaller suffix is met, which has its place already.
    """
    n = len(text)
    if not n:
        return []
    firsts = sorted(set(text))
    number = {b: g for g, b in enumerate(firsts)}
    group = [number[b] for b in text]
    members: list[list[int]] = [[] for _ in firsts]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(firsts)
    below = list(range(-1, len(firsts) - 1))
    above = [*range(1, len(firsts)), -1]
    previous = [-1] * n
    done = bytearray(n)
    smaller: list[list[int]] = [[] for _ in range(n + 1)]  # by next smaller suffix, n is the end
    final: list[int] = []  # groups as processed, from the largest
    sizes: list[int] = []

    g = len(firsts) - 1
    while g >= 0:
        mine = [i for i in members[g] if group[i] == g]
        members[g] = []
        if mine:
            mine.sort()
            step = length[g]
            pointers: dict[int, int] = {}
            for i in mine:
                p = i - 1
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[i] = p
                done[i] = 1
                smaller[i + step].append(i)
                if p >= 0:
                    pointers[p] = pointers.get(p, 0) + 1
            final.append(g)
            sizes.append(len(mine))
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in pointers.items():
                moved.setdefault((group[p], times), []).append(p)
            for (home, times), found in sorted(moved.items(), key=lambda m: m[0], reverse=True):
                new = len(members)  # more pointers rank higher: descending, each lands just above home
                members.append(found)
                length.append(length[home] + times * step)
                up = above[home]
                above.append(up)
                below.append(home)
                above[home] = new
                if up >= 0:
                    below[up] = new
                for p in found:
                    group[p] = new
        g = below[g]

    fill: dict[int, int] = {}
    at = 0
    for g, size in zip(reversed(final), reversed(sizes)):
        fill[g] = at
        at += size
    out = [0] * n
    for i in smaller[n]:
        out[fill[group[i]]] = i
        fill[group[i]] += 1
    for k in range(n):
        for i in smaller[out[k]]:
            g = group[i]
            out[fill[g]] = i
            fill[g] += 1
    return out
