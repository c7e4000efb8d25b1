"""Suffix arrays by linear grouping.

The Lyndon prefix of a suffix is the longest prefix that is smaller than all of its own
proper suffixes; it ends where the next smaller suffix begins.  Suffixes are first grouped by
their Lyndon prefixes, in order, then ordered inside the groups:

1. Groups start as the suffixes with a common first symbol, and are processed from the
   largest down.  For every member, the previous smaller suffix is found by following the
   pointers of suffixes known to be larger.  A suffix that m members point at has just
   learnt that its prefix goes on with m times the group's prefix: of its own group, the
   suffixes with equal m are split off as a group right above, larger m further up.
2. Suffixes are then met in ascending order.  Each one is the next smaller suffix of those
   before it on the chain of previous smaller pointers that have no place yet; they take
   the next free places of their groups.

Every suffix moves once for each group it leaves, which is once for each suffix that points
at it: the work is linear, and nothing is renamed or solved recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of `text` in ascending order (a prefix before its extension)."""
    n = len(text)
    buckets: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        buckets.setdefault(symbol, []).append(i)
    order: list[int] = []
    group = [0] * n  # where the group of a suffix begins in `order`
    for symbol in sorted(buckets):
        begin = len(order)
        for i in buckets[symbol]:
            group[i] = begin
        order += buckets[symbol]
    place = [0] * n
    for k, i in enumerate(order):
        place[i] = k
    end = {group[members[0]]: group[members[0]] + len(members) for members in buckets.values()}
    smaller = _group(order, place, group, end)
    return _emit(n, group, smaller)


def _group(order: list[int], place: list[int], group: list[int], end: dict[int, int]) -> list[int]:
    """Split into Lyndon groups; the previous smaller suffix of each, or -1."""
    n = len(order)
    smaller = [-1] * n
    top = n
    while top:
        begin = group[order[top - 1]]
        times: dict[int, int] = {}
        for i in order[begin:top] if top - begin == 1 else sorted(order[begin:top]):
            before = i - 1
            while before >= 0 and group[before] >= begin:
                before = smaller[before]
            smaller[i] = before
            if before >= 0:
                times[before] = times.get(before, 0) + 1
        if times:
            if len(times) > 1 and max(times.values()) > 1:
                waves: dict[int, list[int]] = {}
                for i, m in times.items():
                    waves.setdefault(m, []).append(i)
                for m in sorted(waves, reverse=True):
                    _split(waves[m], order, place, group, end)
            else:
                _split(times, order, place, group, end)
        top = begin
    return smaller


def _split(moved, order: list[int], place: list[int], group: list[int], end: dict[int, int]) -> None:
    """Make the moved suffixes of each group a group of their own above the rest of it."""
    gone: dict[int, list[int]] = {}
    for i in moved:
        gone.setdefault(group[i], []).append(i)
    for begin, members in gone.items():
        last = end[begin]
        cut = last - len(members)
        if cut == begin:
            continue
        k = last
        for i in members:
            k -= 1
            at, other = place[i], order[k]
            order[at], order[k] = other, i
            place[other], place[i] = at, k
            group[i] = cut
        end[begin], end[cut] = cut, last


def _emit(n: int, group: list[int], smaller: list[int]) -> list[int]:
    out = [-1] * n
    free = list(range(n))  # the next free place of the group that begins here
    placed = bytearray(n)
    nearest = n  # the empty suffix is the smallest
    k = 0
    while True:
        i = nearest - 1
        while i >= 0 and not placed[i]:
            placed[i] = 1
            begin = group[i]
            out[free[begin]] = i
            free[begin] += 1
            i = smaller[i]
        if k == n:
            return out
        nearest = out[k]
        k += 1
