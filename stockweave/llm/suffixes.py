"""Suffix arrays by linear grouping.

Suffixes are grouped by the Lyndon word they start with. The first phase takes the groups from the
largest down: a suffix of the group points to the nearest suffix before it that lies in a smaller
group, and the suffixes pointed to are moved, within their own group, behind those that are not, the
further the more pointers they got. The second phase takes the suffixes in their final order and
places, at the front of what is left of its group, the suffix before each one and those it points
to. No prefix is renamed, nothing is compared twice, and the work grows in proportion to the text.
"""

from __future__ import annotations

from stockweave.llm.common import by_value

by_value(__name__)


def suffix_array(text) -> list[int]:
    """Starts of the suffixes of ``text`` (a sequence of integers) in ascending order."""
    import numpy as np

    n = len(text)
    if n == 0:
        return []
    symbols = np.asarray(text, dtype=np.int64)
    order = np.argsort(symbols, kind="stable")
    first = np.ones(n, bool)
    first[1:] = symbols[order][1:] != symbols[order][:-1]
    starts = np.flatnonzero(first)
    group_of = np.empty(n, np.int64)
    group_of[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    members = order.tolist()
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    place = place.tolist()
    group = group_of.tolist()
    end = dict(zip(starts.tolist(), [*starts[1:].tolist(), n]))
    before = _point_and_split(members, place, group, end, n)
    return _emit(group, before, n)


def _point_and_split(members, place, group, end, n):
    """First phase; ``group`` (the position where a suffix's group starts) becomes final."""
    before = list(range(-1, n - 1))
    top = n
    while top > 0:
        start = group[members[top - 1]]
        pointed: dict[int, int] = {}
        for i in members[start:top]:
            j = before[i]
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for j, count in pointed.items():
                by_count.setdefault(count, []).append(j)
            for count in sorted(by_count, reverse=True):
                old_end: dict[int, int] = {}
                for j in by_count[count]:
                    home = group[j]
                    last = end[home]
                    if home not in old_end:
                        old_end[home] = last
                    last -= 1
                    other, at = members[last], place[j]
                    members[at], place[other] = other, at
                    members[last], place[j] = j, last
                    end[home] = last
                for j in by_count[count]:
                    # The moved ones form the group that starts where their old group now ends.
                    group[j] = end[group[j]]
                for home, stop in old_end.items():
                    end[end[home]] = stop
        top = start
    return before


def _emit(group, before, n):
    """Second phase: the suffix array."""
    out = [-1] * n
    free = {}
    placed = bytearray(n)
    # A pointer of -1 leads to the end of the text: the suffix at the end comes first in that order.
    chain = n - 1
    at = 0
    while True:
        while chain >= 0 and not placed[chain]:
            home = group[chain]
            slot = free.get(home, home)
            out[slot] = chain
            free[home] = slot + 1
            placed[chain] = 1
            chain = before[chain]
        if at >= n:
            return out
        chain = out[at] - 1
        at += 1
