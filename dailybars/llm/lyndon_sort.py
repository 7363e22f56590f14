"""Suffix sorting by linear grouping of Lyndon prefixes, for many short strings at once.

Phase 1 groups the suffixes of a string by their longest Lyndon prefix. Groups start as first symbols and are
processed in descending order. For each suffix of the group in hand its previous-smaller pointer leads to the nearest
suffix to the left in a lower group; that suffix's prefix is extended by this group's prefix as often as pointers
lead to it, so it moves to a new group right above its old one. Phase 2 emits the groups in ascending order: within
a group, the order of two suffixes is that of (length of the run of equal prefixes, suffix behind the run), and what
lies behind is in a lower group, so it is emitted already. Nothing is renamed and nothing recurses.

All strings take a step together: step t handles the t-th highest group of every string, as array operations.
A string is contexts framed by separators (symbol 0): 0 c c c 0 c c 0. A suffix ends at its separator, and suffixes
that are equal up to there share a rank.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start, sizes[i] numbers each."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def lyndon_groups(symbols: np.ndarray, string: np.ndarray):
    """order (suffixes by group), start (each suffix's group), run and behind (for the second phase).

    symbols: all strings in a row. string: the number of each symbol's string, ascending.
    """
    n = len(symbols)
    order = np.lexsort((symbols, string))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    key = string[order] * 512 + symbols[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    last = np.r_[first[1:], n] - 1
    start = np.empty(n, np.int64)
    start[order] = np.repeat(first, last - first + 1)
    end = np.zeros(n, np.int64)
    end[first] = last
    back = np.arange(n) - 1  # previous-smaller pointers of suffixes in handled groups
    behind = np.arange(n) + 1
    run = np.ones(n, np.int64)
    moving = np.zeros(n, bool)
    bounds = np.flatnonzero(np.r_[True, string[1:] != string[:-1], True])
    separators = np.add.reduceat(symbols == 0, bounds[:-1]) if n else np.empty(0, np.int64)
    floor = bounds[:-1] + separators  # separators lie first and are never handled
    top = bounds[1:] - 1
    active = np.flatnonzero(top >= floor)
    while len(active):
        g_last = top[active]
        g_first = start[order[g_last]]
        sizes = g_last - g_first + 1
        members = order[_ranges(g_first, sizes)]
        own = np.repeat(g_first, sizes)
        top[active] = g_first - 1
        # What lies behind: skip suffixes in higher groups, then count the run of this group.
        after = members + 1
        look = np.flatnonzero(start[after] > own)
        while len(look):
            after[look] = behind[after[look]]
            look = look[start[after[look]] > own[look]]
        behind[members] = after
        look = np.flatnonzero(start[after] == own)
        while len(look):
            run[members[look]] += 1
            after[look] = behind[after[look]]
            look = look[start[after[look]] == own[look]]
        # Previous-smaller pointers: skip this and higher groups.
        before = members - 1
        look = np.flatnonzero(start[before] >= own)
        while len(look):
            before[look] = back[before[look]]
            look = look[start[before[look]] >= own[look]]
        behind[members] = after
        back[members] = before
        # Each suffix pointed at moves above the rest of its group, those pointed at more often further up.
        hit, times = np.unique(before[symbols[before] > 0], return_counts=True)
        if len(hit):
            old = start[hit]
            sort = np.lexsort((hit, times, old))
            hit, times, old = hit[sort], times[sort], old[sort]
            block = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            sizes = np.diff(np.r_[block, len(hit)])
            tail = np.repeat(end[old[block]] - sizes + 1, sizes)
            slots = _ranges(end[old[block]] - sizes + 1, sizes)
            moving[hit] = True
            there = order[slots]
            stay = there[~moving[there]]
            was = place[hit]
            free = was[was < tail]
            order[free], place[stay] = stay, free
            order[slots], place[hit] = hit, slots
            moving[hit] = False
            rest = end[old[block]] - sizes
            end[old[block]] = rest
            fresh = np.flatnonzero(np.r_[True, (old[1:] != old[:-1]) | (times[1:] != times[:-1])])
            size = np.diff(np.r_[fresh, len(hit)])
            start[hit] = np.repeat(slots[fresh], size)
            end[slots[fresh]] = slots[fresh] + size - 1
        active = active[top[active] >= floor[active]]
    return order, start, run, behind


def sort_suffixes(symbols: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): the suffixes of each string in ascending order, strings one after the other; equal ones share a
    rank."""
    n = len(symbols)
    order, start, run, behind = lyndon_groups(symbols, string)
    rank = np.zeros(n, np.int64)
    first = np.flatnonzero(np.r_[True, start[order[1:]] != start[order[:-1]]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    real = symbols[order[first]] > 0 if n else np.empty(0, bool)
    first, sizes = first[real], sizes[real]
    of = string[order[first]]
    # The step of a group: its number within its string.
    begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    step = np.arange(len(of)) - np.repeat(begin, np.diff(np.r_[begin, len(of)]))
    alone = sizes == 1
    rank[order[first[alone]]] = first[alone]
    todo = np.flatnonzero(~alone)
    todo = todo[np.argsort(step[todo], kind="stable")]
    cuts = np.flatnonzero(np.r_[True, step[todo][1:] != step[todo][:-1], True]) if len(todo) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        at, size = first[todo[a:b]], sizes[todo[a:b]]
        slots = _ranges(at, size)
        members, group = order[slots], np.repeat(at, size)
        k, r = run[members], rank[behind[members]]
        sort = np.lexsort((r, k, group))
        members, k, r = members[sort], k[sort], r[sort]
        order[slots] = members
        differs = np.r_[True, (group[1:] != group[:-1]) | (k[1:] != k[:-1]) | (r[1:] != r[:-1])]
        rank[members] = slots[np.maximum.accumulate(np.where(differs, np.arange(len(slots)), 0))]
    return order, rank
