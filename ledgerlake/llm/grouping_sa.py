"""Suffix arrays by grouping, for many short strings at once (numpy).

Linear grouping construction: suffixes are first grouped by their first character, then the groups are processed in
descending order.  For every suffix i of the current group (common prefix u) its previous-smaller pointer is found, the
nearest position to the left in a lower group; the positions pointed to have u appended to their prefix and move to a
new group right after their own (one per number of pointers, more pointers later).  At the end each suffix stands in the
group of its longest Lyndon prefix.  A second pass emits the order: groups are read in ascending order and each emitted
suffix p hands out the next free place in their groups to the suffixes whose Lyndon prefix ends at p.  Nothing is
renamed or sorted recursively.

The strings are independent, so a step processes the current group of every string together with flat array operations; a
batch takes as many steps as its string with the most groups.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the half-open ranges, and the range each is from."""
    n = stops - starts
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + starts[of], of


def suffix_arrays(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix arrays of the strings text[ends[i-1]:ends[i]], one after the other, as positions in ``text``.

    ``text``: non-negative integers; a string's last symbol must be 0 and its only 0.
    """
    n, lanes = len(text), len(ends)
    bases = np.concatenate(([0], ends[:-1]))
    lane = np.repeat(np.arange(lanes), ends - bases)
    # position 0 is a guard on the left of the first string: positions are shifted by one
    int_ = np.int32 if n < 1 << 30 else np.int64
    key = lane * (int(text.max(initial=0)) + 1) + text
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
    sizes = np.diff(np.append(first, n))
    sa = (order + 1).astype(int_)
    place = np.empty(n + 1, int_)
    place[sa] = np.arange(n)
    group = np.full(n + 1, -1, int_)
    group[sa] = np.repeat(first, sizes)
    size = np.zeros(n + 1, int_)
    size[first] = sizes
    length = np.ones(n + 1, int_)
    prev = np.arange(-1, n, dtype=int_)
    moved = np.zeros(n + 1, bool)
    lane_first = bases + 1

    top = ends.copy()                                # end of each string's unprocessed groups
    active = np.flatnonzero(top - bases > 1)
    while len(active):
        start = group[sa[top[active] - 1]]
        at, of = _ranges(start, top[active])
        member = sa[at]
        floor = start[of]
        prev[member] = member - 1
        todo, low = member, floor
        while len(todo):
            p = prev[todo]
            high = group[p] >= low
            todo, low, p = todo[high], low[high], p[high]
            prev[todo] = prev[p]
        ptr = prev[member]
        inside = ptr >= lane_first[active][of]
        target, source = ptr[inside], member[inside]
        if len(target):
            by = np.argsort(target, kind="stable")
            target, source = target[by], source[by]
            head = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            times = np.diff(np.append(head, len(target)))
            target, grown = target[head], times * length[source[head]]
            old = group[target]
            by = np.lexsort((times, old))
            target, times, old, grown = target[by], times[by], old[by], grown[by]
            block = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            count = np.diff(np.append(block, len(old)))
            tail = old[block] + size[old[block]] - count       # the moved ones take the group's last places
            slot, of_block = _ranges(tail, tail + count)
            where = place[target]
            moved[target] = True
            there = sa[slot]
            stay = there[~moved[there]]
            free = where[where < tail[of_block]]
            sa[free] = stay
            place[stay] = free
            sa[slot] = target
            place[target] = slot
            moved[target] = False
            run = np.flatnonzero(np.concatenate(([True], (old[1:] != old[:-1]) | (times[1:] != times[:-1]))))
            run_size = np.diff(np.append(run, len(old)))
            size[old[block]] -= count
            size[slot[run]] = run_size
            group[target] = np.repeat(slot[run], run_size)
            length[target] += grown
        top[active] = start
        active = active[start - bases[active] > 1]

    # second pass: emit in ascending order
    position = np.arange(1, n + 1, dtype=int_)
    follows = position + length[1:]                  # where the Lyndon prefix ends
    follows[ends - 1] = 0                            # nothing hands out the strings' ends
    by = np.argsort(follows, kind="stable")
    child, parent = position[by], follows[by]
    child_start = np.searchsorted(parent, np.arange(n + 2), side="left")
    starts_at = np.repeat(np.flatnonzero(size[:n] > 0), size[:n][size[:n] > 0])   # place -> its group's start
    free = np.arange(n + 1)                          # next free place of the group starting there
    out = np.zeros(n, np.int64)
    out[bases] = ends
    free[bases] += 1
    read = bases.copy()
    active = np.arange(lanes)
    while len(active):
        lo = read[active]
        hi = free[starts_at[lo]]
        at, _ = _ranges(lo, hi)
        p = out[at]
        kids, _ = _ranges(child_start[p], child_start[p + 1])
        kid = child[kids]
        if len(kid):
            g = group[kid]
            by = np.argsort(g, kind="stable")
            kid, g = kid[by], g[by]
            head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            count = np.diff(np.append(head, len(g)))
            slot, _ = _ranges(free[g[head]], free[g[head]] + count)
            out[slot] = kid
            free[g[head]] += count
        read[active] = hi
        active = active[hi < ends[active]]
    return out - 1


def repeated_windows(fragments: list[list[bytes]], window: int) -> list[list[np.ndarray]]:
    """For each string of fragments, and each fragment of it: which of its windows (by start) occur in another place of
    the same string, same fragment included."""
    parts, lengths, ends, at = [], [], [], 0
    for lane in fragments:
        for f in lane:
            parts.append(np.frombuffer(f, np.uint8).astype(np.int16) + 2)
            parts.append(np.array([1], np.int16))
            lengths.append(len(f))
            at += len(f) + 1
        parts[-1] = np.array([0], np.int16)          # the last separator is the string's end
        ends.append(at)
    text, lengths = np.concatenate(parts).astype(np.int64), np.array(lengths)
    sa = suffix_arrays(text, np.array(ends))
    stop = np.cumsum(lengths + 1) - 1
    left = np.repeat(stop, lengths + 1) - np.arange(len(text))    # symbols up to the separator
    lane = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
    sa = sa[left[sa] >= window]
    repeated = np.zeros(len(text), bool)
    if len(sa) > 1:
        raw = np.ascontiguousarray(np.maximum(text - 2, 0).astype(np.uint8))
        raw = np.concatenate([raw, np.zeros(8, np.uint8)])
        words = np.ndarray((len(text) + 1,), np.uint64, raw.data, 0, (1,))
        pair = np.flatnonzero(lane[sa[1:]] == lane[sa[:-1]])
        for j in [*range(0, window - 7, 8), max(0, window - 8)]:
            pair = pair[words[sa[pair] + j] == words[sa[pair + 1] + j]]
        repeated[sa[pair]] = True
        repeated[sa[pair + 1]] = True
    cut = iter(np.split(repeated, np.cumsum(lengths + 1)[:-1]))
    return [[next(cut)[:max(0, len(f) - window + 1)] for f in lane_] for lane_ in fragments]
