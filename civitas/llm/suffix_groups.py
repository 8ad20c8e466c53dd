"""Suffix arrays by linear grouping: no recursion, no renaming.

First the suffixes are grouped by their longest Lyndon prefix.  Groups start as
equal first symbols and are processed in descending order; each suffix of a
group finds its previous smaller suffix by following the pointers of suffixes
processed before, and the suffixes so found leave their own group for a new one
right above it, those with more of the group's words in a row higher.  Then the
order inside all groups comes from one ascending walk: when a suffix is
reached, every suffix whose next smaller suffix it is takes the next free place
of its group.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: bytes | list[int]) -> list[int]:
    """Start positions in suffix order; the last symbol must be the smallest and unique."""
    size = len(symbols)
    if not size:
        return []
    group, order, prev = lyndon_groups(symbols)
    return _ordered(size, group, order, prev)


def lyndon_groups(symbols) -> tuple[list[int], list[int], list[int]]:
    """(group of each suffix, groups in ascending order, previous smaller suffixes)."""
    size = len(symbols)
    first: dict[int, list[int]] = {}
    for at, symbol in enumerate(symbols):
        if symbol in first:
            first[symbol].append(at)
        else:
            first[symbol] = [at]
    members: list = [first[s] for s in sorted(first)]
    group = [0] * size
    for number, starts in enumerate(members):
        for at in starts:
            group[at] = number
    alive = [len(starts) for starts in members]
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1] = -1
    done = bytearray(size)
    prev = [-1] * size
    order: list[int] = []
    now = len(members) - 1
    while now >= 0:
        starts = members[now]
        members[now] = None
        if not alive[now]:
            now = below[now]
            continue
        order.append(now)
        if len(starts) > 1:
            starts = sorted([s for s in starts if group[s] == now])
        elif group[starts[0]] != now:
            starts = []
        for s in starts:
            done[s] = 1
        words: dict[int, int] = {}
        for s in starts:
            p = s - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[s] = p
            # a suffix alone in its group has nowhere to go
            if p >= 0 and alive[group[p]] > 1:
                words[p] = words.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, count in words.items():
            if count in by_count:
                by_count[count].append(p)
            else:
                by_count[count] = [p]
        tops: dict[int, int] = {}
        for count in sorted(by_count) if len(by_count) > 1 else by_count:
            fresh: dict[int, int] = {}
            for p in by_count[count]:
                old = group[p]
                new = fresh.get(old)
                if new is None:
                    new = fresh[old] = len(members)
                    top = tops.get(old, old)  # smaller counts lie lower
                    upper = above[top]
                    members.append([p])
                    alive.append(1)
                    below.append(top)
                    above.append(upper)
                    above[top] = new
                    if upper >= 0:
                        below[upper] = new
                else:
                    members[new].append(p)
                    alive[new] += 1
                group[p] = new
                alive[old] -= 1
            tops.update(fresh)
        now = below[now]
    order.reverse()
    return group, order, prev


def _ordered(size: int, group: list[int], order: list[int], prev: list[int]) -> list[int]:
    """Place every suffix when its next smaller suffix is reached."""
    sizes = np.bincount(np.asarray(group, np.int64))
    starts = np.zeros(len(sizes), np.int64)
    ascending = np.asarray(order, np.int64)
    starts[ascending] = np.cumsum(sizes[ascending]) - sizes[ascending]
    free = starts.tolist()
    placed = bytearray(size)
    result = [-1] * size
    result[0] = size - 1
    placed[size - 1] = 1
    for at in range(size):
        p = result[at] - 1
        while p >= 0 and not placed[p]:
            own = group[p]
            result[free[own]] = p
            free[own] += 1
            placed[p] = 1
            p = prev[p]
    return result


def shared_windows(texts: list[bytes], owners: list[int], window: int) -> np.ndarray:
    """For every window of the texts, end to end, the smallest owner that has it.

    The texts (each at least ``window`` long) are joined by a separator, their
    suffixes sorted, and neighbours whose first ``window`` bytes are equal share.
    """
    sizes = np.asarray([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.zeros(int(sizes.sum()) + len(texts) + 1, np.int16)
    body = np.ones(len(joined) - 1, bool)
    body[starts + sizes] = False
    joined[:-1][body] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 2
    joined[:-1][~body] = 1
    suffixes = np.asarray(suffix_array(joined.tolist()), np.int64)
    counts = sizes - window + 1
    owner = np.full(len(joined), -1, np.int64)
    number = np.full(len(joined), -1, np.int64)
    flat = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    owner[flat] = np.repeat(np.asarray(owners, np.int64), counts)
    number[flat] = np.arange(len(flat))
    suffixes = suffixes[number[suffixes] >= 0]
    fresh = np.ones(len(suffixes), bool)
    spread = np.arange(window)
    for at in range(1, len(suffixes), 50_000):
        own = suffixes[at : at + 50_000]
        before = suffixes[at - 1 : at + len(own) - 1]
        fresh[at : at + len(own)] = (
            joined[own[:, None] + spread] != joined[before[:, None] + spread]
        ).any(axis=1)
    heads = np.flatnonzero(fresh)
    least = np.minimum.reduceat(owner[suffixes], heads)
    result = np.empty(len(flat), np.int64)
    result[number[suffixes]] = np.repeat(least, np.diff(np.append(heads, len(suffixes))))
    return result
