"""Suffix arrays of many texts side by side, by linear grouping construction.

First the suffixes are grouped by their Lyndon prefixes: groups are taken in descending order, and
for every suffix of the group the nearest smaller suffix before it (its previous-smaller
pointer) moves into a new group just above its old one, the higher the more suffixes point to it. Then
one pass over the rising order emits every suffix behind the one whose follower was just
emitted, along the same pointers; nothing is renamed or sorted again.

The texts are independent, so one numpy step handles the current group of all of them at once.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The suffixes of every text in rising order, text after text, as places in `symbols`.

    `symbols` holds the texts one after the other, each ending in a symbol that is its only
    smallest; `begins` is where each starts.
    """
    n = len(symbols)
    ends = np.append(begins[1:], n)
    text_of = np.repeat(np.arange(len(begins)), ends - begins)
    # place 0 means none, place i + 1 is symbol i
    order = np.argsort(text_of * (int(symbols.max()) + 1) + symbols, kind="stable") if n else np.zeros(0, np.int64)
    opens = np.ones(n, dtype=bool)
    opens[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (text_of[order[1:]] != text_of[order[:-1]])
    starts = np.flatnonzero(opens)
    array = order + 1
    slot = np.zeros(n + 1, dtype=np.int64)
    slot[array] = np.arange(n)
    group = np.zeros(n + 1, dtype=np.int64)
    group[array] = np.repeat(starts, np.diff(np.append(starts, n)))
    size = np.zeros(n + 1, dtype=np.int64)
    size[starts] = np.diff(np.append(starts, n))
    before, after = np.arange(-1, n), np.arange(1, n + 2)
    before[begins + 1] = 0
    after[ends] = 0
    before[0] = after[0] = 0
    smaller = np.zeros(n + 1, dtype=np.int64)
    done = np.zeros(n + 1, dtype=bool)
    moving = np.zeros(n + 1, dtype=bool)
    top, low = ends.copy(), begins
    while len(top):
        first = group[array[top - 1]]
        many = top - first
        total = int(many.sum())
        own = array[np.arange(total) + np.repeat(first - (np.cumsum(many) - many), many)]
        done[own] = True
        left = _skip(before, own, done)
        right = _skip(after, own, done)
        smaller[own] = left
        after[left] = right
        before[right] = left
        after[0] = before[0] = 0
        parents = np.sort(left[left > 0])
        if len(parents):
            new = np.ones(len(parents), dtype=bool)
            new[1:] = parents[1:] != parents[:-1]
            at = np.flatnonzero(new)
            parents, children = parents[at], np.diff(np.append(at, len(parents)))
            old = group[parents]
            by = np.argsort(old * (total + 1) + children, kind="stable")
            parents, children, old = parents[by], children[by], old[by]
            new = np.ones(len(old), dtype=bool)
            new[1:] = old[1:] != old[:-1]
            at = np.flatnonzero(new)
            leaving = np.diff(np.append(at, len(old)))
            bottom = np.repeat(old[at] + size[old[at]] - leaving, leaving)
            goal = bottom + np.arange(len(old)) - np.repeat(at, leaving)
            moving[parents] = True
            there = array[goal]
            out = there[~moving[there]]
            moving[parents] = False
            was = slot[parents]
            free = was[was < bottom]
            array[free], slot[out] = out, free
            array[goal], slot[parents] = parents, goal
            size[old[at]] -= leaving
            new[1:] |= children[1:] != children[:-1]
            at = np.flatnonzero(new)
            run = np.diff(np.append(at, len(old)))
            group[parents] = np.repeat(goal[at], run)
            size[goal[at]] = run
        live = first > low
        top, low = first[live], low[live]
    # emission
    array[:] = 0
    array[begins] = ends  # the smallest symbol's suffix
    head = np.arange(n + 1)
    head[begins] += 1
    done[:] = False
    done[0] = True
    done[ends] = True
    length = ends - begins
    by = np.argsort(-length, kind="stable")
    begins_by, falling, first_of = begins[by], -length[by], begins[by] + 1
    for i in range(int(length.max()) if len(length) else 0):
        k = int(np.searchsorted(falling, -i, side="left"))
        at = array[begins_by[:k] + i]
        s = (at - 1)[at != first_of[:k]]
        while len(s):
            s = s[~done[s]]
            if not len(s):
                break
            g = group[s]
            array[head[g]] = s
            head[g] += 1
            done[s] = True
            s = smaller[s]
    return array - 1


def _skip(step: np.ndarray, own: np.ndarray, done: np.ndarray) -> np.ndarray:
    """The next place of each that isn't done; the pointers on the way are shortened."""
    at = step[own]
    while True:
        more = done[at]
        if not more.any():
            return at
        at[more] = step[at[more]]
        step[own] = at
