"""Suffix arrays by linear grouping (after Baier's suffix sorting by Lyndon prefixes).

Phase 1 refines suffix groups from the highest to the lowest: each member of a group points to the nearest
suffix to its left in a lower group (its previous smaller), and the suffixes pointed at, apart by how often,
leave their group for a new one just above it. At the end a group holds the suffixes of one Lyndon prefix, and
groups are in order. Phase 2 emits: from each suffix placed, the one before it and its chain of previous-smaller
pointers take the next free places of their groups. No recursion, no renaming of the text.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Of a sequence of non-negative integers; a suffix that begins another comes first."""
    n = len(text) + 1
    t = np.empty(n, np.int64)
    t[:-1], t[-1] = text + 1, 0  # the sentinel is the least suffix
    order = np.argsort(t, kind="stable")
    ranked = t[order]
    heads = np.r_[True, ranked[1:] != ranked[:-1]]
    first = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    group_of = np.empty(n, np.int64)
    group_of[order] = first
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    sizes = np.zeros(n, np.int64)
    sizes[heads] = np.diff(np.r_[np.flatnonzero(heads), n])
    sa, group, place, size = order.tolist(), group_of.tolist(), place_of.tolist(), sizes.tolist()
    smaller = [-1] * n

    end = n - 1
    while end > 0:
        start = group[sa[end]]
        times: dict[int, int] = {}
        members = sa[start : end + 1] if start < end else (sa[end],)
        for i in sorted(members) if start < end else members:
            p = i - 1
            while p >= 0 and group[p] >= start:  # of this group or done: its own pointer is known
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if times:
            top = max(times.values())
            if top == 1:
                levels = (list(times),)
            else:
                by: list[list[int]] = [[] for _ in range(top)]
                for p, c in times.items():
                    by[top - c].append(p)
                levels = by
            for moved in levels:
                for p in moved:
                    g = group[p]
                    size[g] -= 1
                    to = g + size[g]
                    at = place[p]
                    if at != to:
                        other = sa[to]
                        sa[at], sa[to] = other, p
                        place[other], place[p] = at, to
                fresh = [group[p] + size[group[p]] for p in moved]
                for p, g in zip(moved, fresh, strict=True):
                    group[p] = g
                    size[g] += 1
        end = start - 1

    out, placed = [0] * n, [False] * n
    nxt = list(range(n))
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[nxt[g]] = j
            nxt[g] += 1
            placed[j] = True
            j = smaller[j]
    return np.array(out[1:], np.int64)


def common_at_least(text: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """For each neighbouring pair of the suffix array: do the two share their first ``length`` symbols?"""
    ok = np.flatnonzero(np.maximum(sa[1:], sa[:-1]) + length <= len(text))
    for k in range(length - 1, -1, -1):
        ok = ok[text[sa[ok] + k] == text[sa[ok + 1] + k]]
    out = np.zeros(max(0, len(sa) - 1), bool)
    out[ok] = True
    return out
