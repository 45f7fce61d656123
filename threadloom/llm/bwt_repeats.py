"""Strings of a minimum length that occur at least twice among some byte strings, with numpy.

The Burrows-Wheeler transform of the strings gives the interval of `c` + `w` from that of `w` by counting. Taken breadth
first, all intervals of strings of one length come before those of the next, so the end of an interval that has no common
prefix yet has just the length reached: common prefixes come out in increasing order. At the minimum length the search
stops; what has no value by then is longer. The transform is sorted by the first symbols only, as many as the
search goes.
"""

from __future__ import annotations

import numpy as np

_FIRST = 7  # symbols of 9 bits packed into the first sort key
_UNSET = -1


def _symbols(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All parts, each followed by its end (0); a byte is its value and 1. And where each part begins."""
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    data[ends] = 0
    return data, np.concatenate([[0], ends[:-1] + 1])


def _to_end(starts: np.ndarray, n: int) -> np.ndarray:
    """Bytes from each place to the end of its part."""
    ends = np.append(starts[1:], n) - 1
    left = np.repeat(ends.astype(np.int32), np.append(starts[1:], n) - starts)
    left -= np.arange(n, dtype=np.int32)
    return left


def _sorted(data: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their first `depth` symbols (none after an end), and the packed first ones."""
    n = len(data)
    key = np.zeros(n, np.int64)
    for i in range(_FIRST):
        key <<= 9
        if i < n:
            key[:n - i] |= np.where(left[:n - i] >= i, data[i:], np.int16(0))
    order = np.argsort(key, kind="stable").astype(np.int32)
    first = key[order]
    del key
    new = np.concatenate([[True], first[1:] != first[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    h = _FIRST
    while h < depth:
        # Only places that share their rank with another are sorted further.
        again = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
        if not len(again):
            break
        at = order[again]
        both = rank[at].astype(np.int64) * (n + 1)
        both += np.where(left[at] >= h, rank[np.minimum(at + h, n - 1)] + 1, 0)
        by = np.argsort(both, kind="stable")
        order[again] = at[by]
        both = both[by]
        new[again] = np.concatenate([[True], both[1:] != both[:-1]])
        del at, both, by
        rank[order] = np.cumsum(new, dtype=np.int32) - 1
        h *= 2
    return order, first


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals, and the number of the interval of each."""
    sizes = high - low
    which = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    return np.arange(len(which), dtype=np.int32) + (low - np.cumsum(sizes) + sizes).astype(np.int32)[which], which


def _common_prefixes(data: np.ndarray, order: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Common prefix of each suffix, in order, with the one before it; `_UNSET` where it is `least` or more."""
    n = len(order)
    before = data[order - 1]  # the transform; at the first place of a part this is an end
    step = np.empty(n, np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    prefix = np.full(n + 1, _UNSET, np.int16)
    prefix[0] = prefix[n] = 0
    # The first sort key has the shortest common prefixes.
    differ = first[1:] ^ first[:-1]
    short = np.flatnonzero(differ)
    bits = np.frexp(differ[short].astype(np.float64))[1]
    prefix[short + 1] = _FIRST - 1 - (bits - 1) // 9
    edges = np.concatenate([[0], short + 1, [n]])
    low, high = edges[:-1], edges[1:]
    length = _FIRST
    just = prefix[high] == length - 1  # those whose end was found last; the others have led on already
    low, high = low[just], high[just]
    label = np.empty(n + 1, np.int32)
    while len(low) and length < least:
        places, which = _ranges(low, high)
        inner = before[places] > 0  # matches do not cross parts
        to, which = step[places[inner]], which[inner]
        if not len(to):
            break
        label[to] = which
        to.sort()
        own = label[to]
        symbol = data[order[to]]
        last = np.flatnonzero(np.append((to[1:] != to[:-1] + 1) | (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1]), True))
        begin = np.concatenate([[0], last[:-1] + 1])
        low, high = to[begin], to[last] + 1
        fresh = prefix[high] == _UNSET
        low, high = low[fresh], high[fresh]
        prefix[high] = length
        length += 1
    return prefix[:n]


def repeated_starts(parts: list[bytes], least: int) -> list[np.ndarray]:
    """For each part, where a string of `least` bytes begins that begins somewhere else too. Parts shorter than that
    have none."""
    data, starts = _symbols(parts)
    left = _to_end(starts, len(data))
    order, first = _sorted(data, left, least)
    prefix = _common_prefixes(data, order, first, least)
    long = prefix == _UNSET
    found = np.zeros(len(data), bool)
    found[order] = long | np.append(long[1:], False)
    found &= left >= least
    return [np.flatnonzero(f) for f in np.split(found, starts[1:])]
