"""SetSketch registers of many sets at once, and joint estimates of two sets' similarity, with numpy.

Every element is a random point process over the registers; a register keeps the smallest arrival of all
elements. The arrivals of one element over all registers are one process of rate `REGISTERS` * `RATE` whose points fall on
random registers, so they come in increasing order, and only those before a set's bound are made: it is such
that each register has one. The minima are kept as truncated logarithms to the base `BASE`; the larger of two
registers is the register of the union.
"""

from __future__ import annotations

import numpy as np

from threadloom.llm.shingles import mix

REGISTERS = 128  # a power of two
BASE = 1.001
RATE = 20.0
LIMIT = (1 << 16) - 2
_UNIT = 2.0 ** 48  # arrivals are whole multiples of 1 / _UNIT, so sums do not depend on their order
_STEP = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 1 << 16


def registers(elements: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers (uint16) of sets of 64-bit hashes, given one after the other; an empty set has zeros."""
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(ends), REGISTERS), np.uint16)
    todo, spare = np.flatnonzero(sizes), 12.0
    while len(todo):
        rows = np.repeat(np.arange(len(todo)), sizes[todo])
        own = elements if len(todo) == len(ends) else np.concatenate([elements[ends[r] - sizes[r]:ends[r]] for r in todo])
        # Beyond 1 the truncated value is 0, whatever the arrival.
        bound = np.minimum((np.log(REGISTERS) + spare) / (RATE * sizes[todo]), 1.0)
        least = _least(own, rows, (bound * _UNIT).astype(np.int64), len(todo))
        done = (least < np.iinfo(np.int64).max).all(axis=1) | (bound >= 1)
        with np.errstate(divide="ignore"):
            value = np.floor(1 - np.log(least / _UNIT) / np.log(BASE))
        out[todo[done]] = np.clip(value[done], 0, LIMIT + 1).astype(np.uint16)
        todo, spare = todo[~done], spare * 4
    return out


def _least(elements: np.ndarray, rows: np.ndarray, bound: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n * REGISTERS, np.iinfo(np.int64).max, np.int64)
    h, row, when, step = elements, rows, np.zeros(len(elements), np.int64), 1
    while len(h):
        # Few elements that need many points: several points each at once.
        k = int(max(1, min(64, _AT_ONCE // len(h))))
        r = mix(h[:, None] + np.arange(step, step + k, dtype=np.uint64) * _STEP)
        u = ((r >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0 ** -53
        gaps = (-np.log(u) * (_UNIT / (REGISTERS * RATE))).astype(np.int64)
        arrival = when[:, None] + np.cumsum(gaps, axis=1)
        early = arrival <= bound[row][:, None]
        at = (row * REGISTERS)[:, None] + (r & np.uint64(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(least, at[early], arrival[early])
        on = early[:, -1]
        h, row, when, step = h[on], row[on], arrival[on, -1], step + k
    return least.reshape(n, REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets of known sizes, from how many of their registers are
    larger, smaller and equal. The likelihood is concave, so the search thirds the interval."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    share_a = size_a / (size_a + size_b)
    share_b = 1 - share_a
    tiny = 1e-12

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(share_a - share_b * j), p(share_b - share_a * j)
        return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
                + same * np.log(np.maximum(1 - up - down, tiny)))

    low, high = np.zeros(len(a)), np.minimum(share_a / share_b, share_b / share_a)
    for _ in range(40):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2
