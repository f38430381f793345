"""Two-stage suffix sorting of many short byte strings, in arrays.

Only suffixes smaller than their successors are sorted directly (by their first ``REACH``
bytes). All others are induced by scanning the buckets of first bytes in ascending order: such
a suffix stands in its bucket in the order of its successor, which lies in a lower bucket or
was placed in the same bucket one step earlier. Equal strings of ``REACH`` bytes then lie side
by side, which the common prefixes of neighbours tell.
"""

from __future__ import annotations

import numpy as np

REACH = 100
_WORDS = -(-REACH // 8)


def _prefixes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first REACH bytes at each place as rows of big-endian words."""
    view = np.lib.stride_tricks.sliding_window_view(data, _WORDS * 8)
    rows = view[at]
    rows[:, REACH:] = 0
    return rows.view(">u8").astype("u8")


def suffix_order(data: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places ``wanted`` (ascending) in the order of their suffixes.

    ``data`` holds strings that end before ``ends`` (one number for each place), each with
    at least ``8 * _WORDS`` zero bytes after it.
    """
    n = len(data)
    step = np.zeros(n, "i2")
    step[:-1] = data[1:].astype("i2") - data[:-1]
    last = np.unique(ends[wanted]) - 1
    step[last] = -1
    # Equal neighbours take after the next pair that differs.
    places = np.arange(n)
    told = np.minimum.accumulate(np.where(step != 0, places, n - 1)[::-1])[::-1]
    smaller = step[told] > 0
    # Also in order must be what follows a wanted suffix, up to the next one sorted directly.
    stop = np.minimum.accumulate(np.where(smaller, places, n - 1)[::-1])[::-1]
    stop = np.minimum(stop[wanted], ends[wanted] - 1)
    marks = np.zeros(n + 1, "i4")
    np.add.at(marks, wanted, 1)
    np.add.at(marks, stop + 1, -1)
    active = np.cumsum(marks[:-1]) > 0

    direct = np.flatnonzero(active & smaller)
    keys = _prefixes(data, direct)
    direct = direct[np.lexsort(keys.T[::-1])] if len(direct) else direct
    rest = np.flatnonzero(active & ~smaller)
    rest = rest[np.argsort(data[rest], kind="stable")]

    rank = np.full(n + 1, -1, "i8")
    ended = np.zeros(n, bool)
    ended[last] = True
    direct_bytes, rest_bytes = data[direct], data[rest]
    used = np.unique(np.concatenate([direct_bytes, rest_bytes]))
    d_lo, d_hi = (np.searchsorted(direct_bytes, used, side) for side in ("left", "right"))
    r_lo, r_hi = (np.searchsorted(rest_bytes, used, side) for side in ("left", "right"))
    at = 0
    for i in range(len(used)):
        todo = rest[r_lo[i]:r_hi[i]]
        while len(todo):
            # A string's last byte has nothing after it, which is less than anything.
            after = np.where(ended[todo], 0, rank[todo + 1] + 1)
            ready = ended[todo] | (after > 0)
            now = todo[ready]
            if not len(now):
                raise AssertionError("a suffix has no successor in order")
            now = now[np.argsort(after[ready], kind="stable")]
            rank[now] = at + np.arange(len(now))
            at += len(now)
            todo = todo[~ready]
        some = direct[d_lo[i]:d_hi[i]]
        rank[some] = at + np.arange(len(some))
        at += len(some)
    return wanted[np.argsort(rank[wanted], kind="stable")]


def equal_neighbours(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each but the first in order: whether it shares REACH bytes with the one before."""
    rows = _prefixes(data, order)
    return (rows[1:] == rows[:-1]).all(1)
