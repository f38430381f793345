"""Word shingles of many texts at once, as arrays."""

from __future__ import annotations

import numpy as np

from statlake.llm.common import mixed

LENGTH = 5
#: Bits of a shingle's hash; the rest of 64 bits number the texts of a call.
BITS = 44
AT_ONCE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_STEPS = np.array([_BASE ** (k + 1) % (1 << 64) for k in range(LENGTH)], "u8")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, AT_ONCE + (AT_ONCE >> 2))
        for name, base in (("up", 0xD6E8FEB86659FD93), ("down", pow(0xD6E8FEB86659FD93, -1, 1 << 64))):
            steps = np.full(size, base, "u8")
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype="u8")
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-case texts, and the text that each is in."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", "u1")
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype("i1")))
    starts, stops = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype("u8") + np.uint64(1)) * up[:len(data)], dtype="u8")])
    hashes = mixed((sums[stops] - sums[starts]) * down[starts])
    firsts = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    return hashes, np.searchsorted(firsts, starts, "right") - 1


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text number, hash of ``BITS`` bits and count of each different shingle, in order.

    A text of fewer words than a shingle has one shingle, of all its words.
    """
    h, text = word_hashes(texts)
    n = len(h)
    total = np.zeros(n, "u8")
    for k in range(min(LENGTH, n)):
        same = text[k:] == text[:n - k]
        total[:n - k] += np.where(same, h[k:] * _STEPS[k], np.uint64(0))
    first = np.ones(n, bool)
    first[1:] = text[1:] != text[:-1]
    whole = np.zeros(n, bool)
    if n >= LENGTH:
        whole[:n - LENGTH + 1] = text[LENGTH - 1:] == text[:n - LENGTH + 1]
    valid = whole | first
    key = (text[valid].astype("u8") << np.uint64(BITS)) | (mixed(total[valid]) >> np.uint64(64 - BITS))
    key, count = np.unique(key, return_counts=True)
    return (key >> np.uint64(BITS)).astype("i8"), key & np.uint64((1 << BITS) - 1), count


def parts(texts: list[str], size: int = AT_ONCE):
    """The texts in runs of about ``size`` characters: first number and texts."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= size or i + 1 == len(texts):
            yield at, texts[at:i + 1]
            at, total = i + 1, 0
