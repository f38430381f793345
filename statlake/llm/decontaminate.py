"""Benchmark decontamination by templates, which also finds re-parameterised questions.

Words lose their punctuation and case; numbers, units and names (capitalised words inside a
sentence) become placeholders of their type and are remembered as slot values. Windows of
``WINDOW`` such tokens are hashed. A document's windows are looked up among those of the
benchmark; matches of an item at one offset must map its names to the document's consistently
(one name to one name), or the windows that hold a name in conflict don't count. Numbers and
units may take any values: equal ones may become different, and different ones equal. A document
is contaminated by an item if ``AT_LEAST`` of the item's windows are matched in it, or a passage
of ``PASSAGE`` tokens at one offset, or (items of ``EDITED_FROM`` tokens or more) if ``AT_LEAST``
of the item's tokens are equal, two side by side at least, at one offset and those near it where
words were put in or left out, with no name in conflict. ``share`` is that of the windows.

The benchmark's windows travel to all tasks in slices of at most ``MOST_SENT``; each slice is
one pass over the documents, written before the next is sent, and documents are never shuffled. Results for odd input: NULL
and empty texts match nothing; items with fewer tokens than a window are found as a whole, and
by their own values if all tokens are placeholders; copies
of an item are items of their own; repeated rows get equal results; no benchmark: nothing is
contaminated. Other columns of the documents stay as they are.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from statlake.llm.common import in_small_batches, kept, mixed, packed, text_or_empty, unpacked, words_of

WINDOW, AT_LEAST = 5, 0.8
PASSAGE, EDITED_FROM = 13, 10
MOST_SENT = 2_000_000
REMEMBERED = 200_000

#: Tokens of the types.
NUMBER, UNIT, NAME = 3, 5, 7

UNITS = frozenset("""% $ € £ ° °c °f mm cm m km mg g kg t ml l s sec secs second seconds min mins minute
minutes h hour hours day days week weeks month months year years inch inches ft foot feet mile miles
mph kmh km/h m/s lb lbs pound pounds oz usd eur dollar dollars euro euros cent cents percent""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-zµ°]{1,3})?$")
_EDGES = re.compile(r"^[^\w$€£%°+-]+|[^\w$€£%°]+$")
_ENDS = re.compile(r"[.!?:;][\"')\]»”’]*$")
_POWERS = np.array([0x9E3779B97F4A7C15 ** k % (1 << 64) for k in range(WINDOW)], "u8")


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) | 1


class Tokens:
    """Words seen so far, with their tokens at and after the start of a sentence."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.at: dict[str, int] = {}
        self.first, self.later, self.slot = array("Q"), array("Q"), array("Q")
        self.ends = array("b")

    def add(self, word: str) -> int:
        core = _EDGES.sub("", word)
        low = core.lower()
        if not core:
            first = later = slot = 0
        elif _NUMBER.match(low):
            first, later, slot = NUMBER, NUMBER, _hash(low)
        elif low in UNITS:
            first, later, slot = UNIT, UNIT, _hash(low)
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            first, later, slot = _hash(low), NAME, _hash(low)
        else:
            first, slot = _hash(low), 0
            later = first
        self.at[word] = n = len(self.first)
        self.first.append(first)
        self.later.append(later)
        self.slot.append(slot)
        self.ends.append(bool(_ENDS.search(word)))
        return n

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Token hashes and slot values (0: none) of a text."""
        words = words_of(text)
        if len(self.at) > REMEMBERED:
            self.clear()
        found = list(map(self.at.get, words))
        if None in found:
            for i, (w, at) in enumerate(zip(words, found)):
                if at is None:
                    at = self.at.get(w)
                    found[i] = self.add(w) if at is None else at
        at = np.array(found, "i8")
        if not len(at):
            return np.zeros(0, "u8"), np.zeros(0, "u8")
        first, later, slot = (np.array(np.frombuffer(x, "u8")[at]) for x in (self.first, self.later, self.slot))
        starts = np.concatenate([[True], np.frombuffer(self.ends, "i1")[at[:-1]] > 0])
        token = np.where(starts, first, later)
        # A word that stands for itself has no slot.
        slot = np.where((token == first) & (first > NAME), 0, slot)
        some = token > 0
        return token[some], slot[some]


def windows(token: np.ndarray, width: int = WINDOW) -> np.ndarray:
    n = len(token) - width + 1
    if n <= 0:
        return np.zeros(0, "u8")
    out = np.zeros(n, "u8")
    for k in range(width):
        out += mixed(token[k:k + n]) * _POWERS[k]
    return mixed(out)


def _longest(places: np.ndarray) -> int:
    """Length of the longest run of consecutive places."""
    if not len(places):
        return 0
    places = np.unique(places)
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return int(np.diff(np.concatenate([[0], cut, [len(places)]])).max())


class Index:
    """Windows of some items in order of their hashes, and the items' slot values."""

    def __init__(self, items: list[tuple[int, str]]):
        tokens, hashes, item, place, self.tokens, self.slots, counts = Tokens(), [], [], [], [], [], []
        self.ids = [i for i, _ in items]
        for n, (_, text) in enumerate(items):
            token, slot = tokens.of(text)
            w = windows(token)
            hashes.append(w)
            item.append(np.full(len(w), n))
            place.append(np.arange(len(w)))
            self.tokens.append(token)
            self.slots.append(slot)
            counts.append(len(np.unique(w)))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        hashes, self.item, self.place = join(hashes, "u8"), join(item, "i8"), join(place, "i8")
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], self.item[order], self.place[order]
        self.counts = np.array(counts, "i8")
        self.all = join(self.tokens, "u8")
        self.lengths = np.array([len(t) for t in self.tokens], "i8")
        self.base = np.cumsum(self.lengths) - self.lengths
        #: Items shorter than a window by length and hash.
        self.short: dict[int, dict[int, list[int]]] = {}
        for n, token in enumerate(self.tokens):
            if 0 < len(token) < WINDOW:
                self.short.setdefault(len(token), {}).setdefault(int(windows(token, len(token))[0]), []).append(n)

    def matches(self, token: np.ndarray, slot: np.ndarray) -> list[tuple[int, float, int, bool]]:
        """item_id, share of its windows, windows, whether enough have its own slot values."""
        return self._long(token, slot) + self._whole(token, slot)

    def _whole(self, token: np.ndarray, slot: np.ndarray) -> list[tuple[int, float, int, bool]]:
        """Items shorter than a window."""
        found: dict[int, bool] = {}
        for width, items in self.short.items():
            w = windows(token, width)
            for at in np.flatnonzero(np.isin(w, np.array(list(items), "u8"))).tolist():
                theirs = slot[at:at + width]
                for i in items[int(w[at])]:
                    same = bool((self.slots[i] == theirs).all())
                    name = self.tokens[i] == NAME
                    pairs = set(zip(self.slots[i][name].tolist(), theirs[name].tolist()))
                    one_to_one = all(len({p[k] for p in pairs}) == len(pairs) for k in (0, 1))
                    if same or one_to_one and (self.tokens[i] > NAME).any():
                        found[i] = found.get(i, False) or same
        return [(self.ids[i], 1.0, 1, same) for i, same in found.items()]

    def _equal(self, token: np.ndarray, item: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each item at an offset, which of its tokens are equal (two at least side by side)
        in one array, and the number of the pair of each."""
        n = self.lengths[item]
        pair = np.repeat(np.arange(len(item)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = shift[pair] + place
        equal = (at >= 0) & (at < len(token))
        equal &= self.all[self.base[item][pair] + place] == token[np.clip(at, 0, len(token) - 1)]
        both = equal[1:] & equal[:-1] & (pair[1:] == pair[:-1])
        equal[:] = False
        equal[1:] |= both
        equal[:-1] |= both
        return equal, pair

    def _long(self, token: np.ndarray, slot: np.ndarray) -> list[tuple[int, float, int, bool]]:
        w = windows(token)
        if not len(w) or not len(self.hashes):
            return []
        lo = np.searchsorted(self.hashes, w)
        hit = np.flatnonzero(self.hashes[np.minimum(lo, len(self.hashes) - 1)] == w)
        if not len(hit):
            return []
        lo, hi = lo[hit], np.searchsorted(self.hashes, w[hit], "right")
        n = hi - lo
        entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, item, place = np.repeat(hit, n), self.item[entry], self.place[entry]
        out = []
        key, n_at = np.unique((item << 32) + (at - place + (1 << 31)), return_counts=True)
        key_item, key_shift = key >> 32, (key & 0xFFFFFFFF) - (1 << 31)
        equal, pair = self._equal(token, key_item, key_shift)
        items, first = np.unique(key_item, return_index=True)
        sums = np.add.reduceat(np.bincount(pair, equal, len(key)), first)
        edited = (self.lengths[items] >= EDITED_FROM) & (sums >= AT_LEAST * self.lengths[items])
        passage = np.maximum.reduceat(n_at, first) > PASSAGE - WINDOW
        for i, may_edited, may_passage in zip(items, edited, passage):
            mine = item == i
            # Far too few windows whatever the slots say.
            if not may_edited and not may_passage and len(
                    np.unique(self.hashes[entry[mine]])) < AT_LEAST * self.counts[i]:
                continue
            good, same = [], [np.zeros(0, "u8")]
            run, run_same, covers = False, False, []
            shift = at[mine] - place[mine]
            # A window of the document counts at one offset, that with most matches: where an
            # item repeats itself, a name in conflict would be consistent at another one.
            _, which, n = np.unique(shift, return_inverse=True, return_counts=True)
            order = np.lexsort((-n[which], at[mine]))
            best = order[np.diff(at[mine][order], prepend=-1) != 0]
            mine, shift = np.flatnonzero(mine)[best], shift[best]
            for s in np.unique(shift):
                here = mine[shift == s]
                good_here, same_here = self._consistent(i, at[here], place[here], slot)
                good.append(self.hashes[entry[here][good_here]])
                if same_here:
                    same.append(good[-1])
                places = place[here][good_here]
                if _longest(places) > PASSAGE - WINDOW:
                    run, run_same = True, run_same or same_here
                if may_edited and good_here.all():
                    k = np.searchsorted(key, (i << 32) + (s + (1 << 31)))
                    covers.append((len(here), s, same_here, equal[pair == k]))
            n_good, n_same = (len(np.unique(np.concatenate(x))) for x in (good, same))
            enough, enough_same = (x >= AT_LEAST * self.counts[i] for x in (n_good, n_same))
            if covers:
                main = max(covers, key=lambda c: c[0])[1]
                close = [c for c in covers if abs(c[1] - main) <= (1 - AT_LEAST) * self.lengths[i]]
                if np.any([c[3] for c in close], axis=0).sum() >= AT_LEAST * self.lengths[i]:
                    enough, enough_same = True, enough_same or all(c[2] for c in close)
            if enough or run:
                out.append((self.ids[i], n_good / self.counts[i], n_good, bool(enough_same or run_same)))
        return out

    def _consistent(self, i: int, at: np.ndarray, place: np.ndarray, slot: np.ndarray):
        """Windows at one offset that count, and whether all slot values are equal."""
        where = place[:, None] + np.arange(WINDOW)
        own, theirs = self.slots[i][where], slot[at[:, None] + np.arange(WINDOW)]
        name = self.tokens[i][where] == NAME
        pairs = np.unique(np.stack([own[name], theirs[name]]), axis=1)
        bad = np.zeros(own.shape, bool)
        for values, side in zip((own, theirs), pairs):
            value, n = np.unique(side, return_counts=True)
            bad |= name & np.isin(values, value[n > 1])
        return ~bad.any(1), bool((own == theirs).all())


RESULT = "item_id long, share double, n_windows long, same_values boolean"


def _finder(shared):
    state = Tokens()

    def find(texts: pd.Series) -> pd.Series:
        index = shared.value
        return pd.Series([
            [{"item_id": int(i), "share": float(s), "n_windows": int(n), "same_values": bool(v)}
             for i, s, n, v in index.matches(*state.of(t))] for t in texts])

    return F.pandas_udf(find, f"array<struct<{', '.join(f.replace(' ', ':') for f in RESULT.split(', '))}>>")


def indexes(benchmark: DataFrame, most: int = MOST_SENT) -> Iterator[Index]:
    """Indexes of slices of the benchmark, each with a bounded number of windows."""
    items = benchmark.where("item_id is not null").select("item_id", text_or_empty().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    # A window is two characters at least.
    slices = int(total // 2 // most) + 1
    for k in range(slices):
        some = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        yield Index([(r["item_id"], r["text"]) for r in some.orderBy("item_id", "text").toLocalIterator()])


def marked(docs: DataFrame, benchmark: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """``docs`` with ``_items``: the items found in each (item_id, share, windows, values)."""
    context = in_small_batches(docs).sparkSession.sparkContext
    shared = None
    for index in indexes(benchmark, most):
        first = shared is None
        if not first:
            # The last slice's pass is written before this slice is sent: the driver holds two, tasks one.
            docs = kept(docs, "marked")
            shared.destroy()
        shared = context.broadcast(index)
        found = _finder(shared)(text_or_empty())
        docs = docs.withColumn("_items", found if first else F.concat("_items", found))
    return docs


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates."""
    found = marked(packed(docs, "text"), benchmark).where(F.size("_items") == 0)
    return found.select(*unpacked(docs.columns, "text"))
