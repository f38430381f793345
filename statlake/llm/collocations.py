"""Collocations from count streams in prefix and suffix order.

Counting goes by length: words first, then pairs of words, then phrases of three, each only
where both parts one word shorter are frequent, for a phrase is never more frequent than its
parts. Tasks learn which parts are frequent from a bit table of fixed size (``BITS``), so some
rare phrases are counted in vain and none is missed. Tasks sum in blocks before the shuffle,
and phrases travel as their texts, so counts are exact.

The frequent words and phrases of all lengths then form one stream. Dealt and sorted by range
of their words from the first to the last (prefix order), each phrase follows its first word
and its first two words, so one walk gives the counts of both and, for each pair, its most
frequent extension to the right. The same walk in the order of the words from the last to
the first (suffix order) gives the counts of the last word and the last two words, and the
extension to the left. Nothing is looked up in a hash table. Ranges are cut by whole phrases, which
are all different, so that no word, however frequent, makes a range large; what a walk needs
from the range before is passed on in one row a range (of ``RANGE`` phrases).

``a``, ``l``, ``r`` and ``n`` are counts of the phrase, its parts and all words of the language;
the score of a cut is floor(1000000 a a / (l r)), in decimals of 38 digits: exact up to a count of 10^16.

Results for odd input: a NULL text is empty, a NULL language ``und``; empty texts and pieces hold no
words; repeated rows each count; ties of scores are ordered by count and text; an empty
table gives an empty result. A very long text is split into words at once and counted in
slices; memory grows with the longest text. Other columns are not used.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from statlake.llm.common import kept, mixed, text_or_empty

LEAST = 10
LONGEST = 3
#: A candidate is part of a longer one that has this share of its count (per cent).
ABSORBED = 50
TOP, SALTS = 2000, 16
BITS = 1 << 26
#: Words, or different phrases, that a task holds before it hands its sums on; words in a slice.
WORDS_HELD, PHRASES_HELD, SLICE = 1 << 18, 400_000, 1 << 16
#: Rows of a batch handed on.
SENT = 50_000
RANGE = 100_000

#: What ends a piece. Every one becomes a word of its own, which no phrase holds.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TO_BREAK = bytes.maketrans(BREAKS, b"." * len(BREAKS))
BREAK = b"."


def tokens(text: str) -> list[bytes]:
    """The words of a text in lower case (A to Z only), pieces parted by ``BREAK``."""
    # For bytes, lower() and split() know ASCII only, and all other white space are breaks.
    return text.encode().lower().translate(_TO_BREAK).replace(BREAK, b" . ").split()


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


class Held:
    """Numbers for the words a task has met, and counts of phrases of them."""

    def __init__(self, size: int, frequent: np.ndarray):
        self.size, self.frequent = size, frequent
        self.clear()

    def clear(self) -> None:
        numbers = count()
        self.words: dict[bytes, dict[bytes, int]] = defaultdict(lambda: defaultdict(numbers.__next__))
        self.hashes, self.known, self.n = np.zeros(1 << 12, "u8"), np.zeros(1 << 12, bool), 0
        self.keys, self.counts, self.pending = [], [], 0

    def _seen(self, lang: bytes, part: list[bytes]) -> np.ndarray:
        own = self.words[lang]
        before = len(own)
        ids = np.fromiter(map(own.__getitem__, part), "i8", len(part))
        new = [*islice(reversed(own), len(own) - before)][::-1]
        end = self.n + len(new)
        if end > len(self.hashes):
            self.hashes = np.resize(self.hashes, 2 * end)
            self.known = np.resize(self.known, 2 * end)
        hashes = np.array([word_hash(lang, w) for w in new], "u8")
        self.hashes[self.n:end] = hashes
        self.known[self.n:end] = self._has(hashes) & np.array([w != BREAK for w in new], bool)
        self.n = end
        return ids

    def _has(self, hashes: np.ndarray) -> np.ndarray:
        if self.size == 3:
            return np.ones(len(hashes), bool)
        at = hashes % np.uint64(BITS)
        return (self.frequent[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def add(self, lang: bytes, part: list[bytes]) -> None:
        ids = self._seen(lang, part)
        use = self.known[ids]
        if self.size == 2:
            found = (use[:-1] & use[1:]).nonzero()[0]
            keys = ids[found] << 21 | ids[found + 1]
        else:
            pairs = (use[:-1] & use[1:]).nonzero()[0]
            at = pair_hash(self.hashes[ids[pairs]], self.hashes[ids[pairs + 1]]) % np.uint64(BITS)
            pairs = pairs[(self.frequent[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)]
            found = pairs[:-1][np.diff(pairs) == 1]
            keys = ids[found] << 42 | ids[found + 1] << 21 | ids[found + 2]
        keys, n = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(n)
        self.pending += len(keys)
        if self.pending > 2 * PHRASES_HELD:
            self._merge()

    def _merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        keys, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, weights=counts, minlength=len(keys)).astype("i8")
        self.keys, self.counts, self.pending = [keys], [counts], len(keys)

    def full(self) -> bool:
        return self.n > WORDS_HELD or self.pending > PHRASES_HELD and len(self.keys) == 1

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that is held, as language, phrase and count."""
        if not self.keys:
            self.clear()
            return
        self._merge()
        words, langs = np.empty(self.n, object), np.empty(self.n, object)
        for lang, own in self.words.items():
            at = np.fromiter(own.values(), "i8", len(own))
            words[at], langs[at] = list(own), lang
        words, langs = pa.array(words, pa.binary()), pa.array(langs, pa.binary())
        keys, counts = self.keys[0], self.counts[0]
        self.clear()
        for at in range(0, len(keys), SENT):
            parts = [keys[at:at + SENT] >> 21 * k & (1 << 21) - 1 for k in range(self.size)][::-1]
            phrase = pc.binary_join_element_wise(*[words.take(pa.array(p)) for p in parts], b" ")
            yield _rows(langs.take(pa.array(parts[0])), phrase, counts[at:at + SENT])


def _rows(langs, phrases, counts) -> pa.RecordBatch:
    text = [pa.array(x, pa.binary()) if isinstance(x, list) else x for x in (langs, phrases)]
    return pa.RecordBatch.from_arrays([x.cast(pa.string()) for x in text] + [pa.array(counts, pa.int64())],
                                      ["lang", "phrase", "f"])


def _slices(batches: Iterable[pa.RecordBatch], overlap: int) -> Iterator[tuple[bytes, list[bytes]]]:
    """Language and words of several texts at once, or of a slice of a long one."""
    for batch in batches:
        held: dict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(batch["lang"], batch["text"]):
            words = held[lang.as_py()]
            words += tokens(text.as_py())
            words.append(BREAK)
            if len(words) > SLICE:
                for at in range(0, len(words), SLICE):
                    yield lang.as_py().encode(), words[at:at + SLICE + overlap]
                words.clear()
        for lang, words in held.items():
            if words:
                yield lang.encode(), words


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and, under the empty phrase, the number of all words of the language."""
    found: dict[bytes, Counter] = defaultdict(Counter)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, own in found.items():
            words, n = list(own), list(own.values())
            for at in range(0, len(words), SENT):
                some = words[at:at + SENT]
                yield _rows([lang] * len(some), some, n[at:at + SENT])
        found.clear()

    for lang, words in _slices(batches, 0):
        own = found[lang]
        own.update(words)
        breaks = own.pop(BREAK, 0)
        own[b""] += len(words) - breaks
        if sum(map(len, found.values())) > WORDS_HELD:
            yield from rows()
    yield from rows()


def _frequent(docs: DataFrame, counter: Callable) -> DataFrame:
    counts = docs.mapInArrow(counter, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"))
    return kept(counts.where((F.col("f") >= LEAST) | (F.col("phrase") == "")), "counts")


def bit_table(phrases: DataFrame) -> np.ndarray:
    """A bit for the hash of every word or pair: ``BITS`` / 64 numbers, however many there are."""
    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BITS // 64, "u8")
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist()):
                hashes.append([word_hash(lang.encode(), w) for w in phrase.encode().split(b" ")])
            h = np.array(hashes, "u8")
            if len(h):
                at = (pair_hash(h[:, 0], h[:, 1]) if h.shape[1] == 2 else h[:, 0]) % np.uint64(BITS)
                np.bitwise_or.at(table, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        used = table.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used].view("i8"))], ["at", "bits"])

    rows = (phrases.select("lang", "phrase").mapInArrow(mark, "at long, bits long")
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    table = np.zeros(BITS // 64, "u8")
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy().view("u8")
    return table


def counted(docs: DataFrame) -> DataFrame:
    """lang, phrase and f of all words and phrases with ``LEAST`` occurrences, and of all words ('')."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    levels = [_frequent(rows, _count_words)]
    for size in range(2, LONGEST + 1):
        shared = docs.sparkSession.sparkContext.broadcast(bit_table(levels[-1].where("phrase <> ''")))

        def count_phrases(batches, size=size, shared=shared):
            held = Held(size, shared.value)
            for lang, words in _slices(batches, size - 1):
                held.add(lang, words)
                if held.full():
                    yield from held.rows()
            yield from held.rows()

        levels.append(_frequent(rows, count_phrases))
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


WALKED = "lang string, k1 string, k2 string, k3 string, {0}, one long, two long, more long, range int, size int"


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range in order: counts of the first word and pair, the greatest extension of a pair.

    The last row, of size 0, tells the next ranges of the last word and pair, and those before of the
    greatest extension of a pair that began there.
    """
    batches = list(batches)
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    f, size = rows["f"].to_numpy(), np.full(len(rows), 3)
    size[rows["k3"].is_null().to_numpy()] = 2
    size[rows["k2"].is_null().to_numpy()] = 1
    place = np.arange(len(f))

    def last(k: int) -> np.ndarray:
        return np.maximum.accumulate(np.where(size == k, place, -1)) if len(f) else place

    first, pair = last(1), last(2)
    pair = np.where(size == 3, pair, -1)
    more = np.zeros(len(f) + 1, "i8")
    # Extensions of a pair from an earlier range are gathered at the place after the end.
    np.maximum.at(more, pair[size == 3], f[size == 3])

    def told(at: np.ndarray, least: int) -> pa.Array:
        mask = (at < 0) | (size < least)
        return pa.array(np.where(mask, 0, f[np.maximum(at, 0)]) if len(f) else f, pa.int64(), mask=mask)

    number = TaskContext.get().partitionId()
    ones, twos = (np.flatnonzero(size == k) for k in (1, 2))
    mark = {"one": f[ones[-1]] if len(ones) else None, "two": f[twos[-1]] if len(twos) else None,
            "more": more[-1], "range": number, "size": 0}
    out = rows.append_column("one", told(first, 2)).append_column("two", told(pair, 3))
    out = out.append_column("more", pa.array(more[:-1])).append_column(
        "range", pa.array(np.full(len(f), number), pa.int32())).append_column("size", pa.array(size, pa.int32()))
    # The pair that the next range may go on with is the last row of size 2.
    if len(twos):
        mark["k1"], mark["k2"], mark["lang"] = (rows[c][int(twos[-1])].as_py() for c in ("k1", "k2", "lang"))
    marks = pa.Table.from_pylist([{c: int(v) if isinstance(v, np.integer) else v for c, v in mark.items()}])
    out = pa.concat_tables([out, pa.table({c: marks[c].cast(out.schema.field(c).type) if c in marks.column_names
                                           else pa.nulls(1, out.schema.field(c).type) for c in out.column_names})])
    yield from out.combine_chunks().to_batches()


def walked(rows: DataFrame, keys: list[Column], names: tuple[str, str, str], n: int) -> DataFrame:
    """The rows and, by the order of ``keys``, the counts of their first key, first two and
    the greatest count of an extension by a third, under ``names``."""
    own = [c for c in rows.columns if c not in ("lang", "k1", "k2", "k3")]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
    stream = rows.select("lang", *[k.alias(f"k{i}") for i, k in enumerate(keys, 1)], *own)
    order = ["lang", "k1", "k2", "k3"]
    stream = stream.repartitionByRange(max(1, -(-n // RANGE)), *order).sortWithinPartitions(*order)
    found = kept(stream.mapInArrow(_walk, WALKED.format(kinds)), "walk")
    # One row a range: the last word and pair so far, and what later ranges add to the last pair.
    marks = sorted(found.where("size = 0").select("range", "lang", "k1", "k2", "one", "two", "more").collect())
    carried, added, one, two, tail = [], [], None, None, None
    for m in marks:
        carried.append((m["range"], one, two))
        if m["more"] and tail:
            added.append((*tail, m["more"]))
        one = m["one"] or one
        two, tail = (m["two"], (m["lang"], m["k1"], m["k2"])) if m["two"] else (two, tail)
    spark = rows.sparkSession
    carried = spark.createDataFrame(carried, "range int, c_one long, c_two long")
    added = (spark.createDataFrame(added, "lang string, k1 string, k2 string, c_more long")
             .groupBy("lang", "k1", "k2").agg(F.max("c_more").alias("c_more")))
    # Both have one row a range at most.
    found = found.where("size > 0").join(F.broadcast(carried), "range", "left")
    found = found.join(F.broadcast(added), ["lang", "k1", "k2"], "left")
    pair = F.col("size") == 2
    return found.select(
        "lang", "k1", "k2", "k3", *own,
        F.when(F.col("size") > 1, F.coalesce("one", "c_one")).alias(names[0]),
        F.when(F.col("size") > 2, F.coalesce("two", "c_two")).alias(names[1]),
        F.when(pair, F.greatest("more", F.coalesce("c_more", F.lit(0)))).alias(names[2]))


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their parts' counts and score, those within a longer one left out."""
    streams = phrases.where("phrase <> ''")
    n = streams.count()
    words = F.split("phrase", " ")
    rows = streams.select("lang", F.get(words, 0).alias("k1"), F.get(words, 1).alias("k2"),
                          F.get(words, 2).alias("k3"), "f")
    rows = walked(rows, [F.col("k1"), F.col("k2"), F.col("k3")], ("first", "first_two", "right"), n)
    # Back to front: the last word comes first.
    k1, k2, k3 = F.col("k1"), F.col("k2"), F.col("k3")
    back = [F.coalesce(k3, k2, k1), F.when(k3.isNotNull(), k2).when(k2.isNotNull(), k1), F.when(k3.isNotNull(), k1)]
    rows = walked(rows, back, ("last", "last_two", "left"), n)
    found = rows.where("k2 is not null").select(
        "lang", F.concat_ws(" ", "k3", "k2", "k1").alias("phrase"), F.col("f").alias("a"),
        F.col("k3").isNull().alias("short"), "first", "first_two", "last", "last_two",
        F.greatest("right", "left").alias("longer"))
    return _with_score(found)


def _with_score(found: DataFrame) -> DataFrame:
    def score(left: str, right: str) -> Column:
        whole = "cast({0} as decimal(19, 0))"
        return F.expr(f"{whole.format('a')} * {whole.format('a')} * 1000000 div "
                      f"({whole.format(left)} * {whole.format(right)})")

    found = found.where(~F.col("short") | (100 * F.coalesce("longer", F.lit(0)) < ABSORBED * F.col("a")))
    at_one = F.when(F.col("short"), score("first", "last")).otherwise(score("first", "last_two"))
    at_two = F.when(~F.col("short"), score("first_two", "last"))
    found = found.withColumn("s1", at_one).withColumn("s2", at_two)
    later = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    return found.select(
        "lang", "phrase", "a", F.when(later, F.col("first_two")).otherwise(F.col("first")).alias("l"),
        F.when(later | F.col("short"), F.col("last")).otherwise(F.col("last_two")).alias("r"),
        F.when(later, F.col("s2")).otherwise(F.col("s1")).alias("score"))


def top(docs: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best of every language: lang, rank, phrase, a, l, r, n, score."""
    phrases = counted(docs)
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    # First among the phrases of a salt: the last choice sees k rows of each salt at most.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    ranked = scored(phrases)
    for group in (("lang", salt), ("lang",)):
        best = Window.partitionBy(*group).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    total = phrases.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
