"""Toxicity by a weighted lexicon with exception phrases, matched by Aho-Corasick.

Texts are folded first: compatibility forms and case, invisible characters, look-alike letters
of other scripts, digits and signs that stand for letters inside a word. What is left are
words with one space around each. A lexicon entry is a space and the beginning of a word
(``STEM`` characters at least), or a space, a whole word and a space; its weight is the log
ratio of the share of toxic to the share of clean learning texts with it. At the start of a
word the longest entry counts. An exception is a word, or a pair of neighbours, around an
entry that clean texts use no less than toxic ones: entries inside it don't count. The
summed weight, as such and over the number of words, goes through a logistic curve fitted
on the learning texts.

The learning texts are a bounded sample: of each label the ``SAMPLE`` rows with the least
hashes of their doc_id; texts that occur again count once. Entries need ``SUPPORT``
different toxic texts, a weight of ``LEAST`` and, as many terms are tried, evidence against
chance of ``EVIDENCE`` nats (the bound for a binomial tail); the ``ENTRIES`` strongest are kept.
All documents are scored, whole.

Results for odd input: a NULL or empty text holds no entry and gets the score of such texts;
without labels, or without toxic ones, there are no entries and all scores are 0; a doc_id with
both labels is not learned from, nor are NULL labels or doc_ids; repeated rows are each scored,
with equal scores, as only the text counts; an empty table gives an empty result. Very
long texts take time and memory in proportion to their length. Other columns stay as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from statlake.llm.common import kept, text_or_empty

SAMPLE = 12_000
SUPPORT = 3
LEAST = 3.0
EVIDENCE = 7.0
ENTRIES = 2_000
#: Least and greatest length of a stem.
STEM, LONG_STEM = 3, 8
#: An exception needs so many clean texts.
CLEAN = 3
#: Counters of a task are handed on at this size.
HELD = 500_000
SEED = 11
RIDGE = 0.05

#: Letters of other scripts (lower case) that look like the Latin ones below them.
LOOKS_LIKE = str.maketrans(
    "аеорсухіјѕкмтнвԁԛԝһӏɑαεικνορτυχɡıⅼ",
    "aeopcyxijskmthbdqwhlaaeiknoptuxgil")
#: Digits and signs written for letters.
STANDS_FOR = str.maketrans("0134578@$!|", "oieastbasil")
#: Soft hyphen, zero width characters, direction marks, word joiner, byte order mark.
INVISIBLE = re.compile("[­​-‏‪-‮⁠﻿]")

_OTHER = re.compile("[ıɑɡͰ-ԯⅼ]")
_WORD = re.compile(r"[^\W_]+")
#: Marks around most words; none of them stands for a letter there.
_MARKS = ".,;:!?\"'()"
_SIGN = re.compile(r"[@$!|]+(?=[^\W\d_])")


def _as_letters(m: re.Match) -> str:
    """Signs before a letter as letters; "!" and "|" only within a word."""
    inside = m.start() and m.string[m.start() - 1].isalnum()
    return m[0].translate(STANDS_FOR) if inside or not set(m[0]) & {"!", "|"} else m[0]


def folded(text: str) -> str:
    """The words of a text as they are matched, with one space around each."""
    if not text.isascii():
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    text = text.casefold()
    if not text.isascii() and _OTHER.search(text):
        text = text.translate(LOOKS_LIKE)
    words = []
    for token in text.split():
        if token.isalpha() or (token := token.strip(_MARKS)).isalpha():
            words.append(token)
        else:
            found = _WORD.findall(_SIGN.sub(_as_letters, token))
            words += [w if w.isalpha() or w.isdigit() else w.translate(STANDS_FOR) for w in found]
    return f" {' '.join(words)} " if words else " "


@dataclass
class Lexicon:
    entries: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-np.inf, 0.0, 0.0)

    def __post_init__(self):
        self._matcher = None

    def __getstate__(self):
        return self.__dict__ | {"_matcher": None}

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, entry) of what counts in a folded text, one at a place at most."""
        if not self.entries:
            return []
        if self._matcher is None:
            self._matcher = ahocorasick.Automaton()
            for entry in [*self.entries, *self.exceptions]:
                self._matcher.add_word(entry, entry)
            self._matcher.make_automaton()
        longest: dict[int, str] = {}
        spared: list[tuple[int, int]] = []
        for last, entry in self._matcher.iter(text):
            start = last - len(entry) + 1
            if entry in self.exceptions:
                spared.append((start, last + 1))
            elif len(entry) > len(longest.get(start, "")):
                longest[start] = entry
        found, at, until = [], 0, -1
        spared.sort()
        for start, entry in sorted(longest.items()):
            # The furthest end of all exceptions that begin here or before.
            while at < len(spared) and spared[at][0] <= start:
                until = max(until, spared[at][1])
                at += 1
            if start + len(entry) > until:
                found.append((start, start + len(entry), entry))
        return found

    def features(self, text: str, hits: list[tuple[int, int, str]]) -> tuple[float, float]:
        """The weight of a folded text, and by its length."""
        weight = sum(self.entries[e] for _, _, e in hits)
        return math.log1p(weight), math.log1p(100 * weight / (text.count(" ") + 20))

    def score(self, text: str, hits: list[tuple[int, int, str]]) -> float:
        if not self.entries:
            return 0.0
        x = self.curve[0] + sum(b * f for b, f in zip(self.curve[1:], self.features(text, hits)))
        return 1 / (1 + math.exp(-max(min(x, 700.0), -700.0)))


def sampled(labels: DataFrame, learned_from: str, sample: int) -> DataFrame:
    """doc_id and label of the rows to learn from, ``sample`` of each label at most."""
    rows = (labels.where(learned_from).where("doc_id is not null and toxic in (0, 1)")
            .groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic"))
            .where("low = toxic").drop("low"))
    order = F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id")
    some = [rows.where(F.col("toxic") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    return some[0].unionByName(some[1])


def _terms(text: str) -> set[str]:
    words = set(text.split())
    stems = {f" {w[:n]}" for w in words for n in range(STEM, min(len(w), LONG_STEM) + 1)}
    return stems | {f" {w} " for w in words}


def _around(text: str, lexicon: Lexicon) -> set[str]:
    """The words around entries, and pairs of them and their neighbours."""
    found = set()
    for start, _, _ in lexicon.hits(text):
        end = text.index(" ", start + 1) + 1
        before, after = text.rfind(" ", 0, start), text.find(" ", end)
        found.add(text[start:end])
        if before >= 0:
            found.add(text[before:end])
        if after >= 0:
            found.add(text[start:after + 1])
    return found


def _counted(rows: DataFrame, terms) -> DataFrame:
    """term and its number of clean and toxic texts, summed in tasks first."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            out = [pa.array([t for c in n for t in c], pa.string()),
                   pa.array([k for k, c in enumerate(n) for _ in c], pa.int32()),
                   pa.array([v for c in n for v in c.values()], pa.int64())]
            for c in n:
                c.clear()
            return pa.RecordBatch.from_arrays(out, ["term", "toxic", "n"])

        for batch in batches:
            for text, toxic in zip(batch["folded"], batch["toxic"]):
                n[toxic.as_py()].update(terms(text.as_py()))
                if len(n[0]) + len(n[1]) > HELD:
                    yield rows()
        yield rows()

    spread = rows.select("folded", "toxic").mapInArrow(count, "term string, toxic int, n long")
    return spread.groupBy("term").agg(
        *[F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(c)
          for k, c in enumerate(("clean", "toxic"))])


def _shortest(strongest: Iterable[tuple[str, float]]) -> dict[str, float]:
    """Entries without those that a shorter one of no less weight stands for."""
    weights = dict(strongest)
    def covered(e: str) -> bool:
        return any(weights.get(e[:n], -1.0) >= weights[e] - 1e-9 for n in range(STEM + 1, len(e)))
    return {e: w for e, w in weights.items() if not covered(e)}


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """A logistic regression with a ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    ridge = RIDGE * np.diag([0.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        left = (x.T * (p * (1 - p))) @ x + ridge + 1e-9 * np.eye(len(b))
        step = np.linalg.solve(left, x.T @ (y - p) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, b))


def learn(docs: DataFrame, labels: DataFrame, learned_from: str = "true", sample: int = SAMPLE,
          exceptions: Iterable[str] = ()) -> Lexicon:
    """A lexicon from the labels for which the SQL condition ``learned_from`` holds.

    ``exceptions`` are further phrases in which entries don't count.
    """
    # Bounded by the sample, hence small enough for every task.
    some = F.broadcast(sampled(labels.select("doc_id", "toxic"), learned_from, sample))
    fold = F.pandas_udf(lambda texts: texts.map(folded), "string")
    rows = (docs.select("doc_id", text_or_empty().alias("text")).join(some, "doc_id")
            .select("toxic", fold("text").alias("folded"))
            .groupBy("toxic", F.xxhash64("folded").alias("h"), F.length("folded").alias("n"))
            .agg(F.min("folded").alias("folded")))
    rows = kept(rows.select("folded", F.col("toxic").cast("int").alias("toxic")), "toxicity")
    total = dict(rows.groupBy("toxic").count().collect())
    if not total.get(1):
        return Lexicon()
    share = [lambda c, k=k: (F.col(c) + 0.5) / (total.get(k, 0) + 1) for k in (0, 1)]
    weight = F.log(share[1]("toxic") / share[0]("clean"))
    base = total[1] / sum(total.values())
    n = F.col("toxic") + F.col("clean")
    evidence = (F.col("toxic") * F.log(F.col("toxic") / (n * base))
                + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - base)))).otherwise(0.0))
    best = (_counted(rows, _terms).where(F.col("toxic") >= SUPPORT).withColumn("weight", weight)
            .where((F.col("weight") >= LEAST) & (evidence >= EVIDENCE))
            .orderBy(F.desc(F.col("weight") * F.col("toxic")), "term").limit(ENTRIES).collect())
    lexicon = Lexicon(_shortest((r["term"], r["weight"]) for r in best))
    around = _counted(rows, lambda text: _around(text, lexicon))
    spared = (around.where((F.col("clean") >= CLEAN) & (share[1]("toxic") <= share[0]("clean")))
              .orderBy(F.desc("clean"), "term").limit(ENTRIES).collect())
    lexicon.exceptions = frozenset(r["term"] for r in spared) | {folded(e) for e in exceptions}
    lexicon._matcher = None
    # Two numbers and a label for each row of the sample.
    measure = F.pandas_udf(lambda texts: texts.map(lambda t: list(lexicon.features(t, lexicon.hits(t)))), "array<double>")
    points = rows.select("toxic", measure("folded").alias("x")).toPandas()
    lexicon.curve = fit_curve(np.array(points["x"].tolist()), points["toxic"].to_numpy("f8"))
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon, name: str = "toxicity") -> DataFrame:
    """The documents and a column: score (0 to 1), number of words, the entries found in order."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("struct<score:double,n_words:long,hits:array<string>>")
    def score(texts: pa.Array) -> pa.Array:
        lexicon = shared.value
        rows = []
        for text in texts:
            text = folded(text.as_py())
            hits = lexicon.hits(text)
            rows.append({"score": lexicon.score(text, hits), "n_words": text.count(" ") - 1,
                         "hits": [e.strip() for _, _, e in hits]})
        return pa.array(rows, pa.struct([("score", pa.float64()), ("n_words", pa.int64()),
                                         ("hits", pa.list_(pa.string()))]))

    return docs.withColumn(name, score(text_or_empty()))
