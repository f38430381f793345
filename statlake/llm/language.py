"""Language identification: blended-spectrum presence kernels, Nystroem landmarks, ridge.

A text is the set of its 1-, 2- and 3-grams of letters (lower case, all else is one space
character), hashed into ``WIDTH`` places. The kernel of two texts is the number of shared
places over the root of the product of their sizes. ``LANDMARKS`` learning texts span the
feature space; a ridge regression in it, one target a language, gives the scores. Texts
are scored a batch at a time: (batch x places) @ (places x landmarks) @ (landmarks x
languages).

Results for odd input: a NULL text or one without a letter is ``und`` with score 0; rows
without a language or with a NULL doc_id are never learned from; nothing to learn from
makes every text ``und``; repeated rows get equal results. Equal scores: the language that
comes first by code point. Other columns are not looked at.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from statlake.llm.common import code_points, in_small_batches, text_or_empty, uniform

WIDTH = 8192
LANDMARKS = 192
#: The learning sample: so many rows of each language, and so many in all, at most.
PER_LANGUAGE, SAMPLE = 400, 3000
RIDGE = 1e-2
SCORED_AT_ONCE = 256

_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter(
            (unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)),
            bool, sys.maxunicode + 1))
    return _LETTERS[0]


def presence(text: str) -> np.ndarray | None:
    """The places of a text as booleans; None if it has no letter."""
    codes = code_points(text.lower())
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    x = np.where(letter, codes, 32).astype("u8")
    seen = np.zeros(WIDTH, bool)
    gram = np.zeros(len(x), "u8")
    for n in range(3):
        if len(x) <= n:
            break
        gram = gram[:len(x) - n] * np.uint64(0x10FFFF + 8) + x[n:]
        place = (gram + np.uint64(n << 62 & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        seen[(place >> np.uint64(51)).astype("i8")] = True
    return seen


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # (m, WIDTH), divided by the root of each one's size
    weights: np.ndarray  # (m, languages)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = rows.astype("f4")
        x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return (x @ self.landmarks.T) @ self.weights


def fit(rows: np.ndarray, names: list[str]) -> Model | None:
    """Nystroem features of the learning texts and a ridge regression on them."""
    languages = sorted(set(names))
    if not languages:
        return None
    x = rows.astype("f4")
    x /= np.sqrt(x.sum(1, keepdims=True))
    # Rows come in turn from each language, so the first ones cover all of them.
    marks = x[:LANDMARKS]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype("f8"))
    large = values > values.max() * 1e-6
    root = vectors[:, large] / np.sqrt(values[large])
    features = (x @ marks.T).astype("f8") @ root
    wanted = np.array([[1.0 if n == k else -1.0 for k in languages] for n in names])
    left = features.T @ features + RIDGE * len(x) * np.eye(features.shape[1]) / 100
    weights = root @ np.linalg.solve(left, features.T @ wanted)
    return Model(languages, marks, weights.astype("f4"))


def _packed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [presence(t) for t in batch["text"]]
        has = [f is not None for f in found]
        yield pd.DataFrame({
            "rank": batch["rank"][has], "lang": batch["lang"][has], "order": batch["order"][has],
            "places": [np.packbits(f).tobytes() for f in found if f is not None]})


def learn(docs: DataFrame, learned_from: str, per_language: int = PER_LANGUAGE,
          sample: int = SAMPLE) -> Model | None:
    """A model of the rows for which the SQL condition ``learned_from`` holds.

    The sample is the rows with the least hashes of their doc_id in each language. It is
    chosen without texts, and its size is bounded by ``sample``.
    """
    some = in_small_batches(docs).where(learned_from).where("lang is not null and text is not null").select(
        "doc_id", "lang", uniform(F.col("doc_id"), F.lit(7)).alias("order"))
    # The hash alone leaves about four times the rows wanted of each language, however many
    # there are; only these are put in order. No more languages than rows can be learned.
    counts = some.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample)
    some = some.join(F.broadcast(counts), "lang").where(F.col("order") * F.col("n") <= 4 * per_language).drop("n")
    by_hash = W.partitionBy("lang").orderBy("order", "doc_id")
    ids = (some.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= per_language)
           .orderBy("rank", "order").limit(sample))
    chosen = (docs.where(learned_from).where("text is not null").select("doc_id", "lang", "text")
              .join(F.broadcast(ids), ["doc_id", "lang"]))
    rows = (chosen.select("rank", "lang", "order", "text")
            .mapInPandas(_packed, "rank int, lang string, order double, places binary")
            .orderBy("rank", "order").limit(sample).collect())
    if not rows:
        return None
    places = np.unpackbits(np.array([np.frombuffer(r["places"], "u1") for r in rows]), axis=1)
    return fit(places.astype(bool), [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, *extra) -> DataFrame:
    """``lang_pred`` and ``score`` beside doc_id and further columns of plain types.

    The score is half the lead over the second language, from 0 to 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = in_small_batches(docs).select("doc_id", *extra, text_or_empty().alias("_text"))
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            for at in range(0, len(batch), SCORED_AT_ONCE):
                some = batch.iloc[at:at + SCORED_AT_ONCE]
                found = [presence(t) for t in some["_text"]]
                names, sure = np.array(["und"] * len(some), object), np.zeros(len(some))
                has = np.array([f is not None for f in found])
                if model is not None and has.any():
                    s = model.scores(np.array([f for f in found if f is not None]))
                    names[has] = np.array(model.languages, object)[s.argmax(1)]
                    top = np.sort(np.hstack([s, np.full((len(s), 1), -1.0)]), axis=1)
                    sure[has] = np.clip((top[:, -1] - top[:, -2]) / 2, 0, 1)
                yield some.drop(columns="_text").assign(lang_pred=names, score=sure)

    return rows.mapInPandas(score, schema)
