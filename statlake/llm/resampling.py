"""Quality by importance resampling: hashed n-gram models of target and raw text.

Texts are bags of character 2- and 3-grams hashed into ``BUCKETS`` places, and of word pairs
of which only counts whether both words are the same. The target model counts those of
labelled good documents (a bounded sample), the raw model those of all documents. A
document's log weight is the mean of log(target / raw) over its n-grams (``SHRINK`` n-grams
of ratio 1 are added) times ``LENGTH``: the weight of a passage of that length, so that long
and short documents compete alike. Adding Gumbel noise and taking the k largest draws k
documents without replacement in proportion to their weights; k is the share of good
documents among the labelled ones, and two standard errors of it more, times their number.

Results for odd input: a NULL or empty text has log weight 0 and takes part as such; without
labels, or without good ones, all documents stay and all weights are 0; rows with equal keys
(repeated rows) stay or go together; an empty table gives an empty result. The noise depends
on doc_id and a seed alone, so reruns agree. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from statlake.llm.common import (code_points, in_small_batches, kept, kth_largest, packed, text_or_empty, uniform,
                                 unpacked)

BUCKETS = 1 << 16
SAMPLE = 20_000
SMOOTHING = 1.0
LENGTH, SHRINK = 400, 300
#: Places of word pairs: different words, the same word.
PAIR = np.array([0, 1])
SEED = 20_17


def gram_places(text: str) -> np.ndarray:
    x = code_points(text).astype("u8")
    if len(x) < 2:
        return np.zeros(0, "i8")
    pairs = x[:-1] * np.uint64(0x110000) + x[1:]
    triples = pairs[:-1] * np.uint64(0x110000) + x[2:] + np.uint64(1 << 63)
    both = np.concatenate([pairs, triples]) * np.uint64(0x9E3779B97F4A7C15)
    places = (both >> np.uint64(48)).astype("i8")
    words = text.split()
    same = sum(map(eq, words, words[1:]))
    return np.concatenate([places, np.repeat(PAIR, [max(0, len(words) - 1 - same), same])])


def _counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, target = np.zeros(BUCKETS, "i8"), np.zeros(BUCKETS, "i8")
    for batch in batches:
        for text, good in zip(batch["text"], batch["good"]):
            places = gram_places(text)
            counts = np.bincount(places, minlength=BUCKETS) if len(places) > 5000 else None
            for into in [raw, target][:1 + int(good)]:
                if counts is None:
                    np.add.at(into, places, 1)
                else:
                    into += counts
    used = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": used.astype("i4"), "raw": raw[used], "target": target[used]})


def labelled(labels: DataFrame, sample: int) -> DataFrame:
    """The labels with the least hashes of their doc_id, ``sample`` at most."""
    rows = labels.where("doc_id is not null and quality is not null").select(
        "doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).alias("good"),
        (F.col("quality") == 1).alias("fit"))
    return (rows.groupBy("doc_id").agg(F.min("good").alias("good"), F.min("fit").alias("fit"))
            .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Log ratios by bucket and the share of documents to keep."""
    some = kept(labelled(labels, sample), "labelled")
    n, fit_ones = some.agg(F.count("*"), F.coalesce(F.sum(F.col("fit").cast("long")), F.lit(0))).first()
    if not fit_ones:
        return np.zeros(BUCKETS, "f4"), 1.0
    # The sample is bounded by its parameter, hence small enough for every task.
    marked = in_small_batches(docs).select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(some.select("doc_id", "good")), "doc_id", "left")
    rows = (marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
            .mapInPandas(_counted, "bucket int, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    if not target.sum():
        return np.zeros(BUCKETS, "f4"), 1.0
    p = (target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    share = fit_ones / n
    return np.log(p / q).astype("f4"), min(1.0, share + 2 * (share * (1 - share) / n) ** 0.5)


def log_weight(docs: DataFrame, ratios: np.ndarray) -> Column:
    shared = in_small_batches(docs).sparkSession.sparkContext.broadcast(ratios)

    @F.pandas_udf(DoubleType())
    def weigh(texts: pd.Series) -> pd.Series:
        table = shared.value
        found = (table[gram_places(t)] for t in texts)
        return pd.Series([LENGTH * float(x.sum(dtype="f8")) / (len(x) + SHRINK) for x in found], dtype="f8")

    return weigh(text_or_empty())


def noise(seed: int = SEED) -> Column:
    """Gumbel noise that depends on the doc_id alone."""
    return -F.log(-F.log(uniform(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(seed))))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None,
             sample: int = SAMPLE) -> tuple[DataFrame, float | None, np.ndarray]:
    """doc_id, log_weight and key of all documents, the least key kept, and the ratios."""
    ratios, learned = fit(docs, labels, sample)
    scored = docs.select("doc_id", log_weight(docs, ratios).alias("log_weight"))
    scored = kept(scored.withColumn("key", F.col("log_weight") + noise()), "weights")
    k = int(round((learned if share is None else share) * scored.count()))
    return scored, kth_largest(scored, "key", k), ratios


def keep_documents(docs: DataFrame, labels: DataFrame, share: float | None = None,
                   sample: int = SAMPLE) -> DataFrame:
    """The documents drawn, with all their columns and no others."""
    _, least, ratios = resample(docs, labels, share, sample)
    if least is None:
        return docs.limit(0)
    rows = packed(docs, "doc_id", "text").withColumn("_key", log_weight(docs, ratios) + noise())
    return rows.where(F.col("_key") >= least).select(*unpacked(docs.columns, "doc_id", "text"))
