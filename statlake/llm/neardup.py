"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its shingles of five words (lower case), each weighted by its count times
ln(1 + N / n), n the number of documents in the shingle's hash bucket (``BUCKETS`` buckets;
a shingle of its own keeps the same weight at every corpus size, as N and the bucket's n grow
alike). ``BANDS`` x ``ROWS`` samples make a sketch; texts that share a band are candidates.
Inside a band each text is tried against one centre, and against a centre among those that
also share the ``MORE`` samples after the band. All bands draw their centres by one order, so
a text of a large group meets the same few centres again and has few pairs. Candidates are
links if their weighted Jaccard similarity is ``SIMILAR`` or more; classes are connected
components. Texts of bands that are not all of one class then are tried once more, against
centres that every band draws by an order of its own: large groups whose members are not all
alike hang together by several centres.

Bands whose texts are still not all of one class (families that share boilerplate) are settled
by an exact prefix join of their texts: with shingles in order of their frequency among these
texts (in ``ORDER`` buckets), two similar texts share one among the first of both, which
boilerplate is not; and what lies from it on in either text must suffice. So a pair of
a common band is found whatever the centres were, and its texts are compared.

No group is gathered: centres are aggregates, pairs are one row a text and band; the prefix
join pairs texts of different classes that share one of their rarest shingles. Texts with
equal words are one class from the start (their least doc_id stands for them). Results for
odd input: NULL and empty texts are copies of each other; texts of fewer than five words have
one shingle; in ``classes`` a NULL doc_id has a NULL class and is never linked, and rows of
one doc_id are one document; ``keep_one`` goes by doc_id and text, so that texts of one doc_id
and texts without one each take part; an empty table gives an empty result. Very long texts are worked
on one by one, in memory in proportion to the longest. Other columns are kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from statlake.llm.common import in_small_batches, kept, mixed, packed, text_or_empty, unpacked
from statlake.llm.components import components
from statlake.llm.shingles import parts, shingles

BUCKETS = 1 << 18
BANDS, ROWS, MORE = 12, 3, 3
SAMPLES = BANDS * ROWS
SIMILAR = 0.8
#: Of 36 samples, so many are equal at least in pairs with a centre whose texts are compared.
AGREE = 20
#: Buckets in which shingles of unsettled texts are counted to order them.
ORDER = 1 << 18
#: A pair that shares one of so many shingles before has met there already.
BEFORE = 24

_GAMMA: list[tuple[np.ndarray, np.ndarray]] = []


def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution by 16-bit number, and their logarithms."""
    if not _GAMMA:
        u = (np.arange(1 << 16) + 0.5) / (1 << 16)
        lo, hi = np.zeros(len(u)), np.full(len(u), 60.0)
        for _ in range(60):
            mid = (lo + hi) / 2
            below = 1 - np.exp(-mid) * (1 + mid) < u
            lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
        _GAMMA.append(((lo + hi).astype("f4") / 2, np.log((lo + hi) / 2).astype("f4")))
    return _GAMMA[0]


def sketch(shingle: np.ndarray, weight: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Samples of texts whose shingles begin at ``firsts``: (texts, SAMPLES) of 32 bits.

    For a shingle of weight w: t = floor(ln w / r + b), ln a = ln c - r (t - b) - r, with r
    and c from Gamma(2, 1) and b uniform, all by the shingle's hash. The sample is the pair
    of shingle and t with the least a.
    """
    gamma, log_gamma = _gamma()
    log_w = np.log(weight).astype("f4")
    low = np.uint64(0xFFFF)
    out = np.empty((len(firsts), SAMPLES), "u4")
    for k in range(SAMPLES):
        h = mixed(shingle + np.uint64((k + 1) * 0xA0761D6478BD642F % (1 << 64)))
        r = gamma[h & low]
        b = ((h >> np.uint64(32)) & low).astype("f4") * np.float32(1 / 65536)
        t = np.floor(log_w / r + b)
        a = log_gamma[(h >> np.uint64(16)) & low] - r * (t - b + np.float32(1))
        order = a.view("i4")
        order = (order ^ ((order >> 31) & np.int32(0x7FFFFFFF))).astype("i8")
        tag = ((h >> np.uint64(20)) ^ (t.astype("i4").astype("u4") * np.uint64(0x9E3779B1))) & np.uint64(0xFFFFFFFF)
        best = np.minimum.reduceat((order << 32) | tag.astype("i8"), firsts)
        out[:, k] = (best & 0xFFFFFFFF).astype("u4")
    return out


def _bucket_counts(buckets: int):
    """In how many texts each bucket of shingles occurs."""
    bits, low = np.uint64(buckets.bit_length() - 1), np.uint64(buckets - 1)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(buckets, "i8")
        for batch in batches:
            for _, texts in parts(batch["text"].tolist()):
                text, shingle, _ = shingles(texts)
                pairs = np.unique((text.astype("u8") << bits) | (shingle & low))
                counts += np.bincount((pairs & low).astype("i8"), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": used.astype("i4"), "n": counts[used]})

    return count


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """The number of texts by bucket; the driver gets one number for each bucket."""
    rows = (texts.select("text").mapInPandas(_bucket_counts(buckets), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(buckets, "i8")
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def bucket_weights(docs: DataFrame) -> np.ndarray:
    """ln(1 + N / n) by bucket."""
    counts = bucket_counts(in_small_batches(docs).select(text_or_empty().alias("text")), BUCKETS)
    return np.log1p(docs.count() / np.maximum(counts, 1)).astype("f4")


def _sketcher(shared):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        idf = shared.value
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for at, texts in parts(batch["text"].tolist()):
                text, shingle, count = shingles(texts)
                weight = count * idf[(shingle & np.uint64(BUCKETS - 1)).astype("i8")]
                firsts = np.flatnonzero(np.diff(text, prepend=-1))
                samples: list = [[]] * len(texts)
                if len(firsts):
                    for i, row in zip(text[firsts].tolist(), sketch(shingle, weight, firsts).view("i4")):
                        samples[i] = row
                yield pd.DataFrame({
                    "doc_id": ids[at:at + len(texts)],
                    "copy": [xxhash.xxh3_128_digest(" ".join(t.lower().split())) for t in texts],
                    "samples": samples})

    return run


def sketches(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, copy (hash of the words) and the samples of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    rows = docs.where("doc_id is not null").select("doc_id", text_or_empty().alias("text"))
    return kept(rows.mapInPandas(_sketcher(shared), "doc_id long, copy binary, samples array<int>"), "sketches")


def band_keys(reps: DataFrame) -> DataFrame:
    """rep, band and key of every bucket that a text is in, wide ones and those with more samples."""
    rows = reps.where("size(samples) > 0").select("rep", F.expr(f"""explode(flatten(transform(
        sequence(0, {BANDS - 1}), b -> array(
            struct(b as band, xxhash64('wide', b, slice(samples, b * {ROWS} + 1, {ROWS})) as key),
            struct(b as band, xxhash64('more', b, slice(concat(samples, samples), b * {ROWS} + 1, {ROWS + MORE})) as key)))))""").alias("k"))
    return rows.select("rep", "k.band", "k.key")


def candidates(reps: DataFrame, by_band: bool = False) -> DataFrame:
    """Pairs (a, b) of a text and a centre of one of its bands, each pair once.

    With ``by_band`` each band draws its centres by an order of its own: up to two centres a
    band for every text, instead of the same few.
    """
    rows = band_keys(reps)
    order = F.xxhash64("rep", *(["band"] if by_band else []))
    centres = (rows.groupBy("key").agg(F.min(F.struct(order.alias("o"), "rep")).alias("c"), F.count("*").alias("n"))
               .where("n > 1").select("key", F.col("c.rep").alias("centre")))
    pairs = rows.join(centres, "key").where(F.col("rep") != F.col("centre"))
    pairs = pairs.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
    return agreeing(pairs, reps)


def agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose samples agree often enough for similar texts, before any text is read.

    At a similarity of ``SIMILAR``, fewer than ``AGREE`` of 36 are a case in 10,000.
    """
    x = reps.select(F.col("rep").alias("a"), F.col("samples").alias("x")).hint("merge")
    y = reps.select(F.col("rep").alias("b"), F.col("samples").alias("y")).hint("merge")
    agree = F.size(F.filter(F.zip_with("x", "y", lambda s, t: s == t), lambda e: e))
    return pairs.join(x, "a").join(y, "b").where(agree >= AGREE).select("a", "b")


def unsettled(reps: DataFrame, found: DataFrame) -> DataFrame:
    """rep, label: the texts of buckets of three or more that hold texts of several components."""
    labels = reps.select("rep", "samples").join(found, F.col("rep") == F.col("node"), "left").select(
        "rep", "samples", F.coalesce("label", "rep").alias("label"))
    # Texts of a narrow bucket are together in a wide one.
    rows = labels.where("size(samples) > 0").select("rep", "label", F.expr(f"""explode(transform(
        sequence(0, {BANDS - 1}), b -> xxhash64('wide', b, slice(samples, b * {ROWS} + 1, {ROWS})))) as key"""))
    mixed_ = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where(
        "n > 2 and lo < hi").select("key")
    return rows.join(mixed_, "key").select("rep", "label").distinct()


def prefix(shingle: np.ndarray, weight: np.ndarray, common: np.ndarray,
           similar: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rarest shingles that a similar text must share one of, the weight from each of them
    on, and which of them suffice where the other text weighs as much or more.

    What two texts share weighs ``similar`` of the heavier text at least, and of the lighter
    one 2 similar / (1 + similar); so much does not fit behind the shingles given.
    """
    order = np.lexsort((shingle, common))
    rest = np.cumsum(weight[order][::-1])[::-1]
    slack = 1 - 1e-6
    first = rest >= similar * slack * rest[0]
    return shingle[order][first], rest[first], (rest >= 2 * similar / (1 + similar) * slack * rest[0])[first]


def _prefixer(shared, ordered, similar: float):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf, counts = shared.value, ordered.value
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for rep, label, t in zip(batch["rep"], batch["label"], batch["text"]):
                _, shingle, count = shingles([t])
                if not len(shingle):
                    continue
                weight = (count * idf[(shingle & np.uint64(BUCKETS - 1)).astype("i8")]).astype("f8")
                common = counts[(shingle & np.uint64(ORDER - 1)).astype("i8")]
                first, rest, short = prefix(shingle, weight, common, similar)
                for into, x in zip(out, (np.full(len(first), rep), np.full(len(first), label),
                                         np.full(len(first), weight.sum()), first.astype("i8"), rest, short,
                                         [first[max(0, i - BEFORE):i].astype("i8") for i in range(len(first))])):
                    into.append(x)
            if out[0]:
                *plain, before = out
                yield pd.DataFrame(dict(zip(("rep", "label", "weight", "shingle", "rest", "short"), map(np.concatenate, plain)))
                                   | {"before": [x for some in before for x in some]})

    return run


def settling(docs: DataFrame, reps: DataFrame, found: DataFrame, idf: np.ndarray, similar: float = SIMILAR) -> DataFrame:
    """Pairs (a, b) of different components that one bucket holds and that may be similar."""
    some = kept(unsettled(reps, found), "unsettled")
    texts = docs.select(F.col("doc_id").alias("rep"), text_or_empty().alias("text")).join(some.hint("merge"), "rep")
    texts = kept(texts.select("rep", "label", "text").dropDuplicates(["rep"]), "unsettled-texts")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    ordered = spark.sparkContext.broadcast(bucket_counts(texts, ORDER).astype("i4"))
    rows = kept(texts.mapInPandas(_prefixer(shared, ordered, similar),
                                  "rep long, label long, weight double, shingle long, rest double, short boolean, "
                                  "before array<long>"), "prefixes")
    # Shingles of one component only have no pairs to give.
    several = rows.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("shingle")
    rows = rows.join(several, "shingle")
    x = rows.select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("rep", "label", "weight", "rest", "before")])
    y = rows.where("short").select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("rep", "label", "weight", "rest", "before")])
    enough = similar / (1 + similar) * (1 - 1e-6)
    near = ((F.col("label_x") != F.col("label_y")) & (F.col("weight_y") <= F.col("weight_x") * (1 + 1e-6))
            & (F.col("weight_y") >= F.col("weight_x") * similar * (1 - 1e-6))
            & (F.least("rest_x", "rest_y") >= enough * (F.col("weight_x") + F.col("weight_y")))
            & ~F.arrays_overlap("before_x", "before_y"))
    return x.join(y.hint("merge"), "shingle").where(near).select(
        F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts given as shingles in order and weights."""
    both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    shared = np.minimum(x[1][i], y[1][j]).sum()
    return float(shared / (x[1].sum() + y[1].sum() - shared)) if len(both) else 0.0


def _verifier(shared):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf = shared.value
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def features(doc: int, text: str):
            if doc not in known:
                if len(known) > 64:
                    known.clear()
                _, shingle, count = shingles([text])
                known[doc] = shingle, count * idf[(shingle & np.uint64(BUCKETS - 1)).astype("i8")]
            return known[doc]

        for batch in batches:
            found = [similarity(features(a, s), features(b, t)) for a, b, s, t in
                     zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"])]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found})

    return run


def links(docs: DataFrame, pairs: DataFrame, idf: np.ndarray, similar: float = SIMILAR) -> DataFrame:
    """The pairs (a, b, similarity) that are alike, by their whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    pairs = kept(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    # The same plan at every size: both sides are dealt by their keys, none is broadcast.
    texts = kept(docs.select("doc_id", text_or_empty().alias("text")).join(ids.hint("merge"), "doc_id"), "texts")
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b")
    return rows.mapInPandas(_verifier(shared), "a long, b long, similarity double").where(F.col("similarity") >= similar)


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, copy_of (least doc_id with the same words), class_id (least of the class)."""
    docs_ = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    idf = bucket_weights(docs_)
    rows = sketches(docs_, idf)
    # Copies have equal sketches; any one of them serves.
    reps = kept(rows.groupBy("copy").agg(F.min("doc_id").alias("rep"), F.first("samples").alias("samples")), "reps")
    linked = kept(links(docs_, candidates(reps), idf, similar), "links")
    found = components(linked)
    apart = kept(reps.join(unsettled(reps, found).select("rep"), "rep", "left_semi"), "apart")
    again = kept(links(docs_, candidates(apart, by_band=True), idf, similar), "links")
    if not again.isEmpty():
        linked = linked.union(again)
        found = components(linked)
    more = kept(links(docs_, settling(docs_, reps, found, idf, similar), idf, similar), "links")
    if not more.isEmpty():
        found = components(linked.union(more))
    named = reps.select("copy", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        "copy", "rep", F.coalesce("label", "rep").alias("class"))
    out = rows.select("doc_id", "copy").join(named, "copy").select(
        "doc_id", F.col("rep").alias("copy_of"), F.col("class").alias("class_id"))
    none = docs_.where("doc_id is null").select("doc_id", *[F.lit(None).cast("long").alias(c) for c in ("copy_of", "class_id")])
    return out.unionByName(none)


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The documents with one of each class left: the one with the least doc_id.

    A document is a doc_id and a text, told by their hash: texts of one doc_id are compared as
    any others, and so are texts without a doc_id (they stay where no text with one is like
    them). Repeated rows leave one.
    """
    key = F.xxhash64("doc_id", text_or_empty())
    named = classes(docs.select(key.alias("doc_id"), "text"), similar).distinct()
    ids = docs.select(key.alias("_key"), F.col("doc_id").alias("_id")).distinct()
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key"))
    stay = (named.join(ids, F.col("doc_id") == F.col("_key")).groupBy("class_id").agg(first.alias("f"))
            .select(F.col("f._key").alias("_key")))
    rows = packed(docs, "doc_id", "text").withColumn("_key", key).dropDuplicates(["_key"])
    return rows.join(stay, "_key", "left_semi").select(*unpacked(docs.columns, "doc_id", "text"))
