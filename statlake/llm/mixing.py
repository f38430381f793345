"""Mixing sources to target weights: blocks of words, drawn slots, permuted indices.

The words of a source form one stream (its documents in a hashed order), cut into blocks of
``BLOCK`` words; the last one may be shorter. The mix is a row of output shards. Each shard's
slots are dealt to the sources by multinomial draws over what the sources still have to give,
so their totals are met. Slot j of a source takes the block to which a keyed permutation of
the source's block numbers sends j; each full round over the blocks has its own key. Slots
and blocks meet in a join by source and block number. The very last slot of a source is cut
so that the source gives its target to the word.

Results for odd input: a NULL text has no words; documents without words are never taken;
a NULL source is a source of its own and comes last; repeated rows are documents of their
own; an empty table gives an empty mix. Other columns stay as they are. Reruns agree, as all
draws depend on the seed, the doc_ids and the texts alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from statlake.llm.common import WORD, in_small_batches, kept, mixed, packed, text_or_empty, unpacked

BLOCK = 1024
SHARDS = 512
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL, MOST = 1.5, 2.0
#: Parts of a source that are ordered on their own; their sizes are summed first.
BINS = 1024
#: Sources are names of collections. Their sizes are held by the driver.
MOST_SOURCES = 100_000
SEED = 11


def targets(sizes: np.ndarray, weights: np.ndarray, total: float = TOTAL,
            most: float = MOST) -> np.ndarray:
    """Shares of ``total`` x all words by weight; none above ``most`` x its own words."""
    caps = most * sizes.astype("f8")
    left, open_ = total * float(sizes.sum()), sizes > 0
    found = np.zeros(len(sizes))
    while open_.any():
        share = left * weights / weights[open_].sum()
        over = open_ & (share >= caps)
        if not over.any():
            found[open_] = share[open_]
            break
        found[over] = caps[over]
        left -= caps[over].sum()
        open_ &= ~over
    return found


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n-1, row by row, or its inverse: four Feistel rounds.

    Values that fall outside 0 .. n-1 are sent on until they fall inside.
    """
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2))).astype("i8") + 1) // 2, 1).astype("u8")
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, n, key = x.astype("u8"), n.astype("u8"), key.astype("u8")
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for turn in (3, 2, 1, 0) if back else (0, 1, 2, 3):
            salt = k + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            if back:
                left, right = right ^ (mixed(left + salt) & m), left
            else:
                left, right = right, left ^ (mixed(right + salt) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype("i8")


def dealt(slots: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws that exhaust ``slots``."""
    rng = np.random.default_rng(seed)
    left, out = slots.astype("i8").copy(), []
    for shard in range(shards):
        size = int(round(left.sum() / (shards - shard)))
        row = np.zeros(len(left), "i8")
        while size:
            rest = left - row
            draw = np.minimum(rng.multinomial(size, rest / rest.sum()), rest)
            row += draw
            size -= int(draw.sum())
        left -= row
        out.append(row)
    return np.array(out)


def source_table(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST,
                 block: int = BLOCK) -> pd.DataFrame:
    """One row a source in order of code points, NULL last: size, target, blocks, slots."""
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .orderBy(F.col("source").asc_nulls_last()).limit(MOST_SOURCES + 1).toPandas())
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    n = rows["source_size"].to_numpy("i8")
    w = np.array(weights)[np.arange(len(n)) % len(weights)]
    rows["idx"] = np.arange(len(n), dtype="i4")
    rows["target"] = targets(n, w, total, most)
    wanted = np.minimum(np.round(rows["target"]).astype("i8"), np.floor(most * n).astype("i8"))
    rows["blocks"] = blocks = -(-n // block)
    rows["rounds"] = rounds = np.where(n > 0, wanted // np.maximum(n, 1), 0)
    rest = wanted - rounds * n
    # The short block's place in the last round decides how many slots the rest fills.
    short = blocks * block - n
    at = np.full(len(n), -1)
    has = blocks > 0
    if has.any():
        keys = _key(rows["idx"].to_numpy()[has], rounds[has])
        at[has] = permuted(blocks[has] - 1, blocks[has], keys, back=True)
    whole = np.where(rest <= at * block, -(-rest // block), -(-(rest + short) // block))
    rows["slots"] = rounds * blocks + np.where(rest > 0, whole, 0)
    rows["cut"] = np.where(rest > 0, rest - (whole - 1) * block + np.where(at < whole - 1, short, 0), 0)
    return rows


def _key(idx: np.ndarray, turn: np.ndarray, seed: int = SEED) -> np.ndarray:
    return mixed((np.asarray(idx, "u8") << np.uint64(32)) + (np.asarray(turn, "u8") << np.uint64(16))
                 + np.uint64(seed))


def _slots(table: pd.DataFrame, block: int):
    by = table.set_index("idx")

    def expand(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, idx, first, count in batch.itertuples(index=False):
                s = by.loc[idx]
                n = int(s["blocks"])
                for lo in range(first, first + count, 1 << 18):
                    j = np.arange(lo, min(first + count, lo + (1 << 18)))
                    at = permuted(j % n, np.full(len(j), n), _key(np.full(len(j), idx), j // n))
                    words = np.minimum(block, int(s["source_size"]) - at * block)
                    if s["cut"]:
                        words = np.where(j == int(s["slots"]) - 1, int(s["cut"]), words)
                    yield pd.DataFrame({"idx": np.full(len(j), idx, "i4"), "block": at,
                                        "shard": np.full(len(j), shard, "i4"), "slot": j,
                                        "words": words.astype("i4")})

    return expand


def slot_table(spark: SparkSession, table: pd.DataFrame, block: int = BLOCK,
               shards: int = SHARDS) -> DataFrame:
    """idx, block, shard, slot, words: what each slot of the mix takes."""
    schema = "idx int, block long, shard int, slot long, words int"
    slots = table["slots"].to_numpy("i8")
    if not slots.sum():
        return spark.createDataFrame([], schema)
    counts = dealt(slots, shards)
    first = np.cumsum(counts, axis=0) - counts
    shard, idx = np.nonzero(counts)
    rows = pd.DataFrame({"shard": shard.astype("i4"), "idx": idx.astype("i4"),
                         "first": first[shard, idx], "count": counts[shard, idx]})
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (spark.createDataFrame(rows).repartition(n, "shard", "idx")
            .mapInPandas(_slots(table, block), schema))


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, hash and the place of each document in its source's stream.

    Sums by (source, bin) come first, so no source is ever ordered in one task.
    """
    sizes = docs.select(
        F.col("doc_id"), "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_or_empty()).alias("hash"))
    sizes = sizes.withColumn("bin", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(BINS)).cast("int"))
    return kept(sizes, "sizes")


def placed(sizes: DataFrame, table: DataFrame) -> DataFrame:
    bins = sizes.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    before = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select("source", "bin", F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("base"))
    order = W.partitionBy("source", "bin").orderBy(F.col("doc_id").asc_nulls_last(), "hash")
    rows = sizes.withColumn("row", F.row_number().over(order)).withColumn(
        "inner", F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    bins = bins.withColumnsRenamed({"source": "_s", "bin": "_b"})
    rows = rows.join(bins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b")))
    # One row a source: see MOST_SOURCES.
    names = F.broadcast(table.withColumnRenamed("source", "_n"))
    return rows.join(names, F.col("source").eqNullSafe(F.col("_n"))).select(
        "doc_id", "source", "size", "hash", "bin", "row", "idx", "source_size", "target",
        (F.col("base") + F.col("inner")).alias("start"))


def takes(rows: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each piece that the mix takes: the document's key, shard, slot, first word, words."""
    segments = rows.where("size > 0").select(
        "doc_id", "source", "hash", "idx", "bin", "row", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block),
                             F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    edge = F.col("block") * block
    joined = segments.join(slots, ["idx", "block"])
    lo = F.greatest(F.col("start"), edge)
    hi = F.least(F.col("start") + F.col("size"), edge + F.col("words"))
    return joined.withColumns({"first": lo - F.col("start"), "n": hi - lo}).where("n > 0").select(
        "doc_id", "source", "hash", "idx", "bin", "row", "shard", "slot", "first", "n")


def plan(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, **shares):
    """The documents with their places and the pieces of them that the mix takes."""
    spark = docs.sparkSession
    sizes = positions(docs)
    table = source_table(sizes, block=block, **shares)
    small = spark.createDataFrame(
        table[["source", "idx", "source_size", "target"]].astype({"source": object}),
        "source string, idx int, source_size long, target double")
    rows = placed(sizes, small)
    return rows, takes(rows, slot_table(spark, table, block, shards), block)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and the words taken, for every document."""
    rows, pieces = plan(docs, **options)
    key = ["idx", "bin", "row"]
    sums = pieces.groupBy(*key).agg(F.sum("n").alias("taken"))
    return rows.join(sums, key, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: one row for each piece taken, with the columns of ``docs``.

    ``text`` is the piece (its words and the space between them), ``n_chars`` its length
    where there is such a column. Rows with one doc_id, source and text are the same
    document repeated: its pieces are cut from one copy.
    """
    _, pieces = plan(in_small_batches(docs), **options)
    lists = pieces.groupBy("doc_id", "source", "hash").agg(
        F.sort_array(F.collect_list(F.struct("shard", "slot", "first", "n"))).alias("_takes"))
    needed = [c for c in ("doc_id", "source", "text", "n_chars") if c in docs.columns]
    keyed = packed(docs, *needed).withColumn("_hash", F.xxhash64(text_or_empty()))
    keyed = keyed.dropDuplicates(["doc_id", "source", "_hash"])
    lists = lists.withColumnsRenamed({"doc_id": "_d", "source": "_s", "hash": "_h"})
    joined = keyed.join(lists, F.col("doc_id").eqNullSafe(F.col("_d"))
                        & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_hash") == F.col("_h")))
    cut = joined.withColumn("_piece", F.explode(_pieces("text", "_takes")))
    cut = cut.withColumn("text", F.col("_piece"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("_piece").cast(docs.schema["n_chars"].dataType))
    return cut.select(*unpacked(docs.columns, *needed))


def _pieces(text: str, takes_: str):
    import re

    word = re.compile(r"[^\x20\x09-\x0d]+")

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for t, some in zip(texts, lists):
            spans = [m.span() for m in word.finditer(t)]
            out.append([t[spans[x["first"]][0]:spans[x["first"] + x["n"] - 1][1]] for x in some])
        return pd.Series(out)

    return pieces(F.col(text), F.col(takes_))
