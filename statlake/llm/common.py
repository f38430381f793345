"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlake.session import scratch_dir

#: White space between words, as the contracts of the queries name it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_WORD = re.compile(r"[^\x20\x09-\x0d]+")
#: Characters that Python's split() takes for white space and the contracts do not.
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def words_of(text: str) -> list[str]:
    """The words of a text: split() where it means the same, as it is much faster."""
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def in_small_batches(docs: DataFrame) -> DataFrame:
    """The same rows; from here on fewer of them travel to Python at once.

    Whole texts are large, and a batch lives several times in the memory of both sides.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return docs


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again.

    Cuts the lineage, and survives lost executors, as the files are shared.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others as one: no helper's name can clash with theirs."""
    others = [f"`{c}`" for c in docs.columns if c not in needed]
    return docs.select(*needed, *([F.struct(*others).alias("_rest")] if others else []))


def unpacked(columns: list[str], *needed: str) -> list[Column]:
    """Selects what ``packed`` put away; ``columns`` in their order."""
    return [F.col(c) if c in needed else F.col("_rest").getField(c).alias(c) for c in columns]


def uniform(*cols: Column) -> Column:
    """A pseudorandom number in (0, 1) that depends on the given columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles unsigned 64-bit values (multiply and shift, wrapping)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 4096) -> float | None:
    """The exact k-th largest value of a column without NULL or NaN; None without such.

    Each pass counts the values of equal bins between two bounds and goes on inside
    the bin that holds the value looked for, so the driver sees ``bins`` rows at most.
    """
    if k <= 0:
        return None
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if n < k:
        return None
    rank = k
    while lo < hi:
        width = hi / bins - lo / bins
        place = F.col(col) / bins - F.lit(lo) / bins
        share = place / F.lit(width) if width > 0 else F.when(F.col(col) > lo, 1.0).otherwise(0.0)
        at = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        at = F.when(F.col(col) >= hi, bins).otherwise(F.greatest(at, F.lit(0)))
        rows = (df.where(F.col(col).between(lo, hi)).groupBy(at.alias("at"))
                .agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
                .orderBy(F.desc("at")).collect())
        for row in rows:
            if rank <= row["n"]:
                lo, hi = row["lo"], row["hi"]
                break
            rank -= row["n"]
    return lo
