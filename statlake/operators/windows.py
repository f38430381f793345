"""Ordered windows that stay distributed: bounded lookback and temporal split."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def with_lookback(df: DataFrame, keys: list[str], order: list[str], n: int,
                  columns: Callable[[WindowSpec], dict[str, Column]],
                  block: Column | None = None) -> DataFrame:
    """Add window columns over the ``n`` rows before each row of its key.

    All columns share one frame, hence one sort. ``order`` sorts ascending with
    NULLs last. A caller whose keys may hold more rows than a task can sort names a
    ``block``: any expression that never decreases along ``order`` (a truncated
    date, an integer division). Every key is then cut into (key, block) groups, each
    with the up to ``n`` rows that precede it, so the result equals the uncut window.
    """
    asc = [F.col(c).asc_nulls_last() for c in order]
    if block is None:
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(*asc).rowsBetween(-n, -1)))

    # NULL blocks sort last, as NULL order values do.
    tagged = df.withColumn("_blk", F.struct(block.isNull().alias("is_null"), block.alias("value")))

    # The last n rows of every block, and the later blocks each of them reaches into.
    desc = [F.col(c).desc_nulls_first() for c in order]
    tails = (
        tagged
        .withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_blk").orderBy(*desc)))
        .where(F.col("_rn") <= n).drop("_rn")
    )
    along = Window.partitionBy(*keys).orderBy(*asc)
    ahead = [F.col("_blk")] + [F.lead("_blk", d).over(along) for d in range(1, n + 1)]
    names = [f"_b{d}" for d in range(n + 1)]
    tails = tails.select(*df.columns, *[c.alias(b) for c, b in zip(ahead, names)])
    reached = [
        F.when(F.col(names[d]) != F.col(names[d - 1]), F.col(names[d])) for d in range(1, n + 1)
    ]
    halo = (
        tails.select(*df.columns, F.explode(F.array_compact(F.array(*reached))).alias("_blk"))
        .withColumn("_halo", F.lit(True))
    )
    cut = Window.partitionBy(*keys, "_blk").orderBy(*asc).rowsBetween(-n, -1)
    new = columns(cut)
    return (
        tagged.withColumn("_halo", F.lit(False)).unionByName(halo)
        .withColumns(new).where(~F.col("_halo")).select(*df.columns, *new)
    )


def lagged_features(df: DataFrame, stats: list[str], keys: list[str], order: list[str],
                    n: int = 3, block: Column | None = None) -> DataFrame:
    """Averages of the previous ``n`` rows per key, current row excluded.

    Adds ``avg_<stat>_<n>w`` for each stat and ``lookback_count``. Values are
    averaged as doubles; a decimal average would round to a fixed scale.
    """
    def columns(w: WindowSpec) -> dict[str, Column]:
        out = {f"avg_{s}_{n}w": F.avg(F.col(s).cast("double")).over(w) for s in stats}
        out["lookback_count"] = F.count(F.lit(1)).over(w)
        return out

    return with_lookback(df, keys, order, n, columns, block)


def history_window(df: DataFrame, n: int = 3, answer_chars: int | None = None,
                   turn_block: int | None = None) -> DataFrame:
    """The last ``n`` messages before each turn, formatted as prompt context.

    Questions and answers are numbered and kept whole; a prompt builder may cut the
    answers to ``answer_chars``. Other roles are counted but not printed. Conversations
    too long for one task are cut into blocks of ``turn_block`` turns.
    """
    previous = with_lookback(
        df, ["conv_id"], ["turn"], n,
        lambda w: {"_prev": F.collect_list(F.struct("role", "text")).over(w)},
        block=None if turn_block is None else F.floor(F.col("turn") / turn_block),
    )

    # The words of the context.
    def line(message: Column, i: Column) -> Column:
        number = (i + 1).cast("string")
        return F.when(
            message.role == "user",
            F.concat(F.lit("\n\nUser question "), number, F.lit(": "), message.text),
        ).when(
            message.role == "assistant",
            F.concat(F.lit("\n\nAssistant answer "), number, F.lit(": "),
                     message.text if answer_chars is None
                     else F.substring(message.text, 1, answer_chars)),
        ).otherwise(F.lit(""))

    return previous.select(
        *df.columns, F.size("_prev").alias("n_messages"),
        F.array_join(F.transform("_prev", line), "").alias("context"),
    )


def temporal_cutoff(df: DataFrame, ts: str, share: float) -> tuple[str | None, bool]:
    """The last ``ts`` whose percent rank is below ``share``, and "all rows are".

    A percent rank over the whole table would sort it in one task. The rank never
    decreases along ``ts``, so only the cut matters: count rows per day, find the
    day that holds the cut, and look closer inside that day only (minute, second,
    exact value). Every step is one pre-aggregated count whose group number is
    bounded by the calendar; days on which all rows share one value end the
    search at once. Returns the cut as text, None when there is no row.
    """
    kind = df.schema[ts].dataType
    levels: list[str | None] = [None]
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        levels = ["day", "minute", "second", None]
    elif not isinstance(kind, DateType):
        raise TypeError(f"{ts} is {kind.simpleString()}, not a date or timestamp")

    rows, base, total = df.select(ts), 0, None
    for level in levels:
        value = F.col(ts)
        per = rows.groupBy((F.date_trunc(level, value) if level else value).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
        along = Window.orderBy(F.col("b").asc_nulls_last())
        per = per.withColumns({
            "before": F.lit(base) + F.coalesce(
                F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "total": F.sum("n").over(Window.partitionBy()) if total is None else F.lit(total),
        })
        rank = F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1)).otherwise(0.0)
        hit = (
            per.where(rank < share).orderBy(F.col("before").desc())
            .select("before", "total", F.col("lo").cast("string"), F.col("hi").cast("string"))
            .first()
        )
        if hit is None:
            return None, False
        if hit.lo is None:
            return None, True
        if hit.lo == hit.hi:
            return hit.hi, False
        base, total = hit.before, hit.total
        rows = df.select(ts).where(
            (F.col(ts) >= F.lit(hit.lo).cast(kind)) & (F.col(ts) <= F.lit(hit.hi).cast(kind)))
    return hit.hi, False


def temporal_split(df: DataFrame, ts: str, share: float = 0.7, name: str = "split") -> DataFrame:
    """Label rows ``train`` while the percent rank of ``ts`` is below ``share``.

    Equal timestamps share a label and NULLs rank last. After the cut is known
    the label is a comparison: the rows themselves are never shuffled or sorted.
    """
    cut, everything = temporal_cutoff(df, ts, share)
    train = F.lit(everything)
    if cut is not None:
        train = F.col(ts) <= F.lit(cut).cast(df.schema[ts].dataType)
    return df.withColumn(name, F.when(train, "train").otherwise("test"))
