"""Row selection per key: latest row, last rows, first-seen order, anti joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   ties: list[str] | None = None) -> DataFrame:
    """One row per key: the highest ``order`` values, NULLs last.

    Rows of one load often share a timestamp, so ``ties`` and then every other
    orderable column decide, and a rerun picks the same row. Catalyst turns
    ``row_number() = 1`` into a group limit below the shuffle: a key that owns a
    third of the rows sends one row per map task.
    """
    return _ranked(df, keys, order, ties).where(F.col("_rn") == 1).drop("_rn")


def last_n(df: DataFrame, keys: list[str], order: list[str], n: int,
           ties: list[str] | None = None) -> DataFrame:
    """The last ``n`` rows per key (map-side limited like ``latest_per_key``)."""
    return _ranked(df, keys, order, ties).where(F.col("_rn") <= n).drop("_rn")


def _ranked(df: DataFrame, keys, order, ties) -> DataFrame:
    named = [*order, *(ties or [])]
    rest = [
        f.name for f in df.schema.fields
        if f.name not in named and f.name not in keys
        and not isinstance(f.dataType, (MapType, VariantType))
    ]
    by = [F.col(c).desc_nulls_last() for c in [*named, *rest]]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))


def first_seen(df: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """Distinct ids as strings with the order value at which each first appears."""
    return (
        df.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("string").alias(id_col))
        .agg(F.min(order_col).alias("first_seen"))
    )


def unprocessed(source: DataFrame, done: DataFrame, on: dict[str, str]) -> DataFrame:
    """Source rows without a match in ``done``. ``on``: source column -> done column."""
    marks = done.select(*[F.col(d).alias(s) for s, d in on.items()])
    return source.join(marks, list(on), "left_anti").select(*source.columns)


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not hold yet (``NOT EXISTS``)."""
    return unprocessed(source, target, {k: k for k in keys})


def only_pairs(df: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Semi join on the whole key tuple."""
    return df.join(pairs.select(*keys), list(keys), "left_semi").select(*df.columns)


def page(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """One sorted result page; plans as a per-partition top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def apply_filters(df: DataFrame, **values) -> DataFrame:
    """AND of equality filters, skipping the ones not supplied (None)."""
    for name, value in values.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def for_date(df: DataFrame, ts_col: str, yyyymmdd: str) -> DataFrame:
    """Rows of one process date, written as a range so that it reaches the scan."""
    iso = f"{yyyymmdd[:4]}-{yyyymmdd[4:6]}-{yyyymmdd[6:]}"
    kind = df.schema[ts_col].dataType
    start = F.lit(iso).cast("date")
    return df.where(
        (F.col(ts_col) >= start.cast(kind)) & (F.col(ts_col) < F.date_add(start, 1).cast(kind))
    )


def if_not_empty(df: DataFrame, fn):
    """Run ``fn`` only when there is a row; used to skip writes of empty loads."""
    return None if df.isEmpty() else fn(df)
