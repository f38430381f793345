"""Constraint checks that file tables do not enforce themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row count."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | any_null)
    )


def ref_violations(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row. ``on``: child -> parent."""
    wanted = parent.select(*[F.col(p).alias(c) for c, p in on.items()])
    rows = child
    for c in on:
        rows = rows.where(F.col(c).isNotNull())
    return rows.join(wanted, list(on), "left_anti")


def require_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.dropna(subset=list(keys))


def assert_empty(violations: DataFrame, what: str) -> None:
    """Raise when a check found something; looks at one row only."""
    sample = violations.take(1)
    if sample:
        raise ValueError(f"{what}: for example {sample[0].asDict()}")
