"""Table changes as DataFrame -> DataFrame functions (no in-place mutation).

File tables have no ``MERGE``; each function returns the new content of the
target, which ``sources.lake`` writes as a new snapshot or as the touched blocks.
Key joins stay on the key columns only, so both sides shuffle once and adaptive
execution may broadcast or split either of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Replace whole rows whose key is in ``source``; add the unseen ones.

    ``source`` holds one row per key (run ``latest_per_key`` first). A NULL in a key
    would match no row and pile up, so it is refused.
    """
    source = refuse_null_keys(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def refuse_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame, which fails as soon as a row with a NULL key is computed."""
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    message = F.raise_error(F.lit(f"NULL in the key {', '.join(keys)}"))
    first = keys[0]
    return df.withColumn(first, F.when(bad, message.cast(df.schema[first].dataType)).otherwise(F.col(first)))


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows with an unseen key and leave existing rows untouched."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert_cols(target: DataFrame, source: DataFrame, keys: list[str],
                cols: list[str]) -> DataFrame:
    """Insert unseen keys; for known keys update only ``cols`` (NULLs included)."""
    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = source.select(*target.columns).withColumn("_new", F.lit(True)).alias("n")
    merged = old.join(new, list(keys), "full_outer")

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in cols:
            taken = F.when(F.col("_new"), F.col(f"n.{name}")).otherwise(F.col(f"o.{name}"))
        else:
            taken = F.when(F.col("_old"), F.col(f"o.{name}")).otherwise(F.col(f"n.{name}"))
        return taken.alias(name)

    return merged.select(*[pick(c) for c in target.columns])


def update_where_in(target: DataFrame, matches: DataFrame, on: list[str],
                    assignments: dict[str, Column]) -> DataFrame:
    """Set columns on the rows whose ``on`` values occur in ``matches``."""
    marked = target.join(
        matches.select(*on).distinct().withColumn("_hit", F.lit(True)), list(on), "left"
    )
    return marked.select(*[
        F.when(F.col("_hit"), assignments[c].cast(target.schema[c].dataType))
        .otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in target.columns
    ])


def conform(df: DataFrame, schema) -> DataFrame:
    """Select by name in the target's order and cast to its types.

    Columns the frame lacks become NULL, the way an optional field does.
    """
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill NULLs of the named columns with the declared default, keeping the type."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in defaults.items()
    })


def mark_processed(done: DataFrame, batch: DataFrame, keys: list[str], at: Column,
                   at_col: str = "processed_at") -> DataFrame:
    """Upsert one marker row per processed key for the whole batch at once."""
    rows = batch.select(*keys).distinct().withColumn(at_col, at)
    return upsert(done, rows, keys)
