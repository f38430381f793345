"""The model dataset: lagged averages, complete lookback, temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions.scalars import (
    SCORING_WEIGHTS, data_version, points, standard_weights,
)
from statlake.operators.rows import last_n
from statlake.operators.windows import lagged_features, temporal_split
from statlake.schemas import STAT_COLUMNS
from statlake.sources.catalog import count_columns

# Games looked back on and the share of time used for training.
LOOKBACK = 3
TRAIN_SHARE = 0.70


def lagged_rows(gold: DataFrame, stats: list[str] = STAT_COLUMNS,
                block: Column | None = None) -> DataFrame:
    """Games with a full lookback and a target, with averages of the games before.

    The frame counts games played, starts anew each season and leaves out the
    current game, so no row sees its own target.
    """
    lagged = lagged_features(
        gold, stats, ["athlete_id", "season"], ["game_date", "game_id"], LOOKBACK,
        block=block)
    return lagged.where(
        (F.col("lookback_count") == LOOKBACK) & F.col("fantasy_points_ppr").isNotNull()
    ).select(
        "game_id", "athlete_id", "athlete_name", "team_id", "team_abbrev", "season", "week",
        "game_date", "is_home", "opponent_team_id", "opponent_abbrev",
        *[f"avg_{s}_{LOOKBACK}w" for s in stats],
        F.col("fantasy_points_ppr").alias("target_fantasy_ppr"),
        F.col("fantasy_points_standard").alias("target_fantasy_standard"),
    )


def build_features(gold: DataFrame, created_at: Column, stats: list[str] = STAT_COLUMNS,
                   block: Column | None = None) -> DataFrame:
    """The feature table. Pass a stored ``gold``: the split reads it once more."""
    rows = temporal_split(lagged_rows(gold, stats, block), "game_date", TRAIN_SHARE)
    return rows.withColumn("created_at", created_at.cast("timestamp_ntz"))


def split_of(features: DataFrame, split: str, target: str = "target_fantasy_ppr") -> DataFrame:
    return features.where((F.col("split") == split) & F.col(target).isNotNull())


def dataset_check(features: DataFrame, target: str = "target_fantasy_ppr") -> DataFrame:
    """Row counts per split, with and without a target, and the last week."""
    def rows_of(split: str, *more: Column) -> Column:
        cond = F.col("split") == split
        for m in more:
            cond = cond & m
        return F.count(F.when(cond, 1))

    known = F.col(target).isNotNull()
    return features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        rows_of("train").alias("train_rows"), rows_of("test").alias("test_rows"),
        rows_of("train", known).alias("train_with_target"),
        rows_of("test", known).alias("test_with_target"),
        F.max("week").alias("max_week"))


def assert_trainable(features: DataFrame, target: str = "target_fantasy_ppr") -> None:
    """Clear errors for an empty table or an empty split."""
    c = dataset_check(features, target).first()
    if c.total_rows == 0:
        raise ValueError("the feature table is empty")
    for split in ("train", "test"):
        if c[f"{split}_with_target"] == 0:
            raise ValueError(f"no {split} rows with a target among {c.total_rows} rows")


def dataset_metadata(features: DataFrame, season: int = 2025) -> DataFrame:
    """Version label, rows, distinct players and number of average features."""
    return features.agg(
        data_version(F.lit(season), F.max("week")).alias("data_version"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("athlete_id").alias("unique_players"),
    ).withColumn("feature_count", F.lit(count_columns(features, "avg_")))


def predict_baseline(features: DataFrame, run_id: str, created_at: Column,
                     weights: dict[str, str] = SCORING_WEIGHTS) -> DataFrame:
    """Score the lagged averages with the point weights; a NULL term scores 0."""
    def scored(w: dict[str, str]) -> Column:
        total = points(w, lambda s: F.col(f"avg_{s}_{LOOKBACK}w"), exact=False)
        return F.coalesce(total, F.lit(0.0)).cast("decimal(18,4)")

    return features.where(F.col("target_fantasy_ppr").isNotNull()).select(
        F.lit(run_id).alias("run_id"), "game_id", "athlete_id", "athlete_name", "season", "week",
        "game_date", "split", F.col("target_fantasy_ppr").alias("actual_ppr"),
        scored(weights).alias("predicted_ppr"),
        F.col("target_fantasy_standard").alias("actual_standard"),
        scored(standard_weights(weights)).alias("predicted_standard"),
        created_at.cast("timestamp_ntz").alias("created_at"))


def with_errors(df: DataFrame, predicted: str = "predicted_ppr",
                actual: str = "actual_ppr") -> DataFrame:
    gap = F.col(predicted) - F.col(actual)
    return df.withColumns({"error": gap, "abs_error": F.abs(gap)})


def next_game_features(gold: DataFrame, stats: list[str] = STAT_COLUMNS) -> DataFrame:
    """Averages of each athlete's last games of a season, for the game to come."""
    recent = last_n(gold, ["athlete_id", "season"], ["game_date", "game_id"], LOOKBACK)
    return (
        recent.groupBy("athlete_id", "season").agg(
            F.count(F.lit(1)).alias("lookback_count"), (F.max("week") + 1).alias("next_week"),
            *[F.avg(F.col(s).cast("double")).alias(f"avg_{s}_{LOOKBACK}w") for s in stats])
        .where(F.col("lookback_count") == LOOKBACK).drop("lookback_count"))
