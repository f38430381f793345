"""Reporting queries over stage, gold, features and registry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statlake.functions.scalars import display_label, game_label
from statlake.operators.rows import apply_filters, last_n, page
from statlake.plans.registry import unpack_metrics


def stage_kpis(teams: DataFrame, games: DataFrame, articles: DataFrame,
               player_stats: DataFrame) -> DataFrame:
    """Four headline counts in one row; each is a single aggregate, joined as 1 x 1."""
    counts = [
        teams.agg(F.count(F.lit(1)).alias("n_teams")),
        games.agg(F.count(F.lit(1)).alias("n_games")),
        articles.agg(F.count(F.lit(1)).alias("n_articles")),
        player_stats.agg(F.count_distinct("athlete_id").alias("n_players")),
    ]
    return _side_by_side(counts)


#: Sketches of 2^14 registers: a standard error below 1 per cent.
SKETCH_BITS = 14


def distinct_sketches(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """One mergeable sketch of the distinct values for each group.

    Stored by day, sketches answer distinct counts over any span of days without the rows:
    a day is added once, and a span merges as many sketches of a fixed size as it has days.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The estimated number of distinct values of each group of merged sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def registry_kpis(models: DataFrame, versions: DataFrame, deployments: DataFrame,
                  runs: DataFrame) -> DataFrame:
    return _side_by_side([
        models.agg(F.count_distinct("model_id").alias("n_models")),
        versions.agg(F.count_if(F.col("status") == "approved").alias("n_approved")),
        deployments.agg(F.count_if(F.col("traffic_split") > 0).alias("n_active")),
        runs.agg(F.count_if(F.col("status") == "completed").alias("n_completed")),
    ])


def _side_by_side(rows: list[DataFrame]) -> DataFrame:
    """Single-row frames as the columns of one row, through a union and one ``max``."""
    names = [r.columns[0] for r in rows]
    stacked = None
    for r in rows:
        part = r.select(*[
            (F.col(n) if n in r.columns else F.lit(None).cast("bigint")).alias(n) for n in names])
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.agg(*[F.max(n).alias(n) for n in names])


def season_list(games: DataFrame) -> DataFrame:
    return games.select("season").distinct().orderBy(F.col("season").desc_nulls_last())


def weeks_of(games: DataFrame, season: int) -> DataFrame:
    return games.where(F.col("season") == season).select("week").distinct().orderBy(
        F.col("week").asc_nulls_last())


def games_per_week(games: DataFrame, season: int | None = None) -> DataFrame:
    return apply_filters(games, season=season).groupBy("week").agg(
        F.count(F.lit(1)).alias("games"))


def game_scores(games: DataFrame, game_team: DataFrame, teams: DataFrame,
                season: int | None = None, week: int | None = None) -> DataFrame:
    """One row per game and side with the team abbreviation and the score."""
    chosen = apply_filters(games, season=season, week=week)
    return (
        chosen.select(F.col("id").alias("game_id"), "season", "week")
        .join(game_team.select("game_id", "team_id", "home_away", "score"), "game_id")
        .join(teams.select(F.col("id").alias("team_id"), F.col("abbrev").alias("team")),
              "team_id", "left")
        .select("game_id", "season", "week", "team", "home_away", "score"))


def scores_wide(scores: DataFrame) -> DataFrame:
    """Home and away columns side by side, the highest score of each.

    Conditional maxima need one aggregation; ``pivot`` would plan two.
    """
    return scores.groupBy("game_id", "season", "week").agg(*[
        F.max(F.when(F.col("home_away") == side, F.col("score"))).alias(side)
        for side in ("away", "home")])


def games_to_pick(games: DataFrame, season: int | None = None, week: int | None = None) -> DataFrame:
    """The games of a season and week (or of all) in order of their ids."""
    week = week if season is not None else None
    return apply_filters(games, season=season, week=week).select(
        F.col("id").alias("game_id")).orderBy("game_id")


def articles_of(articles: DataFrame, game_id: int, n: int = 20) -> DataFrame:
    rows = articles.where(F.col("game_id") == game_id).select(
        "id", "headline", "published", "source", "story")
    return page(rows, [F.col("published").desc_nulls_last(), F.col("id")], n)


def images_of(images: DataFrame, game_id: int, n: int = 6) -> DataFrame:
    rows = images.where(F.col("game_id") == game_id).select("url", "caption", "height", "width")
    return page(rows, [F.col("url")], n)


def player_stat_page(player_stats: DataFrame, game_id: int | None = None,
                     n: int = 200) -> DataFrame:
    rows = apply_filters(player_stats, game_id=game_id).select(
        "game_id", "athlete_id", "athlete_name", "category", "stat_key", "stat_label",
        "value_str", "team_id")
    order = ["game_id", "athlete_name", "athlete_id", "category", "stat_key", "value_str",
             "team_id"]
    return page(rows, [F.col(c).asc_nulls_last() for c in order], n)


def version_registry(versions: DataFrame, models: DataFrame) -> DataFrame:
    return versions.join(
        models.select("model_id", F.col("name").alias("model_name")), "model_id"
    ).select("model_version_id", "model_id", "model_name", "status",
             *unpack_metrics("metrics_json"), "created_at").orderBy(
        F.col("created_at").desc_nulls_last(), "model_version_id")


def recent_runs(runs: DataFrame, n: int = 30) -> DataFrame:
    rows = runs.select(
        "run_id", "model_id", "dataset_id",
        *unpack_metrics("metrics", ("test_rmse", "test_mae", "test_corr")),
        F.get_json_object("params", "$.algorithm").alias("algorithm"),
        F.get_json_object("params", "$.model_type").alias("model_type"), "status", "created_at")
    return page(rows, [F.col("created_at").desc_nulls_last(), F.col("run_id")], n)


def algorithm_comparison(runs: DataFrame) -> DataFrame:
    """Mean metrics per algorithm, or model type where none is named; no NULL group."""
    kind = F.coalesce("algorithm", "model_type")
    return runs.withColumn("algorithm_type", kind).where(kind.isNotNull()).groupBy(
        "algorithm_type").agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in ("test_mae", "test_rmse", "test_corr")])


def player_list(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Distinct players by name with a display label."""
    players = rows.where(F.col("athlete_name").isNotNull()).select(
        "athlete_id", "athlete_name").distinct().withColumn(
        "label", display_label(F.col("athlete_name"), F.col("athlete_id")))
    order = [F.col("athlete_name"), F.col("athlete_id")]
    return players.orderBy(*order) if n is None else page(players, order, n)


def player_history(gold: DataFrame, athlete_id: str | None = None) -> DataFrame:
    return apply_filters(gold, athlete_id=athlete_id).where(
        F.col("fantasy_points_ppr").isNotNull()).select(
        "athlete_id", "game_id", "season", "week", "game_date",
        F.col("fantasy_points_ppr").alias("actual_ppr"),
        F.col("fantasy_points_standard").alias("actual_standard"))


def player_summary(history: DataFrame) -> DataFrame:
    """Mean, sample deviation, best and number of games per athlete."""
    value = F.col("actual_ppr").cast("double")
    return history.groupBy("athlete_id").agg(
        F.avg(value).alias("avg_ppr"), F.stddev_samp(value).alias("std_ppr"),
        F.max(value).alias("max_ppr"), F.count(F.lit(1)).alias("total_games"))


def last_games(history: DataFrame, n: int = 4) -> DataFrame:
    """The last games per athlete with their axis label."""
    return last_n(history, ["athlete_id"], ["game_date", "game_id"], n).withColumn(
        "game_label", game_label(F.col("week"), F.col("game_date")))


def latest_features(features: DataFrame, n: int = 10) -> DataFrame:
    """The last feature rows per athlete; ``next_week`` is the dashboard's label."""
    return last_n(features, ["athlete_id"], ["game_date", "game_id"], n).withColumn(
        "next_week", F.col("week") + 1)


def segment_totals(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.sum(value).alias("total"))


def category_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count, sum and mean of every category in one pass."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"),
        F.avg(value).alias("mean"))
