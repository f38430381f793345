"""The player-game fact: unseen stage rows, pivoted, scored and placed in context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions.scalars import SCORING_WEIGHTS, points, standard_weights
from statlake.operators.pivot import PLAYER_STATS, Stat, pivot_stats, with_opponent
from statlake.operators.rows import new_rows


def gold_incremental(player_stats: DataFrame, games: DataFrame, game_team: DataFrame,
                     teams: DataFrame, gold: DataFrame, loaded_at: Column,
                     only_games: DataFrame | None = None, stats: list[Stat] = PLAYER_STATS,
                     weights: dict[str, str] = SCORING_WEIGHTS) -> DataFrame:
    """Rows to add to the gold fact; existing (game, athlete) pairs are not touched.

    Everything known about a team in a game is put together at the size of the
    bridge table first, so the player rows join it once. ``only_games`` (game_id) names the games of the current load: the stage scan
    then reads those alone instead of all history. Base and pivot both end up
    hashed on (game, athlete), the pivot after map-side aggregation.
    """
    keys = ["game_id", "athlete_id"]
    facts = player_stats
    if only_games is not None:
        facts = facts.join(only_games.select("game_id").distinct(), "game_id", "left_semi")

    # What gold holds goes first, so that base and pivot see the new rows alone.
    fresh = new_rows(facts, gold, keys)
    wide = pivot_stats(fresh, keys, stats)
    base = fresh.select(*keys, "athlete_name", "team_id").distinct()
    if only_games is not None:
        loaded = only_games.select("game_id").distinct()
        game_team = game_team.join(loaded, "game_id", "left_semi")
        games = games.join(loaded.withColumnRenamed("game_id", "id"), "id", "left_semi")
    rows = base.join(game_context(games, game_team, teams), ["game_id", "team_id"]).join(wide, keys)
    return rows.select(
        *keys, "athlete_name", F.col("team_id").cast("int").alias("team_id"), "team_abbrev", "season", "week", "game_date", "is_home",
        "opponent_team_id", "opponent_abbrev", *[s.name for s in stats],
        points(weights).cast("decimal(18,4)").alias("fantasy_points_ppr"),
        points(standard_weights(weights)).cast("decimal(18,4)").alias("fantasy_points_standard"),
        loaded_at.cast("timestamp_ntz").alias("loaded_at"),
    )


def game_context(games: DataFrame, game_team: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per team of a game: date, home or away, names, opponent.

    ``team_id`` is text, as in the player facts: the small side is cast. A team
    may be missing from ``teams`` (NULL name) but an opponent must be there.
    """
    named = teams.select(F.col("id").alias("team_id"), F.col("abbrev"))
    sides = game_team.select("game_id", "team_id", "home_away").distinct()
    members = sides.select("game_id", "team_id").join(named, "team_id")
    context = (
        sides.join(games.select(F.col("id").alias("game_id"), "season", "week",
                                F.col("start_date").alias("game_date")), "game_id")
        .join(named.withColumnRenamed("abbrev", "team_abbrev"), "team_id", "left"))
    context = with_opponent(context, members, "game_id", "team_id",
                            {"team_id": "opponent_team_id", "abbrev": "opponent_abbrev"})
    return context.withColumns({
        "team_id": F.col("team_id").cast("string"),
        "is_home": F.when(F.col("home_away") == "home", True).otherwise(False),
    }).drop("home_away")
