"""Long key/value statistics to one wide row, and the opponent lookup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from statlake.functions.scalars import stat_decimal


@dataclass(frozen=True)
class Stat:
    """Where an output column comes from: key, optional category, optional part."""

    name: str
    key: str
    category: str | None = None
    sep: str | None = None
    part: int | None = None

    def text(self, key_col: str, value_col: str, category_col: str) -> Column:
        hit = F.col(key_col) == self.key
        if self.category is not None:
            hit = hit & (F.col(category_col) == self.category)
        value = F.col(value_col)
        if self.sep is not None:
            value = F.split_part(value, F.lit(self.sep), F.lit(self.part))
        return F.when(hit, value)


def _pair(made: str, tried: str, key: str, sep: str = "/") -> list[Stat]:
    return [Stat(made, key, sep=sep, part=1), Stat(tried, key, sep=sep, part=2)]


# Output column, source key, category and part of each statistic.
PLAYER_STATS = [
    *_pair("pass_completions", "pass_attempts", "completions/passingAttempts"),
    Stat("pass_yards", "passingYards"),
    Stat("pass_touchdowns", "passingTouchdowns"),
    Stat("interceptions", "interceptions", category="passing"),
    Stat("sacks", "sacks-sackYardsLost", sep="-", part=1),
    Stat("qb_rating", "QBRating"),
    Stat("rush_attempts", "rushingAttempts"),
    Stat("rush_yards", "rushingYards"),
    Stat("rush_touchdowns", "rushingTouchdowns"),
    Stat("receptions", "receptions"),
    Stat("receiving_targets", "receivingTargets"),
    Stat("receiving_yards", "receivingYards"),
    Stat("receiving_touchdowns", "receivingTouchdowns"),
    Stat("fumbles", "fumbles", category="fumbles"),
    Stat("fumbles_lost", "fumblesLost"),
    *_pair("field_goals_made", "field_goal_attempts", "fieldGoalsMade/fieldGoalAttempts"),
    *_pair("extra_points_made", "extra_point_attempts", "extraPointsMade/extraPointAttempts"),
    Stat("total_tackles", "totalTackles"),
    Stat("sacks_def", "sacks", category="defensive"),
    Stat("interceptions_def", "interceptions", category="interceptions"),
    Stat("fumbles_recovered", "fumblesRecovered"),
    Stat("defensive_touchdowns", "defensiveTouchdowns"),
]


def pivot_stats(df: DataFrame, keys: list[str], stats: list[Stat], key_col: str = "stat_key",
                value_col: str = "value_str", category_col: str = "category") -> DataFrame:
    """One row per key with every statistic as DECIMAL(10,2).

    The text maximum per statistic is taken first and parsed after, as strings
    compare differently from numbers. Rows of other keys are filtered before the
    shuffle only by the aggregate itself, so a player without any listed
    statistic still yields a row of zeros. Partial aggregation runs map-side.
    """
    wide = df.groupBy(*keys).agg(*[
        F.max(s.text(key_col, value_col, category_col)).alias(s.name) for s in stats
    ])
    return wide.select(*keys, *[stat_decimal(F.col(s.name)).alias(s.name) for s in stats])


def with_opponent(df: DataFrame, members: DataFrame, game: str, team: str,
                  out: dict[str, str]) -> DataFrame:
    """Add the lowest other team of the same game, NULL when there is none.

    ``members`` lists the teams of each game; ``out`` maps its columns to output
    names and its first entry must be the team. Only the two lowest teams of a
    game can ever be "the lowest other one", so the lookup holds two teams per
    game and the join adds no rows, however many teams or rows a game has.
    """
    fields = list(out)
    rest = fields[1:]
    per_team = members.where(F.col(fields[0]).isNotNull()).groupBy(game, fields[0]).agg(
        *[F.min(F.struct(*rest)).alias("_rest")] if rest else [F.lit(None).alias("_rest")]
    ).select(game, fields[0], *[F.col(f"_rest.{f}").alias(f) for f in rest])
    order = Window.partitionBy(game).orderBy(F.col(fields[0]))
    lowest = per_team.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= 2)
    team_of = F.struct(*fields)
    pairs = lowest.groupBy(F.col(game).alias("_game")).agg(
        F.max(F.when(F.col("_rn") == 1, team_of)).alias("_lo"),
        F.max(F.when(F.col("_rn") == 2, team_of)).alias("_hi"),
    )
    joined = df.join(pairs, df[game] == pairs["_game"], "left")
    other = (
        F.when(F.col(f"_lo.{fields[0]}") != F.col(team), F.col("_lo"))
        .when(F.col(f"_hi.{fields[0]}") != F.col(team), F.col("_hi"))
    )
    return joined.withColumn("_opp", other).select(
        *df.columns, *[F.col(f"_opp.{f}").alias(name) for f, name in out.items()]
    )
