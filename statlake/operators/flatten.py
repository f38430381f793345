"""Nested documents to flat raw rows; every function is a map-only projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions.scalars import first_non_empty, to_utc_ntz
from statlake.operators.checks import require_key

# Fixed value: the season of a game document that does not state one.
DEFAULT_SEASON = 2025
LINEAGE_COLUMNS = ["ingest_timestamp", "source_path", "run_id"]


def with_lineage(df: DataFrame, run_id: str, at: Column) -> DataFrame:
    """Stamp run id and ingest time; both are arguments so that reruns agree."""
    return df.withColumns({"run_id": F.lit(run_id), "ingest_timestamp": at.cast("timestamp_ntz")})


def _events(df: DataFrame) -> DataFrame:
    """One row per event with its first competition."""
    return df.select(F.explode("events").alias("e"), *LINEAGE_COLUMNS).withColumn(
        "c", F.get(F.col("e.competitions"), F.lit(0)))


def _competitors(df: DataFrame) -> DataFrame:
    return _events(df).select(
        F.col("e.id").alias("game"), F.explode("c.competitors").alias("t"), *LINEAGE_COLUMNS)


def _int(path: str) -> Column:
    return F.col(path).try_cast("int")


def flatten_games(df: DataFrame) -> DataFrame:
    return _events(df).select(
        _int("e.id").alias("id"), to_utc_ntz(F.col("e.date")).alias("start_date"),
        F.col("e.season.year").alias("season"), F.col("e.week.number").alias("week"),
        _int("c.venue.id").alias("venue_id"), F.col("c.attendance").alias("attendance"),
        *LINEAGE_COLUMNS)


def flatten_venues(df: DataFrame) -> DataFrame:
    return _events(df).select(
        _int("c.venue.id").alias("id"), F.col("c.venue.fullName").alias("fullname"),
        F.col("c.venue.address.city").alias("city"), F.col("c.venue.address.state").alias("state"),
        F.col("c.venue.address.country").alias("country"), F.col("c.venue.indoor").alias("indoor"),
        *LINEAGE_COLUMNS)


def flatten_teams(df: DataFrame) -> DataFrame:
    rows = _competitors(df).select(
        _int("t.id").alias("id"), F.col("t.team.name").alias("name"),
        F.col("t.team.abbreviation").alias("abbrev"),
        F.col("t.team.displayName").alias("display_name"),
        F.col("t.team.shortDisplayName").alias("short_name"),
        F.col("t.team.color").alias("color"),
        F.col("t.team.alternateColor").alias("alternate_color"),
        _int("t.team.venue.id").alias("venue_id"), F.col("t.team.logo").alias("logo"),
        *LINEAGE_COLUMNS)
    return require_key(rows, ["id"])


def flatten_game_team(df: DataFrame) -> DataFrame:
    rows = _competitors(df).select(
        F.col("game").try_cast("int").alias("game_id"), _int("t.id").alias("team_id"),
        F.col("t.homeAway").alias("home_away"), _int("t.score").alias("score"), *LINEAGE_COLUMNS)
    return require_key(rows, ["team_id"])


def season_of(df: DataFrame) -> Column:
    return F.coalesce(F.col("header.season.year"), F.lit(DEFAULT_SEASON))


def flatten_articles(df: DataFrame) -> DataFrame:
    """Articles; an empty article object has no id and yields no row."""
    a = "article"
    rows = df.where(F.col(a).isNotNull()).select(
        F.col(f"{a}.id"), F.col(f"{a}.headline"),
        to_utc_ntz(F.col(f"{a}.published")).alias("published"), F.col(f"{a}.source"),
        F.col(f"{a}.story"), "game_id", *LINEAGE_COLUMNS)
    return require_key(rows, ["id"])


def flatten_images(df: DataFrame) -> DataFrame:
    """Images with a url; an article without images yields no row."""
    # Fields first, rows second: the scan then leaves the story out.
    return (
        df.select(F.col("article.id").alias("article_id"), F.col("article.images"), "game_id",
                  *LINEAGE_COLUMNS)
        .select("article_id", "game_id", F.explode("images").alias("i"), *LINEAGE_COLUMNS)
        .where(F.col("i.url").isNotNull())
        .select("i.type", "i.name", "i.caption", "i.height", "i.width", "i.url",
                "game_id", "article_id", *LINEAGE_COLUMNS))


def flatten_team_stats(df: DataFrame) -> DataFrame:
    return (
        df.select("game_id", F.explode("boxscore.teams").alias("t"), *LINEAGE_COLUMNS)
        .select("game_id", "t", F.explode("t.statistics").alias("s"), *LINEAGE_COLUMNS)
        .select(F.col("s.name"), F.col("s.displayValue").alias("display_value"),
                F.col("s.value").cast("string").alias("value"), F.col("s.label"),
                F.col("t.team.id").alias("team_id"),
                F.col("t.team.abbreviation").alias("team_abbr"),
                F.col("t.homeAway").alias("home_away"), "game_id", *LINEAGE_COLUMNS))


def zip_shortest(*arrays: str, names: list[str] | None = None) -> Column:
    """Arrays zipped up to the shortest one; a missing array means no element.

    ``arrays_zip`` alone would pad the shorter ones with NULL.
    """
    # size(NULL) is NULL or -1 depending on the session; both mean empty here.
    n = F.array_min(F.array(*[
        F.greatest(F.coalesce(F.size(F.col(a)), F.lit(0)), F.lit(0)) for a in arrays]))
    parts = [
        F.slice(F.coalesce(F.col(a), F.array().cast("array<string>")), F.lit(1), n)
        .alias(name) for a, name in zip(arrays, names or arrays)
    ]
    return F.arrays_zip(*parts)


def flatten_player_stats(df: DataFrame) -> DataFrame:
    """Team, category and athlete levels unrolled to one row per statistic."""
    return (
        df.select("game_id", F.explode("boxscore.players").alias("b"), *LINEAGE_COLUMNS)
        .select("game_id", "b.team", F.explode("b.statistics").alias("cat"), *LINEAGE_COLUMNS)
        .select("game_id", "team", F.col("cat.name").alias("category"),
                F.col("cat.keys").alias("k"), F.col("cat.labels").alias("l"),
                F.explode("cat.athletes").alias("a"), *LINEAGE_COLUMNS)
        .select("*", F.col("a.stats").alias("v"))
        .withColumn("z", F.explode(zip_shortest("k", "l", "v")))
        .select("game_id", F.col("team.id").alias("team_id"),
                F.col("team.abbreviation").alias("team_abbr"),
                F.col("a.athlete.id").alias("athlete_id"),
                F.col("a.athlete.displayName").alias("athlete_name"), "category",
                F.col("z.k").alias("stat_key"), F.col("z.l").alias("stat_label"),
                F.col("z.v").alias("value_str"), *LINEAGE_COLUMNS))


def _spot(node: str) -> Column:
    return first_non_empty(*[
        F.col(f"{node}.{f}") for f in ("possessionText", "downDistanceText", "text")])


def _drives(df: DataFrame) -> DataFrame:
    return df.select("game_id", F.explode("drives.previous").alias("d"), *LINEAGE_COLUMNS)


def flatten_drives(df: DataFrame) -> DataFrame:
    d = "d"
    return _drives(df).select(
        "game_id", F.col(f"{d}.id").alias("drive_id"), F.col(f"{d}.team.id").alias("team_id"),
        F.col(f"{d}.team.abbreviation").alias("team_abbr"), F.col(f"{d}.description"),
        F.col(f"{d}.result"), F.col(f"{d}.displayResult").alias("display_result"),
        F.col(f"{d}.shortDisplayResult").alias("short_result"), F.col(f"{d}.yards"),
        F.col(f"{d}.offensivePlays").alias("offensive_plays"),
        F.col(f"{d}.isScore").alias("is_score"),
        F.col(f"{d}.start.period.number").alias("start_period"),
        F.col(f"{d}.start.clock.displayValue").alias("start_clock"),
        _spot(f"{d}.start").alias("start_spot"),
        F.col(f"{d}.end.period.number").alias("end_period"),
        F.col(f"{d}.end.clock.displayValue").alias("end_clock"),
        _spot(f"{d}.end").alias("end_spot"), F.col(f"{d}.timeElapsed").alias("time_elapsed"),
        *LINEAGE_COLUMNS)


def flatten_plays(df: DataFrame) -> DataFrame:
    """Plays of every drive."""
    return (
        _drives(df).select("game_id", F.col("d.id").alias("drive_id"),
                           F.explode("d.plays").alias("p"), *LINEAGE_COLUMNS)
        .select(
            "game_id", "drive_id", _int("p.sequenceNumber").alias("sequence"),
            F.col("p.id").alias("play_id"), F.col("p.period.number").alias("period"),
            F.col("p.clock.displayValue").alias("clock"), F.col("p.text"),
            F.col("p.statYardage").alias("stat_yardage"),
            F.col("p.scoringPlay").alias("scoring_play"), _spot("p.start").alias("start_spot"),
            _spot("p.end").alias("end_spot"), F.col("p.homeScore").alias("home_score"),
            F.col("p.awayScore").alias("away_score"), F.col("p.wallclock"),
            F.col("p.type.id").alias("type_id"), F.col("p.type.text").alias("type_text"),
            *LINEAGE_COLUMNS))


SCOREBOARD_ROWS = {
    "games": flatten_games, "venues": flatten_venues, "teams": flatten_teams,
    "game_team": flatten_game_team,
}
GAME_ROWS = {
    "articles": flatten_articles, "article_images": flatten_images,
    "team_stats": flatten_team_stats, "player_stats": flatten_player_stats,
    "drives": flatten_drives, "plays": flatten_plays,
}
