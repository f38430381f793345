"""The chain from landed documents to predictions, streamed and in one run.

Events stand in for games: the day is the game, the user the athlete of one of two teams.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from statlake.bindings.common import ntz, query, rounded, table
from statlake.operators import flatten
from statlake.plans import daily, marts, registry
from statlake.session import scratch_dir
from statlake.sources import files
from statlake.sources.lake import Lake
from statlake.streaming.ingest import chain_stream

AT = datetime(2025, 1, 1)
FIRST_DAY = "2024-01-01"

GOLD = """
WITH gold AS (SELECT date_diff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS game_id, user_id::VARCHAR AS athlete_id,
    (1 + user_id % 2)::INTEGER AS team_id, year(any_value(ts))::INTEGER AS season,
    (date_diff('day', DATE '2024-01-01', ts::DATE) // 7 + 1)::INTEGER AS week, date_trunc('day', any_value(ts))::TIMESTAMP AS game_date,
    user_id % 2 = 0 AS is_home, (2 - user_id % 2)::INTEGER AS opponent_team_id,
    count(*)::DOUBLE AS receptions, sum(event_id % 100)::DOUBLE AS receiving_yards
  FROM events GROUP BY user_id, ts::DATE),
points AS (SELECT *, receptions + receiving_yards * 0.1::DOUBLE AS ppr, receiving_yards * 0.1::DOUBLE AS standard FROM gold)"""


def _landed(spark, d, parts: int) -> str:
    """Schedules and game documents as JSON lines; a game's documents lie in one part."""
    root = scratch_dir(spark, "landed")
    e = table(spark, d, "events").withColumn(
        "game_id", F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")))
    part = (F.col("game_id") % parts).alias("part")

    def side(ident: int, where: str):
        name = F.lit(f"T{ident}")
        return F.struct(F.lit(str(ident)).alias("id"), F.lit(where).alias("homeAway"), F.lit("0").alias("score"),
                        F.struct(name.alias("name"), name.alias("abbreviation")).alias("team"))

    days = e.select("game_id", F.to_date("ts").alias("day")).distinct()
    event = F.struct(
        F.col("game_id").cast("string").alias("id"), F.date_format("day", "yyyy-MM-dd'T00:00Z'").alias("date"),
        F.struct(F.year("day").alias("year")).alias("season"),
        F.struct((F.floor(F.col("game_id") / 7) + 1).cast("int").alias("number")).alias("week"),
        F.array(F.struct(F.array(side(1, "home"), side(2, "away")).alias("competitors"))).alias("competitions"))
    files.land_json(days.select(part, F.array(event).alias("events"), F.year("day").alias("season")),
                    f"{root}/boards", ["part"])
    lines = e.groupBy("game_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("event_id") % 100).alias("yards"))
    athlete = F.struct(
        F.struct(F.col("user_id").cast("string").alias("id"), F.lit("name").alias("displayName")).alias("athlete"),
        F.array(F.col("n").cast("string"), F.col("yards").cast("string")).alias("stats"))
    category = F.struct(
        F.lit("receiving").alias("name"), F.array(F.lit("receptions"), F.lit("receivingYards")).alias("keys"),
        F.array(F.lit("REC"), F.lit("YDS")).alias("labels"), F.array(athlete).alias("athletes"))
    block = F.struct(F.struct((1 + F.col("user_id") % 2).cast("string").alias("id"), F.lit("x").alias("abbreviation"))
                     .alias("team"), F.array(category).alias("statistics"))
    files.land_json(lines.select(part, "game_id", F.struct(F.array(block).alias("players")).alias("boxscore")),
                    f"{root}/games", ["part"])
    return root


@query(GOLD + """
SELECT game_id, athlete_id, team_id, season, week, game_date, is_home, opponent_team_id, receptions, receiving_yards,
  round(ppr, 4) AS fantasy_points_ppr, round(standard, 4) AS fantasy_points_standard FROM points""")
def stream_chain(spark, d):
    """Schedules and games stream in by batches; gold holds what one batch run would."""
    root = _landed(spark, d, 2)
    lake = Lake(spark, f"{root}/lake")
    for kind, folder in (("game", "games"), ("scoreboard", "boards")):
        chain_stream(spark, f"{root}/{folder}", lake, kind, f"{root}/checkpoint-{kind}", AT, max_files=4,
                     one_per_file=False).awaitTermination()
    gold = lake.read("gold", "player_game_stats").select(
        "game_id", "athlete_id", "team_id", "season", "week", "game_date", "is_home", "opponent_team_id",
        "receptions", "receiving_yards", "fantasy_points_ppr", "fantasy_points_standard")
    return rounded(gold, 4, "receptions", "receiving_yards", "fantasy_points_ppr", "fantasy_points_standard")


PREDICTED = GOLD + """,
lagged AS (SELECT *, avg(receptions) OVER w + avg(receiving_yards) OVER w * 0.1::DOUBLE AS predicted, count(*) OVER w AS n
  FROM points WINDOW w AS (PARTITION BY athlete_id, season ORDER BY game_date, game_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
predicted AS (SELECT game_id, athlete_id, ppr::DECIMAL(18,4) AS y, predicted::DECIMAL(18,4) AS p,
    CASE WHEN percent_rank() OVER (ORDER BY game_date) < 0.70 THEN 'train' ELSE 'test' END AS split
  FROM lagged WHERE n = 3)"""


def _chain(spark, d) -> Lake:
    root = _landed(spark, d, 2)
    lake = Lake(spark, f"{root}/lake")
    daily.run_chain(lake, files.read_scoreboards(spark, f"{root}/boards", one_per_file=False),
                    files.read_game_details(spark, f"{root}/games", one_per_file=False), "run-1", AT)
    return lake


@query(PREDICTED + " SELECT game_id, athlete_id, split, round(y::DOUBLE, 3) AS actual_ppr, round(p::DOUBLE, 3) AS predicted_ppr FROM predicted")
def chain_predictions(spark, d):
    """From landed documents to the stored predictions of a registered run."""
    found = _chain(spark, d).read("model_outputs", "predictions_fantasy").select(
        "game_id", "athlete_id", "split", "actual_ppr", "predicted_ppr")
    return rounded(found, 3, "actual_ppr", "predicted_ppr")


@query(PREDICTED + """
SELECT 'run-1' AS training_run_id, 'approved' AS status, 1.0::DOUBLE AS traffic_split, count(*) AS test_count,
  round(avg(abs(y::DOUBLE - p::DOUBLE)), 2) AS mae FROM predicted WHERE split = 'test'""")
def register_runs(spark, d):
    """The registry after the chain: the run's version, its status, traffic and metrics."""
    lake = _chain(spark, d)
    versions = lake.read("mlops", "model_version").join(lake.read("mlops", "deployment"), "model_version_id").select(
        "training_run_id", "status", "traffic_split", *registry.unpack_metrics("metrics_json"))
    return versions.select(
        "training_run_id", "status", F.col("traffic_split").cast("double").alias("traffic_split"),
        F.col("test_count").cast("long").alias("test_count"), F.round(F.col("test_mae").cast("double"), 2).alias("mae"))


@query("""
SELECT conv_id::INTEGER AS game_id, ('d' || conv_id) AS drive_id, turn::INTEGER AS sequence, (conv_id || '-' || turn) AS play_id,
  (turn % 4 + 1)::INTEGER AS period, text, length(text)::INTEGER AS stat_yardage, role = 'assistant' AS scoring_play,
  CASE WHEN turn % 2 = 0 THEN 'at ' || role ELSE 'line ' || turn END AS start_spot, role AS type_text, 'run-1' AS run_id
FROM conversations""")
def flatten_plays(spark, d):
    """Each turn as the one play of a drive, landed as JSON and read back; with its lineage."""
    at = scratch_dir(spark, "plays")
    turn = F.col("turn").cast("int")
    spot = F.struct(F.when(turn % 2 == 0, F.concat(F.lit("at "), "role")).alias("possessionText"),
                    F.concat(F.lit("line "), turn.cast("string")).alias("downDistanceText"))
    play = F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string")).alias("id"),
        turn.cast("string").alias("sequenceNumber"), F.struct(F.col("role").alias("text")).alias("type"), "text",
        F.struct((turn % 4 + 1).alias("number")).alias("period"), (F.col("role") == "assistant").alias("scoringPlay"),
        F.length("text").alias("statYardage"), spot.alias("start"))
    drive = F.struct(F.concat(F.lit("d"), F.col("conv_id").cast("string")).alias("id"), F.array(play).alias("plays"))
    files.land_json(table(spark, d, "conversations").select(
        (F.col("conv_id") % 4).alias("part"), F.col("conv_id").cast("int").alias("game_id"),
        F.struct(F.array(drive).alias("previous")).alias("drives")), at, ["part"])
    docs = files.read_game_details(spark, at, one_per_file=False)
    return flatten.flatten_plays(flatten.with_lineage(docs, "run-1", ntz("2025-01-01"))).select(
        "game_id", "drive_id", "sequence", "play_id", "period", "text", "stat_yardage", "scoring_play", "start_spot",
        "type_text", "run_id")


@query("""
SELECT date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT o_custkey) AS n_distinct, true AS within_bound
FROM orders GROUP BY 1""")
def approximate_distinct(spark, d):
    """Distinct customers of a month from sketches of its days, held against exact counts."""
    orders = table(spark, d, "orders").select(
        F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("athlete_id"))
    sketches = marts.distinct_sketches(orders, ["day"], "athlete_id")
    month = F.trunc("day", "month").alias("month")
    estimated = marts.distinct_estimates(sketches.withColumn("month", F.trunc("day", "month")), ["month"])
    exact = orders.groupBy(month).agg(F.count_distinct("athlete_id").alias("n_distinct"))
    return exact.join(estimated, "month").select(
        "month", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")).alias("within_bound"))
