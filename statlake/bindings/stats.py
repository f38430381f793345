"""Statistics: pivot, gold fact, lagged features, predictions, metrics, marts.

Events stand in for player statistics: the day is the game, the user the athlete,
the event type the statistic key, the customer's nation the team.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.bindings.common import ntz, query, rounded, table
from statlake.functions.metrics import regression_metrics as metrics_of
from statlake.functions.scalars import SCORING_WEIGHTS, display_label, points
from statlake.operators.pivot import PLAYER_STATS, Stat, pivot_stats
from statlake.operators.rows import latest_per_key
from statlake.operators.windows import lagged_features as lagged_of, temporal_split as split_by
from statlake.plans import features as feat, marts
from statlake.plans.gold import gold_incremental
from statlake.session import scratch_dir

FIRST_DAY = "2024-01-01"

STATS = [
    Stat("pass_completions", "purchase", sep="/", part=1),
    Stat("pass_yards", "purchase", sep="/", part=2),
    Stat("interceptions", "error"),
    Stat("rush_yards", "view", category="late"),
    Stat("receptions", "click"),
    Stat("receiving_yards", "signup"),
]
STAT_NAMES = [s.name for s in STATS]
WEIGHTS = {k: v for k, v in SCORING_WEIGHTS.items() if k in STAT_NAMES}

LONG = """
long AS (
  SELECT date_diff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS game_id,
    user_id::VARCHAR AS athlete_id, event_type AS stat_key, ts, event_id,
    CASE WHEN json_extract_string(props, '$.k')::INTEGER >= 50 THEN 'late' ELSE 'early' END
      AS category,
    CASE event_type
      WHEN 'purchase' THEN json_extract_string(props, '$.k') || '/' || floor(value)::BIGINT::VARCHAR
      WHEN 'error' THEN '--' ELSE value::DECIMAL(12,2)::VARCHAR END AS value_str
  FROM events)"""


def _max(name, cond, part=None):
    v = f"split_part(value_str, '/', {part})" if part else "value_str"
    return (f"coalesce(TRY_CAST(max(CASE WHEN {cond} THEN {v} END) AS DECIMAL(10,2)), 0)"
            f"::DECIMAL(10,2) AS {name}")


PIVOT_COLUMNS = ", ".join([
    _max("pass_completions", "stat_key = 'purchase'", 1),
    _max("pass_yards", "stat_key = 'purchase'", 2),
    _max("interceptions", "stat_key = 'error'"),
    _max("rush_yards", "stat_key = 'view' AND category = 'late'"),
    _max("receptions", "stat_key = 'click'"),
    _max("receiving_yards", "stat_key = 'signup'"),
])
PPR = ("(pass_yards * 0.04 + interceptions * -2 + rush_yards * 0.1 + receptions * 1 "
       "+ receiving_yards * 0.1)")
STANDARD = "(pass_yards * 0.04 + interceptions * -2 + rush_yards * 0.1 + receiving_yards * 0.1)"
AS_DOUBLE = ", ".join(f"{s}::DOUBLE AS {s}" for s in STAT_NAMES)

STAGE = LONG + """,
stage AS (SELECT * FROM long QUALIFY row_number() OVER (
  PARTITION BY game_id, athlete_id, stat_key ORDER BY ts DESC, event_id DESC) = 1),
facts AS (SELECT s.*, c.c_name AS athlete_name, c.c_nationkey::VARCHAR AS team_id
  FROM stage s JOIN customer c ON s.athlete_id = c.c_custkey::VARCHAR),
games AS (SELECT DISTINCT date_diff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS id,
  year(ts)::INTEGER AS season, week(ts)::INTEGER AS week, date_trunc('day', ts)::TIMESTAMP
  AS start_date FROM events),
game_team AS (SELECT DISTINCT f.game_id, f.team_id::INTEGER AS team_id,
  CASE WHEN f.team_id::INTEGER % 2 = 0 THEN 'home' ELSE 'away' END AS home_away
  FROM facts f WHERE stat_key = 'purchase'),
teams AS (SELECT n_nationkey AS id, n_name AS abbrev FROM nation WHERE n_regionkey <> 4)
"""


def gold_sql(where: str) -> str:
    return f"""
{STAGE},
base AS (SELECT DISTINCT f.game_id, f.athlete_id, f.athlete_name, f.team_id::INTEGER AS team_id,
    g.season, g.week, g.start_date AS game_date, gt.home_away = 'home' AS is_home
  FROM facts f JOIN games g ON f.game_id = g.id
  JOIN game_team gt ON f.game_id = gt.game_id AND f.team_id = gt.team_id::VARCHAR
  {where}),
wide AS (SELECT game_id, athlete_id, {PIVOT_COLUMNS} FROM facts GROUP BY game_id, athlete_id),
opp AS (SELECT b.game_id, b.team_id, min(o.team_id) AS opponent_team_id,
    arg_min(t.abbrev, o.team_id) AS opponent_abbrev
  FROM (SELECT DISTINCT game_id, team_id FROM base) b
  JOIN game_team o ON o.game_id = b.game_id AND o.team_id <> b.team_id
  JOIN teams t ON t.id = o.team_id GROUP BY b.game_id, b.team_id),
gold AS (SELECT b.*, t.abbrev AS team_abbrev, opp.opponent_team_id, opp.opponent_abbrev,
    w.* EXCLUDE (game_id, athlete_id), {PPR}::DECIMAL(18,4) AS fantasy_points_ppr,
    {STANDARD}::DECIMAL(18,4) AS fantasy_points_standard
  FROM base b JOIN wide w ON b.game_id = w.game_id AND b.athlete_id = w.athlete_id
  LEFT JOIN teams t ON t.id = b.team_id
  LEFT JOIN opp ON opp.game_id = b.game_id AND opp.team_id = b.team_id)"""


GOLD_ALL = gold_sql("")
GOLD_NEW = gold_sql("WHERE NOT EXISTS (SELECT 1 FROM long e WHERE e.game_id < 14 "
                    "AND e.game_id = f.game_id AND e.athlete_id = f.athlete_id)")
CONTEXT = ("game_id, athlete_id, athlete_name, team_id, team_abbrev, season, week, game_date, "
           "is_home, opponent_team_id, opponent_abbrev")


# ---------------------------------------------------------------- input frames


def long_stats(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).alias("game_id"),
        F.col("user_id").cast("string").alias("athlete_id"),
        F.col("event_type").alias("stat_key"), "ts", "event_id",
        F.when(k.cast("int") >= 50, "late").otherwise("early").alias("category"),
        F.when(F.col("event_type") == "purchase",
               F.concat(k, F.lit("/"), F.floor("value").cast("string")))
        .when(F.col("event_type") == "error", "--")
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("value_str"))


def stage_frames(spark, d):
    """Stage-shaped facts (a written table, as in the lake), games, bridge and teams."""
    newest = latest_per_key(long_stats(spark, d), ["game_id", "athlete_id", "stat_key"],
                            ["ts"], ["event_id"])
    people = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("athlete_id"), F.col("c_name").alias("athlete_name"),
        F.col("c_nationkey").cast("string").alias("team_id"))
    at = scratch_dir(spark, "player-stats")
    newest.join(people, "athlete_id").select(
        "game_id", "athlete_id", "athlete_name", "team_id", "category", "stat_key", "value_str"
    ).write.parquet(at)
    facts = spark.read.parquet(at)
    e = table(spark, d, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    games = e.select(
        F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).alias("id"),
        F.year("ts").alias("season"), F.weekofyear("ts").alias("week"),
        day.alias("start_date")).distinct()
    team = F.col("team_id").cast("int")
    game_team = facts.where(F.col("stat_key") == "purchase").select(
        "game_id", team.alias("team_id"),
        F.when(team % 2 == 0, "home").otherwise("away").alias("home_away")).distinct()
    teams = table(spark, d, "nation").where(F.col("n_regionkey") != 4).select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("abbrev"))
    return facts, games, game_team, teams


def gold_frame(spark, d, existing_before: int = 0):
    facts, games, game_team, teams = stage_frames(spark, d)
    existing = long_stats(spark, d).where(F.col("game_id") < existing_before).select(
        "game_id", "athlete_id").distinct()
    return gold_incremental(facts, games, game_team, teams, existing, ntz("2024-02-01"),
                            stats=STATS, weights=WEIGHTS).drop("loaded_at")


def stored_gold(spark, d):
    """All player-games as a written table, the way the feature build reads them."""
    at = scratch_dir(spark, "gold")
    gold_frame(spark, d).write.parquet(at)
    return spark.read.parquet(at)


def feature_frame(spark, d):
    return feat.build_features(stored_gold(spark, d), ntz("2024-02-01"), STAT_NAMES)


# ---------------------------------------------------------------- gold


# All statistics: the 22 source keys in order of appearance, dealt to the events by number.
STAT_KEYS = list(dict.fromkeys(s.key for s in PLAYER_STATS))
CATEGORIES = ["passing", "interceptions", "defensive", "fumbles"]


def all_stats(spark, d):
    """Every event as a statistic of its athlete, with compound values and odd ones."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    key = F.get(F.array(*map(F.lit, STAT_KEYS)), (F.col("event_id") % len(STAT_KEYS)).cast("int"))
    whole = F.floor("value").cast("string")
    sep = F.when(F.contains("stat_key", F.lit("/")), "/").when(F.contains("stat_key", F.lit("-")), "-")
    return e.withColumn("stat_key", key).select(
        F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).alias("game_id"),
        F.col("user_id").cast("string").alias("athlete_id"), "stat_key",
        F.get(F.array(*map(F.lit, CATEGORIES)), F.col("k").cast("int") % 4).alias("category"),
        F.when(F.col("k") == "7", "--").when(F.col("k") == "8", "")
        .when(sep.isNotNull(), F.concat("k", sep, whole))
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("value_str"))


# The same as rows: each statistic's pieces are found by a join with the list of statistics.
ALL_STATS = f"""
WITH spec(name, key, category, sep, part) AS (VALUES {", ".join(
    f"('{s.name}', '{s.key}', {'NULL' if s.category is None else repr(s.category)}, "
    f"{'NULL' if s.sep is None else repr(s.sep)}, {s.part or 'NULL'})" for s in PLAYER_STATS)}),
e AS (SELECT *, json_extract_string(props, '$.k') AS k, {STAT_KEYS}[event_id % {len(STAT_KEYS)} + 1] AS stat_key FROM events),
long AS (SELECT date_diff('day', DATE '{FIRST_DAY}', ts::DATE)::INTEGER AS game_id, user_id::VARCHAR AS athlete_id, stat_key,
  {CATEGORIES}[k::INTEGER % 4 + 1] AS category, CASE WHEN k = '7' THEN '--' WHEN k = '8' THEN ''
    WHEN contains(stat_key, '/') THEN k || '/' || floor(value)::BIGINT::VARCHAR
    WHEN contains(stat_key, '-') THEN k || '-' || floor(value)::BIGINT::VARCHAR
    ELSE value::DECIMAL(12,2)::VARCHAR END AS value_str FROM e),
found AS (SELECT game_id, athlete_id, name, max(CASE WHEN sep IS NULL THEN value_str ELSE split_part(value_str, sep, part) END) AS v
  FROM long JOIN spec ON stat_key = key AND (spec.category IS NULL OR spec.category = long.category) GROUP BY ALL),
players AS (SELECT DISTINCT game_id, athlete_id FROM long)
SELECT game_id, athlete_id, {", ".join(
    f"coalesce(max(CASE WHEN name = '{s.name}' THEN TRY_CAST(v AS DECIMAL(10,2)) END), 0)::DOUBLE AS {s.name}"
    for s in PLAYER_STATS)}
FROM players LEFT JOIN found USING (game_id, athlete_id) GROUP BY game_id, athlete_id"""


@query(ALL_STATS)
def stat_pivot_all(spark, d):
    """All 25 statistics of the fact."""
    wide = pivot_stats(all_stats(spark, d), ["game_id", "athlete_id"], PLAYER_STATS)
    return rounded(wide, 2, *[s.name for s in PLAYER_STATS])


@query(f"WITH {LONG} SELECT game_id, athlete_id, {AS_DOUBLE} FROM (SELECT game_id, athlete_id, "
       f"{PIVOT_COLUMNS} FROM long GROUP BY game_id, athlete_id)")
def stat_pivot(spark, d):
    wide = pivot_stats(long_stats(spark, d), ["game_id", "athlete_id"], STATS)
    return rounded(wide, 2, *STAT_NAMES)


@query(f"WITH {LONG}, wide AS (SELECT game_id, athlete_id, {PIVOT_COLUMNS} FROM long "
       f"GROUP BY game_id, athlete_id) SELECT game_id, athlete_id, "
       f"round({PPR}::DOUBLE, 4) AS points_ppr, round({STANDARD}::DOUBLE, 4) AS points_standard "
       "FROM wide")
def fantasy_points(spark, d):
    wide = pivot_stats(long_stats(spark, d), ["game_id", "athlete_id"], STATS)
    standard = {k: v for k, v in WEIGHTS.items() if k != "receptions"}
    return rounded(wide.select("game_id", "athlete_id", points(WEIGHTS).alias("points_ppr"),
                               points(standard).alias("points_standard")),
                   4, "points_ppr", "points_standard")


@query(f"WITH {GOLD_NEW} SELECT {CONTEXT}, {AS_DOUBLE}, "
       "round(fantasy_points_ppr::DOUBLE, 4) AS fantasy_points_ppr, "
       "round(fantasy_points_standard::DOUBLE, 4) AS fantasy_points_standard FROM gold")
def gold_player_game(spark, d):
    """Flagship: the player-games gold does not hold yet, pivoted, placed and scored."""
    gold = gold_frame(spark, d, existing_before=14)
    return rounded(rounded(gold, 2, *STAT_NAMES), 4, "fantasy_points_ppr",
                   "fantasy_points_standard")


# ---------------------------------------------------------------- features

DAILY = """
daily AS (SELECT user_id, date_trunc('month', ts)::DATE AS month, ts::DATE AS day,
  round(sum(value), 2) AS total, count(*) AS n_events FROM events GROUP BY ALL)"""
LAGGED = f"""WITH {DAILY}, lagged AS (SELECT user_id, month, day, total,
  avg(total) OVER w AS a, avg(n_events) OVER w AS b, count(*) OVER w AS lookback_count FROM daily
  WINDOW w AS (PARTITION BY user_id, month ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT user_id, day, total, round(a, 6) AS avg_total_3w, round(b, 6) AS avg_n_events_3w,
  lookback_count FROM lagged"""


def _daily(spark, d):
    return table(spark, d, "events").groupBy(
        "user_id", F.trunc(F.to_date("ts"), "month").alias("month"), F.to_date("ts").alias("day")
    ).agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n_events"))


def _lagged(spark, d, block=None):
    out = lagged_of(_daily(spark, d), ["total", "n_events"], ["user_id", "month"], ["day"], 3,
                    block=block)
    return rounded(out.select("user_id", "day", "total", "avg_total_3w", "avg_n_events_3w",
                              "lookback_count"), 6, "avg_total_3w", "avg_n_events_3w")


@query(LAGGED)
def lagged_features(spark, d):
    return _lagged(spark, d)


@query(LAGGED)
def lagged_features_hot(spark, d):
    """The same averages with every user cut into weeks."""
    return _lagged(spark, d, F.trunc("day", "week"))


@query(f"WITH {DAILY} SELECT user_id, day, CASE WHEN percent_rank() OVER (ORDER BY day) < 0.70 "
       "THEN 'train' ELSE 'test' END AS split FROM daily")
def temporal_split(spark, d):
    return split_by(_daily(spark, d), "day", 0.70).select("user_id", "day", "split")


@query("SELECT event_id, CASE WHEN percent_rank() OVER (ORDER BY ts) < 0.70 "
       "THEN 'train' ELSE 'test' END AS split FROM events")
def temporal_split_instants(spark, d):
    """Split by microsecond timestamps, where nearly every value is distinct."""
    return split_by(table(spark, d, "events").select("event_id", "ts"), "ts", 0.70).drop("ts")


AVERAGES = ", ".join(f"avg({s}) OVER w AS avg_{s}_3w" for s in STAT_NAMES)
FEATURES = f"""{GOLD_ALL},
lagged AS (SELECT *, {AVERAGES}, count(*) OVER w AS lookback_count FROM gold
  WINDOW w AS (PARTITION BY athlete_id, season ORDER BY game_date, game_id
    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
features AS (SELECT *, fantasy_points_ppr AS target_fantasy_ppr,
    fantasy_points_standard AS target_fantasy_standard,
    CASE WHEN percent_rank() OVER (ORDER BY game_date) < 0.70 THEN 'train' ELSE 'test' END AS split
  FROM lagged WHERE lookback_count = 3 AND fantasy_points_ppr IS NOT NULL)"""
ROUND_AVERAGES = ", ".join(f"round(avg_{s}_3w, 6) AS avg_{s}_3w" for s in STAT_NAMES)


@query(f"WITH {FEATURES} SELECT {CONTEXT}, {ROUND_AVERAGES}, split, "
       "round(target_fantasy_ppr::DOUBLE, 4) AS target_fantasy_ppr, "
       "round(target_fantasy_standard::DOUBLE, 4) AS target_fantasy_standard FROM features")
def feature_dataset(spark, d):
    f = feature_frame(spark, d).drop("created_at")
    f = rounded(f, 6, *[f"avg_{s}_3w" for s in STAT_NAMES])
    return rounded(f, 4, "target_fantasy_ppr", "target_fantasy_standard")


@query(f"WITH {FEATURES} SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') "
       "AS train_rows, count(*) FILTER (split = 'test') AS test_rows, count(target_fantasy_ppr) "
       "FILTER (split = 'train') AS train_with_target, count(target_fantasy_ppr) "
       "FILTER (split = 'test') AS test_with_target, max(week) AS max_week FROM features")
def dataset_check(spark, d):
    return feat.dataset_check(feature_frame(spark, d))


@query(f"WITH {FEATURES} SELECT '2024_w' || lpad(max(week)::VARCHAR, 2, '0') AS data_version, "
       "count(*) AS row_count, count(DISTINCT athlete_id) AS unique_players, "
       f"{len(STAT_NAMES)} AS feature_count FROM features")
def dataset_metadata(spark, d):
    return feat.dataset_metadata(feature_frame(spark, d), 2024)


def _avg_points(names):
    return "coalesce(" + " + ".join(
        f"avg_{n}_3w * {WEIGHTS[n]}::DOUBLE" for n in names) + ", 0)::DECIMAL(18,4)"


PREDICTED = f"""{FEATURES},
predicted AS (SELECT game_id, athlete_id, season, week, game_date, split,
    target_fantasy_ppr AS actual_ppr, {_avg_points(WEIGHTS)} AS predicted_ppr,
    target_fantasy_standard AS actual_standard,
    {_avg_points([n for n in WEIGHTS if n != 'receptions'])} AS predicted_standard
  FROM features)"""


def _predictions(spark, d):
    return feat.predict_baseline(feature_frame(spark, d), "run-1", ntz("2024-02-01"), WEIGHTS)


@query(f"WITH {PREDICTED} SELECT 'run-1' AS run_id, game_id, athlete_id, split, "
       "round(actual_ppr::DOUBLE, 4) AS actual_ppr, "
       "round(predicted_ppr::DOUBLE, 4) AS predicted_ppr, "
       "round(predicted_standard::DOUBLE, 4) AS predicted_standard, "
       "round((predicted_ppr - actual_ppr)::DOUBLE, 4) AS error, "
       "round(abs(predicted_ppr - actual_ppr)::DOUBLE, 4) AS abs_error FROM predicted")
def baseline_predictions(spark, d):
    p = feat.with_errors(_predictions(spark, d))
    cols = ["actual_ppr", "predicted_ppr", "predicted_standard", "error", "abs_error"]
    return rounded(p.select("run_id", "game_id", "athlete_id", "split", *cols), 4, *cols)


def _metric_sql(a, b, c):
    return (f"count(*) AS test_count, round(sqrt(avg(power(y - p, 2))), {a}) AS rmse, "
            f"round(avg(abs(y - p)), {b}) AS mae, round(corr(y, p), {c}) AS corr")


@query(f"WITH {PREDICTED}, t AS (SELECT actual_ppr::DOUBLE AS y, predicted_ppr::DOUBLE AS p "
       f"FROM predicted WHERE split = 'test') SELECT {_metric_sql(2, 2, 3)} FROM t")
def regression_metrics(spark, d):
    p = _predictions(spark, d)
    return metrics_of(p.where(F.col("split") == "test"), "actual_ppr", "predicted_ppr")


@query("WITH t AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p "
       f"FROM lineitem) SELECT l_returnflag, {_metric_sql(4, 4, 4)} FROM t GROUP BY l_returnflag")
def regression_metrics_by_group(spark, d):
    li = table(spark, d, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    return metrics_of(li, "l_extendedprice", "p", ["l_returnflag"], (4, 4, 4))


@query(f"WITH {FEATURES} SELECT athlete_id, game_id, week, (week + 1)::INTEGER AS next_week, "
       "round(avg_pass_yards_3w, 6) AS avg_pass_yards_3w, athlete_name || ' (' || athlete_id "
       "|| ')' AS label FROM features QUALIFY row_number() OVER (PARTITION BY athlete_id "
       "ORDER BY game_date DESC, game_id DESC) = 1")
def latest_features(spark, d):
    f = marts.latest_features(feature_frame(spark, d), 1).withColumn(
        "label", display_label(F.col("athlete_name"), F.col("athlete_id")))
    return rounded(f.select("athlete_id", "game_id", "week", "next_week", "avg_pass_yards_3w",
                            "label"), 6, "avg_pass_yards_3w")


@query(f"WITH {GOLD_ALL}, recent AS (SELECT * FROM gold QUALIFY row_number() OVER ("
       "PARTITION BY athlete_id, season ORDER BY game_date DESC, game_id DESC) <= 3) "
       "SELECT athlete_id, season, (max(week) + 1)::INTEGER AS next_week, "
       + ", ".join(f"round(avg({s}), 6) AS avg_{s}_3w" for s in STAT_NAMES)
       + " FROM recent GROUP BY athlete_id, season HAVING count(*) = 3")
def next_game_features(spark, d):
    return rounded(feat.next_game_features(gold_frame(spark, d), STAT_NAMES), 6,
                   *[f"avg_{s}_3w" for s in STAT_NAMES])


# ---------------------------------------------------------------- marts


def _orders_as_games(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("week"), F.col("o_orderdate").alias("start_date"))


@query("""
SELECT (SELECT count(*) FROM nation) AS n_teams, (SELECT count(*) FROM orders) AS n_games,
  (SELECT count(*) FROM documents) AS n_articles,
  (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_players
""")
def kpis(spark, d):
    players = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("athlete_id"))
    return marts.stage_kpis(table(spark, d, "nation"), table(spark, d, "orders"),
                            table(spark, d, "documents"), players)


@query("SELECT month(o_orderdate)::INTEGER AS week, count(*) AS games FROM orders "
       "WHERE year(o_orderdate) = 1997 GROUP BY 1")
def games_per_week(spark, d):
    return marts.games_per_week(_orders_as_games(spark, d), 1997)


SCORES = """
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l.l_suppkey"""


def _scores(spark, d):
    sides = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"),
        F.when(F.col("l_linestatus") == "O", "home").otherwise("away").alias("home_away"),
        F.col("l_quantity").alias("score"))
    teams = table(spark, d, "supplier").where(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("abbrev"))
    return marts.game_scores(_orders_as_games(spark, d), sides, teams)


@query("SELECT o.o_orderkey AS game_id, year(o.o_orderdate)::INTEGER AS season, "
       "month(o.o_orderdate)::INTEGER AS week, s.s_name AS team, "
       "CASE WHEN l.l_linestatus = 'O' THEN 'home' ELSE 'away' END AS home_away, "
       f"l.l_quantity AS score {SCORES}")
def game_scores(spark, d):
    return _scores(spark, d)


@query("SELECT o.o_orderkey AS game_id, year(o.o_orderdate)::INTEGER AS season, "
       "month(o.o_orderdate)::INTEGER AS week, "
       "max(CASE WHEN l.l_linestatus <> 'O' THEN l.l_quantity END) AS away, "
       f"max(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity END) AS home {SCORES} GROUP BY 1, 2, 3")
def scores_wide(spark, d):
    return marts.scores_wide(_scores(spark, d))


def _history(spark, d):
    gold = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("athlete_id"), F.col("o_orderkey").alias("game_id"),
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"),
        F.col("o_orderdate").alias("game_date"), F.col("o_totalprice").alias("fantasy_points_ppr"),
        F.col("o_totalprice").alias("fantasy_points_standard"))
    return marts.player_history(gold)


@query("SELECT o_custkey::VARCHAR AS athlete_id, round(avg(o_totalprice), 6) AS avg_ppr, "
       "round(stddev_samp(o_totalprice), 6) AS std_ppr, max(o_totalprice) AS max_ppr, "
       "count(*) AS total_games FROM orders WHERE o_totalprice IS NOT NULL GROUP BY o_custkey")
def player_summary(spark, d):
    return rounded(marts.player_summary(_history(spark, d)), 6, "avg_ppr", "std_ppr")


@query("SELECT o_custkey::VARCHAR AS athlete_id, o_orderkey AS game_id, "
       "o_totalprice AS actual_ppr, 'Week ' || month(o_orderdate) || chr(10) || "
       "strftime(o_orderdate, '%m/%d') AS game_label FROM orders QUALIFY row_number() OVER ("
       "PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 4")
def last_n_games(spark, d):
    return marts.last_games(_history(spark, d)).select(
        "athlete_id", "game_id", "actual_ppr", "game_label")


@query("""
SELECT DISTINCT c_custkey::VARCHAR AS athlete_id, c_name AS athlete_name,
  c_name || ' (' || c_custkey || ')' AS label FROM customer WHERE c_name IS NOT NULL
ORDER BY athlete_name, athlete_id LIMIT 500
""")
def player_list(spark, d):
    people = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("athlete_id"), F.col("c_name").alias("athlete_name"))
    return marts.player_list(people, 500)


@query("SELECT DISTINCT year(o_orderdate)::INTEGER AS season FROM orders")
def season_list(spark, d):
    return marts.season_list(_orders_as_games(spark, d))


@query("SELECT DISTINCT month(o_orderdate)::INTEGER AS week FROM orders "
       "WHERE year(o_orderdate) = 1996")
def weeks_of_season(spark, d):
    return marts.weeks_of(_orders_as_games(spark, d), 1996)


@query("""
SELECT l_orderkey AS game_id, l_suppkey::VARCHAR AS athlete_id, 'S' || l_suppkey AS athlete_name,
  l_returnflag AS category, l_linenumber::VARCHAR AS stat_key, l_linestatus AS stat_label,
  l_quantity::BIGINT::VARCHAR AS value_str, l_partkey::VARCHAR AS team_id FROM lineitem
ORDER BY game_id NULLS LAST, athlete_name NULLS LAST, athlete_id, category, stat_key, value_str,
  team_id LIMIT 200
""")
def player_stat_page(spark, d):
    text = {"athlete_id": "l_suppkey", "stat_key": "l_linenumber", "team_id": "l_partkey"}
    stats = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_returnflag").alias("category"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("athlete_name"),
        F.col("l_linestatus").alias("stat_label"),
        F.col("l_quantity").cast("bigint").cast("string").alias("value_str"),
        *[F.col(c).cast("string").alias(n) for n, c in text.items()])
    return marts.player_stat_page(stats)


@query("""
SELECT doc_id AS id, lang AS headline, source, text AS story, (n_chars % 100)::INTEGER AS published
FROM documents WHERE source = 'src7' ORDER BY published DESC NULLS LAST, id LIMIT 20
""")
def articles_of_game(spark, d):
    """Newest articles of one game; a source stands for a game."""
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("headline"),
        (F.col("n_chars") % 100).cast("int").alias("published"), "source",
        F.col("text").alias("story"), F.substring("source", 4, 9).try_cast("int").alias("game_id"))
    return marts.articles_of(docs, 7)


@query("SELECT o_orderkey AS game_id FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5 "
       "ORDER BY 1")
def games_to_pick(spark, d):
    return marts.games_to_pick(_orders_as_games(spark, d), 1997, 5)


SALES = "FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey"


def _sales(spark, d):
    return table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))


@query(f"SELECT c_mktsegment, round(sum(o_totalprice), 2) AS total {SALES} GROUP BY 1")
def segment_sales(spark, d):
    return rounded(marts.segment_totals(_sales(spark, d), "c_mktsegment", "o_totalprice"), 2,
                   "total")


@query("SELECT o_orderpriority, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total, "
       f"round(avg(o_totalprice), 4) AS mean {SALES} GROUP BY 1")
def category_summary(spark, d):
    out = marts.category_summary(_sales(spark, d), "o_orderpriority", "o_totalprice")
    return rounded(rounded(out, 2, "total"), 4, "mean")
