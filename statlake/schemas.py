"""Schemas, keys and defaults of the lake tables and of the landed documents.

Fixed values: table, column and key names and the types below are the data
model that readers of the lake rely on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

LINEAGE = "ingest_timestamp timestamp_ntz, source_path string, run_id string"


@dataclass(frozen=True)
class Table:
    """A lake table: DDL, key columns, defaults and (optional) block partitioning.

    ``block_by`` is an integer SQL expression over key columns; rows are stored in
    directories of ``block_size`` consecutive values. The directory follows from
    the key alone, so an upsert rewrites only the blocks its rows fall into. ``partition_by``
    names plain directory columns (raw tables keep one directory per run).
    """

    layer: str
    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    block_by: str | None = None
    block_size: int = 1000
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _raw(name: str, ddl: str) -> Table:
    return Table("raw", name, f"{ddl}, {LINEAGE}", partition_by=("run_id",))


def _stage(name: str, ddl: str, keys: tuple[str, ...], block_by: str | None = None,
           block_size: int = 1000) -> Table:
    return Table("stage", name, f"{ddl}, {LINEAGE}", keys, block_by=block_by,
                 block_size=block_size)


# Article ids are sparse, so a block spans more of them.
ARTICLE_BLOCK = 100_000

# The 25 statistics of the player-game fact, in column order.
STAT_COLUMNS = [
    "pass_completions", "pass_attempts", "pass_yards", "pass_touchdowns", "interceptions",
    "sacks", "qb_rating", "rush_attempts", "rush_yards", "rush_touchdowns", "receptions",
    "receiving_targets", "receiving_yards", "receiving_touchdowns", "fumbles", "fumbles_lost",
    "field_goals_made", "field_goal_attempts", "extra_points_made", "extra_point_attempts",
    "total_tackles", "sacks_def", "interceptions_def", "fumbles_recovered",
    "defensive_touchdowns",
]

_VENUES = "id int, fullname string, city string, state string, country string, indoor boolean"
_GAMES = "id int, start_date timestamp_ntz, season int, week int, venue_id int, attendance int"
_TEAMS = (
    "id int, name string, abbrev string, display_name string, short_name string, "
    "color string, alternate_color string, venue_id int, logo string"
)
_GAME_TEAM = "game_id int, team_id int, home_away string, score int"
_ARTICLES = (
    "id int, headline string, published timestamp_ntz, source string, story string, game_id int"
)

RAW_TABLES = [
    _raw("venues", _VENUES),
    _raw("games", _GAMES),
    _raw("teams", _TEAMS),
    _raw("game_team", _GAME_TEAM),
    _raw("articles", _ARTICLES),
    _raw("article_images", "type string, name string, caption string, height int, width int, "
                           "url string, game_id int, article_id int"),
    _raw("team_stats", "name string, display_value string, value string, label string, "
                       "team_id string, team_abbr string, home_away string, game_id int"),
    _raw("player_stats", "game_id int, team_id string, team_abbr string, athlete_id string, "
                         "athlete_name string, category string, stat_key string, "
                         "stat_label string, value_str string"),
    _raw("drives", "game_id int, drive_id string, team_id string, team_abbr string, "
                   "description string, result string, display_result string, "
                   "short_result string, yards int, offensive_plays int, is_score boolean, "
                   "start_period int, start_clock string, start_spot string, end_period int, "
                   "end_clock string, end_spot string, time_elapsed string"),
    _raw("plays", "game_id int, drive_id string, sequence int, play_id string, period int, "
                  "clock string, text string, stat_yardage int, scoring_play boolean, "
                  "start_spot string, end_spot string, home_score int, away_score int, "
                  "wallclock string, type_id string, type_text string"),
]

STAGE_TABLES = [
    _stage("dim_teams", _TEAMS, ("id",)),
    _stage("dim_venues", _VENUES, ("id",)),
    _stage("dim_games", _GAMES, ("id",)),
    _stage("fact_game_team", _GAME_TEAM, ("game_id", "team_id")),
    _stage("dim_articles", _ARTICLES, ("id",), "id", ARTICLE_BLOCK),
    _stage("dim_article_images", "article_id int, url string, game_id int, caption string, "
                                 "height int, width int", ("article_id", "url"),
           "article_id", ARTICLE_BLOCK),
    _stage("fact_team_stats", "game_id int, team_id string, team_abbr string, home_away string, "
                              "category string, display_value string, value string, "
                              "label string", ("game_id", "team_id", "category"), "game_id"),
    _stage("fact_player_stats", "game_id int, athlete_id string, athlete_name string, "
                                "team_id string, category string, stat_key string, "
                                "stat_label string, value_str string",
           ("game_id", "athlete_id", "stat_key"), "game_id"),
    Table("stage", "article_embeddings", "article_id int, processed_at timestamp_ntz",
          ("article_id",), block_by="article_id", block_size=ARTICLE_BLOCK),
    Table("stage", "article_image_embeddings",
          "article_id int, image_url string, processed_at timestamp_ntz",
          ("article_id", "image_url")),
]

# raw table -> (stage table, columns renamed on the way)
STAGE_LOADS = {
    "teams": ("dim_teams", {}),
    "venues": ("dim_venues", {}),
    "games": ("dim_games", {}),
    "game_team": ("fact_game_team", {}),
    "articles": ("dim_articles", {}),
    "article_images": ("dim_article_images", {}),
    "team_stats": ("fact_team_stats", {"name": "category"}),
    "player_stats": ("fact_player_stats", {}),
}

PLAYER_GAME = Table(
    "gold", "player_game_stats",
    "game_id int, athlete_id string, athlete_name string, team_id int, team_abbrev string, "
    "season int, week int, game_date timestamp_ntz, is_home boolean, opponent_team_id int, "
    "opponent_abbrev string, "
    + ", ".join(f"{c} decimal(10,2)" for c in STAT_COLUMNS)
    + ", fantasy_points_ppr decimal(18,4), fantasy_points_standard decimal(18,4), "
      "loaded_at timestamp_ntz",
    ("athlete_id", "season", "week", "game_id"),
    defaults={c: 0 for c in STAT_COLUMNS}
    | {"fantasy_points_ppr": 0, "fantasy_points_standard": 0},
    block_by="game_id",
)

FEATURES = Table(
    "ai_datasets", "player_fantasy_features",
    "game_id int, athlete_id string, athlete_name string, team_id int, team_abbrev string, "
    "season int, week int, game_date timestamp_ntz, is_home boolean, opponent_team_id int, "
    "opponent_abbrev string, "
    + ", ".join(f"avg_{c}_3w double" for c in STAT_COLUMNS)
    + ", target_fantasy_ppr decimal(18,4), target_fantasy_standard decimal(18,4), "
      "split string, created_at timestamp_ntz",
    ("athlete_id", "season", "week", "game_id"),
)

PREDICTIONS = Table(
    "model_outputs", "predictions_fantasy",
    "run_id string, game_id int, athlete_id string, athlete_name string, season int, week int, "
    "game_date timestamp_ntz, split string, actual_ppr decimal(18,4), "
    "predicted_ppr decimal(18,4), actual_standard decimal(18,4), "
    "predicted_standard decimal(18,4), created_at timestamp_ntz",
    ("run_id", "season", "game_id", "athlete_id"),
    partition_by=("run_id",),
)

REGISTRY_TABLES = [
    Table("mlops", "model", "model_id string, name string, business_problem string, "
                            "ticket_number string, owner string, created_at timestamp_ntz",
          ("model_id",)),
    Table("mlops", "dataset", "dataset_id string, model_id string, data_version string, "
                              "location string, row_count int, feature_count int, "
                              "created_at timestamp_ntz", ("dataset_id",)),
    Table("mlops", "training_run", "run_id string, model_id string, dataset_id string, "
                                   "params string, metrics string, artifact string, "
                                   "status string, created_at timestamp_ntz", ("run_id",)),
    Table("mlops", "model_version", "model_version_id string, model_id string, "
                                    "training_run_id string, artifact_path string, "
                                    "metrics_json string, status string, "
                                    "created_at timestamp_ntz", ("model_version_id",)),
    Table("mlops", "deployment", "deployment_id string, model_version_id string, "
                                 "endpoint_url string, traffic_split float, "
                                 "deployed_at timestamp_ntz", ("deployment_id",)),
]

# One row for each batch of a stream that went through all its tables.
COMMITS = Table("mlops", "stream_commit", "stream string, batch_id bigint, run_id string, "
                                          "committed_at timestamp_ntz", ("stream", "batch_id"))

# child table, child column, parent table, parent column
REGISTRY_REFERENCES = [
    ("dataset", "model_id", "model", "model_id"),
    ("training_run", "model_id", "model", "model_id"),
    ("training_run", "dataset_id", "dataset", "dataset_id"),
    ("model_version", "model_id", "model", "model_id"),
    ("model_version", "training_run_id", "training_run", "run_id"),
    ("deployment", "model_version_id", "model_version", "model_version_id"),
]

VECTORS = Table(
    "vectors", "article_chunks",
    "id string, values array<float>, metadata struct<published:timestamp_ntz, chunk_index:int, "
    "article_id:int, chunk_text:string, headline:string, story:string>",
    ("id",),
    # A chunk id is <article>_<n>.
    block_by="try_cast(split_part(id, '_', 1) AS bigint)",
    block_size=ARTICLE_BLOCK,
)

ALL_TABLES = [
    *RAW_TABLES, *STAGE_TABLES, PLAYER_GAME, FEATURES, PREDICTIONS, *REGISTRY_TABLES, COMMITS,
    VECTORS,
]
TABLES = {(t.layer, t.name): t for t in ALL_TABLES}

# ---------------------------------------------------------------- documents

# DDL text: ``DataFrameReader.schema`` accepts it as is.
SCOREBOARD_DOC = """
events array<struct<
  id:string, date:string, season:struct<year:int>, week:struct<number:int>,
  competitions:array<struct<
    attendance:int,
    venue:struct<id:string, fullName:string, indoor:boolean,
      address:struct<city:string, state:string, country:string>>,
    competitors:array<struct<id:string, homeAway:string, score:string,
      team:struct<name:string, abbreviation:string, displayName:string,
        shortDisplayName:string, color:string, alternateColor:string, logo:string,
        venue:struct<id:string>>>>>>>>
"""

_SPOT = (
    "struct<period:struct<number:int>, clock:struct<displayValue:string>, "
    "possessionText:string, downDistanceText:string, text:string>"
)

GAME_DOC = f"""
header struct<season:struct<year:int>, week:int>,
article struct<id:int, headline:string, published:string, source:string, story:string,
  images:array<struct<type:string, name:string, caption:string, height:int, width:int,
    url:string>>>,
boxscore struct<
  teams:array<struct<homeAway:string, team:struct<id:string, abbreviation:string>,
    statistics:array<struct<name:string, displayValue:string, value:string, label:string>>>>,
  players:array<struct<team:struct<id:string, abbreviation:string>,
    statistics:array<struct<name:string, keys:array<string>, labels:array<string>,
      athletes:array<struct<athlete:struct<id:string, displayName:string>,
        stats:array<string>>>>>>>>,
drives struct<previous:array<struct<id:string, team:struct<id:string, abbreviation:string>,
  description:string, result:string, displayResult:string, shortDisplayResult:string,
  yards:int, offensivePlays:int, isScore:boolean, start:{_SPOT}, `end`:{_SPOT},
  timeElapsed:string,
  plays:array<struct<id:string, sequenceNumber:string, type:struct<id:string, text:string>,
    text:string, awayScore:int, homeScore:int, period:struct<number:int>,
    clock:struct<displayValue:string>, scoringPlay:boolean, wallclock:string,
    statYardage:int, start:{_SPOT}, `end`:{_SPOT}>>>>>
"""

EVAL_SET = "question string, article_id int, n_chunks int"

# Columns used from the sales sheet and their names here.
ORDERS_COLUMNS = {
    "Customer Segment": "customer_segment", "Product Category": "product_category",
    "Sales": "sales",
}
