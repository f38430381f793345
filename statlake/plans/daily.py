"""The daily chain: landed documents -> raw -> stage -> gold; features on demand."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from statlake.functions.metrics import regression_metrics
from statlake.operators.checks import assert_empty, key_violations, require_key
from statlake.operators.flatten import GAME_ROWS, SCOREBOARD_ROWS, with_lineage
from statlake.operators.merge import conform
from statlake.operators.rows import if_not_empty, latest_per_key
from statlake.plans import registry
from statlake.plans.features import build_features, dataset_metadata, predict_baseline
from statlake.plans.gold import gold_incremental
from statlake.plans.retrieval import embed_new
from statlake.schemas import PLAYER_GAME, STAGE_LOADS, TABLES
from statlake.session import scratch_dir
from statlake.sources.lake import Lake


def _at_once(load, names, threads: int = 4) -> None:
    """Load independent tables side by side; one alone rarely fills a cluster."""
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(load, names))


def load_raw(lake: Lake, documents: DataFrame, rows: dict, run_id: str, at: datetime) -> None:
    """Flatten documents into their raw tables under one run id (repeatable).

    JSON is parsed once: the documents are written as nested Parquet, from which
    every table reads only the fields it needs.
    """
    at_path = scratch_dir(lake.spark, "documents")
    with_lineage(documents, run_id, F.lit(str(at))).write.parquet(at_path)
    parsed = lake.spark.read.parquet(at_path)
    _at_once(lambda name: lake.replace_run(rows[name](parsed), "raw", name, run_id), rows)
    lake.discard(at_path)


def to_stage(raw: DataFrame, raw_name: str, keys: list[str] | None = None) -> DataFrame:
    """Newest ingested row per stage key (or other ``keys``), in the stage table's shape."""
    stage_name, renames = STAGE_LOADS[raw_name]
    table = TABLES["stage", stage_name]
    renamed = raw.withColumnsRenamed(renames)
    # An event without a venue, say, yields a row without a key; the table takes none.
    keyed = require_key(renamed, list(keys or table.keys))
    newest = latest_per_key(keyed, list(keys or table.keys), ["ingest_timestamp"],
                            ties=["run_id", "source_path"])
    return conform(newest, table.schema)


def load_stage(lake: Lake, run_id: str | None = None) -> None:
    """Upsert the raw rows of one run (or of all runs) into every stage table."""
    def load(raw_name: str) -> None:
        raw = lake.read("raw", raw_name)
        if run_id is not None:
            raw = raw.where(F.col("run_id") == run_id)
        if_not_empty(raw, lambda df: lake.upsert(
            to_stage(df, raw_name), "stage", STAGE_LOADS[raw_name][0]))

    _at_once(load, STAGE_LOADS)


def games_of_run(lake: Lake, run_id: str) -> DataFrame:
    """The games a run brought player statistics or a schedule for."""
    def of(name: str, column: str) -> DataFrame:
        rows = lake.read("raw", name).where(F.col("run_id") == run_id)
        return rows.select(F.col(column).cast("int").alias("game_id"))

    return of("player_stats", "game_id").unionByName(of("games", "id")).where("game_id is not null").distinct()


def _gold_rows(lake: Lake, at: datetime, run_id: str | None, known: bool) -> DataFrame:
    """Gold rows from stage; ``known`` leaves out what gold already holds."""
    facts, gold, games = ("stage", "fact_player_stats"), ("gold", "player_game_stats"), None
    if run_id is None:
        read = lake.read
    else:
        games = games_of_run(lake, run_id)

        def read(layer, name):
            return lake.read_near(layer, name, games)

    held = read(*gold)
    return gold_incremental(
        read(*facts), lake.read("stage", "dim_games"), lake.read("stage", "fact_game_team"),
        lake.read("stage", "dim_teams"), held if known else held.where(F.lit(False)),
        F.lit(str(at)), games)


def load_gold(lake: Lake, at: datetime, run_id: str | None = None) -> None:
    """Append the unseen player-games, once their key is checked.

    With a run id only the blocks of that run's games are read, on both sides. The rows
    are put aside and checked before gold is touched: none of them is in gold, so their
    own keys are all there is to check.
    """
    folder = scratch_dir(lake.spark, "gold")
    rows = _gold_rows(lake, at, run_id, known=True)
    rows.write.parquet(folder)
    rows = lake.spark.read.schema(rows.schema).parquet(folder)
    assert_empty(key_violations(rows, list(PLAYER_GAME.keys)), "duplicate gold key")
    lake.append(rows, "gold", "player_game_stats")


def refresh_gold(lake: Lake, at: datetime, run_id: str | None = None) -> None:
    """Optional correction: rebuild the games of a run and replace their gold rows."""
    lake.upsert(_gold_rows(lake, at, run_id, known=False), "gold", "player_game_stats")


def rebuild_features(lake: Lake, at: datetime) -> None:
    """Replace the feature table from the stored gold fact."""
    if_not_empty(lake.read("gold", "player_game_stats"), lambda gold: lake.replace(
        build_features(gold, F.lit(str(at))), "ai_datasets", "player_fantasy_features"))


def run_daily(lake: Lake, scoreboards: DataFrame, game_details: DataFrame, run_id: str,
              at: datetime, embedder=None) -> None:
    """One day, layer by layer; every step can be repeated with the same run id.

    With an embedder the articles of the day become chunks and vectors as well.
    """
    load_raw(lake, scoreboards, SCOREBOARD_ROWS, run_id, at)
    load_raw(lake, game_details, GAME_ROWS, run_id, at)
    load_stage(lake, run_id)
    load_gold(lake, at, run_id)
    if embedder is not None:
        embed_new(lake, embedder, F.lit(str(at)))


def run_chain(lake: Lake, scoreboards: DataFrame, game_details: DataFrame, run_id: str, at: datetime,
              embedder=None, model_id: str = "player-fantasy-points") -> None:
    """From landed documents to a deployed version: the day, features, predictions, registry.

    The predictions are those of the weighted averages, kept as rows of the run; the run is
    registered with their test metrics, the best run of the dataset becomes a version, and an
    approved version is deployed. Running again with the same id changes nothing.
    """
    run_daily(lake, scoreboards, game_details, run_id, at, embedder)
    rebuild_features(lake, at)
    feats = lake.read("ai_datasets", "player_fantasy_features")
    if feats.isEmpty():
        return
    now = F.lit(str(at))
    lake.replace_run(predict_baseline(feats, run_id, now), "model_outputs", "predictions_fantasy", run_id)
    registry.register_model(lake, model_id, "fantasy points", "points of the next game", "-", "statlake", at)
    meta = dataset_metadata(feats)
    dataset = f"ds-player-fantasy-{meta.first().data_version}"
    registry.register_dataset(lake, model_id, meta, "ai_datasets.player_fantasy_features", at)
    predictions = lake.read("model_outputs", "predictions_fantasy").where(F.col("run_id") == run_id)
    metrics = regression_metrics(predictions.where(F.col("split") == "test"), "actual_ppr", "predicted_ppr")
    registry.register_run(lake, run_id, model_id, dataset, {"algorithm": "weighted_average"}, metrics,
                          registry.artifact_ref("model_outputs.predictions_fantasy", run_id), at)
    version = f"{model_id}-{run_id}"
    registry.register_best_version(lake, model_id, dataset, version, at)
    registry.deploy_version(lake, version, f"deploy-{version}", "local", at)
