"""The whole chain on small documents: raw, stage, gold, features, registry, articles."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import docs
from statlake.functions.metrics import regression_metrics
from statlake.plans import daily, features, ml, registry, retrieval
from statlake.plans.gold import gold_incremental
from statlake.sources import files
from statlake.sources.lake import Lake
from statlake.streaming.ingest import chain_stream, compact, current_rows, ingest_stream, upsert_stream

AT = dt.datetime(2025, 10, 1, 10)


def _land(root, weeks, restate=None):
    """One scoreboard and one game document per week; two teams, two players."""
    for week in weeks:
        day = dt.date(2025, 9, 7) + dt.timedelta(days=7 * (week - 1))
        score = "99" if restate == week else str(20 + week)
        docs.write(root / "boards" / f"day={day:%Y%m%d}" / "data.json", docs.scoreboard(docs.event(
            100 + week, f"{day}T17:00Z", week,
            [docs.team("1", "Alphas", "home", score), docs.team("2", "Betas", "away", "17")])))
        yards = str(200 + 10 * week)
        docs.write(root / "games" / f"game_id={100 + week}" / "data.json", docs.game(week, blocks=[
            docs.players("1", "AL", ("passing", docs.PASSING, ["a"] * 6,
                                     [("11", "Pat", ["21/30", yards, "2", "1", "2-14", "99.5"])])),
            docs.players("2", "BE", ("receiving", docs.RECEIVING, ["a"] * 3,
                                     [("21", "Rex", [str(week), "--", "1"])]))]))


def _run(spark, lake, root, run_id, at=AT):
    daily.run_daily(lake, files.read_scoreboards(spark, f"{root}/boards"),
                    files.read_game_details(spark, f"{root}/games"), run_id, at)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("day1")
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    _land(root, range(1, 6))
    _run(spark, lake, root, "r1")
    daily.rebuild_features(lake, AT)
    return lake


def test_gold_rows(built):
    rows = {(r.athlete_id, r.week): r for r in built.read("gold", "player_game_stats").collect()}
    assert len(rows) == 10
    pat = rows["11", 2]
    assert (pat.team_abbrev, pat.opponent_abbrev, pat.is_home) == ("AL", "BE", True)
    assert (pat.pass_completions, pat.pass_attempts, pat.sacks) == (21, 30, 2)
    # 220 * 0.04 + 2 * 4 - 1 * 2
    assert pat.fantasy_points_ppr == Decimal("14.8000") == pat.fantasy_points_standard
    rex = rows["21", 3]
    assert rex.receiving_yards == 0  # "--"
    assert (rex.fantasy_points_ppr, rex.fantasy_points_standard) == (9, 6)


def test_features(built):
    rows = {(r.athlete_id, r.week): r
            for r in built.read("ai_datasets", "player_fantasy_features").collect()}
    assert set(rows) == {(a, w) for a in ("11", "21") for w in (4, 5)}
    assert rows["11", 4].avg_pass_yards_3w == 220.0
    assert {rows["11", 4].split, rows["11", 5].split} == {"train"} or rows["11", 5].split == "train"
    meta = features.dataset_metadata(built.read("ai_datasets", "player_fantasy_features")).first()
    assert (meta.data_version, meta.row_count, meta.unique_players, meta.feature_count) == (
        "2025_w05", 4, 2, 25)


def test_repeat_and_restate(spark, tmp_path):
    root, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    _land(root, [1, 2])
    _run(spark, lake, root, "r1")
    _run(spark, lake, root, "r1")
    assert lake.read("raw", "games").count() == 2
    assert lake.read("gold", "player_game_stats").count() == 4
    again = tmp_path / "again"
    _land(again, [2, 3], restate=2)
    _run(spark, lake, again, "r2", AT + dt.timedelta(days=1))
    scores = {(r.game_id, r.team_id): r.score for r in lake.read("stage", "fact_game_team").collect()}
    assert scores[102, 1] == 99 and scores[101, 1] == 21 and len(scores) == 6
    assert lake.read("raw", "games").count() == 4
    loaded = {r.week: r.loaded_at for r in lake.read("gold", "player_game_stats").collect()}
    assert loaded[2] == AT and loaded[3] == AT + dt.timedelta(days=1)  # insert only
    daily.refresh_gold(lake, AT + dt.timedelta(days=2), "r2")
    loaded = {r.week: r.loaded_at.day for r in lake.read("gold", "player_game_stats").collect()}
    assert loaded == {1: 1, 2: 3, 3: 3}


def test_stream_equals_batch(spark, tmp_path):
    root = tmp_path / "in"
    _land(root, [1, 2, 3])
    batch, stream = Lake(spark, str(tmp_path / "b")), Lake(spark, str(tmp_path / "s"))
    daily.load_raw(batch, files.read_scoreboards(spark, f"{root}/boards"),
                   daily.SCOREBOARD_ROWS, "r1", AT)
    daily.load_stage(batch)
    for _ in range(2):  # the second run finds no new file
        ingest_stream(spark, f"{root}/boards", stream, "scoreboard", str(tmp_path / "c"), AT,
                      max_files=1).awaitTermination()
    for name in ("dim_games", "dim_teams", "fact_game_team", "dim_venues"):
        a, b = (sorted(map(repr, lake.read("stage", name).drop("run_id").collect()))
                for lake in (batch, stream))
        assert a == b and a
    assert stream.read("raw", "games").select("run_id").distinct().count() == 3


def test_stream_chain_equals_batch_chain(spark, tmp_path):
    """Games first, then their schedules, in batches; a repeated batch and a lost one change nothing."""
    root = tmp_path / "in"
    _land(root, [1, 2, 3])
    batch, stream = Lake(spark, str(tmp_path / "b")), Lake(spark, str(tmp_path / "s"))
    lengths = lambda text: F.array(F.length(text).cast("float"), F.lit(1.0).cast("float"))
    daily.run_daily(batch, files.read_scoreboards(spark, f"{root}/boards"),
                    files.read_game_details(spark, f"{root}/games"), "r1", AT, embedder=lengths)

    def run(kind, folder):
        chain_stream(spark, f"{root}/{folder}", stream, kind, str(tmp_path / kind), AT, max_files=2,
                     embedder=lengths).awaitTermination()

    def same():
        for name in (("gold", "player_game_stats"), ("vectors", "article_chunks"), ("stage", "fact_player_stats"),
                     ("stage", "dim_games"), ("stage", "article_embeddings")):
            a, b = (sorted(map(repr, x.read(*name).drop("run_id").collect())) for x in (batch, stream))
            assert a == b and a, name

    run("game", "games")
    assert stream.read("gold", "player_game_stats").isEmpty()  # no schedule yet
    run("scoreboard", "boards")
    same()
    commits = {(r.stream, r.batch_id) for r in stream.read("mlops", "stream_commit").collect()}
    assert commits == {("game", 0), ("game", 1), ("scoreboard", 0), ("scoreboard", 1)}
    # A batch whose commit row is missing runs again and leaves everything as it was.
    stream.replace(stream.read("mlops", "stream_commit").where("stream = 'game'"), "mlops", "stream_commit")
    chain_stream(spark, f"{root}/boards", stream, "scoreboard", str(tmp_path / "again"), AT, max_files=2,
                 embedder=lengths).awaitTermination()
    same()


def test_chain_to_a_deployed_version(spark, tmp_path):
    root, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    _land(root, range(1, 9))
    for _ in range(2):
        daily.run_chain(lake, files.read_scoreboards(spark, f"{root}/boards"),
                        files.read_game_details(spark, f"{root}/games"), "r1", AT)
    registry.check_references(lake)
    run = lake.read("mlops", "training_run").collect()
    version = lake.read("mlops", "model_version").first()
    assert [r.run_id for r in run] == ["r1"] and version.training_run_id == "r1" and version.status == "approved"
    assert [r.traffic_split for r in lake.read("mlops", "deployment").collect()] == [1.0]
    feats = lake.read("ai_datasets", "player_fantasy_features").count()
    assert lake.read("model_outputs", "predictions_fantasy").count() == feats > 0


def test_upsert_stream_with_late_rows(spark, tmp_path):
    schema = "k int, at int, v string"
    loads = [[(1, 5, "new"), (2, 1, "a")], [(1, 3, "late"), (2, 2, "b")], [(3, 1, "c")]]
    for i, load in enumerate(loads):
        spark.createDataFrame(load, schema).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/land")
        upsert_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/land"), ["k"], ["at"],
                      f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = {r.k: r.v for r in current_rows(spark, f"{tmp_path}/out", ["k"], ["at"]).collect()}
    assert got == {1: "new", 2: "b", 3: "c"}
    compact(spark, f"{tmp_path}/out", ["k"], ["at"], f"{tmp_path}/small")
    assert current_rows(spark, f"{tmp_path}/small", ["k"], ["at"]).count() == 3


def test_name_variant_duplicates_a_row(spark):
    """The base keeps name variants apart while the pivot is per game and athlete."""
    facts = spark.createDataFrame(
        [(1, "11", "Pat", "1", "passing", "passingYards", "100"),
         (1, "11", "Patrick", "1", "passing", "passingTouchdowns", "2"),
         (1, "12", "Gone", "7", "passing", "passingYards", "5")],
        "game_id int, athlete_id string, athlete_name string, team_id string, category string, "
        "stat_key string, value_str string")
    games = spark.createDataFrame([(1, AT, 2025, 1)], "id int, start_date timestamp_ntz, season int, week int")
    bridge = spark.createDataFrame([(1, 1, "home"), (1, 2, "away"), (1, 3, "x")],
                                   "game_id int, team_id int, home_away string")
    teams = spark.createDataFrame([(1, "AA"), (3, "CC")], "id int, abbrev string")
    gold = spark.createDataFrame([], "game_id int, athlete_id string")
    rows = gold_incremental(facts, games, bridge, teams, gold, F.lit(str(AT))).collect()
    assert {(r.athlete_name, r.pass_yards, r.pass_touchdowns) for r in rows} == {
        ("Pat", 100, 2), ("Patrick", 100, 2)}  # team 7 is not in the bridge
    assert {r.opponent_team_id for r in rows} == {3}  # team 2 has no name


def test_registry_flow(spark, built):
    lake, model = built, "model-x"
    registry.register_model(lake, model, "n", "b", "t", "o", AT)
    registry.register_model(lake, model, "other", "b", "t", "o", AT)
    assert [r.name for r in lake.read("mlops", "model").collect()] == ["n"]
    feats = lake.read("ai_datasets", "player_fantasy_features")
    meta = features.dataset_metadata(feats)
    for _ in range(2):
        registry.register_dataset(lake, model, meta, "table", AT)
    assert lake.read("mlops", "dataset").count() == 1
    lake.append(features.predict_baseline(feats, "run-1", F.lit(str(AT))),
                "model_outputs", "predictions_fantasy")
    metrics = regression_metrics(ml.predict_from_table(lake, "run-1"), "actual_ppr",
                                 "predicted_ppr")
    assert metrics.first().test_count == 4
    ds = lake.read("mlops", "dataset").first().dataset_id

    def run(run_id, mae):
        registry.register_run(lake, run_id, model, ds, {"algorithm": "a"}, metrics.withColumn(
            "mae", F.lit(mae).cast("double")), registry.artifact_ref("t", run_id), AT)

    run("run-null", None)
    run("run-1", 2.5)
    registry.register_best_version(lake, model, ds, "v1", AT)
    run("run-2", 3.0)
    registry.register_best_version(lake, model, ds, "v2", AT + dt.timedelta(days=1))
    run("run-3", 0.0)
    registry.register_best_version(lake, model, ds, "v3", AT + dt.timedelta(days=2))
    status = {r.model_version_id: (r.training_run_id, r.status)
              for r in lake.read("mlops", "model_version").collect()}
    assert status == {"v1": ("run-1", "approved"), "v2": ("run-1", "candidate"),
                      "v3": ("run-3", "approved")}
    for i, v in enumerate(("v1", "v2", "v3")):
        registry.deploy_version(lake, v, f"d{i}", "url", AT + dt.timedelta(days=i))
    traffic = {r.model_version_id: r.traffic_split for r in lake.read("mlops", "deployment").collect()}
    assert traffic == {"v1": 0.0, "v3": 1.0}  # a candidate is not deployed
    active = registry.active_deployment(lake.read("mlops", "deployment"),
                                        lake.read("mlops", "model_version"), model).first()
    assert active.model_version_id == "v3"
    registry.check_references(lake)
    # run-3 keeps no rows in the table; a saved model and another run do.
    assert ml.predict_active(lake, model).isEmpty()
    with pytest.raises(LookupError):
        ml.predict_active(lake, "model-unknown")
    path = f"{lake.root}/models/m"
    ml.save_model(ml.train(feats, "linear_regression"), path)
    for version, artifact in (("v4", path), ("v5", registry.artifact_ref("t", "run-1"))):
        lake.append(lake.read("mlops", "model_version").where("model_version_id = 'v3'").withColumns({
            "model_version_id": F.lit(version), "artifact_path": F.lit(artifact)}),
            "mlops", "model_version")
        registry.deploy_version(lake, version, f"d-{version}", "url", AT + dt.timedelta(days=9))
        served = ml.predict_active(lake, model, athlete_id="11").collect()
        assert {(r.model_version_id, r.week) for r in served} == {(version, 4), (version, 5)}


def test_articles_are_embedded_once(spark, built):
    stories = built.read("stage", "dim_articles")
    model = retrieval.fit_embedder(retrieval.chunk_articles(stories), "chunk_text", 32)
    retrieval.embed_new(built, model, F.lit(str(AT)))
    first = built.read("vectors", "article_chunks").collect()
    assert {r.id for r in first} == {f"{700 + w}_0" for w in range(1, 6)}
    assert {r.id: r.metadata.chunk_text for r in first}["703_0"] == "Home wins week 3."
    retrieval.embed_new(built, model, F.lit(str(AT + dt.timedelta(days=1))))
    marks = built.read("stage", "article_embeddings").collect()
    assert {r.processed_at for r in marks} == {AT} and len(marks) == 5
    ask = retrieval.embed(spark.createDataFrame([(1, "what happened in week 3")], "query_id int, chunk_text string"),
                          "chunk_text", model)
    hits = retrieval.retrieve(ask, built.read("vectors", "article_chunks"), 3)
    shaped = retrieval.assemble_context(retrieval.shape_contexts(hits)).first()
    assert shaped.articles[0] == 703 and len(shaped.articles) == len(shaped.contexts) <= 3
    scores, summary = retrieval.evaluate(
        hits, spark.createDataFrame([(1, 703, 1)], "query_id int, article_id int, n_chunks int"), "e")
    assert scores.first().mrr == 1.0 and summary.first().n_examples == 1
    known = spark.createDataFrame([("q", 1, 2)], "question string, article_id int, n_chunks int")
    more = spark.createDataFrame([("q", 9, 9), ("p", 3, 1)], known.schema)
    assert {(r.question, r.article_id) for r in retrieval.register_eval_set(known, more).collect()
            } == {("q", 1), ("p", 3)}
