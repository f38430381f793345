import datetime as dt

import pytest
from pyspark.sql import functions as F

import docs
from statlake.operators import flatten
from statlake.sources import files

AT = "2025-09-09 10:00:00"


@pytest.fixture(scope="module")
def boards(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("boards")
    home, away = docs.team("1", "Alphas", "home", "21"), docs.team("2", "Betas", "away", "17")
    docs.write(root / "a" / "data.json", docs.scoreboard(
        docs.event(100, "2025-09-07T17:00Z", 1, [home, away]),
        docs.event(101, "2025-09-07T20:00+02:00", 2, [home, docs.team(None, "Gammas", "away", "3")],
                   state=None)))
    docs.write(root / "b" / "data.json", docs.scoreboard())
    return flatten.with_lineage(files.read_scoreboards(spark, str(root / "*")), "r1", F.lit(AT))


def test_games_one_row_per_event_with_utc_time(boards):
    rows = {r.id: r for r in flatten.flatten_games(boards).collect()}
    assert set(rows) == {100, 101}
    assert rows[100].start_date == dt.datetime(2025, 9, 7, 17)
    assert rows[101].start_date == dt.datetime(2025, 9, 7, 18)
    assert (rows[101].season, rows[101].week, rows[101].venue_id) == (2025, 2, 9)
    assert rows[100].run_id == "r1" and rows[100].source_path.startswith("file:")
    assert rows[100].ingest_timestamp == dt.datetime(2025, 9, 9, 10)


def test_missing_state_is_null(boards):
    assert {r.state for r in flatten.flatten_venues(boards).collect()} == {"MA", None}


def test_competitor_without_id_is_dropped(boards):
    assert sorted(r.id for r in flatten.flatten_teams(boards).collect()) == [1, 1, 2]
    bridge = flatten.flatten_game_team(boards).collect()
    assert sorted((r.game_id, r.team_id, r.score) for r in bridge) == [
        (100, 1, 21), (100, 2, 17), (101, 1, 21)]
    names = {r.abbrev: r.display_name for r in flatten.flatten_teams(boards).collect()}
    assert names["AL"] == "The Alphas"


@pytest.fixture(scope="module")
def games(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("games")
    drive = {"id": "d1", "team": {"id": "1", "abbreviation": "AA"}, "description": "5 plays",
             "result": "TD", "yards": 75, "offensivePlays": 5, "isScore": True,
             "start": {**docs.SPOT, "possessionText": "", "text": "AA 25"}, "end": docs.SPOT,
             "timeElapsed": {"displayValue": "3:00"},
             "plays": [{"id": "p1", "sequenceNumber": "100", "type": {"id": "5", "text": "Rush"},
                        "statYardage": 4, "scoringPlay": False, "text": "run", "homeScore": 0,
                        "awayScore": 0, "start": {"downDistanceText": "1st & 10", "text": "x"}}]}
    second = {**drive, "id": "d2", "plays": [{"id": "p2", "sequenceNumber": "bad"}]}
    blocks = [
        docs.players("1", "AA",
                     ("passing", docs.PASSING, ["C/ATT", "YDS", "TD", "INT", "SACKS", "RTG"],
                      [("11", "Pat", ["21/30", "250", "2", "1", "2-14", "101.5"]),
                       ("12", "Sub", ["0/1", "0"])]),
                     ("rushing", ["rushingYards"], None, [("13", "Run", ["40"])])),
        docs.players("2", "BB", ("kicking", ["fieldGoalsMade/fieldGoalAttempts"], ["FG"],
                                 [("21", "Kick", None)])),
    ]
    docs.write(root / "game_id=100" / "data.json", docs.game(1, blocks=blocks,
                                                            drives=[drive, second]))
    docs.write(root / "game_id=101" / "data.json", docs.game(2, article=False, season=None))
    return flatten.with_lineage(files.read_game_details(spark, str(root)), "r1", F.lit(AT))


def test_article_and_images(games):
    article, = flatten.flatten_articles(games).collect()
    assert (article.id, article.game_id) == (701, 100)
    assert article.published == dt.datetime(2025, 9, 8, 3, 21)
    image, = flatten.flatten_images(games).collect()
    assert (image.url, image.article_id) == ("http://x/1.png", 701)


def test_team_stats_values_are_text(games):
    rows = flatten.flatten_team_stats(games.where("game_id = 100")).collect()
    assert {(r.name, r.value, r.home_away) for r in rows} == {
        ("firstDowns", "20", "home"), ("thirdDown", "-", "home")}


def test_player_stats_stop_at_the_shortest_list(games):
    rows = flatten.flatten_player_stats(games).collect()
    by_player = {}
    for r in rows:
        by_player.setdefault(r.athlete_id, []).append((r.stat_key, r.value_str))
    assert len(by_player["11"]) == 6
    assert by_player["12"] == [("completions/passingAttempts", "0/1"), ("passingYards", "0")]
    assert "13" not in by_player  # no labels: no rows
    assert "21" not in by_player  # no values: no rows


def test_season_default(games):
    rows = games.select("game_id", flatten.season_of(games).alias("s")).collect()
    assert {r.game_id: r.s for r in rows} == {100: 2025, 101: 2025}


def test_drives_and_plays(games):
    d = {r.drive_id: r for r in flatten.flatten_drives(games).collect()}
    assert d["d1"].start_spot == "AA 25" and d["d1"].end_spot is None and d["d1"].yards == 75
    p = {r.play_id: r for r in flatten.flatten_plays(games).collect()}
    assert set(p) == {"p1", "p2"}
    assert (p["p1"].sequence, p["p1"].start_spot) == (100, "1st & 10")
    assert p["p2"].sequence is None
