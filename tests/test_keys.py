"""Rows without a key never reach a table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import docs
from statlake.operators import flatten, merge
from statlake.plans import daily
from statlake.sources import files
from statlake.sources.lake import Lake
from test_daily import AT, _land


def test_upsert_refuses_null_keys(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(Exception, match="NULL in the key k"):
        merge.upsert(old, old, ["k"]).collect()
    assert merge.upsert(old, old.where("k = 1"), ["k"]).count() == 2


def test_empty_article_is_no_article(spark, tmp_path):
    document = docs.game(1)
    document["article"] = {}
    docs.write(tmp_path / "game_id=101" / "data.json", document)
    read = flatten.with_lineage(files.read_game_details(spark, str(tmp_path)), "r", F.lit("2025-01-01"))
    assert flatten.flatten_articles(read).count() == 0


def test_daily_chain_reaches_the_articles(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _land(tmp_path, [1, 2])
    lengths = lambda c: F.array(F.length(c).cast("float"))
    for run, at in (("r1", AT), ("r2", AT + dt.timedelta(days=1))):
        daily.run_daily(lake, files.read_scoreboards(spark, f"{tmp_path}/boards"),
                        files.read_game_details(spark, f"{tmp_path}/games"), run, at, embedder=lengths)
    assert lake.read("gold", "player_game_stats").count() == 4
    assert {r.processed_at for r in lake.read("stage", "article_embeddings").collect()} == {AT}
    assert lake.read("vectors", "article_chunks").count() == 2
