import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from statlake.operators import rows as sel
from statlake.operators.windows import history_window, lagged_features, temporal_split


def _games(spark, n_keys=6, n=40, seed=1):
    rnd = random.Random(seed)
    data = []
    for k in range(n_keys):
        for i in range(n if k == 0 else rnd.randint(1, 9)):
            day = None if rnd.random() < 0.05 else dt.date(2025, 1, 1) + dt.timedelta(
                days=rnd.randint(0, 120))
            data.append((k if k != 3 else None, 2025, day, i, rnd.randint(0, 50)))
    return spark.createDataFrame(data, "k int, season int, day date, game int, v int")


@pytest.mark.parametrize("n", [1, 3])
@pytest.mark.parametrize("block", ["week", "year"])
def test_cut_keys_give_the_same_averages(spark, n, block):
    df = _games(spark)
    args = (["v"], ["k", "season"], ["day", "game"], n)
    plain = lagged_features(df, *args).collect()
    cut = lagged_features(df, *args, block=F.trunc("day", block)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, cut))


def test_current_game_is_not_in_its_average(spark):
    df = spark.createDataFrame(
        [(1, 2024, 9, i, float(v)) for i, v in enumerate([10, 20, 30, 1000])]
        + [(1, 2025, 9, 0, 5.0)], "k int, season int, day int, game int, v double")
    out = lagged_features(df, ["v"], ["k", "season"], ["day", "game"], 3)
    got = {(r.season, r.game): (r.avg_v_3w, r.lookback_count) for r in out.collect()}
    assert got[2024, 3] == (20.0, 3)
    assert got[2025, 0] == (None, 0)  # a season starts anew


def _split_by_window(df, ts, share):
    w = Window.orderBy(F.col(ts).asc_nulls_last())
    return df.withColumn("split", F.when(F.percent_rank().over(w) < share, "train")
                         .otherwise("test"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("nulls", [0.0, 0.1, 0.6, 1.0])
def test_split_equals_the_global_window(spark, kind, nulls):
    rnd = random.Random(7)
    start = dt.datetime(2025, 1, 1)
    data = []
    for i in range(300):
        # A third of the rows share one instant; the others crowd into two days.
        at = start if i % 3 == 0 else start + dt.timedelta(
            microseconds=rnd.randint(0, 2 * 86_400_000_000))
        data.append((i, None if rnd.random() < nulls else at))
    df = spark.createDataFrame(data, "i int, at timestamp_ntz").withColumn(
        "at", F.col("at").cast(kind))
    for share in (0.333, 0.7):
        got = temporal_split(df, "at", share).collect()
        want = _split_by_window(df, "at", share).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_split_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(dt.date(2025, 1, 1),)], "d date")
    assert temporal_split(one, "d").first().split == "train"
    assert temporal_split(one.where("false"), "d").collect() == []


def test_history_keeps_texts_whole(spark):
    df = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q" * 600), (1, 2, "assistant", "a" * 600),
         (1, 3, "user", "next"), (2, 0, "user", "other")],
        "conv_id long, turn long, role string, text string")
    for block in (2, None):
        got = {(r.conv_id, r.turn): r for r in history_window(df, 3, turn_block=block).collect()}
        assert got[1, 3].n_messages == 3
        assert got[1, 3].context == (
            "\n\nUser question 2: " + "q" * 600 + "\n\nAssistant answer 3: " + "a" * 600)
        short = history_window(df, 3, answer_chars=500, turn_block=block).where("conv_id = 1 and turn = 3").first()
        assert short.context.endswith("Assistant answer 3: " + "a" * 500)
        assert got[2, 0].context == "" and got[2, 0].n_messages == 0


def test_latest_row_is_stable_under_ties(spark):
    data = [(1, None, "r9", "z"), (1, 5, "r1", "a"), (1, 5, "r2", "b"), (1, 5, "r2", "c"),
            (2, None, "r1", "only")]
    df = spark.createDataFrame(data, "k int, at int, run string, v string")
    for parts in (1, 3, 7):
        out = sel.latest_per_key(df.repartition(parts), ["k"], ["at"], ["run"])
        assert {r.k: r.v for r in out.collect()} == {1: "c", 2: "only"}
    plan = sel.latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan  # losers drop before the shuffle
