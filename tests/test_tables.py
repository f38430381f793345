import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from statlake.operators import checks, merge, rows
from statlake.sources import catalog, files
from statlake.sources.lake import BLOCK, Lake

KV = "k int, v string, w string"
ROWS = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ab"), st.sampled_from("xy")),
                max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_merges_like_dictionaries(spark, old, new):
    target, source = (spark.createDataFrame(x, KV) for x in (old, new))
    o, n = ({k: (v, w) for k, v, w in x} for x in (old, new))

    def content(df):
        got = df.collect()
        assert len(got) == len({r.k for r in got})
        return {r.k: (r.v, r.w) for r in got}

    once = merge.upsert(target, source, ["k"])
    assert content(once) == o | n
    assert content(merge.upsert(once, source, ["k"])) == o | n
    assert content(merge.insert_ignore(target, source, ["k"])) == n | o
    want = {k: (n[k][0], o[k][1]) if k in n and k in o else (o | n)[k] for k in o | n}
    assert content(merge.upsert_cols(target, source, ["k"], ["v"])) == want
    hit = merge.update_where_in(target, source, ["k"], {"w": F.lit("!")})
    assert content(hit) == {k: (v, "!" if k in n else w) for k, (v, w) in o.items()}


def test_update_to_null_counts_as_update(spark):
    target = spark.createDataFrame([(1, "a", "b")], KV)
    source = spark.createDataFrame([(1, None, "z")], KV)
    assert tuple(merge.upsert_cols(target, source, ["k"], ["v"]).first()) == (1, None, "b")


def test_anti_join_keeps_null_keys(spark):
    src = spark.createDataFrame([(None, "a", "b"), (1, "a", "b"), (2, "a", "b")], KV)
    done = spark.createDataFrame([(1,), (None,)], "id int")
    assert {r.k for r in rows.unprocessed(src, done, {"k": "id"}).collect()} == {None, 2}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", None), (None, "d", "x")], KV)
    bad = {(r.k, r.n_rows) for r in checks.key_violations(df, ["k"]).collect()}
    assert bad == {(1, 2), (None, 1)}
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r.k for r in checks.ref_violations(df, parent, {"k": "id"}).collect()] == [2]
    assert checks.require_key(df, ["k"]).count() == 3
    with pytest.raises(ValueError, match="duplicate"):
        checks.assert_empty(checks.key_violations(df, ["k"]), "duplicate key")


def test_defaults_and_conform_keep_types(spark):
    df = spark.createDataFrame([(None, "1.005")], "a int, b string")
    out = merge.with_defaults(df, {"a": 0})
    assert out.first().a == 0 and out.schema["a"].dataType.simpleString() == "int"
    from pyspark.sql.types import StructType

    shaped = merge.conform(df, StructType.fromDDL("b decimal(10,2), c string, a int"))
    assert tuple(map(str, shaped.first())) == ("1.01", "None", "None")


def _stats(spark, *data):
    return spark.createDataFrame(list(data), "game_id int, team_id string, category string, "
                                             "value string")


def test_block_upsert_touches_only_its_blocks(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    name = ("stage", "fact_team_stats")
    lake.upsert(_stats(spark, (1, "a", "x", "1"), (5000, "a", "x", "2"), (5001, "a", "x", "3")),
                *name)
    files_before = {p.name: p.stat().st_mtime_ns for p in tmp_path.rglob("key_block=0/*.parquet")}
    lake.upsert(_stats(spark, (5001, "a", "x", "new"), (5002, "a", "x", "4")), *name)
    got = {(r.game_id, r.value) for r in lake.read(*name).collect()}
    assert got == {(1, "1"), (5000, "2"), (5001, "new"), (5002, "4")}
    files_after = {p.name: p.stat().st_mtime_ns for p in tmp_path.rglob("key_block=0/*.parquet")}
    assert files_before == files_after


def test_touched_blocks_are_pruned_by_a_join(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    name = ("stage", "fact_team_stats")
    lake.upsert(_stats(spark, *[(g, "a", "x", "1") for g in (1, 1500, 2500, 9000)]), *name)
    lake.upsert(_stats(spark, *[(g, "a", "x", "2") for g in (1, 1501, 2500)]), *name)
    got = {(r.game_id, r.value) for r in lake.read(*name).collect()}
    assert got == {(1, "2"), (1500, "1"), (1501, "2"), (2500, "2"), (9000, "1")}
    near = lake.read_near(*name, spark.createDataFrame([(9001,), (2,)], "game_id int"))
    assert {r.game_id for r in near.collect()} == {1, 9000}
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    # However many blocks are named, the plan is the same and none of them is collected.
    many = lake.read_near(*name, spark.range(20_000).selectExpr("cast(id * 1000 as int) as game_id"))
    assert {r.game_id for r in many.collect()} == {1, 1500, 1501, 2500, 9000}
    assert "dynamicpruning" in many._jdf.queryExecution().executedPlan().toString()


def test_staged_blocks_survive_a_lost_run(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    name = ("stage", "fact_team_stats")
    lake.upsert(_stats(spark, (1, "a", "x", "1"), (2, "a", "x", "2")), *name)
    calls = []

    def lost(self, table):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Lake, "_recover", lost)
        with pytest.raises(RuntimeError):
            lake.upsert(_stats(spark, (1, "a", "x", "new")), *name)
    again = Lake(spark, str(tmp_path))
    assert {(r.game_id, r.value) for r in again.read(*name).collect()} == {(1, "new"), (2, "2")}
    assert not list(tmp_path.rglob("staged"))
    assert again._scan(_table(*name)).where(F.col(BLOCK) != 0).isEmpty()


def _table(layer, name):
    from statlake.schemas import TABLES

    return TABLES[layer, name]


def test_snapshots_ignore_unfinished_writes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.read("mlops", "model").isEmpty()
    lake.ensure()
    assert lake.exists("mlops", "model") and lake.exists("gold", "player_game_stats")
    one = spark.createDataFrame([("m1", "first")], "model_id string, name string")
    lake.insert_ignore(one, "mlops", "model")
    lake.insert_ignore(one.withColumn("name", F.lit("second")), "mlops", "model")
    assert [r.name for r in lake.read("mlops", "model").collect()] == ["first"]
    half = tmp_path / "mlops" / "model" / "v=00000009"
    half.mkdir()
    assert [r.name for r in lake.read("mlops", "model").collect()] == ["first"]
    lake.replace(one.withColumn("name", F.lit("third")), "mlops", "model")
    assert [r.name for r in lake.read("mlops", "model").collect()] == ["third"]


def test_a_repeated_run_does_not_double(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(1, 2025)], "id int, season int")
    for run in ("a", "b", "b"):
        lake.replace_run(df, "raw", "games", run)
    assert sorted(r.run_id for r in lake.read("raw", "games").collect()) == ["a", "b"]


def test_latest_and_run_copies(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "a")], "id int, week int, v string")
    files.write_latest_and_run(df, str(tmp_path), ["week"], "r1")
    files.write_latest_and_run(df.where("week = 2").withColumn("v", F.lit("b")), str(tmp_path),
                               ["week"], "r2")
    latest = spark.read.parquet(f"{tmp_path}/latest")
    assert {(r.id, r.v) for r in latest.collect()} == {(1, "a"), (2, "b")}
    assert files.as_of_run(spark, str(tmp_path), "r1").count() == 2
    assert files.as_of_run(spark, str(tmp_path), "r2").count() == 1


def test_empty_input_is_skipped(spark):
    empty = spark.createDataFrame([], KV)
    assert rows.if_not_empty(empty, lambda df: 1 / 0) is None
    assert rows.latest_per_key(empty, ["k"], ["v"]).collect() == []


def test_catalog_reads(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.0, True)], "avg_a int, avg_b int, c double, is_home boolean")
    assert catalog.feature_columns(df) == ["avg_a", "avg_b", "is_home"]
    assert catalog.count_columns(df, "avg_") == 2
    assert {r.column_name: r.non_null for r in catalog.profile(df).collect()} == {
        "avg_a": 1, "avg_b": 0, "c": 1, "is_home": 1}
    snap = catalog.catalog_snapshot({"t": df, "u": df}, keep=["u"])
    assert {r.table_name for r in snap.collect()} == {"u"}
    df.createOrReplaceTempView("snapshot_view")
    assert catalog.session_columns(spark, ["no_such"]).collect() == []
    got = catalog.sql(spark, "SELECT c FROM {t} WHERE avg_a = ?", [1], t=df).collect()
    assert [r.c for r in got] == [2.0]


def test_eval_set_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_text('question,article_id,n_chunks\n"Who, when?",7,3\nWhat?,8,\n')
    got = files.read_eval_set(spark, str(tmp_path / "e.csv")).collect()
    assert [tuple(r) for r in got] == [("Who, when?", 7, 3), ("What?", 8, None)]


def test_orders_sheet(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        'Row ID,Customer Segment,Sales,Product Category\n1,Home,"10.5",Chairs\n2,Home,x,\n')
    df = files.read_orders(spark, str(tmp_path / "o.csv"))
    assert df.columns == ["Row ID", "customer_segment", "sales", "product_category"]
    assert [(r.sales, r.product_category) for r in df.collect()] == [(10.5, "Chairs"), (None, None)]


def test_run_arguments():
    import datetime as dt

    from statlake.session import new_run_id, process_date

    assert process_date(dt.date(2025, 3, 1)) == "20250228"
    assert len(new_run_id()) == 12 and new_run_id() != new_run_id()
