import random

import pytest

from statlake.operators import topk


def _vectors(spark, n, dims, seed, prefix=""):
    rnd = random.Random(seed)
    data = [(f"{prefix}{i}", [float(rnd.choice([-1, 0, 1])) for _ in range(dims)])
            for i in range(n)]
    data.append((f"{prefix}zero", [0.0] * dims))
    data.append((f"{prefix}null", None))
    return data, spark.createDataFrame(data, "id string, values array<float>")


def _brute(queries, corpus, k):
    def unit(v):
        n = sum(x * x for x in v) ** 0.5
        return [x / n for x in v] if n else None

    out = set()
    for q, qv in queries:
        if qv is None or unit(qv) is None:
            continue
        scored = [(-round(sum(a * b for a, b in zip(unit(qv), unit(v))), 9), c)
                  for c, v in corpus if v is not None and unit(v) is not None]
        out |= {(q, i, c) for i, (_, c) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("many", [False, True])
def test_exact_with_ties(spark, monkeypatch, many):
    """Few distinct values make many equal scores; ids decide, with any number of slices."""
    if many:
        monkeypatch.setattr(topk, "SLICE_VALUES", 20)
        monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 2)
    q_rows, q = _vectors(spark, 11, 5, 1, "q")
    c_rows, c = _vectors(spark, 90, 5, 2)
    q = q.withColumnRenamed("id", "query_id")
    got = topk.cosine_top_k(q, c.repartition(5), 7).collect()
    assert {(r.query_id, r.rank, r.id) for r in got} == _brute(q_rows, c_rows, 7)


def test_k_above_corpus_and_no_query(spark):
    _, c = _vectors(spark, 3, 4, 2)
    _, q = _vectors(spark, 2, 4, 5, "q")
    q = q.withColumnRenamed("id", "query_id")
    assert topk.cosine_top_k(q, c, 50).groupBy("query_id").count().where("count > 3").isEmpty()
    assert topk.cosine_top_k(q.where("false"), c, 5).collect() == []


@pytest.mark.parametrize("bad", [[1.0, 0.0, 1.0], [1.0] * 5, [1.0, None, 0.0, 0.0]])
def test_broken_vectors_are_errors(spark, bad):
    _, c = _vectors(spark, 3, 4, 2)
    _, q = _vectors(spark, 2, 4, 5, "q")
    q = q.withColumnRenamed("id", "query_id")
    broken = c.union(spark.createDataFrame([("bad", bad)], "id string, values array<float>"))
    with pytest.raises(Exception, match="not 4 numbers"):
        topk.cosine_top_k(q, broken, 2).collect()


def test_corpus_is_not_shuffled(spark):
    _, c = _vectors(spark, 30, 4, 2)
    _, q = _vectors(spark, 3, 4, 5, "q")
    plan = topk.cosine_top_k(q.withColumnRenamed("id", "query_id"), c, 2)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in below


@pytest.mark.parametrize("group", [7, 60, 10_000_000])
def test_block_product(spark, monkeypatch, group):
    """The same hits whatever the size of the groups, with string and numeric ids and no vector collected."""
    monkeypatch.setattr(topk, "GROUP_VALUES", group)
    monkeypatch.setattr(topk, "MET_VALUES", 50)
    q_rows, q = _vectors(spark, 40, 5, 1, "q")
    c_rows, c = _vectors(spark, 90, 5, 2)
    q = q.withColumnRenamed("id", "query_id")
    got = topk.block_top_k(q, c.repartition(5), 7).collect()
    assert {(r.query_id, r.rank, r.id) for r in got} == _brute(q_rows, c_rows, 7)
    numbered = c.where("id rlike '^[0-9]+$'").withColumn("id", c["id"].cast("long"))
    got = topk.block_top_k(q, numbered, 3).collect()
    rows = [(int(i), v) for i, v in c_rows if i.isdigit()]
    assert {(r.query_id, r.rank, r.id) for r in got} == _brute(q_rows, rows, 3)
    assert topk.block_top_k(q.where("false"), c, 3).collect() == []
    assert topk.block_top_k(q, c.where("false"), 3).collect() == []


def test_payload_reads_the_blocks_of_hits(spark, tmp_path):
    from statlake.bindings import QUERIES

    df = QUERIES["topk_lake"](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_every_row_asks(spark, tmp_path):
    """topk_many asks with all rows, whatever their ids; a NULL vector neither asks nor answers."""
    from statlake.bindings import QUERIES

    rnd = random.Random(3)
    data = [(i, [rnd.random() - 0.5 for _ in range(6)] if i != 8 else None, i % 3) for i in range(1, 40)]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    got = QUERIES["topk_many"](spark, str(tmp_path)).collect()
    assert {(r.query_id, r.rank) for r in got} == {(i, n) for i in range(1, 40) if i != 8 for n in range(1, 11)}
    assert all(r.id == r.query_id for r in got if r["rank"] == 1)


@pytest.mark.parametrize("pairs", [60, 10**9])
def test_block_product_shares_out_the_pairs(spark, monkeypatch, pairs):
    """Many tasks on both sides give the hits of one; equal scores rank by id, a NULL id last."""
    monkeypatch.setattr(topk, "TASK_PAIRS", pairs)
    rows = [(i if i else None, [float(i % 2), 1.0, 0.0]) for i in range(30)]
    c = spark.createDataFrame(rows, "id long, values array<float>").repartition(3)
    q = spark.createDataFrame([("even", [0.0, 1.0, 0.0]), ("odd", [1.0, 1.0, 0.0])], "query_id string, values array<float>")
    if pairs == 60:
        q = q.unionByName(spark.range(40).selectExpr("'more' || id query_id", "array(1f, 1f, 0f) values"))
        assert min(topk._groups(42, 30, 3)) > 1
    hits = {n: [r.id for r in topk.block_top_k(q, c, 15).orderBy("rank").where(f"query_id = '{n}'").collect()]
            for n in ("even", "odd")}
    assert hits == {"even": [*range(2, 30, 2), None], "odd": list(range(1, 30, 2))}
