"""Registry rules on rows derived from parts and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.bindings.common import ntz, query, rounded, table
from statlake.plans import marts, registry

# Parts stand in for training runs, suppliers for model versions and deployments.
RUNS = """
runs AS (SELECT 'run-' || p_partkey AS run_id, 'model-' || p_size AS model_id,
  'ds-' || p_brand AS dataset_id,
  CASE WHEN p_type = 'ECONOMY' THEN '{"model_type":"' || p_type || '"}'
    WHEN p_type = 'PROMO' THEN '{"x":1}'
    ELSE '{"algorithm":"' || p_type || '","model_type":"m"}' END AS params,
  CASE WHEN p_size = 7 THEN '{"ppr":{"test_rmse":1.5,"test_mae":null}}'
    ELSE '{"ppr":{"test_rmse":' || (p_retailprice / 10)::DECIMAL(12,2) || ',"test_mae":'
      || p_retailprice::DECIMAL(12,2) || ',"test_correlation":0.5,"test_count":' || p_size || '}}'
    END AS metrics,
  'path/' || p_partkey AS artifact,
  CASE WHEN p_name LIKE 'red%' THEN 'failed' ELSE 'completed' END AS status,
  TIMESTAMP '2025-01-01' + to_days((p_partkey % 50)::INTEGER) AS created_at FROM part)"""
VERSIONS = """
versions AS (SELECT 'v-' || s_suppkey AS model_version_id, 'model-' || s_nationkey AS model_id,
  'run-' || s_suppkey AS training_run_id, 'path/' || s_suppkey AS artifact_path,
  '{"ppr":{"test_rmse":2.25,"test_mae":' || s_acctbal::DECIMAL(12,2) || ',"test_correlation":'
    || '0.25,"test_count":' || s_nationkey || '}}' AS metrics_json,
  CASE WHEN s_acctbal > 0 THEN 'approved' ELSE 'candidate' END AS status,
  TIMESTAMP '2025-01-01' + to_days((s_suppkey % 10)::INTEGER) AS created_at FROM supplier)"""
DEPLOYMENTS = """
deployments AS (SELECT 'dep-' || s_suppkey AS deployment_id, 'v-' || s_suppkey AS model_version_id,
  'url/' || s_suppkey AS endpoint_url,
  CASE WHEN s_acctbal > 5000 THEN 0.0 ELSE 1.0 END::FLOAT AS traffic_split,
  TIMESTAMP '2025-02-01' + to_days((s_suppkey % 10)::INTEGER) AS deployed_at FROM supplier)"""
MODELS = "models AS (SELECT 'model-' || n_nationkey AS model_id, n_name AS name FROM nation)"


def _json(col, path):
    return f"TRY_CAST(json_extract_string({col}, '{path}') AS DECIMAL(10,4))::DOUBLE"


MAE_SQL = _json("metrics", "$.ppr.test_mae")


def _tag(prefix, col):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _day(start, col, n):
    days = F.pmod(F.col(col), F.lit(n)).cast("int")
    return F.timestamp_add("DAY", days, ntz(start)).alias("day")


def runs(spark, d):
    p = table(spark, d, "part")
    kind = F.col("p_type")
    money = F.col("p_retailprice").cast("decimal(12,2)")
    metrics = F.to_json(F.struct(F.struct(
        (F.col("p_retailprice") / 10).cast("decimal(12,2)").alias("test_rmse"),
        F.when(F.col("p_size") != 7, money).alias("test_mae"),
        F.lit(0.5).alias("test_correlation"), F.col("p_size").alias("test_count")).alias("ppr")))
    broken = F.lit('{"ppr":{"test_rmse":1.5,"test_mae":null}}')
    return p.select(
        _tag("run-", "p_partkey").alias("run_id"), _tag("model-", "p_size").alias("model_id"),
        _tag("ds-", "p_brand").alias("dataset_id"),
        F.when(kind == "ECONOMY", F.to_json(F.struct(kind.alias("model_type"))))
        .when(kind == "PROMO", F.lit('{"x":1}'))
        .otherwise(F.to_json(F.struct(kind.alias("algorithm"), F.lit("m").alias("model_type"))))
        .alias("params"),
        F.when(F.col("p_size") == 7, broken).otherwise(metrics).alias("metrics"),
        _tag("path/", "p_partkey").alias("artifact"),
        F.when(F.col("p_name").like("red%"), "failed").otherwise("completed").alias("status"),
        _day("2025-01-01", "p_partkey", 50).alias("created_at"))


def versions(spark, d):
    return table(spark, d, "supplier").select(
        _tag("v-", "s_suppkey").alias("model_version_id"),
        _tag("model-", "s_nationkey").alias("model_id"),
        _tag("run-", "s_suppkey").alias("training_run_id"),
        _tag("path/", "s_suppkey").alias("artifact_path"),
        registry.metrics_json(F.lit(2.25), F.col("s_acctbal").cast("decimal(12,2)"), F.lit(0.25),
                              F.col("s_nationkey")).alias("metrics_json"),
        F.when(F.col("s_acctbal") > 0, "approved").otherwise("candidate").alias("status"),
        _day("2025-01-01", "s_suppkey", 10).alias("created_at"))


def deployments(spark, d):
    return table(spark, d, "supplier").select(
        _tag("dep-", "s_suppkey").alias("deployment_id"),
        _tag("v-", "s_suppkey").alias("model_version_id"),
        _tag("url/", "s_suppkey").alias("endpoint_url"),
        F.when(F.col("s_acctbal") > 5000, 0.0).otherwise(1.0).cast("float").alias("traffic_split"),
        _day("2025-02-01", "s_suppkey", 10).alias("deployed_at"))


def models(spark, d):
    return table(spark, d, "nation").select(
        _tag("model-", "n_nationkey").alias("model_id"), F.col("n_name").alias("name"))


BEST = f"""
best AS (SELECT run_id, model_id, {MAE_SQL} AS mae FROM runs WHERE status = 'completed'
  ORDER BY mae ASC NULLS LAST, run_id LIMIT 1)"""


@query(f"WITH {RUNS}, {BEST} SELECT * FROM best")
def best_run(spark, d):
    best = registry.best_run(runs(spark, d)).select("run_id", "model_id", "mae")
    return rounded(best, 4, "mae")


@query(f"WITH {VERSIONS}, {DEPLOYMENTS} SELECT d.deployment_id, d.model_version_id, v.model_id, "
       "d.endpoint_url, v.artifact_path FROM deployments d JOIN versions v "
       "ON d.model_version_id = v.model_version_id WHERE d.traffic_split > 0 "
       "ORDER BY d.deployed_at DESC NULLS LAST, d.traffic_split DESC NULLS LAST, d.deployment_id "
       "LIMIT 1")
def active_deployment(spark, d):
    return registry.active_deployment(deployments(spark, d), versions(spark, d))


@query(f"WITH {VERSIONS} SELECT model_version_id, model_id, created_at FROM versions "
       "WHERE status = 'approved' ORDER BY created_at DESC NULLS LAST, model_version_id LIMIT 1")
def latest_approved(spark, d):
    return registry.latest_approved(versions(spark, d)).select(
        "model_version_id", "model_id", "created_at")


@query(f"WITH {VERSIONS}, {MODELS} SELECT v.model_version_id, v.model_id, m.name AS model_name, "
       f"v.status, {_json('v.metrics_json', '$.ppr.test_rmse')} AS test_rmse, "
       f"{_json('v.metrics_json', '$.ppr.test_mae')} AS test_mae, "
       f"{_json('v.metrics_json', '$.ppr.test_correlation')} AS test_corr, "
       "TRY_CAST(json_extract_string(v.metrics_json, '$.ppr.test_count') AS INTEGER) AS test_count, "
       "v.created_at FROM versions v JOIN models m ON v.model_id = m.model_id")
def version_metrics(spark, d):
    out = marts.version_registry(versions(spark, d), models(spark, d))
    return rounded(out, 4, "test_rmse", "test_mae", "test_corr")


@query(f"""WITH {RUNS}, {BEST}, {VERSIONS},
champion AS (SELECT {_json('metrics_json', '$.ppr.test_mae')} AS mae FROM versions
  WHERE status = 'approved' ORDER BY created_at DESC NULLS LAST, model_version_id LIMIT 1)
SELECT b.run_id, b.mae, c.mae AS champion_mae, CASE WHEN (SELECT count(*) FROM champion) = 0
  OR b.mae < c.mae THEN 'approved' ELSE 'candidate' END AS status
FROM best b LEFT JOIN champion c ON true""")
def champion_challenger(spark, d):
    best = registry.best_run(runs(spark, d))
    out = registry.decide_status(best, registry.latest_approved(versions(spark, d)))
    return rounded(out.select("run_id", "mae", "champion_mae", "status"), 4, "mae",
                   "champion_mae")


@query(f"""WITH {VERSIONS}, {DEPLOYMENTS},
chosen AS (SELECT * FROM versions WHERE model_version_id = 'v-1' AND status = 'approved')
SELECT deployment_id, model_version_id, endpoint_url, CASE WHEN model_version_id IN
  (SELECT model_version_id FROM versions WHERE model_id IN (SELECT model_id FROM chosen))
  THEN 0.0 ELSE traffic_split END::FLOAT AS traffic_split, deployed_at FROM deployments
UNION ALL SELECT 'dep-new', model_version_id, 'url/new', 1.0::FLOAT, TIMESTAMP '2025-03-01'
FROM chosen""")
def deploy_swap(spark, d):
    return registry.deploy(deployments(spark, d), versions(spark, d), "v-1", "dep-new", "url/new",
                           ntz("2025-03-01"))


@query(f"WITH {RUNS}, {VERSIONS}, {DEPLOYMENTS}, {MODELS} SELECT "
       "(SELECT count(DISTINCT model_id) FROM models) AS n_models, "
       "(SELECT count(*) FROM versions WHERE status = 'approved') AS n_approved, "
       "(SELECT count(*) FROM deployments WHERE traffic_split > 0) AS n_active, "
       "(SELECT count(*) FROM runs WHERE status = 'completed') AS n_completed")
def registry_kpis(spark, d):
    return marts.registry_kpis(models(spark, d), versions(spark, d), deployments(spark, d),
                               runs(spark, d))


RECENT = f"""
SELECT run_id, model_id, dataset_id, {_json('metrics', '$.ppr.test_rmse')} AS test_rmse,
  {MAE_SQL} AS test_mae, {_json('metrics', '$.ppr.test_correlation')} AS test_corr,
  json_extract_string(params, '$.algorithm') AS algorithm,
  json_extract_string(params, '$.model_type') AS model_type, status, created_at
FROM runs ORDER BY created_at DESC NULLS LAST, run_id"""


@query(f"WITH {RUNS} {RECENT} LIMIT 30")
def recent_runs(spark, d):
    return rounded(marts.recent_runs(runs(spark, d)), 4, "test_rmse", "test_mae", "test_corr")


@query(f"WITH {RUNS}, r AS ({RECENT}) SELECT coalesce(algorithm, model_type) AS algorithm_type, "
       "round(avg(test_mae), 6) AS test_mae, round(avg(test_rmse), 6) AS test_rmse, "
       "round(avg(test_corr), 6) AS test_corr FROM r "
       "WHERE coalesce(algorithm, model_type) IS NOT NULL GROUP BY 1")
def algorithm_comparison(spark, d):
    """Over every run; the dashboard feeds it the 30 recent ones."""
    p = runs(spark, d)
    unpacked = p.select(
        *registry.unpack_metrics("metrics", ("test_rmse", "test_mae", "test_corr")),
        F.get_json_object("params", "$.algorithm").alias("algorithm"),
        F.get_json_object("params", "$.model_type").alias("model_type"))
    return rounded(marts.algorithm_comparison(unpacked), 6, "test_mae", "test_rmse", "test_corr")
