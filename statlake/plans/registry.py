"""Model registry: runs, versions, champion choice and deployment.

Registry tables hold one row per run, version or deployment; all rules are
DataFrame expressions and none reads a row into driver code.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlake.functions.scalars import json_number
from statlake.operators.checks import assert_empty, key_violations, ref_violations
from statlake.schemas import REGISTRY_REFERENCES, REGISTRY_TABLES, TABLES
from statlake.sources.lake import Lake

MAE = "$.ppr.test_mae"
# Metrics unpacked from the JSON text of runs and versions: output name -> path, type.
METRIC_FIELDS = {
    "test_rmse": ("$.ppr.test_rmse", "decimal(10,4)"),
    "test_mae": (MAE, "decimal(10,4)"),
    "test_corr": ("$.ppr.test_correlation", "decimal(10,4)"),
    "test_count": ("$.ppr.test_count", "int"),
}


def metrics_json(rmse: Column, mae: Column, corr: Column, count: Column) -> Column:
    """Metric columns packed as the registry's JSON text; NULL metrics are left out."""
    return F.to_json(F.struct(F.struct(
        rmse.alias("test_rmse"), mae.alias("test_mae"), corr.alias("test_correlation"),
        count.alias("test_count")).alias("ppr")))


def unpack_metrics(json_col: str, names=("test_rmse", "test_mae", "test_corr", "test_count"),
                   ) -> list[Column]:
    return [
        json_number(F.col(json_col), *METRIC_FIELDS[n]).alias(n) for n in names
    ]


# ---------------------------------------------------------------- choices


def best_run(runs: DataFrame, model_id: str | None = None,
             dataset_id: str | None = None) -> DataFrame:
    """The completed run with the lowest MAE; a run without a metric never wins."""
    rows = runs.where(F.col("status") == "completed")
    if model_id is not None:
        rows = rows.where(F.col("model_id") == model_id)
    if dataset_id is not None:
        rows = rows.where(F.col("dataset_id") == dataset_id)
    mae = json_number(F.col("metrics"), MAE)
    return rows.withColumn("mae", mae).orderBy(
        F.col("mae").asc_nulls_last(), F.col("run_id")).limit(1)


def latest_approved(versions: DataFrame, model_id: str | None = None) -> DataFrame:
    rows = versions.where(F.col("status") == "approved")
    if model_id is not None:
        rows = rows.where(F.col("model_id") == model_id)
    return rows.orderBy(F.col("created_at").desc_nulls_last(), F.col("model_version_id")).limit(1)


def active_deployment(deployments: DataFrame, versions: DataFrame,
                      model_id: str | None = None) -> DataFrame:
    """The newest deployment with traffic, with the artifact it serves."""
    v = versions if model_id is None else versions.where(F.col("model_id") == model_id)
    return (
        deployments.where(F.col("traffic_split") > 0)
        .join(v.select("model_version_id", "model_id", "artifact_path"), "model_version_id")
        .orderBy(F.col("deployed_at").desc_nulls_last(), F.col("traffic_split").desc_nulls_last(),
                 F.col("deployment_id"))
        .limit(1)
        .select("deployment_id", "model_version_id", "model_id", "endpoint_url", "artifact_path")
    )


def decide_status(candidate: DataFrame, champion: DataFrame) -> DataFrame:
    """``approved`` for a strictly lower MAE or without a champion, else ``candidate``.

    Both frames hold at most one row; ``candidate`` has ``mae``. A metric of 0 is
    a value. A candidate without a metric cannot beat a champion.
    """
    current = champion.agg(F.max(json_number(F.col("metrics_json"), MAE)).alias("mae")).scalar()
    known = champion.agg(F.count(F.lit(1)).alias("n")).scalar()
    better = F.when(known == 0, True).otherwise(F.col("mae") < F.col("champion_mae"))
    return candidate.withColumn("champion_mae", current).withColumn(
        "status", F.when(better, "approved").otherwise("candidate"))


def deploy(deployments: DataFrame, versions: DataFrame, version_id: str, deployment_id: str,
           endpoint_url: str, at: Column) -> DataFrame:
    """The deployment table after deploying a version, as one frame to write at once.

    Traffic of the model's other deployments drops to 0 and the version gets 1.0;
    a version that is not approved changes nothing.
    """
    chosen = versions.where(
        (F.col("model_version_id") == version_id) & (F.col("status") == "approved"))
    siblings = versions.join(chosen.select("model_id"), "model_id", "left_semi").select(
        "model_version_id").distinct().withColumn("_hit", F.lit(True))
    old = deployments.join(siblings, "model_version_id", "left").withColumn(
        "traffic_split", F.when(F.col("_hit"), F.lit(0.0)).otherwise(F.col("traffic_split"))
        .cast("float")).select(*deployments.columns)
    new = chosen.select(
        F.lit(deployment_id).alias("deployment_id"), "model_version_id",
        F.lit(endpoint_url).alias("endpoint_url"), F.lit(1.0).cast("float").alias("traffic_split"),
        at.cast("timestamp_ntz").alias("deployed_at"))
    return old.unionByName(new)


# ---------------------------------------------------------------- registration


def _row(spark: SparkSession, table: str, **values) -> DataFrame:
    schema = TABLES["mlops", table].schema
    return spark.createDataFrame([tuple(values.get(f) for f in schema.fieldNames())], schema)


def register_model(lake: Lake, model_id: str, name: str, business_problem: str,
                   ticket_number: str, owner: str, at: datetime) -> None:
    """First registration wins; later calls leave the row alone."""
    lake.insert_ignore(_row(
        lake.spark, "model", model_id=model_id, name=name, business_problem=business_problem,
        ticket_number=ticket_number, owner=owner, created_at=at), "mlops", "model")


def register_dataset(lake: Lake, model_id: str, metadata: DataFrame, location: str,
                     at: datetime) -> None:
    """Insert the dataset version or refresh its counts and time."""
    rows = metadata.select(
        F.concat(F.lit("ds-player-fantasy-"), F.col("data_version")).alias("dataset_id"),
        F.lit(model_id).alias("model_id"), "data_version", F.lit(location).alias("location"),
        "row_count", "feature_count", F.lit(str(at)).cast("timestamp_ntz").alias("created_at"))
    lake.upsert_cols(rows, "mlops", "dataset", ["row_count", "feature_count", "created_at"])


def register_run(lake: Lake, run_id: str, model_id: str, dataset_id: str, params: dict,
                 metrics: DataFrame, artifact: str, at: datetime,
                 status: str = "completed") -> None:
    """One training run with its parameters and metrics as JSON text; a known id keeps its row."""
    rows = metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(model_id).alias("model_id"),
        F.lit(dataset_id).alias("dataset_id"), F.lit(json.dumps(params)).alias("params"),
        metrics_json(F.col("rmse"), F.col("mae"), F.col("corr"), F.col("test_count"))
        .alias("metrics"),
        F.lit(artifact).alias("artifact"), F.lit(status).alias("status"),
        F.lit(str(at)).cast("timestamp_ntz").alias("created_at"))
    lake.insert_ignore(rows, "mlops", "training_run")


def register_best_version(lake: Lake, model_id: str, dataset_id: str, version_id: str,
                          at: datetime) -> None:
    """Promote the best run to a version, approved when it beats the current one.

    A version that is registered already stays as it is.
    """
    best = best_run(lake.read("mlops", "training_run"), model_id, dataset_id)
    champion = latest_approved(lake.read("mlops", "model_version"), model_id)
    rows = decide_status(best, champion).select(
        F.lit(version_id).alias("model_version_id"), "model_id",
        F.col("run_id").alias("training_run_id"), F.col("artifact").alias("artifact_path"),
        F.col("metrics").alias("metrics_json"), "status",
        F.lit(str(at)).cast("timestamp_ntz").alias("created_at"))
    lake.insert_ignore(rows, "mlops", "model_version")


def deploy_version(lake: Lake, version_id: str, deployment_id: str, endpoint_url: str,
                   at: datetime) -> None:
    """Write the deployment table with the version in it; a known deployment changes nothing."""
    known = lake.read("mlops", "deployment").where(F.col("deployment_id") == deployment_id)
    if not known.isEmpty():
        return
    after = deploy(lake.read("mlops", "deployment"), lake.read("mlops", "model_version"),
                   version_id, deployment_id, endpoint_url, F.lit(str(at)))
    lake.replace(after, "mlops", "deployment")


def check_references(lake: Lake) -> None:
    """Raise on a duplicate registry key or a reference without its parent row."""
    for t in REGISTRY_TABLES:
        assert_empty(key_violations(lake.read("mlops", t.name), list(t.keys)),
                     f"duplicate key in {t.name}")
    for child, column, parent, key in REGISTRY_REFERENCES:
        assert_empty(
            ref_violations(lake.read("mlops", child), lake.read("mlops", parent), {column: key}),
            f"{child}.{column} without {parent}")


def artifact_ref(table: str, run_id: str) -> str:
    """Where a table-backed model keeps its predictions, as data instead of SQL text."""
    return json.dumps({"table": table, "run_id": run_id})


def table_of(artifact: str) -> dict | None:
    """The table and run of a table-backed artifact, None for a saved model's path."""
    return json.loads(artifact) if artifact.startswith("{") else None
