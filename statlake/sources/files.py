"""File scans with explicit schemas: landed documents and headed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statlake import schemas


def _documents(spark: SparkSession, ddl: str, path: str, one_per_file: bool) -> DataFrame:
    # Partition columns of the landing layout (season=, week=, game_id=, ...) come
    # from the path. Files of one document each cannot be split, so many small
    # files per task is the unit of work; JSON lines split like any text.
    df = spark.read.schema(ddl).option("multiLine", one_per_file).json(path)
    return df.withColumn("source_path", F.col("_metadata.file_path"))


def read_scoreboards(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Scoreboard documents, one per day."""
    return _documents(spark, schemas.SCOREBOARD_DOC, path, one_per_file)


def read_game_details(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Game documents, one per game; ``game_id`` comes from the landing path."""
    return _documents(spark, f"{schemas.GAME_DOC}, game_id int", path, one_per_file)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A headed CSV with a declared schema: no inference pass over the data."""
    return spark.read.schema(ddl).option("header", True).csv(path)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """The sales sheet as headed CSV: all its columns, with the three that are used
    renamed and the amount parsed. The header alone names the columns; no value is
    read to infer types."""
    df = spark.read.option("header", True).csv(path).withColumnsRenamed(schemas.ORDERS_COLUMNS)
    return df.withColumn("sales", F.col("sales").try_cast("double"))


def read_eval_set(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.EVAL_SET)


def clustered(df: DataFrame, parts: list[str]) -> DataFrame:
    """Bring the rows of a directory together before a partitioned write.

    Without it every task opens a file in every directory. The rebalance splits
    large directories over several tasks and merges small ones at run time.
    """
    return df.hint("rebalance", *[F.col(p) for p in parts])


def land_json(df: DataFrame, root: str, parts: list[str]) -> None:
    """Write rows as JSON lines below ``part=value`` directories."""
    clustered(df, parts).write.mode("append").partitionBy(*parts).json(root)


def write_latest_and_run(df: DataFrame, root: str, parts: list[str], run_id: str) -> None:
    """Two copies: ``runs`` keeps each run, ``latest`` replaces the touched partitions.

    The second copy is made from the first, so ``df`` is computed once. Rerunning
    with the same run id rewrites the same directories in both.
    """
    def put(out: DataFrame, path: str, by: list[str]) -> None:
        (clustered(out, parts).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))

    put(df.withColumn("run_id", F.lit(run_id)), f"{root}/runs", [*parts, "run_id"])
    kept = as_of_run(df.sparkSession, root, run_id)
    put(kept.select(*df.columns), f"{root}/latest", parts)


def as_of_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The rows one run wrote; the filter prunes to that run's directories."""
    return spark.read.parquet(f"{root}/runs").where(F.col("run_id") == run_id)
