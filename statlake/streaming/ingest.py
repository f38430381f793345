"""Ingest and upsert as file streams: new files only, newest row wins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from statlake import schemas
from statlake.operators.flatten import GAME_ROWS, SCOREBOARD_ROWS
from statlake.operators.rows import latest_per_key
from statlake.plans.daily import load_gold, load_raw, load_stage
from statlake.plans.retrieval import embed_new
from statlake.sources.lake import Lake


def _run(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def ingest_stream(spark: SparkSession, land: str, lake: Lake, kind: str, checkpoint: str,
                  at: datetime, max_files: int | None = None) -> StreamingQuery:
    """Read landed documents not seen before into raw and stage, then stop.

    The checkpoint remembers finished files. A batch that is run again carries the
    same run id, so raw keeps one copy and the stage upsert repeats itself.
    """
    ddl, rows = {
        "scoreboard": (schemas.SCOREBOARD_DOC, SCOREBOARD_ROWS),
        "game": (f"{schemas.GAME_DOC}, game_id int", GAME_ROWS),
    }[kind]
    reader = spark.readStream.schema(ddl).option("multiLine", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.json(land).withColumn("source_path", F.col("_metadata.file_path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{kind}-{batch_id:06d}"
        load_raw(lake, batch, rows, run_id, at)
        load_stage(lake, run_id)

    return _run(stream, each, checkpoint)


def chain_stream(spark: SparkSession, land: str, lake: Lake, kind: str, checkpoint: str,
                 at: datetime, max_files: int | None = None, one_per_file: bool = True,
                 embedder=None) -> StreamingQuery:
    """Landed documents not seen before through raw, stage and gold, and articles to vectors.

    One batch writes several tables. The batch number is the run id, every write can be
    repeated under it, and a commit row follows the last one: a batch that comes again after
    its commit does nothing, one that was lost in between is made whole. A game enters gold
    with the later of its two documents, whichever stream brings it.
    """
    ddl, rows = {
        "scoreboard": (schemas.SCOREBOARD_DOC, SCOREBOARD_ROWS),
        "game": (f"{schemas.GAME_DOC}, game_id int", GAME_ROWS),
    }[kind]
    reader = spark.readStream.schema(ddl).option("multiLine", one_per_file)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.json(land).withColumn("source_path", F.col("_metadata.file_path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{kind}-{batch_id:06d}"
        done = lake.read("mlops", "stream_commit").where(
            (F.col("stream") == kind) & (F.col("batch_id") == batch_id))
        if not done.isEmpty():
            return
        load_raw(lake, batch, rows, run_id, at)
        load_stage(lake, run_id)
        load_gold(lake, at, run_id)
        if embedder is not None:
            embed_new(lake, embedder, F.lit(str(at)))
        lake.insert_ignore(spark.range(1).select(
            F.lit(kind).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"),
            F.lit(run_id).alias("run_id"), F.lit(str(at)).cast("timestamp_ntz").alias("committed_at")),
            "mlops", "stream_commit")

    return _run(stream, each, checkpoint)


def upsert_stream(stream: DataFrame, keys: list[str], order: list[str], path: str,
                  checkpoint: str) -> StreamingQuery:
    """Keep the newest row per key of a stream as one small delta per batch.

    A batch costs what it carries, not the size of the table, and a repeated batch
    overwrites its own delta. ``current_rows`` merges on read.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, order)
        newest.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _run(stream, each, checkpoint)


def current_rows(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key over all deltas; a late row loses against a newer one."""
    return latest_per_key(spark.read.parquet(path).drop("batch"), keys, order)


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str], to: str) -> None:
    """Fold the deltas into batch 0 of a fresh path."""
    current_rows(spark, path, keys, order).write.mode("overwrite").parquet(f"{to}/batch=0")
