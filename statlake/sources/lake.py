"""The lake: one Parquet directory per table below ``root/layer/table``.

A whole-table write goes to the next numbered snapshot directory and counts once
Spark has put its ``_SUCCESS`` file there; readers take the highest finished one,
so no path is overwritten while it is read. A block-partitioned table keeps one
snapshot and rewrites only the blocks a change touches. One writer per table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType

from statlake.operators import merge
from statlake.schemas import TABLES, Table
from statlake.sources.files import clustered

BLOCK = "key_block"
# Below every block number: a comparison that marks the touched blocks as a filter.
NO_BLOCK = -(1 << 31)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ reading

    def read(self, layer: str, name: str) -> DataFrame:
        """The current content; a table never written reads as an empty frame."""
        table = TABLES[layer, name]
        self._recover(table)
        return self._scan(table).select(*table.schema.fieldNames())

    def read_blocks(self, layer: str, name: str) -> DataFrame:
        """The table with its block number, for joins that are to read some blocks only."""
        table = TABLES[layer, name]
        self._recover(table)
        return self._scan(table)

    def block_of(self, layer: str, name: str) -> Column:
        """The block a row lies in, from its key columns."""
        return self._block(TABLES[layer, name])

    def read_near(self, layer: str, name: str, rows: DataFrame) -> DataFrame:
        """Only the blocks of a table that ``rows`` (with its key columns) fall into.

        Enough for any work on the same keys, such as an anti join or a key check.
        """
        table = TABLES[layer, name]
        self._recover(table)
        near = self._touched(self._scan(table), self._with_block(rows, table))
        return near.select(*table.schema.fieldNames())

    def exists(self, layer: str, name: str) -> bool:
        return self._current(TABLES[layer, name]) is not None

    def ensure(self, tables: list[Table] | None = None) -> None:
        """Create the missing tables empty; existing ones are left alone."""
        for t in tables or TABLES.values():
            if self._current(t) is None:
                self.replace(self.spark.createDataFrame([], t.schema), t.layer, t.name)

    # ------------------------------------------------------------ writing

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        """Add rows, matched to the table by name and cast to its types."""
        table = TABLES[layer, name]
        rows = self._with_block(merge.conform(df, table.schema), table)
        path = self._current(table) or self._snapshot(table, 1)
        self._writer(rows, table, "append").parquet(path)

    def replace(self, df: DataFrame, layer: str, name: str) -> None:
        """Write the whole table as a new snapshot."""
        table = TABLES[layer, name]
        rows = self._with_block(merge.conform(df, table.schema), table)
        path = self._snapshot(table, self._latest(table) + 1)
        self._writer(rows, table, "overwrite").parquet(path)

    def replace_run(self, df: DataFrame, layer: str, name: str, run_id: str) -> None:
        """Append the rows of a run; running again with the same id changes nothing.

        Raw tables keep one directory per run and this overwrites that directory,
        so a retried batch cannot double its rows.
        """
        table = TABLES[layer, name]
        if table.partition_by != ("run_id",):
            raise ValueError(f"{layer}.{name} is not kept per run")
        rows = merge.conform(df.withColumn("run_id", F.lit(run_id)), table.schema)
        path = self._current(table)
        if path is None:  # a directory-wise overwrite leaves no mark of a finished snapshot
            self.replace(rows, layer, name)
        else:
            (self._writer(rows, table, "overwrite")
             .option("partitionOverwriteMode", "dynamic").parquet(path))

    def upsert(self, df: DataFrame, layer: str, name: str, keys: list[str] | None = None) -> None:
        """Replace the rows with the source's keys, add the others.

        A block-partitioned table reads and rewrites only the touched blocks.
        """
        table = TABLES[layer, name]
        keys = list(keys or table.keys)
        source = merge.conform(df, table.schema)
        if self._current(table) is None:
            self.replace(source, layer, name)
            return
        # The source is read for its keys, its blocks and its rows; computing it may
        # be dear (chunks, vectors), so it is kept for the duration of the upsert.
        source = self._with_block(source, table).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if table.block_by is None:
                self.replace(merge.upsert(self.read(layer, name), source, keys), layer, name)
                return
            self._recover(table)
            target = self._touched(self._scan(table), source)
            merged = merge.upsert(target, source, keys)
            self._writer(merged, table, "overwrite").parquet(self._staged(table))
            self._recover(table)
        finally:
            source.unpersist()

    def insert_ignore(self, df: DataFrame, layer: str, name: str) -> None:
        """Append the rows whose key is not there yet (one row per key in ``df``)."""
        table = TABLES[layer, name]
        keys = list(table.keys)
        source = merge.conform(df, table.schema)
        self.append(source.join(self.read(layer, name).select(*keys), keys, "left_anti"),
                    layer, name)

    def upsert_cols(self, df: DataFrame, layer: str, name: str, cols: list[str]) -> None:
        table = TABLES[layer, name]
        source = merge.conform(df, table.schema)
        self.replace(merge.upsert_cols(self.read(layer, name), source, list(table.keys), cols),
                     layer, name)

    # ------------------------------------------------------------ layout

    def _base(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def _snapshot(self, table: Table, n: int) -> str:
        return f"{self._base(table)}/v={n:08d}"

    def _staged(self, table: Table) -> str:
        return f"{self._base(table)}/staged"

    def _with_block(self, df: DataFrame, table: Table) -> DataFrame:
        if table.block_by is None:
            return df
        return df.withColumn(BLOCK, self._block(table))

    @staticmethod
    def _block(table: Table) -> Column:
        # A key outside the numbering goes to block -1, as NULL would match no filter.
        block = F.floor(F.expr(table.block_by) / table.block_size).cast("int")
        return F.coalesce(block, F.lit(-1))

    def _writer(self, df: DataFrame, table: Table, mode: str):
        if table.block_by:
            # The write sorts by block in any case; the key behind it keeps row groups
            # narrow for filters and nearly sorted for later aggregates.
            rows = clustered(df, [BLOCK]).sortWithinPartitions(BLOCK, *table.keys)
            return rows.write.mode(mode).partitionBy(BLOCK)
        if table.partition_by:  # one value per write: rebalance by size alone
            return clustered(df, []).write.mode(mode).partitionBy(*table.partition_by)
        return df.write.mode(mode)

    def _scan(self, table: Table) -> DataFrame:
        path = self._current(table)
        schema = table.schema
        if table.block_by is not None:
            schema = schema.add(BLOCK, IntegerType())
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _touched(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """The rows of the blocks that the source falls into.

        The block numbers, no more than the table has directories or the source has blocks,
        are joined on the partition column: Spark skips the other directories when the query
        runs (dynamic partition pruning), and none of them passes through this program.
        """
        blocks = source.select(BLOCK).distinct().where(F.col(BLOCK) > NO_BLOCK)
        return target.join(F.broadcast(blocks), BLOCK, "left_semi").select(*target.columns)

    def _recover(self, table: Table) -> None:
        """Put finished staged blocks in place; safe to repeat after a lost run."""
        if table.block_by is None or not self._finished(self._staged(table)):
            return
        staged = self.spark.read.schema(self._scan(table).schema).parquet(self._staged(table))
        (self._writer(staged, table, "overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(self._current(table)))
        self.discard(self._staged(table))

    def _current(self, table: Table) -> str | None:
        n = self._latest(table)
        return self._snapshot(table, n) if n else None

    def _latest(self, table: Table) -> int:
        fs, base = self._fs(self._base(table))
        if not fs.exists(base):
            return 0
        found = [
            int(s.getPath().getName()[2:]) for s in fs.listStatus(base)
            if s.getPath().getName().startswith("v=")
        ]
        return next((n for n in sorted(found, reverse=True)
                     if self._finished(self._snapshot(table, n))), 0)

    def _finished(self, directory: str) -> bool:
        fs, marker = self._fs(f"{directory}/_SUCCESS")
        return fs.exists(marker)

    def discard(self, path: str) -> None:
        """Delete an intermediate folder of ours."""
        fs, folder = self._fs(path)
        fs.delete(folder, True)

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path
