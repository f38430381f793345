"""Exact cosine top-k: block products inside tasks, ranking in Spark.

A few queries travel to the tasks as one matrix of a checked size, and the corpus stays
where it is. Any number of queries takes the two-sided block product: corpus and queries are
dealt into groups, every group of the one meets every group of the other in a task, which
holds its corpus rows (a bounded number) and streams its queries past them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Queries of at most so many values (about 16 MB) travel to the tasks as one matrix.
SLICE_VALUES = 2_000_000
# Values of a group of corpus rows (about 64 MB), and scores that a task has at once.
GROUP_VALUES, MET_VALUES = 8_000_000, 1_000_000
# Pairs that a task meets, and so many where there would be more than MANY_TASKS tasks.
TASK_PAIRS, MOST_PAIRS, MANY_TASKS = 2**29, 2**32, 64
# So many queries are multiplied with a batch at once.
QUERIES_AT_ONCE = 256


def cosine_top_k(queries: DataFrame, corpus: DataFrame, k: int, id_col: str = "id",
                 vector_col: str = "values", query_id: str = "query_id",
                 query_vector: str = "values", digits: int = 9) -> DataFrame:
    """For every query the ``k`` most similar corpus rows: query_id, rank, id, score.

    Scores are rounded to ``digits`` before ranking and equal scores rank by id,
    so results do not depend on partitioning. NULL vectors and vectors of length
    zero have no direction and never match; a vector of another width than the
    queries', or with a NULL in it, is an error.

    Up to ``SLICE_VALUES`` values of queries are one broadcast matrix: each task multiplies
    its corpus rows with it and keeps k rows per query, and the corpus is not shuffled.
    Beyond that see ``block_top_k``; the results are the same.
    """
    q, c, n, width, out = _sides(queries, corpus, id_col, vector_col, query_id, query_vector)
    if n * width <= SLICE_VALUES:
        return _ranked(_by_matrix(q.collect(), c, k, digits, out), k)
    return _ranked(_by_blocks(q, n, c, width, k, digits, out), k)


def block_top_k(queries: DataFrame, corpus: DataFrame, k: int, id_col: str = "id",
                vector_col: str = "values", query_id: str = "query_id",
                query_vector: str = "values", digits: int = 9) -> DataFrame:
    """``cosine_top_k`` for any number of queries; no vector passes through the driver.

    Each corpus row is shuffled once for each group of queries, and each query once for each
    group of corpus rows; the number of groups grows with the root of the number of pairs, so
    that tasks of bounded work share out the pairs. A task sorts its corpus rows before the
    queries, so it holds the former and sees the latter batch by batch; k rows per query and
    group go on to the ranking.
    """
    q, c, n, width, out = _sides(queries, corpus, id_col, vector_col, query_id, query_vector)
    return _ranked(_by_blocks(q, n, c, width, k, digits, out), k)


def _sides(queries, corpus, id_col, vector_col, query_id, query_vector):
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("_v")).where(
        F.col("_v").isNotNull())
    n, width = q.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_v")), F.lit(0))).first()
    c = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("_v")).where(
        F.col("_v").isNotNull())
    out = StructType().add(q.schema["query_id"]).add(c.schema["id"]).add("score", "double")
    return _whole(q, width), _whole(c, width), n, width, out


def _whole(df: DataFrame, width: int) -> DataFrame:
    """The frame, which fails on a vector of another width or with a NULL in it."""
    bad = (F.size("_v") != width) | F.exists("_v", lambda x: x.isNull())
    error = F.raise_error(F.lit(f"a vector is not {width} numbers")).cast(df.schema["_v"].dataType)
    return df if width == 0 else df.withColumn("_v", F.when(bad, error).otherwise(F.col("_v")))


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (
        candidates.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _by_matrix(head, corpus: DataFrame, k: int, digits: int, out: StructType) -> DataFrame:
    if not head:
        return corpus.sparkSession.createDataFrame([], out)
    ids = [r.query_id for r in head]
    shared = corpus.sparkSession.sparkContext.broadcast(_unit([r._v for r in head]))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        kept = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = _best(matrix, batch.column("id"), batch.column("_v"), k, digits)
            kept = found if kept is None else _merge(kept, found, k)
        if kept is not None:
            yield _emit(kept, ids, out)

    return corpus.mapInArrow(best_of_task, out)


def _groups(queries: int, rows: int, width: int) -> tuple[int, int]:
    """Into how many groups corpus and queries are dealt."""
    pairs = queries * rows
    tasks = -(-pairs // TASK_PAIRS)
    if tasks > MANY_TASKS:
        tasks = max(MANY_TASKS, -(-pairs // MOST_PAIRS))
    held = max(1, -(-rows * max(width, 1) // GROUP_VALUES), math.isqrt(tasks // 2))
    return held, max(1, -(-tasks // held))


def _by_blocks(q: DataFrame, n: int, c: DataFrame, width: int, k: int, digits: int, out: StructType) -> DataFrame:
    held, streamed = _groups(n, c.count(), width)
    query_type, id_type = (out[i].dataType for i in (0, 1))
    kinds = {df.schema["_v"].dataType.simpleString() for df in (q, c)}
    values = F.col("_v") if kinds == {"array<float>"} else F.col("_v").cast("array<double>").alias("_v")

    def dealt(df: DataFrame, own: int, other: int, cell, kind: int, *cols) -> DataFrame:
        """The rows, each in the cells of its own group and all groups of the other side."""
        group = F.pmod(F.xxhash64(*df.columns), F.lit(own))
        return df.select(group.alias("a"), *cols, values, F.lit(kind).alias("kind")).withColumn(
            "b", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).select(
            cell.cast("int").alias("cell"), "kind", "query_id", "id", "_v")

    rows = dealt(c, held, streamed, F.col("a") * streamed + F.col("b"), 0,
                 F.lit(None).cast(query_type).alias("query_id"), "id")
    asked = dealt(q, streamed, held, F.col("b") * streamed + F.col("a"), 1,
                  "query_id", F.lit(None).cast(id_type).alias("id"))
    # By id, so that of equal scores the one met first stays.
    cells = rows.unionByName(asked).repartitionById(held * streamed, F.col("cell")).sortWithinPartitions(
        "cell", "kind", F.col("id").asc_nulls_last())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, unit, names = None, [], None, None
        for batch in batches:
            at = np.asarray(batch.column("cell")) * 2 + np.asarray(batch.column("kind"))
            ends = [*(np.flatnonzero(np.diff(at)) + 1), len(at)] if len(at) else []
            for start, end in zip([0, *ends], ends):
                some = batch.slice(start, end - start)
                if at[start] % 2 == 0:
                    if cell != at[start] // 2:
                        cell, held, unit = at[start] // 2, [], None
                    held.append((some.column("id"), _matrix(some.column("_v"))))
                elif cell == at[start] // 2:
                    if unit is None:
                        names = pa.concat_arrays([i for i, _ in held])
                        unit, held = _unit(np.concatenate([m for _, m in held])), []
                    for first in range(0, some.num_rows, QUERIES_AT_ONCE):
                        part = some.slice(first, QUERIES_AT_ONCE)
                        asks, hits, scores = _nearest(_unit(_matrix(part.column("_v"))), unit, k, digits)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("query_id").take(pa.array(asks)), names.take(pa.array(hits)),
                             pa.array(scores)], schema=to_arrow_schema(out))

    return cells.mapInArrow(meet, out)


def _nearest(asked: np.ndarray, rows: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the best k rows, of equal scores the first: numbers of query and row, and scores.

    Once a query has k rows, a score counts only if it is above the least of them.
    """
    near = 0.6 * 10.0 ** -digits  # what rounding can add, and a little more
    floor = np.full(len(asked), -np.inf)
    kept = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    step = max(k, MET_VALUES // len(asked))
    for first in range(0, len(rows), step):
        scores = asked @ rows[first:first + step].T
        if first == 0 and scores.shape[1] > k:
            # Vectors without a direction score NaN, which no comparison lets through.
            known = np.where(np.isnan(scores), -np.inf, scores)
            least = np.partition(known, known.shape[1] - k, axis=1)[:, known.shape[1] - k]
            ask, hit = np.nonzero((scores >= (least - 2 * near)[:, None]))
        else:
            ask, hit = np.nonzero(scores > (floor - near)[:, None])
        found = np.round(scores[ask, hit], digits)
        above = found > floor[ask]
        if not above.any():
            continue
        both = [np.concatenate(x) for x in zip(kept, (ask[above], hit[above] + first, found[above]))]
        order = np.lexsort((both[1], -both[2], both[0]))
        ask, hit, found = (x[order] for x in both)
        rank = np.arange(len(ask)) - np.searchsorted(ask, ask)
        kept = tuple(x[rank < k] for x in (ask, hit, found))
        full = rank == k - 1
        floor[ask[full]] = found[full]
    return kept


def _matrix(vectors: pa.Array) -> np.ndarray:
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def _names(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.to_pylist() if pa.types.is_string(ids.type) else ids)


def _unit(vectors) -> np.ndarray:
    rows = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.full_like(rows, np.nan), where=norms > 0)


def _best(matrix: np.ndarray, ids: pa.Array, vectors: pa.Array, k: int, digits: int) -> list:
    """Per query (scores, ids) of the best k rows of one batch."""
    rows = _matrix(vectors)
    norms = np.linalg.norm(rows, axis=1)
    names = _names(ids)
    found = []
    with np.errstate(invalid="ignore", divide="ignore"):
        unit = (rows / norms[:, None]).T
        for start in range(0, len(matrix), QUERIES_AT_ONCE):
            scores = np.round(matrix[start:start + QUERIES_AT_ONCE] @ unit, digits)
            found += [_cut(s, names, k) for s in scores]
    return found


def _cut(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    scored = ~np.isnan(scores)
    scores, ids = scores[scored], ids[scored]
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = scores >= floor
        scores, ids = scores[above], ids[above]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _merge(kept: list, found: list, k: int) -> list:
    return [
        _cut(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), k)
        for a, b in zip(kept, found)
    ]


def _emit(kept: list, ids: list, out: StructType) -> pa.RecordBatch:
    query = [ident for ident, (s, _) in zip(ids, kept) for _ in range(len(s))]
    hit = [x for _, h in kept for x in h.tolist()]
    score = np.concatenate([s for s, _ in kept])
    schema = to_arrow_schema(out)
    return pa.RecordBatch.from_arrays(
        [pa.array(query, schema.field(0).type), pa.array(hit, schema.field(1).type),
         pa.array(score)], schema=schema)
