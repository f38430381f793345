"""Vectors compressed to four code bytes: parts, codebooks, and dictionaries of values.

Every component x becomes the integer floor(1024 x); a vector is cut into ``PARTS`` equal
consecutive parts, and each part position has a codebook of ``ENTRIES`` entries. Codebooks
begin as the parts of the rows with the smallest ids and are replaced ``ROUNDS`` times by the
mean, rounded down, of the parts nearest to each entry.

Distances are not reckoned row by row. Vectors are stored once in blocks of up to ``BLOCK``
rows; a block holds, for every dimension, the dictionary of its distinct integers in order
and each row's place in it. For a codebook, the squared differences of every dictionary
integer to all entries of that dimension are tabulated; the distances of a part are then the
sum, over its dimensions, of the table rows its codes name. A pass reads the blocks and sends
on, for each task, one sum and one count an entry, never rows; codebooks (``ENTRIES`` times the
width of a vector) are all that the driver and a broadcast hold. Sums travel as limbs of
``LIMB`` bits, and where squared differences could leave 64 bits, tables hold Python's
integers, so that all arithmetic is exact for every finite component.

Results for odd input: rows whose vector is NULL or holds a NULL or a non-finite component are
dropped (a component beyond single precision is non-finite), and so are rows of another width
than the row with the smallest id. A width that 4 doesn't divide gives the first parts one component more. Fewer than ``ENTRIES`` rows make
codebooks of as many entries; rows with equal ids follow in the order of their vectors, a NULL
id comes last; repeated rows each count. Ties go to the lower entry. An error that does not fit
into a long is NULL. An empty table, or one without a usable row, gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statlake.llm.common import kept

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
#: Fixed value: the greatest number of single precision.
FINITE = float(np.finfo("f4").max)
BLOCK = 2048
LIMB, LIMBS = 40, 5
LONG = 1 << 63


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """_id, _label and _vector (doubles) of the rows without NULL or non-finite components."""
    finite = F.forall("_vector", lambda x: F.coalesce(F.abs(x) <= FINITE, F.lit(False)))
    return (rows.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"),
                        F.col(vector_col).cast("array<double>").alias("_vector"))
            .where(F.col("_vector").isNotNull() & finite))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x) as 64-bit integers, or as Python's where these are too small."""
    x = np.floor(vectors * SCALE)
    if not x.size or np.abs(x).max() < 2.0 ** 62:
        return x.astype("i8")
    return np.array([int(v) for v in x.flat], object).reshape(x.shape)


def cuts(width: int) -> list[slice]:
    at = np.cumsum([0, *[width // PARTS + (k < width % PARTS) for k in range(PARTS)]])
    return [slice(int(a), int(b)) for a, b in zip(at, at[1:])]


def encoded(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each dimension the distinct integers in order, and each row's place among them."""
    return [np.unique(x[:, d], return_inverse=True) for d in range(x.shape[1])]


def nearest(block: list[tuple[np.ndarray, np.ndarray]], codebook: np.ndarray, rows: int,
            parts: list[slice]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part of every row, and the squared distance of the row."""
    codes = np.zeros((rows, PARTS), "i8")
    ends = [abs(int(v)) for values, _ in block for v in (values[0], values[-1])]
    widest = max([0, *ends, int(np.abs(codebook).max()) if codebook.size else 0])
    # The greatest possible sum of squared differences decides what holds it.
    kind = "i8" if 4 * len(block) * widest ** 2 < LONG else object
    errors = np.zeros(rows, kind)
    for p, part in enumerate(parts):
        total = np.zeros((rows, len(codebook)), kind)
        for d in range(part.start, part.stop):
            values, places = block[d]
            table = (values.astype(kind)[:, None] - codebook[:, d].astype(kind)[None, :]) ** 2
            total += table[places]
        codes[:, p] = total.argmin(1)
        errors += total[np.arange(rows), codes[:, p]]
    return codes, errors


def sums(block: list[tuple[np.ndarray, np.ndarray]], codes: np.ndarray, entries: int,
         parts: list[slice]) -> np.ndarray:
    """The sums of the components of all parts by entry and dimension."""
    found = np.zeros((entries, len(block)), object)
    for p, part in enumerate(parts):
        for d in range(part.start, part.stop):
            values, places = block[d]
            # How often each dictionary integer meets each entry, times the integer.
            met = np.bincount(codes[:, p] * len(values) + places, minlength=entries * len(values))
            small = BLOCK * max(abs(int(values[0])), abs(int(values[-1]))) < LONG
            kind = "i8" if small else object
            found[:, d] = met.reshape(entries, len(values)).astype(kind) @ values.astype(kind)
    return found


def _dump(x: np.ndarray) -> str:
    return ",".join(map(str, x.tolist()))


def _load(text: str) -> np.ndarray:
    x = [int(v) for v in text.split(",")] if text else []
    return np.array(x, "i8" if all(abs(v) < 1 << 62 for v in x) else object)


BLOCKS = "ids array<long>, labels array<{label}>, dictionaries array<string>, places binary"


def stored(rows: DataFrame, width: int, label_type: str) -> DataFrame:
    """Blocks of rows: their ids and labels, dictionaries as decimal numbers, 16-bit places."""
    schema = BLOCKS.format(label=label_type)
    kinds = {f.name: f.type for f in _arrow(schema)}

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                flat = some["_vector"].flatten().to_numpy(zero_copy_only=False)
                block = encoded(integers(flat.reshape(some.num_rows, width)))
                places = (np.concatenate([p for _, p in block]) if width else np.zeros(0)).astype("<u2")
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([some["_id"].to_pylist()], kinds["ids"]),
                    "labels": pa.array([some["_label"].to_pylist()], kinds["labels"]),
                    "dictionaries": pa.array([[_dump(v) for v, _ in block]], kinds["dictionaries"]),
                    "places": pa.array([places.tobytes()], pa.binary())})

    return kept(rows.mapInArrow(pack, schema), "codes")


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    for batch in batches:
        for row in batch.to_pylist():
            places = np.frombuffer(row["places"], "<u2").astype("i8").reshape(
                len(row["dictionaries"]), len(row["ids"]))
            yield row["ids"], row["labels"], [(_load(v), p) for v, p in zip(row["dictionaries"], places)]


def _limbs(value: int) -> list[int]:
    """A number as signed limbs, lowest first; equal places may be summed."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def refined(blocks: DataFrame, codebook: np.ndarray) -> np.ndarray:
    """The codebook after one round; entries that no part is nearest to stay."""
    entries, width = codebook.shape
    parts = cuts(width)
    shared = blocks.sparkSession.sparkContext.broadcast(codebook)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook = shared.value
        total, used = np.zeros((entries, width), object), np.zeros((entries, PARTS), "i8")
        for ids, _, block in _blocks(batches):
            codes, _ = nearest(block, codebook, len(ids), parts)
            total += sums(block, codes, entries, parts)
            for p in range(PARTS):
                used[:, p] += np.bincount(codes[:, p], minlength=entries)
        out = [(e, d, *_limbs(int(total[e, d])), int(used[e, p]))
               for p, part in enumerate(parts) for d in range(part.start, part.stop)
               for e in np.flatnonzero(used[:, p])]
        columns = ["entry", "dim", *[f"limb{k}" for k in range(LIMBS)], "n"]
        yield pa.RecordBatch.from_pydict(
            {c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(columns)})

    names = [f"limb{k}" for k in range(LIMBS)]
    found = (blocks.mapInArrow(add, ", ".join(f"{c} long" for c in ["entry", "dim", *names, "n"]))
             .groupBy("entry", "dim").agg(*[F.sum(c).alias(c) for c in [*names, "n"]]))
    new = codebook.astype(object)
    # Entries times width rows at most.
    for row in found.collect():
        total = sum(row[c] << LIMB * k for k, c in enumerate(names))
        new[row["entry"], row["dim"]] = total // row["n"]
    return new if any(abs(v) >= 1 << 62 for v in new.flat) else new.astype("i8")


def fingerprint(codebook: np.ndarray) -> str:
    flat = [str(v) for part in cuts(codebook.shape[1]) for v in codebook[:, part].flat]
    return hashlib.sha256(",".join(flat).encode()).hexdigest()


def compressed(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """vec_id, label, code and error of all usable rows, and the codebooks (entries x width)."""
    spark = rows.sparkSession
    label_type = rows.schema[label_col].dataType.simpleString()
    out = f"vec_id long, label {label_type}, code string, error long"
    some = usable(rows, id_col, vector_col, label_col)
    by_id = F.asc_nulls_last("_id"), F.col("_vector")
    first = some.orderBy(*by_id).limit(1).collect()
    if not first:
        return spark.createDataFrame([], out), None
    width = len(first[0]["_vector"])
    some = some.where(F.size("_vector") == width)
    begin = [r["_vector"] for r in some.orderBy(*by_id).limit(ENTRIES).collect()]
    codebook = integers(np.array(begin, "f8").reshape(len(begin), width))
    blocks = stored(some, width, label_type)
    for _ in range(ROUNDS):
        codebook = refined(blocks, codebook)
    parts = cuts(width)
    shared = spark.sparkContext.broadcast(codebook)
    kinds = _arrow(out)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, block in _blocks(batches):
            codes, errors = nearest(block, shared.value, len(ids), parts)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, kinds.field("vec_id").type), pa.array(labels, kinds.field("label").type),
                pa.array([bytes(c).hex() for c in codes.astype("u1")]),
                pa.array([int(e) if e < LONG else None for e in errors], pa.int64())], schema=kinds)

    return blocks.mapInArrow(code, out), codebook


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error`` beside the coded rows: the sum of error over equal labels, NULLs together.

    NULL if the sum, or an error of the label, does not fit into a long. Sums are made in the
    tasks first and written, so that Spark knows their size when it chooses the join; adaptive
    execution splits a label that holds many rows.
    """
    coded = kept(coded, "coded")
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    by_label = kept(coded.groupBy(F.col("label").alias("_label")).agg(
        total.try_cast("long").alias("label_error")), "label-errors")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
