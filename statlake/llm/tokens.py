"""Token ids in seekable files: one zstandard frame a document, a seek table at the end.

A file holds a range of doc_ids in ascending order (NULL first, rows of one doc_id by
text):

    one zstandard frame for each document: its ids, unsigned 32 bits, little endian
    a skippable frame (magic 0x184D2A50): doc_ids as int64, then one byte each, 1 = NULL
    a skippable frame (magic 0x184D2A5E): the seek table. For each document 12 bytes:
        size of its frame, size of its ids, low 32 bits of the ids' XXH64; then the
        number of frames (uint32), 0x80 (checksums are present), 0x8F92EAB1

A reader takes the last bytes, then the table, then only the frames it wants. A NULL text
is an empty one and yields the end id alone; repeated rows are written once each; an empty
table yields an empty manifest and no files. Columns but doc_id and text are not looked at.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from statlake.llm.common import in_small_batches, text_or_empty
from statlake.session import scratch_dir

#: Magic numbers of the zstandard seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CACHED_CHUNKS, LONGEST_CACHED = 600_000, 48
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85"
#: Words that are taken apart: letters that lower case one by one and that NFC leaves alone,
#: then marks. The character between units is of neither kind.
LETTER, MARK, BETWEEN = "[A-Za-zÀ-ÖØ-öø-ÿ]", r"[!-/:-@\[-`{-~]", "\0"
_LETTER, _MARK = re.compile(LETTER), re.compile(MARK)
_WORD, _MARKED = re.compile(f"({LETTER}+)({MARK}*)"), re.compile(f"{LETTER}*{MARK}*")

MANIFEST = "part int, file string, n_docs long, n_tokens long, first_id long, last_id long"


class Encoder:
    """Encodes whole texts; the ids of a chunk between white space are remembered.

    The vocabulary's own splitting never joins characters across white space, so the
    ids of a text are those of its chunks one after the other. A new chunk that is a word
    of Latin letters, perhaps with marks behind it, is taken apart: the vocabulary lowers
    case and cuts between letters and marks, so its ids are those of the word in lower case
    and those of the marks, which recur in many chunks. A second tokenizer with the same
    model encodes them, many at once, as there is nothing left to normalise or to split.
    Vocabularies for which a trial of all these characters shows otherwise go without.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {"": b""}
        self.plain = self._plain(path)

    def _plain(self, path: str):
        """The tokenizer of plain words and marks; None if the vocabulary treats them otherwise."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.plain.no_truncation()
        self.plain.no_padding()
        mark = self.plain.encode(BETWEEN, add_special_tokens=False).ids
        added = self.tokenizer.get_added_tokens_decoder().values()
        if len(mark) != 1 or any(_MARKED.fullmatch(t.content) for t in added):
            return None
        self.mark = mark[0]
        letters, marks = ([chr(i) for i in range(256) if p.fullmatch(chr(i))] for p in (_LETTER, _MARK))
        trial = [a + x + b for x in letters for a, b in zip(letters, itertools.cycle(marks))]
        trial += letters + [x + "".join(marks) for x in letters] + [f"b{a}{b}" for a in marks for b in marks]
        try:
            found = self._taken_apart([_WORD.fullmatch(c) for c in trial])
        except ValueError:
            found = []
        self.units = {"": b""}
        return self.plain if found == self._encode(trial) else None

    def _encode(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for lo in range(0, len(units), 100):
            joined = f" {BETWEEN} ".join(units[lo:lo + 100])
            ids = np.array(self.plain.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark)).tolist()
            out += [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)])]
        return out

    def _taken_apart(self, matches: list[re.Match]) -> list[bytes]:
        pairs = [(m[1].lower(), m[2]) for m in matches]
        if len(self.units) > CACHED_CHUNKS:
            self.units = {"": b""}
        new = list({u for pair in pairs for u in pair}.difference(self.units))
        self.units.update(zip(new, self._encode_units(new), strict=True))
        return [self.units[word] + self.units[marks] for word, marks in pairs]

    def _encode_new(self, chunks: list[str]) -> dict[str, bytes]:
        matches = [self.plain and len(c) <= LONGEST_CACHED and _WORD.fullmatch(c) for c in chunks]
        whole = [c for c, m in zip(chunks, matches) if not m]
        found = dict(zip(whole, self._encode(whole))) if whole else {}
        found.update(zip((c for c, m in zip(chunks, matches) if m), self._taken_apart([m for m in matches if m])))
        return found

    def ids(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACE):
            return self._encode([text])[0]
        chunks = text.split()
        parts = list(map(self.known.get, chunks))
        if None in parts:
            found = self._encode_new(list({c for c, p in zip(chunks, parts) if p is None}))
            if len(self.known) > CACHED_CHUNKS:
                self.known.clear()
            self.known.update((c, p) for c, p in found.items() if len(c) <= LONGEST_CACHED)
            parts = [found[c] if p is None else p for c, p in zip(chunks, parts)]
        return b"".join(parts)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, as it is kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _place(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
        else (fs.LocalFileSystem(), folder)


def _writer(folder: str, vocabulary: str, end_id: int, level: int):
    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        import zstandard

        part = TaskContext.get().partitionId()
        store, top = _place(folder)
        name = f"part-{part:06d}.zst"
        own = f"{top}/.{name}.{uuid.uuid4().hex}"
        pack = zstandard.ZstdCompressor(level=level).compress
        encode, end = encoder(vocabulary).ids, struct.pack("<I", end_id)
        table, ids, nulls, total, out = [], [], bytearray(), 0, None
        for batch in batches:
            if out is None and len(batch):
                out = store.open_output_stream(own)
            for missing, doc, text in zip(batch["missing"], batch["doc_id"], batch["text"]):
                raw = encode(text) + end
                frame = pack(raw)
                out.write(frame)
                table.append(struct.pack("<III", len(frame), len(raw),
                                         xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
                ids.append(doc)
                nulls.append(missing)
                total += len(raw) // 4
        if out is None:
            return
        names = np.array(ids, "<i8").tobytes() + bytes(nulls)
        out.write(struct.pack("<II", SKIPPABLE, len(names)) + names)
        entries = b"".join(table)
        out.write(struct.pack("<II", SEEK_TABLE, len(entries) + 9) + entries)
        out.write(struct.pack("<IBI", len(table), 0x80, SEEKABLE))
        out.close()
        # The file appears under its name in one step; a repeated task replaces it whole.
        store.move(own, f"{top}/{name}")
        yield pd.DataFrame({"part": [part], "file": [name], "n_docs": [len(ids)],
                            "n_tokens": [total], "first_id": [min(ids)], "last_id": [max(ids)]})

    return write


def write_tokens(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY,
                 end_id: int = END_ID, files: int | None = None, level: int = 1) -> str:
    """Encode all documents and write them below ``folder``; returns that folder.

    The rows are dealt by ranges of doc_id, so files are in order and of like size. The
    manifest (one row a file) is written by the same job: files without a row in it,
    such as those of a lost attempt, don't count.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store, top = _place(folder)
    store.create_dir(top, recursive=True)
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    rows = (
        in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .repartitionByRange(files, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .select(F.col("doc_id").isNull().cast("int").alias("missing"),
                F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text")
    )
    (rows.mapInPandas(_writer(folder, path, end_id, level), MANIFEST)
     .write.mode("overwrite").parquet(f"{folder}/manifest"))
    return folder


class TokenFile:
    """One file, opened at its end: the table is read, frames only when asked for."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{path}: no seek table")
        at = size - 9 - 12 * n
        table = np.frombuffer(self.file.read_at(12 * n, at), "<u4").reshape(n, 3)
        names = self.file.read_at(9 * n, at - 8 - 9 * n)
        self.sizes, self.checksums = table[:, :2].astype("i8"), table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))[:n]
        self.doc_ids = np.frombuffer(names[:8 * n], "<i8")
        self.nulls = np.frombuffer(names[8 * n:], "u1").astype(bool)

    def document(self, i: int, unpack) -> bytes:
        import xxhash

        size, raw_size = self.sizes[i]
        raw = unpack(self.file.read_at(int(size), int(self.starts[i])))
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[i]:
            raise ValueError(f"frame {i} does not match its checksum")
        return raw


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files, each with the number of ids before it."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row a file, hence a small window over all of them.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _reader(folder: str, with_ids: bool, wanted: list[int] | None):
    chosen = None if wanted is None else np.array(sorted(wanted), "i8")

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        store, top = _place(folder)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for name, before in zip(batch["file"], batch["before"]):
                file = TokenFile(store, f"{top}/{name}")
                counts = file.sizes[:, 1] // 4
                starts = before + np.cumsum(counts) - counts
                places = np.arange(len(counts))
                if chosen is not None:
                    places = places[np.isin(file.doc_ids, chosen) & ~file.nulls]
                for some in np.array_split(places, len(places) // 2000 + 1):
                    raws = [file.document(i, unpack) for i in some]
                    out = pd.DataFrame({
                        "doc_id": pd.array(np.where(file.nulls[some], 0, file.doc_ids[some]),
                                           dtype="Int64"),
                        "start": starts[some], "n_tokens": counts[some],
                        "ids_crc32": np.array([zlib.crc32(r) for r in raws], "i8")})
                    out.loc[file.nulls[some], "doc_id"] = pd.NA
                    if with_ids:
                        out["ids"] = [np.frombuffer(r, "<u4").astype("i4") for r in raws]
                    yield out

    return read


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None,
                with_ids: bool = False) -> DataFrame:
    """The documents in the files, or the given ones, each checked by its checksum.

    With ``doc_ids`` (a list for the caller's own use, hence small) files outside their
    range are skipped, and of the others only the frames asked for are decompressed.
    """
    files = manifest(spark, folder)
    if doc_ids is not None:
        lowest, highest = (min(doc_ids), max(doc_ids)) if doc_ids else (1, 0)
        files = files.where((F.col("first_id") <= highest) & (F.col("last_id") >= lowest))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return (files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
            .select("file", "before").mapInPandas(_reader(folder, with_ids, doc_ids), schema))
