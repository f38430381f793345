"""Suffix-array deduplication: bytes of 100-byte strings that also start earlier are removed.

Whole texts are too many suffixes to sort, so strings that occur once are set aside first:
every 100-byte string has an anchor, the 22-byte string in it with the least hash (the first
of equal ones). Equal strings have equal anchors at equal places, so only strings whose anchor
occurs twice can recur. The starts of neighbouring strings with one anchor are one run; a run's
bytes are a piece of 178 bytes at most. Pieces meet by anchor and are sorted by suffixes in two
stages (suffixes.py); neighbours with a common prefix of 100 bytes are equal strings, and all
but the earliest of them are covered. Documents equal to an earlier one are covered as a whole.

Hot anchors: a task sends few rows of an anchor and says how many it has left; runs of anchors
with more than ``MOST_RUNS`` occurrences are dealt to many tasks, each of which finds its own
earliest strings, and the earliest of these are found by a hash of the string. Equal pieces
of one task are sent once.

Results for odd input: a NULL text is empty; texts under 100 bytes stay whole; matches never
cross documents; NULL doc_ids come first; rows that repeat doc_id and text are one document
and get equal results; rows of one doc_id with different texts are documents in the order of
their hashes, and so are rows without a doc_id (dealt by the hash); an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from statlake.llm.common import mixed, text_or_empty
from statlake.llm.shingles import powers
from statlake.llm.suffixes import REACH, equal_neighbours, suffix_order

ANCHOR = 22
SPAN = REACH - ANCHOR + 1
#: Bytes that are hashed at once; places inside take 20 bits.
BUFFER = 1_000_000
LEFT_AFTER, MOST_RUNS = 16, 4096
#: The low 48 bits of an anchor's hash are dealt: equal parts of others are told apart by their
#: bytes. They stand above 16 zero bits, which compress together with the row's zeros before them.
KEY_SHIFT = np.uint64(16)
SALTS = 256
PIECES_AT_ONCE, REMEMBERED = 12_000, 150_000

NORMAL, KNOWN, LEFT = 0, 1, 2


def _buffers(texts: list[bytes]):
    """Texts in buffers: the joined bytes, and number, offset and place of each part."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for lo in range(0, max(len(text) - REACH + 1, 0), BUFFER - REACH):
            part = text[lo:lo + BUFFER - 1]
            if size + len(part) > BUFFER and parts:
                yield parts
                parts, size = [], 0
            parts.append((i, lo, part))
            size += len(part)
    if parts:
        yield parts


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """number of the text, first start, number of starts and anchor hash of each run."""
    out = [[np.zeros(0, "i8")] * 3 + [np.zeros(0, "u8")]]
    for parts in _buffers(texts):
        data = np.frombuffer(b"".join(p for _, _, p in parts), "u1")
        n = len(data)
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, "u8")
        np.cumsum((data.astype("u8") + np.uint64(1)) * up[:n], dtype="u8", out=sums[1:])
        grams = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[:n - ANCHOR + 1])
        least = (grams & ~np.uint64(0xFFFFF)) | np.arange(len(grams), dtype="u8")
        width = 1
        while width * 2 <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < SPAN:
            least = np.minimum(least[:len(least) - (SPAN - width)], least[SPAN - width:])
        anchor = (least & np.uint64(0xFFFFF)).astype("i8")
        lengths = np.array([len(p) for _, _, p in parts])
        starts = np.cumsum(lengths) - lengths
        inside = np.zeros(n + 1, "i4")
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + lengths - REACH + 1, -1)
        at = np.flatnonzero(np.cumsum(inside[:len(anchor)]) > 0)
        mine = anchor[at]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(mine) != 0)
        first = np.flatnonzero(new)
        part = np.searchsorted(starts, at[first], "right") - 1
        out.append([np.array([i for i, _, _ in parts])[part],
                    at[first] - starts[part] + np.array([lo for _, lo, _ in parts])[part],
                    np.diff(np.append(first, len(at))), grams[mine[first]]])
    return tuple(np.concatenate(x) for x in zip(*out))


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _find_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    count = 0

    def flush():
        key, doc, tag, loc = (np.concatenate(x) for x in zip(*held))
        key <<= KEY_SHIFT
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        first = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] ^ np.uint64(1)) != 0)
        n = np.diff(np.append(first, len(key)))
        hot = n >= LEFT_AFTER
        kind = np.empty(len(key), "i1")
        kind[order] = np.repeat(np.where(hot, KNOWN, NORMAL), n)
        at = order[first[hot]]
        # The rows stay in order of documents, in which neighbours have most bytes in common.
        yield _table(
            key=np.concatenate([key, key[at]]).view("i8"), doc=np.concatenate([doc, np.zeros(len(at), "i8")]),
            tag=np.concatenate([tag, np.zeros(len(at), "i4")]), loc=np.concatenate([loc, n[hot]]),
            kind=np.concatenate([kind, np.full(len(at), LEFT, "i1")]))

    for batch in batches:
        some = batch.filter(pc.invert(batch["copy"]))
        ids, tags = some["doc"].to_numpy(), some["tag"].to_numpy()
        number, start, n, key = runs(_texts(some["text"]))
        if len(number):
            held.append((key, ids[number], tags[number], (start << 8) | n))
            count += len(number)
        if count > 1_000_000:
            yield from flush()
            held, count = [], 0
    if held:
        yield from flush()


def _recurring(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of one task, which hold all of each anchor: those that occur again."""
    rows = [[b[c].to_numpy() for c in ("key", "doc", "tag", "loc", "kind")] for b in batches]
    if not rows:
        return
    key, doc, tag, loc, kind = (np.concatenate(x) for x in zip(*rows))
    known = kind == KNOWN
    own = np.flatnonzero(~known)
    own = own[np.argsort(key[own], kind="stable")]
    k = key[own]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, "i8")
    left = kind[own] == LEFT
    weight = np.where(left, loc[own], 1)
    total = np.add.reduceat(weight, first) if len(first) else weight
    n = np.diff(np.append(first, len(k)))
    split = (np.add.reduceat(left, first) > 0) | (total > MOST_RUNS) if len(first) else left
    stay = np.repeat(total > 1, n) & ~left
    places = np.concatenate([np.flatnonzero(known), own[stay]])
    dealt = np.concatenate([np.ones(known.sum(), bool), np.repeat(split, n)[stay]])
    for lo in range(0, len(places), 200_000):
        p = places[lo:lo + 200_000]
        yield _table(key=key[p], doc=doc[p], tag=tag[p], loc=loc[p], split=dealt[lo:lo + 200_000])


def _cut_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each run. Of equal pieces in a task, the later ones are covered.

    The documents of a task come in ascending order, so the first piece is the earliest.
    """
    seen: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    for batch in batches:
        lists = batch["runs"]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        locs, keys, splits, owners = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("loc", "key", "split", "tag"))
        ids, tags = batch["doc"].to_numpy(), batch["tag"].to_numpy()
        out: list[list] = [[], [], [], [], [], []]
        for i, text in enumerate(_texts(batch["text"])):
            lo, hi = offsets[i], offsets[i + 1]
            order = lo + np.argsort(locs[lo:hi], kind="stable")
            order = order[owners[order] == tags[i]]
            start, n = locs[order] >> 8, locs[order] & 0xFF
            for key, loc, s, m, split in zip(keys[order].tolist(), locs[order].tolist(), start.tolist(),
                                             n.tolist(), splits[order].tolist()):
                piece = text[s:s + m + REACH - 1]
                place = int(ids[i]), int(tags[i]), loc
                first = seen.get((key, piece))
                if first == place:  # a repeated row
                    continue
                if first is not None:
                    piece = None
                elif len(seen) < REMEMBERED:
                    seen[key, piece] = place
                for into, x in zip(out, (key, *place, split, piece)):
                    into.append(x)
        yield _table(key=pa.array(out[0], pa.int64()), doc=pa.array(out[1], pa.int64()),
                     tag=pa.array(out[2], pa.int32()), loc=pa.array(out[3], pa.int64()),
                     split=pa.array(out[4], pa.bool_()), piece=pa.array(out[5], pa.binary()))


def _classes(key: np.ndarray, doc: np.ndarray, tag: np.ndarray, loc: np.ndarray, split: np.ndarray, pieces: list[bytes]):
    """Covered runs (doc, tag, loc with its length) and the earliest strings of split anchors."""
    import xxhash

    order = np.lexsort((loc, tag, doc, tag > 0))
    first_of: dict[tuple[int, bytes], int] = {}
    covered = [i for i in order.tolist() if first_of.setdefault((key[i].item(), pieces[i]), i) != i]
    firsts_ = [first_of[key[i].item(), pieces[i]] for i in covered]
    # Rows of one place are a repeated row, not a repeat.
    covered = [i for i, f in zip(covered, firsts_) if (doc[i], tag[i], loc[i]) != (doc[f], tag[f], loc[f])]
    unique = np.array(list(first_of.values()))  # in order of documents and places
    _, group, size = np.unique(key[unique], return_inverse=True, return_counts=True)
    unique = unique[(size[group] > 1) | split[unique]]
    out_doc, out_tag, out_loc = [doc[covered]], [tag[covered]], [loc[covered]]
    earliest = (np.zeros(0, "i8"), np.zeros(0, "i4"), np.zeros(0, "i8"), [])
    if len(unique):
        gap = bytes(104)
        data = np.frombuffer(b"".join(pieces[i] + gap for i in unique), "u1")
        length = np.array([len(pieces[i]) for i in unique])
        base = np.cumsum(length + 104) - length - 104
        n = loc[unique] & 0xFF
        which = np.repeat(np.arange(len(unique)), n)
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wanted = base[which] + shift
        ends = np.zeros(len(data), "i8")
        ends[wanted] = (base + length)[which]
        sorted_ = suffix_order(data, ends, wanted)
        head = np.concatenate([[True], ~equal_neighbours(data, sorted_)])
        # Pieces are in order of documents, so the least place of equal strings is the earliest.
        firsts = np.minimum.reduceat(sorted_, np.flatnonzero(head))
        least = np.repeat(firsts, np.diff(np.append(np.flatnonzero(head), len(sorted_))))
        later = np.sort(sorted_[sorted_ != least])
        w = np.searchsorted(wanted, later)
        new = np.ones(len(w), bool)
        new[1:] = (np.diff(w) != 1) | (np.diff(which[w]) != 0)
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, len(w)))
        piece, s = which[w[at]], shift[w[at]]
        begin = loc[unique][piece]
        out_doc.append(doc[unique][piece])
        out_tag.append(tag[unique][piece])
        out_loc.append((begin & ~0xFF) + (s << 8) + run)
        mine = np.searchsorted(wanted, np.sort(firsts))
        mine = mine[split[unique][which[mine]]]
        if len(mine):
            begin = loc[unique][which[mine]]
            earliest = (doc[unique][which[mine]], tag[unique][which[mine]], (begin & ~0xFF) + (shift[mine] << 8) + 1,
                        [xxhash.xxh3_128_digest(data[p:p + REACH].tobytes()) for p in wanted[mine]])
    return np.concatenate(out_doc), np.concatenate(out_tag), np.concatenate(out_loc), earliest


def _sort_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of key. A batch ends with a key, unless the key is split."""
    held: list[pa.RecordBatch] = []

    def settle(rows: pa.Table):
        key, doc, tag, loc = (rows[c].to_numpy() for c in ("key", "doc", "tag", "loc"))
        split = rows["split"].to_numpy()
        d, t, l, (rd, rt, rl, rh) = _classes(key, doc, tag, loc, split, rows["piece"].to_pylist())
        yield _table(doc=np.concatenate([d, rd]), tag=np.concatenate([t, rt]), loc=np.concatenate([l, rl]),
                     string=pa.array([None] * len(d) + rh, pa.binary()))

    for batch in batches:
        some = batch.filter(pc.is_null(batch["piece"]))
        if len(some):
            yield _table(doc=some["doc"], tag=some["tag"], loc=some["loc"], string=pa.nulls(len(some), pa.binary()))
        held.append(batch.filter(pc.is_valid(batch["piece"])))
        while sum(map(len, held)) > PIECES_AT_ONCE:
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows["key"].to_numpy()
            ends = np.flatnonzero(np.diff(key)) + 1
            fit = ends[ends <= PIECES_AT_ONCE]
            if len(fit):
                cut = int(fit[-1])
            elif rows["split"][0].as_py():
                cut = PIECES_AT_ONCE
            elif len(ends):
                cut = int(ends[0])
            else:
                break
            yield from settle(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
    if sum(map(len, held)):
        yield from settle(pa.Table.from_batches(held))


def _settle_split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal strings found earliest by different tasks, all but the earliest are covered.

    Rows come in order of string, document and place.
    """
    last = first = None
    for batch in batches:
        rows = zip(batch["string"].to_pylist(), batch["doc"].to_pylist(), batch["tag"].to_pylist(), batch["loc"].to_pylist())
        stay = np.zeros(len(batch), bool)
        for i, (s, *place) in enumerate(rows):
            if s is None or s != last:
                stay[i], last, first = s is None, s, place
            else:
                stay[i] = place != first
        some = batch.filter(pa.array(stay))
        yield _table(doc=some["doc"], tag=some["tag"], loc=some["loc"])


def _removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tags, copies, lists = batch["tag"].to_numpy(), batch["copy"].to_pylist(), batch["covered"].to_pylist()
        out: list[list] = [[], [], [], []]
        for text, tag, copy, found in zip(_texts(batch["text"]), tags, copies, lists):
            spans = []
            if copy and len(text) >= REACH:
                spans = [(0, len(text))]
            elif found:
                loc = np.sort(np.array([f["loc"] for f in found if f["tag"] == tag], "i8"))
                start, n = loc >> 8, loc & 0xFF
                stop = np.maximum.accumulate(start + n - 1 + REACH) if len(loc) else start
                new = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]])) if len(loc) else start
                spans = list(zip(start[new].tolist(), stop[np.append(new[1:], len(loc)) - 1].tolist())) if len(loc) else []
            rest, at = [], 0
            for s, e in spans:
                rest.append(text[at:s])
                at = e
            left = b"".join(rest) + text[at:]
            for into, x in zip(out, (len(text), len(text) - len(left), len(spans), left)):
                into.append(x)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "n_bytes": pa.array(out[0], pa.int64()), "n_removed": pa.array(out[1], pa.int64()),
            "n_spans": pa.array(out[2], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in out[3]], pa.string()),
            "kept": pa.array(out[3], pa.binary())})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The texts are dealt once, by document: all three uses of them read the same shuffle,
    # so they ask for the same columns, and all else is worked out behind it.
    # A text without a doc_id goes by its hash, so that such texts are dealt to all tasks.
    none = F.col("doc_id").cast("long").isNull()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty())).alias("doc"),
                       (~none).alias("named"), text_or_empty().alias("text"))
    dealt = rows.repartition(n, "doc")
    # Texts of one doc_id are numbered, almost always by 1, which takes little room in a shuffle; 0: no doc_id.
    rank = F.dense_rank().over(W.partitionBy("doc").orderBy(F.xxhash64("text")))
    tagged = dealt.withColumn("tag", F.when(F.col("named"), rank).otherwise(0))
    # Copies: only hashes of the texts are dealt. Texts without a doc_id come first.
    hashed = rows.select("doc", "named", F.struct("named", "doc").alias("at"), F.md5("text").alias("hash"))
    earliest = hashed.groupBy("hash").agg(F.min("at").alias("least"), F.max("at").alias("most")).where("least < most")
    copies = hashed.join(earliest, "hash").where("at > least").groupBy("doc").agg(F.collect_set("hash").alias("_hashes"))
    texts = tagged.join(copies, "doc", "left").select(
        "doc", "tag", "text", F.coalesce(
            (F.col("tag") > 0) & F.array_contains("_hashes", F.md5("text")), F.lit(False)).alias("copy"))

    found = texts.select("doc", "tag", "text", "copy").mapInArrow(_find_runs, "key long, doc long, tag int, loc long, kind byte")
    route = F.when(F.col("kind") == KNOWN, F.xxhash64("doc", "loc")).otherwise(F.col("key"))
    recurring = found.repartition(n, route).mapInArrow(_recurring, "key long, doc long, tag int, loc long, split boolean")
    lists = recurring.groupBy("doc").agg(F.collect_list(F.struct("loc", "key", "split", "tag")).alias("runs"))

    ordered = tagged.join(lists, "doc").select("doc", "tag", "text", "runs").sortWithinPartitions(F.col("tag") > 0, "doc", "tag")
    pieces = ordered.mapInArrow(
        _cut_pieces, "key long, doc long, tag int, loc long, split boolean, piece binary")
    route = (F.when(F.col("piece").isNull(), F.xxhash64("doc", "loc"))
             .when(F.col("split"), F.xxhash64("key", F.pmod("doc", F.lit(SALTS)))).otherwise(F.col("key")))
    sorted_ = pieces.repartition(n, route).sortWithinPartitions("key").mapInArrow(
        _sort_pieces, "doc long, tag int, loc long, string binary")
    route = F.when(F.col("string").isNull(), F.xxhash64("doc", "loc")).otherwise(F.xxhash64("string"))
    covered = (sorted_.repartition(n, route).sortWithinPartitions("string", F.col("tag") > 0, "doc", "tag", "loc")
               .mapInArrow(_settle_split, "doc long, tag int, loc long")
               .groupBy("doc").agg(F.collect_list(F.struct("loc", "tag")).alias("covered")))
    ids = F.when(F.col("tag") > 0, F.col("doc")).alias("doc_id")
    return texts.join(covered, "doc", "left").select(ids, "tag", "text", "copy", "covered").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
