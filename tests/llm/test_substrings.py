import hashlib
import random

import numpy as np
import pytest

from statlake.llm import substrings as S
from statlake.llm.suffixes import REACH, equal_neighbours, suffix_order


def brute(docs):
    """docs: (id, text) in order; the result by doc_id."""
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        cov = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                cov[p:p + 100] = b"\1" * 100
            else:
                seen.add(b[p:p + 100])
        kept = bytes(x for x, c in zip(b, cov) if not c)
        spans = sum(1 for j in range(len(b)) if cov[j] and (j == 0 or not cov[j - 1]))
        out.append((i, len(b), sum(cov), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed=3, n=60, alphabet="ab "):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randint(30, 60))) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared))
        out.append("é".join(parts))
    return out + out[:5] + ["", None, "a" * 99, "a" * 100, "a" * 350, "a" * 101, "ab" * 200, "\0" * 150, "x" + "\0" * 150]


def check(df, docs):
    got = {r["doc_id"]: (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}
    wanted = brute(docs)
    assert [got[i] for i, *_ in docs] == wanted
    assert sum(w[2] for w in wanted) > 0


def test_same_as_brute_force(make):
    t = texts()
    check(S.remove_repeats(make(t)), list(enumerate(t)))


def test_split_anchors_and_small_batches(make, monkeypatch):
    """Hot anchors are dealt to many tasks, and batches are cut inside their rows."""
    script = S.__dict__
    t = texts(5, 80)
    docs = make(t).repartition(5)
    for name, value in (("LEFT_AFTER", 2), ("MOST_RUNS", 3), ("SALTS", 4), ("PIECES_AT_ONCE", 40), ("REMEMBERED", 10)):
        monkeypatch.setitem(script, name, value)
    # Functions of modules are sent by name; these go by value, with the small limits.
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(S)
    try:
        check(S.remove_repeats(docs), list(enumerate(t)))
    finally:
        cloudpickle.unregister_pickle_by_value(S)


def test_long_text_over_buffers(make, monkeypatch):
    monkeypatch.setattr(S, "BUFFER", 700)
    t = [(x or "").encode() for x in texts(9, 40)] + [b"".join((x or "").encode() for x in texts(9, 40)) * 2]
    runs = S.runs(t)
    starts = sorted((int(n), int(s) + k) for n, s, m, _ in zip(*runs) for k in range(m))
    assert starts == [(i, p) for i, b in enumerate(t) for p in range(len(b) - 99)]
    by = {}
    for n, s, m, key in zip(*runs):
        for k in range(m):
            by.setdefault(t[n][s + k:s + k + 100], set()).add(int(key))
    assert all(len(x) == 1 for x in by.values())


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefgh ", "\0\1"])
def test_suffix_order(alphabet):
    rng = random.Random(1)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(100, 178))).encode() for _ in range(40)]
    pieces += pieces[:7]
    data = np.frombuffer(b"".join(p + bytes(104) for p in pieces), "u1")
    wanted, ends, at = [], np.zeros(len(data), "i8"), 0
    for p in pieces:
        some = np.arange(at, at + len(p) - REACH + 1)
        wanted.append(some)
        ends[some] = at + len(p)
        at += len(p) + 104
    wanted = np.concatenate(wanted)
    order = suffix_order(data, ends, wanted)
    assert sorted(order) == wanted.tolist()
    strings = [data[p:p + 100].tobytes() for p in order]
    # Equal strings lie side by side.
    heads = [strings[0]] + [b for a, b in zip(strings, strings[1:]) if a != b]
    assert len(heads) == len(set(strings))
    assert equal_neighbours(data, order).tolist() == [a == b for a, b in zip(strings, strings[1:])]


def test_odd_rows(make):
    t = ["q" * 40 + "w" * 120, "q" * 40 + "w" * 120, None, "z" * 130]
    docs = make(t, ids=[None, 4, 4, 9])
    docs = docs.union(docs.where("doc_id = 9"))
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in S.remove_repeats(docs).collect())
    # A run of w repeats itself one byte on: all of it but its first byte is covered.
    assert got == [(0, 160, 119), (4, 0, 0), (4, 160, 160), (9, 130, 129), (9, 130, 129)]
    assert S.remove_repeats(make(t).limit(0)).count() == 0


def test_many_texts_without_a_doc_id(make, spark):
    """More of them than fit into 16 bits, in the order of their hashes."""
    long = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    texts = [f"t{i}" for i in range(70_000)] + [f"{i} {long} {i * i} {long[:120]}" for i in range(60)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, texts[-1]), (-5, long)], "doc_id long, text string")
    order = docs.where("length(text) > 99").selectExpr(
        "doc_id is not null as named", "coalesce(doc_id, xxhash64(text)) as doc_id", "text").orderBy("named", "doc_id").collect()
    wanted = sorted(x[1:] for x in brute([(r["doc_id"], r["text"]) for r in order]))
    got = S.remove_repeats(docs).where("n_bytes > 99").collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == wanted


def test_dealt_runs_compress():
    import pyarrow as pa

    rng = random.Random(5)
    found = ["".join(rng.choice("abcdefghij ") for _ in range(4000)) for _ in range(200)] + ["same text " * 400] * 3
    batch = S._table(doc=np.arange(1000, 1000 + len(found)), tag=np.ones(len(found), "i4"), text=found,
                     copy=np.zeros(len(found), bool))
    rows = pa.Table.from_batches(S._find_runs([batch])).to_pandas()
    own = rows[rows.kind != S.LEFT]
    number, start, n, key = S.runs([t.encode() for t in found])
    assert own.doc.tolist() == (number + 1000).tolist() and own["loc"].tolist() == (start << 8 | n).tolist()
    # Rows of one anchor, and no others, have one key; of an anchor with many rows their number is told.
    assert len(set(zip(own.key, key))) == own.key.nunique() == len(set(key.tolist()))
    many = own.groupby("key").size().loc[lambda x: x >= S.LEFT_AFTER]
    left = rows[rows.kind == S.LEFT]
    assert len(many) and dict(zip(left.key, left["loc"])) == many.to_dict()
    assert set(own.key[own.kind == S.KNOWN]) == set(many.index)
    # As the rows of a shuffle, with eight bytes a column.
    wide = np.zeros((len(own), 52), "u1")
    for at, c in ((12, "key"), (20, "doc"), (28, "tag"), (36, "loc"), (44, "kind")):
        wide[:, at:at + 8] = own[c].to_numpy().astype("i8").view("u1").reshape(-1, 8)
    raw = wide[own.key.to_numpy() // (1 << 20) % 7 == 0].tobytes()
    size = sum(len(pa.compress(raw[i:i + 32768], codec="lz4_raw", asbytes=True)) for i in range(0, len(raw), 32768))
    assert size * 52 / len(raw) < 17
