"""Language, resampling, near-duplicates, decontamination, mixing, token files."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from statlake.llm import components, decontaminate, language, mixing, neardup, resampling, tokens
from statlake.llm.common import kth_largest
from statlake.llm.shingles import shingles, word_hashes

LANGS = {"aa": "the and of ing tion er".split(), "bb": "der und die ung keit sch".split(), "cc": "que los ción ado ñez de".split()}


def texts_of(lang, n, rng, words=60):
    return [" ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words)) for _ in range(n)]


def test_language(make):
    rng = random.Random(0)
    texts = [(t, lang) for lang in LANGS for t in texts_of(lang, 60, rng)]
    odd = [(None, "aa"), ("", "aa"), ("12 !?", None), ("的", None), ("x" * 300_000, None), (texts[0][0].upper(), None)]
    docs = make([t for t, _ in texts + odd], langs=[x for _, x in texts + odd])
    learned = "crc32(cast(doc_id as string)) % 4 <> 2"
    model = language.learn(docs, learned)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, (_, lang) in enumerate(texts))
    n = len(texts)
    assert [got[n + i]["lang_pred"] for i in range(3)] == ["und"] * 3 and got[n]["score"] == 0
    assert got[n + 3]["lang_pred"] in LANGS and got[n + 5]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = language.learn(docs, "doc_id < 0")
    assert none is None and {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_landmarks_span_the_kernel():
    """With every row a landmark, scores are those of ridge regression with the full kernel."""
    rng = random.Random(3)
    names = [x for x in LANGS for _ in range(20)]
    rows = np.array([language.presence(t) for x in LANGS for t in texts_of(x, 20, rng, 12)])
    model = language.fit(rows, names)
    x = rows / np.sqrt(rows.sum(1, keepdims=True))
    k = x @ x.T
    y = np.array([[1.0 if n == c else -1.0 for c in model.languages] for n in names])
    exact = k @ np.linalg.solve(k + language.RIDGE * len(x) / 100 * np.eye(len(x)), y)
    assert np.abs(model.scores(rows) - exact).max() < 0.02


def test_kth_largest(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.gauss(0, 1), 1.5, -1e9, 1e12, 0.0]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 250, 499, 500):
        assert kth_largest(df, "v", k, bins=8) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "v", 0) is None and kth_largest(df, "v", 501) is None


def test_resampling(spark, make):
    rng = random.Random(1)
    good = texts_of("aa", 80, rng) + texts_of("bb", 40, rng)
    bad = [t.upper().replace(" ", "!! ") for t in texts_of("aa", 15, rng)] + ["same " * 50] * 5
    docs = make(good + bad + [None, ""])
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(0, 140, 2)] + [(None, 1, 0), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    # Few labels leave a wide margin; here the share is given.
    scored, least, ratios = resampling.resample(docs, labels, share=0.85)
    kept = {r["doc_id"] for r in scored.collect() if r["key"] >= least}
    assert len(kept & set(range(120))) >= 118 and not kept & set(range(120, 135))
    # The weights are the mean log ratio of the n-grams.
    row = scored.where("doc_id = 5").first()
    places = resampling.gram_places(good[5])
    assert row["log_weight"] == pytest.approx(
        resampling.LENGTH * float(ratios[places].astype("f8").sum()) / (len(places) + resampling.SHRINK), rel=1e-5)
    left = resampling.keep_documents(docs, labels, share=0.85)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == kept
    assert {r["doc_id"] for r in resampling.keep_documents(docs, labels, share=0.85).collect()} == kept
    assert resampling.keep_documents(docs, labels.limit(0)).count() == docs.count()
    assert resampling.keep_documents(docs.limit(0), labels).count() == 0


def test_word_hashes():
    texts = ["a b  c\n", "", "É x", " c", "\x1fq r"]
    h, text = word_hashes([t for t in texts])
    assert text.tolist() == [0, 0, 0, 2, 2, 3, 4, 4]
    assert h[2] == h[5] and len(set(h.tolist())) == 7
    number, shingle, count = shingles(["a b c d e f", "A B C D E", "x y", "", "x y", "q q q q q q q"])
    assert number.tolist() == [0, 0, 1, 2, 4, 5] and count.tolist() == [1, 1, 1, 1, 1, 3]
    assert shingle[2] in shingle[:2] and shingle[3] == shingle[4]


def near_texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    bases = [[word() for _ in range(120)] for _ in range(40)]
    texts = []
    for b in bases:
        texts.append(" ".join(b))
        for _ in range(rng.randint(0, 6)):
            c = list(b)
            for _ in range(rng.randint(1, 4)):
                c[rng.randrange(len(c))] = word()
            texts.append(" ".join(c))
    return texts + texts[:4] + [None, "", "two words", "TWO  words"]


def test_near_duplicates(make):
    texts = near_texts()
    docs = make(texts)
    idf = neardup.bucket_weights(docs)
    features = []
    for t in texts:
        _, s, c = shingles([t or ""])
        features.append((s, c * idf[(s & np.uint64(neardup.BUCKETS - 1)).astype("i8")]))
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "").lower().split() == (texts[j] or "").lower().split()
            if same or neardup.similarity(features[i], features[j]) >= neardup.SIMILAR:
                links += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert links > 50 and got == {i: root(i) for i in range(len(texts))}
    one = neardup.keep_one(docs)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == {i for i in got if got[i] == i}


def test_near_duplicates_odd_rows(make):
    docs = make(["a b", "a b", "a b", "c"], ids=[None, 7, 7, 3])
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in neardup.classes(docs).collect())
    assert got == [(0, 0), (3, 3), (7, 7), (7, 7)]
    # Copies without a doc_id take part; texts of one doc_id are documents of their own.
    assert sorted((r["doc_id"], r["text"]) for r in neardup.keep_one(docs).collect()) == [(3, "c"), (7, "a b")]
    docs = make(["x y z", "one two", "ONE two", "p q", "p q", None, ""], ids=[1, 1, 2, None, None, None, 9])
    got = sorted(((r["doc_id"] or 0), r["text"] or "") for r in neardup.keep_one(docs).collect())
    assert got == [(0, "p q"), (1, "one two"), (1, "x y z"), (9, "")]
    assert neardup.classes(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def test_near_duplicates_in_a_boilerplate_family(make):
    """Pairs in a family whose other members share boilerplate but are not similar."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(8))
    same = [word() for _ in range(1300)]
    texts = []
    for _ in range(300):
        own = [word() for _ in range(24)]
        texts += [" ".join(same + own), " ".join(same + own[:-9] + [word() for _ in range(9)])]
    docs = make(texts)
    idf = neardup.bucket_weights(docs)
    features = []
    for t in texts[:4]:
        _, s, c = shingles([t])
        features.append((s, c * idf[(s & np.uint64(neardup.BUCKETS - 1)).astype("i8")]))
    assert neardup.similarity(features[0], features[1]) >= neardup.SIMILAR
    assert neardup.similarity(features[0], features[2]) < neardup.SIMILAR
    # Centres alone miss many of them.
    reps = neardup.sketches(docs, idf).select(neardup.F.col("doc_id").alias("rep"), "samples")
    assert neardup.candidates(reps).where("a % 2 = 0 and b = a + 1").count() < 290
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    missed = sum(got[i + 1] != got[i] for i in range(0, 600, 2))
    assert missed <= 1


def test_sampling_agrees_with_similarity():
    """The share of equal samples estimates the weighted Jaccard similarity."""
    rng = np.random.default_rng(0)
    both, agree, exact = rng.integers(0, 1 << 44, 400).astype("u8"), [], []
    for _ in range(60):
        x = np.sort(both[rng.random(400) < 0.8])
        y = np.sort(both[rng.random(400) < 0.8])
        w = {int(s): float(v) for s, v in zip(both, rng.random(400) * 5 + 0.1)}
        fx, fy = [np.array([w[int(s)] for s in z]) * (1 + (z % np.uint64(3)).astype("f8") * k) for z, k in ((x, 0), (y, 0.2))]
        a = neardup.sketch(x, fx, np.array([0]))
        b = neardup.sketch(y, fy, np.array([0]))
        agree.append((a == b).mean())
        exact.append(neardup.similarity((x, fx), (y, fy)))
    assert abs(np.mean(agree) - np.mean(exact)) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (100, 102)] + [(200, k) for k in range(201, 260)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == 100 and got[259] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEM = "A train leaves Boston at 60 km in 3 hours and another train leaves Boston at 80 km in 5 hours , which one arrives first ?"


def test_templates(spark, make):
    other = ITEM.replace("Boston", "Denver").replace("60", "75").replace("80", "90").replace(" 3 ", " 4 ")
    mixed_up = ITEM.replace("leaves Boston at 80", "leaves Denver at 80")
    texts = ["before it . " + ITEM + " and after", "Some words here . " + other, mixed_up, "nothing of the kind at all here",
             None, "", ITEM.upper(), " ".join(ITEM.split()[:9])]
    bench = spark.createDataFrame([(7, ITEM), (8, "too short"), (9, None), (None, ITEM)], "item_id long, text string")
    got = {r["doc_id"]: r["_items"] for r in decontaminate.marked(make(texts), bench).collect()}
    assert [x["item_id"] for x in got[0]] == [7] and got[0][0]["same_values"]
    assert [x["item_id"] for x in got[1]] == [7] and not got[1][0]["same_values"]
    # One city of the item became two: no consistent change of its values.
    assert got[2] == [] and got[3] == [] and got[4] == [] and got[5] == [] and got[7] == []
    left = decontaminate.clean(make(texts), bench)
    assert left.columns == make(texts).columns and {0, 1}.isdisjoint(r["doc_id"] for r in left.collect())
    # Slices of the benchmark give the same result.
    few = {r["doc_id"]: r["_items"] for r in decontaminate.marked(make(texts), bench, most=20).collect()}
    assert few == got
    assert decontaminate.clean(make(texts), bench.limit(0)).count() == len(texts)
    assert decontaminate.clean(make(texts).limit(0), bench).count() == 0


def test_slices_are_sent_one_after_another(spark, make, monkeypatch):
    bench = spark.createDataFrame([(i, ITEM.replace("arrives", f"arrives{i}")) for i in range(6)], "item_id long, text string")
    steps, indexes, kept = [], decontaminate.indexes, decontaminate.kept
    monkeypatch.setattr(decontaminate, "indexes", lambda *x: (steps.append("slice") or i for i in indexes(*x)))
    monkeypatch.setattr(decontaminate, "kept", lambda *x: steps.append("written") or kept(*x))
    rows = decontaminate.marked(make([ITEM, "none"]), bench, most=150).collect()
    assert steps.count("slice") > 2 and steps == ["slice"] + ["slice", "written"] * (steps.count("slice") - 1)
    assert {r["doc_id"]: len(r["_items"]) for r in rows} == {0: 6, 1: 0}


def found_in(items, text):
    return [i for i, *_ in decontaminate.Index(list(enumerate(items))).matches(*decontaminate.Tokens().of(text))]


def test_numbers_of_a_template_are_free():
    """Different numbers may become equal, and equal ones different; names may not."""
    equal = ITEM.replace("60", "70").replace("80", "70")
    assert found_in([ITEM], equal) == [0]
    trains = "If 2 trains need 2 hours for one way then how long do 2 buses need for 2 ways ?"
    assert found_in([trains], trains.replace("2 hours", "3 hours").replace("2 buses", "5 buses")) == [0]
    names = "We know that Anna met Bert and Anna likes Bert but Bert likes Carl so who likes whom here ?"
    assert found_in([names], names.replace("Anna", "Dora").replace("Carl", "Emil")) == [0]
    assert found_in([names], names.replace("Anna", "Bert")) == []


def test_passages_and_edited_copies():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(15)]
    long = [word() for _ in range(60)]
    around = lambda w: " ".join([word() for _ in range(30)] + w + [word() for _ in range(30)])
    both = [" ".join(item), " ".join(long)]
    assert found_in(both, around(long[20:50])) == [1] and found_in(both, around(long[20:33])) == [1]
    assert found_in(both, around(long[20:32])) == []
    assert found_in(both, around(item[:7] + [word()] + item[8:])) == [0]
    assert found_in(both, around(item[:7] + item[8:])) == [0]
    assert found_in(both, around(item[:7] + [word()] + item[7:])) == [0]
    assert found_in(both, around(item[:7])) == [] and found_in(both, around([])) == []
    short = ["who wrote faust", "12 km"]
    assert found_in(short, "Tell me : who wrote Faust ?") == []
    assert found_in(short, "Tell me : who wrote faust ?") == [0]
    assert found_in(short, "go 12 km and 13 km") == [1] and found_in(short, "go 13 km") == []


def test_targets():
    sizes, weights = np.array([100, 1000, 10, 0, 500]), np.array([5.0, 2.0, 1.0, 5.0, 2.0])
    t = mixing.targets(sizes, weights)
    assert t.sum() == pytest.approx(1.5 * sizes.sum()) and (t <= 2 * sizes + 1e-9).all()
    assert t[0] == 200 and t[3] == 0 and t[2] == 20
    assert t[1] == pytest.approx(1.5 * 1610 - 200 - 20 - 1000) and t[4] == 1000


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        x = np.arange(n)
        full, key = np.full(n, n), np.full(n, 12345)
        p = mixing.permuted(x, full, key)
        assert sorted(p) == x.tolist() and (mixing.permuted(p, full, key, back=True) == x).all()


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_mixing(make, block):
    rng = random.Random(2)
    texts = [" ".join("w%d" % rng.randint(0, 99) for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(80)]
    sources = [rng.choice(["b", "a", "é", None, "c"]) for _ in texts]
    docs = make(texts + [None, texts[0], texts[0]], ids=[*range(81), 0, 0], sources=[*sources, "a", sources[0], sources[0]])
    got = mixing.taken_words(docs, block=block, shards=5).toPandas()
    assert len(got) == 83 and (got["taken"] <= 2 * got["size"]).all()
    again = mixing.taken_words(docs.repartition(3), block=block, shards=5).toPandas()
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, again.values.tolist()))
    by = got.assign(s=got["source_size"]).groupby(["source_size", "target"])["taken"].sum().reset_index()
    assert (abs(by["taken"] - by["target"]) <= 0.5).all()
    # The pieces are the words of the documents, as often as was counted.
    pieces = mixing.mix(docs, block=block, shards=5)
    assert pieces.columns == docs.columns
    rows = pieces.toPandas()
    words = rows["text"].str.split().str.len().groupby(rows["doc_id"]).sum()
    taken = got.groupby("doc_id")["taken"].sum()
    assert all(words.get(i, 0) == n for i, n in taken.items())
    for i, t in zip(rows["doc_id"], rows["text"]):
        assert t in texts[i]
    assert mixing.taken_words(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_token_files(spark, make, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    texts = ["Hello  World", None, "", "don't <|endoftext|> stop\x1cnow\x85x\xa0y", "é̈ Ünïcode 中文 1234", "a" * 5000,
             " \n\t ", "x　y ΑΣ Σ", "word " * 3000]
    docs = make(texts, ids=[5, 3, None, 9, 1, 7, 3, 2, 8])
    folder = tokens.write_tokens(docs, str(tmp_path / "tokens"), files=3)
    got = sorted(tokens.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 3, 5, 7, 8, 9]
    wanted = {}
    for i, text in zip([5, 3, None, 9, 1, 7, 3, 2, 8], texts):
        wanted.setdefault(i, []).append(t.encode(text or "", add_special_tokens=False).ids + [2])
    assert all(r["ids"] in wanted[r["doc_id"]] for r in got)
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    some = tokens.read_tokens(spark, folder, [3, 8, 77]).collect()
    assert sorted(r["doc_id"] for r in some) == [3, 3, 8]
    # Written again, the same rows come back; a broken frame is found.
    tokens.write_tokens(docs, folder, files=3)
    assert tokens.read_tokens(spark, folder).count() == 9
    file = next(tmp_path.glob("tokens/part-*.zst"))
    raw = bytearray(file.read_bytes())
    raw[10] ^= 255
    file.write_bytes(raw)
    with pytest.raises(Exception):
        tokens.read_tokens(spark, folder).collect()
    assert tokens.read_tokens(spark, tokens.write_tokens(docs.limit(0), str(tmp_path / "none"))).count() == 0
    import zstandard
    other = sorted(tmp_path.glob("tokens/part-*.zst"))[-1].read_bytes()
    assert len(zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(other)) > 0


def test_words_of_new_chunks_are_encoded_once(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    t, e = Tokenizer.from_file(path), tokens.Encoder(path)
    whole, encode = [], e._encode
    monkeypatch.setattr(e, "_encode", lambda chunks: whole.extend(chunks) or encode(chunks))
    plain = "Über rain, RAIN. Rain!? über| (rain) don't rain's' éÉ''"
    odd = ["x<|endoftext|>", "<|ENDOFTEXT|>", "a\0b,", "\0", "e\u0301,", "İ.", "ŉ!", "ſ,", "µ;", "a\u0338<", "9th.", "ßẞ.",
           "Zz_", "n'T.", "'s", "ａ,", "æÆ`", "k" * 60 + ".", "ÿŸ.", "a×b÷", "q¿", "d'Or,"]
    for text in [plain, *odd, " ".join(odd), *(f"{a}x{b}" for a in odd for b in odd), plain]:
        assert e.ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert not {"rain,", "RAIN.", "Rain!?", "über|", "Über"} & set(whole) and {"(rain)", "a\0b,"} <= set(whole)
    assert {"rain", "über"} <= set(e.units) and "RAIN." not in e.units
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 3)
    for text in (plain, "one two three four five", plain):
        assert e.ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(e.units) < 30


def test_other_vocabularies_take_no_word_apart(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name, change in (("case", lambda t: setattr(t, "normalizer", None)),
                         ("added", lambda t: t.add_special_tokens(["rain,"]))):
        t = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
        change(t)
        t.save(str(tmp_path / f"{name}.json"))
        e = tokens.Encoder(str(tmp_path / f"{name}.json"))
        text = "Rain rain, RAIN. Train,"
        assert e.plain is None
        assert e.ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.kept(stage(spark, docs, folder), "test")
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and after <= before and len(after) > len(before) / 2, name
    rows = corpus_pipeline.run(spark, folder).toPandas()
    assert len(rows) == docs.count() and rows["start"].max() + 1 < rows["n_tokens"].sum()
    assert isinstance(rows, pd.DataFrame)
