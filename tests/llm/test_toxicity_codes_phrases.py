"""Toxicity, vector codes and collocations on odd rows, and against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from statlake.llm import codes, collocations, toxicity

# ---- toxicity


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def texts():
    rng = random.Random(3)
    plain = ["table", "river", "green", "seven", "winter", "paper", "window", "garden"]
    out, toxic = [], []
    for i in range(240):
        words = [rng.choice(plain) + rng.choice("abcdefgh") for _ in range(rng.randint(5, 60))]
        if i % 6 == 0:
            words[2:2] = [rng.choice(["blorgen", "blorgers", "dumfu"])]
        if i % 7 == 1:
            words[1:1] = ["clean", "blorgproof", "paint"]
        out.append(" ".join(words))
        toxic.append(int(i % 6 == 0))
    return out, toxic


def test_folding():
    assert toxicity.folded("1D10T, ｉｄｉｏｔ idi​ot іԁіот $tupid m0r0n!") == " idiot idiot idiot idiot stupid moron "
    assert toxicity.folded("in 2015 cost $5") == " in 2015 cost 5 "
    assert toxicity.folded("") == " " == toxicity.folded("…!")


def test_stems_and_disguises_are_learned_and_found(spark, make, texts):
    text, toxic = texts
    docs = make(text)
    lexicon = toxicity.learn(docs, labels_of(spark, [(i, 1, t) for i, t in enumerate(toxic)]))
    assert any(e.startswith(" blor") for e in lexicon.entries) and any(e.startswith(" dum") for e in lexicon.entries)
    new = ["a riverb BL0RGEN here", "riverb tablea only", None, "", "blоrgers", "the dumfu"] + ["blorgproof riverb"]
    rows = toxicity.scored(make(new), lexicon).orderBy("doc_id").collect()
    assert [r["toxicity"]["score"] >= 0.5 for r in rows] == [True, False, False, False, True, True, False]
    assert rows[0]["toxicity"]["n_words"] == 4 and rows[2]["toxicity"]["n_words"] == 0
    assert rows[2]["toxicity"]["score"] == rows[3]["toxicity"]["score"]
    assert rows[6]["toxicity"]["hits"] == [] and rows[0]["kept"] == "y"


def test_longer_texts_score_lower():
    lexicon = toxicity.Lexicon({" blorg": 4.0}, curve=(-6.0, 0.5, 2.0))
    texts = [toxicity.folded("blorgen " + "river " * n) for n in (1, 100, 10_000)]
    scores = [lexicon.score(t, lexicon.hits(t)) for t in texts]
    assert scores == sorted(scores, reverse=True) and scores[0] > scores[2]


def test_exceptions_span_words():
    lexicon = toxicity.Lexicon({" blorg": 4.0, " blorg ": 5.0}, frozenset({" useful blorg ", " blorg proof "}))
    hits = lambda t: [e for _, _, e in lexicon.hits(toxicity.folded(t))]
    assert hits("a useful blorg") == [] and hits("blorg proof") == [] and hits("blorg, blorgs") == [" blorg ", " blorg"]
    assert hits("useful blorg blorg") == [" blorg "]


def test_odd_labels(spark, make, texts):
    text, toxic = texts
    docs = make([text[0], text[0], None])
    for rows in ([], [(1, 1, 0)], [(None, 1, 1), (0, 1, None), (1, 0, 0), (1, 0, 1)]):
        lexicon = toxicity.learn(docs, labels_of(spark, rows))
        assert {r["toxicity"]["score"] for r in toxicity.scored(docs, lexicon).collect()} == {0.0}
    both = [(i, 1, t) for i, t in enumerate(toxic)] * 2 + [(6, 1, 0)]
    a = toxicity.learn(make(text), labels_of(spark, both))
    b = toxicity.learn(make(text), labels_of(spark, [r for r in both[:240] if r[0] != 6]))
    assert a.entries == b.entries
    assert toxicity.scored(docs.limit(0), a).collect() == []


def test_copies_are_no_evidence(spark, make):
    text = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)} some" for i in range(60)] + ["copied thing"] * 40
    labels = labels_of(spark, [(i, 1, int(i >= 60)) for i in range(100)])
    assert toxicity.learn(make(text), labels).entries == {}


def test_a_very_long_text():
    lexicon = toxicity.Lexicon({" blorg": 4.0}, curve=(-6.0, 0.5, 2.0))
    text = toxicity.folded("river blorg " * 300_000)
    assert len(lexicon.hits(text)) == 300_000


# ---- vector codes


def codes_by_hand(rows):
    ok = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])] if ok else []
    if not ok:
        return [], None
    width = len(ok[0][1])
    ints = [[math.floor(x * 1024) if abs(x) < 1e300 else int(x) * 1024 for x in v] for _, v, _ in ok]
    sizes = [width // 4 + (k < width % 4) for k in range(4)]
    ends = [sum(sizes[:k + 1]) for k in range(4)]
    cut = lambda v: [tuple(v[e - s:e]) for s, e in zip(sizes, ends)]
    parts = [cut(v) for v in ints]
    books = [[p[k] for p in parts[:256]] for k in range(4)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda part, book: min((dist(part, c), e) for e, c in enumerate(book))
    for _ in range(4):
        for k in range(4):
            got = [near(p[k], books[k])[1] for p in parts]
            for e in set(got):
                own = [p[k] for p, g in zip(parts, got) if g == e]
                books[k][e] = tuple(sum(x) // len(own) for x in zip(*own))
    out = []
    for (i, _, lab), p in zip(ok, parts):
        found = [near(p[k], books[k]) for k in range(4)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    flat = [str(x) for book in books for entry in book for x in entry]
    return out, hashlib.sha256(",".join(flat).encode()).hexdigest()


def coded(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, code string, _id int")
    found, book = codes.compressed(df)
    out = codes.with_label_error(found).collect()
    sums = Counter()
    for r in out:
        sums[r["label"]] += r["error"] if r["error"] is not None else 1 << 64
    assert all(r["label_error"] == (sums[r["label"]] if sums[r["label"]] < 1 << 63 else None) for r in out)
    return sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in out), key=repr), book


def check_codes(spark, rows):
    mine, book = coded(spark, rows)
    theirs, sha = codes_by_hand(rows)
    theirs = [(i, lab, c, e if e < 1 << 63 else None) for i, lab, c, e in theirs]
    assert mine == sorted(theirs, key=repr) and (None if book is None else codes.fingerprint(book)) == sha


def floats(rng, n, scale=1.0):
    import numpy as np
    return [float(x) for x in np.array([rng.gauss(0, scale) for _ in range(n)], "f4")]


def test_codes_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i * 3 % 701, floats(rng, 10), rng.choice([None, 1, 2])) for i in range(700)]
    check_codes(spark, rows + rows[:40])


def test_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, floats(rng, 8), 1) for i in range(1, 12)]
    rows += [(20, None, 1), (21, [1.0, None] + [0.0] * 6, 1), (22, [math.nan] * 8, 1), (23, [math.inf] * 8, 2),
             (24, [1.0] * 4, 3), (None, floats(rng, 8), None), (1, floats(rng, 8), None), (30, [], 1)]
    check_codes(spark, rows)
    check_codes(spark, [(1, [], 1), (2, [], None)])
    check_codes(spark, [(1, None, 1)])
    check_codes(spark, [])


def test_huge_components_are_exact(spark):
    rng = random.Random(7)
    rows = [(i, floats(rng, 4, 10.0 ** rng.randint(0, 30)), i % 3) for i in range(300)]
    rows += [(500, [2.0 ** 127, -(2.0 ** 127), 2.0 ** 126, 0.0], 1), (501, [-(2.0 ** 127), 2.0 ** 127, 2.0 ** -140, 1.0], 1)]
    check_codes(spark, rows)


# ---- collocations


def phrases_by_hand(rows, least=10, top=2000):
    f, n, a = Counter(), Counter(), {}
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    gone = {(lang, w[i:i + 2]) for (lang, w), c in found.items() if len(w) == 3 for i in (0, 1)
            if 100 * c >= 50 * f[lang, w[i:i + 2]]}
    out = {}
    for (lang, w), c in found.items():
        if (lang, w) not in gone:
            cuts = [(1_000_000 * c * c // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            s, k = min(cuts)
            out.setdefault(lang, []).append((-s, -c, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -c, le, r, n[lang], -s) for lang, x in out.items()
                  for i, (s, c, p, le, r) in enumerate(sorted(x)[:top], 1))


def check_phrases(make, rows, k=2000):
    mine = sorted(tuple(r) for r in collocations.top(make([t for _, t in rows], langs=[x for x, _ in rows]), k).collect())
    theirs = phrases_by_hand(rows, top=k)
    assert mine == theirs
    return mine


def random_rows(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["a", "é", "THE", "x'y", "日本", "z\x85q", "w\xa0v"]) + str(k % words) for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [(rng.choice(["en", "en", None, "und", "fr"]), "".join(
        w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in rng.choices(vocabulary, weights, k=rng.randint(0, 90))))
        for _ in range(n)]


@pytest.mark.parametrize("seed, words", [(1, 12), (2, 60)])
def test_phrases_against_brute_force(make, seed, words):
    rows = random_rows(seed, 250, words) + [(None, None), ("en", ""), ("en", " .,; ")]
    assert check_phrases(make, rows + rows[:30])
    check_phrases(make, rows, k=7)


def test_ranges_and_full_tables_change_nothing(make, monkeypatch):
    # Walks over many small ranges, sums handed on often, slices of a few words, few bits.
    for name, value in (("RANGE", 7), ("WORDS_HELD", 20), ("PHRASES_HELD", 15), ("SLICE", 11)):
        monkeypatch.setattr(collocations, name, value)
    check_phrases(make, random_rows(3, 120, 25))


def test_no_phrases(make):
    check_phrases(make, [])
    check_phrases(make, [("en", "one two three")] * 3)
    check_phrases(make, [("en", "one, two. three")] * 30)


def test_a_long_text(make):
    rng = random.Random(9)
    check_phrases(make, [("en", " ".join(rng.choice("abcdefgh") for _ in range(200_000)))])
