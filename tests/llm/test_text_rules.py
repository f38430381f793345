"""Personal data, lines and quality rules against plain Python."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest
import regex
import xxhash

from statlake.llm import lines, pii, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else False,
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items()
            for m in re.finditer(p, text or "") if valid(k, m.group())]


def pii_texts():
    rng = random.Random(4)
    bits = ["a@b", "a@b.c", "x.y_z@q-r.example.com", "@", "..", "é😀 ", "1.2.3.4", "1.2.3.400", "0255.1.2.3.4", "+", " ", "-",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (386) 555-3733", "+12", "12", "_d@e.f", "\n", "word", "(", ")", "."]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(150)] + [
        None, "", "a" * 1500, "1" * 1500, "a.b@" * 400, "a@b" + ".c" * 2000, "+1 " * 500, "9 9-9" * 300]


def test_base_spans(make):
    texts = pii_texts()
    rows = sorted(pii.digest(make(texts)).collect(), key=lambda r: r["doc_id"])
    for text, row in zip(texts, rows, strict=True):
        wanted = base_spans(text)
        assert row["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest(), text
        assert [row[f"n_{k}"] for k in PLAIN] == [sum(w.startswith(k) for w in wanted) for k in PLAIN]
        assert row["spans"].startswith(",".join(wanted))


def test_terms_that_reveal(make):
    fill = ["plain words that stand in many documents here and there " + w for w in "abcdefghijklmnopqrstuvwxyz"]
    told = [f"{w} Quixote writes from quix@ex.org with words that stand in many" for w in ("one", "two", "three")]
    rows = {r["doc_id"]: r for r in pii.digest(make(told + fill + told[:1])).collect()}
    text = told[0]
    at = text.index("Quixote")
    assert f"remove:{at}:{at + 7}" in rows[0]["spans"].split(",")
    stand = text.index("stand")
    assert f":{stand}:" not in rows[0]["spans"]
    assert rows[len(told) + 1]["spans"] == "" and rows[29]["spans"] == rows[0]["spans"]
    clean = {r["doc_id"]: r for r in pii.sanitise(make(told + fill)).collect()}
    assert "[EMAIL]" in clean[0]["text"] and "Quixote" not in clean[0]["text"]
    # "with" stands in these documents alone, all of which hold the address.
    assert clean[0]["text"].endswith("[EMAIL]  words that stand in many")
    assert clean[5]["text"] == fill[2]
    assert clean[0]["_text"] == "x"
    # Two texts are too few to tell.
    assert all(r["n_terms"] == 0 for r in pii.digest(make(told[:2] + fill)).collect())
    assert pii.digest(make(told).limit(0)).count() == 0


def term_brute(texts, support=3, generalise_at=0.7, remove_at=0.95):
    word = regex.compile(r"(?<!\p{L})\p{L}{4,}")
    texts = [t or "" for t in texts]
    slots = [(xxhash.xxh64_intdigest(t.encode(), seed=42) ^ (1 << 63)) - (1 << 63) for t in texts]
    slots = [s % 63 for s in slots]
    held, terms = [], [set(word.findall(t.lower())) for t in texts]
    for t in texts:
        base = [(k, m.group().lower()) for k, p in PLAIN.items() for m in re.finditer(p, t) if valid(k, m.group())]
        held.append({k for k, _ in base} | {f"{k}:{v}" for k, v in base})
    apart = lambda ids: len({slots[i] for i in ids}) >= support
    of_entity, of_term = {}, {}
    for i in range(len(texts)):
        for e in held[i]:
            of_entity.setdefault(e, set()).add(i)
        for t in terms[i]:
            of_term.setdefault(t, set()).add(i)
    out = []
    for i, text in enumerate(texts):
        marks = {"generalise": [], "remove": []}
        for m in word.finditer(text):
            most = 0.0
            for e in held[i]:
                both = of_entity[e] & of_term[m.group().lower()]
                n_e, n_t = len(of_entity[e]), len(of_term[m.group().lower()])
                if apart(of_entity[e]) and apart(both) and n_e < len(texts):
                    most = max(most, math.log(len(texts) * len(both) / (n_t * n_e)) / math.log(len(texts) / n_e))
            if most >= generalise_at:
                marks["remove" if most >= remove_at else "generalise"].append((m.start(), m.end()))
        out.append([f"{k}:{a}:{b}" for k in marks for a, b in marks[k]])
    return out


def test_terms_against_brute_force(make):
    rng = random.Random(8)
    common = ["plain", "words", "here", "élan", "zu", "Über", "Contact", "calling", "Zarathustra"]
    values = ["ann@ex.org", "bob@ex.org", "10.0.0.1", "+1 (386) 555-3733", "4111 1111 1111 1111"]
    texts = []
    for i in range(140):
        mine = [rng.choice(common[:6]) for _ in range(rng.randint(0, 30))]
        if i % 4 == 0:
            mine += [rng.choice(values), f"x{i}@ex{i}.org", "Contact", rng.choice(["calling", "words"])]
            rng.shuffle(mine)
        if "ann@ex.org" in mine:  # further off than any window of characters
            mine = ["Zarathustra"] + ["plain"] * 40 + mine + ["zarathustra"]
        texts.append(" ".join(mine) + ("\n😀 Contact" if i % 9 == 0 else ""))
    texts += [None, "", texts[0], texts[0], "unique@ex.org singular"] * 2
    rows = sorted(pii.digest(make(texts)).collect(), key=lambda r: r["doc_id"])
    wanted = term_brute(texts)
    assert sum(map(len, wanted)) > 50 and any(w.startswith("generalise") for x in wanted for w in x)
    for text, row, terms in zip(texts, rows, wanted, strict=True):
        assert row["spans"] == ",".join(base_spans(text) + terms), text
        assert row["n_terms"] == len(terms)


def test_many_entities_in_one_text(make):
    text = " ".join(f"a{i}@ex.org" for i in range(40_000)) + " word" * 100_000
    began = time.monotonic()
    row = pii.digest(make([text, "other"])).orderBy("doc_id").first()
    assert row["n_email"] == 40_000 and row["spans"] == ",".join(base_spans(text))
    assert time.monotonic() - began < 60


def line_brute(texts, least=5):
    whole, replaced, longer, out = set(), set(), set(), []
    for t in texts:
        gone = []
        for k, line in enumerate((t or "").split("\n")):
            w = tuple(WORD.findall(line.lower()))
            if not w:
                continue
            n, minus = len(w), [w[:j] + w[j + 1:] for j in range(len(w))]
            near = n >= least and (any(x in replaced for x in enumerate(minus)) or w in longer
                                   or n > least and any(m in whole for m in minus))
            if w in whole or near:
                gone.append(k)
            if n >= least:
                replaced.update(enumerate(minus))
                longer.update(minus if n > least else ())
            whole.add(w)
        out.append(",".join(map(str, gone)))
    return out


def test_lines(make):
    rng = random.Random(2)
    vocabulary = ["a", "b", "É", "c\t", "D."]
    one = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))
    texts = ["\n".join(one() for _ in range(rng.randint(1, 6))) for _ in range(120)] + [None, "", "\n\n", " x  y ", "X Y"]
    texts += [" ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(3000) if i != 1500),
              " ".join(f"w{i}" if i != 7 else "other" for i in range(3000))]
    got = {r["doc_id"]: r for r in lines.counted(make(texts)).collect()}
    assert [got[i]["removed"] for i in range(len(texts))] == line_brute(texts)
    assert got[len(texts) - 1]["removed"] == "0"
    left = {r["doc_id"]: r["text"] for r in lines.drop_lines(make(texts)).collect()}
    for i, t in enumerate(texts):
        gone = set(filter(None, got[i]["removed"].split(",")))
        assert left[i] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if str(k) not in gone))


def test_lines_odd_rows(make):
    docs = make(["one two", "one two", "one two", None], ids=[None, 1, 1, None])
    got = sorted((r["doc_id"] or 0, r["n_removed"], r["n_lines"]) for r in lines.counted(docs).collect())
    assert got == [(0, 0, 1), (0, 0, 1), (1, 1, 1), (1, 1, 1)]
    assert lines.counted(docs.limit(0)).count() == 0


def rule_brute(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(i, i + 5))
    some = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(some) - len(set(some)), len(covered), failed)


@pytest.fixture(scope="module")
def rule_texts():
    rng = random.Random(8)
    words = ["the", "of", "and", "é", "$$$", "|", "a,", "x#", "zz"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))).replace(", ", ",\n") for _ in range(120)]
    return texts + [None, "", " \n ", "a b c d e", "a b c d e " * 2, "word " * 4000, "\x1c \x85 \xa0 x"]


def test_rules_base(make, rule_texts):
    got = {r["doc_id"]: r for r in rules.judged(make(rule_texts)).collect()}
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, t in enumerate(rule_texts):
        assert tuple(got[i][c] for c in cols) == rule_brute(t), repr(t)[:200]
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_rules_divergence(make):
    rng = random.Random(1)
    common = "the of and to in is that it on for was be with as at by".split()
    rare = ["w" + "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    clean = [" ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(150)) + "." for _ in range(60)]
    shout = " ".join(w.upper() + "!!" for w in clean[0].split())
    listed = " | ".join(rng.choice(rare) for _ in range(150))
    short = "SHORT LINE ALL IN CAPITALS HAS TEN WORDS AND NO MORE"
    docs = make([*clean, shout, listed, short, clean[1]], langs=["en"] * 63 + [None])
    got = {r["doc_id"]: r["kept"] for r in rules.judged(docs).collect()}
    assert all(got[i] for i in range(60)) and not got[60] and not got[61] and got[62] and got[63]
    assert rules.judged(docs.limit(0)).count() == 0
    assert rules.judged(docs).columns.count("kept") == 1
