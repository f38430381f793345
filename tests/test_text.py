import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import plain_chunks
from statlake.functions import text as tx

TEXTS = st.text(alphabet="ab .\n", max_size=400)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(5, 60), st.integers(0, 4))
def test_recursive_chunks_are_short_ordered_and_complete(text, size, overlap):
    chunks = plain_chunks.recursive_chunks(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    spans = plain_chunks.atoms(text, 0, size)
    assert "".join(text[a:b] for a, b in spans) == text
    at = 0
    for c in chunks:  # source order; a later chunk never starts before an earlier one
        found = text.find(c, at)
        assert found >= 0
        at = found
    runs = plain_chunks.pack([b - a for a, b in spans], size, overlap)
    covered = {i for a, b in runs for i in range(a, b)}
    assert covered == set(range(len(spans)))
    for (a, b), (c, d) in zip(runs, runs[1:]):
        assert a < c <= b < d
        assert sum(y - x for x, y in spans[c:b]) <= overlap


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(3, 20), st.integers(0, 2))
def test_sentence_chunks_lose_no_word(text, size, overlap):
    chunks = plain_chunks.sentence_chunks(text, size, 0)
    assert " ".join(chunks).split() == text.split()
    long = max((len(s.split()) for s in plain_chunks.sentence_chunks(text, 1, 0)), default=0)
    assert all(len(c.split()) <= max(size, long) for c in plain_chunks.sentence_chunks(text, size, overlap))


def test_splitters_equal_their_plain_form(spark):
    rng = random.Random(4)
    parts = ["a", "bc", "déf", "\U0001f600x", " ", " ", ". ", "! ", "?", "\n", "\n\n", "\n\n\n", "\t", "\xa0", "w" * 30, "."]
    texts = ["", " ", "\n\n", "w" * 90] + ["".join(rng.choices(parts, k=rng.randint(1, 120))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, text string")
    for strategy, size, overlap in (("recursive", 20, 7), ("recursive", 25, 0), ("recursive", 9, 8),
                                    ("sentences", 6, 3), ("sentences", 9, 0), ("sentences", 1, 0)):
        plain = getattr(plain_chunks, "recursive_chunks" if strategy == "recursive" else "sentence_chunks")
        got = {}
        for r in tx.chunk(df, "text", strategy, size, overlap).orderBy("i", "chunk_index").collect():
            got.setdefault(r.i, []).append(r.chunk_text)
            assert r.chunk_index == len(got[r.i]) - 1
        for i, t in enumerate(texts):
            assert got.get(i, []) == plain(t, size, overlap), (strategy, size, overlap, t)
        assert -1 not in got


def test_splitters_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    for strategy in ("recursive", "sentences"):
        plan = tx.chunk(df, "text", strategy)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_token_windows(spark):
    df = spark.createDataFrame([(" ".join(map(str, range(n))),) for n in (0, 1, 5, 6, 9, 10)],
                               "text string")
    got = tx.chunk(df, "text", "tokens", 5, 1).groupBy("text").agg(
        F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text"))).alias("c")).collect()
    for r in got:
        words = r.text.split()
        want = [" ".join(words[s:s + 5]) for s in range(0, max(len(words) - 1, 1), 4)]
        assert [c.chunk_text for c in r.c] == want
    assert len(got) == 5  # the empty text has no chunk


def test_paragraphs_keep_every_piece(spark):
    df = spark.createDataFrame([("a\n\n\n\nb\n\n",)], "text string")
    assert [r.chunk_text for r in tx.chunk(df, "text", "paragraphs").collect()] == ["a", "", "b", ""]


def test_both_cleaners_agree_on_plain_markup(spark):
    html = ("<p>A &amp; B</p>\n<script>var x = '<p>';</script><style>p{}</style>"
            "<!-- gone --> <b>C</b>&nbsp;D")
    df = spark.createDataFrame([(html,), (None,), ("no tags",)], "h string")
    got = df.select(tx.clean_html(F.col("h")).alias("a"),
                    tx.clean_html_strict(F.col("h")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("A & B C D", "A & B C D"), (None, None),
                                        ("no tags", "no tags")]


def test_intent_rules(spark):
    cases = [
        ("Make it a BAR chart please", True, (True, True, "bar")),
        ("switch to scatter", True, (True, True, "scatter")),
        ("switch to scatter", False, (True, False, "scatter")),
        ("show the bar of week 3", False, (False, True, "bar")),
        ("plot points", False, (False, True, "line")),
        ("who won?", True, (False, False, "line")),
        ("line graph or bar chart", False, (False, True, "bar")),
        ("change the team", True, (False, False, "line")),
    ]
    df = spark.createDataFrame([(i, q, p) for i, (q, p, _) in enumerate(cases)],
                               "i int, q string, p boolean")
    got = df.select("i", *[c.alias(n) for n, c in tx.chart_intent(
        F.col("q"), F.col("p")).items()]).collect()
    assert {r.i: (r.is_change, r.wants_chart, r.chart_type) for r in got} == {
        i: w for i, (_, _, w) in enumerate(cases)}


def test_compare_words(spark):
    df = spark.createDataFrame([("A b  c", "b C d e"), ("", "")], "l string, r string")
    got = df.select(*[c.alias(n) for n, c in tx.compare_words(
        tx.word_set(F.col("l")), tx.word_set(F.col("r"))).items()]).collect()
    assert [tuple(r) for r in got] == [(2, 1, 2, 0.4), (0, 0, 0, 0.0)]


def test_vectors_of_odd_texts(spark):
    """Unit length, the same weights for every use, NULL stays NULL, no words give zeros."""
    from statlake.plans import retrieval

    df = spark.createDataFrame([(0, "Ünit one, one"), (1, "one two"), (2, "...!"), (3, ""), (4, None)], "i int, t string")
    model = retrieval.fit_embedder(df, "t", 16)
    got = {r.i: r.values for r in retrieval.embed(df, "t", model).select("i", "values").collect()}
    assert got[4] is None and got[2] == got[3] == [0.0] * 16
    for i in (0, 1):
        assert len(got[i]) == 16 and abs(sum(v * v for v in got[i]) - 1) < 1e-6
    assert retrieval.fit_embedder(df.limit(0), "t", 4).idf == [0.0] * 4


def test_a_stored_place_is_enough_and_no_vector_is_computed_twice(spark, tmp_path, monkeypatch):
    from statlake.bindings import articles
    from statlake.plans import retrieval

    df = spark.createDataFrame([(0, "Ünit one, one"), (1, "one two"), (2, "...!"), (3, None)], "i int, t string")
    stored = df.withColumn("p", retrieval.word_places(F.col("t"), 16))
    model = retrieval.fit_embedder(df, "t", 16)
    assert retrieval.fit_embedder(stored, "p", 16, placed=True).idf == model.idf
    both = stored.select("i", model(F.col("t")).alias("a"), model.of_places(F.col("p")).alias("b")).collect()
    assert all(r.a == r.b for r in both) and {r.i for r in both if r.a is None} == {3}

    spark.createDataFrame([(1, "one two. " * 90, None)], "doc_id int, text string, lang string").write.parquet(
        str(tmp_path / "documents.parquet"))
    plan = articles.embed_documents(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("vectors(") == 1 and "md5" not in plan


def test_cover_sends_a_text_once(spark):
    from statlake.bindings import articles

    rows = [(1, "word " * 400 + "end"), (2, "ab" * 900), (3, " \n "), (4, None), (5, "x y"), (5, "x y")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = articles._cover(tx.chunk(df, "text", "recursive", 350, 75), 350, by_words=False)
    assert sorted(map(tuple, found.collect())) == [
        (1, 0, 0, 0, 1603), (2, 0, 0, 0, 1800), (5, 0, 0, 0, 2)]
    lost = tx.chunk(df, "text", "recursive", 350, 75).where("chunk_index <> 2")
    gaps = {r.doc_id: r.n_gaps for r in articles._cover(lost, 350, by_words=False).collect()}
    assert gaps[5] == 0 and set(gaps) == {1, 2, 5}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "(chunk_index#" in plan and " = 0) THEN text#" in plan
