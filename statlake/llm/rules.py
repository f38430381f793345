"""Quality rules: fixed rules, and the divergence of a text from its language.

Each language has two reference histograms, made from all its documents: of character classes
and of its ``COMMON`` most frequent words (and all others as one). A document is compared with
the references of its ``lang`` by Jensen-Shannon distance (base 2, 0 to 1). It is kept if it
passes the fixed rules and neither distance is above its limit. Histograms of fewer than
``MIN_CHARS`` characters or ``MIN_WORDS`` words say nothing and pass, as do documents of a
language without a reference (fewer than ``MIN_DOCS`` documents, or NULL).

Fixed rules (``base_failed``): fewer than 10 words, or more than 20 % of the words inside
5-word windows that the text holds twice or more.

Built-in expressions only; each document is judged within its row. Results for odd input: a
NULL text has no words and fails; repeated rows get equal results; of equally frequent words
the first by code point is common; an empty table gives an empty result; other columns are
kept by ``judged``, but for those with the names of its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from statlake.llm.common import packed, text_or_empty, unpacked

#: Fixed values of the rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
COMMON = 16
MIN_CHARS, MIN_WORDS, MIN_DOCS = 60, 60, 20
CHAR_LIMIT, WORD_LIMIT = 0.28, 0.42
#: Languages are few; beyond this number their references are not sent to every task.
MOST_BROADCAST = 2000

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept", "char_distance", "word_distance"]
CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^\p{Nd}]+", "space": r"[^\x20\x09-\x0D]+",
           "letter": r"[^\p{L}]+", "point": r"[^.,;:!?'\"()-]+"}


def _classed(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of characters, ``_n``, and of those of each class, ``_<class>``.

    Most characters are letters; all other classes are counted in what is left without them.
    """
    count = lambda text, pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    rows = rows.withColumns({"_n": F.length("_text").cast("long"), "_upper": count("_text", CLASSES["upper"]),
                             "_other": F.regexp_replace("_text", r"\p{L}+", "")})
    rows = rows.withColumns({
        "_letter": F.col("_n") - F.length("_other"),
        "_symbol": F.regexp_count("_other", F.lit(r"[#*$%&|<>]")).cast("long"),
        **{f"_{k}": count("_other", CLASSES[k]) for k in ("digit", "space", "point")}})
    return rows.drop("_other")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the words, the base columns and the histogram of character classes."""
    rows = _classed(docs.withColumn("_text", text_or_empty()))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    rows = rows.withColumn("_grams", F.when(F.col("n_words") > WINDOW, F.expr(
        f"transform(slice(_words, 1, size(_words) - {WINDOW - 1}), (w, i) -> "
        f"xxhash64(w, {', '.join(f'_words[i + {k}]' for k in range(1, WINDOW))}))")))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_lines", lines)
    # Most texts repeat nothing: the ordering of windows is only worked out for the others.
    repeats = F.size("_grams") > F.size(F.array_distinct("_grams"))
    rows = rows.withColumn("_sorted", F.when(repeats, F.expr(
        "array_sort(transform(_grams, (g, i) -> struct(g as g, i as i)))")))
    rows = rows.withColumn("_places", F.when(F.col("_sorted").isNotNull(), F.expr(
        "array_sort(filter(transform(_sorted, (s, i) -> if("
        "s.g <=> get(_sorted, i - 1).g or s.g <=> get(_sorted, i + 1).g, s.i, null)), x -> x is not null))")))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.coalesce(
            F.least(F.lit(WINDOW), F.get("_places", i + 1) - p), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, n: a + n)
    rows = rows.withColumns({
        "word_chars": F.col("_n") - F.col("_space"),
        "n_symbols": F.col("_symbol"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long")})
    rest = F.col("_n") - F.col("_digit") - F.col("_space") - F.col("_letter") - F.col("_point") - F.col("n_symbols")
    rows = rows.withColumn("_chars", F.array(
        "_upper", F.col("_letter") - F.col("_upper"), "_digit", "_space", "_point", "n_symbols",
        F.greatest(rest, F.lit(0))))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop(
        "_grams", "_lines", "_sorted", "_places", "_n", "_symbol", *[f"_{k}" for k in CLASSES])


def references(docs: DataFrame) -> DataFrame:
    """One row a language: shares of character classes, common words and their shares."""
    rows = docs.where("lang is not null").withColumn("_text", text_or_empty())
    words = rows.select("lang", F.explode(F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "")).alias("w"))
    counts = words.groupBy("lang", "w").agg(F.count("*").alias("n"))
    top = W.partitionBy("lang").orderBy(F.desc("n"), "w")
    common = counts.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= COMMON)
    common = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "w", "n"))).alias("c"))
    parts = _classed(rows).select("lang", F.col("_n").alias("n"), F.col("_symbol").alias("symbols"),
                                  *[F.col(f"_{k}").alias(k) for k in CLASSES])
    # The words of a language are summed from the same shuffle that finds the common ones.
    totals = counts.groupBy("lang").agg(F.sum("n").cast("double").alias("words"))
    sums = parts.groupBy("lang").agg(
        F.count("*").alias("docs"), *[F.sum(c).cast("double").alias(c) for c in ["n", "symbols", *CLASSES]])
    rest = F.col("n") - F.col("digit") - F.col("space") - F.col("letter") - F.col("point") - F.col("symbols")
    chars = F.array("upper", F.col("letter") - F.col("upper"), "digit", "space", "point", "symbols",
                    F.greatest(rest, F.lit(0.0)))
    listed = F.transform("c", lambda x: x["n"].cast("double"))
    others = F.col("words") - F.aggregate(listed, F.lit(0.0), lambda a, x: a + x)
    return (sums.where(F.col("docs") >= MIN_DOCS).join(common, "lang").join(totals, "lang").select(
        F.col("lang").alias("_lang"), chars.alias("_ref_chars"),
        F.transform("c", lambda x: x["w"]).alias("_common"), F.concat(listed, F.array(others)).alias("_ref_words")))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as counts of the same classes."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    t, r = F.greatest(total(counts), F.lit(1.0)), F.greatest(total(reference), F.lit(1.0))
    shares = F.zip_with(counts, reference, lambda x, y: F.struct((x / t).alias("p"), (y / r).alias("q")))
    sum_ = F.aggregate(shares, F.lit(0.0), lambda a, s: a + half(s["p"], (s["p"] + s["q"]) / 2)
                       + half(s["q"], (s["p"] + s["q"]) / 2))
    return F.sqrt(F.greatest(sum_ / 2, F.lit(0.0)))


def judged(docs: DataFrame, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """``docs`` with the base columns, both distances (NULL: guarded) and ``kept``."""
    refs = references(docs)
    if docs.select("lang").distinct().limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        refs = F.broadcast(refs)
    needed = ("doc_id", "text", "lang")
    rows = measured(packed(docs, *needed)).join(refs, F.col("lang") == F.col("_lang"), "left")
    # Shares of the total are taken of few numbers; the totals are worked out beforehand.
    found = F.filter("_words", lambda w: F.array_contains("_common", w))
    rows = rows.withColumn("_found", F.when(F.col("n_words") >= MIN_WORDS, found))
    counts = F.transform("_common", lambda c: F.size(F.filter("_found", lambda w: w == c)))
    rows = rows.withColumn("_counts", F.concat(counts, F.array(F.size("_words") - F.size("_found"))))
    rows = rows.withColumns({
        "char_distance": F.when(F.aggregate("_chars", F.lit(0).cast("long"), lambda a, x: a + x) >= MIN_CHARS,
                                js_distance(F.col("_chars"), F.col("_ref_chars"))),
        "word_distance": F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("_counts"), F.col("_ref_words")))})
    far = (F.coalesce("char_distance", F.lit(0.0)) > char_limit) | (F.coalesce("word_distance", F.lit(0.0)) > word_limit)
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~far)
    return rows.select(*unpacked([c for c in docs.columns if c not in RESULTS], *needed), *RESULTS)
