"""Line deduplication within one word edit, by a deletion-neighbourhood join.

A line is the words between line breaks, in lower case. It goes if an earlier line (smaller
doc_id, or further up in its document) has the same words or, from ``NEAR_WORDS`` words on in
both, differs by one word replaced, added or left out. Lines without words stay.

Equal lines are brought together first; the first of them stands for all. Two lines within one
edit share the words before or after the edit, so they share one half of their words; lines
whose halves no other line has are set aside. The others emit their deletion neighbourhood:
every variant with one word left out, as a hash of the words that stay and their places (sums
of hashes, so a variant costs one subtraction). Equal variants of the same place mean a word
replaced; a variant equal to a whole line means a word more. Each variant meets the earliest
line with it, never all others, and the pair's words are compared before a line goes.

Built-in expressions only. Results for odd input: a NULL text has one line without words and
stays NULL; NULL doc_ids come first; rows that repeat doc_id and text are one document and get
equal results; rows of one doc_id with different texts come in the order of their hashes; an
empty table gives an empty result; other columns are kept by ``drop_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from statlake.llm.common import kept, packed, text_or_empty, unpacked

NEAR_WORDS = 5
FIRST_ID = -(1 << 63)
_SPACE = r"[\x20\x09-\x0D]+"


def _place(word: str, at: str) -> str:
    """Two hashes of 40 bits of a word and its place; sums of them stay below 2^62."""
    h = f"xxhash64({word}, {at})"
    return f"struct({h} & 1099511627775L as x, shiftrightunsigned({h}, 24) as y)"


def numbered(docs: DataFrame) -> DataFrame:
    """doc, tag (hash of the text), line_no from 0, words as text, both hashes and halves."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc"),
                       F.xxhash64(text_or_empty()).alias("tag"), F.lower(text_or_empty()).alias("text"))
    lines = rows.select("doc", "tag", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # Most lines have single blanks between their words and need no pattern.
    odd = reduce(lambda a, b: a | b, [F.contains("line", F.lit(x)) for x in ("  ", "\t", "\x0b", "\f", "\r")])
    words = F.trim(F.when(odd, F.regexp_replace("line", _SPACE, " ")).otherwise(F.col("line")))
    lines = lines.select("doc", "tag", "line_no", words.alias("norm")).where("norm <> ''")
    return lines.withColumns({"h": F.xxhash64("norm"), "g": F.xxhash64(F.lit("g"), "norm")})


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row for each different line: its words, first place and number."""
    return kept(lines.groupBy("h", "g").agg(
        F.min(F.struct("doc", "tag", "line_no")).alias("first"), F.count("*").alias("copies"),
        F.first("norm").alias("norm")), "lines")


def candidates(unique: DataFrame) -> DataFrame:
    """The lines that share a half with another line."""
    n = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1
    words = unique.select("h", "norm", n.cast("int").alias("n")).where(F.col("n") >= NEAR_WORDS - 1)
    words = words.withColumns({"q": F.expr("n div 2").cast("int"), "r": F.expr("(n + 1) div 2").cast("int")})
    half = "xxhash64('first', {0}, substring_index(norm, ' ', {0})), xxhash64('last', {0}, substring_index(norm, ' ', -{0}))"
    keys = kept(words.select("h", "n", F.explode(F.expr(
        f"if(q = r, array({half.format('q')}), array({half.format('q')}, {half.format('r')}))")).alias("key")), "halves")
    shared = (keys.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"),
                                      F.min("n").alias("least"), F.max("n").alias("most"))
              .where("lo <> hi").select("key", (F.col("least") < F.col("most")).alias("other_length")))
    hits = keys.join(shared, "key").groupBy("h").agg(F.max("other_length").alias("other_length"))
    return kept(unique.join(hits, "h").select("h", "g", "first", "norm", "other_length"), "near")


def _earliest(variants: DataFrame) -> DataFrame:
    """For each line and variant the earliest line with the variant, if another one."""
    best = (variants.groupBy("key").agg(F.min(F.struct("first", "h", "g")).alias("best"), F.max("first").alias("latest"))
            .where(F.col("best.first") < F.col("latest")))
    return variants.join(best, "key").where(F.col("best.first") < F.col("first")).select(
        "h", "g", F.col("best.h").alias("h0"), F.col("best.g").alias("g0"))


def near_pairs(near: DataFrame) -> DataFrame:
    """Lines (h, g) with an earlier line (h0, g0) that has an equal variant."""
    rows = near.select("h", "g", "first", "other_length", F.split("norm", " ").alias("w"))
    rows = rows.withColumn("n", F.size("w"))
    add = "(a, s) -> struct(a.x + s.x as x, a.y + s.y as y)"
    zero = "cast(struct(0, 0) as struct<x:bigint,y:bigint>)"
    rows = rows.withColumn("total", F.expr(f"aggregate(transform(w, (v, i) -> {_place('v', 'i')}), {zero}, {add})"))
    each = rows.select("h", "g", "first", "other_length", "n", "total", F.posexplode("w").alias("i", "v"))
    each = each.withColumn("own", F.expr(_place("v", "i")))

    replaced = each.where(F.col("n") >= NEAR_WORDS).select("h", "g", "first", F.xxhash64(
        F.lit("replaced"), "n", "i", F.col("total.x") - F.col("own.x"), F.col("total.y") - F.col("own.y")).alias("key"))

    # One word more: what follows the place left out moves up by one.
    longer = each.where("other_length").withColumn("moved", F.expr(_place("v", "i - 1")))
    before = W.partitionBy("h", "g").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("h", "g").orderBy("i").rowsBetween(1, W.unboundedFollowing)
    left = longer.where(F.col("n") > NEAR_WORDS).select("h", "g", "first", "n", *[
        (F.coalesce(F.sum(f"own.{c}").over(before), F.lit(0)) + F.coalesce(F.sum(f"moved.{c}").over(after), F.lit(0))).alias(c)
        for c in "xy"]).select("h", "g", "first", F.xxhash64(F.lit("longer"), F.col("n") - 1, "x", "y").alias("key"))
    whole = rows.where(F.col("other_length") & (F.col("n") >= NEAR_WORDS)).select(
        "h", "g", "first", F.xxhash64(F.lit("longer"), "n", "total.x", "total.y").alias("key"))
    # Only a whole line and its longer ones are one edit apart, not the longer ones.
    out = _earliest(replaced)
    left, whole = left.distinct(), whole.distinct()
    first_longer = left.groupBy("key").agg(F.min(F.struct("first", "h", "g")).alias("best"))
    a = whole.join(first_longer, "key").where(F.col("best.first") < F.col("first"))
    b = left.join(whole.groupBy("key").agg(F.min(F.struct("first", "h", "g")).alias("best")), "key").where(
        F.col("best.first") < F.col("first"))
    for found in (a, b):
        out = out.union(found.select("h", "g", F.col("best.h").alias("h0"), F.col("best.g").alias("g0")))
    return out.distinct()


def one_edit(a: str, b: str) -> Column:
    """Whether two arrays of words are one edit apart: equal but for one place.

    ``k`` words from the start and the rest from the end agree, so the lengths of the
    parts that agree tell.
    """
    return F.expr(f"""
        case when size({a}) = size({b}) then size(filter(zip_with({a}, {b}, (x, y) -> x <> y), d -> d)) = 1
             when size({a}) = size({b}) + 1 then aggregate(zip_with(slice({a}, 1, size({b})), {b}, (x, y) -> x = y),
                      struct(0 as k, true as on), (s, e) -> struct(if(s.on and e, s.k + 1, s.k) as k, s.on and e as on),
                      s -> slice({a}, s.k + 2, size({a})) = slice({b}, s.k + 1, size({b})))
             when size({b}) = size({a}) + 1 then aggregate(zip_with(slice({b}, 1, size({a})), {a}, (x, y) -> x = y),
                      struct(0 as k, true as on), (s, e) -> struct(if(s.on and e, s.k + 1, s.k) as k, s.on and e as on),
                      s -> slice({b}, s.k + 2, size({b})) = slice({a}, s.k + 1, size({a})))
             else false end""")


def gone_lines(docs: DataFrame) -> DataFrame:
    """doc, tag, line_no of the lines that go, and ``near``: whether for a near one only."""
    lines = numbered(docs)
    unique = distinct_lines(lines)
    near = candidates(unique)
    pairs = near_pairs(near)
    words = near.select("h", "g", F.split("norm", " ").alias("w"))
    other = words.select(F.col("h").alias("h0"), F.col("g").alias("g0"), F.col("w").alias("w0"))
    gone = (pairs.join(words, ["h", "g"]).join(other, ["h0", "g0"]).where(one_edit("w", "w0"))
            .select("h", "g").distinct().withColumn("near", F.lit(True)))
    told = unique.select("h", "g", "first", "copies").join(gone, ["h", "g"], "left").where("near or copies > 1")
    told = told.select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    found = lines.drop("norm").join(told, ["h", "g"])
    return found.where(F.col("near") | (F.struct("doc", "tag", "line_no") > F.col("first"))).select(
        "doc", "tag", "line_no", "near")


def _lists(docs: DataFrame) -> DataFrame:
    return gone_lines(docs).groupBy("doc", "tag").agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))


def _joined(docs: DataFrame) -> DataFrame:
    rows = docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)),
                             "_tag": F.xxhash64(text_or_empty())})
    return rows.join(_lists(docs).withColumnsRenamed({"doc": "_doc", "tag": "_tag"}), ["_doc", "_tag"], "left")


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines left out of ``text``."""
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    rows = _joined(packed(docs, "doc_id", "text"))
    return rows.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)).select(
        *unpacked(docs.columns, "doc_id", "text"))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the numbers of the lines that go, from 0."""
    rows = docs.select("doc_id", "text")
    small = _joined(rows.withColumn("n_lines", F.size(F.split(text_or_empty(), "\n")).cast("long")))
    gone = F.coalesce("_gone", F.expr("cast(array() as array<int>)"))
    return small.select("doc_id", "n_lines", F.size(gone).cast("long").alias("n_removed"),
                        F.array_join(F.transform(gone, lambda x: x.cast("string")), ",").alias("removed"))
