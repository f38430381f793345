"""Information-theoretic sanitisation: personal data, and the words that give it away.

Patterns find the entities (e-mail and IP addresses, card and phone numbers). Protected are
each kind as a whole ("this document holds a phone number") and each single value that recurs.
A term is a letter word (``TERM_LETTERS`` letters or more, lower case), anywhere in a document.
With N documents, n(e) and n(t) of which hold entity and term, and n(t, e) of which hold both,

    disclosure = PMI / IC = ln(N n(t, e) / (n(t) n(e))) / ln(N / n(e))

is 1 when the term never occurs without the entity. In documents that hold the entity, every
place of the term is generalised from ``GENERALISE_AT`` on and removed from ``REMOVE_AT`` on.
Counts cover all documents. Copies of one text are no evidence: the texts that hold both must
fall into ``SUPPORT`` of 63 slots of their hash or more (a set of slots is one number, so it
is summed up before the shuffle); so must the texts that hold a value, for it to recur.

Built-in expressions only. Positions are code points from 0, ends exclusive. Results for odd
input: a NULL text is an empty one and has no spans; an entity in every document (IC 0) has
no terms; repeated rows get equal results; a very long text takes time in proportion to its
length and, for its n matches, to n ** 1.5; an empty table gives an empty result; other columns
are kept by ``sanitise``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake.llm.common import kept, packed, text_or_empty, unpacked

#: The kinds in their order, with their patterns. Possessive repeats and the
#: look at the character before say the same as the plain patterns, without backtracking.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
HINTS = {"email": "@", "phone": "+"}
TERM_LETTERS = 4
SUPPORT, GENERALISE_AT, REMOVE_AT = 3, 0.7, 0.95
SALTS, SLOTS = 32, 63

TERM = rf"(?<!\p{{L}})\p{{L}}{{{TERM_LETTERS},}}".replace("\\", "\\\\")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: p.cast("double") <= 255)
    if kind == "card":
        number = _digits(value)
        return F.when(F.length(number).between(13, 19), F.call_function("luhn_check", number)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _matches(kind: str) -> Column:
    hint = HINTS.get(kind)
    pattern = PATTERNS[kind].replace("\\", "\\\\")
    found = f"regexp_extract_all(_text, '{pattern}', 0)"
    if hint:
        found = f"if(contains(_text, '{hint}'), {found}, cast(array() as array<string>))"
    return F.expr(found)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(lengths: Column) -> Column:
    """The sum of all lengths before each one, by pieces of about the square root of their number."""
    add = lambda a, x: a + x
    root = lambda n: F.ceil(F.sqrt(F.size(n))).cast("int")
    pieces = lambda n: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(n) - 1) / root(n)).cast("int")), lambda i: F.slice(n, i * root(n) + 1, root(n)))
    totals = lambda c: F.transform(c, lambda x: F.aggregate(x, F.lit(0), add))
    before = lambda c: F.aggregate(
        totals(c), F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    within = lambda c, o: F.transform(c, lambda x, j: o + F.aggregate(F.slice(c, F.lit(1), j), F.lit(0), add))
    sums = lambda c: F.flatten(F.filter(F.zip_with(c, before(c), within), lambda x: x.isNotNull()))
    return _let(lengths, lambda n: F.when(F.size(n) > 0, _let(pieces(n), sums)).otherwise(
        F.expr("cast(array() as array<int>)")))


def _placed(pattern: str, matches: Column) -> Column:
    """Matches (start, stop, value). A text is its gaps and matches in turn, so places are sums of lengths."""
    gaps = F.expr(f"split(_text, '{pattern}', -1)")
    turns = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    lengths = lambda z: F.transform(z, lambda x: x["g"] + F.coalesce(F.length(x["m"]), F.lit(0)))
    place = lambda x, at: F.struct(
        (at + x["g"]).alias("start"), (at + x["g"] + F.length(x["m"])).alias("stop"), x["m"].alias("value"))
    places = _let(turns, lambda z: F.filter(F.zip_with(z, _starts(lengths(z)), place), lambda s: s["value"].isNotNull()))
    none = F.expr("cast(array() as array<struct<start:int,stop:int,value:string>>)")
    return F.when(F.size(matches) > 0, places).otherwise(none)


def entities(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text``, ``_hash`` and the valid matches of each kind, ``_e_<kind>``."""
    rows = docs.withColumn("_text", text_or_empty())
    rows = rows.withColumns({f"_m_{k}": _matches(k) for k in PATTERNS})

    def checked(kind: str) -> Column:
        placed = _placed(PATTERNS[kind].replace("\\", "\\\\"), F.col(f"_m_{kind}"))
        return F.transform(F.filter(placed, lambda s: _valid(kind, s["value"])), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))

    rows = rows.withColumns({f"_e_{k}": checked(k) for k in PATTERNS}).withColumn("_hash", F.xxhash64("_text"))
    return rows.drop(*[f"_m_{k}" for k in PATTERNS])


def _all(rows: DataFrame) -> Column:
    return F.concat(*[F.col(f"_e_{k}") for k in PATTERNS])


def _some(found: DataFrame) -> Column:
    return F.expr(" or ".join(f"size(_e_{k}) > 0" for k in PATTERNS))


def _support(hash_: str = "_hash") -> Column:
    """The number of slots that texts fall into."""
    return F.bit_count(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(hash_, F.lit(SLOTS)).cast("int"))))


def _salted(few: DataFrame) -> DataFrame:
    """One row for each salt, so that no key of the other side is hot."""
    return few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def protected(found: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Each different text with entities (_hash, n copies, its entities and terms), and the entities with n_e."""
    value = lambda e: F.concat_ws(":", e["kind"], F.lower(e["value"]))
    texts = found.where(_some(found)).groupBy("_hash").agg(
        F.count("*").alias("n"),
        F.any_value(F.array_distinct(F.transform(_all(found), lambda e: e["kind"]))).alias("kinds"),
        F.any_value(F.array_distinct(F.transform(_all(found), value))).alias("values"),
        F.any_value(F.array_distinct(F.expr(f"regexp_extract_all(lower(_text), '{TERM}', 0)"))).alias("terms"))
    texts = kept(texts, "pii")
    each = texts.select("_hash", "n", F.explode(F.concat("kinds", "values")).alias("entity"))
    counted = (each.groupBy("entity").agg(F.sum("n").alias("n_e"), _support().alias("texts"))
               .where(F.col("texts") >= support).drop("texts"))
    # Values that recur; most occur once.
    recur = (each.where(F.contains("entity", F.lit(":"))).withColumn("_salt", _salt("_hash"))
             .join(_salted(counted.select("entity")), ["entity", "_salt"])
             .groupBy("_hash").agg(F.collect_list("entity").alias("recur")))
    texts = texts.join(recur, "_hash", "left")
    entity = F.concat("kinds", F.coalesce("recur", F.expr("cast(array() as array<string>)")))
    return texts.select("_hash", "n", "terms", entity.alias("entities")), counted


def disclosing(docs: DataFrame, texts: DataFrame, counted: DataFrame, support: int = SUPPORT,
               at_least: float = GENERALISE_AT) -> DataFrame:
    """Terms that reveal an entity: entity, term, disclosure."""
    pairs = (texts.select("_hash", "n", "terms", F.explode("entities").alias("entity"))
             .select("_hash", "n", "entity", F.explode("terms").alias("term"))
             .groupBy("entity", "term").agg(F.sum("n").alias("both"), _support().alias("texts"))
             .where(F.col("texts") >= support).withColumn("_salt", _salt("term")))
    words = docs.select(F.explode(F.array_distinct(F.expr(
        f"regexp_extract_all(lower(coalesce(text, '')), '{TERM}', 0)"))).alias("w"))
    of_term = words.groupBy(F.xxhash64("w").alias("_w")).agg(F.count("*").alias("n_t"))
    n = docs.agg(F.count("*").alias("n_all"))
    pmi = F.log(F.col("n_all") * F.col("both") / (F.col("n_t") * F.col("n_e")))
    content = F.log(F.col("n_all") / F.col("n_e"))
    # The number of documents is one row.
    return (pairs.join(_salted(counted), ["entity", "_salt"]).withColumn("_w", F.xxhash64("term")).join(of_term, "_w")
            .join(F.broadcast(n)).where(content > 0)
            .select("entity", "term", (pmi / content).alias("disclosure"))
            .where(F.col("disclosure") >= at_least))


def spans(docs: DataFrame, support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
          remove_at: float = REMOVE_AT) -> DataFrame:
    """``docs`` with ``_base`` and ``_terms``: the spans of entities and of their terms.

    Both are arrays of (kind, start, stop), base ones by kind as listed, then start; terms
    are of kind ``generalise`` or ``remove``, by kind, then start.
    """
    found = entities(docs)
    texts, counted = protected(found, support)
    marks = disclosing(docs, texts, counted, support, generalise_at)
    # A term that reveals several entities of a text counts with its highest disclosure.
    one = (texts.select("_hash", "terms", F.explode("entities").alias("entity"))
           .select("_hash", "entity", F.explode("terms").alias("term")).withColumn("_salt", _salt("_hash")))
    hits = (one.join(_salted(marks), ["entity", "term", "_salt"]).groupBy("_hash", "term")
            .agg((F.max("disclosure") >= remove_at).alias("gone"))
            .groupBy("_hash").agg(
                F.collect_list(F.when(F.col("gone"), F.col("term"))).alias("_remove"),
                F.collect_list(F.when(~F.col("gone"), F.col("term"))).alias("_generalise")))
    # Copies of a text share its terms: the texts with terms are repeated for each salt, and
    # documents without entities get keys of their own, so that no key is hot.
    hits = _salted(hits).withColumnRenamed("_hash", "_key")
    base = F.transform(_all(found), lambda e: F.struct(e["kind"], e["start"], e["stop"]))
    rows = found.withColumn("_base", base).drop(*[f"_e_{k}" for k in PATTERNS])
    some = F.size("_base") > 0
    rows = rows.withColumns({
        "_key": F.when(some, F.col("_hash")).otherwise(F.xxhash64("doc_id", "_hash")),
        "_salt": F.when(some, _salt("doc_id")).otherwise(-1).cast("int")})
    rows = rows.join(hits, ["_key", "_salt"], "left")
    placed = _placed(TERM, F.when(F.col("_remove").isNotNull(), F.expr(f"regexp_extract_all(_text, '{TERM}', 0)"))
                     .otherwise(F.expr("cast(array() as array<string>)")))
    rows = rows.withColumn("_words", placed)

    def places(kind: str) -> Column:
        mine = F.filter("_words", lambda s: F.array_contains(f"_{kind}", F.lower(s["value"])))
        return F.transform(mine, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

    none = F.expr("cast(array() as array<struct<kind:string,start:int,stop:int>>)")
    return (rows.withColumn("_terms", F.when(F.col("_remove").isNotNull(), F.concat(places("generalise"), places("remove")))
                            .otherwise(none))
            .drop("_key", "_salt", "_hash", "_words", "_remove", "_generalise"))


def listed(spans_: Column) -> Column:
    return F.array_join(F.transform(
        spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the sanitised text: entities become their kind, terms [TERM] or nothing.

    Where spans overlap, the one that starts first (then the longer one) is replaced and
    the others go as far as it covers them; a rest is replaced by nothing.
    """
    rows = spans(packed(docs, "doc_id", "text"), **options)
    parts = F.array_sort(F.transform(F.concat("_base", "_terms"), lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("end"), s["kind"].alias("kind"))))
    label = F.expr("""aggregate(_parts, struct(0 as at, cast(array() as array<string>) as out), (a, s) -> struct(
        greatest(a.at, -s.end) as at,
        if(-s.end <= a.at, a.out, concat(a.out, array(
            substring(_text, a.at + 1, s.start - a.at),
            if(s.start < a.at, '', case s.kind when 'generalise' then '[TERM]' when 'remove' then ''
               else concat('[', upper(s.kind), ']') end)))) as out),
        a -> concat(array_join(a.out, ''), substring(_text, a.at + 1, length(_text))))""")
    return rows.withColumn("_parts", parts).withColumn("text", F.when(
        F.col("text").isNotNull(), label)).select(
        *unpacked(docs.columns, "doc_id", "text"))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts by kind, the hash of the base spans, all spans, terms and their number."""
    rows = spans(docs, **options)
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in PATTERNS],
        F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(F.concat("_base", "_terms")).alias("spans"),
        F.size("_terms").cast("long").alias("n_terms"))
