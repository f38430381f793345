"""The operators of this folder bound to the test tables, with DuckDB SQL where it can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from statlake.llm import (codes, collocations, decontaminate, language, lines, mixing, neardup, pii, resampling,
                          rules, substrings, tokens, toxicity)
from statlake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op2_language(spark, folder):
    part = "crc32(cast(doc_id as string)) % 4"
    docs = documents(spark, folder)
    model = language.learn(docs, f"{part} <> 2")
    held = docs.withColumn("held_out", F.coalesce(F.expr(f"{part} = 2"), F.lit(False)))
    return language.predict(held, model, "held_out")


@query()
def op3_mixing(spark, folder):
    return mixing.taken_words(documents(spark, folder))


@query()
def op6_quality(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored, least, _ = resampling.resample(documents(spark, folder), labels)
    return scored.select("doc_id", "log_weight", "key",
                         (F.col("key") >= (float("inf") if least is None else least)).alias("kept"))


@query()
def op7_tokens(spark, folder):
    return tokens.read_tokens(spark, tokens.write_tokens(documents(spark, folder)))


@query()
def op1_pii(spark, folder):
    return pii.digest(documents(spark, folder))


def _js(counts: str, reference: str) -> str:
    p, q = f"({counts}[i] / greatest(list_sum({counts}), 1))", f"({reference}[i] / greatest(list_sum({reference}), 1))"
    half = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({0} + {1}) / 2)) ELSE 0 END"
    return (f"round(sqrt(greatest(list_sum(list_transform(range(1, len({counts}) + 1), "
            f"lambda i: {half.format(p, q)} + {half.format(q, p)})) / 2, 0)), 6)")


RULES = rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS symbols,
  {", ".join(f"length(regexp_replace(t, '{p.replace("'", "''")}', '', 'g')) AS {k}" for k, p in rules.CLASSES.items())} FROM t),
c AS (SELECT *, [upper, letter - upper, digit, space, point, symbols,
  greatest(length(t) - digit - space - letter - point - symbols, 0)]::DOUBLE[] AS chars FROM m),
g AS (SELECT doc_id, u.i, array_to_string(w[u.i:u.i + 4], ' ') AS gram FROM m, unnest(range(1, len(w) - 3)) AS u(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
cover AS (SELECT doc_id, count(DISTINCT r.i + k.k) AS n FROM r, unnest(range(0, 5)) AS k(k) GROUP BY doc_id),
words AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM m WHERE lang IS NOT NULL)
  GROUP BY lang, word),
top AS (SELECT lang, list(word ORDER BY n DESC, word) AS common, list(n ORDER BY n DESC, word) AS counts
  FROM (SELECT * FROM words QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {rules.COMMON}) GROUP BY lang),
ref AS (SELECT lang, common, list_append(counts, total - list_sum(counts))::DOUBLE[] AS ref_words,
  list_transform(sums, lambda x: x)::DOUBLE[] AS ref_chars FROM top JOIN (SELECT lang, sum(len(w)) AS total, count(*) AS docs,
  [sum(upper), sum(letter) - sum(upper), sum(digit), sum(space), sum(point), sum(symbols), greatest(
  sum(length(t)) - sum(digit) - sum(space) - sum(letter) - sum(point) - sum(symbols), 0)] AS sums
  FROM m GROUP BY lang) USING (lang) WHERE docs >= {rules.MIN_DOCS}),
j AS (SELECT c.*, ref.common, ref_words, ref_chars, coalesce(cover.n, 0) AS n_repeat,
  list_append(list_transform(ref.common, lambda x: len(list_filter(w, lambda y: y = x))),
  len(list_filter(w, lambda y: NOT list_contains(ref.common, y))))::DOUBLE[] AS counts
  FROM c LEFT JOIN ref USING (lang) LEFT JOIN cover USING (doc_id)),
d AS (SELECT *, CASE WHEN list_sum(chars) >= {rules.MIN_CHARS} THEN {_js("chars", "ref_chars")} END AS char_distance,
  CASE WHEN len(w) >= {rules.MIN_WORDS} THEN {_js("counts", "ref_words")} END AS word_distance,
  len(w) < 10 OR 100 * n_repeat > 20 * len(w) AS base_failed FROM j)
SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, symbols::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(char_distance, 0) <= {rules.CHAR_LIMIT} AND coalesce(word_distance, 0) <= {rules.WORD_LIMIT} AS kept,
  char_distance, word_distance FROM d"""


@query(RULES)
def op5_rules(spark, folder):
    return rules.judged(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")])


@query()
def op9_decontaminate(spark, folder):
    found = decontaminate.marked(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    best = F.array_max(F.transform("_items", lambda x: x["share"]))
    return found.select(
        "doc_id", (F.size("_items") > 0).alias("contaminated"),
        F.sort_array(F.transform("_items", lambda x: x["item_id"])).alias("item_ids"),
        F.coalesce(best, F.lit(0.0)).alias("share"))


@query()
def op8_neardup(spark, folder):
    return neardup.classes(documents(spark, folder))


@query()
def op10_suffixes(spark, folder):
    return substrings.remove_repeats(documents(spark, folder)).drop("kept")


LINES = r"""
WITH lines AS (SELECT doc_id, u.i - 1 AS line_no, len(s) AS n_lines,
  trim(regexp_replace(lower(s[u.i]), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents) d, unnest(range(1, len(s) + 1)) AS u(i)),
whole AS (SELECT norm, min({'d': doc_id, 'l': line_no}) AS first, string_split(norm, ' ') AS w
  FROM lines WHERE norm <> '' GROUP BY norm),
words AS (SELECT norm, first, w, len(w) AS n FROM whole WHERE len(w) >= 5),
less AS (SELECT norm, first, n, i, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS rest
  FROM words, unnest(range(1, n + 1)) AS u(i)),
near AS (
  SELECT a.norm FROM less a JOIN (SELECT rest, i, min(first) AS f FROM less GROUP BY rest, i) b
    ON a.rest = b.rest AND a.i = b.i AND b.f < a.first
  UNION SELECT a.norm FROM words a JOIN (SELECT rest, min(first) AS f FROM less WHERE n > 5 GROUP BY rest) b
    ON a.norm = b.rest AND b.f < a.first
  UNION SELECT a.norm FROM less a JOIN words b ON a.n > 5 AND a.rest = b.norm AND b.first < a.first),
told AS (SELECT l.doc_id, l.n_lines, l.line_no, l.norm <> '' AND ({'d': l.doc_id, 'l': l.line_no} > w.first
  OR l.norm IN (SELECT norm FROM near)) AS gone FROM lines l LEFT JOIN whole w ON l.norm = w.norm)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
  coalesce(string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (gone), '') AS removed
FROM told GROUP BY doc_id"""


@query(LINES)
def op4_lines(spark, folder):
    return lines.counted(documents(spark, folder))


@query()
def op11_toxicity(spark, folder):
    part = "crc32(cast(doc_id as string)) % 5"
    docs = documents(spark, folder)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"), f"{part} <> 0")
    found = toxicity.scored(docs.select("doc_id", "text"), lexicon)
    score = F.col("toxicity.score")
    return found.select("doc_id", F.coalesce(F.expr(f"{part} = 0"), F.lit(False)).alias("held_out"),
                        score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                        F.size("toxicity.hits").cast("long").alias("n_hits"))


def _codes_sql() -> str:
    """Rounds of nearest entries and rounded means; whole numbers in doubles are exact here."""
    near = """a{0} AS MATERIALIZED (SELECT vec_id, part, v, min({{'d': list_inner_product(v, v)
    - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'e': entry}}) AS m
  FROM p JOIN c{0} USING (part) GROUP BY vec_id, part, v)"""
    mean = """m{0} AS (SELECT part, entry, list(x ORDER BY i) AS v FROM (SELECT part, m.e AS entry, u.i, floor(sum(v[u.i]) / count(*)) AS x
  FROM a{0}, unnest(range(1, len(v) + 1)) AS u(i) GROUP BY part, m.e, u.i) GROUP BY part, entry),
c{1} AS MATERIALIZED (SELECT part, entry, coalesce(m{0}.v, c) AS c FROM c{0} LEFT JOIN m{0} USING (part, entry))"""
    rounds = ",\n".join(f"{near.format(k)},\n{mean.format(k, k + 1)}" for k in range(codes.ROUNDS))
    last = codes.ROUNDS
    return f"""
WITH x AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, u.k AS part, list_transform(e[u.k * len(e) // 4 + 1:(u.k + 1) * len(e) // 4],
  lambda x: floor(1024 * x::DOUBLE)) AS v FROM x, unnest(range(0, 4)) AS u(k)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM p
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {codes.ENTRIES}),
{rounds},
{near.format(last)},
coded AS (SELECT vec_id, string_agg(printf('%02x', m.e::INT), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error
  FROM a{last} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(u.x::BIGINT::VARCHAR, ',' ORDER BY part, entry, u.i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS x, unnest(range(0, len(c))) AS i FROM c{last}) u)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN x USING (vec_id) CROSS JOIN book"""


@query(_codes_sql())
def op12_codes(spark, folder):
    coded, codebook = codes.compressed(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error",
        F.lit(None if codebook is None else codes.fingerprint(codebook)).cast("string").alias("codebooks_sha256"))


COLLOCATIONS = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t)),
g AS (SELECT lang, k.k, array_to_string(w[i.i:i.i + k.k - 1], ' ') AS phrase
  FROM w, unnest(range(1, 4)) AS k(k), unnest(range(1, len(w) - k.k + 2)) AS i(i)),
c AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY lang, phrase, k),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
p AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k >= 2 AND f >= {collocations.LEAST}),
inner_of AS (SELECT lang, array_to_string(w[u.i:u.i + 1], ' ') AS phrase, max(a) AS f
  FROM p, unnest([1, 2]) AS u(i) WHERE k = 3 GROUP BY ALL),
cut AS (SELECT p.lang, p.phrase, a, u.i, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM p, unnest(range(1, k)) AS u(i)
  JOIN c x ON x.lang = p.lang AND x.phrase = array_to_string(w[1:u.i], ' ')
  JOIN c y ON y.lang = p.lang AND y.phrase = array_to_string(w[u.i + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY p.lang, p.phrase ORDER BY score, u.i) = 1),
ranked AS (SELECT cut.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM cut LEFT JOIN inner_of USING (lang, phrase) WHERE inner_of.f IS NULL OR 100 * inner_of.f < {collocations.ABSORBED} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {collocations.TOP}"""


@query(COLLOCATIONS)
def op13_collocations(spark, folder):
    return collocations.top(documents(spark, folder))
