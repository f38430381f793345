"""Documents, questions, nested documents, vectors and retrieval evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.bindings.common import ntz, query, rounded, table
from statlake.functions import text as tx
from statlake.functions.metrics import experiment_summary as summary_of
from statlake.functions.metrics import ranking_metrics as metrics_of
from statlake.operators import flatten
from statlake.operators.topk import block_top_k, cosine_top_k
from statlake.operators.windows import history_window as history_of
from statlake.plans import marts, retrieval
from statlake.session import scratch_dir
from statlake.sources import files
from statlake.sources.lake import Lake

# ---------------------------------------------------------------- text


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _clean_sql(col: str) -> str:
    for pattern, by in tx.CLEAN_RULES:
        col = f"regexp_replace({col}, {_sql_text(pattern)}, {_sql_text(by)}, 'g')"
    return f"trim({col})"


@query(f"SELECT page_id, {_clean_sql('html')} AS story FROM pages")
def clean_html(spark, d):
    return table(spark, d, "pages").select("page_id", tx.clean_html(F.col("html")).alias("story"))


@query(f"SELECT page_id, {_clean_sql('html')} AS story FROM pages")
def clean_html_strict(spark, d):
    return table(spark, d, "pages").select(
        "page_id", tx.clean_html_strict(F.col("html")).alias("story"))


def _chunks(spark, d, *args, **kw):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tx.chunk(docs, "text", *args, **kw).select("doc_id", "chunk_index", "chunk_text")


@query(r"""
SELECT doc_id, (i - 1)::INTEGER AS chunk_index, parts[i] AS chunk_text
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
  unnest(range(1, len(parts) + 1)) AS u(i)
""")
def chunk_paragraphs(spark, d):
    return _chunks(spark, d, "paragraphs", separator="\n")


WORDS = (f"list_filter(string_split_regex({{}}, {_sql_text(tx.BLANKS)}), lambda w: w <> '')")


@query(f"""
SELECT doc_id, ((s // 250))::INTEGER AS chunk_index,
  array_to_string(w[s + 1:s + 300], ' ') AS chunk_text
FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
  unnest(range(0, greatest(len(w) - 50, 1), 250)) AS u(s)
WHERE len(w) > 0
""")
def chunk_tokens(spark, d):
    return _chunks(spark, d, "tokens", 300, 50)


def _cover(chunks, size: int, by_words: bool):
    """Per document: chunks that are too long, out of place or empty, and characters lost.

    Chunks overlap, so each one must begin no later than the one before it ends: laid one
    behind the other without what they share, they give back the text's characters. A text
    goes to its document with the first chunk alone.
    """
    text = F.regexp_replace("text", r"\s+", "")
    bare = lambda c: F.regexp_replace(c, r"\s+", "")
    length = F.size(F.split(F.trim("chunk_text"), r"\s+")) if by_words else F.length("chunk_text")
    chunks = chunks.withColumn("text", F.when(F.col("chunk_index") == 0, F.col("text")))
    per = chunks.groupBy("doc_id").agg(
        F.sum((length > size).cast("long")).alias("n_long"), F.sum((F.trim("chunk_text") == "").cast("long")).alias("n_empty"),
        F.first("text", ignorenulls=True).alias("text"),
        F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_text"))).alias("c"))
    # Each chunk at its last place that leaves no gap: the last match in what is covered
    # so far and as many characters more as the chunk has. It is looked for near the end first.
    ends = F.expr("""aggregate(
        transform(c, x -> regexp_replace(x.chunk_text, '\\\\s+', '')), struct(1 as upto, 0 as gaps), (a, x) ->
        transform(array(substring(bare, 1, a.upto - 1 + length(x))), s -> transform(array(coalesce(
            nullif(locate(reverse(x), reverse(substring(s, -2 * length(x), 2 * length(x)))), 0),
            locate(reverse(x), reverse(s)))), at -> struct(
                greatest(a.upto, least(a.upto + length(x), length(bare) + 1) - greatest(at, 1) + 1) as upto,
                a.gaps + int(at = 0) as gaps))[0])[0])""")
    return per.withColumn("bare", text).withColumn("e", ends).select(
        "doc_id", "n_long", "n_empty", F.col("e.gaps").cast("long").alias("n_gaps"),
        (F.col("e.upto") - 1).cast("long").alias("n_covered"))


COVER = """
SELECT doc_id, 0::BIGINT AS n_long, 0::BIGINT AS n_empty, 0::BIGINT AS n_gaps,
  length(regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g'))::BIGINT AS n_covered
FROM documents WHERE regexp_matches(text, '[^ \t\n\x0B\f\r]')"""


@query(COVER)
def chunk_recursive_cover(spark, d):
    """Recursive chunks keep to their size, their order and every character of the text."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return _cover(tx.chunk(docs, "text", "recursive", 350, 75), 350, by_words=False)


def _packed_sql(atoms: str, weight, size: int, overlap: int) -> str:
    """Runs by prefix sums and a recursive step from one run to the next."""
    to = lambda at: f"len(list_filter(cum, lambda x: x <= {at}))"
    return rf"""
WITH RECURSIVE e AS (SELECT doc_id, u.i, atoms[u.i] AS s, {weight('atoms[u.i]')} AS w
  FROM (SELECT doc_id, {atoms} AS atoms FROM documents WHERE text IS NOT NULL), unnest(range(1, len(atoms) + 1)) AS u(i)),
c AS MATERIALIZED (SELECT doc_id, list(s ORDER BY i) AS s, list(w ORDER BY i) AS w, list(cum ORDER BY i) AS cum
  FROM (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS cum FROM e) GROUP BY doc_id),
r AS (SELECT doc_id, 0 AS first, greatest(1, {to(size)}) AS last FROM c
  UNION ALL SELECT doc_id, f AS first, greatest(f + 1, {to(f"CASE WHEN f > 0 THEN cum[f] ELSE 0 END + {size}")}) AS last
  FROM (SELECT c.doc_id, cum, greatest(first, least(last, CASE WHEN need <= 0 THEN 0 ELSE len(list_filter(cum, lambda x: x < need)) + 1 END)) AS f
    FROM (SELECT r.*, c.*, cum[last] - least({overlap}, {size} - w[last + 1]) AS need FROM r JOIN c USING (doc_id) WHERE last < len(s)) c)),
t AS (SELECT doc_id, first, regexp_replace(regexp_replace(array_to_string(s[first + 1:last], ''), '^[{tx.WHITE}]+', ''),
  '[{tx.WHITE}]+$', '') AS chunk_text FROM r JOIN c USING (doc_id))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1)::INTEGER AS chunk_index, chunk_text
FROM t WHERE chunk_text <> ''"""


def _atoms_sql(text: str, size: int, separators=tx.SEPARATORS) -> str:
    name = f"p{len(separators)}"
    if not separators:
        return f"CASE WHEN length({text}) <= {size} THEN [{text}] ELSE regexp_extract_all({text}, '(?s).') END"
    mark = " || ".join(f"chr({ord(c)})" for c in separators[0])
    finer = _atoms_sql(name, size, separators[1:])
    pieces = (f"list_filter(list_transform(string_split({text}, {mark}), lambda x, i: CASE WHEN i < "
              f"len(string_split({text}, {mark})) THEN x || {mark} ELSE x END), lambda x: x <> '')")
    return (f"CASE WHEN {text} = '' THEN [] WHEN length({text}) <= {size} THEN [{text}] "
            f"ELSE flatten(list_transform({pieces}, lambda {name}: {finer})) END")


@query(_packed_sql(_atoms_sql("text", 350), "length({})".format, 350, 75))
def chunk_recursive(spark, d):
    return _chunks(spark, d, "recursive", 350, 75)


@query(_packed_sql(f"regexp_extract_all(text, '{tx.SENTENCE}')",
                   lambda s: f"len(regexp_extract_all({s}, '[^{tx.WHITE}]+'))", 300, 50))
def chunk_sentences(spark, d):
    return _chunks(spark, d, "sentences", 300, 50)


LEFT = f"list_distinct({WORDS.format('lower(a.text)')})"
RIGHT = f"list_distinct({WORDS.format('lower(b.text)')})"


@query(f"""
WITH p AS (SELECT a.doc_id AS left_id, b.doc_id AS right_id, {LEFT} AS l, {RIGHT} AS r
  FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
n AS (SELECT left_id, right_id, len(list_intersect(l, r)) AS s, len(l) AS nl, len(r) AS nr FROM p)
SELECT left_id, right_id, s::INTEGER AS n_shared, (nl - s)::INTEGER AS n_left_only,
  (nr - s)::INTEGER AS n_right_only,
  round(coalesce(s / nullif(nl + nr - s, 0), 0)::DOUBLE, 9) AS jaccard FROM n
""")
def compare_pairs(spark, d):
    """Each document against the next one, over the whole texts."""
    docs = table(spark, d, "documents").select(
        "doc_id", tx.word_set(F.col("text")).alias("words"))
    left = docs.select(F.col("doc_id").alias("left_id"), F.col("words").alias("l"),
                       (F.col("doc_id") + 1).alias("right_id"))
    right = docs.select(F.col("doc_id").alias("right_id"), F.col("words").alias("r"))
    out = left.join(right, "right_id").select(
        "left_id", "right_id",
        *[c.alias(n) for n, c in tx.compare_words(F.col("l"), F.col("r")).items()])
    return rounded(out, 9, "jaccard")


# Question templates by event type and number; between them they reach every rule.
QUESTION = """
CASE event_type
  WHEN 'view' THEN CASE WHEN k < 25 THEN 'Show me yards per week'
    WHEN k < 50 THEN 'Plot a BAR graph of ' || k WHEN k < 75 THEN 'Who won in week ' || k
    ELSE 'Visualize the bar of ' || k END
  WHEN 'click' THEN CASE WHEN k < 50 THEN 'Make it a pie chart' ELSE 'convert to scatter' END
  WHEN 'purchase' THEN CASE WHEN k < 50 THEN 'Display points as a line chart, not a pie chart'
    ELSE 'switch teams ' || k END
  WHEN 'signup' THEN 'Change to line graph or bar chart'
  ELSE CASE WHEN k < 50 THEN 'A scatter of ' || k ELSE 'graph along the line' END END"""


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(q, '{w}')" for w in words) + ")"


NAMED = ("CASE " + " ".join(f"WHEN {_any(words)} THEN '{kind}'" for kind, words in tx.CHART_TYPES)
         + " END")


@query(f"""
WITH e AS (SELECT event_id, user_id, event_type,
  json_extract_string(props, '$.k')::INTEGER AS k FROM events),
t AS (SELECT event_id, lower({QUESTION}) AS q, user_id > 50 AS prev FROM e),
n AS (SELECT *, {NAMED} AS named FROM t),
c AS (SELECT *, {_any(tx.CHANGE_WORDS)} AND named IS NOT NULL AS is_change FROM n),
w AS (SELECT *, (is_change AND prev) OR {_any(tx.WISH_WORDS)} AS wants_chart FROM c)
SELECT event_id, is_change, wants_chart, coalesce(named,
  CASE WHEN wants_chart AND contains(q, 'bar') THEN 'bar' ELSE 'line' END) AS chart_type FROM w
""")
def chart_intent(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    asked = e.withColumn("q", F.expr(QUESTION))
    return asked.select("event_id", *[
        c.alias(n) for n, c in tx.chart_intent(F.col("q"), F.col("user_id") > 50).items()])


HISTORY = """
WITH h AS (SELECT conv_id, turn, role, text, list({'role': role, 'text': text}) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prev
  FROM conversations)
SELECT conv_id, turn, role, text, coalesce(len(prev), 0)::INTEGER AS n_messages,
  coalesce(array_to_string(list_transform(prev, lambda m, i: CASE m.role
    WHEN 'user' THEN chr(10) || chr(10) || 'User question ' || i || ': ' || m.text
    WHEN 'assistant' THEN chr(10) || chr(10) || 'Assistant answer ' || i || ': ' || m.text
    ELSE '' END), ''), '') AS context
FROM h"""


@query(HISTORY)
def history_window(spark, d):
    """Conversations in blocks of turns, so that a long one is dealt to many tasks."""
    return history_of(table(spark, d, "conversations"), 3, turn_block=256)


@query(HISTORY)
def history_window_hot(spark, d):
    """The same in blocks shorter than the conversations of the test tables."""
    return history_of(table(spark, d, "conversations"), 3, turn_block=3)


# ---------------------------------------------------------------- nested documents


@query("""
SELECT o_orderkey::INTEGER AS id, o_orderdate AS start_date, year(o_orderdate)::INTEGER AS season,
  month(o_orderdate)::INTEGER AS week, (o_custkey % 100)::INTEGER AS venue_id,
  o_custkey::INTEGER AS attendance FROM orders
""")
def flatten_games(spark, d):
    return flatten.flatten_games(_scoreboards(spark, d)).select(
        "id", "start_date", "season", "week", "venue_id", "attendance")


@query("""
SELECT o_orderkey::INTEGER AS id, 'run-7' AS run_id, TIMESTAMP '2024-03-01 10:00:00' AS ingest_timestamp FROM orders
""")
def games_lineage(spark, d):
    """Flattened rows with the run and the time they came in."""
    boards = flatten.with_lineage(_scoreboards(spark, d), "run-7", F.lit("2024-03-01 10:00:00"))
    return flatten.flatten_games(boards).select("id", "run_id", "ingest_timestamp")


@query("""
SELECT o_orderkey::INTEGER AS game_id, o_custkey::INTEGER AS team_id, 'home' AS home_away,
  floor(o_totalprice)::INTEGER AS score FROM orders
UNION ALL SELECT o_orderkey::INTEGER, (o_custkey + 1)::INTEGER, 'away',
  month(o_orderdate)::INTEGER FROM orders
WHERE o_orderstatus <> 'P'
""")
def flatten_game_team(spark, d):
    return flatten.flatten_game_team(_scoreboards(spark, d)).select(
        "game_id", "team_id", "home_away", "score")


@query("""
SELECT (o_custkey % 100)::INTEGER AS id, 'Field ' || o_custkey AS fullname, 'City' AS city,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS state, 'US' AS country,
  o_orderstatus = 'O' AS indoor FROM orders
""")
def flatten_venues(spark, d):
    return flatten.flatten_venues(_scoreboards(spark, d)).select(
        "id", "fullname", "city", "state", "country", "indoor")


@query("""
SELECT o_custkey::INTEGER AS id, 'T' || o_custkey AS name, o_orderstatus AS abbrev FROM orders
UNION ALL SELECT (o_custkey + 1)::INTEGER, 'T' || o_custkey, 'x' FROM orders WHERE o_orderstatus <> 'P'
""")
def flatten_teams(spark, d):
    return flatten.flatten_teams(_scoreboards(spark, d)).select("id", "name", "abbrev")


def _scoreboards(spark, d):
    """Each order as one scoreboard document, landed as JSON and read back.

    The second competitor of a 'P' order has no id, so it must drop out.
    """
    o = table(spark, d, "orders")
    cust = F.col("o_custkey")

    def side(ident, where, points, abbrev):
        team = F.struct(F.concat(F.lit("T"), cust.cast("string")).alias("name"),
                        abbrev.alias("abbreviation"))
        return F.struct(ident.cast("string").alias("id"), F.lit(where).alias("homeAway"),
                        points.cast("string").alias("score"), team.alias("team"))

    venue = F.struct(
        (cust % 100).cast("string").alias("id"),
        F.concat(F.lit("Field "), cust.cast("string")).alias("fullName"),
        (F.col("o_orderstatus") == "O").alias("indoor"),
        F.struct(F.lit("City").alias("city"),
                 F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("state"),
                 F.lit("US").alias("country")).alias("address"))
    event = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'").alias("date"),
        F.struct(F.year("o_orderdate").alias("year")).alias("season"),
        F.struct(F.month("o_orderdate").alias("number")).alias("week"),
        F.array(F.struct(
            cust.cast("int").alias("attendance"), venue.alias("venue"),
            F.array(side(cust, "home", F.floor("o_totalprice"), F.col("o_orderstatus")),
                    side(F.when(F.col("o_orderstatus") != "P", cust + 1), "away",
                         F.month("o_orderdate"), F.lit("x"))).alias("competitors"),
        )).alias("competitions"))
    at = scratch_dir(spark, "land")
    files.land_json(o.select(F.array(event).alias("events"),
                             F.year("o_orderdate").alias("season")), at, ["season"])
    docs = files.read_scoreboards(spark, at, one_per_file=False)
    return flatten.with_lineage(docs, "run-1", ntz("2025-01-01"))


def _game_documents(spark, d):
    """Each document as the article of one game, landed as JSON and read back."""
    at = scratch_dir(spark, "games")
    docs = table(spark, d, "documents")
    ident = F.col("doc_id").cast("int")
    image = F.struct(
        F.col("lang").alias("type"), F.col("source").alias("caption"),
        F.col("n_chars").cast("int").alias("height"),
        F.concat(F.lit("http://x/"), F.col("doc_id").cast("string")).alias("url"))
    no_url = image.withField("url", F.lit(None).cast("string"))
    article = F.struct(
        ident.alias("id"), F.col("source").alias("headline"),
        F.when(F.col("lang") == "en", "2025-09-08T03:21:00Z").otherwise("soon").alias("published"),
        F.col("source"), F.col("text").alias("story"), F.array(image, no_url).alias("images"))
    side = F.struct(
        F.lit("home").alias("homeAway"),
        F.struct(F.col("source").alias("id"), F.col("lang").alias("abbreviation")).alias("team"),
        F.array(F.struct(F.lit("chars").alias("name"), F.col("n_chars").alias("value"),
                         F.lit("CH").alias("label"))).alias("statistics"))
    files.land_json(docs.select(
        "lang", (ident + 1000).alias("game_id"),
        F.when(F.col("source") != "src3", article).alias("article"),
        F.struct(F.array(side).alias("teams")).alias("boxscore")), at, ["lang"])
    return flatten.with_lineage(
        files.read_game_details(spark, at, one_per_file=False), "run-1", ntz("2025-01-01"))


@query("""
SELECT doc_id::INTEGER AS id, source AS headline, CASE WHEN lang = 'en' THEN
  TIMESTAMP '2025-09-08 03:21:00' END AS published, source, text AS story,
  (doc_id + 1000)::INTEGER AS game_id FROM documents WHERE source <> 'src3'
""")
def flatten_articles(spark, d):
    return flatten.flatten_articles(_game_documents(spark, d)).select(
        "id", "headline", "published", "source", "story", "game_id")


@query("""
SELECT lang AS type, source AS caption, n_chars::INTEGER AS height, 'http://x/' || doc_id AS url,
  (doc_id + 1000)::INTEGER AS game_id, doc_id::INTEGER AS article_id
FROM documents WHERE source <> 'src3'
""")
def flatten_images(spark, d):
    return flatten.flatten_images(_game_documents(spark, d)).select(
        "type", "caption", "height", "url", "game_id", "article_id")


@query("""
SELECT 'chars' AS name, n_chars::VARCHAR AS value, 'CH' AS label, source AS team_id,
  lang AS team_abbr, 'home' AS home_away, (doc_id + 1000)::INTEGER AS game_id FROM documents
""")
def flatten_team_stats(spark, d):
    return flatten.flatten_team_stats(_game_documents(spark, d)).select(
        "name", "value", "label", "team_id", "team_abbr", "home_away", "game_id")


@query("""
WITH s AS (SELECT l_orderkey::INTEGER AS game_id, l_suppkey::VARCHAR AS team_id,
  l_partkey::VARCHAR AS athlete_id, l_returnflag AS category, l_quantity::BIGINT AS q,
  l_linenumber AS n, l_linestatus AS f FROM lineitem)
SELECT game_id, team_id, athlete_id, category, 'quantity' AS stat_key, 'QTY' AS stat_label,
  q::VARCHAR AS value_str FROM s
UNION ALL SELECT game_id, team_id, athlete_id, category, 'line', 'LN', n::VARCHAR FROM s
WHERE f = 'O'
""")
def flatten_player_stats(spark, d):
    """Each line item as one player block; the labels limit how many values count."""
    li = table(spark, d, "lineitem")
    text = {k: F.col(c).cast(t).cast("string") for k, c, t in (
        ("team", "l_suppkey", "bigint"), ("who", "l_partkey", "bigint"),
        ("q", "l_quantity", "bigint"), ("n", "l_linenumber", "int"))}
    labels = F.when(F.col("l_linestatus") == "O", F.array(F.lit("QTY"), F.lit("LN"))).otherwise(
        F.array(F.lit("QTY")))
    athlete = F.struct(
        F.struct(text["who"].alias("id"), F.lit("name").alias("displayName")).alias("athlete"),
        F.array(text["q"], text["n"], F.lit("9")).alias("stats"))
    category = F.struct(
        F.col("l_returnflag").alias("name"),
        F.array(F.lit("quantity"), F.lit("line"), F.lit("extra")).alias("keys"),
        labels.alias("labels"), F.array(athlete).alias("athletes"))
    block = F.struct(F.struct(text["team"].alias("id"), F.lit("x").alias("abbreviation"))
                     .alias("team"), F.array(category).alias("statistics"))
    docs = li.select(F.col("l_orderkey").cast("int").alias("game_id"),
                     F.struct(F.array(block).alias("players")).alias("boxscore"),
                     F.lit("memory").alias("source_path"))
    return flatten.flatten_player_stats(
        flatten.with_lineage(docs, "run-1", ntz("2025-01-01"))).select(
        "game_id", "team_id", "athlete_id", "category", "stat_key", "stat_label", "value_str")


@query("""
WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber AS na, (l_quantity::INTEGER % 5) AS nb,
  l_returnflag = 'N' AS gone FROM lineitem)
SELECT l_orderkey, l_partkey, i::VARCHAR AS a, (i * 10)::VARCHAR AS b
FROM s, unnest(range(1, CASE WHEN gone THEN 0 ELSE least(na, nb) END + 1)) AS u(i)
""")
def zip_shortest(spark, d):
    def upto(n, scale):
        full = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                           lambda i: (i * scale).cast("string"))
        return F.when(n > 0, full).otherwise(F.array().cast("array<string>"))

    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", upto(F.col("l_linenumber"), 1).alias("a"),
        F.when(F.col("l_returnflag") != "N",
               upto((F.col("l_quantity").cast("int") % 5), 10)).alias("b"))
    return li.select("l_orderkey", "l_partkey",
                     F.explode(flatten.zip_shortest("a", "b")).alias("z")).select(
        "l_orderkey", "l_partkey", "z.a", "z.b")


# ---------------------------------------------------------------- vectors

# The question of a label is the mean vector of its rows; its article is the label.
SEARCH = """
WITH parts AS (SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS v
  FROM embeddings, unnest(range(1, 65)) AS u(i) GROUP BY label, i),
q AS (SELECT label AS query_id, list(v ORDER BY i) AS qv FROM parts GROUP BY label),
s AS (SELECT q.query_id, e.vec_id AS id, e.label AS article_id,
  round(list_cosine_similarity(e.embedding::DOUBLE[], q.qv), 9) AS score FROM q, embeddings e),
hits AS (SELECT query_id, row_number() OVER w AS rank, id, score, article_id FROM s
  WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 25)
"""


def _questions(spark, d):
    parts = table(spark, d, "embeddings").select(
        "label", F.posexplode("embedding").alias("pos", "v")
    ).groupBy("label", "pos").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    # One entry per dimension: the list is as long as a vector.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return parts.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda p: p.v).alias("values"))


def _corpus(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"),
        F.struct(F.col("label").alias("article_id"),
                 F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("chunk_text"))
        .alias("metadata"))


def _hits(spark, d):
    return retrieval.retrieve(_questions(spark, d), _corpus(spark, d), 25)


@query(SEARCH + "SELECT query_id, rank::INTEGER AS rank, id, score FROM hits")
def topk_cosine(spark, d):
    return cosine_top_k(_questions(spark, d), _corpus(spark, d), 25)


MANY = """
WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS id,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
  FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""


@query(MANY.replace(" WHERE a.vec_id % 50 = 0", ""))
def topk_many(spark, d):
    """All rows against all rows."""
    corpus = _corpus(spark, d)
    return cosine_top_k(corpus.withColumnRenamed("id", "query_id"), corpus, 10)


@query(MANY)
def topk_blocks(spark, d):
    """The rows whose id is divisible by 50 against all rows."""
    corpus = _corpus(spark, d)
    return block_top_k(corpus.withColumnRenamed("id", "query_id").where("query_id % 50 = 0"), corpus, 10)


@query("""
WITH q AS (SELECT label AS query_id, list(v ORDER BY pos) AS qv FROM (
  SELECT label, pos, round(avg(v::DOUBLE), 6) AS v FROM (SELECT label, unnest(embedding) AS v,
    unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY label, pos) GROUP BY label),
s AS (SELECT query_id, (vec_id * 500) || '_' || (label % 3) AS id, (vec_id * 500)::INTEGER AS article_id, 'chunk ' || vec_id AS chunk_text,
  round(list_cosine_similarity(embedding::DOUBLE[], qv), 9) AS score FROM q, embeddings)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, id, score, article_id, chunk_text FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5
""")
def topk_lake(spark, d):
    """Vectors stored in blocks of articles; the payload of the hits from their blocks alone."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    article = (F.col("vec_id") * 500).cast("int")
    lake.replace(table(spark, d, "embeddings").select(
        F.concat(article.cast("string"), F.lit("_"), (F.col("label") % 3).cast("string")).alias("id"),
        F.col("embedding").alias("values"),
        F.struct(F.lit(None).cast("timestamp_ntz").alias("published"), (F.col("label") % 3).alias("chunk_index"),
                 article.alias("article_id"),
                 F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("chunk_text"),
                 F.lit(None).cast("string").alias("headline"), F.lit(None).cast("string").alias("story")).alias("metadata")),
        "vectors", "article_chunks")
    return retrieval.retrieve_stored(lake, _questions(spark, d), 5)


@query(SEARCH + """
SELECT query_id, string_agg('[article_id=' || article_id || '] chunk ' || id,
  chr(10) || chr(10) ORDER BY rank) AS context,
  array_to_string(list(article_id ORDER BY rank), ',') AS articles FROM hits GROUP BY query_id
""")
def contexts(spark, d):
    shaped = retrieval.assemble_context(retrieval.shape_contexts(_hits(spark, d)))
    return shaped.select("query_id", "context", F.array_join(
        F.transform("articles", lambda a: a.cast("string")), ",").alias("articles"))


@query(SEARCH + "SELECT query_id, article_id, score FROM hits WHERE rank = 1")
def top_article(spark, d):
    return retrieval.top_article(_hits(spark, d))


METRICS = SEARCH + """,
want AS (SELECT label AS query_id, count(*) AS total FROM embeddings GROUP BY label),
found AS (SELECT h.query_id, count(*) AS n, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg
  FROM hits h WHERE article_id = query_id GROUP BY h.query_id),
ideal AS (SELECT query_id, sum(1 / log2(i + 1)) AS best FROM want,
  unnest(range(1, least(total, 25) + 1)) AS u(i) GROUP BY query_id),
scores AS (SELECT w.query_id, coalesce(n, 0) / 25.0::DOUBLE AS precision_at_k,
  coalesce(n, 0) / total::DOUBLE AS recall_at_k, coalesce(1.0::DOUBLE / first, 0) AS mrr,
  coalesce(dcg / best, 0) AS ndcg_at_k
  FROM want w JOIN ideal USING (query_id) LEFT JOIN found USING (query_id))
"""
NAMES = ["precision_at_k", "recall_at_k", "mrr", "ndcg_at_k"]


def _scores(spark, d):
    want = table(spark, d, "embeddings").groupBy(F.col("label").alias("query_id")).agg(
        F.count(F.lit(1)).alias("n_chunks")).withColumn("article_id", F.col("query_id"))
    return metrics_of(_hits(spark, d), want, 25)


@query(METRICS + "SELECT query_id, "
       + ", ".join(f"round({n}, 9) AS {n}" for n in NAMES) + " FROM scores")
def ranking_metrics(spark, d):
    return rounded(_scores(spark, d), 9, *NAMES)


@query(METRICS + "SELECT 'exp-1' AS experiment, count(*) AS n_examples, "
       + ", ".join(f"round(avg({n}), 9) AS {n}" for n in NAMES) + " FROM scores")
def experiment_summary(spark, d):
    return rounded(summary_of(_scores(spark, d), "exp-1"), 9, *NAMES)


@query("""
SELECT 'which rows look like ' || label AS question, label AS article_id,
  count(*)::INTEGER + CASE WHEN label < 5 THEN 0 ELSE 1 END AS n_chunks
FROM embeddings GROUP BY label
""")
def register_eval_set(spark, d):
    """Known questions keep their row; the others are added once."""
    sets = table(spark, d, "embeddings").groupBy("label").agg(
        F.count(F.lit(1)).cast("int").alias("n_chunks")).select(
        F.concat(F.lit("which rows look like "), F.col("label").cast("string")).alias("question"),
        F.col("label").alias("article_id"), "n_chunks")
    again = sets.withColumn("n_chunks", F.col("n_chunks") + 1)
    return retrieval.register_eval_set(sets.where(F.col("article_id") < 5),
                                       again.unionByName(again))


@query("""
SELECT url, substr(url, 1, 20) AS caption, (page_id % 7)::INTEGER AS height,
  (page_id % 5)::INTEGER AS width FROM pages WHERE url IS NOT NULL AND page_id // 20 = 2
ORDER BY url, page_id LIMIT 6
""")
def images_of_game(spark, d):
    """The first images of a game by url; twenty pages stand for the images of a game."""
    images = table(spark, d, "pages").select(
        "url", F.substring("url", 1, 20).alias("caption"),
        (F.col("page_id") % 7).cast("int").alias("height"),
        (F.col("page_id") % 5).cast("int").alias("width"), F.floor(F.col("page_id") / 20).alias("game_id"))
    return marts.images_of(images, 2)


EMBED = f"""
WITH ch AS ({_packed_sql(_atoms_sql("text", 350), "length({})".format, 350, 75)}),
p AS (SELECT doc_id, chunk_index, ('0x' || substr(md5(w), 1, 7))::BIGINT % 256 AS dim
  FROM (SELECT doc_id, chunk_index, unnest(regexp_extract_all(lower(chunk_text), '{retrieval.WORDS}')) AS w FROM ch)),
tf AS (SELECT doc_id, chunk_index, dim, count(*) AS n FROM p GROUP BY ALL),
idf AS (SELECT dim, ln(((SELECT count(*) FROM ch) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY dim),
v AS (SELECT doc_id, chunk_index, dim, n * idf AS v, sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id, chunk_index)) AS norm
  FROM tf JOIN idf USING (dim))
SELECT doc_id, chunk_index, dim::INTEGER AS dim, round((v / norm)::FLOAT::DOUBLE, 5) AS value FROM v WHERE v > 0"""


@query(EMBED)
def embed_documents(spark, d):
    """Every chunk of every document as a vector; one row for each component that is not zero."""
    at = scratch_dir(spark, "chunks")
    _chunks(spark, d, "recursive", 350, 75).select(
        "doc_id", "chunk_index", retrieval.word_places(F.col("chunk_text"), 256).alias("places")).write.parquet(at)
    chunks = spark.read.parquet(at)
    model = retrieval.fit_embedder(chunks, "places", 256, placed=True)
    # The outer form: the other one asks every vector for its size first, which computes it anew.
    out = retrieval.embed(chunks, "places", model.of_places).select(
        "doc_id", "chunk_index", F.posexplode_outer("values").alias("dim", "value")).where("value > 0")
    return rounded(out, 5, "value")
