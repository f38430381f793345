"""Row selection, joins, merges, checks and sources on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.bindings.common import ntz, query, rounded, table
from statlake.functions.scalars import chunk_id, normalise_label, to_utc_ntz
from statlake.operators import checks, merge, rows
from statlake.operators.pivot import with_opponent
from statlake.session import scratch_dir
from statlake.sources import catalog, files
from statlake.sources.lake import Lake
from statlake.streaming.ingest import current_rows, upsert_stream

CUT = "2024-01-15"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
EVENT_KEYS = ["user_id", "event_type"]

LATEST = """
SELECT event_id, ts, user_id, event_type, value FROM events {where}
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1
"""


def _events(spark, d):
    return table(spark, d, "events").select(*EVENT_COLUMNS)


def _latest(df):
    return rows.latest_per_key(df, EVENT_KEYS, ["ts"], ["event_id"])


# ---------------------------------------------------------------- row selection


@query(LATEST.format(where=""))
def latest_per_key(spark, d):
    return _latest(_events(spark, d))


@query("""
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) <= 4
""")
def last_n_rows(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return rows.last_n(o, ["o_custkey"], ["o_orderdate"], 4, ["o_orderkey"])


@query("""
SELECT user_id::VARCHAR AS user_id, min(ts) AS first_seen,
       coalesce(max(CASE WHEN event_type = 'signup' THEN year(ts) END), 2025)::INTEGER AS season
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def first_seen_ids(spark, d):
    e = table(spark, d, "events")
    signup = e.where(F.col("event_type") == "signup").groupBy(
        F.col("user_id").cast("string").alias("user_id")).agg(F.max(F.year("ts")).alias("y"))
    return rows.first_seen(e, "user_id", "ts").join(signup, "user_id", "left").select(
        "user_id", "first_seen", F.coalesce("y", F.lit(2025)).alias("season")
    ).orderBy("first_seen", "user_id")


@query("""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-10'
""")
def process_date(spark, d):
    return rows.for_date(_events(spark, d), "ts", "20240109")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' AND l_linenumber = 1
ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity LIMIT 200
""")
def explorer_page(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    hit = rows.apply_filters(li, l_returnflag="R", l_linenumber=1, l_suppkey=None)
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    return rows.page(hit, [F.col(c).asc_nulls_last() for c in order], 200)


@query("""
SELECT doc_id, lang, source, n_chars FROM documents WHERE source = 'src3'
ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 20
""")
def latest_articles(spark, d):
    docs = table(spark, d, "documents").where(F.col("source") == "src3").select(
        "doc_id", "lang", "source", "n_chars")
    return rows.page(docs, [F.col("n_chars").desc_nulls_last(), F.col("doc_id")], 20)


@query("""
SELECT DISTINCT 'season' AS kind, year(o_orderdate)::VARCHAR AS item FROM orders
UNION ALL SELECT DISTINCT 'week', month(o_orderdate)::VARCHAR FROM orders
  WHERE year(o_orderdate) = 1997
UNION ALL SELECT DISTINCT 'brand', p_brand FROM part WHERE p_brand IS NOT NULL
""")
def distinct_values(spark, d):
    def values(df, kind, col):
        return df.where(col.isNotNull()).select(
            F.lit(kind).alias("kind"), col.cast("string").alias("item")).distinct()

    o = table(spark, d, "orders")
    return (
        values(o, "season", F.year("o_orderdate"))
        .unionByName(values(o.where(F.year("o_orderdate") == 1997), "week",
                            F.month("o_orderdate")))
        .unionByName(values(table(spark, d, "part"), "brand", F.col("p_brand"))))


# ---------------------------------------------------------------- joins


@query("""
SELECT d.doc_id, d.lang, d.source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.doc_id IS NULL
""")
def unprocessed_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return rows.unprocessed(docs, table(spark, d, "labels"), {"doc_id": "doc_id"})


@query("""
SELECT DISTINCT a.l_orderkey, a.l_linenumber FROM lineitem a
LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE b.l_orderkey IS NULL
""")
def unprocessed_two_key(spark, d):
    li = table(spark, d, "lineitem")
    pair = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}
    return rows.unprocessed(li.select(*pair).distinct(), li.where(F.col("l_returnflag") == "R"),
                            pair)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate > TIMESTAMP '1998-01-01')
""")
def new_rows_not_exists(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    later = table(spark, d, "lineitem").where(F.col("l_shipdate") > ntz("1998-01-01"))
    return rows.new_rows(o, later.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("""
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_quantity FROM lineitem a
WHERE EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey
  AND b.l_suppkey = a.l_suppkey AND b.l_returnflag = 'R' AND b.l_quantity > 25)
""")
def semi_join_pairs(spark, d):
    li = table(spark, d, "lineitem")
    wanted = li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25))
    cols = ["l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity"]
    return rows.only_pairs(li.select(*cols), wanted, ["l_orderkey", "l_suppkey"])


@query("""
SELECT c.c_custkey, c.nation_text, n.n_name
FROM (SELECT c_custkey, c_nationkey::VARCHAR AS nation_text FROM customer) c
JOIN nation n ON c.nation_text = n.n_nationkey::VARCHAR
""")
def cast_key_join(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation_text"))
    n = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("nation_text"), "n_name")
    return c.join(n, "nation_text").select("c_custkey", "nation_text", "n_name")


@query("""
SELECT s.s_suppkey, s.s_name, n.n_name FROM supplier s
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON s.s_nationkey = n.n_nationkey
""")
def dim_lookup_left(spark, d):
    n = table(spark, d, "nation").where(F.col("n_regionkey") < 3)
    return table(spark, d, "supplier").join(
        n, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select("s_suppkey", "s_name", "n_name")


@query("""
WITH p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT a.l_orderkey, a.l_suppkey, min(b.l_suppkey) AS opponent
FROM p a LEFT JOIN p b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey
GROUP BY a.l_orderkey, a.l_suppkey
""")
def opponent_lateral(spark, d):
    pairs = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return with_opponent(pairs, pairs, "l_orderkey", "l_suppkey", {"l_suppkey": "opponent"})


# ---------------------------------------------------------------- projections


@query("""
SELECT o_orderkey AS game_id, o_orderstatus AS category, o_orderstatus = 'F' AS is_final,
  CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS size_label,
  coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END, 0) AS score,
  coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, o_orderpriority)
    AS algorithm_type,
  (o_totalprice - 200000)::DOUBLE AS error, abs(o_totalprice - 200000)::DOUBLE AS abs_error
FROM orders WHERE o_orderstatus IS NOT NULL AND o_totalprice > 0
""")
def case_projection(spark, d):
    o = table(spark, d, "orders").where(
        F.col("o_orderstatus").isNotNull() & (F.col("o_totalprice") > 0))
    gap = F.col("o_totalprice") - F.lit(200000.0)
    return o.select(
        F.col("o_orderkey").alias("game_id"), F.col("o_orderstatus").alias("category"),
        F.when(F.col("o_orderstatus") == "F", True).otherwise(False).alias("is_final"),
        F.when(F.col("o_totalprice") > 200000, "big").otherwise("small").alias("size_label"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("score"),
        F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
                   F.col("o_orderpriority")).alias("algorithm_type"),
        gap.alias("error"), F.abs(gap).alias("abs_error"),
    ).fillna(0.0, ["score"])


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click'
  WHEN 'purchase' THEN 'sale' ELSE 'other' END AS label FROM events
""")
def label_normalise(spark, d):
    fixed = {"view": "impression", "click": "click", "purchase": "sale"}
    return table(spark, d, "events").select(
        "event_id", normalise_label(F.col("event_type"), fixed, "other").alias("label"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
  WHEN event_type = 'click' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
  ELSE date_trunc('second', ts) END AS start_date FROM events
""")
def ts_normalise(spark, d):
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), plain))
        .when(F.col("event_type") == "click", F.concat(plain, F.lit("+02:00")))
        .when(F.col("event_type") == "view", plain)
        .otherwise(F.concat(plain, F.lit("Z"))))
    return table(spark, d, "events").select("event_id", to_utc_ntz(text).alias("start_date"))


# ---------------------------------------------------------------- merges

BASE = LATEST.format(where=f"WHERE ts < TIMESTAMP '{CUT}'")
PATCH = LATEST.format(where=f"WHERE ts >= TIMESTAMP '{CUT}'")


@query(f"""
WITH base AS ({BASE}), patch AS ({PATCH})
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM patch p
  WHERE p.user_id = b.user_id AND p.event_type = b.event_type)
UNION ALL SELECT * FROM patch
""")
def upsert_rows(spark, d):
    e = _events(spark, d)
    base = _latest(e.where(F.col("ts") < ntz(CUT)))
    patch = _latest(e.where(F.col("ts") >= ntz(CUT)))
    return merge.upsert(base, patch, EVENT_KEYS)


@query(LATEST.format(where=""))
def stream_upsert(spark, d):
    """Events land as one file per task and stream in over several batches."""
    at = scratch_dir(spark, "stream-upsert")
    e = _events(spark, d)
    e.repartition(6, "user_id").write.parquet(f"{at}/land")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(
        f"{at}/land")
    upsert_stream(stream, EVENT_KEYS, ["ts", "event_id"], f"{at}/out", f"{at}/checkpoint"
                  ).awaitTermination()
    return current_rows(spark, f"{at}/out", EVENT_KEYS, ["ts", "event_id"])


@query("""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 5000
UNION ALL SELECT c_custkey, 'new ' || c_name, c_acctbal, c_mktsegment FROM customer
WHERE NOT c_acctbal >= 5000
""")
def insert_ignore(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    fresh = c.withColumn("c_name", F.concat(F.lit("new "), "c_name"))
    return merge.insert_ignore(c.where(F.col("c_acctbal") >= 5000), fresh, ["c_custkey"])


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 5000 THEN 'new ' || c_name ELSE c_name END AS c_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  c_mktsegment
FROM customer WHERE c_acctbal >= 5000 OR c_mktsegment = 'BUILDING'
""")
def upsert_cols(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    patch = c.where(F.col("c_mktsegment") == "BUILDING").withColumns({
        "c_name": F.concat(F.lit("new "), "c_name"), "c_acctbal": F.col("c_acctbal") + 1})
    return merge.upsert_cols(c.where(F.col("c_acctbal") >= 5000), patch, ["c_custkey"],
                             ["c_acctbal"])


@query("""
SELECT c_custkey, c_acctbal, CASE WHEN c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'PENDING' ELSE c_mktsegment END
  AS c_mktsegment
FROM customer
""")
def update_where_in(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    hits = table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"))
    return merge.update_where_in(c, hits, ["c_custkey"], {"c_mktsegment": F.lit("PENDING")})


@query("""
SELECT doc_id AS article_id, CASE WHEN source IN ('src1', 'src3') THEN TIMESTAMP '2025-01-02'
  ELSE TIMESTAMP '2025-01-01' END AS processed_at
FROM documents WHERE lang = 'en' OR source IN ('src1', 'src3')
""")
def mark_processed(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("article_id"), "lang",
                                               "source")
    first = docs.where(F.col("lang") == "en").select(
        "article_id", ntz("2025-01-01").alias("processed_at"))
    again = docs.where(F.col("source").isin("src1", "src3"))
    return merge.mark_processed(first, again, ["article_id"], ntz("2025-01-02"))


# ---------------------------------------------------------------- checks


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def key_violations(spark, d):
    return checks.key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_orderkey IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def ref_violations(spark, d):
    return checks.ref_violations(
        table(spark, d, "orders").select("o_orderkey", "o_custkey"),
        table(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"}
    ).select("o_orderkey", "o_custkey")


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE c_mktsegment END
  AS c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal
FROM customer
""")
def with_defaults(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return merge.with_defaults(c, {"c_mktsegment": "none", "c_acctbal": 0})


# ---------------------------------------------------------------- sources and sinks


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, d):
    at = scratch_dir(spark, "csv")
    table(spark, d, "customer").write.option("header", True).csv(at)
    return files.read_csv(spark, at, "c_custkey bigint, c_name string, c_nationkey int, "
                                     "c_acctbal double, c_mktsegment string")


@query("""
SELECT 'latest' AS copy, event_id, ts::DATE AS day,
  CASE WHEN ts < TIMESTAMP '2024-01-10' THEN value ELSE value + 1 END AS value FROM events
UNION ALL SELECT 'first', event_id, ts::DATE, value FROM events WHERE ts < TIMESTAMP '2024-01-20'
""")
def dual_write_roundtrip(spark, d):
    """Two overlapping runs: days of the second replace those of the first."""
    at = scratch_dir(spark, "dual-write")
    e = table(spark, d, "events").select(
        "event_id", F.to_date("ts").alias("day"), "value", "ts")
    first = e.where(F.col("ts") < ntz("2024-01-20")).drop("ts")
    second = e.where(F.col("ts") >= ntz("2024-01-10")).drop("ts").withColumn(
        "value", F.col("value") + 1)
    # Rows of a day go to one writer each, so a day is a handful of files.
    files.write_latest_and_run(first, at, ["day"], "first")
    files.write_latest_and_run(second, at, ["day"], "second")
    latest = spark.read.parquet(f"{at}/latest").withColumn("copy", F.lit("latest"))
    kept = files.as_of_run(spark, at, "first").withColumn("copy", F.lit("first"))
    cols = ["copy", "event_id", "day", "value"]
    return latest.select(*cols).unionByName(kept.select(*cols))


def _as_games(o, run):
    return o.select(
        F.col("o_orderkey").cast("int").alias("id"), F.col("o_orderdate").alias("start_date"),
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"),
        F.col("o_custkey").cast("int").alias("venue_id"), F.lit(run).alias("run_id"))


@query("""
SELECT o_orderkey::INTEGER AS id, o_orderdate AS start_date, year(o_orderdate)::INTEGER AS season,
  month(o_orderdate)::INTEGER AS week, o_custkey::INTEGER AS venue_id,
  CASE o_orderstatus WHEN 'F' THEN 'first' ELSE 'second' END AS run_id FROM orders
""")
def lake_roundtrip(spark, d):
    """Replace, append, and repeat a run without doubling it."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    o = table(spark, d, "orders")
    lake.replace(_as_games(o.where(F.col("o_orderstatus") == "F"), "first"), "raw", "games")
    rest = _as_games(o.where(F.col("o_orderstatus") != "F"), "second")
    lake.append(rest, "raw", "games")
    lake.replace_run(rest, "raw", "games", "second")
    return lake.read("raw", "games").select(
        "id", "start_date", "season", "week", "venue_id", "run_id")


@query("""
SELECT (o_orderkey // 100)::INTEGER AS game_id, (o_orderkey % 100)::VARCHAR AS team_id,
  o_orderpriority AS category, CASE WHEN o_orderstatus = 'F' THEN 'final' ELSE o_orderstatus END
  AS value FROM orders
""")
def upsert_blocks(spark, d):
    """Upsert into a block-partitioned table: only touched blocks are rewritten."""
    lake = Lake(spark, scratch_dir(spark, "blocks"))
    key = F.col("o_orderkey")
    o = table(spark, d, "orders").select(
        F.floor(key / 100).cast("int").alias("game_id"),
        (key % 100).cast("string").alias("team_id"),
        F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("value"))
    lake.upsert(o, "stage", "fact_team_stats")
    lake.upsert(o.where(F.col("value") == "F").withColumn("value", F.lit("final")),
                "stage", "fact_team_stats")
    return lake.read("stage", "fact_team_stats").select("game_id", "team_id", "category", "value")


@query("""
SELECT label || '_' || vec_id AS id, label, len(embedding)::BIGINT AS n_values,
  round(embedding[1]::DOUBLE * CASE WHEN label >= 4 THEN 2 ELSE 1 END, 6) AS first_value
FROM embeddings
""")
def upsert_vectors(spark, d):
    lake = Lake(spark, scratch_dir(spark, "vectors"))
    e = table(spark, d, "embeddings").select(
        chunk_id(F.col("label"), F.col("vec_id")).alias("id"), F.col("embedding").alias("values"), F.col("label"))

    def records(df, scale):
        return df.select(
            "id", F.transform("values", lambda v: v * F.lit(scale).cast("float")).alias("values"),
            F.struct(
                F.lit(None).cast("timestamp_ntz").alias("published"),
                F.lit(0).alias("chunk_index"), F.col("label").alias("article_id"),
                F.lit("").alias("chunk_text"), F.lit("").alias("headline"),
                F.lit("").alias("story")).alias("metadata"))

    lake.upsert(records(e.where(F.col("label") < 6), 1), "vectors", "article_chunks")
    lake.upsert(records(e.where(F.col("label") >= 4), 2), "vectors", "article_chunks")
    out = lake.read("vectors", "article_chunks").select(
        "id", F.col("metadata.article_id").alias("label"),
        F.size("values").cast("bigint").alias("n_values"),
        F.get("values", F.lit(0)).alias("first_value"))
    return rounded(out, 6, "first_value")


@query("""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997
""")
def param_sql(spark, d):
    return catalog.sql(
        spark, "SELECT o_orderkey, o_totalprice, o_orderdate FROM {orders} "
               "WHERE o_orderstatus = :status AND year(o_orderdate) = :season",
        {"status": "F", "season": 1997}, orders=table(spark, d, "orders"))


def _counts_sql(name, cols):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {i} AS position, '{c}' AS column_name, "
        f"count({c}) AS non_null FROM {name}" for i, c in enumerate(cols, 1))


CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
          "o_orderpriority"]
PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query(f"SELECT position, column_name, non_null FROM ({_counts_sql('customer', CUSTOMER)})")
def profile(spark, d):
    return catalog.profile(table(spark, d, "customer")).drop("data_type")


@query(" UNION ALL ".join(
    _counts_sql(n, c) for n, c in (("customer", CUSTOMER), ("orders", ORDERS), ("part", PART))))
def catalog_columns(spark, d):
    names = ["customer", "orders", "part", "supplier"]
    return catalog.catalog_snapshot(
        {n: table(spark, d, n) for n in names}, keep=("customer", "orders", "part")
    ).drop("data_type")
