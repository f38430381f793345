"""Articles to chunks to vectors; top-k retrieval, contexts and evaluation."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions.metrics import experiment_summary, ranking_metrics
from statlake.functions.scalars import chunk_id
from statlake.functions.text import chunk, clean_html_strict
from statlake.operators.rows import latest_per_key, unprocessed
from statlake.operators.topk import cosine_top_k
from statlake.session import scratch_dir
from statlake.sources.lake import BLOCK, Lake

# Chunking, vector width and result size.
CHUNK_SIZE, CHUNK_OVERLAP = 350, 75
VECTOR_SIZE = 768
# So many vectors are filled at once.
ROWS_AT_ONCE = 1_024
TOP_K = 25
# A word: letters, marks and digits, in a syntax that Java and RE2 read alike.
WORDS = "[\\p{L}\\p{M}\\p{N}]+"
# Ids and scores of this many hits stay far below 100 MB.
MAX_BROADCAST_HITS = 500_000


def word_places(text: Column, dims: int) -> Column:
    """The place of every word of a text, in order: the leading digits of its MD5 sum."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORDS), 0)
    digits = lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int")
    return F.transform(words, lambda w: digits(w) % dims)


@dataclass
class Embedder:
    """Hashed words weighted by inverse document frequency, unit length.

    The offline stand-in for a hosted embedding model; the same weights embed chunks and
    questions. Words are placed by built-in expressions, vectors are filled in Arrow batches,
    linear in words and width. A text without words, or with none that tells texts apart,
    becomes the zero vector, NULL stays NULL.
    """

    idf: list[float]

    def __call__(self, text: Column) -> Column:
        return self.of_places(word_places(text, len(self.idf)))

    def of_places(self, places: Column) -> Column:
        """The vectors of texts whose ``word_places`` are stored."""
        idf = np.asarray(self.idf, dtype=np.float64)
        dims = len(idf)

        @F.arrow_udf("array<float>")
        def vectors(places: pa.Array) -> pa.Array:
            filled = [np.empty(0, np.float32)]
            for first in range(0, len(places), ROWS_AT_ONCE):
                some = places.slice(first, ROWS_AT_ONCE)
                n = np.asarray(some.value_lengths().fill_null(0))
                at = np.repeat(np.arange(len(some)) * dims, n) + np.asarray(some.flatten())
                v = np.bincount(at, minlength=len(some) * dims).reshape(-1, dims) * idf
                # Summed in the order of places, as everywhere.
                norm = np.sqrt(np.add.accumulate(v * v, axis=1)[:, -1:])
                filled.append(np.divide(v, norm, out=np.zeros_like(v), where=norm > 0).astype(np.float32).ravel())
            ends = np.arange(len(places) + 1, dtype=np.int32) * dims
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(filled)), mask=places.is_null())

        return vectors(places)


def fit_embedder(df: DataFrame, text_col: str, dims: int = VECTOR_SIZE, placed: bool = False) -> Embedder:
    """One aggregate pass: in how many texts each place occurs. The driver sees ``dims`` rows.

    ``placed``: the column holds the ``word_places`` of the texts.
    """
    at = F.col(text_col) if placed else word_places(F.col(text_col), dims)
    places = df.select(F.explode_outer(F.array_append(
        F.coalesce(F.array_distinct(at), F.array().cast("array<int>")), F.lit(-1))).alias("at"))
    found = dict(places.groupBy("at").count().collect())
    n = found.get(-1, 0)
    return Embedder([math.log((n + 1) / (found.get(k, 0) + 1)) for k in range(dims)])


def embed(df: DataFrame, text_col: str, embedder, out: str = "values") -> DataFrame:
    """Add a vector column. ``embedder`` is a function Column -> Column: an ``Embedder``, or for
    example a pandas UDF around a model."""
    return df.withColumn(out, embedder(F.col(text_col)))


def chunk_articles(articles: DataFrame, strategy: str = "recursive", size: int = CHUNK_SIZE,
                   overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Cleaned story of each article cut into chunks.

    The parser variant decodes every entity; the splitter needs Python anyway.
    """
    cleaned = articles.withColumn("story", clean_html_strict(F.col("story")))
    return chunk(cleaned, "story", strategy, size, overlap)


def chunk_records(chunks: DataFrame) -> DataFrame:
    """Vector records: chunk id, values, metadata."""
    return chunks.select(
        chunk_id(F.col("id"), F.col("chunk_index")).alias("id"), "values",
        F.struct("published", "chunk_index", F.col("id").alias("article_id"), "chunk_text",
                 "headline", "story").alias("metadata"))


def embed_new(lake: Lake, embedder, at: Column) -> None:
    """Embed the articles without a marker, store their vectors, then mark them.

    The marker is written last: a run lost in between is repeated, and repeating
    replaces the same chunk ids.
    """
    fresh = unprocessed(lake.read("stage", "dim_articles"),
                        lake.read("stage", "article_embeddings"), {"id": "article_id"})
    if fresh.isEmpty():
        return
    # The ids are fixed before anything is written: a story that comes in meanwhile is
    # left to the next run instead of being marked without vectors.
    folder = scratch_dir(lake.spark, "fresh")
    fresh.write.parquet(folder)
    fresh = lake.spark.read.schema(fresh.schema).parquet(folder)
    records = chunk_records(embed(chunk_articles(fresh), "chunk_text", embedder))
    lake.upsert(records, "vectors", "article_chunks")
    marks = fresh.select(F.col("id").alias("article_id"),
                         at.cast("timestamp_ntz").alias("processed_at"))
    lake.upsert(marks, "stage", "article_embeddings")


def retrieve(questions: DataFrame, corpus: DataFrame, k: int = TOP_K) -> DataFrame:
    """Hits with payload: query_id, rank, id, score, article_id, chunk_text.

    Text joins after ranking, so the search moves vectors and ids only. A checked
    number of queries bounds the hits to queries x k; those are broadcast to the
    corpus, which would otherwise be shuffled for a handful of rows.
    """
    hits = cosine_top_k(questions, corpus, k)
    if questions.count() * k <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)
    payload = corpus.select("id", F.col("metadata.article_id"), F.col("metadata.chunk_text"))
    return payload.join(hits, "id").select(
        "query_id", "rank", "id", "score", "article_id", "chunk_text")


def retrieve_stored(lake: Lake, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """Hits in the stored vector table, with their payload.

    The search reads ids and vectors alone. A hit's id tells its block, and the payload is
    joined by block and id: the directories without a hit are skipped while the query runs.
    """
    hits = cosine_top_k(questions, lake.read("vectors", "article_chunks"), k)
    hits = hits.withColumn(BLOCK, lake.block_of("vectors", "article_chunks"))
    if questions.count() * k <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)
    payload = lake.read_blocks("vectors", "article_chunks").select(
        "id", BLOCK, F.col("metadata.article_id"), F.col("metadata.chunk_text"))
    return payload.join(hits, [BLOCK, "id"]).select(
        "query_id", "rank", "id", "score", "article_id", "chunk_text")


def shape_contexts(hits: DataFrame) -> DataFrame:
    """Per query the contexts and article ids in rank order (at most k hits each)."""
    ordered = F.array_sort(F.collect_list(
        F.struct("rank", "id", "score", "article_id", "chunk_text")))
    return hits.groupBy("query_id").agg(ordered.alias("_h")).select(
        "query_id",
        F.transform("_h", lambda h: F.struct(h.id.alias("id"), h.score.alias("score"),
                                             h.article_id.alias("article_id"),
                                             h.chunk_text.alias("chunk_text"))).alias("contexts"),
        F.filter(F.transform("_h", lambda h: h.article_id),
                 lambda a: a.isNotNull()).alias("articles"))


def assemble_context(shaped: DataFrame) -> DataFrame:
    """The prompt context of each question: snippets in rank order."""
    # The format of a snippet and the space between them.
    snippet = F.transform("contexts", lambda c: F.concat(
        F.lit("[article_id="), F.coalesce(c.article_id.cast("string"), F.lit("None")),
        F.lit("] "), F.coalesce(c.chunk_text, F.lit(""))))
    return shaped.withColumn("context", F.array_join(snippet, "\n\n"))


def top_article(hits: DataFrame) -> DataFrame:
    """The parent article of each query's best chunk."""
    return hits.where(F.col("rank") == 1).select("query_id", "article_id", "score")


def evaluate(hits: DataFrame, eval_set: DataFrame, experiment: str, k: int = TOP_K,
             ) -> tuple[DataFrame, DataFrame]:
    """Scores per question and their means under the experiment name."""
    scores = ranking_metrics(hits, eval_set, k)
    return (scores.withColumn("experiment", F.lit(experiment)),
            experiment_summary(scores, experiment))


def register_eval_set(existing: DataFrame, eval_set: DataFrame) -> DataFrame:
    """Questions already registered keep their row; new ones are added once."""
    fresh = latest_per_key(eval_set, ["question"], ["article_id"])
    known = existing.select("question")
    return existing.unionByName(
        fresh.join(known, "question", "left_anti").select(*existing.columns))
