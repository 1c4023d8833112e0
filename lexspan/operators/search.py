"""Multi-query top-k search over a searchable chunk table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clamp_int
from .scoring import scored_row, scored_sets, unique_queries

# The folder that searches leave out, and the bounds of k.
EXCLUDED = "00_GPT_CONFIGURATION/"
DEFAULT_K, LEAST_K, MOST_K = 8, 1, 50


def scored(chunks: DataFrame, queries: str | list) -> DataFrame:
    """Matching chunks with score, matched_queries and matched_terms; one narrow pass, nothing shuffled.

    `chunks` needs content_norm and path_norm. Each different term is counted once a chunk,
    however many queries ask for it.
    """
    inside = chunks.where(~F.col("file").startswith(EXCLUDED))
    return inside.select("*", F.inline(scored_row(unique_queries(queries)))).where("score > 0")


def search(chunks: DataFrame, queries: str | list, k: object = DEFAULT_K) -> DataFrame:
    """The best k chunks: file, folder, content, score, matched_queries, matched_terms, doc_ord, chunk_no.

    Ties go by ingest order (doc_ord, file, chunk_no). Each task keeps its own best k, so k rows a
    task reach the driver's merge. No usable query: no rows.
    """
    k = clamp_int(k, DEFAULT_K, LEAST_K, MOST_K)
    ranked = scored(chunks, queries).orderBy(F.desc("score"), "doc_ord", "file", "chunk_no").limit(k)
    return ranked.select("file", "folder", "content", "score", "matched_queries", "matched_terms", "doc_ord", "chunk_no")


def search_many(chunks: DataFrame, sets: dict[str, str | list], k: object = DEFAULT_K) -> DataFrame:
    """The best k of each named query set, with `query_set`, as `search` has them for each alone.

    One scan, whatever the number of sets. Each task passes on its own best k a set (a group
    limit), so that many rows a set and task are shuffled. Sets without a usable query have no rows.
    """
    k = clamp_int(k, DEFAULT_K, LEAST_K, MOST_K)
    inside = chunks.where(~F.col("file").startswith(EXCLUDED))
    hits = inside.select("file", "folder", "content", "doc_ord", "chunk_no", F.inline(scored_sets(sets)))
    best = Window.partitionBy("query_set").orderBy(F.desc("score"), "doc_ord", "file", "chunk_no")
    ranked = hits.withColumn("__rank", F.row_number().over(best)).where(F.col("__rank") <= k)
    return ranked.select("query_set", "file", "folder", "content", "score", "matched_queries", "matched_terms", "doc_ord", "chunk_no")
