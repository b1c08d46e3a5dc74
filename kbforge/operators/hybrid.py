"""Hybrid retrieval: vector hits and keyword hits merged, regrouped by document, fused, reranked and cut.

Two orders of work are in use: ``merge_first`` regroups chunks, then fuses and cuts; ``fuse_first`` fuses and cuts
chunks, then regroups. A missing distance counts as 2 and a missing score as 0. Ties go to the smaller distance, then
to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.functions import texts
from kbforge.functions import vectors as V
from kbforge.operators import bm25, search

#: The largest distance and the score that counts as 1.
MAX_DISTANCE, MAX_SCORE = 2.0, 50.0
DIGITS = 6


@dataclass(frozen=True)
class Fusion:
    vector_weight: float = 0.6
    bm25_weight: float = 0.4
    sub_query: int = 50
    results: int = 20
    order: str = "merge_first"


CLI = Fusion()
API = Fusion(0.9, 0.1, 300, 20, "fuse_first")


def fusion_score(distance: Column, score: Column, f: Fusion) -> Column:
    """wv * (1 - d / 2) + wb * s / 50; the score isn't clamped."""
    d, s = F.coalesce(distance, F.lit(MAX_DISTANCE)), F.coalesce(score, F.lit(0.0))
    return F.round(f.vector_weight * (1 - d / MAX_DISTANCE) + f.bm25_weight * (s / MAX_SCORE), DIGITS)


def outer_merge(vector_hits: DataFrame, keyword_hits: DataFrame, key: str = "id") -> DataFrame:
    """(key, distance, similarity, score): all rows of either side; what the other side lacks is null."""
    left = vector_hits.select(key, "distance", F.round(V.distance_similarity(F.col("distance")), DIGITS + 1).alias("similarity"))
    return left.join(keyword_hits.select(key, "score"), key, "full_outer")


def hits(chunks: DataFrame, queries: DataFrame, keywords: list[str], f: Fusion) -> DataFrame:
    """Merged hits of the chunk table for query vectors (query, vec) and keywords."""
    near = search.best_per_key(search.many_top_k(chunks, "id", "vector", queries, f.sub_query), "id")
    found = search.best_per_key(bm25.top_k(chunks, "id", ["title", "chunk_text"], keywords, f.sub_query), "id", "score", ascending=False)
    return outer_merge(near, found)


def regroup(merged: DataFrame) -> DataFrame:
    """One row per source_id: best distance, similarity and score, chunks in order, and the fields of the first hit.

    A chunk delivered more than once counts once. The chunks of a document are gathered after the top-k cuts, so a
    group is bounded by the number of hits.
    """
    first = F.struct(F.coalesce("distance", F.lit(MAX_DISTANCE)).alias("d"), F.col("id"))
    return merged.groupBy("source_id").agg(
        F.min_by("id", first).alias("id"), F.min_by("title", first).alias("title"), F.min_by("url", first).alias("url"),
        F.min(F.coalesce("distance", F.lit(MAX_DISTANCE))).alias("distance"), F.max(F.coalesce("similarity", F.lit(0.0))).alias("similarity"), F.max(F.coalesce("score", F.lit(0.0))).alias("score"),
        F.array_sort(F.collect_set(F.struct("chunk_index", "chunk_text"))).alias("chunks"),
    )


def with_text(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn("text", texts.join_chunks(F.col("chunks"))).drop("chunks")


def cut(df: DataFrame, f: Fusion, n: int) -> DataFrame:
    fused = df.withColumn("fusion", fusion_score(F.col("distance"), F.col("score"), f))
    return fused.orderBy(F.col("fusion").desc(), F.coalesce("distance", F.lit(MAX_DISTANCE)), "id").limit(n)


def retrieve(chunks: DataFrame, queries: DataFrame, keywords: list[str], f: Fusion, rerank: Column | None = None) -> DataFrame:
    """The answer of a hybrid query. ``rerank``: a score over column ``text`` (at most its first 4096 characters are
    read by the caller's scorer); without one the keyword score ranks."""
    fields = chunks.select("id", "source_id", "chunk_index", "title", "url", "chunk_text")
    merged = hits(chunks, queries, keywords, f).join(fields, "id")
    if f.order == "merge_first":
        found = cut(with_text(regroup(merged)), f, f.sub_query)
    else:
        found = with_text(regroup(cut(merged, f, max(200, 10 * f.results))))
        found = found.withColumn("fusion", fusion_score(F.col("distance"), F.col("score"), f))
    scored = found.withColumn("rank_score", F.col("score") if rerank is None else rerank)
    return scored.orderBy(F.col("rank_score").desc(), F.col("fusion").desc(), "distance", "id").limit(f.results)


def lexical_overlap(topic: str, text: Column) -> Column:
    """A plain reranker: the share of the topic's words in the first 4096 characters of the text."""
    words = bm25.query_terms(topic)
    held = bm25.tokens(F.substring(text, 1, 4096))
    found = sum((F.array_contains(held, w).cast("int") for w in words), F.lit(0))
    return F.round(found / max(1, len(words)), DIGITS)


def adjacency(chunks: DataFrame) -> DataFrame:
    """Each chunk with ``follows``: whether the one before it in its source is its direct predecessor."""
    before = F.lag("chunk_index").over(Window.partitionBy("source_id").orderBy("chunk_index", "id"))
    return chunks.withColumn("follows", F.coalesce(before == F.col("chunk_index") - 1, F.lit(False)))
