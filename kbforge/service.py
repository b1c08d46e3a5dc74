"""The engine's calls, as a service or command line would make them; each returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbforge.functions import vectors as V
from kbforge.operators import hybrid, search
from kbforge.providers import Embedder, expand_query

TEXT_ITEM = ["score", "url", "title", "text"]
IMAGE_DEFAULTS = {"url": "''", "caption": "''", "processed_storage_id": "''", "aspect_ratio": "0.0D", "exif": "'{}'", "source": "array()"}


def hybrid_search(chunks: DataFrame, topic: str, embedder: Embedder, results: int = 20, fusion: hybrid.Fusion = hybrid.API, generate=None, rerank: Column | None = None) -> DataFrame:
    """(score, url, title, text): the topic is expanded, its sentences embedded, its keywords matched, all fused."""
    asked = expand_query(topic, generate)
    vectors = embedder.embed_texts(asked["sentences"], "query")
    queries = chunks.sparkSession.createDataFrame([(i, v) for i, v in enumerate(vectors)], "query long, vec array<double>")
    found = hybrid.retrieve(chunks, queries, asked["keywords"], fusion, rerank)
    return found.limit(results).select(F.col("rank_score").alias("score"), "url", "title", "text")


def image_search(images: DataFrame, vectors: list[list[float]], results: int = 20) -> DataFrame:
    """Images near any of the query vectors (L2), nearest first, with the columns of an answer; what an image lacks has
    its default. ``score`` is (2 - distance) / 2."""
    queries = images.sparkSession.createDataFrame([(i, v) for i, v in enumerate(vectors)], "query long, vec array<double>")
    hits = search.best_per_key(search.many_top_k(images, "id", "vector", queries, results, "l2"), "id").select("id", "distance")
    columns = [F.coalesce(F.col(c), F.expr(d)).alias(c) if c in images.columns else F.expr(d).alias(c) for c, d in IMAGE_DEFAULTS.items()]
    joined = images.select("id", *columns).join(hits, "id")
    return joined.orderBy("distance", "id").limit(results).select(V.distance_similarity(F.col("distance")).alias("score"), *IMAGE_DEFAULTS, "distance")


def term_search(images: DataFrame, keywords: list[list[float]], sentences: list[list[float]], per_term: int = 50) -> DataFrame:
    """(id, query, distance, similarity): images near the terms of two lists, each term weaker than the one before it
    in its own list."""
    rows = [(i, v, i) for i, v in enumerate(keywords)] + [(len(keywords) + i, v, i) for i, v in enumerate(sentences)]
    queries = images.sparkSession.createDataFrame(rows, "query long, vec array<double>, position int")
    hits = search.many_top_k(images, "id", "vector", queries.select("query", "vec"), per_term, "l2")
    placed = hits.join(F.broadcast(queries.select("query", "position")), "query")  # as many rows as there are terms
    return search.best_per_key(search.decayed(placed), "id").select("id", "query", "distance", "similarity").orderBy("distance", "id")
