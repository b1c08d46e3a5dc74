"""Vector search, quantisation and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.functions import vectors as V
from kbforge.operators import dedup, search, store
from kbforge.plans.registry import Tables, query

#: Every row whose id is divisible by this is a query against all rows.
QUERY_STEP = 50
_OK = "len({v}) = 64 AND len(list_filter({v}, lambda x: x <> 0)) > 0"
CHUNKS = f"SELECT id, title, url, source_id, chunk_index, chunk_text, vector::DOUBLE[] AS v FROM ts_wikipedia_en_embed WHERE {_OK.format(v='vector')}"
IMAGES = f"SELECT id, emb_vector_col::DOUBLE[] AS v FROM emb_table WHERE {_OK.format(v='emb_vector_col')}"
FIRST_CHUNK = "(SELECT v FROM c ORDER BY id LIMIT 1)"
STORE = store.Config("knowledge", "store", "documents", "doc_id", "embeddings", ("embedding",), "hash", retrieval_columns=("source",), tags_column="tags", direct_search_columns=("source", "lang"))


def first_vector(df: DataFrame, key: str, vector: str) -> list[float]:
    row = df.where(search.usable(F.col(vector), 64)).orderBy(key).select(vector).first()
    return [] if row is None else [float(x) for x in row[0]]


def query_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where((F.col(key) % QUERY_STEP == 0) & search.usable(F.col(vector), 64)).select(F.col(key).alias("query"), F.col(vector).alias("vec"))


@query("vec_cosine_topk", f"""WITH c AS ({CHUNKS}) SELECT id, title, source_id, chunk_index, round(1 - list_cosine_similarity(v, {FIRST_CHUNK}), 6) AS distance,
  round((2 - round(1 - list_cosine_similarity(v, {FIRST_CHUNK}), 6)) / 2, 7) AS similarity FROM c ORDER BY distance, id LIMIT 30""")
def vec_cosine_topk(t: Tables) -> DataFrame:
    chunks = t.ts_wikipedia_en_embed
    near = search.top_k(chunks, "id", "vector", first_vector(chunks, "id", "vector"), 30)
    return near.select("id", "title", "source_id", "chunk_index", "distance", F.round(V.distance_similarity(F.col("distance")), 7).alias("similarity"))


@query("vec_l2_topk", f"WITH c AS ({IMAGES}) SELECT id, round(list_distance(v, {FIRST_CHUNK}), 6) AS distance FROM c ORDER BY distance, id LIMIT 50")
def vec_l2_topk(t: Tables) -> DataFrame:
    return search.top_k(t.emb_table, "id", "emb_vector_col", first_vector(t.emb_table, "id", "emb_vector_col"), 50, "l2").select("id", "distance")


@query("similarity_inverse", f"WITH c AS ({IMAGES}) SELECT id, round(1 / (1 + round(list_distance(v, {FIRST_CHUNK}), 6)), 6) AS similarity FROM c")
def similarity_inverse(t: Tables) -> DataFrame:
    q = search.vector_literal(first_vector(t.emb_table, "id", "emb_vector_col"))
    usable = t.emb_table.where(search.usable(F.col("emb_vector_col"), 64))
    return usable.select("id", F.round(V.inverse_similarity(F.round(V.l2_distance(F.col("emb_vector_col"), q), 6)), 6).alias("similarity"))


@query("vec_cosine_join_meta_tags", """SELECT d.doc_id, coalesce(d.source, '') AS source, round(list_cosine_similarity(e.embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)), 6) AS similarity
  FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id WHERE e.embedding IS NOT NULL AND list_has_all([d.lang, d.source], ['en']) ORDER BY similarity DESC, d.doc_id LIMIT 10""")
def vec_cosine_join_meta_tags(t: Tables) -> DataFrame:
    meta = t.documents.withColumn("tags", F.array("lang", "source"))
    vectors = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    return store.search_documents(meta, vectors, STORE, first_vector(t.embeddings, "vec_id", "embedding"), 10, ["en"])


@query("direct_lookup", "SELECT doc_id, source FROM documents WHERE lang = 'en' AND source = (SELECT max(source) FROM documents WHERE lang = 'en') ORDER BY doc_id LIMIT 10")
def direct_lookup(t: Tables) -> DataFrame:
    source = t.documents.where("lang = 'en'").agg(F.max("source")).first()[0]
    return store.direct_search(t.documents, STORE, {"lang": "en", "source": source})


@query("tags_has_all", "SELECT doc_id FROM documents WHERE list_has_all([lang, source], ['en'])")
def tags_has_all(t: Tables) -> DataFrame:
    return t.documents.withColumn("tags", F.array("lang", "source")).where(store.has_all_tags("tags", ["en"])).select("doc_id")


@query("tags_edit", """SELECT id, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(list_filter(source, lambda x: x IS NOT NULL), []), ['reviewed', 'pd12m']), lambda x: x <> 'cc12m'))), '|') AS tags FROM is_pd12m""")
def tags_edit(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", F.array_join(store.edit_tags(F.col("source"), ["reviewed", "pd12m"], ["cc12m"]), "|").alias("tags"))


_MULTI = f"""WITH c AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), h AS (SELECT q.id AS query, c.id, round(1 - list_cosine_similarity(c.v, q.v), 6) AS distance,
  row_number() OVER (PARTITION BY q.id ORDER BY round(1 - list_cosine_similarity(c.v, q.v), 6), c.id) AS rank FROM c, c AS q WHERE q.id % {QUERY_STEP} = 0)"""


def _multi(t: Tables) -> DataFrame:
    return search.many_top_k(t.embeddings, "vec_id", "embedding", query_rows(t.embeddings, "vec_id", "embedding"), 30)


@query("vec_per_query_topk", _MULTI + " SELECT query, id AS vec_id, distance, rank FROM h WHERE rank <= 30")
def vec_per_query_topk(t: Tables) -> DataFrame:
    return _multi(t).select("query", "vec_id", "distance", F.col("rank").cast("long").alias("rank"))


@query("vec_multi_query_best", _MULTI + " SELECT id AS vec_id, query, distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, query) AS r FROM h WHERE rank <= 30) WHERE r = 1")
def vec_multi_query_best(t: Tables) -> DataFrame:
    return search.best_per_key(_multi(t), "vec_id").select("vec_id", "query", "distance")


@query("vec_normalize_norm", """SELECT id, round(n, 6) AS norm, round(sqrt(list_sum(list_transform(v, lambda x: (x / greatest(n, 1e-12)) ** 2))), 6) AS unit_norm
  FROM (SELECT id, vector::DOUBLE[] AS v, sqrt(list_sum(list_transform(vector::DOUBLE[], lambda x: x * x))) AS n FROM ts_wikipedia_en_embed WHERE vector IS NOT NULL)""")
def vec_normalize_norm(t: Tables) -> DataFrame:
    rows = t.ts_wikipedia_en_embed.where("vector is not null")
    return rows.select("id", F.round(V.norm(F.col("vector")), 6).alias("norm"), F.round(V.norm(V.normalise(F.col("vector"))), 6).alias("unit_norm"))


@query("vec_mrl_truncate", """SELECT vec_id, len(v)::INTEGER AS dims, round(v[1] / n, 6) AS first, round(v[-1] / n, 6) AS last FROM (SELECT vec_id, v, greatest(sqrt(list_sum(list_transform(v, lambda x: x * x))), 1e-12) AS n
  FROM (SELECT vec_id, (list_concat(embedding, list_reverse(embedding), embedding)::DOUBLE[])[1:128] AS v FROM embeddings))""")
def vec_mrl_truncate(t: Tables) -> DataFrame:
    """Vectors of 192 elements, made from those of 64, cut to 128."""
    cut = t.embeddings.select("vec_id", V.mrl(F.concat("embedding", F.reverse("embedding"), "embedding"), 128).alias("v"))
    return cut.select("vec_id", F.size("v").alias("dims"), F.round(F.element_at("v", 1), 6).alias("first"), F.round(F.element_at("v", -1), 6).alias("last"))


def _codes(limit: float, top: int) -> str:
    return f"list_transform(embedding::DOUBLE[], lambda x: round_even(greatest(0.0, least({2 * limit}, {limit} + x)) / {2 * limit / top}, 0)::INTEGER)"


@query("vec_quantize_int8", f"SELECT vec_id, array_to_string({_codes(V.LIMIT_8BIT, 255)}, ',') AS codes FROM embeddings")
def vec_quantize_int8(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.array_join(V.quantise8(F.col("embedding")).cast("array<string>"), ",").alias("codes"))


@query("vec_quantize_int4", f"SELECT vec_id, array_to_string(list_transform(range(1, len(c), 2), lambda i: c[i] * 16 + c[i + 1]), ',') AS codes FROM (SELECT vec_id, {_codes(V.LIMIT_4BIT, 15)} AS c FROM embeddings)")
def vec_quantize_int4(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.array_join(V.quantise4(F.col("embedding")).cast("array<string>"), ",").alias("codes"))


@query("vec_greatest_similarity", """SELECT vec_id, round(greatest(list_cosine_similarity(v, q), list_cosine_similarity(list_reverse(v), q)), 6) AS similarity
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v, (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1) AS q FROM embeddings)""")
def vec_greatest_similarity(t: Tables) -> DataFrame:
    two = t.embeddings.withColumn("other", F.reverse("embedding"))
    return two.select("vec_id", F.round(search.greatest_similarity(["embedding", "other"], first_vector(t.embeddings, "vec_id", "embedding")), 6).alias("similarity"))


@query("vec_nearest_one", f"""WITH c AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), i AS ({IMAGES}), h AS (SELECT i.id AS query, c.id AS target, round(1 - list_cosine_similarity(c.v, i.v), 6) AS distance,
  row_number() OVER (PARTITION BY i.id ORDER BY round(1 - list_cosine_similarity(c.v, i.v), 6), c.id) AS r FROM i, c WHERE i.id % {QUERY_STEP} = 0) SELECT query, target, distance FROM h WHERE r = 1 AND distance <= 0.8""")
def vec_nearest_one(t: Tables) -> DataFrame:
    rows = query_rows(t.emb_table, "id", "emb_vector_col")
    return search.nearest_within(rows, "query", "vec", t.embeddings, "vec_id", "embedding", 0.6)


@query("vec_threshold_pairs", """WITH c AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings) SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS cosine
  FROM c a JOIN c b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) >= 0.35""")
def vec_threshold_pairs(t: Tables) -> DataFrame:
    return dedup.near_pairs(t.embeddings, "vec_id", "embedding", 64, 0.35, exact=True).select("a", "b", F.round("cosine", 6).alias("cosine"))


#: The leader rule one vector at a time: ``walk`` carries the leaders so far in a list; a vector near one of them follows
#: the smallest.
@query("dedup_greedy_leader", f"""WITH RECURSIVE c AS ({CHUNKS}), near AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS cosine FROM c a JOIN c b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
  nodes AS (SELECT id, coalesce(list(a) FILTER (a IS NOT NULL), []) AS before, row_number() OVER (ORDER BY id) AS n FROM (SELECT b AS id, a FROM near UNION ALL SELECT a, NULL FROM near) GROUP BY id),
  walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS leaders UNION ALL SELECT nodes.n, CASE WHEN list_has_any(before, leaders) THEN leaders ELSE list_append(leaders, id) END FROM walk JOIN nodes ON nodes.n = walk.n + 1),
  l AS (SELECT unnest(leaders) AS id FROM (SELECT leaders FROM walk ORDER BY n DESC LIMIT 1))
  SELECT b AS id, min(a) AS similar_to, round((1 + arg_min(cosine, a)) / 2, 6) AS similarity FROM near WHERE a IN (FROM l) AND b NOT IN (FROM l) GROUP BY b""")
def dedup_greedy_leader(t: Tables) -> DataFrame:
    followers = dedup.greedy_followers(t.ts_wikipedia_en_embed, "id", "vector", 64, 0.98)
    return followers.select("id", "similar_to", F.round((1 + F.col("cosine")) / 2, 6).alias("similarity"))


@query("image_decay_search", f"""WITH c AS ({IMAGES}), h AS (SELECT q.id AS query, c.id, round(list_distance(c.v, q.v), 6) AS d, row_number() OVER (PARTITION BY q.id ORDER BY round(list_distance(c.v, q.v), 6), c.id) AS rank FROM c, c AS q WHERE q.id % {QUERY_STEP} = 0),
  s AS (SELECT query, id, round(d * (1 + 0.3 * ((query // {QUERY_STEP}) % 3)), 6) AS distance FROM h WHERE rank <= 50), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, query) AS r FROM s WHERE distance < 1.4)
  SELECT id, query, distance, round((2 - distance) / 2, 7) AS similarity FROM k WHERE r = 1""")
def image_decay_search(t: Tables) -> DataFrame:
    hits = search.many_top_k(t.emb_table, "id", "emb_vector_col", query_rows(t.emb_table, "id", "emb_vector_col"), 50, "l2")
    placed = hits.withColumn("position", F.floor(F.col("query") / QUERY_STEP) % 3)
    return search.best_per_key(search.decayed(placed), "id").select("id", "query", "distance", "similarity")
