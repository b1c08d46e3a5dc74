"""Keyword and hybrid retrieval over the chunk table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.functions import texts
from kbforge.operators import bm25, hybrid
from kbforge.plans.registry import Tables, query
from kbforge.plans.vector_queries import CHUNKS, QUERY_STEP, query_rows

KEYWORDS = ["harbour winter", "old bridge", "valley"]
TOPIC = "old harbour bridge in the valley"


def bm25_sql(table: str, key: str, fields: list[str], queries: list[str]) -> str:
    """CTE ``b`` (query, key, score). The queries are words in lower case with single blanks between."""
    tok = lambda c: f"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^a-z0-9]+'), lambda x: x <> '')"
    terms = sorted({x for q in queries for x in q.split()})
    cols = ", ".join(f"{tok(f)} AS t_{i}" for i, f in enumerate(fields))
    freq = lambda i, t: f"len(list_filter(t_{i}, lambda x: x = '{t}'))"
    stat = ", ".join([f"avg(len(t_{i})) AS a_{i}" for i in range(len(fields))] + [f"sum(({freq(i, t)} > 0)::INT) AS d_{i}_{t}" for i in range(len(fields)) for t in terms])

    def part(i: int, t: str) -> str:
        tf = freq(i, t)
        return f"CASE WHEN {tf} > 0 THEN ln(1 + (n - d_{i}_{t} + 0.5) / (d_{i}_{t} + 0.5)) * {tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * len(t_{i}) / a_{i})) ELSE 0 END"

    union = " UNION ALL ".join(f"SELECT {n}::BIGINT AS query, {key}, round({' + '.join(part(i, t) for i in range(len(fields)) for t in q.split())}, 6)::DOUBLE AS score FROM tk, st" for n, q in enumerate(queries))
    return f"tk AS (SELECT {key}, {cols} FROM {table}), st AS (SELECT count(*) AS n, {stat} FROM tk), b AS (SELECT * FROM ({union}) WHERE score > 0)"


@query("bm25_topk", f"WITH {bm25_sql('documents', 'doc_id', ['text'], ['harbour bridge'])} SELECT doc_id, score FROM b ORDER BY score DESC, doc_id LIMIT 50")
def bm25_topk(t: Tables) -> DataFrame:
    return bm25.scores(t.documents, "doc_id", ["text"], ["harbour bridge"]).orderBy(F.col("score").desc(), "doc_id").limit(50).select("doc_id", "score")


_RANKED = "row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank"


@query("bm25_two_field", f"WITH {bm25_sql('ts_wikipedia_en_embed', 'id', ['title', 'chunk_text'], KEYWORDS)} SELECT query, id, score, rank FROM (SELECT *, {_RANKED} FROM b) WHERE rank <= 50")
def bm25_two_field(t: Tables) -> DataFrame:
    return bm25.top_k(t.ts_wikipedia_en_embed, "id", ["title", "chunk_text"], KEYWORDS, 50).select("query", "id", "score", F.col("rank").cast("long").alias("rank"))


@query("bm25_multi_keyword_best", f"""WITH {bm25_sql('ts_wikipedia_en_embed', 'id', ['chunk_text'], KEYWORDS)}, k AS (SELECT * FROM (SELECT *, {_RANKED} FROM b) WHERE rank <= 50)
  SELECT id, query, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, query) AS r FROM k) WHERE r = 1""")
def bm25_multi_keyword_best(t: Tables) -> DataFrame:
    hits = bm25.top_k(t.ts_wikipedia_en_embed, "id", ["chunk_text"], KEYWORDS, 50)
    return hybrid.search.best_per_key(hits, "id", "score", ascending=False).select("id", "query", "score")


def _merged_sql(k: int) -> str:
    """CTEs up to ``m`` (id, distance, similarity, score)."""
    near = f"""c AS ({CHUNKS}), nh AS (SELECT q.id AS query, c.id, round(1 - list_cosine_similarity(c.v, q.v), 6) AS distance,
      row_number() OVER (PARTITION BY q.id ORDER BY round(1 - list_cosine_similarity(c.v, q.v), 6), c.id) AS rank FROM c, c AS q WHERE q.id % {QUERY_STEP} = 0),
      nb AS (SELECT id, min(distance) AS distance FROM nh WHERE rank <= {k} GROUP BY id)"""
    found = f"kb AS (SELECT id, max(score) AS score FROM (SELECT *, {_RANKED} FROM b) WHERE rank <= {k} GROUP BY id)"
    return f"{bm25_sql('ts_wikipedia_en_embed', 'id', ['title', 'chunk_text'], KEYWORDS)}, {near}, {found}, m AS (SELECT coalesce(nb.id, kb.id) AS id, distance, round((2 - distance) / 2, 7) AS similarity, score FROM nb FULL JOIN kb ON nb.id = kb.id)"


_SENTENCES = r"""list_filter(string_split(regexp_replace(trim({c}), '([.!?。！？]["''”’)\]]*)\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"""
_TEXT = """array_to_string(list_transform(chunks, lambda x, i: CASE WHEN i > 1 AND chunks[i - 1].chunk_index = x.chunk_index - 1 THEN
    array_to_string(CASE WHEN len({s}) >= 3 THEN ({s})[2:] ELSE {s} END, '...') ELSE x.chunk_text END), '...')""".format(s=_SENTENCES.format(c="x.chunk_text"))


def _fusion(f: hybrid.Fusion) -> str:
    return f"round({f.vector_weight} * (1 - coalesce(distance, 2.0) / 2) + {f.bm25_weight} * (coalesce(score, 0.0) / 50.0), 6)"


def _regroup(source: str) -> str:
    first = "ORDER BY coalesce(distance, 2.0), x.id"
    return f"""SELECT source_id, first(x.id {first}) AS id, first(title {first}) AS title, first(url {first}) AS url, min(coalesce(distance, 2.0)) AS distance, max(coalesce(similarity, 0.0)) AS similarity, max(coalesce(score, 0.0)) AS score,
      list_sort(list_distinct(list({{'chunk_index': chunk_index, 'chunk_text': chunk_text}}))) AS chunks FROM {source} x JOIN ts_wikipedia_en_embed w ON x.id = w.id GROUP BY source_id"""


def _merge_first(f: hybrid.Fusion) -> str:
    return f"""{_merged_sql(f.sub_query)}, g AS ({_regroup('m')}), tx AS (SELECT * EXCLUDE (chunks), {_TEXT} AS text, {_fusion(f)} AS fusion FROM g),
      cu AS (SELECT * FROM tx ORDER BY fusion DESC, distance, id LIMIT {f.sub_query})"""


def _fuse_first(f: hybrid.Fusion) -> str:
    return f"""{_merged_sql(f.sub_query)}, fu AS (SELECT *, {_fusion(f)} AS fusion FROM m ORDER BY fusion DESC, coalesce(distance, 2.0), id LIMIT {max(200, 10 * f.results)}),
      g AS ({_regroup('fu')}), cu AS (SELECT * EXCLUDE (chunks), {_TEXT} AS text, {_fusion(f)} AS fusion FROM g)"""


_TAIL = "SELECT source_id, id, title, distance, similarity, score, fusion, text, {r} AS rank_score FROM cu ORDER BY {r} DESC, fusion DESC, distance, id LIMIT {n}"
_OUT = ["source_id", "id", "title", "distance", "similarity", "score", "fusion", "text", "rank_score"]


def _queries(t: Tables) -> DataFrame:
    return query_rows(t.ts_wikipedia_en_embed, "id", "vector")


@query("hybrid_outer_merge", f"WITH {_merged_sql(50)} SELECT * FROM m")
def hybrid_outer_merge(t: Tables) -> DataFrame:
    return hybrid.hits(t.ts_wikipedia_en_embed, _queries(t), KEYWORDS, hybrid.CLI)


@query("hybrid_rank_fallback", f"WITH {_fuse_first(hybrid.API)} {_TAIL.format(r='score', n=hybrid.API.results)}")
def hybrid_rank_fallback(t: Tables) -> DataFrame:
    return hybrid.retrieve(t.ts_wikipedia_en_embed, _queries(t), KEYWORDS, hybrid.API).select(*_OUT)


_TOPIC = ["old", "harbour", "bridge", "in", "the", "valley"]
_OVERLAP = "round(len(list_filter({w}, lambda y: list_contains(regexp_split_to_array(lower(substr(text, 1, 4096)), '[^a-z0-9]+'), y))) / {n}, 6)".format(w=_TOPIC, n=float(len(_TOPIC)))


@query("hybrid_fusion_cli", f"WITH {_merge_first(hybrid.CLI)} {_TAIL.format(r=_OVERLAP, n=hybrid.CLI.results)}")
def hybrid_fusion_cli(t: Tables) -> DataFrame:
    return hybrid.retrieve(t.ts_wikipedia_en_embed, _queries(t), KEYWORDS, hybrid.CLI, hybrid.lexical_overlap(TOPIC, F.col("text"))).select(*_OUT)


@query("hybrid_fusion_api", f"WITH {_fuse_first(hybrid.API)} {_TAIL.format(r=_OVERLAP, n=hybrid.API.results)}")
def hybrid_fusion_api(t: Tables) -> DataFrame:
    return hybrid.retrieve(t.ts_wikipedia_en_embed, _queries(t), KEYWORDS, hybrid.API, hybrid.lexical_overlap(TOPIC, F.col("text"))).select(*_OUT)


@query("chunk_regroup", f"WITH {_merged_sql(50)}, g AS ({_regroup('m')}) SELECT source_id, id, title, distance, similarity, score, len(chunks) AS n_chunks FROM g")
def chunk_regroup(t: Tables) -> DataFrame:
    chunks = t.ts_wikipedia_en_embed
    merged = hybrid.hits(chunks, _queries(t), KEYWORDS, hybrid.CLI).join(chunks.select("id", "source_id", "chunk_index", "title", "url", "chunk_text"), "id")
    return hybrid.regroup(merged).select("source_id", "id", "title", "distance", "similarity", "score", F.size("chunks").cast("long").alias("n_chunks"))


@query("chunk_merge_text", f"SELECT source_id, {_TEXT} AS text FROM (SELECT source_id, list_sort(list_distinct(list({{'chunk_index': chunk_index, 'chunk_text': chunk_text}}))) AS chunks FROM ts_wikipedia_en_embed GROUP BY source_id)")
def chunk_merge_text(t: Tables) -> DataFrame:
    grouped = t.ts_wikipedia_en_embed.groupBy("source_id").agg(F.array_sort(F.collect_set(F.struct("chunk_index", "chunk_text"))).alias("chunks"))
    return hybrid.with_text(grouped)


@query("chunk_adjacent_lag", "SELECT id, source_id, chunk_index, coalesce(lag(chunk_index) OVER (PARTITION BY source_id ORDER BY chunk_index, id) = chunk_index - 1, false) AS follows FROM ts_wikipedia_en_embed")
def chunk_adjacent_lag(t: Tables) -> DataFrame:
    return hybrid.adjacency(t.ts_wikipedia_en_embed).select("id", "source_id", "chunk_index", "follows")


@query("rerank_lexical", f"SELECT doc_id, {_OVERLAP} AS rank_score FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def rerank_lexical(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", hybrid.lexical_overlap(TOPIC, F.col("text")).alias("rank_score"))


@query("sentence_split", f"SELECT doc_id, (i - 1)::INTEGER AS place, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_SENTENCES.format(c='text')} AS s FROM documents WHERE text IS NOT NULL))")
def sentence_split(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(texts.sentences(F.col("text"))).alias("place", "sentence"))


#: Two folds: the words of a long sentence into pieces, apart by one private character, and the pieces into chunks, apart
#: by another. The first piece of a chunk is the last one of the chunk before.
_WORDS = r"regexp_extract_all(x, '[^\p{Z}\t\n\x0b\f\r\x1c-\x1f\x{85}]+')"
_CUT = f"""CASE WHEN length(x) <= 682 THEN [x] WHEN len({_WORDS}) = 0 THEN []
    ELSE string_split(list_reduce({_WORDS}, lambda acc, w: CASE WHEN length(string_split(acc, chr(57344))[-1]) + length(w) + 1 < 682 THEN acc || ' ' || w ELSE acc || chr(57344) || w END), chr(57344)) END"""
_FOLD = """list_reduce(p, lambda acc, x: CASE WHEN length(string_split(acc, chr(57345))[-1]) + length(x) < 2048 THEN acc || chr(57344) || x
    ELSE acc || chr(57345) || regexp_extract(acc, '[^' || chr(57344) || chr(57345) || ']*$') || chr(57344) || x END)"""


@query("chunk_text", f"""WITH p AS (SELECT doc_id, flatten(list_transform({_SENTENCES.format(c='text')}, lambda x: {_CUT})) AS p FROM documents WHERE trim(text) <> ''),
  c AS (SELECT doc_id, string_split(replace({_FOLD}, chr(57344), ' '), chr(57345)) AS c FROM p WHERE len(p) > 0) SELECT doc_id, unnest(range(0, len(c))) AS chunk_index, unnest(c) AS chunk_text FROM c""")
def chunk_text(t: Tables) -> DataFrame:
    return texts.chunk_documents(t.documents, "doc_id", "text")
