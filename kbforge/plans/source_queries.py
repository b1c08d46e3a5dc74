"""Sources, mappers, work steps and the store over the driver tables. What a reader needs is written from a table first,
as it would be delivered, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge import service
from kbforge.functions import vectors as V
from kbforge.operators import pipeline, search, tables
from kbforge.operators.store import Store, parse_config
from kbforge.plans.registry import Tables, query
from kbforge.plans.vector_queries import IMAGES, first_vector
from kbforge.providers import Encoder, LetterEmbedder, OverlapReranker, pooled, rerank_scores
from kbforge.sources import mappers, readers
from kbforge.staging import shared_dir


def _path(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/kbforge/{t.spark.sparkContext.applicationId}/delivered-{name}-{uuid.uuid4().hex}"


def _delivered(t: Tables, lines: DataFrame, name: str, folder: str = "") -> str:
    path = _path(t, name)
    lines.write.text(path + folder)
    return path


@query("read_json_lines", "SELECT doc_id, lang, source, title FROM documents")
def read_json_lines(t: Tables) -> DataFrame:
    path = _delivered(t, t.documents.select(F.to_json(F.struct("doc_id", "lang", "source", "title")).alias("value")), "lines")
    return readers.json_lines(t.spark, path, "doc_id long, lang string, source string, title string")


@query("read_tolerant_lines", """SELECT doc_id::VARCHAR AS value, 'row' AS kind FROM documents WHERE doc_id % 10 <> 3 UNION ALL SELECT '{"id": "' || doc_id || '", "ti', 'broken' FROM documents WHERE doc_id % 10 = 3""")
def read_tolerant_lines(t: Tables) -> DataFrame:
    """Every tenth line ends too early; the files lie in folders below the one that is read."""
    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "title"))
    line = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit('{"id": "'), F.col("doc_id").cast("string"), F.lit('", "ti'))).otherwise(whole)
    path = _delivered(t, t.documents.select(line.alias("value")), "tolerant", "/AA/BB")
    good, broken = readers.tolerant_json_lines(t.spark, path, "id string, title string", folder=True, pattern="part-*")
    return good.select(F.col("id").alias("value"), F.lit("row").alias("kind")).unionByName(broken.select(F.col("line").alias("value"), F.lit("broken").alias("kind")))


@query("read_parquet_places", "SELECT doc_id, row_number() OVER () - 1 AS id FROM documents")
def read_parquet_places(t: Tables) -> DataFrame:
    return readers.parquet_meta(t.spark, f"{t.folder}/documents.parquet").select("doc_id", "id")


@query("read_by_extension", "SELECT id, url, origin_width FROM is_pd12m")
def read_by_extension(t: Tables) -> DataFrame:
    """The images in three files of different kinds, beside a hidden one."""
    rows, path = t.is_pd12m.select("id", "url", "origin_width"), _path(t, "kinds")
    rows.where("id % 3 = 0").write.parquet(f"{path}/a.parquet")
    rows.where("id % 3 = 1").write.json(f"{path}/b.json")
    rows.where("id % 3 = 2").write.json(f"{path}/c.jsonl")
    return readers.by_extension(t.spark, [f"{path}/{n}" for n in ("c.jsonl", "a.parquet", "b.json", ".d.zip")], "id long, url string, origin_width long")


@query("read_query_vectors", "SELECT 'vector, ' || vec_id AS text, len(embedding)::INTEGER AS n, embedding[1]::DOUBLE AS first, embedding[64]::DOUBLE AS last FROM embeddings WHERE vec_id % 7 <> 2")
def read_query_vectors(t: Tables) -> DataFrame:
    """A seventh of the rows has no list of numbers."""
    listed = F.when(F.col("vec_id") % 7 == 2, F.lit("[not, numbers]")).otherwise(F.to_json(F.col("embedding").cast("array<double>")))
    path = _delivered(t, t.embeddings.select(F.concat(F.lit('"vector, '), F.col("vec_id").cast("string"), F.lit('","'), listed, F.lit('"')).alias("value")), "vectors")
    found = readers.query_vectors(t.spark, path)
    return found.select("text", F.size("vector").alias("n"), F.element_at("vector", 1).alias("first"), F.element_at("vector", -1).alias("last"))


@query("read_query_lines", r"SELECT trim(regexp_replace(query, '\s+', ' ', 'g')) AS query, count(*) AS n FROM ts_ms_marco WHERE trim(regexp_replace(query, '\s+', ' ', 'g')) <> '' GROUP BY 1")
def read_query_lines(t: Tables) -> DataFrame:
    """Queries with blanks around them and blank lines between."""
    line = F.regexp_replace("query", r"\s+", " ")
    lines = t.ts_ms_marco.where("query is not null").select(F.explode(F.array(F.concat(F.lit("  "), line, F.lit(" ")), F.lit("   "))).alias("value"))
    return readers.query_lines(t.spark, _delivered(t, lines, "queries")).groupBy("query").agg(F.count(F.lit(1)).alias("n"))


@query("read_featured", "SELECT p.source_id AS page, p.id AS text_id, i.id AS image_id FROM (SELECT source_id, min(id) AS id FROM ts_wikipedia_en_embed GROUP BY 1) p JOIN ts_wikipedia_en_embed i ON p.source_id = i.source_id")
def read_featured(t: Tables) -> DataFrame:
    """A page's text metadata with those of each image; here a source is a page and each of its chunks an image."""
    raw = lambda c: F.concat(F.lit('"'), F.replace(F.to_json(F.struct(c.alias("id"))), F.lit('"'), F.lit('\\"')), F.lit('"'))
    chunks = t.ts_wikipedia_en_embed
    text = chunks.groupBy(F.col("source_id").alias("page")).agg(F.min("id").alias("id")).select("page", raw(F.col("id")).alias("raw"))
    image = chunks.select(F.col("source_id").alias("page"), raw(F.col("id")).alias("raw"))
    return readers.featured(text, image, "id long").select("page", F.col("text.id").alias("text_id"), F.col("image.id").alias("image_id"))


@query("read_xml_dump", r"""SELECT doc_id AS id, 'Page ' || doc_id AS title, 'https://wiki.example/Page_' || doc_id AS url, CASE WHEN doc_id % 4 = 0 THEN 'Old ' || doc_id ELSE '' END AS redirect, revid AS revisionid,
  CASE doc_id % 3 WHEN 1 THEN 'Talk' ELSE 'Page' END AS namespace, source || ' <&>' AS comment FROM documents WHERE doc_id % 5 <> 0 AND revid IS NOT NULL AND source IS NOT NULL""")
def read_xml_dump(t: Tables) -> DataFrame:
    """A dump of pages; every fifth is known already."""
    d = t.documents.where("revid is not null and source is not null")
    old = F.when(F.col("doc_id") % 4 == 0, F.struct(F.concat(F.lit("Old "), F.col("doc_id").cast("string")).alias("_title")))
    revision = F.struct(F.col("revid").alias("id"), F.concat("source", F.lit(" <&>")).alias("comment"))
    pages = d.select(F.concat(F.lit("Page "), F.col("doc_id").cast("string")).alias("title"), (F.col("doc_id") % 3).cast("string").alias("ns"), F.col("doc_id").alias("id"), old.alias("redirect"), revision.alias("revision"))
    path = _path(t, "dump")
    pages.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    found = readers.xml_dump(t.spark, path, "https://wiki.example/", d.where("doc_id % 5 = 0").select(F.col("doc_id").alias("id")), {"1": "Talk"})
    return found.select("id", "title", "url", "redirect", "revisionid", "namespace", "comment")


@query("map_images", """SELECT url, coalesce(nullif(caption, ''), '') AS caption, sha256(url) AS hash, coalesce(nullif(license, ''), '') AS license, coalesce(nullif(hash, ''), '') AS origin_hash, coalesce(origin_width, 0) AS origin_width, coalesce(origin_height, 0) AS origin_height,
  's3://store/images/' || sha256(url) || '.jpg' AS origin_storage_id, CASE WHEN coalesce(origin_height, 0) <> 0 THEN round(coalesce(origin_width, 0) / origin_height, 6) ELSE 0.0 END AS aspect_ratio FROM is_pd12m WHERE url <> ''""")
def map_images(t: Tables) -> DataFrame:
    """Deliveries with other names for address, caption and hash, and sizes as text, some of which are no numbers."""
    size = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("wide"))
    given = t.is_pd12m.select(F.col("url").alias("image_url"), F.col("caption").alias("long_caption"), "hash", size("origin_width").alias("width"), size("origin_height").alias("height"), "license")
    found = mappers.images(given, "vintage", "long_caption")
    return found.select("url", "caption", "hash", "license", "origin_hash", "origin_width", "origin_height", "origin_storage_id", F.round("aspect_ratio", 6).alias("aspect_ratio"))


@query("map_high_or_low", "SELECT id, CASE WHEN id % 3 = 0 THEN url || '?large' ELSE url END AS url, sha256(CASE WHEN id % 3 = 0 THEN url || '?large' ELSE url END) AS hash, url AS low, origin_source AS origin FROM is_pd12m WHERE url IS NOT NULL")
def map_high_or_low(t: Tables) -> DataFrame:
    high = F.when(F.col("id") % 3 == 0, F.concat("url", F.lit("?large"))).when(F.col("id") % 3 == 1, F.lit(""))
    given = t.is_pd12m.where("url is not null").select("id", "url", high.alias("url_highres"), F.col("origin_source").alias("url_source"))
    mapped = mappers.high_or_low(given.select("url", "url_highres", "url_source"))
    ids = given.select("id", F.col("url").alias("low"))
    return mapped.select("url", "hash", F.col("meta.url_lowres").alias("low"), F.col("meta.url_source").alias("origin")).join(ids, "low").select("id", "url", "hash", "low", "origin")


@query("map_featured", """SELECT url, coalesce(nullif(caption, ''), nullif(caption_long, ''), nullif(license, ''), nullif(origin_source, ''), 'T' || id) AS caption, sha256(url) AS hash, 'file ' || id AS origin_hash, 640::BIGINT AS origin_width, 480::BIGINT AS origin_height FROM is_pd12m WHERE url IS NOT NULL""")
def map_featured(t: Tables) -> DataFrame:
    tag = lambda name, value: F.concat(F.lit(f'<meta property="og:image{name}" content="'), value, F.lit('">\n'))
    html = F.concat(tag("", F.col("url")), tag(":width", F.lit("640")), tag(":height", F.lit("480")))
    image = F.struct(F.col("caption").alias("caption"), F.col("caption_long").alias("description"), F.col("license").alias("parsed_title"), F.col("origin_source").alias("title"), F.format_string("file %d.tar.jpg", "id").alias("filename"))
    given = t.is_pd12m.where("url is not null").select(html.alias("html"), image.alias("image"), F.struct(F.format_string("T%d", "id").alias("title")).alias("text"))
    return mappers.featured_images(given).select("url", "caption", "hash", F.regexp_replace("origin_hash", r"\.tar$", "").alias("origin_hash"), "origin_width", "origin_height")


@query("map_papers", r"""SELECT paper_id, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(authors, ''), ',| and '), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), '|') AS authors, coalesce(journal_ref, '') AS journal_ref,
  CASE WHEN id % 2 = 0 THEN sha256(abstract) ELSE md5(abstract) END AS hash, CASE WHEN id % 2 = 0 THEN '' ELSE coalesce(license, '') END AS license, CASE WHEN id % 2 = 0 THEN '' ELSE coalesce(abstract, '') END AS abstract,
  's3://store/papers/' || CASE WHEN id % 2 = 0 THEN sha256(abstract) ELSE md5(abstract) END || '.pdf' AS origin_storage_id FROM ts_arxiv WHERE abstract <> ''""")
def map_papers(t: Tables) -> DataFrame:
    """Papers in two layouts in turn."""
    given = t.ts_arxiv.where("abstract <> ''").select(
        F.col("paper_id").alias("id"), "submitter", "authors", "title", "comments", F.col("journal_ref").alias("journal-ref"), "doi", F.col("report_no").alias("report-no"), "license", "abstract", F.when(F.col("id") % 2 == 1, F.md5("abstract")).alias("abstract_md5")
    )
    found = mappers.papers(given)
    return found.select("paper_id", F.array_join("authors", "|").alias("authors"), "journal_ref", "hash", "license", "abstract", "origin_storage_id")


def _answer(url: str) -> bytes:
    """A stand-in for the network: the address says what comes."""
    if url.endswith("0.jpg"):
        raise OSError("no such address")
    return b"%PDF-1.7" if url.endswith(("1.jpg", "2.jpg")) else b"text"


_KEY = "'papers/' || hash || '.pdf'"


@query("fetch_step", f"""SELECT id, CASE WHEN id % 9 = 4 OR url LIKE '%1.jpg' OR url LIKE '%2.jpg' THEN 's3://store/' || {_KEY} ELSE '' END AS origin_storage_id,
  CASE WHEN id % 9 = 4 OR url LIKE '%1.jpg' OR url LIKE '%2.jpg' THEN NULL WHEN url LIKE '%0.jpg' THEN 'failed' ELSE 'unexpected kind of file' END AS error FROM is_pd12m WHERE url IS NOT NULL AND hash IS NOT NULL""")
def fetch_step(t: Tables) -> DataFrame:
    """A ninth of the objects is stored already; the others are fetched from a stand-in and must be PDFs."""
    rows = t.is_pd12m.where("url is not null and hash is not null").select("id", "hash", "url")
    stored = rows.where("id % 9 = 4").select(F.concat(F.lit("papers/"), "hash", F.lit(".pdf")).alias("key"))
    found = pipeline.fetch_changes(rows, stored, _answer, "store", "papers", "papers", "PDF")
    return found.select("id", "origin_storage_id", F.when(F.col("error").contains("no such address"), "failed").otherwise(F.col("error")).alias("error"))


@query("validate_step", "SELECT id, id % 3 = 0 AS validated, CASE WHEN id % 3 = 0 THEN origin_storage_id ELSE '' END AS origin_storage_id FROM ts_arxiv WHERE NOT coalesce(validated, false)")
def validate_step(t: Tables) -> DataFrame:
    contents = t.ts_arxiv.select("id", F.when(F.col("id") % 3 == 0, F.lit(b"%PDF-1.4")).otherwise(F.lit(b"<html>")).alias("content"))
    return pipeline.validation_changes(t.ts_arxiv.select("id", "validated", "origin_storage_id"), contents)


@query("enrich_rows", """SELECT id, nullif(exif, '') AS exif, CASE WHEN source IS NULL THEN NULL ELSE to_json(source)::VARCHAR END AS source, updated_at IS NULL AS filled FROM is_pd12m""")
def enrich_rows(t: Tables) -> DataFrame:
    """Structured columns as JSON; a missing time of change is filled."""
    given = t.is_pd12m.select("id", "exif", "source", "updated_at", F.col("updated_at").isNull().alias("filled"))
    found = pipeline.enrich(given, ["exif", "source"])
    return found.select("id", "exif", "source", (F.col("filled") & F.col("updated_at").isNotNull()).alias("filled"))


@query("image_service", f"""WITH c AS ({IMAGES}), q AS (SELECT v FROM c ORDER BY id LIMIT 1), q2 AS (SELECT list_reverse(v) AS v FROM q), h AS (SELECT id, least(round(list_distance(c.v, q.v), 6), round(list_distance(c.v, q2.v), 6)) AS distance FROM c, q, q2)
  SELECT round((2 - distance) / 2, 6) AS score, coalesce(i.url, '') AS url, coalesce(i.caption, '') AS caption, distance FROM h JOIN is_pd12m i ON h.id = i.id ORDER BY distance, h.id LIMIT 20""")
def image_service(t: Tables) -> DataFrame:
    """Images near either of two query vectors, with the columns of an answer."""
    images = t.is_pd12m.select("id", "url", "caption").join(t.emb_table.select("id", F.col("emb_vector_col").alias("vector")), "id")
    first = first_vector(images, "id", "vector")
    found = service.image_search(images, [first, first[::-1]])
    return found.select(F.round("score", 6).alias("score"), "url", "caption", "distance")


@query("zero_vectors", "SELECT id, CASE WHEN vector IS NULL THEN 64 ELSE len(vector) END::INTEGER AS n, CASE WHEN vector IS NULL THEN 0.0 ELSE round(list_sum(list_transform(vector::DOUBLE[], lambda x: abs(x))), 4) END AS size FROM ts_wikipedia_en_embed")
def zero_vectors(t: Tables) -> DataFrame:
    """A missing vector stands as one of zeros."""
    filled = F.coalesce(F.col("vector").cast("array<double>"), V.zero_vector(64).cast("array<double>"))
    return t.ts_wikipedia_en_embed.select("id", F.size(filled).alias("n"), F.round(F.aggregate(filled, F.lit(0.0), lambda a, x: a + F.abs(x)), 4).alias("size"))


@query("md5_of_text", "SELECT doc_id, md5(text) AS digest, md5(coalesce(title, '') || chr(10) || coalesce(lang, '')) AS of_fields FROM documents WHERE text IS NOT NULL")
def md5_of_text(t: Tables) -> DataFrame:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return t.documents.where("text is not null").select("doc_id", F.md5("text").alias("digest"), F.md5(F.concat(blank("title"), F.lit("\n"), blank("lang"))).alias("of_fields"))


@query("url_exists", "SELECT d.doc_id, EXISTS (SELECT 1 FROM is_pd12m i WHERE i.url = d.url) AS in_images, d.doc_id % 2 = 0 AS in_half FROM documents d")
def url_exists(t: Tables) -> DataFrame:
    """Equality look-ups of an address: in another table, and among half of the rows."""
    known = lambda df, name: df.where("url is not null").select("url").distinct().withColumn(name, F.lit(True))
    found = t.documents.select("doc_id", "url").join(known(t.is_pd12m, "in_images"), "url", "left").join(known(t.documents.where("doc_id % 2 = 0"), "in_half"), "url", "left")
    return found.select("doc_id", F.coalesce("in_images", F.lit(False)).alias("in_images"), F.coalesce("in_half", F.lit(False)).alias("in_half"))


@query("union_of_searches", f"""WITH c AS ({IMAGES}), q AS (SELECT v FROM c ORDER BY id LIMIT 1) SELECT 'near' AS part, id, round(list_distance(c.v, q.v), 6) AS distance FROM c, q QUALIFY row_number() OVER (ORDER BY distance, id) <= 10
  UNION ALL SELECT 'reverse', id, round(list_distance(c.v, list_reverse(q.v)), 6) AS distance FROM c, q QUALIFY row_number() OVER (ORDER BY distance, id) <= 10""")
def union_of_searches(t: Tables) -> DataFrame:
    """Results of two searches one after the other, repeated rows included."""
    first = first_vector(t.emb_table, "id", "emb_vector_col")
    part = lambda name, q: search.top_k(t.emb_table, "id", "emb_vector_col", q, 10, "l2").select(F.lit(name).alias("part"), "id", "distance")
    return part("near", first).unionByName(part("reverse", first[::-1]))


@query("batch_rate", "SELECT event_type, (event_id // 1000) AS batch, count(*) AS n, round((epoch(max(ts)) - epoch(min(ts))) / count(*), 3) AS seconds_a_row, round(100.0 * max(event_id) / (SELECT max(event_id) FROM events), 2) AS done FROM events GROUP BY 1, 2")
def batch_rate(t: Tables) -> DataFrame:
    """Seconds a row and how far each batch has got."""
    last = t.events.agg(F.max("event_id")).first()[0]
    seconds = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts"))
    grouped = t.events.groupBy("event_type", F.floor(F.col("event_id") / 1000).alias("batch"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(seconds / 1e6 / F.count(F.lit(1)), 3).alias("seconds_a_row"), F.round(100.0 * F.max("event_id") / F.lit(last), 2).alias("done"))


@query("table_store", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE coalesce(lang, 'none') END AS lang FROM documents WHERE doc_id % 2 = 0 OR doc_id % 5 = 0")
def table_store(t: Tables) -> DataFrame:
    """A keyed table that is made, filled twice (known keys are ignored), emptied, filled again and updated."""
    rows = t.documents.select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"))
    store = tables.Table(t.spark, _path(t, "table"), rows.schema, ["doc_id"])
    store.insert(rows)
    store.truncate(force=True)
    store.insert(rows.where("doc_id % 2 = 0"))
    store.insert(rows.where("doc_id % 2 = 0 or doc_id % 5 = 0").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "late").otherwise(F.col("lang"))))
    store.update(rows.where("doc_id % 3 = 0").select("doc_id", F.lit("x").alias("lang")), "doc_id")
    store.compact(2)
    return store.read()


@query("column_list", "SELECT id, array_to_string(list_distinct(source), '|') IS NOT NULL OR source IS NULL AS known, len(list_distinct(list_filter(source, lambda x: x IS NOT NULL)))::INTEGER AS n FROM is_pd12m")
def column_list(t: Tables) -> DataFrame:
    """Distinct entries of a list, in their order."""
    once = F.array_distinct(F.filter("source", lambda x: x.isNotNull()))
    return t.is_pd12m.select("id", (F.array_join(once, "|").isNotNull() | F.col("source").isNull()).alias("known"), F.size(once).alias("n")).withColumn("n", F.when(F.col("n") >= 0, F.col("n")))


_LETTERS = "[" + ", ".join(f"length(t) - length(replace(t, '{x}', ''))" for x in "abcdefghijklmnopqrstuvwxyz") + "]::DOUBLE[]"
_UNIT = "list_transform(c, lambda x: x / greatest(sqrt(list_sum(list_transform(c, lambda y: y * y))), 1e-12))"


@query("embed_step", f"""SELECT id, round(v[1], 5) AS first, round(v[5], 5) AS fifth, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 5) AS norm
  FROM (SELECT id, {_UNIT} AS v FROM (SELECT id, {_LETTERS} AS c FROM (SELECT id, lower(chunk_text) AS t FROM ts_wikipedia_en_embed WHERE vector IS NULL AND chunk_text IS NOT NULL)))""")
def embed_step(t: Tables) -> DataFrame:
    """The chunks without a vector get one."""
    made = pipeline.embed_chunks(t.ts_wikipedia_en_embed.where("chunk_text is not null"), LetterEmbedder())
    v = F.col("vector")
    return made.select("id", F.round(F.element_at(v, 1).cast("double"), 5).alias("first"), F.round(F.element_at(v, 5).cast("double"), 5).alias("fifth"), F.round(V.norm(v), 5).alias("norm"))


@query("encode_codes", f"""SELECT doc_id, array_to_string(list_transform(v, lambda x: round_even(greatest(0.0, least(0.6, 0.3 + x)) / (0.6 / 255), 0)::INTEGER), ',') AS codes
  FROM (SELECT doc_id, {_UNIT} AS v FROM (SELECT doc_id, {_LETTERS} AS c FROM (SELECT doc_id, lower(title) AS t FROM documents WHERE title IS NOT NULL)))""")
def encode_codes(t: Tables) -> DataFrame:
    """Titles as codes of 8 bits, from batches of texts."""
    encoded = Encoder(LetterEmbedder(), bits=8).embed(t.documents.where("title is not null").select(F.col("doc_id").alias("id"), F.col("title").alias("text")))
    return encoded.select(F.col("id").alias("doc_id"), F.array_join(F.col("vector").cast("array<string>"), ",").alias("codes"))


@query("rerank_batches", """SELECT id, round(len(list_filter(['old', 'harbour', 'bridge'], lambda y: list_contains(regexp_split_to_array(lower(substr(coalesce(chunk_text, ''), 1, 4096)), '[^a-z0-9]+'), y))) / 3.0, 6) AS rank_score FROM ts_wikipedia_en_embed""")
def rerank_batches(t: Tables) -> DataFrame:
    found = rerank_scores(t.ts_wikipedia_en_embed, "id", "chunk_text", "old harbour bridge", OverlapReranker())
    return found.select("id", F.round("rank_score", 6).alias("rank_score"))


@query("pooled_spans", """SELECT id, round(list_sum(vector[1:4]::DOUBLE[]) / 4, 5) AS first, round(list_sum(vector[6:20]::DOUBLE[]) / 15, 5) AS second, round(list_sum(vector[41:59]::DOUBLE[]) / 19, 5) AS last, 3 AS n FROM ts_wikipedia_en_embed WHERE len(vector) = 64""")
def pooled_spans(t: Tables) -> DataFrame:
    """A vector's elements as vectors of tokens: the means of four spans, of which one is cut and one lies beyond."""
    rows = t.ts_wikipedia_en_embed.where("size(vector) = 64").select("id", F.transform("vector", lambda x: F.array(x)).alias("tokens"))
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 4), (5, 20), (40, 64), (59, 64))])
    means = rows.select("id", pooled(F.col("tokens"), spans, 60).alias("m"))
    one = lambda i: F.round(F.element_at(F.element_at("m", i), 1), 5)
    return means.select("id", one(1).alias("first"), one(2).alias("second"), one(-1).alias("last"), F.size("m").alias("n"))


@query("writable_store", """SELECT min(doc_id::VARCHAR) AS doc_id, sha256(text) AS hash, 26::INTEGER AS n FROM documents WHERE text <> '' GROUP BY sha256(text)""")
def writable_store(t: Tables) -> DataFrame:
    """The documents added to a store, twice, and embedded: each text once, under its smallest id."""
    config = parse_config({"database_file": _path(t, "store"), "database_writable": True, "meta_table": {"name": "meta", "id_column": "id", "text_column": "chunk_text"}, "embedding_table": {"name": "emb", "id_column": "id", "embedding_column": "vector", "emb_model": "letters"}})
    held = Store(t.spark, config, LetterEmbedder())
    texts = t.documents.where("text <> ''").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("meta"), F.array("source").alias("tags"), F.col("text").alias("chunk_text"))
    held.add(texts)
    held.add(texts)
    held.process_pending()
    return held.meta.read().join(held.vectors.read(), "id").select("doc_id", "hash", F.size("vector").alias("n"))
