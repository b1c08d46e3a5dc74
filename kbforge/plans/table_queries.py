"""Ingest, curation, reports, worker bookkeeping and export over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.functions import scalars, texts
from kbforge.operators import dedup, export, tables
from kbforge.plans.registry import Tables, query
from kbforge.sources import readers
from kbforge.staging import shared_dir
from kbforge.streaming import pending as incremental


@query("pending_left_anti", "SELECT d.doc_id, d.source FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id WHERE e.vec_id IS NULL")
def pending_left_anti(t: Tables) -> DataFrame:
    return incremental.pending(t.documents, t.embeddings.withColumnRenamed("vec_id", "doc_id"), "doc_id").select("doc_id", "source")


@query("pending_not_exists", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM ts_wikipedia_en_embed c WHERE c.source_id = d.doc_id) AND trim(coalesce(d.text, '')) <> ''")
def pending_not_exists(t: Tables) -> DataFrame:
    docs, chunks = t.documents, t.ts_wikipedia_en_embed
    return t.spark.sql("SELECT d.doc_id FROM {d} d WHERE NOT EXISTS (SELECT 1 FROM {c} c WHERE c.source_id = d.doc_id) AND trim(coalesce(d.text, '')) <> ''", d=docs, c=chunks)


@query("existing_semi", "SELECT id FROM is_pd12m WHERE id IN (SELECT id FROM emb_table)")
def existing_semi(t: Tables) -> DataFrame:
    return t.is_pd12m.join(t.emb_table.select("id"), "id", "left_semi").select("id")


@query("upsert_ignore", """SELECT id, source_id, chunk_index FROM (SELECT id, source_id, chunk_index, row_number() OVER (PARTITION BY source_id, chunk_index ORDER BY id) AS r FROM ts_wikipedia_en_embed WHERE vector IS NULL) n
  WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM ts_wikipedia_en_embed o WHERE o.vector IS NOT NULL AND o.source_id = n.source_id AND o.chunk_index = n.chunk_index)""")
def upsert_ignore(t: Tables) -> DataFrame:
    chunks = t.ts_wikipedia_en_embed.select("id", "source_id", "chunk_index", F.col("vector").isNull().alias("new"))
    return tables.insert_ignore(chunks.where("not new"), chunks.where("new"), ["source_id", "chunk_index"], ["id"]).select("id", "source_id", "chunk_index")


@query("update_coalesce", "SELECT i.id, CASE WHEN e.id IS NOT NULL THEN 'embedded' ELSE i.license END AS license, i.origin_source FROM is_pd12m i LEFT JOIN (SELECT DISTINCT id FROM emb_table WHERE emb_vector_col IS NOT NULL) e ON i.id = e.id")
def update_coalesce(t: Tables) -> DataFrame:
    changes = t.emb_table.select("id", F.when(F.col("emb_vector_col").isNotNull(), "embedded").alias("license"))
    return tables.update_by_id(t.is_pd12m.select("id", "license", "origin_source"), changes)


@query("hash_dedup_add", "SELECT sha256(text) AS hash, min(doc_id) AS doc_id FROM documents WHERE text <> '' GROUP BY 1")
def hash_dedup_add(t: Tables) -> DataFrame:
    hashed = t.documents.where("text <> ''").select(F.sha2("text", 256).alias("hash"), "doc_id")
    return tables.insert_ignore(hashed.limit(0), hashed, ["hash"], ["doc_id"])


@query("ignored_documents", "SELECT doc_id, trim(coalesce(text, '')) = '' AS ignored FROM documents")
def ignored_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", (F.trim(F.coalesce("text", F.lit(""))) == "").alias("ignored"))


@query("mod_partition", "SELECT p AS part, count(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, doc_id % 4 AS p FROM documents) GROUP BY p")
def mod_partition(t: Tables) -> DataFrame:
    parts = [incremental.work_part(t.documents, "doc_id", 4, k).withColumn("part", F.lit(k).cast("long")) for k in range(4)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


@query("keyset_page", "SELECT id, url FROM is_pd12m WHERE id > (SELECT min(id) + 100 FROM is_pd12m) ORDER BY id LIMIT 100")
def keyset_page(t: Tables) -> DataFrame:
    last = t.is_pd12m.agg(F.min("id") + 100).first()[0]
    return t.is_pd12m.where(F.col("id") > F.lit(last)).orderBy("id").limit(100).select("id", "url")


@query("offset_page", "SELECT id, url FROM is_pd12m ORDER BY id LIMIT 50 OFFSET 100")
def offset_page(t: Tables) -> DataFrame:
    return t.is_pd12m.orderBy("id").offset(100).limit(50).select("id", "url")


@query("queue_predicate", """SELECT 'unfetched' AS queue, count(*) AS n FROM is_pd12m WHERE origin_storage_id IS NULL OR origin_storage_id = '' UNION ALL
  SELECT 'unprocessed', count(*) FROM is_pd12m i LEFT JOIN emb_table e ON i.id = e.id WHERE origin_storage_id <> '' AND (processed_storage_id = '' OR e.emb_vector_col IS NULL) UNION ALL
  SELECT 'unembedded', count(*) FROM ts_wikipedia_en_embed WHERE vector IS NULL UNION ALL SELECT 'unvalidated', count(*) FROM ts_arxiv WHERE NOT validated UNION ALL SELECT 'uncaptioned', count(*) FROM is_pd12m WHERE caption_long = ''""")
def queue_predicate(t: Tables) -> DataFrame:
    images = t.is_pd12m.join(t.emb_table.select(F.col("id"), F.col("emb_vector_col").isNotNull().alias("has")), "id", "left")
    counted = images.agg(
        F.count_if(F.col("origin_storage_id").isNull() | (F.col("origin_storage_id") == "")).alias("unfetched"),
        F.count_if((F.col("origin_storage_id") != "") & ((F.col("processed_storage_id") == "") | ~F.coalesce("has", F.lit(False)))).alias("unprocessed"),
        F.count_if(F.col("caption_long") == "").alias("uncaptioned"),
    ).unpivot([], ["unfetched", "unprocessed", "uncaptioned"], "queue", "n")
    chunks = t.ts_wikipedia_en_embed.agg(F.count_if(F.col("vector").isNull()).alias("n")).select(F.lit("unembedded").alias("queue"), "n")
    papers = t.ts_arxiv.agg(F.count_if(~F.col("validated")).alias("n")).select(F.lit("unvalidated").alias("queue"), "n")
    return counted.unionByName(chunks).unionByName(papers)


def _near(t: Tables) -> DataFrame:
    """The rows of image_match with a similarity of at least 0.999, percentages read as fractions."""
    return t.image_match.withColumn("similarity", scalars.as_fraction(F.col("similarity"))).where(F.col("similarity").between(0.999, 1.0))


_FRACTION = "CASE WHEN isnan(similarity) THEN NULL WHEN similarity > 1 THEN round(similarity / 100, 12) ELSE similarity END"
_LINKED = f"(SELECT id, similar_to, {_FRACTION} AS similarity FROM image_match WHERE {_FRACTION} BETWEEN 0.999 AND 1)"
_MATCHED = f"(SELECT id, max(similar_to) AS similar_to FROM {_LINKED} GROUP BY id)"


@query("dataset_report", f"""WITH r AS (SELECT i.*, coalesce(m.similar_to, 0) AS similar_to FROM is_pd12m i LEFT JOIN {_MATCHED} m ON i.id = m.id),
  c AS (SELECT count(*) AS fetched, count_if(processed_storage_id <> '') AS valid, count_if(processed_storage_id <> '' AND regexp_full_match(processed_storage_id, '.*processed\\.jpg')) AS reprocessed,
    count_if(processed_storage_id <> '' AND similar_to = 0) AS "unique", count_if(processed_storage_id <> '' AND similar_to <> 0) AS duplicated FROM r)
  SELECT fetched::BIGINT AS fetched, valid::BIGINT AS valid, reprocessed::BIGINT AS reprocessed, "unique"::BIGINT AS "unique", duplicated::BIGINT AS duplicated, round(valid / fetched * 100, 2) || '%' AS valid_ratio,
    round(reprocessed / valid * 100, 2) || '%' AS reprocessed_ratio, round("unique" / valid * 100, 2) || '%' AS unique_ratio, round(duplicated / valid * 100, 2) || '%' AS duplicated_ratio, round("unique" / fetched * 100, 2) || '%' AS overall_availability FROM c""")
def dataset_report(t: Tables) -> DataFrame:
    matched = _near(t).groupBy("id").agg(F.max("similar_to").alias("similar_to"))
    images = t.is_pd12m.join(matched, "id", "left").withColumn("similar_to", F.coalesce("similar_to", F.lit(0)))
    done = F.col("processed_storage_id") != ""
    return tables.dataset_report(images, done, F.col("processed_storage_id").rlike(r"^.*processed\.jpg$"), F.col("similar_to") == 0, F.col("similar_to") != 0)


@query("max_resume", "SELECT max(id) AS last_id, greatest(max(similar_to) - 1, 0) AS resume_from FROM image_match")
def max_resume(t: Tables) -> DataFrame:
    return t.image_match.agg(F.max("id").alias("last_id"), F.greatest(F.max("similar_to") - 1, F.lit(0)).alias("resume_from"))


@query("similar_to_regex", "SELECT id, regexp_full_match(processed_storage_id, '.*processed\\.jpg') AS reprocessed FROM is_pd12m")
def similar_to_regex(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", F.col("processed_storage_id").rlike(r"^.*processed\.jpg$").alias("reprocessed"))


def _beats_sql(ttl: int) -> str:
    return f"""SELECT workflow, worker, last_beat, (row_number() OVER (PARTITION BY workflow ORDER BY worker) - 1)::BIGINT AS ord, count(*) OVER (PARTITION BY workflow) AS n_workers
      FROM (SELECT event_type AS workflow, user_id AS worker, max(ts) AS last_beat FROM events GROUP BY 1, 2) WHERE last_beat >= (SELECT max(ts) FROM events) - INTERVAL {ttl} SECOND"""


def _beats(t: Tables, ttl: int) -> DataFrame:
    now = t.events.agg(F.max("ts")).first()[0]
    beats = t.events.select(F.col("user_id").alias("worker"), F.col("event_type").alias("workflow"), "ts")
    return tables.live_workers(beats, F.lit(now), ttl)


@query("worker_order", _beats_sql(86_400))
def worker_order(t: Tables) -> DataFrame:
    return _beats(t, 86_400)


@query("worker_live_ttl", f"SELECT workflow, max(n_workers) AS n_workers FROM ({_beats_sql(3600)}) GROUP BY workflow")
def worker_live_ttl(t: Tables) -> DataFrame:
    return _beats(t, 3600).groupBy("workflow").agg(F.max("n_workers").alias("n_workers"))


@query("latency_summary", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean FROM events GROUP BY event_type")
def latency_summary(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


@query("json_props_extract", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_props_extract(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("passage_unnest", """SELECT query_id, query_type, (row_number() OVER (PARTITION BY query_id, query_type ORDER BY item_id, passage_id, passage_text NULLS FIRST) - 1)::BIGINT AS passage_id, passage_text, is_selected, url,
  array_to_string(list_transform(first_value(answers) OVER (PARTITION BY query_id, query_type ORDER BY item_id, query NULLS FIRST, answers NULLS FIRST), lambda a: trim(a)), '|') AS answers FROM ts_ms_marco WHERE query_id IS NOT NULL""")
def passage_unnest(t: Tables) -> DataFrame:
    """The flat passages are nested by query first, as the deliveries are, and then unnested."""
    row = F.struct("item_id", "passage_id", "passage_text", "is_selected", "url")
    first = F.min(F.struct("item_id", "query", "answers", F.col("well_formed_answers").alias("wellFormedAnswers"))).alias("first")  # deliveries may differ
    nested = t.ts_ms_marco.where("query_id is not null").groupBy("query_id", "query_type").agg(first, F.array_sort(F.collect_list(row)).alias("p"))
    items = nested.select("query_id", "query_type", "first.*", "p").withColumn("passages", F.struct(F.col("p.passage_text").alias("passage_text"), F.col("p.is_selected").alias("is_selected"), F.col("p.url").alias("url")))
    flat = readers.passages(items)
    return flat.select("query_id", "query_type", "passage_id", "passage_text", "is_selected", "url", F.array_join("answers", "|").alias("answers"))


def _absorb(t: Tables) -> tuple[DataFrame, DataFrame]:
    """is_pd12m absorbed into ii_alpha by the links of image_match, to targets and between the source's own rows."""
    near = _near(t)
    links = near.where(F.col("similar_to").between(1, 40)).select("id", F.col("similar_to").alias("target_id"), "similarity")
    pairs = near.where("id <> similar_to").select(F.col("id").alias("a"), F.col("similar_to").alias("b"), "similarity")
    return dedup.absorb(t.is_pd12m, t.ii_alpha, links, pairs, "pd12m")


#: Where the source rows go, one by one in order of their ids: a row linked to a target goes there; another one leads if
#: no leader before it is linked to it. ``placed``: the most similar target or earlier leader of each row that goes
#: somewhere. ``walk`` takes one row of the graph at a time and carries the leaders so far in a list.
_PLACED = f"""links AS (SELECT id, similar_to AS target_id, max(similarity) AS similarity FROM {_LINKED} WHERE similar_to BETWEEN 1 AND 40 AND id IN (SELECT id FROM is_pd12m) AND similar_to IN (SELECT id FROM ii_alpha) GROUP BY ALL),
  edges AS (SELECT least(id, similar_to) AS a, greatest(id, similar_to) AS b, max(similarity) AS similarity FROM {_LINKED} WHERE id <> similar_to AND id IN (SELECT id FROM is_pd12m) AND similar_to IN (SELECT id FROM is_pd12m) GROUP BY ALL),
  free AS (SELECT * FROM edges WHERE a NOT IN (SELECT id FROM links) AND b NOT IN (SELECT id FROM links)),
  nodes AS (SELECT id, coalesce(list(a) FILTER (a IS NOT NULL), []) AS before, row_number() OVER (ORDER BY id) AS n FROM (SELECT b AS id, a FROM free UNION ALL SELECT a, NULL FROM free) GROUP BY id),
  walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS leaders UNION ALL SELECT nodes.n, CASE WHEN list_has_any(before, leaders) THEN leaders ELSE list_append(leaders, id) END FROM walk JOIN nodes ON nodes.n = walk.n + 1),
  followers AS (SELECT id FROM nodes WHERE NOT list_contains((SELECT leaders FROM walk ORDER BY n DESC LIMIT 1), id)),
  every AS (SELECT id, target_id AS target, false AS fresh, similarity FROM links UNION ALL
    SELECT b, a, true, similarity FROM edges WHERE a NOT IN (SELECT id FROM links) AND a NOT IN (SELECT id FROM followers)),
  placed AS (SELECT id, arg_max(target, (similarity, NOT fresh, -target)) AS target, arg_max(fresh, (similarity, NOT fresh, -target)) AS fresh FROM every GROUP BY id)"""


@query("absorb_merge", f"""WITH RECURSIVE {_PLACED},
  s AS (SELECT i.*, p.target, coalesce(origin_width * origin_height, 0) AS area FROM is_pd12m i JOIN placed p ON i.id = p.id AND NOT p.fresh),
  g AS (SELECT target, arg_max(struct_pack(url, origin_width, area), (area, -id)) AS picture, min(created_at) AS created_at, max(updated_at) AS updated_at, coalesce(first(caption ORDER BY id) FILTER (caption <> ''), first(caption ORDER BY id DESC)) AS caption FROM s GROUP BY target)
  SELECT t.id, CASE WHEN coalesce(t.origin_width * t.origin_height, 0) < picture.area THEN picture.url ELSE t.url END AS url,
    CASE WHEN coalesce(t.origin_width * t.origin_height, 0) < picture.area THEN picture.origin_width ELSE t.origin_width END AS origin_width,
    CASE WHEN g.target IS NOT NULL AND coalesce(t.caption, '') = '' THEN g.caption ELSE t.caption END AS caption,
    array_to_string(CASE WHEN g.target IS NULL THEN t.source ELSE list_sort(list_distinct(list_concat(t.source, ['pd12m']))) END, '|') AS source,
    CASE WHEN g.target IS NULL THEN t.updated_at ELSE greatest(t.updated_at, g.updated_at) END AS updated_at FROM ii_alpha t LEFT JOIN g ON g.target = t.id""")
def absorb_merge(t: Tables) -> DataFrame:
    updated, _ = _absorb(t)
    return updated.select("id", "url", "origin_width", "caption", F.array_join("source", "|").alias("source"), "updated_at")


@query("absorb_insert", f"""WITH RECURSIVE {_PLACED},
  s AS (SELECT i.url, i.id, p.target, coalesce(origin_width * origin_height, 0) AS area FROM is_pd12m i JOIN placed p ON i.id = p.id AND p.fresh),
  g AS (SELECT target, arg_max(struct_pack(url, area), (area, -id)) AS picture FROM s GROUP BY target)
  SELECT i.id, CASE WHEN coalesce(i.origin_width * i.origin_height, 0) < picture.area THEN picture.url ELSE i.url END AS url FROM is_pd12m i LEFT JOIN g ON g.target = i.id WHERE i.id NOT IN (SELECT id FROM placed)""")
def absorb_insert(t: Tables) -> DataFrame:
    return _absorb(t)[1].select("id", "url")


@query("map_merge_last_wins", """SELECT id, 'license=' || coalesce(license, '') || '|origin=' || coalesce(caption, '') || '|store=' || coalesce(origin_source, '') AS merged FROM is_pd12m""")
def map_merge_last_wins(t: Tables) -> DataFrame:
    text = lambda c: F.coalesce(c, F.lit(""))
    left = F.create_map(F.lit("license"), text(F.col("license")), F.lit("origin"), text(F.col("origin_source")))
    right = F.create_map(F.lit("origin"), text(F.col("caption")), F.lit("store"), text(F.col("origin_source")))
    entries = F.array_sort(F.map_entries(dedup.map_union(left, right)))
    return t.is_pd12m.select("id", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("merged"))


@query("dump_columns", "SELECT id, title, url, snapshot, source_id, chunk_index, chunk_text FROM ts_wikipedia_en_embed")
def dump_columns(t: Tables) -> DataFrame:
    """The dump written as CSV and read back, without its vector and time columns."""
    path = f"{shared_dir(t.spark)}/kbforge/dump-{uuid.uuid4().hex}"
    kept = t.ts_wikipedia_en_embed.drop("created_at", "updated_at")
    export.dump(kept, path)
    schema = "id long, title string, url string, snapshot string, source_id long, chunk_index long, chunk_text string"
    return readers.csv_table(t.spark, path, schema)


SHARD_BYTES = 100_000
_CSV = "(CASE WHEN regexp_matches({c}, '[,\"\\r\\n]') THEN strlen({c}) + 2 + strlen({c}) - strlen(replace({c}, '\"', '')) ELSE strlen({c}) END)"
_LINE = " + ".join(_CSV.format(c=c) for c in ("doc_id::VARCHAR", "coalesce(title, '')", "coalesce(text, '')")) + " + 4"


_FIELD = "CASE WHEN regexp_matches({c}, '[,\"\\r\\n]') THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE {c} END"
_FIELDS = " || ',' || ".join(_FIELD.format(c=c) for c in ("doc_id::VARCHAR", "coalesce(title, '')", "coalesce(text, '')"))
_SHARDS = f"""RECURSIVE l AS (SELECT doc_id, line, strlen(line) AS bytes, row_number() OVER (ORDER BY doc_id) AS n FROM (SELECT doc_id, {_FIELDS} || chr(13) || chr(10) AS line FROM documents)),
  walk AS (SELECT 0::BIGINT AS n, 0::BIGINT AS shard, 19::BIGINT AS held UNION ALL SELECT l.n, CASE WHEN held + bytes > {SHARD_BYTES} AND held > 19 THEN shard + 1 ELSE shard END, CASE WHEN held + bytes > {SHARD_BYTES} AND held > 19 THEN 19 + bytes ELSE held + bytes END
    FROM walk JOIN l ON l.n = walk.n + 1)"""


@query("pack_shards", f"WITH {_SHARDS} SELECT doc_id, bytes, shard FROM l JOIN walk USING (n)")
def pack_shards(t: Tables) -> DataFrame:
    return export.pack_shards(t.documents, "doc_id", ["doc_id", "title", "text"], SHARD_BYTES).select("doc_id", "bytes", "shard")


@query("shard_manifest", f"""WITH {_SHARDS} SELECT shard, printf('%08d', shard) || '.tar.gz' AS filename, printf('%08d', shard) || '.csv' AS inside, count(*) AS num_rows, (sum(bytes) + 19)::BIGINT AS bytes, md5('doc_id,title,text' || chr(13) || chr(10) || string_agg(line, '' ORDER BY doc_id)) AS md5,
  'doc_id,title,text' AS header, md5(arg_min(line[:-3], doc_id)) AS first_row, md5(arg_max(line[:-3], doc_id)) AS last_row, min(doc_id) AS first_key, max(doc_id) AS last_key FROM l JOIN walk USING (n) GROUP BY shard""")
def shard_manifest(t: Tables) -> DataFrame:
    columns = ["doc_id", "title", "text"]
    found = export.manifest(export.pack_shards(t.documents, "doc_id", columns, SHARD_BYTES), "doc_id", columns)
    return found.withColumns({"first_row": F.md5("first_row"), "last_row": F.md5("last_row")})


@query("cumulative_shards", f"SELECT doc_id, floor((sum({_LINE}) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - ({_LINE})) / {SHARD_BYTES})::BIGINT AS shard FROM documents")
def cumulative_shards(t: Tables) -> DataFrame:
    line = F.octet_length(export.csv_line(F.col("doc_id"), F.col("title"), F.col("text")))
    return export.cumulative_shards(t.documents, line, ["source"], ["doc_id"], SHARD_BYTES).select("doc_id", "shard")


@query("srt_offset_shift", """WITH c AS (SELECT source_id AS video, chunk_index AS segment, min(length(chunk_text)) AS n FROM ts_wikipedia_en_embed GROUP BY 1, 2),
  s AS (SELECT video, segment, n, coalesce(sum(n * 10) OVER (PARTITION BY video ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM c)
  SELECT video, segment, (n + o)::BIGINT AS start_ms, (n * 2 + o)::BIGINT AS end_ms FROM s WHERE n <= 1500""")
def srt_offset_shift(t: Tables) -> DataFrame:
    """Segments last ten milliseconds a character; each has one cue that starts after a tenth of it."""
    n = t.ts_wikipedia_en_embed.groupBy(F.col("source_id").alias("video"), F.col("chunk_index").alias("segment")).agg(F.min(F.length("chunk_text")).cast("long").alias("n"))
    cues = n.select("video", "segment", F.col("n").alias("start_ms"), (F.col("n") * 2).alias("end_ms"), F.lit("cue").alias("text"))
    return export.shift_segments(cues, n.select("video", "segment", (F.col("n") * 10).alias("duration_ms")), 1500).drop("text")


@query("subtitle_files", """WITH c AS (SELECT event_type, printf('00:%02d:%02d,%03d', (event_id // 60) % 60, event_id % 60, event_id % 1000) AS s, printf('00:%02d:%02d,%03d', (event_id // 60) % 60, event_id % 60, (event_id + 7) % 1000) AS e, props AS x FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY s, e, x) AS i FROM c) SELECT event_type, md5(string_agg(i || chr(10) || s || ' --> ' || e || chr(10) || x || chr(10) || chr(10), '' ORDER BY i)) AS srt_md5 FROM n GROUP BY event_type""")
def subtitle_files(t: Tables) -> DataFrame:
    stamp = lambda ms: F.format_string("00:%02d:%02d,%03d", F.floor(F.col("event_id") / 60) % 60, F.col("event_id") % 60, ms % 1000)
    cues = t.events.select("event_type", stamp(F.col("event_id")).alias("start"), stamp(F.col("event_id") + 7).alias("end"), F.col("props").alias("text"))
    return export.subtitles(cues, "event_type").select("event_type", F.md5("srt").alias("srt_md5"))


@query("incremental_available_now", "SELECT doc_id, sha256(text) AS hash FROM documents WHERE trim(text) <> ''")
def incremental_available_now(t: Tables) -> DataFrame:
    """The documents brought through a stream into a keyed table, twice; the second run adds nothing."""
    root = f"{shared_dir(t.spark)}/kbforge/stream-{uuid.uuid4().hex}"
    schema = t.documents.select("doc_id", "text").schema
    out = t.documents.where("false").select("doc_id", F.sha2("text", 256).alias("hash")).schema
    sink = tables.Table(t.spark, f"{root}/table", out, ["doc_id"])
    work = lambda df: df.where("trim(text) <> ''").select("doc_id", F.sha2("text", 256).alias("hash"))
    for _ in range(2):
        incremental.incremental(t.spark, f"{t.folder}/documents.parquet", schema, work, sink, f"{root}/checkpoint")
    return sink.read()


@query("next_ids", "SELECT doc_id, (SELECT max(id) FROM ts_wikipedia_en_embed) + row_number() OVER (ORDER BY doc_id) AS new_id FROM documents")
def next_ids(t: Tables) -> DataFrame:
    start = t.ts_wikipedia_en_embed.select(F.col("id").alias("new_id"))
    return tables.next_ids(start, t.documents.select("doc_id"), "new_id", ["doc_id"])


@query("identity_of", "SELECT id, coalesce(nullif(processed_storage_id, ''), nullif(origin_storage_id, ''), nullif(url, ''), id::VARCHAR) AS identity FROM is_pd12m")
def identity_of(t: Tables) -> DataFrame:
    c = F.col
    return t.is_pd12m.select("id", scalars.identity(c("processed_storage_id"), c("origin_storage_id"), c("url"), c("id")).alias("identity"))


@query("author_split", r"""SELECT id, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(authors, ''), ',| and '), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), '|') AS authors FROM ts_arxiv""")
def author_split(t: Tables) -> DataFrame:
    return t.ts_arxiv.select("id", F.array_join(texts.author_list(F.col("authors")), "|").alias("authors"))
