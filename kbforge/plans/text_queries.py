"""Text and scalar functions over the driver tables. Where the tables hold no such values (addresses of videos, wiki
links, subtitle times), they are made from columns, the same way in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.functions import scalars, texts
from kbforge.plans.registry import Tables, query

BASE, COMMONS, FILES = "https://wiki.example/wiki/", "https://commons.example/wiki/", "https://files.example/"


@query("storage_key", """SELECT id, 'images/' || coalesce(nullif(hash, ''), sha256(url)) || '.jpg' AS key, 's3://store/images/' || coalesce(nullif(hash, ''), sha256(url)) || '.jpg' AS address,
  regexp_replace(origin_storage_id, '^s3://[^/]+/', '') AS object_key, 'shards/' || substr(hash, 1, 5) || '/' || hash || '.jpg' AS shard FROM is_pd12m""")
def storage_key(t: Tables) -> DataFrame:
    key = scalars.storage_key(F.col("hash"), F.col("url"), "images")
    return t.is_pd12m.select("id", key.alias("key"), scalars.object_address(key, "store").alias("address"), scalars.object_key(F.col("origin_storage_id")).alias("object_key"), scalars.shard_key(F.col("hash"), "shards").alias("shard"))


@query("md5_image_path", f"""SELECT id, CASE WHEN starts_with(caption, 'http://') OR starts_with(caption, 'https://') THEN caption ELSE '{FILES}' || substr(md5(replace(caption, ' ', '_')), 1, 1) || '/' || substr(md5(replace(caption, ' ', '_')), 1, 2) || '/' || replace(caption, ' ', '_') END AS path FROM is_pd12m""")
def md5_image_path(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", texts.image_path(F.col("caption"), FILES).alias("path"))


_LINKS = ["", "c:", "commons:", "Commons:Talk:", "File:", "TimedText:", "Category:", "Talk:"]


@query("wikilink_resolve", f"""WITH l AS (SELECT doc_id, p || title AS link FROM documents, (SELECT unnest({_LINKS}) AS p)), s AS (SELECT *, lower(split_part(link, ':', 1)) AS ns, substr(link, strpos(link, ':') + 1) AS rest, contains(link, ':') AS named FROM l)
  SELECT doc_id, link, CASE WHEN starts_with(link, 'c:') THEN '{COMMONS}' || replace(substr(link, 3), ' ', '_') WHEN named AND ns = 'commons' AND contains(rest, ':') THEN '{COMMONS}' || replace(rest, ' ', '_')
    WHEN named AND ns = 'commons' THEN '{COMMONS}' || replace(link, ' ', '_') WHEN named AND ns IN ('file', 'image', 'media', 'timedtext') THEN '{COMMONS}File:' || replace(rest, ' ', '_')
    WHEN named AND ns = 'category' THEN '{BASE}Category:' || replace(rest, ' ', '_') ELSE '{BASE}' || replace(link, ' ', '_') END AS target FROM s""")
def wikilink_resolve(t: Tables) -> DataFrame:
    links = t.documents.select("doc_id", F.explode(F.array(*[F.concat(F.lit(p), "title") for p in _LINKS])).alias("link"))
    return links.select("doc_id", "link", texts.link_target(F.col("link"), BASE, COMMONS).alias("target"))


@query("inline_html_style", r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<em>(.*?)</em>', '*\1*', 'g'), '<strong>(.*?)</strong>', '**\1**', 'g'),
  '<strike>(.*?)</strike>', '~~\1~~', 'g'), '<code>(.*?)</code>', '`\1`', 'g')) AS styled FROM documents""")
def inline_html_style(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(texts.inline_style(F.col("text"))).alias("styled"))


@query("anchor_to_markdown", r"""SELECT doc_id, md5(regexp_replace('See <a class="x" href="' || url || '">' || coalesce(title, 'page') || '</a>. ' || coalesce(text, ''), '<a[^>]*href=["'']([^"'']+)["''][^>]*>(.+?)</a>', '[\2](\1 "\2")', 'g')) AS linked FROM documents""")
def anchor_to_markdown(t: Tables) -> DataFrame:
    html = F.concat(F.lit('See <a class="x" href="'), "url", F.lit('">'), F.coalesce("title", F.lit("page")), F.lit("</a>. "), F.coalesce("text", F.lit("")))
    return t.documents.select("doc_id", F.md5(texts.anchors_to_markdown(html)).alias("linked"))


@query("largest_og_image", """WITH s AS (SELECT id, url, origin_width AS w, origin_height AS h, url || '?small' AS u2 FROM is_pd12m WHERE url IS NOT NULL)
  SELECT id, CASE WHEN w IS NOT NULL AND h IS NOT NULL AND w BETWEEN 0 AND 999999999 AND h BETWEEN 0 AND 999999999 AND (w * h, url) > (640 * 480, u2) THEN url ELSE u2 END AS image,
    CASE WHEN w IS NOT NULL AND h IS NOT NULL AND w BETWEEN 0 AND 999999999 AND h BETWEEN 0 AND 999999999 AND (w * h, url) > (640 * 480, u2) THEN w ELSE 640 END AS width FROM s""")
def largest_og_image(t: Tables) -> DataFrame:
    """A page with the image in its own size, if it has one, and in a smaller one."""
    tag = lambda name, value: F.concat(F.lit(f'<meta property="og:image{name}" content="'), value.cast("string"), F.lit('">\n'))
    fits = F.col("origin_width").between(0, 999_999_999) & F.col("origin_height").between(0, 999_999_999)
    own = F.concat(tag("", F.col("url")), F.coalesce(F.when(fits, F.concat(tag(":width", F.col("origin_width")), tag(":height", F.col("origin_height")))), F.lit("")))
    small = F.concat(tag("", F.concat("url", F.lit("?small"))), tag(":width", F.lit(640)), tag(":height", F.lit(480)))
    best = texts.largest_image(F.concat(F.lit("<head>"), own, small))
    return t.is_pd12m.where("url is not null").select("id", best["url"].alias("image"), best["width"].alias("width"))


_SNIPPET = """CASE WHEN length(text) <= 250 THEN text WHEN pos = 0 THEN substr(text, 1, 247) || '...' ELSE
  (CASE WHEN ws > 0 THEN '...' ELSE '' END) || substr(text, ws + 1, we - ws) || (CASE WHEN we < length(text) THEN '...' ELSE '' END) END"""


@query("snippet_window", f"""WITH s AS (SELECT doc_id, text, strpos(lower(text), 'harbour') AS pos FROM documents WHERE text IS NOT NULL), w AS (SELECT *, greatest(0, pos - 1 - 70) AS ws, least(length(text), pos - 1 + 7 + 70) AS we FROM s)
  SELECT doc_id, {_SNIPPET} AS snippet FROM w""")
def snippet_window(t: Tables) -> DataFrame:
    return t.documents.where("text is not null").select("doc_id", texts.snippet(F.col("text"), F.lit("harbour")).alias("snippet"))


@query("title_truncate", """SELECT doc_id, CASE WHEN length(title) >= 50 THEN substr(title, 1, 47) || '...' ELSE title END AS title, CASE WHEN length(url) >= 50 THEN substr(url, 1, 47) || '...' ELSE url END AS url,
  '...' || substr(replace(text, chr(10), ' '), greatest((length(text) - 80) // 2, 0) + 1, 74) || '...' AS middle FROM documents""")
def title_truncate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", texts.shorten(F.col("title")).alias("title"), texts.shorten(F.col("url")).alias("url"), texts.middle(F.col("text")).alias("middle"))


_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower(caption), '[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("filename_sanitize", f"""SELECT id, CASE WHEN s IS NULL THEN NULL WHEN length(s) > 40 THEN regexp_replace(substr(s, 1, 20), '-+$', '') || '-' || regexp_replace(right(s, 19), '-+$', '') WHEN s = '' THEN 'file' ELSE s END AS slug FROM (SELECT id, {_SLUG} AS s FROM is_pd12m)""")
def filename_sanitize(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", texts.file_slug(F.col("caption")).alias("slug"))


@query("caption_extract", r"""WITH b AS (SELECT id, 'caption.long: "' || replace(coalesce(caption_long, ''), chr(10), ' ') || '"' || chr(10) || '  caption.short: ' || regexp_replace(coalesce(caption, ''), '\s+', ' ', 'g') AS block FROM is_pd12m)
  SELECT id, trim(regexp_replace(regexp_extract(block, '(?m)^.*caption\.long:[ \t]*(.*?)[ \t]*$', 1), '^"+|"+$', '', 'g')) AS long, trim(regexp_replace(regexp_extract(block, '(?m)^.*caption\.short:[ \t]*(.*?)[ \t]*$', 1), '^"+|"+$', '', 'g')) AS short FROM b""")
def caption_extract(t: Tables) -> DataFrame:
    block = F.concat(F.lit('caption.long: "'), F.replace(F.coalesce("caption_long", F.lit("")), F.lit("\n"), F.lit(" ")), F.lit('"\n  caption.short: '), F.regexp_replace(F.coalesce("caption", F.lit("")), r"\s+", " "))
    held = t.is_pd12m.select("id", block.alias("block"))
    return held.select("id", texts.caption_part(F.col("block"), "long").alias("long"), texts.caption_part(F.col("block"), "short").alias("short"))


@query("srt_timestamp_fix", """WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ':' WHEN 1 THEN '.' WHEN 2 THEN ',' ELSE ';' END AS sep, (event_id // 60) % 60 AS m, event_id % 60 AS s, event_id % 997 AS ms FROM events)
  SELECT event_id, CASE WHEN sep <> ';' THEN '00:' || lpad(m::VARCHAR, 2, '0') || ':' || lpad(s::VARCHAR, 2, '0') || ',' || rpad(ms::VARCHAR, 3, '0') END AS stamp,
    CASE WHEN sep <> ';' THEN ((m * 60 + s) * 1000 + rpad(ms::VARCHAR, 3, '0')::BIGINT)::BIGINT END AS millis FROM s""")
def srt_timestamp_fix(t: Tables) -> DataFrame:
    e = F.col("event_id")
    sep = F.get(F.array(*[F.lit(x) for x in ":.,;"]), e % 4)
    raw = F.concat((F.floor(e / 60) % 60).cast("string"), F.lit(":"), (e % 60).cast("string"), sep, (e % 997).cast("string"))
    fixed = t.events.select("event_id", texts.subtitle_time(raw).alias("stamp"))
    return fixed.select("event_id", "stamp", texts.subtitle_millis(F.col("stamp")).alias("millis"))


@query("video_id_extract", """SELECT id, CASE WHEN id % 4 < 3 THEN substr(hash, 1, 11) END AS video, CASE WHEN id % 4 = 3 THEN url <> url ELSE hash <> '' AND id % 4 < 2 END AS is_video FROM is_pd12m""")
def video_id_extract(t: Tables) -> DataFrame:
    start = F.substring("hash", 1, 11)
    url = F.when(F.col("id") % 4 == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), start)).when(F.col("id") % 4 == 1, F.concat(F.lit("youtu.be/"), start)).when(F.col("id") % 4 == 2, F.concat(F.lit("see https://youtube.com/shorts/"), start)).otherwise(F.col("url"))
    return t.is_pd12m.select("id", scalars.video_id(url).alias("video"), scalars.is_video_url(url).alias("is_video"))


@query("file_kind", r"""SELECT id, CASE WHEN e IN ('mp4', 'mkv', 'webm', 'flv') THEN 'video' WHEN e IN ('m4a', 'mp3', 'ogg', 'wav') THEN 'audio' WHEN e IN ('srt', 'vtt', 'ass') THEN 'subtitle'
  WHEN e IN ('jpg', 'jpeg', 'png', 'webp') THEN 'image' WHEN e = 'json' THEN 'metadata' WHEN e = 'description' THEN 'description' ELSE 'other' END AS kind
  FROM (SELECT id, lower(regexp_extract(coalesce(caption, '') || CASE id % 7 WHEN 0 THEN '.MP4' WHEN 1 THEN '.srt' WHEN 2 THEN '.m4a' WHEN 3 THEN '.json' ELSE '' END, '\.([^./]*)$', 1)) AS e FROM is_pd12m)""")
def file_kind(t: Tables) -> DataFrame:
    ending = F.coalesce(F.get(F.array(*[F.lit(x) for x in (".MP4", ".srt", ".m4a", ".json")]), (F.col("id") % 7).cast("int")), F.lit(""))
    return t.is_pd12m.select("id", scalars.file_kind(F.concat(F.coalesce("caption", F.lit("")), ending)).alias("kind"))


@query("sections_600", """SELECT doc_id, (s // 600 + 1)::INTEGER AS index, s::INTEGER AS start, least(s + 600, n)::INTEGER AS "end" FROM (SELECT doc_id, n_chars AS n, unnest(CASE WHEN n_chars > 600 THEN range(0, n_chars, 600) ELSE [0::BIGINT] END) AS s FROM documents)""")
def sections_600(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(scalars.sections(F.col("n_chars"))).alias("s")).select("doc_id", "s.index", "s.start", "s.end")


@query("aspect_ratio", "SELECT id, CASE WHEN origin_height IS NULL OR origin_height = 0 THEN 0.0 ELSE round(origin_width / origin_height, 6) END AS ratio FROM is_pd12m")
def aspect_ratio(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", F.round(scalars.aspect_ratio(F.col("origin_width"), F.col("origin_height")), 6).alias("ratio"))


@query("image_gate", """SELECT id, CASE WHEN origin_width IS NULL OR origin_height IS NULL OR least(origin_width, origin_height) < 256 THEN 'reject' WHEN greatest(origin_width, origin_height) > 7680 THEN 'shrink'
  WHEN upper(regexp_extract(coalesce(caption, ''), '\\.([^./]*)$', 1)) NOT IN ('JPG', 'JPEG') THEN 'convert' ELSE 'keep' END AS action FROM is_pd12m""")
def image_gate(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", scalars.image_gate(F.col("origin_width"), F.col("origin_height"), scalars.extension(F.coalesce("caption", F.lit("")))).alias("action"))


@query("fit_size", """SELECT id, greatest(round(origin_width * s), 1)::INTEGER AS width, greatest(round(origin_height * s), 1)::INTEGER AS height FROM (SELECT id, origin_width, origin_height, least(384.0::DOUBLE / origin_width, 384.0::DOUBLE / origin_height) AS s FROM is_pd12m WHERE origin_width > 0 AND origin_height > 0)""")
def fit_size(t: Tables) -> DataFrame:
    sized = t.is_pd12m.where("origin_width > 0 and origin_height > 0").select("id", scalars.fit_size(F.col("origin_width"), F.col("origin_height"), 384, 384).alias("s"))
    return sized.select("id", "s.width", "s.height")


@query("paper_path", """SELECT id, CASE WHEN NOT contains(paper_id, '/') THEN 'store/pdf/' || split_part(paper_id, '.', 1) || '/' || paper_id || v || '.pdf' ELSE 'store/' || split_part(paper_id, '/', 1) || '/pdf/' || substr(split_part(paper_id, '/', 2), 1, 4) || '/' || split_part(paper_id, '/', 2) || v || '.pdf' END AS path
  FROM (SELECT id, paper_id, (CAST(versions AS JSON)->>'$[#-1]') AS v FROM ts_arxiv WHERE paper_id IS NOT NULL AND versions IS NOT NULL)""")
def paper_path(t: Tables) -> DataFrame:
    rows = t.ts_arxiv.where("paper_id is not null and versions is not null")
    return rows.select("id", scalars.paper_path(F.col("paper_id"), F.from_json("versions", "array<string>"), "store").alias("path"))


@query("expand_source", "SELECT id, CASE WHEN origin_source IN ('cc12m_cleaned', 'cc12m_woman') THEN 'cc12m|' || origin_source ELSE coalesce(origin_source, '') END AS sources FROM is_pd12m")
def expand_source(t: Tables) -> DataFrame:
    return t.is_pd12m.select("id", F.array_join(scalars.expand_source(F.col("origin_source")), "|").alias("sources"))


@query("content_kind", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'PDF' WHEN 1 THEN NULL ELSE 'TEXT' END AS kind FROM documents WHERE text IS NOT NULL AND NOT starts_with(text, '%PDF')")
def content_kind(t: Tables) -> DataFrame:
    """Each text as it is, or behind the mark of a PDF, or behind a byte that is no UTF-8."""
    before = F.when(F.col("doc_id") % 4 == 0, F.lit(b"%PDF-1.7 ")).when(F.col("doc_id") % 4 == 1, F.lit(b"\xff\xfe")).otherwise(F.lit(b""))
    return t.documents.where("text is not null and not startswith(text, '%PDF')").select("doc_id", scalars.content_kind(F.concat(before, F.encode("text", "utf-8"))).alias("kind"))


@query("angles_and_times", """SELECT event_id, CASE WHEN event_id % 360 <= 45 THEN 0 WHEN event_id % 360 <= 135 THEN 90 WHEN event_id % 360 <= 225 THEN 180 WHEN event_id % 360 <= 315 THEN 270 ELSE 0 END AS angle, event_id // 60000 AS minutes, (event_id // 1000) % 60 AS seconds, event_id % 1000 AS millis,
  round(sqrt(pow(value - 1, 2) + pow(user_id - 2, 2)), 6) AS distance FROM events""")
def angles_and_times(t: Tables) -> DataFrame:
    e = F.col("event_id")
    rows = t.events.select("event_id", scalars.right_angle(e % 360).alias("angle"), scalars.split_millis(e).alias("m"), F.round(scalars.point_distance(F.col("value"), F.col("user_id"), F.lit(1), F.lit(2)), 6).alias("distance"))
    return rows.select("event_id", "angle", "m.minutes", "m.seconds", "m.millis", "distance")


@query("sorted_json", """SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"source":' || coalesce('"' || source || '"', 'null') || '}' AS json FROM documents""")
def sorted_json(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", scalars.sorted_json("source", "lang", "doc_id").alias("json"))
