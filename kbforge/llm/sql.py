"""DuckDB SQL of the training-data queries that SQL can express."""

#: Fixed values, written out here so that a mistake in an operator's list shows: wordings for no caption, names of files,
#: and common words.
_ABSENT = (
    r"none|null|nil|nan|na|n a|n/a|unknown|undefined|missing|empty|blank|tbd|todo|image|photo|picture|placeholder|caption|title|description|untitled"
    r"|(untitled|unnamed|unknown|no)( \w+)? (image|photo|photograph|picture|file|caption|description|title|text|alt text|name)( available| provided| given| found| here)?"
    r"|no (caption|description|title|text|information)( is)?( available| provided| given| found)?"
    r"|(caption|description|title)( is)? (not available|unavailable|missing|none|empty)|not available|not provided|without (caption|title|description)"
)
_FILE = r"^[^\s/]*\.(jpe?g|jpe|png|tiff?|gif|webp|bmp|svg|heic|raw|nef|cr2|dng|jp2|psd|pdf)$"
_CAMERA = r"^(img|dsc[nf]?|scan|image|photo|pict?|p|dji|gopr|pxl)[_ -]?\d{2,}([_-]\d+)*$"
_WORDS = (
    "the of and to in a is was that for it as with on by at from their its this these those be were are which or an not but had has have each one another after before under over between near along until into during so because while if when where who they he she we you his her our all there than then also about above behind beyond beside within across through around against "
    "der die das den dem des und ist war ein eine einen einem einer nicht mit von zu im in an auf für aus nach bei bis seit trotz während zwischen unter über wie noch aber obwohl weil davon keine wird wurde sich auch als so oder "
    "le la les l de des du d un une et est était que qui dans en sur pour par avec au aux ne pas ce cette ces se sa son ses mais parce comme depuis pendant après sous entre malgré jusqu à nos bien "
    "el la los las de del un una y es era que en por para con no se su sus al como pero porque desde durante después bajo entre hasta aunque todavía más lo a ante sobre "
    "и в во не на что с со он она они как это по к ко но из у за от до для при между после под над о об так же или который была был были хотя потому без несмотря "
)

_FLAT = r"lower(trim(regexp_replace(caption, '[\s ]+', ' ', 'g')))"

P2_FOUND = rf"""
WITH raw AS (
  SELECT id, origin_width w, origin_height h, caption, updated_at, source,
    regexp_extract(regexp_replace(lower(origin_hash), '^[^0-9a-z]*md5[^0-9a-z]*', ' '),
      '(?:^|[^0-9a-z])((?:[0-9a-f][^0-9a-z]*){{31}}[0-9a-f])(?:[^0-9a-z]|$)', 1) AS found, {_FLAT} AS flat
  FROM is_pd12m),
keyed AS (SELECT *, regexp_replace(found, '[^0-9a-f]', '', 'g') AS k FROM raw),
kept AS (SELECT *, regexp_replace(flat, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS bare FROM keyed
  WHERE k <> '' AND k <> repeat(k[1], 32)),
names AS (SELECT id, lower(regexp_replace(s, '^[\s ]+|[\s ]+$', '', 'g')) AS s FROM (SELECT id, unnest(source) AS s FROM kept)),
trusts AS (SELECT n.id, max(t.trust) AS trust FROM names n JOIN source_trust t ON n.s = lower(trim(t.source)) GROUP BY n.id),
scored AS (SELECT k.*, coalesce(t.trust, 0) AS trust,
    w BETWEEN 1 AND 100000 AND h BETWEEN 1 AND 100000 AS fits,
    coalesce(bare <> '' AND NOT regexp_full_match(bare, '{_ABSENT}') AND NOT regexp_matches(flat, '{_FILE}') AND NOT regexp_matches(flat, '{_CAMERA}'), false) AS says
  FROM kept k LEFT JOIN trusts t USING (id)),
sizes AS (SELECT k, id, row_number() OVER (PARTITION BY k ORDER BY w * h DESC, updated_at DESC NULLS LAST, id) AS r FROM scored WHERE fits),
captions AS (SELECT k, id, row_number() OVER (PARTITION BY k ORDER BY trust DESC, updated_at DESC NULLS LAST, id) AS r FROM scored WHERE says)
SELECT g.k AS origin_hash, coalesce(s.id, 0)::BIGINT AS size_id, coalesce(c.id, 0)::BIGINT AS caption_id
FROM (SELECT k FROM scored GROUP BY k HAVING count(*) >= 2) g
LEFT JOIN sizes s ON s.k = g.k AND s.r = 1 LEFT JOIN captions c ON c.k = g.k AND c.r = 1
"""

P4_FOUND = """
WITH RECURSIVE linked AS (
  SELECT id a, similar_to b FROM image_match
  WHERE NOT isnan(similarity) AND CASE WHEN similarity > 1 THEN round(similarity / 100, 12) ELSE similarity END >= 0.999
    AND id <> 0 AND similar_to <> 0 AND id <> similar_to),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach AS (SELECT a, a AS b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT min(b) AS group_id, a AS id FROM reach GROUP BY a
"""

P7_FOUND = """
SELECT doc_id, ceil((strlen(text) + 1) / 4096.0)::BIGINT AS n_pieces FROM documents WHERE strlen(text) + 1 > 4096
"""

P7_VALID = """
SELECT sum(ceil((strlen(text) + 1) / 4096.0))::BIGINT AS pieces, sum(strlen(text) + 1)::BIGINT AS tokens, true AS within, true AS filled
FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
"""

_COMMON = ", ".join(f"'{w}'" for w in sorted(set(_WORDS.split())))

P9_STATISTICS = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t,
    list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w,
    list_filter(regexp_split_to_array(t, '[\r\n]+'), lambda x: trim(x) <> '') AS l FROM t),
c AS (SELECT doc_id, len(w) AS nw, len(l) AS nl, length(t) AS nc, length(array_to_string(w, '')) AS letters,
    length(regexp_replace(t, '[\p{{L}}\p{{N}}\s]', '', 'g')) AS symbols,
    len(list_filter(l, lambda x: regexp_matches(x, '[.!?。！？]["''”’)\]]*\s*$'))) AS ended,
    len(list_filter(w, lambda x: x IN ({_COMMON}))) AS common FROM s)
SELECT doc_id, nw::BIGINT AS n_words, nl::BIGINT AS n_lines,
  CASE WHEN nw > 0 THEN round(letters / nw, 6) ELSE 0.0 END AS mean_word_length,
  CASE WHEN nc > 0 THEN round(symbols / nc, 6) ELSE 0.0 END AS symbol_ratio,
  CASE WHEN nl > 0 THEN round(ended / nl, 6) ELSE 0.0 END AS ended_share,
  CASE WHEN nw > 0 THEN round(common / nw, 6) ELSE 0.0 END AS common_share
FROM c
"""
