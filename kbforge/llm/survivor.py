"""Best representative of each duplicate group: unpivot, vote per normalised value, choose by max_by, pivot back.

Each field's rows vote with source trust times recency decay. A field's rule says what comes first:
``votes`` (the value with most votes wins, its best record speaks for it) or ``rank`` (a score of the record decides
and votes play no part). Ties always go to the later update time (null is earliest), then to the smaller id.
Everything is a partial aggregate, so a group that holds a third of all rows is combined before it is shuffled. Long
values aren't carried along: a caption travels as its record's id, its votes under a hash, and its text is fetched for
the winners.

Defined results: rows without a usable key are in no group; a field for which no record qualifies is null; an empty
table gives an empty result; the same record twice changes nothing but ``n_records``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbforge.staging import rows_up_to

MOST_SOURCES = 10_000
HALF_LIFE_DAYS = 365.0

#: Wordings by which a caption says that there is none, in lower case without marks around.
NO_CAPTION = (
    r"none|null|nil|nan|na|n a|n/a|unknown|undefined|missing|empty|blank|tbd|todo|image|photo|picture|placeholder|caption|title|description|untitled"
    r"|(untitled|unnamed|unknown|no)( \w+)? (image|photo|photograph|picture|file|caption|description|title|text|alt text|name)( available| provided| given| found| here)?"
    r"|no (caption|description|title|text|information)( is)?( available| provided| given| found)?"
    r"|(caption|description|title)( is)? (not available|unavailable|missing|none|empty)|not available|not provided|without (caption|title|description)"
)
FILE_NAME = r"^[^\s/]*\.(jpe?g|jpe|png|tiff?|gif|webp|bmp|svg|heic|raw|nef|cr2|dng|jp2|psd|pdf)$"
CAMERA_NAME = r"^(img|dsc[nf]?|scan|image|photo|pict?|p|dji|gopr|pxl)[_ -]?\d{2,}([_-]\d+)*$"


def hash_key(raw: Column) -> Column:
    """32 lower-case hexadecimal digits, whatever their case and whatever stands around or between; else null."""
    text = F.regexp_replace(F.lower(raw), r"^[^0-9a-z]*md5[^0-9a-z]*", " ")
    found = F.regexp_extract(text, r"(?:^|[^0-9a-z])((?:[0-9a-f][^0-9a-z]*){31}[0-9a-f])(?:[^0-9a-z]|$)", 1)
    digits = F.regexp_replace(found, r"[^0-9a-f]", "")
    return F.when((digits != "") & (digits != F.repeat(F.substring(digits, 1, 1), F.lit(32))), digits)


def squeeze(text: Column) -> Column:
    """White space collapsed and cut off at both ends."""
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def says_something(caption: Column) -> Column:
    """True where a caption is no blank, no wording for absence and no bare file name."""
    flat = F.lower(squeeze(caption))
    bare = F.regexp_replace(flat, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.coalesce((bare != "") & ~bare.rlike(f"^({NO_CAPTION})$") & ~flat.rlike(FILE_NAME) & ~flat.rlike(CAMERA_NAME), F.lit(False))


def normal_source(source: Column) -> Column:
    return F.lower(F.regexp_replace(source, r"^[\s ]+|[\s ]+$", ""))


def with_trust(records: DataFrame, trust: DataFrame, key: str = "id") -> DataFrame:
    """``records`` with ``sources`` (normalised, distinct, sorted) and ``trust`` (the highest of them; 0 if none is known)."""
    names = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(F.col("source"), F.array()), normal_source), lambda x: x.isNotNull() & (x != ""))))
    out = records.withColumn("sources", names)
    known = trust.where("source is not null and trust is not null").groupBy(normal_source(F.col("source")).alias("name")).agg(F.max("trust").alias("t"))
    if rows_up_to(known, MOST_SOURCES) <= MOST_SOURCES:  # a map of checked size, held in the plan itself
        pairs = sorted((r["name"], r["t"]) for r in known.collect())
        table = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[F.lit(int(t)) for _, t in pairs])) if pairs else F.create_map(F.lit(""), F.lit(0))
        best = F.array_max(F.transform(F.col("sources"), lambda x: F.coalesce(F.try_element_at(table, x).cast("long"), F.lit(0).cast("long"))))
        return out.withColumn("trust", F.coalesce(best, F.lit(0).cast("long")))
    held = out.select(F.col(key).alias("k_"), F.explode("sources").alias("name")).join(known, "name").groupBy("k_").agg(F.max("t").alias("trust"))
    return out.join(held, out[key] == held["k_"], "left").drop("k_").withColumn("trust", F.coalesce(F.col("trust").cast("long"), F.lit(0).cast("long")))


@dataclass(frozen=True)
class Field:
    """One field of the surviving record. ``value``: a struct of what survives; ``norm``: equal values vote together
    (null: the record does not qualify); ``rank``: the record's own score, by which a ``rank`` rule decides."""

    name: str
    value: Column
    norm: Column
    rank: Column
    rule: str = "rank"


def best_representative(records: DataFrame, group: Column, fields: list[Field], recency: Column | None = None) -> DataFrame:
    """(group, n_records, <field>...) for each group of two or more records; each field is a struct or null.

    ``records`` needs id, trust and updated_at. ``recency``: a weight of 0..1; by default halving each year before the
    newest update of the table, without a shuffle of rows.
    """
    if recency is None:
        newest = records.agg(F.max("updated_at").alias("t")).first()["t"]
        age = F.lit(0.0) if newest is None else F.coalesce((F.unix_seconds(F.lit(newest)) - F.unix_seconds("updated_at")) / 86400.0, F.lit(10 * HALF_LIFE_DAYS))
        recency = F.pow(F.lit(0.5), age / HALF_LIFE_DAYS)
    marker = F.struct(F.lit("").alias("field"), F.lit("").alias("norm"), F.lit(0.0).alias("rank"), F.struct(*[F.when(F.lit(False), f.value).alias(f.name) for f in fields]).alias("value"))
    entries = [marker]
    for f in fields:
        held = F.struct(*[(f.value if g is f else F.when(F.lit(False), g.value)).alias(g.name) for g in fields])
        entries.append(F.when(f.norm.isNotNull(), F.struct(F.lit(f.name).alias("field"), f.norm.cast("string").alias("norm"), f.rank.cast("double").alias("rank"), held.alias("value"))))
    long = (
        records.withColumn("g_", group)
        .where("g_ is not null")
        .select("g_", "id", "updated_at", ((F.col("trust") + 0.0) * recency).alias("vote"), F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("e"))
        .select("g_", "id", "updated_at", "vote", "e.*")
    )
    record_order = F.struct("rank", "updated_at", (-F.col("id")).alias("id"))
    voted = long.groupBy("g_", "field", "norm").agg(F.sum("vote").alias("votes"), F.count(F.lit(1)).alias("n"), F.max(record_order).alias("best"), F.max_by("value", record_order).alias("value"))
    by_votes = F.col("field").isin([f.name for f in fields if f.rule == "votes"])
    value_order = F.struct(F.when(by_votes, F.round("votes", 9)).otherwise(F.lit(0.0)).alias("votes"), "best")
    won = voted.groupBy("g_", "field").agg(F.max_by("value", value_order).alias("value"), F.sum("n").alias("n"))
    pivoted = won.groupBy("g_").agg(
        F.max(F.when(F.col("field") == "", F.col("n"))).alias("n_records"),
        *[F.max_by(F.col(f"value.{f.name}"), F.col("field") == f.name).alias(f.name) for f in fields],
    )
    return pivoted.where("n_records >= 2").withColumnRenamed("g_", "group_key")


def image_records(images: DataFrame, trust: DataFrame) -> DataFrame:
    """One surviving record per group of images that share a hash: best size, the id of the record with the best caption,
    voted licence and origin."""
    w, h = F.col("origin_width"), F.col("origin_height")
    fits = w.between(1, 100_000) & h.between(1, 100_000)
    caption, licence, origin = squeeze(F.col("caption")), squeeze(F.col("license")), normal_source(F.col("origin_source"))
    fields = [
        Field("size", F.struct("id", "origin_width", "origin_height"), F.when(fits, F.concat_ws("x", w, h)), w * h),
        Field("caption", F.struct("id"), F.when(says_something(F.col("caption")), F.xxhash64(F.lower(caption))), F.col("trust")),
        Field("license", F.struct("id", licence.alias("text")), F.when(licence != "", F.lower(licence)), F.col("trust"), "votes"),
        Field("origin_source", F.struct("id", origin.alias("text")), F.when(origin != "", origin), F.col("trust"), "votes"),
    ]
    held = with_trust(images.select("id", "origin_hash", "origin_width", "origin_height", "caption", "license", "origin_source", "source", "updated_at"), trust)
    return best_representative(held, hash_key(F.col("origin_hash")), fields)


def group_sources(images: DataFrame) -> DataFrame:
    """(group_key, sources): every source of each hash group, distinct before it is gathered, so that a group's list
    is as long as the number of different source names and not as its rows."""
    names = images.select(hash_key(F.col("origin_hash")).alias("group_key"), F.explode("source").alias("s"))
    names = names.select("group_key", normal_source(F.col("s")).alias("s")).where("group_key is not null and s <> ''").distinct()
    return names.groupBy("group_key").agg(F.array_sort(F.collect_list("s")).alias("sources"))


def survivors(images: DataFrame, trust: DataFrame) -> DataFrame:
    """The surviving records with the text of their caption and every source of their group."""
    texts = images.groupBy(F.col("id").alias("c_")).agg(F.max(squeeze(F.col("caption"))).alias("text"))  # repeated records are one
    won = image_records(images, trust).withColumn("c_", F.col("caption.id"))
    named = won.join(texts, "c_", "left").withColumn("caption", F.when(F.col("c_").isNotNull(), F.struct(F.col("c_").alias("id"), "text"))).drop("c_", "text")
    return named.join(group_sources(images), "group_key", "left")


