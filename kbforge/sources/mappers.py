"""Mappers: delivered metadata onto the common schema, as column expressions over a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbforge.functions import scalars, texts

#: Columns that go by another name in a delivery.
RENAMES = {
    "plain": {},
    "long_caption": {"caption": "long_caption", "origin_hash": "hash", "url": "image_url"},
    "two_captions": {"caption": "caption_llava_short", "caption_long": "caption_llava"},
}


def _field(df: DataFrame, name: str, rename: dict[str, str], default: str = "") -> Column:
    source = rename.get(name, name)
    return scalars.or_default(F.col(source).cast("string"), F.lit(default)) if source in df.columns else F.lit(default)


def images(df: DataFrame, dataset: str, rename: str = "plain", bucket: str = "store", prefix: str = "images") -> DataFrame:
    """Image records; rows without an address are an error of the delivery and left out. Sizes that are no number count
    as 0."""
    names = RENAMES[rename]
    f = lambda c: _field(df, c, names)
    size = lambda c: F.coalesce(F.expr(f"try_cast({c} as long)"), F.lit(0)) if c in df.columns else F.lit(0).cast("long")
    w, h = size("width"), size("height")
    both = (w != 0) | (h != 0)
    kept = df.where(f("url") != "")
    return kept.select(
        f("url").alias("url"), f("caption").alias("caption"), f("caption_long").alias("caption_long"), F.sha2(f("url"), 256).alias("hash"), f("source").alias("origin_source"), f("origin_hash").alias("origin_hash"),
        F.when(both, w).otherwise(0).alias("origin_width"), F.when(both, h).otherwise(0).alias("origin_height"), scalars.object_address(scalars.storage_key(F.lit(""), f("url"), prefix), bucket).alias("origin_storage_id"),
        F.lit("").alias("processed_storage_id"), scalars.aspect_ratio(w, h).alias("aspect_ratio"), F.array(F.lit(dataset)).alias("source"), f("license").alias("license"),
    )


def high_or_low(df: DataFrame) -> DataFrame:
    """Records with a high-resolution address where there is one."""
    url = scalars.or_default(F.col("url_highres"), F.col("url"))
    return df.select(url.alias("url"), F.sha2(url, 256).alias("hash"), F.create_map(F.lit("url_lowres"), F.col("url"), F.lit("url_source"), F.col("url_source")).alias("meta"))


def featured_images(df: DataFrame) -> DataFrame:
    """Featured images: the caption is the first there is of five candidates. ``html`` is the image's page."""
    best = texts.largest_image(F.col("html"))
    caption = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("image.caption", "image.description", "image.parsed_title", "image.title", "text.title")], F.lit(""))
    return df.select(best["url"].alias("url"), caption.alias("caption"), F.sha2(best["url"], 256).alias("hash"), F.regexp_replace("image.filename", r"\.[^.]*$", "").alias("origin_hash"), best["width"].alias("origin_width"), best["height"].alias("origin_height"), scalars.aspect_ratio(best["width"], best["height"]).alias("aspect_ratio"))


def papers(df: DataFrame, prefix: str = "papers", bucket: str = "store") -> DataFrame:
    """Paper records of two layouts, told apart by ``abstract_md5``."""
    older = F.col("abstract_md5").isNull()
    hash_ = F.when(older, F.sha2("abstract", 256)).otherwise(F.col("abstract_md5"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.select(
        F.col("id").alias("paper_id"), texts.author_list(F.col("submitter")).alias("submitter"), texts.author_list(F.col("authors")).alias("authors"), "title", blank("comments").alias("comments"),
        blank("journal-ref").alias("journal_ref"), blank("doi").alias("doi"), blank("report-no").alias("report_no"), hash_.alias("hash"), F.when(older, F.lit("")).otherwise(blank("license")).alias("license"),
        F.when(older, F.lit("")).otherwise(blank("abstract")).alias("abstract"), scalars.object_address(scalars.storage_key(hash_, F.lit(""), prefix, "papers"), bucket).alias("origin_storage_id"),
    )


MAPPERS: dict[str, Callable[..., DataFrame]] = {"images": images, "high_or_low": high_or_low, "featured": featured_images, "papers": papers}
