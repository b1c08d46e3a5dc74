"""Work steps over rows: fetch, validate, embed texts, embed images, caption. Models and transport are arguments.

Each step takes a DataFrame and returns one of changes keyed by id, to be written by ``tables.update_by_id`` or
``insert_ignore``; a row that fails gets its error beside it and never stops the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.functions import scalars, texts
from kbforge.operators import tables
from kbforge.providers import Embedder
from kbforge.sources import objects


def enrich(rows: DataFrame, json_columns: list[str]) -> DataFrame:
    """``rows`` with their structured columns as JSON text (null and empty ones stay null) and ``updated_at`` filled."""
    out = rows
    for c in (c for c in json_columns if c in rows.columns):
        plain = rows.schema[c].dataType.simpleString() == "string"
        out = out.withColumn(c, F.when(F.col(c) != "", F.col(c)) if plain else F.to_json(F.col(c)))
    now = F.current_timestamp()
    return out.withColumn("updated_at", F.coalesce("updated_at", now) if "updated_at" in rows.columns else now)


def unfetched(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("origin_storage_id").isNull())


def fetch_changes(rows: DataFrame, stored: DataFrame, get: Callable[[str], bytes], bucket: str, prefix: str, dataset: str = "images", needs: str | None = None) -> DataFrame:
    """(id, origin_storage_id, content, error): rows whose object is stored already keep its address, others are
    fetched. ``stored``: (key). ``needs``: the kind the content must have. A failure leaves '' as the address, so that
    the row isn't taken up again for ever."""
    keyed = rows.withColumn("key_", scalars.storage_key(F.col("hash"), F.col("url"), prefix, dataset))
    address = scalars.object_address(F.col("key_"), bucket)
    there = stored.select(F.col("key").alias("key_")).distinct()
    done = keyed.join(there, "key_", "left_semi").select("id", address.alias("origin_storage_id"), F.lit(None).cast("binary").alias("content"), F.lit(None).cast("string").alias("error"))
    fresh = keyed.join(there, "key_", "left_anti")
    got = objects.fetch(fresh, "id", "url", get)
    wrong = F.lit(False) if needs is None else ~scalars.content_kind(F.col("content")).eqNullSafe(F.lit(needs))
    error = F.coalesce("error", F.when(wrong, F.lit("unexpected kind of file")))
    new = got.join(fresh.select("id", "key_"), "id").select("id", F.when(error.isNull(), address).otherwise("").alias("origin_storage_id"), F.when(error.isNull(), F.col("content")).alias("content"), error.alias("error"))
    return done.unionByName(new)


def validation_changes(rows: DataFrame, contents: DataFrame, kind: str = "PDF") -> DataFrame:
    """(id, validated, origin_storage_id): true where the stored content is of ``kind``; else the address is cleared.
    ``contents``: (id, content)."""
    checked = rows.where(~F.coalesce("validated", F.lit(False))).join(contents.select("id", scalars.content_kind(F.col("content")).alias("k")), "id")
    return checked.select("id", F.col("k").eqNullSafe(F.lit(kind)).alias("validated"), F.when(F.col("k") == kind, F.col("origin_storage_id")).otherwise("").alias("origin_storage_id"))


def embed_documents(documents: DataFrame, existing: DataFrame, embedder: Embedder, size: int = texts.CHUNK_SIZE, overlap: int = texts.CHUNK_OVERLAP) -> DataFrame:
    """Chunk rows to append for documents (id, title, url, text) without chunks: cut, embedded, known keys left out."""
    todo = documents.join(existing.select(F.col("source_id").alias("id")).distinct(), "id", "left_anti")
    cut = texts.chunk_documents(todo, "id", "text", size, overlap).withColumnRenamed("id", "source_id")
    keyed = cut.withColumn("id", F.xxhash64("source_id", "chunk_index"))
    made = keyed.join(embedder.embed(keyed.select("id", F.col("chunk_text").alias("text"))), "id").drop("id")
    whole = made.join(todo.select(F.col("id").alias("source_id"), "title", "url"), "source_id")
    return tables.insert_ignore(existing.select("source_id", "chunk_index"), whole, ["source_id", "chunk_index"])


def embed_chunks(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    """(id, vector) of chunks that have none yet."""
    return embedder.embed(chunks.where("vector is null").select("id", F.col("chunk_text").alias("text")))


def unembedded_images(images: DataFrame) -> DataFrame:
    return images.where("origin_storage_id is not null and origin_storage_id <> '' and (processed_storage_id = '' or vector is null)")


def image_changes(images: DataFrame, embed: Callable[[list[bytes]], list[list[float]]], contents: DataFrame) -> DataFrame:
    """(id, action, vector, error) of images (id, origin_width, origin_height, format): what the gate says, and the
    vector of those it lets pass. ``contents``: (id, content)."""
    gated = images.select("id", scalars.image_gate(F.col("origin_width"), F.col("origin_height"), F.col("format")).alias("action")).join(contents.select("id", "content"), "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, action, content in zip(batch["id"], batch["action"], batch["content"]):
                if action == "reject" or content is None:
                    out.append((i, action, None, "too small" if action == "reject" else "no content"))
                    continue
                try:
                    out.append((i, action, embed([content])[0], None))
                except Exception as why:
                    out.append((i, action, None, str(why)[:500]))
            yield pd.DataFrame(out, columns=["id", "action", "vector", "error"])

    return gated.mapInPandas(run, "id long, action string, vector array<float>, error string")


def caption_changes(images: DataFrame, caption: Callable[[str], str]) -> DataFrame:
    """(id, caption_long, caption): captions of images (id, url) that have no long one, from a captioner's block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, url in zip(batch["id"], batch["url"]):
                try:
                    out.append((i, caption(url)))
                except Exception:
                    out.append((i, None))
            yield pd.DataFrame(out, columns=["id", "block"])

    made = images.where("caption_long = '' or caption_long is null").select("id", "url").mapInPandas(run, "id long, block string")
    return made.where("block is not null").select("id", texts.caption_part(F.col("block"), "long").alias("caption_long"), texts.caption_part(F.col("block"), "short").alias("caption"))


def caption_subtitles(captions: DataFrame, video: str = "video") -> DataFrame:
    """(video, start, end, text) of JSON captions (video, json): times mended; captions that can't be read are left out."""
    each = captions.select(video, F.explode(F.from_json("json", "array<struct<index:int,start:string,end:string,text:string>>")).alias("c"))
    cues = each.select(video, texts.subtitle_time(F.coalesce("c.start", F.lit("00:00,000"))).alias("start"), texts.subtitle_time(F.coalesce("c.end", F.lit("00:00,000"))).alias("end"), F.coalesce("c.text", F.lit("")).alias("text"))
    return cues.where("start is not null and end is not null")
