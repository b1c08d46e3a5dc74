"""Queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbforge.llm import chunking, components, leaks, neighbours, packing, pairs, quality, sql, survivor
from kbforge.sources.tables import table


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.split_oversized(table(spark, folder, "ts_wikipedia_en_embed"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_pieces(spark, folder).where("piece_index = 0").select("source_id", "chunk_index", "boundary")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    won = survivor.image_records(table(spark, folder, "is_pd12m"), table(spark, folder, "source_trust"))
    zero = F.lit(0).cast("long")
    return won.select(F.col("group_key").alias("origin_hash"), F.coalesce("size.id", zero).alias("size_id"), F.coalesce("caption.id", zero).alias("caption_id"))


def p2_records(spark: SparkSession, folder: str) -> DataFrame:
    won = survivor.survivors(table(spark, folder, "is_pd12m"), table(spark, folder, "source_trust"))
    return won.select(
        F.col("group_key").alias("origin_hash"), "n_records", F.col("size.origin_width").alias("origin_width"), F.col("size.origin_height").alias("origin_height"),
        F.col("caption.text").alias("caption"), F.col("license.text").alias("license"), F.col("origin_source.text").alias("origin_source"), F.array_join("sources", "|").alias("sources"),
    )


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return components.connected_components(components.match_edges(table(spark, folder, "image_match")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    chunk = neighbours.similar_pairs(table(spark, folder, "ts_wikipedia_en_embed"), "id", "vector")
    image = neighbours.similar_pairs(table(spark, folder, "emb_table"), "id", "emb_vector_col")
    return chunk.select(F.lit("chunk").alias("collection"), "id_a", "id_b").unionByName(image.select(F.lit("image").alias("collection"), "id_a", "id_b"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.pair_defects(table(spark, folder, "ts_ms_marco"))


def p6_clauses(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.tagged_clauses(table(spark, folder, "ts_ms_marco"))


def p7_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_report(p7_pack(spark, folder))


def p7_valid(spark: SparkSession, folder: str) -> DataFrame:
    """The packing added up: all pieces and tokens are there, no container is over the capacity, and beside the last one
    the containers leave less than a hundredth open."""
    filled = packing.fill_report(p7_pack(spark, folder))
    tight = (F.col("containers") - 1) * packing.CAPACITY * 0.99 < F.col("tokens")
    return filled.select("pieces", "tokens", (F.col("largest") <= packing.CAPACITY).alias("within"), tight.alias("filled"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents over one container, from the containers that hold their pieces."""
    return p7_pack(spark, folder).where("n_pieces > 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pieces"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_item"))


def p9_labels(spark: SparkSession, folder: str) -> DataFrame:
    return quality.document_labels(table(spark, folder, "documents"), table(spark, folder, "doc_label"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_labels(spark, folder).where("kind <> 'prose'").select("doc_id", "kind")


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.statistics(table(spark, folder, "documents"))


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_pieces": p1_pieces, "p2_found": p2_found, "p2_records": p2_records, "p4_found": p4_found, "p5_found": p5_found,
        "p6_found": p6_found, "p6_clauses": p6_clauses,
        "p7_found": p7_found, "p7_pack": p7_pack, "p7_fill": p7_fill, "p7_valid": p7_valid, "p8_found": p8_found,
        "p9_found": p9_found, "p9_labels": p9_labels, "p9_statistics": p9_statistics,
    }


def oracle_sql() -> dict[str, str]:
    return {"p2_found": sql.P2_FOUND, "p4_found": sql.P4_FOUND, "p7_found": sql.P7_FOUND, "p7_valid": sql.P7_VALID, "p9_statistics": sql.P9_STATISTICS}
