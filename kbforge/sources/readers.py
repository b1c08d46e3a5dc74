"""Sources: metadata in Parquet, JSON lines, CSV, text and XML, and the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbforge.functions import texts

BAD = "_corrupt_record"


def parquet_meta(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with an ``id``: the table's own, else the place of the row in its file, from 0, which is the same at
    every read. Files of one folder each count from 0, as they do when they are loaded one by one."""
    df = spark.read.parquet(path)
    return df if "id" in df.columns else df.withColumn("id", F.col("_metadata.row_index"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object per line; a broken line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def tolerant_json_lines(spark: SparkSession, path: str, schema: str, folder: bool = False, pattern: str = "wiki_*") -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines). With ``folder`` every file below that fits ``pattern`` is read."""
    reader = spark.read
    if folder:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = reader.text(path).where(F.trim("value") != "").select("value", F.from_json("value", f"{schema}, {BAD} string", options).alias("j"))
    broken = F.col("j").isNull() | F.col(f"j.{BAD}").isNotNull()
    return parsed.where(~broken).select("j.*").drop(BAD), parsed.where(broken).select(F.col("value").alias("line"))


def csv_table(spark: SparkSession, path: str, schema: str | None = None, null: str = "\\N") -> DataFrame:
    """CSV with a header, quoted fields over several lines, fields of any length; ``null`` is how null is written."""
    reader = spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').option("maxCharsPerColumn", "-1").option("nullValue", null)
    return (reader.schema(schema) if schema else reader).csv(path)


def query_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(text, vector) of a CSV whose second column is a list of numbers; rows that can't be read are left out."""
    raw = spark.read.option("escape", '"').schema("text string, v string").csv(path)
    return raw.select("text", F.from_json("v", "array<double>").alias("vector")).where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))


def query_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file that aren't blank, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("query")).where("query <> ''")


def passages(items: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per passage of nested items (query_id, query, query_type, answers, wellFormedAnswers, passages struct of
    parallel arrays): its place from 0, answers trimmed. ``limit`` keeps the first items by query_id."""
    some = items if limit is None else items.orderBy("query_id").limit(limit)
    zipped = F.arrays_zip("passages.passage_text", "passages.is_selected", "passages.url")
    trimmed = lambda c: F.transform(c, lambda x: F.trim(x))
    flat = some.select("query_id", "query", "query_type", trimmed(F.col("answers")).alias("answers"), trimmed(F.col("wellFormedAnswers")).alias("well_formed_answers"), F.posexplode(zipped).alias("passage_id", "p"))
    return flat.select("query_id", "query", "query_type", "answers", "well_formed_answers", F.col("passage_id").cast("long"), "p.passage_text", F.col("p.is_selected").cast("long").alias("is_selected"), "p.url")


def featured(text_meta: DataFrame, image_meta: DataFrame, schema: str) -> DataFrame:
    """Each page's text metadata with each of its images' metadata. Both come as JSON within JSON strings (page, raw)."""
    inner = lambda c: F.from_json(F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string")["v"], schema)
    return text_meta.select("page", inner(F.col("raw")).alias("text")).join(image_meta.select("page", inner(F.col("raw")).alias("image")), "page")


DUMP = "title string, ns string, id long, redirect struct<_title: string>, revision struct<id: long, parentid: long, timestamp: string, contributor: struct<id: long, username: string>, comment: string, origin: string, model: string, format: string, text: string, sha1: string>"


def xml_dump(spark: SparkSession, path: str, base: str, known: DataFrame | None = None, namespaces: dict[str, str] | None = None) -> DataFrame:
    """Pages of a wiki dump, without those whose id is in ``known``; names of unknown namespaces are that of 0."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(DUMP).load(path)
    if known is not None:
        pages = pages.join(known.select("id"), "id", "left_anti")
    names = {"0": "Page"} | (namespaces or {})
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    rev = lambda c: F.col(f"revision.{c}")
    where = lambda c: F.concat(F.lit(base), texts.page_name(c))
    return pages.select(
        "id", F.trim("title").alias("title"), where(F.col("title")).alias("url"), F.coalesce(F.trim(F.col("redirect._title")), F.lit("")).alias("redirect"),
        F.coalesce(where(F.trim(F.col("redirect._title"))), F.lit("")).alias("redirecturl"), rev("contributor").alias("contributor"), rev("id").alias("revisionid"), rev("parentid").alias("parentid"),
        F.coalesce(F.try_element_at(table, F.col("ns")), F.lit(names["0"])).alias("namespace"), F.to_timestamp(rev("timestamp")).alias("timestamp"), F.coalesce(rev("comment"), F.lit("")).alias("comment"),
        rev("origin").alias("origin"), rev("model").alias("model"), rev("format").alias("format"), rev("sha1").alias("sha1"), F.coalesce(rev("text"), F.lit("")).alias("text"),
    )


def datasets(spark: SparkSession, prefix: int = 3) -> list[str]:
    """Names of the catalogue's tables without their prefix, sorted."""
    return sorted(t.name[prefix:] for t in spark.catalog.listTables() if not t.isTemporary)


def by_extension(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Metadata files by extension (Parquet, JSON, JSON lines), hidden ones skipped; another extension is an error."""
    shown = sorted(p for p in paths if not p.rsplit("/", 1)[-1].startswith("."))
    parts = []
    for kind, names in (("parquet", (".parquet",)), ("json", (".json", ".jsonl"))):
        mine = [p for p in shown if p.endswith(names)]
        if mine:
            parts.append(parquet_meta(spark, mine[0]) if kind == "parquet" and len(mine) == 1 else spark.read.parquet(*mine) if kind == "parquet" else spark.read.schema(schema).json(mine))
    if any(not p.endswith((".parquet", ".json", ".jsonl")) for p in shown):
        raise ValueError("a file of an unknown kind")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
