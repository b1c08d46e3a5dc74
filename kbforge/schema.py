"""Schemas of the knowledge base's tables and the names under which they are stored."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from kbforge.operators.tables import Table

_K = {"long": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "time": T.TimestampType(), "strings": T.ArrayType(T.StringType()), "vector": T.ArrayType(T.FloatType(), False)}


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _K[k], n not in required) for n, k, required in ((*p.rstrip("!").split(":"), [p.split(":")[0]] if p.endswith("!") else []) for p in text.split())])


DOCUMENTS = _struct("id:long! revid:long url:string title:string origin_storage_id:string ignored:boolean created_at:time updated_at:time")
CHUNKS = _struct("id:long! title:string url:string snapshot:string source_id:long! chunk_index:long! chunk_text:string vector:vector created_at:time updated_at:time")
IMAGES = _struct(
    "id:long! url:string! hash:string caption:string caption_long:string origin_source:string origin_hash:string origin_width:long origin_height:long origin_storage_id:string processed_storage_id:string"
    " processed_width:long processed_height:long aspect_ratio:double exif:string meta:string source:strings license:string vector:vector similarity:double similar_to:long created_at:time updated_at:time"
)
PAPERS = _struct(
    "id:long! paper_id:string! submitter:strings authors:strings title:string comments:string journal_ref:string doi:string report_no:string categories:strings versions:strings hash:string license:string"
    " abstract:string url:string origin_storage_id:string validated:boolean created_at:time updated_at:time"
)
PASSAGES = _struct("item_id:long! answers:strings query:string passage_id:long passage_text:string is_selected:long url:string query_id:long query_type:string well_formed_answers:strings vector:vector")
WORKERS = _struct("id:long! uuid:string! workflow:string last_heartbeat:time")

#: name of a dataset: (prefix of its table, schema, unique keys)
DATASETS = {
    "documents": ("ts", DOCUMENTS, ["id"]),
    "documents_embed": ("ts", CHUNKS, ["source_id", "chunk_index"]),
    "passages": ("ts", PASSAGES, ["query_id", "passage_id"]),
    "passages_embed": ("ts", CHUNKS, ["source_id", "chunk_index"]),
    "papers": ("ts", PAPERS, ["paper_id"]),
    "images": ("is", IMAGES, ["url"]),
    "alpha": ("ii", IMAGES, ["url"]),
    "workers": ("sc", WORKERS, ["uuid"]),
}


def table_name(dataset: str) -> str:
    """prefix_dataset; a name that isn't known is an error."""
    if dataset not in DATASETS:
        raise ValueError(f"no dataset {dataset}")
    return f"{DATASETS[dataset][0]}_{dataset}"


def open_table(spark: SparkSession, root: str, dataset: str) -> Table:
    """The keyed table of a dataset below ``root``; it need not exist yet."""
    name = table_name(dataset)
    _, schema, keys = DATASETS[dataset]
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return Table(spark, f"{root}/{name}", nullable, keys)
