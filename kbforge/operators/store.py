"""The small store: a meta table with texts and tags, an embedding table, and a configuration that names their columns.

Search returns DataFrames; failures raise. ``text`` columns that are null come out as '' from a vector search.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbforge.functions import vectors as V
from kbforge.operators import search, tables
from kbforge.providers import Embedder


@dataclass(frozen=True)
class Config:
    """What a store is called and which of its columns may be searched and returned."""

    name: str
    database: str
    meta_table: str
    id_column: str
    embedding_table: str
    vector_columns: tuple[str, ...]
    model: str
    text_column: str | None = None
    tags_column: str | None = None
    retrieval_columns: tuple[str, ...] = ()
    direct_search_columns: tuple[str, ...] = ()
    writable: bool = False
    mrl_dims: int | None = None
    quantization: str | None = None
    query_task: str = ""
    passage_task: str = ""

    @property
    def columns(self) -> list[str]:
        """Id, text and retrieval columns, each once and in this order."""
        return list(dict.fromkeys([self.id_column, *([self.text_column] if self.text_column else []), *self.retrieval_columns]))


def parse_config(raw: dict, name: str = "default", folder: str = ".") -> Config:
    """A configuration from its parsed YAML or JSON; a missing key is an error, a relative path lies in ``folder``."""
    meta, emb = raw.get("meta_table") or {}, raw.get("embedding_table") or {}
    needed = {"database_file": raw.get("database_file"), "meta_table.name": meta.get("name"), "meta_table.id_column": meta.get("id_column"), "embedding_table.name": emb.get("name"), "embedding_table.embedding_column": emb.get("embedding_column"), "embedding_table.emb_model": emb.get("emb_model")}
    if missing := sorted(k for k, v in needed.items() if not v):
        raise ValueError(f"the configuration lacks {', '.join(missing)}")
    vector = emb["embedding_column"]
    return Config(
        name, os.path.join(folder, raw["database_file"]), meta["name"], meta["id_column"], emb["name"], tuple(vector) if isinstance(vector, list) else (vector,), emb["emb_model"], meta.get("text_column"), meta.get("tags_column"),
        tuple(meta.get("retrieval_columns") or ()), tuple(meta.get("direct_search_columns") or ()), bool(raw.get("database_writable")), emb.get("mrl_dims"), emb.get("quantization"), emb.get("query_task_type") or "", emb.get("passage_task_type") or "",
    )


def load_config(path: str, name: str = "default") -> Config:
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        raw = yaml.safe_load(text)
    except ImportError:
        import json

        raw = json.loads(text)
    if not isinstance(raw, dict):
        raise ValueError("the configuration is no mapping")
    return parse_config(raw, name, os.path.dirname(os.path.abspath(path)))


@dataclass
class Registry:
    """Configurations by name, found in a folder; ``default`` is the first that is valid."""

    configs: dict[str, Config] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    @classmethod
    def discover(cls, folder: str) -> Registry:
        found = cls()
        for path in sorted(p for p in Path(folder).rglob("*") if p.suffix in (".yaml", ".yml", ".json")):
            name = "_".join(path.relative_to(folder).with_suffix("").parts)
            try:
                found.configs[name] = load_config(str(path), name)
            except Exception as why:
                found.failed[name] = str(why)
        return found

    def get(self, name: str = "default") -> Config:
        if name == "default" and "default" not in self.configs and self.configs:
            return next(iter(self.configs.values()))
        if name not in self.configs:
            raise KeyError(f"no configuration {name}")
        return self.configs[name]

    def health(self) -> str:
        return "unhealthy" if not self.configs else "degraded" if self.failed else "healthy"


def has_all_tags(column: str, tags: list[str]):
    """True where every one of ``tags`` is set; null tags pass nothing."""
    return F.size(F.array_except(F.array(*[F.lit(t) for t in tags]), F.col(column))) == 0


def query_codes(vector: list[float], config: Config) -> list[float]:
    """The query vector as the store keeps vectors: cut, then quantised to biased codes where the store says so."""
    import numpy as np

    v = np.asarray(vector, dtype=np.float64)
    if config.mrl_dims is not None:
        v = v[: config.mrl_dims if config.mrl_dims in V.MRL_DIMS else V.MRL_DEFAULT]
        v = v / max(float(np.linalg.norm(v)), 1e-12)
    if config.quantization == "int8":
        return np.rint(np.clip(V.LIMIT_8BIT + v, 0, 2 * V.LIMIT_8BIT) / (2 * V.LIMIT_8BIT / 255)).tolist()
    if config.quantization == "int4":
        c = np.rint(np.clip(V.LIMIT_4BIT + v, 0, 2 * V.LIMIT_4BIT) / (2 * V.LIMIT_4BIT / 15)).astype(int)
        return ((c[0::2] << 4) | c[1::2]).astype(float).tolist()
    return v.tolist()


def search_documents(meta: DataFrame, embeddings: DataFrame, config: Config, vector: list[float], top_k: int = 10, tags: list[str] | None = None) -> DataFrame:
    """The most similar rows, with the configured columns and ``similarity``; ties go to the smaller id.

    Tags are filtered before the join, and the join happens after the columns are pruned. ``top_k`` is 1..100.
    """
    if not 1 <= top_k <= 100:
        raise ValueError("top_k must be in 1..100")
    kept = meta.where(has_all_tags(config.tags_column, tags)) if tags and config.tags_column else meta
    code = query_codes(vector, config)
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in config.vector_columns])
    scored = embeddings.where(ok).select(config.id_column, F.round(search.greatest_similarity(list(config.vector_columns), code), search.DIGITS).alias("similarity")).where(F.col("similarity").isNotNull())
    found = scored.join(kept.select(*config.columns), config.id_column)
    kinds = dict(found.dtypes)
    return found.orderBy(F.col("similarity").desc(), config.id_column).limit(top_k).select(*[F.coalesce(c, F.lit("")).alias(c) if kinds[c] == "string" else F.col(c) for c in [*config.columns, "similarity"]])


def direct_search(meta: DataFrame, config: Config, params: dict[str, object], limit: int = 10) -> DataFrame:
    """Rows equal to every parameter, the smallest ids first. No parameter, or one that isn't allowed, finds nothing."""
    if not params or any(k not in config.direct_search_columns for k in params):
        return meta.select(*config.columns).limit(0)
    wanted = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in params.items()])
    return meta.where(wanted).select(*config.columns).orderBy(config.id_column).limit(limit)


def edit_tags(tags, add: list[str], remove: list[str]):
    """Sorted, distinct tags after adding and then removing."""
    text = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return F.sort_array(F.array_except(F.array_union(F.coalesce(tags, text([])), text(add)), text(remove)))


META = T.StructType([T.StructField(n, k) for n, k in (("id", T.LongType()), ("doc_id", T.StringType()), ("url", T.StringType()), ("hash", T.StringType()), ("meta", T.StringType()), ("tags", T.ArrayType(T.StringType())), ("chunk_text", T.StringType()))])
EMBEDDING = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))])


class Store:
    """A writable store in two folders."""

    def __init__(self, spark: SparkSession, config: Config, embedder: Embedder | None = None):
        self.config, self.embedder = config, embedder
        self.meta = tables.Table(spark, f"{config.database}/{config.meta_table}", META, ["hash"])
        self.vectors = tables.Table(spark, f"{config.database}/{config.embedding_table}", EMBEDDING, ["id"])

    def _check(self) -> None:
        if not self.config.writable:
            raise ValueError("the store is not writable")

    def add(self, texts: DataFrame) -> int:
        """Add (doc_id, url, meta, tags, chunk_text) rows whose text isn't stored yet; how many were added.

        An empty text is an error, and so is a doc_id or url that another text already has.
        """
        self._check()
        if not texts.where("chunk_text is null or chunk_text = ''").isEmpty():
            raise ValueError("a text is empty")
        old = self.meta.read()
        hashed = texts.withColumn("hash", F.sha2("chunk_text", 256))
        fresh = tables.insert_ignore(old, hashed, ["hash"], ["hash", "doc_id", "url"])
        for c in ("doc_id", "url"):
            known = old.select(c).unionByName(fresh.select(c)).where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1")
            if not known.isEmpty():
                raise ValueError(f"{c} is in use")
        numbered = tables.next_ids(old, fresh, "id", ["hash"])
        added = fresh.count()
        if added:
            self.meta.write(old.unionByName(numbered.select(*old.columns)))
        return added

    def pending(self) -> DataFrame:
        return self.meta.read().join(self.vectors.read().select("id"), "id", "left_anti")

    def process_pending(self) -> int:
        """Embed what has no vector yet; texts that fail stay pending."""
        self._check()
        if self.embedder is None:
            raise ValueError("an embedder is needed")
        made = self.embedder.embed(self.pending().select("id", F.col("chunk_text").alias("text")), self.config.passage_task).where("vector is not null")
        return self.vectors.insert(made.select("id", "vector"))

    def manage_tags(self, identifier: dict[str, object], add: list[str] | None = None, remove: list[str] | None = None) -> bool:
        """Edit the tags of the record that one identifier names; False where there is none. Written only on change."""
        self._check()
        if len(identifier) != 1:
            raise ValueError("exactly one identifier is needed")
        (column, value), old = next(iter(identifier.items())), self.meta.read()
        new = edit_tags(F.col("tags"), add or [], remove or [])
        mine = old.where(F.col(column) == F.lit(value))
        if mine.isEmpty():
            return False
        if not mine.where(~new.eqNullSafe(F.sort_array(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>")))))).isEmpty():
            self.meta.write(old.withColumn("tags", F.when(F.col(column) == F.lit(value), new).otherwise(F.col("tags"))))
        return True

    def search(self, text: str, top_k: int = 10, tags: list[str] | None = None) -> DataFrame:
        if not text:
            return self.meta.read().select(*self.config.columns).limit(0)
        vector = self.embedder.embed_texts([text], self.config.query_task)[0]
        return search_documents(self.meta.read(), self.vectors.read(), self.config, vector, top_k, tags)

    def direct_search(self, params: dict[str, object], limit: int = 10) -> DataFrame:
        return direct_search(self.meta.read(), self.config, params, limit)
