"""Models behind interfaces: embedders, rerankers and query expansion. The ones here are deterministic and need no
files; a real model takes their place by the same methods."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbforge.functions import vectors as V


class Embedder(Protocol):
    def embed_texts(self, texts: list[str], task: str = "") -> list[list[float]]: ...

    def embed(self, rows: DataFrame, task: str = "") -> DataFrame: ...


class Reranker(Protocol):
    def score(self, topic: str, texts: list[str]) -> list[float]: ...


class OverlapReranker:
    """The share of the topic's words (runs of ASCII letters and digits) that a text holds."""

    def score(self, topic: str, texts: list[str]) -> list[float]:
        words = set(re.findall("[a-z0-9]+", topic.lower()))
        return [len(words & set(re.findall("[a-z0-9]+", t.lower()))) / max(1, len(words)) for t in texts]


def rerank_scores(rows: DataFrame, key: str, text: str, topic: str, reranker: Reranker, most_chars: int = 4096, batch: int = 64) -> DataFrame:
    """(key, rank_score) of every row: texts, cut to ``most_chars`` characters as the model takes them, are scored in
    batches. A batch that fails, or gives another number of scores than it was given texts, counts as zeros."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            scores: list[float] = []
            for i in range(0, len(frame), batch):
                part = [t or "" for t in frame["t_"][i : i + batch]]
                try:
                    found = [float(x) for x in reranker.score(topic, part)]
                except Exception:
                    found = []
                scores += found if len(found) == len(part) else [0.0] * len(part)
            yield pd.DataFrame({key: frame["k_"], "rank_score": scores})

    return rows.select(F.col(key).alias("k_"), F.substring(text, 1, most_chars).alias("t_")).mapInPandas(run, f"{key} {kind}, rank_score double")


class Encoder:
    """An embedder with the form of its vectors: cut to the first ``dims`` elements at unit length, and quantised to 8 or
    4 bits. Texts are embedded in batches; a batch with a wrong number of vectors is an error of the model, and each of
    its rows is tried alone. A row that fails, or whose vector has another length than the first one's, gets null."""

    def __init__(self, embedder: Embedder, dims: int | None = None, bits: int | None = None, batch: int = 64):
        if bits not in (None, 4, 8):
            raise ValueError("vectors are quantised to 4 or 8 bits")
        self.embedder, self.dims, self.bits, self.batch = embedder, dims, bits, batch

    def embed_texts(self, texts: list[str], task: str = "") -> list[list[float]]:
        found = self.embedder.embed_texts(texts, task)
        if len(found) != len(texts):
            raise ValueError(f"{len(texts)} texts gave {len(found)} vectors")
        return found

    def _tried(self, texts: list[str], task: str) -> list[list[float] | None]:
        try:
            return list(self.embed_texts(texts, task))
        except Exception:
            return [None] if len(texts) == 1 else [v for t in texts for v in self._tried([t], task)]

    def embed(self, rows: DataFrame, task: str = "") -> DataFrame:
        """(id, vector) of (id, text); codes take the place of the vector where they are asked for."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            length = None
            for frame in batches:
                out: list = []
                for i in range(0, len(frame), self.batch):
                    part = frame["text"][i : i + self.batch].tolist()
                    known = iter(self._tried([t for t in part if t is not None], task) if any(t is not None for t in part) else [])
                    out += [None if t is None else next(known) for t in part]
                length = length or next((len(v) for v in out if v is not None), None)
                yield pd.DataFrame({"id": frame["id"], "vector": [v if v is None or len(v) == length else None for v in out]})

        made = rows.select("id", "text").mapInPandas(run, "id long, vector array<double>")
        vector = V.mrl(F.col("vector"), self.dims)
        vector = {None: vector, 8: V.quantise8(vector), 4: V.quantise4(vector)}[self.bits]
        return made.select("id", vector.alias("vector"))


class LetterEmbedder:
    """How often each of ``letters`` stands in the lower-cased text, at unit length."""

    def __init__(self, letters: str = "abcdefghijklmnopqrstuvwxyz"):
        self.letters = letters

    def embed_texts(self, texts: list[str], task: str = "") -> list[list[float]]:
        counts = np.array([[t.lower().count(x) for x in self.letters] for t in texts], dtype=np.float64).reshape(len(texts), len(self.letters))
        return (counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)).tolist()

    def embed(self, rows: DataFrame, task: str = "") -> DataFrame:
        return Encoder(self).embed(rows, task).withColumn("vector", F.col("vector").cast("array<float>"))


class HashEmbedder:
    """Signed hashing of words into ``dim`` buckets, at unit length. A text without a word is the zero vector."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def _one(self, text: str, task: str) -> np.ndarray:
        v = np.zeros(self.dim)
        for word in re.findall(r"\w+", text.lower()):
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
            v[h % self.dim] += 1 if h >> 63 else -1
        return v / max(float(np.linalg.norm(v)), 1e-12)

    def embed_texts(self, texts: list[str], task: str = "") -> list[list[float]]:
        return [self._one(t or "", task).tolist() for t in texts]

    def embed(self, rows: DataFrame, task: str = "") -> DataFrame:
        """(id, vector) of (id, text) rows in Arrow batches, one model per worker; a row that fails gets null."""
        own = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for text in batch["text"]:
                    try:
                        out.append(None if text is None else own._one(text, task).astype(np.float32))
                    except Exception:
                        out.append(None)
                yield pd.DataFrame({"id": batch["id"], "vector": out})

        return rows.select("id", "text").mapInPandas(run, "id long, vector array<float>")


def expand_query(topic: str, generate: Callable[[str], dict] | None = None, most: int = 3) -> dict[str, list[str]]:
    """{'sentences', 'keywords'} of a topic, at most ``most`` each; the topic itself where ``generate`` fails or is missing."""
    try:
        made = generate(topic) if generate else {}
    except Exception:
        made = {}
    clean = lambda xs: list(dict.fromkeys(x.strip() for x in xs or [] if isinstance(x, str) and x.strip()))[:most]
    return {"sentences": clean(made.get("sentences")) or [topic], "keywords": clean(made.get("keywords")) or [topic]}


def normalise_queries(texts: list[str]) -> list[str]:
    """Trimmed, lower-cased, distinct, in their order."""
    return list(dict.fromkeys(t.strip().lower() for t in texts))


def pooled(tokens: Column, spans: Column, most: int | None = None) -> Column:
    """Mean vector of each span (start, end) of a text's token vectors; ends beyond ``most`` - 1 are cut, empty spans
    and spans that begin there are left out."""
    kept = spans if most is None else F.transform(F.filter(spans, lambda s: s["start"] < most - 1), lambda s: F.struct(s["start"].alias("start"), F.least(s["end"], F.lit(most - 1)).alias("end")))
    kept = F.filter(kept, lambda s: s["end"] - s["start"] >= 1)

    def mean(s: Column) -> Column:
        part = F.slice(tokens, s["start"] + 1, s["end"] - s["start"])
        total = F.aggregate(part, F.transform(F.element_at(part, 1), lambda _: F.lit(0.0)), lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y.cast("double")))
        return F.transform(total, lambda x: x / (s["end"] - s["start"]))

    return F.transform(kept, mean)
