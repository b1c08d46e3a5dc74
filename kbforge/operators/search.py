"""Vector search: nearest rows of a corpus for one or many query vectors.

Ties always go to the smaller id. Rows whose vector is null, of another length than the query, or all zero are no
candidates. Many queries against a whole corpus go through NumPy products with a local top-k, so only k rows per query
and batch are ranked at the end. Queries travel to the corpus while they are counted few; beyond that both sides meet
in a grid of parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.functions import vectors as V
from kbforge.staging import rows_up_to

QUERY_BLOCK, CORPUS_PART = 4096, 32_768
#: Scores are compared at this many digits, so that results don't hang on the order of summation.
DIGITS = 6


def usable(vector: Column, dim: int) -> Column:
    return vector.isNotNull() & (F.size(vector) == dim) & F.exists(vector, lambda x: x != 0)


def vector_literal(values: list[float]) -> Column:
    """A query vector as a literal; its size is that of one vector."""
    return F.lit([float(x) for x in values]).cast("array<double>")


def top_k(corpus: DataFrame, key: str, vector: str, query: list[float], k: int, metric: str = "cosine", offset: int = 0) -> DataFrame:
    """The corpus rows with ``distance``, the nearest k of them. Plans as one TakeOrderedAndProject."""
    q = vector_literal(query)
    measure = {"cosine": V.cosine_distance, "l2": V.l2_distance}[metric]
    scored = corpus.where(usable(F.col(vector), len(query))).withColumn("distance", F.round(measure(F.col(vector), q), DIGITS))
    ordered = scored.orderBy("distance", key)
    return (ordered.offset(offset) if offset else ordered).limit(k)


def _nearest(ids: np.ndarray, q: np.ndarray, keys: np.ndarray, v: np.ndarray, k: int, metric: str, distinct_keys: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, key, distance): the nearest k of the rows of each query; the smaller key at a tie."""
    if metric == "cosine":
        d = 1 - (q @ v.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None, :])
    else:
        d = np.sqrt(np.maximum((q**2).sum(1)[:, None] + (v**2).sum(1)[None, :] - 2 * q @ v.T, 0))
    d = np.round(d, DIGITS) + 0.0
    if distinct_keys:
        d[ids[:, None] == keys[None, :]] = np.inf
    n = min(k, len(keys))
    edge = np.partition(d, n - 1, axis=1)[:, n - 1]
    a, b = np.nonzero((d <= edge[:, None]) & np.isfinite(d))
    order = np.lexsort((keys[b], d[a, b], a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, dtype=np.int64)
    kept = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a)))) < k
    return ids[a[kept]], keys[b[kept]], d[a[kept], b[kept]]


def grid(left: DataFrame, right: DataFrame, left_part: int, right_part: int) -> DataFrame:
    """(i, j, left, id, vec): every part of ``left`` (id, vec) together with every part of ``right``, parts dealt by a hash
    and of about so many rows. The shuffle carries each side as often as the other has parts; nothing is collected."""
    ni, nj = (max(1, -(-df.count() // part)) for df, part in ((left, left_part), (right, right_part)))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    one = left.select(own(ni).alias("i"), every(nj).alias("j"), F.lit(True).alias("left"), "id", "vec")
    two = right.select(every(ni).alias("i"), own(nj).alias("j"), F.lit(False).alias("left"), "id", "vec")
    return one.unionByName(two)


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def many_top_k(corpus: DataFrame, key: str, vector: str, queries: DataFrame, k: int, metric: str = "cosine", block: int = QUERY_BLOCK, distinct_keys: bool = False, part: int = CORPUS_PART) -> DataFrame:
    """(query, key, distance, rank): the nearest k corpus rows of every query of ``queries`` (query long, vec array).

    Up to ``block`` queries, counted first, travel to the corpus, which is read once and not shuffled. More of them
    meet it in a grid of blocks of queries and parts of the corpus. Either way only k rows of a query leave a part.
    ``distinct_keys``: a query is no neighbour of the row whose key it bears. A query of another length than the
    first one's is left out.
    """
    kind = corpus.schema[key].dataType.simpleString()
    schema = f"query long, {key} {kind}, distance double"
    asked = queries.where(F.exists("vec", lambda x: x != 0)).select("query", "vec")
    first = asked.select(F.size("vec").alias("n")).first()
    if first is None:
        return corpus.sparkSession.createDataFrame([], schema + ", rank int")
    asked = asked.where(F.size("vec") == first["n"])
    rows_of = corpus.where(usable(F.col(vector), first["n"])).select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    made = lambda found: pd.DataFrame({"query": found[0], key: found[1], "distance": found[2]})

    if rows_up_to(asked, block) <= block:
        held = asked.orderBy("query").collect()  # counted: at most ``block`` rows
        ids, q = np.array([r["query"] for r in held]), np.array([r["vec"] for r in held], dtype=np.float64)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for i in range(0, len(batch), 4096):
                    yield made(_nearest(ids, q, batch["id"].to_numpy()[i : i + 4096], stacked(batch["vec"][i : i + 4096]), k, metric, distinct_keys))

        out = rows_of.mapInPandas(run, schema)
    else:

        def meet(pdf: pd.DataFrame) -> pd.DataFrame:
            asks, rows = pdf[pdf["left"]], pdf[~pdf["left"]]
            if not len(asks) or not len(rows):
                return made(([], [], []))
            keys, v = rows["id"].to_numpy(), stacked(rows["vec"])
            found = [_nearest(asks["id"].to_numpy(), stacked(asks["vec"]), keys[i : i + 4096], v[i : i + 4096], k, metric, distinct_keys) for i in range(0, len(rows), 4096)]
            return made(tuple(np.concatenate(x) for x in zip(*found)))

        if kind != "bigint":
            raise TypeError(f"keys of type {kind} need {block} queries at most")
        out = grid(asked.withColumnRenamed("query", "id"), rows_of, block, part).groupBy("i", "j").applyInPandas(meet, schema)
    best = Window.partitionBy("query").orderBy("distance", key)
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def best_per_key(hits: DataFrame, key: str, score: str = "distance", ascending: bool = True) -> DataFrame:
    """One row per key: the hit with the best score, the earlier query at a tie."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    return hits.withColumn("r_", F.row_number().over(Window.partitionBy(key).orderBy(order, "query"))).where("r_ = 1").drop("r_")


def nearest_within(rows: DataFrame, key: str, vector: str, targets: DataFrame, target_key: str, target_vector: str, similarity: float) -> DataFrame:
    """(query, target, distance): each row's nearest target where its similarity (2 - d) / 2 is at least ``similarity``."""
    queries = rows.select(F.col(key).alias("query"), F.col(vector).alias("vec")).where(F.col("vec").isNotNull())
    found = many_top_k(targets, target_key, target_vector, queries, 1)
    return found.where(F.col("distance") <= F.round(F.lit(2 * (1 - similarity)), DIGITS + 3)).select("query", F.col(target_key).alias("target"), "distance")


def decayed(hits: DataFrame, decay: float = 0.3, most: float = 1.4) -> DataFrame:
    """Hits whose distance is stretched by 1 + decay * position of their query in its list, kept below ``most``, with
    the similarity made anew; one row per key."""
    stretched = hits.withColumn("distance", F.round(F.col("distance") * (1 + F.lit(decay) * F.col("position")), DIGITS)).where(F.col("distance") < most)
    return stretched.withColumn("similarity", F.round(V.distance_similarity(F.col("distance")), DIGITS + 1))


def greatest_similarity(columns: list[str], query: list[float]) -> Column:
    """The greatest cosine over several vector columns."""
    scores = [V.cosine(F.col(c), vector_literal(query)) for c in columns]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]
