"""Most similar vectors for every vector, by collision counting over single-projection sorted arrays.

Vectors that are exact copies form one class, which is searched once. Every class has a home block (its most similar
centre out of about 2 * sqrt(n), taken from the data by a hash of the id) and visits its PROBES most similar blocks
as a query. Within a block each of PROJECTIONS random directions gives one sorted array of the block's vectors. A
query opens a window around its own projection in every array, counts for each vector the windows it falls into, and
verifies those with at least COLLISIONS. Virtual rehashing widens all windows by the radius schedule until the query
has its k neighbours within the radius or the radius of the least similarity is reached. A pair counts whichever of
the two found it, so it is lost only if both missed it.

Blocks that hold many vectors are cut into parts of at most PART vectors and QUERIES queries, so a dense spot is
spread over tasks and nothing is dropped. Only the block sizes and the centres (both about 2 * sqrt(n)) reach the
driver.

Defined results: only vectors of ``dim`` finite elements that are not all zero count, and rows without an id don't; a vector is no neighbour of
itself; copies are neighbours of similarity 1; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.staging import Stage

PROBES = 12
PROJECTIONS = 28
COLLISIONS = 20
#: Half a window, in standard deviations of the projected difference of two vectors at the radius.
REACH = 1.5
#: The first radius, as a share of the last.
FIRST_RADIUS = 0.45
PART, QUERIES = 4096, 32_768
SEED = 17


def directions(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, m)).astype(np.float32)


def usable(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(id, vec, h1, h2): vectors that count, and a 128-bit key by which exact copies meet."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)
    flat = F.transform(v, lambda x: x + F.lit(0.0).cast("float"))  # -0 becomes 0
    return df.where(v.isNotNull() & F.col(key).isNotNull()).where(ok).select(F.col(key).alias("id"), flat.alias("vec")).select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(SEED)).alias("h2"))


def centres(rows: DataFrame, n: int) -> np.ndarray:
    """About 2 * sqrt(n) unit vectors from the data, distinct, the same each time."""
    want = max(1, math.ceil(2 * math.sqrt(n)))
    held = rows.select("vec", F.xxhash64("id", F.lit(SEED)).alias("o"), "id").orderBy("o", "id").limit(2 * want).select("vec").collect()
    found = np.unique(np.array([r["vec"] for r in held], dtype=np.float32), axis=0)
    found = found[np.random.default_rng(SEED).permutation(len(found))[:want]].astype(np.float64)
    return (found / np.linalg.norm(found, axis=1, keepdims=True)).astype(np.float32)


def _assign(classes: DataFrame, middle: np.ndarray, probes: int) -> DataFrame:
    """(rep, n, h1, h2, raw, cells): the vector as bytes, and its blocks from the most similar on."""
    top = min(probes, len(middle))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 2048):
                part = batch.iloc[i : i + 2048]
                v = np.stack(part["vec"].to_numpy()).astype(np.float64)
                unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
                near = unit @ middle.T
                cells = np.argpartition(-near, top - 1, axis=1)[:, :top]
                cells = np.take_along_axis(cells, np.argsort(-np.take_along_axis(near, cells, 1), axis=1, kind="stable"), 1)
                yield part[["rep", "n", "h1", "h2"]].assign(raw=[np.asarray(x, dtype=np.float32).tobytes() for x in part["vec"]], cells=list(cells.astype(np.int32)))

    return classes.mapInPandas(run, "rep long, n long, h1 long, h2 long, raw binary, cells array<int>")


def count_collisions(sorted_values: np.ndarray, ranks: np.ndarray, at: np.ndarray, half: float) -> np.ndarray:
    """How many of the windows of each query hold each vector. ``sorted_values``: (m, d), one sorted array per
    direction; ``ranks``: (m, d), each vector's place in it; ``at``: (q, m), the queries' own projections."""
    counts = np.zeros((len(at), ranks.shape[1]), dtype=np.uint8)
    for j in range(len(ranks)):
        low = np.searchsorted(sorted_values[j], at[:, j] - half, side="left").astype(np.uint16)
        high = np.searchsorted(sorted_values[j], at[:, j] + half, side="right").astype(np.uint16)
        counts += (ranks[j][None, :] - low[:, None]) < (high - low)[:, None]
    return counts


def search_block(data: np.ndarray, data_ids: np.ndarray, query: np.ndarray, query_ids: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, similarity) of each query's best k vectors of the block with at least ``least``."""
    a = directions(data.shape[1])
    projected, at = data.astype(np.float32) @ a, query.astype(np.float32) @ a
    order = np.argsort(projected, axis=0, kind="stable").T
    sorted_values = np.take_along_axis(projected.T, order, 1)
    ranks = np.empty(order.shape, dtype=np.uint16)
    np.put_along_axis(ranks, order, np.arange(len(data), dtype=np.uint16)[None, :], 1)
    last = math.sqrt(max(2 - 2 * least, 1e-9))
    found = []
    step = max(1, 2_000_000 // max(1, len(data)))
    for i in range(0, len(query), step):
        waiting = np.arange(i, min(i + step, len(query)))
        for radius in (last * FIRST_RADIUS, last):
            counts = count_collisions(sorted_values, ranks, at[waiting], REACH * radius)
            q, d = np.nonzero(counts >= COLLISIONS)
            q = waiting[q]
            other = query_ids[q] != data_ids[d]
            q, d = q[other], d[other]
            cos = np.einsum("ij,ij->i", query[q], data[d])
            if radius < last:
                inside = np.bincount(q[cos >= 1 - radius**2 / 2], minlength=len(query))[waiting] >= k
                kept = np.isin(q, waiting[inside]) & (cos >= least)
                waiting = waiting[~inside]
            else:
                kept = cos >= least
            found.append((q[kept], d[kept], cos[kept]))
            if not len(waiting):
                break
    q, d, cos = (np.concatenate(x) for x in zip(*found))
    best = np.lexsort((data_ids[d], -cos, q))
    q, d, cos = q[best], d[best], cos[best]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, dtype=np.int64)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    top = place < k
    return query_ids[q[top]], data_ids[d[top]], cos[top]


def _candidates(staged: DataFrame, dim: int, k: int, least: float) -> DataFrame:
    """(a, b, cos) of classes, both ways round, at most k from each visited block."""
    visits = staged.select("rep", "raw", F.posexplode("cells").alias("place", "cell")).withColumn("home", F.col("place") == 0).drop("place")
    sizes = staged.select(F.posexplode("cells").alias("place", "cell")).groupBy("cell").agg(F.count_if(F.col("place") == 0).alias("d"), F.count(F.lit(1)).alias("q"))
    large = sizes.where((F.col("d") > PART) | (F.col("q") > QUERIES))  # fewer rows than there are centres
    large = large.select("cell", F.ceil(F.col("d") / PART).cast("int").alias("nd"), F.ceil(F.col("q") / QUERIES).cast("int").alias("nq"))
    one = F.lit(1)
    split = visits.join(F.broadcast(large), "cell", "left").withColumns({"nd": F.greatest(F.coalesce("nd", one), one), "nq": F.greatest(F.coalesce("nq", one), one)})
    spot = F.xxhash64("rep")
    roles = split.withColumns({"dp": F.pmod(spot, F.col("nd")).cast("int"), "qp": F.pmod(F.shiftright(spot, 20), F.col("nq")).cast("int")})
    every = F.explode(
        F.filter(
            F.flatten(F.transform(F.sequence(F.lit(0), F.col("nd") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.col("nq") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"), (F.col("home") & (i == F.col("dp"))).alias("data"), (j == F.col("qp")).alias("query"))))),
            lambda x: x["data"] | x["query"],
        )
    )
    routed = roles.select("cell", "rep", "raw", every.alias("x")).select("cell", F.col("x.i").alias("i"), F.col("x.j").alias("j"), "rep", "raw", F.col("x.data").alias("data"), F.col("x.query").alias("query"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.frombuffer(b"".join(pdf["raw"]), dtype=np.float32).reshape(-1, dim).astype(np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        ids, data, query = pdf["rep"].to_numpy(), pdf["data"].to_numpy(dtype=bool), pdf["query"].to_numpy(dtype=bool)
        if not data.any() or not query.any():
            return pd.DataFrame({"a": [], "b": [], "cos": []})
        q, d, cos = search_block(v[data], ids[data], v[query], ids[query], k, least)
        return pd.DataFrame({"a": np.concatenate((q, d)), "b": np.concatenate((d, q)), "cos": np.concatenate((cos, cos))})

    return routed.groupBy("cell", "i", "j").applyInPandas(run, "a long, b long, cos double")


def similar_pairs(df: DataFrame, key: str, vector: str, dim: int = 64, k: int = 5, least: float = 0.85, probes: int = PROBES) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs of at least ``least`` of which one is among the other's k most similar."""
    rows = usable(df, key, vector, dim)
    n = rows.count()
    if n == 0:
        return df.sparkSession.createDataFrame([], "id_a long, id_b long")
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
    staged = Stage(_assign(classes, centres(rows, n), probes), "vectors").df

    best = Window.partitionBy("a").orderBy(F.col("cos").desc(), "b")
    found = _candidates(staged, dim, k, least).withColumn("r", F.row_number().over(best)).where(F.col("r") <= 2 * k).drop("r")
    found = found.dropDuplicates(["a", "b"]).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")

    # Classes of several vectors: their first k + 1 ids stand for all, since ties go to the smaller id.
    several = staged.where("n > 1").select("h1", "h2", "rep", "n")
    member = rows.select("id", "h1", "h2").join(several, ["h1", "h2"]).select("id", "rep", "n")
    by_id = Window.partitionBy("rep").orderBy("id")
    firsts = member.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1).groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.max("n").alias("n"))
    within = member.join(firsts.select("rep", "ids"), "rep").select("id", F.explode(F.slice(F.filter("ids", lambda y: y != F.col("id")), 1, k)).alias("y"))

    a_side, b_side = firsts.select(F.col("rep").alias("a"), F.col("ids").alias("ids_a"), F.col("n").alias("n_a")), firsts.select(F.col("rep").alias("b"), F.col("ids").alias("ids_b"))
    open_ = found.join(a_side, "a", "left").join(b_side, "b", "left").withColumn("room", k + 1 - F.coalesce("n_a", F.lit(1).cast("long"))).where("room > 0")
    spread = open_.select("a", "cos", "room", F.coalesce("ids_a", F.array("a")).alias("ids_a"), F.explode(F.slice(F.coalesce("ids_b", F.array("b")), 1, k)).alias("y"))
    ranked = spread.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.col("cos").desc(), "y"))).where("r <= room")
    across = ranked.select(F.explode("ids_a").alias("id"), "y")
    return within.unionByName(across).select(F.least("id", "y").alias("id_a"), F.greatest("id", "y").alias("id_b")).distinct()
