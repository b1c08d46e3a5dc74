"""Consolidating pairwise matches into groups: alternating large-star and small-star rewrites.

Every record ends up linked to the smallest identifier of its component. Each rewrite is one map-side-combined
minimum per node and one join; the minima of hot nodes are joined by broadcast, and the number of hot nodes is
bounded by arithmetic (a hot node holds at least 1/HOT_SHARE of all edges, so there are fewer than 2 * HOT_SHARE
of them). No neighbour list is ever gathered. Each round is written to the shared folder, so lineage stays short.

Defined results: edges with a null end or with equal ends are dropped; repeated and reversed edges count once; an
empty edge table gives an empty result; records without any edge are in no group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbforge.staging import Stage

HOT_SHARE = 200


def as_fraction(similarity: Column) -> Column:
    """Similarity as a fraction: values above 1 are percentages; NaN and null become null."""
    s = F.when(F.isnan(similarity), None).otherwise(similarity)
    return F.when(s > 1, F.round(s / 100, 12)).otherwise(s)


def match_edges(matches: DataFrame, threshold: float = 0.999) -> DataFrame:
    """(a, b): the pairs that rows of a match table link at ``threshold`` or more; ids that are null or 0 link nothing."""
    linked = (as_fraction(F.col("similarity")) >= threshold) & (F.col("id") != 0) & (F.col("similar_to") != 0) & (F.col("id") != F.col("similar_to"))
    return matches.where(linked).select(F.col("id").alias("a"), F.col("similar_to").alias("b"))


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, m, n): the smallest of each node and its neighbours, and its degree."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))


def _with_minimum(pairs: DataFrame, total: int, scratch: list[Stage]) -> DataFrame:
    """``pairs`` (u, v) with the minimum of u. Hot nodes by a broadcast of bounded size, the rest by shuffle. Stages that
    the result reads are added to ``scratch``."""
    minima = _minimum(pairs)
    least = max(10_000, total // HOT_SHARE)
    if total <= least:
        return pairs.join(minima.select("u", "m"), "u")
    staged = Stage(minima, "minima")
    scratch.append(staged)
    hot = F.broadcast(staged.df.where(F.col("n") >= least).select("u", "m"))
    cold = staged.df.where(F.col("n") < least).select("u", "m")
    warm = pairs.join(hot, "u", "left_anti").join(cold, "u")
    return pairs.join(hot, "u").unionByName(warm)


def _large_star(edges: DataFrame, total: int, scratch: list[Stage]) -> DataFrame:
    """Each node links its larger neighbours to the smallest of all its neighbours and itself."""
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("p")).select("p.u", "p.v")
    found = _with_minimum(both, 2 * total, scratch).where(F.col("v") > F.col("u"))
    return found.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame, total: int, scratch: list[Stage]) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them. Edges run from larger a to smaller b."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    found = _with_minimum(down, total, scratch)
    linked = found.select(F.explode(F.array(F.col("v"), F.col("u"))).alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def _digest(df: DataFrame) -> tuple:
    """Row count and an order-free checksum, to see that a round changed nothing."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 16)).alias("s"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["s"], row["x"]


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(group_id, id) for every node of ``edges`` (a, b long): group_id is the smallest id of its component."""
    simple = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stage = Stage(simple, "edges")
    before = _digest(stage.df)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        scratch: list[Stage] = []
        star = Stage(_large_star(stage.df, before[0], scratch), "large")
        step = Stage(_small_star(star.df, star.df.count(), scratch), "small")
        after = _digest(step.df)
        for done in (*scratch, star, stage):
            done.drop()
        stage = step
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    members = stage.df.select(F.col("b").alias("group_id"), F.col("a").alias("id"))
    roots = stage.df.select(F.col("b").alias("group_id"), F.col("b").alias("id")).distinct()
    return members.unionByName(roots)
