"""Filling fixed-capacity containers: Karmarkar-Karp multiway differencing over blocks of items.

Items over the capacity are divided into full containers and a remainder; the remainders and all other items are
dealt to blocks by a hash, so no block depends on a hot key and each holds about BLOCK items. In a block, partial
partitions with opposing imbalances are merged, the two most unbalanced first, into k windows. Windows that come out
over the capacity are differenced anew with windows that have room. k begins at the least number that could hold the
block and rises while any window is over the capacity. What a block's windows leave open is the only loss against the
whole table, and it is reported by ``fill_report``.

Defined results: a null text is no item, nor is one without an id; an empty text is one token (its end mark); repeated texts are items of
their own; an empty table gives no container.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
BLOCK = 1000
#: Items of two windows up to which every outcome is compared.
COMPLETE = 14
#: How many windows, outcomes and further windows are tried where an overfull window needs two others.
LOOK = 8


def kk_partition(sizes: list[int], k: int) -> list[list[int]]:
    """Items (by index) of each of k windows, by the largest differencing method.

    A partial partition is a list of (sum, items) from large to small, without its empty windows, and every merge
    pairs the largest windows of the one with the smallest of the other. The least sum is subtracted after a merge
    only for the order of merging, so sums stay true.
    """
    if not sizes:
        return [[] for _ in range(k)]
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:  # the smallest ``over`` windows of a meet the smallest of b in opposite order
            at = len(a) - over
            met = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[at:], reversed(b[len(b) - over :]))] if len(b) >= over else None
            merged = a[:at] + b[: len(b) - over] + met
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], serial, merged))
        serial += 1
    out = [list(items) for _, items in heap[0][2]]
    return out + [[] for _ in range(k - len(out))]


@lru_cache
def _signs(n: int) -> np.ndarray:
    """Every way of putting n items on two sides, the first item always on the same."""
    return (np.arange(1 << (n - 1))[:, None] >> np.arange(n)[None, :] & 1).astype(np.int64)


def outcomes(items: list[int], sizes: list[int], capacity: int, most: int = 1) -> list[tuple[list[int], list[int]]]:
    """Ways of differencing ``items`` into two windows of which the first is within the capacity, the nearest to it
    first, so that what room is left stays in one window; at most ``most`` of them. For up to COMPLETE items
    differencing is complete: every outcome of taking each item away or adding it. Beyond that many items it is largest
    differencing, which is then as good as equal."""
    held = np.array([sizes[i] for i in items], dtype=np.int64)
    if len(items) > COMPLETE:
        two = sorted(([items[i] for i in half] for half in kk_partition(held.tolist(), 2)), key=lambda half: sum(sizes[i] for i in half))
        return [tuple(two)] if sum(sizes[i] for i in two[0]) <= capacity else []
    signs = _signs(len(items))
    sums = signs @ held
    sums, signs = np.concatenate((sums, held.sum() - sums)), np.concatenate((signs, 1 - signs))
    fits = np.flatnonzero(sums <= capacity)
    fits = fits[[sums[fits].argmax()]] if most == 1 and len(fits) else fits[np.argsort(-sums[fits], kind="stable")[:most]]
    return [([i for i, x in zip(items, signs[f]) if x], [i for i, x in zip(items, signs[f]) if not x]) for f in fits]


def level(windows: list[list[int]], sizes: list[int], capacity: int) -> bool:
    """Difference the items of an overfull window anew together with those of a window with room, into two windows, or
    with those of two such windows, into three.

    The windows with most room come first. A result is taken if it holds less over the capacity than before, so the
    work ends by itself. True once every window fits, False where no window can take up any of what is over (of three
    windows, the LOOK most promising of each are tried); ``windows`` is changed in place.
    """
    of = lambda items: sum(sizes[i] for i in items)
    total = [of(items) for items in windows]

    def replaced(w: int) -> dict[int, list[int]] | None:
        excess, roomy = total[w] - capacity, sorted((v for v in range(len(windows)) if total[v] < capacity), key=total.__getitem__)
        for v in roomy:
            for one, two in outcomes(windows[w] + windows[v], sizes, capacity):
                if of(two) - capacity < excess:
                    return {w: two, v: one}
        for v in roomy[:LOOK]:
            for one, two in outcomes(windows[w] + windows[v], sizes, capacity, LOOK):
                for u in roomy[: LOOK + 1]:
                    for three, four in outcomes(two + windows[u], sizes, capacity) if u != v else ():
                        if of(four) - capacity < excess:
                            return {w: four, v: one, u: three}
        return None

    while True:
        w = max(range(len(windows)), key=total.__getitem__)
        if total[w] <= capacity:
            return True
        better = replaced(w)
        if better is None:
            return False
        for at, items in better.items():
            windows[at], total[at] = items, of(items)


def fill_windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity`` each; no size may be over it. The count rises until differencing, repeated for
    pairs of windows of which one is overfull, fits. It ends: with one window an item everything fits."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = kk_partition(sizes, k)
        if level(windows, sizes, capacity):
            return [w for w in windows if w]
        k += 1


def pieces(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, n_pieces, tokens): an item within the capacity is one piece, a larger one full pieces and a rest.

    Tokens are those of a byte tokenizer: one per UTF-8 byte and one end mark for the document. Nothing is shuffled.
    """
    tokens = F.octet_length("text").cast("long") + 1
    n = F.ceil(F.col("t") / F.lit(capacity)).cast("long")
    sized = documents.where("text is not null and doc_id is not null").select("doc_id", tokens.alias("t")).withColumn("n_pieces", n)
    cut = sized.select("doc_id", "t", "n_pieces", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)).alias("piece"))
    return cut.select("doc_id", "piece", "n_pieces", F.least(F.lit(capacity).cast("long"), F.col("t") - F.col("piece") * capacity).alias("tokens"))


def pack(documents: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(doc_id, piece, n_pieces, tokens, block, window): the container (block, window) of every piece.

    Full pieces are containers of their own (block -1, told apart by doc_id and piece) and take no part in the
    shuffle, which carries only numbers. The number of blocks follows the number of rows, and that of the tasks the
    number of blocks: the rows are few bytes but much work, so they aren't left to be put together by size.
    """
    cut = pieces(documents, capacity)
    full = cut.where(F.col("tokens") == capacity).select("*", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("window"))
    blocks = max(1, round(documents.count() / block))
    rest = cut.where(F.col("tokens") < capacity).withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(blocks)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "tokens"], ignore_index=True)
        window = np.empty(len(pdf), dtype=np.int64)
        for w, items in enumerate(fill_windows(pdf["tokens"].tolist(), capacity)):
            window[items] = w
        return pdf.assign(window=window)

    schema = "doc_id long, piece long, n_pieces long, tokens long, block long, window long"
    tasks = min(blocks, max(16 * documents.sparkSession.sparkContext.defaultParallelism, -(-blocks // 64)))
    return full.unionByName(rest.repartition(tasks, "block").groupBy("block").applyInPandas(run, schema))


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, pieces, tokens, fill (share of the containers that is used) and the largest container."""
    own = F.when(F.col("block") < 0, F.struct("doc_id", "piece"))
    containers = packed.groupBy("block", "window", own.alias("own")).agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    one = containers.agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("pieces"), F.sum("t").alias("tokens"), F.max("t").alias("largest"))
    return one.select("containers", "pieces", "tokens", (F.col("tokens") / (F.col("containers") * capacity)).alias("fill"), "largest")
