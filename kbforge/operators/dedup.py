"""Greedy leaders among near duplicates, absorption of one table into another, and the merge rule for two records.

The leader rule is sequential: in id order a row that nobody has marked becomes a leader and marks every later
unmarked row near it. That is the lexicographically first maximal independent set of the candidate graph, which is
resolved in rounds of joins: a row is a leader once all its smaller neighbours are known not to be, and a follower
once one of them is. Each round is written to the shared folder; nothing is collected.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.functions import scalars
from kbforge.operators import search
from kbforge.staging import Stage, broadcast_if_small, rows_up_to

SIMILARITY = 0.999
BANDS, BAND_BITS = 24, 12
CELL = 2048


def _signs(dim: int, bands: int, bits: int) -> np.ndarray:
    return np.random.default_rng(23).standard_normal((dim, bands * bits))


def near_pairs(df: DataFrame, key: str, vector: str, dim: int, least_cosine: float, exact: bool = False, bands: int = BANDS, bits: int = BAND_BITS) -> DataFrame:
    """(a, b, cosine), a < b: pairs of at least ``least_cosine``.

    Candidates share one of ``bands`` signatures of ``bits`` hyperplane signs; at the default similarity (cosine
    0.998, an angle under 4 degrees) a pair shares a given signature with probability 0.76, so it is missed with
    probability below 1e-14. ``exact`` compares blocks of rows with blocks instead, for low thresholds and small
    tables. Exact copies are one class in the signatures and are linked to their smallest id only.
    """
    rows = df.where(search.usable(F.col(vector), dim)).select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    if exact:
        return _blocked_pairs(rows, least_cosine)
    classes = rows.groupBy("vec").agg(F.min("id").alias("id"))
    copies = rows.join(classes.withColumnRenamed("id", "a"), "vec").where("id <> a").select("a", F.col("id").alias("b"), F.lit(1.0).alias("cosine"))
    signs = _signs(dim, bands, bits)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            v = np.stack(batch["vec"].to_numpy()).astype(np.float64)
            code = ((v @ signs).reshape(len(v), bands, bits) > 0) @ weights
            yield pd.DataFrame({"id": batch["id"], "vec": batch["vec"], "codes": list(code.astype(np.int64))})

    signed = classes.mapInPandas(sign, "id long, vec array<float>, codes array<long>")
    spread = signed.select("id", "vec", F.posexplode("codes").alias("band", "code"))
    sized = spread.groupBy("band", "code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    held = spread.join(sized, ["band", "code"]).withColumn("parts", F.ceil(F.col("n") / CELL).cast("int"))
    own = held.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # a hot bucket is cut into parts; a row visits every pair of parts that holds its own
    meets = own.select("band", "code", "id", "vec", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = meets.select("band", "code", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "vec", "own")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        v = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        ids, own, cross = pdf["id"].to_numpy(), pdf["own"].to_numpy(), pdf["i"].iloc[0] != pdf["j"].iloc[0]
        out = []
        for s in range(0, len(v), 1024):
            c = v[s : s + 1024] @ v[s:].T
            a, b = np.nonzero(c >= least_cosine)
            ok = a < b
            if cross:
                ok &= own[a + s] != own[b + s]
            out.append(pd.DataFrame({"a": ids[a[ok] + s], "b": ids[b[ok] + s], "cosine": c[a[ok], b[ok]]}))
        return pd.concat(out, ignore_index=True)

    found = met.groupBy("band", "code", "i", "j").applyInPandas(compare, "a long, b long, cosine double").groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    return found.unionByName(copies)


def _blocked_pairs(rows: DataFrame, least_cosine: float, part: int = CELL) -> DataFrame:
    """All rows against all in a grid of parts. A pair is found in the meeting of its parts that holds the smaller id on
    the left."""

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["left"]], pdf[~pdf["left"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "cosine": []})
        v, w = search.stacked(left["vec"]), search.stacked(right["vec"])
        c = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ (w / np.linalg.norm(w, axis=1, keepdims=True)).T
        one, two = left["id"].to_numpy(), right["id"].to_numpy()
        a, b = np.nonzero((c >= least_cosine) & (one[:, None] < two[None, :]))
        return pd.DataFrame({"a": one[a], "b": two[b], "cosine": c[a, b]})

    return search.grid(rows, rows, part, part).groupBy("i", "j").applyInPandas(meet, "a long, b long, cosine double")


def _check_rounds(done: int, most: int | None) -> None:
    if most is not None and done >= most:
        raise RuntimeError(f"leaders did not settle in {most} rounds")


#: Pairs of open rows up to which one task settles them (about 40 MB).
SETTLE = 1_000_000


def greedy_leaders(pairs: DataFrame, most_rounds: int | None = None, settle: int = SETTLE) -> DataFrame:
    """(id, similar_to, cosine) of every follower: its smallest leader among its smaller neighbours.

    ``pairs``: (a, b, cosine), a < b. Rows without a pair are leaders of themselves and don't appear. The smallest open
    id is settled in every round, so the rounds end. Once the open rows have no more than ``settle`` pairs, counted, one
    task takes the rows in order. With ``most_rounds`` there are rounds only, and it is an error if rows are open after
    them.
    """
    edges = Stage(pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine")), "pairs").df
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    smaller = edges.select("b").distinct()
    state = Stage(nodes.join(smaller, nodes["id"] == smaller["b"], "left").select("id", F.when(F.col("b").isNull(), True).alias("leads")), "state")

    def in_order(pdf: pd.DataFrame) -> pd.DataFrame:
        leads = {int(a): bool(up) for a, up in zip(pdf["a"], pdf["up"]) if up is not None and up == up}
        out = {}
        for b, before in pdf.sort_values("b").groupby("b", sort=True)["a"]:
            leads[int(b)] = out[int(b)] = not any(leads[int(a)] for a in before)
        return pd.DataFrame({"id": list(out), "leads": list(out.values())})

    for done in itertools.count():
        if state.df.where("leads is null").isEmpty():
            break
        _check_rounds(done, most_rounds)
        open_ = state.df.where("leads is null").select(F.col("id").alias("b"))
        waiting = Stage(edges.select("a", "b").join(open_, "b", "left_semi").join(state.df.select(F.col("id").alias("a"), F.col("leads").alias("up")), "a"), "waiting")
        if most_rounds is None and rows_up_to(waiting.df, settle) <= settle:
            found = waiting.df.groupBy().applyInPandas(in_order, "id long, leads boolean")
            nxt = Stage(state.df.where("leads is not null").unionByName(found), "state")
        else:
            seen = waiting.df.groupBy("b").agg(F.max((F.col("up") == True).cast("int")).alias("some"), F.max(F.col("up").isNull().cast("int")).alias("open"))  # noqa: E712
            step = state.df.join(seen, state.df["id"] == seen["b"], "left")
            nxt = Stage(step.select("id", F.coalesce("leads", F.when(F.col("some") == 1, False).when(F.col("open") == 0, True)).alias("leads")), "state")
        state.drop()
        waiting.drop()
        state = nxt
    leaders = state.df.where("leads").select(F.col("id").alias("a"))
    followers = state.df.where("not leads").select(F.col("id").alias("b"))
    led = edges.join(leaders, "a").join(followers, "b")
    return led.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("similar_to"), F.min_by("cosine", "a").alias("cosine"))


#: Rows of an average bucket, and the share of near pairs that may share no bucket.
BUCKET, MISSED = 256, 1e-6
#: Rows that one call of a Python function is given: many small buckets together, or one cut of a hot bucket.
ROWS_A_CALL = 20_000
#: Hot buckets up to which their sizes are broadcast; beyond it the join shuffles.
MOST_HOT = 100_000


def signature_plan(rows: int, least_cosine: float, bits: int | None = None, missed: float = MISSED) -> tuple[int, int]:
    """(bands, bits): as many bits that a bucket holds about BUCKET of evenly spread rows, so that the comparisons of a row
    grow as the logarithm of ``rows``, and as many bands that a pair at ``least_cosine`` shares none of them with a
    probability of at most ``missed``."""
    bits = bits or max(4, round(math.log2(max(rows, 1) / BUCKET)))
    same = (1 - math.acos(min(1.0, least_cosine)) / math.pi) ** bits
    return (1 if same >= 1 else max(4, math.ceil(math.log(missed) / math.log1p(-same)))), bits


def _spread(rows: DataFrame) -> DataFrame:
    """(id, raw, band, code): each row in each of its buckets."""
    return rows.select("id", "raw", F.posexplode("codes").alias("band", "code"))


def _by_bucket(rows: DataFrame, keys: list[str], work, schema: str, total: int) -> DataFrame:
    """``work`` applied to each group of ``keys``, many small groups in one call. ``work`` gets a frame and returns
    arrays in the order of ``schema``; ``total``: about how many rows there are."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(keys, ignore_index=True)
        codes = pdf[keys].to_numpy()
        start = np.append(np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(1))), len(pdf))
        ids, raw = pdf["id"].to_numpy(), pdf["raw"].to_numpy()
        leads = pdf["leads"].to_numpy(dtype=bool) if "leads" in pdf else None
        made = [work(ids[a:b], _units(raw[a:b]), None if leads is None else leads[a:b]) for a, b in zip(start, start[1:]) if b - a > 1]
        made = [m for m in made if len(m[0])]
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*made))} if made else {n: [] for n in names})

    calls = max(1, -(-total // ROWS_A_CALL))
    return rows.withColumn("call_", F.pmod(F.xxhash64(*keys), F.lit(calls))).groupBy("call_").applyInPandas(run, schema)


def _units(raw: np.ndarray) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1).astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _nearest_leader(leaders: DataFrame, others: DataFrame, least_cosine: float, part: int, bands: int) -> DataFrame:
    """(id, leader, cosine): for each of ``others`` (id, raw, codes) its smallest leader before it, found in any bucket.

    A bucket that holds more than ``part`` of either side is cut into parts by a hash; every part of the one meets every
    part of the other, and each meeting gives at most one row per row of ``others``, so a hot bucket is spread and its
    pairs are never written.
    """
    buckets = ["band", "code"]
    n_led, n_rest = leaders.count(), others.count()
    led, rest = _spread(leaders).withColumn("leads", F.lit(True)), _spread(others).withColumn("leads", F.lit(False))
    both = led.unionByName(rest)
    if max(n_led, n_rest) > part:
        parts = lambda own: F.ceil(F.count_if(own) / part).cast("int")
        sizes = both.groupBy(*buckets).agg(parts(F.col("leads")).alias("nl"), parts(~F.col("leads")).alias("nr")).where("nl > 1 or nr > 1")
        both = both.join(broadcast_if_small(Stage(sizes, "sizes").df, MOST_HOT), buckets, "left")
    else:
        both = both.withColumns({"nl": F.lit(1), "nr": F.lit(1)})
    count = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))
    own = lambda n: F.array(F.pmod(F.xxhash64("id"), n).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    met = both.select(*buckets, F.explode(F.when(F.col("leads"), own(count("nl"))).otherwise(every(count("nl")))).alias("i"), "nr", "leads", "id", "raw")
    met = met.select(*buckets, "i", F.explode(F.when(F.col("leads"), every(count("nr"))).otherwise(own(count("nr")))).alias("j"), "leads", "id", "raw")

    def meet(ids: np.ndarray, v: np.ndarray, leads: np.ndarray) -> tuple:
        order = np.flatnonzero(leads)
        order = order[np.argsort(ids[order], kind="stable")]
        other, out = np.flatnonzero(~leads), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for s in range(0, len(other) if len(order) else 0, 1024):
            rows = other[s : s + 1024]
            c = v[rows] @ v[order].T
            near = (c >= least_cosine) & (ids[order][None, :] < ids[rows][:, None])
            first = near.argmax(1)  # leaders are in order, so the first is the smallest
            hit = near[np.arange(len(rows)), first]
            out.append((ids[rows[hit]], ids[order[first[hit]]], c[np.arange(len(rows)), first][hit]))
        return tuple(np.concatenate(x) for x in zip(*out))

    found = _by_bucket(met, [*buckets, "i", "j"], meet, "id long, leader long, cosine double", (n_led + n_rest) * bands)
    return found.groupBy("id").agg(F.min("leader").alias("leader"), F.min_by("cosine", "leader").alias("cosine"))


def _heads(open_: DataFrame, rows_left: int, head: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows in their buckets, those of hot buckets only as far as their ``head`` smallest ids; (id, cut, beyond) of the
    rows of hot buckets: all of them are cut, and some lie beyond a head). None where no bucket is hot."""
    spread, buckets = _spread(open_), ["band", "code"]
    if rows_left <= head:
        return spread, None
    hot = Stage(spread.groupBy(*buckets).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > head).select(*buckets), "hot").df
    known = broadcast_if_small(hot, MOST_HOT)
    if hot.isEmpty():
        return spread, None
    order = Window.partitionBy(*buckets).orderBy("id")
    ranked = spread.select("id", *buckets).join(known, buckets, "left_semi").withColumn("r", F.row_number().over(order)).where(F.col("r") <= head)
    edge = Stage(ranked.groupBy(*buckets).agg(F.max("id").alias("last")), "edges").df
    held = spread.join(broadcast_if_small(edge, MOST_HOT), buckets, "left")
    places = held.where("last is not null").groupBy("id").agg(F.lit(True).alias("cut"), F.max(F.col("id") > F.col("last")).alias("beyond"))
    return held.where("last is null or id <= last").drop("last"), places


def greedy_followers(df: DataFrame, key: str, vector: str, dim: int, least_cosine: float, bits: int | None = None, head: int = CELL, most_rounds: int | None = None) -> DataFrame:
    """(id, similar_to, cosine) of every follower under the sequential leader rule, without a graph of pairs.

    In each round the ``head`` smallest open ids of every bucket are compared among themselves. A row that is in the
    head of all its buckets and has no smaller open row near it leads; rows near a leader and after it are closed.
    The smallest open id always leads, so every round gets on and the rounds end; with ``most_rounds`` it is an error if
    rows are open after them. When at most ``head`` rows are open, one task settles them. At the end each follower is given its smallest leader.
    Exact copies are one class, since they share their fate. Pairs are never written, only one row per row and bucket.
    """
    rows = df.where(F.col(key).isNotNull() & search.usable(F.col(vector), dim)).select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    classes = rows.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    bands, bits = signature_plan(rows.count(), least_cosine, bits)
    signs = _signs(dim, bands, bits)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            v = np.stack(batch["vec"].to_numpy()).astype(np.float32) if len(batch) else np.empty((0, dim), np.float32)
            code = ((v.astype(np.float64) @ signs).reshape(len(batch), bands, bits) > 0) @ weights
            yield pd.DataFrame({"id": batch["id"], "raw": [x.tobytes() for x in v], "codes": list(code.astype(np.int64))})

    signed = Stage(classes.select(F.col("rep").alias("id"), "vec").mapInPandas(sign, "id long, raw binary, codes array<long>"), "signed").df

    def neighbours(ids: np.ndarray, v: np.ndarray, _) -> tuple:
        order = np.argsort(ids, kind="stable")
        before, after = np.zeros(len(ids), dtype=bool), np.zeros(len(ids), dtype=bool)
        for s in range(0, len(ids), 1024):
            rows = order[s : s + 1024]
            c = v[rows] @ v[order].T >= least_cosine
            places = np.arange(s, s + len(rows))[:, None]
            before[rows] = (c & (np.arange(len(ids))[None, :] < places)).any(1)
            after[rows] = (c & (np.arange(len(ids))[None, :] > places)).any(1)
        some = before | after
        return ids[some], before[some], after[some]

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        near = (v := _units(pdf["raw"].to_numpy())) @ v.T >= least_cosine
        leads = np.zeros(len(pdf), dtype=bool)
        for i in range(len(pdf)):
            leads[i] = not near[i, :i][leads[:i]].any()
        return pdf.assign(leads=leads)

    open_, leaders, closed = signed, [], []
    no = F.lit(False)
    for rounds in itertools.count():
        rows_left = open_.count()
        if rows_left == 0:
            break
        _check_rounds(rounds, most_rounds)
        if rounds and rows_left <= head:  # few enough for the rule as it stands; none is near a leader of before
            settled = Stage(open_.groupBy().applyInPandas(settle, "id long, raw binary, codes array<long>, leads boolean"), "settled").df
            leaders.append(settled.where("leads").drop("leads"))
            closed.append(settled.where("not leads").drop("leads"))
            break
        heads, places = _heads(open_, rows_left, head)
        tested = _by_bucket(heads.select("band", "code", "id", "raw"), ["band", "code"], neighbours, "id long, before boolean, after boolean", rows_left * bands)
        verdict = tested.groupBy("id").agg(F.max("before").alias("before"), F.max("after").alias("after"))
        if places is None:
            verdict = verdict.withColumn("unknown", no)
        else:
            verdict = verdict.join(places, "id", "full").select("id", F.coalesce("before", no).alias("before"), (F.coalesce("after", no) | F.coalesce("cut", no)).alias("after"), F.coalesce("beyond", no).alias("unknown"))
        state = Stage(verdict, "state")
        waiting = Stage(open_.join(state.df.where("before or unknown").select("id"), "id", "left_semi"), "waiting")
        if not leaders:  # while all rows are open, one without any neighbour leads nobody and leaves
            leading = open_.join(state.df.where("not before and not unknown and after").select("id"), "id", "left_semi")
        else:  # later on it may yet be the smallest leader of a row that is closed already
            leading = open_.join(waiting.df.select("id"), "id", "left_anti")
        led = Stage(leading, "leaders")
        leaders.append(led.df)
        near = Stage(_nearest_leader(led.df, waiting.df, least_cosine, head, bands).select("id"), "near")
        open_ = Stage(waiting.df.join(near.df, "id", "left_anti"), "open").df
        closed.append(Stage(waiting.df.join(near.df, "id", "left_semi"), "closed").df)
        for done in (waiting, state, near):
            done.drop()
    if not leaders:
        return signed.select("id", F.col("id").alias("similar_to"), F.lit(1.0).alias("cosine")).limit(0)
    every = lambda parts: reduce(DataFrame.unionByName, parts)
    found = _nearest_leader(every(leaders), every(closed), least_cosine, head, bands)
    final = Stage(found.select("id", F.col("leader").alias("similar_to"), "cosine"), "followers").df
    copies = rows.join(classes.where("n > 1").select("vec", "rep"), "vec").where("id <> rep").select("id", "rep")
    joined = copies.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    return final.unionByName(joined.select("id", F.coalesce("similar_to", "rep").alias("similar_to"), F.coalesce("cosine", F.lit(1.0)).alias("cosine")))


def mark(table: DataFrame, followers: DataFrame, key: str = "id") -> DataFrame:
    """``table`` with ``similarity`` ((1 + cosine) / 2) and ``similar_to`` (null: unmarked, since an id may be 0)."""
    marks = followers.select(F.col("id").alias(key), F.round((1 + F.col("cosine")) / 2, 6).alias("similarity"), "similar_to")
    return table.drop("similarity", "similar_to").join(marks, key, "left")


def unmark(table: DataFrame) -> DataFrame:
    """``table`` with all marks taken off."""
    return table.withColumns({"similarity": F.lit(None).cast("double"), "similar_to": F.lit(None).cast("long")})


#: Columns that come with the picture of a record, its captions, its maps (of map type, or JSON objects as text).
PICTURE = ("url", "origin_width", "origin_height", "origin_storage_id", "processed_storage_id", "processed_width", "processed_height", "aspect_ratio", "vector")
CAPTIONS, MAPS, TIMES = ("caption", "caption_long"), ("exif", "meta"), ("created_at", "updated_at")


def _area(width: Column, height: Column) -> Column:
    return F.coalesce(width * height, F.lit(0))


def _as_map(column: Column, kind: str) -> Column:
    return F.from_json(column, "map<string,variant>") if kind == "string" else column


def merged_record(source: str, kinds: dict[str, str]) -> dict[str, Column]:
    """The columns of a target row (t) merged with what was folded of its source rows (s), of those in ``kinds`` (name
    to type): the larger picture gives address, sizes, storage and vector (the target at a tie), captions are the
    target's where it has one, maps are united with the target winning, sources are united, times span both."""
    s, t = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"t.{c}"))
    keep = _area(t("origin_width"), t("origin_height")) >= _area(s("origin_width"), s("origin_height"))
    out = {c: F.when(keep, t(c)).otherwise(s(c)) for c in PICTURE if c in kinds}
    out |= {c: scalars.or_default(t(c), s(c)) for c in CAPTIONS if c in kinds}
    for c in (c for c in MAPS if c in kinds):
        both = map_union(s(c), _as_map(t(c), kinds[c]), "map<string,variant>" if kinds[c] == "string" else kinds[c])
        # nothing to add, or a text that is no object: the target's stays
        stays = s(c).isNull() | (t(c).isNotNull() & _as_map(t(c), kinds[c]).isNull() & (t(c) != "")) if kinds[c] == "string" else s(c).isNull()
        out[c] = F.when(stays, t(c)).otherwise(F.to_json(both) if kinds[c] == "string" else both)
    out["source"] = F.sort_array(F.array_union(F.coalesce(t("source"), F.array().cast("array<string>")), scalars.expand_source(F.lit(source))))
    return out | {"created_at": F.least(t("created_at"), s("created_at")), "updated_at": F.greatest(t("updated_at"), s("updated_at"))}


def _fold(linked: DataFrame, by: list[str], kinds: dict[str, str]) -> DataFrame:
    """One row per ``by`` of its source rows, as merging them one by one in id order leaves it: the largest picture, the
    first caption, the first value of each key of a map, the span of the times. Partial aggregates, so that a hot
    target is spread."""
    has = lambda names: [c for c in names if c in kinds]
    rank = F.struct(_area(F.col("origin_width"), F.col("origin_height")).alias("area"), (-F.col("id")).alias("i"))
    first = lambda c: F.coalesce(F.min_by(c, F.when(F.col(c) != "", F.col("id"))), F.max_by(c, "id")).alias(c)
    out = linked.groupBy(*by).agg(F.max_by(F.struct(*has(PICTURE)), rank).alias("picture"), *[first(c) for c in has(CAPTIONS)], F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    out = out.select(*by, "picture.*", *has(CAPTIONS), *TIMES)
    for c in has(MAPS):
        entries = linked.select(*by, "id", F.explode(_as_map(F.col(c), kinds[c])).alias("key", "value")).groupBy(*by, "key").agg(F.min_by("value", "id").alias("value"))
        out = out.join(entries.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(c)), by, "left")
    return out


def _with_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in df.columns])


def _merged(rows: DataFrame, folded: DataFrame, into: str, name: str, kinds: dict[str, str]) -> DataFrame:
    """``rows`` with what was folded for them merged in; a row for which there is nothing stays as it is."""
    columns, is_hit = merged_record(name, kinds), F.col(f"s.{into}").isNotNull()
    rows = _with_columns(rows, kinds)
    joined = rows.alias("t").join(folded.alias("s"), F.col("t.id") == F.col(f"s.{into}"), "left")
    return joined.select(*[F.when(is_hit, columns[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in columns else F.col(f"t.{c}") for c in rows.columns])


def placement(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, into, fresh) of each source row that isn't inserted: the row it merges into, a target or (``fresh``) a source
    row inserted before it.

    The leader rule with the target rows as leaders that are there already: a row linked to a target never leads; of
    the others one leads if no smaller row linked to it does. Each of the rest goes to the most similar of its targets
    and smaller leaders (a target, then the smaller id, at a tie).
    """
    targets = links.groupBy("id", "target_id").agg(F.max("similarity").alias("similarity"))
    linked = targets.select("id").distinct()
    without = lambda df, ids, end: df.join(ids.withColumnRenamed("id", end), end, "left_anti")
    edges = Stage(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").groupBy("a", "b").agg(F.max("similarity").alias("similarity")), "edges").df
    free = without(without(edges, linked, "a"), linked, "b").withColumnRenamed("similarity", "cosine")
    followers = greedy_leaders(free).select("id")
    fresh = without(edges, linked.unionByName(followers), "a").select(F.col("b").alias("id"), F.col("a").alias("into"), F.lit(True).alias("fresh"), "similarity")
    every = fresh.unionByName(targets.select("id", F.col("target_id").alias("into"), F.lit(False).alias("fresh"), "similarity"))
    order = F.struct("similarity", (~F.col("fresh")).alias("old"), (-F.col("into")).alias("i"))
    return every.groupBy("id").agg(F.max_by(F.struct("into", "fresh"), order).alias("x")).select("id", "x.*")


def absorb(source: DataFrame, target: DataFrame, links: DataFrame, pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(updated target, rows to add) after absorbing the source as if row by row in id order: a row merges into the
    target row it is linked to, or into a row added before it, else it is added.

    ``links``: (id, target_id, similarity), ``pairs``: (a, b, similarity) between source rows. All source rows of one
    target merge, folded field by field. Rows to add have all columns of the source and keep their source id; the
    store gives them ids of its own. Links are as given: a picture that a merge puts in place isn't matched anew.
    """
    merged = {*PICTURE, *CAPTIONS, *MAPS, *TIMES}
    kinds = {c: k for c, k in [*target.dtypes, *source.dtypes] if c in merged}
    ids, there = source.select("id"), target.select(F.col("id").alias("target_id"))
    end = lambda c: ids.withColumnRenamed("id", c)
    placed = Stage(placement(links.join(there, "target_id", "left_semi").join(ids, "id", "left_semi"), pairs.join(end("a"), "a", "left_semi").join(end("b"), "b", "left_semi")), "placed").df
    folded = _fold(_with_columns(source, kinds).join(placed, "id"), ["fresh", "into"], kinds)
    added = source.withColumn("source", scalars.expand_source(F.lit(name))).join(placed, "id", "left_anti")
    updated = _merged(target, folded.where("not fresh"), "into", name, kinds)
    return updated, _merged(added, folded.where("fresh"), "into", name, kinds)


def map_union(a: Column, b: Column, kind: str = "map<string,string>") -> Column:
    """Union of two maps, the right one winning, whatever the session says about repeated keys; null counts as empty."""
    empty = F.create_map().cast(kind)
    left, right = F.coalesce(a, empty), F.coalesce(b, empty)
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)
