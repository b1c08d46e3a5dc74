import datetime
import hashlib
import inspect
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from kbforge.operators import bm25, dedup, export, hybrid, search, store, tables
from kbforge.providers import HashEmbedder, expand_query, normalise_queries, pooled
from kbforge.streaming import pending


def vectors(n, dim=8, seed=0):
    return np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)


def frame(spark, v, key="id"):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], f"{key} long, vector array<float>")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_many_top_k(spark, metric):
    v = vectors(120)
    v[7] = v[3]
    df = frame(spark, v).unionByName(spark.createDataFrame([(500, None), (501, [0.0] * 8), (502, [1.0])], "id long, vector array<float>"))
    queries = df.where("id < 9").select(F.col("id").alias("query"), F.col("vector").alias("vec"))
    found = search.many_top_k(df, "id", "vector", queries, 4, metric, block=4)
    w = v.astype(float)
    for q in range(9):
        if metric == "cosine":
            d = 1 - w @ w[q] / (np.linalg.norm(w, axis=1) * np.linalg.norm(w[q]))
        else:
            d = np.linalg.norm(w - w[q], axis=1)
        best = np.lexsort((np.arange(120), np.round(d, 6)))[:4]
        assert [r["id"] for r in found.where(F.col("query") == q).orderBy("rank").collect()] == best.tolist()
    assert search.many_top_k(df.limit(0), "id", "vector", queries, 4).count() == 0
    assert search.many_top_k(df, "id", "vector", queries.limit(0), 4).count() == 0
    single = search.top_k(df, "id", "vector", v[0].tolist(), 4, metric).collect()
    assert [r["id"] for r in single] == [r["id"] for r in found.where("query = 0").orderBy("rank").collect()]


def test_bm25(spark):
    docs = ["the old harbour", "harbour harbour bridge", "", None, "a bridge over the river", "nothing"]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    toks = [re.findall("[a-z0-9]+", (d or "").lower()) for d in docs]
    avg = sum(map(len, toks)) / len(toks)
    want = {}
    for i, t in enumerate(toks):
        s = 0
        for q in ("harbour", "bridge"):
            tf, dfq = t.count(q), sum(q in x for x in toks)
            if tf:
                s += math.log(1 + (len(docs) - dfq + 0.5) / (dfq + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
        if s:
            want[i] = round(s, 6)
    assert {r["id"]: r["score"] for r in bm25.scores(df, "id", ["text"], ["Harbour, bridge!"]).collect()} == want
    assert bm25.scores(df, "id", ["text"], ["!!"]).count() == 0
    assert bm25.scores(df.limit(0), "id", ["text"], ["x"]).count() == 0


def test_fusion_is_monotone(spark):
    df = spark.createDataFrame([(0.5, 10.0), (0.4, 10.0), (0.4, 20.0), (None, None), (2.0, 0.0)], "d double, s double")
    f = [r[0] for r in df.select(hybrid.fusion_score(F.col("d"), F.col("s"), hybrid.CLI)).collect()]
    assert f[0] < f[1] < f[2] and f[3] == f[4] == 0


def sequential_leaders(n, edges):
    near, marked = {}, {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
    for i in range(n):
        if i not in marked:
            for j in sorted(near.get(i, ())):
                marked.setdefault(j, i)
    return marked


def test_greedy_leaders(spark):
    rng = random.Random(5)
    for n, m in ((6, 5), (30, 40), (60, 200)):
        edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
        df = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "a long, b long, cosine double")
        assert {r["id"]: r["similar_to"] for r in dedup.greedy_leaders(df).collect()} == sequential_leaders(n, edges)
        for settle in (0, 20):  # by rounds alone, and by rounds until few pairs are open
            assert {r["id"]: r["similar_to"] for r in dedup.greedy_leaders(df, settle=settle).collect()} == sequential_leaders(n, edges)
    assert dedup.greedy_leaders(df.limit(0)).count() == 0


def test_leaders_are_never_left_open(spark):
    """A round limit that is reached is an error, and there is none unless one is asked for."""
    path = spark.createDataFrame([(i, i + 1, 1.0) for i in range(8)], "a long, b long, cosine double")
    with pytest.raises(RuntimeError, match="did not settle in 2 rounds"):
        dedup.greedy_leaders(path, most_rounds=2)
    angle = np.arange(8) * 0.06
    v = (np.stack([np.cos(angle), np.sin(angle)], axis=1) @ np.eye(64)[:2]).astype(np.float32)
    with pytest.raises(RuntimeError, match="did not settle in 1 rounds"):
        dedup.greedy_followers(frame(spark, v), "id", "vector", 64, 0.998, bits=4, most_rounds=1)
    for f in (dedup.greedy_leaders, dedup.greedy_followers):
        assert inspect.signature(f).parameters["most_rounds"].default is None


def test_near_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 64))
    v = np.concatenate([base, base[:30] + 0.02 * rng.standard_normal((30, 64)), base[:3]]).astype(np.float32)
    df = frame(spark, v)
    w = v.astype(float) / np.linalg.norm(v, axis=1, keepdims=True)
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if w[i] @ w[j] >= 0.998}
    assert {(r["a"], r["b"]) for r in dedup.near_pairs(df, "id", "vector", 64, 0.998, exact=True).collect()} == want
    found = {(r["a"], r["b"]) for r in dedup.near_pairs(df, "id", "vector", 64, 0.998).collect()}
    copies = {(i, 90 + i) for i in range(3)}
    assert found <= want and copies <= found
    of = lambda pairs: sequential_leaders(len(v), pairs).keys()
    assert of(found) == of(want)


@pytest.mark.parametrize("head", [3, 2048])
def test_greedy_followers(spark, head):
    """A dense spot holds a third of the rows; a small head makes many rounds and cut buckets."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((60, 64))
    dense = rng.standard_normal(64) + 0.03 * rng.standard_normal((50, 64))
    v = np.concatenate([base, base[:20] + 0.04 * rng.standard_normal((20, 64)), dense, base[:6], dense[:4]]).astype(np.float32)
    v = v[rng.permutation(len(v))]
    w = v.astype(float) / np.linalg.norm(v, axis=1, keepdims=True)
    want = sequential_leaders(len(v), {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if w[i] @ w[j] >= 0.998})
    got = dedup.greedy_followers(frame(spark, v), "id", "vector", 64, 0.998, bits=6, head=head).collect()
    assert {r["id"]: r["similar_to"] for r in got} == want and len(got) == len(want)
    assert dedup.greedy_followers(frame(spark, v).limit(0), "id", "vector", 64, 0.998).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_followers_on_chains(spark, seed):
    """Points on an arc: long chains of near neighbours, so that leaders are settled over several rounds."""
    rng = np.random.default_rng(seed)
    angle = rng.uniform(0, 1.2, 120)
    v = (np.stack([np.cos(angle), np.sin(angle)], axis=1) @ np.linalg.qr(rng.standard_normal((64, 2)))[0].T).astype(np.float32)
    w = v.astype(float) / np.linalg.norm(v, axis=1, keepdims=True)
    want = sequential_leaders(len(v), {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if w[i] @ w[j] >= 0.998})
    got = dedup.greedy_followers(frame(spark, v), "id", "vector", 64, 0.998, bits=4).collect()
    assert {r["id"]: r["similar_to"] for r in got} == want


RECORD = "id long, url string, caption string, caption_long string, origin_width long, origin_height long, origin_storage_id string, exif string, meta map<string,string>, source array<string>, license string, vector array<float>, created_at timestamp, updated_at timestamp"


def records(seed, ids, source):
    rng, at = random.Random(seed), lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=n)
    text = lambda i, c: rng.choice([None, "", f"{c}{i}"])
    keys = lambda i: {k: f"{k}{i}" for k in rng.sample("abcd", rng.randint(0, 3))}
    return {i: dict(id=i, url=f"u{i}", caption=text(i, "c"), caption_long=text(i, "l"), origin_width=rng.choice([None, 1, 2, 9]), origin_height=rng.choice([1, 3]), origin_storage_id=text(i, "o"),
        exif=rng.choice([None, json.dumps(keys(i) | {"n": i})]), meta=rng.choice([None, keys(i)]), source=source, license=text(i, "x"), vector=[float(i)], created_at=at(rng.randint(0, 99)), updated_at=at(rng.randint(100, 199))) for i in ids}


def merged_one(sc, tg, name):
    """merge_items of the reference."""
    area = lambda x: (x["origin_width"] or 0) * x["origin_height"]
    out = dict(tg) if area(tg) >= area(sc) else tg | {c: sc[c] for c in dedup.PICTURE if c in sc}
    out |= {c: tg[c] or sc[c] for c in dedup.CAPTIONS}
    if sc["exif"]:
        out["exif"] = json.dumps(json.loads(sc["exif"]) | json.loads(tg["exif"] or "{}"))
    out["meta"] = (sc["meta"] or {}) | (tg["meta"] or {})
    out["source"] = sorted({*tg["source"], name})
    return out | {"created_at": min(tg["created_at"], sc["created_at"]), "updated_at": max(tg["updated_at"], sc["updated_at"])}


def canon(found):
    return {r["id"]: r | {"exif": json.loads(r["exif"] or "{}"), "meta": r["meta"] or {}} for r in found}


def test_absorb_merges_every_linked_row(spark):
    """Against the reference's loop, with a hot target."""
    source, target = records(1, range(100, 160), ["s"]), records(2, range(1, 6), ["alpha"])
    rng = random.Random(3)
    links = {i: rng.choice([1, 1, 1, 2, 3]) for i in source if rng.random() < 0.8}
    want = dict(target)
    for i in sorted(links):
        want[links[i]] = merged_one(source[i], want[links[i]], "s")
    frames = [spark.createDataFrame([tuple(r.values()) for r in x.values()], RECORD) for x in (source, target)]
    pairs = spark.createDataFrame([], "a long, b long, similarity double")
    updated, _ = dedup.absorb(*frames, spark.createDataFrame([(i, t, 1.0) for i, t in links.items()], "id long, target_id long, similarity double"), pairs, "s")
    assert canon(r.asDict() for r in updated.collect()) == canon(want.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_absorb_inserts_no_near_copies(spark, seed):
    """The target grows row by row in the reference; rows near an inserted one merge into it."""
    source, target = records(seed, range(100, 150), ["s"]), records(seed + 9, range(1, 6), ["alpha"])
    rng = random.Random(seed)
    score = lambda: rng.choice([0.999, 0.9995, 1.0])
    links = {(i, rng.randint(1, 5)): score() for i in rng.sample(sorted(source), 15)} | {(i, rng.randint(1, 5)): score() for i in rng.sample(sorted(source), 5)}
    pairs = {tuple(rng.sample(sorted(source), 2)): score() for _ in range(60)}
    both = {}
    for (a, b), s in pairs.items():
        both[min(a, b), max(a, b)] = max(s, both.get((min(a, b), max(a, b)), 0))
    grown = {("old", i): r for i, r in target.items()}
    for i in sorted(source):
        near = [(s, 1, -t, ("old", t)) for (a, t), s in links.items() if a == i] + [(s, 0, -a, ("new", a)) for (a, b), s in both.items() if b == i and ("new", a) in grown]
        if near:
            grown[max(near)[3]] = merged_one(source[i], grown[max(near)[3]], "s")
        else:
            grown["new", i] = source[i] | {"source": ["s"]}
    frames = [spark.createDataFrame([tuple(r.values()) for r in x.values()], RECORD) for x in (source, target)]
    given = [spark.createDataFrame([(*k, s) for k, s in x.items()], f"{names}, similarity double") for x, names in ((links, "id long, target_id long"), (pairs, "a long, b long"))]
    for df, kind in zip(dedup.absorb(*frames, *given, "s"), ("old", "new")):
        assert df.columns == frames[0].columns
        assert canon(r.asDict() for r in df.collect()) == canon(r for (k, _), r in grown.items() if k == kind)


def test_insert_ignore_and_update(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, url string")
    new = spark.createDataFrame([(3, "b"), (5, "c"), (4, "c"), (6, None), (7, None)], "id long, url string")
    assert rows(tables.insert_ignore(old, new, ["url"], ["id"]), "id", "url") == Counter({(4, "c"): 1, (6, None): 1, (7, None): 1})
    assert tables.insert_ignore(old, new.limit(0), ["url"]).count() == 0
    changes = spark.createDataFrame([(1, "z"), (2, None), (9, "q")], "id long, url string")
    assert rows(tables.update_by_id(old, changes), "id", "url") == Counter({(1, "z"): 1, (2, "b"): 1})


def test_next_ids(spark):
    old = spark.createDataFrame([(10,)], "id long")
    new = spark.range(1000).select(F.col("id").alias("k")).repartition(7)
    got = tables.next_ids(old, new, "id", ["k"]).orderBy("k").collect()
    assert [r["id"] for r in got] == list(range(11, 1011))
    assert tables.next_ids(old, new.limit(0), "id", ["k"]).count() == 0


def test_no_machine_local_stage_on_a_cluster():
    from types import SimpleNamespace as N

    from kbforge.staging import shared_dir

    session = lambda master, folder: N(conf=N(get=lambda *_: folder), sparkContext=N(applicationId="a", master=master, getConf=lambda: N(get=lambda *_: None)))
    assert shared_dir(session("spark://h:7077", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master, None))


def test_table(spark, tmp_path):
    t = tables.Table(spark, f"file://{tmp_path}/t", spark.createDataFrame([], "id long, url string").schema, ["url"])
    assert t.read().count() == 0
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, url string")
    assert t.insert(batch, ["id"]) == 2 and t.insert(batch) == 0
    t.update(spark.createDataFrame([(1, "z")], "id long, url string"))
    assert {r["url"] for r in t.read().collect()} == {"z", "b"}
    t.compact()
    assert t.read().count() == 2
    with pytest.raises(ValueError):
        t.truncate()
    t.truncate(force=True)
    assert t.read().count() == 0


def test_table_appends(spark, tmp_path):
    """An insert leaves the parts that are there, an update rewrites only those it touches, old ones go, and the second
    of two writers begins again."""
    t = tables.Table(spark, f"file://{tmp_path}/t", spark.createDataFrame([], "id long, url string").schema, ["id"])
    rows_ = lambda *ids: spark.createDataFrame([(i, f"u{i}") for i in ids], "id long, url string")
    assert t.insert(rows_(1, 2)) == 2 and t.insert(rows_(2, 3)) == 1 and t.insert(rows_(4)) == 1
    before = t._latest()[1]
    t.update(spark.createDataFrame([(3, "x")], "id long, url string"))
    after = t._latest()[1]
    assert len(before) == len(after) == 3 and len(set(before) & set(after)) == 2
    assert sorted(map(tuple, t.read().collect())) == [(1, "u1"), (2, "u2"), (3, "x"), (4, "u4")]
    t.update(spark.createDataFrame([(9, "x")], "id long, url string"))
    assert t._latest()[1] == after
    other = tables.Table(spark, t.folder, t.schema, ["id"])
    number, parts = t._latest()
    taken, commit = [], other._commit

    def late(n, p):  # another writer is first, once
        if not taken:
            taken.append(t.insert(rows_(5, 6)))
        return commit(n, p)

    other._commit = late
    assert other.insert(rows_(6, 7)) == 1 and taken == [2]
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 3, 4, 5, 6, 7]
    t.compact()
    t.compact()
    assert len([n for n in (tmp_path / "t").iterdir() if n.name.startswith("d-")]) == 2 and t.read().count() == 7


def test_live_workers(spark):
    beats = spark.sql("select * from values (1, 'A', timestamp'2024-01-01 00:00:00'), (1, 'A', timestamp'2024-01-01 00:10:00'), (2, 'A', timestamp'2024-01-01 00:07:00'), (3, 'A', timestamp'2024-01-01 00:06:59'), (5, 'B', timestamp'2024-01-01 00:09:00'), (null, 'A', timestamp'2024-01-01 00:10:00') as t(worker, workflow, ts)")
    got = tables.live_workers(beats, F.lit("2024-01-01 00:10:00").cast("timestamp"), 180)
    assert rows(got, "workflow", "worker", "ord", "n_workers") == Counter({("A", 1, 0, 2): 1, ("A", 2, 1, 2): 1, ("B", 5, 0, 1): 1})


RAW = {"database_file": "db", "database_writable": True, "meta_table": {"name": "meta", "id_column": "id", "text_column": "chunk_text", "tags_column": "tags", "retrieval_columns": ["url", "chunk_text"], "direct_search_columns": ["doc_id"]}, "embedding_table": {"name": "emb", "id_column": "id", "embedding_column": "vector", "emb_model": "hash"}}


def test_store(spark, tmp_path):
    config = store.parse_config(RAW, folder=f"file://{tmp_path}")
    assert config.columns == ["id", "chunk_text", "url"]
    s = store.Store(spark, config, HashEmbedder(64))
    schema = "doc_id string, url string, meta string, tags array<string>, chunk_text string"
    texts_ = [("d1", "u1", None, ["x"], "old harbour bridge"), ("d2", "u2", None, None, "winter valley"), ("d3", None, None, ["x", "y"], "harbour in winter")]
    assert s.add(spark.createDataFrame(texts_, schema)) == 3 and s.add(spark.createDataFrame(texts_[:1], schema)) == 0
    with pytest.raises(ValueError, match="empty"):
        s.add(spark.createDataFrame([("d9", "u9", None, None, "")], schema))
    with pytest.raises(ValueError, match="url"):
        s.add(spark.createDataFrame([("d8", "u1", None, None, "another text")], schema))
    assert s.pending().count() == 3 and s.process_pending() == 3 and s.pending().count() == 0
    assert s.search("old harbour bridge", 1).first()["chunk_text"] == "old harbour bridge"
    tagged = s.search("winter", 10, ["x"]).collect()
    assert {r["chunk_text"] for r in tagged} == {"old harbour bridge", "harbour in winter"} and {r["url"] for r in tagged} == {"u1", ""}
    assert s.search("").count() == 0
    assert s.direct_search({"doc_id": "d2"}).count() == 1 and s.direct_search({"url": "u1"}).count() == 0 and s.direct_search({}).count() == 0
    assert s.manage_tags({"doc_id": "d1"}, ["b", "a", "x"], ["x"]) and not s.manage_tags({"doc_id": "none"}, ["b"])
    assert s.meta.read().where("doc_id = 'd1'").first()["tags"] == ["a", "b"]
    with pytest.raises(ValueError, match="one identifier"):
        s.manage_tags({})
    with pytest.raises(ValueError, match="writable"):
        store.Store(spark, store.parse_config(RAW | {"database_writable": False})).add(spark.createDataFrame(texts_, schema))


def test_config_and_health(tmp_path):
    import json

    with pytest.raises(ValueError, match="database_file"):
        store.parse_config({})
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(RAW))
    assert store.Registry.discover(str(tmp_path)).health() == "healthy"
    (tmp_path / "bad.json").write_text("{}")
    found = store.Registry.discover(str(tmp_path))
    assert found.health() == "degraded" and found.get().name == "a_one" and store.Registry().health() == "unhealthy"
    with pytest.raises(KeyError):
        found.get("none")


@pytest.mark.parametrize("kind", ["int8", "int4", None])
def test_query_codes(kind):
    config = store.parse_config(RAW | {"embedding_table": RAW["embedding_table"] | {"quantization": kind, "mrl_dims": 128}})
    v = np.random.default_rng(0).standard_normal(200)
    got = store.query_codes(v.tolist(), config)
    assert len(got) == (64 if kind == "int4" else 128)
    if kind is None:
        assert abs(np.linalg.norm(got) - 1) < 1e-9


def test_pack_shards(spark, tmp_path):
    data = [(i, "é" * (i % 17) + ("," if i % 5 == 0 else "")) for i in range(500)] + [(1000, "x" * 500)]
    df = spark.createDataFrame(data, "id long, text string").repartition(3)
    packed = export.pack_shards(df, "id", ["id", "text"], 200).collect()
    held = Counter()
    for r in packed:
        held[r["shard"]] += r["bytes"]
    assert len(packed) == len(data) and all(b + 9 <= 200 for s, b in held.items() if sum(p["shard"] == s for p in packed) > 1)
    order = [r["shard"] for r in sorted(packed, key=lambda r: r["id"])]
    assert order == sorted(order) == greedy([r["bytes"] for r in sorted(packed, key=lambda r: r["id"])], 9, 200)
    report = export.write_shards(df, "id", ["id", "text"], f"file://{tmp_path}/out", 200)
    assert report.agg(F.sum("num_rows")).first()[0] == len(data)
    assert spark.read.option("lineSep", "\r\n").text(f"file://{tmp_path}/out").count() == len(data)
    first = report.where("shard = 0").first()
    body = "id,text\r\n" + "".join(r["line"] for r in sorted(packed, key=lambda r: r["id"]) if r["shard"] == 0)
    assert first["md5"] == hashlib.md5(body.encode()).hexdigest() and first["bytes"] == len(body.encode()) and first["first_row"] == '0,","' and first["header"] == "id,text"


def greedy(sizes, header, most):
    """The fold as it stands: a line that doesn't fit begins the next shard, unless the shard is empty."""
    out, shard, held = [], 0, header
    for s in sizes:
        if held + s > most and held > header:
            shard, held = shard + 1, header
        out.append(shard)
        held += s
    return out


@pytest.mark.parametrize("seed", range(4))
def test_shards_over_many_ranges(spark, seed):
    """One fold over all rows, whatever the ranges; repeated rows, rows without a key and lines over the limit included."""
    rng = random.Random(seed)
    data = [(rng.randrange(60), "x" * rng.choice([0, 3, 10, 40, 90, 150])) for _ in range(300)] + [(None, "y")] * 3
    df = spark.createDataFrame(data, "id long, text string").withColumn("line", F.lit("other"))
    got = export.pack_shards(df.drop("line"), "id", ["id", "text"], 120).withColumn("h", F.xxhash64("line"))
    found = sorted(got.collect(), key=lambda r: (r["id"] is not None, r["id"] or 0, r["h"], r["shard"]))
    assert len(found) == len(data) and [r["shard"] for r in found] == greedy([r["bytes"] for r in found], 9, 120)
    assert export.pack_shards(df.limit(0), "id", ["id", "text"], 120).count() == 0


def test_cumulative_shards(spark):
    """Groups over several ranges, one of them without a name and one that holds most rows."""
    rng = random.Random(3)
    data = [(i, rng.choice(["a", "a", "a", "a", "b", None]), rng.randrange(1, 50)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, src string, n int").repartition(4)
    got = {r["id"]: r["shard"] for r in export.cumulative_shards(df, F.col("n"), ["src"], ["id"], 100).collect()}
    held, want = Counter(), {}
    for i, src, n in data:
        want[i] = held[src] // 100
        held[src] += n
    assert got == want and export.cumulative_shards(df.limit(0), F.col("n"), ["src"], ["id"], 100).count() == 0


def test_incremental(spark, tmp_path):
    df = spark.range(50)
    df.write.parquet(f"file://{tmp_path}/in")
    sink = tables.Table(spark, f"file://{tmp_path}/out", df.schema, ["id"])
    go = lambda: pending.incremental(spark, f"file://{tmp_path}/in", df.schema, lambda b: b.where("id % 2 = 0"), sink, f"file://{tmp_path}/cp")
    assert go() == 25 and go() == 0
    spark.range(40, 60).write.mode("append").parquet(f"file://{tmp_path}/in")
    assert go() == 5 and sink.read().count() == 30


def test_encoder_and_reranker_survive_failures(spark):
    from kbforge.providers import Encoder, rerank_scores

    class Moody:
        """A model that fails on some texts and loses a vector of some batches."""

        def embed_texts(self, texts, task=""):
            if any("bad" in t for t in texts):
                raise OSError("no")
            return [[float(len(t)), 1.0] for t in texts if "lost" not in t]

        def score(self, topic, texts):
            return self.embed_texts(texts) and [float(len(t)) for t in texts]

    rows = spark.createDataFrame([(1, "one"), (2, "bad"), (3, None), (4, "lost"), (5, "")], "id long, text string").coalesce(1)
    found = {r["id"]: r["vector"] for r in Encoder(Moody(), batch=3).embed(rows).collect()}
    assert found == {1: [3.0, 1.0], 2: None, 3: None, 4: None, 5: [0.0, 1.0]}
    scores = {r["id"]: r["rank_score"] for r in rerank_scores(rows, "id", "text", "t", Moody(), batch=2).collect()}
    assert scores == {1: 0.0, 2: 0.0, 3: 0.0, 4: 4.0, 5: 0.0}
    assert rerank_scores(rows.limit(0), "id", "text", "t", Moody()).count() == 0 and Encoder(Moody(), bits=4).embed(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Encoder(Moody(), bits=5)


def test_providers(spark):
    assert expand_query("t") == {"sentences": ["t"], "keywords": ["t"]}
    assert expand_query("t", lambda _: {"keywords": ["a", "a", "b", "c", "d"]})["keywords"] == ["a", "b", "c"]
    assert expand_query("t", lambda _: 1 / 0)["keywords"] == ["t"]
    assert normalise_queries([" B ", "a", "b"]) == ["b", "a"]
    e = HashEmbedder(16)
    assert abs(np.linalg.norm(e.embed_texts(["some text"])[0]) - 1) < 1e-9 and not any(e.embed_texts(["  "])[0])
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], [(0, 2), (2, 9), (1, 1)])], "t array<array<double>>, s array<struct<start:int,end:int>>")
    assert df.select(pooled(F.col("t"), F.col("s"), 4).alias("p")).first()["p"] == [[2.0, 3.0], [5.0, 6.0]]


def test_subtitles_and_shift(spark):
    cues = spark.createDataFrame([("v", 0, 100, 200, "a"), ("v", 1, 50, 80, "b"), ("v", 1, 99_999, 100_000, "late")], "video string, segment int, start_ms long, end_ms long, text string")
    segments = spark.createDataFrame([("v", 0, 1000), ("v", 1, 2000)], "video string, segment int, duration_ms long")
    moved = export.shift_segments(cues, segments, 5000)
    assert rows(moved, "text", "start_ms", "end_ms") == Counter({("a", 100, 200): 1, ("b", 1050, 1080): 1})
