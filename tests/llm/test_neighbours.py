import numpy as np
from helpers import clashing

from kbforge.llm import neighbours


def brute(ids, v, k=5, least=0.85):
    v = v.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = v @ v.T
    np.fill_diagonal(c, -2)
    out = set()
    for i in range(len(v)):
        order = np.lexsort((ids, -np.round(c[i], 9)))[:k]
        out |= {tuple(sorted((int(ids[i]), int(ids[j])))) for j in order if c[i, j] >= least}
    return out


def data(n=900, copies=0, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, 64))
    v = np.repeat(centres, 4, axis=0) + 0.45 * rng.standard_normal((4 * (n // 6), 64))
    v = np.concatenate([v, rng.standard_normal((n - len(v), 64))]) * rng.uniform(0.4, 3, (n, 1))
    if copies:
        v[-copies:] = v[0]
        v[-copies - 3 : -copies] = v[1]
    return np.arange(n) * 3 + 1, v.astype(np.float32)


def frame(spark, ids, v):
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, v)], "id long, vector array<float>")


def pairs(df):
    got = [(r["id_a"], r["id_b"]) for r in neighbours.similar_pairs(df, "id", "vector").collect()]
    assert len(got) == len(set(got)) and all(a < b for a, b in got)
    return set(got)


def test_recall(spark):
    ids, v = data()
    want, got = brute(ids, v), pairs(frame(spark, ids, v))
    assert len(want & got) / len(want) >= 0.97 and len(got - want) / len(want) <= 0.03


def test_copies_hold_a_third(spark, monkeypatch):
    ids, v = data(600, copies=200)
    want = brute(ids, v)
    assert len(want & pairs(frame(spark, ids, v))) / len(want) >= 0.97


def test_hot_block_is_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 64)
    rng = np.random.default_rng(8)
    ids, v = data(500)
    v[:200] = rng.standard_normal(64) + 0.3 * rng.standard_normal((200, 64))
    want = brute(ids, v)
    assert len(want & pairs(frame(spark, ids, v))) / len(want) >= 0.95


def test_dirty_rows(spark):
    good = [1.0] + [0.0] * 63
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0] * 32, [0.0] * 64, [nan] + good[1:], [inf] + good[1:]]
    rows = [(i, x) for i, x in enumerate(bad)] + [(10, good), (11, [2.0 * x for x in good]), (12, good), (None, good)]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    assert pairs(df) == {(10, 11), (10, 12), (11, 12)}
    assert pairs(clashing(df)) == {(10, 11), (10, 12), (11, 12)}
    assert pairs(df.where("id = 10")) == set() and pairs(df.limit(0)) == set() and pairs(df.where("id < 6")) == set()
