import random

from helpers import clashing, rows
from pyspark.sql import functions as F

from kbforge.llm import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {(find(x), x) for x in root}


def found(df):
    got = [(r["group_id"], r["id"]) for r in components.connected_components(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_shapes(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1200)]
    noise = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    dirty = [(None, 5), (5, None), (7, 7), (2, 1), (2, 1), (1, 2)]
    edges = chain + star + noise + dirty
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    assert found(df) == brute(edges)
    assert found(df.withColumns({c: F.lit(1) for c in ("u", "v", "m", "n", "p")})) == brute(edges)
    assert found(df.limit(0)) == set()


def test_hot_node(spark):
    edges = [(1, i) for i in range(2, 13_000)] + [(20_000 + i, 20_001 + i) for i in range(0, 4000, 2)]
    assert found(spark.createDataFrame(edges, "a long, b long")) == brute(edges)


def test_match_edges(spark):
    nan = float("nan")
    data = [(1, 2, 0.999), (3, 4, 99.9), (5, 6, 99.8), (7, 8, 0.998999), (9, 0, 1.0), (0, 9, 1.0), (9, 9, 1.0), (10, None, 1.0), (None, 10, 1.0), (11, 12, nan), (13, 14, None), (15, 16, 100.0), (17, 18, 1.0)]
    df = spark.createDataFrame(data, "id long, similar_to long, similarity double")
    expected = {(1, 2): 1, (3, 4): 1, (15, 16): 1, (17, 18): 1}
    assert rows(components.match_edges(df), "a", "b") == expected
    assert rows(components.match_edges(df.withColumn("extra", F.lit(1))), "a", "b") == expected
    assert components.match_edges(clashing(df)).count() == 4
