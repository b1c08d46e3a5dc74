import random

from helpers import clashing, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kbforge.llm import packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_windows(sizes):
    windows = packing.fill_windows(sizes, 100)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in w) <= 100 for w in windows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=40), st.integers(1, 9))
def test_partition_is_whole(sizes, k):
    windows = packing.kk_partition(sizes, k)
    assert len(windows) == k and sorted(i for w in windows for i in w) == list(range(len(sizes)))


def test_partition_is_near_equal():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 1000) for _ in range(400)]
    sums = [sum(sizes[i] for i in w) for w in packing.kk_partition(sizes, 20)]
    assert max(sums) - min(sums) <= 0.01 * sum(sums) / 20


def test_fill():
    rng = random.Random(3)
    sizes = [min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(1000)]
    windows = packing.fill_windows(sizes)
    assert sum(sizes) / (4096 * len(windows)) > 0.99


def test_overfull_window_that_needs_two_others():
    sizes = [90, 15, 50, 40, 30, 30, 35]
    windows = [[0, 1], [2, 3], [4, 5, 6]]
    assert packing.level(windows, sizes, 100)
    assert sorted(i for w in windows for i in w) == list(range(7)) and all(sum(sizes[i] for i in w) <= 100 for w in windows)
    assert not packing.level([[0], [1]], [101, 100], 100)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=2, max_size=14))
def test_outcomes(sizes):
    """Complete differencing finds the fullest window that fits."""
    best = max(s for n in range(1 << len(sizes)) if (s := sum(x for i, x in enumerate(sizes) if n >> i & 1)) <= 60)
    one, two = packing.outcomes(list(range(len(sizes))), sizes, 60)[0]
    assert sum(sizes[i] for i in one) == best and sorted(one + two) == list(range(len(sizes)))


def test_rows(spark):
    data = [(1, None), (2, ""), (3, "a" * 4095), (4, "a" * 4096), (5, "é" * 5000), (6, "short"), (6, "short"), (7, "x" * 1_000_000), (None, "y")] + [(100 + i, "z" * (i * 7 % 900)) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = packing.pack(df, block=50)
    tokens = rows(got.groupBy("doc_id").agg(F.sum("tokens").alias("t"), F.max("n_pieces").alias("n")), "doc_id", "t", "n")
    for doc, text in data[1:5]:
        size = len(text.encode()) + 1
        assert tokens[(doc, size, -(-size // 4096))] == 1
    assert (1, 1, 1) not in tokens and tokens[(6, 12, 1)] == 1  # repeated rows are items of their own
    assert tokens[(7, 1_000_001, 245)] == 1
    report = packing.fill_report(got).first()
    assert report["largest"] <= 4096 and report["tokens"] == sum(len(t.encode()) + 1 for d, t in data if d is not None and t is not None)
    assert rows(packing.pack(clashing(df), block=50)) == rows(got)
    assert packing.pack(df.limit(0)).count() == 0
