import random
import re

import pytest
from helpers import clashing
from pyspark.sql import functions as F

from kbforge.llm import survivor

SCHEMA = "id long, origin_hash string, origin_width long, origin_height long, caption string, license string, origin_source string, source array<string>, updated_at timestamp"
H = "0123456789abcdef0123456789abcdef"
TRUST = [("survey", 9), ("pd", 6), ("web", 1)]


@pytest.mark.parametrize(
    "raw,key",
    [(H, H), (H.upper(), H), (f"md5:{H}", H), (f"MD5 {H}", H), (f"md5={H}", H), (f"{{{H}}}", H), ("01234567-89ab-cdef-0123-456789abcdef", H), (f'  "{H}"\n', H), (None, None), ("", None), ("  ", None), ("0" * 32, None), ("f" * 32, None), (H[:31], None), (H + "ab", None), ("n/a", None)],
)
def test_hash_key(spark, raw, key):
    assert spark.range(1).select(survivor.hash_key(F.lit(raw).cast("string")).alias("k")).first()["k"] == key


@pytest.mark.parametrize("caption", ["", "  ", "\t", None, "none", "NULL", "n/a", "N/A", "-", "...", "[no caption]", "no caption available", "Untitled", "untitled image", "No description.", "IMG_1721.JPG", "scan_251.tif", "DSC03587.jpg"])
def test_says_nothing(spark, caption):
    assert spark.range(1).select(survivor.says_something(F.lit(caption).cast("string")).alias("x")).first()["x"] is False


@pytest.mark.parametrize("caption", ["A bridge", "View of X, 1820", "Нет моста", "旧桥", "One note", "Image of a bridge.jpg on a wall"])
def test_says_something(spark, caption):
    assert spark.range(1).select(survivor.says_something(F.lit(caption)).alias("x")).first()["x"] is True


def brute(data):
    groups, trust = {}, dict(TRUST)
    for r in data:
        h = re.sub("[^0-9a-f]", "", (r[1] or "").lower().replace("md5", ""))
        if len(h) == 32 and len(set(h)) > 1:
            groups.setdefault(h, []).append(r)
    out = {}
    for h, rs in groups.items():
        if len(rs) < 2:
            continue
        when = lambda r: (r[8] is not None, r[8] or 0, -r[0])
        sized = [r for r in rs if r[2] and r[3] and 1 <= r[2] <= 100_000 and 1 <= r[3] <= 100_000]
        said = [r for r in rs if r[4] and r[4].startswith("View")]
        t = lambda r: max([trust.get(s.strip().lower(), 0) for s in r[7] or [] if s], default=0)
        out[h] = (max(sized, key=lambda r: (r[2] * r[3], when(r)))[0] if sized else 0, max(said, key=lambda r: (t(r), when(r)))[0] if said else 0)
    return out


def found(spark, df):
    got = survivor.image_records(df, spark.createDataFrame(TRUST, "source string, trust long"))
    zero = F.lit(0).cast("long")
    return {r["group_key"]: (r["s"], r["c"]) for r in got.select("group_key", F.coalesce("size.id", zero).alias("s"), F.coalesce("caption.id", zero).alias("c")).collect()}


def test_against_brute_force(spark):
    import datetime as dt

    rng = random.Random(4)
    hashes = ["%032x" % rng.getrandbits(128) for _ in range(30)]
    times = [None, *[dt.datetime(2024, 1, d) for d in range(1, 6)]]
    data = []
    for i in range(1, 400):
        h = hashes[0] if rng.random() < 0.4 else rng.choice(hashes)  # one group holds over a third
        raw = rng.choice([h, h.upper(), f"md5:{h}", f"{h[:8]}-{h[8:]}", None, ""])
        data.append((i, raw, rng.choice([None, 0, 10, 20, 200_000]), rng.choice([None, 10, 20]), rng.choice([None, "none", "View of A", "View of B"]), rng.choice([None, "cc0"]), "pd", rng.choice([None, [], [" Survey "], ["pd", None], ["web", "other"], ["PD"]]), rng.choice(times)))
    df = spark.createDataFrame(data, SCHEMA)
    assert found(spark, df) == brute(data)
    assert found(spark, clashing(df)) == brute(data)
    assert found(spark, df.unionByName(df)) == brute(data + data)
    assert found(spark, df.limit(0)) == {}


def test_votes_and_sources(spark):
    data = [(1, H, 1, 1, "View", "cc0", "pd", ["pd", "Web "], None), (2, H, 2, 2, "View", "CC0 ", "pd", ["web"], None), (3, H, 3, 3, "View", "by", "pd", ["survey"], None)]
    df = spark.createDataFrame(data, SCHEMA)
    trust = spark.createDataFrame([("pd", 3), ("web", 3), ("survey", 5)], "source string, trust long")
    r = survivor.survivors(df, trust).first()
    assert r["license"]["text"].lower() == "cc0" and r["sources"] == ["pd", "survey", "web"] and r["n_records"] == 3
    assert (r["caption"]["id"], r["caption"]["text"]) == (3, "View")
    twice = survivor.survivors(df.unionByName(df), trust).collect()
    assert [(x["n_records"], x["caption"]["text"]) for x in twice] == [(6, "View")]
    survivor.MOST_SOURCES, kept = 1, survivor.MOST_SOURCES
    try:
        assert survivor.survivors(df, trust).first()["license"]["text"].lower() == "cc0"  # by join where the table is large
    finally:
        survivor.MOST_SOURCES = kept
