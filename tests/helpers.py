"""What the tests share."""

import math
import os
from collections import Counter

DATA = os.environ.get("KBFORGE_TEST_DATA", "/root/testdata/sf0.001")
#: Columns named as operators might name theirs.
CLASHING = ["value", "field", "pos", "key", "a", "b", "n", "rep", "h1", "vec", "t", "piece", "block", "window", "g_", "e", "vote", "trust", "sources", "rank", "norm", "family", "line", "bytes", "cos", "cell", "kind", "w", "l", "x"]


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if getattr(value, "tzinfo", None):
        return value.replace(tzinfo=None)
    return value


def rows(df, *columns):
    columns = columns or sorted(df.columns)
    return Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())


def clashing(df):
    """The table with more columns, named as an operator might name its own."""
    from pyspark.sql import functions as F

    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("other").alias(c) for c in CLASHING if c not in have])
