"""BM25 over one or more text fields.

One pass over the texts writes down each row's length and frequencies of the queried terms; the corpus statistics are
one small row. No postings are shuffled: rows without any term leave at once. Terms of a query are a bag joined by OR;
the score of a row is the sum over fields and terms. Ties go to the smaller id. Null fields count as empty.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.staging import Stage, once

K1, B = 1.2, 0.75
DIGITS = 6


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits of the lower-cased text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")


def query_terms(query: str) -> list[str]:
    return list(dict.fromkeys(re.findall("[a-z0-9]+", query.lower())))


def scores(corpus: DataFrame, key: str, fields: list[str], queries: list[str], k1: float = K1, b: float = B) -> DataFrame:
    """(query, key, score) of every row that holds a term of a query; ``query`` is its position from 0."""
    terms = sorted({t for q in queries for t in query_terms(q)})
    if not terms:
        return corpus.sparkSession.createDataFrame([], f"query long, {key} {corpus.schema[key].dataType.simpleString()}, score double")
    # Occurrences are counted by patterns over the lower-cased text, within generated code and without arrays of words.
    held = once(corpus, [key], {f"x_{i}": F.lower(F.coalesce(F.col(f), F.lit(""))) for i, f in enumerate(fields)})
    times = lambda i, pattern: F.regexp_count(f"x_{i}", F.lit(pattern))
    word = lambda t: f"{t}(?![a-z0-9])(?<![a-z0-9]{t})"  # the word first, so that texts are skimmed for it
    sized = once(held, [key], {f"n_{i}": times(i, "[a-z0-9]+") for i in range(len(fields))} | {f"f_{i}": F.array(*[times(i, word(t)) for t in terms]) for i in range(len(fields))})
    sized = Stage(sized, "terms").df  # numbers only: the texts are read once, for statistics and scores alike
    stats = sized.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(f"n_{i}").alias(f"avg_{i}") for i in range(len(fields))],
        *[F.sum((F.get(f"f_{i}", F.lit(j)) > 0).cast("long")).alias(f"df_{i}_{j}") for i in range(len(fields)) for j in range(len(terms))],
    ).first()  # one row, whatever the corpus
    found = sized.where(F.exists(F.concat(*[F.col(f"f_{i}") for i in range(len(fields))]), lambda x: x > 0))

    def part(i: int, j: int) -> Column:
        tf, df, mean = F.get(f"f_{i}", F.lit(j)), stats[f"df_{i}_{j}"] or 0, stats[f"avg_{i}"] or 1.0
        idf = math.log(1 + (stats["rows"] - df + 0.5) / (df + 0.5))
        return F.when(tf > 0, F.lit(idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col(f"n_{i}") / mean))).otherwise(F.lit(0.0))

    place = {t: j for j, t in enumerate(terms)}
    total = [sum((part(i, place[t]) for i in range(len(fields)) for t in query_terms(q)), F.lit(0.0)) for q in queries]
    each = F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("query"), F.round(s, DIGITS).alias("score")) for n, s in enumerate(total)])).alias("x")
    return found.select(key, each).select("x.query", key, "x.score").where("score > 0")


def top_k(corpus: DataFrame, key: str, fields: list[str], queries: list[str], k: int) -> DataFrame:
    """(query, key, score, rank): the best k rows of every query."""
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), key)
    return scores(corpus, key, fields, queries).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
