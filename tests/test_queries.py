"""Every query of the core against its SQL; the few without SQL must run."""

import pytest
from helpers import DATA
from pyspark.sql import functions as F

from kbforge.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(name, QUERIES, SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark):
    assert QUERIES[name](spark, DATA).count() >= 0


def test_matches_scored_as_percentages(spark, tmp_path):
    """A link counts whichever way it is scored, and the nearest target is taken."""
    links = [(1001, 7, 99.95), (1001, 3, 0.9991), (1001, 2, 99.2), (1002, 1001, 99.99), (1003, 5, float("nan")), (1004, 5, 50.0), (1005, 3, 99.91), (1005, 7, 0.9991)]
    spark.createDataFrame(links, "id long, similar_to long, similarity double").write.parquet(f"{tmp_path}/image_match.parquet")
    source = spark.read.parquet(f"{DATA}/is_pd12m.parquet").where("id <= 1005")
    source.withColumns({"updated_at": F.timestamp_seconds(F.col("id") + 4_000_000_000), "processed_storage_id": F.lit("x/processed.jpg")}).write.parquet(f"{tmp_path}/is_pd12m.parquet")
    spark.read.parquet(f"{DATA}/ii_alpha.parquet").write.parquet(f"{tmp_path}/ii_alpha.parquet")
    # 1002 merges into 1001's only if that was inserted; it was merged, so 1002 leads
    assert {r["id"] for r in QUERIES["absorb_insert"](spark, str(tmp_path)).collect()} == {1002, 1003, 1004}
    late = QUERIES["absorb_merge"](spark, str(tmp_path)).where("updated_at > '2090-01-01'").select("id", F.unix_timestamp("updated_at").alias("at"))
    assert {r["id"]: r["at"] - 4_000_000_000 for r in late.collect()} == {7: 1001, 3: 1005}
    report = QUERIES["dataset_report"](spark, str(tmp_path)).first()
    assert (report["fetched"], report["unique"], report["duplicated"]) == (5, 2, 3)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_does_not_import_llm():
    import pathlib
    import re

    import kbforge

    root = pathlib.Path(kbforge.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"kbforge\.llm|from kbforge import llm", path.read_text()), path
