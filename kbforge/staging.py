"""Lineage cuts in the shared folder, and broadcasts whose size is checked first."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset in local mode (tests). Elsewhere
    that is an error, since each machine would write to a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder where the master is {master}")
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="kbforge-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return "file://" + _LOCAL[app]


class Stage:
    """A table written to the shared folder and read back: it survives lost executors and carries no lineage."""

    def __init__(self, df: DataFrame, name: str = "stage"):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/kbforge/{self.spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def rows_up_to(df: DataFrame, most: int) -> int:
    """Row count, counted no further than ``most`` + 1."""
    return df.limit(most + 1).count()


def broadcast_if_small(df: DataFrame, most: int) -> DataFrame:
    """A broadcast hint where the table has at most ``most`` rows, else the table as it is (a shuffle join follows)."""
    return F.broadcast(df) if rows_up_to(df, most) <= most else df


def once(df: DataFrame, kept: list[str], made: dict[str, Column]) -> DataFrame:
    """``kept`` columns and ``made`` ones, each of these computed once per row. A plain projection would be merged into
    the one above it, and an expression that is used there several times would be computed as often."""
    return df.select(*kept, F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("once_")).select(*kept, *[F.col(f"once_.{n}").alias(n) for n in made])


def clear_stages(spark: SparkSession) -> None:
    """Delete all tables that this application has written to the shared folder; results that still read them are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/kbforge/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
