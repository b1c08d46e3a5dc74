"""Incremental work: files that arrived since the last run are read as a stream, worked on and appended by key.

``availableNow`` takes what is there and stops, so a run is a batch with a memory (the checkpoint), and the append
ignores known keys, so a batch that runs twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbforge.operators.tables import Table


def incremental(spark: SparkSession, source: str, schema, work: Callable[[DataFrame], DataFrame], sink: Table, checkpoint: str, files_per_batch: int = 100) -> int:
    """Bring new Parquet files of ``source`` through ``work`` into ``sink``; how many rows were added."""
    added = [0]

    def each(batch: DataFrame, _: int) -> None:
        added[0] += sink.insert(work(batch))

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        stream = reader.parquet(source)
    else:  # a source is a folder; a single file is picked out of its own
        folder, _, name = source.rpartition("/")
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return added[0]


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that have no result yet."""
    return rows.join(done.select(key), key, "left_anti")


def work_part(rows: DataFrame, key: str, parts: int, part: int) -> DataFrame:
    """The share of worker ``part`` of ``parts``; one worker has everything."""
    return rows if parts <= 1 else rows.where(F.pmod(F.col(key), F.lit(parts)) == part)
