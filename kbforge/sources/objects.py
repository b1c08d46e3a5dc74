"""Objects: files in a Hadoop file system and addresses fetched over HTTP. The transport is given by the caller, so
that it runs on executors and can be replaced in tests."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds for connecting and reading, and how a fetch names itself.
TIMEOUT = 30
AGENT = "kbforge"


def http_get(url: str, timeout: float = TIMEOUT) -> bytes:
    """The content of an address; an error status raises."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as reply:
        return reply.read()


def retrying(call: Callable[[str], bytes], most: int = 3, first: float = 1.0, sleep: Callable[[float], None] | None = None) -> Callable[[str], bytes]:
    """``call`` tried up to ``most`` times, waits doubled each time."""
    import time

    def run(x: str) -> bytes:
        for attempt in range(1, most + 1):
            try:
                return call(x)
            except Exception:
                if attempt == most:
                    raise
                (sleep or time.sleep)(first * 2 ** (attempt - 1))
        raise AssertionError

    return run


def fetch(rows: DataFrame, key: str, url: str, get: Callable[[str], bytes] = http_get) -> DataFrame:
    """(key, content, error) of each address, in batches on the executors; a failure is a row, not an exception."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, u in zip(batch["key"], batch["url"]):
                try:
                    out.append((k, get(u), None))
                except Exception as why:
                    out.append((k, None, str(why)[:500]))
            yield pd.DataFrame(out, columns=[key, "content", "error"])

    some = rows.where(F.col(url).isNotNull() & (F.col(url) != "")).select(F.col(key).alias("key"), F.col(url).alias("url"))
    return some.mapInPandas(run, f"{key} {kind}, content binary, error string")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of the files below ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def put_json(spark: SparkSession, path: str, value: object) -> None:
    """One compact JSON object, keys sorted; folders are made as needed."""
    at, fs = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()))
    out.close()


def get_json(spark: SparkSession, path: str) -> object:
    rows = spark.read.option("wholetext", "true").text(path).collect()
    return json.loads(rows[0]["value"])


def write_objects(rows: DataFrame, path: str, key: str) -> None:
    """One JSON document per row in partitioned JSON lines under ``path``; at scale an object per row is what to avoid."""
    rows.withColumn("bucket_", F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 2)).write.mode("overwrite").partitionBy("bucket_").json(path)
