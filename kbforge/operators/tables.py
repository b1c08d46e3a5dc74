"""Keyed tables without a transactional format: inserts that ignore known keys, updates, truncation, reports.

A table is a folder of parts and of numbered manifests that list them. A write puts a part beside the others and then
the next manifest, so nothing is read and overwritten at once and a lost executor leaves the table whole. An insert
costs what it adds, an update the parts that hold a changed row. The next number can be taken once: of two writers at
once one is first and the other begins again with what it finds then. (The file system must make a file only if it
isn't there, as HDFS and local ones do.)
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kbforge.functions import scalars
from kbforge.staging import Stage


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The rows of ``batch`` to append: no key of the table, each key once (the first by ``order``).

    Rows with a null in a key are never equal to another row, as under a unique constraint, and are all kept.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    first = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in (order or keys)])
    once = batch.where(whole).withColumn("r_", F.row_number().over(first)).where("r_ = 1").drop("r_")
    fresh = once.join(existing.select(*keys), keys, "left_anti").select(*batch.columns)
    return fresh.unionByName(batch.where(~whole))


def update_by_id(table: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """``table`` with the columns of ``changes`` replaced where a row has the key; a null change leaves the old value.

    Of several changes for one key the result would be undefined, so the greatest row of values is taken.
    """
    names = [c for c in changes.columns if c != key]
    one = changes.groupBy(key).agg(F.max(F.struct(*names)).alias("c_"))
    joined = table.join(one, key, "left")
    return joined.select(*[F.coalesce(F.col(f"c_.{c}"), F.col(c)).alias(c) if c in names else F.col(c) for c in table.columns])


def next_ids(existing: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``batch`` with ``key`` numbered on from the largest key of the table, in ``order``.

    Numbers come from a range sort: the counts of its partitions, one number each, are added up first, so no task ever
    sees more than its own rows.
    """
    start = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    ranged = batch.repartitionByRange(*[F.col(c) for c in order]).withColumn("p_", F.spark_partition_id())
    ranged = Stage(ranged, "ranged").df  # the bounds are sampled anew by each job, so the partitions are written down first
    counts = {r["p_"]: r["n"] for r in ranged.groupBy("p_").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        before.append(F.lit(total).cast("long"))
        total += counts.get(p, 0)
    if not before:
        return batch.withColumn(key, F.lit(None).cast("long"))
    place = F.row_number().over(Window.partitionBy("p_").orderBy(*order))
    return ranged.withColumn(key, F.lit(start) + F.get(F.array(*before), F.col("p_")) + place).drop("p_")


class Table:
    """A keyed table in a folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder.rstrip("/"), schema, keys

    def _at(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _drop(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def _manifests(self) -> list[str]:
        fs, path = self._at()
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in names if n.startswith("m-") and n.endswith(".json"))

    def _parts(self, manifest: str) -> list[str]:
        return json.loads(self.spark.read.text(f"{self.folder}/{manifest}", wholetext=True).first()[0])

    def _latest(self) -> tuple[int, list[str]]:
        names = self._manifests()
        return (int(names[-1][2:-5]), self._parts(names[-1])) if names else (0, [])

    def _put(self, df: DataFrame) -> str:
        name = f"d-{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.folder}/{name}")
        return name

    def _commit(self, after: int, parts: list[str]) -> bool:
        """The manifest next to ``after``; False if another writer was first. The last two manifests and their parts
        are kept, so that a reader of the one before ends undisturbed."""
        fs, path = self._at(f"m-{after + 1:020d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as error:
            if not fs.exists(path):
                raise error
            return False
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        *old, before = self._manifests()[:-1] or [None]
        kept = {*parts, *(self._parts(before) if before else ())}
        for name in old:
            for part in set(self._parts(name)) - kept:
                self._drop(part)
            self._drop(name)
        return True

    def _read(self, parts: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._read(self._latest()[1])

    def write(self, df: DataFrame) -> None:
        """The whole table anew."""
        part = self._put(df)
        while not self._commit(self._latest()[0], [part]):
            pass

    def insert(self, batch: DataFrame, order: list[str] | None = None) -> int:
        """Append what isn't there yet; the number of rows added."""
        while True:
            number, parts = self._latest()
            part = self._put(insert_ignore(self._read(parts), batch, self.keys, order))
            added = self._read([part]).count()
            if added and self._commit(number, [*parts, part]):
                return added
            self._drop(part)
            if not added:
                return 0

    def update(self, changes: DataFrame, key: str = "id") -> None:
        """Change rows by key; parts without such a row stay as they are."""
        while True:
            number, parts = self._latest()
            if not parts:
                return
            at = F.regexp_extract("_metadata.file_path", "/(d-[0-9a-f]{32})/", 1).alias("part_")
            rows = self._read(parts).select(key, at).join(changes.select(key), key, "left_semi")
            touched = sorted(r["part_"] for r in rows.select("part_").distinct().collect())  # names of parts, as many as there are
            if not touched:
                return
            part = self._put(update_by_id(self._read(touched), changes, key))
            if self._commit(number, [*(p for p in parts if p not in touched), part]):
                return
            self._drop(part)

    def truncate(self, force: bool = False) -> None:
        if not force:
            raise ValueError("truncation must be forced")
        self.write(self.spark.createDataFrame([], self.schema))

    def compact(self, files: int = 1) -> None:
        """Rewrite the table into ``files`` files."""
        self.write(self.read().repartition(files))


def dataset_report(images: DataFrame, processed: Column, reprocessed: Column, unique: Column, duplicated: Column) -> DataFrame:
    """One row of counts and ratios, from one pass."""
    counts = images.agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(processed).alias("valid"), F.count_if(processed & reprocessed).alias("reprocessed"),
        F.count_if(processed & unique).alias("unique"), F.count_if(processed & duplicated).alias("duplicated"),
    )
    ratio = lambda a, b: scalars.percent(F.col(a), F.col(b))
    return counts.select(
        "*", ratio("valid", "fetched").alias("valid_ratio"), ratio("reprocessed", "valid").alias("reprocessed_ratio"), ratio("unique", "valid").alias("unique_ratio"),
        ratio("duplicated", "valid").alias("duplicated_ratio"), ratio("unique", "fetched").alias("overall_availability"),
    )


def live_workers(beats: DataFrame, at: Column, ttl_seconds: int = 180) -> DataFrame:
    """(workflow, worker, last_beat, ord, n_workers): workers whose last beat isn't older than ``ttl_seconds`` at the
    time ``at``, numbered from 0 by worker within their workflow. ``beats``: (worker, workflow, ts)."""
    last = beats.where("worker is not null and workflow is not null").groupBy("workflow", "worker").agg(F.max("ts").alias("last_beat"))
    alive = last.where(F.col("last_beat") >= at - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    group = Window.partitionBy("workflow")
    return alive.select("workflow", "worker", "last_beat", (F.row_number().over(group.orderBy("worker")) - 1).cast("long").alias("ord"), F.count(F.lit(1)).over(group).alias("n_workers"))
