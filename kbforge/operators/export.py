"""Export: tables as CSV shards of bounded size with a manifest, and subtitles as text."""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kbforge.staging import Stage, broadcast_if_small

MOST_BYTES = 1_000_000_000
#: Groups in ranges up to which their sums are broadcast; beyond it the join shuffles.
MOST_GROUPS = 100_000


def csv_line(*columns: Column) -> Column:
    """One CSV line with its line end: fields that hold a comma, quote or line break are quoted, null is empty."""

    def one(c: Column) -> Column:
        s = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(s.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)

    return F.concat(F.concat_ws(",", *[one(c) for c in columns]), F.lit("\r\n"))


def shard_fold(sizes: list[int], start: int, header: int, most: int) -> list[int]:
    """Shard of each line: a new one begins where a line would push the current one over ``most``, header included."""
    out, shard, held = [], start, header
    for s in sizes:
        if held + s > most:
            shard, held = shard + 1, header
        out.append(shard)
        held += s
    return out


class Lines:
    """The line sizes of one stretch of a table, as sums from its beginning."""

    def __init__(self, sizes: np.ndarray, header: int, most: int):
        self.sums, self.n, self.header, self.most = np.append(0, np.cumsum(sizes, dtype=np.int64)), len(sizes), header, most

    def fits(self, held: np.ndarray | int) -> np.ndarray:
        """How many lines still go into a shard that holds ``held`` bytes."""
        return np.searchsorted(self.sums, self.most - held, side="right") - 1

    def following(self, begins: np.ndarray) -> np.ndarray:
        """The line with which the shard after the one that begins with each line begins."""
        return np.maximum(np.searchsorted(self.sums, self.sums[begins] + self.most - self.header, side="right") - 1, begins + 1)

    def chain(self, begin: int) -> list[int]:
        """The lines with which shards begin, from one on."""
        out = []
        while begin < self.n:
            out.append(begin)
            begin = int(self.following(np.array([begin]))[0])
        return out

    def outcomes(self) -> list[tuple[int, int, int]]:
        """(limit, opened, held): a shard that comes to this stretch with at most ``limit`` bytes, and with more than the
        next smaller limit, leaves it after so many shards have been opened, the last one holding so much. Shards that
        begin at different lines soon begin at the same ones, so there are few outcomes; never more than lines in a shard."""
        most_lines = int(self.fits(self.header))
        first = np.arange(min(most_lines, self.n - 1) + 1)
        at, opened, last = first.copy(), np.zeros(len(first), dtype=np.int64), first.copy()
        while (open_ := at < self.n).any():
            last[open_], opened[open_] = at[open_], opened[open_] + 1
            at[open_] = self.following(at[open_])
        held = self.header + self.sums[self.n] - self.sums[last]
        new = np.append(True, (opened[1:] != opened[:-1]) | (held[1:] != held[:-1]))
        out = [(int(self.most - self.sums[i]), int(opened[i]), int(held[i])) for i in first[new]]
        if most_lines >= self.n:  # all of the stretch goes into the shard that comes
            out.append((int(self.most - self.sums[self.n]), 0, int(self.sums[self.n])))
        return out


def pack_shards(df: DataFrame, key: str, columns: list[str], most: int = MOST_BYTES) -> DataFrame:
    """``df`` with ``line``, ``bytes`` and ``shard`` (from 0): order-preserving greedy shards of at most ``most`` bytes,
    as a fold over all rows in order of the key gives them. A line over the limit has a shard for itself.

    The fold needs keys and sizes only. They are sorted into ranges and written down; each range tells what becomes of
    a shard that comes to it with so many bytes, these few outcomes are followed range by range on the driver, and each
    range then numbers its lines. Repeated keys are one after the other in order of their lines.
    """
    header = len((",".join(columns) + "\r\n").encode())
    line = csv_line(*[F.col(c) for c in columns])
    sized = df.select(F.col(key).alias("key_"), F.xxhash64(line).alias("hash_"), F.octet_length(line).cast("long").alias("bytes"))
    ranged = Stage(sized.repartitionByRange("key_", "hash_").withColumn("part", F.spark_partition_id()), "sizes").df
    ranged = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("key_", "hash_")))

    def tell(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = Lines(pdf.sort_values("place")["bytes"].to_numpy(), header, most)
        return pd.DataFrame(lines.outcomes(), columns=["limit", "opened", "held"]).assign(part=pdf["part"].iloc[0])

    by_part: dict[int, list] = {}
    for r in ranged.select("part", "place", "bytes").groupBy("part").applyInPandas(tell, "limit long, opened long, held long, part int").collect():
        by_part.setdefault(r["part"], []).append((r["limit"], r["opened"], r["held"]))
    shard, held, begins = -1, most, {}  # as if a full shard came to the first line
    for part in sorted(by_part):
        begins[part] = shard, min(held, most)
        _, opened, left = min((x for x in by_part[part] if x[0] >= min(held, most)), key=lambda x: x[0])
        shard, held = shard + opened, left if opened else held + left

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", ignore_index=True)
        start, held = begins[int(pdf["part"].iloc[0])]
        lines = Lines(pdf["bytes"].to_numpy(), header, most)
        at = np.array(lines.chain(int(lines.fits(held))), dtype=np.int64)
        return pdf.assign(shard=start + np.searchsorted(at, np.arange(len(pdf)), side="right"))[["key_", "hash_", "bytes", "shard"]]

    numbered = ranged.groupBy("part").applyInPandas(number, f"key_ {df.schema[key].dataType.simpleString()}, hash_ long, bytes long, shard long")
    # equal lines of one key may lie in different shards: the first of them in the first, and so on
    turn = lambda order: F.row_number().over(Window.partitionBy("key_", "hash_").orderBy(order))
    n = numbered.withColumn("turn_", turn("shard")).alias("n")
    own = df.withColumn("line", line).withColumns({"hash_": F.xxhash64("line"), "key_": F.col(key)}).withColumn("turn_", turn("hash_")).alias("o")
    met = own.join(n, (F.col("o.hash_") == F.col("n.hash_")) & F.col("o.key_").eqNullSafe(F.col("n.key_")) & (F.col("o.turn_") == F.col("n.turn_")))
    return met.select(*[F.col(f"o.{c}") for c in df.columns], "o.line", "n.bytes", "n.shard")


def write_shards(df: DataFrame, key: str, columns: list[str], path: str, most: int = MOST_BYTES) -> DataFrame:
    """CSV shards under ``path``/shard=<number>; returns the manifest."""
    packed = Stage(pack_shards(df, key, columns, most), "shards").df  # written once: file and manifest must agree
    packed.repartition("shard").sortWithinPartitions("shard", key, "line").select("shard", F.regexp_replace("line", "\r\n$", "").alias("value")).write.partitionBy("shard").option("lineSep", "\r\n").text(path)
    return manifest(packed, key, columns)


def manifest(packed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(shard, filename, inside, num_rows, bytes, md5, header, first_row, last_row, first_key, last_key) of every shard;
    bytes and md5 are those of the file with its header. A shard is no larger than its file may be, so one task reads it."""
    header = ",".join(columns)
    kind = packed.schema[key].dataType.simpleString()
    schema = f"shard long, filename string, inside string, num_rows long, bytes long, md5 string, header string, first_row string, last_row string, first_key {kind}, last_key {kind}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: dict | None = None

        def done(x: dict) -> tuple:
            return (x["shard"], f"{x['shard']:08d}.tar.gz", f"{x['shard']:08d}.csv", x["rows"], x["bytes"], x["md5"].hexdigest(), header, x["first"], x["last"], x["first_key"], x["last_key"])

        for batch in batches:
            out = []
            for shard, k, line in zip(batch["shard"], batch["key"], batch["line"]):
                if now is None or now["shard"] != shard:
                    out += [done(now)] if now else []
                    top = (header + "\r\n").encode()
                    now = {"shard": shard, "rows": 0, "bytes": len(top), "md5": hashlib.md5(top), "first": line[:-2], "first_key": k}
                raw = line.encode()
                now["md5"].update(raw)
                now.update(rows=now["rows"] + 1, bytes=now["bytes"] + len(raw), last=line[:-2], last_key=k)
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])
        if now:
            yield pd.DataFrame([done(now)], columns=[f.split()[0] for f in schema.split(", ")])

    return packed.select("shard", F.col(key).alias("key"), "line").repartition("shard").sortWithinPartitions("shard", "key", "line").mapInPandas(run, schema)


def cumulative_shards(df: DataFrame, size: Column, group: list[str], order: list[str], most: int) -> DataFrame:
    """``df`` with ``shard`` = running size / ``most`` within its group, for where the exact fold isn't needed.

    The rows are sorted into ranges, which are written down; each range adds up its groups, and a row's running size is
    that of the ranges before it plus that within its own. So a group that holds most rows is spread over ranges.
    """
    held = df.withColumns({"size_": size.cast("long"), "group_": F.to_json(F.struct(*group), {"ignoreNullFields": "false"})})
    ranged = Stage(held.repartitionByRange(*[F.col(c) for c in (*group, *order)]).withColumn("part_", F.spark_partition_id()), "ranged").df
    sums = ranged.groupBy("group_", "part_").agg(F.sum("size_").alias("s_"))
    earlier = Window.partitionBy("group_").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    before = Stage(sums.select("group_", "part_", F.coalesce(F.sum("s_").over(earlier), F.lit(0)).alias("before_")), "before").df
    within = F.sum("size_").over(Window.partitionBy("part_", "group_").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = ranged.withColumn("within_", within).join(broadcast_if_small(before, MOST_GROUPS), ["group_", "part_"])
    return joined.select(*df.columns, F.floor((F.col("before_") + F.col("within_") - F.col("size_")) / most).cast("long").alias("shard"))


def dump(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """The table as CSV with a header, without its storage columns and vectors; null is \\\\N, so that it is no empty text."""
    hidden = [c for c in df.columns if c in ("origin_storage_id", "processed_storage_id") or c.startswith("vector")]
    df.drop(*hidden).write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("nullValue", "\\N").option("maxRecordsPerFile", rows_per_file).csv(path)


def subtitles(cues: DataFrame, group: str) -> DataFrame:
    """(group, srt): numbered cues of each group by start. ``cues``: (group, start, end, text) with HH:MM:SS,mmm."""
    w = Window.partitionBy(group).orderBy("start", "end", "text")
    block = F.concat(F.row_number().over(w).cast("string"), F.lit("\n"), F.col("start"), F.lit(" --> "), F.col("end"), F.lit("\n"), F.col("text"), F.lit("\n\n"))
    placed = cues.where("start is not null and end is not null").withColumn("n_", F.row_number().over(w)).withColumn("b_", block)
    return placed.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_", "b_"))), lambda x: x["b_"]), "").alias("srt"))


def shift_segments(cues: DataFrame, segments: DataFrame, segment_ms: int) -> DataFrame:
    """Cues of consecutive segments on one time line: each is moved by the length of the segments before its own; cues
    that start after ``segment_ms`` are dropped. ``segments``: (video, segment, duration_ms)."""
    before = F.coalesce(F.sum("duration_ms").over(Window.partitionBy("video").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = cues.where(F.col("start_ms") <= segment_ms).join(segments.withColumn("offset_ms", before).drop("duration_ms"), ["video", "segment"])
    return moved.select("video", "segment", (F.col("start_ms") + F.col("offset_ms")).alias("start_ms"), (F.col("end_ms") + F.col("offset_ms")).alias("end_ms"), "text")


def python_csv_line(values: list[str]) -> str:
    """What the csv module writes for a row; the tests hold ``csv_line`` against it."""
    buffer = io.StringIO()
    csv.writer(buffer).writerow(values)
    return buffer.getvalue()

