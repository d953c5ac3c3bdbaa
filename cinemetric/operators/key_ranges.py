"""Stored tables that a batch changes without rewriting what it does not touch (W-01..W-07, S-12, S-13).

A ``KeyRangeTable`` is a folder of Parquet files in ranges of its key and one manifest per version:

    data/<version>-<id>/_range=<n>/...   rows of a range, sorted on the key
    manifest/v=<version>/                one row per range: its data folder, least and greatest key, rows, bytes

A change reads the manifest (as large as the number of ranges), finds the ranges that the batch's
keys fall into, joins the batch with those ranges' rows only, writes them to a new data folder and then
the next manifest, in which every other range keeps its old folder.  The manifest's ``_SUCCESS`` file
is the commit: a job that dies before it leaves the table at its old version, and a writer that
finds its version taken fails.  Readers keep the version that they opened.

Ranges follow the whole key, so a key prefix that holds a third of the rows (one movie's ratings)
spans several ranges.  A task sorts and writes one range, so ranges are bounded in bytes as well as in
rows, whatever a row holds; one that grows beyond twice ``target_rows`` or ``target_bytes`` is split
when it is written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetric.operators import mutate as W

Change = Callable[[DataFrame, DataFrame], DataFrame]


def value_bytes(c: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in memory, what it nests included (0 where it is NULL)."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(c) + 8
    elif isinstance(kind, T.ArrayType):
        each = F.transform(c, lambda x: value_bytes(x, kind.elementType) + 8)
        size = F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x) + 16
    elif isinstance(kind, T.MapType):
        size = value_bytes(F.map_keys(c), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(c), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(16))
    elif isinstance(kind, T.VariantType):
        size = F.octet_length(F.to_json(c)) + 8
    else:
        size = F.lit(16 if isinstance(kind, T.DecimalType) else 8)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long"))


def _row_bytes(schema: T.StructType) -> Column:
    return sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields), F.lit(16).cast("long"))


class VersionTaken(RuntimeError):
    """Another writer committed the version that this one meant to write."""


class KeyRangeTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], target_rows: int = 2_000_000, target_bytes: int = 128 << 20):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.target_rows, self.target_bytes = target_rows, target_bytes
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- versions ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        root = self._path(f"{self.path}/manifest")
        if not self._fs.exists(root):
            return []
        found = [f.getPath() for f in self._fs.listStatus(root)]
        done = [p for p in found if self._fs.exists(self._path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def _manifest(self, version: int | None = None) -> list:
        """One row per range, in key order; bounded by rows / ``target_rows`` and bytes / ``target_bytes``."""
        version = self.versions()[-1] if version is None else version
        return self.spark.read.parquet(f"{self.path}/manifest/v={version}").orderBy("place").collect()

    def _commit(self, version: int, entries: list[tuple], schema: T.StructType, note: str = "") -> None:
        rows = [(i, schema.json(), note, *e) for i, e in enumerate(entries)]
        key = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in schema.fields if f.name in self.keys)
        frame = self.spark.createDataFrame(rows, f"place int, schema string, note string, folder string, low struct<{key}>, high struct<{key}>, n long, size long")
        try:
            frame.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifest/v={version}")
        except Exception as e:
            if "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e):
                raise VersionTaken(f"version {version} of {self.path}") from e
            raise

    # -- reading ------------------------------------------------------------------------------

    def _rows(self, entries: Sequence, schema: T.StructType) -> DataFrame:
        folders = [e["folder"] for e in entries if e["folder"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        entries = self._manifest(version)
        return self._rows(entries, self._schema(entries))

    @staticmethod
    def _schema(entries: Sequence) -> T.StructType:
        return T.StructType.fromJson(json.loads(entries[0]["schema"]))

    # -- writing ------------------------------------------------------------------------------

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _write(self, rows: DataFrame, version: int, ranges: int) -> list[tuple]:
        """Write rows in new ranges; their manifest entries in key order."""
        folder = f"{self.path}/data/{version}-{uuid.uuid4().hex}"
        ranged = rows.repartitionByRange(max(1, ranges), *self.keys).withColumn("_range", F.spark_partition_id())
        # sorted on the folder's column first, as the writer wants it: else it sorts the range once more
        ranged.sortWithinPartitions("_range", *self.keys).write.partitionBy("_range").parquet(folder)
        if not any(f.getPath().getName().startswith("_range=") for f in self._fs.listStatus(self._path(folder))):
            return []
        written = self.spark.read.parquet(folder)
        stats = written.groupBy("_range").agg(
            F.min(self._key()).alias("low"), F.max(self._key()).alias("high"), F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(rows.schema)).alias("size")
        )
        found = stats.orderBy("_range").collect()  # one row per range
        return [(f"{folder}/_range={r['_range']}", tuple(r["low"]), tuple(r["high"]), r["n"], r["size"]) for r in found]

    def _ranges_for(self, n: int, size: int) -> int:
        return max(-(-n // self.target_rows), -(-size // self.target_bytes))

    @staticmethod
    def _size(entry) -> int:
        """Bytes of a range; 0 in manifests from before they were kept."""
        return entry["size"] if "size" in entry else 0

    def note(self) -> str:
        """What the last change was committed with."""
        return self._manifest()[0]["note"]

    def create(self, rows: DataFrame, note: str = "") -> "KeyRangeTable":
        """Version 0; rows without a whole key are left out, and keys must be unique."""
        rows = rows.dropna(subset=self.keys)
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(rows.schema)), F.lit(0)).alias("size")).first()
        entries = self._write(rows, 0, self._ranges_for(found["n"], found["size"]))
        none = [(None, None, None, 0, 0)]
        self._commit(0, entries or none, rows.schema, note)
        return self

    def _touched(self, batch: DataFrame, on: Sequence[str], entries: Sequence) -> list[int]:
        """Places of the ranges that may hold the batch's keys (``on``: a prefix of the key)."""
        bounds = [
            (i, tuple(e["low"][c] for c in on), tuple(e["high"][c] for c in on)) for i, e in enumerate(entries) if e["folder"]
        ]
        if not bounds:
            return []
        types = {f.name: f.dataType for f in self._schema(entries).fields}
        literal = lambda key: F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(on, key)])
        lows, highs = (F.array(*[literal(b[k]) for b in bounds]) for k in (1, 2))
        key = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in on])
        # last range that begins at or before the key, first that ends at or behind it
        last = F.size(F.filter(lows, lambda x: x <= key)) - 1
        first = F.size(F.filter(highs, lambda x: x < key))
        spans = batch.select(F.greatest(last, F.lit(0)).alias("last"), first.alias("first")).distinct()
        places = spans.select(F.explode(F.sequence(F.least("first", "last"), F.col("last"))).alias("i")).distinct().collect()
        return [bounds[r["i"]][0] for r in places]  # at most one row per range

    def change(self, batch: DataFrame, how: Change, on: Sequence[str] | None = None, note: str = "") -> int:
        """Apply ``how(rows of the touched ranges, batch)`` and commit it with a note; the new version's number."""
        on = list(on or self.keys)
        if on != self.keys[: len(on)]:
            raise ValueError(f"{on} is no prefix of the key {self.keys}")
        version = self.versions()[-1]
        entries = self._manifest(version)
        schema = self._schema(entries)
        batch = batch.dropna(subset=on)
        places = set(self._touched(batch, on, entries))
        touched = [e for i, e in enumerate(entries) if i in places]
        rows = how(self._rows(touched, schema), batch).select(*schema.fieldNames())
        ranges = max(len(touched), self._ranges_for(sum(e["n"] for e in touched), sum(map(self._size, touched)))) if touched else 1
        written = self._write(rows, version + 1, ranges) if touched or not batch.isEmpty() else []
        kept = [(e["folder"], tuple(e["low"]), tuple(e["high"]), e["n"], self._size(e)) for i, e in enumerate(entries) if i not in places and e["folder"]]
        new = sorted([*kept, *self._split_at(written, kept, version + 1, schema)], key=lambda e: e[1])
        self._commit(version + 1, new or [(None, None, None, 0, 0)], schema, note)
        return version + 1

    def _split_at(self, written: list[tuple], kept: list[tuple], version: int, schema: T.StructType) -> list[tuple]:
        """New ranges, none of which spans an old one; one that is too large in several."""
        out = []
        for entry in written:
            folder, low, high, n, size = entry
            inside = sorted(k[1] for k in kept if low < k[1] < high)
            parts = self._ranges_for(n, size) if n > 2 * self.target_rows or size > 2 * self.target_bytes else 1
            if not inside and parts == 1:
                out.append(entry)
                continue
            rows = self.spark.read.schema(schema).parquet(folder)
            types = {f.name: f.dataType for f in schema.fields}
            literal = lambda key: F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(self.keys, key)])
            for lower, upper in zip([None, *inside], [*inside, None]):
                part = rows if lower is None else rows.filter(self._key() >= literal(lower))
                part = part if upper is None else part.filter(self._key() < literal(upper))
                out += self._write(part, version, parts)
        return out

    # -- mutations ------------------------------------------------------------------------------

    def upsert(self, batch: DataFrame, seq: str | Sequence[str]) -> int:
        """W-02 / S-12: the largest ``seq`` of a repeated key wins; rows without a key are no changes."""
        return self.change(batch, lambda rows, b: W.upsert(rows, b, self.keys, seq))

    def insert_if_absent(self, batch: DataFrame, seq: str | Sequence[str]) -> int:
        """W-01 / S-13: known keys are tolerated and skipped; the first ``seq`` of a repeated key wins."""
        return self.change(batch, lambda rows, b: W.insert_if_absent(rows, b, self.keys, seq)[0])

    def delete(self, keys: DataFrame, on: Sequence[str] | None = None) -> int:
        """W-05: delete by the key, or by a prefix of it."""
        on = list(on or self.keys)
        return self.change(keys, lambda rows, b: W.delete_keys(rows, b, on)[0], on)


def cascade(parent: KeyRangeTable, children: Sequence[KeyRangeTable], keys: DataFrame, column: str) -> None:
    """W-06 / W-07: delete parent keys and every child's rows of them, children first, so that a
    stopped cascade leaves no row without its parent and can be run again."""
    for table in children:
        first = table.keys[0]
        table.delete(keys.select(F.col(column).alias(first)), [first])
    parent.delete(keys.select(F.col(column).alias(parent.keys[0])))
