"""Operator 1: token-id files with Elias-Fano coded document boundaries.

A file set is a folder of Parquet containers that Spark commits task by task (so a lost executor
leaves no half file), each row of which is one shard in this binary format:

    magic "EFT1", ids of 16 bits; first (tokens of the part before this shard), tokens, null ids
    ends     Elias-Fano: end of every document in the shard's concatenated ids
    doc ids  Elias-Fano: doc_id minus the smallest one, of documents with an id
    ids      16-bit little-endian, documents one after the other

Documents stand in ascending doc_id order over the whole set: a range partitioning on doc_id
gives the parts, and a shard is closed as soon as it holds ``shard_tokens``.  A document's
boundaries take about two bits plus the log of its mean length, and ``Shard.bounds(i)`` answers
by select without a table of 64-bit offsets.  What is global, the number of tokens in all parts
before, is a running sum over one row per part.

Defined cases: a null or empty text is its end id; a null doc_id comes first; rows with one
doc_id stand next to each other, in the order of their text's hash; an empty table gives an empty
set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinemetric.llm import elias_fano
from cinemetric.llm.tokens import encoder

_HEAD = struct.Struct("<4sHHQQQ")
SHARDS = "part long, serial long, n_docs long, n_tokens long, shard binary"


def pack_shard(doc_ids: list[int | None], ids: list[bytes], first: int) -> bytes:
    sizes = np.fromiter((len(x) // 2 for x in ids), np.int64, len(ids))
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = known[:1] if len(known) else np.zeros(1, np.int64)
    head = _HEAD.pack(b"EFT1", 2, 0, first, int(sizes.sum()), len(doc_ids) - len(known))
    relative = known.astype(np.uint64) - base.astype(np.uint64)
    return b"".join(
        [head, base.astype("<i8").tobytes(), elias_fano.encode(np.cumsum(sizes)), elias_fano.encode(relative), *ids]
    )


class Shard:
    """A shard read in place: ``doc_ids``, ``bounds(i)`` and ``ids(i)``."""

    def __init__(self, data: bytes):
        magic, width, _, self.first, self.n_tokens, self.nulls = _HEAD.unpack_from(data, 0)
        if magic != b"EFT1" or width != 2:
            raise ValueError("no shard of this format")
        view = memoryview(data)
        at = _HEAD.size
        self.base = int(np.frombuffer(data, "<i8", 1, at)[0])
        at += 8
        self.ends = elias_fano.Reader(view[at:])
        at += self.ends.size
        self._doc_ids = elias_fano.Reader(view[at:])
        at += self._doc_ids.size
        self.tokens = np.frombuffer(data, "<u2", self.n_tokens, at)

    def __len__(self) -> int:
        return self.ends.n

    def doc_ids(self) -> list[int | None]:
        known = self._doc_ids.all().astype(np.uint64) + np.array([self.base], np.int64).astype(np.uint64)
        return [None] * self.nulls + known.astype(np.int64).tolist()

    def bounds(self, i: int) -> tuple[int, int]:
        """Start and end of the i-th document in the shard's ids."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.tokens[start:end]


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 1,
    shard_tokens: int = 1 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every text, append ``end_id`` and write the file set to ``path``."""
    end = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        part, serial, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, ids, held = [], [], 0

        def shard():
            row = [part, serial, len(ids), held, pack_shard(doc_ids, ids, first)]
            types = [pa.int64()] * 4 + [pa.binary()]
            names = ["part", "serial", "n_docs", "n_tokens", "shard"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                slice_ = batch.slice(at, 128)
                for d, x in zip(slice_.column("doc_id").to_pylist(), encode(slice_.column("text").to_pylist())):
                    doc_ids.append(d)
                    ids.append(x + end)
                    held += len(x) // 2 + 1
                    if held >= shard_tokens:
                        yield shard()
                        serial, first = serial + 1, first + held
                        doc_ids, ids, held = [], [], 0
        if ids:
            yield shard()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = ["doc_id", "h", "row"]  # row: equal rows are told apart, so no doc_id piles up in a part
    ordered = (
        rows.withColumn("h", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    ordered.select("doc_id", "text").mapInArrow(run, SHARDS).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with ``base``: the tokens of all parts before the shard's."""
    shards = spark.read.schema(SHARDS).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_t"))  # one row per written task
    bases = parts.select("part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), "part")  # bounded by the number of parts


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("shard").to_pylist()):
                shard = Shard(data)
                doc_ids, start = shard.doc_ids(), 0
                for at in range(0, len(shard), 256):
                    # boundaries by select, a few hundred at a time: no table of all of them
                    ends = [shard.ends.select(i) for i in range(at, min(at + 256, len(shard)))]
                    starts = [start, *ends[:-1]]
                    start = ends[-1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[at : at + 256], pa.int64()),
                            pa.array([base + shard.first + s for s in starts], pa.int64()),
                            pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                            pa.array([shard.tokens[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    rows = read_shards(spark, path).select("base", "shard")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def ids_crc32(ids: pa.Array) -> np.ndarray:
    """Unsigned crc32 of each ids buffer as 32-bit little-endian ids."""
    return np.array([zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in ids.to_pylist()], np.int64)


def with_crc32(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``."""
    kept = [c for c in rows.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(ids_crc32(batch.column("ids")))], names=[*kept, "ids_crc32"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids"]
    return rows.mapInArrow(run, ", ".join([*fields, "ids_crc32 long"]))
