"""Operator 3: packing by first-fit decreasing with a tournament tree, in random groups.

A document's ids, with the end id, are cut into pieces of the sequence length and a rest.  Full
pieces are sequences by themselves, numbered in chunks of a bounded size.  The rests are dealt by a seeded hash into groups of about
``group_rests`` and each group packs its own: longest first, each into the first bin that still
has room.  A tournament tree over the bins' free room (each node holds the largest of its two
children) finds that bin in log(bins) steps.  Groups are independent, so they run in parallel, a
lost executor costs only its groups, and a group's memory is bounded by its number of rests times
the sequence length.

Sequence ids are unique, not dense: ``group * SEQUENCES + number``, negative for full pieces.  Defined cases: a null or empty text is one piece that holds the end id;
repeated rows are packed each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.token_files import ids_crc32
from cinemetric.llm.tokens import encoder

SEQUENCES = 1 << 20
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, chunk long, row long"
PACKED = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (all at most ``room``), first-fit decreasing."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [room] * (2 * leaves)  # node i has children 2i and 2i+1; bins are the leaves
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, room - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str, length: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Pieces of every document's ids: ``length`` ids each, and the rest."""
    end = int(end_id).to_bytes(2, "little")
    chunk_pieces = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        part_id, full = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for d, r, ids in zip(
                    part.column("doc_id").to_pylist(), part.column("row").to_pylist(), encode(part.column("text").to_pylist())
                ):
                    ids += end
                    total = len(ids) // 2
                    for start in range(0, total, length):
                        cut = ids[2 * start : 2 * (start + length)]
                        chunk = None  # rests are dealt by a hash
                        if len(cut) == 2 * length:
                            chunk = -1 - (part_id * SEQUENCES + full // chunk_pieces)
                            full += 1
                        rows.append((d, start, len(cut) // 2, total, cut, chunk, r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 2)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids", "serial", "row"],
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.mapInArrow(run, PIECES)


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = 2048,
    end_id: int = 1,
    group_rests: int = 4096,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Packed pieces: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` are 16-bit little-endian ids; with ``digest`` their crc32 as 32-bit ids stands in their
    place (``ids_crc32``), computed where they are packed.  A sequence is its pieces in the order of ``offset``,
    padded to ``length``.
    """
    groups = max(1, -(-docs.count() // group_rests))
    cut = pieces(docs, vocabulary, length, end_id, doc_id, text)
    dealt = cut.withColumn(
        "group", F.coalesce("chunk", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "row"), F.lit(groups)))
    )

    def run(table: pa.Table) -> pa.Table:
        # in the order of the documents, so that a rerun packs alike in whatever order rows arrive
        table = table.sort_by([("row", "ascending"), ("start", "ascending")])
        group = table.column("group")[0].as_py()
        if group < 0:
            sequence = group * SEQUENCES - np.arange(table.num_rows)
            offset = np.zeros(table.num_rows, np.int64)
        else:
            bins, offset = first_fit_decreasing(table.column("length").to_numpy(), length)
            sequence = group * SEQUENCES + bins
        ids = table.column("ids")
        if digest:
            ids = pa.array(ids_crc32(ids))
        names = ["doc_id", "start", "length", "doc_tokens"]
        columns = [*(table.column(c) for c in names), ids, pa.array(sequence), pa.array(offset)]
        return pa.table(columns, names=[*names, "ids_crc32" if digest else "ids", "sequence_id", "offset"])

    return dealt.groupBy("group").applyInArrow(run, PACKED.replace("ids binary", "ids_crc32 long") if digest else PACKED)
