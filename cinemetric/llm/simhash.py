"""Operator 7: SimHash near-dedup over a byte-position index with count filtering.

A fingerprint has eight bytes, and two fingerprints at ``max_bits`` (2) or fewer differing bits
share at least six of them at the same positions: the guaranteed minimum of the count filter.
Tallying shared bytes from one posting per (position, byte) would meet N^2/256 pairs, so the
tally is taken inside the index: its postings are keyed by every choice of six positions and
their six bytes, and a pair meets in a posting exactly if its tally reaches the minimum.  A
posting can hold at most 2^16 fingerprints (two free bytes) whatever the input, is verified by
Hamming distance in one go, and sends out a star over each linked set rather than its pairs, so
thousands of near copies cost as many links, not their square.

Rows with one fingerprint collapse before the index.  Defined cases: null and wordless texts have
fingerprint zero and link like any other; texts of fewer than three words are one shingle; a null
``doc_id`` is kept, and takes part in a component that is named by its smallest non-null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.components import components
from cinemetric.llm.shared import stored, work_dir

BYTES = 8


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles: a bit is 1 if set in over half the hashes."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[shingle - 1 :].tolist()
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), 1 << 15):
        part = [digest(joined[a:b], 42) for a, b in zip(starts[i : i + (1 << 15)], stops[i : i + (1 << 15)])]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", row_key: str | None = None
) -> DataFrame:
    """``(doc_id, row_key, fp)``; ``fp`` holds the unsigned fingerprint's bits in a signed long,
    ``row_key`` the long column of that name (null if none is named)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [simhash((t or "").encode(), shingle) for t in part.column("text").to_pylist()]
                fps = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array(fps)], names=["doc_id", "row_key", "fp"]
                )

    key = F.col(row_key) if row_key else F.lit(None)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), key.cast("long").alias("row_key"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def _stars(group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one posting's distinct fingerprints: each with the first of its linked set."""
    n = len(group)
    label = np.arange(n)
    if n <= 256:
        near = np.bitwise_count(group[:, None] ^ group[None, :]) <= max_bits
        while True:
            new = np.where(near, label[None, :], n).min(axis=1)
            if (new == label).all():
                break
            label = new
    else:  # flip every one or two bits that differ anywhere in the posting and look the result up
        free = int(np.bitwise_or.reduce(group ^ group[0]))
        ones = [1 << i for i in range(64) if free >> i & 1]
        masks = [sum(c) for k in range(1, max_bits + 1) for c in combinations(ones, k)]
        links = []
        for m in masks:
            flipped = group ^ np.uint64(m)
            at = np.minimum(np.searchsorted(group, flipped), n - 1)
            hit = np.flatnonzero(group[at] == flipped)
            links.append((hit, at[hit]))
        while True:
            new = label.copy()
            for a, b in links:
                np.minimum.at(new, a, new[b])
            new = new[new]
            if (new == label).all():
                break
            label = new
    far = np.flatnonzero(label != np.arange(n))
    return group[far], group[label[far]]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """``fps(fp)``, distinct, to links ``(a, b)`` that connect all at ``max_bits`` or fewer."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the index keeps two bytes free, which covers up to two differing bits")
    masks = []
    for places in combinations(range(BYTES), BYTES - max_bits):
        mask = sum(0xFF << (8 * p) for p in places)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.explode(
        F.array(*[F.struct(F.lit(i).alias("places"), F.col("fp").bitwiseAND(F.lit(m)).alias("six")) for i, m in enumerate(masks)])
    )
    postings = (
        fps.select("fp", keys.alias("key"))
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("fps")
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(np.asarray(lists.value_lengths()))
            starts = ends - np.asarray(lists.value_lengths())
            two = ends - starts == 2
            x, y = values[starts[two]], values[starts[two] + 1]
            near = np.bitwise_count(x ^ y) <= max_bits
            found = [(x[near], y[near])]
            for s, e in zip(starts[~two], ends[~two]):
                found.append(_stars(np.sort(values[s:e]), max_bits))
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return postings.mapInArrow(run, "a long, b long")


def grouped(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text", row_key: str | None = None
) -> DataFrame:
    """One row per document: ``doc_id, row_key, fp, component_id, first_key``.

    ``component_id`` is the smallest id reachable over links, ``first_key`` the row key of the
    group's first row by id (null last) and row key.
    """
    folder = work_dir(docs.sparkSession, "simhash")
    rows = stored(fingerprints(docs, shingle, doc_id, text, row_key), f"{folder}/fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    kinds = stored(rows.groupBy("fp").agg(F.min(order).alias("first")), f"{folder}/kinds")
    linked = components(links(kinds.select("fp"), max_bits), folder)
    rooted = kinds.join(linked, kinds.fp == linked.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(first, "root").select(
        F.col("fp").alias("kind"), F.col("least.doc_id").alias("component_id"), F.col("least.row_key").alias("first_key")
    )
    named = stored(named, f"{folder}/named")
    return rows.join(named, rows.fp == named.kind).select("doc_id", "row_key", "fp", "component_id", "first_key")


def near_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (smallest id reachable over links)."""
    return grouped(docs, shingle, max_bits, doc_id, text).select("doc_id", "fp", "component_id")


def hex_digits(fp):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
