"""Operator 4: exact substring dedup by blockwise suffix sorting with a difference cover.

Removes every byte that is covered by a ``length``-byte string which also starts anywhere else.
The work runs over files in the shared folder that tasks map into memory; rows carry compressed
arrays of positions, never text.

1. Copies.  Texts are grouped by digest.  A text with a copy is repeated as a whole; one of its
   rows stands for all in what follows.
2. Candidates.  A start can only repeat if every winnowing minimum inside its ``length`` bytes
   occurs twice in the corpus (equal strings have equal minima).  Minima that do are written as
   sorted arrays; the starts that pass, with the bytes they reach, become blocks of text.  This is
   a necessary condition: nothing that repeats is lost.
3. Cover sample.  Positions whose offset modulo ``PERIOD`` is in the difference cover are the
   sample.  Their ``length``-byte strings are sorted lexicographically, a range of strings at a
   time, and their ranks are written beside each block.  A block sends each distinct string once.
4. Suffix buckets.  Of starts that are equal within a block (told by their bytes) one stands for all,
   which are hits at once; so a passage in very many texts meets itself once per block.  What is
   left is dealt by a hash of their first ``PERIOD`` bytes, and
   a task sorts one bucket at a time: equal prefixes are long ties, and for any two of them the
   cover has a shift, below ``PERIOD``, at which both are in the sample; the ranks there decide.
   So a bucket needs its positions and their next few ranks in memory, not their text.  Starts
   that are equal over ``length`` bytes end up side by side; neighbours are told equal by equal
   ranks, or by their bytes where the ranks look beyond ``length``.
   Long texts are taken in overlapping pieces of ``BLOCK_BYTES`` starts, so no block, and no step
   before the last pass, holds more than a piece of a text; the numbers of hash ranges, sample
   ranges and suffix buckets follow the bytes and starts that there are.
5. Starts with an equal neighbour are merged to removed spans per text, written as sorted arrays,
   and a last pass over the documents cuts them out.

Defined cases: a null text is empty and loses nothing; texts shorter than ``length`` lose nothing,
copies or not; repeated rows are copies; the result keeps one row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.arrays import by_slot, hash_range, pack_arrays, unpack_arrays
from cinemetric.llm.shared import map_file, stored, work_dir, write_file

GRAM, WINDOW = 32, 96  # winnowing: a minimum of WINDOW hashes of GRAM bytes
BLOCK_BYTES = 1 << 20
SLOT_BYTES = 64 << 20  # text bytes behind a range of hashes
SAMPLE_BUCKET, SUFFIX_BUCKET = 60_000, 250_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
PART = "slot long, blob binary"


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """Period and members of the cover of 6r+4 residues whose steps are 1^r, r+1, (2r+1)^r,
    (4r+3)^(2r+1), (2r+2)^(r+1), 1^r."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)])


PERIOD, COVER = difference_cover(2)  # 181 and 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many members lie below a residue; which of the next members (at residues i, j) stand at
    a shift that both reach; and that shift."""
    below = np.searchsorted(COVER, np.arange(PERIOD + 1))
    member = np.zeros(PERIOD, bool)
    member[COVER] = True
    slot = np.zeros((PERIOD, PERIOD), np.int64)
    shift = np.zeros((PERIOD, PERIOD), np.int64)
    every = np.arange(PERIOD)
    for i in range(PERIOD):
        both = member[(i + every)[None, :] % PERIOD] & member[(every[:, None] + every[None, :]) % PERIOD]
        shift[i] = both.argmax(axis=1)  # rows: j, columns: shift
        end = i + shift[i]
        slot[i] = below[end % PERIOD] + len(COVER) * (end // PERIOD) - below[i]
    return below, slot, shift


BELOW, SLOT, SHIFT = _tables()


def _sample_index(offsets: np.ndarray) -> np.ndarray:
    """Number of sample positions of a block below an offset."""
    return offsets // PERIOD * len(COVER) + BELOW[offsets % PERIOD]


def _gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all ``width``-byte strings, by doubling."""
    h = data.astype(np.uint64) * _M1 + np.uint64(0x1234567)
    h ^= h >> np.uint64(29)
    size = 1
    while size < width:
        step = min(size, width - size)
        h = h[:-step] * _M1 + h[step:] if step < len(h) else h[:0]
        h ^= h >> np.uint64(31)
        h *= _M2
        size += step
    return h


def _slide(values: np.ndarray, width: int, ufunc) -> np.ndarray:
    """Minimum or maximum over every ``width`` neighbours."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = ufunc(values[:-step], values[step:])
        size += step
    return values


def _minima(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Window minima by window start, and the hashes of the positions that are one."""
    h = _gram_hashes(np.frombuffer(text, np.uint8), GRAM)
    low = _slide(h, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint64)
    return low, h[_slide(np.concatenate([edge, low, edge]), WINDOW, np.maximum) == h]


def _rows(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    slots, blobs = zip(*parts) if parts else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(blobs, pa.binary())], names=["slot", "blob"])


def _digest(text: bytes) -> tuple[int, int]:
    d = hashlib.md5(text, usedforsecurity=False).digest()
    return int.from_bytes(d[:8], "big"), int.from_bytes(d[8:], "big")


def _pieces(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of ``BLOCK_BYTES`` starts, each with the bytes that its last start reaches."""
    for at in range(0, len(raw) - length + 1, BLOCK_BYTES):
        yield at, raw[at : at + BLOCK_BYTES - 1 + length]


class _Sorted:
    """Arrays sorted by their first one (hashes), in one file per range of hashes."""

    def __init__(self, path: str, slots: int, kinds: tuple[str, ...]):
        self.path, self.slots, self.kinds, self.maps = path, slots, kinds, {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def write(self, slot: int, *arrays: np.ndarray) -> None:
        write_file(f"{self.path}-{slot}", np.array([len(a) for a in arrays], "<i8"), *[a.astype(k) for a, k in zip(arrays, self.kinds)])

    def slot(self, slot: int) -> list[np.ndarray]:
        if slot not in self.maps:
            name, at, out = f"{self.path}-{slot}", 8 * len(self.kinds), []
            try:
                sizes = map_file(name, "<i8", len(self.kinds))
            except FileNotFoundError:  # nothing was written for this range
                sizes = [0] * len(self.kinds)
            for size, kind in zip(sizes, self.kinds):
                out.append(map_file(name, kind, int(size), at) if size else np.empty(0, kind))
                at += int(size) * np.dtype(kind).itemsize
            self.maps[slot] = out
        return self.maps[slot]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        for slot, at in by_slot(hash_range(hashes, self.slots)):
            keys = self.slot(slot)[0]
            if len(keys):
                out[at] = keys[np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)] == hashes[at]
        return out

    def find(self, high: int, low: int) -> tuple[list[np.ndarray], int]:
        """The slot's arrays and the row of a 128-bit key (-1: none); kinds start with its halves."""
        arrays = self.slot(int(hash_range(np.array([high], np.uint64), self.slots)[0]))
        at = int(np.searchsorted(arrays[0], np.uint64(high)))
        while at < len(arrays[0]) and arrays[0][at] == high:
            if arrays[1][at] == low:
                return arrays, at
            at += 1
        return arrays, -1


class _Blocks:
    """Blocks of candidate text and the ranks of their sample positions."""

    def __init__(self, path: str, length: int):
        self.path, self.length = path, length

    def text(self, block: int) -> np.ndarray:
        return np.asarray(map_file(f"{self.path}/text-{block}", "u1"))

    def ends(self, offsets: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """End of the segment that holds each offset."""
        return stops[np.minimum(np.searchsorted(stops, offsets, "right"), len(stops) - 1)]

    def strings(self, block: int, offsets: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The sample strings at offsets, cut at their segment's end, as comparable byte strings."""
        n = self.length
        data = np.concatenate([self.text(block), np.zeros(n, np.uint8)])
        out = np.empty((len(offsets), n + 2), np.uint8)
        out[:, :n] = np.lib.stride_tricks.sliding_window_view(data, n)[offsets]
        left = np.minimum(self.ends(offsets, stops) - offsets, n)
        short = np.flatnonzero(left < n)
        if len(short):
            out[short, :n] *= np.arange(n)[None, :] < left[short, None]
        out[:, n], out[:, n + 1] = left // 255 + 1, left % 255 + 1  # never zero: no end is stripped
        return out.view(f"S{n + 2}").ravel()


def _first_of(sorted_values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, bool)


def _tie_sort(group: np.ndarray, residue: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Order of suffixes whose equal prefixes are adjacent (``group`` is non-decreasing), by the
    ranks at the shift that the cover has for each pair: merges of runs, all groups in step."""
    order = np.arange(len(group))
    first = np.flatnonzero(_first_of(group))
    start = first[np.cumsum(_first_of(group)) - 1]
    end = np.append(first[1:], len(group))[np.cumsum(_first_of(group)) - 1]
    longest = int((end - start).max(initial=0))
    run = 1
    while run < longest:
        at = np.flatnonzero(end - start > run)
        pair = start[at] + (at - start[at]) // (2 * run) * (2 * run)
        is_left = at < pair + run
        left, pair_of = at[is_left], pair[is_left]
        # how many of the right run stand before each of the left run
        low, high = np.minimum(pair_of + run, end[left]), np.minimum(pair_of + 2 * run, end[left])
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            a, b = order[left[open_]], order[middle]
            after = ranks[b, SLOT[residue[b], residue[a]]] < ranks[a, SLOT[residue[a], residue[b]]]
            low[open_] = np.where(after, middle + 1, low[open_])
            high[open_] = np.where(after, high[open_], middle)
        # Ranks look up to a period beyond the length, so starts that are equal over the length may
        # be told apart by one shift and not by another.  Places then differ among equals only;
        # made non-decreasing, they give one merge that keeps equals together.
        place = np.maximum.accumulate(low - base + pair_of) + (left - pair_of)
        new, free = order.copy(), np.ones(len(group), bool)
        new[place] = order[left]
        free[place] = False
        new[at[free[at]]] = order[at[~is_left]]
        order = new
        run *= 2
    return order


def _equal_starts(text: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which starts of a block are equal over ``length`` bytes to another one, and which stand for all
    that are equal to them (or for themselves alone)."""
    hashes = _gram_hashes(text, length)[offsets]
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order), bool)  # equal to the one before it in order
    near = np.flatnonzero(hashes[order][1:] == hashes[order][:-1]) + 1
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    for at in range(0, len(near), 20_000):
        some = near[at : at + 20_000]
        same[some] = (windows[offsets[order[some]]] == windows[offsets[order[some - 1]]]).all(1)
    hit, stands = np.zeros(len(order), bool), np.zeros(len(order), bool)
    hit[order] = same | np.append(same[1:], False)
    stands[order] = ~same
    return hit, stands


def _steps(offsets: np.ndarray) -> bytes:
    return pack_arrays(offsets[:1], np.diff(offsets).astype("<u4"))


def _removed(docs: DataFrame, length: int, doc_id: str, text: str, finish, schema: str) -> DataFrame:
    """Rows that ``finish(doc_id column, texts as bytes, spans per text)`` makes of the documents, in one pass."""
    if length < GRAM + WINDOW or length < PERIOD or length > 255 * 255:
        raise ValueError(f"length must be at least {max(PERIOD, GRAM + WINDOW)}")
    spark = docs.sparkSession
    path = work_dir(spark, "repeats")
    inner = length - (GRAM + WINDOW - 1)  # windows inside a string, less one
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    long = rows.filter(F.octet_length("text") >= length)
    size = long.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slots = max(8, -(-size // SLOT_BYTES))

    # 1. texts that have copies, with the id whose row stands for them
    copied = (
        long.select("doc_id", F.md5("text").alias("digest"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .filter(F.col("n") > 1)
    )
    copies = _Sorted(f"{path}/copies", slots, ("<u8", "<u8", "<i8", "u1"))

    def digest_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [bytes.fromhex(d) for d in batch.column("digest").to_pylist()]
            both = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
            first = np.array([0 if i is None else i for i in batch.column("first_id").to_pylist()], np.int64)
            null = np.array([i is None for i in batch.column("first_id").to_pylist()], np.uint8)
            yield _rows([(s, pack_arrays(both[at, 0], both[at, 1], first[at], null[at])) for s, at in by_slot(hash_range(both[:, 0], slots))])

    def write_copies(group: pa.Table) -> pa.Table:
        parts = zip(*map(unpack_arrays, group.column("blob").to_pylist()))
        columns = [np.concatenate(p) for p in parts]
        order = np.lexsort((columns[1], columns[0]))
        copies.write(group.column("slot")[0].as_py(), *[c[order] for c in columns])
        return pa.table({"n": [len(order)]})

    copied.mapInArrow(digest_slots, PART).groupBy("slot").applyInArrow(write_copies, "n long").agg(F.sum("n")).collect()

    def standing(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int]]:
        """The texts of a batch that have no copy, or stand for their copies."""
        for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            raw = t.encode()
            high, low = _digest(raw)
            found, at = copies.find(high, low)
            if at < 0 or (found[3][at] if d is None else found[2][at] == d and not found[3][at]):
                yield raw, high, low

    # 2. minima that occur twice, then the candidate text
    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _rows([(s, pack_arrays(keys[at], (n[at] > 1).astype(np.uint8))) for s, at in by_slot(hash_range(keys, slots))])

        for batch in batches:
            for raw, _, _ in standing(batch):
                for _, piece in _pieces(raw, length):
                    held.append(_minima(piece)[1])
                    size += len(held[-1])
                    if size > 1_000_000:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    repeated = _Sorted(f"{path}/minima", slots, ("<u8",))

    def write_minima(group: pa.Table) -> pa.Table:
        keys, twice = (np.concatenate(p) for p in zip(*map(unpack_arrays, group.column("blob").to_pylist())))
        order = np.argsort(keys, kind="stable")
        keys, twice = keys[order], twice[order].astype(bool)
        again = ~_first_of(keys)
        repeated.write(group.column("slot")[0].as_py(), np.unique(keys[twice | again]))
        return pa.table({"n": [int((twice | again).sum())]})

    long.mapInArrow(minima, PART).groupBy("slot").applyInArrow(write_minima, "n long").agg(F.sum("n")).collect()

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of text on file; rows of their segments: stop in the block, start in the text,
        number of starts, and the text's digest."""
        part = TaskContext.get().partitionId()
        serial, texts, segments, size = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            block = part << 32 | serial
            write_file(f"{path}/text-{block}", np.frombuffer(b"".join(texts), np.uint8))
            cols = [np.array(c, k) for c, k in zip(zip(*segments), ("<i8", "<i8", "<i8", "<u8", "<u8"))]
            return _rows([(block, pack_arrays(*cols))])

        for batch in batches:
            for raw, high, low in standing(batch):
                for begin, piece in _pieces(raw, length):
                    values, back = np.unique(_minima(piece)[0], return_inverse=True)
                    bad = ~repeated.has(values)[back]
                    if bad.all():
                        continue
                    sums = np.concatenate([[0], np.cumsum(bad)])
                    ok = sums[inner + 1 :] == sums[: len(sums) - inner - 1]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], ok.astype(np.int8), [0]])))
                    for a, b in edges.reshape(-1, 2).tolist():
                        texts.append(piece[a : b - 1 + length])
                        size += len(texts[-1])
                        segments.append((size, begin + a, b - a, high, low))
                    if size >= BLOCK_BYTES:
                        yield flush()
                        serial, texts, segments, size = serial + 1, [], [], 0
        if segments:
            yield flush()

    blocks = _Blocks(path, length)
    segments = stored(long.mapInArrow(candidates, PART), f"{path}/segments")

    # 3. ranks of the cover sample
    def sample_of(block: int, stops: np.ndarray) -> np.ndarray:
        every = np.arange(int(stops[-1]) // PERIOD + 1)[:, None] * PERIOD + COVER[None, :]
        every = every.ravel()
        return every[every < stops[-1]]

    def local(block: int, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sample offsets, their distinct strings in order, where each first stands, and which
        string each offset has."""
        stops = unpack_arrays(blob)[0]
        offsets = sample_of(block, stops)
        values, at, back = np.unique(blocks.strings(block, offsets, stops), return_index=True, return_inverse=True)
        return offsets, values, at, back

    total = segments.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    spans_of = _Sorted(f"{path}/spans", slots, ("<u8", "<u8", "<i8", "<i8", "<i8", "<i8"))
    if total:

        def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, blob in zip(batch.column("slot").to_pylist(), batch.column("blob").to_pylist()):
                    offsets, values, at, back = local(block, blob)
                    write_file(f"{path}/own-{block}", back.astype("<u4"))
                    write_file(f"{path}/first-{block}", at.astype("<u4"))
                    stops, _, starts, _, _ = unpack_arrays(blob)
                    some = values[:: max(1, len(values) // 64)]
                    keys = pa.array([bytes(v[:64]) for v in some], pa.binary())
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(values)] * n), pa.array([int(starts.sum())] * n), pa.array([1.0 / n] * n), keys],
                        names=["distinct", "starts", "share", "key"],
                    )

        keys = stored(segments.mapInArrow(keys_of, "distinct long, starts long, share double, key binary"), f"{path}/keys")
        size = keys.agg(F.sum(F.col("distinct") * F.col("share")).alias("d"), F.sum(F.col("starts") * F.col("share")).alias("s")).first()
        ranges = max(1, round(size["d"] / SAMPLE_BUCKET))
        buckets = max(1, -(-round(size["s"]) // SUFFIX_BUCKET))
        # splitters: one key per range, from a bounded sample of the keys
        picked = [bytes(r["key"]) for r in keys.select("key", F.xxhash64("key").alias("h")).orderBy("h", "key").limit(64 * min(ranges, 1024)).collect()]
        picked = np.unique(np.array(picked, "S64"))
        splitters = picked[np.linspace(0, len(picked), ranges, endpoint=False).astype(int)[1:]] if ranges > 1 else picked[:0]

        def deal_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, blob in zip(batch.column("slot").to_pylist(), batch.column("blob").to_pylist()):
                    stops = unpack_arrays(blob)[0]
                    offsets = sample_of(block, stops)
                    first = offsets[map_file(f"{path}/first-{block}", "<u4")]
                    values = blocks.strings(block, first, stops)
                    # values are sorted: number and offset of each range's part
                    cut = np.searchsorted(splitters, values.astype("S64"), "right")
                    for r, at in by_slot(cut):
                        yield _rows([(r, pack_arrays(np.array([block], "<i8"), at[:1].astype("<i8"), first[at].astype("<i8"), stops))])

        def rank(group: pa.Table) -> pa.Table:
            part = group.column("slot")[0].as_py()
            taken, values = [], []
            for blob in group.column("blob").to_pylist():
                block, at, first, stops = unpack_arrays(blob)
                taken.append((int(block[0]), int(at[0]), len(first)))
                values.append(blocks.strings(int(block[0]), first, stops))
            _, ranks = np.unique(np.concatenate(values), return_inverse=True)
            out, done = [], 0
            for block, at, n in taken:
                out.append((block, pack_arrays(np.array([at], "<i8"), (part << 32) + ranks[done : done + n].astype(np.int64))))
                done += n
            return pa.Table.from_batches([_rows(out)])

        def write_ranks(group: pa.Table) -> pa.Table:
            block = group.column("slot")[0].as_py()
            own = np.asarray(map_file(f"{path}/own-{block}", "<u4"))
            ranks = np.zeros(int(own.max()) + 1, np.int64)
            for blob in group.column("blob").to_pylist():
                at, some = unpack_arrays(blob)
                ranks[int(at[0]) : int(at[0]) + len(some)] = some
            write_file(f"{path}/rank-{block}", ranks[own])
            return pa.table({"n": [len(own)]})

        ranked = segments.mapInArrow(deal_sample, PART).groupBy("slot").applyInArrow(rank, PART)
        ranked.groupBy("slot").applyInArrow(write_ranks, "n long").agg(F.sum("n")).collect()

        # 4. suffix buckets
        def deal_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, blob in zip(batch.column("slot").to_pylist(), batch.column("blob").to_pylist()):
                    stops, _, n, _, _ = unpack_arrays(blob)
                    begin = np.concatenate([[0], stops[:-1]])
                    offsets = np.concatenate([np.arange(a, a + k) for a, k in zip(begin.tolist(), n.tolist())])
                    hit, stands = _equal_starts(blocks.text(block), offsets, length)
                    write_file(f"{path}/equal-{block}", offsets[hit].astype("<u4"))
                    offsets = offsets[stands]
                    hashes = _gram_hashes(blocks.text(block), PERIOD)[offsets]
                    yield _rows([
                        (s, pack_arrays(np.array([block], "<i8"), offsets[at].astype("<u4"), hashes[at]))
                        for s, at in by_slot(hash_range(hashes, buckets))
                    ])

        def sort_bucket(group: pa.Table) -> pa.Table:
            block_of, offsets, hashes = [], [], []
            for blob in group.column("blob").to_pylist():
                block, own, h = unpack_arrays(blob)
                block_of.append(np.full(len(own), block[0]))
                offsets.append(own.astype(np.int64))
                hashes.append(h)
            block_of, offsets, hashes = (np.concatenate(x) for x in (block_of, offsets, hashes))
            order = np.argsort(hashes, kind="stable")
            sorted_hashes = hashes[order]
            first = _first_of(sorted_hashes)
            alone = first & np.append(first[1:], True)
            order = order[~alone]  # a start that shares its prefix with none repeats nowhere
            block_of, offsets, hashes = block_of[order], offsets[order], hashes[order]
            same = np.cumsum(_first_of(hashes))
            ranks = np.empty((len(order), len(COVER)), np.int64)
            for block, at in by_slot(block_of):
                own = np.concatenate([map_file(f"{path}/rank-{block}", "<i8"), np.full(len(COVER), -1)])
                ranks[at] = own[_sample_index(offsets[at])[:, None] + np.arange(len(COVER))]
            residue = offsets % PERIOD
            order = _tie_sort(same, residue, ranks)
            a, b = order[:-1], order[1:]
            near = np.flatnonzero(same[a] == same[b])
            a, b = a[near], b[near]
            equal = ranks[a, SLOT[residue[a], residue[b]]] == ranks[b, SLOT[residue[b], residue[a]]]
            open_ = np.flatnonzero(~equal)  # the ranks look beyond the length: compare the bytes
            for at in range(0, len(open_), 50_000):
                some = open_[at : at + 50_000]
                sides = []
                for side in (a[some], b[some]):
                    text = np.empty((len(side), length), np.uint8)
                    for block, where in by_slot(block_of[side]):
                        text[where] = np.lib.stride_tricks.sliding_window_view(blocks.text(block), length)[offsets[side[where]]]
                    sides.append(text.view(f"V{length}").ravel())
                equal[some] = sides[0] == sides[1]
            hit = np.unique(np.concatenate([a[equal], b[equal]]))
            out = []
            for block, at in by_slot(block_of[hit]):
                found = np.sort(offsets[hit[at]])
                out.append((block, _steps(found)))
            return pa.Table.from_batches([_rows(out)])

        # 5. spans per text
        def spans(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.Table.from_batches([_rows([])])
            stops, starts, n, high, low = unpack_arrays(left.column("blob")[0].as_py())
            marked = np.zeros(int(stops[-1]) + 1, np.int8)
            marked[map_file(f"{path}/equal-{left.column('slot')[0].as_py()}", "<u4")] = 1
            for blob in right.column("blob").to_pylist():
                at, steps = unpack_arrays(blob)
                marked[np.concatenate([at, at[0] + np.cumsum(steps.astype(np.int64))])] = 1
            edges = np.flatnonzero(np.diff(np.concatenate([[0], marked, [0]])))
            a, b = edges[::2], edges[1::2]
            if not len(a):
                return pa.Table.from_batches([_rows([])])
            begin = np.concatenate([[0], stops[:-1]])
            seg = np.searchsorted(stops, a, "right")
            # a run of starts stays inside its segment: its last start reaches the segment's end
            x, y = a - begin[seg] + starts[seg], b - 1 - begin[seg] + starts[seg] + length
            high, low = high[seg], low[seg]
            return pa.Table.from_batches([_rows([(s, pack_arrays(high[at], low[at], x[at], y[at])) for s, at in by_slot(hash_range(high, slots))])])

        def write_spans(group: pa.Table) -> pa.Table:
            high, low, x, y = (np.concatenate(p) for p in zip(*map(unpack_arrays, group.column("blob").to_pylist())))
            order = np.lexsort((x, low, high))
            high, low, x, y = (v[order] for v in (high, low, x, y))
            first = np.flatnonzero(_first_of(high) | _first_of(low))
            spans_of.write(group.column("slot")[0].as_py(), high[first], low[first], first, np.append(first[1:], len(high)), x, y)
            return pa.table({"n": [len(first)]})

        hits = segments.mapInArrow(deal_starts, PART).groupBy("slot").applyInArrow(sort_bucket, PART)
        own = spark.read.schema(PART).parquet(f"{path}/segments")
        own.groupBy("slot").cogroup(hits.groupBy("slot")).applyInArrow(spans, PART).groupBy("slot").applyInArrow(
            write_spans, "n long"
        ).agg(F.sum("n")).collect()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raws, out = [t.encode() for t in part.column("text").to_pylist()], []
                for raw in raws:
                    found: list[list[int]] = []
                    if len(raw) >= length:
                        high, low = _digest(raw)
                        if copies.find(high, low)[1] >= 0:
                            found = [[0, len(raw)]]
                        elif total:
                            arrays, k = spans_of.find(high, low)
                            if k >= 0:
                                for x, y in zip(arrays[4][arrays[2][k] : arrays[3][k]].tolist(), arrays[5][arrays[2][k] : arrays[3][k]].tolist()):
                                    if found and x <= found[-1][1]:
                                        found[-1][1] = max(found[-1][1], y)
                                    else:
                                        found.append([x, y])
                    out.append(found)
                yield finish(part.column("doc_id"), raws, out)

    return rows.mapInArrow(cut, schema)


def removed_spans(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: ``doc_id, text`` and ``spans``, the removed byte ranges ``[start, end)``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(ids: pa.Array, raws: list[bytes], spans: list[list[list[int]]]) -> pa.RecordBatch:
        listed = pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], kind)
        return pa.RecordBatch.from_arrays([ids, pa.array([r.decode() for r in raws], pa.string()), listed], names=["doc_id", "text", "spans"])

    return _removed(docs, length, doc_id, text, finish, "doc_id long, text string, spans array<struct<start: long, end: long>>")


def removal_digests(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``; no text leaves its task."""

    def finish(ids: pa.Array, raws: list[bytes], spans: list[list[list[int]]]) -> pa.RecordBatch:
        rows = []
        for raw, found in zip(raws, spans):
            at, kept, n = 0, hashlib.sha256(), 0
            for x, y in found:
                kept.update(raw[at:x])
                at, n = y, n + y - x
            kept.update(raw[at:])
            rows.append((len(raw), n, len(found), kept.hexdigest()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = [pa.int64()] * 3 + [pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _removed(docs, length, doc_id, text, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
