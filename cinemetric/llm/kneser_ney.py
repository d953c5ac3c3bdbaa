"""Operator 2: interpolated modified Kneser-Ney language model on memory-mapped hash arrays.

Counting (Spark tasks over texts, pre-aggregated, then one shuffle per level):

1. words: 64-bit hashes and counts, merged per range of hashes into sorted arrays.  A word's place
   in them is its id.
2. bigrams: keys ``context * (V + 1) + word`` with counts, merged per shard into sorted arrays.  A
   context's keys share a shard, but a context with very many tokens is spread over several, by
   word.
3. per context: total and the numbers of words seen once, twice, more often; per word: in how many
   contexts it occurs (the continuation count).  Both are dense arrays in blocks of ids.

The discounts of both levels come from counts of counts.  The files lie in the shared folder; a
scoring worker maps them into memory and looks its keys up in sorted order, so it holds one batch
of texts, never the model.  Intermediate tables carry compressed arrays rather than rows.

The model has order two: a third level would shuffle about as many keys as there are tokens.
A bigram's stored count ends at 2^32 - 1 (its context's total does not).
Text model: bytes A-Z lowered, words between ASCII white space, a begin mark as first context and
an end token, which is scored.  A word is known by its 64-bit hash.

Defined cases: a null or empty text is its end token; a null id counts as the empty text in the
fold; without training rows every token has probability one; repeated rows count each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.arrays import by_slot, hash_range, pack_arrays, unpack_arrays
from cinemetric.llm.shared import map_file, stored, work_dir, write_file

END = b"\n"  # no word holds white space
ID_BLOCK = 1 << 20
SHARD_TOKENS = 4_000_000
PART = "slot long, blob binary"


def tokens(text: str | None) -> list[bytes]:
    out = (text or "").encode().lower().split()
    out.append(END)
    return out


def _rows(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    slots, blobs = zip(*parts) if parts else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(blobs, pa.binary())], names=["slot", "blob"])


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(keys) else counts)


@dataclass
class Words:
    """The vocabulary: sorted hashes and counts per slot, mapped when first used."""

    path: str
    sizes: list[int]
    total: int = 0
    _maps: dict = field(default_factory=dict, repr=False)
    _known: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.bases = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def __getstate__(self):
        return {"path": self.path, "sizes": self.sizes, "total": self.total, "bases": self.bases, "_maps": {}, "_known": {}}

    @property
    def count(self) -> int:
        return int(self.bases[-1])

    def _slot(self, slot: int):
        if slot not in self._maps:
            n = self.sizes[slot]
            name = f"{self.path}/words-{slot}"
            self._maps[slot] = (map_file(name, "<u8", n), map_file(name, "<i8", n, 8 * n)) if n else (np.empty(0, "u8"), np.empty(0, "i8"))
        return self._maps[slot]

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes, -1 if never trained on."""
        out = np.full(len(hashes), -1, np.int64)
        for slot, at in by_slot(hash_range(hashes, len(self.sizes))):
            keys = self._slot(slot)[0]
            if len(keys):
                place = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
                out[at] = np.where(keys[place] == hashes[at], self.bases[slot] + place, -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of ids (0 for -1)."""
        out = np.zeros(len(ids), np.int64)
        slots = np.searchsorted(self.bases, ids, "right") - 1
        slots[ids < 0] = -1
        for slot, at in by_slot(slots):
            if slot >= 0:
                out[at] = self._slot(slot)[1][ids[at] - self.bases[slot]]
        return out

    def ids(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > 400_000:
            known.clear()
        new = list({w for w in words if w not in known})
        if new:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
            known.update(zip(new, self.look_up(hashes).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class Blocks:
    """A dense array over ids, in files of ``ID_BLOCK`` values."""

    def __init__(self, path: str, dtype: str):
        self.path, self.dtype, self.maps = path, dtype, {}

    def __getstate__(self):
        return {"path": self.path, "dtype": self.dtype, "maps": {}}

    def at(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), self.dtype)
        for block, where in by_slot(ids // ID_BLOCK):
            if block >= 0:
                if block not in self.maps:
                    try:
                        self.maps[block] = map_file(f"{self.path}-{block}", self.dtype)
                    except FileNotFoundError:  # no id of the block has a value
                        self.maps[block] = np.zeros(ID_BLOCK, self.dtype)
                out[where] = self.maps[block][ids[where] % ID_BLOCK]
        return out


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from counts of counts 1..4."""
    if n[0] <= 0 or n[1] <= 0:
        return np.array([0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2.0 * n[1])
    raw = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] > 0 and n[i] > 0 else 0.9 for i in (1, 2, 3)]
    return np.clip(raw, 0.05, [0.999, 1.999, 2.999])


def _discount(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], d])[np.minimum(counts, 3)]


def _pairs(words: Words, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context ids (the begin mark is ``words.count``), word ids, and each document's length."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = words.ids([w for ws in lists for w in ws])
    contexts = np.empty_like(ids)
    contexts[1:] = ids[:-1]
    contexts[np.cumsum(sizes) - sizes] = words.count
    return contexts, ids, sizes


def _shard_of(words: Words, contexts: np.ndarray, ids: np.ndarray, shards: int) -> np.ndarray:
    """A context's shard; contexts above a shard's share of tokens are spread by word."""
    own = words.counts(np.where(contexts == words.count, -1, contexts))
    spread = np.maximum(1, -(-own // SHARD_TOKENS)).astype(np.uint64)
    spread[contexts == words.count] = max(1, shards // 4)  # the begin mark: one per document
    salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % spread
    mixed = (contexts.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20)) + salt * np.uint64(0x100000001B3)
    return (mixed % np.uint64(shards)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of up to about ``size`` tokens (one document at least), tokenized."""
    for batch in batches:
        texts = batch.column("text")
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
        start = held = 0
        for i, n in enumerate(lengths.tolist()):
            held += n // 5 + 1
            if held >= size or i == len(lengths) - 1:
                part = batch.slice(start, i + 1 - start)
                yield part, [tokens(t) for t in part.column("text").to_pylist()]
                start, held = i + 1, 0


@dataclass
class Model:
    words: Words
    shards: int
    path: str
    bigram: np.ndarray
    unigram: np.ndarray
    continuations: int  # number of distinct bigrams
    spare: float  # unigram mass that the discounts free
    totals: Blocks = None
    gammas: Blocks = None
    lefts: Blocks = None

    def __post_init__(self):
        self.totals = Blocks(f"{self.path}/total", "<i8")
        self.gammas = Blocks(f"{self.path}/gamma", "<f8")
        self.lefts = Blocks(f"{self.path}/left", "<i8")
        self.maps: dict[int, tuple] = {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def _count(self, contexts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Training counts of bigrams, by binary search in the mapped shards."""
        out = np.zeros(len(ids), np.int64)
        seen = np.flatnonzero((contexts >= 0) & (ids >= 0))
        keys, back = np.unique(contexts[seen].astype(np.uint64) * np.uint64(self.words.count + 1) + ids[seen].astype(np.uint64), return_inverse=True)
        base = np.uint64(self.words.count + 1)
        slots = _shard_of(self.words, (keys // base).astype(np.int64), (keys % base).astype(np.int64), self.shards)
        found = np.zeros(len(keys), np.int64)
        for shard, at in by_slot(slots):
            if shard not in self.maps:
                n = int(map_file(f"{self.path}/bigrams-{shard}", "<i8", 1)[0])
                self.maps[shard] = map_file(f"{self.path}/bigrams-{shard}", "<u8", n, 8), map_file(f"{self.path}/bigrams-{shard}", "<u4", n, 8 + 8 * n)
            known, counts = self.maps[shard]
            if len(known):
                place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                found[at] = np.where(known[place] == keys[at], counts[place], 0)
        out[seen] = found[back]
        return out

    def probabilities(self, contexts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Interpolated probability of each word after its context."""
        v = self.words.count
        if not v:
            return np.ones(len(ids))
        left = self.lefts.at(ids)
        low = np.maximum(left - _discount(left, self.unigram), 0.0) / self.continuations + self.spare / (v + 1)
        total = self.totals.at(contexts)
        count = self._count(contexts, ids)
        high = np.maximum(count - _discount(count, self.bigram), 0.0) / np.maximum(total, 1)
        return np.where(total > 0, high + self.gammas.at(contexts) * low, low)


def _count_words(rows: DataFrame, path: str, slots: int) -> Words:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, held), np.uint64, len(held))
            times = np.fromiter(held.values(), np.int64, len(held))
            keys, times = _merged(hashes, times)
            held.clear()
            return _rows([(s, pack_arrays(keys[at], times[at])) for s, at in by_slot(hash_range(keys, slots))])

        for _, lists in _batches(batches, 200_000):
            for words in lists:
                held.update(words)
            if len(held) > 500_000:
                yield flush()
        if held:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        slot = group.column("slot")[0].as_py()
        parts = [unpack_arrays(b) for b in group.column("blob").to_pylist()]
        keys, times = _merged(*(np.concatenate(side) for side in zip(*parts)))
        write_file(f"{path}/words-{slot}", keys, times)
        return pa.table({"slot": [slot], "n": [len(keys)], "total": [int(times.sum())]})

    found = rows.mapInArrow(count, PART).groupBy("slot").applyInArrow(merge, "slot long, n long, total long")
    sizes, total = [0] * slots, 0
    for r in found.collect():  # one row per slot
        sizes[r["slot"]] = r["n"]
        total += r["total"]
    return Words(path, sizes, total)


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count the texts of ``docs`` and write the model's files to the shared folder."""
    spark = docs.sparkSession
    path = work_dir(spark, "kneser-ney")
    rows = docs.select(F.col(text).cast("string").alias("text"))
    words = _count_words(rows, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = max(1, -(-words.total // SHARD_TOKENS))
    base = np.uint64(words.count + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            held.clear()
            keys, times = _merged(keys, np.ones(len(keys), np.int64))
            slots = _shard_of(words, (keys // base).astype(np.int64), (keys % base).astype(np.int64), shards)
            parts = []
            for s, at in by_slot(slots):
                own = keys[at]
                contexts = (own // base).astype(np.int64)
                # sorted by context: small steps; compressed column by column
                parts.append((s, pack_arrays(contexts[:1], np.diff(contexts), (own % base).astype("<u4" if words.count < 1 << 32 else "<u8"), times[at].astype("<u4"))))
            return _rows(parts)

        for _, lists in _batches(batches, 200_000):
            contexts, ids, _ = _pairs(words, lists)
            held.append(contexts.astype(np.uint64) * base + ids.astype(np.uint64))
            size += len(ids)
            if size >= SHARD_TOKENS:
                yield flush()
                size = 0
        if held:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("slot")[0].as_py()
        keys, times = [], []
        for blob in group.column("blob").to_pylist():
            first, steps, own, n = unpack_arrays(blob)
            contexts = np.concatenate([first, first[0] + np.cumsum(steps)]).astype(np.uint64)
            keys.append(contexts * base + own.astype(np.uint64))
            times.append(n.astype(np.int64))
        key, n = _merged(np.concatenate(keys), np.concatenate(times))
        write_file(f"{path}/bigrams-{shard}", np.array([len(key)], "<i8"), key, np.minimum(n, 0xFFFFFFFF).astype("<u4"))
        contexts = (key // base).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], np.diff(contexts) != 0]))
        per_context = [np.add.reduceat(x.astype(np.int64), first) for x in (n, n == 1, n == 2, n > 2)]
        right, lefts = np.unique((key % base).astype(np.int64), return_counts=True)
        kinds = []
        for block, at in by_slot(contexts[first] // ID_BLOCK):
            kinds.append(("context", block, pack_arrays(contexts[first][at] % ID_BLOCK, *[x[at].astype("<u4") if x.max() < 1 << 32 else x[at] for x in per_context])))
        for block, at in by_slot(right // ID_BLOCK):
            kinds.append(("word", block, pack_arrays((right[at] % ID_BLOCK).astype("<u4"), lefts[at].astype("<u4"))))
        kinds.append(("counts", 0, pack_arrays(np.array([(n == i).sum() for i in (1, 2, 3, 4)] + [len(key)], "<i8"))))
        names, blocks, blobs = zip(*kinds)
        return pa.table({"kind": names, "block": pa.array(blocks, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    keyed = rows.mapInArrow(count, PART).groupBy("slot").applyInArrow(merge, "kind string, block long, blob binary")
    keyed = stored(keyed, f"{path}/levels")
    seen = sum((unpack_arrays(r["blob"])[0] for r in keyed.filter("kind = 'counts'").collect()), np.zeros(5, np.int64))  # one row per shard
    bigram = discounts(seen[:4].astype(float))

    def finish(group: pa.Table) -> pa.Table:
        kind, block = group.column("kind")[0].as_py(), group.column("block")[0].as_py()
        size = min(ID_BLOCK, words.count + 1 - block * ID_BLOCK)
        sums = np.zeros((4 if kind == "context" else 1, size), np.int64)
        for blob in group.column("blob").to_pylist():
            ids, *values = unpack_arrays(blob)
            for row, x in zip(sums, values):
                np.add.at(row, ids.astype(np.int64), x.astype(np.int64))
        if kind == "context":
            write_file(f"{path}/total-{block}", sums[0])
            write_file(f"{path}/gamma-{block}", (bigram @ sums[1:]) / np.maximum(sums[0], 1))
            return pa.table({"n": pa.array([], pa.list_(pa.int64()))})
        write_file(f"{path}/left-{block}", sums[0])
        return pa.table({"n": pa.array([[int((sums[0] == i).sum()) for i in (1, 2, 3, 4)] + [int((sums[0] > 2).sum())]], pa.list_(pa.int64()))})

    ends = keyed.filter("kind <> 'counts'").groupBy("kind", "block").applyInArrow(finish, "n array<long>")
    low = sum((np.array(r["n"], np.int64) for r in ends.collect()), np.zeros(5, np.int64))  # one row per block of ids
    unigram = discounts(low[:4].astype(float))
    pairs = int(seen[4])
    spare = float(unigram @ np.array([low[0], low[1], low[4]])) / max(pairs, 1)
    return Model(words, shards, path, bigram, unigram, max(pairs, 1), spare)


SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the text's token numbers, unigram ``base_score`` and model ``score`` (log10)."""
    names = [f.split()[0] for f in SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.words
        floor = 0.1 * (words.count + 1) + words.total
        for batch, lists in _batches(batches, 400_000):
            contexts, ids, sizes = _pairs(words, lists)
            if not words.count:
                contexts[:] = -1
            starts = np.cumsum(sizes) - sizes
            counts = words.counts(ids)
            base = np.log10((counts + 0.1) / floor)
            logs = np.log10(model.probabilities(contexts, ids))
            columns = [sizes, np.add.reduceat((counts > 0).astype(np.int64), starts), np.full(len(sizes), words.total)]
            columns += [np.add.reduceat(base, starts), np.add.reduceat(logs, starts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, columns)], names=[*batch.schema.names[:-1], *names])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("text"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, SCORES]))
