"""Operator 13: phrase collocations from an FM-index per shard over word ids.

1. Tasks cut their texts into pieces and words and gather them, per language, into shards of about
   ``SHARD_BYTES``: a sequence of numbers of the shard's distinct words, 0 between pieces.
2. Words are counted over all shards; only frequent ones can stand in a candidate, so they get dense
   ids (in the order of language and word) and all others become breaks.
3. Per length 2, 3, 4: each shard builds the index of its sequence in both directions (suffixes
   sorted to that depth, their BWT, last-to-first mapping) and extends the intervals of its words by
   turns to the right and to the left, keeping the interval of either direction; that lists every
   n-gram with its count.  Counts are summed across shards in one shuffle, in which a shard's n-grams
   travel as sorted, compressed arrays per slot of their hash; a bit per n-gram comes back, and those
   that stay rare become breaks in their shards before the next length, so no n-gram is listed of
   which a part is rare.
4. The frequent n-grams are the candidates.  Counts of their parts, and the highest count among
   their one-word extensions to the left and right (which decides containment: of a longer
   candidate that holds a phrase, the n-grams between them are at least as frequent), come by joins.

Nothing is dropped that could matter: a part of a frequent n-gram is frequent.  A shard is as long as
``SHARD_BYTES`` or its longest text; a slot holds about ``SLOT_GRAMS`` n-grams, of which each has one
entry per shard at most.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated rows count each;
without candidates, or from an empty table, no rows; extra columns are left out.  Text is UTF-8
bytes, of which only A-Z are lowered; words are whatever stands between blanks and tabs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.llm.arrays import by_slot, hash_range, pack_arrays, unpack_arrays
from cinemetric.llm.idtable import hashed
from cinemetric.llm.shared import stored, work_dir
from cinemetric.operators.keys import ordered_index

SHARD_BYTES = 8 << 20
SLOT_GRAMS = 1 << 21
LONGEST = 4
NO_LANGUAGE = "und"
#: What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

SHARDS = "shard long, lang string, n long, words array<binary>, counts array<long>, seq binary"
STATE = "shard long, size long, seq binary, ids array<long>"
_KEY = [f"g{i + 1}" for i in range(LONGEST)]
GRAMS = "slot long, shard long, grams binary"
VERDICTS = "shard long, slot long, alive binary, " + ", ".join(f"{g} long" for g in _KEY) + ", f long"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.array([2 if b in PIECE_ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)


def word_sequence(data: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers from 1 of a text's words with 0 between pieces, the distinct words, their counts."""
    raw = np.frombuffer(data.translate(_LOWER), np.uint8)
    kind = _KIND[raw]
    word = np.concatenate([[False], kind == 0, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, stop = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(1, np.int64), pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[kind == 0].tobytes())]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), buffers).dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    breaks = np.flatnonzero(np.diff(piece)) + 1
    return np.insert(number + 1, breaks, 0), coded.dictionary, np.bincount(number)


def _closed(seq: np.ndarray) -> np.ndarray:
    """The sequence as a circle with one 0 at its seam and single 0s inside."""
    seq = np.concatenate([[0], seq])
    return seq[(seq > 0) | (np.append(1, seq[:-1]) > 0)]


def _depth_keys(seq: np.ndarray, depth: int) -> np.ndarray:
    """Keys that order the circle's positions by their next ``depth`` symbols."""
    key, have = seq, 1
    base = int(seq.max(initial=0)) + 1
    while have < depth:
        more = min(have, depth - have)
        other = key if more == have else seq
        key = key * (int(other.max(initial=0)) + 1 if more == have else base) + np.roll(other, -have)
        have += more
        if have < depth:
            key = np.unique(key, return_inverse=True)[1]
    return key


class Direction:
    """The index of a circular sequence in one direction, exact for patterns below ``depth`` symbols."""

    def __init__(self, seq: np.ndarray, depth: int):
        suffixes = np.argsort(_depth_keys(seq, depth), kind="stable")
        self.bwt = seq[suffixes - 1]
        order = np.argsort(self.bwt, kind="stable")
        self.last_to_first = np.empty(len(seq), np.int64)
        self.last_to_first[order] = np.arange(len(seq))


class BothDirections:
    """Intervals of patterns in the index of a sequence (``low``) and of its reverse (``other``)."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.symbols = int(seq.max(initial=0)) + 1
        self.left, self.right = Direction(seq, depth), Direction(seq[::-1], depth)
        counts = np.bincount(seq, minlength=self.symbols)
        self.firsts = np.cumsum(counts) - counts
        self.counts = counts

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``low, other, size`` and the words of all single-word patterns."""
        low = self.firsts[1:]
        return low, low, self.counts[1:], np.arange(1, self.symbols)[:, None]

    def _extended(self, index: Direction, low: np.ndarray, other: np.ndarray, size: np.ndarray):
        """Patterns with one more symbol at the side that ``index`` reads: parent, symbol, low, other, size."""
        parent = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        key = parent * self.symbols + index.bwt[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(first, append=len(key))
        parent, symbol = key[first] // self.symbols, key[first] % self.symbols
        before = first - (np.cumsum(size) - size)[parent]  # smaller symbols beside the same parent
        low, other = index.last_to_first[rows[order[first]]], other[parent] + before
        real = symbol > 0
        return parent[real], symbol[real], low[real], other[real], counts[real]

    def extend(self, low, other, size, words, leftwards: bool):
        if leftwards:
            parent, symbol, low, other, size = self._extended(self.left, low, other, size)
            return low, other, size, np.column_stack([symbol, words[parent]])
        parent, symbol, other, low, size = self._extended(self.right, other, low, size)
        return low, other, size, np.column_stack([words[parent], symbol])


def ngrams(seq: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of ``depth`` words in a closed sequence, in the order of their symbols, with counts."""
    index = BothDirections(seq, depth)
    low, other, size, words = index.words()
    for k in range(2, depth + 1):
        low, other, size, words = index.extend(low, other, size, words, leftwards=k == 3)
    order = np.argsort(low, kind="stable")
    return words[order], size[order]


def occurrences(seq: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where n-grams of ``depth`` words stand, the place of each in ``ngrams``, and the words of all places."""
    whole = np.ones(len(seq), bool)
    for k in range(depth):
        whole &= np.roll(seq, -k) > 0
    at = np.flatnonzero(whole)
    first, places = np.unique(_depth_keys(seq, depth)[at], return_index=True, return_inverse=True)[1:]
    return at, places, seq[at[first][:, None] + np.arange(depth)]


def broken(seq: np.ndarray, depth: int, at: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The sequence with a break wherever the n-gram of ``depth`` words that stands at ``at`` is not alive."""
    # words of an n-gram that is kept stay; between two that do not share the rest of one is a break
    starts = at[alive]
    if not len(starts):
        return np.zeros(1, seq.dtype)
    run = np.append(True, np.diff(starts) > 1)
    first, last = starts[run], starts[np.append(run[1:], True)] + depth - 1
    size = last - first + 2
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    out = seq[np.minimum(at, len(seq) - 1)].copy()
    out[np.cumsum(size) - 1] = 0
    return _closed(out)


def _keys(ids: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a shard as two numbers each: the first two words, and what follows."""
    g = np.zeros((len(words), LONGEST), np.uint64)
    g[:, : words.shape[1]] = ids.astype(np.uint64)[words - 1]
    up = np.uint64(32)
    return g[:, 0] << up | g[:, 1], g[:, 2] << up | g[:, 3]


def _slots(front: np.ndarray, rest: np.ndarray, slots: int) -> np.ndarray:
    return hash_range(hashed(front, rest, np.uint64(1)), slots)


def _pack_grams(front: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted n-grams and their counts; the bytes of one weight stand together, which packs them well."""
    planes = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).ravel()
    return pack_arrays(planes(np.diff(front, prepend=np.uint64(0))), planes(rest), planes(counts.astype(np.uint64)))


def _unpack_grams(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    front, rest, counts = (np.ascontiguousarray(x.reshape(8, -1).T).view(np.uint64).ravel() for x in unpack_arrays(blob))
    return np.cumsum(front, dtype=np.uint64), rest, counts


def _batch(schema: str, **columns) -> pa.RecordBatch:
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], types[t]) for n, t in fields], names=[n for n, _ in fields])


def shards(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Word sequences of whole texts, gathered per task and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(name: str):
            nonlocal shard
            # a piece ends with its text
            seq, words, counts = word_sequence(b"\n".join(held.pop(name)))
            del sizes[name]
            if len(words):
                shard += 1
                yield _batch(
                    SHARDS, shard=[shard], lang=[name], n=[int(counts.sum())], words=[words.to_pylist()],
                    counts=[counts], seq=[pack_arrays(seq.astype(np.uint32))],
                )

        for batch in batches:
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if t:
                    held.setdefault(name, []).append(t)
                    sizes[name] = sizes.get(name, 0) + len(t) + 1
                    if sizes[name] >= SHARD_BYTES:
                        yield from flush(name)
                    elif sum(sizes.values()) >= 2 * SHARD_BYTES:  # many small languages
                        yield from flush(max(sizes, key=sizes.get))
        for name in list(held):
            yield from flush(name)

    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    return docs.select(language, F.col(text).cast("string").alias("text")).mapInArrow(run, SHARDS)


def _state(shard: int, seq: np.ndarray, ids: np.ndarray) -> pa.Table:
    return _table(STATE, shard=[shard], size=[len(seq)], seq=[pack_arrays(seq.astype(np.uint32))], ids=[ids])


def _frequent_sequence(left: pa.Table, right: pa.Table) -> pa.Table:
    """A shard's sequence over its frequent words, numbered in the order of their ids."""
    if not left.num_rows or not right.num_rows:
        return _table(STATE)
    right = right.sort_by("id")
    seq = unpack_arrays(left.column("seq")[0].as_py())[0].astype(np.int64)
    number = np.zeros(int(seq.max()) + 1, np.int64)
    number[right.column("place").to_numpy() + 1] = np.arange(1, right.num_rows + 1)
    return _state(left.column("shard")[0].as_py(), _closed(number[seq]), right.column("id").to_numpy())


def _table(schema: str, **columns) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.Table.from_batches([_batch(schema, **(columns or {n: [] for n in names}))])


def shard_ngrams(state: DataFrame, depth: int, slots: int) -> DataFrame:
    """``slot, shard, grams``: every n-gram of ``depth`` words of every shard with its count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob, ids in zip(batch.column("shard").to_pylist(), batch.column("seq").to_pylist(), batch.column("ids")):
                words, counts = ngrams(unpack_arrays(blob)[0].astype(np.int64), depth)
                front, rest = _keys(ids.values.to_numpy(), words)
                rows = [(s, _pack_grams(front[at], rest[at], counts[at])) for s, at in by_slot(_slots(front, rest, slots))]
                for at in range(0, len(rows), 64):
                    part = rows[at : at + 64]
                    yield _batch(GRAMS, slot=[s for s, _ in part], shard=[shard] * len(part), grams=[x for _, x in part])

    return state.mapInArrow(run, GRAMS)


def _summed(min_count: int):
    """One slot: a bit per n-gram and shard, and the frequent n-grams with their counts."""

    def run(table: pa.Table) -> pa.Table:
        given = [_unpack_grams(x) for x in table.column("grams").to_pylist()]
        sizes = [len(x[0]) for x in given]
        front, rest, counts = (np.concatenate(x) for x in zip(*given))
        order = np.lexsort((rest, front))
        new = np.ones(len(order), bool)
        new[1:] = (front[order][1:] != front[order][:-1]) | (rest[order][1:] != rest[order][:-1])
        first = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order], first).astype(np.int64)
        alive = np.empty(len(order), bool)
        alive[order] = np.repeat(totals >= min_count, np.diff(first, append=len(order)))
        n, kept = table.num_rows, order[first[totals >= min_count]]
        none, low = [None] * n, np.uint64(0xFFFFFFFF)
        bits = [np.packbits(x).tobytes() for x in np.split(alive, np.cumsum(sizes)[:-1])]
        words = (front[kept] >> np.uint64(32), front[kept] & low, rest[kept] >> np.uint64(32), rest[kept] & low)
        blank = [None] * len(kept)
        return pa.Table.from_batches([
            _batch(VERDICTS, shard=table.column("shard").to_pylist(), slot=table.column("slot").to_pylist(), alive=bits, f=none, **{g: none for g in _KEY}),
            _batch(VERDICTS, shard=blank, slot=blank, alive=blank, f=totals[totals >= min_count], **{g: w.astype(np.int64) for g, w in zip(_KEY, words)}),
        ])

    return run


def _reduced(depth: int, slots: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(STATE)
        seq = unpack_arrays(left.column("seq")[0].as_py())[0].astype(np.int64)
        ids = left.column("ids").chunk(0).values.to_numpy()
        at, places, words = occurrences(seq, depth)
        bits = dict(zip(right.column("slot").to_pylist(), right.column("alive").to_pylist()))
        alive = np.zeros(len(words), bool)
        for slot, grams in by_slot(_slots(*_keys(ids, words), slots)):
            alive[grams] = np.unpackbits(np.frombuffer(bits[slot], np.uint8), count=len(grams))
        seq = broken(seq, depth, at, alive[places])
        return _state(left.column("shard")[0].as_py(), seq, ids) if len(seq) > 1 else _table(STATE)

    return run


def _whole(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def frequent_ngrams(docs: DataFrame, min_count: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (``id, lang, word, f``), frequent n-grams (``g1.., f``; single words too; 0 behind
    the last), and words per language (``lang, n``)."""
    folder = work_dir(docs.sparkSession, "collocations")
    cut = stored(shards(docs, lang, text), f"{folder}/shards")
    totals = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    local = cut.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    local = local.select("shard", "place", "lang", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = local.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    words = stored(ordered_index(stored(counted, f"{folder}/counted"), ["lang", "word"], "id"), f"{folder}/words")
    words = words.withColumn("id", F.col("id").cast("long"))
    hits = local.join(words, ["lang", "word"]).select(F.col("shard").alias("of"), F.col("place").cast("long").alias("place"), "id")
    state = cut.select("shard", "seq").groupBy("shard").cogroup(hits.groupBy("of")).applyInArrow(_frequent_sequence, STATE)
    state = stored(state, f"{folder}/words-state")
    found = [words.select(F.col("id").alias("g1"), *[F.lit(0).cast("long").alias(g) for g in _KEY[1:]], "f")]
    for depth in range(2, LONGEST + 1):
        positions = state.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]  # no shard has more n-grams
        slots = max(1, -(-positions // SLOT_GRAMS))
        summed = shard_ngrams(state, depth, slots).groupBy("slot").applyInArrow(_summed(min_count), VERDICTS)
        summed = stored(summed, f"{folder}/grams-{depth}")
        found.append(summed.filter("shard IS NULL").select(*_KEY, "f"))
        if depth < LONGEST:
            bits = summed.filter("shard IS NOT NULL").select(F.col("shard").alias("of"), "slot", "alive")
            state = state.groupBy("shard").cogroup(bits.groupBy("of")).applyInArrow(_reduced(depth, slots), STATE)
            state = stored(state, f"{folder}/state-{depth}")
    grams = found[0]
    for more in found[1:]:
        grams = grams.unionByName(more)
    return words, stored(grams, f"{folder}/grams"), totals


def _cut(size: int, k: int) -> Column:
    """First ``k`` words and the rest of an n-gram, as keys filled with 0."""
    zero = F.lit(0).cast("long")
    left = [F.col(_KEY[i]) if i < k else zero for i in range(LONGEST)]
    right = [F.col(_KEY[k + i]) if k + i < size else zero for i in range(LONGEST)]
    return F.struct(F.lit(k).alias("k"), F.struct(*[c.alias(g) for c, g in zip(left, _KEY)]).alias("left"), F.struct(*[c.alias(g) for c, g in zip(right, _KEY)]).alias("right"))


def collocations(
    docs: DataFrame,
    min_count: int = 30,
    contained_percent: int = 80,
    scale: int = 2_000_000,
    per_lang: int | None = 2000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best candidates of each language (all: None)."""
    words, grams, totals = frequent_ngrams(docs, min_count, lang, text)
    key = [F.col(g) for g in _KEY]
    size = sum((F.col(g) > 0).cast("int") for g in _KEY).alias("size")
    candidates = grams.withColumn("size", size).filter("size > 1")
    # the highest count one word further to the left or to the right
    zero = F.lit(0).cast("long")
    longer = candidates.filter("size > 2")
    shorter = [longer.select(*[F.col(b).alias(a) for a, b in zip(_KEY, _KEY[1:])], zero.alias(_KEY[-1]), "f")]
    last = [F.when(F.col("size") == i + 1, zero).otherwise(F.col(g)).alias(g) for i, g in enumerate(_KEY)]
    shorter.append(longer.select(*last, "f"))
    extended = shorter[0].unionByName(shorter[1]).groupBy(*_KEY).agg(F.max("f").alias("longest"))
    kept = candidates.join(extended, _KEY, "left").filter(
        F.col("longest").isNull() | (_whole(F.lit(100)) * _whole(F.col("longest")) < _whole(F.lit(contained_percent)) * _whole(F.col("f")))
    )
    cuts = F.when(F.col("size") == 2, F.array(_cut(2, 1)))
    cuts = cuts.when(F.col("size") == 3, F.array(_cut(3, 1), _cut(3, 2))).otherwise(F.array(*[_cut(4, k) for k in (1, 2, 3)]))
    rows = kept.select(*key, F.col("f").alias("a"), F.explode(cuts).alias("cut")).select(*key, "a", "cut.*")
    part = lambda name, f: grams.select(F.struct(*key).alias(name), F.col("f").alias(f))
    rows = rows.join(part("left", "l"), "left").join(part("right", "r"), "right")
    score = F.expr(f"(cast({scale} as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = rows.withColumn("score", score).groupBy(*_KEY, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    named = best.select(*key, "a", "best.l", "best.r", "best.score")
    for i, g in enumerate(_KEY):
        names = words.select(F.col("id").alias(g), F.col("word").cast("string").alias(f"w{i}"), *(["lang"] if not i else []))
        named = named.join(names, g, "left")
    phrase = F.concat_ws(" ", *[f"w{i}" for i in range(LONGEST)]).alias("phrase")
    rows = named.select("lang", phrase, "a", "l", "r", "score").join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if per_lang is not None:
        ranked = ranked.filter(F.col("rank") <= per_lang)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
