"""Operator 11: byte-level BPE encoding and decoding by a two-tier look-up.

Tier one is a minimal perfect hash over the vocabulary (hash, displace; single keys placed last, so
that no slot stays empty).  A whole batch of pre-tokens is looked up at once: the first 16 bytes of
each as two machine words and its length are the key, compared with the key in its slot, so an answer
is exact.  Tier two takes the pre-tokens that are no vocabulary entry: their bytes are linked, a
heap holds the ranks of neighbouring links, and the lowest rank (leftmost of equals) merges until
none is left.  Pre-tokens above 16 bytes go through the scalar forms of the same two tiers.  A
worker remembers tier-two results in tables of fixed size.

Pre-tokens are found for a batch at once, too: characters become classes (letter, number, white
space, other) by a table that the tokenizer library itself gives, and the matches of the published
pattern begin where classes change, but for the attached space, the last of several white spaces,
and contractions.  Texts above ``SEGMENT`` characters are cut in front of white space that follows
something else, where a match always begins, so memory is bounded by the longest pre-token.

Defined cases: a null or empty text has no ids and decodes to no bytes; strings of special tokens
are plain text; null and repeated doc_ids are rows like any other; extra columns are left out, by
whatever name; an empty table gives no rows.  An id that the vocabulary does not have makes
``decode`` fail.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.idtable import SHORT, IdTable, hashed, key, word_view
from cinemetric.llm.recent import Recent

#: Fixed value: the pre-tokenizer pattern whose matches ``pre_tokens`` computes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEGMENT = 1 << 20
BATCH_CHARS = 1 << 20
CACHE_BYTES = 16 << 20
OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)
_HALF = np.uint64(32)


def _words(key: bytes) -> tuple[int, int, int]:
    """A key as two words and its length; what follows 16 bytes is folded into the words."""
    padded = key + bytes(-len(key) % 16)
    low = high = 0
    for at in range(0, len(padded), 16):
        low = (low * 31 + int.from_bytes(padded[at : at + 8], "little")) & 0xFFFFFFFFFFFFFFFF
        high = (high * 31 + int.from_bytes(padded[at + 8 : at + 16], "little")) & 0xFFFFFFFFFFFFFFFF
    return low, high, len(key)


@dataclass
class PerfectHash:
    """Slots 0..n-1 of n keys: ``slot(hashes)``; ``low, high, size`` are the key in each slot."""

    displace: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    key: np.ndarray  # number of the key in each slot

    @staticmethod
    def build(keys: list[bytes]) -> PerfectHash:
        n, buckets = len(keys), max(1, len(keys) // 2)
        low, high, size = (np.array(c, np.uint64) for c in zip(*map(_words, keys)))
        h = hashed(low, high, size)
        if len(np.unique(h)) < n:
            raise ValueError("two keys with one hash")
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        first, step = PerfectHash._places(h)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        groups.sort(key=len, reverse=True)
        displace, taken, key = np.zeros(buckets, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
        free = 0
        for group in groups:
            b = bucket[group[0]]
            if len(group) == 1:  # only single keys are left: any free slot does
                while taken[free]:
                    free += 1
                slots, displace[b] = np.array([free]), -free - 1
            else:
                at, width = 0, 64
                while True:
                    tries = np.arange(at, at + width, dtype=np.uint64)
                    slots = ((first[group] + tries[:, None] * step[group]) % np.uint64(n)).astype(np.int64)
                    good = ~taken[slots].any(1)
                    ordered = np.sort(slots, 1)
                    good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                    if good.any():
                        break
                    at, width = at + width, min(2 * width, 1 << 14)
                d = int(good.argmax())
                slots, displace[b] = slots[d], at + d
            taken[slots], key[slots] = True, group
        return PerfectHash(displace, low[key], high[key], size[key], key)

    @staticmethod
    def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return h >> _HALF, (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 where the key in the slot is another one."""
        h = hashed(low, high, size)
        d = self.displace[(h % np.uint64(len(self.displace))).astype(np.int64)]
        first, step = self._places(h)
        slot = ((first + d.astype(np.uint64) * step) % np.uint64(len(self.key))).astype(np.int64)
        slot = np.where(d < 0, -d - 1, slot)
        same = (self.low[slot] == low) & (self.high[slot] == high) & (self.size[slot] == size)
        return np.where(same, self.key[slot], -1)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes of a rank file, in the order of ranks."""
    with open(path, "rb") as lines:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks are not 0, 1, 2 ...")
    return [t for _, t in pairs]


def character_classes() -> np.ndarray:
    """The class of every code point, as the tokenizer library's own regular expressions see it."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for at in range(0, 0x110000, 0x8000):  # some at a time: each byte found is a number of its own
            text = "".join(chr(c) for c in range(at, at + 0x8000) if not 0xD800 <= c < 0xE000)
            found = library.encode_ordinary(text)
            classes[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = value
    return classes


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: a heap of ranks over linked bytes."""
    n, get = len(word), ranks.get
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # rank of each link with its right neighbour; a heap entry that says otherwise is out of date
    rank = [get(word[i : i + 2], -1) for i in range(n - 1)]
    rank.append(-1)
    heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        top = pop(heap)
        i = top & 0xFFFFFFFF
        if rank[i] != top >> 32:
            continue
        j = end[i]
        e = end[i] = end[j]
        rank[j] = -1  # swallowed
        if e < n:
            before[e] = i
            r = rank[i] = get(word[i : end[e]], -1)
            if r >= 0:
                push(heap, r << 32 | i)
        else:
            rank[i] = -1
        p = before[i]
        if p >= 0:
            r = rank[p] = get(word[p:e], -1)
            if r >= 0:
                push(heap, r << 32 | p)
    out, i = [], 0
    while i < n:
        e = end[i]
        out.append(ranks[word[i:e]])
        i = e
    return out


def split_contractions(codes: np.ndarray, begins: np.ndarray) -> None:
    """A match that begins with ' and goes on as a contraction ends with it."""
    quote = np.flatnonzero((codes == 39) & begins)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begins[quote[short | long] + 1] = False
        for at in (quote[short] + 2, quote[long] + 3):
            begins[at[at < len(begins)]] = True


def byte_spans(raw: bytes, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and lengths of what begins at the characters ``at``, each up to the next."""
    if len(raw) != len(codes):
        at = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[at]
    return at, np.diff(at, append=len(raw))


def scatter(out: np.ndarray, places: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
    """Write runs of ``counts`` values, one after the other in ``flat``, to their places."""
    out[np.repeat(places - (np.cumsum(counts) - counts), counts) + np.arange(len(flat))] = flat


def looked_up(raw: bytes, words: np.ndarray, at: np.ndarray, size: np.ndarray, table: IdTable, short, recent: Recent, long) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the strings at ``at`` and how many each has; what a worker does not remember is computed
    by ``short(at, size)`` up to 16 bytes, else by ``long(strings)``."""
    counts = np.zeros(len(at), np.int64)
    in_table, beside = np.flatnonzero(size <= SHORT), np.flatnonzero(size > SHORT)
    ids, counts[in_table] = table.look_up(words, at[in_table], size[in_table], short)
    if not len(beside):
        return ids, counts
    keys = [raw[a:b] for a, b in zip(at[beside].tolist(), (at[beside] + size[beside]).tolist())]
    buffers = recent.fill(keys, long)
    counts[beside] = [len(x) // 4 for x in buffers]
    places, out = np.cumsum(counts) - counts, np.empty(int(counts.sum()), np.uint32)
    scatter(out, places[in_table], counts[in_table], ids)
    scatter(out, places[beside], counts[beside], np.frombuffer(b"".join(buffers), np.uint32))
    return out, counts


class Codec:
    """``encode`` texts and ``decode`` ids by a list of token bytes in rank order."""

    def __init__(self, tokens: list[bytes], hashed: PerfectHash, classes: np.ndarray):
        self.tokens, self.hashed, self.classes = tokens, hashed, classes
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.recent, self.table = Recent(CACHE_BYTES), IdTable()  # tier-two results of long and of short pre-tokens

    def pre_tokens(self, codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Where matches begin, as flags over the characters; an EDGE is a match of its own."""
        n = len(codes)
        begins = np.ones(n, bool)
        np.not_equal(classes[1:], classes[:-1], out=begins[1:])
        # something after white space: the last white space is left to it, and a plain space joins it
        after = np.flatnonzero(begins[1:] & (classes[1:] < SPACE) & (classes[:-1] == SPACE)) + 1
        begins[after - 1] = True
        begins[after] = codes[after - 1] != 32
        split_contractions(codes, begins)
        return begins

    def _long(self, keys: list[bytes]) -> list[bytes]:
        """Ids of distinct pre-tokens above 16 bytes, as buffers."""
        low, high, size = (np.array(c, np.uint64) for c in zip(*map(_words, keys)))
        found = self.hashed.find(low, high, size).tolist()
        known = [i >= 0 and self.tokens[i] == k for i, k in zip(found, keys)]
        return [array("I", (i,) if same else merged(k, self.ranks)).tobytes() for i, same, k in zip(found, known, keys)]

    def _short(self, words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens of at most 16 bytes, and how many each has: one heap a pre-token, all in step.

        A heap is a row of a tree of minima over the 16 links: its root is the lowest rank and
        place, a changed link is sifted up its path.  A round pops one merge of every pre-token.
        """
        none = np.int32(len(self.tokens) << 4)

        def link(rows: np.ndarray, i: np.ndarray, e: np.ndarray) -> np.ndarray:
            rank = self.hashed.find(*key(words, start[rows] + i, e - i))
            return np.where(rank < 0, none, rank << 4 | i).astype(np.int32)

        heap = np.full((len(start), 32), none, np.int32)
        after = np.tile(np.arange(1, 18, dtype=np.int64), (len(start), 1))
        before = np.tile(np.arange(-1, 16, dtype=np.int64), (len(start), 1))
        begins = np.arange(16) < size[:, None]
        rows, i = np.nonzero(np.arange(15) + 1 < size[:, None])
        heap[rows, 16 + i] = link(rows, i, i + 2)
        for level in (8, 4, 2, 1):
            heap[:, level : 2 * level] = np.minimum(heap[:, 2 * level : 4 * level : 2], heap[:, 2 * level + 1 : 4 * level : 2])
        rows = np.arange(len(start))
        while True:
            root = heap[rows, 1]
            rows = rows[root < none]
            if not len(rows):
                break
            i = (root[root < none] & 15).astype(np.int64)
            j = after[rows, i]
            e = after[rows, j]
            p = before[rows, i]
            after[rows, i], before[rows, e], begins[rows, j] = e, i, False
            heap[rows, 16 + j] = none
            inside = e < size[rows]
            heap[rows, 16 + i] = none
            r, k = rows[inside], i[inside]
            heap[r, 16 + k] = link(r, k, after[r, e[inside]])
            left = p >= 0
            r, k = rows[left], p[left]
            heap[r, 16 + k] = link(r, k, e[left])
            changed = ((rows, 16 + j), (rows, 16 + i), (r, 16 + k))
            for level in range(1, 5):
                for r, leaf in changed:
                    node = leaf >> level
                    heap[r, node] = np.minimum(heap[r, 2 * node], heap[r, 2 * node + 1])
        rows, i = np.nonzero(begins)
        return (link(rows, i, after[rows, i]) >> 4).astype(np.uint32), begins.sum(1)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[codes]
        edges = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        classes[edges] = EDGE
        raw = joined.encode()
        at = np.flatnonzero(self.pre_tokens(codes, classes))
        is_edge = classes[at] == EDGE
        at, size = byte_spans(raw, codes, at)
        doc = np.cumsum(is_edge)[~is_edge]  # edges before a match: its text
        at, size = at[~is_edge], size[~is_edge]
        words = word_view(raw)
        ids = self.hashed.find(*key(words, at, size))
        ids[size > SHORT] = -1
        counts, missed = np.ones(len(ids), np.int64), np.flatnonzero(ids < 0)
        slow, counts[missed] = looked_up(raw, words, at[missed], size[missed], self.table, partial(self._short, words), self.recent, self._long)
        places = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.uint32)
        hit = np.flatnonzero(ids >= 0)
        out[places[hit]] = ids[hit]
        scatter(out, places[missed], counts[missed], slow)
        per_text = np.bincount(doc, counts, len(texts)).astype(np.int64)
        return out, per_text

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        held, owners, chars = [], [], 0

        def flush():
            ids, sizes = self._encode(held)
            for owner, x in zip(owners, np.split(ids, np.cumsum(sizes)[:-1])):
                parts[owner].append(x)

        for i, text in enumerate(texts):
            for segment in segments(text or ""):
                held.append(segment)
                owners.append(i)
                chars += len(segment)
                if chars >= BATCH_CHARS:
                    flush()
                    held, owners, chars = [], [], 0
        if held:
            flush()
        empty = np.empty(0, np.uint32)
        return [p[0] if len(p) == 1 else np.concatenate(p) if p else empty for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, one after the other."""
        if not len(ids):
            return b""
        size = self.lengths[ids]
        shift = self.offsets[ids] - (np.cumsum(size) - size)
        return self.bytes[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()


#: In front of white space that follows something else; the second for cuts at plain spaces only.
SPACE_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?= )")
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")


def segments(text: str, cut_at: re.Pattern = _CUT) -> Iterator[str]:
    """A text in pieces of about ``SEGMENT`` characters, cut where a match begins anyway."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = cut_at.search(text, at + SEGMENT)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:] if at else text


_MODELS: dict[str, tuple] = {}
_CODECS: dict[str, Codec] = {}


def model(path: str) -> tuple[str, list[bytes], PerfectHash, np.ndarray]:
    """What tasks need to encode by a rank file; as large as the vocabulary, 1.1 MB of classes beside it."""
    if path not in _MODELS:
        tokens = read_ranks(path)
        _MODELS[path] = (path, tokens, PerfectHash.build(tokens), character_classes())
    return _MODELS[path]


def codec(parts: tuple[str, list[bytes], PerfectHash, np.ndarray]) -> Codec:
    """The worker's codec of a model; it lives as long as the worker process."""
    if parts[0] not in _CODECS:
        _CODECS[parts[0]] = Codec(*parts[1:])
    return _CODECS[parts[0]]


def _mapped(docs: DataFrame, path: str, columns, schema: str, doc_id: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = rows.column("text").to_pylist()
                values = columns(coder, coder.encode(texts))
                arrays = [rows.column("doc_id"), *values.values()]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *values])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {schema}")


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of every text."""

    def columns(coder: Codec, ids: list[np.ndarray]) -> dict[str, pa.Array]:
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
        }

    return _mapped(docs, path, columns, "n_tokens long, ids binary", doc_id, text)


def decoded(rows: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, bytes`` of ids as ``encoded`` gives them."""
    shared = rows.sparkSession.sparkContext.broadcast(model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value)
        for batch in batches:
            out = [coder.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    given = rows.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return given.mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded and the ids decoded again, in one pass."""

    def columns(coder: Codec, ids: list[np.ndarray]) -> dict[str, pa.Array]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": pa.array([sha(x.astype("<u4").tobytes()) for x in ids]),
            "decoded_sha256": pa.array([sha(coder.decode(x)) for x in ids]),
        }

    return _mapped(docs, path, columns, "n_tokens long, ids_sha256 string, decoded_sha256 string", doc_id, text)
