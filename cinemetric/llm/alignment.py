"""Operator 12: alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Texts are encoded by a byte-level vocabulary (A, the codec of operator 11) and by a sentencepiece
model (B).  Both give increasing arrays of byte ends.  At the current shift between the two arrays'
indices, stretches of growing length (1, 2, 4 ... ends) are compared at once, so that a run of
one-to-one tokens is jumped in a logarithm of steps; where the arrays part, the irregular group is
resolved by advancing the side that is behind until both end together, which gives the new shift.

A group's last two tokens are a link.  How often an id pair is linked corpus-wide comes back to the
documents without moving a row per link: a task gathers documents into blocks of about
``BLOCK_LINKS`` links, each link a number into its block's distinct pairs, and only those pairs are
counted, joined with their totals and brought to the block.

Texts are cut in front of a space that follows something else: a match of A's pattern begins there,
and no piece of B goes on from another character to a space (checked when the model is read; a
model with such pieces gets whole texts).  Words of B between such cuts are remembered per worker,
bounded in bytes.  So memory is bounded by a block, and by four bytes per link of one text.

Defined cases: a null or empty text, and one whose tokens' bytes are not a space and the text, has
no tokens: zeros and an empty digest; null and repeated doc_ids are rows of their own; a
corpus-wide highest count may be shared, then each of the pairs is best; an empty table gives no
rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm import byte_bpe
from cinemetric.llm.idtable import IdTable, word_view
from cinemetric.llm.recent import Recent
from cinemetric.llm.shared import stored, work_dir

BLOCK_LINKS = 1 << 20
BATCH_CHARS = 1 << 19
#: Words between two lanes of the alignment.
LANE_WORDS = 12
#: The longest stretch that a run is probed with at once.
PROBE = 1 << 10
_MARK = "▁"
_MARK_BYTES = _MARK.encode()
_BYTE = re.compile("<0x([0-9A-F]{2})>")

PARTS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, "
    "pairs array<long>, counts array<long>"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Pieces:
    """A sentencepiece model: ids of segments and the bytes of ids."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if len(names) > 1 << 16:
            raise ValueError("ids of this model do not fit 16 bits")
        tokens = [self._bytes(i, name) for i, name in enumerate(names)]
        if not all(tokens):
            raise ValueError("a piece without bytes")
        self.table = TokenBytes(tokens)
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}", name) for name in names)
        self.opens = np.array([name.startswith(_MARK) for name in names])
        self.recent, self.table_of_words = Recent(byte_bpe.CACHE_BYTES), IdTable()

    def _bytes(self, i: int, name: str) -> bytes:
        coded = _BYTE.fullmatch(name)
        if self.library.is_byte(i) and coded:
            return bytes([int(coded[1], 16)])
        return name.replace(_MARK, " ").encode()

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without spaces, and how many each has: one text of them all, parted where a
        piece begins with the space."""
        ids = np.array(self.library.encode(b" ".join(words).decode(), num_threads=1), np.uint32)
        return ids, np.diff(np.flatnonzero(self.opens[ids]), append=len(ids))

    def _long(self, words: list[bytes]) -> list[bytes]:
        ids, counts = self._words(words)
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts, to each of which the model adds the space in front."""
        out = [np.empty(0, np.uint32)] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if self.cuts and text and b"  " not in text and _MARK_BYTES not in text and text[0] != 32 != text[-1]:
                plain.append(k)
            else:
                out[k] = np.array(self.library.encode(text.decode(), num_threads=1), np.uint32)
        if not plain:
            return out
        raw = b" ".join([texts[k] for k in plain])
        spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
        at, stop = np.append(0, spaces + 1), np.append(spaces, len(raw))

        def compute(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return self._words([raw[a:b] for a, b in zip(starts.tolist(), (starts + sizes).tolist())])

        ids, counts = byte_bpe.looked_up(raw, word_view(raw), at, stop - at, self.table_of_words, compute, self.recent, self._long)
        lengths = np.fromiter((len(texts[k]) for k in plain), np.int64, len(plain))
        last_word = np.searchsorted(stop, np.cumsum(lengths + 1) - 1)
        for k, x in zip(plain, np.split(ids, np.cumsum(counts)[last_word][:-1])):
            out[k] = x
        return out


class TokenBytes:
    """Bytes and decimal digits of every id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.sizes[ids]
        shift = self.offsets[ids] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()


def group_ends(a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as numbers of tokens of A and of B.

    ``a`` and ``b`` are increasing byte ends whose last values are equal; ``starts`` are increasing
    offsets from 0 on.  Those at which both end a token begin lanes, which run in step: a lane whose
    next ends are equal probes the run at its shift, in stretches of doubled length; one whose next
    ends differ lets the side that is behind go on.
    """
    n = len(a)
    i, j = np.searchsorted(a, starts), np.searchsorted(b, starts)  # starts lie below the last end
    common = (a[i] == starts) & (b[j] == starts)
    i, j = np.append(0, i[common] + 1), np.append(0, j[common] + 1)
    stop = np.append(i[1:], n)
    a, b = np.append(a, np.full(PROBE, -1)), np.append(b, np.full(PROBE, -2))  # no run goes on behind the last ends
    is_end, partner = np.zeros(n, bool), np.zeros(n, np.int64)
    window = np.arange(1, PROBE + 1)
    while len(i):
        x, y = a[i], b[j]
        level = np.flatnonzero(x == y)
        i, j = i + (x < y), j + (x > y)
        if len(level):
            run = _run(a, b, i[level], j[level], stop[level], window)
            first = np.cumsum(run) - run
            step = np.arange(int(run.sum())) - np.repeat(first, run)
            ends = np.repeat(i[level], run) + step
            is_end[ends], partner[ends] = True, np.repeat(j[level], run) + step
            i[level] += run
            j[level] += run
            going = i < stop
            i, j, stop = i[going], j[going], stop[going]
    in_a = np.flatnonzero(is_end)
    return in_a + 1, partner[in_a] + 1


def _run(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, stop: np.ndarray, window: np.ndarray) -> np.ndarray:
    """How many ends from (i, j) on are equal at that shift, up to ``stop``."""
    run = np.ones(len(i), np.int64)
    open_, width = np.arange(len(i)), 4
    while len(open_):
        at, bt = i[open_] + run[open_] - 1, j[open_] + run[open_] - 1
        at, bt = np.minimum(at, len(a) - width - 1), np.minimum(bt, len(b) - width - 1)
        same = a[at[:, None] + window[:width]] == b[bt[:, None] + window[:width]]
        whole = same.all(1)
        run[open_] += np.where(whole, width, same.argmin(1))
        open_ = open_[whole]
        open_ = open_[i[open_] + run[open_] < stop[open_]]
        width = min(2 * width, PROBE)
    return np.minimum(run, stop - i)


_DIGITS = 5  # ids of 16 bits


def _digit_table() -> tuple[np.ndarray, np.ndarray]:
    text = "".join(str(i).ljust(_DIGITS + 1) for i in range(1 << 16))
    sizes = np.fromiter((len(str(i)) for i in range(1 << 16)), np.int64, 1 << 16)
    return np.frombuffer(text.encode(), np.uint8).reshape(-1, _DIGITS + 1), sizes


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, digits, sizes) -> tuple[np.ndarray, np.ndarray]:
    """``a,a|b;a|b,b;`` of all groups as bytes, and where each group's text ends."""
    many_a, many_b = np.diff(in_a, prepend=0), np.diff(in_b, prepend=0)
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[np.arange(len(ids_a)) + np.repeat(in_b - many_b, many_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(in_a, many_b)] = ids_b
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[in_a + in_b - many_b - 1] = ord("|")
    marks[in_a + in_b - 1] = ord(";")
    rows, size = digits[ids], sizes[ids]
    rows[np.arange(len(ids)), size] = marks
    ends = np.cumsum(size + 1)[in_a + in_b - 1]
    return rows[np.arange(_DIGITS + 1) <= size[:, None]], ends


@dataclass
class _Document:
    doc_id: int | None
    segments: int
    whole: bool = True
    n_a: int = 0
    n_b: int = 0
    links: list[np.ndarray] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)

    def row(self) -> dict:
        links = np.concatenate(self.links) if self.whole and self.links else np.empty(0, np.uint32)
        known = self.whole and self.n_a > 0
        return {
            "doc_id": self.doc_id,
            "n_a": self.n_a if known else 0,
            "n_b": self.n_b if known else 0,
            "n_links": len(links),
            "groups_sha256": self.digest.hexdigest() if known else "",
            "links": links,
        }


class Aligner:
    def __init__(self, coder: byte_bpe.Codec, proto: bytes):
        if len(coder.tokens) > 1 << 16 or not all(coder.tokens):
            raise ValueError("ids of 16 bits and tokens of one byte at least")
        self.coder, self.pieces = coder, Pieces(proto)
        self.digits, self.sizes = _digit_table()

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        return list(byte_bpe.segments(" " + text, byte_bpe.SPACE_CUT)) if self.pieces.cuts else [" " + text]

    def align(self, held: list[tuple[_Document, str]]) -> None:
        """Add the tokens of segments, each beginning with a space, to their documents."""
        all_a = self.coder.encode([s for _, s in held])
        raws = [s.encode() for _, s in held]
        all_b = self.pieces.encode([raw[1:] for raw in raws])
        batch, texts = [], []
        for (doc, _), raw, a, b in zip(held, raws, all_a, all_b):
            if int(self.coder.lengths[a].sum()) == len(raw) and self.pieces.table.joined(b) == raw:
                batch.append((doc, a, b))
                texts.append(raw)
            else:
                doc.whole = False
        if not batch:
            return
        ids_a = np.concatenate([a for _, a, _ in batch])
        ids_b = np.concatenate([b for _, _, b in batch])
        ends_a, ends_b = np.cumsum(self.coder.lengths[ids_a]), np.cumsum(self.pieces.table.sizes[ids_b])
        spaces = np.flatnonzero(np.frombuffer(b"".join(texts), np.uint8) == 32)
        in_a, in_b = group_ends(ends_a, ends_b, spaces[LANE_WORDS::LANE_WORDS])
        links = ids_a[in_a - 1] << np.uint32(16) | ids_b[in_b - 1]
        text, stops = group_text(ids_a, ids_b, in_a, in_b, self.digits, self.sizes)
        last = np.searchsorted(in_a, np.cumsum([len(a) for _, a, _ in batch]))  # every segment ends a group
        first, begin = 0, 0
        for (doc, a, b), g in zip(batch, (last + 1).tolist()):
            if doc.n_a:
                doc.digest.update(b";")
            doc.digest.update(text[begin : stops[g - 1] - 1].tobytes())
            doc.n_a, doc.n_b = doc.n_a + len(a), doc.n_b + len(b)
            doc.links.append(links[first:g])
            first, begin = g, stops[g - 1]


_ALIGNERS: dict[str, Aligner] = {}


def _block_rows(block: int, docs: list[dict]) -> Iterator[pa.RecordBatch]:
    """The documents of a block, each link as the number of its pair, and one row of the pairs."""
    links = np.concatenate([d["links"] for d in docs])
    pairs, place, counts = np.unique(links, return_inverse=True, return_counts=True)
    places = np.split(place.astype("<u4"), np.cumsum([len(d["links"]) for d in docs])[:-1])
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        + [("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    )
    rows = [{**d, "block": block, "n_groups": d["n_links"], "links": x.tobytes()} for d, x in zip(docs, places)]
    for at in range(0, len(rows), 1024):
        yield pa.RecordBatch.from_pylist(rows[at : at + 1024], schema)
    if len(pairs):
        whole = {"block": pa.array([block], pa.int64())}
        whole |= {k: pa.array([v.astype(np.int64)]) for k, v in (("pairs", pairs), ("counts", counts))}
        yield pa.RecordBatch.from_arrays([whole.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)


def parts(docs: DataFrame, vocabulary: str, piece_model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with links as numbers into their block's pairs, and each block's pairs."""
    with open(piece_model, "rb") as f:
        proto = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((byte_bpe.model(vocabulary), proto))  # bounded by the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = f"{vocabulary} {piece_model}"
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(byte_bpe.codec(shared.value[0]), shared.value[1])
        aligner = _ALIGNERS[key]
        block = TaskContext.get().partitionId() << 32
        held, chars, open_docs, done, links = [], 0, [], [], 0

        def texts():
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    rows = batch.slice(at, 64)
                    yield from zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist())

        for d, t in texts():
            cut = aligner.segments(t)
            doc = _Document(d, len(cut))
            open_docs.append(doc)
            for s in cut:
                held.append((doc, s))
                chars += len(s)
                if chars >= BATCH_CHARS:
                    aligner.align(held)
                    held, chars = [], 0
            if not held:  # every document so far is complete
                rows = [x.row() for x in open_docs]
                open_docs, done, links = [], done + rows, links + sum(x["n_links"] for x in rows)
                if links >= BLOCK_LINKS:
                    yield from _block_rows(block, done)
                    block, done, links = block + 1, [], 0
        if held:
            aligner.align(held)
        done += [x.row() for x in open_docs]
        if done:
            yield from _block_rows(block, done)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, PARTS)


def aligned(docs: DataFrame, vocabulary: str, piece_model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: tokens of both, groups, links, and the links' corpus-wide counts."""
    folder = work_dir(docs.sparkSession, "alignment")
    written = stored(parts(docs, vocabulary, piece_model, doc_id, text), f"{folder}/parts")
    zipped = F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p")
    rows = written.filter(F.col("pairs").isNotNull()).select("block", zipped)
    pairs = rows.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = stored(pairs.groupBy("pair").agg(F.sum("n").alias("total")), f"{folder}/totals")
    piece = F.col("pair").bitwiseAND(0xFFFF)
    highest = totals.groupBy(piece.alias("piece")).agg(F.max("total").alias("highest"))
    # at most one row per id of B
    ranked = totals.withColumn("piece", piece).join(F.broadcast(highest), "piece")
    ranked = ranked.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    counted = pairs.join(ranked, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    documents = written.filter(F.col("pairs").isNull()).drop("pairs", "counts")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        total[place], best[place] = right.column("total").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        sums, bests = [], []
        for x in left.column("links").to_pylist():
            links = np.frombuffer(x, "<u4")
            sums.append(int(total[links].sum()))
            bests.append(int(best[links].sum()))
        values = {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        names = [f.split()[0] for f in ALIGNED.split(", ")]
        return pa.table({c: values[c] if c in values else left.column(c) for c in names})

    return documents.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(finish, ALIGNED)
