"""Operators 11 to 13 against the tokenizer libraries and brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from cinemetric.llm import alignment, byte_bpe, collocations, queries
from cinemetric.llm.idtable import IdTable, word_view
from cinemetric.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"
RANKS, PIECES = vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a  b", " lead", "trail ", "a \n b", "it's 'll WE'RE 's ''s \n's  's", "don't've'll're'", "<|endoftext|> x",
    "<unk> <s> </s>", "İΣ é ﬁ", "1234 5\t6 ²½", "\0 x", "café 你好! 'tuff", "\x1c a\x85b", "a　b   c", "▁a ▁", "\n\n\n x", "€" * 40,
    "x" * 3000 + " " + "你" * 500, "internationalization " * 30,
]
SCHEMA = "doc_id long, text string, lang string, ids string, place long, n_tokens string, rank string"


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    drawn = lambda letters, n: ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 50))) for _ in range(n)]
    return ODD + drawn(" \n\t'stmdrevlaX19é你!,²", 400) + drawn("abcdehinorst   ", 400)


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _docs(spark, texts, lang=lambda i: "en"):
    """Columns whose names clash with those of the operators; null and repeated ids."""
    rows = [(None if i == 3 else 7 if i in (4, 5) else i, t, lang(i), "x", 1, "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_perfect_hash_is_minimal_and_exact():
    tokens = byte_bpe.read_ranks(RANKS)
    hashed = byte_bpe.PerfectHash.build(tokens)
    assert sorted(hashed.key.tolist()) == list(range(len(tokens)))
    find = lambda keys: hashed.find(*(np.array(c, np.uint64) for c in zip(*map(byte_bpe._words, keys)))).tolist()
    assert find(tokens) == list(range(len(tokens)))
    assert set(find([t + b"\0" for t in tokens if len(t) < 15 and t + b"\0" not in set(tokens)])) == {-1}


def test_pattern_is_the_published_one(texts):
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_encoding_equals_library(texts, library, monkeypatch):
    coder = byte_bpe.codec(byte_bpe.model(RANKS))
    for segment in (byte_bpe.SEGMENT, 7):
        monkeypatch.setattr(byte_bpe, "SEGMENT", segment)
        for t, ids in zip(texts * 2, coder.encode(texts * 2)):
            assert ids.tolist() == library.encode_ordinary(t or "")
            assert coder.decode(ids) == (t or "").encode()
    for word in (b"abab" * 5, b"internationalization", b"x", bytes(range(256))):
        assert byte_bpe.merged(word, coder.ranks) == library._core_bpe.encode_single_piece(word)


def test_small_table_forgets_but_stays_right(library):
    coder = byte_bpe.Codec(*byte_bpe.model(RANKS)[1:])
    coder.table = IdTable(bits=3, ids=64)
    for t in ["qwxz zzkq " * 9, "abcdqz efghqz " * 40, "qwxz " * 3]:
        assert [x.tolist() for x in coder.encode([t, t])] == [library.encode_ordinary(t)] * 2
    assert word_view(b"ab")[0] == 0x6261


def test_bpe_frames(spark, texts, library):
    docs = _docs(spark, texts)
    coded = byte_bpe.encoded(docs, RANKS)
    back = sorted(bytes(r.bytes) for r in byte_bpe.decoded(coded, RANKS).collect())
    assert back == sorted((t or "").encode() for t in texts)
    rows = byte_bpe.digests(docs, RANKS)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = collections.Counter()
    for r, t in zip(_docs(spark, texts).select("doc_id", "text").collect(), texts):
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        want[(r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, rows.collect())) == want
    assert byte_bpe.digests(docs.limit(0), RANKS).count() == 0 and byte_bpe.encoded(docs.limit(0), RANKS).count() == 0


def _brute_alignment(rows):
    a_lib, b_lib = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    letters = {**{b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    letters.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)})
    byte_of = {c: b for b, c in letters.items()}
    a_bytes = lambda i: bytes(byte_of[c] for c in a_lib.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    out, links_of, counts = [], [], collections.Counter()
    for doc_id, text in rows:
        row, links = None, []
        if text:
            a, b, raw = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text), (" " + text).encode()
            if b"".join(map(a_bytes, a)) == raw == b"".join(map(b_bytes, b)):
                ea, eb = (np.cumsum([len(f(i)) for i in x]).tolist() for f, x in ((a_bytes, a), (b_bytes, b)))
                i = j = 0
                said = []
                in_a, in_b = ({e: k + 1 for k, e in enumerate(x)} for x in (ea, eb))
                for e in sorted(set(ea) & set(eb)):
                    x, y = in_a[e], in_b[e]
                    said.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                    links.append((a[x - 1], b[y - 1]))
                    i, j = x, y
                row = (len(a), len(b), len(said), len(links), hashlib.sha256(";".join(said).encode()).hexdigest())
        out.append((doc_id, row or (0, 0, 0, 0, "")))
        links_of.append(links)
        counts.update(links)
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (d, *r[:4], sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), r[4])
        for (d, r), links in zip(out, links_of)
    ]


def test_alignment_equals_brute_force(spark, texts, monkeypatch):
    docs = _docs(spark, texts)
    want = collections.Counter(_brute_alignment([(r.doc_id, r.text) for r in docs.collect()]))
    monkeypatch.setattr(alignment, "BATCH_CHARS", 300)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 200)
    for segment in (1 << 20, 9):
        monkeypatch.setattr(byte_bpe, "SEGMENT", segment)
        got = alignment.aligned(docs, RANKS, PIECES)
        assert collections.Counter(map(tuple, got.collect())) == want
    assert alignment.aligned(docs.limit(0), RANKS, PIECES).count() == 0


def test_group_ends_by_runs():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randrange(1, 400)
        share = rnd.choice([0.2, 0.9, 0.995])
        a, b = (sorted({*(i for i in range(1, n) if rnd.random() < share), n}) for _ in "ab")
        starts = np.array(sorted(rnd.sample(range(n), rnd.randrange(0, min(n, 9)))), np.int64)
        got = alignment.group_ends(np.array(a), np.array(b), starts)
        common = sorted(set(a) & set(b))
        assert [x.tolist() for x in got] == [[a.index(e) + 1 for e in common], [b.index(e) + 1 for e in common]]


def _brute_collocations(rows, least, per_lang):
    f, n, out = collections.defaultdict(collections.Counter), collections.Counter(), []
    lower = {i: i + 32 for i in range(65, 91)}
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        kept = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        dropped = {
            g[i : i + k] for g, x in kept.items() for k in range(2, len(g)) for i in range(len(g) - k + 1)
            if 100 * x >= 80 * kept[g[i : i + k]]
        }
        rows = []
        for g in set(kept) - dropped:
            score, k = min((2_000_000 * kept[g] // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -kept[g], " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:per_lang])]
    return sorted(out)


def test_collocations_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    words = ["New", "york", "CITY", "big", "apple", "é", "ÀB", "你好", "a\x01b", "x" * 40, "the", "of"]
    line = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randrange(12))) + rnd.choice(".,;\n! \t  ")
    rows = [(i, "".join(line() for _ in range(rnd.randrange(12))), rnd.choice(["en", None, "und", "de"])) for i in range(150)]
    rows += [(1, None, "en"), (None, "", None), (2, "a a a a a a", "fr"), (2, "a a a a a a", "fr"), (3, "New York City " * 30, "en"), (4, ". ,\n", "it")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, word string, shard long").repartition(4)
    given = [(r[2], r[1]) for r in rows]
    for size in (8 << 20, 600):
        monkeypatch.setattr(collocations, "SHARD_BYTES", size)
        for least, top in ((4, 50), (2, 2000)):
            got = collocations.collocations(docs, min_count=least, per_lang=top)
            assert sorted(map(tuple, got.collect())) == _brute_collocations(given, least, top)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs, min_count=10**6).count() == 0


def test_ngrams_of_one_shard():
    rnd = random.Random(9)
    for _ in range(50):
        seq = np.array([rnd.randrange(5) for _ in range(rnd.randrange(1, 60))])
        closed = collocations._closed(seq)
        for depth in (2, 3, 4):
            want = collections.Counter()
            text = seq.tolist()
            want.update(t for t in (tuple(text[i : i + depth]) for i in range(len(text) - depth + 1)) if 0 not in t)
            words, counts = collocations.ngrams(closed, depth)
            assert [tuple(w) for w in words.tolist()] == sorted(want) and dict(zip(map(tuple, words.tolist()), counts.tolist())) == want


def test_registered_queries(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_two_tier_bpe(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        row = got[r.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    want = _brute_alignment([(r.doc_id, r.text) for r in docs])
    assert sorted(map(tuple, queries.op12_diagonal_alignment(spark, SF).collect())) == sorted(want)
