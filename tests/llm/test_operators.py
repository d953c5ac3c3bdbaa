"""The training-data operators against brute force, exact round trips and held-out accuracy, with
nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cinemetric.llm import (
    elias_fano, graph_search, kneser_ney, mixing, packing, quality, range_join, repeats, secrets, simhash, token_files,
)
from cinemetric.llm.shared import work_dir
from cinemetric.llm.tokens import Encoder, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, label string"


def _docs(spark, rows):
    """(doc_id, text, source) rows, with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), "x", "y") for d, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 2 + int(rng.integers(6)))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(words, n))
    passage = make(120)
    rows = [(i, make(int(rng.integers(5, 150))), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, f"{make(20)} {passage} {make(15)}.", "s9") for i in range(6)]
    rows += [(200, rows[3][1], "s1"), (201, rows[3][1].upper(), None), (202, rows[7][1] + " end", "s2")]
    rows += [(300, None, "s1"), (301, "", None), (302, "  \n ", "s1"), (303, "one", "s2"), (304, make(6000), "s3")]
    rows += [(None, "a null id " * 60, "s1"), (5, rows[5][1], "s1"), (5, rows[5][1], "s1"), (6, "ab " * 400, "s0")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return _docs(spark, texts)


def test_elias_fano_select_and_all():
    for values in ([], [0], [5], [0, 0, 0], [1, 1, 2, 900, 900, 10**6], list(np.cumsum(np.arange(500) % 37))):
        data = elias_fano.encode(np.array(values, np.int64))
        reader = elias_fano.Reader(memoryview(data))
        assert reader.all().tolist() == list(values) and reader.size == len(data)
        assert [reader.select(i) for i in range(len(values))] == list(values)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder_equals_library(name, texts):
    e = Encoder(vocabulary(name))
    odd = ["a  b", " lead", "trail ", "a \n b", "x  y  z", "it's 'll WE'RE", "<|endoftext|>", "İΣ é", "1234 5\t6", "\0 x", "café 你好!"]
    for t in odd + [t for _, t, _ in texts if t]:
        want = np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
        assert e.encode([t]) == [want]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_as_the_file_has_them(name):
    from tokenizers import Tokenizer

    plain, e = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name))
    odd = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|>\n", "a <|ENDOFTEXT|> b", "a <| b <|end", "café <|endoftext|>  你"]
    for t in odd * 2:  # the second time from the caches
        assert e.encode([t]) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u2").tobytes()]
    assert plain.token_to_id("<|endoftext|>") in np.frombuffer(e.encode([odd[0]])[0], "<u2")


def test_token_files_round_trip(spark, docs, texts):
    path = work_dir(spark, "test-files")
    token_files.write_token_files(docs, path, vocabulary("word_bpe_49k.json"), shard_tokens=500)
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    e = Encoder(vocabulary("word_bpe_49k.json"))
    want = collections.Counter((d, e.encode([t])[0] + b"\x01\x00") for d, t, _ in texts)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 2
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    shard = token_files.Shard(token_files.read_shards(spark, path).orderBy("part", "serial").first()["shard"])
    assert [shard.bounds(i)[1] for i in range(len(shard))] == shard.ends.all().tolist()


def test_kneser_ney_against_counts(spark, docs, texts):
    train = [(d, t) for d, t, _ in texts if d is None or d % 2 == 0]
    model = kneser_ney.train(docs.filter("doc_id is null or doc_id % 2 = 0"))
    got = kneser_ney.scored(docs, model).collect()
    uni, pairs = collections.Counter(), collections.Counter()
    for _, t in train:
        ws = kneser_ney.tokens(t)
        uni.update(ws)
        pairs.update(zip(["<s>", *ws], ws))
    n, v = sum(uni.values()), len(uni)
    left = collections.Counter(w for _, w in pairs)
    of = lambda c: kneser_ney.discounts(np.array([sum(1 for x in c.values() if x == i) for i in (1, 2, 3, 4)], float))
    d2, d1 = of(pairs), of(left)
    total, follow = collections.Counter(), collections.defaultdict(list)
    for (a, _), c in pairs.items():
        total[a] += c
        follow[a].append(c)
    spare = sum(d1[min(c, 3) - 1] for c in left.values()) / len(pairs)

    def p(a, w):
        low = max(left[w] - (d1[min(left[w], 3) - 1] if left[w] else 0), 0) / len(pairs) + spare / (v + 1)
        if not total[a]:
            return low
        c = pairs[a, w]
        gamma = sum(d2[min(x, 3) - 1] for x in follow[a]) / total[a]
        return max(c - (d2[min(c, 3) - 1] if c else 0), 0) / total[a] + gamma * low

    want = collections.Counter()
    for d, t, _ in texts:
        ws = kneser_ney.tokens(t)
        score = sum(math.log10(p(a, w)) for a, w in zip(["<s>", *ws], ws))
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[d, len(ws), sum(w in uni for w in ws), n, round(base, 5), round(score, 5)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == want
    assert abs(sum(p("<s>", w) for w in uni) + spare / (v + 1) * sum(d2[min(x, 3) - 1] for x in follow["<s>"]) / total["<s>"] - 1) < 1e-9


def test_kneser_ney_without_training_rows(spark, docs):
    model = kneser_ney.train(docs.filter("1 = 0"))
    assert {(r.score, r.train_tokens) for r in kneser_ney.scored(docs, model).collect()} == {(0.0, 0)}


def test_first_fit_decreasing_equals_scan():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 200):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room, want = [], np.empty(n, np.int64)
        for i in np.argsort(-sizes, kind="stable"):
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if k == len(room):
                room.append(100)
            room[k] -= sizes[i]
            want[i] = k
        assert bins.tolist() == want.tolist()
        assert all(offsets[bins == b].min() == 0 for b in set(bins.tolist()))


def test_packing_holds_every_id_once(spark, docs, texts):
    rows = packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=256, group_rests=32).collect()
    e = Encoder(vocabulary("byte_bpe_50k.json"))
    want = collections.Counter()
    for d, t, _ in texts:
        ids = e.encode([t])[0] + b"\x01\x00"
        for s in range(0, len(ids) // 2, 256):
            want[d, s, len(ids) // 2, ids[2 * s : 2 * s + 512]] += 1
    assert collections.Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256


@pytest.mark.parametrize("block, bucket", [(repeats.BLOCK_BYTES, repeats.SUFFIX_BUCKET), (700, 400)])
def test_repeats_against_brute_force(spark, docs, texts, monkeypatch, block, bucket):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)  # long texts in many pieces
    monkeypatch.setattr(repeats, "SUFFIX_BUCKET", bucket)
    got = repeats.removal_digests(docs, length=200).collect()
    raw = [(d, (t or "").encode()) for d, t, _ in texts]
    seen = collections.Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = collections.Counter()
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[d, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in got) == want
    assert sum(r.n_removed for r in got) > 3000
    if block > 10_000:
        spans = repeats.removed_spans(docs, length=200).collect()
        assert sorted((sum(s.end - s.start for s in r.spans), len(r.spans)) for r in spans) == sorted((r.n_removed, r.n_spans) for r in got)
        assert repeats.removal_digests(docs.limit(0), length=200).count() == 0


def test_difference_cover_reaches_every_pair():
    for r in (0, 1, 2):
        period, cover = repeats.difference_cover(r)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.train(docs, labels.filter(~fold))
    assert model[0] and len(model[0]) < 200
    held = quality.scored(docs.join(labels.filter(fold), "doc_id"), model, keep=["doc_id", "quality"])
    right = held.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_quality_cases(spark, docs):
    none = quality.train(docs, spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    scores = quality.scored(docs, none).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality.scored(docs.filter("1 = 0"), none).count() == 0


def test_mixing_meets_targets(spark, docs, texts):
    got = mixing.mix(docs).collect()
    sizes = collections.Counter()
    for _, t, s in texts:
        sizes[s] += len((t or "").split())
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while True:  # clamp and share the rest anew until nobody is above
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
    largest = {s: max(len((t or "").split()) for _, t, x in texts if x == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    repeated = mixing.repeated(docs)
    assert repeated.columns == docs.columns and repeated.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.filter("1 = 0")).count() == 0


def test_mixing_plan_is_short_and_leaves_texts_in_place(spark, docs):
    # what several steps read is written once, not repeated in the plan (79 exchanges before)
    plan = mixing.repeated(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 2 and "Exchange hashpartitioning" not in plan, plan


def test_mixing_fills_past_what_does_not_fit(spark):
    rows = [(i, "w " * (3 + i % 40), "a") for i in range(300)] + [(900 + i, "w " * 4000, "a") for i in range(2)]
    rows += [(None, f"n{i} " * 20, "b") for i in range(200)] + [(7, "same " * 30, "c")] * 200  # no ids, one row often
    got = mixing.mix(_docs(spark, rows), weights=(1.0, 2.0, 1.0), max_epochs=3.0).collect()
    for s in "abc":
        own = [r for r in got if r.source == s]
        whole = min(r.copies for r in own)
        left = [r.size for r in own if r.copies == whole]
        gap = own[0].target - sum(r.taken for r in own)
        assert len(own) == (302 if s == "a" else 200) and max(r.copies for r in own) <= whole + 1
        assert gap <= min(left) / 2 + 1e-6 and -gap <= min(r.size for r in own) / 2 + 15, (s, gap)


def test_simhash_groups_against_brute_force(spark, docs, texts):
    def fp(t):
        ws = (t or "").encode().lower().split()
        parts = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [(d, fp(t)) for d, t, _ in texts]
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = collections.Counter((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(fps))
    got = simhash.near_groups(docs).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()
    assert collections.Counter(tuple(r) for r in got) == want
    assert simhash.near_groups(docs.filter("1 = 0")).count() == 0


def test_simhash_links_cover_all_near_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 40, dtype=np.int64)
    many = {int(base[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 16, (400, 2))}
    near = {int(b) ^ (1 << int(rng.integers(62))) ^ (1 << int(rng.integers(62))) for b in base}
    fps = sorted(many | near | set(base.tolist()))
    links = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                assert find(a) == find(b)


def _vectors():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x[100:140] = x[0] + rng.normal(scale=0.05, size=(40, 16))
    x[140:150] = x[1]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 0), (904, [], 1)]
    return rows + [(905, x[0].tolist(), None), (906, [float("inf")] * 16, 2)], x


def test_graph_search_recall(spark):
    rows, x = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("shard", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in graph_search.nearest(df, every=10, k=10, shard_rows=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = np.concatenate([x, x[:1]])
    ids = np.array([*range(300), 905])
    hits = total = 0
    for q in range(0, 300, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hits += len({int(ids[i]) for i in order} & {v for v, _ in got[q]})
        total += 10
        assert all(abs(s - d[np.flatnonzero(ids == v)[0]]) < 1e-12 for v, s in got[q])
    assert hits / total >= 0.95 and set(got) == set(range(0, 300, 10))
    assert graph_search.nearest(df.filter("1 = 0")).count() == 0


@pytest.mark.parametrize("cell", [4096, 20])
def test_range_join_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(range_join, "CELL", cell)
    monkeypatch.setattr(range_join, "BLOCK", cell)
    rows, _ = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ok = {i: (np.array(v), l) for i, v, l in rows if v and l is not None and None not in v and np.isfinite(v).all() and any(v)}
    links, root = collections.Counter(), {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, la) in ok.items():
        for j, (b, lb) in ok.items():
            if i != j and la == lb and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links[i] += 1
                a_, b_ = sorted((find(i), find(j)))
                root[b_] = a_
    want = {(i, links[i], find(i), find(i) == i) for i in root}
    assert {tuple(r) for r in range_join.near_vectors(df).collect()} == want
    assert sum(links.values()) > 100
    assert range_join.near_vectors(df.filter("1 = 0")).count() == 0


def test_secret_scan(spark):
    token = hashlib.sha1(b"k").hexdigest()
    rows = [
        (1, f'words token = "{token}" more and token = "{token}" end', "a"),
        (2, f"see commit {token}. Thanthrererendanheererea and 4845168114407329", "a"),
        (3, "plain words only", None), (4, None, "a"), (5, "", "a"), (6, "x" * 50_000, "a"), (1, f"api_key: {token[::-1]}", "b"),
    ]
    docs = _docs(spark, rows)
    forest = secrets.default_forest(docs)
    got = {(r.doc_id, r.start, r.length) for r in secrets.findings(docs, forest).collect()}
    second = rows[0][1].rindex(token)
    assert got == {(1, 15, 40), (1, second, 40), (1, 9, 40)}
    shown = secrets.redacted(docs, forest)
    assert shown.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in shown.collect()}
    assert (1, 'words token = "[SECRET]" more and token = "[SECRET]" end') in texts
    assert {t for t in texts if t[0] in (2, 3, 4, 5, 6)} == {(d, t) for d, t, _ in rows if d != 1}
    assert secrets.findings(docs.filter("1 = 0"), forest).count() == 0


def test_secret_scan_finds_short_and_marked_values(spark):
    held = [
        ('password = "{}"', "Tr0ub4dor&3"), ("pwd: {}", "hunter2Xy9"), ("so api_token={}, then", "a8Kd03mZq1Lp"),
        ("at postgres://bob:{}@db.host/x now", "s3cr9t"), ("db_passwd = '{}'", "kD9a@Lq2!vR7$xP4%tB8#mN1"),
        ("secret: {} and", "qL82mcZ0vbE1xk94!pTz83KqLwm20sXe~e"), ('{{"password": "{}"}}', "Vx7#pl9Q"),
        ("my-very-long-service-password={} x", "Gh4!kd8Zt"),
    ]
    free = [
        "password: required for all", "the key: something else", 'password = "<your-password>"', "pwd = get_password()",
        "auth: https://www.example.com/login", "token: ${API_TOKEN} here", "see http://host:8080/a@b and key = value",
    ]
    rows = [(i, shape.format(value), "a") for i, (shape, value) in enumerate(held)] + [(100 + i, t, "a") for i, t in enumerate(free)]
    docs = _docs(spark, rows)
    forest = secrets.default_forest(docs)
    got = {r.doc_id: r.text for r in secrets.redacted(docs, forest).collect()}
    assert got == {i: shape.format("[SECRET]") for i, (shape, _) in enumerate(held)} | {100 + i: t for i, t in enumerate(free)}
    spans = {(r.doc_id, r.start, r.length) for r in secrets.findings(docs, forest).collect()}
    assert spans == {(i, rows[i][1].index(value), len(value)) for i, (_, value) in enumerate(held)}


def test_secret_scan_keeps_columns_and_marked_texts(spark):
    token = hashlib.sha1(b"k").hexdigest()
    texts = [f'token = "{token}" x', f' a token = "{token}"', "no secret  here", None, ""]
    rows = [(i, t, i, "p", "f") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_found` long, `__x` string, `a.b` string")
    forest = secrets.default_forest(docs)
    got = [tuple(r) for r in secrets.redacted(docs, forest).orderBy("doc_id").collect()]
    assert got == [(i, t and t.replace(token, "[SECRET]"), i, "p", "f") for i, t, *_ in rows]
    assert {(r.doc_id, r.start) for r in secrets.findings(docs, forest).collect()} == {(0, 9), (1, texts[1].index(token))}
    assert secrets.findings(docs.limit(0), secrets.default_forest(docs.limit(0))).count() == 0


def test_secret_forest_on_held_out_findings(spark):
    found = secrets.extracted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    measured = secrets.held_out_quality(found)
    assert measured["findings"] > 100 and measured["precision"] >= 0.97 and measured["recall"] >= 0.97


def test_secret_sample_is_of_distinct_findings(spark):
    keys = [hashlib.sha1(bytes([i])).hexdigest() for i in range(4)]
    rows = [(i, f'token = "{keys[i if i < 4 else 0]}" x', "a") for i in range(60)] + [(90 + i, f'token = "{keys[1]}" x', "a") for i in range(60)]
    found = secrets.corpus_findings(secrets.extracted(_docs(spark, rows)), per_kind=4).filter("label = 1").collect()
    assert sorted(r.secret for r in found) == sorted(keys)


def test_crc_of_ids_is_of_32_bit_words():
    import pyarrow as pa

    ids = np.array([5, 70, 50256], "<u2")
    assert token_files.ids_crc32(pa.array([ids.tobytes()])).tolist() == [zlib.crc32(ids.astype("<u4").tobytes())]


def test_range_join_repeated_and_null_ids(spark):
    v, w = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    near = [1.0, 0.05] + [0.0] * 6
    rows = [(5, v, "1"), (5, w, "2"), (6, near, "1"), (None, w, "3"), (None, w, "3"), (7, v, "4"), (None, near, "4"), (8, v, "5"), (8, v, "5")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").withColumn("kind", F.lit("x")).repartition(3)
    got = sorted([tuple(r) for r in range_join.near_vectors(table).collect()], key=str)
    want = [
        (5, 1, 5, True), (5, 0, 5, True), (6, 1, 5, False), (None, 1, None, True), (None, 1, None, True),
        (7, 1, 7, True), (None, 1, 7, True), (8, 1, 8, True), (8, 1, 8, True),
    ]
    assert got == sorted(want, key=str)


def test_mix_is_the_same_for_any_partitions(spark):
    n = 30_000
    docs = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % (n - 400)).alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"),
    )
    taken = lambda p: sorted(map(str, mixing.mix(docs.repartition(p), weights=(5.0, 2.0, 1.0), max_epochs=3.0).drop("copies").collect()))
    first = taken(3)
    assert len(first) == n and first == taken(7)
