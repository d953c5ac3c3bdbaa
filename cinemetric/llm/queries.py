"""Registered queries of the training-data operators: each applies one operator, with production
parameters, to its whole table and derives the columns of its contract from the operator's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetric.llm import (
    alignment, byte_bpe, collocations, graph_search, kneser_ney, mixing, packing, quality, range_join, repeats, secrets, simhash,
    token_files,
)
from cinemetric.llm.shared import stored, table, work_dir
from cinemetric.llm.tokens import vocabulary


def id_crc32(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.with_crc32(token_files.read_documents(spark, path))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = kneser_ney.train(docs.filter(id_crc32() % 10 != 0))
    return kneser_ney.scored(docs, model).select(
        "doc_id", (id_crc32() % 10 == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=2048, end_id=1)
    return token_files.with_crc32(packed)


def op4_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(table(spark, sf_dir, "documents"), length=400)


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """The rule ensemble, learned from labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels").filter(id_crc32() % 3 != 1)
    return quality.train(docs, labels)


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = quality.scored(docs, quality_model(spark, sf_dir, docs))
    return rows.select(
        "doc_id", (id_crc32() % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), max_epochs=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_byte_position_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return rows.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(secrets.extracted(table(spark, sf_dir, "documents")), f"{work_dir(spark, 'secrets')}/candidates")
    return secrets.findings_of(found, secrets.forest_of(found))


def op10_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op11_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned(docs, vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))


def op13_bwt_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=30, per_lang=2000)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_tournament_packing": op3_tournament_packing,
    "op4_difference_cover": op4_difference_cover,
    "op5_rule_ensemble": op5_rule_ensemble,
    "op6_water_filling": op6_water_filling,
    "op7_byte_position_simhash": op7_byte_position_simhash,
    "op8_pruned_graph": op8_pruned_graph,
    "op9_secret_forest": op9_secret_forest,
    "op10_pivot_range_join": op10_pivot_range_join,
    "op11_two_tier_bpe": op11_two_tier_bpe,
    "op12_diagonal_alignment": op12_diagonal_alignment,
    "op13_bwt_collocations": op13_bwt_collocations,
}
ORACLE_SQL: dict[str, str] = {
    # all pairs of a label, then the smallest id reachable over links
    "op10_pivot_range_join": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a AS node, a AS seen FROM pairs
  UNION
  SELECT reach.node, pairs.b FROM reach JOIN pairs ON pairs.a = reach.seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.node = e.vec_id LEFT JOIN least l ON l.node = e.vec_id""",
    # all phrases by brute force
    "op13_bwt_collocations": """
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g FROM (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
    FROM pieces CROSS JOIN (VALUES (1), (2), (3), (4)) AS sizes(k))),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cand AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 30),
parts AS (
  SELECT lang, a, list_slice(g, i, i + k - 1) AS g FROM (
    SELECT lang, g, a, k, unnest(generate_series(1, len(g) - k + 1)) AS i
    FROM cand JOIN (VALUES (2), (3)) AS sizes(k) ON k < len(g))),
dropped AS (
  SELECT DISTINCT c.lang, c.g FROM cand c JOIN parts p ON p.lang = c.lang AND p.g = c.g
  WHERE 100::HUGEINT * p.a >= 80::HUGEINT * c.a),
cuts AS (
  SELECT c.lang, c.g, c.a, k FROM cand c JOIN (VALUES (1), (2), (3)) AS sizes(k) ON k < len(c.g)
  WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = c.lang AND d.g = c.g)),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.k)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, c.k + 1, len(c.g))),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT named.*, n, row_number() OVER (PARTITION BY named.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM named JOIN totals ON totals.lang = named.lang)
WHERE rank <= 2000""",
}
