"""The corpus pipeline: five stages over ``documents``, each calling one training-data operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns they were given:

1. ``quality``  (operator 5): documents that the rule ensemble rejects go;
2. ``dedup``    (operator 7): one document of each SimHash group stays, the one that names it;
3. ``secrets``  (operator 9): secrets in the texts are masked, no document goes;
4. ``mix``      (operator 6): documents are repeated or left out to meet the source targets;
5. ``pack``     (operator 3): token sequences of the mix.

Defined cases are those of the operators.  Stage 2 decides by row, so null and repeated ids touch
no other document: of each group the row with the smallest id stays (null last; of rows with that
id, or of rows without any, one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetric.llm import mixing, packing, quality, secrets, simhash
from cinemetric.llm.queries import quality_model
from cinemetric.llm.shared import stored, table, work_dir
from cinemetric.llm.tokens import vocabulary

#: No SQL states the classifier, the forest or the tokenizer; tests hold each stage to its own check.
ORACLE_SQL = None


def _whole_row(docs: DataFrame) -> DataFrame:
    """``text`` and ``doc_id`` beside the row as it came, so extra columns cannot clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(spark, sf_dir, docs)
    scored = quality.scored(_whole_row(docs), model, keep=["_row"])
    return scored.filter(F.col("score") >= 0.5).select("_row.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # written once, so that every later read sees the same row keys
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_key"))
    keyed = stored(keyed, f"{work_dir(spark, 'dedup')}/rows")
    groups = simhash.grouped(keyed.select("_row.doc_id", "_row.text", "_key"), shingle=3, max_bits=2, row_key="_key")
    # keys of the rows to go: small beside the texts, which are not moved
    gone = groups.filter(F.col("row_key") != F.col("first_key")).select(F.col("row_key").alias("_key"))
    return keyed.join(gone, "_key", "left_anti").select("_row.*")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs, secrets.default_forest(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs, weights=(5.0, 2.0, 1.0), max_epochs=3.0)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=2048, end_id=1, digest=True)


STAGES = [
    ("quality", quality_stage),
    ("dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
