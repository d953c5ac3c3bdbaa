"""Text look-up without a full scan (F-03, F-04, Q-29, Q-30).

``TextIndex.build`` writes one posting row (trigram, id) per distinct trigram of a lower-cased text,
range-partitioned and sorted on the trigram, and the rows themselves sorted on their id.  ``search``
reads only the postings of the term's trigrams (a pushed filter that Parquet's statistics prune),
keeps the ids that have them all, joins their rows and applies the real predicate to those: trigrams are
necessary, not sufficient.  A term without three plain characters in a row (wildcards part them) has
no trigram, and scans.

A trigram that most texts hold has a posting per text; the rarest trigrams of a term decide, so
of a long term only the ``rarest`` are read, by the counts that ``build`` wrote.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def _grams_of(text) -> F.Column:
    low = F.lower(text)
    positions = F.sequence(F.lit(1), F.greatest(F.length(low) - (GRAM - 1), F.lit(1)))
    grams = F.transform(positions, lambda i: F.substr(low, i, F.lit(GRAM)))
    return F.filter(F.array_distinct(grams), lambda g: F.length(g) == GRAM)


def term_grams(term: str) -> list[str]:
    """Trigrams that every text matching ``ILIKE '%term%'`` holds (``%`` and ``_`` match anything)."""
    plain = re.split(r"[%_\\]", term.lower())
    return sorted({p[i : i + GRAM] for p in plain for i in range(len(p) - GRAM + 1)})


class TextIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, text: str, rarest: int = 4):
        self.spark, self.path, self.key, self.text, self.rarest = spark, path.rstrip("/"), key, text, rarest

    def build(self, rows: DataFrame) -> "TextIndex":
        ranged = rows.repartitionByRange(self.key).sortWithinPartitions(self.key)
        ranged.write.mode("overwrite").parquet(f"{self.path}/rows")
        stored = self.rows().select(self.key, self.text)
        postings = stored.filter(F.col(self.text).isNotNull()).select(F.explode(_grams_of(F.col(self.text))).alias("gram"), self.key)
        postings.repartitionByRange("gram", self.key).sortWithinPartitions("gram", self.key).write.mode("overwrite").parquet(f"{self.path}/postings")
        counts = self.spark.read.parquet(f"{self.path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{self.path}/counts")
        return self

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def candidates(self, term: str) -> DataFrame | None:
        """Ids whose text holds the term's rarest trigrams; None where the term has no trigram."""
        grams = term_grams(term)
        if not grams:
            return None
        known = self.spark.read.parquet(f"{self.path}/counts").filter(F.col("gram").isin(*grams)).orderBy("n", "gram").collect()  # a row per trigram of the term
        if len(known) < len(grams):
            return self.rows().select(self.key).limit(0)
        read = [r["gram"] for r in known[: self.rarest]]
        hits = self.spark.read.parquet(f"{self.path}/postings").filter(F.col("gram").isin(*read))
        return hits.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(read)).select(self.key)

    def search(self, term: str) -> DataFrame:
        """Rows whose text is ILIKE ``%term%``."""
        found = self.candidates(term)
        rows = self.rows() if found is None else self.rows().join(found, self.key, "left_semi")
        return rows.filter(F.col(self.text).ilike(f"%{term}%"))
