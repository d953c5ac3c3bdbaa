"""Rows routed by their verdict in one pass, with counts taken on the way (N-13, A-18, T-01).

``route`` evaluates the rules once, writes every row once into the folder of its verdict, and counts
input, accepted, rejected and each reason with ``observe`` while it writes; nothing is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cinemetric.operators.validate import Rule, check

ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass
class Routed:
    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]  # input, accepted, rejected, and a count per reason


def route(rows: DataFrame, rules: Sequence[Rule], path: str) -> Routed:
    """Write ``rows`` to ``path/verdict=...``; rejected rows keep their ``reasons``."""
    checked = check(rows, rules)
    verdict = F.when(F.size("reasons") == 0, ACCEPTED).otherwise(REJECTED)
    seen = Observation()
    counted = checked.withColumn("verdict", verdict).observe(
        seen,
        F.count(F.lit(1)).alias("input"), F.count_if(F.size("reasons") == 0).alias(ACCEPTED), F.count_if(F.size("reasons") > 0).alias(REJECTED),
        *[F.count_if(F.array_contains("reasons", r.name)).alias(f"reason: {r.name}") for r in rules],
    )
    counted.write.mode("overwrite").partitionBy("verdict").parquet(path)
    got = {k.removeprefix("reason: "): v for k, v in seen.get.items()}
    written = rows.sparkSession.read.schema(counted.schema).parquet(path)
    part = lambda name: written.filter(F.col("verdict") == name).drop("verdict")
    return Routed(part(ACCEPTED).drop("reasons"), part(REJECTED), got)
