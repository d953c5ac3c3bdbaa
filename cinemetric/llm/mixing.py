"""Operator 6: mixing sources to target weights by capped water-filling (native).

``water_fill`` turns source sizes and weights into targets: every source gets its share of the
total by weight; a share above ``max_epochs`` times the source's size is clamped there and the
excess goes to the open sources in proportion to their weights, until nobody is above.  The
fixed point has a closed form: with sources sorted by size/weight, the clamped ones are a prefix,
so one ordered window over the (small) per-source table finds the water level without a loop.

``mix`` then takes whole repetitions of every document (``floor(target / size)``) and fills the
fraction that is left with whole documents: first in the order of a seeded hash of id, source and
text, by a histogram of the hash (partial sums before the shuffle), up to the last bucket that
fits; then, past what did not fit, by a histogram of the sizes of the others, from the largest
that fits down, so that what stays open is less than any document left; and the smallest left if
taking it is nearer than leaving the gap open.  Documents of one size are taken in the order of a hash
of id, source and text, ranked within hash buckets behind the bucket's offset, so no window runs over
more than a bucket, and a rerun takes the same whatever the input's partitions are.

The plan per source, the parts per size and the chosen documents are written once each: a query
that repeats them wherever they are used holds dozens of shuffles, whose tasks, threads and code all
meet in the driver.  Their known sizes also let Spark join them without moving the texts.

Defined cases: a null text has size 0 and takes 0 words; a source of size 0 has target 0; a null
source is a source of its own, last in the order; repeated rows and rows without id
are decided each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.llm.shared import stored, work_dir

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
#: Parts of a hash bucket, so that a source's documents of one size are counted in many tasks.
SALTS = 64


def word_count(text: Column) -> Column:
    """Words of a text: runs of characters that are no ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """``sources(source, source_size, weight)`` plus ``target``.

    One row per source; the windows run over that table only, whose size is the number of
    sources.
    """
    by_level = Window.orderBy("_level", F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    open_ = sources.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn(
        "_level", F.when(F.col("weight") > 0, F.col("_cap") / F.col("weight")).otherwise(F.lit(0.0))
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level at which this source and all after it would share what those before leave over
    shared = open_.withColumns(
        {
            "_left": F.sum("source_size").over(total) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_weights": F.sum("weight").over(after),
        }
    ).withColumn("_share", F.when(F.col("_weights") > 0, F.col("_left") / F.col("_weights")))
    # the first source that is not clamped sets the water level; all before it are full
    level = F.min(F.when(F.col("_share") <= F.col("_level"), F.struct("_level", "_share"))).over(total)["_share"]
    return (
        shared.withColumn("_water", level)
        .withColumn(
            "target",
            F.coalesce(F.least(F.col("_water") * F.col("weight"), F.col("_cap")), F.col("_cap")),
        )
        .drop("_cap", "_level", "_left", "_weights", "_share", "_water")
    )


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights given out in turn to the sources in code point order, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))


def _filled(acc: Column, kind: Column) -> Column:
    """One step of filling from the largest size down: as many of a size as the open words hold."""
    n = F.least(kind["n"], F.floor(acc["open"] / kind["size"]).cast("long"))
    return F.struct(
        (acc["open"] - n * kind["size"]).alias("open"),
        F.when(n < kind["n"], kind["size"]).otherwise(acc["least"]).alias("least"),
        F.when(n > 0, F.concat(acc["taken"], F.array(F.struct(kind["size"].alias("size"), n.alias("n"))))).otherwise(acc["taken"]).alias("taken"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    max_epochs: float = 3.0,
    seed: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, copies, taken`` and ``keep``.

    ``copies`` is how many times the mix takes the whole document and ``taken`` the words of
    all copies.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(source), F.col(text)), F.lit(BUCKETS * 1024)).alias("_u"),
        F.xxhash64(F.lit(seed + 2), F.col(doc_id), F.col(source), F.col(text)).alias("_v"),
        F.monotonically_increasing_id().alias("_key"),
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    )
    # written once, so that every later read sees the same row keys
    folder = work_dir(docs.sparkSession, "mix")
    rows = stored(rows, f"{folder}/rows").withColumn("_bucket", F.floor(F.col("_u") / 1024))

    hist = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_mass"))
    sizes = hist.groupBy("source").agg(F.sum("_mass").alias("source_size"))
    targets = water_fill(cyclic_weights(sizes, weights), max_epochs).withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    targets = targets.withColumn("_part", F.col("target") - F.col("_whole") * F.col("source_size"))

    # the last hash bucket that fits whole below the fraction, and the words it leaves open
    running = Window.partitionBy("h.source").orderBy("_bucket")
    t, h = targets.alias("t"), hist.alias("h")
    fitting = (
        h.join(t, F.col("h.source").eqNullSafe(F.col("t.source")))
        .select("h.source", "_bucket", "_part", F.sum("_mass").over(running).alias("_sum"))
        .filter(F.col("_sum") <= F.col("_part"))
        .groupBy("source")
        .agg(F.max("_bucket").alias("_last"), F.max("_sum").alias("_filled"))
    )
    plan = (
        t.join(fitting.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left")
        .select(
            F.col("t.source").alias("_source"),
            "source_size",
            "target",
            "_whole",
            F.coalesce("_last", F.lit(-1)).alias("_last"),
            (F.col("_part") - F.coalesce("_filled", F.lit(0))).alias("_open"),
        )
    )
    plan = stored(plan, f"{folder}/plan")  # one row per source
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_key", F.lit(seed + 1)), F.lit(SALTS)))
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    # what can still be taken: all that fit, and what is nearer than leaving the gap open
    rest = (
        placed.filter((F.col("_bucket") > F.col("_last")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("_open")))
        .select("source", "size", "_open", "_key", "_salt", "_v", F.pmod("_v", F.lit(BUCKETS)).alias("_a"), F.pmod(F.xxhash64("_v"), F.lit(SALTS)).alias("_b"))
    )
    parts = rest.groupBy("source", "size", "_a", "_b").agg(F.count(F.lit(1)).alias("n"), F.first("_open").alias("_open"))
    parts = stored(parts, f"{folder}/parts")
    counts = parts.groupBy("source", "size").agg(F.sum("n").alias("n"), F.first("_open").alias("_open"))
    one = "struct<size:bigint,n:bigint>"
    fill = F.aggregate(
        "sizes",
        F.struct(F.col("_open").cast("double").alias("open"), F.lit(None).cast("bigint").alias("least"), F.array().cast(f"array<{one}>").alias("taken")),
        lambda acc, c: _filled(acc, c),
    )
    fills = (
        counts.groupBy("source")
        .agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"), F.first("_open").alias("_open"))
        .select("source", fill.alias("f"))
    )
    closes = F.col("f.least") < 2 * F.col("f.open")
    takes = (
        fills.select("source", F.explode(F.concat("f.taken", F.when(closes, F.array(F.struct(F.col("f.least").alias("size"), F.lit(1).cast("long").alias("n")))).otherwise(F.array().cast(f"array<{one}>")))).alias("t"))
        .groupBy(F.col("source").alias("_tsource"), F.col("t.size").alias("_tsize"))
        .agg(F.sum("t.n").alias("_take"))
    )
    # documents of a size that go, from the first bucket on
    order = Window.partitionBy("source", "size").orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("source").eqNullSafe(F.col("_tsource")) & (F.col("size") == F.col("_tsize"))
    starts = (
        parts.withColumn("_from", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .join(takes, same)
        .filter(F.col("_from") < F.col("_take"))
        .select(F.col("source").alias("_tsource"), F.col("size").alias("_tsize"), F.col("_a").alias("_ta"), F.col("_b").alias("_tb"), (F.col("_take") - F.col("_from")).alias("_n"))
    )
    # within a bucket by the hash of what a document is; the row key only tells equal rows apart
    bucket = ["source", "size", "_a", "_b"]
    due = rest.join(starts, same & (F.col("_a") == F.col("_ta")) & (F.col("_b") == F.col("_tb")))
    equal = due.groupBy(*bucket, "_v", "_salt").agg(F.count(F.lit(1)).alias("_m"), F.first("_n").alias("_n"))
    earlier = Window.partitionBy(*bucket).orderBy("_v", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        equal.withColumn("_q", F.col("_n") - F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
        .filter("_q > 0")
        .select(F.col("source").alias("_qsource"), F.col("size").alias("_qsize"), F.col("_v").alias("_qv"), F.col("_salt").alias("_qsalt"), "_q")
    )
    of_quota = F.col("source").eqNullSafe(F.col("_qsource")) & (F.col("size") == F.col("_qsize")) & (F.col("_v") == F.col("_qv")) & (F.col("_salt") == F.col("_qsalt"))
    within = Window.partitionBy("source", "size", "_v", "_salt").orderBy("_key")
    chosen = (
        rest.join(quota, of_quota)
        .withColumn("_at", F.row_number().over(within))
        .filter(F.col("_at") <= F.col("_q"))
        .select("_key", F.lit(1).alias("_one"))
    )
    chosen = stored(chosen, f"{folder}/chosen")
    out = placed.join(chosen, "_key", "left")
    copies = F.col("_whole") + F.when((F.col("_bucket") <= F.col("_last")) | F.col("_one").isNotNull(), 1).otherwise(0)
    return out.withColumn("copies", copies.cast("long")).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with the columns it came with."""
    columns = docs.columns
    packed = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in columns]))
    mixed = mix(packed, keep=["_row"], **options)
    return (
        mixed.filter(F.col("copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("_row.*")
    )
