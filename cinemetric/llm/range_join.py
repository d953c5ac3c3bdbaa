"""Operator 10: embedding near-dedup as an exact metric range join.

Cosine ``c`` is Euclidean distance ``sqrt(2 - 2c)`` on unit vectors, which is a metric.  Within a
label, pivots partition the vectors: the nearest pivot's cell is a vector's home.  By the triangle
inequality a vector can only have partners in a cell if its distance to that cell's pivot is at
most the cell's radius plus the link distance, and at most its home distance plus twice the link
distance; the plane halfway between the two pivots must also be within the link distance.  There
it is replicated.  Every home vector then meets all its partners inside its own cell, so cells
join independently, and the links of a vector are counted at its home alone.

Equal vectors collapse first, with their number as weight, so copies are never expanded.  Cells
are joined block against block (``BLOCK`` rows each side), whatever a cell holds, and a block pair
sends out one count per linked vector and one star per linked set, not its pairs.  The pivots are
at most ``MAX_PIVOTS`` vectors over all labels: labels that fit one cell need none.

Where no pivot separates the data (unit vectors that are nearly at right angles, at a link distance
above the spread of the pivot distances) replication keeps every cell in every other one's reach:
the join is then as exact, and as costly, as comparing all of a label block by block.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component, or
whose label is null, links with nothing and is kept; vectors of different lengths do not link;
rows that repeat a ``vec_id``, and rows without one, are vectors of their own; a component's id is the
smallest that any of its vectors has (none: null, and all its vectors are kept).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.components import components
from cinemetric.llm.shared import stored, work_dir
from cinemetric.llm.vectors import matrix, unit, usable

MAX_PIVOTS = 2048
CELL = 4096
BLOCK = 4096
FOUND = "a long, b long, links long"


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * rows @ pivots.T))


def _join(homes: pa.Table, members: pa.Table, cosine: float) -> pa.Table:
    """One block pair: links of every home vector, and stars that connect what is linked."""
    a_id, b_id = (t.column("kind").to_numpy() for t in (homes, members))
    x, y = (unit(matrix(t.column("embedding"))) for t in (homes, members))
    weight = members.column("weight").to_numpy()
    left, right = [], []
    for at in range(0, len(x), 512):
        i, j = np.nonzero(x[at : at + 512] @ y.T >= cosine)
        left.append(i + at)
        right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    other = a_id[i] != b_id[j]
    i, j = i[other], j[other]
    links = np.bincount(i, weights=weight[j], minlength=len(x)).astype(np.int64)
    label_a, label_b = a_id.copy(), b_id.copy()
    while True:
        before = label_a.copy(), label_b.copy()
        np.minimum.at(label_a, i, label_b[j])
        np.minimum.at(label_b, j, label_a[i])
        if (before[0] == label_a).all() and (before[1] == label_b).all():
            break
    far_a, far_b = label_a != a_id, label_b != b_id
    linked = links > 0
    none = pa.nulls(int(linked.sum()), pa.int64())
    stars = int(far_a.sum() + far_b.sum())
    return pa.table(
        {
            "a": np.concatenate([a_id[far_a], b_id[far_b], a_id[linked]]),
            "b": pa.chunked_array([pa.array(np.concatenate([label_a[far_a], label_b[far_b]])), none]),
            "links": pa.chunked_array([pa.nulls(stars, pa.int64()), pa.array(links[linked])]),
        }
    )


def near_vectors(
    rows: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    folder = work_dir(rows.sparkSession, "range-join")
    reach = math.sqrt(2.0 - 2.0 * cosine) + 1e-9  # a rounding error must not hide a link
    vectors = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("string").alias("label"))
    ok = usable(F.col("embedding")) & F.col("label").isNotNull()
    kinds = (
        vectors.filter(ok)
        .groupBy(F.size("embedding").alias("dim"), "label", "embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    )
    # a kind is known by its own number, drawn once: several kinds may share an id, or have none
    kinds = stored(kinds.withColumn("kind", F.monotonically_increasing_id()), f"{folder}/kinds")

    total = kinds.count()
    cell = max(CELL, -(-total // MAX_PIVOTS))
    # only labels above one cell: at most MAX_PIVOTS of them
    large = {
        (r["dim"], r["label"]): r["n"]
        for r in kinds.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell).collect()
    }
    pivots: dict[tuple[int, str], np.ndarray] = {}
    if large:
        slots = F.lit(0)
        for (dim, name), n in large.items():
            slots = F.when((F.col("dim") == dim) & (F.col("label") == name), -(-n // cell)).otherwise(slots)
        of_slot = (
            kinds.withColumn("slots", slots)
            .filter(F.col("slots") > 0)
            .withColumn("h", F.xxhash64("embedding", F.lit(1)))
            .groupBy("dim", "label", F.pmod("h", "slots").alias("slot"))
            .agg(F.min(F.struct("h", "embedding"))["embedding"].alias("pivot"))
        )
        for r in of_slot.orderBy("dim", "label", "slot").collect():  # one row per pivot
            pivots.setdefault((r["dim"], r["label"]), []).append(r["pivot"])
        pivots = {k: unit(np.array(v, np.float64)) for k, v in pivots.items()}

    def place(batches, radius=None):
        """Home cell and its distance; with the cells' radius, the cells to be replicated to."""
        apart = {} if radius is None else {k: _distances(p, p) for k, p in pivots.items()}
        for batch in batches:
            dims, labels = batch.column("dim").to_pylist(), batch.column("label").to_pylist()
            home, far = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            cells = [[0]] * len(dims)
            keys = np.array([hash(k) for k in zip(dims, labels)])
            for key in {k: None for k in zip(dims, labels)}:
                if key not in pivots:
                    continue
                at = np.flatnonzero(keys == hash(key))
                d = _distances(unit(matrix(batch.column("embedding").take(pa.array(at)))), pivots[key])
                home[at], far[at] = d.argmin(axis=1), d.min(axis=1)
                if radius is not None:
                    near = (d <= radius[key][None, :] + reach) & (d <= far[at][:, None] + 2 * reach)
                    # a partner homed there lies beyond the plane halfway between the two pivots
                    near &= d * d - far[at][:, None] ** 2 <= 2 * reach * apart[key][home[at]] + 1e-12
                    near[np.arange(len(at)), home[at]] = True
                    for k, row in zip(at, near):
                        cells[k] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(far), pa.array(cells, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "home", "far", "cells"],
            )

    placed_type = "dim int, label string, embedding array<float>, first_id long, weight long, kind long, home long, far double, cells array<long>"
    kinds = kinds.withColumn("embedding", F.col("embedding").cast("array<float>")) if "double" not in dict(kinds.dtypes)["embedding"] else kinds
    placed_type = placed_type.replace("array<float>", dict(kinds.dtypes)["embedding"])
    radius = {k: np.zeros(len(p)) for k, p in pivots.items()}
    homes_in = {k: np.zeros(len(p), np.int64) for k, p in pivots.items()}
    if pivots:
        at_home = kinds.mapInArrow(lambda it: place(it), placed_type)
        stats = at_home.groupBy("dim", "label", "home").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n"))
        for r in stats.filter(F.col("n") > 0).join(
            F.broadcast(rows.sparkSession.createDataFrame([(k[0], k[1]) for k in pivots], "dim int, label string")), ["dim", "label"]
        ).collect():  # one row per pivot
            radius[r["dim"], r["label"]][r["home"]] = r["r"]
            homes_in[r["dim"], r["label"]][r["home"]] = r["n"]
    placed = stored(kinds.mapInArrow(lambda it: place(it, radius), placed_type), f"{folder}/placed")

    # number of blocks on either side of each large cell; every other cell is one block
    blocks = F.create_map(F.lit("-"), F.struct(F.lit(1).alias("h"), F.lit(1).alias("m")))
    if pivots:
        members_in = placed.select("dim", "label", F.explode("cells").alias("cell")).groupBy("dim", "label", "cell").agg(F.count(F.lit(1)).alias("n"))
        sizes = members_in.filter(F.col("n") > BLOCK).collect()  # at most one row per pivot
        entries = []
        for r in sizes:
            n_home = homes_in.get((r["dim"], r["label"]), np.zeros(1, np.int64))[r["cell"]] or r["n"]
            entries += [F.lit(f"{r['dim']}/{r['label']}/{r['cell']}"), F.struct(F.lit(int(-(-n_home // BLOCK))).alias("h"), F.lit(int(-(-r["n"] // BLOCK))).alias("m"))]
        if entries:
            blocks = F.create_map(*entries)
    key = F.concat_ws("/", "dim", "label", "cell")
    many = lambda side: F.coalesce(blocks[key][side], F.lit(1))
    h = F.xxhash64("kind", F.lit(9))
    wanted = ["dim", "label", "cell", "hb", "mb", "kind", "embedding", "weight"]
    homes = (
        placed.withColumn("cell", F.col("home"))
        .withColumn("hb", F.pmod(h, many("h")))
        .withColumn("mb", F.explode(F.sequence(F.lit(0), many("m") - 1)))
        .select(*wanted)
    )
    members = (
        placed.withColumn("cell", F.explode("cells"))
        .withColumn("mb", F.pmod(h, many("m")))
        .withColumn("hb", F.explode(F.sequence(F.lit(0), many("h") - 1)))
        .select(*wanted)
    )
    by = ["dim", "label", "cell", "hb", "mb"]

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("a", "b", "links")})
        return _join(left, right, cosine)

    found = stored(homes.groupBy(*by).cogroup(members.groupBy(*by)).applyInArrow(join, FOUND), f"{folder}/found")
    links = found.filter(F.col("links").isNotNull()).groupBy(F.col("a").alias("n_id")).agg(F.sum("links").alias("far_links"))
    linked = components(found.filter(F.col("b").isNotNull()).select("a", "b"), folder)
    reached = kinds.join(linked, kinds.kind == linked.node, "left").withColumn("root", F.coalesce("root", "kind"))
    smallest = reached.groupBy(F.col("root").alias("of_root")).agg(F.min("first_id").alias("component_id"))
    classes = (
        reached.join(links, F.col("kind") == F.col("n_id"), "left")
        .join(smallest, F.col("root") == F.col("of_root"))
        .select(
            F.col("label").alias("k_label"),
            F.col("embedding").alias("k_embedding"),
            (F.coalesce("far_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            "component_id",
        )
    )
    same = ok & (F.col("label") == F.col("k_label")) & (F.col("embedding") == F.col("k_embedding"))
    out = vectors.join(classes, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
