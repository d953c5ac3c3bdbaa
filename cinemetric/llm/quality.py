"""Operator 5: quality classifier as a sparse ensemble of rules over text statistics.

1. ``statistics``: cheap per-text numbers (shares of byte classes, word and line statistics).
2. A random forest of shallow trees is fitted to a bounded sample of labelled rows; every node's
   path from its root is a conjunctive rule over the statistics.
3. A lasso logistic regression over the rules' 0/1 columns keeps few of them.
4. The kept rules are compiled into one Spark column: an intercept and a sum of
   ``when(a <= x and b > y, weight)``.

Scoring is then one pass over the texts and a codegen'd expression, without a shuffle.

Defined cases: null and empty texts have all-zero statistics and a score; without labelled rows,
or with labels of one kind only, every score is the share of good labels (1.0 without labels);
labels with a null id or quality are not learned from; a document with several labels is learned
from with each of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.llm.shared import stored, work_dir

#: Labelled rows that the model is fitted on at most (those with the smallest id hashes).
SAMPLE_ROWS = 20_000
STATISTICS = (
    "length_log", "words_log", "word_length", "word_length_sd", "letters", "digits", "spaces", "marks",
    "symbols", "capitals", "high_bytes", "words_with_symbol", "words_all_symbol", "distinct_words",
    "top_word", "lines_log", "repeated_lines", "line_length", "long_words", "short_words",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_LETTERS = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_MARKS, _SYMBOLS = _class(b".,;:!?'\"-()"), _class(b"#$%&*@^~|<>{}[]=+_/\\`")
_SYMBOL_RUN = re.compile(rb"[#$%&*@^~|<>{}\[\]=+_/\\`]")


def _numbers(text: bytes) -> list[float]:
    n = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(STATISTICS) - 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    k = len(words)
    times: dict[bytes, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    with_symbol = sum(m for w, m in times.items() if _SYMBOL_RUN.search(w))
    lines = [x for x in text.split(b"\n") if x]
    return [
        float(np.log1p(n)),
        float(np.log1p(k)),
        float(sizes.mean()),
        float(sizes.std()),
        counts[_LETTERS].sum() / n,
        counts[48:58].sum() / n,
        (n - int(sizes.sum())) / n,
        counts[_MARKS].sum() / n,
        counts[_SYMBOLS].sum() / n,
        counts[65:91].sum() / n,
        counts[128:].sum() / n,
        with_symbol / k,
        sum(m for w, m in times.items() if not _LETTERS[np.frombuffer(w[:1], np.uint8)[0]] and not w[:1].isdigit()) / k,
        len(times) / k,
        max(times.values()) / k,
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        float((sizes > 14).mean()),
        float((sizes < 3).mean()),
    ]


def statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` (of the input) and one double column per name in ``STATISTICS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                table = np.array([_numbers((t or "").encode()) for t in part.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *map(pa.array, table.T)], names=[*part.schema.names[:-1], *STATISTICS]
                )

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, *(f"`{s}` double" for s in STATISTICS)]))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, threshold), all of them hold


def tree_rules(model) -> list[Rule]:
    """The path to every node of every tree of a fitted forest, each as a conjunction."""
    rules: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[int, bool], float]) -> None:
        if path:
            rules[tuple(sorted((i, up, x) for (i, up), x in path.items()))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        i, x = split.featureIndex(), split.threshold()
        low, high = dict(path), dict(path)
        low[i, False] = min(x, path.get((i, False), np.inf))
        high[i, True] = max(x, path.get((i, True), -np.inf))
        walk(node.leftChild(), low)
        walk(node.rightChild(), high)

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(rules)


def rule_column(rule: Rule, names: Sequence[str] = STATISTICS) -> Column:
    parts = [F.col(f"`{names[i]}`") > x if up else F.col(f"`{names[i]}`") <= x for i, up, x in rule]
    return reduce(Column.__and__, parts)


def fit(sample: DataFrame, label: str = "label", trees: int = 20, depth: int = 3, lasso: float = 0.002, seed: int = 11):
    """Rules with their weights, and the intercept, from ``sample`` (statistics and a 0/1 label)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    kinds = {r["l"]: r["n"] for r in sample.groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        return [], (30.0 if not total or 1 in kinds else -30.0)
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(sample).select("x", F.col(label).cast("double").alias("y"), *STATISTICS)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, featureSubsetStrategy="onethird", seed=seed
    ).fit(rows)
    rules = tree_rules(forest)
    if not rules:
        share = kinds.get(1, 0) / total
        return [], float(np.log(share / (1 - share)))
    flags = rows.select("y", *[rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="r").transform(flags).select("y", "r")
    lasso_fit = LogisticRegression(
        featuresCol="r", labelCol="y", elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60
    ).fit(flags)
    weights = lasso_fit.coefficients.toArray()
    return [(r, float(w)) for r, w in zip(rules, weights) if w], float(lasso_fit.intercept)


def score_column(rules: list[tuple[Rule, float]], intercept: float) -> Column:
    """The rule ensemble as one column: the probability of label 1."""
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-total))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS, **options):
    """Fit on ``labels(doc_id, <label>)`` rows; at most ``sample_rows`` of them."""
    bounded = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .orderBy(F.xxhash64("_id", F.lit(3)), "_id", "label")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_words"))
    learned = texts.join(F.broadcast(bounded), F.col("_doc") == F.col("_id"))  # at most sample_rows labels
    sample = stored(statistics(learned, "_words", ["label"]), work_dir(docs.sparkSession, "quality"))
    return fit(sample.coalesce(4), **options)  # small by its bound: few tasks for each of many rounds


def scored(docs: DataFrame, model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` of every document."""
    rules, intercept = model
    return statistics(docs, text, keep).select(*[F.col(f"`{c}`") for c in keep], score_column(rules, intercept).alias("score"))
