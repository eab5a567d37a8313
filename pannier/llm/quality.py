"""Quality classifier: a sparse ensemble of rules over text statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import IS_SPACE, SpanHash, distinct_per_text, runs, slices, text_bytes
from pannier.llm.sampling import lowest_marks
from pannier.sources.scratch import Scratch

STATISTICS = [
    "log_bytes", "log_words", "word_length", "longest_word", "upper_share", "digit_share", "mark_share",
    "bar_share", "exclamation_share", "line_share", "stop_share", "distinct_words", "repeated_words", "distinct_lines",
]
_CLASSES = {
    "upper_share": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit_share": b"0123456789",
    "mark_share": b"#$%&*+<=>@[\\]^_`{}~/",
    "bar_share": b"|",
    "exclamation_share": b"!",
    "line_share": b"\n",
    "stop_share": b".,;:?",
}


def _statistics(texts: pa.Array) -> list[np.ndarray]:
    data, offsets = text_bytes(texts)
    n, size = len(texts), np.diff(offsets)
    some = np.maximum(size, 1)
    found = {"log_bytes": np.log1p(size)}
    for name, members in _CLASSES.items():
        table = np.zeros(256, np.int64)
        table[list(members)] = 1
        counts = np.concatenate([[0], np.cumsum(table[data])])
        found[name] = (counts[offsets[1:]] - counts[offsets[:-1]]) / some
    hashed = SpanHash(data)
    starts, ends, of = runs(~IS_SPACE[data], offsets)
    words, length = np.bincount(of, minlength=n), ends - starts
    word = hashed.of(starts, ends)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, of, length)
    found["log_words"] = np.log1p(words)
    found["word_length"] = np.bincount(of, length, minlength=n) / np.maximum(words, 1)
    found["longest_word"] = np.log1p(longest)
    found["distinct_words"] = distinct_per_text(of, word, n) / np.maximum(words, 1)
    found["repeated_words"] = np.bincount(of[again], minlength=n) / np.maximum(words, 1)
    starts, ends, of = runs(data != 10, offsets)
    lines = np.bincount(of, minlength=n)
    found["distinct_lines"] = distinct_per_text(of, hashed.of(starts, ends), n) / np.maximum(lines, 1)
    return [found[name].astype(np.float64) for name in STATISTICS]


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the statistics of every whole text; NULL is as empty, where all are 0."""
    rows = docs.select(*(F.col(name) for name in keep), F.col(text).alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                values = [pa.array(v) for v in _statistics(part.column("_text"))]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), *values], [*keep, *STATISTICS])

    kinds = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep]
    return rows.mapInArrow(measure, ", ".join([*kinds, *(f"{n} double" for n in STATISTICS)]))


Rule = tuple[tuple[str, float, float], ...]  # (statistic, above, up to) and so on; all must hold


def tree_rules(tree, names: list[str]) -> set[Rule]:
    """A rule for every node below the root: the conjunction of the splits on the way to it."""
    rules: set[Rule] = set()

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            rules.add(tuple((name, low, high) for name, (low, high) in sorted(bounds.items())))
        if node.subtreeDepth() == 0:
            return
        name, cut = names[node.split().featureIndex()], node.split().threshold()
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        walk(node.leftChild(), bounds | {name: (low, min(high, cut))})
        walk(node.rightChild(), bounds | {name: (max(low, cut), high)})

    walk(tree._call_java("rootNode"), {})
    return rules


def rule_column(rule: Rule) -> Column:
    """The rule as a condition of the statistics' columns."""
    condition = F.lit(True)
    for name, low, high in rule:
        if low > float("-inf"):
            condition &= F.col(name) > low
        if high < float("inf"):
            condition &= F.col(name) <= high
    return condition


class RuleEnsemble:
    """Rules with weights; ``score`` is a column expression of the statistics."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total += F.when(rule_column(rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    @classmethod
    def fit(cls, rows: DataFrame, label: str, trees: int = 20, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> "RuleEnsemble":
        """Rules from random trees, weights from logistic regression with an absolute penalty.

        Rows are statistics and a label of 0 or 1. Without rows the score is a half, with one
        label only it is the label's smoothed share.
        """
        n, ones = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
        if ones in (0, n):
            share = (ones + 1) / (n + 2)
            return cls([], float(np.log(share / (1 - share))))
        data = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows)
        forest = RandomForestClassifier(
            labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.5, seed=seed
        ).fit(data)
        rules = sorted(set().union(*(tree_rules(tree, STATISTICS) for tree in forest.trees)))
        if not rules:
            return cls([], float(np.log(ones / (n - ones))))
        held = array_to_vector(F.array(*(rule_column(rule).cast("double") for rule in rules)))
        points = rows.select(F.col(label).alias("label"), held.alias("features"))
        lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60).fit(points)
        weights = lasso.coefficients.toArray()
        return cls([(rule, float(w)) for rule, w in zip(rules, weights) if w], float(lasso.intercept))


def train(
    measured: DataFrame, labels: DataFrame, learns: Column, key: str = "doc_id", label: str = "quality", max_rows: int = 20_000
) -> RuleEnsemble:
    """Fit on the ``max_rows`` different labelled rows that are lowest by a hash, among those that ``learns``.

    Only fitting is bounded by ``max_rows``. NULL labels and keys are ignored; where a
    document has several labels, each is a row of its own. Rows equal in key, label and
    statistics count once.
    """
    scratch = Scratch.of(measured.sparkSession)
    known = labels.select(F.col(key), F.col(label).cast("double").alias("label")).dropna().distinct()
    rows = measured.filter(learns).join(known, key)
    rows = scratch.keep(rows.select("label", *STATISTICS, F.xxhash64(key, "label", *STATISTICS, F.lit(7)).alias("mark")), "labelled")
    low = rows.join(lowest_marks(rows, max_rows), rows["mark"] <= F.col("last_mark"))
    sample = low.dropDuplicates(["mark"]).select("label", *STATISTICS)
    return RuleEnsemble.fit(scratch.keep(sample, "quality-sample"), "label")


def classify(measured: DataFrame, model: RuleEnsemble, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """``keep``, score and predicted of measured rows; one projection, no shuffle."""
    scored = measured.withColumn("score", model.score())
    return scored.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
