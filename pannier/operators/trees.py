"""Fitted boosted trees as expressions: one text of nested CASEs that Spark and other SQL engines evaluate alike."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.operators.model import CATEGORICAL, NUMERIC, features

UNITS = 1_000_000_000_000  # of a margin of 1: leaves are whole numbers, so sums do not depend on their order


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Rows go left where the column is at most ``threshold``, or its value among ``values``.

    ``others``: values that no list of the ensemble names, and NULLs, go left as well.
    """

    column: str
    left: "Leaf | Split"
    right: "Leaf | Split"
    threshold: float | None = None
    values: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    others: bool = False


Tree = Leaf | Split


@dataclass(frozen=True)
class Ensemble:
    """Trees with the weights of their values; the margin of a row is the weighted sum."""

    trees: tuple[tuple[float, Tree], ...]

    def terms(self) -> Iterator[str]:
        """Each tree as a CASE with its weighted leaves in ``UNITS``."""
        for weight, tree in self.trees:
            yield _text(tree, weight)

    def margin(self) -> str:
        """The margin in ``UNITS`` as SQL text."""
        return " + ".join(self.terms()) or "0"

    def probability(self) -> str:
        """The probability of the positive class as SQL text."""
        return probability_of(f"({self.margin()})")


def probability_of(margin: str) -> str:
    """The probability that a margin in ``UNITS`` stands for; boosting's logistic loss doubles it."""
    return f"(1e0 / (1e0 + exp(-2e0 * (CAST({margin} AS DOUBLE) / {UNITS}e0))))"


def _literals(values: Sequence[str]) -> str:
    numbers = all(re.fullmatch(r"-?\d+", v) for v in values)
    return ", ".join(values if numbers else ("'" + v.replace("'", "''") + "'" for v in values))


def _double(number: float) -> str:
    """A literal that is a double, not a decimal, wherever it is read."""
    text = repr(number)
    return text if "e" in text else f"{text}e0"


def _text(tree: Tree, weight: float) -> str:
    if isinstance(tree, Leaf):
        return str(round(tree.value * weight * UNITS))
    if tree.threshold is not None:
        goes = f"{tree.column} <= {_double(tree.threshold)}"
    elif tree.others:
        goes = f"{tree.column} IS NULL OR {tree.column} NOT IN ({_literals(tree.excluded)})" if tree.excluded else "TRUE"
    else:
        goes = f"{tree.column} IN ({_literals(tree.values)})"
    return f"CASE WHEN {goes} THEN {_text(tree.left, weight)} ELSE {_text(tree.right, weight)} END"


# How Spark ML writes trees as text.
_TREE = re.compile(r"^\s*Tree \d+ \(weight (\S+)\):$")
_IF = re.compile(r"^\s*If \(feature (\d+) (<=|in) (.*)\)$")
_PREDICT = re.compile(r"^\s*Predict: (\S+)$")


def read_ensemble(description: str, columns: Sequence[str], labels: Mapping[str, Sequence[str]]) -> Ensemble:
    """The trees of a Spark ML description, over ``columns`` by feature number.

    ``labels`` lists the values of categorical columns by code; the code after the last stands
    for all other values and NULL.
    """
    lines = description.splitlines()
    at = 0

    def node() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if found := _PREDICT.match(line):
            return Leaf(float(found[1]))
        found = _IF.match(line)
        if found is None:
            raise ValueError(f"not a tree: {line!r}")
        column, kind, limit = columns[int(found[1])], found[2], found[3]
        left = node()
        at += 1  # the line of the other side
        right = node()
        if kind == "<=":
            return Split(column, left, right, threshold=float(limit))
        codes = {int(float(code)) for code in limit.strip("{}").split(",")}
        known = labels[column]
        inside = tuple(v for code, v in enumerate(known) if code in codes)
        outside = tuple(v for code, v in enumerate(known) if code not in codes)
        return Split(column, left, right, values=inside, excluded=outside, others=len(known) in codes)

    trees = []
    while at < len(lines):
        found = _TREE.match(lines[at])
        at += 1
        if found:
            trees.append((float(found[1]), node()))
    return Ensemble(tuple(trees))


def ensemble_of(model: PipelineModel) -> Ensemble:
    """The trees of a fitted ranker (see ``model.fit_ranker``) over its input columns."""
    indexer, _, fitted = model.stages
    labels = dict(zip(CATEGORICAL, map(list, indexer.labelsArray)))
    return read_ensemble(fitted.toDebugString, [*CATEGORICAL, *NUMERIC], labels)


def score_trees(ensemble: Ensemble, df: DataFrame, group: int = 50) -> DataFrame:
    """``df`` with ``score``, the ensemble's probability; its numeric inputs become doubles.

    No vector is assembled and no Python or ML code runs: the trees are column expressions, summed
    ``group`` trees at a time, in whole numbers. This suits ensembles of up to some dozens of trees;
    hundreds make more code than the JVM compiles, and ``model.score`` is faster. Missing numbers count as 0, and values the ensemble has not seen
    take the way of other values. An empty table gives an empty result.
    """
    typed = features(df, keep=df.columns)
    terms = list(ensemble.terms())
    sums = [F.expr(" + ".join(terms[k : k + group])).cast("bigint") for k in range(0, len(terms), group)] or [F.lit(0).cast("bigint")]
    parts = F.array(*sums)
    margin = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, part: total + part)
    scored = typed.withColumn("_margin", margin)
    return scored.withColumn("score", F.expr(probability_of("_margin"))).select(*df.columns, "score")
