"""Fitted boosted trees as masks of leaves, which score a batch of rows tree by tree side by side in numpy."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel

from pannier.operators.model import CATEGORICAL, NUMERIC
from pannier.operators.trees import Ensemble, Leaf, Split, Tree, read_ensemble

LEAVES = 32  # most leaves of a tree: a bit each
ROWS = 256  # scored at once, in buffers that stay in a core's cache
BATCH = 8192  # rows whose inputs are combined at once
_PLACES = np.uint32(0x077CB531)  # times a power of two: a different number in the upper five bits for each
# Inputs that rows share with their rule, their order and their line: few combinations occur among neighbours.
TOGETHER = (
    ("trigger_product_id", "recommended_product_id", "recommended_department_id", "support", "confidence", "lift"),
    ("order_dow", "order_hour_of_day", "days_since_prior_order", "order_number"),
    ("cart_size", "trigger_reordered"),
)


@dataclass(frozen=True)
class LeafMasks:
    """For each input and bin of its values, the leaves of every tree that these values leave open.

    Leaves are bits from left to right. A value that does not go left at a node closes all leaves to the
    left of it, so the lowest bit that all inputs leave open is the leaf a row comes to. ``limits`` are
    the thresholds that cut a number into bins; codes, which have none, are bins themselves. ``values``
    are the weighted leaves by tree, whole numbers of ``1 / scale``, so sums do not depend on their order.
    ``together`` has the inputs' numbers in groups; the masks of a group are ANDed once for each combination
    that occurs among ``BATCH`` rows. Which inputs share a group affects the time alone.
    """

    limits: tuple[np.ndarray | None, ...]
    left_open: tuple[np.ndarray, ...]
    values: np.ndarray
    scale: float
    together: tuple[tuple[int, ...], ...]

    def scorer(self) -> Callable[..., pd.Series]:
        """A function of the inputs that returns the probability of the positive class, as Spark ML computes it from the margin.

        It holds the masks and nothing of this package, so tasks need no more than numpy and pandas.
        """
        limits, left_open, values, scale, together = self.limits, self.left_open, self.values, self.scale, self.together
        at_once, batch, spread, firsts = ROWS, BATCH, _PLACES, np.arange(0, values.size, LEAVES)

        def combined(bins: list[np.ndarray], group: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
            """The masks of a group for each combination of its bins, and the rows' combinations."""
            key = bins[group[0]]
            for i in group[1:]:  # codes of combinations so far stay below the rows, so products do not overflow
                key = np.unique(key, return_inverse=True)[1] * len(left_open[i]) + bins[i]
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            masks = left_open[group[0]][bins[group[0]][first]]
            for i in group[1:]:
                masks &= left_open[i][bins[i][first]]
            return masks, which

        def probability(*inputs: pd.Series) -> pd.Series:
            given = [column.to_numpy() for column in inputs]
            margin = np.empty(len(given[0]))
            shape = min(at_once, len(margin)), len(firsts)
            leaves, other, place, found = (np.empty(shape, kind) for kind in (np.uint32, np.uint32, np.int64, np.int64))
            for start in range(0, len(margin), batch):
                part = [column[start : start + batch] for column in given]
                bins = [v.astype(np.int64) if cuts is None else np.searchsorted(cuts, v) for cuts, v in zip(limits, part)]
                groups = [combined(bins, group) for group in together]
                for at in range(0, len(bins[0]), at_once):
                    n = min(at_once, len(bins[0]) - at)
                    for k, (masks, which) in enumerate(groups):
                        masks.take(which[at : at + n], axis=0, out=(other if k else leaves)[:n], mode="clip")
                        if k:
                            leaves[:n] &= other[:n]
                    np.negative(leaves[:n], out=other[:n])
                    leaves[:n] &= other[:n]  # the lowest bit
                    leaves[:n] *= spread
                    leaves[:n] >>= np.uint32(27)
                    np.add(leaves[:n], firsts, out=place[:n])
                    values.take(place[:n], out=found[:n], mode="clip")
                    margin[start + at : start + at + n] = found[:n].sum(axis=1) / scale
            with np.errstate(over="ignore"):
                return pd.Series(1 - 1 / (1 + np.exp(2 * margin)))

        return probability


def _leaves(tree: Tree) -> int:
    return 1 if isinstance(tree, Leaf) else _leaves(tree.left) + _leaves(tree.right)


def _tests(tree: Tree, first: int = 0) -> Iterator[tuple[Split, int]]:
    """The nodes of a tree, each with the leaves to its left as bits."""
    if isinstance(tree, Split):
        n = _leaves(tree.left)
        yield tree, ((1 << n) - 1) << first
        yield from _tests(tree.left, first)
        yield from _tests(tree.right, first + n)


def _ends(tree: Tree) -> Iterator[float]:
    if isinstance(tree, Leaf):
        yield tree.value
    else:
        yield from _ends(tree.left)
        yield from _ends(tree.right)


def masks_of(
    ensemble: Ensemble, columns: Sequence[str], codes: dict[str, int], together: Sequence[Sequence[str]] = ()
) -> LeafMasks | None:
    """Masks of an ensemble over ``columns``; ``codes`` has the number of codes of those that are codes.

    ``together`` groups columns of which few combinations occur side by side; any others are by themselves.
    None where there is no tree or one of more than ``LEAVES`` leaves.
    """
    trees = [tree for _, tree in ensemble.trees]
    if not trees or max(map(_leaves, trees)) > LEAVES:
        return None
    tests = [(at, split, mask) for at, tree in enumerate(trees) for split, mask in _tests(tree)]
    limits, left_open = [], []
    for column in columns:
        own = [t for t in tests if t[1].column == column]
        cuts = None if column in codes else np.unique([split.threshold for _, split, _ in own]).astype(float)
        n = codes[column] if cuts is None else len(cuts) + 1
        table = np.full((n, len(trees)), (1 << LEAVES) - 1, np.uint32)
        for at, split, mask in own:
            if cuts is None:
                right = np.ones(n, bool)
                right[[int(v) for v in split.values] + ([n - 1] if split.others else [])] = False
            else:
                right = np.arange(n) > np.searchsorted(cuts, split.threshold)
            table[right, at] &= np.uint32(~mask & (1 << LEAVES) - 1)
        limits.append(cuts)
        left_open.append(table)
    ends = [[value * weight for value in _ends(tree)] for weight, tree in ensemble.trees]
    most = sum(max(map(abs, values)) for values in ends)
    scale = 2.0 ** (61 - max(0, math.frexp(most)[1]))
    values = np.zeros((len(trees), LEAVES), np.int64)
    for at, tree_ends in enumerate(ends):
        for bit, value in enumerate(tree_ends):
            values[at, ((1 << bit) * int(_PLACES) & 0xFFFFFFFF) >> 27] = round(value * scale)
    grouped = {column for group in together for column in group}
    groups = [*together, *((column,) for column in columns if column not in grouped)]
    numbers = tuple(tuple(columns.index(column) for column in group) for group in groups)
    return LeafMasks(tuple(limits), tuple(left_open), values.ravel(), scale, numbers)


def masks_of_model(model: PipelineModel) -> LeafMasks | None:
    """Masks of a fitted ranker (see ``model.fit_ranker``) over its category codes and numbers."""
    indexer, _, fitted = model.stages
    # The code after the last label stands for all other values and NULL.
    labels = {c: [str(code) for code in range(len(known))] for c, known in zip(CATEGORICAL, indexer.labelsArray)}
    ensemble = read_ensemble(fitted.toDebugString, [*CATEGORICAL, *NUMERIC], labels)
    return masks_of(ensemble, [*CATEGORICAL, *NUMERIC], {c: len(known) + 1 for c, known in labels.items()}, TOGETHER)
