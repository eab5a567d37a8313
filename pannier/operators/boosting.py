"""Spark ML's boosted trees for two classes, fitted to all rows by sums over bins in numpy.

Trees are those of ``GBTClassifier``: the first is fitted to -1 and 1, later ones to the gradient of the
logistic loss, and a node takes the split that lowers the variance most. What differs is the way there.
Thresholds come from the counts of all values, where Spark ML takes them from some 10,000 rows. Rows with
equal bins are one cell with its counts, so sums do not depend on how rows are laid out. Cells stay in blocks
of whole arrays; a level is one pass over them, which sums inputs of few combinations together.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pannier.operators import profile
from pannier.sources.scratch import Scratch, delete

VALUES = 200_000  # different values of a number that the driver looks at one by one
RANGES = 50_000  # of equal numbers of rows, which it looks at where there are more
ALONE = 1_000_000  # cells that one task passes sooner than jobs start
BLOCK = 500_000  # cells that a task holds at once
COMBINED = 4096  # combinations of inputs that are summed together
CHUNK = 32_768  # cells whose numbers stay in a core's cache
COLLECTED = 128  # sums that the driver adds up itself
CHECKPOINT = 10  # rounds after which margins are written
ALIKE = 1e-10  # gains that differ by less, relatively, are equal


@dataclass(frozen=True)
class Settings:
    """Numbers of a fit, named as Spark ML names them."""

    max_iter: int
    step_size: float
    max_depth: int
    min_instances: int = 20


def cut(values: np.ndarray, counts: np.ndarray, splits: int, upper: np.ndarray | None = None) -> np.ndarray:
    """Spark ML's thresholds of a number: midpoints that cut its rows, ``counts`` a value, into equal parts.

    ``values`` ascend; where they stand for ranges they are the least of each and ``upper`` the greatest.
    """
    upper = values if upper is None else upper
    middle = (upper[:-1] + values[1:]) / 2.0
    if len(middle) <= splits:
        return np.unique(middle)
    stride = float(counts.sum()) / (splits + 1)
    found, current, target = [], float(counts[0]), stride
    for at, n in enumerate(counts[1:].tolist()):
        before, current = current, current + n
        if abs(before - target) < abs(current - target):
            found.append(middle[at])
            target += stride
    return np.unique(found)


def thresholds(train: DataFrame, columns: Sequence[str], splits: int) -> list[np.ndarray]:
    """Thresholds of each of the columns, which are doubles without NULLs, from the counts of all its values."""
    one = [F.struct(F.lit(at).alias("at"), F.col(c).cast("double").alias("v")) for at, c in enumerate(columns)]
    counted = train.select(F.inline(F.array(*one))).groupBy("at", "v").agg(F.count("*").alias("n"))
    counted = Scratch.of(train.sparkSession).keep(counted, "values")
    wide = {r["at"]: r["rows"] for r in counted.groupBy("at").agg(F.count("*").alias("n"), F.sum("n").alias("rows")).filter(F.col("n") > VALUES).collect()}
    few = counted.filter(~F.col("at").isin(list(wide))).toArrow().sort_by("v")
    result = []
    for at, column in enumerate(columns):
        if at in wide:
            place = F.floor(F.col("before") * F.lit(RANGES) / F.lit(wide[at]))
            ranges = profile.running_counts(train, column).groupBy(place.alias("place"))
            found = ranges.agg(F.min("v").alias("v"), F.max("v").alias("most"), F.sum("n").alias("n")).toArrow().sort_by("v")
            result.append(cut(found["v"].to_numpy(), found["n"].to_numpy(), splits, found["most"].to_numpy()))
        else:
            own = few.filter(pc.equal(few["at"], at))
            result.append(cut(own["v"].to_numpy(), own["n"].to_numpy(), splits))
    return result


def _packed(sizes: Sequence[int]) -> list[list[int]]:
    """The inputs' numbers in runs, each of which fits a whole number of 62 bits."""
    runs: list[list[int]] = [[]]
    held = 1
    for at, size in enumerate(sizes):
        if held * size >= 1 << 62:
            runs.append([])
            held = 1
        runs[-1].append(at)
        held *= size
    return runs


def cells(coded: DataFrame, codes: Sequence[str], numbers: Sequence[str], cuts: Sequence[np.ndarray], sizes: Sequence[int], label: str) -> DataFrame:
    """A row for each combination of bins that occurs: its rows ``n``, those of them with label 0 and 1, and the bins as keys."""
    names = [f"_bin_{c}" for c in numbers]
    # A bin of a Bucketizer holds its lower bound, a bin of a tree its upper.
    bounds = [[-math.inf, *np.nextafter(own, math.inf).tolist(), math.inf] if len(own) else [-math.inf, 0.0, math.inf] for own in cuts]
    binned = Bucketizer(splitsArray=bounds, inputCols=list(numbers), outputCols=names).transform(coded)
    bins = [F.col(c).cast("bigint") for c in codes]
    bins += [F.col(c).cast("bigint") if len(own) else F.lit(0).cast("bigint") for c, own in zip(names, cuts)]
    keys = []
    for at, run in enumerate(_packed(sizes)):
        key = bins[run[0]]
        for i in run[1:]:
            key = key * F.lit(sizes[i]) + bins[i]
        keys.append(key.alias(f"key_{at}"))
    marks = binned.select(*keys, F.col(label).alias("y"))
    return marks.groupBy(*[k for k in marks.columns if k != "y"]).agg(
        F.count("*").alias("n"), F.count_if(F.col("y") == 0).alias("negative"), F.count_if(F.col("y") == 1).alias("positive")
    )


def blocks_of(sizes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """A function that cuts a task's cells into blocks: groups of inputs, rows and rows with label 0 by cell.

    Inputs of which few combinations occur in a block are one group: its inputs, the bins of each by
    combination, and the cells' combinations. Like all that tasks run here it holds nothing of this
    package, so executors need no more than numpy and pyarrow.
    """
    runs, combined, most = _packed(sizes), COMBINED, BLOCK

    def small(counts: np.ndarray) -> np.ndarray:
        return counts.astype(np.min_scalar_type(int(counts.max())))

    def block(keys: list[np.ndarray], n: np.ndarray, negative: np.ndarray) -> tuple:
        groups: list[list] = []
        for run, rest in zip(runs, keys):
            for i in reversed(run):
                rest, bins = np.divmod(rest, sizes[i])
                for group in groups:
                    found = np.zeros(len(group[1][0]) * sizes[i], bool)
                    both = group[2] * sizes[i] + bins
                    found[both] = True
                    held = np.flatnonzero(found)
                    if len(held) <= combined:
                        group[0].append(i)
                        group[1] = [*(known[held // sizes[i]] for known in group[1]), held % sizes[i]]
                        group[2] = (np.cumsum(found) - 1)[both]
                        break
                else:
                    groups.append([[i], [np.arange(sizes[i])], bins])
        return [(inputs, [small(bins) for bins in known], small(codes)) for inputs, known, codes in groups], small(n), small(negative)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append([column.to_numpy() for column in batch.columns])
                rows += batch.num_rows
            if rows >= most:
                columns = [np.concatenate(parts) for parts in zip(*held)]
                yield block(columns[: len(runs)], *columns[len(runs) : len(runs) + 2])
                held, rows = [], 0
        if rows:
            columns = [np.concatenate(parts) for parts in zip(*held)]
            yield block(columns[: len(runs)], *columns[len(runs) : len(runs) + 2])

    return blocks


def steps(sizes: Sequence[int], categorical: int) -> tuple[Callable, Callable]:
    """What a pass does with a block: the sums of a level's nodes, and the margin after a tree.

    A path has for each level the splits of its nodes, (feature, left) or None, from left to right; rows
    of a node without a split go left.
    """
    chunk, ends = CHUNK, np.cumsum(sizes)
    starts, n_bins = ends - np.array(sizes), int(ends[-1])

    def turns(groups: list, path: list) -> list[list]:
        """For each level and group the combinations that go right, by node; None where no node asks the group."""
        found = []
        for splits in path:
            tables: list = [None] * len(groups)
            for k, split in enumerate(splits):
                for g, (inputs, known, _) in enumerate(groups):
                    if split is not None and split[0] in inputs:
                        bins = known[inputs.index(split[0])]
                        if tables[g] is None:
                            tables[g] = np.zeros((len(splits), len(bins)), bool)
                        tables[g][k] = ~np.isin(bins, list(split[1])) if split[0] < categorical else bins > split[1]
            found.append(tables)
        return found

    def nodes(codes: list[np.ndarray], tables: list[list], rows: int) -> np.ndarray:
        at = np.zeros(rows, np.int64)
        for level in tables:
            right = np.zeros(rows, bool)
            for code, table in zip(codes, level):
                if table is not None:
                    right |= table.ravel().take(at * table.shape[1] + code)
            at *= 2
            at += right
        return at

    def sums(block: tuple, margin: np.ndarray | None, path: list) -> np.ndarray:
        """Sums and rows by node and bin, then by node in all, and each node's sum of squares."""
        groups, n, negative = block
        width, tables = 2 ** len(path), turns(groups, path)
        found = [np.zeros((2, width * len(known[0]))) for _, known, _ in groups]
        own = np.zeros((2, width, n_bins + 2))
        for start in range(0, len(n), chunk):
            part = slice(start, start + chunk)
            many, zeros = n[part].astype(float), negative[part].astype(float)
            codes = [code[part].astype(np.int64) for _, _, code in groups]
            at = nodes(codes, tables, len(many))
            if margin is None:
                positive, below = 1.0, 2.0
            else:
                with np.errstate(over="ignore"):
                    positive, below = 4.0 / (np.exp(2.0 * margin[part]) + 1.0), 4.0
            weights = many * positive - below * zeros
            squares = (many - zeros) * positive**2 + zeros * (positive - below) ** 2
            for values, place in ((weights, (0, n_bins)), (many, (1, n_bins)), (squares, (0, n_bins + 1))):
                own[place[0], :, place[1]] += np.bincount(at, values, width)
            for code, (_, known, _), sides in zip(codes, groups, found):
                place = at * len(known[0]) + code
                sides[0] += np.bincount(place, weights, sides.shape[1])
                sides[1] += np.bincount(place, many, sides.shape[1])
        for (inputs, known, _), sides in zip(groups, found):
            for i, bins in zip(inputs, known):
                spread = np.zeros((len(bins), sizes[i]))
                spread[np.arange(len(bins)), bins] = 1.0
                own[:, :, starts[i] : ends[i]] = sides.reshape(2, width, len(bins)) @ spread
        return own

    def moved(block: tuple, margin: np.ndarray | None, path: list, values: np.ndarray) -> np.ndarray:
        """The margin with the tree's values added."""
        groups, n, _ = block
        tables, result = turns(groups, path), np.zeros(len(n)) if margin is None else margin.copy()
        for start in range(0, len(n), chunk):
            part = slice(start, start + chunk)
            codes = [code[part].astype(np.int64) for _, _, code in groups]
            result[part] += values[nodes(codes, tables, len(codes[0]))]
        return result

    return sums, moved


def booster(sizes: Sequence[int], categorical: int, settings: Settings) -> Callable[[Callable, Callable], list[tuple]]:
    """The rounds, given a function that sums a level of all rows by a path, and one that adds a tree to all margins.

    A tree is a tuple of nodes in heap order: rows, sum and squares of what it is fitted to, gain, feature and
    ``left``, the last bin or the set of bins that go left. A leaf's feature is None. Leaves of the last level
    are known from the split above, so their squares are not (NaN).
    """
    alike, ends, epsilon = ALIKE, np.cumsum(sizes), 2.220446049250313e-16
    starts, n_bins = ends - np.array(sizes), int(ends[-1])
    rounds, step, depth, least = settings.max_iter, settings.step_size, settings.max_depth, settings.min_instances

    def best_split(sums: np.ndarray, counts: np.ndarray, total: float, n: float) -> tuple:
        """The fall of the variance, the input, its bins to the left, and their rows and sum; the first of equal splits."""
        options = []
        for at, (start, end) in enumerate(zip(starts, ends)):
            s, c, order = sums[start:end], counts[start:end], None
            if at < categorical:
                order = np.argsort(np.where(c > 0, s / np.maximum(c, 1), np.inf), kind="stable")
                s, c = s[order], c[order]
            left, left_n = np.cumsum(s)[:-1], np.cumsum(c)[:-1]
            right, right_n = total - left, n - left_n
            fits = np.minimum(left_n, right_n) >= max(1, least)
            if not fits.any():
                continue
            fall = left**2 / np.maximum(left_n, 1) + right**2 / np.maximum(right_n, 1) - total**2 / n
            gain = np.where(fits, fall / n, -np.inf)
            k = int(np.argmax(gain >= gain.max() - alike * abs(gain.max())))
            options.append((gain[k], at, k if order is None else frozenset(order[: k + 1].tolist()), left_n[k], left[k]))
        most = max((option[0] for option in options), default=0.0)
        return next((option for option in options if option[0] >= most - alike * abs(most)), (0.0, None, None, 0.0, 0.0))

    def boost(level_sums: Callable, add: Callable) -> list[tuple]:
        trees = []
        for number in range(rounds):
            tree: list[tuple | None] = [None] * (2 ** (depth + 1) - 1)
            path: list[list] = []
            alive = {0}
            while alive and len(path) < depth:
                own, first, splits = level_sums(path), 2 ** len(path) - 1, [None] * 2 ** len(path)
                for k in sorted(alive):
                    total, rows, squares = float(own[0, k, n_bins]), float(own[1, k, n_bins]), float(own[0, k, n_bins + 1])
                    impurity = max(0.0, squares / rows - (total / rows) ** 2)
                    found = best_split(own[0, k, :n_bins], own[1, k, :n_bins], total, rows) if impurity >= epsilon else (0.0,)
                    if not found[0] > alike * impurity:
                        tree[first + k] = (rows, total, squares, 0.0, None, None)
                        continue
                    gain, feature, left, left_n, left_sum = found
                    tree[first + k], splits[k] = (rows, total, squares, float(gain), feature, left), (feature, left)
                    for side, side_n, side_sum in ((1, left_n, left_sum), (2, rows - left_n, total - left_sum)):
                        tree[2 * (first + k) + side] = (float(side_n), float(side_sum), math.nan, 0.0, None, None)
                alive = {2 * k + side for k in alive if splits[k] is not None for side in (0, 1)}
                if alive:
                    path.append(splits)
            values = np.zeros(2 ** len(path))
            for k in range(len(values)):
                at = len(values) - 1 + k
                while tree[at] is None:
                    at = (at - 1) // 2
                values[k] = tree[at][1] / tree[at][0]
            trees.append(tuple(tree))
            if number < rounds - 1:
                add(path, values * (step if number else 1.0))
        return trees

    return boost


def _in_one_task(sizes: Sequence[int], categorical: int, settings: Settings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All rounds of few cells, side by side in one task."""
    blocks, boost = blocks_of(sizes), booster(sizes, categorical, settings)
    sums, moved = steps(sizes, categorical)

    def fit_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(blocks(batches))
        margins: list = [None] * len(held)

        def add(path: list, values: np.ndarray) -> None:
            margins[:] = [moved(block, margin, path, values) for block, margin in zip(held, margins)]

        trees = boost(lambda path: sum(sums(block, margin, path) for block, margin in zip(held, margins)), add)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], ["trees"])

    return fit_here


def _over_tasks(dealt: DataFrame, sizes: Sequence[int], categorical: int, settings: Settings) -> list[tuple]:
    """The rounds over blocks that stay where they were read, a job a level; the margins are kept beside them."""
    spark, scratch = dealt.sparkSession, Scratch.of(dealt.sparkSession)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch.path("boosting"))
    blocks, (sums, moved) = blocks_of(sizes), steps(sizes, categorical)

    def pickled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.large_binary())], ["block"])

    def singly(rdd: RDD) -> RDD:
        """An element at a time, so that two such tables are read side by side without being written again."""
        return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)

    cells = singly(dealt.mapInArrow(pickled, "block binary").rdd.map(lambda row: pickle.loads(row[0])))
    state = {"margins": singly(cells.map(lambda block: None)), "old": None, "round": 0, "files": []}

    def level_sums(path: list) -> np.ndarray:
        pairs = cells.zip(state["margins"])
        found = pairs.mapPartitions(lambda part: [own for own in [sum(sums(block, margin, path) for block, margin in part)] if isinstance(own, np.ndarray)])
        total = found.treeReduce(np.add) if pairs.getNumPartitions() > COLLECTED else sum(found.collect())
        if state["old"] is not None:
            state["old"].unpersist()
            state["old"] = None
            if state["round"] % CHECKPOINT == 0:
                for file in state["files"]:
                    delete(spark, file)
                state["files"] = [state["margins"].getCheckpointFile()]
        return total

    def add(path: list, values: np.ndarray) -> None:
        """The next level's job makes the margins."""
        state["round"] += 1
        state["old"] = state["margins"]
        state["margins"] = singly(cells.zip(state["margins"]).map(lambda pair: moved(*pair, path, values)))
        if state["round"] % CHECKPOINT == 0:
            state["margins"].checkpoint()

    try:
        return booster(sizes, categorical, settings)(level_sums, add)
    finally:
        state["margins"].unpersist()
        cells.unpersist()
        for file in state["files"]:
            delete(spark, file)


def _saved(tree: tuple, cuts: Sequence[np.ndarray], sizes: Sequence[int], categorical: int) -> list[list]:
    """The tree's nodes as Spark ML saves them, each before its sides; sides that say the same are one leaf, as there."""
    found: list[list] = []

    def add(at: int) -> float | None:
        rows, total, squares, gain, feature, left = tree[at]
        own, number = total / rows, len(found)
        found.append([number, own, squares / rows - own * own, [rows, total, squares], int(rows), -1.0, -1, -1, (-1, [], -1)])
        if feature is None:
            return own
        first, right = add(2 * at + 1), len(found)
        second = add(2 * at + 2)
        if first is not None and first == second:
            del found[number + 1 :]
            found[number][1] = first
            return first
        code = feature < categorical
        bounds = [float(b) for b in sorted(left)] if code else [float(cuts[feature - categorical][left])]
        found[number][5:] = [gain, number + 1, right, (feature, bounds, sizes[feature] if code else -1)]
        return None

    add(0)
    return found


NODE = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint,
    gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


def as_model(spark: SparkSession, trees: list[tuple], cuts: Sequence[np.ndarray], sizes: Sequence[int], categorical: int, estimator: GBTClassifier) -> GBTClassificationModel:
    """The trees as the model that ``estimator`` returns, by way of the files Spark ML saves: node by node it takes a minute."""
    jvm, gateway, scratch = spark._jvm, spark.sparkContext._gateway, Scratch.of(spark)
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0))
    empty, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for at in range(len(trees)):
        empty[at] = kind(f"{estimator.uid}_{at}", leaf, len(sizes))
        weights[at] = estimator.getStepSize() if at else 1.0
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(estimator.uid, empty, weights, len(sizes), 2)
    path = scratch.path("trees")
    GBTClassificationModel(java).save(path)
    rows = [(at, tuple(node)) for at, tree in enumerate(trees) for node in _saved(tree, cuts, sizes, categorical)]
    spark.createDataFrame(rows, NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    model = GBTClassificationModel.load(path)
    delete(spark, path)
    return estimator._copyValues(model)


def fit(coded: DataFrame, codes: Sequence[str], numbers: Sequence[str], n_codes: Sequence[int], estimator: GBTClassifier) -> GBTClassificationModel:
    """Fit the trees of ``estimator`` to the codes, of which ``n_codes`` may occur, and the numbers of all rows.

    Raises an error where there are no rows or a label is not 0 or 1.
    """
    spark = coded.sparkSession
    scratch = Scratch.of(spark)
    rows = coded.count()
    cuts = thresholds(coded, numbers, min(estimator.getMaxBins(), rows) - 1)
    sizes = [*n_codes, *(len(own) + 1 for own in cuts)]
    folded = scratch.keep(cells(coded, codes, numbers, cuts, sizes, estimator.getLabelCol()), "training-rows")
    n_cells, known = folded.agg(F.count("*"), F.sum(F.col("negative") + F.col("positive"))).first()
    if not rows or known != rows:
        raise ValueError(f"{rows} rows, {known or 0} of them with a label of 0 or 1")
    keys = [c for c in folded.columns if c.startswith("key_")]
    settings = Settings(estimator.getMaxIter(), estimator.getStepSize(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode())
    some = folded.select(*keys, "n", "negative")
    if n_cells <= ALONE:
        found = some.repartition(1).sortWithinPartitions(*keys).mapInArrow(_in_one_task(sizes, len(codes), settings), "trees binary")
        trees = pickle.loads(found.collect()[0]["trees"])
    else:
        tasks = spark.sparkContext.defaultParallelism
        trees = _over_tasks(some.repartition(tasks, *keys).sortWithinPartitions(*keys), sizes, len(codes), settings)
    scratch.discard(folded)
    return as_model(spark, trees, cuts, sizes, len(codes), estimator)
