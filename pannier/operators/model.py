"""Feature frame, boosted-tree ranker and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.functions.expressions import fill_missing, to_number
from pannier.operators import boosting
from pannier.sources.scratch import Scratch

# The model's inputs.
CATEGORICAL = [
    "order_dow",
    "order_hour_of_day",
    "trigger_product_id",
    "recommended_product_id",
    "recommended_department_id",
]
NUMERIC = [
    "days_since_prior_order",
    "order_number",
    "cart_size",
    "trigger_reordered",
    "support",
    "confidence",
    "lift",
]
TARGET = "label"
TASK_ROWS = 50_000  # rows of a bounded training sample in one task


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, with 0 for missing values and for text that is no number."""
    return df.withColumns({c: fill_missing(to_number(c), 0.0) for c in columns})


def features(candidates: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The twelve model inputs, the integer label where there is one, and columns to ``keep``."""
    target = [TARGET] if TARGET in candidates.columns else []
    kept = [c for c in keep or [] if c not in CATEGORICAL + NUMERIC + target]
    typed = coerce_numeric(candidates.select(*kept, *CATEGORICAL, *NUMERIC, *target), NUMERIC)
    return typed.withColumn(TARGET, F.col(TARGET).cast("int")) if target else typed


def fit_indexer(train: DataFrame) -> StringIndexerModel:
    """Category codes by descending frequency in the training rows; unseen values share one more."""
    return StringIndexer(
        inputCols=CATEGORICAL, outputCols=[f"{c}_index" for c in CATEGORICAL], handleInvalid="keep"
    ).fit(train)


def assembler() -> VectorAssembler:
    """Category codes and numbers as one vector."""
    return VectorAssembler(inputCols=[f"{c}_index" for c in CATEGORICAL] + NUMERIC, outputCol="features")


def training_sample(train: DataFrame, max_rows: int, seed: int = 42) -> DataFrame:
    """All rows, or about ``max_rows`` of them chosen by a hash of their values."""
    n = train.count()
    if n <= max_rows:
        return train
    place = F.pmod(F.xxhash64(*map(F.col, sorted(train.columns)), F.lit(seed)), F.lit(1 << 30))
    return train.filter(place < int(max_rows / n * (1 << 30)))


def fit_ranker(
    train: DataFrame,
    max_iter: int = 500,
    step_size: float = 0.05,
    max_depth: int = 5,
    seed: int = 42,
    max_train_rows: int | None = None,
) -> PipelineModel:
    """Fit the boosted trees on a feature frame.

    Products among the candidates are frequent items, which keeps the number of
    categories, and with it ``maxBins``, within the bound the mining sets. All rows are
    fitted to, by ``boosting``; only a caller's ``max_train_rows`` bounds them, see
    ``training_sample``. Category codes come from all rows.
    """
    indexer = fit_indexer(train)
    train = train if max_train_rows is None else training_sample(train, max_train_rows, seed)
    bins = max(32, *[len(labels) + 2 for labels in indexer.labelsArray])
    trees = GBTClassifier(
        labelCol=TARGET,
        maxIter=max_iter,
        stepSize=step_size,
        maxDepth=max_depth,
        maxBins=bins,
        minInstancesPerNode=20,
        seed=seed,
    )
    if max_train_rows is not None:
        # All tasks pick the sample; then few tasks for its few rows.
        train = Scratch.of(train.sparkSession).keep(train, "training-sample").coalesce(max_train_rows // TASK_ROWS + 1)
    n_codes = [len(labels) + 1 for labels in indexer.labelsArray]
    fitted = boosting.fit(indexer.transform(train), [f"{c}_index" for c in CATEGORICAL], NUMERIC, n_codes, trees)
    return PipelineModel(stages=[indexer, assembler(), fitted])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the probability of the positive class as ``score``; its numeric inputs become doubles.

    The model codes the categories; batches of rows then go through masks of the trees' leaves (see
    ``masks``), some ten times faster than node by node. Trees too large for masks are
    walked by Spark ML.
    """
    from pannier.operators.masks import masks_of_model  # which reads this module's inputs

    typed = features(df, keep=df.columns)
    masks = masks_of_model(model)
    if masks is None:
        return model.transform(typed).withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")

    codes = [f"{c}_index" for c in CATEGORICAL]
    coded = model.stages[0].transform(typed)
    return coded.withColumn("score", F.pandas_udf(masks.scorer(), "double")(*codes, *NUMERIC)).select(*df.columns, "score")


def decide(scored: DataFrame, threshold: float = 0.5, score_column: str = "score") -> DataFrame:
    """Predict 1 at or above the threshold."""
    return scored.withColumn("prediction", (F.col(score_column) >= threshold).cast("int"))
