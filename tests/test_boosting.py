"""The fit to all rows against Spark ML's own, whose thresholds come from all rows as long as there are few."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from pannier.operators import boosting, model
from pannier.plans import catalog
from pannier.plans.stages import Stages
from pannier.sources.scratch import Scratch


def _frame(n, seed=1):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({c: rng.integers(0, 9, n) for c in model.CATEGORICAL} | {c: rng.normal(size=n).round(3) for c in model.NUMERIC})
    frame["cart_size"] = rng.integers(1, 5, n).astype(float)
    noise = frame["lift"] + (frame["order_dow"] % 3 == 1) * 2 + rng.normal(size=n)
    return frame.assign(label=(noise > 0.5).astype(int))


def _shape_and_leaves(fitted):
    lines = fitted.toDebugString.splitlines()[1:]
    return [re.sub("Predict: .*", "Predict", x) for x in lines], [float(x.split()[1]) for x in lines if "Predict" in x]


@pytest.mark.parametrize("alone", [boosting.ALONE, 0])
def test_trees_are_those_of_spark_ml(spark, monkeypatch, alone):
    """In one task, and in blocks over several tasks with margins kept from round to round and checkpoints."""
    for name, value in {"ALONE": alone, "BLOCK": 300, "CHUNK": 128, "CHECKPOINT": 2}.items():
        monkeypatch.setattr(boosting, name, value)
    frame = pd.concat([_frame(1200), _frame(300)])  # rows with equal bins are one cell
    frame.iloc[::50, 0] = None
    rows = model.features(spark.createDataFrame(frame))
    fitted = model.fit_ranker(rows, max_iter=6, max_depth=4, step_size=0.3)
    coded = model.assembler().transform(fitted.stages[0].transform(rows)).select("features", "label").coalesce(1).cache()
    own = GBTClassifier(labelCol="label", maxIter=6, stepSize=0.3, maxDepth=4, maxBins=32, minInstancesPerNode=20).fit(coded)
    (shape, leaves), (expected_shape, expected) = _shape_and_leaves(fitted.stages[2]), _shape_and_leaves(own)
    assert shape == expected_shape and len(leaves) > 40 and np.allclose(leaves, expected, atol=1e-12)
    assert list(fitted.stages[2].treeWeights) == list(own.treeWeights)
    assert np.allclose(fitted.stages[2].featureImportances.toArray(), own.featureImportances.toArray())


def test_rows_do_not_depend_on_their_layout(spark):
    frame = spark.createDataFrame(_frame(2000))
    one, other = (model.fit_ranker(model.features(f), max_iter=4) for f in (frame, frame.orderBy("lift").repartition(3)))
    assert one.stages[2].toDebugString.splitlines()[1:] == other.stages[2].toDebugString.splitlines()[1:]


def test_thresholds_see_every_value(spark, monkeypatch):
    """Also where there are too many values for the driver to look at each."""
    n = 40_000
    frame = spark.range(n).select((F.col("id") % 20_000).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"))
    plain = boosting.thresholds(frame, ["a", "b"], 31)
    assert plain[1].tolist() == [0.5, 1.5] and len(plain[0]) == 31
    values = np.arange(20_000.0)
    assert plain[0].tolist() == boosting.cut(values, np.full(20_000, 2), 31).tolist()
    monkeypatch.setattr(boosting, "VALUES", 1000)
    ranged = boosting.thresholds(frame, ["a", "b"], 31)
    assert ranged[1].tolist() == [0.5, 1.5] and np.abs(ranged[0] - plain[0]).max() <= 2


def test_odd_rows(spark):
    one_class = _frame(100).assign(label=1)
    fitted = model.fit_ranker(model.features(spark.createDataFrame(one_class)), max_iter=3)
    assert [r["prediction"] for r in fitted.transform(model.features(spark.createDataFrame(one_class))).select("prediction").distinct().collect()] == [1.0]
    for wrong in (2, None):
        bad = model.features(spark.createDataFrame(_frame(50))).withColumn("label", F.when(F.col("lift") > 0, F.lit(wrong).cast("int")).otherwise(F.col("label")))
        with pytest.raises(ValueError, match="label"):
            model.fit_ranker(bad, max_iter=2)


def test_inputs_of_many_bins_take_several_keys():
    assert boosting._packed([300] * 12) == [list(range(7)), list(range(7, 12))]


def test_registered_ranker_is_fitted_to_all_rows(spark, monkeypatch):
    """F11-F20: no sample; every training candidate is in a cell."""
    kept, keep = {}, Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, label, *rest: kept.setdefault(label, keep(self, df, label, *rest)))
    monkeypatch.setattr(Scratch, "discard", lambda self, *tables: None)
    monkeypatch.setattr(boosting, "booster", lambda sizes, categorical, settings: lambda sums, add: [((1.0, 1.0, 1.0, 0.0, None, None),)] * 2)
    monkeypatch.setattr(catalog, "_stages", {})
    st = catalog.stages(spark, "/root/testdata/sf0.001")
    assert st.ranker and "training-sample" not in kept
    n = st.candidates("train").count()
    assert kept["training-rows"].agg(F.sum("n")).first()[0] == n


def test_candidates_are_scored_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr("pannier.plans.stages.score", lambda ranker, df: calls.append(1) or df.withColumn("score", F.lit(0.5)))
    monkeypatch.setattr(Stages, "ranker", None)
    st = Stages(spark, dict)
    st._kept["test-candidates"] = spark.createDataFrame([(1, 2, 3, 4, 1)], "order_id long, trigger_product_id long, recommended_product_id long, cart_size int, label int")
    assert st.scored.count() == 1 and st.scored.first()["score"] == 0.5 and calls == [1]
