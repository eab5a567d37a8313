"""Compiled trees against the model they come from, in Spark and as SQL elsewhere."""

import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle

from pannier.operators import masks, model, trees

COLUMNS = [*model.CATEGORICAL, *model.NUMERIC]


def _frame(rng, n, departments):
    data = {c: rng.integers(0, 9, n) for c in model.CATEGORICAL}
    data["recommended_department_id"] = rng.choice(departments, n)
    data |= {c: rng.normal(size=n).round(3) for c in model.NUMERIC}
    frame = pd.DataFrame(data)
    noise = frame["lift"] + (frame["order_dow"] % 3 == 1) * 2 - (frame["recommended_department_id"] % 2) + rng.normal(size=n)
    frame["label"] = (noise > 0.5).astype(int)
    return frame


@pytest.fixture(scope="module")
def fitted(spark):
    train = _frame(np.random.default_rng(1), 1500, [1, 2, 3, 4])
    return model.fit_ranker(model.features(spark.createDataFrame(train)), max_iter=8, max_depth=4)


def test_a_fitted_model_and_its_trees_agree(spark, fitted):
    """Also on values that the model has not seen, and on missing ones."""
    rows = _frame(np.random.default_rng(2), 400, [1, 2, 3, 4, 77])
    frame = spark.createDataFrame(rows).withColumn("_margin", model.F.lit("clash"))
    ensemble = trees.ensemble_of(fitted)
    assert len(ensemble.trees) == 8
    by_model = [r["score"] for r in model.score(fitted, frame.drop("_margin")).orderBy(*COLUMNS).collect()]
    by_trees = [r["score"] for r in trees.score_trees(ensemble, frame.drop("_margin"), group=3).orderBy(*COLUMNS).collect()]
    assert np.allclose(by_model, by_trees, atol=1e-9) and len(set(by_trees)) > 50
    con = duckdb.connect()
    con.register("candidates", rows)
    elsewhere = con.execute(f"SELECT {ensemble.probability()} FROM candidates ORDER BY {', '.join(COLUMNS)}").fetchall()
    assert np.allclose(by_trees, [p for p, in elsewhere], atol=1e-12)


def test_missing_values_go_where_the_model_sends_them(spark, fitted):
    rows = _frame(np.random.default_rng(3), 60, [1, 2]).astype(object)
    for at in range(len(rows)):
        rows.loc[at, COLUMNS[at % len(COLUMNS)]] = None
    schema = ", ".join([*(f"{c} bigint" for c in model.CATEGORICAL), *(f"{c} double" for c in model.NUMERIC), "label bigint", "n bigint"])
    rows["n"] = range(len(rows))
    frame = spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], schema)
    one = {r["n"]: r["score"] for r in model.score(fitted, frame).collect()}
    two = {r["n"]: r["score"] for r in trees.score_trees(trees.ensemble_of(fitted), frame).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_odd_ensembles(spark):
    frame = spark.createDataFrame(_frame(np.random.default_rng(4), 5, [1]))
    assert {r["score"] for r in trees.score_trees(trees.Ensemble(()), frame).collect()} == {0.5}
    assert trees.score_trees(trees.Ensemble(((1.0, trees.Leaf(0.5)),)), frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="not a tree"):
        trees.read_ensemble("Tree 0 (weight 1.0):\n  nothing", COLUMNS, {})
    named = trees.Split("who", trees.Leaf(1.0), trees.Leaf(2.0), values=("o'neil", "b"))
    assert trees.Ensemble(((1.0, named),)).margin().startswith("CASE WHEN who IN ('o''neil', 'b')")


@pytest.mark.parametrize("depth", [1, 5, 6])
def test_masks_score_as_spark_ml_does(spark, monkeypatch, depth):
    """Also on unseen and missing values and at thresholds; rows are walked through the trees only where those are too large."""
    train = _frame(np.random.default_rng(5), 3000, [1, 2, 3, 4])
    fitted = model.fit_ranker(model.features(spark.createDataFrame(train)), max_iter=30, step_size=0.3, max_depth=depth)
    rows = pd.concat([train[:900], _frame(np.random.default_rng(6), 1500, [1, 2, 3, 77])]).astype(object)
    for at in range(0, len(rows), 7):
        rows.iloc[at, at % len(COLUMNS)] = None
    rows["n"] = range(len(rows))
    schema = ", ".join([*(f"{c} bigint" for c in model.CATEGORICAL), *(f"{c} double" for c in model.NUMERIC), "label bigint", "n bigint"])
    frame = spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], schema)
    plain = fitted.transform(model.features(frame, ["n"])).select("n", model.vector_to_array("probability")[1].alias("score"))
    expected = dict(plain.collect())
    assert (masks.masks_of_model(fitted) is None) == (depth == 6)
    walked, transform = [], type(fitted).transform
    monkeypatch.setattr(type(fitted), "transform", lambda self, *rest: walked.append(1) or transform(self, *rest))
    found = dict(model.score(fitted, frame).select("n", "score").collect())
    assert bool(walked) == (depth == 6) and found.keys() == expected.keys()
    assert max(abs(found[n] - expected[n]) for n in found) < 1e-14


def test_no_rows_and_lone_leaves_score(spark):
    leaf = masks.masks_of(trees.Ensemble(((1.0, trees.Leaf(0.5)), (0.5, trees.Leaf(-1.0)))), ["a"], {})
    assert leaf.scorer()(pd.Series(np.zeros(3))).tolist() == [0.5] * 3 and leaf.scorer()(pd.Series(np.zeros(0))).size == 0
    assert masks.masks_of(trees.Ensemble(()), ["a"], {}) is None


def test_tasks_score_without_this_package(fitted):
    """Executors need numpy and pandas only."""
    pickled = cloudpickle.dumps(masks.masks_of_model(fitted).scorer())
    code = f"import pickle, pandas as pd; print(len(pickle.loads({pickled!r})(*[pd.Series([0.0, 1.0])] * {len(COLUMNS)})))"
    assert subprocess.run([sys.executable, "-c", code], cwd="/", env={}, capture_output=True, text=True).stdout == "2\n"


def test_masks_are_combined_for_rows_side_by_side(fitted):
    """Inputs that rows share are combined once for all of them, and any layout of the rows scores alike."""
    rows = _frame(np.random.default_rng(7), 20_000, [1, 2, 3])[COLUMNS]
    rows[model.CATEGORICAL] %= 3  # as codes
    shared = rows.assign(**{c: rows[c].iloc[np.arange(len(rows)) // 500 * 500].to_numpy() for g in masks.TOGETHER for c in g})
    found = masks.masks_of_model(fitted)
    assert sorted(i for group in found.together for i in group) == list(range(len(COLUMNS))) and len(found.together) == 3
    for frame in (rows, shared):
        scores = found.scorer()(*(frame[c] for c in COLUMNS))
        one_by_one = [found.scorer()(*(frame[c].iloc[at : at + 1] for c in COLUMNS))[0] for at in range(0, len(frame), 400)]
        assert scores[::400].tolist() == one_by_one and len(set(one_by_one)) > 10
