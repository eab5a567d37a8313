import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pannier.operators import metrics, model
from pannier.plans.catalog import stages
from pannier.sources.schemas import CANDIDATES
from pannier.sources.scratch import Scratch


@pytest.fixture(scope="module")
def split(spark):
    st = stages(spark, SMALL)
    return st.candidates("train"), st.candidates("test")


def test_features_coerce_and_fill(spark):
    row = {c: 1 for c in CANDIDATES.names} | {"order_id": 7}
    df = spark.createDataFrame([row]).select(
        *[F.col(c) for c in CANDIDATES.names if c not in ("lift", "support", "confidence", "cart_size")],
        F.lit("twelve").alias("cart_size"),
        F.lit("0.5").alias("support"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(float("nan")).alias("lift"),
    )
    found = model.features(df, keep=["order_id"]).first()
    assert (found.cart_size, found.support, found.confidence, found.lift, found.order_id) == (0.0, 0.5, 0.0, 0.0, 7)
    assert len(model.features(df).columns) == 13


def test_ranker_learns_and_unseen_categories_score(spark, split):
    train, test = split
    fitted = model.fit_ranker(model.features(train), max_iter=8, max_depth=4, step_size=0.3)
    unseen = test.withColumn("trigger_product_id", F.col("trigger_product_id") + 10_000)
    scored = model.score(fitted, test)
    assert scored.columns == [*CANDIDATES.names, "score"]
    assert scored.filter("score BETWEEN 0 AND 1").count() == test.count()
    assert model.score(fitted, unseen).filter("score IS NULL").count() == 0
    assert metrics.roc_auc(model.score(fitted, train)).first().roc_auc > 0.6


def test_decision_is_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.499,)], "score double")
    assert [r.prediction for r in model.decide(df).orderBy("score").collect()] == [0, 1]


def test_sample_is_picked_by_all_tasks(spark, split, monkeypatch):
    """Only the rows of the sample pass through the few tasks that write the training rows."""
    train = model.features(split[0]).repartition(6)
    kept, keep = {}, Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, label, *rest: kept.update({label: df.rdd.getNumPartitions()}) or keep(self, df, label, *rest))
    n = train.count() // 2
    model.fit_ranker(train, max_iter=1, max_depth=2, max_train_rows=n)
    assert kept["training-rows"] == 1 < kept["training-sample"]
