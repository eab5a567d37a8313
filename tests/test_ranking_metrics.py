import random

import pytest

import brute
from pannier.operators import metrics, ranking

COLUMNS = "order_id bigint, trigger_product_id bigint, recommended_product_id bigint, cart_size int, confidence double, label int"
ROWS = [
    (1, 1, 2, 1, 0.9, 0),
    (1, 1, 3, 1, 0.8, 1),
    (1, 1, 4, 1, 0.8, 1),
    (1, 2, 3, 2, 0.95, 0),
    (2, 1, 2, 1, 0.9, 0),
    (2, 1, 3, 1, 0.1, 0),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_top_k_breaks_ties_by_product(scored):
    top = ranking.top_k(scored, 2, "confidence").filter("order_id = 1 AND trigger_product_id = 1")
    assert sorted((r["rank"], r.recommended_product_id) for r in top.collect()) == [(1, 2), (2, 3)]


def test_first_recommendation_is_the_earliest_not_the_most_confident(scored):
    first = ranking.first_recommendations(scored).filter("order_id = 1 AND recommended_product_id = 3").first()
    assert (first.confidence, first.label) == (0.8, 1)


def test_lines_at_one_position_resolve_to_the_smaller_trigger(spark):
    rows = [(1, 2**31 + 5, 9, 4, 0.5, 1), (1, 2**31 + 3, 9, 4, 0.6, 0), (1, 1, 9, 5, 0.9, 1)]
    first = ranking.first_recommendations(spark.createDataFrame(rows, COLUMNS).repartition(3)).first()
    assert (first.trigger_product_id, first.confidence, first.label) == (2**31 + 3, 0.6, 0)


@pytest.mark.parametrize("triggers", [(2**32 + 1, 2), (2**32 + 1, 1), (-5, 2**32 - 5), (-(2**33), 7)])
def test_triggers_are_compared_in_full(spark, triggers):
    rows = [(1, t, 9, 4, 0.1 * at, at % 2) for at, t in enumerate(triggers)]
    for order in (rows, rows[::-1]):
        first = ranking.first_recommendations(spark.createDataFrame(order, COLUMNS).coalesce(1)).first()
        assert first.trigger_product_id == min(triggers)
        assert (first.confidence, first.label) == next((r[4], r[5]) for r in rows if r[1] == min(triggers))


def test_missing_scores_and_labels_are_refused(spark):
    for row in ((None, 1), (float("nan"), 0), (0.5, None)):
        df = spark.createDataFrame([(0.9, 1), (0.1, 0), row], "score double, label int")
        with pytest.raises(Exception, match="1 rows have no score or no label"):
            metrics.classification_metrics(df).collect()
        with pytest.raises(ValueError, match="1 rows have no score or no label"):
            metrics.roc_auc(df)


def test_model_metrics_skip_groups_without_positives(scored):
    at = {r.k: r for r in metrics.precision_recall_at_k(scored, (1, 2, 5), "confidence").collect()}
    # groups: (1,1) labels 0,1,1; (1,2) label 0; (2,1) labels 0,0
    assert at[1].precision == 0 and at[1].recall == 0
    assert at[2].precision == pytest.approx((1 / 2 + 0 + 0) / 3) and at[2].recall == pytest.approx(1 / 2)
    # k above the group size divides by the rows there are
    assert at[5].precision == pytest.approx((2 / 3) / 3) and at[5].recall == 1


def test_rule_metrics_count_orders_without_positives_as_zero(scored):
    at = {r.k: r for r in metrics.rule_precision_recall_at_k(scored, (1, 3)).collect()}
    # order 1 ranks 2 (0), 3 (1), 4 (1); order 2 ranks 2 (0), 3 (0)
    assert at[1].precision == 0 and at[1].recall == 0
    assert at[3].precision == pytest.approx((2 / 3) / 2) and at[3].recall == pytest.approx(1 / 2)


def test_classification_metrics(spark, scored):
    row = metrics.classification_metrics(scored, 0.85, "confidence").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (pytest.approx(1 / 6), 0, 0, 0)
    row = metrics.classification_metrics(scored, 0.8, "confidence").first()
    assert (row.precision, row.recall) == (pytest.approx(2 / 5), 1)
    assert row.f1 == pytest.approx(4 / 7)
    row = metrics.classification_metrics(scored, 2.0, "confidence").first()
    assert (row.precision, row.recall, row.f1) == (0, 0, 0)


@pytest.mark.parametrize("digits,buckets", [(1, 4), (2, 16), (9, 64), (9, 256)])
def test_auc_matches_pair_counting(spark, digits, buckets):
    rng = random.Random(digits * buckets)
    # a third of the rows share one score
    rows = [(0.25 if i % 3 == 0 else round(rng.random() ** 3, digits), int(rng.random() < 0.3)) for i in range(600)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert metrics.roc_auc(df, range_scores=max(1, 400 // buckets)).first().roc_auc == pytest.approx(brute.auc(rows), abs=1e-12)


def test_auc_edge_cases(spark):
    def auc(rows):
        return metrics.roc_auc(spark.createDataFrame(rows, "score double, label int")).first().roc_auc

    assert auc([(0.5, 1), (0.5, 0)]) == 0.5
    assert auc([(0.9, 1), (0.1, 0)]) == 1.0
    assert auc([(0.1, 1), (0.9, 0)]) == 0.0
    assert auc([(0.1, 1), (0.9, 1)]) is None
    assert auc([(float(i % 7), int(i % 2 == 0)) for i in range(1000)]) == pytest.approx(
        brute.auc([(float(i % 7), int(i % 2 == 0)) for i in range(1000)])
    )


def test_metrics_of_nothing(spark, scored):
    none = scored.limit(0)
    assert metrics.roc_auc(none, "confidence").first().roc_auc is None
    assert metrics.classification_metrics(none, 0.5, "confidence").first()[:] == (0, 0, 0, 0)
    assert {r.precision for r in metrics.precision_recall_at_k(none, score="confidence").collect()} == {None}


def test_one_dominant_group_is_ranked_right(spark):
    rng = random.Random(4)
    hot = [(1, 1, i, 1, rng.random(), int(rng.random() < 0.5)) for i in range(2000)]
    cold = [(o, 1, i, 1, rng.random(), int(rng.random() < 0.5)) for o in range(2, 800) for i in range(5)]
    df = spark.createDataFrame(hot + cold, COLUMNS).repartition(16)
    groups = {}
    for row in hot + cold:
        groups.setdefault(row[0], []).append(row)
    for r in metrics.precision_recall_at_k(df, (1, 10), "confidence").collect():
        precision, recall = [], []
        for rows in groups.values():
            best = sorted(rows, key=lambda x: (-x[4], x[2]))[: r.k]
            precision.append(sum(x[5] for x in best) / len(best))
            if total := sum(x[5] for x in rows):
                recall.append(sum(x[5] for x in best) / total)
        assert r.precision == pytest.approx(sum(precision) / len(precision))
        assert r.recall == pytest.approx(sum(recall) / len(recall))


def test_best_bundle_by_confidence(spark):
    rules = spark.createDataFrame(
        [("a", "b", 0.1, 0.5, 1.0), ("a", "c", 0.1, 0.5, 1.0), ("b", "a", 0.1, 0.2, 1.0), ("b", "c", 0.2, 0.7, 1.0)],
        "antecedent string, consequent string, support double, confidence double, lift double",
    )
    catalogue = spark.createDataFrame(
        [(1, "a", 1, "x"), (2, "b", 1, "x"), (3, "c", 1, "x"), (4, "d", 1, "x")],
        "product_id bigint, product_name string, department_id int, department string",
    )
    requests = spark.createDataFrame([(1, 8), (1, 9), (2, 8), (4, 8)], "trigger_product_id bigint, order_hour_of_day int")
    keys = ["trigger_product_id", "order_hour_of_day"]
    best = ranking.best_bundle(requests, rules, catalogue, keys)
    assert {(r.trigger_product_id, r.order_hour_of_day): r.recommended_product_name for r in best.collect()} == {
        (1, 8): "b",  # a tie goes to the smaller product id
        (1, 9): "b",
        (2, 8): "c",
        (4, 8): None,
    }
