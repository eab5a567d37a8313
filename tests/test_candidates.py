import pytest
from pyspark.sql import functions as F

import brute
from conftest import master_lines
from pannier.operators import candidates as cand
from pannier.operators import rules
from pannier.operators.prepare import CardinalityError
from pannier.sources.schemas import CANDIDATES
from pannier.sources.scratch import Scratch

RULES = "antecedent string, consequent string, support double, confidence double, lift double"


def _rules(spark, pairs):
    return spark.createDataFrame([(a, b, 0.1, 0.5, 1.1) for a, b in pairs], RULES)


def _labels(found):
    columns = ["order_id", "trigger_product_name", "cart_size", "recommended_product_name", "label"]
    return sorted(tuple(r) for r in found.select(*columns).collect())


def test_labels_by_cart_position(spark):
    carts = {1: ["a", "b"], 2: ["b", "a"], 3: ["a"], 4: ["c"], 9: ["z", "b"]}
    found = cand.build_candidates(master_lines(spark, carts), _rules(spark, [("a", "b")]))
    assert _labels(found) == [(1, "a", 1, "b", 1), (2, "a", 2, "b", 0), (3, "a", 1, "b", 0)]
    assert found.schema.names == CANDIDATES.names
    row = found.filter("order_id = 1").first()
    assert (row.trigger_product_id, row.recommended_product_id, row.recommended_department_name) == (1, 2, "dept3")
    assert (row.support, row.confidence, row.lift) == (0.1, 0.5, 1.1)


def test_a_repeated_product_is_bought_once(spark):
    carts = {1: ["a", "b", "a", "b"], 2: ["b", "b", "a"]}
    found = cand.build_candidates(master_lines(spark, carts), _rules(spark, [("a", "b")]))
    assert _labels(found) == sorted(brute.candidates(carts, [("a", "b")]))


@pytest.mark.parametrize("part_rows", [3, 100_000])
def test_outsized_orders_give_the_same_candidates(spark, conf, part_rows):
    carts = {order: [f"p{(order * k) % 17:02d}" for k in range(1, 1 + order % 5)] for order in range(1, 60)}
    carts[77] = [f"p{i % 40:02d}" for i in range(90)]  # a third of all lines, products repeated
    pairs = [(f"p{i:02d}", f"p{(i * 7 + 3) % 40:02d}") for i in range(40)] + [("p01", "p02"), ("p02", "p01")]
    lines, found_rules = master_lines(spark, carts), _rules(spark, pairs)
    expected = sorted(brute.candidates(carts, pairs))
    for threshold in ("10m", "-1"):  # with and without broadcasts
        conf(autoBroadcastJoinThreshold=threshold, adaptive__autoBroadcastJoinThreshold=threshold)
        looked_up = cand.label(cand.expand_and_look_up(lines, found_rules, part_rows))
        rows = looked_up.select("order_id", "product_name", "add_to_cart_order", "consequent", "label").collect()
        assert sorted(tuple(r) for r in rows) == expected


def test_popular_product_with_shuffled_skew_joins(spark, conf):
    carts = {order: ["hot", f"p{order % 50:02d}"] for order in range(3000)}
    pairs = [("hot", f"p{i:02d}") for i in range(50)]
    lines, found_rules = master_lines(spark, carts), _rules(spark, pairs)
    usual = _labels(cand.build_candidates(lines, found_rules))
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        adaptive__advisoryPartitionSizeInBytes="10k",
    )
    assert _labels(cand.build_candidates(lines, found_rules)) == usual
    assert len(usual) == 3000 * 50


def test_two_products_with_one_name_are_an_error(spark):
    lines = master_lines(spark, {1: ["a", "b"], 2: ["a", "c"]})
    same = lines.withColumn("product_name", F.when(F.col("product_name") == "c", "b").otherwise(F.col("product_name")))
    with pytest.raises(CardinalityError):
        cand.build_candidates(same, _rules(spark, [("a", "b")]))


def test_rules_from_other_orders_may_name_unknown_products(spark):
    found = cand.build_candidates(master_lines(spark, {1: ["a"]}), _rules(spark, [("a", "gone"), ("gone", "a")])).collect()
    assert [(r.recommended_product_id, r.recommended_product_name, r.label) for r in found] == [(None, None, 0)]


def test_no_rules_no_candidates(spark):
    lines = master_lines(spark, {1: ["a", "b"]})
    assert cand.build_candidates(lines, _rules(spark, [("a", "b")]).limit(0)).count() == 0


def test_stats(spark):
    lines = master_lines(spark, {1: ["a", "b"], 2: ["b"], 3: ["a"]})
    found = cand.build_candidates(lines, _rules(spark, [("a", "b"), ("b", "a")]))
    stats = cand.order_stats(found)
    assert {r.order_id: (r.candidates, r.positives) for r in stats.collect()} == {1: (2, 1), 2: (1, 0), 3: (1, 0)}
    assert cand.share_with_positive(stats).first().share == pytest.approx(1 / 3)


def test_mined_rules_feed_candidates(spark):
    carts = {i: ["a", "b", "c"][: 1 + i % 3] for i in range(30)}
    lines = master_lines(spark, carts)
    mined = rules.one_to_one(rules.generate_rules(lines, 0.2, 0.15))
    pairs = [(r.antecedent, r.consequent) for r in mined.collect()]
    assert _labels(cand.build_candidates(lines, mined)) == sorted(brute.candidates(carts, pairs))


def test_an_order_below_no_threshold_takes_several_tasks(spark):
    """9,999 lines of one order with 20 rules each; every candidate comes once."""
    names = [f"p{i:03d}" for i in range(200)]
    carts = {1: [names[i % 200] for i in range(9_999)], 2: ["p000", "p001"]}
    pairs = [(a, names[(i + k) % 200]) for i, a in enumerate(names) for k in range(1, 21)]
    found = cand.expand_and_look_up(master_lines(spark, carts), _rules(spark, pairs), 10_000)
    rows = found.filter("order_id = 1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(rows) > 3 and sum(r["count"] for r in rows) == 9_999 * 20


def test_candidates_are_not_sorted_to_find_their_outcome(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    lines = master_lines(spark, {1: ["a", "b", "c"], 2: ["b", "a", "b"]})
    pairs = Scratch.of(spark).keep(_rules(spark, [("a", "b"), ("b", "c"), ("b", "a")]), "pairs")
    found = cand.expand_and_look_up(lines, F.broadcast(pairs))
    text = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert "BroadcastHashJoin" in joins[0] and "SortMergeJoin" in "".join(joins[1:])  # expanded last
    rows = sorted((r.order_id, r.product_name, r.consequent, r.actual_add_to_cart_order or 0) for r in found.collect())
    assert rows == [(1, "a", "b", 2), (1, "b", "a", 1), (1, "b", "c", 3), (2, "a", "b", 3)] + [(2, "b", "a", 2)] * 2 + [(2, "b", "c", 0)] * 2
