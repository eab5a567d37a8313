import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import master_lines
from pannier.operators import itemsets, ranking, rules
from pannier.plans import catalog

CARTS = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a"], 4: ["b", "c", "b"], 5: ["d"]}


def _random_carts(n=300, items=12, seed=1):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(items)]
    return {
        order: list(dict.fromkeys(rng.choices([f"item{i:02d}" for i in range(items)], weights, k=rng.randint(1, 6))))
        for order in range(n)
    }


def _as_dict(found):
    return {
        (tuple(r.antecedents), tuple(r.consequents)): tuple(round(v, 9) for v in r[2:]) for r in found.collect()
    }


def _rounded(expected):
    return {key: tuple(round(v, 9) for v in values) for key, values in expected.items()}


def test_hand_worked_supports(spark):
    lines = master_lines(spark, CARTS)
    singles = {r["item"]: (r.freq, r.support) for r in itemsets.item_support(lines).collect()}
    assert singles == {"a": (3, 0.6), "b": (3, 0.6), "c": (2, 0.4), "d": (1, 0.2)}
    pairs = itemsets.frequent_pairs(itemsets.frequent_baskets(lines, 0.2)).collect()
    assert {(r.item_a, r.item_b): r.freq for r in pairs} == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 2}


def test_hand_worked_rule(spark):
    found = _as_dict(rules.generate_rules(master_lines(spark, CARTS), 0.4, 0.15))
    assert set(found) == {(("a",), ("b",)), (("b",), ("a",)), (("b",), ("c",)), (("c",), ("b",))}
    assert found[("c",), ("b",)] == (0.4, 0.6, 0.4, 1.0, round(1 / 0.6, 9))


def test_repeated_item_counts_once(spark):
    lines = master_lines(spark, {1: ["a", "a", "a", "b"], 2: ["c"], 3: ["c"], 4: ["c"]})
    found = itemsets.frequent_baskets(lines, 0.5)
    # three lines in one of four orders pass the line count but not the exact support
    assert [r["item"] for r in itemsets.frequent_items(found).collect()] == ["c"]
    assert itemsets.frequent_pairs(found).count() == 0


@pytest.mark.parametrize("pairs_only", [True, False])
@pytest.mark.parametrize("min_support,min_confidence", [(0.01, 0.15), (0.05, 0.3), (0.3, 0.9)])
def test_rules_match_brute_force(spark, pairs_only, min_support, min_confidence):
    carts = _random_carts()
    found = rules.generate_rules(master_lines(spark, carts), min_support, min_confidence, pairs_only=pairs_only)
    expected = brute.rules(carts, min_support, min_confidence, 2 if pairs_only else None)
    assert _as_dict(found) == _rounded(expected)


def test_itemsets_match_brute_force_at_the_exact_threshold(spark):
    carts = _random_carts(100)
    for min_support in (0.07, 0.14, 0.29):  # thresholds that some counts hit exactly
        found = itemsets.frequent_itemsets(itemsets.frequent_baskets(master_lines(spark, carts), min_support))
        expected = {s: c for s, c in brute.itemset_counts(carts).items() if c / 100 >= min_support}
        assert {tuple(r["items"]): r.freq for r in found.collect()} == expected


def test_one_to_one_rules_of_fp_growth_are_the_pair_rules(spark):
    lines = master_lines(spark, _random_carts(seed=7))
    general = rules.generate_rules(lines, 0.02, 0.15, pairs_only=False)
    plain = general.filter((F.size("antecedents") == 1) & (F.size("consequents") == 1))
    assert _as_dict(plain) == _as_dict(rules.generate_rules(lines, 0.02, 0.15))


def test_rule_properties(spark):
    found = _as_dict(rules.generate_rules(master_lines(spark, _random_carts(seed=3)), 0.02, 0.0))
    for (left, right), (sa, sb, sab, confidence, lift) in found.items():
        assert sab <= min(sa, sb) + 1e-9 and 0 < confidence <= 1
        assert abs(found[right, left][4] - lift) < 1e-6


def test_rules_do_not_depend_on_partitioning(spark):
    lines = master_lines(spark, _random_carts(seed=5))
    assert _as_dict(rules.generate_rules(lines.repartition(13))) == _as_dict(rules.generate_rules(lines.coalesce(1)))


def test_min_lift_and_collapse(spark):
    lines = master_lines(spark, _random_carts(seed=9))
    every = rules.generate_rules(lines, 0.02, 0.1, pairs_only=False)
    strong = rules.generate_rules(lines, 0.02, 0.1, min_lift=1.2, pairs_only=False)
    assert _as_dict(strong) == {k: v for k, v in _as_dict(every).items() if v[4] >= 1.2}
    collapsed = rules.one_to_one(every, "min")
    assert collapsed.count() == every.count() > rules.one_to_one(every).count()
    with pytest.raises(ValueError):
        rules.one_to_one(every, "max")


def test_identical_baskets_fold(spark):
    carts = {i: ["a", "b", "c"] for i in range(50)} | {100 + i: ["a"] for i in range(50)}
    found = itemsets.frequent_baskets(master_lines(spark, carts), 0.1)
    assert found.weighted.count() == 2
    assert {r.freq for r in itemsets.frequent_pairs(found).collect()} == {50}


def test_wide_baskets_are_cut_exactly(spark, monkeypatch):
    carts = _random_carts(200, seed=11) | {999: [f"item{i:02d}" for i in range(12)]}
    whole = itemsets.frequent_pairs(itemsets.frequent_baskets(master_lines(spark, carts), 0.01)).collect()
    monkeypatch.setattr(itemsets, "WIDE", 3)
    cut = itemsets.frequent_pairs(itemsets.frequent_baskets(master_lines(spark, carts), 0.01)).collect()
    assert sorted(cut) == sorted(whole) and len(whole) > 60


def test_nothing_frequent(spark):
    lines = master_lines(spark, {i: [f"only{i}"] for i in range(5)})
    for pairs_only in (True, False):
        assert rules.generate_rules(lines, 0.5, 0.1, pairs_only=pairs_only).count() == 0
    assert itemsets.frequent_itemsets(itemsets.frequent_baskets(lines.limit(0), 0.5)).count() == 0


def test_encodings(spark):
    lines = master_lines(spark, CARTS)
    assert itemsets.encode_long(lines).count() == 9
    order_baskets = itemsets.baskets(lines)
    assert {r.order_id: r["items"] for r in order_baskets.collect()}[4] == ["b", "c"]
    vocabulary, vectors = itemsets.encode_vectors(lines)
    names = {r.code: r["item"] for r in vocabulary.collect()}
    vector = {r.order_id: r.presence for r in vectors.collect()}[4]
    assert sorted(names[code] for code in vector) == ["b", "c"] and vector == sorted(vector)
    assert len(set(names.values())) == len(names) == lines.select("product_name").distinct().count()
    sizes = {r["size"]: r.n for r in itemsets.size_histogram(order_baskets.withColumn("size", F.size("items"))).collect()}
    assert sizes == {1: 2, 2: 2, 3: 1}


def _mined(spark, orders):
    """All itemsets of the orders with their supports, by brute force."""
    from itertools import combinations

    items = sorted(set().union(*orders))
    rows = []
    for size in range(1, len(items) + 1):
        for chosen in combinations(items, size):
            n = sum(set(chosen) <= set(o) for o in orders)
            if n:
                rows.append((list(chosen), size, n, n / len(orders)))
    return spark.createDataFrame(rows, "items array<string>, size int, freq bigint, support double"), rows


@pytest.mark.parametrize("least", [0.0, 0.5, 0.9])
def test_grown_rules_are_all_rules(spark, least):
    from itertools import combinations

    itemsets, rows = _mined(spark, ["abcde", "abc", "abd", "acde", "be", "bcde", "abcd"])
    support = {tuple(r[0]): r[3] for r in rows}
    want = set()
    for items, s in support.items():
        for size in range(1, len(items)):
            for left in combinations(items, size):
                if s / support[left] >= least:
                    want.add((left, tuple(x for x in items if x not in left)))
    found = rules.association_rules(itemsets, least).collect()
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in found} == want and len(found) == len(want)


def test_a_long_itemset_is_not_split_in_all_ways(spark):
    """Thirty items have 2**30 splits; one single consequent passes, so there is one level more and no rule in it."""
    items = [f"i{k:02d}" for k in range(30)]
    rows = [(items, 30, 1, 0.1), ([items[7]], 1, 5, 0.5)]
    rows += [([x for x in items if x != y], 29, 1, 0.1 if y == items[7] else 0.9) for y in items]
    found = rules.association_rules(spark.createDataFrame(rows, "items array<string>, size int, freq bigint, support double"), 0.6)
    assert [(r["consequents"], r["confidence"], r["lift"]) for r in found.filter("size(antecedents) = 29").collect()] == [([items[7]], 1.0, 2.0)]


def test_rules_of_no_itemsets(spark):
    assert rules.association_rules(spark.createDataFrame([], "items array<string>, size int, freq bigint, support double")).count() == 0


def _many_alike(spark):
    """Six names whose rules repeat the same sides, as general rules do that stand for their smallest names."""
    rng = random.Random(5)
    lines = [(o, n, "abcdef".index(n), at) for o in range(60) for at, n in enumerate(rng.sample("abcdef", rng.randint(1, 6)), 1)]
    found = [(rng.choice("abc"), rng.choice("cdef"), rng.random(), rng.choice([0.2, 0.4, 0.6]), rng.choice([0.9, 1.1])) for _ in range(300)]
    found = [(a, b, "abcdef".index(b), *rest) for a, b, *rest in found if a != b]
    lines = spark.createDataFrame(lines, "order_id long, product_name string, product_id long, add_to_cart_order int")
    return lines, spark.createDataFrame(found, "antecedent string, consequent string, recommended_product_id long, support double, confidence double, lift double")


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_general_queries_expand_lines_by_the_rules_they_need(spark, monkeypatch):
    lines, mined = _many_alike(spark)
    monkeypatch.setattr(catalog, "_general_rules", lambda *_: (lines, mined))
    expanded, whole = [], catalog._general_candidates
    monkeypatch.setattr(catalog, "_general_candidates", lambda ls, some: expanded.append(some.count()) or whole(ls, some))
    every = whole(lines, mined)
    counted = every.groupBy("trigger_product_id", "recommended_product_id").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.round(F.max("lift"), 9).alias("max_lift")
    )
    assert _rows(catalog.candidates_general_rules(spark, "")) == _rows(counted)
    top = ranking.top_k(every, 5, "confidence")
    columns = [*ranking.GROUP, "rank", "recommended_product_id", F.round("confidence", 9).alias("confidence"), "label"]
    assert _rows(catalog.ranked_general_rules(spark, "")) == _rows(top.select(*columns))
    first = ranking.first_recommendations(every).withColumn("confidence", F.round("confidence", 9))
    assert _rows(catalog.first_general_rules(spark, "")) == _rows(first)
    pairs = mined.select("antecedent", "consequent").distinct().count()
    assert expanded == [pairs, 15, pairs]  # of some 300 rules; 3 antecedents of 5 rules each
