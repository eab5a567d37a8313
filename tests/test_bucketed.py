"""Tables in buckets by order: joins and groupings on the order without a shuffle."""

import random
import re

from conftest import SMALL, master_lines
from pannier.operators import candidates, itemsets, prepare, rules
from pannier.plans import catalog
from pannier.sources.tables import write_bucketed
from pannier.sources.scratch import Scratch


def order_shuffles(df):
    plan = df._jdf.queryExecution().toString()
    return re.findall(r"Exchange hashpartitioning\(order_id[^)]*\)", plan)


def test_no_shuffle_by_order(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    st = catalog.stages(spark, SMALL)
    plain = prepare.join_lines(st.tables["orders"], st.tables["order_products"])
    assert order_shuffles(plain)
    assert not order_shuffles(prepare.join_lines(st.bucketed["orders"], st.bucketed["order_products"]))
    assert not order_shuffles(itemsets.baskets(st.bucketed["master"]))


def test_candidates_meet_purchases_in_their_bucket(spark, conf):
    """Only orders cut into parts are laid out again; rules are small enough to be broadcast."""
    st = catalog.stages(spark, SMALL)
    pairs = Scratch.of(spark).keep(rules.one_to_one(st.rules("train")), "pairs")
    lines = st.bucketed["master"]
    small = lines.join(pairs.limit(0).selectExpr("1L AS order_id"), "order_id", "left_anti")
    taken = candidates.purchases(small).groupBy("order_id", "consequent").max("actual_add_to_cart_order")
    found = candidates.look_up_outcome(candidates.expand(small, pairs), taken)
    assert not order_shuffles(found)


def test_large_orders_are_cut(spark):
    rng = random.Random(2)
    carts = {order: rng.sample("abcdefgh", rng.randint(1, 8)) for order in range(40)} | {99: list("abcdefghijkl")}
    lines = master_lines(spark, carts)
    pairs = Scratch.of(spark).keep(
        spark.createDataFrame([(a, b, 0.1, 0.2, 1.0) for a in "abcdef" for b in "cdefghz" if a != b], "antecedent string, consequent string, support double, confidence double, lift double"),
        "pairs",
    )
    bucketed = write_bucketed(lines, Scratch.of(spark).path("bucketed"), "order_id", 4)
    want = sorted(map(repr, candidates.look_up_outcome(candidates.expand(lines, pairs), candidates.purchases(lines)).select("order_id", "product_name", "consequent", "actual_add_to_cart_order").collect()))
    for part_rows in (10, 100_000):
        found = candidates.look_up_in_buckets(bucketed, pairs, part_rows)
        assert sorted(map(repr, found.select("order_id", "product_name", "consequent", "actual_add_to_cart_order").collect())) == want
    assert candidates.look_up_in_buckets(bucketed.limit(0), pairs).count() == 0


def test_null_keys_are_kept(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (None, "c")], "order_id bigint, product_name string")
    assert write_bucketed(rows, Scratch.of(spark).path("bucketed"), "order_id", 3).count() == 3


def test_a_lookup_reads_one_bucket(spark, conf):
    conf(sources__bucketing__autoBucketedScan__enabled="false")  # only so that the plan tells the count; files are left out either way
    st = catalog.stages(spark, SMALL)
    order = st.master.first()["order_id"]
    found = prepare.order_lines(st.bucketed["master"], order)
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"SelectedBucketsCount: 1 out of \d+", plan)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, prepare.order_lines(st.master, order).collect()))
    assert prepare.order_lines(st.bucketed["master"], -5).count() == 0
