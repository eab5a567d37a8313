"""The derived grocery tables, with one user and one order holding a third of everything."""

import re
from datetime import datetime, timedelta

from conftest import SMALL
from pannier.plans.catalog import stages
from pannier.sources.scratch import Scratch
from pannier.sources.star import star_order_products, star_orders


def test_numbering_of_a_dominant_user(spark):
    start = datetime(1995, 1, 1)
    rows = [(i, 1 if i % 3 == 0 else 2 + i % 40, start + timedelta(days=(i * 37) % 50)) for i in range(900)]
    raw = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz")
    found = {r.order_id: r for r in star_orders(raw).collect()}
    by_user = {}
    for key, user, day in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_user.setdefault(user, []).append((key, day))
    assert len(found) == 900
    for orders in by_user.values():
        for at, (key, day) in enumerate(orders):
            gap = None if at == 0 else float((day - orders[at - 1][1]).days)
            r = found[key]
            assert (r.order_number, r.days_since_prior_order) == (at + 1, gap)
            assert r.eval_set == ("train" if at + 1 == len(orders) else "prior")
            assert r.order_dow == (day.weekday() + 1) % 7


def test_lines_of_a_dominant_order(spark):
    part = spark.createDataFrame([(i, f"Brand#{1 + i % 25}") for i in range(100)], "p_partkey bigint, p_brand string")
    lines = [(1 if i % 3 == 0 else i % 50 + 2, (i * 13) % 100, i % 9) for i in range(1500)]
    lineitem = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int")
    orders = spark.createDataFrame([(o, 1, o) for o in range(1, 60)], "order_id bigint, user_id bigint, order_number int")
    found = star_order_products(lineitem, part, orders).collect()
    expected = {}
    for order, key, line in lines:
        product = 1 + key % 25
        expected[order, product] = min(line, expected.get((order, product), 99))
    assert {(r.order_id, r.product_id) for r in found} == set(expected)
    first = {}
    for order, product in sorted(expected):
        first.setdefault(product, order)
    for r in found:
        ahead = [p for (o, p), line in expected.items() if o == r.order_id and (line, p) < (expected[o, r.product_id], r.product_id)]
        assert r.add_to_cart_order == len(ahead) + 1
        assert r.reordered == int(r.order_id > first[r.product_id])


def test_lines_are_moved_twice(spark, conf, monkeypatch):
    """By order, then by user and product; lines of unknown orders and users count as not bought before."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    part = spark.createDataFrame([(i, f"Brand#{1 + i % 3}") for i in range(2)] + [(2, None)], "p_partkey bigint, p_brand string")
    lineitem = spark.createDataFrame([(o, p, 1) for o in (1, 2, 3, 8, 9, None) for p in (0, 1, 2)], "l_orderkey bigint, l_partkey bigint, l_linenumber int")
    # An order that comes twice has two numbers; order 8 has no user.
    rows = [(1, 7, 1), (2, 7, 2), (2, 7, 3), (3, 5, 1), (8, None, 4), (8, None, 5)]
    orders = spark.createDataFrame(rows, "order_id bigint, user_id bigint, order_number int")
    written = []
    monkeypatch.setattr(Scratch, "keep", lambda self, df, *rest: written.append(df) or df)
    lines = star_order_products(lineitem, part, orders)
    assert not written
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L[,)]", lines._jdf.queryExecution().executedPlan().toString())
    # Of each join one shuffle is that of the other side: parts, and orders.
    assert sorted(moved) == ["l_partkey", "order_id", "order_id", "p_partkey", "user_id"]
    found = sorted((r.order_id or 0, r.product_id or 0, r.reordered) for r in lines.collect())
    again = [(0, 0), (1, 0), (2, 1), (2, 1), (3, 0), (8, 0), (8, 0), (9, 0)]
    assert found == sorted((order, product, flag * (product > 0)) for order, flag in again for product in (0, 1, 2))


def test_several_tasks_a_core(spark):
    """Scans and merged partitions are cut finer than one task a core."""
    many = str(3 * spark.sparkContext.defaultParallelism)
    assert {spark.conf.get(f"spark.sql.{key}.minPartitionNum") for key in ("files", "adaptive.coalescePartitions")} == {many}


def test_expected_numbers(spark):
    st = stages(spark, SMALL)
    assert st.master.count() == 4936
    assert (st.rules("train").count(), st.rules("test").count()) == (268, 300)
    assert st.candidates("train").filter("label = 1").count() == 3967
    assert st.candidates("test").count() == 10953
