"""The physical plans hold what the operators promise."""

import os
import re
import shutil

import pytest

from conftest import SMALL
from pannier.operators import candidates as cand
from pannier.operators import itemsets, metrics, prepare, ranking, rules
from pannier.plans.catalog import QUERIES, stages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def st(spark):
    return stages(spark, SMALL)


def test_filters_and_columns_reach_the_scan(st):
    t = st.tables
    text = plan(prepare.build_master(t["orders"], t["order_products"], t["products"], t["departments"]))
    assert "EqualTo(eval_set,prior)" in text
    scan = next(line for line in text.splitlines() if "eval_set,prior" in line)
    assert "user_id" not in scan


def test_split_scan_is_pruned(st):
    text = plan(st.lines("test").select("order_id"))
    assert "PartitionFilters: [isnotnull(split" in text
    assert "ReadSchema: struct<order_id:bigint>" in text


def test_candidates_are_never_shuffled(st, conf):
    lines, found = st.lines("train"), rules.one_to_one(st.rules("train"))
    kept = st.scratch.keep(found, "rules")
    conf(autoBroadcastJoinThreshold="10k")  # the rules still fit, the lines do not
    text = plan(cand.expand_and_look_up(lines, kept))
    assert "SortMergeJoin" in text
    shuffles = re.findall(r"Exchange hashpartitioning.*", text)
    assert len(shuffles) == 2 and all("REPARTITION_BY_NUM" in s for s in shuffles)


def test_rules_too_large_to_broadcast_are_shuffled(st, conf):
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(cand.expand(st.lines("train"), rules.one_to_one(st.rules("train"))))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_top_k_cuts_groups_before_the_shuffle(st):
    text = plan(ranking.top_k(st.candidates("test"), 5, "confidence"))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_pairs_are_summed_before_the_shuffle(st):
    text = plan(itemsets.frequent_pairs(itemsets.frequent_baskets(st.lines("train"))))
    assert "partial_sum(orders" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith("scan_csv")}))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_rule_metrics_read_the_candidates_once(st):
    assert plan(metrics.rule_precision_recall_at_k(st.candidates("test"))).count("FileScan") == 1


def test_changed_source_files_are_read_again(spark, tmp_path):
    for table in ("orders", "lineitem", "part"):
        shutil.copy(f"{SMALL}/{table}.parquet", tmp_path / f"{table}.parquet")
    first = stages(spark, str(tmp_path))
    assert stages(spark, str(tmp_path)) is first
    os.utime(tmp_path / "part.parquet", (1, 1))
    assert stages(spark, str(tmp_path)) is not first


def test_sorted_queries_are_in_a_total_order(spark):
    rows = [tuple(r) for r in QUERIES["sorted_orders"](spark, SMALL).select("user_id", "order_number", "order_id").collect()]
    assert rows == sorted(rows) and len(set(rows)) == len(rows)
    columns = ["order_id", "add_to_cart_order", "consequent"]
    rows = [tuple(r) for r in QUERIES["sorted_expansion"](spark, SMALL).select(*columns).collect()]
    assert rows == sorted(rows) and len(set(rows)) == len(rows)
