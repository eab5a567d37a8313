"""Bundles for a stream of requests, and mergeable distinct counts."""

import pytest

from conftest import SMALL, master_lines
from pannier.operators import prepare, profile, ranking, rules
from pannier.plans import catalog
from pannier.sources.scratch import Scratch


def test_a_restarted_stream_answers_new_requests_only(spark):
    scratch, st = Scratch.of(spark), catalog.stages(spark, SMALL)
    pairs, catalogue = rules.one_to_one(st.rules("train")), scratch.keep(prepare.product_catalogue(st.lines("train")), "catalogue")
    asked = catalog.requests(st).orderBy(*catalog.REQUEST).limit(40)
    rows = asked.collect() + asked.limit(3).collect()  # repeated requests are answered each
    first = spark.createDataFrame(rows[:20] + [(None, 1, 1, 1)], asked.schema)
    second = spark.createDataFrame(rows[20:], asked.schema)
    folder, target, state = scratch.path("asked"), scratch.path("answered"), scratch.path("state")

    def run():
        stream = spark.readStream.schema(asked.schema).parquet(folder)
        ranking.best_bundles_on_stream(stream, pairs, catalogue, catalog.REQUEST, target, state).awaitTermination()
        return sorted(map(repr, spark.read.parquet(target).drop("batch").collect()))

    def plain(*tables):
        return sorted(repr(r) for t in tables for r in ranking.best_bundle(t, pairs, catalogue, catalog.REQUEST).collect())

    first.write.parquet(folder)
    assert run() == plain(first)
    assert run() == plain(first)  # nothing new
    second.write.mode("append").parquet(folder)
    assert run() == plain(first, second)


def test_sketches_of_parts_merge(spark):
    rows = spark.range(60_000).selectExpr("id % 7 AS day", "id % 20000 AS a", "IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS b", "CAST(NULL AS INT) AS c")
    kept = profile.distinct_sketches(rows, ["day"], ["a", "b", "c"])
    assert kept.count() == 7
    total = profile.sketched_counts(kept, ["a", "b", "c"]).first()
    assert total["a"] == pytest.approx(20_000, rel=0.03) and total["b"] == pytest.approx(40_000, rel=0.03) and total["c"] == 0
    per_day = profile.sketched_counts(kept, ["a"], ["day"]).collect()
    assert len(per_day) == 7 and all(r["a"] == pytest.approx(60_000 / 7, rel=0.03) for r in per_day)


def test_sketches_of_few_values_are_exact(spark):
    lines = master_lines(spark, {1: ["a", "b"], 2: ["a", "c", "d"], 3: ["a"]})
    kept = profile.distinct_sketches(lines, ["order_dow"], ["order_id", "product_name"])
    assert profile.sketched_counts(kept, ["order_id", "product_name"]).first().asDict() == {"order_id": 3, "product_name": 4}
    assert profile.sketched_counts(kept.limit(0), ["order_id"]).first()["order_id"] == 0
