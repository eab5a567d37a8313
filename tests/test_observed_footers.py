"""Checks counted while tables are written, counts from footers, and sparse vectors."""

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from conftest import SMALL, master_lines
from pannier.operators import itemsets, profile
from pannier.plans import catalog
from pannier.sources.scratch import Scratch


def _checked(spark, df, checks):
    Scratch.of(spark).keep(checks.watch("t", df), "watched")
    return {r["column_name"]: r for r in checks.rows(spark).collect()}


def test_checks_are_counted_by_the_write(spark):
    rows = [(1, "a", 3.0), (2, "a", None), (3, None, -1.0), (4, None, 99.0), (5, "a", 7.0), (None, "b", 0.0)]
    df = spark.createDataFrame(rows, "k bigint, name string, x double").repartition(4)
    found = _checked(spark, df, profile.Checks({"x": (0, 30)}, ("k", "name")))
    assert [found[c]["n_rows"] for c in ("k", "name", "x")] == [6, 6, 6]
    assert [found[c]["nulls"] for c in ("k", "name", "x")] == [1, 2, 1]
    assert [found[c]["n_outside"] for c in ("k", "name", "x")] == [None, None, 2]
    assert [found[c]["most_alike"] for c in ("k", "name", "x")] == [1, 3, None]
    assert found["x"]["type_name"] == "double" and found["k"]["non_null"] == 5


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k bigint, x double")
    found = _checked(spark, df, profile.Checks({"x": (0, None)}, ("k",)))
    assert [tuple(found[c])[3:] for c in ("k", "x")] == [(0, 0, 0, None, 0), (0, 0, 0, 0, None)]


def test_watched_rows_are_written_unchanged(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "k bigint, name string")
    kept = Scratch.of(spark).keep(profile.Checks({}, ("k", "name")).watch("t", df), "watched")
    assert kept.columns == df.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, df.collect()))


def test_checks_agree_with_scans(spark):
    st = catalog.stages(spark, SMALL)
    found = {(r["table_name"], r["column_name"]): r for r in st.checks.collect()}
    for name, df in st.tables.items():
        for r in profile.null_counts(df).collect():
            assert found[name, r["column_name"]]["nulls"] == r["nulls"]
        for r in profile.table_info(df).collect():
            assert found[name, r["column_name"]]["non_null"] == r["non_null"]
    assert found["products", "product_name"]["most_alike"] == 1


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_footers_answer_counts_and_ranges(spark):
    df = spark.createDataFrame([(5, 1.5, "b"), (-3, None, None), (None, None, "c"), (4, 0.5, "d")], "k bigint, x double, name string")
    path = Scratch.of(spark).path("footers")
    df.coalesce(1).write.parquet(path)
    assert [tuple(r) for r in profile.footer_counts(spark, {"t": path}).collect()] == [("t", 4, 3)]
    found = {r[0]: tuple(r)[1:] for r in profile.footer_ranges(spark, path).collect()}
    assert found == {"k": (3, "-3", "5"), "x": (2, None, None), "name": (3, None, None)}
    plan = _plan(profile.footer_range_plan(spark, path))
    assert "PushedAggregation: [COUNT(k)" in plan and "MIN(k)" in plan
    # The caller's own session still reads Parquet as before.
    assert "PushedAggregation" not in _plan(spark.read.parquet(path).agg(F.count("*")))


def test_ranges_where_a_file_has_no_value(spark):
    df = spark.createDataFrame([(5, None), (-3, None), (None, None)], "k bigint, none int")
    path = Scratch.of(spark).path("footers")
    df.coalesce(1).write.parquet(path)
    df.filter("k IS NULL").coalesce(1).write.mode("append").parquet(path)
    found = {r[0]: tuple(r)[1:] for r in profile.footer_ranges(spark, path).collect()}
    assert found == {"k": (2, "-3", "5"), "none": (0, None, None)}


def test_sparse_vectors_hold_the_items_of_their_order(spark):
    lines = master_lines(spark, {1: ["a", "b", "a"], 2: ["c"], 3: ["b", "c", "d"]})
    lines = lines.withColumn("product_name", F.when(F.col("product_name") != "d", F.col("product_name")))
    vocabulary, vectors = itemsets.encode_sparse(lines)
    names = {r["code"]: r["item"] for r in vocabulary.collect()}
    assert sorted(names) == [0, 1, 2, 3]  # without a gap
    assert isinstance(vectors.schema["presence"].dataType, VectorUDT)
    rows = vectors.collect()
    assert all(isinstance(r["presence"], SparseVector) and r["presence"].size == 4 for r in rows)
    held = {r["order_id"]: {names[i] for i in r["presence"].indices} for r in rows}
    assert held == {1: {"a", "b"}, 2: {"c"}, 3: {"b", "c", None}}
    assert all(set(r["presence"].values) == {1.0} for r in rows)
    total = vectors.agg(Summarizer.sum(F.col("presence"))).first()[0]  # Spark ML takes them as they are
    assert {names[i]: total[i] for i in names} == {"a": 1, "b": 2, "c": 2, None: 1}


def test_dense_codes_have_no_gap(spark):
    coded = itemsets.dense_codes(spark.range(0, 1000, 1, 7).filter("id % 3 = 0 OR id < 100"))
    codes = sorted(r["code"] for r in coded.collect())
    assert codes == list(range(len(codes)))


def test_sparse_vectors_of_no_lines(spark):
    vocabulary, vectors = itemsets.encode_sparse(master_lines(spark, {1: ["a"]}).limit(0))
    assert vocabulary.count() == vectors.count() == 0
