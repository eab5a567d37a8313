import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import master_lines
from pannier.operators import prepare, profile
from pannier.plans.stages import Stages
from pannier.sources.schemas import CANDIDATES, DEPARTMENTS, ORDERS, PRODUCTS
from pannier.sources.tables import RAW_NAMES, build_clean_tables, read_csv, read_raw, write_table


def test_master_drops_lonely_orders_and_products_and_fills_days(shop):
    rows = prepare.build_master(**_renamed(shop)).orderBy("order_id", "add_to_cart_order").collect()
    # order 4 has no lines, cheese no department, order 5 is not prior
    assert [(r.order_id, r.product_name, r.days_since_prior_order) for r in rows] == [
        (1, "apple", -1.0),
        (1, "bread", -1.0),
        (2, "bread", 3.0),
        (2, "apple", 3.0),
    ]


def _renamed(shop):
    return {"orders": shop["orders"], "lines": shop["order_products"], "products": shop["products"], "departments": shop["departments"]}


def test_nan_days_count_as_missing(spark, shop):
    orders = shop["orders"].withColumn(
        "days_since_prior_order", F.when(F.col("order_id") == 2, F.lit(float("nan"))).otherwise(1.0)
    )
    master = prepare.build_master(**{**_renamed(shop), "orders": orders})
    assert {r.days_since_prior_order for r in master.filter("order_id = 2").collect()} == {-1.0}


@pytest.mark.parametrize("n", [0, 1, 2, 499, 1000, 4999, 5000, 6000])
def test_sample_is_exact_and_independent_of_partitioning(spark, n):
    ids = spark.range(5000).withColumnRenamed("id", "order_id")
    drawn = {r.order_id for r in prepare.sample_rows(ids, "order_id", n).collect()}
    assert len(drawn) == min(n, 5000)
    assert drawn == {r.order_id for r in prepare.sample_rows(ids.repartition(3), "order_id", n).collect()}


def test_sample_is_the_n_smallest_hashes(spark):
    ids = spark.range(3000).withColumnRenamed("id", "order_id")
    smallest = prepare.peek(ids, "order_id", 700).collect()
    assert {r.order_id for r in smallest} == {r.order_id for r in prepare.sample_rows(ids, "order_id", 700).collect()}


def test_sample_and_split_are_independent(spark):
    ids = spark.range(20000).withColumnRenamed("id", "order_id")
    _, test = prepare.split_orders(prepare.sample_rows(ids, "order_id", 2000))
    assert 300 < test.count() < 500


def test_user_sample_keeps_whole_histories(spark):
    orders = spark.range(1000).select(F.col("id").alias("order_id"), (F.col("id") % 50).alias("user_id"))
    counts = prepare.sample_users(orders, 7).groupBy("user_id").count().collect()
    assert [r["count"] for r in counts] == [20] * 7


def test_sample_of_one_dominant_user(spark):
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("user_id")
    )
    assert prepare.sample_users(orders, 2001).count() == 3000
    assert prepare.sample_users(orders, 500).select("user_id").distinct().count() == 500


def test_split_never_cuts_an_order(spark):
    lines = spark.range(4000).select((F.col("id") % 1000).alias("order_id"), "id")
    train, test = prepare.split_orders(lines)
    assert train.join(test, "order_id", "left_semi").count() == 0
    assert train.count() + test.count() == 4000
    assert 150 < test.select("order_id").distinct().count() < 250
    assert prepare.split_orders(lines, 1.0)[1].count() == 4000
    assert prepare.split_orders(lines, 0.0)[0].count() == 4000


def test_membership_does_not_multiply(spark, shop):
    ids = spark.createDataFrame([(2,), (2,), (99,)], "order_id bigint")
    assert prepare.keep_members(shop["order_products"], ids, "order_id").count() == 3


def test_order_lines_come_in_cart_order(spark):
    master = master_lines(spark, {27: ["c", "a", "b"], 28: ["a"]})
    assert [r.product_name for r in prepare.order_lines(master, 27).collect()] == ["c", "a", "b"]


def test_shared_name_is_an_error(spark):
    lines = master_lines(spark, {1: ["a", "b"]}).withColumn("product_name", F.lit("same"))
    with pytest.raises(prepare.CardinalityError):
        prepare.assert_unique(prepare.product_catalogue(lines), "product_name")


def test_catalogue_keeps_one_row_per_product(spark):
    lines = master_lines(spark, {1: ["b", "a"], 2: ["a", "a"]})
    assert [r.product_name for r in prepare.product_catalogue(lines).orderBy("product_id").collect()] == ["a", "b"]


def test_hygiene_checks(shop):
    found = {r.check_name: r.n for r in profile.orphan_counts(*(shop[n] for n in ("orders", "order_products", "products", "departments"))).collect()}
    expected = {"lines_without_order": 0, "lines_without_product": 0, "products_without_department": 1, "orders_without_lines": 1}
    assert found == expected
    nulls = {r.column_name: r.nulls for r in profile.null_counts(shop["orders"]).collect()}
    assert nulls["days_since_prior_order"] == 2 and nulls["order_id"] == 0
    outside = profile.out_of_range(shop["orders"], {"order_dow": (1, 3), "order_number": (2, None)}).collect()
    assert {r.column_name: r.n_outside for r in outside} == {"order_dow": 2, "order_number": 2}


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    row = profile.describe(df, ["v"]).first()
    assert (row.n, row["mean"], row.min, row.q25, row.q50, row.q75, row.max) == (4, 4, 1, 1.75, 2.5, 4.75, 10)
    assert round(row["std"], 6) == 4.082483


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quartiles_by_counted_values(spark, n):
    values = [(k * k % 97) / 4 for k in range(n)] + [None]
    row = profile.describe(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert [row.q25, row.q50, row.q75] == pytest.approx(list(np.quantile(values[:-1], [0.25, 0.5, 0.75])))


def test_csv_files_of_other_column_order_or_bad_text_are_refused(spark, tmp_path):
    folder = tmp_path / "products.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("product_id,product_name,department_id\n1,apple,10\n")
    (folder / "b.csv").write_text("department_id,product_name,product_id\n20,bread,2\n")
    with pytest.raises(Exception):
        read_csv(spark, str(folder), PRODUCTS).collect()
    (folder / "b.csv").write_text("product_id,product_name,department_id\nx7,cheese,oops\n")
    with pytest.raises(Exception):
        read_csv(spark, str(folder), PRODUCTS).collect()
    (folder / "b.csv").write_text("product_id,product_name,department_id\n2,bread,20\n")
    assert sorted(tuple(r) for r in read_csv(spark, str(folder), PRODUCTS).collect()) == [(1, "apple", 10), (2, "bread", 20)]


def test_csv_columns_go_by_name_and_quotes_double(spark, tmp_path):
    text = 'product_id,product_name,aisle_id,department_id\n7,"Say ""Cheese"", please",61,19\n8,Plain,3,\n'
    (tmp_path / "products.csv").write_text(text)
    rows = read_csv(spark, f"{tmp_path}/products.csv", PRODUCTS).orderBy("product_id").collect()
    assert [tuple(r) for r in rows] == [(7, 'Say "Cheese", please', 19), (8, "Plain", None)]
    write_table(read_csv(spark, f"{tmp_path}/products.csv", PRODUCTS), f"{tmp_path}/again", "csv")
    assert sorted(read_csv(spark, f"{tmp_path}/again", PRODUCTS).collect(), key=str) == sorted(rows, key=str)
    with pytest.raises(ValueError):
        read_csv(spark, f"{tmp_path}/products.csv", DEPARTMENTS)


def test_csv_round_trip_and_clean_tables(shop, tmp_path):
    for name, df in shop.items():
        write_table(df, f"{tmp_path}/{RAW_NAMES.get(name, name)}.csv", "csv")
    raw = read_raw(shop["orders"].sparkSession, str(tmp_path))
    clean = build_clean_tables(raw, f"{tmp_path}/clean")
    for name, df in shop.items():
        assert sorted(clean[name].collect(), key=str) == sorted(df.collect(), key=str)
    assert clean["orders"].schema.names == ORDERS.names
    assert clean["orders"].filter("days_since_prior_order IS NULL").count() == 2


def test_stages_from_raw_csv_to_written_candidates(shop, tmp_path):
    spark = shop["orders"].sparkSession
    for name, df in shop.items():
        write_table(df, f"{tmp_path}/raw/{RAW_NAMES.get(name, name)}.csv", "csv")
    whole = Stages(spark, lambda: read_raw(spark, f"{tmp_path}/raw"))
    assert whole.master.count() == 4
    sampled = Stages(spark, lambda: read_raw(spark, f"{tmp_path}/raw"), n=1, unit="user")
    assert sampled.master.select("order_id").distinct().count() in (0, 2)
    whole.write(f"{tmp_path}/out")
    written = [read_csv(spark, f"{tmp_path}/out/{s}_order_data.csv", CANDIDATES) for s in ("train", "test")]
    assert sum(df.count() for df in written) == sum(whole.candidates(s).count() for s in ("train", "test"))
