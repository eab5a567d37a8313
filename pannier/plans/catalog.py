"""The registered queries: one or more per operator, over all rows of the source folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pannier.functions.expressions import fill_missing, yes_no
from pannier.operators import candidates as cand
from pannier.operators import itemsets, metrics, model, prepare, profile, ranking, rules, trees
from pannier.plans.stages import RANGES, Stages
from pannier.session import configure
from pannier.sources.scratch import Scratch, files_state
from pannier.sources.star import star_tables, star_type_carts, star_type_lines
from pannier.sources.tables import read_csv, write_table
from pannier.sources.schemas import MASTER, TABLES

SOURCES = ("orders", "lineitem", "part")
SAMPLE_ORDERS, SAMPLE_USERS = 1000, 100
THRESHOLD = 0.16  # decision threshold where the score is a confidence

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_stages: dict[tuple[str, str, str], Stages] = {}


def reset_stages() -> None:
    """Forget all stage outputs; the next query builds its own."""
    _stages.clear()


def stages(spark: SparkSession, folder: str) -> Stages:
    """The stage outputs for a source folder, built once per application and state of its files."""
    key = (spark.sparkContext.applicationId, folder, files_state(spark, [f"{folder}/{t}.parquet" for t in SOURCES]))
    if key not in _stages:
        _stages[key] = Stages(configure(spark), lambda: star_tables(spark, folder))
    return _stages[key]


def query(function: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    """Register a query that starts from the stage outputs."""
    QUERIES[function.__name__] = lambda spark, folder: function(stages(spark, folder))
    return function


def _r9(column: Column | str) -> Column:
    return F.round(column, 9)


def _rounded(df: DataFrame, *exact: str) -> DataFrame:
    return df.select(*[F.col(c) if c in exact else _r9(F.col(c)).alias(c) for c in df.columns])


def _labelled(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("table_name", F.lit(name)) for name, df in parts.items()])


def _flat(mined: DataFrame) -> DataFrame:
    """Rule sides as text."""
    return mined.withColumns({side: F.array_join(side, ",") for side in ("antecedents", "consequents")})


# Scans, sources and sinks


def _csv_table(st: Stages, name: str) -> DataFrame:
    folder = st.scratch.path("csv")
    write_table(st.tables[name], f"{folder}/{name}.csv", "csv")
    return read_csv(st.spark, f"{folder}/{name}.csv", TABLES[name])


for _name in TABLES:
    QUERIES[f"scan_csv_{_name}"] = lambda spark, folder, name=_name: _csv_table(stages(spark, folder), name)


@query
def scan_master(st: Stages) -> DataFrame:
    return st.master


@query
def write_master_csv(st: Stages) -> DataFrame:
    path = st.scratch.path("master-csv")
    write_table(st.master.drop("split"), path, "csv")
    return read_csv(st.spark, path, MASTER)


@query
def write_candidates(st: Stages) -> DataFrame:
    both = st.candidates("train").withColumn("split", F.lit("train")).unionByName(
        st.candidates("test").withColumn("split", F.lit("test"))
    )
    path = st.scratch.path("candidates-out")
    write_table(both, path, partition_by=("split",))
    return st.spark.read.schema(both.schema).parquet(path).groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sum("label").cast("bigint").alias("positives"),
        F.sum("cart_size").cast("bigint").alias("sum_cart_size"),
    )


@query
def clean_tables(st: Stages) -> DataFrame:
    return profile.row_counts(st.tables)


@query
def row_counts(st: Stages) -> DataFrame:
    names = {"orders": st.tables["orders"], "order_products": st.tables["order_products"]}
    return profile.row_counts({**names, "master": st.master.drop("split"), "test_candidates": st.candidates("test")})


@query
def table_info(st: Stages) -> DataFrame:
    tables = {"orders": st.tables["orders"], "order_products": st.tables["order_products"]}
    return _labelled({n: profile.table_info(df) for n, df in {**tables, "master": st.master.drop("split")}.items()})


@query
def footer_row_counts(st: Stages) -> DataFrame:
    """A6 from the footers of the written tables."""
    return profile.footer_counts(st.spark, {name: f"{st.clean_folder}/{name}.parquet" for name in st.tables})


def footer_column_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A6 and A7 over the given tables, from their footers."""
    return _labelled({name: profile.footer_ranges(spark, f"{folder}/{name}.parquet") for name in SOURCES})


QUERIES["footer_column_ranges"] = footer_column_ranges


@query
def observed_table_checks(st: Stages) -> DataFrame:
    """A7, E13, E18 and D6's unique names, counted by the jobs that wrote the tables; a row per count."""
    counts = ["n_rows", "non_null", "nulls", "n_outside", "most_alike"]
    return st.checks.unpivot(["table_name", "column_name", "type_name"], counts, "check_name", "n").filter("n IS NOT NULL")


# Projections, filters and expressions


@query
def order_context(st: Stages) -> DataFrame:
    return st.tables["orders"].select(*prepare.ORDER_COLUMNS)


@query
def prior_orders(st: Stages) -> DataFrame:
    return prepare.prior_orders(st.tables["orders"])


@query
def member_lines(st: Stages) -> DataFrame:
    sample = prepare.sample_rows(prepare.prior_orders(st.tables["orders"]), "order_id", SAMPLE_ORDERS)
    return prepare.keep_members(st.tables["order_products"], sample, "order_id")


@query
def missing_days(st: Stages) -> DataFrame:
    return prepare.missing_days(st.tables["orders"])


@query
def filled_days(st: Stages) -> DataFrame:
    return st.tables["orders"].select(
        "order_id", fill_missing("days_since_prior_order", -1.0).alias("days_since_prior_order")
    )


@query
def largest_order_lines(st: Stages) -> DataFrame:
    sizes = st.master.groupBy("order_id").agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max_by("order_id", F.struct("n", "order_id"))).scalar()
    return prepare.order_lines(st.master, largest)


@query
def bucketed_order_lines(st: Stages) -> DataFrame:
    """B6 over lines in buckets by order, of which only the order's own bucket is read."""
    sizes = st.bucketed["master"].groupBy("order_id").agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max_by("order_id", F.struct("n", "order_id"))).first()[0]
    return prepare.order_lines(st.bucketed["master"], largest)


@query
def first_orders(st: Stages) -> DataFrame:
    return prepare.first_orders(st.tables["orders"])


@query
def renamed_lines(st: Stages) -> DataFrame:
    return st.master.drop("split").withColumnsRenamed(cand.TRIGGER_NAMES)


@query
def later_purchase_labels(st: Stages) -> DataFrame:
    return st.all_candidates.select("order_id", "trigger_product_id", "recommended_product_id", "label")


@query
def purchased_flags(st: Stages) -> DataFrame:
    flagged = st.all_candidates.withColumn("candidate_purchased", yes_no("label"))
    return profile.value_counts(flagged, "candidate_purchased")


@query
def rules_min_confidence(st: Stages) -> DataFrame:
    return _flat(rules.filter_confidence(st.rules("train"), 0.16))


@query
def rules_min_lift(st: Stages) -> DataFrame:
    return _flat(rules.filter_lift(st.rules("train"), 1.02))


def coerced_numbers(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    texts = part.select(
        "p_partkey", F.substring_index("p_brand", "#", -1).alias("brand_number"), "p_name", F.col("p_retailprice")
    )
    return model.coerce_numeric(texts, ["brand_number", "p_name", "p_retailprice"])


QUERIES["coerced_numbers"] = coerced_numbers


# Sampling and splitting


@query
def sampled_orders(st: Stages) -> DataFrame:
    return prepare.sample_rows(prepare.prior_orders(st.tables["orders"]), "order_id", SAMPLE_ORDERS).select("order_id")


@query
def sampled_users(st: Stages) -> DataFrame:
    return prepare.sample_users(prepare.prior_orders(st.tables["orders"]), SAMPLE_USERS)


@query
def split_sides(st: Stages) -> DataFrame:
    return st.tables["orders"].select("order_id", prepare.split_column().alias("split"))


@query
def random_peek(st: Stages) -> DataFrame:
    return prepare.peek(st.tables["orders"], "order_id", 10).select("order_id", "days_since_prior_order")


# Joins


@query
def orders_with_lines(st: Stages) -> DataFrame:
    return prepare.join_lines(st.tables["orders"].select(*prepare.ORDER_COLUMNS), st.tables["order_products"])


@query
def bucketed_orders_with_lines(st: Stages) -> DataFrame:
    """D1 over tables in buckets by order."""
    return prepare.join_lines(st.bucketed["orders"].select(*prepare.ORDER_COLUMNS), st.bucketed["order_products"])


@query
def lines_with_products(st: Stages) -> DataFrame:
    return prepare.join_products(st.tables["order_products"], st.tables["products"])


@query
def lines_with_departments(st: Stages) -> DataFrame:
    lines = prepare.join_products(st.tables["order_products"], st.tables["products"])
    return prepare.join_departments(lines, st.tables["departments"])


@query
def orphan_counts(st: Stages) -> DataFrame:
    t = st.tables
    return profile.orphan_counts(t["orders"], t["order_products"], t["products"], t["departments"])


def _sampled_master(st: Stages, n: int, unit: str) -> DataFrame:
    t = st.tables
    return prepare.build_master(t["orders"], t["order_products"], t["products"], t["departments"], n, unit=unit)


@query
def sampled_master(st: Stages) -> DataFrame:
    return _sampled_master(st, SAMPLE_ORDERS, "order")


@query
def user_sampled_master(st: Stages) -> DataFrame:
    return _sampled_master(st, SAMPLE_USERS, "user")


def _expanded(st: Stages) -> DataFrame:
    """Lines of both splits, each under its own rules."""
    train, test = (cand.expand(st.lines(s), rules.one_to_one(st.rules(s))) for s in ("train", "test"))
    return train.unionByName(test)


@query
def candidate_expansion(st: Stages) -> DataFrame:
    return _expanded(st).groupBy("product_name", "consequent").agg(
        F.count("*").alias("n"), F.sum("add_to_cart_order").cast("bigint").alias("sum_positions")
    )


@query
def outcome_lookup(st: Stages) -> DataFrame:
    train, test = (cand.expand_and_look_up(st.lines(s), rules.one_to_one(st.rules(s))) for s in ("train", "test"))
    return train.unionByName(test).select("order_id", "product_name", "consequent", "actual_add_to_cart_order")


@query
def bucketed_outcome_lookup(st: Stages) -> DataFrame:
    """D4 and D5 over lines in buckets by order."""
    master = st.bucketed["master"]
    train, test = (cand.look_up_in_buckets(master.filter(F.col("split") == s), rules.one_to_one(st.rules(s))) for s in ("train", "test"))
    return train.unionByName(test).select("order_id", "product_name", "consequent", "actual_add_to_cart_order")


@query
def recommended_attributes(st: Stages) -> DataFrame:
    catalogue = prepare.product_catalogue(st.master)
    return cand.add_attributes(rules.one_to_one(rules.generate_rules(st.master)), catalogue).select(
        "antecedent", "consequent", *cand.RECOMMENDED_NAMES.values()
    )


@query
def candidates_test(st: Stages) -> DataFrame:
    return st.candidates("test")


@query
def candidates_train(st: Stages) -> DataFrame:
    return st.candidates("train")


@query
def candidates_test_train_rules(st: Stages) -> DataFrame:
    return st.make_candidates("test", "train")


# Baskets, itemsets and rules


@query
def basket_items(st: Stages) -> DataFrame:
    return itemsets.baskets(st.master).select("order_id", F.array_join("items", ",").alias("items"))


@query
def bucketed_basket_items(st: Stages) -> DataFrame:
    """E1 over lines in buckets by order."""
    return itemsets.baskets(st.bucketed["master"]).select("order_id", F.array_join("items", ",").alias("items"))


@query
def encoded_items(st: Stages) -> DataFrame:
    return itemsets.encode_long(st.master)


@query
def encoded_vectors(st: Stages) -> DataFrame:
    vocabulary, vectors = itemsets.encode_vectors(st.master)
    counts = vectors.select(F.explode("presence").alias("code")).groupBy("code").agg(F.count("*").alias("n_orders"))
    return counts.join(vocabulary, "code").select("item", "n_orders")


@query
def sparse_vectors(st: Stages) -> DataFrame:
    """E2 as vectors of Spark ML: orders per position, by the item it stands for, and the vectors' width."""
    vocabulary, vectors = itemsets.encode_sparse(st.master)
    held = vectors.select(F.unwrap_udt("presence").alias("v")).select("v.size", F.explode("v.indices").alias("code"))
    counts = held.groupBy("code", "size").agg(F.count("*").alias("n_orders"))
    return counts.join(vocabulary, "code").select("item", "n_orders", F.col("size").cast("bigint").alias("width"))


@query
def item_support(st: Stages) -> DataFrame:
    return itemsets.item_support(st.master)


@query
def frequent_pairs(st: Stages) -> DataFrame:
    return itemsets.frequent_pairs(itemsets.frequent_baskets(st.master))


def _type_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return itemsets.frequent_itemsets(itemsets.frequent_baskets(star_type_lines(configure(spark), folder)))


def frequent_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return _type_itemsets(spark, folder).withColumn("items", F.array_join("items", ","))


def itemset_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return itemsets.size_histogram(_type_itemsets(spark, folder))


def general_rules(spark: SparkSession, folder: str) -> DataFrame:
    lines = star_type_lines(configure(spark), folder)
    return _flat(rules.generate_rules(lines, pairs_only=False))


def _general_rules(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cart lines of part types, and rules between itemsets of any size, each standing for its smallest names.

    An order holds a type on one line. Many rules stand for the same names, so queries cut the rules
    to those that their result can hold before lines are expanded by them.
    """
    lines = Scratch.of(configure(spark)).keep(star_type_carts(spark, folder), "type-carts")
    mined = rules.one_to_one(rules.generate_rules(lines, pairs_only=False), collapse="min")
    ids = lines.select(F.col("product_name").alias("consequent"), F.col("product_id").alias("recommended_product_id")).distinct()
    return lines, mined.join(ids, "consequent")


def _general_candidates(lines: DataFrame, some: DataFrame) -> DataFrame:
    """Labelled candidates of the lines under the rules."""
    kept = Scratch.of(lines.sparkSession).keep(some, "general-rules")
    return cand.label(cand.expand_and_look_up(lines, kept)).withColumnsRenamed(cand.TRIGGER_NAMES)


def candidates_general_rules(spark: SparkSession, folder: str) -> DataFrame:
    lines, mined = _general_rules(spark, folder)
    alike = mined.groupBy("antecedent", "consequent", "recommended_product_id").agg(
        F.count("*").alias("n_alike"), F.max("lift").alias("lift")
    )
    return _general_candidates(lines, alike).groupBy("trigger_product_id", "recommended_product_id").agg(
        F.sum("n_alike").alias("n"), F.sum(F.col("label") * F.col("n_alike")).alias("positives"), _r9(F.max("lift")).alias("max_lift")
    )


def ranked_general_rules(spark: SparkSession, folder: str) -> DataFrame:
    lines, mined = _general_rules(spark, folder)
    # A group is one line, so its candidates rank as the rules of the line's product do.
    top = _general_candidates(lines, ranking.top_k(mined, 5, "confidence", ["antecedent"]))
    return top.select(*ranking.GROUP, "rank", "recommended_product_id", _r9("confidence").alias("confidence"), "label")


def first_general_rules(spark: SparkSession, folder: str) -> DataFrame:
    lines, mined = _general_rules(spark, folder)
    first = ranking.first_recommendations(_general_candidates(lines, ranking.strongest_rules(mined)))
    return first.withColumn("confidence", _r9("confidence"))


GENERAL = (frequent_itemsets, itemset_sizes, general_rules, candidates_general_rules, ranked_general_rules, first_general_rules)
QUERIES |= {f.__name__: f for f in GENERAL}


@query
def pair_rules(st: Stages) -> DataFrame:
    return _flat(st.rules("train"))


@query
def pair_rules_test(st: Stages) -> DataFrame:
    return _flat(st.rules("test"))


@query
def mined_rules(st: Stages) -> DataFrame:
    return _flat(rules.generate_rules(st.master))


# Profiling


@query
def eval_set_counts(st: Stages) -> DataFrame:
    return profile.value_counts(st.tables["orders"], "eval_set")


@query
def user_counts(st: Stages) -> DataFrame:
    return profile.value_counts(st.tables["orders"], "user_id")


@query
def label_balance(st: Stages) -> DataFrame:
    return _rounded(profile.value_shares(st.all_candidates, "label"), "label")


@query
def distinct_counts(st: Stages) -> DataFrame:
    return _labelled(
        {
            "orders": profile.distinct_counts(st.tables["orders"], ["order_id"]),
            "order_products": profile.distinct_counts(st.tables["order_products"], ["product_id"]),
            "master": profile.distinct_counts(st.master, ["order_id", "product_id", "product_name"]),
        }
    )


@query
def sketched_distinct_counts(st: Stages) -> DataFrame:
    """Whether counts from sketches of each day, merged over all days, come within 3 % of the exact ones."""
    columns = ["order_id", "product_id", "product_name"]
    days = Scratch.of(st.spark).keep(profile.distinct_sketches(st.master, ["order_dow"], columns), "sketches")
    about = profile.sketched_counts(days, columns).unpivot([], columns, "column_name", "n_sketched")
    exact = profile.distinct_counts(st.master, columns)
    close = F.abs(F.col("n_sketched") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")
    return exact.join(about, "column_name").select("column_name", "n_distinct", close.alias("is_close"))


@query
def null_counts(st: Stages) -> DataFrame:
    return _labelled({name: profile.null_counts(df) for name, df in st.tables.items()})


@query
def order_candidate_stats(st: Stages) -> DataFrame:
    return cand.order_stats(st.all_candidates)


@query
def order_stats_summary(st: Stages) -> DataFrame:
    stats = cand.order_stats(st.all_candidates)
    return _rounded(profile.describe(stats, ["candidates", "positives"]), "column_name")


@query
def orders_with_positive(st: Stages) -> DataFrame:
    return _rounded(cand.share_with_positive(cand.order_stats(st.all_candidates)))


@query
def product_catalogue(st: Stages) -> DataFrame:
    return prepare.product_catalogue(st.master)


@query
def value_ranges(st: Stages) -> DataFrame:
    return profile.out_of_range(st.tables["orders"], RANGES)


# Ranking


@query
def top_recommendations(st: Stages) -> DataFrame:
    return ranking.top_k(st.candidates("test"), 5, "confidence").select(
        *ranking.GROUP, "recommended_product_id", "label", "rank"
    )


@query
def first_recommendations(st: Stages) -> DataFrame:
    return ranking.first_recommendations(st.candidates("test"))


@query
def ranked_recommendations(st: Stages) -> DataFrame:
    return ranking.ranked_recommendations(st.candidates("test"), 10).select(
        "order_id", "recommended_product_id", "confidence", "label", "rank"
    )


@query
def sorted_orders(st: Stages) -> DataFrame:
    return st.tables["orders"].orderBy("user_id", "order_number", "order_id")


@query
def sorted_expansion(st: Stages) -> DataFrame:
    return _expanded(st).orderBy("order_id", "add_to_cart_order", "consequent").select(
        "order_id", "add_to_cart_order", "product_name", "consequent", "lift"
    )


REQUEST = ["trigger_product_id", "order_hour_of_day", "order_dow", "cart_size"]


def requests(st: Stages) -> DataFrame:
    """Every product, hour, day and cart position that occurs in the test lines."""
    named = {"product_id": "trigger_product_id", "add_to_cart_order": "cart_size"}
    return st.lines("test").withColumnsRenamed(named).select(*REQUEST).distinct()


@query
def best_bundles(st: Stages) -> DataFrame:
    catalogue = Scratch.of(st.spark).keep(prepare.product_catalogue(st.lines("train")), "catalogue")
    return ranking.best_bundle(requests(st), rules.one_to_one(st.rules("train")), catalogue, REQUEST)


@query
def streamed_best_bundles(st: Stages) -> DataFrame:
    """F5 with the requests read as a stream of files."""
    asked = st.scratch.path("request-files")
    requests(st).repartition(4).write.parquet(asked)
    catalogue = st.scratch.keep(prepare.product_catalogue(st.lines("train")), "catalogue")
    source = st.spark.read.parquet(asked).schema
    stream = st.spark.readStream.schema(source).option("maxFilesPerTrigger", 2).parquet(asked)
    target = st.scratch.path("answers")
    pairs = rules.one_to_one(st.rules("train"))
    ranking.best_bundles_on_stream(stream, pairs, catalogue, REQUEST, target, st.scratch.path("stream-state")).awaitTermination()
    return st.spark.read.parquet(target).drop("batch")


# Features and model


@query
def feature_frame(st: Stages) -> DataFrame:
    return model.features(st.candidates("test"))


def _indexed(st: Stages) -> DataFrame:
    return model.fit_indexer(st.candidates("train")).transform(model.features(st.candidates("test")))


@query
def category_codes(st: Stages) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.col(f"{c}_index").alias("code"))
        for c in model.CATEGORICAL
    ]
    coded = _indexed(st).select(F.inline(F.array(*pairs)))
    return coded.groupBy("column_name", "value", "code").agg(F.count("*").alias("n"))


@query
def assembled_vectors(st: Stages) -> DataFrame:
    vectors = model.assembler().transform(_indexed(st)).select(vector_to_array("features").alias("v"))
    sums = vectors.select(F.posexplode("v").alias("position", "value")).groupBy("position")
    return sums.agg(F.round(F.sum("value"), 4).alias("total"))


@query
def model_scores(st: Stages) -> DataFrame:
    return st.scored.select("order_id", "trigger_product_id", "recommended_product_id", "label", "score")


@query
def model_decisions(st: Stages) -> DataFrame:
    return model.decide(st.scored).groupBy("label", "prediction").agg(F.count("*").alias("n"))


@query
def decisions(st: Stages) -> DataFrame:
    decided = model.decide(st.candidates("test"), THRESHOLD, "confidence")
    return decided.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def model_bundles(st: Stages) -> DataFrame:
    catalogue = Scratch.of(st.spark).keep(prepare.product_catalogue(st.lines("train")), "catalogue")
    # Context a request does not name: a first order.
    asked = requests(st).withColumns(
        {
            "days_since_prior_order": F.lit(-1.0),
            "order_number": F.lit(1),
            "trigger_reordered": F.lit(0),
        }
    )
    return ranking.best_bundle(asked, rules.one_to_one(st.rules("train")), catalogue, REQUEST, st.ranker)


@query
def model_best_bundles(st: Stages) -> DataFrame:
    return model_bundles(st)


@query
def model_score_counts(st: Stages) -> DataFrame:
    """Per label the rows with a score, and those whose score is a probability."""
    return st.scored.groupBy("label").agg(
        F.count("score").alias("n_scored"), F.count_if(F.col("score").between(0, 1)).alias("n_probabilities")
    )


@query
def model_decision_totals(st: Stages) -> DataFrame:
    """Decisions per label, and those that agree with the score."""
    decided = model.decide(st.scored)
    agrees = (F.col("prediction") == 1) == (F.col("score") >= 0.5)
    return decided.groupBy("label").agg(F.count("prediction").alias("n_decided"), F.count_if(agrees).alias("n_agreeing"))


@query
def model_bundle_checks(st: Stages) -> DataFrame:
    """Per request, whether its bundle is among the trigger's rules; without a rule it has none."""
    pairs = rules.one_to_one(st.rules("train"))
    catalogue = prepare.product_catalogue(st.lines("train"))
    allowed = cand.add_attributes(pairs, catalogue).join(
        catalogue.select(F.col("product_name").alias("antecedent"), F.col("product_id").alias("trigger_product_id")), "antecedent"
    )
    keys = ["trigger_product_id", "recommended_product_id"]
    return model_bundles(st).join(allowed.select(*keys, F.lit(True).alias("allowed")), keys, "left").select(
        *REQUEST, F.coalesce("allowed", F.lit(False)).alias("allowed")
    )


@query
def model_metric_checks(st: Stages) -> DataFrame:
    """The model's metrics against plain recomputations on the same scores: whether they are equal."""
    scored = st.scored
    scored.createOrReplaceTempView("pannier_scored")
    # Mean places of equal scores, from running counts over ranges of scores.
    places = profile.running_counts(scored, "score").select(F.col("v").alias("score"), (F.col("before") + (F.col("n") + 1) / 2).alias("place"))
    folded = scored.groupBy("score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    area = folded.join(places, "score").agg(F.sum(F.col("pos") * F.col("place")).alias("places"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    area = area.select((F.col("places") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * F.col("neg")))
    right = st.spark.sql("SELECT AVG(IF((score >= 0.5) = (label = 1), 1.0D, 0.0D)) FROM pannier_scored")
    first = st.spark.sql("""
        SELECT AVG(label) FROM (SELECT label, ROW_NUMBER() OVER (PARTITION BY order_id, trigger_product_id
            ORDER BY score DESC, recommended_product_id, cart_size) AS n FROM pannier_scored) WHERE n = 1
    """)
    pairs = {
        "roc_auc": (metrics.roc_auc(scored), area),
        "accuracy": (metrics.classification_metrics(scored).select("accuracy"), right),
        "precision_at_1": (metrics.precision_recall_at_k(scored).filter("k = 1").select("precision"), first),
    }
    parts = [
        st.spark.range(1).select(F.lit(name).alias("metric"), (F.abs(a.scalar() - b.scalar()) < 1e-9).alias("equal"))
        for name, (a, b) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# A small ensemble in Spark ML's own words, as a parameter; labels of coded columns stand below it.
SMALL_ENSEMBLE = """
  Tree 0 (weight 1.0):
    If (feature 10 <= 0.2)
     If (feature 1 in {0.0,2.0,3.0,6.0})
      Predict: -0.8
     Else (feature 1 not in {0.0,2.0,3.0,6.0})
      Predict: -0.5
    Else (feature 10 > 0.2)
     If (feature 11 <= 1.05)
      Predict: 0.125
     Else (feature 11 > 1.05)
      Predict: 0.375
  Tree 1 (weight 0.05):
    If (feature 7 <= 3.5)
     Predict: 0.75
    Else (feature 7 > 3.5)
     If (feature 5 <= 2.0)
      Predict: 0.125
     Else (feature 5 > 2.0)
      Predict: -0.375
  Tree 2 (weight 0.05):
    If (feature 0 in {1.0,3.0})
     Predict: -2.0
    Else (feature 0 not in {1.0,3.0})
     Predict: 1.5
"""
SMALL_LABELS = {"order_hour_of_day": ["9", "10", "11", "12", "13", "14"], "order_dow": ["6", "0", "3"]}


@query
def tree_scores(st: Stages) -> DataFrame:
    """Probabilities and decisions of ``SMALL_ENSEMBLE``, compiled into one column, for all test candidates."""
    ensemble = trees.read_ensemble(SMALL_ENSEMBLE, [*model.CATEGORICAL, *model.NUMERIC], SMALL_LABELS)
    decided = model.decide(trees.score_trees(ensemble, st.candidates("test")), 0.4)
    return decided.select(
        "order_id", "trigger_product_id", "recommended_product_id", "cart_size", _r9("score").alias("score"), "prediction"
    )


# Evaluation


@query
def classification_metrics(st: Stages) -> DataFrame:
    return _rounded(metrics.classification_metrics(st.candidates("test"), THRESHOLD, "confidence"))


@query
def roc_auc(st: Stages) -> DataFrame:
    return _rounded(metrics.roc_auc(st.candidates("test"), "confidence"))


@query
def precision_recall_at_k(st: Stages) -> DataFrame:
    return _rounded(metrics.precision_recall_at_k(st.candidates("test"), score="confidence"), "k")


@query
def precision_recall_train_rules(st: Stages) -> DataFrame:
    candidates = st.make_candidates("test", "train")
    return _rounded(metrics.precision_recall_at_k(candidates, score="confidence"), "k")


@query
def rule_scores_by_order(st: Stages) -> DataFrame:
    return _rounded(metrics.rule_scores_by_order(st.candidates("test")), "order_id")


@query
def rule_precision_recall_at_k(st: Stages) -> DataFrame:
    return _rounded(metrics.rule_precision_recall_at_k(st.candidates("test")), "k")


@query
def model_precision_recall_at_k(st: Stages) -> DataFrame:
    return _rounded(metrics.precision_recall_at_k(st.scored), "k")


@query
def model_classification_metrics(st: Stages) -> DataFrame:
    return _rounded(metrics.classification_metrics(st.scored))


@query
def model_roc_auc(st: Stages) -> DataFrame:
    return _rounded(metrics.roc_auc(st.scored))
