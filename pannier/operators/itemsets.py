"""Baskets, their encodings and the frequent itemsets in them.

Only items that reach the minimum support are ever shuffled. Supports sum to the mean
basket size, so there are at most (mean lines per order / minimum support) such items,
and that also bounds how many of them one order can hold, however many lines it has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.fpm import FPGrowth
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pannier.functions.layout import spread
from pannier.sources.scratch import Scratch

# First items of a basket that one task pairs with the others.
WIDE = 1000


def baskets(lines: DataFrame) -> DataFrame:
    """The different product names of every order, sorted.

    Collects every name; the mining below collects frequent items only.
    """
    return lines.groupBy("order_id").agg(F.array_sort(F.collect_set("product_name")).alias("items"))


def encode_long(lines: DataFrame) -> DataFrame:
    """Presence of an item in an order as one row, the sparse form of a boolean matrix."""
    return lines.select("order_id", "product_name").distinct()


def encode_vectors(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Presence of items as sparse 0/1 vectors: the vocabulary, and each order's sorted codes.

    The vocabulary holds every item, as (code, item), in a table of its own; neither it nor
    the vectors pass through the driver, and no size bounds it.
    """
    found = encode_long(lines)
    vocabulary = Scratch.of(lines.sparkSession).keep(
        found.select(F.col("product_name").alias("item")).distinct().select(F.monotonically_increasing_id().alias("code"), "item"),
        "vocabulary",
    )
    coded = found.join(vocabulary, found.product_name.eqNullSafe(vocabulary.item))
    return vocabulary, coded.groupBy("order_id").agg(F.sort_array(F.collect_list("code")).alias("presence"))


def dense_codes(values: DataFrame, code: str = "code") -> DataFrame:
    """Rows of ``values`` numbered from 0 without a gap, in no order, and never sorted or in one task.

    The table is written with numbers that have gaps between parts; the sums of the sizes of the
    parts before, a row each, close them.
    """
    scratch = Scratch.of(values.sparkSession)
    numbered = scratch.keep(values.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = numbered.withColumn("_part", part).join(starts, "_part")
    return joined.withColumn(code, F.col("_start") + place).drop("_id", "_part", "_start")


def encode_sparse(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Presence of items as Spark ML's sparse vectors: the vocabulary, and each order's vector of ones.

    As wide as there are different names, NULL included; an order's positions are the codes of its
    names. The vocabulary, (code, item), is a table like any other, so it is not bounded by
    the driver's memory, only by the 2**31 positions a vector can have. Vectors are written in
    the layout ML's type has in Parquet and read as that type; no Python sees them.
    """
    spark, scratch = lines.sparkSession, Scratch.of(lines.sparkSession)
    found = encode_long(lines)
    items = found.select(F.col("product_name").alias("item")).distinct()
    vocabulary = scratch.keep(dense_codes(items), "vocabulary")
    width = vocabulary.count()
    if width >= 1 << 31:
        raise ValueError(f"{width} different items are more than a vector has positions")
    codes = F.sort_array(F.collect_list(F.col("code").cast("int")))
    held = found.join(vocabulary, found.product_name.eqNullSafe(vocabulary.item)).groupBy("order_id").agg(codes.alias("codes"))
    # The fields of ML's vector type; type 0 is sparse.
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(width).alias("size"),
        F.col("codes").alias("indices"),
        F.transform("codes", lambda _: F.lit(1.0)).alias("values"),
    )
    path = scratch.path("sparse-vectors")
    held.select("order_id", vector.alias("presence")).write.parquet(path)
    return vocabulary, spark.read.schema(StructType([lines.schema["order_id"], StructField("presence", VectorUDT())])).parquet(path)


def item_support(lines: DataFrame) -> DataFrame:
    """Orders holding each item, and their share of all orders."""
    n_orders = lines.agg(F.count_distinct("order_id").alias("n")).scalar()
    return (
        encode_long(lines)
        .groupBy(F.col("product_name").alias("item"))
        .agg(F.count("*").alias("freq"))
        .withColumn("support", F.col("freq").cast("double") / n_orders.cast("double"))
    )


@dataclass(frozen=True)
class FrequentBaskets:
    """Baskets cut down to the items that can be frequent.

    ``items`` maps a code to a product name and ``per_order`` holds each order's sorted
    codes.
    """

    n_orders: int
    min_support: float
    items: DataFrame
    per_order: DataFrame

    @cached_property
    def weighted(self) -> DataFrame:
        """Each different basket once, with the number of orders that hold just it."""
        folded = self.per_order.groupBy("codes").agg(F.count("*").alias("orders"))
        return Scratch.of(folded.sparkSession).keep(folded, "baskets")

    def supported(self, counted: DataFrame) -> DataFrame:
        """Add ``support`` and keep the rows that reach the minimum."""
        share = F.col("freq").cast("double") / F.lit(float(self.n_orders))
        return counted.withColumn("support", share).filter(F.col("support") >= self.min_support)


def frequent_baskets(lines: DataFrame, min_support: float = 0.01) -> FrequentBaskets:
    """Prune items that cannot be frequent and collect the others per order.

    An item's lines bound the orders it is in from above, so counting lines, which
    combines before the shuffle, is enough to drop items that cannot be frequent.
    """
    scratch = Scratch.of(lines.sparkSession)
    n_orders = lines.agg(F.count_distinct("order_id").alias("n")).first()["n"]
    items = scratch.keep(
        lines.groupBy("product_name")
        .agg(F.count("*").alias("n_lines"))
        .filter(F.col("n_lines").cast("double") / F.lit(float(max(n_orders, 1))) >= min_support)
        .select(F.monotonically_increasing_id().alias("code"), "product_name"),
        "items",
    )
    per_order = (
        lines.select("order_id", "product_name")
        .join(items, "product_name")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_set("code")).alias("codes"))
    )
    return FrequentBaskets(n_orders, min_support, items, per_order)


def frequent_items(found: FrequentBaskets) -> DataFrame:
    """Single items at or above the minimum support."""
    counted = (
        found.weighted.select(F.explode("codes").alias("code"), "orders")
        .groupBy("code")
        .agg(F.sum("orders").alias("freq"))
    )
    return found.supported(counted.join(found.items, "code").select(F.col("product_name").alias("item"), "freq"))


def frequent_pairs(found: FrequentBaskets) -> DataFrame:
    """Unordered item pairs at or above the minimum support, ``item_a < item_b``.

    Each different basket is expanded once, whatever the number of orders that share
    it, and its pairs are summed within the task before the sums are shuffled. The
    folded baskets are small on disk but grow when expanded, so they are spread first;
    a basket of more than ``WIDE`` items is cut into parts that each take up to ``WIDE``
    of its items as first ones.
    """
    last_part = F.floor((F.size("codes") - 1) / WIDE).cast("int")
    parts = found.weighted.filter(F.size("codes") > 1).withColumn(
        "part", F.explode(F.sequence(F.lit(0), last_part))
    )
    firsts = spread(parts, "codes", "part").select(
        "orders", "codes", "part", F.posexplode(F.slice("codes", F.col("part") * WIDE + 1, WIDE)).alias("at", "a")
    )
    at = F.col("part") * WIDE + F.col("at")
    rest = F.slice("codes", at + 2, F.size("codes") - at - 1)
    counted = (
        firsts.select("orders", "a", F.explode(rest).alias("b"))
        .groupBy("a", "b")
        .agg(F.sum("orders").alias("freq"))
    )
    names = found.items
    return (
        found.supported(counted)
        .join(names.select(F.col("code").alias("a"), F.col("product_name").alias("name_a")), "a")
        .join(names.select(F.col("code").alias("b"), F.col("product_name").alias("name_b")), "b")
        .select(
            F.least("name_a", "name_b").alias("item_a"),
            F.greatest("name_a", "name_b").alias("item_b"),
            "freq",
            "support",
        )
    )


def frequent_itemsets(found: FrequentBaskets) -> DataFrame:
    """Itemsets of every size at or above the minimum support, with sorted item names."""
    scratch = Scratch.of(found.per_order.sparkSession)
    order_codes = scratch.keep(found.per_order.select("codes"), "order-codes")
    # FP-growth rounds its own threshold; half an order less, then the exact filter.
    threshold = max(found.min_support * found.n_orders - 0.5, 0.0) / max(order_codes.count(), 1)
    # Trees of conditional baskets are dealt out as widely as any shuffle; by default the input's few files decide.
    parts = int(found.per_order.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mined = FPGrowth(itemsCol="codes", minSupport=min(threshold, 1.0), numPartitions=parts).fit(order_codes)
    sets = scratch.keep(
        mined.freqItemsets.select(F.monotonically_increasing_id().alias("id"), F.col("items").alias("codes"), "freq"),
        "itemsets",
    )
    named = (
        sets.select("id", "freq", F.explode("codes").alias("code"))
        .join(found.items, "code")
        .groupBy("id", "freq")
        .agg(F.array_sort(F.collect_list("product_name")).alias("items"))
    )
    return found.supported(named).select("items", F.size("items").alias("size"), "freq", "support")


def size_histogram(itemsets: DataFrame) -> DataFrame:
    """Number of itemsets per size."""
    return itemsets.groupBy("size").agg(F.count("*").alias("n"))
