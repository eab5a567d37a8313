"""Candidate recommendations per cart line, labelled by what the order went on to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.functions.expressions import bought_later
from pannier.functions.layout import spread
from pannier.operators.prepare import assert_unique, product_catalogue
from pannier.sources.schemas import CANDIDATES
from pannier.sources.scratch import Scratch

# Master columns that a candidate takes over under another name.
TRIGGER_NAMES = {
    "add_to_cart_order": "cart_size",
    "product_id": "trigger_product_id",
    "product_name": "trigger_product_name",
    "reordered": "trigger_reordered",
}
# Catalogue columns as attributes of the recommended product.
RECOMMENDED_NAMES = {
    "product_id": "recommended_product_id",
    "product_name": "recommended_product_name",
    "department_id": "recommended_department_id",
    "department": "recommended_department_name",
}

# Candidates that one part of an order makes, on average.
PART_ROWS = 100_000


def expand(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """Every line once per rule whose antecedent is the line's product."""
    return lines.join(rules, lines.product_name == rules.antecedent).drop("antecedent")


def purchases(lines: DataFrame) -> DataFrame:
    """What each order took and where in the cart, named for the lookup."""
    return lines.select(
        "order_id",
        F.col("product_name").alias("consequent"),
        F.col("add_to_cart_order").alias("actual_add_to_cart_order"),
    )


def look_up_outcome(expanded: DataFrame, taken: DataFrame, within: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """Add the cart position at which the order took the recommended product, if it did."""
    return expanded.join(taken, [*within, "consequent"], "left")


def _expand_in_carts(triggers: DataFrame, rules: DataFrame, taken: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """``look_up_outcome(expand(triggers, rules), taken, within)``, with the lookup made ready before lines multiply.

    Each cart's last positions, a map by product, are joined to its lines. The far more candidates
    then find their outcome in that map and are neither sorted nor moved. A map holds products of
    some rule only, see ``itemsets`` for how many they can be.
    """
    last = taken.groupBy(*within, "consequent").agg(F.max("actual_add_to_cart_order").alias("last"))
    bought = last.groupBy(*within).agg(F.map_from_entries(F.collect_list(F.struct("consequent", "last"))).alias("bought"))
    found = expand(triggers.join(bought, [*within], "left"), rules)
    return found.withColumn("actual_add_to_cart_order", F.try_element_at("bought", F.col("consequent"))).drop("bought")


def expand_and_look_up(lines: DataFrame, rules: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``look_up_outcome(expand(lines, rules), purchases(lines))``, laid out by order first.

    Lines are shuffled once, before they multiply; an order's lines meet the order's
    products where they are, and the candidates made of them look their outcome up there. Only products of some rule are
    moved. An order is as many parts as its measured candidates fill, nearly always one;
    each part takes some of the trigger lines and a copy of the products bought. A product
    that an order holds several times counts once, with its last position.
    """
    scratch = Scratch.of(lines.sparkSession)
    fan_out = scratch.keep(rules.groupBy(F.col("antecedent").alias("product_name")).agg(F.count("*").alias("n_rules")), "fan-out")
    triggers = lines.join(fan_out, "product_name")
    taken = purchases(lines).join(rules.select("consequent"), "consequent", "left_semi")
    sizes = triggers.groupBy("order_id").agg(F.ceil(F.sum("n_rules") / part_rows).cast("int").alias("parts"))
    parts = scratch.keep(sizes.filter(F.col("parts") > 1), "orders-in-parts")
    n_parts = F.coalesce("parts", F.lit(1))
    one = F.pmod(F.xxhash64("product_id", "add_to_cart_order"), n_parts).cast("int")
    triggers = triggers.drop("n_rules").join(parts, "order_id", "left").withColumn("part", one).drop("parts")
    each = F.explode(F.sequence(F.lit(0), n_parts - 1))
    taken = taken.join(parts, "order_id", "left").withColumn("part", each).drop("parts")
    within = ("order_id", "part")
    return _expand_in_carts(spread(triggers, *within), rules, spread(taken, *within), within).drop("part")


def look_up_in_buckets(lines: DataFrame, rules: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``expand_and_look_up`` of lines that lie in buckets by order, without a shuffle of lines or candidates.

    An order's lines multiply and meet its purchases in its bucket. Orders whose candidates fill
    more than a part would make their bucket too long; they, and no others, are cut into parts
    by ``expand_and_look_up``.
    """
    scratch = Scratch.of(lines.sparkSession)
    fan_out = scratch.keep(rules.groupBy(F.col("antecedent").alias("product_name")).agg(F.count("*").alias("n_rules")), "fan-out")
    sizes = lines.join(fan_out, "product_name").groupBy("order_id").agg(F.sum("n_rules").alias("n"))
    large = scratch.keep(sizes.filter(F.col("n") > part_rows).select("order_id"), "large-orders")
    small = lines.join(large, "order_id", "left_anti")
    taken = purchases(small).join(rules.select("consequent"), "consequent", "left_semi")
    found = _expand_in_carts(small, rules, taken, ("order_id",))
    return found.unionByName(expand_and_look_up(lines.join(large, "order_id", "left_semi"), rules, part_rows))


def label(with_outcome: DataFrame) -> DataFrame:
    """1 where the recommended product was put into the cart after the trigger."""
    return with_outcome.withColumn("label", bought_later("actual_add_to_cart_order", "add_to_cart_order"))


def add_attributes(rules: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rules with the recommended product's id and department; a name must be one product's."""
    assert_unique(catalogue, "product_name")
    attributes = catalogue.withColumnsRenamed(RECOMMENDED_NAMES)
    return rules.join(attributes, rules.consequent == attributes.recommended_product_name, "left")


def build_candidates(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """Labelled candidates for ``lines`` under one-to-one ``rules``.

    The product attributes are joined to the rules rather than to the far larger
    candidates.
    """
    scratch = Scratch.of(lines.sparkSession)
    catalogue = scratch.keep(product_catalogue(lines), "catalogue")
    attributed = scratch.keep(add_attributes(rules, catalogue), "rules")
    return (
        label(expand_and_look_up(lines, attributed))
        .withColumnsRenamed(TRIGGER_NAMES)
        .select(*CANDIDATES.names)
    )


def order_stats(candidates: DataFrame) -> DataFrame:
    """Candidates and positives per order."""
    return candidates.groupBy("order_id").agg(
        F.count("label").alias("candidates"), F.sum("label").cast("bigint").alias("positives")
    )


def share_with_positive(stats: DataFrame) -> DataFrame:
    """Share of the orders that have at least one positive candidate."""
    return stats.agg(F.avg((F.col("positives") > 0).cast("double")).alias("share"))
