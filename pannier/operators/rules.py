"""Association rules over frequent itemsets: support, confidence and lift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.operators.itemsets import (
    FrequentBaskets,
    frequent_baskets,
    frequent_items,
    frequent_itemsets,
    frequent_pairs,
)
from pannier.sources.schemas import RULES
from pannier.sources.scratch import Scratch


def filter_confidence(rules: DataFrame, min_confidence: float) -> DataFrame:
    """Rules at or above a confidence."""
    return rules.filter(F.col("confidence") >= min_confidence)


def filter_lift(rules: DataFrame, min_lift: float) -> DataFrame:
    """Rules at or above a lift."""
    return rules.filter(F.col("lift") >= min_lift)


def _with_metrics(rules: DataFrame) -> DataFrame:
    confidence = F.col("support") / F.col("antecedent_support")
    return rules.withColumn("confidence", confidence).withColumn(
        "lift", F.col("confidence") / F.col("consequent_support")
    )


def pair_rules(found: FrequentBaskets, min_confidence: float = 0.15, min_lift: float | None = None) -> DataFrame:
    """Rules A -> B in both directions of every frequent pair."""
    pairs, singles = frequent_pairs(found), frequent_items(found)
    ends = F.array(F.array("item_a", "item_b"), F.array("item_b", "item_a"))
    directed = pairs.select("support", F.explode(ends).alias("ends")).select(
        F.col("ends")[0].alias("antecedent"), F.col("ends")[1].alias("consequent"), "support"
    )
    antecedents = singles.select(F.col("item").alias("antecedent"), F.col("support").alias("antecedent_support"))
    consequents = singles.select(F.col("item").alias("consequent"), F.col("support").alias("consequent_support"))
    rules = _with_metrics(directed.join(antecedents, "antecedent").join(consequents, "consequent"))
    rules = filter_confidence(
        rules.select(
            F.array("antecedent").alias("antecedents"), F.array("consequent").alias("consequents"), *RULES.names[2:]
        ),
        min_confidence,
    )
    return rules if min_lift is None else filter_lift(rules, min_lift)


def association_rules(
    itemsets: DataFrame, min_confidence: float = 0.15, min_lift: float | None = None
) -> DataFrame:
    """Rules between the sides of frequent itemsets, with consequents grown item by item.

    Moving an item from the antecedent to the consequent can only raise the antecedent's support
    and so lower the confidence. A consequent that fails therefore fails with any further item,
    and only consequents that reached the minimum are grown: two of an itemset that agree but for
    their last item give one of an item more. So an itemset costs as many lookups as it has rules
    and failed extensions of them, not all splits of its items. Every side is itself frequent,
    and its support is looked up among the same itemsets.
    """
    scratch = Scratch.of(itemsets.sparkSession)
    sets = scratch.keep(itemsets.select(F.monotonically_increasing_id().alias("id"), "items", "support"), "rule-itemsets")
    supports = sets.select(F.col("items").alias("side"), F.col("support").alias("side_support"))

    def looked_up(rules: DataFrame, name: str) -> DataFrame:
        renamed = supports.withColumnsRenamed({"side": f"{name}s", "side_support": f"{name}_support"})
        return rules.join(renamed, f"{name}s")

    single = F.explode(F.transform("items", lambda item: F.array(item)))
    level = sets.filter(F.size("items") > 1).select("id", "items", "support", single.alias("consequents"))
    levels: list[DataFrame] = []
    while True:
        split = level.withColumn("antecedents", F.array_except("items", "consequents"))
        kept = looked_up(split, "antecedent").filter(F.col("support") / F.col("antecedent_support") >= min_confidence)
        kept = scratch.keep(kept, f"rules-{len(levels) + 1}")
        if levels and kept.isEmpty():
            break
        levels.append(kept)
        size = len(levels)
        head, last = F.slice("consequents", 1, size - 1) if size > 1 else F.array().cast("array<string>"), F.element_at("consequents", -1)
        grown = kept.filter(F.size("items") > size + 1).withColumns({"head": head, "last": last})
        others = grown.select("id", "head", F.col("last").alias("other"))
        level = grown.join(others, ["id", "head"]).filter(F.col("other") > F.col("last"))
        level = level.select("id", "items", "support", F.concat("consequents", F.array("other")).alias("consequents"))
    rules = reduce(DataFrame.unionByName, levels)
    rules = _with_metrics(looked_up(rules, "consequent")).select(*RULES.names)
    return rules if min_lift is None else filter_lift(rules, min_lift)


def generate_rules(
    lines: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.15,
    min_lift: float | None = None,
    pairs_only: bool = True,
) -> DataFrame:
    """Mine cart lines into rules, between single items or between itemsets of any size."""
    found = frequent_baskets(lines, min_support)
    if pairs_only:
        return pair_rules(found, min_confidence, min_lift)
    return association_rules(frequent_itemsets(found), min_confidence, min_lift)


def one_to_one(rules: DataFrame, collapse: str | None = None) -> DataFrame:
    """Rules with a plain ``antecedent`` and ``consequent`` name.

    Rules with several items on a side are left out, or with ``collapse="min"`` stand
    for the smallest name on each side.
    """
    if collapse not in (None, "min"):
        raise ValueError(f"unknown collapse {collapse!r}")
    if collapse is None:
        rules = rules.filter((F.size("antecedents") == 1) & (F.size("consequents") == 1))
    return rules.select(
        F.array_min("antecedents").alias("antecedent"),
        F.array_min("consequents").alias("consequent"),
        "support",
        "confidence",
        "lift",
    )
