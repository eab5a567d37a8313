"""Top-k recommendations under explicit total orders."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pannier.operators.candidates import add_attributes
from pannier.operators.model import score as score_rows
from pannier.sources.scratch import Scratch

GROUP = ["order_id", "trigger_product_id"]


def _strongest(df: DataFrame) -> list[Column]:
    """An order of rules between the same products, the strongest first."""
    return [F.desc(c) for c in ("lift", "confidence", "support") if c in df.columns]


def rank(scored: DataFrame, score: str = "score", group: list[str] = GROUP) -> DataFrame:
    """Number the rows of every group from the best score down as ``rank``.

    Ties go to the smaller product id, then to the earlier cart position; rows of several
    rules between the same products follow by lift, confidence and support.
    """
    ties = [F.col(c) for c in ("recommended_product_id", "cart_size") if c in scored.columns]
    best_first = W.partitionBy(*group).orderBy(F.desc(score), *ties, *_strongest(scored))
    return scored.withColumn("rank", F.row_number().over(best_first))


def top_k(scored: DataFrame, k: int, score: str = "score", group: list[str] = GROUP) -> DataFrame:
    """The ``k`` best rows of every group with their ``rank``.

    Filtering on the rank lets Spark cut every group to ``k`` rows before the shuffle.
    """
    return rank(scored, score, group).filter(F.col("rank") <= k)


def strongest_rules(rules: DataFrame) -> DataFrame:
    """The strongest rule between each two products, the only one ``first_recommendations`` takes of them."""
    order = W.partitionBy("antecedent", "consequent").orderBy(*_strongest(rules))
    return rules.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == 1).drop("nth")


def first_recommendations(candidates: DataFrame) -> DataFrame:
    """An order's earliest candidate for each recommended product.

    Earliest is by cart position, then trigger; of several rules between the same products
    it is the strongest. Filtering on the rank lets Spark cut groups before the shuffle.
    """
    group = ["order_id", "recommended_product_id"]
    order = W.partitionBy(*group).orderBy("cart_size", "trigger_product_id", *_strongest(candidates))
    first = candidates.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == 1)
    return first.select(*group, "cart_size", "trigger_product_id", "confidence", "label")


def ranked_recommendations(candidates: DataFrame, k: int) -> DataFrame:
    """An order's ``k`` most confident different recommendations."""
    return top_k(first_recommendations(candidates), k, "confidence", ["order_id"])


def _best(score: str) -> Column:
    return F.struct(-F.col(score), F.col("recommended_product_id"))


def best_bundle(
    requests: DataFrame,
    rules: DataFrame,
    catalogue: DataFrame,
    keys: list[str],
    model: PipelineModel | None = None,
) -> DataFrame:
    """The single best recommendation for every request, whose ``keys`` name it and may be NULL.

    A request names the product in the cart (``trigger_product_id``), the context and,
    for scoring by a model, the model's other context features. Without a model the
    score is the confidence, so the best rule per product is known before the requests
    are read and they are not expanded at all. Requests no rule applies to keep NULLs.
    """
    scratch = Scratch.of(requests.sparkSession)
    attributed = scratch.keep(
        add_attributes(rules, catalogue).join(
            catalogue.select(F.col("product_name").alias("antecedent"), F.col("product_id").alias("trigger_product_id")),
            "antecedent",
        ),
        "bundles",
    )
    columns = ["recommended_product_id", "recommended_product_name", "support", "confidence", "lift", "score"]
    if model is None:
        scored = attributed.withColumn("score", F.col("confidence"))
        best = scored.groupBy("trigger_product_id").agg(F.min_by(F.struct(*columns), _best("score")).alias("best"))
        return requests.join(best, "trigger_product_id", "left").select(*keys, "best.*")
    # Requests that agree in their keys may differ in other context, so each has a number of its own.
    numbered = scratch.keep(requests.withColumn("request", F.monotonically_increasing_id()), "requests")
    scored = scratch.keep(score_rows(model, numbered.join(attributed, "trigger_product_id")), "scored-bundles")
    order = W.partitionBy("request").orderBy(F.desc("score"), "recommended_product_id", *_strongest(attributed))
    best = scored.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == 1).select("request", *columns)
    return numbered.select("request", *keys).join(best, "request", "left").select(*keys, *columns)


def best_bundles_on_stream(
    requests: DataFrame,
    rules: DataFrame,
    catalogue: DataFrame,
    keys: list[str],
    target: str,
    checkpoint: str,
    model: PipelineModel | None = None,
) -> StreamingQuery:
    """Answer a stream of requests batch by batch with ``best_bundle``, until all that is there is answered.

    Ranking inside a request is no streaming operation, so each micro-batch is answered as a
    table. Its answers replace the folder ``target/batch=<number>``: a batch that a lost driver
    runs again writes its own folder again and no request is answered twice. ``checkpoint`` keeps
    what has been read; a later call with it answers new requests only.
    """

    def answer(batch: DataFrame, number: int) -> None:
        best_bundle(batch, rules, catalogue, keys, model).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
