"""Time the headline stages and queries; prints one JSON line.

``BENCH_SF_DIR`` names the source folder and ``BENCH_CPUS`` the local cores. Every
stage starts from the written output of the one before and is run to its end, so the
times add up to the whole way from the source files to the evaluated ranker.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from pannier.operators import metrics, model
from pannier.operators.prepare import product_catalogue
from pannier.operators.ranking import best_bundle, ranked_recommendations, top_k
from pannier.operators.rules import generate_rules, one_to_one
from pannier.plans.catalog import REQUEST, requests
from pannier.plans.stages import Stages
from pannier.session import local_session
from pannier.sources.scratch import Scratch
from pannier.sources.star import star_tables, star_type_lines



def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="pannier-bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # the session itself is not timed
    times: dict[str, float] = {}

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(name: str, work) -> object:
        start = time.perf_counter()
        result = work()
        if isinstance(result, DataFrame) and name not in ("master_orders",):
            run(result)
        times[name] = round(time.perf_counter() - start, 3)
        return result

    st = Stages(spark, lambda: star_tables(spark, folder))
    timed("clean_tables", lambda: dict(st.tables))
    timed("master_orders", lambda: st.master)
    timed("pair_rules", lambda: [st.rules("train"), st.rules("test")])
    timed("general_rules", lambda: generate_rules(star_type_lines(spark, folder), pairs_only=False))
    timed("candidates", lambda: [st.candidates("train"), st.candidates("test")])
    test = st.candidates("test")
    timed("top_k", lambda: top_k(test, 5, "confidence"))
    timed("ranked_recommendations", lambda: ranked_recommendations(test, 10))
    timed("precision_recall_at_k", lambda: metrics.precision_recall_at_k(test, score="confidence"))
    timed("rule_precision_recall_at_k", lambda: metrics.rule_precision_recall_at_k(test))
    timed("classification_metrics", lambda: metrics.classification_metrics(test, score="confidence"))
    timed("roc_auc", lambda: metrics.roc_auc(test, "confidence"))
    timed(
        "best_bundle",
        lambda: best_bundle(
            requests(st),
            one_to_one(st.rules("train")),
            st.scratch.keep(product_catalogue(st.lines("train")), "catalogue"),
            REQUEST,
        ),
    )
    timed("fit_ranker_500_rounds", lambda: st.ranker)
    timed("score", lambda: model.score(st.ranker, test))
    print(
        json.dumps(
            {
                "metric": "total time from source files to evaluated ranker",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )
    Scratch.of(spark).drop()
    spark.stop()


if __name__ == "__main__":
    main()
