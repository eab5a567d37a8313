"""The stages from input tables to labelled candidates, each written once and then scanned."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pannier.operators.candidates import build_candidates
from pannier.operators.model import features, fit_ranker, score
from pannier.operators.prepare import build_master, split_column
from pannier.operators.profile import Checks
from pannier.operators.rules import generate_rules, one_to_one
from pannier.sources.scratch import Scratch
from pannier.sources.tables import build_clean_tables, write_bucketed, write_table

# Values that the clean tables should hold, and columns that tell their rows apart.
RANGES = {
    "order_dow": (0, 6),
    "order_hour_of_day": (0, 23),
    "order_number": (1, None),
    "days_since_prior_order": (0, 30),
}
UNIQUE = ("product_name", "department")


class Stages:
    """Stage outputs over one set of input tables, of all prior orders or ``n`` orders or users.

    The master table is partitioned by split, so a scan of one split prunes the other's
    files; rules and candidates are a table per split.
    """

    def __init__(
        self,
        spark: SparkSession,
        load: Callable[[], dict[str, DataFrame]],
        min_support: float = 0.01,
        min_confidence: float = 0.15,
        seed: int = 42,
        rounds: int = 500,
        n: int | None = None,
        unit: str = "order",
    ):
        self.spark = spark
        self.scratch = Scratch.of(spark)
        self._load = load
        self.min_support = min_support
        self.min_confidence = min_confidence
        self.seed = seed
        self.rounds = rounds
        self.n = n
        self.unit = unit
        self._kept: dict[str, DataFrame] = {}

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The clean relational tables, checked by the jobs that write them."""
        return build_clean_tables(self._load(), self.clean_folder, self._checks.watch)

    @cached_property
    def clean_folder(self) -> str:
        """Where the clean tables are written."""
        return self.scratch.path("clean")

    @cached_property
    def _checks(self) -> Checks:
        return Checks(RANGES, UNIQUE)

    @property
    def checks(self) -> DataFrame:
        """What was counted as the clean tables were written."""
        _ = self.tables
        return self._checks.rows(self.spark)

    @cached_property
    def master(self) -> DataFrame:
        """The master table with its ``split`` column."""
        t = self.tables
        master = build_master(
            t["orders"], t["order_products"], t["products"], t["departments"], self.n, self.seed, self.unit
        )
        return self.scratch.keep(master.withColumn("split", split_column(seed=self.seed)), "master", ["split"])

    @cached_property
    def bucketed(self) -> dict[str, DataFrame]:
        """Orders, their lines and the master table as catalog tables in buckets by order."""
        tables = {"orders": self.tables["orders"], "order_products": self.tables["order_products"], "master": self.master}
        return {name: write_bucketed(df, self.scratch.path(f"bucketed-{name}"), "order_id") for name, df in tables.items()}

    def lines(self, split: str) -> DataFrame:
        """Master rows of one split."""
        return self.master.filter(F.col("split") == split).drop("split")

    def _once(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        if label not in self._kept:
            self._kept[label] = self.scratch.keep(build(), label)
        return self._kept[label]

    def rules(self, split: str = "train") -> DataFrame:
        """Rules mined on one split."""
        return self._once(
            f"{split}-rules", lambda: generate_rules(self.lines(split), self.min_support, self.min_confidence)
        )

    @property
    def all_candidates(self) -> DataFrame:
        """Candidates of both splits, each under its own rules."""
        return self.candidates("train").unionByName(self.candidates("test"))

    def make_candidates(self, split: str, rules_from: str = "same_split") -> DataFrame:
        """Candidates of a split under its own rules, or under the training rules."""
        source = split if rules_from == "same_split" else rules_from
        return build_candidates(self.lines(split), one_to_one(self.rules(source)))

    def candidates(self, split: str = "test") -> DataFrame:
        """Candidates of one split."""
        return self._once(f"{split}-candidates", lambda: self.make_candidates(split))

    def write(self, folder: str, form: str = "csv") -> None:
        """Write the master table and the candidates of both splits to ``folder``."""
        # The names of the written tables.
        write_table(self.master.drop("split"), f"{folder}/master_orders.{form}", form)
        for split in ("train", "test"):
            write_table(self.candidates(split), f"{folder}/{split}_order_data.{form}", form)

    @cached_property
    def ranker(self) -> PipelineModel:
        """The ranker fitted on all training candidates."""
        return fit_ranker(features(self.candidates("train")), self.rounds, seed=self.seed)

    @property
    def scored(self) -> DataFrame:
        """The test candidates with the ranker's score, in the columns that decisions and metrics read."""
        columns = ["order_id", "trigger_product_id", "recommended_product_id", "cart_size", "label", "score"]
        return self._once("scored", lambda: score(self.ranker, self.candidates("test")).select(*columns))
