"""The registered queries over tables in their original business shapes.

``run(spark, tables, name)`` evaluates any query name of the catalog over a
dict of DataFrames shaped like the original tables (``customer_orders``,
``runner_orders``, ``runners``, ``pizza_names``, ``pizza_recipes``,
``pizza_toppings``, ``pizza_ratings``, ``customer_transactions``, ``customer_nodes``,
``regions``; see ``sources.business`` for typed readers).  Only the tables a
query uses need to be present.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import orders as O
from ..operators.numbering import numbered
from ..sources.business import with_txn_ids
from ..sources.tables import tasks_for
from .catalog import BUILDERS, Params

# The parameters stated by the original questions.
REFERENCE_PARAMS = Params(
    product_names=("Meatlovers", "Vegetarian"),
    prices={"Meatlovers": 12},
    default_price=10,
    surcharges={"Cheese": 2},
    surcharge_default=1,
    week_anchor="2021-01-01",
    new_product="Supreme",
    rate_per_km=0.3,
    money_scale=2,
    calendar_start="2020-01-01",
)


class BusinessCtx:
    """Same interface as the test-data context, over business-shaped tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], params: Params = REFERENCE_PARAMS):
        self.spark = spark
        self.tables = tables
        self.p = params

    def _t(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"table {name!r} is needed by this query")
        return self.tables[name]

    @property
    def items(self) -> DataFrame:
        return O.clean_orders(self._t("customer_orders"))

    @property
    def dealt_items(self) -> DataFrame:
        return self.items.repartition(self.item_tasks, "order_id") if self.item_tasks else self.items

    @cached_property
    def item_tasks(self) -> int | None:
        return tasks_for(self._t("customer_orders"))

    @cached_property
    def txn_tasks(self) -> int | None:
        return tasks_for(self._t("customer_transactions"))

    @property
    def deliveries(self) -> DataFrame:
        return O.clean_deliveries(self._t("runner_orders"))

    @property
    def products(self) -> DataFrame:
        return self._t("pizza_names")

    @property
    def toppings(self) -> DataFrame:
        return self._t("pizza_toppings")

    @property
    def recipes(self) -> DataFrame:
        return self._t("pizza_recipes")

    @property
    def ratings(self) -> DataFrame:
        return self._t("pizza_ratings")

    @property
    def runners(self) -> DataFrame:
        return self._t("runners")

    @property
    def txns(self) -> DataFrame:
        t = self._t("customer_transactions")
        return t if "txn_id" in t.columns else with_txn_ids(t)

    @property
    def nodes(self) -> DataFrame:
        n = self._t("customer_nodes")
        if "stint_id" in n.columns:
            return n
        # tie-break for stints starting on the same day
        return numbered(n, ["customer_id", "start_date"], ["end_date", "node_id", "region_id"], "stint_id")

    @property
    def moves(self) -> DataFrame:
        """Placements with the start of their first day as the moment."""
        return self.nodes.withColumn("moved_at", F.col("start_date").cast("timestamp_ntz"))

    @property
    def hot_ledger(self) -> DataFrame:
        return self._t("customer_transactions").drop("txn_id")

    @property
    def ledger_text(self) -> DataFrame:
        t = self._t("customer_transactions")
        return t.select(*[F.col(c).cast("string") for c in ("customer_id", "txn_date", "txn_type", "txn_amount")])

    @property
    def regions(self) -> DataFrame:
        return self._t("regions")


def names() -> list[str]:
    return list(BUILDERS)


def run(spark: SparkSession, tables: dict[str, DataFrame], name: str,
        params: Params = REFERENCE_PARAMS) -> DataFrame:
    return BUILDERS[name](BusinessCtx(spark, tables, params))
