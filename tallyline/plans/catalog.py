"""Named query plans over the test tables: one callable per business query.

Each entry is ``fn(spark, sf_dir) -> DataFrame``.  Names ending in
``_as_written`` reproduce what the original SQL computes where it differs
from the question it answers; the plain name follows the question.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import allocation as AL
from ..operators import ledger as L
from ..operators import lists as LS
from ..operators import month_end as ME
from ..operators import numbering as N
from ..operators import orders as O
from ..operators import placement as PL
from ..operators import pricing as PR
from ..operators import sketches as SK
from ..session import ensure_checkpoint_dir
from ..sources import analogues as A
from ..sources import business as B
from ..sources import sinks
from ..sources.tables import Tables
from ..streaming import live_balance as LB

# Fixed parameters of the test-data analogue of the business questions.
PRODUCT_NAMES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRICES = {"LARGE": 12}          # every other product costs DEFAULT_PRICE
DEFAULT_PRICE = 10
SURCHARGES = {"gear": 2}        # every other extra costs SURCHARGE_DEFAULT
SURCHARGE_DEFAULT = 1
WEEK_ANCHOR = "2024-01-01"
CALENDAR_START = "1994-10-15"    # a fixed first month of the balance grid
NEW_PRODUCT = "Supreme"
RATE_PER_KM = 0.3


@dataclass(frozen=True)
class Params:
    product_names: tuple[str, ...] = tuple(PRODUCT_NAMES)
    prices: dict = field(default_factory=lambda: dict(PRICES))
    default_price: int = DEFAULT_PRICE
    surcharges: dict = field(default_factory=lambda: dict(SURCHARGES))
    surcharge_default: int = SURCHARGE_DEFAULT
    week_anchor: str = WEEK_ANCHOR
    calendar_start: str = CALENDAR_START
    new_product: str = NEW_PRODUCT
    rate_per_km: float = RATE_PER_KM
    money_scale: int = 0            # decimals of interest: amounts are whole cents


TEST_PARAMS = Params()


class Ctx:
    """Per-query access to the derived business tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = TEST_PARAMS):
        self.t = Tables(spark, sf_dir)
        self.spark = spark
        self.p = params

    @property
    def items(self) -> DataFrame:
        return O.clean_orders(A.raw_order_items(self.t))

    @property
    def dealt_items(self) -> DataFrame:
        """``items`` by order, in parts that stay small at any size."""
        return O.clean_orders(A.raw_order_items(self.t, self.item_tasks))

    @cached_property
    def item_tasks(self) -> int | None:
        return self.t.tasks("lineitem")

    @cached_property
    def txn_tasks(self) -> int | None:
        return self.t.tasks("orders")

    @property
    def deliveries(self) -> DataFrame:
        return O.clean_deliveries(A.raw_deliveries(self.t))

    @property
    def products(self) -> DataFrame:
        return A.products(self.t)

    @property
    def toppings(self) -> DataFrame:
        return A.toppings(self.t)

    @property
    def recipes(self) -> DataFrame:
        return A.recipes(self.t)

    @property
    def ratings(self) -> DataFrame:
        """The test tables have no ratings: they are derived from the orders."""
        return PR.ratings(self.items, self.deliveries)

    @property
    def runners(self) -> DataFrame:
        return A.runners(self.t)

    @property
    def txns(self) -> DataFrame:
        return A.transactions(self.t)

    @property
    def nodes(self) -> DataFrame:
        return A.node_placements(self.t)

    @property
    def moves(self) -> DataFrame:
        return A.node_moves(self.t)

    @property
    def hot_ledger(self) -> DataFrame:
        return A.hot_ledger(self.t)

    @property
    def ledger_text(self) -> DataFrame:
        return A.ledger_text(self.t)

    @property
    def regions(self) -> DataFrame:
        return A.regions(self.t)


def _bulk_load(c: Ctx) -> DataFrame:
    """The ledger written as CSV and loaded with its rejected rows."""
    path = f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/load-{uuid.uuid4().hex}"
    c.ledger_text.write.option("header", True).csv(path)
    return B.load_report(c.spark, path, "customer_transactions")


def _widened_table(c: Ctx) -> DataFrame:
    """A typed table that is created, filled, widened by a rewrite and filled with
    values that only the wider type holds."""
    table = f"made_{uuid.uuid4().hex}"
    sinks.create_table(c.spark, table, [("order_id", "bigint"), ("customer_id", "bigint"), ("rating", "int")], replace=True)
    first = c.ratings.select(F.col("order_id").cast("bigint"), F.col("customer_id").cast("bigint"), F.col("rating").cast("int"))
    first.write.insertInto(table)
    sinks.widen_column(c.spark, table, "rating", "bigint")
    first.select(-F.col("order_id"), "customer_id", F.col("rating").cast("bigint") * 10_000_000_000).write.insertInto(table)
    return c.spark.table(table)


def _month_end_incremental(c: Ctx) -> DataFrame:
    return ME.appended_in_periods(c.spark, c.txns, f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/month-end-{uuid.uuid4().hex}")


def q(fn: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


BUILDERS: dict[str, Callable[[Ctx], DataFrame]] = {
    # ---- cleaning
    "clean_orders": (lambda c: c.items),
    "clean_deliveries": (lambda c: c.deliveries),
    # ---- loads and tables
    "bulk_load": _bulk_load,
    "widened_table": _widened_table,
    # ---- counts
    "items_ordered": (lambda c: O.items_ordered(c.items)),
    "distinct_customers": (lambda c: O.distinct_customers(c.items)),
    "distinct_orders": (lambda c: O.distinct_orders(c.items)),
    "successful_orders": (lambda c: O.orders_per_courier(c.deliveries, True)),
    "orders_per_courier": (lambda c: O.orders_per_courier(c.deliveries, False)),
    "product_mix": (lambda c: O.product_mix(c.items, c.products, c.p.product_names)),
    "max_items_per_order": (lambda c: O.max_items_per_order(c.items, c.deliveries)),
    "max_items_per_order_as_written": (lambda c: O.max_items_per_order(c.items)),
    "change_split": (lambda c: O.change_split(c.items, c.deliveries)),
    "change_split_as_written": (lambda c: O.change_split(c.items, c.deliveries, as_written=True)),
    "both_changes": (lambda c: O.both_changes(c.items, c.deliveries)),
    "delivered_by_type": (lambda c: O.delivered_by_type(c.items, c.deliveries, c.products)),
    # ---- time profiles
    "by_hour": (lambda c: O.by_hour(c.items)),
    "by_weekday": (lambda c: O.by_weekday(c.items)),
    "by_week_us": (lambda c: O.by_week(c.runners)),
    "by_week_anchor": (lambda c: O.by_week(c.runners, c.p.week_anchor)),
    # ---- timings, distances, speeds
    "pickup_minutes": (lambda c: O.pickup_minutes(c.items, c.deliveries)),
    "prep_by_size": (lambda c: O.prep_by_size(c.items, c.deliveries)),
    "prep_correlation": (lambda c: O.prep_correlation(c.items, c.deliveries)),
    "avg_distance": (lambda c: O.avg_distance(c.items, c.deliveries)),
    "avg_distance_as_written": (lambda c: O.avg_distance(c.items, c.deliveries, per="item")),
    "avg_distance_per_order": (lambda c: O.avg_distance(c.items, c.deliveries, per="order")),
    "duration_spread": (lambda c: O.duration_spread(c.deliveries)),
    "speed": (lambda c: O.speed(c.items, c.deliveries)),
    "success_pct": (lambda c: O.success_pct(c.deliveries)),
    "success_pct_as_written": (lambda c: O.success_pct(c.deliveries, as_written=True)),
    # ---- lists
    "line_ids": (lambda c: LS.with_line_ids(c.dealt_items)),
    "global_ids": (lambda c: N.with_global_ids(c.dealt_items, ["order_time", "order_id"], "record_id", c.item_tasks)),
    "hot_key_ids": (lambda c: N.numbered(c.hot_ledger, ["customer_id", "txn_date"], ["txn_type", "txn_amount"], "txn_id", c.txn_tasks)),
    "recipe_rows": (lambda c: LS.explode_recipe(c.recipes, c.toppings)),
    "extra_rows": (lambda c: LS.explode_ids(c.dealt_items, "extras", "extra_id")),
    "exclusion_rows": (lambda c: LS.explode_ids(c.dealt_items, "exclusions", "exclusion_id")),
    "recipe_list": (lambda c: LS.recipe_list(c.recipes, c.toppings)),
    "extra_rank": (lambda c: LS.token_rank(c.items, "extras", c.toppings, "extra_count")),
    "exclusion_rank": (lambda c: LS.token_rank(c.items, "exclusions", c.toppings, "exclusion_count")),
    "top_extra": (lambda c: LS.token_rank(c.items, "extras", c.toppings, "extra_count", top=1)),
    "top_exclusion": (lambda c: LS.token_rank(c.items, "exclusions", c.toppings, "exclusion_count", top=1)),
    "item_label": (lambda c: LS.item_label(c.dealt_items, c.toppings, c.products)),
    "ingredient_list": (lambda c: LS.ingredient_list(c.dealt_items, c.recipes, c.toppings, c.products)),
    "ingredient_list_as_written": (lambda c: LS.ingredient_list(c.dealt_items, c.recipes, c.toppings, c.products,
                                                                 as_written=True)),
    "ingredient_usage": (lambda c: LS.ingredient_usage(c.items, c.recipes, c.toppings, c.deliveries)),
    "ingredient_usage_as_written": (lambda c: LS.ingredient_usage(c.items, c.recipes, c.toppings,
                                                                   as_written=True)),
    # ---- pricing and ratings
    "revenue": (lambda c: PR.revenue(c.items, c.deliveries, c.products, c.p.prices, c.p.default_price)),
    "revenue_with_extras": (lambda c: PR.revenue_with_extras(
        c.items, c.deliveries, c.products, c.toppings, c.p.prices, c.p.default_price, c.p.surcharges,
        c.p.surcharge_default)),
    "revenue_with_extras_as_written": (lambda c: PR.revenue_with_extras(
        c.items, c.deliveries, c.products, c.toppings, c.p.prices, c.p.default_price, c.p.surcharges,
        c.p.surcharge_default, as_written=True)),
    "ratings": (lambda c: c.ratings),
    "delivery_fact": (lambda c: PR.delivery_fact(c.items, c.deliveries, c.ratings)),
    "net_after_pay": (lambda c: PR.net_after_pay(c.items, c.deliveries, c.products, c.p.prices,
                                                  c.p.default_price, c.p.rate_per_km)),
    "net_after_pay_as_written": (lambda c: PR.net_after_pay(c.items, c.deliveries, c.products, c.p.prices,
                                                             c.p.default_price, c.p.rate_per_km, as_written=True)),
    "append_product": (lambda c: PR.append_product(c.products, c.recipes, c.toppings, c.p.new_product)[0]),
    "append_product_recipe": (lambda c: PR.append_product(c.products, c.recipes, c.toppings, c.p.new_product)[1]),
    # ---- node placements
    "distinct_nodes": (lambda c: PL.distinct_nodes(c.nodes)),
    "nodes_per_region": (lambda c: PL.nodes_per_region(c.nodes, c.regions)),
    "nodes_per_region_as_written": (lambda c: PL.nodes_per_region(c.nodes, c.regions, distinct=False)),
    "customers_per_region": (lambda c: PL.customers_per_region(c.nodes, c.regions)),
    "realloc_avg": (lambda c: PL.realloc_avg(c.nodes)),
    "realloc_avg_per_stint": (lambda c: PL.realloc_avg(c.nodes, per_stint=True)),
    "realloc_percentiles": (lambda c: PL.realloc_percentiles(c.nodes, c.regions)),
    "realloc_second_percentiles": (lambda c: PL.realloc_second_percentiles(c.moves, c.regions)),
    # ---- ledger
    "txn_summary": (lambda c: L.txn_summary(c.txns)),
    "deposit_averages": (lambda c: L.deposit_averages(c.txns)),
    "active_customers": (lambda c: L.active_customers(c.txns)),
    "active_customers_as_written": (lambda c: L.active_customers(c.txns, as_written=True)),
    "closing_balance": (lambda c: L.closing_balance(c.txns)),
    "closing_balance_fixed_start": (lambda c: L.closing_balance(c.txns, start=c.p.calendar_start)),
    "month_end_incremental": _month_end_incremental,
    "yearly_customers": (lambda c: SK.yearly_customers(c.txns)),
    "growth_pct": (lambda c: L.growth_pct(c.txns)),
    "growth_pct_abs": (lambda c: L.growth_pct(c.txns, use_abs=True)),
    "running_balance": (lambda c: L.running_balance(c.txns)),
    "balance_stats": (lambda c: L.balance_stats(c.txns)),
    # ---- allocation and interest
    "alloc_month_end": (lambda c: AL.alloc_month_end(c.txns)),
    "alloc_trailing30": (lambda c: AL.alloc_trailing30(c.txns, tasks=c.txn_tasks)),
    "alloc_realtime": (lambda c: AL.alloc_realtime(c.txns)),
    "interest_simple": (lambda c: AL.interest_simple(c.txns, scale=c.p.money_scale, tasks=c.txn_tasks)),
    "interest_compound": (lambda c: AL.interest_compound(c.txns, scale=c.p.money_scale)),
    "interest_compound_floored": (lambda c: AL.interest_compound(c.txns, floor_at_zero=True, scale=c.p.money_scale)),
    # ---- streaming (replayed from a file source with an availableNow trigger)
    "live_balance": (lambda c: LB.replay_live_balance(c.spark, c.txns)),
    "live_month_peaks": (lambda c: LB.replay_month_peaks(c.spark, c.txns)),
    "live_peaks_late": (lambda c: LB.replay_month_peaks(c.spark, c.txns, delay=10)),
    "live_month_total": (lambda c: LB.replay_month_total(c.spark, c.txns)),
    "live_monthly_net": (lambda c: LB.replay_monthly_net(c.spark, c.txns)),
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: q(fn) for n, fn in BUILDERS.items()}
