"""Revenue, surcharges, ratings, the delivery fact table, courier pay and
adding a product.

Prices are given as {product name: price} with a default for every other
product; surcharges likewise per topping name.  Both become CASE expressions
(no price table to join).  Item rows are reduced per product / topping before
they meet the dimension.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import timeparts as T
from .orders import delivered_items, speed_kmh, successful


def price_of(col: str, prices: Mapping[str, int], default: int) -> Column:
    expr = F.lit(default)
    for name, p in prices.items():
        expr = F.when(F.col(col) == name, F.lit(p)).otherwise(expr)
    return expr


def revenue(items: DataFrame, deliveries: DataFrame, products: DataFrame,
            prices: Mapping[str, int], default: int) -> DataFrame:
    """Fixed-price revenue of delivered items."""
    per = delivered_items(items, deliveries).groupBy("pizza_id").agg(F.count("*").alias("n"))
    j = per.join(products, "pizza_id")
    return j.agg(F.sum(F.col("n") * price_of("pizza_name", prices, default)).cast("bigint").alias("revenue"))


def extras_surcharge(items: DataFrame, toppings: DataFrame, surcharges: Mapping[str, int],
                     default: int = 1, deliveries: DataFrame | None = None) -> DataFrame:
    """Total charge for extras: each extra topping costs ``default`` unless it
    has its own price.  Extras that name no known topping are not charged."""
    src = items if deliveries is None else delivered_items(items, deliveries)
    per = (src.select(F.explode(C.parse_id_list("extras")).alias("topping_id"))
           .groupBy("topping_id").agg(F.count("*").alias("n")))
    j = per.join(toppings, "topping_id")
    return j.agg(F.sum(F.col("n") * price_of("topping_name", surcharges, default)).cast("bigint").alias("surcharge"))


def revenue_with_extras(items: DataFrame, deliveries: DataFrame, products: DataFrame, toppings: DataFrame,
                        prices: Mapping[str, int], default: int, surcharges: Mapping[str, int],
                        surcharge_default: int = 1, as_written: bool = False) -> DataFrame:
    """Delivered revenue plus the extras charge.

    Default: extras of delivered items only.  ``as_written``: extras of every
    item, cancelled orders included.  The two one-row results are combined
    with a scalar subquery (no join).
    """
    base = revenue(items, deliveries, products, prices, default)
    extra = extras_surcharge(items, toppings, surcharges, surcharge_default,
                             None if as_written else deliveries)
    return base.select((F.col("revenue") + F.coalesce(extra.scalar(), F.lit(0))).cast("bigint")
                       .alias("updated_revenue"))


def ratings(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """A rating 1..5 for every successful order, derived from its keys: stands
    in for the ratings table where none is given (the test tables)."""
    orders = items.select("order_id", "customer_id").distinct()
    j = orders.join(successful(deliveries).select("order_id"), "order_id")
    return j.select("order_id", "customer_id",
                    (F.pmod(F.col("order_id") * 7 + F.col("customer_id"), F.lit(5)) + 1).cast("int").alias("rating"))


def delivery_fact(items: DataFrame, deliveries: DataFrame, rating_table: DataFrame) -> DataFrame:
    """One row per successful delivery with its rating, times, speed and size."""
    per = items.groupBy("customer_id", "order_id", "order_time").agg(F.count("order_id").alias("pizza_count"))
    j = per.join(successful(deliveries), "order_id").join(rating_table, ["order_id", "customer_id"], "left")
    return j.select("customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
                    T.boundary_minutes("order_time", "pickup_time").alias("mins_difference"),
                    "duration", speed_kmh().alias("avg_speed"), "pizza_count")


def net_after_pay(items: DataFrame, deliveries: DataFrame, products: DataFrame, prices: Mapping[str, int],
                  default: int, rate_per_km: float = 0.3, as_written: bool = False) -> DataFrame:
    """Delivered revenue, courier pay (rate x total km) and what is left,
    rounded to cents.

    Default: couriers are paid for successful deliveries, and no revenue is 0.
    ``as_written``: the kilometres of every delivery.  Kilometres are summed
    as decimals, so the cents do not depend on the order of the rows."""
    rev = revenue(items, deliveries, products, prices, default)
    paid_for = deliveries if as_written else successful(deliveries)
    km = F.sum(F.col("distance").cast("decimal(20,8)"))
    paid = paid_for.agg(F.round(km * F.lit(str(rate_per_km)).cast("decimal(10,6)"), 2).alias("paid"))
    earned = rev.scalar() if as_written else F.coalesce(rev.scalar(), F.lit(0))
    cost = F.col("paid") if as_written else F.coalesce("paid", F.lit(0))
    return paid.select(earned.cast("bigint").alias("revenue"), cost.cast("decimal(30,2)").alias("p")).select(
        "revenue", F.col("p").cast("double").alias("runners_paid"), (F.col("revenue") - F.col("p")).cast("double").alias("change_left"))


def append_product(products: DataFrame, recipes: DataFrame, toppings: DataFrame, name: str,
                   new_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(products, recipes), each with one row more: a new product holding every
    topping, whose id is ``new_id`` or one past the largest id.  All rows stay.

    The topping ids are collected into one text (bounded by the toppings)."""
    if new_id is not None:
        id_col = F.lit(new_id)
    else:
        id_col = products.agg(F.max("pizza_id") + 1).scalar()
    all_ids = F.array_join(F.transform(F.array_sort(F.collect_list("topping_id")), lambda x: x.cast("string")), ", ")
    id_type = products.schema["pizza_id"].dataType
    new = toppings.agg(all_ids.alias("toppings")).select(id_col.cast(id_type).alias("pizza_id"), F.lit(name).alias("pizza_name"), "toppings")
    return (products.select("pizza_id", "pizza_name").unionByName(new.select("pizza_id", "pizza_name")),
            recipes.select("pizza_id", "toppings").unionByName(new.select("pizza_id", "toppings")))
