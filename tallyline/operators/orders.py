"""Order and delivery metrics (cleaning, counts, mixes, time profiles, speeds).

Inputs:
  items       order_id, customer_id, pizza_id, exclusions, extras, order_time
              (one row per ordered item; ``clean_orders`` output)
  deliveries  order_id, runner_id, pickup_time, distance, duration, cancellation
              (one row per order; ``clean_deliveries`` output)
  products    pizza_id, pizza_name
  runners     runner_id, registration_date

Scale notes: item-level data is reduced per order (or per product) *before*
it meets a delivery or product row, so joins carry pre-aggregated rows; all
aggregations are partial/final, so a hot courier, customer or product only
adds rows to the map-side combine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import timeparts as T


def int_avg(col: str) -> Column:
    """Integer average truncated toward zero (SQL AVG over an INT column)."""
    return F.expr(f"sum({col}) div nullif(count({col}), 0)")


# --------------------------------------------------------------- cleaning

def clean_orders(raw: DataFrame) -> DataFrame:
    """Null tokens and NULLs in the two list columns become ''."""
    return raw.select(
        "order_id", "customer_id", "pizza_id",
        C.blank_if_token("exclusions").alias("exclusions"),
        C.blank_if_token("extras").alias("extras"),
        "order_time")


def clean_deliveries(raw: DataFrame) -> DataFrame:
    """Text columns to typed values: timestamp, km as double, minutes as int,
    and NULL cancellation for a successful delivery."""
    return raw.select(
        "order_id", "runner_id",
        C.parse_timestamp("pickup_time").alias("pickup_time"),
        C.parse_number("distance", C.DISTANCE_UNITS, "double").alias("distance"),
        C.parse_number("duration", C.DURATION_UNITS, "int").alias("duration"),
        C.null_if_token("cancellation", C.CANCELLATION_NULL_TOKENS).alias("cancellation"))


def with_id_lists(items: DataFrame) -> DataFrame:
    """Adds ``exclusion_ids`` / ``extra_ids`` as ARRAY<BIGINT> (empty = none)."""
    return items.withColumn("exclusion_ids", C.parse_id_list("exclusions")) \
                .withColumn("extra_ids", C.parse_id_list("extras"))


def successful(deliveries: DataFrame) -> DataFrame:
    return deliveries.filter(F.col("cancellation").isNull())


def delivered_items(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Items of successfully delivered orders (semi join: items are not widened)."""
    return items.join(successful(deliveries).select("order_id"), "order_id", "left_semi")


# --------------------------------------------------------------- counts

def items_ordered(items: DataFrame) -> DataFrame:
    return items.agg(F.count("order_id").alias("pizza_count"))


def distinct_customers(items: DataFrame) -> DataFrame:
    return items.agg(F.countDistinct("customer_id").alias("customer_count"))


def distinct_orders(items: DataFrame) -> DataFrame:
    return items.agg(F.countDistinct("order_id").alias("order_count"))


def orders_per_courier(deliveries: DataFrame, successful_only: bool = True) -> DataFrame:
    d = successful(deliveries) if successful_only else deliveries
    return d.groupBy("runner_id").agg(F.count("order_id").alias("successful_orders"))


def product_mix(items: DataFrame, products: DataFrame, names: Iterable[str]) -> DataFrame:
    """Per customer, one count column per product name (conditional sums in a
    single aggregation; names are given, so no extra job finds them).  A
    product without a catalogue row counts under no name, but its customer stays."""
    per = items.groupBy("customer_id", "pizza_id").agg(F.count("*").alias("n"))
    j = per.join(products, "pizza_id", "left")
    return j.groupBy("customer_id").agg(
        *[F.sum(F.when(F.col("pizza_name") == n, F.col("n")).otherwise(0)).alias(n) for n in names])


def max_items_per_order(items: DataFrame, deliveries: DataFrame | None = None) -> DataFrame:
    """Largest item count of one order; delivered orders only when
    ``deliveries`` is given (the question's reading)."""
    src = items if deliveries is None else delivered_items(items, deliveries)
    per = src.groupBy("customer_id", "order_id").agg(F.count("order_id").alias("n"))
    return per.agg(F.max("n").alias("max_single_order"))


def change_split(items: DataFrame, deliveries: DataFrame, as_written: bool = False) -> DataFrame:
    """Per customer, items with at least one change and without.

    ``as_written``: every joined item (cancelled too), and a change is a
    non-NULL list column -- after cleaning lists are never NULL, so every
    item counts as changed.  Default: delivered items, change = non-empty list.
    """
    if as_written:
        j = items.join(deliveries.select("order_id"), "order_id")
        changed = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
        unchanged = F.col("exclusions").isNull() & F.col("extras").isNull()
    else:
        j = with_id_lists(delivered_items(items, deliveries))
        changed = (F.size("exclusion_ids") > 0) | (F.size("extra_ids") > 0)
        unchanged = ~changed
    return j.groupBy("customer_id").agg(
        F.sum(F.when(changed, 1).otherwise(0)).alias("with_changes"),
        F.sum(F.when(unchanged, 1).otherwise(0)).alias("without_changes"))


def both_changes(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    j = with_id_lists(delivered_items(items, deliveries))
    both = (F.size("exclusion_ids") > 0) & (F.size("extra_ids") > 0)
    return j.agg(F.sum(F.when(both, 1).otherwise(0)).alias("with_exclusion_and_extra"))


def delivered_by_type(items: DataFrame, deliveries: DataFrame, products: DataFrame) -> DataFrame:
    per = delivered_items(items, deliveries).groupBy("pizza_id").agg(F.count("*").alias("n"))
    return per.join(products, "pizza_id").groupBy("pizza_name").agg(F.sum("n").alias("delivered"))


# --------------------------------------------------------------- time profiles

def by_hour(items: DataFrame) -> DataFrame:
    return (items.groupBy(F.hour("order_time").alias("hour"))
            .agg(F.count("order_id").alias("pizza_ordered")).orderBy("hour"))


def by_weekday(items: DataFrame) -> DataFrame:
    return (items.groupBy(T.weekday_name("order_time").alias("weekday"))
            .agg(F.count("order_id").alias("pizza_ordered"))
            .orderBy(F.desc("pizza_ordered"), "weekday"))


def by_week(runners: DataFrame, anchor: str | None = None) -> DataFrame:
    """Sign-ups per week: calendar weeks (Sunday start, week 1 holds 1 Jan) when
    ``anchor`` is None, else 7-day periods counted from ``anchor``."""
    wk = T.us_week("registration_date") if anchor is None else T.anchored_week("registration_date", anchor)
    return runners.groupBy(wk.alias("week_period")).agg(F.count("*").alias("runner_count"))


# --------------------------------------------------------------- timings

def _order_times(items: DataFrame) -> DataFrame:
    return items.select("order_id", "order_time").distinct()


def pickup_minutes(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per courier, integer average of minute boundaries from order to pickup,
    one value per delivered order."""
    j = _order_times(items).join(successful(deliveries), "order_id")
    m = j.select("runner_id", T.boundary_minutes("order_time", "pickup_time").alias("pickup_minutes"))
    return m.groupBy("runner_id").agg(int_avg("pickup_minutes").alias("average_time"))


def _order_sizes(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    per = items.groupBy("order_id", "order_time").agg(F.count("pizza_id").alias("pizza_count"))
    j = per.join(successful(deliveries), "order_id")
    return j.select("order_id", "pizza_count",
                    T.boundary_minutes("order_time", "pickup_time").alias("prep_time"))


def prep_by_size(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    return (_order_sizes(items, deliveries).groupBy("pizza_count")
            .agg(int_avg("prep_time").alias("avg_prep_time")))


def prep_correlation(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Pearson correlation of order size and preparation minutes."""
    return _order_sizes(items, deliveries).agg(
        F.round(F.corr(F.col("pizza_count").cast("double"), F.col("prep_time").cast("double")), 6)
        .alias("correlation"))


KM_UNITS = 100_000_000     # distances are summed as whole units of 1e-8 km


def km_units(distance: str = "distance") -> Column:
    """The distance as written, in whole units of 1e-8 km: the shortest decimal
    of the double is the number that the text held, and nothing is rounded
    before the final result."""
    return (F.col(distance).cast("decimal(20,8)") * F.lit(KM_UNITS)).cast("bigint")


def avg_distance(items: DataFrame, deliveries: DataFrame, per: str = "order") -> DataFrame:
    """Average delivery distance per customer, rounded once, half away from
    zero, to 0.1 km.

    ``per='order'`` (the question's reading) counts each order once;
    ``per='item'`` weights each order by its item count (the joined-rows
    average).  Items are reduced to (customer, order, count) before the join.
    """
    cnt = items.groupBy("customer_id", "order_id").agg(F.count("*").alias("n"))
    if per == "order":
        cnt = cnt.withColumn("n", F.lit(1).cast("bigint"))
    j = cnt.join(deliveries.select("order_id", km_units().alias("u")), "order_id")
    sums = j.groupBy("customer_id").agg(
        F.sum(F.col("u").cast("decimal(28,0)") * F.col("n").cast("decimal(10,0)")).cast("decimal(38,0)").alias("s"),
        F.sum(F.when(F.col("u").isNotNull(), F.col("n"))).cast("decimal(20,0)").alias("n"))
    # exact, since a float mean of exactly x.x5 could round either way
    tenths = F.expr(f"signum(s) * ((2 * abs(s) + {KM_UNITS // 10} * n) div ({KM_UNITS // 5} * n))").cast("double")
    return sums.select("customer_id", F.when(F.col("n") > 0, tenths / F.lit(10.0)).alias("average_distance"))


def duration_spread(deliveries: DataFrame) -> DataFrame:
    return deliveries.agg((F.max("duration") - F.min("duration")).alias("duration_difference"))


def speed_kmh(distance: str = "distance", duration: str = "duration") -> Column:
    """km/h = distance / minutes * 60, rounded once, half away from zero, to
    0.1; NULL for a zero or missing duration.  Exact in whole units of
    distance: 8.1 km in 40 min is 12.15 km/h and a float quotient lands on
    either side of the half."""
    u = f"cast(cast({distance} AS decimal(20,8)) * {KM_UNITS} AS decimal(28,0))"
    t = f"cast({duration} AS decimal(10,0))"
    # 10 * km/h = 600 * u / (KM_UNITS * t)
    tenths = f"signum({u}) * signum({t}) * ((1200 * abs({u}) + {KM_UNITS} * abs({t})) div ({2 * KM_UNITS} * abs({t})))"
    return F.expr(f"CASE WHEN {duration} <> 0 THEN cast({tenths} AS double) / 10D END")


def speed(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per delivered order: distance, minutes, item count and km/h (NULL for a
    zero duration)."""
    cnt = items.groupBy("order_id").agg(F.count("order_id").alias("number_of_pizza"))
    j = cnt.join(successful(deliveries), "order_id")
    return j.select("runner_id", "order_id", "distance", F.col("duration").alias("duration_in_min"),
                    "number_of_pizza", speed_kmh().alias("avg_speed"))


def success_pct(deliveries: DataFrame, as_written: bool = False) -> DataFrame:
    """Per courier: orders, delivered orders and success percentage.

    ``as_written``: delivered = distance present, integer percentage
    (100*delivered div total).  Default: delivered = not cancelled, percentage
    rounded to 2 decimals.
    """
    if as_written:
        ok = F.col("distance").isNotNull()
        pct = F.expr("(100 * sum(CASE WHEN distance IS NULL THEN 0 ELSE 1 END)) div count(*)")
        return deliveries.groupBy("runner_id").agg(
            F.count("*").alias("total_orders"), F.count("distance").alias("delivered"),
            pct.alias("success_percentage"))
    ok = F.col("cancellation").isNull()
    return deliveries.groupBy("runner_id").agg(
        F.count("*").alias("total_orders"),
        F.count(F.when(ok, 1)).alias("delivered"),
        F.round(F.lit(100.0) * F.count(F.when(ok, 1)) / F.count("*"), 2).alias("success_percentage"))
