"""Reference-shaped tables derived from the TPC-H-like test tables.

The operators in ``tallyline.operators`` take tables shaped like the business
case tables (orders with items, deliveries, products, recipes, toppings,
runners, ledger transactions, node placements, regions).  The test data has
other tables, so this module derives each business table from them with Spark
expressions.  Every derivation is a projection of, or a join / aggregation
over, the whole input tables, so the work grows with them.

Mapping (item = one ``lineitem`` row):

* raw order items  <- lineitem JOIN orders: order = l_orderkey, customer =
  o_custkey, product = l_partkey, order time = o_orderdate plus a time of
  day taken from the order key; exclusion / extra lists are messy text
  ('null', 'NULL', NULL, '', '4', '2, 6', '2,6') chosen by key arithmetic.
* raw deliveries    <- orders (one row per order): courier = priority digit,
  cancelled = status 'P'; pickup / distance / duration are text with units
  and null tokens.
* products          <- part: id = p_partkey, name = p_type.
* toppings          <- the words of p_name, numbered in alphabetical order.
* recipes           <- part: the ids of the words of p_name as '3, 11' text.
* runners           <- events: a user's first event date is the sign-up date.
* transactions      <- orders: customer = o_custkey, date = o_orderdate,
  type by status (F deposit, O purchase, P withdrawal), amount in cents.
* node placements   <- events JOIN customer JOIN nation: node = event_type,
  start = event date, region = the customer's nation's region.
* regions           <- region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables

# Fixed values of the derivation (also spelled out in the DuckDB oracle).
LIST_ID_RANGE = 16          # list ids are drawn from 1..16
TIME_OF_DAY_MULT = 7919     # time of day = (order key * 7919) mod 86400 seconds


def _s(c: Column) -> Column:
    return c.cast("string")


def order_time(orderkey: Column, orderdate: Column) -> Column:
    secs = (orderkey * TIME_OF_DAY_MULT) % 86400
    return orderdate.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def raw_order_items(t: Tables, tasks: int | None = None) -> DataFrame:
    """With ``tasks``, the items come in that many parts by order, which what follows
    by order keeps: the join, counts and line numbers of an order are one stage."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if tasks:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    n = LIST_ID_RANGE
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    ex_k = (ok + ln) % 10
    exclusions = (F.when(ex_k == 0, F.lit(None).cast("string"))
                  .when(ex_k == 1, F.lit("null"))
                  .when(ex_k == 2, F.lit("NULL"))
                  .when(ex_k == 7, _s(pk % n + 1))
                  .when(ex_k == 8, F.concat(_s(sk % n + 1), F.lit(", "), _s(pk % n + 1)))
                  .otherwise(F.lit("")))
    x_k = (pk + ln) % 10
    extras = (F.when(x_k == 0, F.lit(None).cast("string"))
              .when(x_k == 1, F.lit("null"))
              .when(x_k == 5, _s(sk % n + 1))
              .when(x_k == 6, F.concat(_s(ok % n + 1), F.lit(","), _s(sk % n + 1)))
              .when(x_k == 9, F.concat(_s(pk % n + 1), F.lit(", "), _s(ok % n + 1)))
              .otherwise(F.lit("")))
    return j.select(
        ok.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        pk.alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        order_time(F.col("o_orderkey"), F.col("o_orderdate")).alias("order_time"),
    )


def raw_deliveries(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    cancelled = F.col("o_orderstatus") == "P"
    ot = order_time(ok, F.col("o_orderdate"))
    pickup = ot + F.make_dt_interval(F.lit(0), F.lit(0), 5 + ok % 37, ck % 60)
    km10 = 10 + (ok * 13 + ck) % 240
    dist_txt = F.concat(_s(F.expr("km10 div 10")), F.lit("."), _s(km10 % 10))
    m = (ok * 7 + ck) % 41
    return (o.withColumn("km10", km10).select(
        ok.alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("runner_id"),
        F.when(cancelled, F.lit("null"))
         # cast, not date_format: formatting goes through the session zone
         .otherwise(pickup.cast("string")).alias("pickup_time"),
        F.when(cancelled, F.lit("null"))
         .when(ok % 4 == 0, F.concat(dist_txt, F.lit("km")))
         .when(ok % 4 == 1, F.concat(dist_txt, F.lit(" km")))
         .when(ok % 4 == 2, F.concat(dist_txt, F.lit("45")))   # three decimals: x.x45
         .otherwise(F.concat(_s(F.expr("km10 div 10")), F.lit("km"))).alias("distance"),
        F.when(cancelled, F.lit("null"))
         .when(ck % 5 == 0, F.concat(_s(m), F.lit(" minutes")))
         .when(ck % 5 == 1, F.concat(_s(m), F.lit("mins")))
         .when(ck % 5 == 2, F.concat(_s(m), F.lit(" mins")))
         .when(ck % 5 == 3, F.concat(_s(m), F.lit("minute")))
         .otherwise(_s(m)).alias("duration"),
        F.when(cancelled & (ok % 2 == 0), F.lit("Restaurant Cancellation"))
         .when(cancelled, F.lit("Customer Cancellation"))
         .when(ok % 4 == 0, F.lit(None).cast("string"))
         .when(ok % 4 == 1, F.lit("null"))
         .when(ok % 4 == 2, F.lit("NaN"))
         .otherwise(F.lit("")).alias("cancellation"),
    ))


def products(t: Tables) -> DataFrame:
    """Catalogue rows; every 97th part has none, so that items without a
    product row occur."""
    return t.part.filter("p_partkey % 97 <> 5").select(F.col("p_partkey").alias("pizza_id"), F.col("p_type").alias("pizza_name"))


def toppings(t: Tables) -> DataFrame:
    """Vocabulary of product-name words, numbered 1.. in alphabetical order.

    The numbering is a window over the *distinct* words only (bounded by the
    vocabulary, not by the part table), after a partial distinct per task.
    """
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("topping_name")).distinct()
    return words.select(F.dense_rank().over(Window.orderBy("topping_name")).cast("int").alias("topping_id"),
                        "topping_name")


def recipes(t: Tables) -> DataFrame:
    """Recipe text per product: the ids of its name's words in word order;
    every 89th part has no recipe."""
    words = t.part.filter("p_partkey % 89 <> 7").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "topping_name"))
    ids = words.join(toppings(t), "topping_name")
    return ids.groupBy(F.col("p_partkey").alias("pizza_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "topping_id"))),
                                 lambda x: x["topping_id"].cast("string")), ", ").alias("toppings"))


def runners(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("runner_id")).agg(
        F.to_date(F.min("ts")).alias("registration_date"))


def transactions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("txn_id"),
        F.to_date("o_orderdate").alias("txn_date"),
        F.when(F.col("o_orderstatus") == "F", "deposit")
         .when(F.col("o_orderstatus") == "O", "purchase")
         .when(F.col("o_orderstatus") == "P", "withdrawal")
         .otherwise(F.col("o_orderstatus")).alias("txn_type"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("txn_amount"),
    )


def node_placements(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    cust = t.customer.select("c_custkey", "c_nationkey")
    nat = t.nation.select("n_nationkey", "n_regionkey")
    return (ev.join(cust, ev.user_id == cust.c_custkey)
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("user_id").alias("customer_id"),
                    F.col("n_regionkey").alias("region_id"),
                    F.col("event_type").alias("node_id"),
                    F.to_date("ts").alias("start_date"),
                    F.col("event_id").alias("stint_id")))


def node_moves(t: Tables) -> DataFrame:
    """Node placements to the microsecond."""
    ev = t.events.select("user_id", "event_type", "ts")
    cust = t.customer.select("c_custkey", "c_nationkey")
    nat = t.nation.select("n_nationkey", "n_regionkey")
    return (ev.join(cust, ev.user_id == cust.c_custkey).join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("user_id").alias("customer_id"), F.col("n_regionkey").alias("region_id"),
                    F.col("event_type").alias("node_id"), F.col("ts").alias("moved_at")))


def hot_ledger(t: Tables) -> DataFrame:
    """A ledger without transaction ids in which one customer (0) has a third of
    the rows, and days are months, so that a key has very many rows."""
    txns = transactions(t)
    return txns.select(F.when(F.col("customer_id") % 3 == 0, 0).otherwise(F.col("customer_id")).cast("bigint").alias("customer_id"),
                       F.trunc("txn_date", "month").alias("txn_date"), "txn_type", "txn_amount")


def ledger_text(t: Tables) -> DataFrame:
    """The ledger as text for a bulk load; every 50th amount and every 70th date is
    no such value, every 90th amount is blank and every 40th customer has blanks around."""
    txns = transactions(t)
    k = F.col("txn_id")
    return txns.select(
        F.when(k % 40 == 3, F.concat(F.lit(" "), F.col("customer_id").cast("string"), F.lit(" "))).otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
        F.when(k % 70 == 1, F.lit("2020-13-45")).otherwise(F.col("txn_date").cast("string")).alias("txn_date"), "txn_type",
        F.when(k % 50 == 1, F.lit("12.x")).when(k % 90 == 2, F.lit("")).otherwise(F.col("txn_amount").cast("string")).alias("txn_amount"))


def regions(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))
