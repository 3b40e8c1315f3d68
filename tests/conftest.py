from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="tallyline-tests")
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


RAW_ORDERS_SCHEMA = ("order_id bigint, customer_id bigint, pizza_id bigint, exclusions string, extras string, "
                     "order_time timestamp_ntz")
RAW_DELIVERIES_SCHEMA = ("order_id bigint, runner_id int, pickup_time string, distance string, duration string, "
                         "cancellation string")


@pytest.fixture(scope="session")
def pizza(spark):
    """Hand-made order fixture holding every edge case the cleaning and list
    operators must handle (null tokens, units, lists with and without spaces,
    identical items, a cancelled order with extras, a zero duration, an
    exclusion outside the recipe, a fully excluded recipe)."""
    raw_orders = spark.createDataFrame([
        (1, 11, 1, "", "", ts("2021-01-01 18:05:02")),
        (1, 11, 2, None, "null", ts("2021-01-01 18:05:02")),
        (2, 12, 1, "NULL", "3", ts("2021-01-03 09:10:00")),
        (2, 12, 1, "NULL", "3", ts("2021-01-03 09:10:00")),
        (3, 13, 2, "2, 4", "1,5", ts("2021-01-08 23:59:59")),
        (4, 11, 1, "9", "", ts("2021-01-09 00:00:01")),
        (5, 14, 1, "1, 2, 3", "", ts("2021-01-10 12:00:00")),
        (6, 12, 2, "", "2", ts("2021-01-10 12:30:00")),
    ], RAW_ORDERS_SCHEMA)
    raw_deliveries = spark.createDataFrame([
        (1, 1, "2021-01-01 18:15:01", "20km", "32 minutes", ""),
        (2, 1, "2021-01-03 09:30:45", "13.4 km", "20 mins", "null"),
        (3, 2, "2021-01-09 00:10:00", "10", "15minute", None),
        (4, 2, "2021-01-09 00:20:00", "5km", "0", "NaN"),
        (5, 3, "2021-01-10 12:25:59", "8.1", "40", None),
        (6, 3, "null", "null", "null", "Customer Cancellation"),
    ], RAW_DELIVERIES_SCHEMA)
    products = spark.createDataFrame([(1, "Meat Lovers"), (2, "Vegetarian")], "pizza_id bigint, pizza_name string")
    recipes = spark.createDataFrame([(1, "1, 2, 3"), (2, "2, 4, 5")], "pizza_id bigint, toppings string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "Cheese"), (3, "Beef"), (4, "Mushrooms"), (5, "Peppers")],
                                     "topping_id int, topping_name string")
    from tallyline.operators import orders as O
    return {
        "raw_orders": raw_orders, "raw_deliveries": raw_deliveries,
        "items": O.clean_orders(raw_orders), "deliveries": O.clean_deliveries(raw_deliveries),
        "products": products, "recipes": recipes, "toppings": toppings,
    }


TXN_SCHEMA = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"


@pytest.fixture(scope="session")
def ledger(spark):
    """Three customers over Jan-Mar 2020: same-day transactions, an unknown
    type ('fee', a credit), a zero deposit, a month without activity, a
    customer who starts in February, a negative balance and a >5% rise."""
    return spark.createDataFrame([
        (1, 1, d("2020-01-02"), "deposit", 100),
        (1, 2, d("2020-01-02"), "purchase", 30),
        (1, 3, d("2020-03-15"), "withdrawal", 100),
        (1, 4, d("2020-03-15"), "fee", 5),
        (2, 5, d("2020-02-10"), "deposit", 0),
        (2, 6, d("2020-02-20"), "deposit", 50),
        (2, 7, d("2020-03-01"), "purchase", 20),
        (3, 8, d("2020-01-05"), "deposit", 10),
        (3, 9, d("2020-02-05"), "deposit", 1),
    ], TXN_SCHEMA)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
