"""Every registered query runs over business-shaped tables (the fixtures)."""

from __future__ import annotations

import pytest

from tallyline.plans import business as BP
from tallyline.plans.catalog import Params

from .conftest import d, rows

PARAMS = Params(product_names=("Meat Lovers", "Vegetarian"), prices={"Meat Lovers": 12}, default_price=10,
                surcharges={"Bacon": 2}, surcharge_default=1, week_anchor="2021-01-01", new_product="Supreme",
                rate_per_km=0.3)


@pytest.fixture(scope="module")
def tables(spark, pizza, ledger):
    nodes = spark.createDataFrame([
        (1, 1, 1, d("2020-01-01"), d("2020-01-10")), (1, 1, 2, d("2020-01-11"), d("2020-01-20")),
        (1, 1, 1, d("2020-01-21"), d("9999-12-31")), (2, 2, 3, d("2020-01-05"), d("9999-12-31")),
    ], "customer_id int, region_id int, node_id int, start_date date, end_date date")
    return {
        "customer_orders": pizza["raw_orders"], "runner_orders": pizza["raw_deliveries"],
        "pizza_names": pizza["products"], "pizza_recipes": pizza["recipes"], "pizza_toppings": pizza["toppings"],
        "pizza_ratings": spark.createDataFrame([(1, 11, 3), (2, 12, 5)], "order_id bigint, customer_id bigint, rating int"),
        "runners": spark.createDataFrame([(1, d("2021-01-01")), (2, d("2021-01-03")), (3, d("2021-01-08"))],
                                         "runner_id int, registration_date date"),
        "customer_transactions": ledger.drop("txn_id"),
        "customer_nodes": nodes,
        "regions": spark.createDataFrame([(1, "North"), (2, "South")], "region_id int, region_name string"),
    }


@pytest.mark.parametrize("name", [n for n in BP.names() if not n.startswith("live_")])
def test_every_query_runs_on_business_tables(spark, tables, name):
    BP.run(spark, tables, name, PARAMS).collect()


def test_business_values(spark, tables):
    assert BP.run(spark, tables, "revenue", PARAMS).first()[0] == 80
    assert BP.run(spark, tables, "revenue_with_extras", PARAMS).first()[0] == 85
    assert rows(BP.run(spark, tables, "by_week_anchor", PARAMS)) == [(1, 2), (2, 1)]
    assert rows(BP.run(spark, tables, "by_week_us", PARAMS)) == [(1, 1), (2, 2)]
    assert BP.run(spark, tables, "realloc_avg", PARAMS).first()[0] == 10.0
    fact = BP.run(spark, tables, "delivery_fact", PARAMS).collect()
    assert {r["order_id"]: r["rating"] for r in fact}[1] == 3
    cb = rows(BP.run(spark, tables, "closing_balance", PARAMS), "customer_id", "end_date", "closing_balance")
    assert cb[2] == (1, d("2020-03-31"), -25)


def test_reference_parameters_are_the_stated_ones():
    p = BP.REFERENCE_PARAMS
    assert p.prices == {"Meatlovers": 12} and p.default_price == 10 and p.rate_per_km == 0.3
    assert p.week_anchor == "2021-01-01"
