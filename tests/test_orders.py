from __future__ import annotations

from tallyline.operators import orders as O
from tallyline.operators import pricing as PR

from .conftest import rows, ts

PRICES = {"Meat Lovers": 12}


def test_clean_deliveries(pizza):
    got = rows(pizza["deliveries"], "order_id", "pickup_time", "distance", "duration", "cancellation")
    assert got == [
        (1, ts("2021-01-01 18:15:01"), 20.0, 32, None),
        (2, ts("2021-01-03 09:30:45"), 13.4, 20, None),
        (3, ts("2021-01-09 00:10:00"), 10.0, 15, None),
        (4, ts("2021-01-09 00:20:00"), 5.0, 0, None),
        (5, ts("2021-01-10 12:25:59"), 8.1, 40, None),
        (6, None, None, None, "Customer Cancellation"),
    ]


def test_clean_orders_blanks(pizza):
    got = rows(pizza["items"], "order_id", "pizza_id", "exclusions", "extras")
    assert (1, 2, "", "") in got and (2, 1, "", "3") in got and (3, 2, "2, 4", "1,5") in got


def test_counts(pizza):
    it, dl = pizza["items"], pizza["deliveries"]
    assert O.items_ordered(it).first()[0] == 8
    assert O.distinct_customers(it).first()[0] == 4
    assert O.distinct_orders(it).first()[0] == 6
    assert rows(O.orders_per_courier(dl)) == [(1, 2), (2, 2), (3, 1)]
    assert rows(O.orders_per_courier(dl, successful_only=False)) == [(1, 2), (2, 2), (3, 2)]
    assert O.max_items_per_order(it, dl).first()[0] == 2


def test_product_mix(pizza):
    got = rows(O.product_mix(pizza["items"], pizza["products"], ["Meat Lovers", "Vegetarian"]))
    assert got == [(11, 2, 1), (12, 2, 1), (13, 0, 1), (14, 1, 0)]


def test_change_split_readings_differ(pizza):
    brief = rows(O.change_split(pizza["items"], pizza["deliveries"]))
    assert brief == [(11, 1, 2), (12, 2, 0), (13, 1, 0), (14, 1, 0)]
    as_written = rows(O.change_split(pizza["items"], pizza["deliveries"], as_written=True))
    assert as_written == [(11, 3, 0), (12, 3, 0), (13, 1, 0), (14, 1, 0)]
    assert O.both_changes(pizza["items"], pizza["deliveries"]).first()[0] == 1


def test_pickup_and_prep(pizza):
    assert rows(O.pickup_minutes(pizza["items"], pizza["deliveries"])) == [(1, 15), (2, 15), (3, 25)]
    # order sizes: o1 2 items (10 min), o2 2 items (20), o3..o5 1 item (11, 20, 25)
    assert rows(O.prep_by_size(pizza["items"], pizza["deliveries"])) == [(1, 18), (2, 15)]


def test_speed_zero_duration_and_half_up(pizza):
    got = rows(O.speed(pizza["items"], pizza["deliveries"]), "order_id", "avg_speed", "number_of_pizza")
    assert got == [(1, 37.5, 2), (2, 40.2, 2), (3, 40.0, 1), (4, None, 1), (5, 12.2, 1)]


def test_avg_distance(pizza):
    # customer 11: o1 (2 items, 20 km) + o4 (1 item, 5 km): per item 15.0, per order 12.5
    per_item = dict(rows(O.avg_distance(pizza["items"], pizza["deliveries"], per="item")))
    per_order = dict(rows(O.avg_distance(pizza["items"], pizza["deliveries"])))
    assert per_item[11] == 15.0 and per_order[11] == 12.5
    # customer 12: o2 (2 items, 13.4) and cancelled o6 (NULL distance ignored)
    assert per_item[12] == 13.4


def test_success_pct(pizza):
    assert rows(O.success_pct(pizza["deliveries"])) == [(1, 2, 2, 100.0), (2, 2, 2, 100.0), (3, 2, 1, 50.0)]
    assert rows(O.success_pct(pizza["deliveries"], as_written=True)) == [(1, 2, 2, 100), (2, 2, 2, 100),
                                                                         (3, 2, 1, 50)]


def test_revenue_and_extras(pizza):
    it, dl, pr, tp = pizza["items"], pizza["deliveries"], pizza["products"], pizza["toppings"]
    assert PR.revenue(it, dl, pr, PRICES, 10).first()[0] == 80
    assert PR.revenue_with_extras(it, dl, pr, tp, PRICES, 10, {"Bacon": 2}).first()[0] == 85
    assert PR.revenue_with_extras(it, dl, pr, tp, PRICES, 10, {"Bacon": 2}, as_written=True).first()[0] == 86
    net = PR.net_after_pay(it, dl, pr, PRICES, 10, 0.3).first()
    assert net["revenue"] == 80 and abs(net["runners_paid"] - 16.95) < 1e-9
    assert abs(net["change_left"] - 63.05) < 1e-9


def test_delivery_fact(pizza):
    it, dl = pizza["items"], pizza["deliveries"]
    fact = PR.delivery_fact(it, dl, PR.ratings(it, dl))
    got = rows(fact, "order_id", "mins_difference", "pizza_count", "avg_speed")
    assert got == [(1, 10, 2, 37.5), (2, 20, 2, 40.2), (3, 11, 1, 40.0), (4, 20, 1, None), (5, 25, 1, 12.2)]
    assert fact.filter("rating IS NULL").count() == 0


def test_append_product(pizza):
    names, recipes = PR.append_product(pizza["products"], pizza["recipes"].filter("pizza_id = 1"), pizza["toppings"], "Supreme")
    # the product without a recipe stays
    assert rows(names) == [(1, "Meat Lovers"), (2, "Vegetarian"), (3, "Supreme")]
    assert rows(recipes) == [(1, "1, 2, 3"), (3, "1, 2, 3, 4, 5")]


def test_speed_rounding_is_symmetric(spark):
    df = spark.createDataFrame([(8.1, 40), (-8.1, 40), (8.1, -40), (7.3, 40), (1.0, 0)], "distance double, duration int")
    got = [r[0] for r in df.select(O.speed_kmh()).collect()]
    assert got == [12.2, -12.2, -12.2, 11.0, None]


def test_append_product_with_given_id(pizza):
    names, recipes = PR.append_product(pizza["products"], pizza["recipes"], pizza["toppings"], "Supreme", new_id=9)
    assert rows(names)[-1] == (9, "Supreme") and rows(recipes)[-1] == (9, "1, 2, 3, 4, 5")


def test_distances_are_rounded_once(spark):
    """0.745 km in 3 min is 14.9 km/h; means of 0.745 and 5.0496 are 0.7 and 5.0."""
    df = spark.createDataFrame([(0.745, 3)], "distance double, duration int")
    assert df.select(O.speed_kmh()).first()[0] == 14.9
    items = spark.createDataFrame([(1, 1), (2, 2)], "order_id bigint, customer_id bigint")
    raw = spark.createDataFrame([(1, "0.745 km"), (2, "5.0496km")], "order_id bigint, distance string")
    from tallyline.functions import clean as C
    deliveries = raw.select("order_id", C.parse_number("distance", C.DISTANCE_UNITS).alias("distance"))
    assert rows(O.avg_distance(items, deliveries)) == [(1, 0.7), (2, 5.0)]


def test_product_mix_keeps_customers_without_catalogue_rows(spark):
    items = spark.createDataFrame([(1, 7, 1), (2, 8, 99)], "order_id bigint, customer_id bigint, pizza_id bigint")
    products = spark.createDataFrame([(1, "A")], "pizza_id bigint, pizza_name string")
    assert rows(O.product_mix(items, products, ["A"])) == [(7, 1), (8, 0)]


def _deliveries(spark, cancelled):
    return spark.createDataFrame([(1, 1, 10.0, cancelled)], "order_id bigint, runner_id int, distance double, cancellation string")


def test_net_after_pay_pays_for_successful_orders(spark, pizza):
    items = pizza["items"].filter("order_id = 1")
    paid = lambda c, **k: PR.net_after_pay(items, _deliveries(spark, c), pizza["products"], {"Meat Lovers": 12}, 10, **k).first()
    assert tuple(paid("Customer Cancellation")) == (0, 0.0, 0.0)
    assert tuple(paid("Customer Cancellation", as_written=True)) == (None, 3.0, None)
    assert tuple(paid(None)) == (22, 3.0, 19.0)


def test_given_ratings_are_used(spark, pizza):
    ratings = spark.createDataFrame([(1, 11, 3)], "order_id bigint, customer_id bigint, rating int")
    fact = PR.delivery_fact(pizza["items"], pizza["deliveries"], ratings)
    assert {r["order_id"]: r["rating"] for r in fact.collect()}[1] == 3
