from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import lists as LS

from .conftest import rows


def test_line_ids_distinguish_identical_items(pizza):
    got = rows(LS.with_line_ids(pizza["items"]).filter("order_id = 2"), "order_id", "pizza_id", "line_no")
    assert got == [(2, 1, 1), (2, 1, 2)]


def test_explode_recipe_and_list(pizza):
    assert rows(LS.explode_recipe(pizza["recipes"], pizza["toppings"]), "pizza_id", "topping_id") == [
        (1, 1), (1, 2), (1, 3), (2, 2), (2, 4), (2, 5)]
    assert rows(LS.recipe_list(pizza["recipes"], pizza["toppings"])) == [
        (1, "Bacon, Beef, Cheese"), (2, "Cheese, Mushrooms, Peppers")]


def test_explode_ids_keeps_blank_rows(pizza):
    ex = LS.explode_ids(pizza["items"], "extras", "extra_id")
    assert ex.count() == 8 + 1          # one row per item, two for '1,5'
    assert rows(ex.filter("order_id = 3"), "extra_id") == [(1,), (5,)]
    assert ex.filter("extra_id IS NULL").count() == 4


def test_token_rank(pizza):
    got = rows(LS.token_rank(pizza["items"], "extras", pizza["toppings"], "extra_count"))
    assert got == [("Bacon", 1), ("Beef", 2), ("Cheese", 1), ("Peppers", 1)]
    top = LS.token_rank(pizza["items"], "extras", pizza["toppings"], "extra_count", top=1).collect()
    assert [tuple(r) for r in top] == [("Beef", 2)]


def _lists(df):
    return sorted((r["order_id"], r["line_no"], r["ingredients_list"]) for r in df.collect())


def test_ingredient_list_brief(pizza):
    got = _lists(LS.ingredient_list(pizza["items"], pizza["recipes"], pizza["toppings"], pizza["products"]))
    assert got == [
        (1, 1, "Meat Lovers: Bacon, Beef, Cheese"),
        (1, 1, "Vegetarian: Cheese, Mushrooms, Peppers"),
        (2, 1, "Meat Lovers: Bacon, 2xBeef, Cheese"),
        (2, 2, "Meat Lovers: Bacon, 2xBeef, Cheese"),
        (3, 1, "Vegetarian: Bacon, 2xPeppers"),
        (4, 1, "Meat Lovers: Bacon, Beef, Cheese"),
        (5, 1, "Meat Lovers: "),
        (6, 1, "Vegetarian: 2xCheese, Mushrooms, Peppers"),
    ]


def test_ingredient_list_as_written(pizza):
    got = _lists(LS.ingredient_list(pizza["items"], pizza["recipes"], pizza["toppings"], pizza["products"],
                                    as_written=True))
    assert got == [
        (1, 1, "Meat Lovers: Bacon, Cheese, Beef"),
        (1, 1, "Vegetarian: Cheese, Mushrooms, Peppers"),
        (2, 1, "Meat Lovers: Bacon, Cheese, 2xBeef"),
        (2, 2, "Meat Lovers: Bacon, Cheese, 2xBeef"),
        (3, 1, "Vegetarian: 2xPeppers"),
        (4, 1, "Meat Lovers: Bacon, Cheese, Beef"),
        (6, 1, "Vegetarian: 2xCheese, Mushrooms, Peppers"),
    ]


def test_item_label(pizza):
    got = sorted((r["order_id"], r["line_no"], r["label"]) for r in
                 LS.item_label(pizza["items"], pizza["toppings"], pizza["products"]).collect())
    assert (3, 1, "Vegetarian - Exclude Cheese, Mushrooms - Extra Bacon, Peppers") in got
    assert (4, 1, "Meat Lovers") in got
    assert (5, 1, "Meat Lovers - Exclude Bacon, Cheese, Beef") in got
    assert (2, 2, "Meat Lovers - Extra Beef") in got
    assert len(got) == 8


def test_ingredient_usage(pizza):
    brief = dict(rows(LS.ingredient_usage(pizza["items"], pizza["recipes"], pizza["toppings"], pizza["deliveries"])))
    assert brief == {"Bacon": 5, "Cheese": 5, "Beef": 6, "Mushrooms": 1, "Peppers": 3}
    as_written = dict(rows(LS.ingredient_usage(pizza["items"], pizza["recipes"], pizza["toppings"],
                                               as_written=True)))
    assert as_written == {"Bacon": 4, "Cheese": 7, "Beef": 6, "Mushrooms": 2, "Peppers": 4}


def test_usage_is_additive_over_identical_items(spark, pizza):
    """Doubling every item doubles every usage count (pre-aggregation check)."""
    items = pizza["items"]
    once = dict(rows(LS.ingredient_usage(items, pizza["recipes"], pizza["toppings"])))
    twice = dict(rows(LS.ingredient_usage(items.unionByName(items), pizza["recipes"], pizza["toppings"])))
    assert twice == {k: 2 * v for k, v in once.items()}


def test_line_ids_chunked_expansion(spark):
    """Many identical items in one order: numbered 1..n without gaps, also when
    the copies are generated in several chunks."""
    from pyspark.sql import functions as F
    items = spark.range(0, 23).select(
        F.lit(7).cast("bigint").alias("order_id"), F.lit(1).cast("bigint").alias("customer_id"),
        F.lit(3).cast("bigint").alias("pizza_id"),
        F.when(F.col("id") < 20, F.lit("")).otherwise(F.lit("2")).alias("exclusions"),
        F.lit("").alias("extras"), F.lit("2021-01-01 00:00:00").cast("timestamp_ntz").alias("order_time"))
    lc = LS.line_counts(items)
    assert sorted(r["line_no"] for r in LS.expand_lines(lc, chunk=3).collect()) == list(range(1, 24))
    got = rows(LS.expand_lines(lc, chunk=3), "exclusions", "line_no")
    assert got[:2] == [("", 1), ("", 2)] and got[-1] == ("2", 23)


def test_items_without_product_or_recipe_rows_stay(spark, pizza):
    raw = spark.createDataFrame([(1, 1, 1, "", "2"), (1, 1, 8, "1", "2"), (1, 1, 9, "", "")],
                                "order_id bigint, customer_id bigint, pizza_id bigint, exclusions string, extras string")
    items = raw.withColumn("order_time", F.lit("2021-01-01 00:00:00").cast("timestamp_ntz"))
    products = pizza["products"].unionByName(spark.createDataFrame([(9, "Plain")], "pizza_id bigint, pizza_name string"))
    got = {r["pizza_id"]: r["ingredients_list"] for r in LS.ingredient_list(items, pizza["recipes"], pizza["toppings"], products).collect()}
    assert got == {1: "Meat Lovers: Bacon, Beef, 2xCheese", 8: "Cheese", 9: "Plain: "}
    got = {r["pizza_id"]: r["label"] for r in LS.item_label(items, pizza["toppings"], products).collect()}
    assert got == {1: "Meat Lovers - Extra Cheese", 8: "Exclude Bacon - Extra Cheese", 9: "Plain"}
    used = dict(rows(LS.ingredient_usage(items, pizza["recipes"], pizza["toppings"])))
    assert used == {"Bacon": 1, "Beef": 1, "Cheese": 3}
    written = LS.ingredient_list(items, pizza["recipes"], pizza["toppings"], products, as_written=True)
    assert [r["pizza_id"] for r in written.collect()] == [1]


def test_lists_with_joined_names_equal_those_with_one_map(pizza, monkeypatch):
    p, args = pizza, ("recipes", "toppings", "products")

    def both(op, key):
        one, joined = (sorted((r["order_id"], r["pizza_id"], r["line_no"], r[key]) for r in op(small).collect()) for small in (True, False))
        assert one == joined and one

    for as_written in (False, True):
        both(lambda s: LS.ingredient_list(p["items"], *[p[a] for a in args], as_written=as_written, small=s), "ingredients_list")
    both(lambda s: LS.item_label(p["items"], p["toppings"], p["products"], small=s), "label")
    monkeypatch.setattr(LS, "NAMES_ROWS", 3)          # counted: five toppings are too many for one map
    plan = LS.item_label(p["items"], p["toppings"], p["products"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "scalar-subquery" not in plan


def test_joined_names_of_items_without_lists(pizza):
    items = pizza["items"].withColumn("extras", F.lit(None).cast("string")).withColumn("exclusions", F.lit(""))
    got = {r["label"] for r in LS.item_label(items, pizza["toppings"], pizza["products"], small=False).collect()}
    assert got == {"Meat Lovers", "Vegetarian"}
    none = LS.item_label(items, pizza["toppings"].limit(0), pizza["products"], small=False)
    assert none.count() == items.count()
