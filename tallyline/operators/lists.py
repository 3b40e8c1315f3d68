"""List columns: recipes, extras and exclusions as rows, ingredient lists,
item labels and ingredient usage.

Inputs as in ``orders`` plus
  recipes   pizza_id, toppings   (text list of topping ids, '1, 2, 3')
  toppings  topping_id, topping_name

Scale notes: list parsing is a per-row expression (no shuffle).  Name lookups
join the topping dimension *after* the data is reduced per topping id where
the result allows it (rankings, usage).  Ingredient lists and labels are
built in the item's own row from arrays and a map of topping names (one
constant of the plan, or beyond a checked size one per distinct set of ids),
after identical items are counted.  Item line numbers count identical
items first, so no window sorts a hot order's
raw rows, and copies are regenerated in bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from .orders import delivered_items, with_id_lists

ITEM_KEYS = ["order_id", "pizza_id", "line_no"]


LINE_KEYS = ["order_id", "pizza_id"]
LINE_ORDER = ["exclusions", "extras", "customer_id", "order_time"]
EXPAND_CHUNK = 100_000
NAMES_ROWS, NAMES_CHARS = 50_000, 4_000_000     # a topping dimension that travels as one map
NAME_SALTS = 8


def line_counts(items: DataFrame) -> DataFrame:
    """Distinct item contents with ``_copies`` (how many identical items) and
    ``_first`` (the first line number of those copies).

    Line numbers count the items of one product within one order, ordered by
    the other columns.  Identical items are counted first (map-side combine),
    so the numbering window sorts distinct contents only: an order holding a
    huge number of identical items costs one row here, not one per item.
    """
    order = LINE_ORDER + [c for c in items.columns if c not in LINE_KEYS + LINE_ORDER]
    counts = items.groupBy(*LINE_KEYS, *order).agg(F.count("*").alias("_copies"))
    w = Window.partitionBy(*LINE_KEYS).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_first", F.coalesce(F.sum("_copies").over(w), F.lit(0)) + 1)


def expand_lines(df: DataFrame, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """One row per copy with its ``line_no``; copies are generated in chunks of
    at most ``chunk`` numbers, so no single array holds a huge group."""
    keep = [c for c in df.columns if c not in ("_copies", "_first")]
    parts = df.select(*keep, "_first", "_copies",
                      F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.floor((F.col("_copies") - 1) / chunk).cast("bigint"))).alias("_chunk"))
    lo = F.col("_first") + F.col("_chunk") * chunk
    hi = F.least(F.col("_first") + F.col("_copies") - 1, lo + chunk - 1)
    return parts.select(*keep, F.explode(F.sequence(lo, hi)).alias("_line")) \
                .select(*keep, F.col("_line").cast("int").alias("line_no"))


def with_line_ids(items: DataFrame) -> DataFrame:
    """Items with their identity (order_id, pizza_id, line_no); identical
    items get distinct numbers."""
    return expand_lines(line_counts(items)).select(*items.columns, "line_no")


def parse_recipes(recipes: DataFrame) -> DataFrame:
    return recipes.select("pizza_id", C.parse_id_list("toppings").alias("recipe_ids"))


def explode_recipe(recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """One row per (product, topping) with the topping's name."""
    rows = recipes.select("pizza_id", F.explode(C.split_tokens("toppings")).alias("tok")) \
                  .select("pizza_id", C.to_int("tok").alias("topping_id")) \
                  .filter(F.col("topping_id").isNotNull())
    return rows.join(toppings, "topping_id").select("pizza_id", "topping_id", "topping_name")


def explode_ids(items: DataFrame, list_col: str, out_col: str) -> DataFrame:
    """One row per list element of each item; an item with an empty list keeps
    one row with a NULL id (as splitting '' yields one blank element)."""
    lc = line_counts(items)
    rows = lc.select(*LINE_KEYS, "_first", "_copies", F.explode(C.split_tokens(list_col)).alias("tok")) \
             .select(*LINE_KEYS, "_first", "_copies", C.to_int("tok").alias(out_col))
    return expand_lines(rows).select(*ITEM_KEYS, out_col)


def recipe_list(recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Standard ingredients per product, names sorted, ', '-separated."""
    return explode_recipe(recipes, toppings).groupBy("pizza_id").agg(
        F.array_join(F.array_sort(F.collect_list("topping_name")), ", ").alias("standard_ingredients"))


def token_rank(items: DataFrame, list_col: str, toppings: DataFrame, count_col: str,
               top: int | None = None, deliveries: DataFrame | None = None) -> DataFrame:
    """How often each topping appears in a list column, most frequent first.

    Counts are reduced per id before the name join; ``top`` keeps the first
    rows (ties broken by name).
    """
    src = items if deliveries is None else delivered_items(items, deliveries)
    ids = src.select(F.explode(C.parse_id_list(list_col)).alias("topping_id"))
    per_id = ids.groupBy("topping_id").agg(F.count("*").alias("n"))
    ranked = (per_id.join(toppings, "topping_id").groupBy("topping_name")
              .agg(F.sum("n").alias(count_col)).orderBy(F.desc(count_col), "topping_name"))
    return ranked.limit(top) if top else ranked


def _small(toppings: DataFrame) -> bool:
    """Whether the dimension, counted, fits the bounds of a constant map."""
    n, chars = toppings.agg(F.count("*"), F.coalesce(F.sum(F.length("topping_name")), F.lit(0))).first()
    return n <= NAMES_ROWS and chars <= NAMES_CHARS


def with_names(items: DataFrame, lists: list[str], toppings: DataFrame, small: bool | None = None) -> DataFrame:
    """``items`` with ``_names``, a MAP id -> name that holds the ids of its ``lists``.

    A dimension within ``NAMES_ROWS`` and ``NAMES_CHARS`` is one map, a constant
    of the plan.  A larger one is joined: every distinct set of ids is exploded
    once, its ids meet the names (an id that most sets hold is spread over
    ``NAME_SALTS`` parts), and the set's own map comes back to the items.  The
    result is the same; ``small`` picks a way instead of the count."""
    entry = F.struct(F.col("topping_id").cast("bigint"), "topping_name")
    if _small(toppings) if small is None else small:
        return items.withColumn("_names", toppings.agg(F.map_from_entries(F.collect_list(entry))).scalar())
    ids = items.withColumn("_ids", F.array_sort(F.array_distinct(F.concat(*lists))))
    pairs = ids.select("_ids").distinct().select("_ids", F.explode("_ids").alias("topping_id")).withColumn(
        "_salt", F.pmod(F.xxhash64("_ids"), F.lit(NAME_SALTS)).cast("int"))
    salted = toppings.select(F.col("topping_id").cast("bigint").alias("topping_id"), "topping_name",
                             F.explode(F.sequence(F.lit(0), F.lit(NAME_SALTS - 1))).alias("_salt"))
    maps = pairs.join(salted, ["topping_id", "_salt"]).groupBy("_ids").agg(F.map_from_entries(F.collect_list(entry)).alias("_names"))
    return ids.join(maps, "_ids", "left").drop("_ids")


def _expanded(items: DataFrame, out: Column, name: str, columns: list[str]) -> DataFrame:
    """``out`` for every item with its line number; ``items`` is line_counts
    joined with what ``out`` needs."""
    return expand_lines(items.select(*columns, "_first", "_copies", out.alias(name))).select(*ITEM_KEYS, *columns[2:], name)


def ingredient_list(items: DataFrame, recipes: DataFrame, toppings: DataFrame, products: DataFrame,
                    as_written: bool = False, small: bool | None = None) -> DataFrame:
    """'Name: 2xa, b, c' per item.

    Default (the question's reading): toppings = recipe minus exclusions plus
    extras (extras outside the recipe included), sorted by name, '2x' when a
    topping is both kept from the recipe and added as an extra; every item is
    listed, also one without a recipe or product row.  ``as_written``: only
    recipe toppings that are not excluded, in recipe order, '2x' when also an
    extra; extras outside the recipe are dropped, and an item whose recipe is
    missing or fully excluded disappears.

    Lists are built in the item's row: one scan of the items, one shuffle for
    their line numbers and the joins to products and recipes.
    """
    how = "inner" if as_written else "left"
    j = with_id_lists(line_counts(items)).join(products.select("pizza_id", "pizza_name"), "pizza_id", how).join(
        parse_recipes(recipes), "pizza_id", how)
    recipe = F.coalesce("recipe_ids", F.array().cast("array<bigint>"))
    j = with_names(j.withColumn("recipe_ids", recipe), ["recipe_ids", "extra_ids"], toppings, small)
    name = lambda x: F.try_element_at("_names", x)
    kept = lambda x: F.array_contains("recipe_ids", x) & ~F.array_contains("exclusion_ids", x)
    if as_written:
        ids = F.filter(F.filter("recipe_ids", lambda x: ~F.array_contains("exclusion_ids", x)), lambda x: name(x).isNotNull())
        labels = F.transform(ids, lambda x: F.when(F.array_contains("extra_ids", x), F.concat(F.lit("2x"), name(x))).otherwise(name(x)))
        j = j.withColumn("_labels", labels).filter(F.size("_labels") > 0)
    else:
        ids = F.filter(F.array_distinct(F.concat("recipe_ids", "extra_ids")),
                       lambda x: (kept(x) | F.array_contains("extra_ids", x)) & name(x).isNotNull())
        pairs = F.array_sort(F.transform(ids, lambda x: F.struct(name(x).alias("n"), (kept(x) & F.array_contains("extra_ids", x)).alias("twice"))))
        j = j.withColumn("_labels", F.transform(pairs, lambda p: F.when(p["twice"], F.concat(F.lit("2x"), p["n"])).otherwise(p["n"])))
    # CONCAT semantics of the original: a missing name leaves just the list
    text = F.concat_ws("", F.concat(F.col("pizza_name"), F.lit(": ")), F.array_join("_labels", ", "))
    return _expanded(j, text, "ingredients_list", [*LINE_KEYS, "customer_id", "order_time"])


def item_label(items: DataFrame, toppings: DataFrame, products: DataFrame, small: bool | None = None) -> DataFrame:
    """'Name - Exclude a, b - Extra c, d' per item (parts without names vanish);
    list names keep the order written in the item's lists.  An item without a
    product row has a label without the name."""
    j = with_id_lists(line_counts(items)).join(products.select("pizza_id", "pizza_name"), "pizza_id", "left")
    j = with_names(j, ["exclusion_ids", "extra_ids"], toppings, small)

    def part(ids: str, word: str):
        names = F.filter(F.transform(ids, lambda x: F.try_element_at("_names", x)), lambda x: x.isNotNull())
        return F.when(F.size(names) > 0, F.concat(F.lit(word + " "), F.array_join(names, ", ")))

    text = F.concat_ws(" - ", "pizza_name", part("exclusion_ids", "Exclude"), part("extra_ids", "Extra"))
    return _expanded(j, text, "label", LINE_KEYS)


def ingredient_usage(items: DataFrame, recipes: DataFrame, toppings: DataFrame,
                     deliveries: DataFrame | None = None, as_written: bool = False) -> DataFrame:
    """Total quantity of each topping used, most used first.

    Items are first counted per (product, exclusions, extras) -- usage is
    additive, so identical items are weighed instead of repeated -- and sums
    are reduced per topping id before the name join.

    ``as_written``: all items; per recipe topping 2 if it is an extra, else 0
    if excluded, else 1; extras outside the recipe are not counted.
    Default: delivered items (when ``deliveries`` is given); per topping
    (kept from the recipe ? 1 : 0) + (extra ? 1 : 0); an item without a recipe
    uses its extras.
    """
    src = items if deliveries is None else delivered_items(items, deliveries)
    grouped = src.groupBy("pizza_id", "exclusions", "extras").agg(F.count("*").alias("cnt"))
    g = with_id_lists(grouped).join(parse_recipes(recipes), "pizza_id", "inner" if as_written else "left")
    g = g.withColumn("recipe_ids", F.coalesce("recipe_ids", F.array().cast("array<bigint>")))
    tid = F.col("topping_id")
    if as_written:
        rows = g.select("cnt", "exclusion_ids", "extra_ids", F.explode("recipe_ids").alias("topping_id"))
        n = (F.when(F.array_contains("extra_ids", tid), 2)
              .when(F.array_contains("exclusion_ids", tid), 0).otherwise(1))
    else:
        rows = g.select("cnt", "recipe_ids", "exclusion_ids", "extra_ids",
                        F.explode(F.array_distinct(F.concat("recipe_ids", "extra_ids"))).alias("topping_id"))
        n = ((F.array_contains("recipe_ids", tid) & ~F.array_contains("exclusion_ids", tid)).cast("int")
             + F.array_contains("extra_ids", tid).cast("int"))
    per_id = rows.groupBy("topping_id").agg(F.sum(n * F.col("cnt")).alias("n"))
    return (per_id.join(toppings, "topping_id").groupBy("topping_name")
            .agg(F.sum("n").alias("times_used")).orderBy(F.desc("times_used"), "topping_name"))
