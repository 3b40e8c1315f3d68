"""SURVEY §5(c) invariants on the smallest test tables, checked in plain Python."""

from __future__ import annotations

from tallyline.operators import lists as LS
from tallyline.plans.catalog import Ctx

from .conftest import SF_SMALL


def _ids(text):
    out = []
    for tok in (text or "").split(","):
        tok = tok.strip()
        if tok.lstrip("+-").isdigit():
            out.append(int(tok))
    return out


def test_usage_total_equals_list_sizes(spark):
    c = Ctx(spark, SF_SMALL)
    recipes = {r["pizza_id"]: _ids(r["toppings"]) for r in c.recipes.collect()}
    known = {r["topping_id"] for r in c.toppings.collect()}
    expect = 0
    for r in c.items.collect():
        rec = set(recipes.get(r["pizza_id"], []))       # an item without a recipe uses its extras
        kept = rec - set(_ids(r["exclusions"]))
        expect += len(kept & known) + len(set(_ids(r["extras"])) & known)
    usage = LS.ingredient_usage(c.items, c.recipes, c.toppings)
    assert sum(r["times_used"] for r in usage.collect()) == expect


def test_labels_name_every_known_list_id(spark):
    """Each item's label names exactly its known exclusion and extra ids."""
    c = Ctx(spark, SF_SMALL)
    names = {r["topping_id"]: r["topping_name"] for r in c.toppings.collect()}
    labels = {(r["order_id"], r["pizza_id"], r["line_no"]): r["label"]
              for r in LS.item_label(c.items, c.toppings, c.products).collect()}
    items = LS.with_line_ids(c.items).join(c.products, "pizza_id", "left").collect()
    assert len(items) == len(labels)
    for r in items:
        parts = [r["pizza_name"]] if r["pizza_name"] else []
        ex = [names[i] for i in _ids(r["exclusions"]) if i in names]
        xt = [names[i] for i in _ids(r["extras"]) if i in names]
        if ex:
            parts.append("Exclude " + ", ".join(ex))
        if xt:
            parts.append("Extra " + ", ".join(xt))
        assert labels[(r["order_id"], r["pizza_id"], r["line_no"])] == " - ".join(parts)
