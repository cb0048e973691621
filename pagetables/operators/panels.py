"""The panels of a page, and what they hold besides grids and labelled rows: items, links, cards, addresses."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.operators.tree import (
    any_of,
    attr_of,
    below,
    first,
    has_class,
    let,
    node_is,
    nodes,
    pick,
    shown,
)

# The elements that carry list items, cards and addresses.
ITEM_KINDS = {
    "li": ("li",), "item": ("div", "item"), "tag": ("span", "tag"), "chip": ("div", "chip"), "badge": ("span", "badge")
}
CARD_KINDS = {
    "contact-card": ("div", "contact-card"), "card": ("div", "card"), "contact": ("div", "contact"), "row": ("div", "row")
}
ADDRESS_KINDS = {
    "address": ("address",), "address-block": ("div", "address"), "location": ("div", "location"), "row": ("div", "row")
}
ID_PREFIX = "ProfileBar-"


def is_ready() -> Column:
    """Whether a page has a panel bar at all."""
    return F.exists(nodes(), lambda x: any_of(x, ("ul", "k-panelbar"), ("li", "k-panelbar-header"), ("li", "k-panelbar-item")))


def panel_nodes(by: str) -> Column:
    """The panels of a page in order: ``'item'`` of a panel bar, or ``'id'`` (ProfileBar-n)."""
    if by == "item":
        bar = lambda x: F.when(x["up"] >= 0, F.get(nodes(), x["up"]))
        return F.filter(nodes(), lambda x: (x["tag"] == "li") & F.coalesce(node_is(bar(x), "ul", "k-panelbar"), F.lit(False)))
    return F.filter(nodes(), lambda x: F.coalesce(x["id"].startswith(ID_PREFIX), F.lit(False)))


def each_panel(
    trees: DataFrame,
    by: str,
    build: Callable[[Column], Column],
    name: str,
    keys: Sequence[str] = ("page_id",),
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """``keys, panel_pre, panel_id`` and what ``build`` makes of each panel's elements; only the panels with these ids."""
    panels = panel_nodes(by)
    if ids is not None:
        panels = F.filter(panels, lambda p: p["id"].isin(*ids))
    one = lambda p: F.struct(p["i"].alias("panel_pre"), p["id"].alias("panel_id"), build(below(p)).alias(name))
    return trees.select(*keys, F.inline(F.transform(panels, one)))


def named_items(inside: Column, kinds: Sequence[str], title: str = "", longer_than: int = 0) -> Column:
    """Texts of the list items of these kinds, minus blanks, the section's title and short ones."""
    found = F.transform(F.filter(inside, lambda x: any_of(x, *(ITEM_KINDS[k] for k in kinds))), shown)
    keep = lambda t: (F.length(t) > longer_than) & (t != title)
    return F.coalesce(F.filter(found, keep), F.array().cast("array<string>"))


def content(inside: Column, *classes: str) -> Column:
    """Text of the first content element of one of the classes."""
    hit = first(F.filter(inside, lambda x: (x["tag"] == "div") & has_class(x, *classes)))
    return F.coalesce(let(hit, lambda x: F.when(x.isNotNull(), shown(x))), F.lit(""))


def links(inside: Column) -> Column:
    """Links of a panel: ``array<struct<href, text, is_nav>>``; ``is_nav`` marks the panel's own header."""

    def one(x: Column) -> Column:
        nav = F.exists(x["cls"], lambda c: c.contains("k-link"))
        return F.struct(attr_of(x, "href").alias("href"), shown(x).alias("text"), nav.alias("is_nav"))

    return F.transform(pick(inside, "a"), one)


def crumbs(inside: Column) -> Column:
    """Texts of all breadcrumb items of a panel."""

    def of(trails: Column) -> Column:
        found = F.filter(inside, lambda x: (x["tag"] == "li") & F.exists(trails, lambda o: (o["i"] < x["i"]) & (x["i"] <= o["last"])))
        return F.transform(found, shown)

    return let(pick(nodes(), "ol", "breadcrumb"), of)


def images(inside: Column) -> Column:
    return pick(inside, "img")


def blurb(inside: Column, longer_than: int) -> Column:
    """The first descriptive text of more than so many characters."""
    found = F.filter(inside, lambda x: any_of(x, ("div", "description"), ("div", "summary"), ("p", "lead")))
    return first(F.filter(F.transform(found, shown), lambda t: F.length(t) > longer_than))


def _blocks(inside: Column, kinds: Sequence[tuple[str, ...]], made: Callable[[Column, Column], Column]) -> Column:
    """What ``made`` gives for every block of these kinds and its inside."""
    found = F.filter(inside, lambda x: any_of(x, *kinds))
    return F.transform(found, lambda b: let(below(b), lambda inner: made(b, inner)))


def _first_text(items: Column, test: Callable[[Column], Column]) -> Column:
    return let(first(F.filter(items, test)), lambda x: F.when(x.isNotNull(), shown(x)))


def cards(inside: Column, kinds: Sequence[str], wide: bool) -> Column:
    """Contact cards: ``array<struct<name, email, phone, role>>``, NULL where a card has no such element.

    The first element of each selector inside a card counts. ``wide`` also takes ``b`` for a name and ``small`` for a role.
    """

    def name(x: Column) -> Column:
        return x["tag"].isin("h4", "h5", "strong", *(["b"] if wide else [])) | has_class(x, "name")

    def role(x: Column) -> Column:
        found = has_class(x, "role", "title", "position")
        return found | (x["tag"] == "small") if wide else found

    def to(scheme: str) -> Callable[[Column], Column]:
        return lambda x: (x["tag"] == "a") & F.coalesce(attr_of(x, "href").startswith(scheme), F.lit(False))

    def card(_: Column, inner: Column) -> Column:
        tests = {"name": name, "email": to("mailto:"), "phone": to("tel:"), "role": role}
        return F.struct(*[_first_text(inner, t).alias(n) for n, t in tests.items()])

    return _blocks(inside, [CARD_KINDS[k] for k in kinds], card)


def addresses(inside: Column, kinds: Sequence[str]) -> Column:
    """Address blocks: ``array<struct<text, city, province, postal>>``."""
    tests = {"city": ("city",), "province": ("province", "state"), "postal": ("postal", "zip")}

    def block(b: Column, inner: Column) -> Column:
        parts = [_first_text(inner, lambda x: has_class(x, *c)).alias(n) for n, c in tests.items()]  # noqa: B023
        return F.struct(shown(b).alias("text"), *parts)

    return _blocks(inside, [ADDRESS_KINDS[k] for k in kinds], block)
