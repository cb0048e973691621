"""Grid tables: rows of cells, and section grids as lists of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import icon_flag, normalize_key
from pagetables.operators.tree import (
    Fold,
    attr_of,
    below,
    entry,
    first,
    in_any,
    last_wins,
    let,
    links_in,
    node_is,
    nodes,
    pick,
    raw_text,
    shown,
    with_below,
)

def attr(name: str) -> Column:
    """Attribute of a node row."""
    return F.try_element_at("attrs", F.lit(name))


def icon_in(items: Column) -> Column:
    """The first icon among a list's elements."""
    return first(pick(items, "span", "k-icon"))


def box_in(items: Column) -> Column:
    """Whether the first checkbox among a list's elements is checked, NULL without one."""
    boxes = F.filter(items, lambda x: (x["tag"] == "input") & F.coalesce(attr_of(x, "type") == "checkbox", F.lit(False)))
    return let(first(boxes), lambda x: F.when(x.isNotNull(), attr_of(x, "checked").isNotNull()))


def listed_cell(c: Column) -> Column:
    """A cell as listings read it: ``struct<text, links, icon, box>``; texts are as shown, not cleaned."""

    def made(inner: Column) -> Column:
        icon = let(icon_in(inner), lambda i: F.when(i.isNotNull(), F.struct(attr_of(i, "title").alias("title"), i["cls"].alias("cls"))))
        return F.struct(raw_text(c).alias("text"), titled_links(inner).alias("links"), icon.alias("icon"), box_in(inner).alias("box"))

    return let(below(c), made)


def titled_links(items: Column) -> Column:
    def one(x: Column) -> Column:
        return F.struct(attr_of(x, "href").alias("href"), attr_of(x, "title").alias("title"), raw_text(x).alias("text"))

    return F.transform(pick(items, "a"), one)


def table_rows(trees: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Master rows of every page: ``keys, row_pre, n_cells, cells, links``, built where the page was read."""

    def one(r: Column) -> Column:
        def made(inner: Column) -> Column:
            cells = F.transform(pick(inner, "td"), listed_cell)
            return F.struct(r["i"].alias("row_pre"), cells.alias("cells"), titled_links(inner).alias("links"))

        return let(below(r), made)

    rows = trees.select(*keys, F.inline(F.transform(pick(nodes(), "tr", "k-master-row"), one)))
    return rows.select(*keys, "row_pre", F.size("cells").alias("n_cells"), "cells", "links")


def is_record_row(x: Column, flavor: str) -> Column:
    """Master rows; for organizations any row but detail rows."""
    if flavor == "facility":
        return node_is(x, "tr", "k-master-row")
    return (x["tag"] == "tr") & (~F.array_contains(x["cls"], "k-detail-row") | F.array_contains(x["cls"], "k-master-row"))


def is_empty_mark(x: Column) -> Column:
    return node_is(x, "tr", "k-no-data") | node_is(x, "div", "k-grid-norecords-template")


def is_visible(x: Column) -> Column:
    style = F.replace(F.coalesce(attr_of(x, "style"), F.lit("")), F.lit(" "), F.lit(""))
    return attr_of(x, "hidden").isNull() & ~F.lower(style).contains("display:none")


def tree_cells(row: Column, wide: bool = False) -> Column:
    """Cells of a row: ``array<struct<text, links, flag>>``."""

    def cell(c: Column) -> Column:
        def made(inner: Column) -> Column:
            flag = let(icon_in(inner), lambda i: icon_flag(attr_of(i, "title"), i["cls"], wide))
            return F.struct(shown(c).alias("text"), links_in(inner).alias("links"), flag.alias("flag"))

        return let(below(c), made)

    return F.transform(pick(below(row), "td"), cell)


def _cell_entries(flavor: str, name: Column, c: Column) -> Column:
    """What one grid cell adds to its record."""
    link = F.get(c["links"], F.lit(0))
    href = F.coalesce(link["href"], F.lit(""))
    named, with_url = entry(name, link["text"]), entry(F.concat(name, F.lit("_URL")), link["href"])
    linked = F.array(named, with_url)
    if flavor != "facility":
        linked = (
            F.when(href.startswith("mailto:"), F.array(entry("Email", link["text"])))
            .when(href.startswith("tel:"), F.array(entry("Phone", link["text"])))
            .when((href != "") & ~href.startswith("javascript"), linked)
            .otherwise(F.array(named))
        )
    return F.when(F.size(c["links"]) > 0, linked).otherwise(F.array(entry(name, F.coalesce(c["flag"], c["text"]))))


def grid_records(inside: Column, flavor: str, header_mode: str = "compact") -> Column:
    """Records of the first grid among the elements of a panel: ``array<map<string,string>>``, NULL without a grid.

    ``flavor`` is ``facility`` (master rows only, links always give a URL) or
    ``organization`` (any row but detail rows, mail and phone links get their own key,
    all-blank rows are dropped). ``header_mode='compact'`` names cells by the non-blank
    headers only, as the source data does; ``'positional'`` keeps blank headers in place.
    """
    drop = "?" if flavor == "organization" else ""

    def heads(inner: Column) -> Column:
        def titles(around: Column) -> Column:
            found = F.filter(inner, lambda x: (x["tag"] == "th") & in_any(around, x))
            return F.transform(found, lambda x: normalize_key(shown(x), drop))

        names = let(pick(nodes(), "thead"), titles)
        return F.filter(names, lambda h: h != "") if header_mode == "compact" else names

    def record(names: Column) -> Fold:
        def name(i: Column) -> Column:
            return F.coalesce(F.nullif(F.get(names, i), F.lit("")), F.concat(F.lit("Column_"), i))

        def made(r: Column) -> Column:
            cells = tree_cells(r, flavor == "organization")
            return last_wins(F.flatten(F.transform(cells, lambda c, i: _cell_entries(flavor, name(i), c))))

        return made

    def filled(m: Column) -> Column:
        if flavor == "facility":
            return F.size(m) > 0
        return F.exists(F.map_values(m), lambda v: F.coalesce(v, F.lit("")) != "")

    def records(g: Column) -> Column:
        def of(inner: Column) -> Column:
            def rows(bodies: Column) -> Column:
                return F.filter(inner, lambda x: is_record_row(x, flavor) & in_any(bodies, x))

            def made(names: Column) -> Column:
                return F.filter(F.transform(let(pick(nodes(), "tbody"), rows), record(names)), filled)

            return let(heads(inner), made)

        none = F.exists(with_below(g), lambda x: is_empty_mark(x) & is_visible(x))
        return F.when(none, F.array().cast("array<map<string,string>>")).when(g.isNotNull(), let(below(g), of))

    return let(first(pick(inside, "div", "k-grid")), records)


def fixed_rows(panel_id: str, grid_id: str | None, min_cells: int) -> Column:
    """Rows of a panel's grid with known columns: ``array<array<cell>>``, empty without panel or rows.

    ``grid_id`` may be None for any grid of the panel; shorter rows are left out. A panel that shows the
    no-records line has no rows.
    """

    def rows(panels: Column) -> Column:
        def of(bodies: Column) -> Column:
            def wanted(x: Column) -> Column:
                test = node_is(x, "tr", "k-master-row") & in_any(panels, x) & in_any(bodies, x)
                return test & in_any(F.filter(nodes(), lambda g: node_is(g, id=grid_id)), x) if grid_id else test

            cells = F.transform(F.filter(nodes(), wanted), lambda r: tree_cells(r))
            return F.filter(cells, lambda r: F.size(r) >= min_cells)

        none = F.exists(nodes(), lambda x: is_empty_mark(x) & in_any(panels, x))
        return F.when(~none, let(pick(nodes(), "tbody"), of))

    found = let(F.filter(nodes(), lambda x: node_is(x, id=panel_id)), rows)
    empty = F.array().cast("array<array<struct<text:string,links:array<struct<href:string,text:string>>,flag:string>>>")
    return F.coalesce(found, empty)
