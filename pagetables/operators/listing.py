"""Listing grids -> master records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.text import (
    NO_LINK,
    blank_to_null,
    clean_text,
    has_any,
    parse_flag_cell,
    parse_pager,
    strip,
    truncate,
)
from pagetables.operators.scope import enclosing, is_a, sel_is

# Where the portal's grids keep what, and the placeholder option.
EXPERT_CELLS = {"id": 1, "facility": 4, "type": 6, "position": 7, "name": 8, "min": 9}
FACILITY_CELLS = {"branch": 0, "name": 1, "type": 2, "min": 1}
ORGANIZATION_CELLS = {
    "name": 3, "provinces": 4, "sectors": 5, "requests": 6, "projects": 7, "enabled": 8, "link": 9, "min": 10
}
PLACEHOLDER = "Select HEI"


def cell(i: int) -> Column:
    """Cell ``i`` of a row, NULL when the row is shorter."""
    return F.get("cells", F.lit(i))


def plain_text(i: int) -> Column:
    return strip(cell(i)["text"])


def text(i: int) -> Column:
    return clean_text(cell(i)["text"])


def flag(i: int) -> Column:
    c = cell(i)
    return F.when(c.isNull(), "No").otherwise(parse_flag_cell(c["icon"]["title"], c["icon"]["cls"], c["box"], c["text"]))


def link_titled(title: str) -> Column:
    """Address of the row's first link with this title."""
    hit = f"get(filter(links, x -> x.title = '{title}'), 0)"
    return F.expr(f"if({hit} IS NULL, '{NO_LINK}', {hit}.href)")


def first_link(c: Column) -> Column:
    return blank_to_null(F.get(c["links"], F.lit(0))["href"])


def manage_link() -> Column:
    """First link of the last cell; else the row's first link that speaks of managing or viewing."""

    def speaks(x: Column) -> Column:
        label = F.coalesce(blank_to_null(x["title"]), x["text"])
        return has_any(x["href"]) | has_any(label)

    spoken = F.get(F.filter("links", speaks), F.lit(0))
    return F.coalesce(
        first_link(F.try_element_at("cells", F.lit(-1))),
        F.when(spoken.isNotNull(), F.coalesce(spoken["href"], F.lit(""))),
        F.lit(NO_LINK),
    )


def with_min_cells(rows: DataFrame, n: int) -> DataFrame:
    return rows.filter(F.col("n_cells") >= n)


def expert_listing(
    rows: DataFrame, institution: Column, scraped_at: Column, keep: Sequence[str] = ()
) -> DataFrame:
    at = EXPERT_CELLS
    return with_min_cells(rows, at["min"]).select(
        *keep,
        institution.alias("Institution"),
        plain_text(at["name"]).alias("Name"),
        plain_text(at["type"]).alias("Expert_Type"),
        plain_text(at["position"]).alias("Position"),
        plain_text(at["facility"]).alias("Facility"),
        plain_text(at["id"]).alias("Expert_ID"),
        link_titled("View Full Details").alias("Manage_URL"),
        link_titled("View Profile").alias("Profile_URL"),
        scraped_at.alias("Scraped_At"),
    )


def facility_listing(
    rows: DataFrame, institution: Column, scraped_at: Column, keep: Sequence[str] = ()
) -> DataFrame:
    at = FACILITY_CELLS
    return with_min_cells(rows, at["min"]).select(
        *keep,
        institution.alias("Institution"),
        plain_text(at["branch"]).alias("Branch"),
        plain_text(at["name"]).alias("Facility_Name"),
        plain_text(at["type"]).alias("Facility_Type"),
        manage_link().alias("Manage_URL"),
        scraped_at.alias("Scraped_At"),
    )


def organization_rejects(rows: DataFrame) -> DataFrame:
    """Rows the organization listing leaves out, with the reason."""
    at = ORGANIZATION_CELLS
    short = F.col("n_cells") < at["min"]
    return rows.filter(short | (text(at["name"]) == "")).withColumn(
        "reason", F.when(short, "too_few_cells").otherwise("blank_name")
    )


def organization_listing(rows: DataFrame, scraped_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    at = ORGANIZATION_CELLS
    return (
        with_min_cells(rows, at["min"])
        .filter(text(at["name"]) != "")
        .select(
            *keep,
            text(at["name"]).alias("Organization_Name"),
            text(at["provinces"]).alias("Provinces"),
            text(at["sectors"]).alias("Sectors"),
            flag(at["requests"]).alias("Requests"),
            flag(at["projects"]).alias("Projects"),
            flag(at["enabled"]).alias("Enabled"),
            F.coalesce(first_link(cell(at["link"])), F.lit(NO_LINK)).alias("Manage_URL"),
            scraped_at.alias("Scraped_At"),
        )
    )


def mapping_preview(rows: DataFrame, keys: Sequence[str] = ("page_id",), width: int = 50) -> DataFrame:
    """Texts of the first row's cells, to check the column positions by eye: ``keys, n_cells, td``."""
    first = rows.groupBy(*keys).agg(F.min_by(F.struct("n_cells", "cells"), "row_pre").alias("r"))
    return first.select(
        *keys,
        F.col("r.n_cells"),
        F.transform("r.cells", lambda c: truncate(clean_text(c["text"]), width)).alias("td"),
    )


def row_positions(rows: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Add ``row_ord``, the row's place on its page from 0 (a page bounds the window)."""
    w = Window.partitionBy(*keys).orderBy("row_pre")
    return rows.withColumn("row_ord", (F.row_number().over(w) - 1).cast("bigint"))


def dropdown_options(nodes: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Options of the open list box in order, without blanks and the placeholder: ``keys, idx, name``."""
    name = strip(F.col("text"))
    options = (
        nodes.filter((F.col("tag") == "li") & F.expr("exists(path, p -> p.sel RLIKE '^ul #[^ ]*listbox ')"))
        .withColumn("name", name)
        .filter((F.col("name") != "") & ~F.col("name").contains(PLACEHOLDER))
    )
    w = Window.partitionBy(*keys).orderBy("pre")
    return options.select(*keys, (F.row_number().over(w) - 1).cast("int").alias("idx"), "name")


def pagers(nodes: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Parsed pager of every page: ``keys, pager struct<first,last,total,parsed>``."""
    is_pager = is_a("span", "k-pager-info", "k-label")
    return (
        nodes.filter(is_pager)
        .groupBy(*keys)
        .agg(F.min_by("text", "pre").alias("t"))
        .select(*keys, parse_pager(F.col("t")).alias("pager"))
    )


def links_in_lists(nodes: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Links that sit in list items, numbered per page: ``keys, pos, href``."""
    w = Window.partitionBy(*keys).orderBy("pre")
    return (
        nodes.filter((F.col("tag") == "a") & (F.size(enclosing(sel_is("li"))) > 0))
        .withColumn("href", F.try_element_at("attrs", F.lit("href")))
        .filter(F.col("href").isNotNull())
        .select(*keys, F.row_number().over(w).cast("bigint").alias("pos"), "href")
    )
