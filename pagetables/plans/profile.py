"""Master records and captured detail pages -> profiles, errors and long-form facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import valid_link
from pagetables.operators.sections import page_sections
from pagetables.sources.html import page_trees

# Elements that sections look at, and classes that count on any element.
SECTION_TAGS = "ul ol li div section table thead tbody tr td th a span label img address p h4 h5 strong b small".split()
SECTION_CLASSES = "name role title position city province state postal zip".split()

# Meta fields: name -> master column ('' where the master has none).
META = {
    "expert": {
        "Institution": "Institution", "Name_From_List": "Name", "Expert_ID": "Expert_ID", "Profile_URL": "Profile_URL"
    },
    "facility": {
        "Institution": "Institution", "Facility_Name_From_List": "Facility_Name", "Facility_ID": "",
        "Type_From_List": "Facility_Type",
    },
    "organization": {
        "Organization_Name_From_List": "Organization_Name", "Provinces_From_List": "Provinces",
        "Sectors_From_List": "Sectors",
    },
}
NAME_COLUMN = {"expert": "Name", "facility": "Facility_Name", "organization": "Organization_Name"}


def section_trees(pages: DataFrame, carry: Sequence[str] = (), base: str | None = None) -> DataFrame:
    """Trees of detail pages with the elements that sections look at."""
    return page_trees(pages, carry, SECTION_TAGS, base, classes=SECTION_CLASSES)


def newest_pages(pages: DataFrame) -> DataFrame:
    """One capture per address: the one with the highest ``page_id``, of ``page_id, url``."""
    return pages.groupBy("url").agg(F.max("page_id").alias("page_id")).select("page_id", "url")


def meta(kind: str, scraped_at: Column) -> Column:
    """``Meta`` struct from the master columns; a missing value is ''."""
    fields = [F.col("Manage_URL").alias("Source_URL"), scraped_at.alias("Scraped_At")]
    for name, column in META[kind].items():
        fields.append((F.coalesce(F.col(column), F.lit("")) if column else F.lit("")).alias(name))
    return F.struct(*fields)


def enrich(master: DataFrame, pages: DataFrame, kind: str, scraped_at: Column) -> DataFrame:
    """Master rows that meet a captured page: ``page_id, Meta``.

    Only addresses and ids are joined here, never the markup.
    """
    known = newest_pages(pages.select("page_id", "url"))
    linked = master.filter(valid_link(F.col("Manage_URL")))
    return linked.join(known, linked["Manage_URL"] == known["url"]).select(
        "page_id", meta(kind, scraped_at).alias("Meta")
    )


def profiles(
    kind: str,
    master: DataFrame,
    pages: DataFrame,
    scraped_at: Column,
    trees: DataFrame | None = None,
    absolute_links: bool = False,
) -> DataFrame:
    """Profiles of the master rows with a ready page: ``page_id, Meta, <section> ...``.

    ``absolute_links`` completes relative links and image addresses by the page's own.

    ``trees`` may be a stored table of them; otherwise the pages are read. Older captures are read too, but only
    finished sections meet the master and its newest captures: neither markup nor nodes are ever moved.
    """
    if trees is None:
        trees = section_trees(pages, base="url" if absolute_links else None)
    return enrich(master, pages, kind, scraped_at).join(page_sections(trees, kind), "page_id")


def ready_pages(nodes: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Pages with a panel bar."""
    bar = (F.col("tag") == "ul") & F.array_contains("cls", "k-panelbar")
    header = (F.col("tag") == "li") & F.arrays_overlap(
        "cls", F.array(F.lit("k-panelbar-header"), F.lit("k-panelbar-item"))
    )
    return nodes.filter(bar | header).select(*keys).distinct()


def extraction_errors(
    kind: str, master: DataFrame, extracted: DataFrame, at: Column, url: str = "Manage_URL", index: Column | None = None
) -> DataFrame:
    """Master rows without a profile and why: ``index, name, institution, url, reason, timestamp``.

    ``extracted`` holds the addresses (column ``url``) that gave a profile. ``index`` is the row's place in the master
    list (``ordered.row_numbers`` gives one), NULL without.
    """
    done = extracted.select(F.col("url").alias(url)).distinct()
    ok = valid_link(F.col(url))
    bad = master.filter(~ok).unionByName(master.filter(ok).join(done, url, "left_anti"))
    institution = F.col("Institution") if "Institution" in master.columns else F.lit("")
    return bad.select(
        (F.lit(None) if index is None else index).cast("bigint").alias("index"),
        F.coalesce(F.col(NAME_COLUMN[kind]), F.lit("Unknown")).alias("name"),
        institution.alias("institution"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.when(ok, "Extraction failed").otherwise("No valid Manage URL").alias("reason"),
        at.alias("timestamp"),
    )


def _facts(section: str, c: Column, dtype: str) -> Column:
    """One section as ``array<struct<section,item_ord,key,value>>``."""

    def fact(item: Column, key: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), item.cast("int").alias("item_ord"), key.alias("key"), value.alias("value")
        )

    none = F.lit(None)
    if dtype == "map<string,string>":
        return F.transform(F.map_entries(c), lambda e: fact(none, e["key"], e["value"]))
    if dtype == "array<map<string,string>>":
        return F.flatten(F.transform(c, lambda m, i: F.transform(F.map_entries(m), lambda e: fact(i, e["key"], e["value"]))))
    if dtype == "array<string>":
        return F.transform(c, lambda v, i: fact(i, F.lit(""), v))
    raise ValueError(dtype)


def section_facts(df: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Profiles in long form: ``keys, section, item_ord, key, value``.

    Nested parts are named ``<section>.<part>``; ``item_ord`` is NULL for labelled rows.
    """
    parts = []
    for field in df.schema.fields:
        if field.name in keys or field.name == "Meta":
            continue
        c, kind = F.col(field.name), field.dataType.simpleString()
        if kind.startswith("struct"):
            for sub in field.dataType.fields:
                parts.append(_facts(f"{field.name}.{sub.name}", c[sub.name], sub.dataType.simpleString()))
        elif kind.startswith("array<struct"):
            names = field.dataType.elementType.names
            records = F.transform(
                c, lambda r: F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[r[n] for n in names]))  # noqa: B023
            )
            parts.append(_facts(field.name, records, "array<map<string,string>>"))
        else:
            parts.append(_facts(field.name, c, kind))
    return df.select(*keys, F.inline(F.concat(*parts)))
