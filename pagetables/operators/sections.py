"""Sections of a profile, as expressions on one row per page.

The row is a page's tree (``page_trees``). A section looks at one panel and is a choice among what that
holds: its grid, else its list items, else its text, and so on. Nothing is exploded or grouped, so
no section needs an exchange, and a page's nodes never leave the task that read them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import link_name, parse_flag, split_first_delim, split_list
from pagetables.operators import panels as P
from pagetables.operators.grid import fixed_rows, grid_records, icon_in
from pagetables.operators.kv import (
    EXPERT_AUDIT,
    EXPERT_DEMOGRAPHICS,
    EXPERT_DETAILS,
    EXPERT_GENERAL,
    FACILITY,
    ORGANIZATION,
    KvRules,
    fields,
)
from pagetables.operators.tree import attr_of, below, entry, first, has_class, if_filled, in_any, let, node_is, nodes, pick, shown

RECORDS, FIELDS = "array<map<string,string>>", "map<string,string>"

# Panels and grids of an expert page, and the four availability flags.
EXPERT_GRIDS = {4: ("contactsGrid", 4), 6: ("networksGrid", 2), 8: ("webGrid", 3), 9: (None, 4)}
AVAILABILITY = (
    "Can_Initiate_Innovation_Challenge",
    "Available_for_Scoping",
    "Available_for_Projects",
    "Can_be_Principal_Investigator",
)


def no_records() -> Column:
    return F.array().cast(RECORDS)


def no_fields() -> Column:
    return F.create_map().cast(FIELDS)


class Panel:
    """The ``n``-th panel of a page, or the one with an id, and the columns that ``page_sections`` makes for it.

    ``own`` holds the panel's elements, ``fields`` its labelled rows, ``grid`` the records of its first grid. Missing
    panels have no elements, rows or records.
    """

    def __init__(self, n: int, kind: str):
        self.n, self.kind = n, kind

    def held(self, column: str) -> Column:
        return F.get(column, F.lit(self.n - 1))

    @property
    def own(self) -> Column:
        return below(self.held("panels"))

    @property
    def fields(self) -> Column:
        return F.coalesce(self.held("fields"), no_fields())

    @property
    def grid(self) -> Column:
        return F.coalesce(self.held("grids"), no_records())

    @property
    def labelled(self) -> Column:
        """The labelled rows as one record, if there are any."""
        return F.when(F.size(self.fields) > 0, F.array(self.fields)).otherwise(no_records())

    def grid_or(self, other: Column) -> Column:
        return F.when(F.size(self.grid) > 0, self.grid).otherwise(F.coalesce(other, no_records()))


def record(**pairs: tuple[Column, Column]) -> Column:
    """Map of the given (value, condition) pairs whose condition holds."""
    found = [F.when(on, entry(k, v)) for k, (v, on) in pairs.items()]
    return F.map_from_entries(F.array_compact(F.array(*found)))


def put(into: Column, key: str, value: Column, when: Column) -> Column:
    """Set one key of a map where the condition holds."""
    kept = F.map_filter(into, lambda k, v: k != key)
    return F.when(when, F.map_concat(kept, F.create_map(F.lit(key), value))).otherwise(into)


def cascade(panel: Panel, kinds: Sequence[str], title: str = "", split: str = "", longer_than: int = 0) -> Column:
    """Grid records if there are any; else list items; else the split text: ``struct<rows, items>``.

    ``split``: '' for no text stage, 'comma', or 'first' for the first delimiter that occurs.
    """
    items = P.named_items(panel.own, kinds, title, longer_than)
    if split == "comma":
        items = if_filled(items, split_list(P.content(panel.own, "k-content", "panel-body")))
    elif split == "first":
        items = if_filled(items, split_first_delim(P.content(panel.own, "k-content", "panel-body", "content")))
    none = F.array().cast("array<string>")
    return F.struct(panel.grid.alias("rows"), F.when(F.size(panel.grid) > 0, none).otherwise(F.coalesce(items, none)).alias("items"))


def contacts(panel: Panel) -> Column:
    """Grid records, else one record per contact card."""
    wide = panel.kind == "organization"
    kinds = ("contact-card", "card", "contact", "row") if wide else ("contact-card", "card", "row")

    def one(c: Column) -> Column:
        filled = (lambda v: v != "") if wide else (lambda v: v.isNotNull())
        return record(
            Name=(c["name"], filled(c["name"])),
            Email=(c["email"], c["email"].isNotNull()),
            Phone=(c["phone"], c["phone"].isNotNull()),
            Role=(c["role"], filled(c["role"])),
        )

    return panel.grid_or(F.filter(F.transform(P.cards(panel.own, kinds, wide), one), lambda m: F.size(m) > 0))


def locations(panel: Panel) -> Column:
    """Grid records, else address blocks, else the labelled rows as one record."""
    kinds = ("address", "address-block", "location")
    if panel.kind == "facility":
        found = F.transform(P.addresses(panel.own, kinds), lambda b: F.create_map(F.lit("Address"), b["text"]))
    else:

        def one(b: Column) -> Column:
            return record(
                Address=(b["text"], F.lit(True)),
                City=(b["city"], b["city"].isNotNull()),
                Province=(b["province"], b["province"].isNotNull()),
                Postal_Code=(b["postal"], b["postal"].isNotNull()),
            )

        blocks = F.filter(P.addresses(panel.own, (*kinds, "row")), lambda b: F.length(b["text"]) > 5)
        found = F.transform(blocks, one)
    return panel.grid_or(if_filled(found, panel.labelled))


def web_links(panel: Panel) -> Column:
    """Grid records, else the panel's own links with a name and an address."""

    def keep(x: Column) -> Column:
        href = F.coalesce(x["href"], F.lit(""))
        usable = (href != "") & ~href.startswith("javascript")
        return usable & (href != "#") & ~x["is_nav"] if panel.kind == "organization" else usable

    def one(x: Column) -> Column:
        return F.create_map(F.lit("Name"), link_name(x["text"]), F.lit("URL"), x["href"])

    return panel.grid_or(F.transform(F.filter(P.links(panel.own), keep), one))


def activity(panel: Panel) -> Column:
    """Grid records, else the labelled rows as one record, and (organizations) project links."""
    if panel.kind == "facility":
        return panel.grid_or(panel.labelled)

    def keep(x: Column) -> Column:
        return (x["href"].contains("Project") | x["href"].contains("Request")) & (x["text"] != "")

    def one(x: Column) -> Column:
        return F.create_map(F.lit("Project_Name"), x["text"], F.lit("Project_URL"), x["href"])

    projects = F.transform(F.filter(P.links(panel.own), keep), one)
    return panel.grid_or(F.concat(panel.labelled, F.coalesce(projects, no_records())))


def trail(panel: Panel) -> Column:
    """Breadcrumb of the panel as ``a > b > c``, NULL without any."""
    items = P.crumbs(panel.own)
    joined = lambda names: F.when(F.size(names) > 0, F.array_join(F.filter(names, lambda n: n != ""), " > "))
    return let(items, joined)


def expert_general(panel: Panel) -> Column:
    image = first(F.filter(P.images(panel.own), lambda i: attr_of(i, "alt").isNotNull()))
    src = let(image, lambda i: F.when(i.isNull(), F.lit("")).otherwise(attr_of(i, "src")))
    unit = F.coalesce(F.try_element_at(panel.fields, F.lit("Academic_Unit")), trail(panel), F.lit(""))
    rest = F.map_filter(panel.fields, lambda k, v: ~k.isin("Academic_Unit", "Photo_URL"))
    full = F.map_concat(F.create_map(F.lit("Academic_Unit"), unit), rest, F.create_map(F.lit("Photo_URL"), src))
    return F.when(panel.held("panels").isNull(), no_fields()).otherwise(full)


def facility_general(panel: Panel) -> Column:
    image = first(F.filter(P.images(panel.own), lambda i: attr_of(i, "alt").isNotNull()))
    found = let(trail(panel), lambda t: put(panel.fields, "Academic_Unit_Path", t, t.isNotNull()))
    return let(image, lambda i: put(found, "Image_URL", attr_of(i, "src"), i.isNotNull()))


def organization_general(panel: Panel) -> Column:
    image = first(F.filter(P.images(panel.own), lambda i: attr_of(i, "alt").isNotNull() | has_class(i, "logo", "org-image")))
    with_image = let(attr_of(image, "src"), lambda src: put(panel.fields, "Image_URL", src, F.coalesce(src, F.lit("")) != ""))
    return let(P.blurb(panel.own, 50), lambda text: put(with_image, "Description", text, text.isNotNull()))


def fields_of(panel: Panel) -> Column:
    return panel.fields


def fields_and_rows(panel: Panel) -> Column:
    """Labelled rows together with the panel's grid: ``struct<fields, rows>``."""
    return F.struct(panel.fields.alias("fields"), panel.grid.alias("rows"))


def facility_descriptors(panel: Panel) -> Column:
    tags = P.named_items(panel.own, ("tag", "chip", "badge"))
    return F.struct(panel.fields.alias("fields"), panel.grid.alias("rows"), tags.alias("tags"))


def _cell(r: Column, i: int) -> Column:
    return F.get(r, F.lit(i))


def _text(r: Column, i: int) -> Column:
    return F.coalesce(_cell(r, i)["text"], F.lit(""))


def _link(r: Column, i: int, field: str, other: Column) -> Column:
    return F.when(F.size(_cell(r, i)["links"]) > 0, F.get(_cell(r, i)["links"], F.lit(0))[field]).otherwise(other)


def _row(**values: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in values.items()])


# Records of the expert grids, from a row ``r`` of cells.


def expertise_row(r: Column) -> Column:
    return _row(SRED_Code=_text(r, 0), Area=_text(r, 1), Discipline=_text(r, 2), Field=_text(r, 3))


def affiliation_row(r: Column) -> Column:
    return _row(Facility_Name=_text(r, 0), Is_Primary_Facility=F.coalesce(_cell(r, 1)["flag"], _text(r, 1)))


def web_row(r: Column) -> Column:
    return _row(Name=_text(r, 0), Type=_text(r, 1), URL=_link(r, 2, "href", _text(r, 2)))


def activity_row(r: Column) -> Column:
    return _row(
        Project_Name=_link(r, 0, "text", _text(r, 0)), Project_URL=_link(r, 0, "href", F.lit("")), Type=_text(r, 1),
        Organization=_text(r, 2), Current_Status=_text(r, 3),
    )


def expert_rows(panel: Panel, one: Callable[[Column], Column]) -> Column:
    """Records of one of the expert grids."""
    return F.transform(fixed_rows(f"{P.ID_PREFIX}{panel.n}", *EXPERT_GRIDS[panel.n]), one)


def availability_flags() -> Column:
    """Flags of the first availability table by position, a map."""

    def of(panels: Column) -> Column:
        return let(pick(nodes(), "tbody"), lambda bodies: in_bodies(panels, bodies))

    def in_bodies(panels: Column, bodies: Column) -> Column:
        def counts(x: Column) -> Column:
            return in_any(panels, x) & in_any(bodies, x)

        def filled(t: Column) -> Column:
            return F.exists(below(t), lambda x: ((x["tag"] == "td") | node_is(x, "span", "k-icon")) & counts(x))

        table = first(F.filter(pick(nodes(), "table", "table"), filled))
        return let(table, lambda t: let(F.transform(F.filter(pick(below(t), "td"), counts), flag), named))

    def flag(c: Column) -> Column:
        return let(icon_in(below(c)), lambda i: parse_flag(attr_of(i, "title"), i["cls"], shown(c)))

    def named(flags: Column) -> Column:
        n = F.least(F.size(flags), F.lit(len(AVAILABILITY)))
        return F.map_from_arrays(F.slice(F.array(*map(F.lit, AVAILABILITY)), 1, n), F.slice(flags, 1, n))

    return let(F.filter(nodes(), lambda x: node_is(x, id=f"{P.ID_PREFIX}5")), of)


def price_availability(panel: Panel) -> Column:
    rate = F.try_element_at(panel.fields, F.lit("PerDiemRate"))
    return F.map_concat(record(Daily_Rate=(rate, rate.isNotNull())), F.coalesce(availability_flags(), no_fields()))


# Sections of each kind of profile in order: the panel, what it takes from it, and how.
Build = Callable[[Panel], Column]
_CODES = ("li", "item", "tag", "chip", "badge")
_CHIPS = ("li", "item", "tag", "chip")

SECTIONS: dict[str, dict[str, tuple[int, str, Build]]] = {
    "expert": {
        "General_Information": (1, "fields", expert_general),
        "Details": (2, "fields", fields_of),
        "Expert_Demographics": (3, "fields", fields_of),
        "Expertise": (4, "", lambda p: expert_rows(p, expertise_row)),
        "Price_Availability": (5, "fields", price_availability),
        "Facility_Affiliation": (6, "", lambda p: expert_rows(p, affiliation_row)),
        "Web_Presence": (8, "", lambda p: expert_rows(p, web_row)),
        "Activity": (9, "", lambda p: expert_rows(p, activity_row)),
        "Audit_Trail": (10, "fields", fields_of),
    },
    "facility": {
        "General_Information": (1, "fields", facility_general),
        "Academic_Unit_Details": (2, "fields", fields_of),
        "Provinces_Served": (3, "grid", lambda p: cascade(p, ("li", "item", "tag"), "", "comma")),
        "Activities_Offered": (4, "grid", lambda p: cascade(p, _CHIPS, "Activities Offered")),
        "Sectors_Served": (5, "grid", lambda p: cascade(p, _CHIPS, "Sectors Served")),
        "Contacts": (6, "grid", contacts),
        "Locations": (7, "grid fields", locations),
        "Facility_Descriptors": (8, "grid fields", facility_descriptors),
        "Languages_Serviced": (9, "grid", lambda p: cascade(p, ("li", "tag", "chip", "badge"), "Languages Serviced", "comma")),
        "Web_Presence": (10, "grid", web_links),
        "Activity": (11, "grid fields", activity),
        "Audit_Trail": (12, "fields", fields_of),
    },
    "organization": {
        "General_Information": (1, "fields", organization_general),
        "Organization_Information": (2, "grid fields", fields_and_rows),
        "Annual_Information": (3, "grid fields", fields_and_rows),
        "NAICS_Sectors": (4, "grid", lambda p: cascade(p, _CODES, "NAICS Sectors", "first", 1)),
        "Contacts": (5, "grid", contacts),
        "Locations": (6, "grid fields", locations),
        "Languages_Serviced": (7, "grid", lambda p: cascade(p, _CODES, "Languages Serviced", "comma", 1)),
        "Web_Presence": (8, "grid", web_links),
        "Activity": (9, "grid fields", activity),
        "Audit_Trail": (10, "grid fields", fields_and_rows),
    },
}
KIND_RULES = {"facility": FACILITY, "organization": ORGANIZATION}
EXPERT_RULES = {1: EXPERT_GENERAL, 2: EXPERT_DETAILS, 3: EXPERT_DEMOGRAPHICS, 5: EXPERT_AUDIT, 10: EXPERT_AUDIT}


def panel_list(kind: str) -> Column:
    """The panels of a page at their numbers: experts' by id (NULL where one lacks), others' in order."""
    if kind != "expert":
        return P.panel_nodes("item")
    names = F.array(*[F.lit(f"{P.ID_PREFIX}{n}") for n in range(1, 11)])
    return let(P.panel_nodes("id"), lambda ps: F.transform(names, lambda name: first(F.filter(ps, lambda p: p["id"] == name))))


def panel_parts(kind: str, wanted: dict[str, tuple[int, str, Build]]) -> dict[str, Column]:
    """``fields`` and ``grids``: per panel its labelled rows and its grid's records, where a wanted section needs them."""
    need = {part: sorted({n for n, parts, _ in wanted.values() if part in parts}) for part in ("fields", "grid")}

    def for_panels(builds: dict[Callable[[Column], Column], list[int]]) -> Column:
        def one(p: Column, i: Column) -> Column:
            out = F.when(p.isNull(), None)
            for build, numbers in builds.items():
                out = out.when(i.isin(*[n - 1 for n in numbers]), build(below(p)))
            return out

        return F.transform("panels", one)

    out: dict[str, Column] = {}
    if need["fields"]:
        rules: dict[KvRules, list[int]] = {}
        for n in need["fields"]:
            rules.setdefault(EXPERT_RULES[n] if kind == "expert" else KIND_RULES[kind], []).append(n)
        out["fields"] = for_panels({functools.partial(fields, rules=r): numbers for r, numbers in rules.items()})
    if need["grid"]:
        out["grids"] = for_panels({functools.partial(grid_records, flavor=kind): need["grid"]})
    return out


def page_sections(
    trees: DataFrame, kind: str, keys: Sequence[str] = ("page_id",), only: Sequence[str] | None = None
) -> DataFrame:
    """Sections of every page that has a panel bar: ``keys, <section> ...``.

    ``trees`` has one row per page (``page_trees``). ``only`` names the sections wanted;
    what the others need is not built.
    """
    wanted = {name: SECTIONS[kind][name] for name in (only or SECTIONS[kind])}
    page = trees.where(P.is_ready()).select(*keys, "text", "nodes", panel_list(kind).alias("panels"))
    if parts := panel_parts(kind, wanted):
        page = page.withColumns(parts)
    return page.select(*keys, *[build(Panel(n, kind)).alias(name) for name, (n, _, build) in wanted.items()])
