"""Labelled rows -> key/value pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import blank_to_null, normalize_key, parse_flag, rating
from pagetables.operators.grid import icon_in
from pagetables.operators.tree import (
    attr_of,
    below,
    entry,
    first,
    has_class,
    holds,
    last_wins,
    let,
    links_in,
    node_is,
    pick,
    shown,
)


@dataclass(frozen=True)
class KvRules:
    """How a kind of page writes its labelled rows.

    ``columns``: classes of the value column. ``other``: which column to take when none has
    them: '' for none, 'any' for the first that does not hold the label, 'with_text' or
    'with_content' for the first such that is not blank. ``values``: 'text' (the text only),
    'first_link', 'all_links' or 'expert_general'.
    """

    columns: tuple[str, ...]
    other: str = ""
    values: str = "text"
    key_drop: str = ""
    key_from_for: bool = True
    keep_blank: bool = True


# The value columns of each kind of page.
EXPERT_GENERAL = KvRules((), other="with_content", values="expert_general")
EXPERT_DETAILS = KvRules(("col-md-9", "col-md-7"))
EXPERT_DEMOGRAPHICS = KvRules(("col-md-7", "col-md-9"), key_from_for=False)
EXPERT_AUDIT = KvRules(("col-md-9",))
FACILITY = KvRules(
    ("col-md-9", "col-md-7", "col-md-8", "col-md-10"), other="any", values="first_link", key_drop=":"
)
ORGANIZATION = KvRules(
    ("col-md-9", "col-md-7", "col-md-8", "col-md-10", "col-md-6"),
    other="with_text", values="all_links", key_drop=":", keep_blank=False,
)


def is_col(x: Column) -> Column:
    return (x["tag"] == "div") & F.exists(x["cls"], lambda c: c.contains("col-"))


def labelled_rows(inside: Column) -> Column:
    """Rows among a panel's elements that hold a label: ``array<struct<label, cols>>``, of nodes."""

    def parts(r: Column) -> Column:
        return let(below(r), lambda inner: F.struct(first(pick(inner, "label")).alias("label"), F.filter(inner, is_col).alias("cols")))

    return F.filter(F.transform(pick(inside, "div", "row"), parts), lambda q: q["label"].isNotNull())


def value_column(rules: KvRules, q: Column) -> Column:
    """The column of a labelled row that holds its value, NULL if there is none."""
    named = first(F.filter(q["cols"], lambda c: has_class(c, *(rules.columns or ("",)))))
    if not rules.other:
        return named

    def free(c: Column) -> Column:
        out = ~holds(c, q["label"])
        if rules.other == "with_text":
            out = out & (shown(c) != "")
        elif rules.other == "with_content":
            held = F.exists(below(c), lambda x: (x["tag"] == "a") | node_is(x, "span", "k-icon"))
            out = out & F.exists(c["cls"], lambda n: n.contains("col-md")) & ((shown(c) != "") | held)
        return out

    return F.coalesce(named, first(F.filter(q["cols"], free)))


def field_key(rules: KvRules, label: Column) -> Column:
    from_text = normalize_key(shown(label), rules.key_drop)
    return F.coalesce(blank_to_null(attr_of(label, "for")), from_text) if rules.key_from_for else from_text


def trail_in(items: Column) -> Column:
    """The items of the first breadcrumb among some elements as ``a > b > c``, NULL without one."""

    def joined(trail: Column) -> Column:
        names = F.filter(F.transform(pick(below(trail), "li"), shown), lambda n: n != "")
        return F.when(trail.isNotNull(), F.array_join(names, " > "))

    filled = F.filter(pick(items, "ol", "breadcrumb"), lambda o: F.size(pick(below(o), "li")) > 0)
    return let(first(filled), joined)


def _entries(rules: KvRules, q: Column) -> Column:
    """Entries that a row contributes, from its label and value column."""
    general, wide = rules.values == "expert_general", rules.values == "all_links"

    def of(inner: Column) -> Column:
        icon, rated = icon_in(inner), first(pick(inner, "span", "k-rating"))
        target = attr_of(q["label"], "for")
        held = F.struct(
            field_key(rules, q["label"]).alias("name"), target.alias("target"), shown(q["val"]).alias("text"),
            links_in(inner).alias("links"), icon.alias("icon"), rated.alias("rated"),
            (trail_in(inner) if wide else F.lit(None).cast("string")).alias("trail"),
        )
        return let(held, made)

    def made(h: Column) -> Column:
        name, text = h["name"], h["text"]
        plain = F.array(entry(name, text))
        if rules.values == "text":
            return plain
        flag = parse_flag(attr_of(h["icon"], "title"), h["icon"]["cls"], text, wide)
        score = rating(attr_of(h["rated"], "aria-valuenow"), text if general else None)
        if general:
            mail, phone = (
                F.coalesce(first(F.filter(h["links"], lambda x: x["href"].startswith(p)))["text"], F.lit("")) for p in ("mailto:", "tel:")
            )
            return (
                F.when(h["target"].isin("IsLinkedToUser", "Enabled"), F.array(entry(name, flag)))
                .when(h["target"] == "Contact", F.array(entry("Email", mail), entry("Phone", phone)))
                .when(h["target"] == "ReputationScore", F.array(entry("Reputation_Score", F.when(h["rated"].isNull(), text).otherwise(score))))
                .otherwise(plain)
            )

        def linked(x: Column) -> Column:
            href = F.coalesce(x["href"], F.lit(""))
            named = entry(name, x["text"])
            web = F.array(named, entry(F.concat(name, F.lit("_URL")), href))
            if wide:
                web = F.when((href != "") & ~href.startswith("javascript"), web).otherwise(F.array(named))
            return (
                F.when(href.startswith("mailto:"), F.array(entry("Email", x["text"])))
                .when(href.startswith("tel:"), F.array(entry("Phone", x["text"])))
                .otherwise(web)
            )

        chosen = h["links"] if wide else F.slice(h["links"], 1, 1)
        found = (
            F.when(h["icon"].isNotNull(), F.array(entry(name, flag)))
            .when(F.size(h["links"]) > 0, F.flatten(F.transform(chosen, linked)))
            .when(h["rated"].isNotNull(), F.array(entry(name, score)))
        )
        if wide:
            found = found.when(h["trail"].isNotNull(), F.array(entry(name, h["trail"])))
        found = found.otherwise(plain if rules.keep_blank else F.filter(plain, lambda e: e["value"] != ""))
        return found if rules.keep_blank else F.when(name != "", found).otherwise(F.filter(found, lambda e: F.lit(False)))

    return let(below(q["val"]), of)


def fields(inside: Column, rules: KvRules) -> Column:
    """The labelled rows among a panel's elements as one map, keys in page order.

    A later value replaces an earlier one of the same key and keeps the earlier place.
    """
    rows = F.transform(labelled_rows(inside), lambda q: F.struct(q["label"].alias("label"), value_column(rules, q).alias("val")))
    with_value = F.filter(rows, lambda q: q["val"].isNotNull())
    return last_wins(F.flatten(F.transform(with_value, lambda q: _entries(rules, q))))
