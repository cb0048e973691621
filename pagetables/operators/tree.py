"""Expressions on one row per page: what lies in an element is a slice of the page's nodes.

The rows are those of ``page_trees``: ``nodes`` in document order and ``text``. An element knows
its place ``i`` and the place of the ``last`` element inside, so its inside is found without a
search, and everything below is a plain expression on the row: nothing is exploded, moved
or joined. ``x`` stands for a node struct in a lambda.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import clean_text

Fold = Callable[[Column], Column]


def nodes() -> Column:
    return F.col("nodes")


def let(value: Column, body: Fold) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def below(x: Column) -> Column:
    """The elements inside."""
    return F.slice(nodes(), x["i"] + 2, x["last"] - x["i"])


def with_below(x: Column) -> Column:
    """The element and those inside."""
    return F.slice(nodes(), x["i"] + 1, x["last"] - x["i"] + 1)


def holds(x: Column, y: Column) -> Column:
    """Whether ``y`` lies in ``x``."""
    return (x["i"] < y["i"]) & (y["i"] <= x["last"])


def in_any(holders: Column, x: Column) -> Column:
    return F.exists(holders, lambda h: holds(h, x))


def _text(x: Column) -> Column:
    return F.substring(F.col("text"), x["start"] + 1, x["end"] - x["start"]).cast("string")


def raw_text(x: Column) -> Column:
    """Text of an element as shown, line breaks included."""
    return F.btrim(_text(x), F.lit(" \n"))


def shown(x: Column) -> Column:
    """Clean text of an element."""
    return clean_text(_text(x))


def attr_of(x: Column, name: str) -> Column:
    return F.try_element_at(x["attrs"], F.lit(name))


def node_is(x: Column, tag: str | None = None, *classes: str, id: str | None = None) -> Column:
    """Tag, every class token, id."""
    tests = [x["tag"] == tag] if tag else []
    tests += [F.array_contains(x["cls"], c) for c in classes]
    if id is not None:
        tests.append(F.coalesce(x["id"] == id, F.lit(False)))
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def any_of(x: Column, *kinds: tuple[str, ...]) -> Column:
    """Whether a node is of one of the kinds, each a tag and classes."""
    out = node_is(x, *kinds[0])
    for k in kinds[1:]:
        out = out | node_is(x, *k)
    return out


def has_class(x: Column, *classes: str) -> Column:
    return F.arrays_overlap(x["cls"], F.array(*map(F.lit, classes)))


def pick(items: Column, tag: str, *classes: str) -> Column:
    """The elements of a list with this tag and these classes."""
    return F.filter(items, lambda x: node_is(x, tag, *classes))


def links_in(items: Column) -> Column:
    """The links among a list's elements: ``array<struct<href, text>>``."""
    return F.transform(pick(items, "a"), lambda x: F.struct(attr_of(x, "href").alias("href"), shown(x).alias("text")))


def entry(key: Column | str, value: Column) -> Column:
    return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), value.alias("value"))


def last_wins(entries: Column) -> Column:
    """Entries -> map; a later value replaces an earlier one of its key, which keeps its place."""

    def made(es: Column) -> Column:
        keys = F.array_distinct(F.transform(es, lambda e: e["key"]))

        def last(k: Column) -> Column:
            return F.try_element_at(F.filter(es, lambda e: e["key"] == k), F.lit(-1))["value"]

        return let(keys, lambda ks: F.map_from_arrays(ks, F.transform(ks, last)))

    return let(entries, made)


def if_filled(value: Column, other: Column) -> Column:
    """A list or map unless it is empty or NULL."""
    return let(value, lambda v: F.when(F.coalesce(F.size(v), F.lit(0)) > 0, v).otherwise(other))
