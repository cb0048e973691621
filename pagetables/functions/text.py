"""Text, key, flag and number rules, all as ``Column -> Column`` expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the source data defines it (Unicode white space plus
# the four ASCII separators), the pager wording, flag words and icon classes.
SPACE = r"(?U)[\s\x1c-\x1f]"
PAGER = r"^(\d+)\s*-\s*(\d+)\s+of\s+(\d+)\s+items?"
YES_WORDS = ("yes", "true", "1", "✓", "✔")
NO_WORDS = ("no", "false", "0", "✗", "✘", "")
NO_LINK = "Not Found"
NOT_RATED = "Not Rated"
LINK_WORDS = ("Manage", "Details", "Edit", "View")


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.coalesce(F.regexp_replace(c, rf"^{SPACE}+|(?U)[\s\x1c-\x1f]+$", ""), F.lit(""))


def clean_text(c: Column) -> Column:
    """Collapse white-space runs (nbsp included) to one space and trim; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, SPACE + "+", " ")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_truthy(*cols: Column, default: Column) -> Column:
    """First value that is neither NULL, zero nor blank.

    All columns share one type; the blank for that type is its default's cast.
    """
    return F.coalesce(*[F.when(c.cast("string").isin("", "0", "0.0"), None).otherwise(c) for c in cols], default)


def lookup(m: Column, key: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def parse_pager(c: Column) -> Column:
    """``'1 - 100 of 163 items'`` -> struct(first, last, total, parsed).

    Unreadable text gives zeros with ``parsed = false``; the "no items" wordings,
    as the whole text's beginning, give zeros with ``parsed = true``.
    """
    s = strip(c)

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(s, PAGER, i).try_cast("bigint"), F.lit(0).cast("bigint"))

    low = F.lower(s)
    return F.struct(
        part(1).alias("first"),
        part(2).alias("last"),
        part(3).alias("total"),
        (s.rlike(PAGER) | low.rlike(r"^(no|0) items\b")).alias("parsed"),
    )


def is_last_page(pager: Column, need_total: bool = False) -> Column:
    """``last >= total``; with ``need_total`` an unknown total is never the last page."""
    done = pager["last"] >= pager["total"]
    return (done & (pager["total"] > 0)) if need_total else done


def pages_ceil(total: Column, size: int = 100) -> Column:
    return F.ceil(total / F.lit(size)).cast("bigint")


def pages_estimate(total: Column, size: int = 50) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), (F.floor(total / F.lit(size)) + 1).cast("bigint"))


def _has(classes: Column, *names: str) -> Column:
    return F.arrays_overlap(F.coalesce(classes, F.array().cast("array<string>")), F.array(*map(F.lit, names)))


def icon_flag(title: Column, classes: Column, wide: bool = False) -> Column:
    """Yes/No of an icon by its title, else its class tokens; NULL if neither tells.

    ``wide`` also understands the tick and close icons. Classes are compared as whole
    tokens, so an unchecked box is never taken for a tick. ``classes`` is NULL where
    there is no icon.
    """
    yes = ["k-i-checkbox-checked"] + (["k-i-check"] if wide else [])
    no = ["k-i-checkbox"] + (["k-i-close"] if wide else [])
    return (
        F.when(F.coalesce(title, F.lit("")) != "", title)
        .when(_has(classes, *yes), F.lit("Yes"))
        .when(_has(classes, *no), F.lit("No"))
    )


def parse_flag(title: Column, classes: Column, text: Column, wide: bool = False) -> Column:
    """Yes/No of an element's icon, else the element's text."""
    return F.coalesce(icon_flag(title, classes, wide), clean_text(text))


def parse_flag_cell(title: Column, classes: Column, box: Column, text: Column) -> Column:
    """Yes/No of a listing cell: icon, then checkbox, then wording; a missing cell is No.

    ``box`` is NULL without a checkbox, else whether it is checked.
    """
    t = clean_text(text)
    return (
        F.when(F.coalesce(title, F.lit("")) != "", title)
        .when(_has(classes, "k-i-checkbox-checked", "k-i-check"), F.lit("Yes"))
        .when(_has(classes, "k-i-checkbox", "k-i-close", "k-i-x"), F.lit("No"))
        .when(box.isNotNull(), F.when(box, F.lit("Yes")).otherwise(F.lit("No")))
        .when(F.lower(t).isin(*YES_WORDS), F.lit("Yes"))
        .when(F.lower(t).isin(*NO_WORDS), F.lit("No"))
        .otherwise(t)
    )


def normalize_key(c: Column, drop: str = "") -> Column:
    """Spaces to underscores; every character of ``drop`` is removed."""
    return F.translate(c, " " + drop, "_")


def split_list(c: Column, delimiter: str = ",") -> Column:
    """Trimmed, non-blank parts of a delimited text."""
    parts = F.transform(F.split(c, "[" + delimiter + "]"), strip)
    return F.filter(parts, lambda x: x != "")


def split_first_delim(c: Column) -> Column:
    """Split on the first of comma, semicolon, newline that occurs; none gives an empty list."""
    return (
        F.when(c.contains(","), split_list(c, ","))
        .when(c.contains(";"), split_list(c, ";"))
        .when(c.contains("\n"), split_list(c, "\n"))
        .otherwise(F.array().cast("array<string>"))
    )


def parse_int_list(c: Column) -> Column:
    """Comma list of integers; blanks are skipped, one bad item makes the whole list NULL."""
    items = F.transform(split_list(c), lambda x: x.try_cast("int"))
    return F.when(F.exists(items, lambda x: x.isNull()), None).otherwise(items)


def has_any(c: Column, words: Sequence[str] = LINK_WORDS) -> Column:
    """Whether the text contains any of the (plain) words."""
    return F.coalesce(c, F.lit("")).rlike("|".join(words))


def link_kind(href: Column) -> Column:
    return (
        F.when(href.startswith("mailto:"), "mailto")
        .when(href.startswith("tel:"), "tel")
        .when(href.startswith("javascript"), "javascript")
        .when(href.startswith("#"), "fragment")
        .otherwise("web")
    )


def valid_link(url: Column) -> Column:
    return ~F.coalesce(url, F.lit("")).isin("", NO_LINK)


def link_name(text: Column) -> Column:
    return F.coalesce(blank_to_null(text), F.lit("Link"))


def truncate(c: Column, n: int, ellipsis: bool = False) -> Column:
    cut = F.substring(c, 1, n)
    return F.when(F.length(c) > n, F.concat(cut, F.lit("..."))).otherwise(c) if ellipsis else cut


def rating(value: Column, text: Column | None = None) -> Column:
    """Rating value, 'Not Rated' if blank; a text that says so overrides the value."""
    r = F.coalesce(blank_to_null(value), F.lit(NOT_RATED))
    return r if text is None else F.when(F.coalesce(text, F.lit("")).contains(NOT_RATED), NOT_RATED).otherwise(r)


def percent(done: Column, total: Column, digits: int = 2) -> Column:
    """Rounded share in percent as a double; 0 when the total is 0."""
    share = F.round(done.cast("double") / total.cast("double") * 100.0, digits)
    return F.when(total > 0, share).otherwise(F.lit(0.0))


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def shown_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def json_text(c: Column) -> Column:
    """Nested value as JSON text, keeping null fields."""
    return F.to_json(c, {"ignoreNullFields": "false"})
