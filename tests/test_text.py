import re

import pytest
from pyspark.sql import functions as F

from pagetables.functions import text as X


def one(spark, fn, *values, ddl=None):
    ddl = ddl or ", ".join(f"c{i} string" for i in range(len(values)))
    df = spark.createDataFrame([values], ddl)
    return df.select(fn(*[F.col(c) for c in df.columns]).alias("r")).first()["r"]


def python_clean(s):
    return re.sub(r"\s+", " ", s.strip()).replace("\xa0", " ") if s else ""


@pytest.mark.parametrize(
    "s",
    ["  a   b\u001f\u001cc　\n", "", None, "  ", "a", "\ta\r\n b ", "x\u0085y", "​z", " q r"],
)
def test_clean_text_is_python_clean(spark, s):
    assert one(spark, X.clean_text, s) == python_clean(s)


@pytest.mark.parametrize("s", ["  a  b ", "\n", "\x1ca\x1f", "a\nb"])
def test_strip_is_python_strip(spark, s):
    assert one(spark, X.strip, s) == s.strip()


@pytest.mark.parametrize(
    "s, want",
    [
        ("1 - 100 of 163 items", (1, 100, 163, True)),
        ("1 - 1 of 1 item", (1, 1, 1, True)),
        (" 101-163 of 163 items shown", (101, 163, 163, True)),
        ("1 - 100 of 1,163 items", (0, 0, 0, False)),
        ("1 - 100 of 1,230 items", (0, 0, 0, False)),
        ("101 - 110 items", (0, 0, 0, False)),
        ("No items to display", (0, 0, 0, True)),
        ("0 items", (0, 0, 0, True)),
        ("", (0, 0, 0, False)),
        (None, (0, 0, 0, False)),
    ],
)
def test_pager(spark, s, want):
    assert tuple(one(spark, X.parse_pager, s)) == want


@pytest.mark.parametrize(
    "first, last, total, plain, strict",
    [(1, 50, 120, False, False), (101, 120, 120, True, True), (0, 0, 0, True, False)],
)
def test_last_page(spark, first, last, total, plain, strict):
    df = spark.range(1).select(F.struct(F.lit(first).alias("first"), F.lit(last).alias("last"), F.lit(total).alias("total")).alias("p"))
    row = df.select(X.is_last_page(F.col("p")), X.is_last_page(F.col("p"), need_total=True)).first()
    assert tuple(row) == (plain, strict)


@pytest.mark.parametrize("n, ceil, estimate", [(0, 0, 1), (1, 1, 1), (50, 1, 2), (100, 1, 3), (101, 2, 3)])
def test_page_counts(spark, n, ceil, estimate):
    row = spark.range(1).select(X.pages_ceil(F.lit(n)), X.pages_estimate(F.lit(n))).first()
    assert tuple(row) == (ceil, estimate)


FLAGS = [
    # title, classes, text, narrow, wide
    ("Yes", ["k-icon", "k-i-checkbox"], "", "Yes", "Yes"),
    (None, ["k-icon", "k-i-checkbox-checked"], "", "Yes", "Yes"),
    (None, ["k-icon", "k-i-checkbox"], "", "No", "No"),
    (None, ["k-icon", "k-i-check"], "t", "t", "Yes"),
    ("", ["k-icon", "k-i-close"], "t", "t", "No"),
    (None, None, "  Per  haps ", "Per haps", "Per haps"),
]


@pytest.mark.parametrize("title, classes, text, narrow, wide", FLAGS)
def test_flag(spark, title, classes, text, narrow, wide):
    ddl = "a string, b array<string>, c string"
    assert one(spark, X.parse_flag, title, classes, text, ddl=ddl) == narrow
    assert one(spark, lambda *c: X.parse_flag(*c, wide=True), title, classes, text, ddl=ddl) == wide


@pytest.mark.parametrize(
    "title, classes, box, text, want",
    [
        ("Maybe", ["k-icon"], None, "", "Maybe"),
        (None, ["k-i-x"], None, "yes", "No"),
        (None, ["k-i-checkbox"], None, "", "No"),
        (None, None, True, "no", "Yes"),
        (None, None, False, "yes", "No"),
        (None, None, None, "✓", "Yes"),
        (None, None, None, "✘", "No"),
        (None, None, None, " TRUE ", "Yes"),
        (None, None, None, None, "No"),
        (None, None, None, "maybe  so", "maybe so"),
        (None, ["k-icon", "k-i-star"], None, "1", "Yes"),
    ],
)
def test_flag_cell(spark, title, classes, box, text, want):
    ddl = "a string, b array<string>, c boolean, d string"
    assert one(spark, X.parse_flag_cell, title, classes, box, text, ddl=ddl) == want


def test_keys_and_lists(spark):
    assert one(spark, lambda c: X.normalize_key(c, ":?"), "Is it: so?") == "Is_it_so"
    assert one(spark, X.normalize_key, "a  b:") == "a__b:"
    assert one(spark, X.split_list, " a, ,b ,") == ["a", "b"]
    assert one(spark, X.split_first_delim, "a; b, c;") == ["a; b", "c;"]
    assert one(spark, X.split_first_delim, "a; b;") == ["a", "b"]
    assert one(spark, X.split_first_delim, "a\nb") == ["a", "b"]
    assert one(spark, X.split_first_delim, "alone") == []
    assert one(spark, X.parse_int_list, "3, 7,,12") == [3, 7, 12]
    assert one(spark, X.parse_int_list, "3, x") is None


def test_small_rules(spark):
    zero = F.lit(0).cast("bigint")
    row = spark.range(1).select(
        X.first_truthy(F.lit(0).cast("bigint"), F.lit(None).cast("bigint"), F.lit(7).cast("bigint"), default=zero),
        X.percent(F.lit(1), F.lit(3)), X.percent(F.lit(1), F.lit(0)),
        X.truncate(F.lit("abcdef"), 3), X.truncate(F.lit("abcdef"), 3, ellipsis=True), X.truncate(F.lit("abc"), 3, True),
        X.rating(F.lit("4")), X.rating(F.lit("")), X.rating(F.lit("4"), F.lit("is Not Rated")),
        X.link_name(F.lit("")), X.link_kind(F.lit("tel:1")), X.valid_link(F.lit("Not Found")),
        X.valid_link(F.lit(None).cast("string")), X.has_any(F.lit("/x/Details/1")), X.has_any(F.lit(None).cast("string")),
        X.lookup(F.create_map(F.lit("a"), F.lit("b")), "c", "Unknown"),
        X.run_id(F.lit("2024-03-05 01:02:03").cast("timestamp")),
        X.iso_time(F.lit("2024-03-05 01:02:03").cast("timestamp")),
        X.json_text(F.struct(F.lit(None).cast("string").alias("a"), F.lit("é").alias("b"))),
    ).first()
    assert tuple(row) == (
        7, 33.33, 0.0, "abc", "abc...", "abc", "4", "Not Rated", "Not Rated", "Link", "tel", False, False, True, False,
        "Unknown", "20240305_010203", "2024-03-05T01:02:03.000000", '{"a":null,"b":"é"}',
    )
