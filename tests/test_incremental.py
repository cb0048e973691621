import random

import pytest
from pyspark.sql import functions as F

from pagetables.operators import incremental, ordered, summary
from pagetables.plans import profile


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def master(spark):
    urls = ["a", "Not Found", "b", "a", "Not Found", "c"]
    return spark.createDataFrame([(u, 1 + i // 3, i % 3) for i, u in enumerate(urls)], "Manage_URL string, page_no int, row_ord int")


def test_keep_first(master):
    order = ["page_no", "row_ord"]
    assert rows(incremental.keep_first(master, "Manage_URL", order)) == [("Not Found", 1, 1), ("a", 1, 0), ("b", 1, 2), ("c", 2, 2)]
    kept = incremental.keep_first(master, "Manage_URL", order, collapse_missing=False)
    assert [r[0] for r in rows(kept)] == ["Not Found", "Not Found", "a", "b", "c"]


def test_append_new(spark, master):
    known = spark.createDataFrame([("a",), ("Not Found",)], "Manage_URL string")
    order = ["page_no", "row_ord"]
    assert [r[0] for r in rows(incremental.append_new(known, master, "Manage_URL", order))] == ["b", "c"]
    kept = incremental.append_new(known, master, "Manage_URL", order, collapse_missing=False)
    assert [r[0] for r in rows(kept)] == ["Not Found", "Not Found", "b", "c"]


def test_replace_also_drops_groups_without_fresh_rows(spark):
    m = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "Institution string, v int")
    fresh = spark.createDataFrame([("x", 9)], "Institution string, v int")
    revisited = spark.createDataFrame([("x",), ("y",)], "Institution string")
    assert rows(incremental.replace_groups(m, fresh, "Institution", revisited)) == [("x", 9), ("z", 3)]
    assert rows(incremental.replace_groups(m, fresh, "Institution")) == [("x", 9), ("y", 2), ("z", 3)]
    assert rows(incremental.removed_counts(m, revisited, "Institution")) == [("x", 1), ("y", 1)]


def test_revisiting_some_keeps_the_other_empties(spark):
    empties = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "idx int, name string")
    fresh = spark.createDataFrame([("y",)], "Institution string")
    assert rows(incremental.still_empty(empties, fresh, "Institution").select("idx")) == [(1,), (3,)]
    asks = spark.createDataFrame([(1, " 2, 9,,4"), (2, "2,b"), (3, "")], "ask int, choice string")
    assert rows(incremental.pick_empty(empties, asks, "choice", ["ask"])) == [(1, 2, "x", False), (1, 4, "z", False), (1, 9, None, True)]


def test_resolve_option_is_the_first_by_containment(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab ") for _ in range(rng.randint(0, 5)))
    options = [(g, i, word()) for g in range(4) for i in range(30)]
    targets = sorted({(g, word()) for g in range(4) for _ in range(40)})
    o = spark.createDataFrame(options, "g int, idx int, name string")
    t = spark.createDataFrame(targets, "g int, target string")
    for both in (True, False):
        got = {(r.g, r.target): r.chosen for r in incremental.resolve_option(t, o, ["g"], both).collect()}
        for g, target in targets:
            # a blank target is within every option, a blank option is never chosen
            names = [n for gg, _, n in options if gg == g and n and (target in n or (both and n in target))]
            if target:
                assert got[g, target] == (names[0] if names else None), (g, target)
        assert len(got) == len(targets)


def hot_polls(n_hot=600, n_cold=40, seed=1):
    """One page with most of the reads, many with few."""
    rng = random.Random(seed)
    out, i = [], 0
    for page in [0] * n_hot + [rng.randint(1, 30) for _ in range(n_cold * 10)]:
        i += 1
        out.append((page, rng.randint(0, 400), i, rng.choice([0, 1, 1, 2])))
    return out


def brute_stable(polls, k, last):
    out = {}
    for page in {p for p, *_ in polls}:
        reads = sorted((t, i, n) for p, t, i, n in polls if p == page)
        hit = next((r for j, r in enumerate(reads) if j >= k and r[2] > 0 and len({x[2] for x in reads[j - k : j + 1]}) == 1), None)
        if hit or last:
            out[page] = (hit or reads[-1])[1]
    return out


@pytest.mark.parametrize("k, width, last", [(2, 50, False), (2, 7, True), (3, 1, False), (1, 1000, True)])
def test_first_stable_over_blocks(spark, k, width, last):
    polls = hot_polls()
    df = spark.createDataFrame(polls, "page int, t int, id int, n int")
    got = ordered.first_stable(df, "page", ["t", "id"], F.floor(F.col("t") / width), k, last)
    assert {r.page: r.id for r in got.collect()} == brute_stable(polls, k, last)


@pytest.mark.parametrize("k, last", [(2, False), (3, True)])
def test_first_stable_finds_its_own_blocks(spark, k, last):
    polls = hot_polls()
    df = spark.createDataFrame(polls, "page int, t int, id int, n int")
    got = ordered.first_stable(df, "page", ["t", "id"], k=k, last_read=last)
    assert {r.page: r.id for r in got.collect()} == brute_stable(polls, k, last)


def test_a_key_with_a_third_of_all_rows_is_split(spark):
    rows = spark.range(90_000).selectExpr("if(id % 3 = 0, 0, id) AS page", "id AS t", "1 AS n")
    sizes = [r[0] for r in ordered.order_blocks(rows, "page", ["t"]).groupBy("_block").count().select("count").collect()]
    median = sorted(sizes)[len(sizes) // 2]
    assert len(sizes) > 2 and max(sizes) < 5 * median


def test_long_names_are_looked_up_by_few_rows(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij ") for _ in range(2000))
    options = spark.createDataFrame([(0, "x" * 50), (1, long), (2, long), (3, long[500:900])], "idx int, name string")
    assert options.select(F.size(incremental.grams(F.col("name"), 3)).alias("n")).agg(F.max("n")).first()[0] <= 2000
    targets = spark.createDataFrame([(long[100:1900],), (long + "!",), (long[7:9],), ("no such name",), ("",)], "target string")
    got = {r.target: r.chosen for r in incremental.resolve_option(targets, options).collect()}
    assert got == {long[100:1900]: long, long + "!": long, long[7:9]: long, "no such name": None, "": None}


def test_attempts(spark):
    polls = [("a", 1, 0), ("a", 2, 0), ("a", 3, 4), ("b", 1, 1), ("c", 1, 0), *[("d", i, int(i > 4)) for i in range(1, 90)]]
    df = spark.createDataFrame(polls, "page string, t int, n int")
    assert rows(ordered.classify_attempts(df, "page", ["t"])) == [("a", "ok_after_retry", 2), ("b", "ok", 0), ("c", "empty", 3), ("d", "empty", 3)]


def test_numbering_and_totals_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FAN", 3)
    rng = random.Random(5)
    data = [(rng.choice("xxxy"), rng.randint(0, 40), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, page int, i int")
    numbered = ordered.row_numbers(df, ["g"], "page", ["i"])
    got = {r.i: r.position for r in numbered.collect()}
    for g in "xy":
        for position, (_, i) in enumerate(sorted((p, i) for gg, p, i in data if gg == g)):
            assert got[i] == position
    batches = ordered.batch_ids(df, ["g"], "page", ["i"], 50).groupBy("g", "batch").count()
    assert all(r["count"] == 50 for r in batches.collect() if r.batch < sum(1 for d in data if d[0] == r.g) // 50)
    totals = rows(ordered.running_total(df, "page"), "page")
    assert [t[2] for t in totals] == [sum(1 for d in data if d[1] <= t[0]) for t in totals]
    assert sum(t[1] for t in totals) == 500


def test_top_values_hides_blanks_after_the_cut(spark):
    df = spark.createDataFrame([(v,) for v in ["", "", "", "a", "a", "b", "c"]], "v string")
    assert rows(summary.top_values(df, "v", 2)) == [("a", 2)]
    assert rows(summary.count_by_group(df, "v", None))[0] == ("", 3)
    assert rows(summary.group_remainder(df, "v", 3)) == [(1,)] and rows(summary.group_remainder(df, "v")) == [(0,)]


def test_presence_counts_nothing_for_null(spark):
    df = spark.createDataFrame([([1, 2], {"a": "b"}), ([], {}), (None, None)], "l array<int>, m map<string,string>")
    got = summary.section_presence(df, {"l": F.col("l"), "m": F.col("m")}).first()
    assert tuple(got) == (3, 1, 2, 1, 1)


def test_errors(spark):
    master = spark.createDataFrame(
        [("I", "a", "u1"), ("I", "b", "Not Found"), ("I", None, ""), ("J", "d", None), ("J", "e", "u2")],
        "Institution string, Name string, Manage_URL string",
    )
    done = spark.createDataFrame([("u1",)], "url string")
    at = F.lit("2024-01-01").cast("timestamp")
    got = profile.extraction_errors("expert", master, done, at).drop("timestamp", "index")
    assert rows(got, "institution", "name") == [
        ("Unknown", "I", "", "No valid Manage URL"), ("b", "I", "Not Found", "No valid Manage URL"),
        ("d", "J", "", "No valid Manage URL"), ("e", "J", "u2", "Extraction failed"),
    ]
    failed = got.filter("url = 'u2'").select(F.col("url").alias("Manage_URL"))
    handled = done.select(F.col("url").alias("Manage_URL"))
    left = incremental.pending(master.filter("Manage_URL like 'u%'"), "Manage_URL", handled, failed)
    assert left.count() == 0
