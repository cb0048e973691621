import pytest

from pagetables.operators.incremental import keep_first
from pagetables.streaming.listing import current_rows, records_of, stream_listing

SHAPE = "page_id bigint, page_no bigint, html string"
GROUPED = "institution string, visit bigint, page_id bigint, page_no bigint, url string, html string"


def table(lines):
    return "<table>" + "".join('<tr class="k-master-row">' + "".join(f"<td>{c}</td>" for c in cells) + "</tr>" for cells in lines) + "</table>"


def page(n, *orgs):
    link = lambda u: f'<a href="{u}">Manage</a>' if u else ""
    return (n, n, table([["", "", "", name, "ON", "S", "yes", "no", "1", link(u)] for name, u in orgs]))


def visit(group, v, n, *facilities):
    link = lambda u: f'<a href="{u}" title="View">Open</a>' if u else ""
    return (group, v, n, n, "", table([["B", name, "T", link(u)] for name, u in facilities]))


DROPS = [
    [page(0, ("A", "u1"), ("B", "u2"), ("N", "")), page(1, ("A again", "u1"), ("C", "u3"))],
    [page(2, ("B later", "u2"), ("D", "u4"), ("N later", "")), page(3, ("", "u9"))],
]


def land(spark, path, drop, shape=SHAPE):
    spark.createDataFrame(drop, shape).coalesce(1).write.mode("append").parquet(path)


def stored(spark, path):
    return sorted((r.Organization_Name, r.Manage_URL) for r in spark.read.parquet(path + "/data").collect())


@pytest.fixture
def folders(tmp_path):
    return tuple(str(tmp_path / n) for n in ("landing", "out", "ckpt"))


def test_two_drops_and_a_restart(spark, folders):
    landing, out, ckpt = folders
    land(spark, landing, DROPS[0])
    stream_listing(spark, landing, out, ckpt, total=6).awaitTermination()
    assert stored(spark, out) == [("A", "u1"), ("B", "u2"), ("C", "u3"), ("N", "Not Found")]

    land(spark, landing, DROPS[1])  # the second start takes in the new files only
    stream_listing(spark, landing, out, ckpt, total=6).awaitTermination()
    everything = spark.createDataFrame([p for d in DROPS for p in d], SHAPE)
    batch = keep_first(records_of(everything, "organization"), "Manage_URL", ["page_no", "row_pre"])
    want = sorted((r.Organization_Name, r.Manage_URL) for r in batch.collect())
    assert stored(spark, out) == want == [("A", "u1"), ("B", "u2"), ("C", "u3"), ("D", "u4"), ("N", "Not Found")]
    progress = spark.read.parquet(out + "/progress").orderBy("batch_id").collect()
    assert [(r.processed, r.total, r.percent) for r in progress] == [(4, 6, 66.67), (5, 6, 83.33)]

    # nothing new: nothing changes
    stream_listing(spark, landing, out, ckpt, total=6).awaitTermination()
    assert stored(spark, out) == want


def test_a_batch_that_runs_again_replaces_itself(spark, folders):
    landing, out, ckpt = folders
    for drop in DROPS:
        land(spark, landing, drop)
        stream_listing(spark, landing, out, ckpt).awaitTermination()
    want = stored(spark, out)
    # as after a failure before its commit: Spark plans the same batch again, from the state before it
    from pathlib import Path

    for name in ("1", ".1.crc"):
        (Path(ckpt) / "commits" / name).unlink(missing_ok=True)
    stream_listing(spark, landing, out, ckpt).awaitTermination()
    assert stored(spark, out) == want
    assert [r.batch_id for r in spark.read.parquet(out + "/progress").orderBy("batch_id").collect()] == [0, 1]


def test_bounded_batches(spark, folders):
    landing, out, ckpt = folders
    for drop in DROPS:
        for p in drop:
            land(spark, landing, [p])
    stream_listing(spark, landing, out, ckpt, max_files=1).awaitTermination()
    assert len(stored(spark, out)) == 5
    progress = spark.read.parquet(out + "/progress").orderBy("batch_id").collect()
    assert [r.batch_id for r in progress] == [0, 1, 2, 3] and progress[-1].processed == 5


def test_records_without_an_address_can_all_be_kept(spark, folders):
    landing, out, ckpt = folders
    for drop in DROPS:
        land(spark, landing, drop)
    stream_listing(spark, landing, out, ckpt, max_files=1, collapse_missing=False).awaitTermination()
    assert [n for n, u in stored(spark, out) if u == "Not Found"] == ["N", "N later"]


def test_a_batch_looks_up_its_own_keys_only(spark, folders):
    """Twenty batches of as many new and known keys each: what is read from the state doesn't grow with the history."""
    landing, out, ckpt = folders
    for b in range(20):
        new = [(f"O{b}-{i}", f"u{b}-{i}") for i in range(20)]
        old = [(f"again {i}", f"u{max(b - 1, 0)}-{i}") for i in range(20)]
        land(spark, landing, [page(b, *new, *old)])
    query = stream_listing(spark, landing, out, ckpt, max_files=1)
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert len(states) == 20 and states[-1].numRowsTotal == 400
    looked_up = [s.customMetrics["rocksdbGetCount"] for s in states]
    read = [s.customMetrics["rocksdbTotalBytesRead"] for s in states]
    assert max(looked_up[10:]) <= max(looked_up[1:10]) and max(read[10:]) <= 2 * max(read[1:10])
    assert len(stored(spark, out)) == 400


def test_a_group_that_is_visited_again_replaces_itself(spark, folders):
    landing, out, ckpt = folders
    drops = [
        [visit("A", 1, 0, ("a1", "x"), ("a2", "y")), visit("B", 1, 1, ("b1", "x"), ("b2", ""), ("b3", ""))],
        [visit("A", 1, 2, ("a1 again", "x"), ("a3", "z")), visit("C", 1, 3)],  # the same visit goes on
        [visit("A", 2, 0, ("new", "y")), visit("B", 2, 1)],  # B shows nothing any more
        [visit("A", 1, 9, ("late", "late"))],  # a page of the old visit
    ]
    seen = []
    for drop in drops:
        land(spark, landing, drop, GROUPED)
        stream_listing(spark, landing, out, ckpt, "facility").awaitTermination()
        seen.append(sorted((r.Institution, r.Facility_Name, r.Manage_URL) for r in current_rows(spark, out).collect()))
    b = [("B", "b1", "x"), ("B", "b2", "Not Found")]
    assert seen == [
        [("A", "a1", "x"), ("A", "a2", "y"), *b],
        [("A", "a1", "x"), ("A", "a2", "y"), ("A", "a3", "z"), *b],
        [("A", "new", "y")],
        [("A", "new", "y")],
    ]
    assert [r.processed for r in spark.read.parquet(out + "/progress").orderBy("batch_id").collect()] == [4, 5, 6, 7]


def test_experts_by_institution(spark, folders):
    landing, out, ckpt = folders
    cells = lambda name, u: [f'<a href="{u}" title="View Full Details">v</a>', "7", "", "", "F", "", "T", "P", name]
    land(spark, landing, [("A", 1, 0, 0, "", table([cells("x", "u"), cells("x2", "u")])), ("B", 1, 1, 0, "", table([cells("y", "u")]))], GROUPED)
    stream_listing(spark, landing, out, ckpt, "expert").awaitTermination()
    rows = current_rows(spark, out)
    assert sorted((r.Institution, r.Name, r.Manage_URL) for r in rows.collect()) == [("A", "x", "u"), ("B", "y", "u")]
    assert rows.columns[:3] == ["Institution", "Name", "Expert_Type"]


