import json

import pytest
from pyspark.sql import functions as F

from pagetables import schema
from pagetables.operators import audit
from pagetables.sources import tables as io
from pagetables.sources.html import html_nodes

ORG = {"Organization_Name": "Café é", "Provinces": "ON", "Manage_URL": "u1"}


def test_a_master_list_as_one_array(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text(json.dumps([ORG, {**ORG, "Manage_URL": "u2", "Scraped_At": "2024-01-02T03:04:05"}], ensure_ascii=False))
    df = io.read_master(spark, str(path), "organization", multi_line=True)
    assert df.columns == schema.master_fields("organization")
    assert [r.Organization_Name for r in df.collect()] == ["Café é"] * 2
    assert df.filter("Scraped_At is not null").count() == 1


def test_unreadable_records_are_left_out_and_shown(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text(json.dumps(ORG) + "\n{broken\n" + json.dumps(ORG) + "\n")
    assert io.read_master(spark, str(path), "organization").count() == 2
    assert [r[0] for r in io.unreadable(spark, str(path), "organization").collect()] == ["{broken"]
    broken = tmp_path / "broken.json"
    broken.write_text("[" + json.dumps(ORG) + ", {")
    assert io.read_master(spark, str(broken), "organization", multi_line=True).count() == 0
    assert io.unreadable(spark, str(broken), "organization", multi_line=True).count() == 1


def test_snapshot_counters_under_one_name(spark, tmp_path):
    files = {
        "a": {"timestamp": "t1", "last_page_scraped": 3, "total_items_in_table": 12, "organizations_collected": 2, "data": [ORG, ORG]},
        "b": {"timestamp": "t2", "current_index": 5, "total_organizations": 10, "organizations_processed": 0, "errors_count": 1, "data": []},
        "c": {"timestamp": "t3", "data": [ORG]},
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    (tmp_path / "d.json").write_text("{cut")
    records, progress = io.read_snapshot(spark, str(tmp_path), "organization")
    assert records.count() == 3
    assert [r.text for r in io.unreadable_snapshots(spark, str(tmp_path), "organization").collect()] == ["{cut"]
    got = {r.timestamp: (r.processed, r.total, r.cursor, r.errors, r.percent) for r in progress.collect()}
    assert got == {"t1": (2, 12, 3, 0, 25.0), "t2": (0, 10, 5, 1, 50.0), "t3": (0, 0, 0, 0, 0.0)}


def test_errors_may_be_absent(spark, tmp_path):
    assert io.read_errors(spark, str(tmp_path / "none")).count() == 0
    df = spark.createDataFrame([(3, "n", "i", "u", "Extraction failed", None)], schema.ERRORS)
    io.write_errors(df, str(tmp_path / "errors"), "20240101_000000")
    io.write_errors(df, str(tmp_path / "errors"), "20240101_000000")
    io.write_errors(df, str(tmp_path / "errors"), "20240102_000000")
    assert io.read_errors(spark, str(tmp_path / "errors")).count() == 2


def test_a_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "snap")
    progress = spark.range(1).select(F.lit(1).alias("processed"))
    for batch, n in ((0, 3), (1, 2), (1, 4)):
        io.write_snapshot(spark.range(n), progress, path, batch)
    got = {r.batch_id: r["count"] for r in spark.read.parquet(path + "/data").groupBy("batch_id").count().collect()}
    assert got == {0: 3, 1: 4}
    assert spark.read.parquet(path + "/progress").count() == 2


def test_replaced_partitions(spark, tmp_path):
    path = str(tmp_path / "groups")
    rows = lambda *x: spark.createDataFrame(x, "v int, Institution string")
    io.replace_partitions(rows((1, "x"), (2, "y")), path, "Institution")
    io.replace_partitions(rows((3, "y"), (4, "y")), path, "Institution")
    assert sorted((r.v, r.Institution) for r in spark.read.parquet(path).collect()) == [(1, "x"), (3, "y"), (4, "y")]


def test_flat_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "é"\nnow, ok', {"k": None}, ["a"], ""), (2, None, None, None, "z")], "i int, t string, m map<string,string>, l array<string>, e string")
    io.write_flat(df, str(tmp_path / "flat"), ["t", "m", "l", "e", "missing", "i"])
    back = io.read_flat(spark, str(tmp_path / "flat"), "t string, m string, l string, e string, i int")
    assert [tuple(r) for r in back.orderBy("i").collect()] == [
        ('say "é"\nnow, ok', '{"k":null}', '["a"]', "", 1), (None, None, None, "z", 2),
    ]


def test_json_keeps_utf8(spark, tmp_path):
    io.write_records(spark.createDataFrame([("é✓",)], "t string"), str(tmp_path / "r"), "json")
    assert "é✓" in "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))


def test_a_stored_node_table_serves_as_nodes(spark, pages_of, tmp_path):
    nodes = html_nodes(pages_of("<p>a<a href='/x'>b</a>"))
    io.write_nodes(nodes, str(tmp_path / "nodes"))
    stored = spark.read.parquet(str(tmp_path / "nodes"))
    assert stored.schema.simpleString() == nodes.schema.simpleString()
    assert stored.filter("tag = 'a'").select("attrs").first().attrs == {"href": "/x"}


def test_record_count(spark):
    df = spark.createDataFrame([([1, 2],), (None,)], "data array<int>")
    assert [r[0] for r in df.select(io.record_count(F.col("data"))).collect()] == [2, 0]


@pytest.mark.parametrize("name", ["expert", "facility", "organization"])
def test_registry(spark, name):
    assert schema.datasets(spark).filter(F.col("category").startswith(name.capitalize()[:5])).count() == 2


def test_an_interrupted_batch_is_not_committed(spark, tmp_path):
    path = str(tmp_path / "log")
    state = lambda n, errors: spark.createDataFrame([("r", n, 9, errors)], "run string, processed bigint, total bigint, errors bigint")
    io.write_snapshot(spark.range(3), state(3, 1), path, 0)
    io.write_snapshot(spark.range(2), state(5, 0), path, 1)
    io.write_batch(spark.range(4), f"{path}/data", 2)  # stopped before its progress row
    records, log = io.snapshot_log(spark, path)
    assert (records.count(), log.count()) == (5, 2)
    assert [r.may_retire for r in (audit.retirable(log, ["run"]).first(), audit.retirable(log, ["run"], need_all=True).first())] == [True, False]
    io.write_snapshot(spark.range(4), state(9, 0), path, 2)  # run again
    records, log = io.snapshot_log(spark, path)
    assert records.count() == 9 and audit.retirable(log, ["run"], need_all=True).first().may_retire


@pytest.mark.parametrize("eol, indent", [("\n", 2), ("\r\n", 4)])
def test_an_indented_array_is_split_among_tasks(spark, tmp_path, eol, indent):
    names = [f'n{i} }},\n  {{ "x": [1]' if i % 50 == 7 else f"name {i}" for i in range(5000)]
    rows = [{"Institution": "I\u00e9", "Name": n, "Manage_URL": f"u{i}", "Other": [{"a": 1}, {"b": "}"}]} for i, n in enumerate(names)]
    text = json.dumps(rows, indent=indent, ensure_ascii=False).replace("\n", eol)
    (tmp_path / "one.json").write_bytes(text.encode())
    (tmp_path / "two.json").write_bytes(json.dumps(rows[:1], indent=indent).replace("\n", eol).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 8))
    try:
        df = io.read_master(spark, str(tmp_path), "expert", multi_line=True)
        parts = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(parts) >= 8 and max(parts) < 2 * 5001 / 8
        got = sorted((r.Manage_URL, r.Name, r.Institution) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([(r["Manage_URL"], r["Name"], r["Institution"]) for r in rows] + [("u0", names[0], "I\u00e9")])
    assert io.unreadable(spark, str(tmp_path), "expert", multi_line=True).count() == 0


def test_a_broken_record_of_an_indented_array_is_shown(spark, tmp_path):
    text = json.dumps([{"Name": "a"}, {"Name": "b"}, {"Name": "c"}], indent=2).replace('"b"', "b")
    (tmp_path / "one.json").write_text(text)
    assert sorted(r.Name for r in io.read_master(spark, str(tmp_path), "expert", multi_line=True).collect()) == ["a", "c"]
    assert [r.text.strip() for r in io.unreadable(spark, str(tmp_path), "expert", multi_line=True).collect()] == ['{    "Name": b}']
