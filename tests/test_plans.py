"""The plans that the operators are meant to have."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from acceptance import render as R
from acceptance.oracle import SQL
from acceptance.queries import QUERIES
from pagetables.operators.sections import page_sections
from pagetables.plans import profile
from pagetables.sources.html import html_nodes

WRITES_FIRST = {"json_roundtrip", "snapshot_explode", "flat_export", "streamed_listing", "streamed_facilities", "streamed_experts", "stream_progress", "errors_roundtrip", "snapshot_batches", "is_complete", "partial_result"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_no_query_compares_all_pairs(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text  # pages are the only Python step


@pytest.mark.parametrize("kind", ["expert", "facility", "organization"])
def test_sections_are_built_where_the_page_was_read(spark, kind):
    t = R.Tables(spark, SMALL)
    pages = {"expert": lambda: R.expert_pages(t, 1, 4), "facility": lambda: R.facility_detail_pages(t), "organization": lambda: R.organization_detail_pages(t)}
    text = plan(page_sections(profile.section_trees(pages[kind]()), kind))
    assert text.count("MapInArrow") == 1
    after = text[: text.index("MapInArrow")]
    assert "Exchange" not in after and "Generate" not in after and "Join" not in after


def test_a_profile_moves_neither_markup_nor_nodes(spark):
    t = R.Tables(spark, SMALL)
    pages = R.expert_pages(t, 1).withColumn("url", F.col("page_id").cast("string"))
    df = profile.profiles("expert", R.experts_master(t), pages, F.lit(None).cast("timestamp"))
    text = plan(df)
    assert text.count("MapInArrow") == 1
    assert not re.search(r"Exchange[^\n]*\n[^\n]*MapInArrow", text)


def test_first_row_per_key_is_cut_before_the_exchange(spark):
    text = plan(QUERIES["keep_first"](spark, SMALL))
    assert re.search(r"WindowGroupLimit [^\n]*Partial", text)
    text = plan(QUERIES["attempt_outcome"](spark, SMALL))
    assert re.search(r"WindowGroupLimit [^\n]*4, Partial", text)


def test_scans_read_needed_columns(spark):
    text = plan(QUERIES["page_links"](spark, SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text
    text = plan(QUERIES["page_hosts"](spark, SMALL))
    assert "ReadSchema: struct<url:string>" in text


def test_a_stored_node_table_prunes_columns_and_tags(spark, tmp_path):
    from pagetables.operators.listing import links_in_lists
    from pagetables.sources.tables import write_nodes

    t = R.Tables(spark, SMALL)
    write_nodes(html_nodes(t.captured), str(tmp_path / "nodes"))
    text = plan(links_in_lists(spark.read.parquet(str(tmp_path / "nodes"))))
    assert "EqualTo(tag,a)" in text and "text:string" not in text


@pytest.mark.parametrize("name", ["running_total", "batch_ids"])
def test_numbering_needs_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "SinglePartition" not in text and "MapInArrow" not in text  # pages were read once, before
