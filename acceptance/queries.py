"""One query per operator, over the given tables. ``oracle.py`` has the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import render as R
from acceptance.session import work_dir
from pagetables import schema
from pagetables.functions import text as X
from pagetables.operators import audit, grid, incremental, kv, listing, ordered, panels, sections, summary
from pagetables.plans import profile
from pagetables.sources import tables as io
from pagetables.sources.html import html_nodes, page_trees
from pagetables.streaming.listing import current_rows, stream_listing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LISTING_TAGS = ("tr", "td", "a", "span", "input")


def query(fn: Callable[[R.Tables], DataFrame]) -> Callable[[R.Tables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(R.Tables(spark, sf_dir))
    return fn


def no_time() -> Column:
    return F.lit(None).cast("timestamp")


def rows_of(pages: DataFrame, *carry: str) -> DataFrame:
    return grid.table_rows(page_trees(pages, carry, LISTING_TAGS), ("page_id", *carry))


def org_rows(t: R.Tables) -> DataFrame:
    return rows_of(R.organization_pages(t), "page_no")


def org_listing(t: R.Tables, *keep: str) -> DataFrame:
    return listing.organization_listing(org_rows(t), no_time(), keep)


def org_listing_placed(t: R.Tables) -> DataFrame:
    placed = listing.row_positions(org_rows(t))
    return listing.organization_listing(placed, no_time(), ("page_no", "row_ord"))


def fac_listing(t: R.Tables, *keep: str, pages: DataFrame | None = None) -> DataFrame:
    pages = R.facility_pages(t) if pages is None else pages
    rows = rows_of(pages, "g", "institution", "page_no")
    return listing.facility_listing(rows, F.col("institution"), no_time(), keep)


def ex_listing(t: R.Tables, *keep: str) -> DataFrame:
    rows = rows_of(R.expert_listing_pages(t), "institution")
    return listing.expert_listing(rows, F.col("institution"), no_time(), keep)


def id_of(url: str, cast: str = "bigint") -> Column:
    return F.regexp_extract(url, r"(\d+)$", 1).cast(cast)


def nations(t: R.Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("name"))


# --- pages and nodes -------------------------------------------------------------------


@query
def page_links(t):
    nodes = html_nodes(t.captured, tags=("a",), texts=())
    linked = nodes.filter(grid.attr("href").isNotNull())
    return linked.groupBy("page_id").agg(F.count("*").alias("n_links"))


@query
def page_tag_counts(t):
    nodes = html_nodes(t.captured, tags=("li", "h1", "p"), texts=())
    count = lambda tag: F.count_if(F.col("tag") == tag).alias(f"n_{tag}")
    return nodes.groupBy("page_id").agg(count("li"), count("h1"), count("p"))


@query
def page_head(t):
    nodes = html_nodes(t.captured, tags=("html", "title"), texts=("title",))
    return nodes.groupBy("page_id").agg(
        F.min_by(grid.attr("lang"), F.when(F.col("tag") == "html", F.col("pre"))).alias("lang"),
        F.min_by(X.clean_text(F.col("text")), F.when(F.col("tag") == "title", F.col("pre"))).alias("title"),
    )


@query
def page_nav(t):
    return listing.links_in_lists(html_nodes(t.captured, tags=("a",), texts=()))


@query
def page_hosts(t):
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host")
    return summary.count_by_group(t.pages.select(host), "host")


@query
def page_ready(t):
    """Every linked expert's page; the ones without a panel bar are not ready."""
    pages = R.expert_pages(t, 1)
    ready = profile.ready_pages(html_nodes(pages, tags=("ul", "li"), texts=()))
    return pages.select("page_id").join(ready.withColumn("r", F.lit(True)), "page_id", "left").select(
        "page_id", F.coalesce("r", F.lit(False)).alias("ready")
    )


@query
def dim_options(t):
    return listing.dropdown_options(html_nodes(R.option_pages(t), tags=("li",)))


# --- listings --------------------------------------------------------------------------


@query
def organizations_listing(t):
    return org_listing(t).drop("Scraped_At")


@query
def facilities_listing(t):
    return fac_listing(t).drop("Scraped_At")


@query
def experts_listing(t):
    return ex_listing(t).drop("Scraped_At")


@query
def arity_reject(t):
    return listing.organization_rejects(org_rows(t)).groupBy("reason").agg(F.count("*").alias("n"))


@query
def mapping_preview(t):
    preview = listing.mapping_preview(org_rows(t), ("page_no",))
    return preview.select("page_no", *[F.get("td", F.lit(i - 1)).alias(f"td_{i}") for i in (4, 5, 6)])


@query
def listing_pages(t):
    total = fac_listing(t, "g", pages=R.facility_pages(t)).groupBy("g").agg(F.count("*").alias("total"))
    return total.select("g", "total", X.pages_ceil(F.col("total")).alias("pages_ceil"), X.pages_estimate(F.col("total")).alias("pages_est"))


@query
def pager_parse(t):
    orgs = R.organizations(t).groupBy("page_no").agg(F.count("*").alias("n"))
    total = R.organizations(t).agg(F.count("*").alias("n")).scalar()
    first = F.col("page_no") * R.ORG_PAGE + 1
    pages = orgs.select(
        F.col("page_no").alias("page_id"), R.pager_text(first, first + F.col("n") - 1, total).alias("html")
    )
    pager = listing.pagers(html_nodes(pages, tags=("span",)))
    p = F.col("pager")
    return pager.select(
        F.col("page_id").alias("page_no"), p["first"].alias("first_item"), p["last"].alias("last_item"),
        p["total"].alias("total"), X.is_last_page(p).alias("is_last"),
    )


# --- sources and sinks -------------------------------------------------------------------


@query
def json_roundtrip(t):
    path = work_dir(t.spark)
    io.write_records(org_listing(t).withColumn("Scraped_At", F.lit("2024-01-01").cast("timestamp")), path, "json")
    back = io.read_master(t.spark, path, "organization")
    return back.select(
        F.col("Organization_Name").alias("name"), F.col("Provinces").alias("provinces"), F.col("Manage_URL").alias("manage_url")
    )


@query
def snapshot_explode(t):
    """A checkpoint per listing page, written and read back: its records counted by what they say and by unfolding."""
    path = work_dir(t.spark)
    records = org_listing(t, "page_no").withColumn("Organization_Name", R.cat(F.col("page_no"), "/", F.col("Organization_Name")))
    fields = F.struct(*schema.master_fields("organization"))
    saved = records.groupBy(F.col("page_no").alias("last_page_scraped")).agg(F.collect_list(fields).alias("data"))
    saved.withColumn("organizations_collected", F.size("data")).write.json(path)
    unfolded, progress = io.read_snapshot(t.spark, path, "organization", multi_line=False)
    page = F.split("Organization_Name", "/")[0].cast("bigint").alias("page_no")
    counts = unfolded.groupBy(page).agg(F.count("*").alias("n_records"))
    told = progress.filter(F.col("records") == F.col("processed")).select(F.col("cursor").alias("page_no"))
    return counts.join(told, "page_no")


@query
def flat_export(t):
    path = work_dir(t.spark)
    order = ["Organization_Name", "Provinces", "Sectors", "Enabled", "Not_There"]
    io.write_flat(org_listing(t), path, order)
    ddl = "name string, provinces string, sectors string, enabled string"
    return io.read_flat(t.spark, path, ddl)


# --- joins and incremental work -----------------------------------------------------------


@query
def profile_meta(t):
    pages = R.expert_pages(t, 1)
    ready = profile.ready_pages(html_nodes(pages, tags=("ul", "li"), texts=()))
    joined = profile.enrich(R.experts_master(t), pages, "expert", no_time()).join(ready, "page_id", "left_semi")
    return joined.select("Meta.Source_URL", "Meta.Institution", "Meta.Name_From_List", "Meta.Expert_ID", "Meta.Profile_URL")


@query
def error_reasons(t):
    pages = R.expert_pages(t, 1)
    ready = profile.ready_pages(html_nodes(pages, tags=("ul", "li"), texts=()))
    done = pages.select("page_id", "url").join(ready, "page_id", "left_semi")
    return profile.extraction_errors("expert", R.experts_master(t), done, no_time()).select("name", "reason")


@query
def errors_roundtrip(t):
    """Errors of two runs with their place in the master list, written, one run written again, and read back."""
    pages = R.expert_pages(t, 1)
    ready = profile.ready_pages(html_nodes(pages, tags=("ul", "li"), texts=()))
    done = pages.select("page_id", "url").join(ready, "page_id", "left_semi")
    errors = profile.extraction_errors("expert", R.experts_master(t), done, no_time(), index=F.col("k"))
    path = work_dir(t.spark)
    for run in (0, 1, 0):
        io.write_errors(errors.filter(F.col("index") % 2 == run), path, f"run{run}")
    return io.read_errors(t.spark, path).select("index", "name", "institution", "reason")


@query
def snapshot_batches(t):
    """Facilities saved in four batches, the last one interrupted before its commit: what counts, batch by batch."""
    path = work_dir(t.spark)
    rows = R.facilities(t)
    total = rows.count()
    done = 0
    for b in range(4):
        batch = rows.filter(F.col("k") % 4 == b).select("k", "facility_name")
        done += batch.count()
        state = t.spark.range(1).select(*audit.progress(F.lit(done), F.lit(total), F.lit(0)))
        if b < 3:
            io.write_snapshot(batch, state, path, b)
        else:
            io.write_batch(batch, f"{path}/data", b)
    records, log = io.snapshot_log(t.spark, path)
    return records.groupBy("batch_id").agg(F.count("*").alias("n")).join(log.select("batch_id", "processed", "total"), "batch_id")


@query
def partial_result(t):
    """A run stopped before its third batch was committed: what it had saved, kept as a master list under the run's id."""
    path = work_dir(t.spark)
    rows = fac_listing(t, "page_no")
    state = t.spark.range(1).select(*audit.progress(F.lit(0), F.lit(0), F.lit(0)))
    for b in range(3):
        batch = rows.filter(F.col("page_no") % 3 == b).drop("page_no")
        if b < 2:
            io.write_snapshot(batch, state, path, b)
        else:
            io.write_batch(batch, f"{path}/data", b)
    run = t.spark.range(1).select(X.run_id(F.lit("2024-01-01 12:30:00").cast("timestamp"))).first()[0]
    io.write_records(io.snapshot_log(t.spark, path)[0].drop("batch_id"), f"{path}/partial_{run}", "json")
    return io.read_master(t.spark, f"{path}/partial_{run}", "facility").drop("Scraped_At")


@query
def is_complete(t):
    """Each institution's run of expert pages: some with errors, some interrupted, some complete; two retirement rules."""
    g, k, linked, ready = F.col("g"), F.col("k"), X.valid_link(F.col("manage_url")), F.col("ready")
    runs = R.experts(t).groupBy("g").agg(
        F.count_if(linked & ready & ((g % 5 != 0) | (k % 2 == 0))).alias("p"),
        F.count_if(linked & (ready | (g % 3 != 0))).alias("t"),
        F.count_if(linked & ~ready & (g % 3 != 0)).alias("errors"),
    )
    log = runs.select("g", "errors", *audit.progress(F.col("p"), F.col("t"), F.col("errors"))).withColumn("batch_id", F.lit(1))
    first = log.withColumns({"batch_id": F.lit(0), "processed": F.lit(0).cast("bigint"), "errors": F.lit(0).cast("bigint")})
    path = work_dir(t.spark)
    for batch, rows in enumerate((first, log)):
        io.write_batch(rows.drop("batch_id"), path, batch)
    saved = t.spark.read.parquet(path)
    both = audit.retirable(saved, ["g"], need_all=True).select("g", F.col("may_retire").alias("is_complete"))
    clean = audit.retirable(saved, ["g"]).select("g", F.col("may_retire").alias("no_errors"))
    return saved.filter("batch_id = 1").select("g", "processed", "total", "errors").join(both, "g").join(clean, "g")


@query
def newest_capture(t):
    """Every second page captured again under a later id."""
    pages = t.pages.select("page_id", "url")
    again = pages.filter(F.col("page_id") % 2 == 0).withColumn("page_id", F.col("page_id") + 1_000_000_000)
    return profile.newest_pages(pages.unionByName(again)).select("url", "page_id")


@query
def append_new(t):
    """The batch is the whole listing, the enabled organizations are already stored."""
    orgs = R.organizations(t)
    listed = lambda rows: listing.organization_listing(
        listing.row_positions(rows_of(R.organization_pages(t, rows), "page_no")), no_time(), ("page_no", "row_ord", "cells")
    )
    existing, batch = listed(orgs.filter(F.col("enabled") == "Yes")), listed(orgs)
    fresh = incremental.append_new(existing, batch, "Manage_URL", ["page_no", "row_ord"])
    key = X.clean_text(F.get("cells", F.lit(0))["text"]).cast("bigint")
    return fresh.select(F.col("Manage_URL").alias("manage_url"), key.alias("k"))


@query
def keep_first(t):
    first = incremental.keep_first(org_listing_placed(t), "Manage_URL", ["page_no", "row_ord"])
    return first.select(F.col("Manage_URL").alias("manage_url"), (F.col("page_no") * 100 + F.col("row_ord")).alias("first_pos"))


@query
def resolve_option(t):
    """Each customer asks its nation's list box for a lab of its own number, by its whole name or with a suffix."""
    options = t.supplier.select(
        F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("idx"), F.concat(F.lit("Lab "), F.col("s_name")).alias("name")
    )
    named = F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Supplier"))
    target = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Lab "), named, F.lit(" (main)"))).otherwise(named)
    targets = t.customer.select(F.col("c_nationkey").alias("g"), target.alias("target"))
    return incremental.resolve_option(targets, options, ["g"])


@query
def pending(t):
    experts = R.experts_master(t).filter(X.valid_link(F.col("Manage_URL")))
    done = experts.filter(F.col("Expert_Type") == "Academic")
    pages = R.expert_pages(t, 1)
    ready = profile.ready_pages(html_nodes(pages, tags=("ul", "li"), texts=()))
    failed = pages.join(ready, "page_id", "left_anti").select(F.col("url").alias("Manage_URL"))
    return incremental.pending(experts, "Manage_URL", done, failed).select("k")


@query
def replace_groups(t):
    """The groups of one region are visited again and now show linked facilities only."""
    groups = t.nation.filter(F.col("n_regionkey") == 0).select(F.col("n_nationkey").alias("g"), F.col("n_name").alias("Institution"))
    again = R.facilities(t).join(groups, "g", "left_semi").filter(X.valid_link(F.col("manage_url")))
    fresh = fac_listing(t, pages=R.facility_pages(t, again))
    after = incremental.replace_groups(fac_listing(t), fresh, "Institution", groups)
    return after.groupBy(F.col("Institution").alias("institution")).agg(F.count("*").alias("n"))


@query
def removed_rows(t):
    """Rows a replacement drops."""
    groups = t.nation.filter(F.col("n_regionkey") == 0).select(F.col("n_name").alias("Institution"))
    return incremental.removed_counts(fac_listing(t), groups, "Institution").select(
        F.col("Institution").alias("institution"), "removed"
    )


@query
def still_empty(t):
    """The empty groups are visited again; the nations of one region now have rows."""
    empties = incremental.empty_groups(nations(t), fac_listing(t), "Institution")
    again = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).filter(F.col("n_regionkey") == 3)
    fresh = again.select(F.col("n_name").alias("Institution"))
    return incremental.still_empty(empties, fresh, "Institution").select("idx", "name")


@query
def empty_groups(t):
    """Nations without facilities; the last one could not be chosen."""
    resolved = nations(t).filter(F.col("idx") < 24)
    return incremental.empty_groups(nations(t), fac_listing(t), "Institution", resolved=resolved)


@query
def empty_selection(t):
    """Each order asks for two of the empty groups by number; orders marked P have a bad item."""
    empties = incremental.empty_groups(nations(t), fac_listing(t), "Institution")
    n = F.col("o_orderkey") % 3
    bad = R.pick(F.col("o_orderstatus") == "P", ", x", "")
    asks = t.orders.select("o_orderkey", R.cat(n + 22, ", ", n + 24, ",, ", bad).alias("choice"))
    return incremental.pick_empty(empties, asks, "choice", ["o_orderkey"])


def dataset_counts(t: R.Tables) -> DataFrame:
    """``g, phase, records``: what is there per nation for phases 1, 2, 3 and 5."""
    ex = R.experts(t)
    ready = ex.filter(X.valid_link(F.col("manage_url")) & F.col("ready"))
    orgs = t.customer.select(F.col("c_nationkey").alias("g"))
    out = None
    for phase, rows in ((1, ex), (2, ready), (3, R.facilities(t)), (5, orgs)):
        counts = rows.groupBy("g").agg(F.count("*").alias("records")).withColumn("phase", F.lit(phase))
        out = counts if out is None else out.unionByName(counts)
    return out


def registry(t: R.Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("g"), F.inline(schema.dataset_rows()))


@query
def ready_datasets(t):
    return audit.ready_datasets(registry(t), dataset_counts(t), ["g"]).select("g", "phase", "ready")


@query
def status_board(t):
    linked = X.valid_link(F.col("manage_url"))
    ex = R.experts(t).groupBy("g").agg(F.count_if(linked & F.col("ready")).alias("d"), F.count("*").alias("n"))
    small = F.col("facility_type") == "SMALL"
    fac = R.facilities(t).groupBy("g").agg(F.count_if(linked & small).alias("d"), F.count("*").alias("n"))
    done = ex.withColumn("phase", F.lit(2)).unionByName(fac.withColumn("phase", F.lit(4)))
    progress = done.select("g", "phase", *audit.progress(F.col("d"), F.col("n"), F.lit(0)))
    board = audit.status_board(registry(t), dataset_counts(t), progress, ["g"])
    return board.select("g", "phase", "name", "status", "records")


@query
def completeness(t):
    pager_pages = R.facility_pager_pages(t, F.col("n_nationkey") % 5)
    pagers = listing.pagers(html_nodes(pager_pages, carry=("g",), tags=("span",)), ("page_id", "g"))
    dim = t.nation.select(F.col("n_nationkey").alias("g"))
    return audit.completeness(dim, fac_listing(t, "g"), audit.claimed_totals(pagers, "g"), "g")


@query
def activity_union(t):
    """Grid rows of the experts' activity; linked and plain project names side by side."""
    found = sections_of(R.activity_pages(t), "expert", "Activity")
    rows = found.select("k", F.inline("Activity"))
    return rows.select(
        "k", F.col("Project_Name").alias("project_name"), F.col("Project_URL").alias("project_url"),
        F.col("Type").alias("type"), F.col("Current_Status").alias("current_status"),
    )


# --- aggregates, windows, status -----------------------------------------------------------


@query
def count_by_group(t):
    return summary.count_by_group(ex_listing(t), "Institution", 10).withColumnRenamed("Institution", "institution")


@query
def group_remainder(t):
    return summary.group_remainder(ex_listing(t), "Institution")


@query
def flag_counts(t):
    return summary.flag_counts(org_listing(t), requests_yes="Requests", projects_yes="Projects", enabled_yes="Enabled")


@query
def top_values(t):
    return summary.top_values(org_listing(t), "Provinces").withColumnRenamed("Provinces", "provinces")


def sections_of(pages: DataFrame, kind: str, *only: str, carry: str = "k") -> DataFrame:
    trees = profile.section_trees(pages.withColumn("k", F.col(carry)), ("k",))
    return sections.page_sections(trees, kind, ("k",), only)


def expert_sections(t: R.Tables, panel: int, section: str) -> DataFrame:
    return sections_of(R.expert_pages(t, panel), "expert", section, carry="page_id")


def facility_sections(t: R.Tables, *only: str) -> DataFrame:
    return sections_of(R.facility_detail_pages(t), "facility", *only, carry="page_id")


def organization_sections(t: R.Tables, *only: str) -> DataFrame:
    return sections_of(R.organization_detail_pages(t), "organization", *only, carry="page_id")


@query
def section_presence(t):
    found = summary.section_presence(expert_sections(t, 4, "Expertise"), {"expertise": F.col("Expertise")})
    return found.select("profiles", "with_expertise", "expertise_entries")


@query
def section_sizes(t):
    found = expert_sections(t, 4, "Expertise")
    return summary.section_sizes(found, ["k"], {"expertise": F.col("Expertise")})


@query
def harvest_totals(t):
    return summary.harvest_totals(fac_listing(t), "Institution", nations(t))


@query
def run_summary(t):
    failed = F.col("event_type") == "error"
    return summary.run_summary(t.events, "user_id", "event_type", failed, "ts", "ts").select(
        F.col("user_id").alias("run"), "completed", "failed", F.size("completed_phases").cast("bigint").alias("phases"), "seconds"
    )


@query
def running_total(t):
    return ordered.running_total(org_listing(t, "page_no"), "page_no")


def polls(t: R.Tables) -> DataFrame:
    n = (F.floor("value").cast("int") % 3).alias("n")
    return t.events.select(F.col("user_id").alias("page"), "ts", "event_id", n)


@query
def first_stable(t):
    stable = ordered.first_stable(polls(t), "page", ["ts", "event_id"])
    return stable.select("page", F.col("event_id").alias("stable_at"))


@query
def attempt_outcome(t):
    return ordered.classify_attempts(polls(t), "page", ["ts", "event_id"])


@query
def batch_ids(t):
    rows = fac_listing(t, "page_no", "row_pre")
    numbered = ordered.batch_ids(rows, ["Institution"], "page_no", ["row_pre"], 50)
    return numbered.groupBy(F.col("Institution").alias("institution"), "batch").agg(F.count("*").alias("n"))


@query
def progress_percent(t):
    facts = R.facilities(t).groupBy("g").agg(F.count("*").alias("c"), F.max("k").alias("m"))
    return facts.select("g", *audit.progress(F.col("c"), F.col("m") + 1, F.lit(0)))


@query
def latest_progress(t):
    """Newest progress of every user, an event being one save; zero and missing counters count as 0."""
    v = F.col("event_id")
    saves = t.events.select(
        F.col("user_id").alias("run"), (v % 4).alias("processed"), R.pick(v % 5 == 0, F.lit(None), v % 7).alias("total"),
        (v % 3).alias("cursor"), X.iso_time(F.col("ts")).alias("timestamp"),
    )
    return audit.latest_progress(saves, ["run"])


@query
def run_id_format(t):
    return t.orders.select(
        "o_orderkey", X.run_id(F.col("o_orderdate")).alias("run_id"), X.shown_time(F.col("o_orderdate")).alias("shown")
    )


# --- sections and scalars --------------------------------------------------------------------


def expert_grid(t: R.Tables, n: int, section: str) -> DataFrame:
    return expert_sections(t, n, section).select("k", F.inline(section))


@query
def expertise(t):
    return expert_grid(t, 4, "Expertise")


@query
def affiliation(t):
    return expert_grid(t, 6, "Facility_Affiliation")


@query
def web_presence(t):
    return expert_grid(t, 8, "Web_Presence")


@query
def price_flags(t):
    names = ["Daily_Rate", *sections.AVAILABILITY]
    return expert_sections(t, 5, "Price_Availability").select("k", *[F.col("Price_Availability")[n].alias(n) for n in names])


@query
def expert_general(t):
    names = ["Academic_Unit", "Enabled", "Email", "Phone", "Reputation_Score"]
    return expert_sections(t, 1, "General_Information").select("k", *[F.col("General_Information")[n].alias(n) for n in names])


@query
def breadcrumb(t):
    """The trail of every facility's first panel."""
    trees = page_trees(R.facility_detail_pages(t), tags=("ul", "ol", "li"))
    found = panels.each_panel(trees, "item", panels.crumbs, "crumbs").where(F.size("crumbs") > 0)
    names = F.filter("crumbs", lambda x: x != "")
    return found.select(F.col("page_id").alias("k"), F.array_join(names, " > ").alias("path"))


@query
def kv_pairs(t):
    """Labelled rows of the facilities' first panel, links, ratings and blanks included."""
    trees = profile.section_trees(R.facility_detail_pages(t))
    found = panels.each_panel(trees, "item", lambda inside: kv.fields(inside, kv.FACILITY), "fields", ids=["ProfileBar-1"])
    return found.select(F.col("page_id").alias("k"), F.explode("fields"))


@query
def grid_rows(t):
    """Experts' parts as a grid whose first cell is a link."""
    part = F.col("p_partkey")
    link = R.cat(f'<a href="{R.PORTAL}/P/', part, '">', part, "</a>")
    rows = (
        t.part.select(F.expr("p_partkey div 20").alias("k"), "p_partkey", R.row(R.td(link), R.td(F.col("p_brand"))).alias("html"))
        .groupBy("k")
        .agg(R.join_rows("p_partkey", "html").alias("rows"))
    )
    table = R.grid("Code,Research Area", F.col("rows"))
    pages = rows.select(F.col("k").alias("page_id"), R.bar(R.panel(1, table)).alias("html"))
    found = panels.each_panel(page_trees(pages), "item", lambda inside: grid.grid_records(inside, "facility"), "rows")
    record = found.select(F.col("page_id").alias("k"), F.posexplode("rows").alias("item_ord", "m"))
    return record.select("k", F.col("item_ord").cast("bigint"), *[F.col("m")[c].alias(c) for c in ("Code", "Research_Area", "Code_URL")])


@query
def section_items(t):
    parts = facility_sections(t, "Provinces_Served").select("k", F.col("Provinces_Served").alias("s"))
    stage = F.when(F.size("s.rows") > 0, "grid").when(F.col("k") % 3 == 1, "items").otherwise("text")
    names = F.when(F.size("s.rows") > 0, F.transform("s.rows", lambda m: m["Province"])).otherwise(F.col("s.items"))
    return parts.select("k", stage.alias("stage"), F.explode(names).alias("item"))


@query
def contacts(t):
    people = sections_of(R.contact_pages(t), "organization", "Contacts").select("k", F.explode("Contacts").alias("c"))
    return people.select("k", *[F.col("c")[n].alias(n) for n in ("Name", "Email", "Phone")])


@query
def locations(t):
    places = organization_sections(t, "Locations").select("k", F.explode("Locations").alias("p"))
    return places.select("k", *[F.col("p")[n].alias(n) for n in ("Address", "City")])


@query
def descriptors(t):
    d = F.col("Facility_Descriptors")
    return facility_sections(t, "Facility_Descriptors").select(
        "k", d["fields"]["Brand"].alias("descriptor_brand"), F.get(d["tags"], F.lit(0)).alias("tag"),
        F.size(d["rows"]).alias("n_list_rows"),
    )


@query
def link_kinds(t):
    """Links of all five kinds, one to a facility, from pages of fifty."""
    k = F.col("k")
    href = (
        F.when(k % 5 == 0, "mailto:a@example.com").when(k % 5 == 1, "tel:5").when(k % 5 == 2, "javascript:x()")
        .when(k % 5 == 3, "#top").otherwise("https://fac.example/")
    )
    pages = (
        R.facilities(t)
        .select((F.col("page_no") * 25 + F.col("g")).alias("page_id"), "k", R.cat('<a href="', href, '">x</a>').alias("html"))
        .groupBy("page_id")
        .agg(R.join_rows("k", "html").alias("html"))
    )
    links = html_nodes(pages, tags=("a",), texts=())
    return links.groupBy(X.link_kind(grid.attr("href")).alias("kind")).agg(F.count("*").alias("n"))


@query
def expert_facts(t):
    """Every section of the experts' profiles in long form."""
    pages = R.expert_pages(t, 1, 2, 3, 4, 5, 6, 8, 9, 10)
    full = profile.profiles("expert", R.experts_master(t), pages, no_time())
    return profile.section_facts(full).withColumnRenamed("page_id", "k")


@query
def facility_profiles(t):
    """The facilities' master list meets their pages: what the profiles carry over from the list."""
    url = R.cat(f"{R.PORTAL}/Fac/", F.col("page_id"))
    full = profile.profiles("facility", fac_listing(t), R.facility_detail_pages(t).withColumn("url", url), no_time())
    return full.select(
        F.col("page_id").alias("k"), F.col("Meta.Institution").alias("institution"), F.col("Meta.Facility_Name_From_List").alias("name"),
        F.col("Meta.Type_From_List").alias("type"), F.col("Meta.Source_URL").alias("source"),
    )


@query
def organization_profiles(t):
    """The organizations' master list meets their pages."""
    url = R.cat(f"{R.PORTAL}/Org/", F.col("page_id"))
    full = profile.profiles("organization", org_listing(t), R.organization_detail_pages(t).withColumn("url", url), no_time())
    return full.select(
        F.col("page_id").alias("k"), F.col("Meta.Organization_Name_From_List").alias("name"),
        F.col("Meta.Provinces_From_List").alias("provinces"), F.col("Meta.Sectors_From_List").alias("sectors"),
        F.col("Meta.Source_URL").alias("source"),
    )


@query
def facility_facts(t):
    """Every section of the facilities' profiles in long form."""
    return profile.section_facts(facility_sections(t), ("k",))


@query
def organization_facts(t):
    """Every section of the organizations' profiles in long form."""
    return profile.section_facts(organization_sections(t), ("k",))


@query
def clean_text(t):
    return t.documents.select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query
def parse_flag(t):
    status = F.col("o_orderstatus")
    classes = F.when(status == "F", F.array(F.lit("k-icon"), F.lit("k-i-checkbox-checked"))).when(
        status == "O", F.array(F.lit("k-icon"), F.lit("k-i-checkbox"))
    )
    flag = X.parse_flag(F.lit(None).cast("string"), classes, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", flag.alias("flag"))


@query
def normalize_key(t):
    text = F.concat("o_orderpriority", F.lit(" Level: ok?"))
    return t.orders.select("o_orderpriority", X.normalize_key(text, ":?").alias("key")).distinct()


@query
def split_list(t):
    text = R.cat(F.col("branch"), ", ,", F.col("facility_type"))
    items = R.facilities(t).select("k", F.posexplode(X.split_list(text)).alias("pos", "item"))
    return items.select("k", (F.col("pos") + 1).cast("bigint").alias("pos"), "item")


# --- streaming -------------------------------------------------------------------------------


def landed(t: R.Tables, kind: str, *drops: DataFrame) -> str:
    """Pages that land drop by drop, each taken in before the next; where the result lies."""
    base = work_dir(t.spark)
    for drop in drops:
        drop.write.mode("append").parquet(f"{base}/landing")
        stream_listing(t.spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", kind).awaitTermination()
    return f"{base}/out"


def in_drops(pages: DataFrame) -> list[DataFrame]:
    """All pages, the first ones of the listing first."""
    at = F.col("page_no")
    return [pages.filter(at < 3), pages.filter(at.between(3, 9)), pages.filter(at > 9)]


@query
def streamed_listing(t):
    """The organization pages taken in by a stream, one record per address kept."""
    out = landed(t, "organization", *in_drops(R.organization_pages(t).select("page_id", "page_no", "html")))
    return t.spark.read.parquet(f"{out}/data").select(F.col("Manage_URL").alias("manage_url"), "Provinces")


def visited(pages: DataFrame, visit: int) -> DataFrame:
    return pages.select("institution", F.lit(visit).cast("bigint").alias("visit"), "page_id", "page_no", F.lit("").alias("url"), "html")


@query
def streamed_facilities(t):
    """Facility pages in several batches; the groups of one region are visited again and now show linked facilities only."""
    groups = t.nation.filter(F.col("n_regionkey") == 0).select(F.col("n_nationkey").alias("g"))
    again = R.facilities(t).join(groups, "g", "left_semi").filter(X.valid_link(F.col("manage_url")))
    out = landed(t, "facility", *in_drops(visited(R.facility_pages(t), 1)), visited(R.facility_pages(t, again), 2))
    return current_rows(t.spark, out).select(
        F.col("Institution").alias("institution"), F.col("Facility_Name").alias("name"), F.col("Manage_URL").alias("manage_url")
    )


@query
def streamed_experts(t):
    """Expert pages in several batches, one record per institution and address."""
    pages = R.expert_listing_pages(t).withColumn("page_no", F.expr(f"page_id div {R.GROUPS}"))
    out = landed(t, "expert", *in_drops(visited(pages, 1)))
    return current_rows(t.spark, out).select(
        F.col("Institution").alias("institution"), F.col("Name").alias("name"), F.col("Manage_URL").alias("manage_url")
    )


@query
def stream_progress(t):
    """Records taken in by the end of the stream, as its progress rows say, and the number of batches."""
    out = landed(t, "organization", *in_drops(R.organization_pages(t).select("page_id", "page_no", "html")))
    rows = t.spark.read.parquet(f"{out}/progress")
    return rows.agg(F.max("processed").alias("processed"), F.count("*").alias("batches"))
