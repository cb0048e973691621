"""Portal-shaped pages rendered from the given tables.

Extracting these pages must give the tables' rows back; the SQL in ``oracle.py``
describes the same values. Everything is a Spark expression, and a page never holds more
than a fixed number of rows, so the rendered pages grow in number with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.sources.tables import read_pages

PORTAL = "https://portal.example"
ORG_PAGE = 100
FAC_PAGE = 50
EXPERT_PAGE = 500
GROUPS = 22  # facility groups; nations beyond have none


class Tables:
    """The given tables by name; ``captured`` is the page table as the library reads it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name == "captured":
            return read_pages(self.spark, f"{self.dir}/pages.parquet")
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pick(test: Column, yes: Column | str, no: Column | str) -> Column:
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(test, as_col(yes)).otherwise(as_col(no))


def yes_no(test: Column) -> Column:
    return pick(test, "Yes", "No")


def td(*content: Column | str) -> Column:
    return cat("<td>", *content, "</td>")


def row(*cells: Column) -> Column:
    return cat('<tr class="k-master-row">', *cells, "</tr>")


def join_rows(order: str, html: str) -> Column:
    """Aggregate: the rows' markup in order, as one text."""
    ordered = F.array_sort(F.collect_list(F.struct(order, html)))
    return F.array_join(F.transform(ordered, lambda r: r[html]), "")


def placed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a page together, over as many tasks as the session shuffles to.

    With a number of partitions given, small pages are not put together in one task; reading
    them afterwards is what takes time.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def grid_page(*body: Column | str) -> Column:
    return cat("<html><body><div><table><tbody>", *body, "</tbody></table></div></body></html>")


def pager_text(first: Column, last: Column, total: Column) -> Column:
    return cat('<span class="k-pager-info k-label">', first, " - ", last, " of ", total, " items</span>")


# --- organizations -----------------------------------------------------------------


def organizations(t: Tables) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("n_nationkey")
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == nation)
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("k"),
            F.expr("c_custkey div 100").alias("page_no"),
            (k % ORG_PAGE).alias("row_ord"),
            pick(k % 17 == 0, "", F.col("c_name")).alias("name"),
            pick(nation % 7 == 0, "", F.col("r_name")).alias("provinces"),
            F.col("c_mktsegment").alias("sectors"),
            yes_no(k % 2 == 0).alias("requests"),
            yes_no(k % 3 == 0).alias("projects"),
            yes_no(F.col("c_acctbal") > 0).alias("enabled"),
            pick(k % 11 == 0, "Not Found", cat(f"{PORTAL}/Org/", k)).alias("manage_url"),
            pick(k % 13 == 0, F.lit(9), F.lit(10)).alias("n_cells"),
        )
    )


def organization_pages(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """``page_id, page_no, html``: ``ORG_PAGE`` rows to a page.

    Flags are written by title, by icon class and by tick, one way per column.
    """
    titled = cat('<span class="k-icon k-i-box" title="', F.col("requests"), '"></span>')
    classed = pick(
        F.col("projects") == "Yes",
        '<span class="k-icon k-i-checkbox-checked"></span>',
        '<span class="k-icon k-i-checkbox"></span>',
    )
    ticked = pick(F.col("enabled") == "Yes", "✓", "✗")
    link = pick(
        F.col("manage_url") == "Not Found",
        "",
        cat('<div><a href="', F.col("manage_url"), '">Manage</a> <a href="#">Other</a></div>'),
    )
    html = row(
        td(F.col("k")), td(""), td("&nbsp;"), td("  ", F.col("name"), "\n"), td(F.col("provinces")),
        td(F.col("sectors")), td(titled), td(classed), td(ticked),
        pick(F.col("n_cells") == 10, td(link), ""),
    )
    return (
        (organizations(t) if rows is None else rows)
        .select("page_no", "row_ord", html.alias("html"))
        .transform(placed, "page_no")
        .groupBy("page_no")
        .agg(join_rows("row_ord", "html").alias("rows"))
        .select(F.col("page_no").alias("page_id"), "page_no", grid_page(F.col("rows")).alias("html"))
    )


# --- facilities ---------------------------------------------------------------------


def facilities(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.join(t.nation, F.col("n_nationkey") == k % GROUPS).select(
        k.alias("k"),
        F.col("n_nationkey").alias("g"),
        F.col("n_name").alias("institution"),
        F.col("p_brand").alias("branch"),
        F.col("p_name").alias("facility_name"),
        F.col("p_type").alias("facility_type"),
        pick(k % 9 == 0, "Not Found", cat(f"{PORTAL}/Fac/", k)).alias("manage_url"),
        F.expr(f"p_partkey div {GROUPS * FAC_PAGE}").alias("page_no"),
    )


def facility_pages(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """``page_id, g, institution, page_no, html``: ``FAC_PAGE`` rows of one group to a page."""
    link = cat('<a href="', F.col("manage_url"), '" title="View">Open</a>')
    has_link = F.col("manage_url") != "Not Found"
    early = F.col("k") % 5 == 0
    html = row(
        td(F.col("branch")),
        td(F.col("facility_name"), pick(has_link & early, cat(" ", F.replace(link, F.lit(">Open<"), F.lit("><"))), "")),
        td(F.col("facility_type")), td("3"), td("4"), td("Yes"), td(pick(has_link & ~early, link, "")),
    )
    return (
        (facilities(t) if rows is None else rows)
        .select("g", "institution", "page_no", "k", html.alias("html"))
        .transform(placed, "g", "institution", "page_no")
        .groupBy("g", "institution", "page_no")
        .agg(join_rows("k", "html").alias("rows"), F.count("*").alias("n"))
        .select(
            (F.col("page_no") * 25 + F.col("g")).alias("page_id"),
            "g", "institution", "page_no", "n", grid_page(F.col("rows")).alias("html"),
        )
    )


def facility_pager_pages(t: Tables, extra: Column) -> DataFrame:
    """One pager page per nation, claiming ``extra`` more rows than there are."""
    counts = facilities(t).groupBy("g").agg(F.count("*").alias("n"))
    total = F.coalesce("n", F.lit(0)) + extra
    text = pick(
        total == 0,
        '<span class="k-pager-info k-label">No items to display</span>',
        pager_text(F.least(F.lit(1), total), F.least(F.lit(50), total), total),
    )
    odd = '<span class="k-pager-info k-label">1 - 50 of 1,230 items</span>'  # a separator that no pager rule reads
    return t.nation.join(counts, F.col("n_nationkey") == F.col("g"), "left").select(
        F.col("n_nationkey").cast("bigint").alias("page_id"), F.col("n_nationkey").alias("g"),
        pick(F.col("n_nationkey") % 7 == 3, odd, text).alias("html"),
    )


# --- experts ------------------------------------------------------------------------


def experts(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        k.alias("k"),
        F.col("n_name").alias("institution"),
        F.col("n_nationkey").alias("g"),
        F.col("s_name").alias("name"),
        pick(F.col("s_acctbal") > 5000, "Academic", "Industry").alias("expert_type"),
        cat("Position ", k % 7).alias("position"),
        cat("Facility ", k % 10).alias("facility"),
        k.cast("string").alias("expert_id"),
        pick(k % 6 == 0, "Not Found", cat(f"{PORTAL}/Exp/", k)).alias("manage_url"),
        pick(k % 4 == 0, "Not Found", cat(f"{PORTAL}/Pub/", k)).alias("profile_url"),
        (k % 10 != 1).alias("ready"),
    )


def expert_listing_pages(t: Tables) -> DataFrame:
    """``page_id, institution, html``: the experts of one institution among ``EXPERT_PAGE`` keys."""

    def link(url: str, title: str) -> Column:
        tag = cat('<a href="', F.col(url), f'" title="{title}">{title}</a>')
        return pick(F.col(url) == "Not Found", "", tag)

    html = row(
        td(link("manage_url", "View Full Details"), link("profile_url", "View Profile")),
        cat('<td style="display:none">', F.col("expert_id"), "</td>"),
        td(""), td(""),
        cat('<td style="display:none">', F.col("facility"), "</td>"),
        td(""), td(F.col("expert_type")), td(F.col("position")), td("<b>", F.col("name"), "</b>"),
    )
    return (
        experts(t)
        .withColumn("block", F.expr(f"k div {EXPERT_PAGE}"))
        .select("g", "institution", "block", "k", html.alias("html"))
        .transform(placed, "g", "institution", "block")
        .groupBy("g", "institution", "block")
        .agg(join_rows("k", "html").alias("rows"))
        .select((F.col("block") * 25 + F.col("g")).alias("page_id"), "institution", grid_page(F.col("rows")).alias("html"))
    )


def labelled(label: str, value: Column | str, label_for: str | None = None, width: int = 9) -> Column:
    attr = f' for="{label_for}"' if label_for else ""
    return cat(
        f'<div class="row"><div class="col-md-3"><label{attr}>{label}</label></div>',
        f'<div class="col-md-{width}">', value, "</div></div>",
    )


def icon(test: Column) -> Column:
    return pick(
        test,
        '<span class="k-icon k-i-checkbox-checked" title="Yes"></span>',
        '<span class="k-icon k-i-checkbox"></span>',
    )


def panel(n: int, *content: Column | str) -> Column:
    return cat(
        f'<li id="ProfileBar-{n}" class="k-panelbar-header" aria-expanded="true">'
        f'<a class="k-link" href="#">Section {n}</a><div class="k-content">',
        *content,
        "</div></li>",
    )


def bar(*panels: Column | str) -> Column:
    return cat('<html><body><ul class="k-panelbar">', *panels, "</ul></body></html>")


def grid(head: str, rows: Column | str, grid_id: str | None = None, foot: Column | str = "") -> Column:
    """Grid with comma separated headers; ``foot`` comes after the rows."""
    heads = "".join(f"<th>{h}</th>" for h in head.split(","))
    attr = f' id="{grid_id}"' if grid_id else ""
    return cat(f'<div class="k-grid"{attr}><table><thead><tr>{heads}</tr></thead><tbody>', rows, foot, "</tbody></table></div>")


NO_DATA = '<tr class="k-no-data"><td colspan="4">No records found</td></tr>'


def expertise_rows(t: Tables) -> DataFrame:
    """``k, rows``: twenty parts to an expert."""
    html = row(td(F.col("p_partkey")), td(F.col("p_brand")), td(F.col("p_type")), td(" ", F.col("p_size")))
    return (
        t.part.select(F.expr("p_partkey div 20").alias("k"), "p_partkey", html.alias("html"))
        .groupBy("k")
        .agg(join_rows("p_partkey", "html").alias("expertise_html"))
    )


def chunked_id(k: Column, order_key: str) -> Column:
    """Page key for one ``k`` and a run of 65536 order keys, so that no page grows without bound."""
    return k * F.lit(1 << 24) + F.expr(f"{order_key} div 65536")


def activity_pages(t: Tables) -> DataFrame:
    """``page_id, k, html``: the orders of fifteen customers are an expert's activity; even ones are linked."""
    key, k = F.col("o_orderkey"), F.expr("o_custkey div 15")
    name = cat("Order ", key)
    linked = cat(f'<a href="{PORTAL}/Project/', key, '">', name, "</a>")
    html = row(td(pick(key % 2 == 0, linked, name)), td(F.col("o_orderpriority")), td("-"), td(F.col("o_orderstatus")))
    table = grid("Project,Type,Organization,Status", F.col("rows"), "webGrid")
    return (
        t.orders.select(k.alias("k"), chunked_id(k, "o_orderkey").alias("page_id"), "o_orderkey", html.alias("html"))
        .transform(placed, "page_id", "k")
        .groupBy("page_id", "k")
        .agg(join_rows("o_orderkey", "html").alias("rows"))
        .select("page_id", "k", bar(panel(9, table)).alias("html"))
    )


def affiliation_rows(t: Tables) -> DataFrame:
    """``region, rows``: the nations of a region."""
    html = row(td(F.col("n_name")), td(icon(F.col("n_nationkey") % 2 == 0)))
    return (
        t.nation.select("n_regionkey", "n_nationkey", html.alias("html"))
        .groupBy("n_regionkey")
        .agg(join_rows("n_nationkey", "html").alias("affiliation_html"))
    )


def web_rows() -> Column:
    """Up to three sites per expert: even ones linked, odd ones as text."""

    def one(i: Column) -> Column:
        k = F.col("k")
        url = cat("https://site.example/", k, "/", i)
        linked = cat('<a href="', url, '">site</a>')
        return row(
            td("Site ", i), td(pick(i % 2 == 0, "Social", "Home")), td(pick(i % 2 == 0, linked, cat("site.example ", i)))
        )

    sites = F.filter(F.array(*[F.lit(i) for i in range(3)]), lambda i: i < F.col("k") % 4)
    return F.array_join(F.transform(sites, one), "")


def expert_pages(t: Tables, *wanted: int) -> DataFrame:
    """``page_id, url, html``: a detail page per linked expert, with the wanted panels.

    Experts whose key ends in 1 get a page without a panel bar.
    """
    k = F.col("k")
    df = experts(t).transform(placed, "k")
    if 4 in wanted:
        df = df.join(expertise_rows(t), "k", "left")
    if 6 in wanted:
        df = df.join(affiliation_rows(t), k % 5 == F.col("n_regionkey"), "left")
    no_contact = cat('<a href="mailto:e', k, '@example.com"> e', k, '@example.com</a> <a href="tel:555">555-', k, "</a>")
    score = pick(
        k % 3 == 0,
        '<span class="k-rating" aria-valuenow="0"></span> Not Rated',
        cat('<span class="k-rating" aria-valuenow="', k % 5, '"><span class="k-icon k-i-star"></span></span>'),
    )
    table = (
        '<table class="table"><thead><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr></thead><tbody><tr>',
        *[td(icon(k % n == 0)) for n in (2, 3, 5, 7)],
        "</tr></tbody></table>",
    )
    rows = lambda c: F.coalesce(F.col(c), F.lit(""))
    panels = {
        1: lambda: panel(
            1,
            '<img alt="photo" src="/img/', k, '.png">',
            '<ol class="breadcrumb"><li>', F.col("institution"), "</li><li> </li><li>", F.col("facility"), "</li></ol>",
            labelled("Enabled", icon(k % 2 == 0), "Enabled"),
            labelled("Contact", no_contact, "Contact"),
            labelled("Reputation", score, "ReputationScore"),
            labelled("Expert Type", F.col("expert_type")),
        ),
        2: lambda: panel(2, labelled("Position", F.col("position"), "Position", 7), labelled("Bio Text", "", None, 9)),
        3: lambda: panel(3, labelled("Age Group", cat("Group ", k % 4), "ignored", 7)),
        4: lambda: panel(
            4,
            grid("Code,Area,Discipline,Field", rows("expertise_html"), "contactsGrid", pick(k % 3 == 0, NO_DATA, "")),
        ),
        5: lambda: panel(5, labelled("Daily Rate", cat("$", k + 100), "PerDiemRate"), *table),
        6: lambda: panel(6, grid("Name,Primary", rows("affiliation_html"), "networksGrid")),
        8: lambda: panel(8, grid("Name,Type,URL", web_rows(), "webGrid")),
        9: lambda: panel(9, grid("Project,Type,Organization,Status", row(*map(td, ("P", "T", "O", "S"))), "webGrid")),
        10: lambda: panel(10, labelled("Created", cat("Day ", k), "CreatedOn")),
    }
    html = pick(F.col("ready"), bar(*[panels[n]() for n in wanted]), "<html><body><p>Sign in</p></body></html>")
    return df.filter(F.col("manage_url") != "Not Found").select(
        k.alias("page_id"), F.col("manage_url").alias("url"), html.alias("html")
    )


def experts_master(t: Tables) -> DataFrame:
    """The expert listing as a stored master table would hold it."""
    return experts(t).select(
        "k",
        F.col("institution").alias("Institution"),
        F.col("name").alias("Name"),
        F.col("expert_type").alias("Expert_Type"),
        F.col("position").alias("Position"),
        F.col("facility").alias("Facility"),
        F.col("expert_id").alias("Expert_ID"),
        F.col("manage_url").alias("Manage_URL"),
        F.col("profile_url").alias("Profile_URL"),
    )


# --- facility and organization details ------------------------------------------------


def card(name: Column | str, mail: Column | str, phone: Column | str, role: Column | str = "") -> Column:
    return cat(
        '<div class="contact-card"><h4>', name, '</h4><a href="mailto:', mail, '">', mail, '</a> <a href="tel:', phone,
        '">', phone, '</a><span class="role">', role, "</span></div>",
    )


def spans(cls: str, *texts: Column | str) -> Column:
    return cat(*[x for t in texts for x in (f'<span class="{cls}">', t, "</span> ")])


def provinces_of(t: Tables) -> DataFrame:
    """``m, grid_rows, li_rows, names``: the regions up to number ``m``, in three writings."""
    upto = t.region.withColumn("m", F.explode(F.sequence("r_regionkey", F.lit(4))))
    marked = upto.select(
        "m", "r_regionkey", F.col("r_name"), row(td(F.col("r_name"))).alias("g"),
        cat("<li>", F.col("r_name"), "</li>").alias("l"), cat(F.col("r_name"), ", ").alias("c"),
    )
    return marked.groupBy("m").agg(
        join_rows("r_regionkey", "g").alias("as_grid"),
        join_rows("r_regionkey", "l").alias("as_list"),
        join_rows("r_regionkey", "c").alias("as_text"),
    )


def facility_detail_pages(t: Tables) -> DataFrame:
    """``page_id, url, html``: a page of twelve panels per facility."""
    k = F.col("k")
    name, branch, kind = F.col("facility_name"), F.col("branch"), F.col("facility_type")
    provinces = (
        F.when(k % 3 == 0, grid("Province", F.col("as_grid")))
        .when(k % 3 == 1, cat("<ul>", F.col("as_list"), "</ul>"))
        .otherwise(F.col("as_text"))
    )
    site = cat('<a href="https://fac.example/', k, '">Visit</a>')
    mail = cat('<a href="mailto:f', k, '@example.com">f', k, "@example.com</a>")
    hall = cat(
        '<div class="row"><div class="col-sm-3"><label>Hall</label></div><div class="col-sm-4">H', k % 4, "</div></div>"
    )
    html = bar(
        panel(
            1, labelled("Facility Name:", name), labelled("Website", site, "Site"), labelled("Contact", mail), hall,
            labelled("Rating", cat('<span class="k-rating" aria-valuenow="', pick(k % 5 == 0, "", (k % 5).cast("string")), '"></span>')),
            labelled("Notes", ""),
            '<ol class="breadcrumb"><li>', F.col("institution"), "</li><li>", branch, "</li></ol>",
            '<img alt="" src="/img/', k, '.png">',
        ),
        panel(2, labelled("Is Lab", icon(k % 2 == 0))),
        panel(3, provinces),
        panel(4, cat('<div class="chip">', branch, '</div><div class="chip">', kind, "</div>")),
        panel(5, cat("<ul><li>Sectors Served</li><li>", kind, "</li></ul>")),
        panel(6, card(name, cat("c", k, "@example.com"), cat("555-", k), "Lead")),
        panel(7, cat("<address>", k, " Main Street<br>", branch, "</address>")),
        panel(
            8, labelled("Brand", branch),
            grid("Item,Level", cat(row(td("One"), td(kind)), row(td("Two"), td("low")))), spans("tag", kind),
        ),
        panel(9, "English, , French"),
        panel(
            10, '<a href="https://fac.example/', k, '">Home</a> <a href="https://fac.example/more"> </a> ',
            '<a href="javascript:void(0)">No</a>',
        ),
        panel(11, labelled("Project", cat("P", k), "Project", 8)),
        panel(12, labelled("Created", cat("Day ", k), "Created", 10)),
    )
    return (
        facilities(t)
        .transform(placed, "k")
        .join(provinces_of(t), k % 5 == F.col("m"))
        .select(k.alias("page_id"), cat(f"{PORTAL}/Fac/", k).alias("url"), html.alias("html"))
    )


def contact_pages(t: Tables) -> DataFrame:
    """``page_id, k, html``: an order is a contact of its customer; a grid for even keys, cards for odd ones."""
    k, order = F.col("o_custkey"), F.col("o_orderkey")
    name, mail, phone = cat("Contact ", order), cat("o", order, "@example.com"), cat("555-", order)
    line = cat(
        "<tr><td>", name, '</td><td><a href="mailto:', mail, '">', mail, '</a></td><td><a href="tel:', phone, '">',
        phone, "</a></td></tr>",
    )
    html = pick(k % 2 == 0, line, card(name, mail, phone))
    content = pick(F.col("k") % 2 == 0, grid("Name,Mail,Call", F.col("rows")), F.col("rows"))
    return (
        t.orders.select(k.alias("k"), chunked_id(k, "o_orderkey").alias("page_id"), "o_orderkey", html.alias("html"))
        .transform(placed, "page_id", "k")
        .groupBy("page_id", "k")
        .agg(join_rows("o_orderkey", "html").alias("rows"))
        .select("page_id", "k", bar(*[panel(n) for n in range(1, 5)], panel(5, content)).alias("html"))
    )


def annual_rows(t: Tables) -> DataFrame:
    """``k, annual_html``: a grid row per year in which the customer ordered."""
    years = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return (
        years.select("o_custkey", "y", cat("<tr><td>", F.col("y"), "</td><td>", F.col("n"), "</td></tr>").alias("html"))
        .groupBy("o_custkey")
        .agg(join_rows("y", "html").alias("annual_html"))
    )


def organization_detail_pages(t: Tables) -> DataFrame:
    """``page_id, url, html``: a page of ten panels per organization."""
    k = F.col("k")
    name, sector, province = F.col("name"), F.col("sectors"), F.col("provinces")
    both = cat(
        '<a href="mailto:b', k, '@example.com">b', k, '@example.com</a><a href="tel:555">555-', k, "</a>"
    )
    path = cat('<ol class="breadcrumb"><li>', province, "</li><li>", sector, "</li></ol>")
    codes = (
        F.when(k % 3 == 0, spans("badge", sector, "x", cat("Code ", k % 7)))
        .when(k % 3 == 1, cat(sector, "; Code ", k % 7))
        .otherwise(cat("Code ", k % 7))
    )
    address = cat(k, " Main Street, <b class=\"city\">", sector, "</b>")
    place = pick(
        k % 2 == 0,
        cat('<div class="address">', address, "</div>"),
        grid("Address,City", cat("<tr><td>", k, " Main Street, ", sector, "</td><td>", sector, "</td></tr>")),
    )
    lead = pick(k % 2 == 0, cat('<p class="lead">', F.repeat(cat(sector, " "), F.lit(9)), "</p>"), '<p class="lead">short</p>')
    html = bar(
        panel(
            1, labelled("Legal Name:", name), labelled("Main Contact", both), labelled("Path", path, None, 6),
            '<img class="logo" src="/logo/', k, '.png">', lead,
        ),
        panel(
            2, labelled("Segment", sector),
            grid("Field?,Value", cat("<tr><td>Requests</td><td>", icon(k % 2 == 0), "</td></tr><tr><td></td></tr>")),
        ),
        panel(3, grid("Year,Orders", F.coalesce("annual_html", F.lit("")))),
        panel(4, codes),
        panel(5, card(cat("Desk ", k), cat("d", k, "@example.com"), cat("555-", k))),
        panel(6, place),
        panel(7, "<ul><li>Languages Serviced</li><li>English</li><li>F</li></ul>"),
        panel(
            8, '<a href="https://org.example/', k, '">Home</a><a href="#">Top</a><a href="javascript:x()">No</a>',
            '<a href="https://org.example/blank"></a>',
        ),
        panel(
            9, labelled("Requests", F.col("requests"), "Requests", 8),
            cat('<p><a href="/Project/', k, '">Project ', k, '</a> <a href="/Other">Other</a></p>'),
        ),
        panel(10, labelled("Created", cat("Day ", k)), grid("When,Who", cat("<tr><td>Day ", k, "</td><td>system</td></tr>"))),
    )
    return (
        organizations(t)
        .transform(placed, "k")
        .join(annual_rows(t), k == F.col("o_custkey"), "left")
        .select(k.alias("page_id"), cat(f"{PORTAL}/Org/", k).alias("url"), html.alias("html"))
    )


def list_page(tag: str, *content: Column | str) -> Column:
    return cat(f"<html><body><{tag}>", *content, f"</{tag}></body></html>")


def option_pages(t: Tables) -> DataFrame:
    """``page_id, html``: a list box of 25 suppliers to a page, with the placeholder and a blank option."""
    item = cat("<li>", F.col("s_name"), "</li>")
    return (
        t.supplier.select(F.expr("s_suppkey div 25").alias("page_id"), "s_suppkey", item.alias("html"))
        .transform(placed, "page_id")
        .groupBy("page_id")
        .agg(join_rows("s_suppkey", "html").alias("rows"))
        .select(
            "page_id",
            cat(
                '<html><body><ul id="HeiId_listbox" aria-hidden="false"><li>Select HEI</li><li> </li>', F.col("rows"),
                "</ul><ul><li>Not an option</li></ul></body></html>",
            ).alias("html"),
        )
    )
