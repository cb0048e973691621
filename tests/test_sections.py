import pytest
from pyspark.sql import functions as F

from pagetables.operators import grid, kv, listing, panels, sections
from pagetables.plans import profile
from pagetables.sources.html import page_trees


def bar(*contents):
    return '<ul class="k-panelbar">' + "".join(f'<li class="k-item"><a class="k-link" href="#">P</a><div class="k-content">{c}</div></li>' for c in contents) + "</ul>"


def by_id(**contents):
    items = "".join(f'<li id="ProfileBar-{n[1:]}" class="k-panelbar-header">{c}</li>' for n, c in contents.items())
    return f'<ul class="k-panelbar">{items}</ul>'


def row(label, value, width=9, attr=""):
    return f'<div class="row"><div class="col-md-3"><label{attr}>{label}</label></div><div class="col-md-{width}">{value}</div></div>'


def a_grid(heads, *rows, cls="k-master-row", extra=""):
    th = "".join(f"<th>{h}</th>" for h in heads)
    trs = "".join(f'<tr class="{cls}">' + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f'<div class="k-grid"><table><thead><tr>{th}</tr></thead><tbody>{trs}{extra}</tbody></table></div>'


@pytest.fixture
def section(spark, pages_of):
    def run(kind, html, *names):
        found = sections.page_sections(profile.section_trees(pages_of(html)), kind, only=names).collect()
        if not found:
            return None
        out = [found[0][n].asDict(True) if hasattr(found[0][n], "asDict") else found[0][n] for n in names]
        return out[0] if len(out) == 1 else out

    return run


@pytest.fixture
def pairs(pages_of):
    def run(rules, html):
        found = panels.each_panel(page_trees(pages_of(bar(html))), "item", lambda inside: kv.fields(inside, rules), "fields")
        return [tuple(e) for e in found.select(F.map_entries("fields").alias("e")).first()["e"]]

    return run


@pytest.fixture
def records(pages_of):
    def run(flavor, html, **kw):
        build = lambda inside: grid.grid_records(inside, flavor, **kw)
        return panels.each_panel(page_trees(pages_of(bar(html))), "item", build, "rows").first()["rows"]

    return run


def test_repeated_label_keeps_place_and_last_value(pairs):
    html = row("A", "1", attr=' for="a"') + row("B", "2") + row("A", "3", attr=' for="a"')
    assert pairs(kv.FACILITY, html) == [("a", "3"), ("B", "2")]


def test_blank_values(pairs):
    html = row("Name:", " ") + row("", "x")
    assert pairs(kv.FACILITY, html) == [("Name", ""), ("", "x")]
    assert pairs(kv.ORGANIZATION, html) == []


def test_two_links_in_a_value(pairs):
    html = row("Reach us", '<a href="mailto:m">m</a> <a href="tel:1"> 1</a>')
    assert pairs(kv.FACILITY, html) == [("Email", "m")]
    assert pairs(kv.ORGANIZATION, html) == [("Email", "m"), ("Phone", "1")]


def test_link_addresses(pairs):
    html = row("Site", '<a href="javascript:x()">S</a>') + row("Bare", "<a>b</a>")
    assert pairs(kv.FACILITY, html) == [("Site", "S"), ("Site_URL", "javascript:x()"), ("Bare", "b"), ("Bare_URL", "")]
    assert pairs(kv.ORGANIZATION, html) == [("Site", "S"), ("Bare", "b")]


def test_value_order_icon_link_rating_text(pairs):
    icon = '<span class="k-icon k-i-check"></span><a href="/x">x</a>t'
    html = row("I", icon) + row("R", '<span class="k-rating" aria-valuenow="3"></span>t') + row("N", '<span class="k-rating"></span>')
    assert pairs(kv.FACILITY, html) == [("I", "x t".replace(" ", "")), ("R", "3"), ("N", "Not Rated")]
    assert pairs(kv.ORGANIZATION, html)[0] == ("I", "Yes")


def test_value_column_choice(pairs):
    first_wide = '<div class="row"><div class="col-md-2"><label>K</label></div><div class="col-md-4">no</div><div class="col-md-8">yes</div></div>'
    other = '<div class="row"><div class="col-xs-2"><label>L</label></div><div class="col-xs-1"> </div><div class="col-xs-4">v</div></div>'
    six = row("M", "six", width=6)
    assert pairs(kv.FACILITY, first_wide + other + six) == [("K", "yes"), ("L", ""), ("M", "six")]
    assert pairs(kv.ORGANIZATION, first_wide + other + six) == [("K", "yes"), ("L", "v"), ("M", "six")]
    assert pairs(kv.EXPERT_DETAILS, first_wide + other + six) == []


def test_breadcrumb_value(pairs):
    html = row("Path", '<ol class="breadcrumb"><li>A</li><li> </li><li>B</li></ol>')
    assert pairs(kv.ORGANIZATION, html) == [("Path", "A > B")]
    assert pairs(kv.FACILITY, html) == [("Path", "A B")]


def test_nested_rows(pairs):
    inner = row("In", "1") + row("On", "2")
    html = f'<div class="row"><div class="col-md-9">{inner}</div></div>'
    assert pairs(kv.FACILITY, html) == [("In", "1"), ("On", "2")]


def test_blank_header_and_missing_header(records):
    html = a_grid([" ", "A", "B"], ["1", "2", "3"])
    assert records("facility", html) == [{"A": "1", "B": "2", "Column_2": "3"}]
    assert records("facility", html, header_mode="positional") == [{"Column_0": "1", "A": "2", "B": "3"}]


def test_grid_cells_with_links_and_icons(records):
    cells = ['<a href="mailto:m@x">m</a>', '<a href="/p">p</a> tail', '<a>n</a>', '<span class="k-icon k-i-close"></span>', '<a href="tel:5">5</a>']
    html = a_grid(["Who?", "Project", "N", "F", "T"], cells)
    assert records("facility", html) == [
        {"Who?": "m", "Who?_URL": "mailto:m@x", "Project": "p", "Project_URL": "/p", "N": "n", "N_URL": None, "F": "", "T": "5", "T_URL": "tel:5"}
    ]
    assert records("organization", html) == [
        {"Email": "m", "Project": "p", "Project_URL": "/p", "N": "n", "F": "No", "Phone": "5"}
    ]


def test_grid_rows_by_kind(records):
    html = a_grid(["A"], ["1"], [" "], extra='<tr><td>plain</td></tr><tr class="k-detail-row"><td>detail</td></tr>')
    assert records("facility", html) == [{"A": "1"}, {"A": ""}]
    assert records("organization", html) == [{"A": "1"}, {"A": "plain"}]


def test_no_data_line(records):
    shown = a_grid(["A"], ["1"], extra='<tr class="k-no-data"><td>none</td></tr>')
    hidden = a_grid(["A"], ["1"], extra='<tr class="k-no-data" style="display: none"></tr>')
    assert records("facility", shown) == [] and records("organization", shown) == []
    assert records("facility", hidden) == [{"A": "1"}] and records("organization", hidden) == [{"A": "1"}]


def test_first_grid_of_a_panel_counts(records):
    assert records("facility", a_grid(["A"]) + a_grid(["B"], ["2"])) == []
    assert records("facility", "<p>none</p>") is None


def test_missing_panels(section):
    html = bar("a", "b", "<ul><li>Ontario</li></ul>")
    got = section("facility", html, "Provinces_Served", "Contacts", "Facility_Descriptors", "Audit_Trail", "Web_Presence")
    assert got == [{"rows": [], "items": ["Ontario"]}, [], {"fields": {}, "rows": [], "tags": []}, {}, []]


def test_not_ready(section):
    assert section("organization", "<p>Sign in</p>", "Contacts") is None


def test_cascades(section):
    texts = bar("", "", "X, , Y", "x, y", '<span class="tag">Sectors Served</span><div class="chip">S</div>')
    got = section("facility", texts, "Provinces_Served", "Activities_Offered", "Sectors_Served")
    assert [g["items"] for g in got] == [["X", "Y"], [], ["S"]]
    naics = [bar("", "", "", c) for c in ("one; two, three", "one; two", "no delimiter", '<span class="badge">Q</span><span class="badge">QQ</span>')]
    assert [section("organization", h, "NAICS_Sectors")["items"] for h in naics] == [["one; two", "three"], ["one", "two"], [], ["QQ"]]


def test_contacts_from_cards(section):
    card = '<div class="card"><b>Bo</b><a href="mailto:b"> </a><small>Boss</small></div><div class="contact"><h5>Al</h5><span class="role"> </span></div>'
    assert section("organization", bar("", "", "", "", card), "Contacts") == [
        {"Name": "Bo", "Email": "", "Role": "Boss"}, {"Name": "Al"},
    ]
    assert section("facility", bar("", "", "", "", "", card), "Contacts") == [{"Email": ""}]


def test_locations(section):
    block = '<div class="location">1 Road <i class="city">Town</i><span class="state">ON</span><span class="zip"></span></div><address>x</address>'
    assert section("organization", bar("", "", "", "", "", block), "Locations") == [
        {"Address": "1 Road Town ON".replace(" ON", "ON"), "City": "Town", "Province": "ON", "Postal_Code": ""}
    ]
    assert section("facility", bar(*[""] * 6, block), "Locations") == [{"Address": "1 Road TownON"}, {"Address": "x"}]
    # a labelled row is itself a block for organizations
    assert section("organization", bar("", "", "", "", "", row("Street", "1 Road")), "Locations") == [{"Address": "Street 1 Road"}]
    assert section("facility", bar(*[""] * 6, row("Street", "1 Road")), "Locations") == [{"Street": "1 Road"}]


def test_activity(section):
    html = row("Status", "on") + '<a href="/Project/1">One</a><a href="/Request/2"> </a><a href="/Other">no</a>'
    assert section("organization", bar(*[""] * 8, html), "Activity") == [
        {"Status": "on"}, {"Project_Name": "One", "Project_URL": "/Project/1"},
    ]
    assert section("facility", bar(*[""] * 10, html), "Activity") == [{"Status": "on"}]


def test_expert_sections(section):
    no_data = '<div class="k-grid-norecords-template" style="display:none"></div>'
    html = by_id(
        p1=row("Contact", "none", attr=' for="Contact"') + row("Linked", '<span class="k-icon k-i-checkbox"></span>', attr=' for="IsLinkedToUser"')
        + row("Bio Text:", "b") + row("Empty", " "),
        p4='<div id="contactsGrid">' + a_grid(["a"], ["1", "2", "3"], ["1", "2", "3", "4", "5"]) + "</div>",
        p6='<div id="networksGrid">' + a_grid(["a"], ["F", "Yes"]) + no_data + "</div>",
        p8='<div id="otherGrid">' + a_grid(["a"], ["N", "T", "u"]) + "</div>",
        p9=a_grid(["a"], ['<a href="/p">P</a>x', "T", "O", "S"]),
    )
    names = ("General_Information", "Expertise", "Facility_Affiliation", "Web_Presence", "Activity", "Price_Availability", "Details")
    got = section("expert", html, *names)
    assert got[0] == {"Academic_Unit": "", "Email": "", "Phone": "", "IsLinkedToUser": "No", "Bio_Text:": "b", "Photo_URL": ""}
    assert [list(map(tuple, x)) for x in got[1:5]] == [[("1", "2", "3", "4")], [], [], [("P", "/p", "T", "O", "S")]]
    assert got[5:] == [{}, {}]


def test_listing_links(pages_of):
    def fac(cells):
        html = '<table><tr class="k-master-row">' + "".join(f"<td>{c}</td>" for c in cells) + "</table>"
        rows = grid.table_rows(page_trees(pages_of(html)))
        return listing.facility_listing(rows, F.lit("I"), F.lit(None).cast("timestamp")).first().asDict()

    assert fac(["B"]) == {"Institution": "I", "Branch": "B", "Facility_Name": "", "Facility_Type": "", "Manage_URL": "Not Found", "Scraped_At": None}
    assert fac(["B", "N", '<a href="/last">x</a>'])["Manage_URL"] == "/last"
    assert fac(['<a href="/no">x</a><a href="/e" title="Edit me">x</a>', "N", "T"])["Manage_URL"] == "/e"
    assert fac(['<a href="/u">View</a>', "N", "<a>gone</a>"])["Manage_URL"] == "/u"
    assert fac(['<a title="Details">v</a>', "N", ""])["Manage_URL"] == ""


def test_unchecked_box_without_title_is_no(pages_of):
    cells = ["", "", "", "Org", "P", "S", '<span class="k-icon k-i-checkbox"></span>', '<input type="checkbox" checked>', "<input type=checkbox>", ""]
    html = '<table><tr class="k-master-row">' + "".join(f"<td>{c}</td>" for c in cells) + "</table>"
    got = listing.organization_listing(grid.table_rows(page_trees(pages_of(html))), F.lit(None).cast("timestamp")).first()
    assert (got.Requests, got.Projects, got.Enabled, got.Manage_URL) == ("No", "Yes", "No", "Not Found")


def test_newest_capture_counts(spark):
    master = spark.createDataFrame([("O", "P", "S", "u")], "Organization_Name string, Provinces string, Sectors string, Manage_URL string")
    pages = spark.createDataFrame([(1, "u", bar(row("A", "old"))), (2, "u", bar(row("A", "new"))), (3, "v", bar(row("A", "x")))], "page_id bigint, url string, html string")
    got = profile.profiles("organization", master, pages, F.lit("2024-01-01").cast("timestamp")).collect()
    assert len(got) == 1 and got[0].General_Information == {"A": "new"}
    assert got[0].Meta.Organization_Name_From_List == "O" and got[0].Meta.Source_URL == "u"
