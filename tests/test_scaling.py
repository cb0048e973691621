"""What keeps the time of a query in step with its tables."""

from acceptance import queries
from pagetables.sources import html
from pagetables.streaming.listing import first_of_keys

RECORD = "Name string, page_no bigint, page_id bigint, row_pre int, _key string"


def test_first_of_keys_is_no_python_and_puts_missing_places_last(spark):
    rows = [("late", 2, 2, 1, "u"), ("first", 1, 7, 5, "u"), ("nowhere", None, None, None, "u"), ("alone", None, 1, 1, "v"), ("none", 1, 1, 1, None)]
    found = first_of_keys(spark.createDataFrame(rows, RECORD), ("_key",))
    assert sorted((r.Name, r._key) for r in found.collect()) == [("alone", "v"), ("first", "u"), ("none", None)]
    assert "Pandas" not in found._jdf.queryExecution().toString()


def test_landed_pages_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "work_dir", lambda s: str(tmp_path))

    class Done:
        def awaitTermination(self):
            pass

    monkeypatch.setattr(queries, "stream_listing", lambda *a: Done())
    t = queries.R.Tables(spark, "/root/testdata/sf0.001")
    queries.landed(t, "organization", spark.range(800).repartition(8))
    assert len(list((tmp_path / "landing").glob("*.parquet"))) == 8


def test_a_tag_written_the_same_way_is_read_once(monkeypatch):
    class Counting:
        n = 0

        def search(self, *a):
            self.n += 1
            return token.search(*a)

    token, counting = html._TOKEN, Counting()
    monkeypatch.setattr(html, "_TOKEN", counting)
    page = html.Page("<table>" + '<tr class="r"><td>a</td></tr>' * 500 + "</table>")
    assert page.tag.count("td") == 500 and counting.n < 20


def test_a_remembered_tag_does_not_hide_where_a_quote_closes():
    titles = lambda markup: [dict(zip(a[0], a[1])).get("title") for a in html.Page(markup).attrs]
    for _ in range(2):
        assert titles('<b title="x>') == ['"x']
        assert titles('<b title="x>y">z</b>') == ["x>y"]
