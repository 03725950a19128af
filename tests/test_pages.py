"""Link discovery on literal pages and the skip-existing landing rule."""

from pyspark.sql import functions as F

from yellowstar.sources import new_files, page_links

PAGE = """<html><body>
<table><tr><td><ul>
  <li><a class="x" href=" https://host/data/yellow_tripdata_2023-01.parquet ">Jan</a></li>
  <li><a href="https://host/data/yellow_tripdata_2023-02.parquet">Feb</a></li>
  <li><a href="https://host/data/yellow_tripdata_2023-03.parquet">Mar</a></li>
</ul><ul>
  <li><a href="https://host/data/green_tripdata_2023-01.parquet">g</a></li>
  <li><a href="https://host/q?a=1&amp;f=yellow_x.parquet">amp</a></li>
</ul></td></tr></table>
<table><tr><td><ul><li><a href="https://host/yellow_second_table.parquet">no</a></li></ul></td></tr></table>
</body></html>"""


def test_first_table_first_two_items(spark):
    pages = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    got = page_links(pages, word="yellow", first_table_only=True).orderBy("list_pos", "item_pos").collect()
    assert [(r.list_pos, r.item_pos, r.filename) for r in got] == [
        (0, 0, "yellow_tripdata_2023-01.parquet"),
        (0, 1, "yellow_tripdata_2023-02.parquet"),
        (1, 1, "q?a=1&f=yellow_x.parquet"),
    ]
    assert got[0].link == "https://host/data/yellow_tripdata_2023-01.parquet"


def test_whole_page_without_table_restriction(spark):
    pages = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    names = {r.filename for r in page_links(pages, word="yellow").collect()}
    assert "yellow_second_table.parquet" in names


def test_word_is_case_sensitive(spark):
    pages = spark.createDataFrame([(1, "u", '<ul><li><a href="/Yellow.parquet">x</a></li></ul>')], "page_id long, url string, html string")
    assert page_links(pages, word="yellow").count() == 0


def test_new_files_first_occurrence_and_landed(spark):
    html = '<ul><li><a href="/a/yellow_1.parquet">x</a></li><li><a href="/b/yellow_2.parquet">y</a></li></ul>'
    later = '<ul><li><a href="/c/yellow_1.parquet">x</a></li></ul>'
    pages = spark.createDataFrame([(2, "u", later), (1, "u", html)], "page_id long, url string, html string")
    links = page_links(pages, word="yellow")
    got = {r.filename: (r.page_id, r.link) for r in new_files(links).collect()}
    assert got == {"yellow_1.parquet": (1, "/a/yellow_1.parquet"), "yellow_2.parquet": (1, "/b/yellow_2.parquet")}
    landed = spark.createDataFrame([("yellow_2.parquet",)], "filename string")
    assert [r.filename for r in new_files(links, landed).collect()] == ["yellow_1.parquet"]


def test_href_quoting_styles(spark):
    html = (
        "<ul><li><a class=x href='/s/yellow_single.parquet'>a</a></li>"
        "<li><A HREF=/u/yellow_bare.parquet>b</A></li></ul>"
        '<ul><li><a name="n">no link</a> <a href="/d/yellow_double.parquet">c</a></li></ul>'
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = sorted(r.filename for r in page_links(pages, word="yellow").collect())
    assert got == ["yellow_bare.parquet", "yellow_double.parquet", "yellow_single.parquet"]


def _tree_links(html, word):
    """Model: walk a parsed element tree like the original scraper did."""
    from html.parser import HTMLParser

    void = {"br", "img", "meta", "link", "hr", "input", "area", "base", "col", "source", "wbr"}

    class Node:
        def __init__(self, tag, attrs, parent):
            self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

        def find_all(self, tag):
            for c in self.children:
                if c.tag == tag:
                    yield c
                yield from c.find_all(tag)

    class Builder(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.root = self.cur = Node("#root", [], None)

        def handle_starttag(self, tag, attrs):
            node = Node(tag, attrs, self.cur)
            self.cur.children.append(node)
            if tag not in void:
                self.cur = node

        def handle_endtag(self, tag):
            n = self.cur
            while n is not None and n.tag != tag:
                n = n.parent
            if n is not None and n.parent is not None:
                self.cur = n.parent

    b = Builder()
    b.feed(html)
    out = []
    for ul in b.root.find_all("ul"):
        for li in list(ul.find_all("li"))[:2]:
            a = next((x for x in li.find_all("a") if x.attrs.get("href") is not None), None)
            if a is None:
                continue
            link = a.attrs["href"].strip()
            name = link.split("/")[-1].strip()
            if word in name:
                out.append((name, link))
    return out


def test_page_links_equal_tree_walk_on_pages_table(spark):
    from collections import Counter

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = Counter((r.page_id, r.filename, r.link) for r in page_links(pages, word="th").collect())
    want = Counter()
    for r in pages.select("page_id", "html").toLocalIterator():
        for name, link in _tree_links(r.html, "th"):
            want[(r.page_id, name, link)] += 1
    assert got == want and sum(got.values()) > 0


NESTED = """<table><tr><td>
<ul><li>intro <ul><li><a href="/a/yellow_inner.parquet">i</a></li><li>none</li></ul> <a href="/a/yellow_late.parquet">l</a></li>
<li><a name="n">no</a><a href="/b/yellow_second.parquet">s</a></li><li><a href="/c/yellow_third.parquet">t</a></li></ul>
<ul><li><ul><li><ul><li><a href="/d/yellow_deep.parquet">d</a></li></ul></li></ul></li></ul>
</td></tr></table><table><tr><td><ul><li><a href="/e/yellow_other_table.parquet">o</a></li></ul></td></tr></table>"""


def test_nested_lists_equal_tree_walk(spark):
    from collections import Counter

    from yellowstar.sources import nested_page_links

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html")
    inner = '<ul><li><a href="/sub/inner-th.csv">x</a></li></ul></li>'
    deep = pages.withColumn("html", F.replace("html", F.lit("</li>"), F.lit(inner)))
    deep = deep.withColumn("page_id", F.col("page_id") + 10**6)
    rows = [(-1, NESTED.replace("yellow", "th")), (-2, None), (-3, ""), (-4, "<ul></ul><li>")]
    every = pages.union(deep).union(spark.createDataFrame(rows, "page_id bigint, html string"))
    got = Counter((r.page_id, r.filename, r.link) for r in nested_page_links(every, word="th").collect())
    want = Counter()
    for r in every.toLocalIterator():
        for name, link in _tree_links(r.html or "", "th"):
            want[(r.page_id, name, link)] += 1
    assert got == want and sum(v for (p, *_), v in got.items() if p > 10**6) > 0


def test_nested_lists_of_the_first_table(spark):
    from yellowstar.sources import nested_page_links

    pages = spark.createDataFrame([(1, NESTED)], "page_id bigint, html string")
    got = nested_page_links(pages, first_table_only=True).orderBy("list_pos", "item_pos").collect()
    inner, deep = "yellow_inner.parquet", "yellow_deep.parquet"
    assert [(r.list_pos, r.item_pos, r.filename) for r in got] == [
        (0, 0, inner), (0, 1, inner), (1, 0, inner), (2, 0, deep), (2, 1, deep), (3, 0, deep), (3, 1, deep), (4, 0, deep),
    ]
