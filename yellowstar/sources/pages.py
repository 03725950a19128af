"""Link discovery over a table of web pages and the skip-existing landing rule.

The reference fetched one page and walked its HTML tree on the driver. Here
the pages are a table: every page is an independent row, so discovery is a
per-row regex extraction (JVM-side, no Python) followed by explodes, and the
"write only if absent" rule becomes a first-occurrence aggregate plus an
anti join against what has already landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Patterns shared with the DuckDB oracle (Java and RE2 read them alike).
TABLE_PATTERN = r"(?is)<table\b.*?</table>"
LIST_PATTERN = r"(?is)<ul\b[^>]*>(.*?)</ul>"
ITEM_PATTERN = r"(?is)<li\b[^>]*>(.*?)</li>"
# one group per attribute quoting style: "double", 'single', unquoted
HREF_PATTERN = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _unescape(c: Column) -> Column:
    """Decode the character references an HTML parser resolves in attributes."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def page_links(
    pages: DataFrame,
    word: str = "yellow",
    items_per_list: int = 2,
    first_table_only: bool = False,
    html_col: str = "html",
    id_col: str = "page_id",
) -> DataFrame:
    """Links found in the first ``items_per_list`` items of every list.

    Output: ``page_id, list_pos, item_pos, link, filename`` with 0-based
    positions; ``filename`` is the last ``/`` segment of the link and must
    contain ``word`` (case-sensitive). ``first_table_only`` restricts the
    search to the first ``<table>`` of each page, as the original page
    layout required.

    Lists and tables are matched by their tags, not parsed as a tree: a list
    nested inside a list item ends the outer match at its own ``</ul>``
    (``nested_page_links`` follows the nesting).
    """
    scope = F.col(html_col)
    if first_table_only:
        scope = F.regexp_extract(scope, TABLE_PATTERN, 0)
    lists = pages.select(
        F.col(id_col).alias("page_id"),
        F.posexplode(F.regexp_extract_all(scope, F.lit(LIST_PATTERN), F.lit(1))).alias("list_pos", "list_html"),
    )
    items = lists.select(
        "page_id",
        "list_pos",
        F.posexplode(
            F.slice(F.regexp_extract_all("list_html", F.lit(ITEM_PATTERN), F.lit(1)), 1, items_per_list)
        ).alias("item_pos", "item_html"),
    )
    # exactly one group takes part in a match; the others extract ""
    href = F.concat(*[F.regexp_extract("item_html", HREF_PATTERN, g) for g in (1, 2, 3)])
    link = F.trim(_unescape(href))
    links = items.select("page_id", "list_pos", "item_pos", link.alias("link"))
    links = links.withColumn("filename", F.trim(F.element_at(F.split("link", "/"), -1)))
    return links.filter(F.col("filename").contains(word))


# opening and closing tags that decide which list an item and a link belong to
TAG_PATTERN = r"(?is)<(/?)(table|ul|li|a)\b[^>]*>"


def nested_page_links(
    pages: DataFrame,
    word: str = "yellow",
    items_per_list: int = 2,
    first_table_only: bool = False,
    html_col: str = "html",
    id_col: str = "page_id",
) -> DataFrame:
    """``page_links`` that follows nesting as a walk of the element tree does.

    Every list of a page counts, nested ones too, in the order of their
    opening tags; a list's items are all ``<li>`` inside it, those of nested
    lists included, and the first ``items_per_list`` of them are taken; an
    item's link is the first ``<a href>`` inside it. An element ends at the
    closing tag of its own depth (at the page's end if there is none).

    The tags, not the pages, are what travels: one running depth per page and
    kind of tag, then one small row of positions per page.
    """
    scope = F.col(html_col)
    tags = pages.select(
        F.col(id_col).alias("page_id"),
        F.posexplode(F.regexp_extract_all(scope, F.lit(TAG_PATTERN), F.lit(0))).alias("pos", "tag"),
    )
    tags = tags.select(
        "page_id",
        "pos",
        (F.regexp_extract("tag", TAG_PATTERN, 1) == "/").alias("closes"),
        F.lower(F.regexp_extract("tag", TAG_PATTERN, 2)).alias("kind"),
        F.concat(*[F.regexp_extract("tag", HREF_PATTERN, g) for g in (1, 2, 3)]).alias("href"),
    )
    same_kind = Window.partitionBy("page_id", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(F.when(F.col("closes"), -1).otherwise(1)).over(same_kind) + F.col("closes").cast("int")
    same_depth = Window.partitionBy("page_id", "kind", "depth").orderBy("pos")
    ends = tags.withColumn("depth", depth).withColumn("end", F.lead("pos", 1, 2**31 - 1).over(same_depth))
    ends = ends.filter(~F.col("closes"))

    def spans(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "end")))).alias(kind)

    linked = F.when((F.col("kind") == "a") & (F.col("href") != ""), F.struct("pos", "href"))
    page = ends.groupBy("page_id").agg(
        spans("table"), spans("ul"), spans("li"), F.sort_array(F.collect_list(linked)).alias("a")
    )
    if first_table_only:
        first = F.get("table", F.lit(0))
        inner = F.filter("ul", lambda u: (u["pos"] > first["pos"]) & (u["pos"] < first["end"]))
        page = page.withColumn("ul", inner)
    lists = page.select("page_id", "li", "a", F.posexplode("ul").alias("list_pos", "u"))
    inside = F.filter("li", lambda x: (x["pos"] > F.col("u.pos")) & (x["pos"] < F.col("u.end")))
    items = lists.select(
        "page_id", "list_pos", "a", F.posexplode(F.slice(inside, 1, items_per_list)).alias("item_pos", "i")
    )
    first_link = F.get(F.filter("a", lambda x: (x["pos"] > F.col("i.pos")) & (x["pos"] < F.col("i.end"))), F.lit(0))
    links = items.select("page_id", "list_pos", "item_pos", F.trim(_unescape(first_link["href"])).alias("link"))
    links = links.withColumn("filename", F.trim(F.element_at(F.split("link", "/"), -1)))
    return links.filter(F.col("filename").contains(word))


def file_names(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Last path segment of each landed file, as ``filename``."""
    return paths.select(F.element_at(F.split(path_col, "/"), -1).alias("filename"))


def new_files(links: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """Files a landing run writes: first link per file name, minus landed ones.

    The reference skips a file when it already exists, so within one crawl
    the first link (in page, list, item order) for each name wins and later
    ones are skipped. The per-name aggregate is partial (map-side), so a
    name that recurs on a third of all pages does not skew one task.
    """
    first = links.groupBy("filename").agg(
        F.min(F.struct("page_id", "list_pos", "item_pos", "link")).alias("_first")
    )
    out = first.select("filename", "_first.link", "_first.page_id", "_first.list_pos", "_first.item_pos")
    if landed is not None:
        out = out.join(landed.select("filename").distinct(), "filename", "left_anti")
    return out
