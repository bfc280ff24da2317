"""Page extraction: links, ratings, review blocks and requirement rules.

A page's outline (see ``sources.html``) is one row, so every step below is an
array expression on that row: no shuffle, and nothing is joined to itself.  What
stands below, around or after a node is looked up by the places that the
parser noted, so the work grows with the page and not with its square.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.functions.text import bind, clean_text, normalize_name, null_if
from termscope.sources.html import BOXES, outline

LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def has_html(pages: DataFrame, html: str = "raw_html") -> DataFrame:
    """Pages whose HTML is not empty."""
    return pages.filter(F.col(html) != "")


def page_errors(pages: DataFrame, html: str = "raw_html", key: Sequence[str] = ("source_id",)) -> DataFrame:
    """Pages that the parser could not read, with its message; their other extracts are empty."""
    parsed = has_html(pages, html).select(*key, outline(F.col(html))["error"].alias("error"))
    return parsed.filter(F.col("error").isNotNull())


def with_outline(pages: DataFrame, html: str = "raw_html") -> DataFrame:
    """Replace the HTML column of non-empty pages by its outline ``page``."""
    return has_html(pages, html).withColumn("page", outline(F.col(html))).drop(html)


def _strings(page: Column, node: Column) -> Column:
    """Visible strings below a node, in document order."""
    part = F.slice(page["texts"], node["t0"] + 1, node["t1"] - node["t0"])
    return F.transform(part, lambda t: t["s"])


def _joined(page: Column, node: Column) -> Column:
    return F.array_join(_strings(page, node), " ")


def _lines(strings: Column) -> Column:
    """Cleaned non-empty lines of the strings."""
    lines = F.split(F.array_join(strings, "\n"), LINE_BREAK)
    return F.filter(F.transform(lines, clean_text), lambda s: s != "")


def _strip(col: Column) -> Column:
    return F.regexp_replace(col, STRIP, "")


def _below(nodes: Column, box: Column) -> Column:
    """The nodes below one, in document order."""
    return F.slice(nodes, box["at"] + 2, box["end"] - box["at"] - 1)


def page_text(pages: DataFrame, html: str = "raw_html", name: str = "raw_text") -> DataFrame:
    """Visible text of each page, one stripped non-blank line per line."""
    shown = F.filter(F.col("page")["texts"], lambda t: ~t["noscript"])
    strings = F.array_join(F.transform(shown, lambda t: t["s"]), "\n")
    lines = F.filter(F.transform(F.split(strings, LINE_BREAK), _strip), lambda s: s != "")
    return with_outline(pages, html).withColumn(name, F.array_join(lines, "\n")).drop("page")


def page_links(
    pages: DataFrame,
    base_url: str,
    href_regex: str = D.PROFESSOR_HREF,
    html: str = "raw_html",
    key: Sequence[str] = ("course_id",),
) -> DataFrame:
    """Professor links of listing pages: one row per page and absolute address.

    The name is the anchor text, else the first h1-h4 of the nearest enclosing
    list item, div, section or article.  A repeated address keeps its last name.
    """
    found = link_array(F.col("page"), base_url, href_regex)
    rows = with_outline(pages, html).select(*key, F.explode(found).alias("link"))
    return rows.select(*key, "link.*")


def link_array(page: Column, base_url: str, href_regex: str) -> Column:
    """Links of one page as an array, each address once."""
    nodes = page["nodes"]
    anchors = F.filter(
        nodes, lambda n: (n["tag"] == "a") & F.regexp_like(clean_text(n["href"]), F.lit(href_regex))
    )

    def noted(k: Column) -> Column:
        """The node at a place, null at -1."""
        return F.get(nodes, k)

    def box_heading(a: Column) -> Column:
        return bind(noted(noted(a["box"])["head"]), lambda h: normalize_name(_joined(page, h)))

    def link(a: Column) -> Column:
        name = bind(normalize_name(_joined(page, a)), lambda n: F.when(n != "", n).otherwise(box_heading(a)))
        return F.struct(
            name.alias("professor_name"),
            absolute_url(clean_text(a["href"]), base_url).alias("professor_page_url"),
        )

    named = F.filter(F.transform(anchors, link), lambda k: k["professor_name"] != "")

    def last_of_each(by_url: Column) -> Column:
        last = F.filter(by_url, lambda x, n: ~x["url"].eqNullSafe(F.get(by_url, n + 1)["url"]))
        newest_first = F.array_sort(F.transform(last, lambda x: F.struct((-x["n"]).alias("n"), x["name"].alias("name"), x["url"].alias("url"))))
        return F.transform(newest_first, lambda x: F.struct(x["name"].alias("professor_name"), x["url"].alias("professor_page_url")))

    numbered = F.transform(named, lambda k, n: F.struct(
        k["professor_page_url"].alias("url"), n.alias("n"), k["professor_name"].alias("name")))
    return bind(F.array_sort(numbered), last_of_each)


def link_order(links: DataFrame, *before: str) -> DataFrame:
    """Sort links by name without regard to case, then by address, for display or export; ``before`` columns come first."""
    return links.orderBy(*before, F.lower("professor_name"), "professor_page_url")


def absolute_url(href: Column, base_url: str) -> Column:
    """Address of a link found on a page of ``base_url`` (a site root)."""
    root = base_url.rstrip("/")
    scheme = root.split("://")[0]
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .otherwise(F.concat(F.lit(f"{root}/"), href))
    )


def page_ratings(
    pages: DataFrame,
    base_url: str,
    href_regex: str = D.PROFESSOR_HREF,
    html: str = "raw_html",
    key: Sequence[str] = ("course_id",),
    innermost: bool = False,
) -> DataFrame:
    """Rating and difficulty of each linked professor, from the listing page.

    The first container in document order whose text holds the name decides;
    ``innermost`` takes the smallest such container instead.
    """
    page = F.col("page")
    links = link_array(page, base_url, href_regex)
    people = F.array_distinct(F.transform(links, lambda k: k["professor_name"]))
    # What holds a name makes its enclosing containers hold it, so the first such container is an outermost one.
    wanted = F.filter(page["nodes"], lambda n: n["tag"].isin(*BOXES) & (F.lit(True) if innermost else n["box"] == -1))

    def box(n: Column) -> Column:
        return bind(_below(page["nodes"], n), lambda inside: F.struct(
            F.lower(_joined(page, n)).alias("text"), (n["stop"] - n["i"]).alias("size"),
            figure(inside, "rating").alias("rating"), figure(inside, "difficulty").alias("difficulty")))

    def figure(inside: Column, which: str) -> Column:
        first = F.get(F.filter(inside, lambda n: (n["tag"] == "p") & (n["id"] == which)), F.lit(0))
        return bind(first, lambda n: null_if(F.when(n.isNotNull(), F.array_join(_strings(page, n), ""))))

    outlined = with_outline(pages, html).select(*key, F.transform(wanted, box).alias("boxes"), people.alias("people"))

    def figures(name: Column) -> Column:
        hits = F.filter("boxes", lambda b: F.contains(b["text"], F.lower(name)))
        if innermost:
            smallest = F.array_min(F.transform(hits, lambda b: b["size"]))
            hits = F.filter(hits, lambda b: b["size"] == smallest)
        return bind(F.get(hits, F.lit(0)), lambda b: F.struct(
            name.alias("professor_name"), b["rating"].alias("rating"), b["difficulty"].alias("difficulty")))

    # Only the small results leave the page's row.  An outer explode keeps its
    # filter above, which would parse each page a second time below.
    found = outlined.select(*key, F.explode_outer(F.transform("people", figures)).alias("found"))
    return found.filter(F.col("found").isNotNull()).select(*key, "found.*")


def review_blocks(
    pages: DataFrame,
    html: str = "raw_html",
    leaf_only: bool = False,
    season: str = D.SEASON_LINE,
    updated: str = D.UPDATED_LINE,
) -> DataFrame:
    """Text blocks that look like reviews: adds ``position`` and ``lines``.

    Every container with four lines or more, an update line and a season line
    counts, enclosing containers included; equal blocks of a page count once.
    ``leaf_only`` drops containers that enclose another such container.
    """
    page = F.col("page")

    def is_review(b: Column) -> Column:
        lines = b["lines"]
        return (
            (F.size(lines) >= 4)
            & F.exists(lines, lambda s: s.rlike(updated))
            & F.exists(lines, lambda s: s.rlike(season))
        )

    boxes = F.transform(
        F.filter(page["nodes"], lambda n: n["tag"].isin(*BOXES)),
        lambda n: F.struct(n["i"].alias("i"), n["stop"].alias("stop"), _lines(_strings(page, n)).alias("lines")),
    )
    outlined = with_outline(pages, html).withColumn("found", F.filter(boxes, is_review))
    if leaf_only:
        # Containers stand in document order: one that encloses another is followed by it.
        outlined = outlined.withColumn(
            "found", F.filter("found", lambda b, n: ~F.coalesce(F.get("found", n + 1)["i"] < b["stop"], F.lit(False)))
        )
    # Lines hold no line break, and strings are told apart by hashes where arrays would be compared one by one.
    texts = F.array_distinct(F.transform("found", lambda b: F.array_join(b["lines"], "\n")))
    blocks = F.transform(texts, lambda t: F.split(t, "\n"))
    keep = [c for c in outlined.columns if c not in ("page", "found")]
    return outlined.select(*keep, F.posexplode(blocks).alias("position", "lines"))


def requirement_items(
    pages: DataFrame,
    headings: Sequence[str] = D.GROUP_HEADINGS,
    html: str = "raw_html",
) -> DataFrame:
    """Headings and the list items and paragraphs that follow them.

    Adds one row per item: heading_index (counts all headings of the page from
    1), group_name, rule_index (from 1 within the heading), display_order (from
    1 within the page) and text.
    """
    page = F.col("page")
    nodes = page["nodes"]
    heads = F.transform(
        F.filter(nodes, lambda n: n["tag"].isin(*headings)),
        lambda h, n: F.struct(h["rank"].alias("rank"), h["rank_end"].alias("rank_end"), (n + 1).alias("heading_index"), h["at"].alias("at")))

    def texts(n: Column) -> Column:
        bullets = F.transform(F.filter(_below(nodes, n), lambda m: m["tag"] == "li"), lambda m: _joined(page, m))
        return F.when(n["tag"].isin("ul", "ol"), bullets).when(n["tag"] == "p", F.array(_joined(page, n)))

    def group(by_rank: Column, h: Column, n: Column) -> Column:
        # The siblings behind a heading, up to the next heading among them.
        stop = F.least(h["rank_end"], F.coalesce(F.get(by_rank, n + 1)["rank"], h["rank_end"]))
        after = F.transform(F.slice(page["siblings"], h["rank"] + 2, stop - h["rank"] - 1), lambda k: F.get(nodes, k))
        listed = F.filter(after, lambda m: m["tag"].isin("ul", "ol", "p"))
        return F.struct(
            h["heading_index"].alias("heading_index"), _joined(page, F.get(nodes, h["at"])).alias("group_name"),
            F.filter(F.flatten(F.transform(listed, texts)), lambda s: s != "").alias("items"))

    grouped = bind(F.array_sort(heads), lambda by_rank: F.transform(by_rank, lambda h, n: group(by_rank, h, n)))
    groups = F.array_sort(grouped)  # back in document order
    rules = F.flatten(
        F.transform(
            F.filter(groups, lambda g: g["group_name"] != ""),
            lambda g: F.transform(
                g["items"],
                lambda text, n: F.struct(
                    g["heading_index"].alias("heading_index"),
                    g["group_name"].alias("group_name"),
                    (n + 1).alias("rule_index"),
                    text.alias("text"),
                ),
            ),
        )
    )
    outlined = with_outline(pages, html)
    keep = [c for c in outlined.columns if c != "page"]
    rows = outlined.select(*keep, F.posexplode_outer(rules).alias("position", "rule"))
    rows = rows.filter(F.col("rule").isNotNull())  # an inner explode would parse each page twice
    return rows.select(*keep, (F.col("position") + 1).alias("display_order"), "rule.*")
