"""Field extraction from web pages by wrappers that are induced from example pages.

Every page becomes the paths of its tag tree: the names of the tags from the root to an element, with `#` for
the element's own text or `@name` for an attribute. A path is stable on a site if most of the site's pages
have it exactly once. From pages whose field values are known, a site's wrapper for a field is the
stable path whose values agree with most of them; sites without examples use the path that is best over all
sites. No pattern is written by hand, and values are read off the path as they stand in the page.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.ranking import top_per_group
from fleetlake.sinks.tables import save_scratch

# Elements of HTML that have no content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DEEP = 64


class TagPaths(HTMLParser):
    """Occurrences and values of the tag paths of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open: list[str] = []
        self.texts: list[list[str]] = []
        self.found: dict[str, list] = {}  # path -> [times, value of the first]

    def _seen(self, path: str, value: str) -> None:
        known = self.found.setdefault(path, [0, value])
        known[0] += 1

    def _close(self) -> None:
        path, text = "/".join(self.open), "".join(self.texts.pop())
        self.open.pop()
        self._seen(path + "#", text)

    def handle_starttag(self, tag, attrs):
        if tag == "p" and "p" in self.open[-DEEP:]:  # a paragraph ends where the next one begins
            while self.open[-1] != "p":
                self._close()
            self._close()
        path = "/".join([*self.open, tag])
        for name, value in attrs:
            self._seen(f"{path}@{name}", value or "")
        if tag not in VOID and len(self.open) < DEEP:
            self.open.append(tag)
            self.texts.append([])

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open[-1] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if self.texts:
            self.texts[-1].append(data)

    def _reference(self, text: str) -> None:
        """A reference as it stands in the page, with its semicolon or without."""
        line, offset = self.getpos()
        ended = self.html.startswith(";", self.lines[line - 1] + offset + len(text))
        self.handle_data(text + ";" if ended else text)

    def handle_entityref(self, name):
        self._reference(f"&{name}")

    def handle_charref(self, name):
        self._reference(f"&#{name}")

    def paths(self, html: str) -> dict[str, list]:
        self.html, self.lines = html, [0, *(m.end() for m in re.finditer("\n", html))]
        self.feed(html)
        self.close()
        while self.open:
            self._close()
        return self.found


def page_paths(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page, host, path, times, value): the distinct tag paths of every page, value being that of the first
    occurrence. A null page has none; the host of a url without `://` is empty."""

    def parse(it):
        for batch in it:
            columns = [[], [], [], [], []]
            for page, host, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for path, (times, value) in TagPaths().paths(text).items():
                    for column, x in zip(columns, (page, host, path, times, value), strict=True):
                        column.append(x)
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["page", "host", "path", "times", "value"])

    host = F.lower(F.coalesce(F.regexp_extract(url, "^[^:]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.where(F.col(html).isNotNull()).select(F.col(page_id).cast("long"), host, F.col(html))
    return rows.mapInArrow(parse, "page long, host string, path string, times long, value string")


def path_support(paths: DataFrame) -> DataFrame:
    """(host, path, pages, once, support): pages of the site, those that have the path once, and their share.

    Counts combine before the shuffle, so a site with a third of all pages is one row a path and task.
    """
    sites = paths.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    once = paths.where("times = 1").groupBy("host", "path").agg(F.count(F.lit(1)).alias("once"))
    return once.join(sites, "host").select("host", "path", "pages", "once", (F.col("once") / F.col("pages")).alias("support"))


def induced(paths: DataFrame, examples: DataFrame, least: float = 0.8) -> DataFrame:
    """(host, field, path): each site's wrapper; host is null for the one of all sites.

    `examples` is (page, field, value). A path must be once on `least` of the site's pages. The path with
    most agreements wins, then the higher support, the shorter and the first path.
    """
    agree = paths.where("times = 1").join(examples.withColumnRenamed("value", "_value"), "page").where(F.col("value") == F.col("_value"))
    hits = agree.groupBy("host", "path", "field").agg(F.count(F.lit(1)).alias("hits"))
    stable = path_support(paths).where(F.col("support") >= least)
    own = hits.join(stable, ["host", "path"]).select("host", "field", "path", "hits", "support")
    every = own.groupBy("field", "path").agg(F.sum("hits").alias("hits"), F.max("support").alias("support"))
    order = [F.desc("hits"), F.desc("support"), F.length("path"), F.asc("path")]
    local = top_per_group(own, ["host", "field"], 1, *order).select("host", "field", "path")
    common = top_per_group(every, ["field"], 1, *order).select(F.lit(None).cast("string").alias("host"), "field", "path")
    return local.unionByName(common)


def extracted(paths: DataFrame, wrappers: DataFrame, fields: list[str]) -> DataFrame:
    """(page, one column per field): the value at the site's path, else at the path of all sites; null where
    the page has neither exactly once or the value is empty."""
    one = paths.where("times = 1").select("page", "host", "path", "value")
    local = one.join(wrappers.where("host IS NOT NULL"), ["host", "path"]).select("page", "field", F.lit(0).alias("rank"), "value")
    common = one.join(wrappers.where("host IS NULL").drop("host"), "path").select("page", "field", F.lit(1).alias("rank"), "value")
    best = local.unionByName(common).groupBy("page").agg(
        *[F.min(F.when(F.col("field") == f, F.struct("rank", "value")))["value"].alias(f) for f in fields]
    )
    pages = paths.select("page").distinct()
    return pages.join(best, "page", "left").select("page", *[F.nullif(F.col(f), F.lit("")).alias(f) for f in fields])


def induce_and_extract(pages: DataFrame, page_id: str, url: str, html: str, examples: DataFrame, fields: list[str]) -> DataFrame:
    """(page_id, fields) of every page, wrappers learned from `examples` (page, field, value)."""
    paths = save_scratch(page_paths(pages, page_id, url, html), "tag-paths")
    found = extracted(paths, save_scratch(induced(paths, examples), "wrappers"), fields)
    return pages.select(F.col(page_id).cast("long").alias("page")).join(found, "page", "left").withColumnRenamed("page", page_id)
