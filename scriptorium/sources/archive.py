"""Crawling an archive: the pages a manifest's crawl would reach, found in a table of fetched pages.

The frontier advances a level at a time. Each level is joined with the archive by URL and its links are filtered by the
scope before the join, so pages out of scope are never touched; visited URLs leave by an anti join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.urls import in_scope
from scriptorium.tables import shared_folder

HREF = r"""<a\s[^>]*?href\s*=\s*["']([^"'#\s]+)"""


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of the links of each page, absolute and without fragments; one row for each place.

    Root-relative, protocol-relative, absolute and sibling links are resolved; ../ steps too. Mail, script and in-page
    links are left out.
    """
    hosts = F.regexp_extract(url, r"^([a-z][a-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.concat(hosts, F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]+(/(?:[^?#]*/)?)", 1))
    raw = pages.select(F.col(url).alias("url"), hosts.alias("host"), F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(hosts, F.lit("/"))).alias("folder"), F.explode(F.regexp_extract_all(html, F.lit("(?i)" + HREF), F.lit(1))).alias("link"))
    raw = raw.where(~F.col("link").rlike(r"^(?i)(mailto|javascript|data|tel):"))
    link = F.replace(F.col("link"), F.lit("&amp;"), F.lit("&"))
    full = F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), link).when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract("url", "^([a-z]+:)", 1), link))
    full = full.when(F.startswith(link, F.lit("/")), F.concat("host", link)).otherwise(F.concat("folder", F.regexp_replace(link, r"^(\./)+", "")))
    return raw.select("url", full.alias("full")).select("url", F.when(F.col("full").rlike(r"/\.\.?(/|[?]|$)"), without_dots(F.col("full"))).otherwise(F.col("full")).alias("target"))


def without_dots(url: Column) -> Column:
    """An absolute URL with its ./ and ../ steps taken, however many; steps above the root stay at the root."""
    top, path, query = (F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)/?([^?]*)([?].*)?$", k) for k in (1, 2, 3))
    steps = F.split(path, "/")
    last = F.element_at(steps, -1).isin(".", "..")
    steps = F.when(last, F.concat(steps, F.array(F.lit("")))).otherwise(steps)
    put = lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    return F.concat(top, F.lit("/"), F.array_join(F.aggregate(steps, F.array().cast("array<string>"), put), "/"), F.coalesce(query, F.lit("")))


def crawl(archive: DataFrame, seed: str, allow: list[str], deny: list[str], max_pages: int) -> DataFrame:
    """Rows of archive(url, html, ...) in the order a breadth-first crawl from seed reaches them, with level; max_pages at most.

    Within a level pages go by URL. The cap is the crawl's own limit, and the only one: levels go on until no page is
    new. Links and levels are tables in the folder of spark.checkpoint.dir (shared_folder), so
    plans stay short however long a chain of pages is.
    """
    spark = archive.sparkSession
    folder = f"{shared_folder(spark)}/crawl-{uuid.uuid4().hex}"
    strings = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    found = page_links(archive).where(in_scope(F.col("target"), F.lit(seed), strings(allow), strings(deny))).distinct()
    found.join(archive.select(F.col("url").alias("target")), "target", "left_semi").select("url", "target").write.parquet(f"{folder}/links")
    links = spark.read.schema("url string, target string").parquet(f"{folder}/links")
    level, n = spark.createDataFrame([(seed,)], "url string").join(archive.select("url"), "url", "left_semi"), 0
    while True:
        level.write.parquet(f"{folder}/seen/level={n}")
        level = spark.read.schema("url string").parquet(f"{folder}/seen/level={n}")
        seen = spark.read.schema("url string, level int").parquet(f"{folder}/seen")
        if not level.head(1) or seen.count() >= max_pages:
            break
        level = links.join(level, "url", "left_semi").select(F.col("target").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        n += 1
    return archive.join(seen.orderBy("level", "url").limit(max_pages), "url").orderBy("level", "url")
