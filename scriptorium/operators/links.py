"""Links between pages: resolution inside a version, unresolved markers, routes and redirects."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.urls import canonical_route, link_target, relative_link

LINK = re.compile(r"(?<!!)\[((?:[^\[\]]|\[[^\[\]]*\])*)\]\(\s*<?([^)\s>]+)>?(?:\s+\"[^\"]*\")?\s*\)")
PAGE_KEY = ["collection", "version", "relpath"]


def markdown_links(pages: DataFrame) -> DataFrame:
    """(collection, version, relpath, ordinal, label, link, target) of every link in every body; target is null where none is local."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, v, r, body in zip(b["collection"], b["version"], b["relpath"], b["body"], strict=True):
                rows += [(c, v, r, i, m[1], m[2], link_target(r, m[2])) for i, m in enumerate(LINK.finditer(body or ""))]
            yield pd.DataFrame(rows, columns=["collection", "version", "relpath", "ordinal", "label", "link", "target"])

    return pages.select(*PAGE_KEY, "body").mapInPandas(run, "collection string, version string, relpath string, ordinal int, label string, link string, target string")


def resolve(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds `resolved` to links with a local target: whether a page of the same collection and version has that path.

    A target x/ or x also stands for x/index.md, x.md and x/_index.md. Versions never see each other's pages: collection
    and version are part of the join key.
    """
    stem = F.regexp_replace("target", r"/$", "")
    forms = F.array_distinct(F.array("target", F.concat(stem, F.lit(".md")), F.concat(stem, F.lit("/index.md")), F.concat(stem, F.lit("/_index.md"))))
    wanted = links.where("target is not null").withColumn("form", F.explode(forms))
    have = pages.select("collection", "version", F.col("relpath").alias("form")).distinct().withColumn("hit", F.col("form"))
    out = wanted.join(have, ["collection", "version", "form"], "left")
    return out.groupBy("collection", "version", "relpath", "ordinal", "label", "link", "target").agg(F.min("hit").alias("resolved_path")).withColumn("resolved", F.col("resolved_path").isNotNull())


def unresolved(links: DataFrame, pages: DataFrame) -> DataFrame:
    return resolve(links, pages).where("not resolved").drop("resolved", "resolved_path")


def mark_unresolved(pages: DataFrame) -> DataFrame:
    """Bodies with a comment after each relative link whose page is missing."""
    gone = unresolved(markdown_links(pages), pages).groupBy(*PAGE_KEY).agg(F.collect_set("ordinal").alias("gone"))

    @F.pandas_udf("string")
    def marked(body: pd.Series, gone_: pd.Series) -> pd.Series:
        out = []
        for text, missing in zip(body, gone_, strict=True):
            missing = set() if missing is None else set(missing)
            turn = iter(range(10**9))
            out.append(LINK.sub(lambda m: m[0] + (f" <!-- unresolved-source-link: target={m[2]} -->" if next(turn) in missing else ""), text or "") if missing else text)  # noqa: B023
        return pd.Series(out)

    return pages.join(gone, PAGE_KEY, "left").withColumn("body", marked("body", "gone")).select(*pages.columns)


def routes(pages: DataFrame) -> DataFrame:
    """(collection, version, relpath, route, via): every route that leads to a page; `via` is canonical, permalink or redirect.

    A page's redirect from its own permalink is not a redirect.
    """
    key = [F.col(k) for k in PAGE_KEY]
    own = F.coalesce("canonical_route", canonical_route(F.col("canonical_url")))
    parts = [
        pages.where(own.isNotNull()).select(*key, own.alias("route"), F.lit("canonical").alias("via")),
        pages.where("permalink is not null").select(*key, F.col("permalink").alias("route"), F.lit("permalink").alias("via")),
        pages.select(*key, "permalink", F.explode("redirect_from").alias("route")).where(~F.col("route").eqNullSafe(F.col("permalink"))).select(*key, "route", F.lit("redirect").alias("via")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def collisions(pages: DataFrame, route: str = "canonical_route") -> DataFrame:
    """Adds `canonical_collision`: whether another page of the same collection and version has the route."""
    same = F.count("*").over(Window.partitionBy("collection", "version", route))
    routed = pages.where(F.col(route).isNotNull()).withColumn("canonical_collision", same > 1)
    return routed.unionByName(pages.where(F.col(route).isNull()).withColumn("canonical_collision", F.lit(False)))


def cross_corpus(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Site links (/route/) of a page that only another collection owns: with that collection."""
    site = links.where(F.startswith("link", F.lit("/"))).withColumn("route", F.regexp_replace("link", "#.*$", ""))
    owned = routes(pages).select(F.col("collection").alias("owner"), F.col("version").alias("owner_version"), "route").distinct()
    own = owned.select(F.col("owner").alias("collection"), F.col("owner_version").alias("version"), "route")
    return site.join(own, ["collection", "version", "route"], "left_anti").join(owned, "route").where("owner <> collection")


def mark_cross_corpus(pages: DataFrame) -> DataFrame:
    """Bodies with a comment after each site link that only another collection answers; of several, the first by name."""
    found = cross_corpus(markdown_links(pages), pages).groupBy(*PAGE_KEY, "ordinal").agg(F.min(F.concat_ws("/", "owner", "owner_version")).alias("owner"))
    plan = found.groupBy(*PAGE_KEY).agg(F.map_from_entries(F.collect_list(F.struct("ordinal", "owner"))).alias("plan"))  # no more entries than the page has links

    @F.pandas_udf("string")
    def marked(body: pd.Series, plan_: pd.Series) -> pd.Series:
        out = []
        for text, owners in zip(body, plan_, strict=True):
            owners = dict(owners) if owners is not None else {}
            turn = iter(range(10**9))

            def put(m: re.Match, owners=owners, turn=turn) -> str:
                owner = owners.get(next(turn))
                return m[0] + (f" <!-- cross-corpus-link: owner={owner} -->" if owner else "")

            out.append(LINK.sub(put, text or "") if owners else text)
        return pd.Series(out)

    return pages.join(plan, PAGE_KEY, "left").withColumn("body", marked("body", "plan")).select(*pages.columns)


IMAGE = re.compile(r"(!\[[^\]]*\]\(\s*<?)([^)\s>]+)(>?[^)]*\))")


def pin_assets(body: str, source_path: str, repo_url: str, git_ref: str) -> str:
    """Relative image paths become URLs at the commit; percent-encoding is undone first and put back by the URL's own rules.

    Absolute and site-absolute paths stay: what they mean is not known here.
    """

    def pinned(m: re.Match) -> str:
        target = link_target(source_path, m[2])
        return m[0] if target is None or target.startswith("../") else f"{m[1]}{repo_url}/blob/{git_ref}/{quote(target)}{m[3]}"

    return IMAGE.sub(pinned, body)


def localize_routes(pages: DataFrame, site: str, marker: str = "unresolved-site-link") -> DataFrame:
    """Bodies whose site links (/route/) lead to pages of the same version by relative path.

    A route that no page of the version has becomes an absolute URL under `site` with a marker comment. Routes are
    looked up by an equality join on (collection, version, route), so a version cannot lead into another.
    """
    found = markdown_links(pages).where(F.startswith("link", F.lit("/")))
    bare = F.regexp_replace("link", r"[?#].*$", "")
    found = found.withColumn("route", F.when(F.endswith(bare, F.lit("/")), bare).otherwise(F.concat(bare, F.lit("/")))).withColumn("bare", bare)
    known = routes(pages).groupBy("collection", "version", "route").agg(F.min("relpath").alias("to"))
    hits = found.join(known, ["collection", "version", "route"], "left")
    plan = hits.groupBy(*PAGE_KEY).agg(F.map_from_entries(F.collect_list(F.struct("ordinal", F.struct("to", "bare")))).alias("plan"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for here, body, steps in zip(b["relpath"], b["body"], b["plan"], strict=True):
                steps = dict(steps) if steps is not None else {}
                turn = iter(range(10**9))

                def put(m: re.Match, here=here, steps=steps, turn=turn) -> str:
                    step = steps.get(next(turn))
                    if step is None:
                        return m[0]
                    rest = m[2][len(step["bare"]) :]
                    if step["to"] is not None:
                        return f"[{m[1]}]({relative_link(here, step['to'])}{rest})"
                    return f"[{m[1]}]({site.rstrip('/')}{m[2]}) <!-- {marker}: route={step['bare']} -->"

                made.append(LINK.sub(put, body or "") if steps else body)
            b["body"] = made
            yield b.drop(columns=["plan"])

    names = [f.name for f in pages.schema]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.join(plan, PAGE_KEY, "left").select(*names, "plan").mapInPandas(run, kinds)


def leaves_version(links: DataFrame) -> DataFrame:
    """Relative links that climb out of their own collection and version: an invariant says there are none."""
    return links.where(F.startswith("target", F.lit("../")))
