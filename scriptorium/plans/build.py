"""From manifests to a searchable index: the steps of a build in their order."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from scriptorium.operators import index, links, normalize
from scriptorium.sources import archive, checkout, corpus, manifests


def pages_of(spark: SparkSession, manifest: dict, source: DataFrame | str, fetched_at: str) -> DataFrame:
    """The pages of one manifest, from an archive of fetched pages or from the folder of a checkout.

    A crawl starts at the manifest's base URL and stays in its scope. Pages of a checkout get their local site links made
    relative, and links that lead nowhere are marked.
    """
    if manifest["source_type"] == "crawl":
        fetched = source.withColumn("html", source["content"].cast("string"))
        reached = archive.crawl(fetched, manifest["base_url"], manifest["allow_prefixes"], manifest["deny_prefixes"], manifest["max_pages"] or 2**31 - 1)
        return normalize.normalize_crawl(reached.drop("html", "level"), manifest)
    files = checkout.read_checkout(spark, source, manifest["docs_paths"] or ["."], manifest["exclude_globs"])
    pages = normalize.normalize_checkout(files, manifest, fetched_at)
    if manifest["shortcode_profile"] == "jekyll":
        site = (manifest["site_overrides"] or {}).get("site_url", manifest["repo_url"])
        return links.localize_routes(pages, site, marker="unresolved-jekyll-route")
    return links.mark_unresolved(pages)


def build(spark: SparkSession, manifest_folder: str, sources: dict[str, DataFrame | str], corpus_folder: str, index_folder: str, fetched_at: str) -> DataFrame:
    """Every manifest of a folder whose name has a source: normalised, written as a corpus tree, and indexed. Returns the pages.

    Site links that only another collection's pages answer get a comment that names it. The index is built from the tree
    as it was written, or refreshed where there is one already.
    """
    whole = None
    for row in manifests.read_manifests(spark, manifest_folder).collect():  # configuration, a few hundred rows
        manifest = row.asDict(recursive=True)
        if manifest["name"] in sources:
            pages = pages_of(spark, manifest, sources[manifest["name"]], fetched_at)
            whole = pages if whole is None else whole.unionByName(pages)
    if whole is None:
        raise ValueError("no manifest has a source")
    corpus.write_corpus(links.mark_cross_corpus(whole), corpus_folder)
    pages = corpus.read_corpus(spark, corpus_folder)
    if os.path.exists(f"{index_folder}/chunks"):
        index.refresh(pages, index_folder)
    else:
        index.build(pages, index_folder)
    return pages
