"""Checks of a corpus: duplicate bodies, coverage of manifests, and invariants that every build must keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_duplicates(pages: DataFrame, body: str = "body", key: str = "path") -> DataFrame:
    """(body_md5, copies, first_key) of bodies that more than one page has. Hashes are exchanged, bodies are not."""
    hashed = pages.select(F.md5(F.coalesce(F.col(body), F.lit("")).cast("binary")).alias("body_md5"), key)
    return hashed.groupBy("body_md5").agg(F.count("*").alias("copies"), F.min(key).alias("first_key")).where("copies > 1")


def uncovered(manifests: DataFrame, pages: DataFrame) -> DataFrame:
    """Manifests without any page."""
    have = pages.select("collection", "version").distinct()
    return manifests.join(have, ["collection", "version"], "left_anti")


def violations(pages: DataFrame) -> DataFrame:
    """(path, rule) of pages that break an invariant: a repeated source_url, a missing core key, or a path that names another version."""
    twice = pages.groupBy("source_url").agg(F.count("*").alias("n")).where("n > 1").select("source_url")
    core = [F.when(F.coalesce(F.col(k), F.lit("")) == "", F.lit(f"no {k}")) for k in ("collection", "version", "title", "source_url", "fetched_at_raw")]
    parts = F.split("path", "/")
    moved = F.when((parts[0] != F.col("collection")) | (parts[1] != F.col("version")), F.lit("path of another version"))
    each = pages.select("path", F.explode(F.array_compact(F.array(*core, moved))).alias("rule"))
    return each.unionByName(pages.join(twice, "source_url", "left_semi").select("path", F.lit("repeated source_url").alias("rule")))


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("collection", "version").agg(F.count("*").alias("pages"), F.max("fetched_at").alias("last_fetched"))
