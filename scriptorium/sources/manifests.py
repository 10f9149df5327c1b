"""Manifests: one TOML file for each crawl or checkout."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from scriptorium.schema import MANIFESTS, columns

REQUIRED = ("name", "collection", "version")


def parse_manifest(text: str) -> dict[str, object]:
    """A manifest as a row. Missing prefix lists are empty; a missing key that every manifest needs raises ValueError."""
    found = tomllib.loads(text)
    if missing := [k for k in REQUIRED if not found.get(k)]:
        raise ValueError(f"manifest lacks {', '.join(missing)}")
    out = {name: found.get(name) for name, _ in columns(MANIFESTS)}
    out["version"] = str(out["version"])
    for k in ("allow_prefixes", "deny_prefixes"):
        out[k] = out[k] or []
    out["source_type"] = out["source_type"] or "crawl"
    out["preserve_description"] = bool(out["preserve_description"])
    if out["delay_seconds"] is not None:
        out["delay_seconds"] = float(out["delay_seconds"])
    return out


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """All manifests of a folder; a manifest is configuration, a few hundred rows."""
    rows = [parse_manifest(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.toml"))]
    return spark.createDataFrame([tuple(r[name] for name, _ in columns(MANIFESTS)) for r in rows], MANIFESTS)
