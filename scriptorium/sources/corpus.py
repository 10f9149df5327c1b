"""The corpus tree corpus/<collection>/<version>/<relpath>.md as a data source of its own.

Spark's file sources skip names that begin with '_' or '.', which would lose every _index.md; this one lists the tree
itself. Partitions are slices of the file list, so the files are read on the executors, and filters on collection and
version prune directories before anything is opened. The folder must be readable from everywhere; for repeated use
write the rows to Parquet once, partitioned by collection and version.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, InputPartition, WriterCommitMessage

from scriptorium.functions import frontmatter
from scriptorium.schema import PAGES, columns

FILES_PER_PARTITION = 256
NAMES = [name for name, _ in columns(PAGES)]


class _Files(InputPartition):
    def __init__(self, paths: list[tuple[str, str, str]]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, root: str, per_partition: int):
        self.root, self.per_partition, self.only = root, per_partition, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("collection",), ("version",)):
                self.only[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = []
        for collection in sorted(os.listdir(self.root)):
            if self.only.get("collection", collection) != collection or not os.path.isdir(f"{self.root}/{collection}"):
                continue
            for version in sorted(os.listdir(f"{self.root}/{collection}")):
                if self.only.get("version", version) != version:
                    continue
                top = f"{self.root}/{collection}/{version}"
                for folder, _, names in sorted(os.walk(top)):
                    found += [(collection, version, os.path.relpath(f"{folder}/{n}", top)) for n in sorted(names) if n.endswith(".md")]
        n = self.per_partition
        return [_Files(found[i : i + n]) for i in range(0, len(found), n)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for collection, version, relpath in partition.paths:
            path = f"{collection}/{version}/{relpath}"
            yield page_row(path, Path(self.root, path).read_bytes().decode("utf-8", "replace"))


def page_row(path: str, text: str) -> tuple:
    """A page file as a row of the page schema; collection and version come from the path."""
    collection, version, relpath = path.split("/", 2)
    block, body = frontmatter.split_page(text)
    row = frontmatter.fields(block)
    row |= {"path": path, "collection": collection, "version": version, "relpath": relpath, "body": body, "body_md5": hashlib.md5(body.encode()).hexdigest()}
    try:
        row["fetched_at"] = datetime.fromisoformat(row["fetched_at_raw"]) if row["fetched_at_raw"] else None
    except ValueError:
        row["fetched_at"] = None
    return tuple(row.get(n) for n in NAMES)


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator) -> WriterCommitMessage:
        for batch in iterator:
            for row in batch.to_pylist():
                path = Path(self.root, row["collection"], row["version"], row["relpath"])
                path.parent.mkdir(parents=True, exist_ok=True)
                part = path.with_name(f"{path.name}.{os.getpid()}.part")  # a retried task replaces whole files only
                part.write_text(page_text(row), encoding="utf-8")
                part.replace(path)
        return WriterCommitMessage()


def page_text(row: dict) -> str:
    """A row as a page file: frontmatter in schema order, further keys after it, then the body."""
    values = {k: row[k] for k in NAMES if k not in ("path", "relpath", "fetched_at", "fetched_at_raw", "extra", "body", "body_md5") and row.get(k) is not None}
    values["fetched_at"] = row.get("fetched_at_raw") or (row["fetched_at"].isoformat() if row.get("fetched_at") else None)
    return frontmatter.emit(values | dict(row.get("extra") or {})) + (row.get("body") or "")


class CorpusSource(DataSource):
    """spark.read.format("corpus").option("path", root), and df.write.format("corpus") for rows of the page schema."""

    @classmethod
    def name(cls) -> str:
        return "corpus"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("filesPerPartition", FILES_PER_PARTITION)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CorpusSource)
    return spark.read.format("corpus").option("path", root).load()


def write_corpus(pages: DataFrame, root: str) -> None:
    pages.sparkSession.dataSource.register(CorpusSource)
    pages.select(*NAMES).write.format("corpus").option("path", root).mode("append").save()
