"""Documentation files of a local repository checkout, by a manifest's docs_paths and exclude_globs."""

from __future__ import annotations

import os
from collections.abc import Iterator
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source_path string, relpath string, kind string, content binary"
KINDS = {".md": "markdown", ".mdx": "mdx", ".rst": "rst", ".html": "html", ".json": "openapi"}


def corpus_path(path: str) -> str:
    stem, dot, end = path.rpartition(".")
    return f"{stem}.md" if dot and f".{end}" in (".mdx", ".rst", ".html") else path


def listed_files(root: str, docs_paths: list[str], exclude_globs: list[str] | None = None) -> list[tuple[str, str]]:
    """(source path, corpus path) of every file the manifest takes.

    An entry of docs_paths is a folder, whose name is stripped from the corpus path, or a single file, which keeps its
    basename. Globs apply to the path below the entry. Symbolic links are followed while they stay inside the checkout.
    Where two files would get one corpus path, the one inside a folder keeps its full source path.
    """
    real = os.path.realpath(root)
    inside = lambda p: os.path.realpath(p) == real or os.path.realpath(p).startswith(real + os.sep)
    found: list[tuple[str, str, bool]] = []
    for entry in docs_paths:
        top = os.path.normpath(os.path.join(root, entry))
        if os.path.isfile(top) and inside(top):
            found.append((os.path.relpath(top, root), corpus_path(os.path.basename(top)), True))
            continue
        for folder, folders, names in os.walk(top, followlinks=True):
            folders[:] = sorted(f for f in folders if f != ".git" and inside(os.path.join(folder, f)))
            for n in sorted(names):
                full = os.path.join(folder, n)
                below = os.path.relpath(full, top)
                if os.path.splitext(n)[1] in KINDS and os.path.isfile(full) and inside(full) and not any(fnmatchcase(below, g) for g in exclude_globs or []):
                    found.append((os.path.relpath(full, root), corpus_path(below), False))
    single = {relpath for _, relpath, alone in found if alone}
    out = {source: corpus_path(source) if not alone and relpath in single else relpath for source, relpath, alone in found}
    return sorted(out.items())


class _Slice(InputPartition):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, root: str, docs_paths: list[str], exclude: list[str]):
        self.root, self.docs_paths, self.exclude = root, docs_paths, exclude

    def partitions(self) -> list[InputPartition]:
        files = listed_files(self.root, self.docs_paths, self.exclude)
        return [_Slice(files[i : i + 256]) for i in range(0, len(files), 256)] or [_Slice([])]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        for source, relpath in partition.files:
            with open(os.path.join(self.root, source), "rb") as f:
                yield source, relpath, KINDS[os.path.splitext(source)[1]], f.read()


class CheckoutSource(DataSource):
    """spark.read.format("checkout") with options path, docs_paths and exclude_globs (lists joined by newlines)."""

    @classmethod
    def name(cls) -> str:
        return "checkout"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        split = lambda k: [x for x in self.options.get(k, "").split("\n") if x]
        return _Reader(self.options["path"], split("docs_paths"), split("exclude_globs"))


def read_checkout(spark: SparkSession, root: str, docs_paths: list[str], exclude_globs: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(CheckoutSource)
    return spark.read.format("checkout").option("path", root).option("docs_paths", "\n".join(docs_paths)).option("exclude_globs", "\n".join(exclude_globs or [])).load()


def openapi_operations(files: DataFrame) -> DataFrame:
    """(source_path, route, verb, summary, description) of every operation in OpenAPI files of a checkout."""
    from pyspark.sql import functions as F

    doc = F.from_json(F.decode("content", "UTF-8"), "struct<paths:map<string,map<string,struct<summary:string,description:string,operationId:string>>>>")
    routes = files.where("kind = 'openapi'").select("source_path", F.explode(doc["paths"]).alias("route", "verbs"))
    return routes.select("source_path", "route", F.explode("verbs").alias("verb", "op")).select("source_path", "route", "verb", "op.summary", "op.description")
