"""Pages cut into sections at their headings."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.terms import terms
from scriptorium.schema import CHUNKS, columns

_HEADING = re.compile(r"(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$")
_FENCE = re.compile(r"\s{0,3}(`{3,}|~{3,})")


def sections(body: str) -> list[tuple[list[str], int, str]]:
    """(heading path, level, text) of each section: the part before any heading has level 0 and an empty path.

    Headings inside fences are text. An empty body has no sections. A section keeps its own heading line.
    """
    out: list[tuple[list[str], int, list[str]]] = [([], 0, [])]
    path: list[tuple[int, str]] = []
    fence = ""
    for line in body.split("\n"):
        mark = _FENCE.match(line)
        if fence:
            if mark and mark[1][0] == fence[0] and len(mark[1]) >= len(fence) and not line.strip().strip(fence[0]):
                fence = ""
        elif mark:
            fence = mark[1]
        elif m := _HEADING.match(line):
            level = len(m[1])
            path = [*(p for p in path if p[0] < level), (level, m[2])]
            out.append(([t for _, t in path], level, []))
        out[-1][2].append(line)
    texts = ((p, level, "\n".join(lines).strip()) for p, level, lines in out)
    return [(p, level, t) for p, level, t in texts if t]


def chunk_pages(pages: DataFrame) -> DataFrame:
    """Rows of the chunk schema. An empty page is one chunk that holds its title; ids are path#ordinal."""
    names = [n for n, _ in columns(CHUNKS)]
    facts = ["collection", "version", "relpath", "title", "source_url", "body_md5", "fetched_at"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for body, *own in zip(b["body"], *(b[k] for k in facts), strict=True):
                page = dict(zip(facts, own, strict=True))
                for i, (path, level, text) in enumerate(sections(body or "") or [([], 0, page["title"] or "")]):
                    rows.append(page | {"chunk_id": f"{page['collection']}/{page['version']}/{page['relpath']}#{i}", "heading_path": path, "level": level, "ordinal": i, "text": text, "n_terms": 0})
            yield pd.DataFrame(rows, columns=names)

    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    return pages.select(*facts, "body").mapInPandas(run, CHUNKS).withColumn("n_terms", F.size(terms(F.col("text"))))
