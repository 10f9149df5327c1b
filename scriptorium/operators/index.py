"""The full-text index as tables: chunks, postings and statistics; built whole or refreshed by difference."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.terms import terms
from scriptorium.operators.chunks import chunk_pages
from scriptorium.schema import CHUNKS, POSTINGS

PAGE = ["collection", "version", "relpath"]
PARTS = 64


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(3)
        coded = lists.flatten().dictionary_encode()
        owner = np.repeat(np.arange(len(b)), lists.value_lengths().fill_null(0).to_numpy())
        kinds = max(1, len(coded.dictionary))
        pairs, many = np.unique(owner * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        row = pa.array(pairs // kinds)
        yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(pairs % kinds)), *[c.take(row) for c in b.columns[:3]], pa.array(many, pa.int32())], ["term", "chunk_id", "collection", "version", "tf"])


def postings(chunks: DataFrame) -> DataFrame:
    """(term, chunk_id, collection, version, tf); a chunk is one row, so its terms are counted in Arrow batches where it is, and nothing is exchanged."""
    rows = chunks.select("chunk_id", "collection", "version", terms(F.col("text")).alias("t")).where(F.size("t") > 0)
    return rows.mapInArrow(_counted, POSTINGS)


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """(collection, version, n, avg_dl): statistics within each version, so that versions do not influence each other."""
    return chunks.groupBy("collection", "version").agg(F.count("*").alias("n"), F.avg("n_terms").alias("avg_dl"))


def document_frequency(posts: DataFrame) -> DataFrame:
    return posts.groupBy("collection", "version", "term").agg(F.count("*").alias("df"))


SERVED = ["title", "source_url", "fetched_at", "body_md5"]


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """(collection, version, relpath, change) of two page tables: added, removed or changed pages; a change is one of any field that is served."""
    served = F.md5(F.to_json(F.struct(*SERVED), {"ignoreNullFields": "false"}))
    a, b = (d.select(*PAGE, served.alias(k)) for d, k in ((old, "was"), (new, "now")))
    both = a.join(b, PAGE, "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return both.select(*PAGE, change.alias("change")).where("change is not null")


def build(pages: DataFrame, folder: str) -> None:
    """Writes chunks and postings, partitioned by collection and version, so a search reads its version only."""
    write(chunk_pages(pages), f"{folder}/chunks")
    write(postings(pages.sparkSession.read.schema(CHUNKS).parquet(f"{folder}/chunks")), f"{folder}/postings")


def write(df: DataFrame, path: str) -> None:
    """Replaces the versions that df holds. A version is written by up to PARTS tasks, few where it is small."""
    parts = df.repartition("collection", "version", F.pmod(F.xxhash64("chunk_id"), F.lit(PARTS)))
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collection", "version").parquet(path)


def refresh(pages: DataFrame, folder: str) -> DataFrame:
    """Brings the index up to the pages: only versions with a difference are written again. Returns the difference.

    Both tables of a version are replaced as a whole, so a refresh that is cut off is completed by running it again.
    """
    spark = pages.sparkSession
    chunks_path, marks = f"{folder}/chunks", f"{folder}/postings"
    old = spark.read.schema(CHUNKS).parquet(chunks_path).select(*PAGE, *SERVED).distinct()
    delta(old, pages).write.mode("overwrite").parquet(f"{folder}/changes")  # the record of this refresh; also keeps it fixed while its sources are rewritten
    change = spark.read.parquet(f"{folder}/changes")
    versions = change.select("collection", "version").distinct()
    chunks = chunk_pages(pages.join(versions, ["collection", "version"], "left_semi"))
    for path, df in ((marks, postings(chunks)), (chunks_path, chunks)):  # chunks last: they are what the next difference looks at
        write(df, path)
    gone = versions.join(pages.select("collection", "version").distinct(), ["collection", "version"], "left_anti").collect()
    for r in gone:  # versions without pages any more
        for name in ("chunks", "postings"):
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/collection={r['collection']}/version={r['version']}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return change
