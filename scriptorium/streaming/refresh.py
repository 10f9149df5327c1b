"""Keeping the index up to date from a stream of page files: each micro-batch refreshes the versions it brings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptorium.operators import index
from scriptorium.schema import PAGES


def merge_pages(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The pages of old with those of new put in by path; of several in new the last fetched wins."""
    key = ["collection", "version", "relpath"]
    latest = new.groupBy(*key).agg(F.max_by(F.struct(*[c for c in new.columns if c not in key]), F.struct(F.coalesce("fetched_at_raw", F.lit("")), "body_md5")).alias("p")).select(*key, "p.*").select(*new.columns)
    return latest if old is None else old.join(latest.select(*key), key, "left_anti").select(*new.columns).unionByName(latest)


def refresh_from(spark: SparkSession, incoming: str, pages: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Takes Parquet files of page rows from `incoming` as they come, merges them into `pages` and refreshes the index in `folder`.

    A batch writes a new generation of the page table before the index, and a batch that is run again merges to the same
    pages, so a lost driver costs a rerun and no page.
    """

    def take(batch: DataFrame, number: int) -> None:
        store = batch.sparkSession
        current = store._jvm.org.apache.hadoop.fs.Path(f"{pages}/current")
        have = current.getFileSystem(store._jsc.hadoopConfiguration()).exists(current)
        last, before = store.read.text(f"{pages}/current").first()[0].split() if have else ("-", "-")
        base = before if last == str(number) else last  # a batch that runs again starts from where it did the first time
        old = store.read.parquet(f"{pages}/g{base}") if base != "-" else None
        merge_pages(old, batch).write.mode("overwrite").parquet(f"{pages}/g{number}")
        now = store.read.parquet(f"{pages}/g{number}")
        if old is None:
            index.build(now, folder)
        else:
            index.refresh(now, folder)
        store.createDataFrame([(f"{number} {base}",)], "value string").coalesce(1).write.mode("overwrite").text(f"{pages}/current")

    stream = spark.readStream.schema(PAGES).parquet(incoming)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
