"""From raw documents to packed training sequences: quality, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import boxed, remove_saved, saved, saved_so_far, table
from scriptorium.llm.line_dedup import dedup_lines
from scriptorium.llm.minhash_dedup import near_duplicates
from scriptorium.llm.mixing import mixed_rows
from scriptorium.llm.packing import pack_documents
from scriptorium.llm.quality import classify


def boxes(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that a stage's operator reads, and all others as one, so that no name of theirs meets the operator's."""
    rest = [c for c in docs.columns if c not in needed]
    return docs.select(*needed, boxed(rest))


def unboxes(out: DataFrame, docs: DataFrame, *needed: str, **changed: Column) -> DataFrame:
    """The columns of docs again, in their order; those in changed as given."""
    value = lambda c: changed.get(c, F.col(c) if c in needed else F.col("row__").getField(c))
    return out.select(*[value(c).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 1, unchanged, whatever the names of their columns.

    Null, empty and very long texts are judged like any other; repeated rows stay or go together; without labels, and
    for an empty table, nothing is rejected.
    """
    out = classify(boxes(docs, "doc_id", "text"), table(spark, sf_dir, "labels")).where("predicted = 1")
    return unboxes(out, docs, "doc_id", "text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds; n_chars follows the text, other columns stay.

    A null text becomes empty. Rows that share an id are one document; those without one are the last, as a whole.
    """
    out = dedup_lines(boxes(docs, "doc_id", "text"))
    return unboxes(out, docs, "doc_id", text=F.col("kept_text"), n_chars=F.length("kept_text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, unchanged: the one of the smallest id, and of repeated rows one.

    Null and empty texts, and texts of blanks alone, are near equal texts only; an empty table stays empty.
    """
    out = near_duplicates(boxes(docs, "doc_id", "text")).where("kept")
    return unboxes(out, docs, "doc_id", "text")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them whole, dealt to output shards and shuffled within them; columns stay as they are.

    The shards are the order of the rows written; documents have no column for them. Documents without words are in no
    mix; a null source is one of its own, the last; an empty table stays empty.
    """
    return mixed_rows(docs, "text", ["doc_id", "text"])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its training sequence. The cache is small, as workers come from other stages.

    Only id and text are read, so other columns play no part; a null or empty text is one piece that ends at once;
    repeated rows are packed as often as they occur; an empty table gives none.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), known=200_000)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL cannot express a trained classifier; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again. What the stages wrote on the way is deleted as soon as the next stage has read it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        since = saved_so_far()
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_saved(spark, max(0, since - 1) if name != STAGES[0][0] else since, keep=1)
    return docs
