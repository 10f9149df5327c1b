"""Ranked search, section lookup and listing, as plans of built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.terms import terms
from scriptorium.schema import CHUNKS, POSTINGS

K1, B = 1.2, 0.75
DEFAULT_LIMIT, MOST = 8, 50


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct terms of a query, by the same rules as the index."""
    return sorted(set(spark.range(1).select(terms(F.lit(query)).alias("t")).first()["t"]))


def only(df: DataFrame, collection: str | None, version: str | None) -> DataFrame:
    """Rows of a collection and version; None stands for all. Versions compare as strings."""
    for name, value in (("collection", collection), ("version", version)):
        if value is not None:
            df = df.where(F.col(name) == F.lit(str(value)))
    return df


def bm25(chunks: DataFrame, posts: DataFrame, query: list[str]) -> DataFrame:
    """(chunk_id, score): Okapi BM25 over the terms, with statistics of each chunk's own collection and version.

    The term filter reaches the scan of the postings; statistics are a few rows a version.
    """
    stats = chunks.groupBy("collection", "version").agg(F.count("*").alias("n"), F.avg("n_terms").alias("avg_dl"))
    hits = posts.where(F.col("term").isin(query))
    df = hits.groupBy("collection", "version", "term").agg(F.count("*").alias("df"))
    rows = hits.join(df, ["collection", "version", "term"]).join(stats, ["collection", "version"]).join(chunks.select("chunk_id", F.col("n_terms").alias("dl")), "chunk_id")
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avg_dl")))
    return rows.groupBy("chunk_id").agg(F.round(F.sum(idf * norm), 6).alias("score"))


def rank(facts: DataFrame, query: list[str]) -> DataFrame:
    """(chunk_id, score) as bm25 has them, from facts(chunk_id, collection, version, n_terms, tfs): how often each chunk has each term of the query.

    One row a version of statistics, and no exchange of chunks but for the order of the result.
    """
    counts = [F.count_if(F.get("tfs", F.lit(i)) > 0).alias(f"d{i}") for i in range(len(query))]
    stats = facts.groupBy("collection", "version").agg(F.count("*").alias("n"), F.avg("n_terms").alias("avg_dl"), *counts)
    stats = stats.select("collection", "version", "n", "avg_dl", F.array(*[F.col(f"d{i}") for i in range(len(query))]).alias("dfs"))
    rows = facts.where(F.exists("tfs", lambda x: x > 0)).join(stats, ["collection", "version"])

    def part(i: int):
        tf, df = F.get("tfs", F.lit(i)), F.get("dfs", F.lit(i))
        norm = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("n_terms") / F.col("avg_dl")))
        return F.when(tf > 0, F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)) * norm).otherwise(0.0)

    return rows.select("chunk_id", F.round(sum((part(i) for i in range(len(query))), F.lit(0.0)), 6).alias("score"))


def check_limit(limit: object) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= MOST:
        raise ValueError(f"limit must be an integer from 1 to {MOST}")
    return limit


class Search:
    """The three queries over chunk and posting tables."""

    def __init__(self, chunks: DataFrame, posts: DataFrame):
        self.chunks, self.posts = chunks, posts
        self.spark = chunks.sparkSession

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Search:
        return cls(spark.read.schema(CHUNKS).parquet(f"{folder}/chunks"), spark.read.schema(POSTINGS).parquet(f"{folder}/postings"))

    def search_docs(self, query: str, collection: str | None = None, version: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
        """The best sections for a query, best first, ties by chunk_id. A collection or version that does not exist is an error, never another one."""
        if not isinstance(query, str) or not query.strip():
            raise ValueError("query must be a non-empty string")
        limit = check_limit(limit)
        chunks = only(self.chunks, collection, version)
        if (collection is not None or version is not None) and not chunks.head(1):
            raise ValueError(f"no such collection or version: {collection} {version}")
        best = bm25(chunks, only(self.posts, collection, version), query_terms(self.spark, query))
        best = best.orderBy(F.col("score").desc(), "chunk_id").limit(limit)
        out = best.join(chunks, "chunk_id").select("chunk_id", "collection", "version", "title", "heading_path", "source_url", "score", snippet(F.col("text"), query_terms(self.spark, query)).alias("snippet"))
        return out.orderBy(F.col("score").desc(), "chunk_id")

    def get_section(self, chunk_id: str) -> DataFrame:
        if not isinstance(chunk_id, str) or not chunk_id:
            raise ValueError("chunk_id must be a non-empty string")
        parts = chunk_id.split("/", 2)
        near = only(self.chunks, parts[0], parts[1]) if len(parts) == 3 else self.chunks  # prunes to one partition
        return near.where(F.col("chunk_id") == chunk_id)

    def list_collections(self) -> DataFrame:
        each = self.chunks.groupBy("collection", "version").agg(F.countDistinct("relpath").alias("pages"), F.count("*").alias("chunks"), F.max("fetched_at").alias("last_fetched"))
        return each.orderBy("collection", "version")


def snippet(text, query: list[str], around: int = 120):
    """Up to `around` characters on either side of the first query term in the text, in one line."""
    low = F.lower(text)
    places = F.filter(F.array(*[F.instr(low, F.lit(t)) for t in query] or [F.lit(0)]), lambda p: p > 0)
    start = F.greatest(F.coalesce(F.array_min(places), F.lit(1)) - around, F.lit(1))
    return F.regexp_replace(F.substring(text, start, F.lit(2 * around)), r"\s+", " ")


def grep(pages: DataFrame, pattern: str) -> DataFrame:
    """(path, line, text) of lines that match a regular expression: the baseline without an index."""
    hit = pages.where(F.col("body").rlike(pattern)).select("path", F.posexplode(F.split("body", "\n")).alias("pos", "text"))
    return hit.where(F.col("text").rlike(pattern)).select("path", (F.col("pos") + 1).alias("line"), "text")


def compare(search: Search, pages: DataFrame, questions: list[str], limit: int = DEFAULT_LIMIT) -> DataFrame:
    """(question, strategy, ordinal, hit): for each question of a short list, what grep and what search find, for judging by hand."""
    out = None
    for q in questions:
        found = search.search_docs(q, limit=limit).select("chunk_id").withColumn("ordinal", F.monotonically_increasing_id())
        part = found.select(F.lit(q).alias("question"), F.lit("search").alias("strategy"), "ordinal", F.col("chunk_id").alias("hit"))
        words = "|".join(query_terms(search.spark, q))
        lines = grep(pages, f"(?i)({words})").orderBy("path", "line").limit(limit)
        part = part.unionByName(lines.select(F.lit(q).alias("question"), F.lit("grep").alias("strategy"), F.monotonically_increasing_id().alias("ordinal"), F.concat_ws(":", "path", "line").alias("hit")))
        out = part if out is None else out.unionByName(part)
    return out
