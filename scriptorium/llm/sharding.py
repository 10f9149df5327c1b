"""Operator 9: a uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are first dealt to virtual partitions by a hash. A matrix with those partitions' sizes as row sums and the wanted
shard sizes as column sums is drawn from the multivariate hypergeometric law: the law that a uniform permutation of all
rows would follow. Each partition permutes its rows locally and cuts them by its row of the matrix, the rows are
exchanged, and each shard permutes again. Every step is a DataFrame operation; only the matrix (at most
MAX_PARTITIONS x shards counts, whatever the input) is drawn on the driver.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import boxed, kept, leading_bits, own, power_of_two, saved, unboxed, unsigned_order
from scriptorium.llm.draws import split

MAX_PARTITIONS = 65_536
ROWS_PER_PARTITION = 250_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart, the larger ones first."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(partitions: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts of rows from each partition (rows) to each shard (columns), with exact sums either way.

    Partitions are halved again and again; each half's share of its node's rows in every shard is one draw for all nodes
    of a level at once. Numbers of rows may be as large as 64 bits hold.
    """
    draw, many = np.random.default_rng(seed), power_of_two(len(partitions), 1, 1 << 40)
    sizes = np.zeros(many, np.int64)
    sizes[: len(partitions)] = partitions
    out = np.array([shards], np.int64)
    while len(out) < many:
        halves = sizes.reshape(2 * len(out), -1).sum(1)
        left = split(draw, out, halves[::2])
        out = np.stack([left, out - left], 1).reshape(-1, len(shards))
    return out[: len(partitions)]


def hypergeometric_shuffle(df: DataFrame, ties: list[str], shards: int = 16, seed: int = 9, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Adds `shard` (int) and `slot` (long, gapless from 0 within a shard) to every row; input columns of these names, in any case, are replaced.

    ties: columns that tell rows apart. Rows that agree in all of them may trade places among themselves, which changes
    nothing a reader can see, so reruns agree. Nulls in those columns are values like any other, and long texts cost
    their length. An empty input gives an empty result. Shard sizes are at most one apart.
    """
    spark = df.sparkSession
    keep = kept(df, "shard", "slot")
    tied = [F.col("row__").getField(t) for t in ties]
    rows = df.select(boxed(keep), F.xxhash64(F.lit(seed), *map(own, ties)).alias("h1"), F.xxhash64(F.lit(seed + 1), *map(own, ties)).alias("h2"))
    total = df.count()
    parts = power_of_two(total / rows_per_partition, 64, MAX_PARTITIONS)
    rows = rows.withColumn("part", leading_bits(F.col("h1"), parts))
    found = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}  # MAX_PARTITIONS rows at most
    sizes = [found.get(p, 0) for p in range(parts)]
    cuts = communication_matrix(sizes, shard_sizes(total, shards), seed).cumsum(axis=1)
    # At most MAX_PARTITIONS rows of `shards` numbers: this broadcast has a fixed bound.
    literal = F.lit(json.dumps([{"part": p, "cuts": c} for p, c in enumerate(cuts.tolist())]))
    matrix = spark.range(1).select(F.inline(F.from_json(literal, "array<struct<part:int,cuts:array<bigint>>>")))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(unsigned_order(F.col("h1")), *tied)) - 1
    dealt = rows.withColumn("rank", rank).join(F.broadcast(matrix), "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("cuts", lambda c: c <= F.col("rank"))).cast("int"))
    per_shard = power_of_two(total / shards / rows_per_partition, 16, MAX_PARTITIONS)
    dealt = saved(dealt.select("row__", "shard", "h2", leading_bits(F.col("h2"), per_shard).alias("sub")), "dealt")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1))
    starts = dealt.groupBy("shard", "sub").agg(F.count("*").alias("n")).select("shard", "sub", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "sub").orderBy(unsigned_order(F.col("h2")), *tied))
    out = dealt.withColumn("place", place).join(starts, ["shard", "sub"])
    return out.select(*unboxed(keep), "shard", (F.col("start") + F.col("place") - 1).cast("long").alias("slot"))


def sharding_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: its size, checksum, shard and slot under the law `rows`. A null text has size 1 and the checksum of ''.

    Equal texts need no common shard under this law, so groups play no part in it. Null and repeated ids are rows like
    any other; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    out = hypergeometric_shuffle(thin, ["doc_id", "text_crc32", "size"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
