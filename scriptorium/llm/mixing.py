"""Operator 10: mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source gets a quota of words (weights, with a ceiling on repeats). A source's documents are permuted by a hash and
laid end to end, pass after pass, until the quota is full; that line is cut into blocks of equal numbers of words. The
exact numbers of blocks of all sources are split recursively in two by multivariate-hypergeometric draws down to the
output shards, so every shard gets as many blocks as a uniform shuffle of all blocks would give it. Each shard draws its
blocks from the sources' permuted lines, no block twice, and what the mix takes of a document is what its shards' blocks
hold of it. Only one row per source is gathered on the driver; more than MOST_SOURCES of them are refused.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import WORD, boxed, kept, leading_bits, own, power_of_two, saved, unboxed, unsigned_order
from scriptorium.llm.draws import split

CYCLE = (5.0, 2.0, 1.0)  # weights of the sources by code point, repeating
MOST_REPEATS = 3
BLOCKS_PER_SHARD = 1024
MOST_SOURCES = 65_536  # the mix has a weight for each; a table with more is refused with an error
ROWS_PER_BUCKET, TEXTS_PER_BUCKET = 250_000, 10_000  # of thin rows, and of rows that carry texts


def targets(sizes: list[int], weights: list[float], most: int = MOST_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, none above `most` times its size; the excess goes to the others by weight."""
    out, free, rest = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while free:
        share = rest / sum(weights[i] for i in free)
        full = [i for i in free if share * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = share * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            rest -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def splitting_tree(blocks: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns; a power of two of them). Shards get equal numbers, to one."""
    draw, out = np.random.default_rng(seed), np.array([blocks], np.int64)
    while len(out) < shards:
        left = split(draw, out, (out.sum(1) + 1) // 2)
        out = np.stack([left, out - left], 1).reshape(2 * len(out), len(blocks))
    return out.T


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(df: DataFrame, size: Column, ties: list[str], shards: int = 16, seed: int = 10, whole: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds to every row what the mix takes of it; input columns of these names, in any case, are replaced.

    size, source_size long: words of the row and of its source. target double: the source's words in the mix.
    dealt array<bigint>: words that each output shard's blocks hold of the row. taken long: their sum, at most
    MOST_REPEATS times size. shards array<int>: the shard of each copy, by the block in which it begins. In each source
    one document at most gives only its first words, so taken sums to the rounded target; with whole=True it is taken
    whole or left, whichever is nearer, and copies are dealt whole.
    A null source is one source of its own, after all others in order. ties tell rows apart: rows alike in all of them
    are interchangeable. Sources without words get nothing; an empty input gives an empty result; more sources than
    MOST_SOURCES are an error. shards: a power of two.
    """
    spark = df.sparkSession
    keep = kept(df, "size", "source_size", "target", "taken", "dealt", "shards")
    tied = [F.col("row__").getField(t) for t in ties]
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    rows = df.select(boxed(keep), size.alias("size"), key.alias("key"), F.xxhash64(F.lit(seed), *map(own, ties)).alias("h"))
    sources = rows.groupBy("key").agg(F.sum("size").alias("w"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"a mix has at most {MOST_SOURCES} sources")
    sources.sort(key=lambda r: (r["key"] == "n", r["key"].encode()))
    sizes = [r["w"] for r in sources]
    wanted = targets(sizes, [CYCLE[i % len(CYCLE)] for i in range(len(sources))])
    quotas = [min(round(t), MOST_REPEATS * s) for t, s in zip(wanted, sizes, strict=True)]
    block = max(1, sum(quotas) // (shards * BLOCKS_PER_SHARD))
    tree = splitting_tree([-(-q // block) for q in quotas], shards, seed)
    cuts = np.minimum(tree.cumsum(axis=1) * block, np.array(quotas, np.int64)[:, None])  # where a shard's words end on the source's line
    columns = zip([r["key"] for r in sources], sizes, wanted, quotas, cuts.tolist(), strict=True)
    facts = [{"key": k, "source_size": s, "target": t, "quota": q, "cuts": c} for k, s, t, q, c in columns]
    schema = "array<struct<key:string,source_size:bigint,target:double,quota:bigint,cuts:array<bigint>>>"
    plan = F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(facts)), schema))))  # MOST_SOURCES rows at most
    buckets = power_of_two(sum(r["n"] for r in sources) / rows_per_bucket, 16, 65_536)
    rows = rows.withColumn("sub", leading_bits(F.col("h"), buckets))
    upto = Window.unboundedPreceding, -1
    before = F.sum("w").over(Window.partitionBy("key").orderBy("sub").rowsBetween(*upto))
    starts = rows.groupBy("key", "sub").agg(F.sum("size").alias("w")).select("key", "sub", F.coalesce(before, F.lit(0)).alias("start"))
    order = Window.partitionBy("key", "sub").orderBy(unsigned_order(F.col("h")), *tied).rowsBetween(*upto)
    line = rows.withColumn("within", F.coalesce(F.sum("size").over(order), F.lit(0))).join(starts, ["key", "sub"]).join(plan, "key")
    line = line.withColumn("begin", F.col("start") + F.col("within"))
    line = line.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0))
    at = lambda c: c * F.col("source_size") + F.col("begin")
    shard = lambda c: F.least(F.size(F.filter("cuts", lambda x: x <= at(c))), F.lit(shards - 1))
    turns = F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))
    begun = (at(F.col("passes")) < F.col("quota")) & (F.col("passes") < MOST_REPEATS)
    half = (F.col("quota") - at(F.col("passes"))) * 2 >= F.col("size") if whole else F.lit(True)
    copies = F.when(F.col("size") > 0, F.col("passes") + F.when(begun & half, 1).otherwise(0)).otherwise(0)
    line = line.withColumn("shards", F.slice(F.transform(turns, shard), F.lit(1), copies.cast("int")))
    if whole:
        held = lambda s: F.size(F.filter("shards", lambda x: x == s)) * F.col("size")
    else:
        low = lambda s, c: F.greatest(at(c), F.when(s == 0, F.lit(0).cast("long")).otherwise(F.get("cuts", s - 1)))
        high = lambda s, c: F.least(at(c) + F.col("size"), F.get("cuts", s))
        held = lambda s: F.aggregate(turns, F.lit(0).cast("long"), lambda n, c: n + F.greatest(high(s, c) - low(s, c), F.lit(0)))
    line = line.withColumn("dealt", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: held(s).cast("long")))
    taken = F.aggregate("dealt", F.lit(0).cast("long"), lambda n, x: n + x)
    return line.select(*unboxed(keep), "size", F.col("source_size").cast("long"), "target", taken.alias("taken"), "dealt", "shards")


def mixed_rows(df: DataFrame, text: str, ties: list[str], **options) -> DataFrame:
    """The mix itself: each row as often as it is taken whole, dealt to its shards and shuffled within them; columns of df only, whatever their names.

    Rows without words are in no mix; repeated rows are rows of their own. Texts are exchanged twice, to find their
    place and to go there: thin rows in the first exchange would need a second one to find their texts again.
    """
    names = {c: f"c{i}__" for i, c in enumerate(df.columns)}
    plain = df.select(*[own(c).alias(n) for c, n in names.items()], own("source").alias("source"))
    tied = [names[t] for t in ties]
    out = mix(plain, word_count(F.col(names[text])), tied, whole=True, rows_per_bucket=TEXTS_PER_BUCKET, **options)
    parts = power_of_two(df.count() / TEXTS_PER_BUCKET, 16, 65_536)  # of a shard: its rows are ordered in ranges of a hash
    out = out.select(*names.values(), F.posexplode("shards").alias("copy", "shard")).withColumn("order", F.xxhash64(F.lit(11), "copy", *tied))
    dealt = out.repartition("shard", leading_bits(F.col("order"), parts)).sortWithinPartitions("shard", unsigned_order(F.col("order")))
    return dealt.select(*[F.col(n).alias(c) for c, n in names.items()])


def mixing_digest(docs: DataFrame) -> DataFrame:
    """One row per document with what the mix takes of it. A null text has no words; null and repeated ids are rows like any other; an empty table gives no rows."""
    thin = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("n")), "word-counts")  # texts are read once
    out = mix(thin, F.col("n"), ["doc_id", "n"])
    return out.select("doc_id", "size", "source_size", "target", "taken", "dealt", "shards")
