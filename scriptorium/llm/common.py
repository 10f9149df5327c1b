"""Pieces that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Characters that separate words: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


_MADE: list[str] = []  # on the driver: tables that saved() has written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where that is unset, a temporary one, but only in local mode (tests), where all tasks run on this machine; on a
    cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as a table in the shared folder and reads it back, so lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_so_far() -> int:
    """How many of the tables that this driver has saved still exist."""
    return len(_MADE)


def remove_saved(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Deletes the tables that this driver has saved, from number `since` of them on but for the last `keep`; for the end of a job, when no result is still to be read from them."""
    last = len(_MADE) - keep
    for name in _MADE[since:last]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    del _MADE[since:last]


def kept(df: DataFrame, *new: str) -> list[str]:
    """The columns of df but for those that an operator replaces, in whatever case they are written."""
    return [c for c in df.columns if c.lower() not in new]


def own(name: str) -> Column:
    """A column by its plain name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(keep: list[str]) -> Column:
    """Those columns as one, `row__`: between boxing and unboxing an operator's own names meet none of the input's."""
    return F.struct(*[own(c).alias(c) for c in keep], F.lit(0).alias("none__")).alias("row__")


def unboxed(keep: list[str]) -> list[Column]:
    return [F.col("row__").getField(c).alias(c) for c in keep]


def returned(df: DataFrame, *more: str) -> StructType:
    """The schema of df with more columns, each written as `name type`; for functions over Arrow batches."""
    added = StructType.fromDDL(", ".join(more)).fields if more else []
    return StructType([StructField(f.name, f.dataType) for f in [*df.schema.fields, *added]])


HOT_ROWS, MOST_HOT = 128, 1024


def join_spread(rows: DataFrame, facts: DataFrame, on: list[str], values: list[str], total: int, spread: Column, size: str = "n") -> DataFrame:
    """rows with the values that facts hold for their key, or nulls: a left join that no key can crowd into one task.

    facts has each key once, with the number of rows (`size`) that carry it; total is the sum of those numbers. Keys
    with more than a share of 1 / MOST_HOT of all rows, MOST_HOT at most by that, are broadcast; their rows are dealt by
    `spread`. facts is read twice: a written table, or cheap. Null keys meet nothing.
    """
    hot = F.col(size) > max(HOT_ROWS, total // MOST_HOT)
    mine = [F.col(c).alias(f"{c}__hot") for c in on]
    most = F.broadcast(facts.where(hot).select(*mine, F.struct(*values).alias("hot__")))
    out = rows.join(most, [F.col(c) == F.col(f"{c}__hot") for c in on], "left").drop(*[f"{c}__hot" for c in on])
    out = out.withColumn("salt__", F.when(F.col("hot__").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(spread), F.lit(1 << 30)) + 1))
    rest = facts.where(~hot).select(*on, F.lit(0).cast("long").alias("salt__"), F.struct(*values).alias("cold__"))
    out = out.join(rest, [*on, "salt__"], "left")
    found = [F.coalesce(F.col("hot__").getField(v), F.col("cold__").getField(v)).alias(v) for v in values]
    return out.select(*rows.columns, *found)


MOST_BITS = 1 << 27


def maybe_among(rows: DataFrame, wanted: DataFrame, key: Column, many: int) -> DataFrame:
    """The rows whose key one of `many` wanted rows has, and few others: what spares an exchange of most rows before a join.

    key is a hash, written the same for both sides. Wanted keys set bits, 8 to 16 for each, in pieces of 32,768 that are
    broadcast: MOST_BITS / 8 bytes (16 MB) at most. Where so many bits would be more than half full, all rows are returned.
    """
    if 2 * many > MOST_BITS:
        return rows
    place = F.pmod(key, F.lit(power_of_two(8 * many, 1 << 15, MOST_BITS))) + 1  # bitmaps count from 1
    thin = wanted.select(F.bitmap_bucket_number(place).alias("piece__"), F.bitmap_bit_position(place).alias("bit__"))
    pieces = thin.repartition("piece__").groupBy("piece__").agg(F.bitmap_construct_agg("bit__").alias("bits__"))
    at = rows.withColumns({"piece__": F.bitmap_bucket_number(place), "bit__": F.bitmap_bit_position(place)}).join(F.broadcast(pieces), "piece__")
    byte = F.conv(F.hex(F.substring("bits__", (F.floor(F.col("bit__") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.pmod("bit__", F.lit(8)) + 1).cast("int"))
    return at.where(byte.bitwiseAND(mask) > 0).select(*rows.columns)


Batches = Iterator[pa.RecordBatch]
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def lean(run: Callable[[Batches], Batches], rows: int = SLICE_ROWS) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that sees its input in slices of so many rows and about SLICE_BYTES at most (one row at least),
    and gives freed memory back when its task ends, as workers live on between tasks."""

    def sliced(batches: Batches) -> Batches:
        for b in batches:
            n = max(1, min(rows, int(len(b) * SLICE_BYTES / max(1, b.nbytes))))
            for lo in range(0, len(b), n):
                yield b.slice(lo, n)

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(sliced(batches))
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return whole


def power_of_two(n: float, least: int, most: int) -> int:
    """The smallest power of two that is at least n, within bounds that are powers of two themselves."""
    b = least
    while b < n and b < most:
        b *= 2
    return b


def leading_bits(h: Column, buckets: int) -> Column:
    """Bucket of a 64-bit hash by its leading bits (buckets: a power of two), so that buckets follow the unsigned order of h."""
    bits = buckets.bit_length() - 1
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def unsigned_order(h: Column) -> Column:
    """Sorts a signed 64-bit hash as an unsigned one."""
    return h.bitwiseXOR(F.lit(-(2**63)))


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed bijective scrambling of uint64 values (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Words:
    """The words of a batch of texts: codes into the distinct words, and where each text begins among them.

    Null texts have no words. Splitting and coding run in Arrow, so per-word Python work is on distinct words only.
    """

    def __init__(self, texts: pa.Array):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        lengths = np.diff(lists.offsets.to_numpy())
        full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, bool)
        owner = np.repeat(np.arange(len(texts)), lengths)[full]
        coded = flat.filter(pa.array(full)).dictionary_encode()
        self.distinct: pa.Array = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word occurrence."""
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(self.distinct))
        return own[self.codes] if len(own) else np.zeros(0, np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n-1 places have none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            out = mix64(out * np.uint64(0x100000001B3) + words[i : len(words) - n + 1 + i])
    return out
