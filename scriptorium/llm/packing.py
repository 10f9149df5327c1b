"""Operator 2: best-fit packing by patterns fitted with non-negative least squares.

All that matters for packing is how many pieces there are of each length, at most `size` numbers. From that histogram
the driver plans: it enumerates the patterns of two or three lengths that fill a sequence exactly, fits how often to use
each by non-negative least squares (accelerated projected gradients), rounds so that running sums stay exact, clips to
what is there, and packs the residual by best fit, longest first, on counts. The plan's size depends on `size` alone,
never on the rows. Pieces then find their sequence by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import lean, power_of_two, saved
from scriptorium.llm.tokens import KNOWN_MOST, encoder

SIZE = 2048
ROUNDS = 200
ROWS_PER_BUCKET = 250_000


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All (a >= b >= c) of two (c = 0) or three of the given lengths whose sum is size."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    found = []
    for a in lengths[lengths < size][::-1].tolist():
        rest = size - a
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        c = rest - b
        ok = have[b] & ((c == 0) | have[c])
        found.append(np.stack([np.full(int(ok.sum()), a), b[ok], c[ok]], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit(pats: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of each pattern that bring the used lengths close to counts in the least-squares sense."""
    size = len(counts)
    weight = (pats > 0).astype(float)

    def used(x):
        return np.bincount(pats.ravel(), (weight * x[:, None]).ravel(), size)

    def back(r):
        return (r[pats] * weight).sum(1)

    v = np.ones(len(pats))
    for _ in range(12):  # the largest eigenvalue bounds the step
        v = back(used(v))
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(used(y) - counts) / (1.02 * bound))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


@dataclass
class Plan:
    """Runs of slots sorted by (length, first rank): ranks [first, first + bins * each) of a length go `each` to a sequence."""

    length: np.ndarray
    first: np.ndarray
    bins: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        key = lambda n, r: n.astype(np.int64) << 48 | r.astype(np.int64)
        at = np.searchsorted(key(self.length, self.first), key(length, rank), "right") - 1
        i = rank - self.first[at]
        return self.sequence[at] + i // self.each[at], self.offset[at] + i % self.each[at] * length


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """How to pack so many pieces of each length (1 to size)."""
    left = np.zeros(size + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    rows: list[tuple[int, int, int, int, int, int]] = []
    taken, sequences = np.zeros(size + 1, np.int64), 0

    def put(n: int, bins: int, each: int, sequence: int, offset: int) -> None:
        rows.append((n, int(taken[n]), bins, each, sequence, offset))
        taken[n] += bins * each
        left[n] -= bins * each

    if left[size]:
        bins = int(left[size])
        put(size, bins, 1, 0, 0)
        sequences += bins
    pats = patterns(np.flatnonzero(left), size)
    if len(pats):
        x = np.cumsum(fit(pats, left.astype(float)))
        repeats = np.diff(np.concatenate([[0], np.floor(x + 0.5)])).astype(np.int64)
        for i in np.flatnonzero(repeats):
            own = [n for n in pats[i].tolist() if n]
            bins = min(int(repeats[i]), *(int(left[n]) // own.count(n) for n in own))
            if bins:
                at = 0
                for n in own:
                    put(n, bins, 1, sequences, at)
                    at += n
                sequences += bins
    open_: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by free space: (first sequence, how many)
    for n in range(size, 0, -1):
        space = n
        while left[n]:
            while space <= size and not open_[space]:
                space += 1
            if space > size:  # new sequences, filled with as many of this length as fit
                each = size // n
                bins, rest = divmod(int(left[n]), each)
                if bins:
                    put(n, bins, each, sequences, 0)
                    open_[size - each * n].append((sequences, bins))
                    sequences += bins
                if rest:
                    put(n, 1, rest, sequences, 0)
                    open_[size - rest * n].append((sequences, 1))
                    sequences += 1
                continue
            start, many = open_[space].pop()
            each = min(space // n, int(left[n]))
            bins = min(many, int(left[n]) // each)
            if bins < many:
                open_[space].append((start + bins, many - bins))
            put(n, bins, each, start, size - space)
            if space > each * n:
                open_[space - each * n].append((start, bins))
    a = np.array(rows, np.int64).reshape(-1, 6)
    a = a[np.lexsort((a[:, 1], a[:, 0]))]
    return Plan(*a.T.copy(), sequences)


def pieces(docs: DataFrame, path: str, end_id: int, size: int, keep_ids: bool = False, known: int = KNOWN_MOST) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its ids and end_id, cut only beyond size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = encoder(path, known), np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), tokens.encode(b.column(1)), strict=True):
                own = ids + end
                for p, at in enumerate(range(0, len(own), 4 * size)):
                    cut = own[at : at + 4 * size]
                    rows.append((doc, p, p * size, len(cut) // 4, zlib.crc32(cut), cut))
            cols = list(zip(*rows, strict=True))
            out = [pa.array(c, t) for c, t in zip(cols[:5], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cols[5]], pa.list_(pa.int64()))] if keep_ids else [])], ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run, 1024), schema)


def pack(items: DataFrame, ties: list[str], size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset (long) to rows with a length of 1 to size; items must be a written table, as it is read twice.

    Sequences are gapless from offset 0. ties tell rows apart. A length that a third of all rows have is ranked in hash
    buckets, whose sizes are counted first, so it needs no single task.
    """
    spark = items.sparkSession
    lengths = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    made = spark.sparkContext.broadcast(plan(lengths, size))  # a plan's size is bounded by the patterns of `size`
    buckets = power_of_two(sum(lengths.values()) / ROWS_PER_BUCKET, 16, 65_536)
    rows = items.withColumn("__b", F.pmod(F.xxhash64(*ties), F.lit(buckets)).cast("int"))
    upto = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("length", "__b").agg(F.count("*").alias("n")).select("length", "__b", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__first"))
    within = F.row_number().over(Window.partitionBy("length", "__b").orderBy(*ties)) - 1
    ranked = rows.withColumn("__within", within).join(starts, ["length", "__b"]).select(*items.columns, (F.col("__first") + F.col("__within")).alias("__rank"))
    n, at, names = len(items.columns), items.columns.index("length"), [*items.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = made.value.place(b.column(at).to_numpy(), b.column(n).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    return ranked.mapInArrow(lean(run, 65_536), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, size: int = SIZE, known: int = KNOWN_MOST) -> DataFrame:
    """Every document, tokenized and packed: one row per piece. known: words a worker's cache holds, for memory against time.

    A null or empty text is the end id alone; repeated rows are packed as often as they occur; an empty table gives none.
    """
    return pack(saved(pieces(docs, path, end_id, size, known=known), "pieces"), ["doc_id", "piece", "ids_crc32"], size)
