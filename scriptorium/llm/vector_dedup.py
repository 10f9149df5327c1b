"""Operator 7: embedding near-dedup by randomised-rotation binary codes with stored correction factors.

Each distinct vector is scaled to length 1, turned by a random rotation and stored once more as a short record: the
signs of its coordinates as packed bits, the correction factor <signs, vector>, and the turned coordinates in four bit
planes. From the signs of one vector and the planes of another, <signs, other> / <signs, vector> is an unbiased
estimate of their inner product, computed by counting bits; for a pair at the threshold its error has a known spread, so
a pair whose estimate lies ERRORS spreads below the threshold is settled and the others are computed exactly, in double
precision.

Runs of sign bits of further rotations are hash tables: vectors meet if a run agrees, and runs are so many that a pair
at the threshold is missed with a probability below MISS. Short records alone go to the buckets first; whole vectors
follow only where an estimate asks for them. A bucket of any size is compared in blocks, a task for each pair of blocks,
that count links and return stars, never the pairs themselves.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import join_spread, lean, own, saved
from scriptorium.llm.graph import components, stars

COSINE, MISS, BLOCK, ERRORS, PLANES = 0.98, 1e-5, 256, 5.0, 4
LAST = 2**63 - 1  # stands for a null id
BUCKET = ["label", "d", "table", "code"]


@functools.lru_cache(4)
def rotations(dims: int, bits: int) -> np.ndarray:
    """One random rotation for the short records and enough for so many table bits, side by side: dims x (a multiple of dims)."""
    draw = np.random.default_rng(7)
    return np.concatenate([np.linalg.qr(draw.standard_normal((dims, dims)))[0] for _ in range(1 - (-bits // dims))], 1)


def table_shape(largest: int, cosine: float = COSINE) -> tuple[int, int]:
    """Bits in a run and number of runs, for groups of `largest` vectors: buckets of about 64 where vectors spread evenly."""
    bits = min(24, max(6, math.ceil(math.log2(max(2, largest) / 64))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _bits(on: np.ndarray) -> np.ndarray:
    """Rows of booleans, packed into 64-bit words."""
    wide = np.zeros((len(on), -(-on.shape[1] // 64) * 64), bool)
    wide[:, : on.shape[1]] = on
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def short_records(turned: np.ndarray) -> np.ndarray:
    """Turned unit vectors to 64-bit words: sign bits, PLANES bit planes, and as doubles the factor, the planes' origin and step, the sum."""
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / (2**PLANES - 1), 1e-300)
    level = np.floor((turned - low[:, None]) / step[:, None] + 0.5).astype(np.uint8)
    facts = np.stack([np.abs(turned).sum(1) / math.sqrt(turned.shape[1]), low, step, turned.sum(1)], 1)
    return np.concatenate([_bits(turned >= 0), *[_bits(level >> j & 1 > 0) for j in range(PLANES)], facts.view(np.uint64)], 1)


def estimates(a: np.ndarray, b: np.ndarray, dims: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all of a with all of b (short records), and the spread of the error for a pair at the threshold."""
    words = -(-dims // 64)
    dot = np.zeros((len(a), len(b)), np.uint32)
    for j in range(PLANES):
        for w in range(words):
            dot += np.bitwise_count(a[:, w, None] & b[None, :, (1 + j) * words + w]).astype(np.uint32) << j
    factor = np.ascontiguousarray(a[:, -4:]).view(np.float64)[:, 0, None]
    low, step, total = np.ascontiguousarray(b[:, -3:]).view(np.float64).T
    on = np.bitwise_count(a[:, :words]).sum(1)[:, None]
    guess = (2 * (low * on + step * dot) - total) / math.sqrt(dims) / factor
    turn = (1 - factor**2) * (1 - cosine**2) / max(1, dims - 1)
    return guess, np.sqrt(np.maximum(0, turn) + step**2 / 12) / factor


def likely(a: np.ndarray, b: np.ndarray, dims: int, cosine: float) -> np.ndarray:
    """Which pairs the estimates do not rule out."""
    guess, spread = estimates(a, b, dims, cosine)
    return guess + ERRORS * spread >= cosine


def settle(x: np.ndarray, y: np.ndarray, maybe: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) marked in maybe whose unit vectors x[i] and y[j] have an inner product of cosine or more."""
    i, j = np.nonzero(maybe)
    if 20 * len(i) > maybe.size:
        good = (x @ y.T)[i, j] >= cosine
    else:
        good = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
    return i[good], j[good]


def vector_links(df: DataFrame, vec_id: str, vector: str, label: str, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; links join rows of one label with a cosine of `cosine` or more.

    Vectors that are null, empty, zero, or hold null or non-finite components, rows without a label, and vectors of
    different length link with nothing. Repeated rows, and rows that share an id, are rows of their own, each with the
    links of its vector. component_id is the smallest id that links reach; null ids take part and count as larger than
    any other, so a component of null ids alone has a null component_id, and rows without an id are never kept. Other
    columns play no part; an empty table gives no rows.
    """
    v = own(vector)
    real = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = own(label).isNotNull() & v.isNotNull() & (F.size(v) > 0) & real & F.exists(v, lambda x: x != 0)
    wide = F.transform(v, lambda x: x.cast("double") + 0.0)
    rows = df.select(F.coalesce(own(vec_id).cast("long"), F.lit(LAST)).alias("id"), own(label).cast("string").alias("label"), F.when(F.coalesce(sound, F.lit(False)), wide).alias("v"))
    rows = rows.withColumns({f"k{i}": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), "label", "v")) for i in (1, 2)})
    groups = rows.where("v is not null").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("v").alias("v"))
    groups = saved(groups.withColumn("node", F.monotonically_increasing_id()), "vectors")  # numbers are fixed once written
    kind = "f4" if df.schema[vector].dataType.simpleString() == "array<float>" else "f8"
    linked = saved(_links_of(groups, cosine, kind), "vector-links")
    counts = linked.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    comps = components(linked.where("b is not null"), "a", "b").select(F.col("id").alias("node"), "component")
    reps = groups.select("k1", "k2", "rep", "m", "node").join(counts, "node", "left").join(comps, "node", "left")
    reps = saved(reps.withColumn("component", F.coalesce("component", "node")), "vector-facts")
    least = saved(reps.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("n")), "vector-components")
    facts = join_spread(reps, least, ["component"], ["least"], reps.count(), F.col("node"))
    facts = saved(facts.select("k1", "k2", F.col("m").alias("n"), (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "least"), "vector-facts")
    out = join_spread(rows.select("id", "k1", "k2"), facts, ["k1", "k2"], ["n_links", "least"], df.count(), F.col("id"))
    named = lambda c: F.when(c < LAST, c)
    out = out.select(named(F.col("id")).alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), named(F.coalesce("least", "id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(own(vec_id) == F.col("component_id"), F.lit(False)))


def _met(keys: DataFrame) -> DataFrame:
    """keys(*BUCKET, node): members of buckets of two or more, once for each pair (i, j) of the bucket's blocks that they are in; own: their block."""
    sizes = saved(keys.groupBy(*BUCKET).agg(F.count("*").alias("n")), "vector-buckets").where("n > 1")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    sized = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    out = join_spread(keys, sized, BUCKET, ["blocks"], total, F.col("node")).where("blocks is not null")
    out = out.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    out = out.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with"))


def _in_blocks(met: DataFrame, facts: DataFrame, compare: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """compare, applied to the members of every pair of blocks with their facts (by node)."""
    place = [*BUCKET, "i", "j"]
    rows = met.select(*place, "own", "node").join(facts, "node").select(*place, "own", "node", *[c for c in facts.columns if c != "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            new = np.zeros(max(0, len(b) - 1), bool)
            for k in range(len(place)):
                mark = b.column(k).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                new |= mark[1:] != mark[:-1]
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(b)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    if held and any(held[-1].column(k)[0] != b.column(k)[lo] for k in range(len(place))):
                        yield compare(pa.Table.from_batches(held).combine_chunks())
                        held = []
                    held.append(b.slice(lo, hi - lo))
        if held:
            yield compare(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(*place).sortWithinPartitions(*place, "node").mapInArrow(lean(run), schema)


def _words(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(len(t), -1)


def _links_of(groups: DataFrame, cosine: float, kind: str) -> DataFrame:
    """(a, b, n): rows with b are star edges between nodes; rows without say that a has n links to other nodes' rows. kind: f4 or f8, as vectors were stored."""
    sizes = groups.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("n"))
    bits, tables = table_shape(sizes.agg(F.max("n")).first()[0] or 0, cosine)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(3).value_lengths().to_numpy()
            for d in np.unique(lengths).tolist():
                part = b.take(pa.array(np.flatnonzero(lengths == d)))
                x = part.column(3).flatten().to_numpy().reshape(-1, d)
                turned = unit(x) @ rotations(d, bits * tables)
                runs = ((turned[:, d : d + bits * tables] >= 0).reshape(len(x), tables, bits) @ (1 << np.arange(bits))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * tables, pa.int32()), pa.array(runs.ravel()))
                blobs = [pa.array([r.tobytes() for r in y], pa.binary()) for y in (short_records(turned[:, :d]), x.astype(kind))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([d] * len(x), pa.int32()), *blobs, lists], ["label", "node", "m", "d", "short", "x", "runs"])

    def ask(t: pa.Table) -> pa.RecordBatch:
        """Members with a pair that the estimates do not rule out, by short records alone."""
        i, j, d = (t.column(c)[0].as_py() for c in ("i", "j", "d"))
        short, home = _words(t, "short", np.uint64), t.column("own").to_numpy()
        one, two = (np.flatnonzero(home == k) for k in (i, j))
        wanted = np.zeros(len(t), bool)
        for lo in range(0, len(one), BLOCK):
            for at in range(0, len(two), BLOCK):
                p, q = one[lo : lo + BLOCK], two[at : at + BLOCK]
                maybe = likely(short[p], short[q], d, cosine) & (p[:, None] != q[None, :])
                wanted[p] |= maybe.any(1)
                wanted[q] |= maybe.any(0)
        return _one_batch(t.filter(pa.array(wanted)).select([*BUCKET, "node"]))

    def compare(t: pa.Table) -> pa.RecordBatch:
        table, i, j, d = (t.column(c)[0].as_py() for c in ("table", "i", "j", "d"))
        node, m, home = (t.column(c).to_numpy() for c in ("node", "m", "own"))
        short, x = _words(t, "short", np.uint64), unit(_words(t, "x", kind).astype(np.float64))
        runs = t.column("runs").combine_chunks().flatten().to_numpy().reshape(len(t), tables)
        one, two = (np.flatnonzero(home == k) for k in (i, j))
        links, first, second = np.zeros(len(t), np.int64), [], []
        for lo in range(0, len(one), BLOCK):
            for at in range(0, len(two), BLOCK):
                p, q = one[lo : lo + BLOCK], two[at : at + BLOCK]
                maybe = likely(short[p], short[q], d, cosine)
                if i == j:
                    maybe &= p[:, None] < q[None, :]  # the blocks hold the same rows
                r, s = settle(x[p], x[q], maybe, cosine)
                p, q = p[r], q[s]
                for run in range(table):  # a pair counts in the first table where it meets, and there alone
                    fresh = runs[p, run] != runs[q, run]
                    p, q = p[fresh], q[fresh]
                links += np.bincount(p, m[q], len(t)).astype(np.int64) + np.bincount(q, m[p], len(t)).astype(np.int64)
                first.append(p)
                second.append(q)
        some = np.flatnonzero(links)
        near, far = stars(len(t), np.concatenate(first), np.concatenate(second)) if first else (some[:0], some[:0])
        b = pa.array([None] * len(some) + node[far].tolist(), pa.int64())
        n = np.concatenate([links[some], np.zeros(len(far), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[some], node[near]]), pa.int64()), b, pa.array(n)], ["a", "b", "n"])

    coded = groups.select("label", "node", "m", "v").mapInArrow(lean(encode), "label string, node long, m long, d int, short binary, x binary, runs array<int>")
    coded = saved(coded, "vector-codes")
    keys = coded.select("label", "d", F.posexplode("runs").alias("table", "code"), "node")
    asked = _in_blocks(_met(keys), coded.select("node", "short"), ask, "label string, d int, table int, code int, node long")
    asked = saved(asked.distinct(), "vector-candidates")
    return _in_blocks(_met(asked), coded.select("node", "m", "short", "x", "runs"), compare, "a long, b long, n long")


def _one_batch(t: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in t.columns], t.column_names)


def vector_digest(embeddings: DataFrame) -> DataFrame:
    """The links of the table's vectors; the cases of vector_links hold."""
    return vector_links(embeddings, "vec_id", "embedding", "label")
