"""Connected components of a graph that no machine holds whole, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import join_spread, lean, saved

ONE_TASK = 1 << 18  # so many edges at most are joined in one task; more go by stars


class Forest:
    """A small union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, a: int) -> int:
        while (b := self.up.setdefault(a, a)) != a:
            self.up[a] = a = self.up[b]
        return a

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart until now."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def stars(n: int, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (k, least of k's component) that join what the edges (p, q) over nodes 0 to n - 1 join."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[p], least[q])
        now = least.copy()
        np.minimum.at(now, p, low)
        np.minimum.at(now, q, low)
        now = np.minimum(now, now[now])
        if (now == least).all():
            break
        least = now
    far = np.flatnonzero(least != np.arange(n))
    return far, least[far]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            forest.join(x, y)
    found = [(a, r) for a in sorted(forest.up) if (r := forest.root(a)) != a]
    for lo in range(0, len(found), 10_000):
        ids, roots = zip(*found[lo : lo + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and an order-free checksum, to see whether a round changed anything."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1))).alias("h")).first()
    return r["n"], r["h"] or 0


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): for every id in an edge but the smallest of each component, the smallest id it reaches.

    Loops and repeated edges are fine; nulls are not edges. A large star hangs a node's larger neighbours on its smallest
    neighbour, a small star the smaller ones, until every tree is a star. A node's minimum is a combining aggregate, and
    hubs' minima are broadcast to their edges, so a hub costs no task of its own. Up to ONE_TASK edges are joined in one.
    """
    big, small = F.greatest(a, b), F.least(a, b)
    now = saved(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(big.alias("a"), small.alias("b")).distinct(), "edges")
    mark = _mark(now)
    if mark[0] <= ONE_TASK:
        now, mark = saved(now.coalesce(1).mapInArrow(lean(_joined), "a long, b long"), "edges"), (0, 0)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = join_spread(both, least, ["a"], ["m"], 2 * mark[0], F.col("b")).where("b > a and b <> m")
        large = saved(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        hung = join_spread(large, least, ["a"], ["m"], mark[0], F.col("b")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = saved(hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
