"""Classes of near texts from banded signatures: candidates by buckets, links verified on whole texts.

Texts that share a band of their signatures meet in a bucket. Links are verified exactly, in three steps:

1. each text against one pivot, the same for as many of its buckets as can be, which joins most classes;
2. where a bucket of SMALL members at most still spans classes, the pairs across them;
3. where a larger one does, the members outside its largest class against all: in blocks, a task for each pair of
   blocks, which returns stars over classes, never the pairs.

After that every pair of bucket members is in one class or was compared or has signatures that agree too little: no
bucket is cut short. Buckets and pivots that hold a large share of all rows are spread over tasks throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import SLICE_BYTES, join_spread, lean, maybe_among, saved
from scriptorium.llm.graph import components, stars

SMALL, BLOCK, BLOCK_SIZE = 32, 1024, 2 << 20  # members of small buckets and of blocks; sum of sizes in a block
LAST = 2**63 - 1  # stands for a null id
PAIRS_PER_TASK = 256  # of one pivot
LISTED = 16  # elements that give more pairs of sets than this are multiplied


@dataclass
class Measure:
    """What makes two texts near. The functions run in workers.

    agree: which pairs of signature bytes (two arrays, pairs x bytes) are worth a look at the texts.
    similar: which pairs of texts (two Arrow arrays) are near, exactly.
    prepared: what stands for each text of an Arrow array in a block.
    across: the near pairs (i, j) of two lists of what was prepared.
    """

    agree: Callable[[np.ndarray, np.ndarray], np.ndarray]
    similar: Callable[[pa.Array, pa.Array], np.ndarray]
    prepared: Callable[[pa.Array], list[bytes]]
    across: Callable[[list[bytes], list[bytes]], tuple[np.ndarray, np.ndarray]]


def common_elements(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each set on the left with each on the right; sets are arrays without repeats."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        owner, flat = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        owner, flat = owner[order], flat[order]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, int)
        sides.append((owner, flat[first], first, np.diff(np.append(first, len(flat)))))
    (own_l, el_l, first_l, many_l), (own_r, el_r, first_r, many_r) = sides
    _, at_l, at_r = np.intersect1d(el_l, el_r, assume_unique=True, return_indices=True)

    def members(owner: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners of chosen elements, and the number of the element that each is of."""
        which = np.repeat(np.arange(len(many)), many)
        return owner[np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)], which

    listed = many_l[at_l] * many_r[at_r] <= LISTED
    a, b = at_l[listed], at_r[listed]
    rows, which = members(own_l, first_l[a], many_l[a])
    cols, turn = members(own_r, first_r[b][which], many_r[b][which])
    out += np.bincount(rows[turn] * len(right) + cols, minlength=out.size).reshape(out.shape).astype(np.float32)
    a, b = at_l[~listed], at_r[~listed]
    for lo in range(0, len(a), 2048):
        cells = []
        for owner, first, many, n, x in ((own_l, first_l, many_l, len(left), a), (own_r, first_r, many_r, len(right), b)):
            x = x[lo : lo + 2048]
            row, col = members(owner, first[x], many[x])
            cell = np.zeros((n, len(x)), np.float32)
            cell[row, col] = 1
            cells.append(cell)
        out += cells[0] @ cells[1].T
    return out


def _agreeing(measure: Measure) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(len(b), -1) for k in (2, 3))
            yield b.select([0, 1]).filter(pa.array(measure.agree(one, two)))

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h1, h2, z): texts travel compressed."""
    for b in batches:
        press = zstandard.ZstdCompressor()
        z = [press.compress(t) for t in b.column(3).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(z, pa.binary())], ["id", "h1", "h2", "z"])


def opened(b: pa.RecordBatch, *at: int) -> Iterator[tuple]:
    """The batch in slices, each with its texts of those columns; a slice has about SLICE_BYTES of text at most, one row at least."""
    packed = [b.column(k).to_pylist() for k in at]
    size = sum(np.array([zstandard.frame_content_size(z) for z in column], np.int64) for column in packed)
    ends = [*(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1).tolist(), len(b)]
    for lo, hi in zip([0, *ends], ends, strict=False):
        press = zstandard.ZstdDecompressor()
        yield b.slice(lo, hi - lo), *[pa.array([press.decompress(z) for z in column[lo:hi]], pa.binary()).view(pa.string()) for column in packed]


def _verified(measure: Measure) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, one, two in opened(b, 2, 3):
                yield part.select([0, 1]).filter(pa.array(measure.similar(one, two), pa.bool_()))

    return run


def _beside(pairs: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """Written pairs(a, b, ...) with the value that facts(node, value) have for a and for b, as `of_a` and `of_b`.

    b may be the same in a large share of all pairs: its value then goes to as many tasks as its pairs fill.
    """
    sized = pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / PAIRS_PER_TASK).cast("int"))
    rows = join_spread(pairs, sized, ["b"], ["salts"], pairs.count(), F.col("a")).withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    copies = facts.select(F.col("node").alias("b"), F.col(value).alias("of_b")).join(sized.select("b", "salts"), "b")
    copies = copies.select("b", "of_b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = rows.join(facts.select(F.col("node").alias("a"), F.col(value).alias("of_a")), "a").join(copies, ["b", "salt"])
    return rows.select("a", "b", "of_a", "of_b")


def classes(reps: DataFrame, texts: Callable[[DataFrame], DataFrame], measure: Measure) -> DataFrame:
    """(id, component): for every node that links take to a smaller one, the smallest node of its class.

    reps: a written table (node, bands array<long>, short binary, size int), a row for each distinct text; size: what a
    text weighs in a block. texts: from (node) to (node, z), each node once; z is its text as `opened` reads it.
    """

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs(a, b) whose texts are near. Signatures are asked first, so few texts travel."""
        pairs = saved(pairs, "pairs")
        likely = saved(_beside(pairs, reps, "short").mapInArrow(lean(_agreeing(measure)), "a long, b long"), "pairs")
        used = texts(saved(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "pair-ids"))
        return saved(_beside(likely, used, "z").mapInArrow(lean(_verified(measure)), "a long, b long"), "links")

    rows = reps.select("node", "size", F.posexplode("bands").alias("band", "key")).where("key is not null")
    order = F.xxhash64(F.lit(4), "node")
    full = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min(F.struct(order.alias("o"), "node")).alias("head"), F.sum("size").alias("sizes"))
    full = saved(full.where("n > 1"), "buckets")
    total = full.agg(F.sum("n")).first()[0] or 0
    members = saved(join_spread(rows, full, ["band", "key"], ["n", "head", "sizes"], total, F.col("node")).where("n is not null"), "bucket-members")
    first = members.groupBy("node").agg(F.min("head").alias("head"))  # buckets share their pivots, so most classes come whole
    links = verified(first.select(F.col("node").alias("a"), F.col("head.node").alias("b")).where("a <> b"))
    known = components(links, "a", "b")

    def still_open(size) -> DataFrame:
        """Members of buckets of such a size that span classes, with their classes."""
        mine = members.where(size).join(known.withColumnRenamed("id", "node"), "node", "left")
        mine = saved(mine.select("band", "key", "node", "n", "size", "sizes", F.coalesce("component", "node").alias("c")), "bucket-classes")
        mixed = mine.groupBy("band", "key").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("n")).where("c1 < c2")
        return join_spread(mine, mixed, ["band", "key"], ["c1"], total, F.col("node")).where("c1 is not null").drop("c1")

    few = saved(still_open(F.col("n") <= SMALL), "open-buckets")
    other = few.select("band", "key", F.col("node").alias("b"), F.col("c").alias("cb"))
    pairs = few.join(other, ["band", "key"]).where("node > b and c <> cb").select(F.col("node").alias("a"), "b").distinct()
    links = links.unionByName(verified(pairs))
    known = components(links, "a", "b")

    many = saved(still_open(F.col("n") > SMALL), "open-buckets")
    if many.head(1):
        links = links.unionByName(saved(_across(many, texts, measure, total), "links"))
        known = components(links, "a", "b")
    return known


def _across(many: DataFrame, texts: Callable[[DataFrame], DataFrame], measure: Measure, total: int) -> DataFrame:
    """Edges between classes: members outside a bucket's largest class (side 0) against all members (side 1), in blocks."""
    held = many.groupBy("band", "key", "c").agg(F.count("*").alias("k"), F.sum("size").alias("s"), F.first("n").alias("n"), F.first("sizes").alias("sizes"))
    held = held.groupBy("band", "key").agg(F.max(F.struct("k", "c", "s")).alias("major"), F.first("n").alias("n"), F.first("sizes").alias("sizes"))
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SIZE), F.lit(1)).cast("int")
    held = held.select("band", "key", "n", F.col("major.c").alias("major"), blocks(F.col("n") - F.col("major.k"), F.col("sizes") - F.col("major.s")).alias("ni"), blocks(F.col("n"), F.col("sizes")).alias("nj"))
    rows = join_spread(many.select("band", "key", "node", "c"), saved(held, "open-blocks"), ["band", "key"], ["major", "ni", "nj"], total, F.col("node"))
    spread = lambda n: F.pmod(F.xxhash64(F.lit(4), "node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    minor = rows.where("c <> major").withColumn("j", upto("nj")).select("band", "key", spread("ni").alias("i"), "j", F.lit(0).alias("side"), "node", "c")
    whole = rows.withColumn("i", upto("ni")).select("band", "key", "i", spread("nj").alias("j"), F.lit(1).alias("side"), "node", "c")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, own in opened(b, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(measure.prepared(own), pa.binary())], ["node", "held"])

    def compare(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sides = [[h for h in held if h[0] == s] for s in (0, 1)]
        c = [np.array([h[1] for h in side], np.int64) for side in sides]
        i, j = measure.across(*[[h[2] for h in side] for side in sides]) if all(sides) else (np.zeros(0, int), np.zeros(0, int))
        other = c[0][i] != c[1][j]
        names, at = np.unique(np.concatenate([c[0][i[other]], c[1][j[other]]]), return_inverse=True)
        far, near = stars(len(names), at[: len(at) // 2], at[len(at) // 2 :])
        return pa.RecordBatch.from_arrays([pa.array(names[far], pa.int64()), pa.array(names[near], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (band, key, i, j)."""
        now, rows_ = None, []
        for b in batches:
            keys = zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)
            for key, *row in zip(keys, *(b.column(k).to_pylist() for k in (4, 5, 6)), strict=True):
                if key != now:
                    yield compare(rows_)
                    now, rows_ = key, []
                rows_.append(tuple(row))
        yield compare(rows_)

    place = ["band", "key", "i", "j"]
    ids = saved(many.select("node").distinct(), "open-ids")
    sets = saved(texts(ids).mapInArrow(lean(prepare), "node long, held binary"), "block-texts")
    met = minor.unionByName(whole).join(sets, "node").select(*place, "side", "c", "held")
    return met.repartition(*place).sortWithinPartitions(*place).mapInArrow(lean(run), "a long, b long")


def text_keys() -> list:
    """A row's id (null: LAST) and two hashes of its text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2")]


def classified(docs: DataFrame, pick: Column, banded: Callable, measure: Measure) -> tuple[DataFrame, DataFrame]:
    """(id, h1, h2, pick, ...) of every row, and of every distinct text (h1, h2, n, class_id, best): n rows have it; best is (id, pick) of its class's row to keep.

    banded: from batches of (id, h1, h2, pick, text) to those but the text and (bands, short, size), as classes needs them.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    schema = "id long, h1 long, h2 long, pick long, bands array<long>, short binary, size int"
    signed = saved(docs.select(*text_keys(), pick.alias("pick"), text).mapInArrow(lean(banded), schema), "signatures")
    reps = signed.groupBy("h1", "h2").agg(F.min(F.struct("id", "pick")).alias("best"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("short").alias("short"), F.first("size").alias("size"))
    reps = saved(reps.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")  # numbers are fixed once written

    def texts(nodes: DataFrame) -> DataFrame:
        """From the row of the smallest id; rows alike in id and text count once. Most other rows stay where they are."""
        wanted = saved(reps.select("h1", "h2", "node", F.col("best.id").alias("id")).join(nodes, "node", "left_semi"), "wanted-texts")
        rows = maybe_among(docs.select(*text_keys(), text), wanted, F.xxhash64(F.lit(3), "id", "h1", "h2"), wanted.count())
        rows = rows.mapInArrow(lean(_packed), "id long, h1 long, h2 long, z binary")
        return rows.join(wanted, ["id", "h1", "h2"]).groupBy("node").agg(F.first("z").alias("z"))

    known = classes(reps.select("node", "bands", "short", "size").where(F.size("bands") > 0), texts, measure)
    named = reps.select("h1", "h2", "n", "node", "best").join(known.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = saved(named, "text-classes")
    least = saved(named.groupBy("component").agg(F.min("best").alias("least"), F.count("*").alias("n")), "class-facts")
    named = join_spread(named, least, ["component"], ["least"], named.count(), F.col("node"))
    class_id = F.when(F.col("least.id") < LAST, F.col("least.id"))
    return signed, saved(named.select("h1", "h2", "n", class_id.alias("class_id"), F.col("least").alias("best")), "text-facts")
