"""Operator 4: near-duplicate documents by BagMinHash signatures, banding, and verified multiset overlap.

A text is the multiset of its shingles of five words. Each shingle of weight w runs Poisson processes over the integer
weight levels: one process for each dyadic interval of levels, [0,1), [1,2), [2,4), [4,8) and so on, with the
interval's length as its rate. A point has a time, a register and a level; it counts for the text if its level is below
w. A register keeps the earliest time, so two registers agree with a probability equal to the weighted Jaccard
similarity, and the work follows the registers and not the weights: points later than all registers can hold are never
drawn.

Texts that share a band of registers meet; equal texts are one from the start. Links are verified exactly (sum of
minima over sum of maxima of counts) as near_classes has it. Pairs whose registers agree in fewer than LEAST_AGREE
places are not looked at: a pair at the threshold does that with a probability of 1e-10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import Words, boxed, gram_hashes, join_spread, kept, mix64, own, unboxed
from scriptorium.llm.near_classes import LAST, Measure, classified, common_elements, text_keys

SHINGLE, SIMILAR_NUM, SIMILAR_DEN = 5, 4, 5  # five words, a similarity of 4/5
BANDS, ROWS = 25, 5  # at 0.8 a pair misses all bands with a probability of 5e-5
REGISTERS = BANDS * ROWS
LEAST_AGREE = 70


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of every distinct shingle of a batch. One to four words are one shingle; no words, none."""
    h, many = words.hashes(), words.counts
    grams = gram_hashes(h, SHINGLE)
    each = np.maximum(0, many - SHINGLE + 1)
    owner = np.repeat(np.arange(len(many)), each)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each) + words.starts[:-1][owner]
    own = grams[place] if len(owner) else grams[:0]
    short = np.flatnonzero((many > 0) & (many < SHINGLE))
    few = np.zeros(len(short), np.uint64)
    for k in range(SHINGLE - 1):
        on = many[short] > k
        few[on] = mix64(few[on] * np.uint64(31) + h[words.starts[:-1][short[on]] + k], 5)
    owner, own = np.concatenate([owner, short]), np.concatenate([own, few])
    order = np.lexsort((own, owner))
    owner, own = owner[order], own[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], own[first], np.diff(np.append(first, len(own)))


def registers(owner: np.ndarray, grams: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """BagMinHash: the earliest time in each register, texts x REGISTERS; infinite for texts without shingles."""
    out = np.full(texts * REGISTERS, np.inf)
    total = np.bincount(owner, counts, texts)
    todo = total > 0
    reach = np.log(REGISTERS) + 5.0
    while todo.any():
        out.reshape(texts, REGISTERS)[todo] = np.inf
        horizon = REGISTERS / np.maximum(total, 1) * reach
        pick = np.flatnonzero(todo[owner])
        low, width = 0, 1
        while len(pick):
            _points(out, owner[pick], mix64(grams[pick], low + 1), counts[pick], low, width, horizon)
            low, width = low + width, max(1, low + width)
            pick = pick[counts[pick] > low]
        todo &= np.isinf(out.reshape(texts, REGISTERS)).any(1)
        reach *= 2
    return out.reshape(texts, REGISTERS)


def _points(out: np.ndarray, owner: np.ndarray, seed: np.ndarray, weight: np.ndarray, low: int, width: int, horizon: np.ndarray) -> None:
    """Draws the points of the processes over levels [low, low + width) up to each text's horizon."""
    time, turn, end = np.zeros(len(owner)), 0, horizon[owner]
    while len(owner):
        a = mix64(seed, 2 * turn + 1000)
        time = time - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        live = np.flatnonzero(time < end)
        owner, seed, weight, time, end = owner[live], seed[live], weight[live], time[live], end[live]
        b = mix64(seed, 2 * turn + 1001)
        register = (b % np.uint64(REGISTERS)).astype(np.int64)
        if width > 1:
            level = low + ((b >> np.uint64(32)).astype(np.float64) / 2.0**32 * width).astype(np.int64)
            counts = level < weight
            np.minimum.at(out, owner[counts] * REGISTERS + register[counts], time[counts])
        else:
            np.minimum.at(out, owner * REGISTERS + register, time)
        turn += 1


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash for each band, texts x BANDS."""
    bits = signature.view(np.uint64).reshape(-1, BANDS, ROWS)
    out = np.zeros(bits.shape[:2], np.uint64)
    for r in range(ROWS):
        out = mix64(out ^ bits[:, :, r], r)
    return out.view(np.int64)


def register_bytes(signature: np.ndarray) -> np.ndarray:
    """One byte of a hash for each register: enough to count agreements."""
    return (mix64(signature.view(np.uint64), 9) & np.uint64(0xFF)).astype(np.uint8)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h1, h2, pick) with the bands, the short signature and the number of words of the text in column 4."""
    for b in batches:
        words = Words(b.column(4))
        times = registers(*shingles(words), len(b))
        signature, short = bands(times), register_bytes(times)
        sizes = np.where(words.counts > 0, BANDS, 0)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(signature[words.counts > 0].ravel()))
        yield pa.RecordBatch.from_arrays([*b.columns[:4], lists, pa.array([r.tobytes() for r in short], pa.binary()), pa.array(words.counts, pa.int32())], ["id", "h1", "h2", "pick", "bands", "short", "size"])


def similar(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Which pairs of texts have a weighted Jaccard similarity of 4/5 or more, by exact counts."""
    one, two = shingles(Words(a)), shingles(Words(b))
    owner, own = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    counts = np.concatenate([one[2], two[2]])
    order = np.lexsort((own, owner))
    owner, own, counts = owner[order], own[order], counts[order]
    both = np.flatnonzero((owner[1:] == owner[:-1]) & (own[1:] == own[:-1]))
    least = np.bincount(owner[both], np.minimum(counts[both], counts[both + 1]), len(a)).astype(np.int64)
    most = np.bincount(owner, counts, len(a)).astype(np.int64) - least
    return (SIMILAR_DEN * least >= SIMILAR_NUM * most) & (most > 0)


def agree(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one == two).sum(1) >= LEAST_AGREE


def elements(texts: pa.Array) -> list[bytes]:
    """Each text's multiset as a set of (shingle, how often before) hashes: overlaps become counts of common elements."""
    owner, grams, counts = shingles(Words(texts))
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = mix64(np.repeat(grams, counts) + turn.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 6)
    ends = np.searchsorted(np.repeat(owner, counts), np.arange(len(texts) + 1))
    return [flat[x:y].tobytes() for x, y in zip(ends, ends[1:], strict=False)]


def across(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    one, two = ([np.frombuffer(h, np.uint64) for h in side] for side in (left, right))
    size = np.array([len(x) for x in one])[:, None] + np.array([len(x) for x in two])
    common = common_elements(one, two)
    return np.nonzero((common > 0) & (SIMILAR_DEN * common >= SIMILAR_NUM * (size - common)))


MEASURE = Measure(agree, similar, elements, across)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Adds class_id (long) and kept (boolean) to every row; input columns of these names, in any case, are replaced.

    class_id is the smallest doc_id of the row's class: rows with equal texts, or joined by links of similarity 0.8 or
    more. kept marks one row of each class: that of the smallest id, and of several rows of that id one by a hash of the
    row. Null and empty texts and texts of blanks alone are like equal texts only. Rows are classed by their texts, also
    where they share an id. A null id takes part and comes after all others; a class of null ids only has a null
    class_id and keeps one row as well. An empty table gives an empty result.
    """
    keep = kept(docs, "class_id", "kept")
    plain = [c for c in keep if "map<" not in (kind := docs.schema[c].dataType.simpleString()) and "variant" not in kind]
    pick = F.xxhash64(F.lit(8), *[own(c) for c in plain])  # tells rows apart, but for those alike in all columns
    signed, facts = classified(docs, pick, _banded, MEASURE)
    out = docs.select(boxed(keep), *text_keys(), pick.alias("pick"))
    out = join_spread(out, facts, ["h1", "h2"], ["class_id", "best"], signed.count(), F.col("pick"))
    chosen = (F.col("id") == F.col("best.id")) & (F.col("pick") == F.col("best.pick"))
    if signed.groupBy("h1", "h2", "id", "pick").count().where("count > 1").head(1):  # rows alike in all columns
        alike = Window.partitionBy("h1", "h2", "id", "pick")
        out = out.withColumn("turn", F.row_number().over(alike.orderBy(F.lit(1))))
        chosen = chosen & (F.col("turn") == 1)
    return out.select(*unboxed(keep), "class_id", chosen.alias("kept"))


def near_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its class and whether it stands for it, as near_duplicates has them. Texts are not exchanged for this."""
    signed, facts = classified(docs, F.monotonically_increasing_id(), _banded, MEASURE)
    out = join_spread(signed.select("id", "h1", "h2", "pick"), facts, ["h1", "h2"], ["class_id", "best"], signed.count(), F.col("pick"))
    chosen = (F.col("id") == F.col("best.id")) & (F.col("pick") == F.col("best.pick"))
    return out.select(F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"), "class_id", chosen.alias("kept"))
