"""Operator 5: document fingerprints by randomised edit embedding.

A walk reads a text and, at each step, emits the character under its head and then moves on or stays by a random bit
that depends on the step and the character alone. All texts share the bits, so texts at a small edit distance fall back
into step and their emitted strings agree in most places: edit distance becomes Hamming distance. The fingerprint keeps
a 4-bit hash of the emitted character at sampled steps, as many from each octave of steps, so texts of any length are
sampled along their whole length and longer texts only add samples. Fingerprints compare by weighted agreement.

Near texts are found by banding: each band is a handful of samples at random places of the fingerprint, the same for all
texts of its octaves. Texts that share a band and are about as long meet; those whose counts of neighbouring characters
differ by more than a few edits can change go apart, the others are verified by their edit distance.

A walk's stay at a character is looked up (`DWELL`: steps until the next 1 bit), so a text costs one table access per
character. Bits repeat every PERIOD steps, and the last of a period is 1 for all; characters count by 256 classes, so
some differ by the verification only.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import join_spread, lean, mix64, saved
from scriptorium.llm.near_classes import LAST, Measure, classified

PERIOD, CLASSES, PER_OCTAVE, OCTAVES = 4096, 256, 64, 34
FEW = 64  # below so many texts still under way, plain loops beat vectors
BLOCK = 512
ROWS_PER_BUCKET, MOST_BUCKETS, RANGES = 4096, 65_536, 128
NEAR, LEAST_SAMPLES, MARGIN = 4, 64, 24  # edits of near texts; texts with fewer samples are near equal ones alone
CHANCE, AGREE, LOST = 0.13, 0.88, 0.02  # agreement of samples of unlike texts and of near ones; near texts that share no band
PAIR_BLOCK = 512  # texts in a block of a bucket that is compared
SPAN = 32  # lengths, in characters, of texts that can share a band


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    cells = np.arange(CLASSES * PERIOD, dtype=np.uint64)
    bits = (mix64(cells, 51) >> np.uint64(40) & np.uint64(1)).astype(bool).reshape(CLASSES, PERIOD)
    bits[:, -1] = True
    dwell = np.ones((CLASSES, PERIOD), np.int64)
    for j in range(PERIOD - 2, -1, -1):
        dwell[:, j] = np.where(bits[:, j], 1, 1 + dwell[:, j + 1])
    steps, weights = [np.arange(PER_OCTAVE)], [np.ones(PER_OCTAVE)]
    for k in range(OCTAVES):
        width = 1 << k
        jitter = mix64(np.arange(PER_OCTAVE, dtype=np.uint64), 100 + k) % np.uint64(width)
        steps.append(PER_OCTAVE * width + np.arange(PER_OCTAVE) * width + jitter.astype(np.int64))
        weights.append(np.full(PER_OCTAVE, float(width)))
    digits = (mix64(np.arange(CLASSES * 16, dtype=np.uint64), 52) >> np.uint64(30) & np.uint64(15)).astype(np.uint8).reshape(CLASSES, 16)
    return dwell, np.concatenate(steps), np.cumsum(np.concatenate(weights)), np.frombuffer(b"0123456789abcdef", np.uint8)[digits]


DWELL, STEPS, WEIGHT_SO_FAR, DIGITS = _tables()
WEIGHT = np.diff(WEIGHT_SO_FAR, prepend=0)
ROWS = [r.tolist() for r in DWELL]
FLAT = DWELL.ravel()


def classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((cp ^ (cp >> 8)) & 0xFF).astype(np.uint8)


def walk(codes: list[np.ndarray], starts: list[int]) -> list[np.ndarray]:
    """For each text, the step at which each character is first emitted, and the step after its end."""
    sizes = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-sizes, kind="stable")
    falling = -sizes[order]
    out = [np.empty(n + 1, np.int64) for n in sizes]
    step = np.array(starts, np.int64)[order]
    at = 0
    while (active := int(np.searchsorted(falling, -at, "left"))) >= FEW:
        block = np.zeros((active, BLOCK), np.int64)
        for d in range(active):
            part = codes[order[d]][at : at + BLOCK]
            block[d, : len(part)] = part
        block = np.ascontiguousarray(block.T) * PERIOD
        emitted = np.empty((BLOCK, active), np.int64)
        still = np.searchsorted(falling, -(at + np.arange(BLOCK)), "left")
        cell = np.empty(active, np.int64)
        for i, a in enumerate(still.tolist()):
            if not a:
                break
            now, c = step[:a], cell[:a]
            emitted[i, :a] = now
            np.bitwise_and(now, PERIOD - 1, out=c)
            c += block[i, :a]
            now += FLAT.take(c)
        emitted = np.ascontiguousarray(emitted.T)
        for d in range(active):
            n = min(BLOCK, sizes[order[d]] - at)
            out[order[d]][at : at + n] = emitted[d, :n]
        at += BLOCK
    for d in range(active):
        j, places = int(step[d]), []
        for c in codes[order[d]][at:].tolist():
            places.append(j)
            j += ROWS[c][j & 4095]
        out[order[d]][at : at + len(places)] = places
        step[d] = j
    for d, i in enumerate(order):
        out[i][-1] = step[d]
    return out


def digest(codes: np.ndarray, places: np.ndarray) -> str:
    """The fingerprint: a hex digit for every sampled step before the end of the walk; '' for an empty text."""
    samples = STEPS[: np.searchsorted(STEPS, places[-1], "left")]
    own = codes[np.searchsorted(places[:-1], samples, "right") - 1] if len(codes) else codes
    return DIGITS[own, np.arange(len(own)) & 15].tobytes().decode() if len(codes) else ""


def likeness(a: str, b: str) -> float:
    """Share of steps at which two walks emit the same character, corrected for chance; 0 to 1. Two empty texts: 1."""
    if a == b:
        return 1.0
    n, most = min(len(a), len(b)), max(len(a), len(b))
    if not n:
        return 0.0
    same = np.frombuffer(a.encode(), np.uint8)[:n] == np.frombuffer(b.encode(), np.uint8)[:n]
    agree = float(WEIGHT[:n][same].sum()) - WEIGHT_SO_FAR[n - 1] / 16
    return min(1.0, max(0.0, agree / (15 / 16) / WEIGHT_SO_FAR[most - 1]))


def fingerprints(texts: list[str]) -> list[str]:
    codes = [classes(t) for t in texts]
    return [digest(c, p) for c, p in zip(codes, walk(codes, [0] * len(codes)), strict=True)]


def band_shape(texts: int) -> tuple[int, int]:
    """Samples in a band and number of bands: few unlike texts of so many share one, and all but LOST of the near ones."""
    width = max(4, math.ceil(math.log(20 * max(1, texts)) / -math.log(CHANCE)))
    return width, math.ceil(math.log(LOST) / math.log(1 - AGREE**width))


@functools.lru_cache(64)
def _sites(octaves: int, width: int, bands: int) -> np.ndarray:
    return np.random.default_rng([5, octaves]).integers(0, PER_OCTAVE * octaves, (bands, width))


def band_keys(print_: np.ndarray, chars: int, width: int, bands: int) -> list[int | None]:
    """A key for each band of a fingerprint, over its full octaves and the SPAN of lengths that its text is in.

    A text just over an octave has keys over the octaves before as well, and one fewer than NEAR characters into a span
    over the span before: near texts differ by NEAR characters at most, so spans part none. Keys are in four runs, by
    whether octaves and span are even or odd, null where there are none.
    """
    octaves, span = len(print_) // PER_OCTAVE, chars // SPAN
    out: list[int | None] = [None] * (4 * bands)
    for k in [octaves, octaves - 1] if octaves > 1 and len(print_) % PER_OCTAVE < MARGIN else [octaves]:
        digits = print_[_sites(k, width, bands)]
        key = np.full(bands, k, np.uint64)
        for w in range(width):
            key = mix64(key ^ digits[:, w].astype(np.uint64), w)
        for s in [span, span - 1] if span and chars % SPAN < NEAR else [span]:
            at = (2 * (k % 2) + s % 2) * bands
            out[at : at + bands] = mix64(key ^ np.uint64(s), width).view(np.int64).tolist()
    return out


def sketch_bytes(codes: np.ndarray) -> bytes:
    """The number of characters, and how many pairs of neighbours are in each of 64 classes, modulo 16, two counts a byte: what a pair is asked before its texts."""
    c = codes.astype(np.uint32)
    many = np.bincount((c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77) >> np.uint32(26)).astype(np.int64), minlength=64) & 15
    return np.uint32(min(len(c), 2**32 - 1)).tobytes() + (many[::2] | many[1::2] << 4).astype(np.uint8).tobytes()


def agree(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Pairs of sketch_bytes that NEAR edits may have parted, and no others are near: an edit changes the length by 1 and the counts by 4 in all at most."""
    chars = [np.ascontiguousarray(x[:, :4]).view("<u4")[:, 0].astype(np.int64) for x in (one, two)]
    apart = np.zeros(len(one), np.int64)
    for shift in (0, 4):
        d = (one[:, 4:] >> shift) - (two[:, 4:] >> shift) & 15
        apart += np.minimum(d, 16 - d).sum(1, dtype=np.int64)
    return (np.abs(chars[0] - chars[1]) <= NEAR) & (apart <= 4 * NEAR)


def similar(a: pa.Array, b: pa.Array) -> np.ndarray:
    return np.array([edit_distance(x, y, NEAR) is not None for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], bool)


def _histogram(text: str) -> np.ndarray:
    """Counts of characters in 32 classes and of pairs of neighbours in 96: an edit changes the first by 2 at most in all, the second by 4."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ones = np.bincount((mix64(cp, 53) >> np.uint64(59)).astype(np.int64), minlength=32)
    twos = np.bincount((mix64(cp[1:] * np.uint64(0x110000) + cp[:-1], 54) % np.uint64(96)).astype(np.int64), minlength=96)
    return np.concatenate([ones, twos]).astype(np.int32)


def encoded(texts: pa.Array) -> list[bytes]:
    return [_histogram(t).tobytes() + t.encode("utf-8", "surrogatepass") for t in texts.to_pylist()]


def across(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within NEAR edits; counts rule out most others at once."""
    one, two = ([t[512:].decode("utf-8", "surrogatepass") for t in side] for side in (left, right))
    counts = [np.stack([np.frombuffer(t, np.int32, 128) for t in side]) for side in (left, right)]
    size = np.array([len(t) for t in two], np.int64)
    found: list[tuple[int, int]] = []
    for i, t in enumerate(one):
        apart = np.abs(counts[1] - counts[0][i])
        maybe = (np.abs(size - len(t)) <= NEAR) & (apart[:, :32].sum(1) <= 2 * NEAR) & (apart[:, 32:].sum(1) <= 4 * NEAR)
        found += [(i, j) for j in np.flatnonzero(maybe).tolist() if edit_distance(t, two[j], NEAR) is not None]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


MEASURE = Measure(agree, similar, encoded, across)


def near_texts(docs: DataFrame) -> DataFrame:
    """(id, h1, near_class) of the rows whose near_class is not their own id: the smallest doc_id that links reach.

    Links join equal texts, and texts of LEAST_SAMPLES samples or more that are within NEAR edits; a pair shares no band
    with a probability of about LOST. id and h1 tell rows apart as text_keys has them.
    """
    width, bands = band_shape(docs.count())

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [classes(t) for t in b.column(4).to_pylist()]
            prints = [np.frombuffer(digest(c, p).encode(), np.uint8) for c, p in zip(codes, walk(codes, [0] * len(codes)), strict=True)]
            keys = [band_keys(p, len(c), width, bands) if len(p) >= LEAST_SAMPLES else [] for c, p in zip(codes, prints, strict=True)]
            short = [sketch_bytes(c) for c in codes]
            size = [len(c) // 4 + 1 for c in codes]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary()), pa.array(size, pa.int32())], ["id", "h1", "h2", "pick", "bands", "short", "size"])

    signed, facts = classified(docs, F.lit(0).cast("long"), banded, MEASURE)
    out = join_spread(signed.select("id", "h1", "h2"), facts, ["h1", "h2"], ["class_id"], signed.count(), F.col("id"))
    return out.where("class_id <> id").select("id", "h1", F.col("class_id").alias("near_class"))


FIRST = -(2**63)  # stands for a null id, the last in descending order


def _places(rows: DataFrame) -> tuple[Callable[[DataFrame], DataFrame], int]:
    """A function that adds `bucket` to rows(id, h1), rising with (id, h1), and the number of buckets: about ROWS_PER_BUCKET rows each.

    Ranges of ids are found by quantiles of a fixed error, an id at a quantile is a range of its own, and ranges are
    evened out by their exact counts: by id, or by h1 where they hold one id. 2 * RANGES rows are gathered.
    """
    total = rows.count()
    quantiles = rows.select(F.col("id").cast("double").alias("x")).approxQuantile("x", [i / RANGES for i in range(1, RANGES)], 1 / (8 * RANGES)) if total else []
    ends = sorted({max(FIRST, min(2**63 - 1, int(q))) for q in quantiles})
    literal = lambda x, kind: F.from_json(F.lit(json.dumps(x)), f"array<{kind}>")
    cuts = literal(ends, "bigint")
    ranged = lambda df: df.withColumn("range", 2 * F.size(F.filter(cuts, lambda e: e < F.col("id"))) + F.array_contains(cuts, F.col("id")).cast("int"))
    known = {r["range"]: r for r in ranged(rows).groupBy("range").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()}
    share = max(ROWS_PER_BUCKET, total / MOST_BUCKETS)
    low, span, many, base = [], [], [], [0]
    for k in range(2 * len(ends) + 1):
        r = known.get(k)
        low.append(r["low"] if r else 0)
        span.append(r["high"] - low[-1] if r else 0)
        many.append(math.ceil(r["n"] / share) if r else 1)
        base.append(base[-1] + many[-1])
    wide = [float(x) for x in span]

    def placed(df: DataFrame) -> DataFrame:
        pick = lambda x, kind="double": F.element_at(literal(x, kind), F.col("range") + 1)
        above = F.when(pick(wide) < 2.0**62, (F.col("id") - pick(low, "bigint")).cast("double")).otherwise(F.col("id").cast("double") - pick(low, "bigint").cast("double"))
        by_id = above / (pick(wide) + 1)
        by_hash = (F.col("h1").cast("double") + 2.0**63) / 2.0**64
        part = F.when(pick(wide) > 0, by_id).otherwise(by_hash)
        within = F.least(F.greatest(F.floor(part * pick(many)), F.lit(0)), pick(many) - 1)
        return ranged(df).withColumn("bucket", (pick(base[:-1], "int") + within).cast("int")).drop("range")

    return placed, base[-1]


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, as the contract of op5 has it, and its near_class.

    A null text is empty. Null ids come last of all; rows with equal ids follow each other by a hash of the text. One row
    alone is its own next. Very long texts cost their length; an empty table gives no rows. near_class is the smallest
    doc_id that links of near_texts reach from the row, its own without any.
    """
    null_last = lambda c: F.when(c == LAST, F.lit(FIRST)).otherwise(c)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = near_texts(docs)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(F.lit(1), "text").alias("h1"), "text")
    placed, many = _places(rows.select("id", "h1"))
    tops = sorted((r["bucket"], *r["top"]) for r in placed(rows.select("id", "h1")).groupBy("bucket").agg(F.max(F.struct("id", "h1")).alias("top")).collect())  # MOST_BUCKETS rows and a few at most
    # the first row of a bucket is also the next of the last row of the bucket above it; the very first one, of the very last
    facts = [{"bucket": b, "top_id": i, "top_h": h, "above": tops[(k + 1) % len(tops)][0]} for k, (b, i, h) in enumerate(tops)]
    table = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(facts)), "array<struct<bucket:int,top_id:bigint,top_h:bigint,above:int>>")))
    place = lambda bucket, kind: F.struct(F.col(bucket).alias("bucket"), F.lit(kind).alias("kind"))
    top = (F.col("id") == F.col("top_id")) & (F.col("h1") == F.col("top_h"))
    dealt = placed(rows).join(F.broadcast(table), "bucket").withColumn("to", F.explode(F.when(top, F.array(place("bucket", 1), place("above", 2))).otherwise(F.array(place("bucket", 1)))))
    dealt = dealt.select("to.bucket", "to.kind", "id", "h1", F.lit(None).cast("long").alias("near_class"), "text")
    marks = placed(near.select(null_last(F.col("id")).alias("id"), "h1", "near_class")).select("bucket", F.lit(0).alias("kind"), "id", "h1", "near_class")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts travel compressed."""
        for b in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in b.column(5).to_pylist()]
            z = [pa.compress(t, "zstd", asbytes=True) if t else b"" for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(z, pa.binary()), pa.array([len(t) for t in texts], pa.int64())], ["bucket", "kind", "id", "h1", "near_class", "z", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (id, text, bucket, extra, near_class), rows still without their next
        known, now = {}, None
        for b in batches:
            for bucket, kind, id_, h1, near_class, z, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != now:
                    known, now = {}, bucket
                if kind == 0:
                    known[id_, h1] = near_class
                else:
                    text = pa.decompress(z, size, "zstd", asbytes=True).decode("utf-8", "surrogatepass") if size else ""
                    held.append((id_ if id_ > FIRST else None, text, bucket, kind == 2, known.get((id_, h1), id_ if id_ > FIRST else None)))
            if held:
                yield batch_of(held)
                held = held[-1:]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[1] for r in rows]
        codes = [classes(t) for t in texts]
        places = walk(codes, [0] * len(rows))
        prints = [digest(c, p) for c, p in zip(codes, places, strict=True)]
        todo = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
        cut, tails = {}, []
        for i in todo:
            k = len(texts[i]) // 3
            cut[i] = len(texts[i]) - k
            tails.append(codes[i + 1][:k])
        walked = walk(tails, [int(places[i][cut[i]]) for i in todo])
        out = []
        for i, tail, more in zip(todo, tails, walked, strict=True):
            edited = texts[i][: cut[i]] + texts[i + 1][: len(texts[i]) - cut[i]]
            own = digest(np.concatenate([codes[i][: cut[i]], tail]), np.concatenate([places[i][: cut[i]], more]))
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((rows[i][0], len(texts[i]), sha, prints[i], own, likeness(prints[i], own), likeness(prints[i], prints[i + 1]), rows[i][4]))
        cols = list(zip(*out, strict=True)) or [()] * 8
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_class"])

    order = ["bucket", "kind", F.col("id").desc(), F.col("h1").desc()]
    sent = dealt.mapInArrow(lean(packed), "bucket int, kind int, id long, h1 long, near_class long, z binary, bytes long")
    both = sent.unionByName(marks.withColumn("z", F.lit(None).cast("binary")).withColumn("bytes", F.lit(0).cast("long")))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, near_class long"
    return both.repartition(max(1, many), "bucket").sortWithinPartitions(*order).mapInArrow(lean(run), schema)


def common_start(a: str, i: int, b: str, j: int) -> int:
    """Length of what a from i on and b from j on begin with in common; compares slices, which double and then halve."""
    most, at, step, growing = min(len(a) - i, len(b) - j), 0, 16, True
    while at < most:
        n = min(step, most - at)
        if a[i + at : i + at + n] == b[j + at : j + at + n]:
            at += n
            step = 2 * step if growing else max(1, step // 2)
        elif n == 1:
            break
        else:
            step, growing = max(1, n // 2), False
    return max(at, 0)


def edit_distance(a: str, b: str, most: int) -> int | None:
    """Levenshtein distance if it is at most `most`, by furthest-reaching diagonals."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None

    def slide(i: int, k: int) -> int:
        return i + common_start(a, i, b, i + k)

    reach = {0: slide(0, 0)}
    for d in range(most + 1):
        if reach.get(m - n, -1) >= n:
            return d
        nxt = {}
        for k in range(-d - 1, d + 2):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            if i >= 0 and i <= n and 0 <= i + k <= m + 1:
                nxt[k] = slide(min(i, n, m - k), k)
        reach = nxt
    return None


def segments(n: int, most: int) -> list[tuple[int, int, int]]:
    """(number, start, size) of most + 1 even parts of n characters; of a text with fewer characters, one empty part alone."""
    if n <= most:
        return [(0, 0, 0)]
    size, longer = divmod(n, most + 1)
    plain = most + 1 - longer
    return [(i, i * size + max(0, i - plain), size + (i >= plain)) for i in range(most + 1)]


def window(number: int, start: int, shift: int, most: int) -> tuple[int, int]:
    """First and last place at which a text longer by `shift` can hold this part, if the two are within `most` edits and this is the first part to match."""
    return max(0, start - number, start + shift - (most - number)), min(start + number, start + shift + (most - number))


def part_keys(text: str, most: int) -> Iterator[tuple[int, int, bool]]:
    """(key, number of the part, own): own parts, and places of the text that could be parts of a text as long or shorter. Each once."""
    n, seen = len(text), set()
    for m in range(max(0, n - most), n + 1):
        for i, start, size in segments(m, most):
            lo, hi = window(i, start, n - m, most) if size else (0, 0)
            for at in range(lo, min(hi, n - size) + 1):
                key = xxhash.xxh3_64_intdigest(f"{m} {i} {text[at : at + size]}".encode("utf-8", "surrogatepass")) - (1 << 63)
                if key not in seen:
                    seen.add(key)
                    yield key, i, False
    for i, start, size in segments(n, most):
        yield xxhash.xxh3_64_intdigest(f"{n} {i} {text[start : start + size]}".encode("utf-8", "surrogatepass")) - (1 << 63), i, True


def first_match(a: str, b: str, most: int) -> int | None:
    """Number of the first part of a that b, as long or longer, holds at a place where it could be."""
    for i, start, size in segments(len(a), most):
        lo, hi = window(i, start, len(b) - len(a), most) if size else (0, 0)
        if lo <= hi and b.find(a[start : start + size], lo, hi + size) >= 0:
            return i
    return None


def near_pairs(docs: DataFrame, most: int = 8) -> DataFrame:
    """(doc_id, near_id, distance): every document with every text of a smaller id at an edit distance of 1 to `most`; near_id is that text's smallest id.

    No pair is lost: a text within `most` edits of another holds one of its most + 1 parts unchanged and within `most`
    places of its own, so parts are buckets. A bucket's members are compared in blocks, a task for each pair of blocks,
    and a pair is compared only in the bucket of its first common part, so candidates are never rows. Null ids, null and
    empty texts give no pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(t, *k) for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k in part_keys(text, most)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.int32(), pa.bool_()), strict=True)], ["t", "key", "number", "own"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, number, i, j), those of own parts first."""
        now, held = None, []
        for b in batches:
            found = []
            for *key, own, t, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != now:
                    now, held = key, []
                if own:
                    held.append((t, text))
                    continue
                for u, part in held:
                    if (len(part), u) < (len(text), t) and len(text) - len(part) <= most and first_match(part, text, most) == key[1] and (d := edit_distance(part, text, most)) is not None:
                        found.append((u, t, d))
            cols = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.binary(), pa.int32()), strict=True)], ["a", "b", "distance"])

    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text <> ''")
    texts = texts.withColumn("t", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    owners = saved(texts.select("doc_id", "t").distinct(), "edit-owners")
    once = saved(texts.groupBy("t").agg(F.first("text").alias("text")), "edit-texts")
    keys = saved(once.select("t", "text").mapInArrow(lean(run), "t binary, key long, number int, own boolean"), "edit-parts")
    count = keys.groupBy("key", "number").agg(F.sum(F.col("own").cast("long")).alias("n_own"), F.sum((~F.col("own")).cast("long")).alias("n_other"))
    blocks = lambda n: F.ceil(F.col(n) / PAIR_BLOCK).cast("int")
    full = count.where("n_own >= 1 and n_other >= 2").select("key", "number", blocks("n_own").alias("ni"), blocks("n_other").alias("nj"))
    spread = lambda n: F.pmod(F.xxhash64("t"), F.col(n)).cast("int")
    rows = keys.join(full, ["key", "number"]).withColumn("with", F.explode(F.sequence(F.lit(0), F.when(F.col("own"), F.col("nj")).otherwise(F.col("ni")) - 1)))
    rows = rows.withColumn("i", F.when(F.col("own"), spread("ni")).otherwise(F.col("with"))).withColumn("j", F.when(F.col("own"), F.col("with")).otherwise(spread("nj")))
    met = rows.join(once, "t").select("key", "number", "i", "j", "own", "t", "text")
    met = met.repartition("key", "number", "i", "j").sortWithinPartitions("key", "number", "i", "j", F.col("own").desc())
    links = saved(met.mapInArrow(lean(verify), "a binary, b binary, distance int"), "edit-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    firsts = owners.groupBy(F.col("t").alias("b")).agg(F.min("doc_id").alias("near_id"))
    return both.join(firsts, "b").join(owners.withColumnRenamed("t", "a"), "a").where("doc_id > near_id").select("doc_id", "near_id", "distance")
