"""Operator 3: a quality classifier, a generalised additive model with pairwise interactions.

Features of whole texts are binned at quantiles of the training sample. Boosting goes round the features in cycles; each
step adds a shallow tree (three leaves at most) of one feature to that feature's lookup table. Afterwards the pairs of
features with the largest gain on the residuals get two-dimensional tables the same way (trees of four leaves). A score
is the logistic of an intercept and a sum of table entries: additions over bins, vectorised.

Only the sample of labelled rows (TRAIN_ROWS at most, by hash order) is gathered on the driver; features and scores of
all documents are computed where the documents are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import Words, boxed, kept, lean, own, returned, unboxed

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, CYCLES, PAIRS, PAIR_CYCLES, RATE, LEAST_LEAF = 32, 8, 120, 10, 60, 0.15, 2
THRESHOLD = 0.3
FEATURES = (
    "log_words", "log_chars", "mean_word", "sd_word", "upper", "capital", "symbol_end", "symbol_only", "plain", "digit",
    "distinct", "repeat_next", "top_word", "distinct_pairs", "short", "log_lines", "words_per_line", "stop_end", "symbol_chars", "half_repeat",
)


def word_facts(words: list[str]) -> np.ndarray:
    """Per distinct word: length, upper, capital, ends in a symbol, symbols only, letters only (but for a final mark), digit, full stop, symbols."""
    out = np.zeros((len(words), 9))
    for i, w in enumerate(words):
        body = w.rstrip(".,;:!?")
        letters = body.isalpha()
        out[i, 0] = len(w)
        if letters:
            out[i, 1] = body.isupper() and len(body) > 1
            out[i, 2] = body[0].isupper()
            out[i, 5] = 1
            out[i, 8] = max(0, len(w) - len(body) - 1)
        else:
            marks = sum(not c.isalnum() for c in body)
            out[i, 3] = bool(body) and not body[-1].isalnum()
            out[i, 4] = marks == len(body)
            out[i, 6] = any(c.isdigit() for c in body)
            out[i, 8] = marks + max(0, len(w) - len(body) - 1)
        out[i, 7] = w[-1] in ".!?"
    return out


def features(texts: pa.Array) -> np.ndarray:
    """One row per text, in the order of FEATURES. A null or empty text has zeros."""
    words = Words(texts)
    n, starts, codes = words.counts, words.starts, words.codes
    facts = word_facts(words.distinct.to_pylist())
    out = np.zeros((len(n), len(FEATURES)))
    have = np.flatnonzero(n)
    if not len(have):
        return out
    owner = np.repeat(np.arange(len(n)), n)
    size = np.maximum(n, 1)
    total = lambda v: np.bincount(owner, v, len(n))
    each = facts[codes]
    mean = {j: total(each[:, j]) / size for j in range(9)}
    chars = np.maximum(mean[0] * n, 1)
    space = len(words.distinct) + 1

    def spread(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and the largest count of one key, by text."""
        distinct, many = np.unique(owners.astype(np.int64) * space * space + keys, return_counts=True)
        who = distinct // (space * space)
        most = np.zeros(len(n), np.int64)
        np.maximum.at(most, who, many)
        return np.bincount(who, minlength=len(n)), most

    kinds, most = spread(codes, owner)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    pair_kinds, _ = spread(codes[inner] * space + codes[inner + 1], owner[inner]) if len(inner) else (np.zeros(len(n)), None)
    same = np.bincount(owner[inner], codes[inner] == codes[inner + 1], len(n)) if len(inner) else np.zeros(len(n))
    place = np.arange(len(codes)) - starts[:-1][owner]
    late = place >= (n // 2)[owner]
    seen = np.unique(owner[~late] * space + codes[~late])
    half = np.bincount(owner[late], np.isin(owner[late] * space + codes[late], seen) & (each[late, 0] > 4), len(n))
    long_late = np.bincount(owner[late], each[late, 0] > 4, len(n))
    lines = pc.add(pc.count_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n"), 1).to_numpy(zero_copy_only=False)
    cols = (
        np.log1p(n), np.log1p(chars), mean[0], np.sqrt(np.maximum(0, total(each[:, 0] ** 2) / size - mean[0] ** 2)), mean[1], mean[2], mean[3], mean[4], mean[5], mean[6],
        kinds / size, same / size, most / size, pair_kinds / np.maximum(1, n - 1), total(each[:, 0] <= 3) / size, np.log1p(lines), np.log1p(n / lines), mean[7], mean[8] * n / chars, half / np.maximum(1, long_late),
    )
    out[have] = np.stack(cols, 1)[have]
    return out


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = features(b.column(1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "x"])


@dataclass
class Model:
    """Lookup tables: of a fixed size, whatever it was trained on."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    intercept: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (c, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += t[np.searchsorted(c, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[coarse[a], coarse[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Best gain over a line of bins, and how many bins go left (0: no split)."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return 0.0, 0
    gs, hs = g.sum(), h.sum()
    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
    gain = np.where((nl >= LEAST_LEAF) & (n.sum() - nl >= LEAST_LEAF), gain, -1)
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(np.clip(g.sum() / (h.sum() + 1), -4, 4))


def _line_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of three leaves at most over bins in order."""
    out = np.zeros(len(g))
    parts = [(0, len(g))]
    for _ in range(2):
        best = max(((*_split(g[a:b], h[a:b], n[a:b]), a, b) for a, b in parts), key=lambda s: s[0])
        if not best[1]:
            break
        _, left, a, b = best
        parts.remove((a, b))
        parts += [(a, a + left), (a + left, b)]
    for a, b in parts:
        out[a:b] = _leaf(g[a:b], h[a:b])
    return out


def _square_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """A split along one axis, then one along the other in each half; its gain and its table."""
    best = (-1.0, np.zeros_like(g))
    for turn in (False, True):
        a, b, c = (m.T if turn else m for m in (g, h, n))
        for cut in range(1, a.shape[0]):
            out, gain = np.zeros_like(a), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                x, y, z = a[rows].sum(0), b[rows].sum(0), c[rows].sum(0)
                _, left = _split(x, y, z)
                for cols in (slice(0, left), slice(left, None)) if left else (slice(None),):
                    out[rows, cols] = _leaf(x[cols], y[cols])
                    gain += x[cols].sum() ** 2 / (y[cols].sum() + 1)
            if gain > best[0]:
                best = (gain, out.T.copy() if turn else out)
    return best


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Fits the tables to labels 0 and 1. Without rows or with one class alone it predicts that share everywhere."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model([_cuts(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(len(FEATURES))], [], [_cuts(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(len(FEATURES))], [], [], float(np.log(share / (1 - share))))
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    raw = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(CYCLES):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _line_tree(np.bincount(b, g, len(sizes[j])), np.bincount(b, h, len(sizes[j])), sizes[j])
            model.tables[j] += step
            raw += step[b]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.pair_cuts)]
    wide = [len(c) + 1 for c in model.pair_cuts]

    def square(a: int, b: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        k, shape = coarse[a] * wide[b] + coarse[b], (wide[a], wide[b])
        return _square_tree(*(np.bincount(k, v, shape[0] * shape[1]).reshape(shape) for v in (g, h, np.ones(len(y)))))

    ranked = sorted(((-square(a, b)[0], a, b) for a in range(len(wide)) for b in range(a) if wide[a] > 1 and wide[b] > 1))
    model.pairs = [(a, b) for _, a, b in ranked[:PAIRS]]
    model.pair_tables = [np.zeros((wide[a], wide[b])) for a, b in model.pairs]
    for _ in range(PAIR_CYCLES):
        for i, (a, b) in enumerate(model.pairs):
            step = RATE * square(a, b)[1]
            model.pair_tables[i] += step
            raw += step[coarse[a], coarse[b]]
    return model


def held_out():
    """Rows whose labels are never learned from. A row without an id has no label to learn, and is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, train_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of train_rows documents at most, the first by hash of those that may be learned from."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("y"))
    many = known.count()
    h = F.xxhash64(F.lit(3), "doc_id")
    if many > train_rows:  # a slice of the hash range that holds a little more than the sample, so that few rows are gathered for it
        known = known.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * train_rows / many + 1e-6)))
    sample = known.orderBy(F.pmod(h, F.lit(1 << 30)), "doc_id").limit(train_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # train_rows bounds the broadcast
    made = rows.select("doc_id", "text").mapInArrow(lean(_feature_lists), "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x"))
    got = sorted((r["doc_id"], r["x"], r["y"]) for r in made.join(F.broadcast(sample), "doc_id").collect())
    return np.array([r[1] for r in got]).reshape(-1, len(FEATURES)), np.array([r[2] for r in got], float)


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, keep: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in keep) with score (double, 0 to 1) and predicted (int), for every row; input columns of these names, in any case, are replaced.

    labels(doc_id, quality): null ids or labels teach nothing, and of several labels of one document the smallest
    counts. Null and empty texts are scored like any other, very long ones as a whole; repeated rows get equal scores.
    Documents without labels at all: the score is 0.5. An empty table gives no rows. A row's score depends on its text
    alone; nothing is exchanged but the sample.
    """
    keep = [c for c in keep or docs.columns if c in kept(docs, "score", "predicted")]
    at = keep.index("text") if "text" in keep else None
    rows = docs.select(boxed(keep), *([own("text").alias("text")] if at is None else []))
    model = docs.sparkSession.sparkContext.broadcast(train(*labelled_sample(docs, labels, train_rows)))  # lookup tables of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.value.score(features(b.column(1) if at is None else b.column(0).field(at)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["row__", "score", "predicted"])

    out = rows.mapInArrow(lean(run), returned(rows.select("row__"), "score double", "predicted int"))
    return out.select(*unboxed(keep), "score", "predicted")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each document with its score, as classify has it."""
    out = classify(docs, labels, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
