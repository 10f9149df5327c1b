"""Operator 8: substring dedup by super-k-mer partitioning, on words.

A window is WINDOW consecutive words; its minimiser is the run of GRAM words in it with the smallest hash, the leftmost of
equals. Consecutive windows with the same minimiser at the same place are a super-k-mer: one string of words that holds them all. Equal windows have equal
minimisers, so all of them meet in the minimiser's bucket.

1. From each text only (minimiser, document, start, windows) goes out. Minimisers that occur once cannot have repeated
   windows; counts (combined before the exchange) leave the others.
2. Those super-k-mers travel as packed strings to their buckets, sorted by minimiser, document and start. A bucket is
   streamed: the first place of each distinct window is remembered, later ones are repeats. Memory holds the distinct
   windows of one minimiser, however many documents repeat them.
   A minimiser of very many super-k-mers (HOT_ROWS, MOST_HOT, MOST_ROWS) has no bucket: its windows go out one by one, as
   two 64-bit hashes, dealt by window and one of SALTS parts of the documents. All but the first of a part are repeats.
3. The firsts of all parts of a window meet (SALTS at most): all but the first of them are repeats too.
4. Repeats go back to their documents as spans of words.

Exact copies of a whole text are found first by a hash of the text and take no part in 2: all their windows are
repeats, so all their words go if they have a window at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import HOT_ROWS, MOST_HOT, Words, boxed, gram_hashes, join_spread, kept, lean, mix64, returned, saved, unboxed

WINDOW, GRAM = 20, 4
LAST = 2**63 - 1  # stands for a null id
#: A bucket holds MOST_ROWS super-k-mers at most; less where that is a larger share than 1 / MOST_HOT of all.
MOST_ROWS, SALTS = 1 << 14, 1024
AT_ONCE = 1 << 17  # windows of a batch: a very long text sends several


def super_kmers(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, minimiser, first word and number of windows of each super-k-mer of a batch."""
    grams = gram_hashes(words.hashes(), GRAM)
    span = WINDOW - GRAM + 1
    at, have = np.arange(len(grams)), 1  # place of the smallest gram, the leftmost of equals, in spans that double

    def either(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[left] <= grams[right], left, right)

    while have * 2 <= span:
        at = either(at[:-have], at[have:]) if len(at) > have else at[:0]
        have *= 2
    at = either(at[: have - span], at[span - have :]) if len(at) > span - have > 0 else at  # two spans that overlap
    many = np.maximum(0, words.counts - WINDOW + 1)
    owner = np.repeat(np.arange(len(many)), many)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    own = at[words.starts[:-1][owner] + start] if len(owner) else at[:0]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], grams[own[first]].view(np.int64), start[first].astype(np.int32), np.diff(np.append(first, len(own))).astype(np.int32)


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's minimisers, with how often it has them: a text that goes round in circles sends a row, not one for each turn."""
    for b in batches:
        owner, low, _, _ = super_kmers(Words(b.column(1)))
        order = np.lexsort((low, owner))
        owner, low = owner[order], low[order]
        first = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1]))) if len(low) else order
        many = np.diff(np.append(first, len(low)))
        yield pa.RecordBatch.from_arrays([pa.array(low[first]), b.column(0).take(pa.array(owner[first])), pa.array(many, pa.int32())], ["low", "k", "n"])


def joined(owner: np.ndarray, low: np.ndarray, start: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers that follow each other with the same minimiser, at whatever place, as one: they go to one bucket anyway."""
    new = np.ones(len(low), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (low[1:] != low[:-1]) | (start[1:] != start[:-1] + many[:-1])
    first = np.flatnonzero(new)
    return owner[first], low[first], start[first], np.add.reduceat(many, first) if len(first) else many


def window_hashes(words: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the WINDOW words from each of those places on."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW):
            out = mix64(out * np.uint64(0x100000001B3) + words[at + i], salt)
    return out


PACKED = "key long, w1 long, w2 long, id long, k long, start int, packed string"


def _packed(batches: Iterator[pa.RecordBatch], salts: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, k, text, lows) to their wanted super-k-mers: packed strings by minimiser, or windows where that is hot."""
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.string()]
    names = [c.split(" ")[0] for c in PACKED.split(", ")]
    for b in batches:
        words = Words(b.column(2))
        owner, low, start, many = joined(*super_kmers(words))
        lists = b.column(3)
        flat = lists.flatten()
        lows, hot = flat.field(0).to_numpy(), flat.field(1).to_numpy(zero_copy_only=False).astype(bool)
        wanted = np.split(lows, np.cumsum(np.diff(lists.offsets.to_numpy()))[:-1])
        ends = np.searchsorted(owner, np.arange(len(b) + 1))
        pick = np.flatnonzero(np.concatenate([np.isin(low[x:y], w) for x, y, w in zip(ends, ends[1:], wanted, strict=False)])) if len(b) else owner
        single = np.isin(low[pick], lows[hot])
        apart, pick = pick[single], pick[~single]
        distinct = words.distinct.to_pylist()
        texts = []
        for i in pick.tolist():
            a = int(words.starts[owner[i]]) + int(start[i])
            texts.append(" ".join([distinct[c] for c in words.codes[a : a + int(many[i]) + WINDOW - 1].tolist()]))
        at, nothing = pa.array(owner[pick]), pa.nulls(len(pick), pa.int64())
        cols = [pa.array(low[pick]), nothing, nothing, b.column(0).take(at), b.column(1).take(at), pa.array(start[pick]), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(cols, kinds, strict=True)], names)
        if len(apart):
            count = many[apart]
            place = np.repeat(start[apart] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            text = np.repeat(owner[apart], count)
            hashes = words.hashes()
            for lo in range(0, len(text), at_once):
                t, p = text[lo : lo + at_once], place[lo : lo + at_once]
                w1, w2 = (window_hashes(hashes, words.starts[t] + p, salt) for salt in (0, 1))
                at = pa.array(t)
                k = b.column(1).take(at)
                key = mix64(w1 + (k.to_numpy().view(np.uint64) % np.uint64(salts)), 2)
                own = [pa.array(x.view(np.int64)) for x in (key, w1, w2)]
                cols = [*own, b.column(0).take(at), k, pa.array(p), pa.nulls(len(t), pa.string())]
                yield pa.RecordBatch.from_arrays([c.cast(kind) for c, kind in zip(cols, kinds, strict=True)], names)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of words under windows that are not the first of their kind; rows come sorted by all columns but the last.

    The first of a window that came alone is returned with its hashes: other parts may hold an earlier one.
    """
    now, seen, first = None, {}, None
    for b in batches:
        out: list[tuple] = []
        for key, w1, w2, id_, k, start, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
            fresh = (key, w1, w2) != now
            if fresh:
                now, seen, first = (key, w1, w2), {}, (id_, k, start)
            if packed is None:
                if fresh:
                    out.append((id_, k, start, start + WINDOW, w1, w2))
                elif first != (id_, k, start):
                    out.append((id_, k, start, start + WINDOW, None, None))
                continue
            ends = list(accumulate((len(w) + 1 for w in packed.split(" ")), initial=0))
            begin = None
            for i in range(len(ends) - WINDOW):
                place = (id_, k, start + i)
                repeat = seen.setdefault(packed[ends[i] : ends[i + WINDOW] - 1], place) != place
                if repeat and begin is None:
                    begin = start + i
                elif not repeat and begin is not None:
                    out.append((id_, k, begin, start + i - 1 + WINDOW, None, None))
                    begin = None
            if begin is not None:
                out.append((id_, k, begin, start + len(ends) - WINDOW - 1 + WINDOW, None, None))
        cols = list(zip(*out, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["id", "k", "from", "to", "w1", "w2"])


def marked(texts: DataFrame) -> DataFrame:
    """texts(id, k, text) to (mid, mk, spans, copy): what to cut from each text, for those with something to cut.

    k is a hash of id and text. copy: a smaller id holds the same text. Rows with one id and different texts are
    different documents in the order of k.
    """
    full = texts.select("id", "k", F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    first = full.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).where("first < last")
    first = saved(first, "texts")
    total = first.agg(F.sum("n")).first()[0] or 0
    copies = join_spread(full, first, ["h1", "h2"], ["first"], total, F.col("k")).where("id > first")
    copies = saved(copies.select("id", "k").distinct(), "copies")
    thin = saved(texts.select("k", "text").mapInArrow(lean(_thin), "low long, k long, n int"), "super-kmers")
    total = thin.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, min(MOST_ROWS, total // MOST_HOT))
    more = thin.groupBy("low").agg(F.sum("n").alias("n")).where("n > 1").select("low", (F.col("n") > most).alias("hot"))
    # a clash of two documents' k only lets superfluous super-k-mers travel
    wanted = thin.select("low", "k").join(more, "low").join(copies.select("k"), "k", "left_anti")
    wanted = wanted.groupBy("k").agg(F.collect_list(F.struct("low", "hot")).alias("lows"))
    packed = texts.join(wanted.hint("shuffle_hash"), "k").select("id", "k", "text", "lows")
    packed = packed.mapInArrow(lean(partial(_packed, salts=SALTS, at_once=AT_ONCE)), PACKED)
    spans = packed.repartition("key").sortWithinPartitions("key", "w1", "w2", "id", "k", "start")
    spans = spans.mapInArrow(lean(_repeats), "id long, k long, from int, to int, w1 long, w2 long")
    settled = F.col("w1").isNull()
    meet = Window.partitionBy("w1", "w2", F.when(settled, F.xxhash64("id", "k", "from"))).orderBy("id", "k", "from")
    spans = spans.withColumn("place", F.rank().over(meet)).where(settled | (F.col("place") > 1))
    spans = spans.groupBy("id", "k").agg(F.collect_list(F.struct("from", "to")).alias("spans")).withColumn("copy", F.lit(False))
    both = spans.unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True)
    return both.select(F.col("id").alias("mid"), F.col("k").alias("mk"), "spans", "copy")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(id, k, text) and more columns of docs."""
    own = F.coalesce("text", F.lit(""))
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select(id_.alias("id"), F.xxhash64(id_, own).alias("k"), own.alias("text"), *more)


def _with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Joins on k alone, so that rows keep the partitioning they were exchanged by before."""
    return rows.join(marks.hint("shuffle_hash"), (rows["k"] == marks["mk"]) & (rows["id"] <= marks["mid"]) & (rows["id"] >= marks["mid"]), "left")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Adds n_words, n_removed and kept_text (words joined by one space) to every row; input columns of these names, in any case, are replaced.

    A word goes if a window over it also starts in a smaller doc_id, or earlier in its own document. A null or empty
    text has no words. A null id comes after all others. Rows alike in id and text are the same document, whose words
    stay in each; very long texts cost their length; an empty table gives no rows.
    """
    keep = kept(docs, "n_words", "n_removed", "kept_text")
    rows = docs.select(boxed(keep), "doc_id", "text")
    both = _with_marks(keyed(rows, "row__"), marked(keyed(docs))).select("row__", "spans", "copy", "text")
    return _cut(both).select(*unboxed(keep), "n_words", "n_removed", "kept_text")


def _cut(both: DataFrame) -> DataFrame:
    """both: a column to be kept, then spans, copy and the text."""
    name = both.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b.column(3))
            distinct = words.distinct.to_pylist()
            gone, texts = [], []
            for i, (spans, copy) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                codes = words.codes[words.starts[i] : words.starts[i + 1]]
                size = len(codes)
                if copy and size >= WINDOW:
                    codes = codes[:0]
                elif spans:
                    edge = np.zeros(size + 1, np.int64)
                    for s in spans:
                        edge[s["from"]] += 1
                        edge[s["to"]] -= 1
                    codes = codes[np.cumsum(edge[:-1]) == 0]
                gone.append(size - len(codes))
                texts.append(" ".join([distinct[c] for c in codes.tolist()]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words.counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())], [name, "n_words", "n_removed", "kept_text"])

    return both.mapInArrow(lean(run), returned(both.select(name), "n_words long", "n_removed long", "kept_text string"))


def substring_digest(docs: DataFrame) -> DataFrame:
    """The digest of remove_repeats, whose cases hold. Texts are exchanged once, for both joins by document."""
    texts = keyed(docs)
    both = _with_marks(texts, marked(texts)).select(F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"), "spans", "copy", "text")
    return _cut(both).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d WHERE len(w) >= 20),
x AS (SELECT doc_id, pos, min({'d': doc_id, 'p': pos}) OVER (PARTITION BY array_to_string(w[pos:pos + 19], ' ')) AS f FROM p),
r AS (SELECT DISTINCT doc_id, pos + o AS pos FROM x, range(0, 20) AS t(o) WHERE f.d <> doc_id OR f.p <> pos),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
g AS (SELECT e.doc_id, count(*) AS n_words, count(r.pos) AS n_removed, string_agg(word, ' ' ORDER BY e.pos) FILTER (r.pos IS NULL) AS kept FROM e LEFT JOIN r USING (doc_id, pos) GROUP BY 1)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g USING (doc_id)
"""
