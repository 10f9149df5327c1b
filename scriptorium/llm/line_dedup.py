"""Operator 6: line dedup by sharded cuckoo filters that exact reference-count tables back.

A line's key is the line stripped of blanks at both ends, with A-Z lower-cased; keys of at least LEAST code points
count. State, all of it in written tables:

- postings(doc_id, k, shard, key): one row per row of the input and key, the ground truth that makes deletions possible;
- counts(shard, key, refs, first_doc, last_doc): the exact reference counts of all keys;
- filters(shard, filter): a cuckoo filter per shard over the keys that two documents or more share.

A line is tried against its shard's filter, a few bytes a key, and only hits go to the exact table. Lines that a large
share of all documents hold are looked up directly, where they are. Adding documents adds to the counts of their keys
and inserts those that come to be shared; deleting documents counts the keys that they held again and removes those
that are not shared any more, so lines that were dropped for their sake come back. Only filters of shards that change
are touched; one without room is built again from the exact counts, and the shards become more as keys do.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import BLANKS, HOT_ROWS, MOST_HOT, boxed, kept, lean, returned, saved, unboxed
from scriptorium.llm.cuckoo import CuckooFilter

LEAST = 10
KEYS_PER_SHARD, LEAST_SHARDS = 200_000, 32
SALTS = 4  # a shard's lines are tried in so many tasks, each with a copy of the filter
LAST = 2**63 - 1  # stands for a null id
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def line_key(line: str) -> bytes | None:
    """16 bytes that stand for the line's key, or None for one that is too short to count."""
    key = line.strip(BLANKS).translate(LOWER)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")) if len(key) >= LEAST else None


def known_id(doc_id: str = "doc_id"):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def row_key():
    """Tells a row apart by id and text; the text alone does where ids are null."""
    return F.xxhash64(known_id(), F.coalesce("text", F.lit("")))


def postings(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, k, shard, key), once for each row and key; a null id is LAST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, own_, keys = [], [], []
            for i, k, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = {x for line in (text or "").split("\n") if (x := line_key(line))}
                ids += [i] * len(found)
                own_ += [k] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own_, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "k", "key"])

    rows = docs.select(known_id().alias("doc_id"), row_key().alias("k"), "text").mapInArrow(lean(run), "doc_id long, k long, key binary")
    return rows.select("doc_id", "k", in_shard(shards), "key")


def in_shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def reference_counts(posts: DataFrame) -> DataFrame:
    """Exact counts of every key. Null ids are one document, after all others in order; rows with one id are one document."""
    return posts.groupBy("shard", "key").agg(F.count("*").alias("refs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


SHARED = "first_doc < last_doc"  # two documents or more hold the key


def build_filters(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, filter) over the shared keys of counts; a task holds the keys of one shard, KEYS_PER_SHARD or so of 16 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[int, list[bytes]] = {}
        for b in batches:
            for s, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys.setdefault(s, []).append(k)
            for s in list(keys)[:-1]:  # rows come sorted by shard
                yield one(s, keys.pop(s))
        for s in keys:
            yield one(s, keys[s])

    def one(shard: int, keys: list[bytes]) -> pa.RecordBatch:
        made = CuckooFilter(len(keys))
        made.insert(np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2))
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([made.to_bytes()], pa.binary())], ["shard", "filter"])

    rows = counts.where(SHARED).select("shard", "key").repartition(shards, "shard").sortWithinPartitions("shard")
    return rows.mapInArrow(lean(run), "shard int, filter binary")


def filter_hits(posts: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Postings that their shard's filter lets pass. Filters go ahead of the lines they judge, as rows of the same exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            shard = b.column(0).to_numpy()
            for lo, hi in zip(cuts := [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist()], [*cuts[1:], len(shard)], strict=True):
                part = b.slice(lo, hi - lo)
                if shard[lo] != now:
                    now, held = shard[lo], None
                blobs = part.column(4)
                if blobs.null_count < len(part):
                    held = CuckooFilter.from_bytes(blobs.drop_null()[0].as_py())
                lines = part.filter(blobs.is_null())
                if held is not None and len(lines):
                    keys = np.frombuffer(b"".join(lines.column(3).to_pylist()), np.uint64).reshape(-1, 2)
                    yield lines.filter(pa.array(held.contains(keys))).select([1, 2, 0, 3])

    none = F.lit(None)
    lines = posts.select("shard", "doc_id", "k", "key", none.cast("binary").alias("filter"), F.pmod(F.xxhash64("k"), F.lit(SALTS)).cast("int").alias("salt"))
    copies = filters.select("shard", none.cast("long").alias("doc_id"), none.cast("long").alias("k"), none.cast("binary").alias("key"), "filter", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = copies.unionByName(lines).repartition(shards * SALTS, "shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())
    return both.select("shard", "doc_id", "k", "key", "filter").mapInArrow(lean(run), "doc_id long, k long, shard int, key binary")


def lost_lines(posts: DataFrame, counts: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """(doc_id, k, gone): the keys that each row loses, by an exact look at what passes the filters.

    Keys that more than one in MOST_HOT postings have are looked up at once, by a broadcast of MOST_HOT rows at most.
    """
    total = posts.count()
    shared = counts.where(SHARED).select("shard", "key", "first_doc", F.col("refs").alias("n"))
    hot = shared.where(F.col("n") > max(HOT_ROWS, total // MOST_HOT)).select("key", F.col("first_doc").alias("first"))
    both = posts.join(F.broadcast(hot), "key", "left")
    hits = filter_hits(both.where("first is null"), filters, shards)
    found = hits.join(shared.drop("n"), ["shard", "key"]).select("doc_id", "k", "key", "first_doc")
    found = found.unionByName(both.where("first is not null").select("doc_id", "k", "key", F.col("first").alias("first_doc")))
    return found.where("doc_id > first_doc").groupBy("doc_id", "k").agg(F.collect_set("key").alias("gone"))  # no more keys than the row has lines


def kept_lines(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text."""
    keep = kept(docs, "n_lines", "n_dropped", "kept_text")
    at = keep.index("text")
    rows = docs.select(boxed(keep), known_id().alias("doc_id"), row_key().alias("k"))
    both = rows.join(lost.hint("shuffle_hash"), ["doc_id", "k"], "left").select("row__", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts_, dropped, texts = [], [], []
            for text, drop in zip(b.column(0).field(at).to_pylist(), b.column(1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                if drop:
                    drop = set(drop)
                    left = [x for x in lines if line_key(x) not in drop]
                else:
                    left = lines
                counts_.append(len(lines))
                dropped.append(len(lines) - len(left))
                texts.append(text or "" if len(left) == len(lines) else "\n".join(left))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts_, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())], ["row__", "n_lines", "n_dropped", "kept_text"])

    out = both.mapInArrow(lean(run), returned(rows.select("row__"), "n_lines long", "n_dropped long", "kept_text string"))
    return out.select(*unboxed(keep), "n_lines", "n_dropped", "kept_text")


@dataclass
class LineState:
    """What has been taken in so far. Null ids are one document, after all others in order; so are rows that share an id."""

    postings: list[DataFrame]  # written tables, one for each insertion
    counts: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def of(cls, docs: DataFrame, shards: int | None = None) -> LineState:
        made = saved(postings(docs, 1), "line-postings")
        return cls._over([made], shards or max(LEAST_SHARDS, -(-made.count() // KEYS_PER_SHARD)))

    @classmethod
    def _over(cls, made: list[DataFrame], shards: int) -> LineState:
        """A state over written postings, dealt to so many shards."""
        made = [p.withColumn("shard", in_shard(shards)) for p in made]
        counts = saved(reference_counts(_all(made)), "line-counts")
        return cls(made, counts, saved(build_filters(counts, shards), "line-filters"), shards)

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs (all taken in before) without the lines that an earlier document holds."""
        return kept_lines(docs, lost_lines(_all(self.postings), self.counts, self.filters, self.shards))

    def insert(self, docs: DataFrame) -> LineState:
        """The state with more documents, of ids that it does not hold yet. Only their postings are exchanged, and the counts; nothing is exchanged for an empty table."""
        new = saved(postings(docs, self.shards), "line-postings")
        if not new.head(1):
            return self
        both = self.counts.unionByName(reference_counts(new)).groupBy("shard", "key")
        counts = saved(both.agg(F.sum("refs").alias("refs"), F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")), "line-counts")
        made = [*self.postings, new]
        if counts.count() > 2 * KEYS_PER_SHARD * self.shards:
            return self._over(made, 2 * self.shards)
        return self._changed(made, counts)

    def delete(self, doc_ids: DataFrame) -> LineState:
        """The state without the documents in doc_ids(doc_id; a null id means all rows without one); what they had made others drop is kept again."""
        ids = doc_ids.select(known_id().alias("doc_id")).distinct()
        posts = _all(self.postings)
        left = saved(posts.join(ids, "doc_id", "left_anti"), "line-postings")
        touched = saved(posts.join(ids, "doc_id", "left_semi").select("shard", "key").distinct(), "line-touched")
        again = reference_counts(left.join(touched, ["shard", "key"], "left_semi"))
        counts = saved(self.counts.join(touched, ["shard", "key"], "left_anti").unionByName(again), "line-counts")
        return self._changed([left], counts)

    def _changed(self, made: list[DataFrame], counts: DataFrame) -> LineState:
        """Carries what has come to be shared, or is not any more, into the filters of the shards where that is so."""
        old, now = (c.where(SHARED).select("shard", "key") for c in (self.counts, counts))
        change = now.join(old, ["shard", "key"], "left_anti").withColumn("up", F.lit(True))
        change = saved(change.unionByName(old.join(now, ["shard", "key"], "left_anti").withColumn("up", F.lit(False))), "line-changes")

        def run(filters, changes):
            import pandas as pd

            shard = int(changes["shard"].iloc[0])
            up, down = (np.frombuffer(b"".join(changes["key"][changes["up"] == x]), np.uint64).reshape(-1, 2) for x in (True, False))
            blob = None
            if len(filters):
                held = CuckooFilter.from_bytes(filters["filter"].iloc[0])
                held.delete(down)
                if held.room(len(up)):
                    held.insert(up)
                    blob = held.to_bytes()
            return pd.DataFrame({"shard": [shard], "filter": [blob]})

        shards = change.select("shard").distinct()
        mine = self.filters.join(shards, "shard", "left_semi")
        new = saved(mine.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(run, "shard int, filter binary"), "line-filters")
        full = new.where("filter is null").select("shard")  # new shards, and those without room
        again = build_filters(counts.join(full, "shard", "left_semi"), self.shards)
        filters = self.filters.join(shards, "shard", "left_anti").unionByName(new.where("filter is not null")).unionByName(again)
        return LineState(made, counts, saved(filters, "line-filters"), self.shards)


def _all(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row of docs with n_lines, n_dropped and kept_text (input columns of these names, in any case, are replaced).

    A null or empty text is one empty line. Keys found in two documents or more lose all their lines but those of the
    smallest doc_id that holds them, where all of them stay. Rows with equal ids are one document, and so are rows with
    null ids, which come last. Very long texts cost their length; an empty table gives no rows.
    """
    return LineState.of(docs).apply(docs)


def line_digest(docs: DataFrame) -> DataFrame:
    """A row for each document with the hash of what dedup_lines leaves of it."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, c.first_doc IS NOT NULL AND k.doc_id <> c.first_doc AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
