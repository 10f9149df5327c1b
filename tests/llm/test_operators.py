"""Each operator against a brute-force version, an exact round trip, or held-out accuracy, with the awkward inputs."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from scriptorium.llm import common, draws, edit_embedding, line_dedup, minhash_dedup, mixing, near_classes, packing, quality, sharding, substring_dedup, url_lists, vector_dedup
from scriptorium.llm.common import Words, maybe_among
from scriptorium.llm.cuckoo import CuckooFilter
from scriptorium.llm.graph import components
from scriptorium.llm.tokens import Encoder, tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENS = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in ("ka", "lo", "mi", "ru", "se") for b in ("n", "to", "ra", "x", "y", "zu")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


LONG = prose("long", 6000)
TEXTS = [
    None, "", " \t\n ", "one", "same\nline here is long\nend", "Same\n  LINE here is long \nother", "same\nline here is long\nend", prose(1, 60), prose(1, 60) + " tail", prose(2, 30) + " " + prose(1, 25), LONG, LONG + " x",
    "kan " * 50, "é" * 40 + " Å 説明 🙂", "a\x1cb c d", prose(3, 2047), prose(4, 25), prose(4, 25) + "\n" + prose(4, 25),
]
ROWS = [(i, t, "en", ["a", "b", None, "c"][i % 4], 1) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, KINDS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, and columns named like what operators add."""
    rows = [(None, "x y z", "en", "a", 1), (1, prose(5, 30), None, "a", 1), (1, prose(5, 30), None, "a", 1), (2, None, "en", None, None), (2, prose(5, 30), "en", "b", 3)]
    out = spark.createDataFrame(rows, KINDS)
    for c in CLASHING:
        out = out.withColumn(c, F.lit("mine"))
    return out


#: What operators add, in other case too, what they call things on their way, and names that need quoting.
CLASHING = (
    "shard", "slot", "Size", "taken", "Score", "PREDICTED", "kept_text", "n_words", "Class_Id", "kept", "id", "k", "h1", "spans", "Shards", "sequence_id", "target", "source_size",
    "dealt", "__sub", "sub", "part", "row__", "salt__", "key", "begin", "size.of", "a`b", "length", "label", "n_lines", "__gone", "__text", "rank", "n", "offset", "x y",
)


def survive(out, *new):
    """Columns of the input that an operator does not replace hold what they held."""
    for r in out.collect():
        assert {c for c in CLASHING if c.lower() not in new and r.asDict().get(c, "none") != "mine"} == set()
    assert sorted({c.lower() for c in CLASHING} & set(new) - {c.lower() for c in out.columns}) == []


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 1


def brute_list(captures, events):
    held = {}
    for p, d, action, category in events:
        if p and d is not None:
            held.setdefault(p, {})
            held[p][d] = max(held[p].get(d, ("", "")), (action, category))
    out = []
    for i, url, day in captures:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)(?:[^/?#]*)/?([^/?#]*)", url or "")
        host = m[1].lower() if m else ""
        domain = re.search(r"([^.]+\.[^.]+\.[^.]+)$", host)
        hit = None
        for key in (f"{host}/{m[2]}" if m and m[2] else "", host, domain[1] if domain else ""):
            past = [d for d in held.get(key, {}) if day is not None and d <= day] if key else []
            if hit is None and past and held[key][max(past)][0] == "add":
                hit = (key, held[key][max(past)][1], max(past))
        out.append((i, *(hit or (None, None, None))))
    return sorted(out)


def test_url_lists(spark):
    r = random.Random(1)
    hosts = [f"h{i}.example.org" for i in range(4)] + [f"w.h{i}.example.org" for i in range(4)]
    captures = [(i, f"https://{r.choice(hosts)}:8080/{r.choice(['en', 'fr', ''])}/{i}?q", r.randrange(400)) for i in range(300)]
    captures += [(900, None, 5), (901, "nonsense", 5), (902, "https://h0.example.org/en/", None), (903, "https://h1.example.org", 50), (903, "https://h1.example.org", 50)]
    events = [(r.choice([*hosts, *(f"{h}/en" for h in hosts)]), r.randrange(400), r.choice(["add", "remove"]), r.choice("xy")) for _ in range(200)] + [(None, 1, "add", "x"), ("h0.example.org", None, "add", "x")]
    got = url_lists.temporal_list_join(spark.createDataFrame(captures, "i int, url string, fetch_day int"), spark.createDataFrame(events, "pattern string, day int, action string, category string"))
    assert sorted([(x["i"], x["list_pattern"], x["list_category"], x["listed_since"]) for x in got.collect()], key=str) == sorted(brute_list(captures, events), key=str)
    named = spark.createDataFrame(captures, "i int, url string, fetch_day int")
    for c in CLASHING + ("site", "host", "on", "epoch", "pattern"):
        named = named.withColumn(c, F.lit("mine"))
    survive(url_lists.temporal_list_join(named, spark.createDataFrame(events, EVENT)))
    assert url_lists.temporal_list_join(named.limit(0), spark.createDataFrame(events, EVENT)).count() == 0
    empty = spark.createDataFrame([], "pattern string, day int, action string, category string")
    assert url_lists.temporal_list_join(spark.createDataFrame(captures, "i int, url string, fetch_day int"), empty).where("list_level is not null").count() == 0


CAPTURE, EVENT = "i int, url string, fetch_day int", "pattern string, day int, action string, category string"


def test_url_lists_on_any_day(spark):
    """Entries and captures far from day 0, on both sides of it, and far from each other."""
    events = [("h.example.org", d, a, "x") for d, a in ((-300, "add"), (-70, "remove"), (4160, "add"), (20_500, "remove"), (20_600, "add"))]
    captures = [(i, "https://h.example.org/", d) for i, d in enumerate((-301, -300, -71, -70, -1, 0, 4159, 4160, 4224, 20_499, 20_500, 20_599, 20_600, 100_001, 2_000_000_000))]
    got = url_lists.temporal_list_join(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENT))
    assert sorted((x["i"], x["list_pattern"], x["list_category"], x["listed_since"]) for x in got.collect()) == brute_list(captures, events)


def test_hosts(spark):
    """Users, ports, dots at the end and capitals are no part of a host; addresses in brackets are one."""
    cases = {"https://u:p@a.b.com/": "a.b.com", "HTTP://A.B.com.:80?x@y": "a.b.com", "http://[::1]:80/x": "[::1]", "http://a.com/u@v.org/": "a.com", "nonsense": "", "http:///x": ""}
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r["url"]: r["h"] for r in rows.select("url", url_lists.host_of(F.col("url")).alias("h")).collect()} == cases


def test_url_lists_of_any_length(spark):
    """Patterns of one to five labels and of several segments, nested; the longest one active holds."""
    hosts = ["a.b.c.example.com", "b.c.example.com", "example.com", "xexample.com", "www.example.com", "deep.a.b.c.example.com", "other.net", "com"]
    paths = ["", "/", "/en", "/en/", "/en/docs/page", "/en/docs?x/y", "//en", "/english/docs"]
    patterns = ["com", "example.com", "c.example.com", "b.c.example.com", "a.b.c.example.com", "example.com/en", "example.com/en/docs", "a.b.c.example.com/en/docs", "other.net/english"]
    r = random.Random(3)
    captures = [(i, f"http://{h}{p}", r.randrange(300)) for i, (h, p) in enumerate((h, p) for h in hosts for p in paths for _ in range(6))]
    events = [(p, d, a, p[:1]) for p in patterns for d, a in ((r.randrange(100), "add"), (100 + r.randrange(50), "remove"), (150 + r.randrange(100), "add"))]

    def brute(url, day):
        site = url.split("://")[1].split("?")[0]
        host = site.split("/")[0]
        for p in sorted(patterns, key=lambda p: ("/" in p, len(p)), reverse=True):
            past = max(((d, a) for q, d, a, _ in events if q == p and d <= day), default=None)
            covers = (site == p or site.startswith(f"{p}/")) if "/" in p else (host == p or host.endswith(f".{p}"))
            if covers and past and past[1] == "add":
                return "prefix" if "/" in p else "host" if host == p else "domain", p, past[0]
        return None, None, None

    got = url_lists.temporal_list_join(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENT)).collect()
    assert {x["i"]: (x["list_level"], x["list_pattern"], x["listed_since"]) for x in got} == {i: brute(u, d) for i, u, d in captures}
    assert len(got) == len(captures) and {"com", "example.com", "c.example.com", "example.com/en/docs"} <= {x["list_pattern"] for x in got}


def test_url_lists_are_independent(spark):
    """Lists and categories that share patterns do not end each other's entries, and a capture stays one row."""
    r = random.Random(4)
    hosts = [f"h{i}.example.org" for i in range(3)]
    events = [(x, p, d, a, c) for x, c in (("1", "ads"), ("2", "spam"), ("2", "malware"), ("3", "ads")) for p in hosts for d, a in ((r.randrange(60), "add"), (60 + r.randrange(60), "remove"), (120 + r.randrange(80), "add"))]
    events += [("1", "h0.example.org", 10, "add", "ads"), ("1", "h0.example.org", 10, "remove", "ads")]
    captures = [(i, f"https://{r.choice(hosts)}/{i % 9}", r.randrange(220)) for i in range(400)]

    def brute(url, day):
        live = []
        for x, c, p in {(x, c, p) for x, p, _, _, c in events}:
            past = max(((d, a) for y, q, d, a, k in events if (y, k, q) == (x, c, p) and d <= day), default=None)
            if p == url.split("/")[2] and past and past[1] == "add":
                live.append((past[0], c, p))
        return max(live, default=(None, None, None))

    got = url_lists.temporal_list_join(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, "list string, " + EVENT)).collect()
    assert len(got) == len(captures)
    assert {x["i"]: (x["listed_since"], x["list_category"], x["list_pattern"]) for x in got} == {i: brute(u, d) for i, u, d in captures}
    pages = spark.createDataFrame([("ads", "tiontion.example.net", d, a, "ads") for d, a in ((0, "add"), (400, "remove"))] + [("spam", "tiontion.example.net", d, a, "spam") for d, a in ((0, "add"), (90, "remove"))], "list string, " + EVENT)
    one = url_lists.temporal_list_join(spark.createDataFrame([(1, "http://tiontion.example.net/", 200)], CAPTURE), pages).first()
    assert (one["list_category"], one["listed_since"]) == ("ads", 0)


# 2


def test_encoder():
    encoder = Encoder(TOKENS)
    texts = [*TEXTS, "It's I'M don't. they'll ### a,b. x... É. ΣΣ. <|endoftext|>a <|startoftext|> 12.5 \u200b. ﬁ. ẞ.", "\u0130. \u0130x ŉ. \u0958. x\u0301. A\u030a. 説明. ª ΐ."]
    made = encoder.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.frombuffer(made[i], "<u4").tolist() == tokenizer(TOKENS).encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("texts", [[], [None], ["", " "], ["\u00a0", None, "\u3000 \u00a0"], ["a\0b \0", "\u00a0x", None, "x x"]])
def test_encoder_of_few_words(texts):
    made = Encoder(TOKENS).encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [tokenizer(TOKENS).encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_of_repeated_words():
    """Python holds distinct words alone: no object, nor a place in a list, for each of a million occurrences."""
    n, encoder = 1_000_000, Encoder(TOKENS)
    texts = pa.array(["the of " * (n // 4)] * 2)
    encoder.encode(texts)
    tracemalloc.start()
    words = Words(texts)
    alone = tracemalloc.get_traced_memory()[1]
    del words
    tracemalloc.reset_peak()
    made = encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(m) for m in made] == [2 * n, 2 * n] and made[0] == made[1]
    assert peak < max(alone, 8 * n + 4 * n) + n  # what Words takes on its way, or its codes beside the ids


def check_packing(rows, size=2048):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing(docs, none, odd):
    rows = packing.pack_documents(docs, TOKENS).collect()
    n = check_packing(rows)
    want = []
    for i, t in enumerate(TEXTS):
        ids = [*tokenizer(TOKENS).encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, p, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert n <= -(-sum(w[3] for w in want) // 2048) + 2
    assert packing.pack_documents(none, TOKENS).count() == 0
    assert packing.pack_documents(odd, TOKENS).count() == 5
    assert {len(r["ids"]) for r in packing.pieces(docs, TOKENS, 0, 2048, keep_ids=True).collect()} == {w[3] for w in want}


@pytest.mark.parametrize("seed", range(4))
def test_plan(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(2048, 1 + (r.lognormal(6, 1.2, 5000)).astype(int)) if seed else np.full(5000, 700)
    made = packing.plan(dict(Counter(lengths.tolist())))
    ranks, seen = [], Counter()
    for n in lengths.tolist():
        ranks.append(seen[n])
        seen[n] += 1
    sequence, offset = made.place(lengths, np.array(ranks))
    assert check_packing([{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True)]) == made.sequences
    assert made.sequences <= (-(-lengths.sum() // 2048) * 1.01 + 1 if seed else 2500)


# 3


def test_quality(spark, docs, none, odd):
    good = [(i, prose(i, 80).capitalize() + ".") for i in range(300)]
    bad = [(1000 + i, " | ".join(prose(i, 40).split()) if i % 2 else "kan " * 80) for i in range(300)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_digest(table, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] < 1000) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert quality.classify(docs, labels).count() == len(ROWS) and quality.classify(none, labels).count() == 0
    assert quality.classify(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    survive(quality.classify(odd, labels), "score", "predicted")
    assert {r["held_out"] for r in quality.quality_digest(odd, labels).where("doc_id is null").collect()} == {False}
    small = {r["doc_id"]: r["score"] for r in quality.classify(table.where("doc_id < 3"), labels, train_rows=400).collect()}
    assert len(small) == 3


def test_additive_tables():
    r = np.random.default_rng(0)
    x = np.zeros((3000, len(quality.FEATURES)))
    x[:, :2] = r.random((3000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # nothing but an interaction
    model = quality.train(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.85


# 4


def shingle_counts(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(rows):
    up = {i: i for i, _ in rows}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, s in rows:
        for b, t in rows:
            x, y = shingle_counts(s), shingle_counts(t)
            if a < b and ((s or "") == (t or "") or sum((x & y).values()) * 5 >= 4 * sum((x | y).values()) > 0):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {i: root(i) for i in up}


def near_rows():
    r = random.Random(4)
    out = []
    for g in range(6):
        base = prose(g + 50, 90).split()
        for k in range(40 if g == 0 else 8):
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = r.choice(VOCAB) + "q"
            out.append((len(out) * 3, " ".join(w) + (" kan" * (k % 3))))
    return out + [(5000, None), (5001, ""), (5002, "a b"), (5003, "a b"), (5004, "a c")]


def test_near_duplicates(spark, docs, none, odd):
    rows = near_rows()
    got = {r["doc_id"]: r["class_id"] for r in minhash_dedup.near_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)
    got = minhash_dedup.near_duplicates(docs)
    assert got.columns == [*docs.columns, "class_id", "kept"]
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == brute_classes([r[:2] for r in ROWS])
    assert minhash_dedup.near_duplicates(none).count() == 0
    found = minhash_dedup.near_duplicates(odd)
    survive(found, "class_id", "kept")
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in found.collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, False), (2, 1, False), (2, 2, True), (None, None, True)], key=str)
    rows = [(None, base) for base in (prose(1, 30), prose(1, 30), prose(2, 30))] + [(4, prose(3, 30)), (4, prose(4, 30)), (None, prose(4, 30)), (4, prose(4, 30))]
    for query in (minhash_dedup.near_digest, minhash_dedup.near_duplicates):
        got = Counter((r["doc_id"], r["class_id"], r["kept"]) for r in query(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == {(None, None, True): 2, (None, None, False): 1, (4, 4, True): 2, (4, 4, False): 1, (None, 4, False): 1}


def test_hot_buckets(spark, monkeypatch):
    """Buckets far over a block that span classes, with outliers in them, and a text in a third of all rows: the same classes, by every way of comparing."""
    from scriptorium.llm import common, near_classes

    monkeypatch.setattr(common, "HOT_ROWS", 4)
    monkeypatch.setattr(near_classes, "SMALL", 3)
    monkeypatch.setattr(near_classes, "BLOCK", 5)
    monkeypatch.setattr(near_classes, "PAIRS_PER_TASK", 3)
    r = random.Random(14)
    base, rows = prose(77, 60).split(), []
    for _ in range(90):
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = r.choice(VOCAB) + "z"
        rows.append((len(rows), " ".join(w)))
    rows += [(200 + i, " ".join(base)) for i in range(60)] + [(300 + i, prose(300 + i, 40)) for i in range(30)]
    got = {x["doc_id"]: x["class_id"] for x in minhash_dedup.near_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_members_outside_the_largest_class_meet_all(spark, monkeypatch):
    """One bucket holds all; pivots find nothing, so the blocks have to find every link across classes."""
    monkeypatch.setattr(near_classes, "SMALL", 0)
    monkeypatch.setattr(near_classes, "BLOCK", 4)
    r = random.Random(15)
    texts = {i: float(r.randrange(40)) for i in range(60)}  # near: at most 1 apart
    near = lambda a, b: abs(a - b) <= 1
    reps = spark.createDataFrame([(i, [7], b"x", 1) for i in texts], "node long, bands array<long>, short binary, size int")
    table = spark.createDataFrame([(i, zstandard.compress(str(v).encode())) for i, v in texts.items()], "node long, z binary")
    measure = near_classes.Measure(
        lambda one, two: np.zeros(len(one), bool),
        lambda a, b: np.zeros(len(a), bool),
        lambda t: [x.as_py().encode() for x in t],
        lambda x, y: np.nonzero(np.abs(np.array([float(a) for a in x])[:, None] - np.array([float(b) for b in y])) <= 1),
    )
    got = {x["id"]: x["component"] for x in near_classes.classes(reps, lambda ids: table.join(ids, "node", "left_semi"), measure).collect()}
    up = list(texts)

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in texts:
        for b in range(a):
            if near(texts[a], texts[b]):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    assert {i: got.get(i, i) for i in texts} == {i: root(i) for i in texts} and len(set(map(root, texts))) > 1


def test_signatures_are_unbiased():
    r, errors = np.random.default_rng(3), []
    for t in range(40):
        grams = np.arange(30, dtype=np.uint64) * np.uint64(7919) + np.uint64(t * 1_000_003)
        a = r.integers(1, 40, 30)
        b = np.maximum(0, a + r.integers(-12, 12, 30))
        k = b > 0
        one, two = minhash_dedup.registers(np.zeros(30, int), grams, a, 1)[0], minhash_dedup.registers(np.zeros(int(k.sum()), int), grams[k], b[k], 1)[0]
        errors.append((one == two).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02


def test_overlaps():
    from scriptorium.llm import near_classes

    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 50)).astype(np.uint64)) for _ in range(40)] + [np.zeros(0, np.uint64)]
    got = near_classes.common_elements(sets[:9], sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(9) for j in range(41))


# 5


def test_fingerprints(docs, none, odd):
    rows = {r["doc_id"]: r for r in edit_embedding.fingerprint_digest(docs).collect()}
    ids = sorted(rows, reverse=True)
    assert len(ids) == len(ROWS)
    for i, n in zip(ids, [*ids[1:], ids[0]], strict=True):
        own, nxt = TEXTS[i] or "", TEXTS[n] or ""
        k = len(own) // 3
        edited = own[: len(own) - k] + nxt[:k]
        a, b, c = edit_embedding.fingerprints([own, edited, nxt])
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"], rows[i]["fingerprint"], rows[i]["edited_fingerprint"]) == (len(own), sha(edited), a, b)
        assert rows[i]["near_edited"] == edit_embedding.likeness(a, b) and rows[i]["near_next"] == edit_embedding.likeness(a, c)
    assert edit_embedding.fingerprint_digest(none).count() == 0
    assert edit_embedding.fingerprint_digest(odd).count() == 5
    alone = edit_embedding.fingerprint_digest(docs.where("doc_id = 7")).first()
    assert alone["near_next"] == 1.0
    assert {i: r["near_class"] for i, r in rows.items()} == brute_near([r[:2] for r in ROWS])


def brute_near(rows):
    """Smallest id that equal texts, and pairs within four edits of 64 samples or more, lead to."""
    up = {i: i for i, _ in rows}
    prints = {i: edit_embedding.fingerprints([t or ""])[0] for i, t in rows}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, s in rows:
        for b, t in rows:
            s_, t_ = s or "", t or ""
            if a < b and (s_ == t_ or min(len(prints[a]), len(prints[b])) >= 64 and edit_embedding.edit_distance(s_, t_, 4) is not None):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {i: root(i) for i in up}


def test_near_classes_recall(spark):
    """Of texts with one to four edits in them, at least nine tenths are found beside their originals, and no others."""
    r = random.Random(31)
    rows = [(i, prose(500 + i, r.choice([15, 40, 120, 400]))) for i in range(250)]
    for i in range(250):
        chars = list(rows[i][1])
        for _ in range(1 + i % 4):
            at = r.randrange(len(chars))
            chars[at : at + r.randrange(2)] = r.choice(["", "q", "z"])
        rows.append((1000 + i, "".join(chars)))
    got = {x["id"]: x["near_class"] for x in edit_embedding.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: c for i, c in brute_near(rows).items() if i != c}
    found = sum(got.get(i) == c for i, c in want.items())
    print("recall", found, len(want))
    assert len(want) > 240 and set(got) <= set(want) and found >= 0.9 * len(want)


def test_texts_too_far_apart_stay_where_they_are(spark, monkeypatch):
    """Copies with 12 letters changed, and unlike texts that begin alike, are told apart without their texts; near ones are not."""
    r = random.Random(32)
    base, rows = prose(77, 300), []
    for i in range(25):
        chars = list(base)
        for at in r.sample(range(len(chars)), 12):
            chars[at] = r.choice("qzxj")
        rows.append((i, "".join(chars)))
    rows += [(100 + i, "ab" * (500 + 40 * i)) for i in range(25)]
    near = rows[7][1]
    rows += [(500, near[:900] + "q" + near[900:]), (501, "ab" * 501)]
    steps, write = Counter(), near_classes.saved

    def counted(df, name):
        out = write(df, name)
        steps[name] += out.count()
        return out

    monkeypatch.setattr(near_classes, "saved", counted)
    got = {x["id"]: x["near_class"] for x in edit_embedding.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {500: 7, 501: 100}
    assert steps["wanted-texts"] <= 8 and steps["block-texts"] == 0


@pytest.mark.parametrize("size", [64, 500, 1500])
def test_bands_and_sketches_part_no_near_pair(size):
    """Lengths around every boundary between spans, in which near texts share a whole run of keys when their samples do."""
    r = random.Random(size)
    print_ = np.full(190, 48, np.uint8)  # two octaves, and nearly a third
    for n in range(size, size + 3 * edit_embedding.SPAN):
        for m in range(n, n + 9):
            one, two = (edit_embedding.band_keys(print_, k, 8, 9) for k in (n, m))
            met = sum(a == b for a, b in zip(one, two, strict=True) if a is not None)
            assert met >= 9 if m - n <= 4 else met in (0, 9)
        assert not set(one) & set(edit_embedding.band_keys(print_, n + 3 * edit_embedding.SPAN, 8, 9)) - {None}
    text = prose(size, size // 8)
    for n in range(60):
        chars = list(text)
        for _ in range(n % 5):
            at = r.randrange(len(chars))
            chars[at : at + r.randrange(2)] = r.choice(["", "q", "é", "x"])
        pair = [np.frombuffer(edit_embedding.sketch_bytes(edit_embedding.classes(t)), np.uint8).reshape(1, -1) for t in (text, "".join(chars))]
        assert edit_embedding.agree(*pair).all()


def test_ranges_of_ids(docs, monkeypatch):
    want = sorted(map(str, edit_embedding.fingerprint_digest(docs).collect()))
    monkeypatch.setattr(edit_embedding, "ROWS_PER_BUCKET", 2)
    assert sorted(map(str, edit_embedding.fingerprint_digest(docs).collect())) == want


def test_counts_rule_out_no_near_pair():
    r = random.Random(41)
    base, texts = prose(90, 30), []
    for n in range(60):
        chars = list(base)
        for _ in range(n % 9):
            at = r.randrange(len(chars))
            chars[at : at + r.randrange(2)] = r.choice(["", "q", "é", "ka"])
        texts.append("".join(chars))
    held = edit_embedding.encoded(pa.array(texts))
    got = set(zip(*(x.tolist() for x in edit_embedding.across(held, held)), strict=True))
    assert got == {(i, j) for i, s in enumerate(texts) for j, t in enumerate(texts) if levenshtein(s, t) <= 4} and 60 < len(got) < 3600


def test_ranges_of_one_id(spark, monkeypatch):
    """Half of all rows without an id, and many with one: ranges are split by the text, and the order is whole."""
    monkeypatch.setattr(edit_embedding, "ROWS_PER_BUCKET", 3)
    rows = [(None if i % 2 else 5 if i % 4 else i - 2**62, prose(i % 25, 12)) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = {(r["doc_id"], r["text"]): r["h"] for r in table.select("doc_id", "text", F.xxhash64(F.lit(1), "text").alias("h")).collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, keyed[x]), reverse=True)
    want = Counter((i, sha(t[: len(t) - len(t) // 3] + u[: len(t) // 3])) for (i, t), (_, u) in zip(order, [*order[1:], order[0]], strict=True))
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in edit_embedding.fingerprint_digest(table).collect()) == want


def test_walk_is_the_plain_walk():
    """Vectors and lookups give what single steps give."""
    r = random.Random(6)
    codes = [np.array([r.randrange(256) for _ in range(r.randrange(0, 900))], np.uint8) for _ in range(90)]
    for c, places in zip(codes, edit_embedding.walk(codes, [0] * 90), strict=True):
        j = 0
        for k, cls in enumerate(c.tolist()):
            assert places[k] == j
            j += int(edit_embedding.DWELL[cls, j % edit_embedding.PERIOD])
        assert places[-1] == j


def test_fewer_edits_are_likelier():
    base, r, last = prose(9, 400), random.Random(2), 1.0
    for edits in (1, 8, 60):
        chars = list(base)
        for _ in range(edits):
            at = r.randrange(len(chars))
            chars[at : at + r.randrange(2)] = r.choice(["", "q", "zz"])
        now = edit_embedding.likeness(*edit_embedding.fingerprints([base, "".join(chars)]))
        assert now <= last
        last = now
    assert last < 0.95


def test_near_pairs(spark):
    base = prose(11, 120)
    rows = [(1, base), (2, base[:300] + "Q" + base[300:]), (3, prose(12, 120)), (4, base), (5, None), (6, "")]
    got = {(r["doc_id"], r["near_id"], r["distance"]) for r in edit_embedding.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2, 1, 1) in got and all(d > 0 for _, _, d in got) and not any(3 in p[:2] for p in got)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize(("most", "block"), [(8, 512), (3, 4)])
def test_near_pairs_are_all_pairs(spark, monkeypatch, most, block):
    """Brute force over short, long and template texts; pairs whose common head is far from either; copies and repeated ids."""
    monkeypatch.setattr(edit_embedding, "PAIR_BLOCK", block)
    r = random.Random(13)

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            at = r.randrange(len(chars) + 1)
            chars[at : at + r.randrange(2)] = r.choice(["", "q", "é"])
        return "".join(chars)

    base = [prose(21, 25), prose(22, 12), prose(23, 5), "kan to", "a", "é🙂x", "kan " * 20]
    texts = [edited(b, n) for b in base for n in (0, 0, 1, 2, 4, 5, 6, 8, 9)] + ["", None, prose(21, 25)]
    rows = [*enumerate(texts), (3, texts[4]), (70, texts[2]), (None, texts[0])]
    first = {}
    for i, t in rows:
        if t and i is not None:
            first[t] = min(i, first.get(t, i))
    known = {(t, u): levenshtein(t, u) for t in first for u in first if abs(len(t) - len(u)) <= most}
    want = {(i, first[u], known[t, u]) for i, t in rows if t and i is not None for u in first if first[u] < i and 1 <= known.get((t, u), 99) <= most}
    got = edit_embedding.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), most).collect()
    assert {tuple(x) for x in got} == want and len(want) > 100


@pytest.mark.parametrize(("a", "b", "most", "d"), [("kitten", "sitting", 5, 3), ("abc", "abc", 3, 0), ("", "ab", 3, 2), ("abcdef", "xyz", 3, None), ("ab", "", 1, None)])
def test_edit_distance(a, b, most, d):
    assert edit_embedding.edit_distance(a, b, most) == d


# 6


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows):
    first = {}
    for i, t in sorted(rows):
        for x in (t or "").split("\n"):
            first.setdefault(line_key(x), i)
    return {i: [x for x in (t or "").split("\n") if len(line_key(x)) < 10 or first[line_key(x)] == i] for i, t in rows}


def test_lines(docs, none, odd):
    got = line_dedup.dedup_lines(docs)
    want = brute_lines([r[:2] for r in ROWS])
    for r in got.collect():
        assert r["kept_text"] == "\n".join(want[r["doc_id"]])
        assert (r["n_lines"], r["n_dropped"]) == (len((r["text"] or "").split("\n")), len((r["text"] or "").split("\n")) - len(want[r["doc_id"]]))
    assert {r["doc_id"]: r["kept_sha256"] for r in line_dedup.line_digest(docs).collect()} == {i: sha("\n".join(x)) for i, x in want.items()}
    assert line_dedup.dedup_lines(none).count() == 0
    survive(line_dedup.dedup_lines(odd), "n_lines", "n_dropped", "kept_text")
    assert sorted((r["doc_id"] is None, r["n_dropped"]) for r in line_dedup.dedup_lines(odd).collect()) == [(False, 0), (False, 0), (False, 0), (False, 1), (True, 0)]


def test_lines_are_reversible(docs):
    """What deletion leaves equals a state that never saw the documents; so does what insertion makes."""
    half, rest = docs.where("doc_id < 6"), docs.where("doc_id >= 6")
    whole = line_dedup.LineState.of(docs, shards=3)
    grown = line_dedup.LineState.of(half, shards=3).insert(rest)
    shrunk = whole.delete(rest.select("doc_id"))
    for state, table in ((grown, docs), (shrunk, half)):
        want = brute_lines([tuple(r) for r in table.select("doc_id", "text").collect()])
        assert {r["doc_id"]: r["kept_text"] for r in state.apply(table).collect()} == {i: "\n".join(x) for i, x in want.items()}
    assert line_dedup._all(shrunk.delete(half.select("doc_id")).postings).count() == 0


def line_rows(seed, n):
    """Lines from a small store, some in nearly every document, some cased or padded differently."""
    r = random.Random(seed)
    return [f"  {x.upper()}\t" if r.random() < 0.2 else x for x in (f"the line number {int(r.random() ** 3 * 60)}" for _ in range(n))]


def test_many_insertions_and_deletions(spark, monkeypatch):
    """Ten insertions in a row, through filters that run full and shards that become more, then deletions: each time as if made at once."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 6)
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 4)
    rows = [(i, "\n".join([*line_rows(i, 5), f"only in document {i}"])) for i in range(44)]
    table = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    state = line_dedup.LineState.of(table(rows[:4]), shards=1)
    for at in range(4, 44, 4):
        state = state.insert(table(rows[at : at + 4]))
    assert state.shards > 1 and state.insert(table([])) is state

    def same(state, some):
        want = brute_lines(some)
        assert {r["doc_id"]: r["kept_text"] for r in state.apply(table(some)).collect()} == {i: "\n".join(x) for i, x in want.items()}

    same(state, rows)
    state = state.delete(table(rows[::3]).select("doc_id"))
    same(state, [r for k, r in enumerate(rows) if k % 3])
    same(state.insert(table(rows[::3])), rows)


def test_lines_without_ids(spark, monkeypatch):
    """Rows without ids are one document, the last; each keeps or loses its own lines."""
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 2)
    rows = [(None, f"a common long line\nonly in row {i} of these") for i in range(9)] + [(3, "a common long line"), (4, "A common long line \nx")]
    got = Counter(r["kept_text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([f"only in row {i} of these" for i in range(9)] + ["a common long line", "x"])


def test_cuckoo():
    r = np.random.default_rng(7)
    keys = r.integers(0, 2**63, (20_000, 2)).astype(np.uint64)
    made = CuckooFilter(10_000)
    made.insert(keys[:10_000])
    assert made.contains(keys[:10_000]).all() and made.contains(keys[10_000:]).mean() < 0.002
    made.delete(keys[:5000])
    again = CuckooFilter.from_bytes(made.to_bytes())
    assert again.contains(keys[5000:10_000]).all() and again.contains(keys[:5000]).mean() < 0.002
    tiny = CuckooFilter(1)
    tiny.insert(keys[:200])
    assert CuckooFilter.from_bytes(tiny.to_bytes()).contains(keys[:200]).all()


def test_cuckoo_keeps_keys_that_share_an_overflow_entry():
    """Pairs of keys with one fingerprint and one pair of buckets in a filter far beyond its capacity; one of each is deleted."""
    keys = np.random.default_rng(8).integers(0, 2**63, (20_000, 2)).astype(np.uint64)
    made, alike = CuckooFilter(4), {}
    for k, a, b, f in zip(range(len(keys)), *(x.tolist() for x in made._places(keys)), strict=True):
        alike.setdefault((min(a, b), f), []).append(k)
    one, two = (keys[[g[k] for g in alike.values() if len(g) > 1][:40]] for k in (0, 1))
    made.insert(np.concatenate([one, two]))
    assert max(made.overflow.values()) > 1
    made.delete(one)
    assert made.contains(two).all() and CuckooFilter.from_bytes(made.to_bytes()).contains(two).all()
    made.delete(two)
    assert not made.overflow and not made.table.any()


# 7


def brute_links(rows):
    """(vec_id, n_links, component_id, kept) of every row, by comparing every two rows."""
    last = 2**63 - 1
    sound = {}
    for k, (_, v, lab) in enumerate(rows):
        if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            scaled = np.array(v, float) / np.abs(np.array(v, float)).max()
            sound[k] = (lab, scaled / np.linalg.norm(scaled))
    links, up = [0] * len(rows), list(range(len(rows)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, (la, x) in sound.items():
        for b, (lb, y) in sound.items():
            if a < b and la == lb and len(x) == len(y) and float(x @ y) >= 0.98:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), last), last if i is None else i)
    named = [None if least[root(k)] == last else least[root(k)] for k in range(len(rows))]
    return sorted(((i, links[k], named[k], i is not None and i == named[k]) for k, (i, _, _) in enumerate(rows)), key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


def linked(spark, rows, kind=VECTORS):
    return sorted((tuple(x) for x in vector_dedup.vector_digest(spark.createDataFrame(rows, kind)).collect()), key=str)


def test_vectors(spark, monkeypatch):
    r = np.random.default_rng(8)
    rows = []
    for g in range(8):
        base = r.standard_normal(64)
        for _ in range(60 if g == 0 else 5):
            rows.append((len(rows), [float(np.float32(x)) for x in base + r.standard_normal(64) * 0.12], g % 3))
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 1), (902, rows[0][1], None), (903, None, 0), (904, [0.0] * 64, 0), (905, [float("nan")] * 64, 0), (906, [None] * 64, 0), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (909, [], 0), (910, [x * 2 for x in rows[0][1]], 0)]
    for block in (1024, 16):
        monkeypatch.setattr(vector_dedup, "BLOCK", block)
        assert linked(spark, rows) == brute_links(rows)
    assert linked(spark, rows[:0]) == []


def test_vectors_with_null_and_repeated_ids(spark):
    """Rows are told apart by their vectors, not by their ids."""
    near, far = [1.0, 0.001], [0.0, 1.0]
    rows = [(None, [1.0, 0.0], 1), (None, near, 1), (None, far, 1), (5, [1.0, 0.0], 2), (5, far, 2), (6, near, 2), (7, far, 3), (7, far, 3), (None, far, 3), (None, None, 3), (8, [1e300, 1e300], 4), (9, [1e-300, 1e-300], 4)]
    want = brute_links(rows)
    assert linked(spark, rows, "vec_id long, embedding array<double>, label int") == want
    assert [w[1] for w in want if w[0] is None] == [0, 0, 1, 1, 2] and (5, 1, 5, True) in want and (5, 0, 5, True) in want
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for c in ("id", "K1", "rep", "n", "n_links", "Kept", "component_id", "node", "v"):
        table = table.withColumn(c, F.lit("mine"))
    assert sorted((tuple(x) for x in vector_dedup.vector_digest(table).collect()), key=str) == want


def test_hot_vectors(spark, monkeypatch):
    """A third of all rows are one vector, another third nearly so; both spread over many tasks."""
    from scriptorium.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 4)
    r = np.random.default_rng(18)
    base = r.standard_normal(16)
    rows = [(i, base.tolist(), 1) for i in range(40)] + [(100 + i, (base + r.standard_normal(16) * 0.05).tolist(), 1) for i in range(40)] + [(200 + i, r.standard_normal(16).tolist(), i % 2) for i in range(40)]
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    assert linked(spark, rows) == brute_links(rows)


@pytest.mark.parametrize("dims", [2, 40, 64, 150])
def test_estimates_hold(dims):
    """Estimates from bits and factors are unbiased, and their bounds rule out no pair at the threshold, but most others."""
    r = np.random.default_rng(9)
    x = vector_dedup.unit(r.standard_normal((400, dims)))
    w = r.standard_normal((400, dims))
    w = vector_dedup.unit(w - (w * x).sum(1, keepdims=True) * x)
    y = 0.9801 * x + (1 - 0.9801**2) ** 0.5 * w  # just over the threshold
    turn = vector_dedup.rotations(dims, 1)[:, :dims]
    a, b = (vector_dedup.short_records(v @ turn) for v in (x, y))
    maybe = vector_dedup.likely(a, b, dims, 0.98)
    i, j = vector_dedup.settle(x, y, maybe, 0.98)
    want = {(p, q) for p, q in zip(*np.nonzero(x @ y.T >= 0.98), strict=True)}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(want) >= 400
    if dims >= 40:
        guess, spread = vector_dedup.estimates(a, b, dims, 0.98)
        assert abs((guess - x @ y.T).mean()) < 0.01 and abs((np.diag(guess) - 0.9801).mean()) < 0.01
        assert 0.4 < (np.diag(guess) - 0.9801).std() / np.median(np.diag(spread)) < 1.6
        assert maybe.sum() < 0.02 * maybe.size + 400


def test_recall_of_tables():
    """Pairs at the threshold meet in a table: none of 20,000 is missed, where MISS lets one in 100,000 go."""
    bits, tables = vector_dedup.table_shape(5000)
    r, missed = np.random.default_rng(10), 0
    for _ in range(20):
        x = vector_dedup.unit(r.standard_normal((1000, 64)))
        w = r.standard_normal((1000, 64))
        w = vector_dedup.unit(w - (w * x).sum(1, keepdims=True) * x)
        y = 0.98 * x + (1 - 0.98**2) ** 0.5 * w
        one, two = ((v @ vector_dedup.rotations(64, bits * tables)[:, 64 : 64 + bits * tables] >= 0).reshape(-1, tables, bits) for v in (x, y))
        missed += int((~(one == two).all(2).any(1)).sum())
    assert missed <= 2


def test_components(spark, monkeypatch):
    from scriptorium.llm import graph

    r = random.Random(10)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(None, 3), (7, 7)]
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in pairs:
        if a is not None and a != b:
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    want = {a: root(a) for a in up if root(a) != a}
    edges = spark.createDataFrame(pairs, "x long, y long")
    pairs_of_a_hub = [(1000, 1001 + i) for i in range(400)] + [(1001 + i, 2000) for i in range(50)]
    pairs += pairs_of_a_hub
    want |= {i: 1000 for _, i in pairs_of_a_hub}
    want |= {i: 1000 for i, _ in pairs_of_a_hub if i > 1000}
    edges = spark.createDataFrame(pairs, "x long, y long")
    for most in (1 << 18, 0):
        monkeypatch.setattr(graph, "ONE_TASK", most)
        assert {x["id"]: x["component"] for x in components(edges, "x", "y").collect()} == want
    assert components(edges.limit(0), "x", "y").count() == 0


# 8


def brute_windows(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if seen.setdefault(tuple(w[s : s + 20]), (i, s)) != (i, s):
                gone[s : s + 20] = [True] * 20
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_windows(spark, docs, none, odd):
    want = brute_windows([r[:2] for r in ROWS])
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect()} == want
    assert {r["doc_id"]: r["kept_sha256"] for r in substring_dedup.substring_digest(docs).collect()} == {i: sha(t) for i, (_, _, t) in want.items()}
    assert substring_dedup.remove_repeats(none).count() == 0
    survive(substring_dedup.remove_repeats(odd), "n_words", "n_removed", "kept_text")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.remove_repeats(odd).collect()) == [(False, 1, 0), (False, 1, 0), (False, 2, 0), (False, 2, 30), (True, 0, 0)]
    r = random.Random(12)
    parts = [prose(100 + i, 24) for i in range(12)]
    rows = [(i, " ".join(r.choice(parts) if r.random() < 0.6 else prose(1000 + 7 * i + k, r.randrange(3, 30)) for k in range(6))) for i in range(60)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_text"]) for x in got.collect()} == brute_windows(rows)


@pytest.mark.parametrize(("rows_at_most", "salts"), [(1, 1), (1, 3), (1, 1024), (6, 2)])
def test_substrings_of_hot_minimisers(spark, monkeypatch, rows_at_most, salts):
    """Minimisers beyond the bound go window by window, in parts: a passage in most documents, in two documents of one id, and many times in one."""
    for name, value in (("HOT_ROWS", 1), ("MOST_ROWS", rows_at_most), ("MOST_HOT", 1), ("SALTS", salts), ("AT_ONCE", 50)):
        monkeypatch.setattr(substring_dedup, name, value)
    r = random.Random(13)
    parts = [prose(200 + i, 26) for i in range(3)]
    rows = [(i, " ".join(r.choice(parts) if r.random() < 0.6 else prose(2000 + 7 * i + k, r.randrange(0, 30)) for k in range(5))) for i in range(40)]
    rows += [(100, " ".join([parts[0]] * 9)), (101, "kan " * 60), (102, None), (103, ""), (104, rows[5][1])]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_text"]) for x in got.collect()} == brute_windows(rows)


# 9


def test_sharding(spark, docs, none, odd):
    rows = sharding.sharding_digest(docs).collect()
    slots = {}
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len((TEXTS[r["doc_id"]] or "").encode()) + 1, zlib.crc32((TEXTS[r["doc_id"]] or "").encode()), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(16)) <= 1
    assert sorted(map(str, sharding.sharding_digest(docs).collect())) == sorted(map(str, rows))
    assert sharding.sharding_digest(none).count() == 0
    assert sharding.hypergeometric_shuffle(odd, ["doc_id", "text"]).count() == 5
    survive(sharding.hypergeometric_shuffle(odd, ["doc_id", "text"]), "shard", "slot")
    many = sharding.hypergeometric_shuffle(spark.range(5000), ["id"], shards=7, rows_per_partition=100).collect()
    assert sorted(Counter(r["shard"] for r in many).values()) == [714] * 5 + [715] * 2
    assert len({(r["shard"], r["slot"]) for r in many}) == 5000
    # a shard holds a fair share of any part of the input
    assert all(60 < c < 140 for c in Counter(r["shard"] for r in many if r["id"] < 700).values())


def test_matrix():
    sizes = [5, 0, 40, 3]
    shards = sharding.shard_sizes(48, 5)
    made = sharding.communication_matrix(sizes, shards, 1)
    assert made.sum(1).tolist() == sizes and made.sum(0).tolist() == shards


def test_matrix_of_very_many_rows():
    """Row sums of 10^11, far beyond numpy's own sampler: exact margins, and entries that spread as the law has it."""
    total = 4 * 10**11
    made = sharding.communication_matrix([10**11] * 4, sharding.shard_sizes(total, 400), 2)
    assert made.sum(1).tolist() == [10**11] * 4 and made.sum(0).tolist() == sharding.shard_sizes(total, 400)
    spread = (total * (1 / 4) * (3 / 4) * (1 / 400) * (399 / 400)) ** 0.5
    assert 0.9 < (made - total / 1600).std() / spread < 1.1
    parts = [total // 65_536 + (i < total % 65_536) for i in range(65_536)]
    made = sharding.communication_matrix(parts, sharding.shard_sizes(total, 16), 3)
    assert (made.sum(1) == parts).all() and made.sum(0).tolist() == sharding.shard_sizes(total, 16) and made.min() > 0


@pytest.mark.parametrize(("good", "bad", "sample"), [(7, 5, 6), (3, 40, 20), (30, 4, 17), (1, 1, 1), (5, 0, 3), (0, 5, 3), (9, 9, 18), (9, 9, 0)])
def test_draws_follow_the_law(monkeypatch, good, bad, sample):
    """The reduction that large populations take, here applied down to the end, against the law's probabilities."""
    monkeypatch.setattr(draws, "SMALL", 0)
    many = 100_000
    got = draws.hypergeometric(np.random.default_rng(3), *(np.full(many, x) for x in (good, bad, sample)))
    want = [math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample) if k <= good else 0.0 for k in range(sample + 1)]
    assert np.abs(np.bincount(got, minlength=sample + 1) / many - want).max() < 0.008


# 10


def test_mixing(spark, docs, none, odd):
    rows = [(i, prose(i, 5 + i % 40), "en", f"s{i % 7}" if i % 3 else "s0" if i % 2 else None, 1) for i in range(400)]
    table = spark.createDataFrame(rows, KINDS)
    got = mixing.mixing_digest(table).collect()
    size = {}
    for i, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, rest, want = set(size), float(sum(size.values())), {}
    while True:
        share = rest / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 3 * size[s]}
        if not full:
            want |= {s: share * weight[s] for s in left}
            break
        want |= {s: 3.0 * size[s] for s in full}
        rest -= sum(3 * size[s] for s in full)
        left -= full
    source = {i: s for i, _, _, s, _ in rows}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert (r["size"], r["source_size"]) == (len(words(rows[r["doc_id"]][1])), size[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 3 * r["size"] and len(r["shards"]) == -(-r["taken"] // r["size"]) and all(0 <= x < 16 for x in r["shards"])
        assert sum(r["dealt"]) == r["taken"] and len(r["dealt"]) == 16 and all(r["dealt"][x] > 0 for x in r["shards"])
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(map(str, mixing.mixing_digest(table).collect())) == sorted(map(str, got))
    assert mixing.mixing_digest(none).count() == 0 and mixing.mixing_digest(docs).count() == len(ROWS) and mixing.mixing_digest(odd).count() == 5
    mixed = mixing.mixed_rows(table, "text", ["doc_id", "text"])
    assert mixed.columns == table.columns
    whole = Counter()
    for r in mixed.collect():
        whole[r["source"]] += len(words(r["text"]))
    assert all(abs(whole[s] - want[s]) <= 45 for s in want)
    # every shard gets the same number of blocks, of all sources together
    shares = np.array([r["dealt"] for r in got]).sum(0)
    assert shares.sum() == sum(taken.values()) and np.ptp(shares) <= 2 * len(want) + 2
    survive(mixing.mix(odd, F.lit(1).cast("long"), ["doc_id", "text"]), "size", "source_size", "target", "taken", "dealt", "shards")
    survive(mixing.mixed_rows(odd, "text", ["doc_id", "text"]))


def test_mixing_refuses_what_it_cannot_hold(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    table = spark.range(8).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.lit("a b").alias("text"))
    with pytest.raises(ValueError, match="sources"):
        mixing.mixing_digest(table)
    assert mixing.mixing_digest(table.where("source <> 's3'")).count() == 6


def test_splitting_tree():
    made = mixing.splitting_tree([100, 3, 0, 41], 8, 1)
    assert made.sum(1).tolist() == [100, 3, 0, 41] and set(made.sum(0).tolist()) == {18}
    assert mixing.targets([100, 10, 10], [1, 5, 5]) == [60.0, 30.0, 30.0] and mixing.targets([0, 0], [1, 1]) == [0.0, 0.0]


def test_words_are_the_contract_s():
    made = Words(pa.array(TEXTS))
    distinct = made.distinct.to_pylist()
    for i, t in enumerate(TEXTS):
        assert [distinct[c] for c in made.codes[made.starts[i] : made.starts[i + 1]]] == words(t)


@pytest.mark.parametrize("many", [0, 1, 5000])
def test_maybe_among_loses_no_row(spark, monkeypatch, many):
    rows = spark.range(40_000).withColumn("text", F.concat(F.lit("t"), "id"))
    wanted = rows.where(F.col("id") < many).select("id")
    found = {r["id"] for r in maybe_among(rows, wanted, F.xxhash64(F.lit(3), "id"), many).collect()}
    assert found >= set(range(many)) and len(found) <= many + 0.13 * 40_000
    monkeypatch.setattr(common, "MOST_BITS", 1 << 15)
    full = maybe_among(rows, wanted, F.xxhash64(F.lit(3), "id"), many)
    assert full.columns == rows.columns and {r["id"] for r in full.collect()} >= set(range(many))
    assert maybe_among(rows, wanted, F.xxhash64(F.lit(3), "id"), 1 << 15) is rows


def test_packed_texts_open_in_slices(monkeypatch):
    texts = ["", "é" * 3000, "a" * 100_000, "", "b c d"]
    ids = pa.array(range(5), pa.int64())
    (sent,) = near_classes._packed([pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(texts)], ["id", "h1", "h2", "text"])])
    monkeypatch.setattr(near_classes, "SLICE_BYTES", 10_000)
    parts = list(near_classes.opened(sent, 3))
    assert len(parts) > 1 and [t for _, own in parts for t in own.to_pylist()] == texts
    assert [i for b, _ in parts for i in b.column(0).to_pylist()] == list(range(5))
    assert not [t for _, own in near_classes.opened(sent.slice(0, 0), 3) for t in own.to_pylist()]


def test_saved_tables_go(spark):
    from scriptorium.llm import common

    kept = common.saved(spark.range(3), "small")
    path = common._MADE[-1]
    assert kept.count() == 3
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    common.remove_saved(spark)
    assert not common._MADE and not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
