"""The stages of the corpus pipeline against brute force, each on its own input."""

import re
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from pyspark.sql import functions as F  # noqa: E402
from test_operators import CLASHING, KINDS, brute_classes, brute_lines, check_packing, prose, words  # noqa: E402

from scriptorium.llm.quality import classify  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"Line of every document\n{prose(i % 30, 60)}\n{prose(i, 20)}", "en", f"s{i % 3}", 1) for i in range(90)] + [(900, None, None, None, None), (901, "", "en", "s0", 0)]
    return spark.createDataFrame(rows, KINDS)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]


def test_columns_stay(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name


def test_other_columns_survive(spark, docs):
    """Columns named like what operators add or use come out of every stage as they went in, and repeated rows are handled."""
    odd = docs.limit(40).union(docs.limit(3))
    for c in CLASHING:
        odd = odd.withColumn(c, F.concat(F.lit("mine "), F.coalesce(F.col("`doc_id`").cast("string"), F.lit("?"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, FOLDER)
        assert out.columns == odd.columns
        rows = out.collect()
        assert rows or name == "quality"
        for r in rows:
            assert all(r[c] == f"mine {r['doc_id']}" for c in CLASHING), name
        if name == "near_dedup":
            assert len({r["doc_id"] for r in rows}) == len(rows)
    assert corpus_pipeline.packing(spark, odd, FOLDER).count() == 43


def test_lines(spark, docs):
    want = brute_lines([tuple(r) for r in docs.select("doc_id", "text").collect()])
    rows = corpus_pipeline.line_dedup(spark, docs, FOLDER).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {i: "\n".join(x) for i, x in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_near(spark, docs):
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    classes = brute_classes(pairs)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()) == sorted({*classes.values()})


def test_mixing(spark, docs):
    rows = corpus_pipeline.mixing(spark, docs, FOLDER).collect()
    known = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert rows and all(r["text"] == known[r["doc_id"]] for r in rows)


def test_quality_keeps_what_scores_enough(spark, docs):
    """Every row that the scores let through stays as it is, clean ones too, and no other."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for given in (docs, spark.read.parquet(f"{FOLDER}/documents.parquet")):
        scores = {r["doc_id"]: r["score"] for r in classify(given, labels).collect()}
        rows = given.collect()
        want = [r for r in rows if scores[r["doc_id"]] >= 0.3]
        assert sorted(map(str, corpus_pipeline.quality(spark, given, FOLDER).collect())) == sorted(map(str, want))
    assert 0 < len(want) < len(rows)


def test_mixing_meets_targets(spark, docs):
    """Words of each source in the mix against water-filled shares; copies of a source's documents differ by one at most."""
    rows, copies = docs.collect(), Counter(r["doc_id"] for r in corpus_pipeline.mixing(spark, docs, FOLDER).collect())
    size, by = {r["doc_id"]: len(words(r["text"])) for r in rows}, {}
    for r in rows:
        by.setdefault(r["source"], []).append(r["doc_id"])
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, rest, want = {s for s in order if total[s]}, float(sum(total.values())), dict.fromkeys(order, 0.0)
    while left:
        share = rest / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 3 * total[s]}
        for s in full or left:
            want[s] = 3.0 * total[s] if full else share * weight[s]
        rest -= sum(want[s] for s in full)
        left = left - full if full else set()
    for s, ids in by.items():
        counts = {copies[i] for i in ids if size[i]}
        assert abs(sum(copies[i] * size[i] for i in ids) - want[s]) <= max(size[i] for i in ids) / 2 + 1
        assert not counts or max(counts) <= 3 and max(counts) - min(counts) <= 1
    assert not any(copies[i] for i in size if not size[i])


def test_packing(spark, docs):
    rows = corpus_pipeline.packing(spark, docs, FOLDER).collect()
    check_packing(rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}


def test_run(spark):
    from scriptorium.llm.common import saved_so_far

    before = saved_so_far()
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert saved_so_far() == before + 1  # the result's own table
    assert rows and check_packing(rows)
    bad = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if re.search(r"(###|%%%|&&&)", r["text"] or "")}
    assert len(bad & {r["doc_id"] for r in rows}) < len(bad) / 2  # from 68 labels; larger tables catch nearly all
