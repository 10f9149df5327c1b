import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import urls
from scriptorium.operators.normalize import crawl_path

BASE = "https://manual.example.net/product/v7/"
#: allow, deny, url, in scope
CASES = [
    ([], [], BASE, True),
    ([], [], BASE + "deep/er/page.html?lang=en#part", True),
    ([], [], BASE[:-1], False),
    ([], [], BASE.replace("v7", "v70"), False),
    ([], [], BASE.replace("v7", "v6") + "guide/start.html", False),
    ([], [], BASE.replace("manual.", "") + "guide/start.html", False),
    ([], [], BASE.replace("https", "http") + "guide/start.html", False),
    ([], [], None, False),
    ([], ["guide/"], BASE + "guide/start.html", False),
    ([], ["guide/"], BASE + "guidelines.html", True),
    (["guide/"], [], BASE + "guide/", True),
    (["guide/"], [], BASE + "guide", False),
    (["guide/"], [], BASE + "api/guide/", False),
    (["guide/", "api/v1."], [], BASE + "api/v1.verbs.html", True),
    (["guide/", "api/v1."], [], BASE + "api/v2.verbs.html", False),
    (["guide/start.html"], [], BASE + "guide/start.html", True),
    (["guide/"], [], BASE, True),
    (["guide/"], [], BASE + "index.html", True),
    (["guide/"], ["guide/old/"], BASE + "guide/old/a.html", False),
    (["guide/"], ["guide/old/"], BASE + "guide/older.html", True),
    (None, None, BASE + "guide/start.html", True),
]


def test_scope(spark):
    rows = spark.createDataFrame([(i, a, d, u) for i, (a, d, u, _) in enumerate(CASES)], "i int, allow array<string>, deny array<string>, url string")
    got = {r["i"]: r["ok"] for r in rows.select("i", urls.in_scope(F.col("url"), F.lit(BASE), F.col("allow"), F.col("deny")).alias("ok")).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[3] for c in CASES]


@pytest.mark.parametrize(("rel", "path"), [("", "index.md"), ("index.html", "index.md"), ("guide/", "guide/index.md"), ("guide/start.html", "guide/start.md"), ("b/c/index.html", "b/c/index.md"), ("x?y=1#z", "x"), ("reindex.html", "reindex.md"), ("a.html.html", "a.html.md")])
def test_relpath(spark, rel, path):
    assert crawl_path(BASE + rel, BASE) == path
    assert spark.range(1).select(urls.crawl_relpath(F.lit(BASE + rel), F.lit(BASE))).first()[0] == path


@given(st.lists(st.text("abc_.-", min_size=1, max_size=5).filter(lambda s: s.strip(".")), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_relative_links_lead_back(parts):
    target = "/".join(parts) + ".md"
    for here in ("index.md", "a/b/c.md", "abc/index.md"):
        assert urls.link_target(here, urls.relative_link(here, target).replace("%", "%25")) == target or ".." in parts


def test_columns(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(urls.canonical_route(F.lit("https://docs.example.org/latest/reports/cli-index/"))) == "/reports/cli-index/"
    assert one(urls.canonical_route(F.lit("https://docs.example.org/latest/reports/index/"))) == "/reports/"
    assert one(urls.permalink_relpath(F.lit("/reports/cli-index/"))) == "reports/cli-index/index.md"
    assert one(urls.decode_path(F.lit("a%20b+c"))) == "a b+c"
    text = "see https://github.com/o/r/blob/master/x and https://github.com/o/s/tree/master/y"
    assert one(urls.pin_refs(F.lit(text), "https://github.com/o/r", "c0ffee", ["master"])) == text.replace("r/blob/master", "r/blob/c0ffee")
    values = F.create_map(F.lit("v"), F.lit("2.19"))
    assert one(urls.fill_variables(F.lit("{{site.v}} {{ site.v }} {{site.w}}"), values)) == "2.19 2.19 {{site.w}}"
    assert one(urls.suffix_to_md(F.lit("a/b.mdx"))) == "a/b.md"
    assert one(urls.source_url(F.lit(None).cast("string"), F.lit("https://x/r"), F.lit("abc"), F.lit("d/e.md"))) == "https://x/r/blob/abc/d/e.md"
