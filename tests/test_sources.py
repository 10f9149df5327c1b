import os

import pytest
from pyspark.sql import functions as F

from scriptorium.operators.normalize import normalize_checkout, normalize_crawl
from scriptorium.sources.archive import crawl, page_links
from scriptorium.sources.checkout import listed_files, openapi_operations, read_checkout
from scriptorium.sources.manifests import parse_manifest, read_manifests
from scriptorium.streaming.refresh import refresh_from

GIT = 'name = "a-1"\ncollection = "a"\nversion = "1.0"\nsource_type = "git"\nrepo_url = "https://h/r"\ngit_ref = "c0ffee"\ndocs_paths = ["docs", "README.md"]\nexclude_globs = ["skip/*"]\n[site_overrides]\nv = "2"\n'
CRAWL = 'name = "b-2"\ncollection = "b"\nversion = "2"\nbase_url = "https://d.org/2/"\ncontent_selector = "main"\ndeny_prefixes = ["no/"]\nmax_pages = 10\ndelay_seconds = 0.3\n'


def test_manifests(spark, tmp_path):
    (tmp_path / "a.toml").write_text(GIT)
    (tmp_path / "b.toml").write_text(CRAWL)
    a, b = read_manifests(spark, str(tmp_path)).orderBy("name").collect()
    assert (a["version"], a["source_type"], a["site_overrides"], a["allow_prefixes"]) == ("1.0", "git", {"v": "2"}, [])
    assert (b["source_type"], b["max_pages"], b["delay_seconds"], b["deny_prefixes"]) == ("crawl", 10, 0.3, ["no/"])
    with pytest.raises(ValueError):
        parse_manifest('name = "x"')


@pytest.fixture
def checkout(tmp_path):
    for path, text in {
        "docs/a.md": "# A\n\n{{ site.v }}\n", "docs/_b.rst": "B\n=\n", "docs/skip/c.md": "no", "docs/README.md": "# Inner\n", "README.md": "# Outer\n", "docs/d.html": "<title>D</title><main>x</main>",
        "docs/api.json": '{"paths": {"/x": {"get": {"summary": "S"}}}}', "docs/e.png": "no", "other/f.md": "# F\n",
    }.items():
        (tmp_path / "r" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "r" / path).write_text(text)
    (tmp_path / "outside.md").write_text("secret")
    os.symlink("../other/f.md", tmp_path / "r/docs/link.md")
    os.symlink(tmp_path / "outside.md", tmp_path / "r/docs/leak.md")
    return str(tmp_path / "r")


def test_checkout(spark, checkout):
    m = parse_manifest(GIT)
    found = dict(listed_files(checkout, m["docs_paths"], m["exclude_globs"]))
    assert found == {"docs/a.md": "a.md", "docs/_b.rst": "_b.md", "docs/README.md": "docs/README.md", "README.md": "README.md", "docs/d.html": "d.md", "docs/api.json": "api.json", "docs/link.md": "link.md"}
    files = read_checkout(spark, checkout, m["docs_paths"], m["exclude_globs"])
    pages = {r["relpath"]: r for r in normalize_checkout(files, m, "2026-01-02T03:04:05+08:00").collect()}
    assert set(pages) == {"a.md", "_b.md", "docs/README.md", "README.md", "d.md", "link.md"}
    assert pages["a.md"]["body"] == "# A\n\n2\n" and pages["a.md"]["source_url"] == "https://h/r/blob/c0ffee/docs/a.md"
    assert (pages["_b.md"]["title"], pages["d.md"]["title"], pages["a.md"]["version"]) == ("B", "D", "1.0")
    assert [(r["route"], r["verb"], r["summary"]) for r in openapi_operations(files).collect()] == [("/x", "get", "S")]


def html(*targets):
    return "<title>t</title><main><h1>H</h1>" + "".join(f'<a href="{t}">x</a>' for t in targets) + "</main>"


def test_crawl(spark):
    base = "https://d.org/2/"
    rows = [(base, html("a.html", "no/x.html", "https://o.org/", "mailto:x@y")), (base + "a.html", html("b/", "../2/c.html", "/2/")), (base + "b/", html("../a.html")), (base + "c.html", ""), (base + "no/x.html", ""), (base + "alone.html", "")]
    archive = spark.createDataFrame(rows, "url string, html string")
    got = [(r["url"], r["level"]) for r in crawl(archive, base, [], ["no/"], 10).collect()]
    assert got == [(base, 0), (base + "a.html", 1), (base + "b/", 2), (base + "c.html", 2)]
    assert len(crawl(archive, base, [], ["no/"], 2).collect()) == 2
    assert (base + "b/", base + "a.html") in {tuple(r) for r in page_links(archive).collect()}
    raw = archive.select("url", F.encode("html", "UTF-8").alias("content"), F.lit("text/html").alias("content_type"), F.current_timestamp().alias("fetched_at"))
    pages = {r["relpath"]: r for r in normalize_crawl(raw, parse_manifest(CRAWL)).collect()}
    assert set(pages) == {"index.md", "a.md", "b/index.md", "c.md", "alone.md"}
    assert pages["index.md"]["title"] == "H" and "[x](a.md)" in pages["index.md"]["body"] and pages["c.md"]["title"] == "c"


def test_crawl_follows_long_chains(spark):
    """Next-page links beyond 64 levels, with a link back; the cap alone ends the crawl early."""
    base = "https://d.org/2/"
    rows = [(base, html("p1.html"))] + [(f"{base}p{i}.html", html(f"p{i + 1}.html", "p1.html")) for i in range(1, 71)]
    archive = spark.createDataFrame(rows, "url string, html string").coalesce(1).cache()
    assert [(r["url"], r["level"]) for r in crawl(archive, base, [], [], 1000).collect()] == [(u, n) for n, (u, _) in enumerate(rows)]
    assert len(crawl(archive, base, [], [], 3).collect()) == 3
    assert crawl(archive, "https://d.org/none/", [], [], 10).count() == 0


def test_stream(spark, checkout, tmp_path):
    incoming, pages, folder, mark = (str(tmp_path / x) for x in ("in", "pages", "index", "mark"))
    m = parse_manifest(GIT)
    first = normalize_checkout(read_checkout(spark, checkout, m["docs_paths"], []), m, "2026-01-02T03:04:05+08:00")
    first.write.parquet(incoming)
    refresh_from(spark, incoming, pages, folder, mark).awaitTermination()
    n = spark.read.parquet(f"{folder}/chunks").count()
    changed = first.where("relpath = 'a.md'").withColumn("body", F.lit("# A\n\nnew\n\n## More\n\nx")).withColumn("fetched_at_raw", F.lit("2027"))
    changed.withColumn("body_md5", F.md5(F.col("body").cast("binary"))).write.mode("append").parquet(incoming)
    refresh_from(spark, incoming, pages, folder, mark).awaitTermination()
    assert spark.read.parquet(f"{folder}/chunks").count() == n + 1
    assert spark.read.parquet(f"{folder}/postings").where("term = 'new'").count() == 1
