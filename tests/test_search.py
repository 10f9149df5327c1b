import io
import json
import math

import pytest

from scriptorium import serve
from scriptorium.operators import audit, index, links, rpc, search
from scriptorium.operators.chunks import chunk_pages
from scriptorium.schema import ARCHIVE
from scriptorium.sources.corpus import page_row, read_corpus, write_corpus

FRONT = '---\ncollection: {c}\nversion: "{v}"\ntitle: "{t}"\nsource_url: https://x.org/{c}/{v}/{r}\nfetched_at: 2026-07-28T01:05:05+00:00\n---\n'
FILES = {
    "k8s/1.31/_index.md": ("Home", ""),
    "k8s/1.31/pods.md": ("Pods", "# Pods\n\nA pod runs containers. See [svc](svc.md) and [gone](gone.md).\n\n## Limits\n\nPod limits apply.\n"),
    "k8s/1.31/svc.md": ("Services", "# Services\n\nA service selects pods.\n"),
    "k8s/1.30/pods.md": ("Pods", "# Pods\n\nOld pod text about pod pod.\n"),
    "ceph/19/index.md": ("Ceph", "# Ceph\n\nStorage 說明文件 for blocks.\n"),
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("corpus")
    for path, (title, body) in FILES.items():
        c, v, r = path.split("/", 2)
        (top / path).parent.mkdir(parents=True, exist_ok=True)
        (top / path).write_text(FRONT.format(c=c, v=v, t=title, r=r) + body, encoding="utf-8")
    return str(top)


@pytest.fixture(scope="module")
def pages(spark, root):
    return read_corpus(spark, root).cache()


@pytest.fixture(scope="module")
def tool(spark, pages, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    index.build(pages, folder)
    return search.Search.open(spark, folder)


def test_corpus_round_trip(spark, root, pages, tmp_path):
    assert {r["path"] for r in pages.collect()} == set(FILES)  # names with a leading underscore too
    assert pages.where("collection = 'k8s' and version = '1.30'").count() == 1
    assert dict(pages.dtypes)["version"] == "string"
    write_corpus(pages, str(tmp_path))
    again = read_corpus(spark, str(tmp_path))
    assert sorted(map(str, again.drop("fetched_at").collect())) == sorted(map(str, pages.drop("fetched_at").collect()))
    assert page_row("a/1/x.md", "no frontmatter")[2] == "1"


def test_search(tool):
    got = tool.search_docs("pod", "k8s", "1.31").collect()
    assert [r["chunk_id"] for r in got] == ["k8s/1.31/pods.md#1", "k8s/1.31/pods.md#0"] or {r["chunk_id"] for r in got} == {"k8s/1.31/pods.md#0", "k8s/1.31/pods.md#1"}
    assert all(r["version"] == "1.31" for r in got)
    n, df, tf = 4, 2, 2
    dl = {r["chunk_id"]: r["n_terms"] for r in tool.chunks.where("version = '1.31'").collect()}
    one = "k8s/1.31/pods.md#1"
    want = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl[one] / (sum(dl.values()) / n)))
    tf_of = {r["chunk_id"]: r["tf"] for r in tool.posts.where("term = 'pod' and version = '1.31'").collect()}
    assert tf_of[one] in (1, 2)
    got_one = next(r["score"] for r in got if r["chunk_id"] == one)
    tf = tf_of[one]
    want = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl[one] / (sum(dl.values()) / n)))
    assert got_one == pytest.approx(want, abs=1e-5)
    assert [r["chunk_id"] for r in tool.search_docs("明文").collect()] == ["ceph/19/index.md#0"]


@pytest.mark.parametrize("bad", [{"query": ""}, {"query": "pod", "limit": 0}, {"query": "pod", "limit": 51}, {"query": "pod", "limit": True}, {"query": "pod", "version": "9"}, {"query": "pod", "collection": "none"}])
def test_search_rejects(tool, bad):
    with pytest.raises(ValueError):
        tool.search_docs(**bad)


def test_lookup_and_listing(tool):
    assert tool.get_section("k8s/1.31/_index.md#0").first()["text"] == "Home"
    assert [(r["collection"], r["version"], r["pages"]) for r in tool.list_collections().collect()] == [("ceph", "19", 1), ("k8s", "1.30", 1), ("k8s", "1.31", 3)]


def test_refresh(spark, pages, tmp_path):
    folder = str(tmp_path / "index")
    index.build(pages, folder)
    from pyspark.sql import functions as F

    changed = pages.where("version <> '1.30'").withColumn("body", F.when(F.col("relpath") == "svc.md", F.lit("# New\n\nword")).otherwise(F.col("body")))
    changed = changed.withColumn("body_md5", F.md5(F.col("body").cast("binary")))
    diff = {(r["relpath"], r["version"]): r["change"] for r in index.refresh(changed, folder).collect()}
    assert diff == {("svc.md", "1.31"): "changed", ("pods.md", "1.30"): "removed"}
    renamed = changed.withColumn("title", F.when(F.col("relpath") == "pods.md", F.lit("Other")).otherwise(F.col("title"))).withColumn("source_url", F.when(F.col("collection") == "ceph", F.lit("https://new/")).otherwise(F.col("source_url")))
    assert {(r["relpath"], r["change"]) for r in index.refresh(renamed, folder).collect()} == {("pods.md", "changed"), ("index.md", "changed")}
    assert {r["title"] for r in search.Search.open(spark, folder).chunks.where("relpath = 'pods.md'").collect()} == {"Other"}
    assert index.refresh(changed, folder).count() == 2
    left = spark.read.parquet(f"{folder}/chunks")
    want = chunk_pages(changed)
    assert sorted(r["chunk_id"] + r["text"] for r in left.collect()) == sorted(r["chunk_id"] + r["text"] for r in want.collect())
    assert spark.read.parquet(f"{folder}/postings").where("version = '1.30'").count() == 0


def test_postings_count_terms(spark):
    rows = [("a", "b c b  b"), ("b", ""), ("c", None), ("d", "x"), ("e", "說明文件 x x")]
    chunks = spark.createDataFrame(rows, "chunk_id string, text string").selectExpr("chunk_id", "'c' as collection", "'1' as version", "text")
    got = {(r["chunk_id"], r["term"]): r["tf"] for r in index.postings(chunks).collect()}
    assert got == {("a", "b"): 3, ("a", "c"): 1, ("d", "x"): 1, ("e", "說明文件"): 1, ("e", "說明"): 1, ("e", "明文"): 1, ("e", "文件"): 1, ("e", "x"): 2}


def test_server(tool):
    out = io.StringIO()
    serve.run(tool, ['{"id":1,"method":"tools/call","params":{"name":"get_section","arguments":{"chunk_id":"k8s/1.31/_index.md#0"}}}\n', "\n", '{"id":2,"method":"ping"}\n'], out)
    one, two = (json.loads(x) for x in out.getvalue().splitlines())
    assert json.loads(one["result"]["content"][0]["text"])["text"] == "Home" and two == {"jsonrpc": "2.0", "id": 2, "result": {}}
    assert serve.main([]) == 2


def test_build(spark, tmp_path):
    """From manifests, a checkout and an archive to answers: a marked dead link, a link that another collection owns, a second build that adds."""
    from scriptorium.plans.build import build

    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.toml").write_text('name = "tool-1"\ncollection = "tool"\nversion = "1"\nsource_type = "git"\nrepo_url = "https://git.example.org/tool"\ngit_ref = "c0ffee"\ndocs_paths = ["docs"]\n')
    (tmp_path / "m/b.toml").write_text('name = "site-2"\ncollection = "site"\nversion = "2"\nbase_url = "https://site.example.org/"\n')
    (tmp_path / "m/c.toml").write_text('name = "later"\ncollection = "later"\nversion = "1"\nsource_type = "git"\nrepo_url = "https://git.example.org/later"\ngit_ref = "f00"\ndocs_paths = ["."]\nshortcode_profile = "jekyll"\n[site_overrides]\nsite_url = "https://later.example.org"\n')
    (tmp_path / "src/docs").mkdir(parents=True)
    (tmp_path / "src/docs/one.md").write_text("# One\n\n[gone](none.md) [kept](two.md) [far](/far/)\n")
    (tmp_path / "src/docs/two.md").write_text("# Two\n\nbody\n")
    (tmp_path / "far").mkdir()
    (tmp_path / "far/p.md").write_text("---\ntitle: Far\npermalink: /far/\n---\nelsewhere\n")
    page = lambda body: f"<main><h1>S</h1>{body}</main>".encode()
    fetched = spark.createDataFrame([("https://site.example.org/", None, page("<a href='x/../x/y.html'>y</a>"), "text/html", None), ("https://site.example.org/x/y.html", None, page("<p>reached</p>"), "text/html", None), ("https://site.example.org/alone.html", None, page("no"), "text/html", None)], ARCHIVE)
    sources = {"tool-1": str(tmp_path / "src"), "site-2": fetched}
    where = [str(tmp_path / "m"), sources, str(tmp_path / "corpus"), str(tmp_path / "index"), "2026-01-01T00:00:00+00:00"]
    assert sorted(r["path"] for r in build(spark, *where).collect()) == ["site/2/index.md", "site/2/x/y.md", "tool/1/one.md", "tool/1/two.md"]
    sources["later"] = str(tmp_path / "far")
    bodies = {r["path"]: r["body"] for r in build(spark, *where).collect()}
    assert "[gone](none.md) <!-- unresolved-source-link: target=none.md --> [kept](two.md) [far](/far/) <!-- cross-corpus-link: owner=later/1 -->" in bodies["tool/1/one.md"]
    found = search.Search.open(spark, where[3])
    assert [r["chunk_id"] for r in found.search_docs("reached").collect()] == ["site/2/x/y.md#0"]
    assert [r["collection"] for r in found.list_collections().collect()] == ["later", "site", "tool"]
    with pytest.raises(ValueError, match="source"):
        build(spark, where[0], {}, *where[2:])


def test_links(spark, pages):
    found = links.markdown_links(pages)
    assert {(r["link"], r["resolved"]) for r in links.resolve(found, pages).collect()} == {("svc.md", True), ("gone.md", False)}
    body = links.mark_unresolved(pages).where("relpath = 'pods.md' and version = '1.31'").first()["body"]
    assert "[gone](gone.md) <!-- unresolved-source-link: target=gone.md -->" in body and "[svc](svc.md) and" in body
    assert links.leaves_version(found).count() == 0
    kinds = "collection string, version string, relpath string, permalink string, canonical_url string, canonical_route string, redirect_from array<string>"
    site = spark.createDataFrame([("a", "1", "x/index.md", "/x/", "https://d.org/latest/x/", None, ["/x/", "/old/"]), ("b", "1", "y/index.md", "/y/", "https://d.org/latest/y/", "/y/", None), ("b", "1", "z.md", None, None, "/y/", None)], kinds)
    assert {(r["route"], r["via"]) for r in links.routes(site).where("collection = 'a'").collect()} == {("/x/", "canonical"), ("/x/", "permalink"), ("/old/", "redirect")}
    assert {r["relpath"]: r["canonical_collision"] for r in links.collisions(site).collect()} == {"x/index.md": False, "y/index.md": True, "z.md": True}
    from_a = spark.createDataFrame([("a", "1", "x/index.md", 0, "l", "/y/#f", None)], "collection string, version string, relpath string, ordinal int, label string, link string, target string")
    assert [r["owner"] for r in links.cross_corpus(from_a, site).collect()] == ["b", "b"][:1]


def test_audit(spark, pages):
    assert audit.violations(pages).count() == 0
    assert audit.exact_duplicates(pages.unionByName(pages)).count() == 5
    manifests = spark.createDataFrame([("k8s", "1.31"), ("k8s", "9")], "collection string, version string")
    assert [r["version"] for r in audit.uncovered(manifests, pages).collect()] == ["9"]


def test_grep_and_compare(tool, pages):
    assert [(r["path"], r["line"]) for r in search.grep(pages, "Old").collect()] == [("k8s/1.30/pods.md", 3)]
    assert {r["strategy"] for r in search.compare(tool, pages, ["service"]).collect()} == {"grep", "search"}


LINES = [
    ("", None), ("x" * 1_000_001, -32600), ("{bad", -32700), ("[1]", -32600), ("3", -32600), ('{"method":"ping"}', None), ('{"id":null,"method":"ping"}', None),
    ('{"id":1,"method":"ping"}', 0), ('{"id":2,"method":"initialize","params":{"protocolVersion":"2024-11-05"}}', 0), ('{"id":3,"method":"initialize"}', 0),
    ("\t", None), (" \t\u00a0\r\u2003", None), ('\t{"id":8,"method":"ping"}\t\r', 0), ('{"id":4,"method":"tools/list"}', 0), ('{"id":5,"method":"tools/call","params":[1]}', -32602), ('{"id":6,"method":"nope"}', -32601),
]


def test_rpc_lines(spark, tool):
    call = lambda name, args: rpc.dispatch(tool, name, args)
    got = [json.loads(x) for x in rpc.serve(call, [x for x, _ in LINES])]
    assert [g["error"]["code"] if "error" in g else 0 for g in got] == [c for _, c in LINES if c is not None]
    assert [g["result"]["protocolVersion"] for g in got if g.get("id") in (2, 3)] == ["2024-11-05", "2025-06-18"]
    replayed = rpc.replay(spark.createDataFrame([(i, x) for i, (x, _) in enumerate(LINES)], "i int, line string")).orderBy("i").collect()
    assert [r["code"] if r["outcome"] == "error" else 0 if r["outcome"] == "answered" else None for r in replayed] == [c for _, c in LINES]


@pytest.mark.parametrize(("name", "args", "code", "failed"), [
    ("search_docs", {"query": "pod", "collection": None}, None, False), ("search_docs", {"query": "pod", "limit": "8"}, -32602, None), ("search_docs", {}, -32602, None),
    ("get_section", {"chunk_id": "k8s/1.31/svc.md#0"}, None, False), ("get_section", {"chunk_id": "none"}, -32602, None), ("list_collections", None, None, False),
    ("list_collections", {"x": 1}, -32602, None), ("other", {}, -32602, None),
])
def test_rpc_calls(tool, name, args, code, failed):
    message = {"id": 1, "method": "tools/call", "params": {"name": name, "arguments": args}}
    got = rpc.answer(lambda n, a: rpc.dispatch(tool, n, a), message)
    assert got.get("error", {}).get("code") == code
    if failed is not None:
        assert got["result"]["isError"] is failed and json.loads(got["result"]["content"][0]["text"])


def test_rpc_failure():
    def broken(name, args):
        raise RuntimeError("down")

    got = rpc.answer(broken, {"id": 1, "method": "tools/call", "params": {"name": "x"}})
    assert got["result"] == {"content": [{"type": "text", "text": "error: down"}], "isError": True}


def test_site_routes_and_assets(spark):
    assert links.pin_assets("![a](img/x%20y.png) ![b](/z.png) ![c](https://o/c.png)", "docs/p.md", "https://h/r", "c0ffee") == "![a](https://h/r/blob/c0ffee/docs/img/x%20y.png) ![b](/z.png) ![c](https://o/c.png)"
    kinds = "collection string, version string, relpath string, permalink string, canonical_url string, canonical_route string, redirect_from array<string>, body string"
    rows = [("a", "1", "x/index.md", "/x/", None, "/x/", ["/old/"], "[y](/y/#f) [o](/old) [n](/none/) [r](z.md)"), ("a", "1", "y/index.md", "/y/", None, "/y/", None, None), ("a", "2", "none/index.md", "/none/", None, "/none/", None, "")]
    got = {r["relpath"]: r["body"] for r in links.localize_routes(spark.createDataFrame(rows, kinds), "https://s.org/").collect()}
    assert got["x/index.md"] == "[y](../y/index.md#f) [o](index.md) [n](https://s.org/none/) <!-- unresolved-site-link: route=/none/ --> [r](z.md)"
