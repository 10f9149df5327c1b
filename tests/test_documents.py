import pytest
from pyspark.sql import functions as F

from scriptorium.functions.decoding import decode_body
from scriptorium.functions.frontmatter import emit, fields, split_page
from scriptorium.functions.terms import terms
from scriptorium.operators.chunks import chunk_pages, sections
from scriptorium.operators.html_markdown import Renderer, parse_html, select
from scriptorium.operators.normalize import Options, file_page, heading, html_page
from scriptorium.operators.profiles import apply_profile
from scriptorium.operators.rst_markdown import rst_to_markdown

PAGE = '<!doctype html><meta charset="UTF-8"><title>Größe</title><h1>Größe – 大小</h1>'
PLAIN = "<h1>Größe – 大小</h1><p>naïve</p>"


@pytest.mark.parametrize(("content", "kind", "text"), [
    (PAGE.encode(), "text/html", PAGE),
    (PAGE.encode(), "text/html; charset=utf-8", PAGE),
    (PLAIN.encode(), "text/html", PLAIN),
    ('<meta charset="klingon-8">ž'.encode(), "text/html; charset=none-such", '<meta charset="klingon-8">ž'),
    ("é".encode("latin-1"), "text/html", "é"),
    ("é".encode("latin-1"), "text/html; charset=iso-8859-1", "é"),
    (b"\xff\xfea\x00", None, "a"),
    (b"a\xff", "text/plain; charset=utf-8", "a�"),
    (None, None, None),
])
def test_decoding(content, kind, text):
    assert decode_body(content, kind) == text


def markdown(html):
    return Renderer().document(parse_html(html))


@pytest.mark.parametrize(("html", "text"), [
    ("<h2>A <a class='headerlink' href='#a'>¶</a></h2><p>x\n  y</p>", "## A\n\nx\ny\n"),
    ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c\n"),
    ("<div class='admonition note'><p class='admonition-title'>Note</p><p>Mind.</p></div>", "> **Note:**\n>\n> Mind.\n"),
    ("<div class='highlight-yaml'><pre>a: 1\n  b</pre></div>", "```yaml\na: 1\n  b\n```\n"),
    ("<pre>```\nx</pre>", "````\n```\nx\n````\n"),
    ("<table><tr><th>A</th><th>B</th></tr><tr><td>1|2</td><td><b>x</b></td></tr></table>", "| A | B |\n| --- | --- |\n| 1\\|2 | **x** |\n"),
    ("<dl><dt>t</dt><dd><p>d</p></dd><dt>u</dt><dd>e</dd></dl>", "t\n:   d\n\nu\n:   e\n"),
    ("<blockquote><p>q</p><p>r</p></blockquote>", "> q\n>\n> r\n"),
    ("<p><a href='https://x.org'>https://x.org</a> <a href='y.html'>y</a> <code>a`b</code></p>", "<https://x.org> [y](y.html) ``a`b``\n"),
    ("<p>a<script>var t='</p>';</script><style>p{}</style>b</p>", "ab\n"),
    ("<p><b>open<p>next</p>", "open\n\nnext\n"),
    ("<img alt='i' src='a.png'>", "![i](a.png)\n"),
    ("", "\n"),
])
def test_html(html, text):
    assert markdown(html) == text


def test_selectors():
    root = parse_html("<div class='body x' role=main id=m><p>1</p></div><article>2</article>")
    assert select(root, "div.body[role=main]").text() == "1"
    assert select(root, "main, article").text() == "2"
    assert select(root, ".x p").tag == "p"
    assert select(root, "#m").tag == "div"
    assert select(root, "section") is None


def test_html_page_links_and_title():
    html = "<title>T</title><main><h1>Head <a class=headerlink href='#'>¶</a></h1><a href='../x.html#f'>x</a> <a href='https://o.org/'>o</a></main>"
    title, body = html_page(html, "div.none", "https://d.org/1/a/b.html", "https://d.org/1/")
    assert title == "Head"
    assert "[x](../x.md#f)" in body and "[o](https://o.org/)" in body


@pytest.mark.parametrize(("heading", "title"), [
    ("Using C#", "Using C#"),
    ("here,###", "here,###"),
    ("C# <a class=headerlink href='#c'>#</a>", "C#"),
    ("<a href='#c'>¶</a> F# ¶", "F#"),
    ("A <a href='x'>B#</a>", "A B#"),
])
def test_a_hash_is_part_of_a_title(heading, title):
    assert html_page(f"<title>T</title><h1>{heading}</h1>")[0] == title


@pytest.mark.parametrize(("rst", "text"), [
    ("Title\n=====\n\nSub\n---\n\ntext\n", "# Title\n\n## Sub\n\ntext\n"),
    (".. note:: Mind\n   this.\n", "> **Note:**\n>\n> Mind\n> this.\n"),
    ("Run::\n\n  a b\n    c\n\nDone.\n", "Run:\n\n```\na b\n  c\n```\n\nDone.\n"),
    (".. code-block:: python\n   :linenos:\n\n   x = 1\n", "```python\nx = 1\n```\n"),
    ("- a\n- b\n\n  c\n", "- a\n\n- b\n\n  c\n"),
    ("`X <https://x.org>`_ and ``code``\n", "[X](https://x.org) and `code`\n"),
    (":ref:`there`\n", "there <!-- unresolved-rst-link: kind=ref target=there -->\n"),
    ("==== ====\nA    B\n==== ====\n1    2\n==== ====\n", "| A | B |\n| --- | --- |\n| 1 | 2 |\n"),
    (".. toctree::\n   :maxdepth: 1\n\n   a\n", ".. toctree::\n   :maxdepth: 1\n\n   a\n"),
    (".. _label:\n\n.. a comment\n\nx\n", "x\n"),
])
def test_rst(rst, text):
    assert rst_to_markdown(rst) == text


@pytest.mark.parametrize(("profile", "source", "parts"), [
    ("", "{{< note >}}\nMind.\n{{< /note >}}", ["> **Note:**\n>\n> Mind."]),
    ("", '{{< glossary_tooltip text="Pod" term_id="pod" >}}s', ["Pods"]),
    ("", '{{% tab name="User" %}}\nx\n{{% /tab %}}', ["**Tab: User**", "x"]),
    ("", "> [!warning]\n> Hot.", ["> **Warning:**\n>\n> Hot."]),
    ("istio", "{{< tip >}}\nA\n```sh\n{{< x >}}\n```\n{{< /tip >}}", ["> **Tip:**", "> ```sh\n> {{< x >}}\n> ```"]),
    ("gitbook", '{% hint style="danger" %}\nNo.\n{% endhint %}', ["> **Danger:**\n>\n> No."]),
    ("gitbook", '{% tabs %}\n{% tab title="a.conf" %}\nx\n{% endtab %}\n{% endtabs %}', ["**Tab: a.conf**", "x"]),
    ("jekyll", "{% raw %}{{ x }}{% endraw %}\n{: .note }", ["{{ x }}\n{: .note }"]),
    ("opencode", "import X from 'y'\n\n<Note>Hi</Note>", ["**Note:**\n\nHi"]),
    ("prometheus-operator", "```yaml mdox-exec\nx\n```", ["```yaml mdox-exec\nx\n```"]),
])
def test_profiles(profile, source, parts):
    made = apply_profile(source, profile)
    assert all(p in made for p in parts), made


def test_unknown_profile():
    with pytest.raises(ValueError):
        apply_profile("x", "none")


def test_frontmatter():
    text = '---\ncollection: a\nversion: "8"\nnav_order: 20\nhas_toc: false\nredirect_from: ["/x/"]\ncards: [{"heading":"h"}]\ntitle: "T: x"\n---\nbody\n'
    block, body = split_page(text)
    got = fields(block)
    assert (body, got["version"], got["nav_order"], got["has_toc"], got["redirect_from"], got["title"]) == ("body\n", "8", 20, False, ["/x/"], "T: x")
    assert got["extra"] == {"cards": '[{"heading": "h"}]'}
    assert fields(split_page(emit({"collection": "a", "version": "2.19", "title": 'q"'}))[0])["version"] == "2.19"
    assert split_page("no block") == ("", "no block")
    assert fields("title: [broken\nversion: 6")["version"] == "6"


def test_sections(spark):
    body = "pre\n# A\nx\n```\n# no\n```\n## B #\ny\n# C\n"
    assert [(p, n) for p, n, _ in sections(body)] == [([], 0), (["A"], 1), (["A", "B"], 2), (["C"], 1)]
    rows = spark.createDataFrame([("c", "1", "a.md", "T", "u", "h", body), ("c", "1", "_index.md", "Empty", "u2", "h2", "")], "collection string, version string, relpath string, title string, source_url string, body_md5 string, body string")
    got = {r["chunk_id"]: r for r in chunk_pages(rows).collect()}
    assert set(got) == {f"c/1/a.md#{i}" for i in range(4)} | {"c/1/_index.md#0"}
    assert got["c/1/_index.md#0"]["text"] == "Empty" and got["c/1/a.md#2"]["heading_path"] == ["A", "B"]


def test_terms(spark):
    got = spark.range(1).select(terms(F.lit("Pod-Security, 說明文 x"))).first()[0]
    assert sorted(got) == sorted(["pod", "security", "說明文", "x", "說明", "明文"])
    assert spark.range(1).select(terms(F.lit(None).cast("string"))).first()[0] == []


def test_file_pages():
    options = Options(None, None, True, {"v": "2"}, "https://x/r", "abc", ["main"])
    page = file_page("---\ntitle: Front\ndescription: D\n---\n", "markdown", "a/b.md", options)
    assert (page["title"], page["body"], page["description"]) == ("Front", "D\n", "D")
    page = file_page("{{ site.v }} https://x/r/blob/main/y\n", "markdown", "a/stem.md", options)
    assert (page["title"], page["body"]) == ("stem", "2 https://x/r/blob/abc/y\n")
    assert file_page("Head\n====\n", "rst", "x.md", options)["title"] == "Head"
    assert file_page("<title>T</title><main>x</main>", "html", "x.md", options)["title"] == "T"
    assert heading("```\n# no\n```\n# `Yes` [a](b)\n") == "Yes a"


def test_jekyll_pages():
    text = '---\ntitle: CLI\npermalink: /reporting/index/\nnav_order: 10\nredirect_from: [/old/]\ncards: [{"heading": "H", "link": "/x/", "description": "D"}]\n---\nBody\n'
    page = file_page(text, "markdown", "_reporting/cli.md", Options(profile="jekyll", variables={"site_url": "https://d.org/latest"}))
    assert (page["permalink"], page["nav_order"], page["redirect_from"], page["canonical_route"]) == ("/reporting/index/", 10, ["/old/"], "/reporting/")
    assert page["body"] == "Body\n\n- [H](/x/): D\n"
