"""From raw documents to pages: file kinds, profiles, titles, links and provenance."""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import urls
from scriptorium.functions.decoding import decode_body
from scriptorium.functions.frontmatter import fields, split_page
from scriptorium.operators.html_markdown import Renderer, clean_title, parse_html, select, title_of
from scriptorium.operators.links import pin_assets
from scriptorium.operators.profiles import apply_profile
from scriptorium.operators.rst_markdown import rst_to_markdown
from scriptorium.schema import PAGES, columns


def heading(body: str) -> str | None:
    """The first level-one heading outside fences."""
    fence = None
    for line in body.split("\n"):
        if m := re.match(r"\s*(```+|~~~+)", line):
            fence = None if fence and line.strip().startswith(fence) else fence or m[1]
        elif not fence and (m := re.match(r"# +(.+?)\s*#*\s*$", line)):
            return clean_title(m[1])
    return None


def html_page(html: str, selector: str | None = None, url: str = "", base: str = "") -> tuple[str, str]:
    """Title and Markdown of an HTML page: its content node, with links under base made relative to .md pages.

    Without a selector, or where it fits nothing, the content is <main>, <article>, or <body>.
    """
    root = parse_html(html)
    main = (select(root, selector) if selector else None) or select(root, "main") or select(root, "article") or select(root, "body") or root

    def link(href: str) -> str:
        full, _, fragment = urls.join_url(url, href).partition("#")
        if not base or not full.startswith(base):
            return urls.join_url(url, href) if url else href
        here, there = (crawl_path(x, base) for x in (url, full))
        return urls.relative_link(here, there) + (f"#{fragment}" if fragment else "")

    return title_of(root, main), Renderer(link=link).document(main)


def crawl_path(url: str, base: str) -> str:
    """The driver-side twin of urls.crawl_relpath."""
    rel = re.sub(r"[?#].*$", "", url[len(base) :])
    return re.sub(r"\.html$", ".md", re.sub(r"(^|/)(index\.html)?$", r"\1index.md", rel, count=1))


@dataclass
class Options:
    """What a manifest says about normalisation."""

    profile: str | None = None
    selector: str | None = None
    preserve_description: bool = False
    variables: dict[str, str] = field(default_factory=dict)
    repo_url: str = ""
    git_ref: str = ""
    mutable_refs: list[str] = field(default_factory=list)


def file_page(text: str, kind: str, relpath: str, options: Options) -> dict[str, object]:
    """Title, body and kept source keys of one source file of a checkout."""
    block, body = split_page(text)
    source = fields(block)
    title = source.get("title")
    if kind == "html":
        title, body = html_page(text, options.selector)
    elif kind == "rst":
        body = rst_to_markdown(text)
        title = heading(body)
    else:
        body = apply_profile(body, options.profile)
        for name, value in options.variables.items():
            body = re.sub(rf"\{{\{{\s*site\.{re.escape(name)}\s*\}}\}}", lambda _, v=value: v, body)
    if options.mutable_refs and options.repo_url:
        refs = "|".join(map(re.escape, options.mutable_refs))
        body = re.sub(rf"({re.escape(options.repo_url)}/(?:-/)?(?:blob|tree|raw)/)(?:{refs})(?=/|$|[)#?\s])", lambda m: m[1] + options.git_ref, body)
    title = clean_title(str(title)) if title else None
    stem = posixpath.splitext(posixpath.basename(relpath))[0]
    description = source.get("description") if options.preserve_description else None
    if description and not body.strip():
        body = f"{description}\n"
    page = {"title": title or heading(body) or stem, "body": body, "description": description}
    if options.profile == "jekyll":
        page |= jekyll_fields(source, options)
        page["body"] += card_links(source.get("extra") or {})
    return page


#: Source keys that pages of the Jekyll renderer keep.
JEKYLL_KEYS = ("permalink", "redirect_from", "layout", "nav_order", "parent", "grand_parent", "has_children", "has_toc", "nav_exclude")


def jekyll_fields(source: dict[str, object], options: Options) -> dict[str, object]:
    """Route and navigation columns; a page's canonical URL is the site's root and its permalink."""
    kept = {k: source.get(k) for k in JEKYLL_KEYS}
    url = source.get("canonical_url") or (options.variables.get("site_url", "").rstrip("/") + str(kept["permalink"]) if kept["permalink"] and options.variables.get("site_url") else None)
    route = None
    if url:
        path = re.sub(r"^/latest(?=/)", "", re.sub(r"^[a-z]+://[^/]+", "", str(url)))
        route = re.sub(r"(^|/)index/$", r"\1", path)
    return kept | {"renderer": "jekyll", "canonical_url": url, "canonical_route": route, "canonical_collision": False}


def card_links(extra: dict[str, str]) -> str:
    """Data cards of a page (lists of heading, link and description) as a list of links."""
    out = []
    for name in sorted(extra):
        if name.endswith("cards"):
            try:
                cards = json.loads(extra[name])
            except ValueError:
                continue
            out += [f"- [{c['heading']}]({c['link']})" + (f": {c['description']}" if c.get("description") else "") for c in cards if isinstance(c, dict) and c.get("heading") and c.get("link")]
    return "\n" + "\n".join(out) + "\n" if out else ""


def page_frame(rows: Iterator[dict]) -> pd.DataFrame:
    names = [n for n, _ in columns(PAGES)]
    out = []
    for row in rows:
        row["path"] = f"{row['collection']}/{row['version']}/{row['relpath']}"
        row["body_md5"] = hashlib.md5(row["body"].encode()).hexdigest()
        row["extra"] = {}
        out.append([row.get(n) for n in names])
    return pd.DataFrame(out, columns=names)


def normalize_crawl(archive: DataFrame, manifest: dict) -> DataFrame:
    """archive(url, content, content_type, fetched_at) to rows of the page schema, for pages in the manifest's scope.

    The scope is a filter on columns before any page is opened; parsing runs in Arrow batches and needs no exchange.
    """
    base, selector = manifest["base_url"], manifest.get("content_selector")
    strings = lambda k: F.array(*map(F.lit, manifest.get(k) or [])).cast("array<string>")
    scoped = archive.where(urls.in_scope(F.col("url"), F.lit(base), strings("allow_prefixes"), strings("deny_prefixes")))
    facts = {k: manifest.get(k) for k in ("collection", "version", "app_version")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for url, content, kind, at in zip(b["url"], b["content"], b["content_type"], b["fetched_at"], strict=True):
                title, body = html_page(decode_body(content, kind) or "", selector, url, base)
                made.append(facts | {"relpath": crawl_path(url, base), "source_url": url, "title": title or posixpath.splitext(posixpath.basename(crawl_path(url, base)))[0], "body": body, "fetched_at": at, "fetched_at_raw": None if pd.isna(at) else at.isoformat()})
            yield page_frame(iter(made))

    return scoped.select("url", "content", "content_type", "fetched_at").mapInPandas(run, PAGES)


def normalize_checkout(files: DataFrame, manifest: dict, fetched_at: str) -> DataFrame:
    """files(source_path, relpath, kind, content) of a checkout to rows of the page schema; OpenAPI files give none."""
    options = Options(manifest.get("shortcode_profile"), manifest.get("content_selector"), bool(manifest.get("preserve_description")), dict(manifest.get("site_overrides") or {}), manifest["repo_url"], manifest["git_ref"], list(manifest.get("mutable_refs") or []))
    facts = {k: manifest.get(k) for k in ("collection", "version", "app_version")}
    template = manifest.get("source_url_template") or "{repo_url}/blob/{git_ref}/{path}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for source, relpath, kind, content in zip(b["source_path"], b["relpath"], b["kind"], b["content"], strict=True):
                page = file_page(bytes(content).decode("utf-8", "replace"), kind, relpath, options)
                page["body"] = pin_assets(page["body"], source, options.repo_url, options.git_ref)
                url = template.replace("{repo_url}", options.repo_url).replace("{git_ref}", options.git_ref).replace("{path}", source)
                if page.get("permalink"):  # the site's layout: a route is a folder with an index page
                    relpath = str(page["permalink"]).strip("/") + "/index.md"
                made.append(facts | page | {"relpath": relpath.lstrip("/"), "source_url": url, "source_path": source, "source_commit": options.git_ref, "fetched_at": pd.Timestamp(fetched_at), "fetched_at_raw": fetched_at})
            yield page_frame(iter(made))

    return files.where("kind <> 'openapi'").select("source_path", "relpath", "kind", "content").mapInPandas(run, PAGES)
