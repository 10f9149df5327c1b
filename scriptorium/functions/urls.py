"""URL scope, mapping of URLs to corpus paths, and link targets, as column expressions.

Everything here is built-in functions only, so filters on URLs stay in generated code next to the scan.
"""

from __future__ import annotations

import posixpath
import re
from urllib.parse import unquote, urljoin, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_scope(url: Column, base: Column, allow: Column, deny: Column) -> Column:
    """Whether a crawl with this base and these prefix lists may take url.

    The URL must start with the base as text, so other hosts and other versions are out. Without allow prefixes
    everything below the base is in; with them only matching relative paths, and the base page itself. A deny prefix,
    compared as plain text and not by path segment, always wins. Null lists count as empty; a null URL is out.
    """
    rel = F.substring(url, F.length(base) + 1, F.length(url))
    starts = lambda prefixes: F.exists(F.coalesce(prefixes, F.array().cast("array<string>")), lambda p: F.startswith(rel, p))
    free = F.coalesce(F.size(allow), F.lit(0)) <= 0
    return F.coalesce(F.startswith(url, base) & (free | rel.isin("", "index.html") | starts(allow)) & ~starts(deny), F.lit(False))


def crawl_relpath(url: Column, base: Column) -> Column:
    """Corpus path of a crawled URL: index pages become index.md, x.html becomes x.md."""
    rel = F.regexp_replace(F.substring(url, F.length(base) + 1, F.length(url)), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(rel, r"(^|/)(index\.html)?$", "$1index.md"), r"\.html$", ".md")


def suffix_to_md(path: Column) -> Column:
    return F.regexp_replace(path, r"\.(mdx|rst|html)$", ".md")


def permalink_relpath(permalink: Column) -> Column:
    """A site route /a/b/ is the page a/b/index.md."""
    return F.concat(F.regexp_replace(permalink, "^/", ""), F.when(F.endswith(permalink, F.lit("/")), "index.md").otherwise("/index.md"))


def canonical_route(canonical_url: Column) -> Column:
    """Route of a canonical URL: without host and /latest, and without a last segment index/."""
    route = F.regexp_replace(F.regexp_replace(canonical_url, r"^[a-z]+://[^/]+", ""), r"^/latest(?=/)", "")
    return F.regexp_replace(route, r"(^|/)index/$", "$1")


def source_url(template: Column, repo_url: Column, git_ref: Column, path: Column) -> Column:
    """Citation URL of a file in a repository at a ref; without a template, the /blob/ form."""
    form = F.coalesce(template, F.lit("{repo_url}/blob/{git_ref}/{path}"))
    return F.replace(F.replace(F.replace(form, F.lit("{repo_url}"), repo_url), F.lit("{git_ref}"), git_ref), F.lit("{path}"), path)


def pin_refs(text: Column, repo_url: str, commit: str, refs: list[str]) -> Column:
    """Links to this repository's blob or tree at a moving ref point at the commit instead; other repositories stay."""
    if not refs:
        return text
    names = "|".join(sorted(map(re.escape, refs), key=len, reverse=True))
    return F.regexp_replace(text, rf"({re.escape(repo_url)}/(?:-/)?(?:blob|tree|raw)/)(?:{names})(?=/|$|[)#?\s])", rf"$1{commit}")


def decode_path(path: Column) -> Column:
    """Percent-decoding that leaves a plus sign alone."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def fill_variables(text: Column, values: Column) -> Column:
    """Replaces {{ site.name }} by the map's value of name; unknown names stay."""
    entries = F.map_entries(F.coalesce(values, F.create_map().cast("map<string,string>")))
    one = lambda acc, e: F.replace(F.replace(acc, F.concat(F.lit("{{site."), e["key"], F.lit("}}")), e["value"]), F.concat(F.lit("{{ site."), e["key"], F.lit(" }}")), e["value"])
    return F.aggregate(entries, text, one)


def join_url(base: str, link: str) -> str:
    """The absolute form of a link found on a page."""
    return urljoin(base, link)


def relative_link(from_path: str, to_path: str) -> str:
    return posixpath.relpath(to_path, posixpath.dirname(from_path) or ".")


def link_target(from_path: str, link: str) -> str | None:
    """Corpus path that a relative link on a page names, without its fragment; None for absolute, mail and in-page links."""
    parts = urlsplit(link)
    if parts.scheme or parts.netloc or not parts.path or link.startswith("/"):
        return None
    return posixpath.normpath(posixpath.join(posixpath.dirname(from_path), unquote(parts.path)))
