"""Record shapes of the corpus, its manifests and its index tables."""

from __future__ import annotations

PAGES = """path string, collection string, version string, relpath string, title string, source_url string,
fetched_at_raw string, fetched_at timestamp, app_version string, description string, source_path string, source_commit string,
renderer string, permalink string, canonical_url string, canonical_route string, redirect_from array<string>,
canonical_collision boolean, chart_version string, layout string, nav_order int, parent string, grand_parent string,
has_children boolean, has_toc boolean, nav_exclude boolean, extra map<string,string>, body string, body_md5 string"""

MANIFESTS = """name string, collection string, version string, source_type string, repo_url string, git_ref string,
docs_paths array<string>, sparse_paths array<string>, source_url_template string, exclude_globs array<string>,
shortcode_profile string, mutable_refs array<string>, app_version string, site_overrides map<string,string>,
preserve_description boolean, base_url string, content_selector string, allow_prefixes array<string>,
deny_prefixes array<string>, max_pages int, delay_seconds double"""

CHUNKS = """chunk_id string, collection string, version string, relpath string, title string, source_url string,
heading_path array<string>, level int, ordinal int, text string, n_terms int, body_md5 string, fetched_at timestamp"""

POSTINGS = "term string, chunk_id string, collection string, version string, tf int"

ARCHIVE = "url string, fetched_at timestamp, content binary, content_type string, charset string"


def columns(schema: str) -> list[tuple[str, str]]:
    """(name, type) of each field of a schema above."""
    out, depth, field = [], 0, ""
    for c in schema.replace("\n", " ") + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = field.strip().split(" ", 1)
            out.append((name, kind))
            field = ""
        else:
            field += c
    return out
