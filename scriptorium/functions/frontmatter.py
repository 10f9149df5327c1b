"""YAML frontmatter of corpus pages: reading and writing."""

from __future__ import annotations

import json

import yaml

from scriptorium.schema import PAGES, columns

CORE = ("collection", "version", "title", "source_url", "fetched_at")
KINDS = dict(columns(PAGES))
_DERIVED = ("path", "relpath", "fetched_at_raw", "fetched_at", "extra", "body", "body_md5")


class _Strings(yaml.SafeLoader):
    """Leaves every plain scalar a string, so that version 6 or 2.19 stays what was written."""


_Strings.yaml_implicit_resolvers = {}


def split_page(text: str) -> tuple[str, str]:
    """The frontmatter block and the body; a page without one has all of it as its body."""
    if not text.startswith("---\n"):
        return "", text
    end = text.find("\n---\n", 3)
    if end < 0:
        return (text[4:-4], "") if text.endswith("\n---") else ("", text)
    return text[4 : end + 1], text[end + 5 :]


def parse(block: str) -> dict[str, object]:
    """Keys of a frontmatter block; scalars are strings, lists and maps keep their shape. Broken YAML gives what its lines say."""
    try:
        out = yaml.load(block, Loader=_Strings) if block.strip() else {}
        if isinstance(out, dict):
            return out
    except yaml.YAMLError:
        pass
    pairs = (line.split(":", 1) for line in block.splitlines() if ":" in line and not line.startswith((" ", "-", "#")))
    return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


def typed(value: object, kind: str) -> object:
    """A parsed value as the page schema has it; None where it does not fit."""
    if value is None:
        return None
    if kind == "boolean":
        return {"true": True, "false": False}.get(str(value).lower())
    if kind == "int":
        return int(value) if str(value).lstrip("-").isdigit() else None
    if kind == "array<string>":
        return [str(v) for v in (value if isinstance(value, list) else [value])]
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def fields(block: str) -> dict[str, object]:
    """Page columns of a frontmatter block; keys without a column go to `extra` as JSON text."""
    found = parse(block)
    out: dict[str, object] = {k: typed(found.get(k), kind) for k, kind in KINDS.items() if k not in _DERIVED}
    out["fetched_at_raw"] = typed(found.get("fetched_at"), "string")
    out["extra"] = {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in found.items() if k not in KINDS and k != "fetched_at"}
    return out


def emit(values: dict[str, object]) -> str:
    """A frontmatter block: the five core keys first, then the others in the order given; text is quoted where YAML would read it otherwise."""
    lines = []
    for k in [*CORE, *(k for k in values if k not in CORE)]:
        if (v := values.get(k)) is None:
            continue
        if k in ("collection", "source_url", "fetched_at") and isinstance(v, str) and v and not set(v) & set("\"'#\n"):
            lines.append(f"{k}: {v}")
        else:
            lines.append(f"{k}: {json.dumps(v, ensure_ascii=False)}")
    return "---\n" + "\n".join(lines) + "\n---\n"
