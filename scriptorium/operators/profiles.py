"""Markup that static-site generators put into Markdown, turned into plain Markdown.

A profile is a list of rewrites applied outside fenced code. Unknown markup stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from scriptorium.operators.html_markdown import quoted

Rewrite = Callable[[str], str]

# Labels of boxes in the sources.
LABELS = {"note": "Note", "info": "Note", "tip": "Tip", "success": "Tip", "hint": "Hint", "warning": "Warning", "caution": "Caution", "danger": "Danger", "important": "Important", "idea": "Tip", "disclaimer": "Note", "flag": "Note"}


def _box(kind: str, body: str) -> str:
    return "\n" + quoted(f"**{LABELS.get(kind.lower(), 'Note')}:**\n\n{body.strip()}") + "\n"


def hugo(text: str) -> str:
    """Boxes, tab sets and glossary terms of Hugo shortcodes; comments go."""
    open_, close = r"\{\{[<%]\s*", r"\s*[>%]\}\}"
    text = re.sub(rf"{open_}comment{close}.*?{open_}/\s*comment{close}", "", text, flags=re.S)
    text = re.sub(rf"{open_}(note|caution|warning|tip|idea|info){close}(.*?){open_}/\s*\1{close}", lambda m: _box(m[1], m[2]), text, flags=re.S)
    text = re.sub(rf"{open_}alert(?:\s+[^>%]*?(?:color|title)=\"(\w+)\")?[^>%]*{close}(.*?){open_}/\s*alert{close}", lambda m: _box(m[1] or "note", m[2]), text, flags=re.S)
    text = re.sub(rf"{open_}glossary_tooltip\s[^>%]*?text=\"([^\"]*)\"[^>%]*{close}", r"\1", text)
    text = re.sub(rf"{open_}glossary_tooltip\s[^>%]*?term_id=\"([^\"]*)\"[^>%]*{close}", lambda m: m[1].replace("-", " "), text)
    text = re.sub(rf"{open_}tabs?et?s?\s+(?:name|category-name)=\"?([^\">%]*)\"?[^>%]*{close}", lambda m: "", text) if "tabset" not in text else re.sub(rf"{open_}tabset\s+category-name=\"?([^\">%]*)\"?[^>%]*{close}", r"**Tabset (\1):**\n", text)
    text = re.sub(rf"{open_}tab\s+(?:name=)?\"([^\"]*)\"[^>%]*{close}", r"**Tab: \1**\n", text)
    return re.sub(rf"{open_}/\s*(?:tabs?|tabset|tabs){close}", "", text)


def gitbook(text: str) -> str:
    """Hints and tabs of GitBook."""
    text = re.sub(r"\{%\s*hint\s+style=\"(\w+)\"\s*%\}(.*?)\{%\s*endhint\s*%\}", lambda m: _box(m[1], m[2]), text, flags=re.S)
    text = re.sub(r"\{%\s*tab\s+title=\"([^\"]*)\"\s*%\}", r"**Tab: \1**\n", text)
    return re.sub(r"\{%\s*(?:tabs|endtabs|endtab)\s*%\}\n?", "", text)


def jekyll(text: str) -> str:
    """Raw blocks lose their fence, card includes become links; attribute lists and other markers stay."""
    text = re.sub(r"\{%-?\s*(?:end)?raw\s*-?%\}", "", text)
    return re.sub(r"\{%-?\s*include\s+(?:list|cards)\.html[^%]*%\}\n?", "", text)


def mdx(text: str) -> str:
    """Imports go; boxes, tabs and cards become Markdown; other components leave their content."""
    text = re.sub(r"^(?:import|export)\s.*\n", "", text, flags=re.M)
    text = re.sub(r":::(note|tip|caution|danger|warning|info)(?:\[[^\]]*\])?\n(.*?)\n:::", lambda m: _box(m[1], m[2]).strip("\n"), text, flags=re.S)
    text = re.sub(r"<(?:Note|Callout|Aside)[^>]*>(.*?)</(?:Note|Callout|Aside)>", lambda m: f"**Note:**\n\n{m[1].strip()}", text, flags=re.S)
    text = re.sub(r"<(?:Tab|TabItem)\s[^>]*?(?:label|title)=\"([^\"]*)\"[^>]*>", r"**Tab: \1**\n", text)
    return re.sub(r"</?(?:Tabs|Tab|TabItem|Steps|Card|CardGrid|Columns)\b[^>]*>\n?", "", text)


def gitlab(text: str) -> str:
    """Quoted alerts `> [!warning]` become boxes."""
    lines, out, label = text.split("\n"), [], None
    for line in lines:
        if m := re.match(r">\s*\[!(\w+)\]\s*$", line):
            label = LABELS.get(m[1].lower(), "Note")
            out += [f"> **{label}:**", ">"]
        else:
            out.append(line)
    return "\n".join(out)


PROFILES: dict[str, list[Rewrite]] = {
    "": [hugo, gitlab],
    "istio": [hugo],
    "gitbook": [gitbook],
    "jekyll": [jekyll],
    "opencode": [mdx],
    "prometheus-operator": [],
}
_FENCE = re.compile(r"(^[ \t]*(```+|~~~+)[^\n]*\n.*?^[ \t]*\2[ \t]*$)", re.S | re.M)


def apply_profile(text: str, profile: str | None) -> str:
    """The text with the profile's rewrites outside fenced code; unknown profiles raise ValueError.

    Boxes and tabs may span a fence, so fences are put aside as single characters and put back.
    """
    if (profile or "") not in PROFILES:
        raise ValueError(f"unknown profile: {profile}")
    kept: list[str] = []

    def aside(m: re.Match) -> str:
        kept.append(m[1])
        return f"\ue000{len(kept) - 1}\ue001"

    def back(m: re.Match) -> str:
        return m[1] + kept[int(m[2])].replace("\n", "\n" + m[1])

    text = _FENCE.sub(aside, text)
    for rewrite in PROFILES[profile or ""]:
        text = rewrite(text)
    return re.sub(r"\n{3,}", "\n\n", re.sub("((?:> ?)*)\ue000(\\d+)\ue001", back, text))
