"""reStructuredText to Markdown, for the parts documentation uses most.

Sections, note-like directives, code and literal blocks, lists, grid-free tables and inline marks are converted. What it
does not know passes through unchanged; references it cannot resolve keep their text and get a marker comment.
"""

from __future__ import annotations

import re

from scriptorium.operators.html_markdown import indented, quoted

# Directives rendered as quoted boxes, and their labels.
BOXES = {
    "note": "Note", "warning": "Warning", "tip": "Tip", "hint": "Hint", "important": "Important", "caution": "Caution",
    "attention": "Attention", "danger": "Danger", "error": "Error", "seealso": "See also", "admonition": "Note",
}
CODE = {"code-block", "code", "sourcecode", "prompt", "highlight"}
_UNDER = re.compile(r"([=\-`:.'\"~^_*+#<>])\1*\s*$")
_DIRECTIVE = re.compile(r"\.\. ([\w:-]+)::\s*(.*)$")


def _deeper(lines: list[str], at: int, least: int = 1) -> tuple[list[str], int]:
    """The block indented by `least` or more from line `at` on, without its common indent, and the line after it."""
    block = []
    while at < len(lines) and (not lines[at].strip() or len(lines[at]) - len(lines[at].lstrip()) >= least):
        block.append(lines[at])
        at += 1
    while block and not block[-1].strip():
        block.pop()
        at -= 1
    depth = min((len(x) - len(x.lstrip()) for x in block if x.strip()), default=0)
    return [x[depth:] for x in block], at


def inline(text: str) -> str:
    def named(m: re.Match) -> str:
        label, target = m[1].strip(), m[2].strip()
        return f"[{label}]({target})" if not target.endswith("_") else f"{label} <!-- unresolved-rst-link: kind=named target={target[:-1]} -->"

    def role(m: re.Match) -> str:
        kind, body = m[1], m[2]
        shown = re.fullmatch(r"(.*?)\s*<([^>]+)>", body, re.S)
        label, target = (shown[1], shown[2]) if shown else (body.lstrip("~!"), body)
        if kind in ("ref", "doc", "term", "option", "confval"):
            return f"{label} <!-- unresolved-rst-link: kind={kind} target={target} -->" if kind in ("ref", "doc") else f"`{label}`"
        return f"*{label}*" if kind in ("emphasis", "title") else f"`{label}`"

    parts = re.split(r"(``.+?``)", text, flags=re.S)
    for i in range(0, len(parts), 2):
        part = re.sub(r":([\w:-]+):`([^`]+)`", role, parts[i])
        part = re.sub(r"`([^`<]+?)\s*<([^>`]+)>`__?", named, part)
        part = re.sub(r"`(https?://[^`]+)`_", r"<\1>", part)
        parts[i] = re.sub(r"`([^`]+)`_\b", r"\1 <!-- unresolved-rst-link: kind=named target=\1 -->", part)
    return "".join(re.sub(r"^``(.+)``$", r"`\1`", p, flags=re.S) if i % 2 else p for i, p in enumerate(parts))


def rst_to_markdown(text: str) -> str:
    levels: list[str] = []
    return _blocks(text.expandtabs(8).split("\n"), levels).strip() + "\n"


def _level(mark: str, levels: list[str]) -> int:
    if mark not in levels:
        levels.append(mark)
    return levels.index(mark) + 1


def _blocks(lines: list[str], levels: list[str]) -> str:
    out: list[str] = []
    at = 0
    while at < len(lines):
        line = lines[at]
        below = lines[at + 1] if at + 1 < len(lines) else ""
        if not line.strip():
            at += 1
        elif len(line) > 2 and _UNDER.match(line) and below.strip() and at + 2 < len(lines) and lines[at + 2].rstrip() == line.rstrip() and not re.match(r"[ =]*$", below):
            out.append(f"{'#' * min(6, _level('over' + line[0], levels))} {inline(below.strip())}")
            at += 3
        elif line.strip() and not line.startswith((" ", "..")) and _UNDER.match(below) and len(below.rstrip()) >= min(3, len(line.strip())):
            out.append(f"{'#' * min(6, _level(below[0], levels))} {inline(line.strip())}")
            at += 2
        elif m := _DIRECTIVE.match(line):
            body, after = _deeper(lines, at + 1)
            out.append(_directive(m[1], m[2], body, lines[at:after], levels))
            at = after
        elif line.startswith(".. _") and line.rstrip().endswith(":"):
            at += 1  # a label
        elif line.startswith(".. ") or line.rstrip() == "..":
            _, at = _deeper(lines, at + 1)  # a comment
        elif m := re.match(r"(\s*)([-*+•]|#\.|\d+[.)]|\(?[a-z]\))\s+(?=\S)", line):
            item, after = _deeper(lines, at + 1, m.end())
            first = line[m.end() :]
            mark = "- " if m[2] in "-*+•" else "1. "
            out.append(mark + indented(_blocks([first, *item], levels), " " * len(mark)).lstrip())
            at = after
        elif re.match(r"=+( +=+)+\s*$", line):
            at = _simple_table(lines, at, out)
        else:
            start = at
            while at < len(lines) and lines[at].strip() and not _DIRECTIVE.match(lines[at]):
                at += 1
                if at < len(lines) and lines[at - 1].rstrip().endswith("::"):
                    break
            at = max(at, start + 1)
            text = "\n".join(x.rstrip() for x in lines[start:at])
            literal = text.endswith("::")
            if literal:
                text = text[:-2].rstrip() + (":" if text[:-2].strip() and not text[:-2].endswith((" ", "\n")) else "")
            if text.strip():
                out.append(inline(text))
            if literal:
                while at < len(lines) and not lines[at].strip():
                    at += 1
                code, at = _deeper(lines, at)
                out.append("```\n" + "\n".join(code) + "\n```")
    return "\n\n".join(out)


def _directive(name: str, argument: str, body: list[str], raw: list[str], levels: list[str]) -> str:
    options = 0
    while options < len(body) and re.match(r":[\w-]+:", body[options]):
        options += 1
    rest = body[options:]
    if name in BOXES:
        label = argument if name == "admonition" and argument else BOXES[name]
        own = rest if name == "admonition" else ([argument] if argument else []) + rest
        return quoted(f"**{label}:**\n\n" + _blocks(own, levels))
    if name in CODE and rest:
        while rest and not rest[0].strip():
            rest = rest[1:]
        return f"```{argument}\n" + "\n".join(rest) + "\n```"
    if name in ("image", "figure"):
        alt = next((m[1] for x in body if (m := re.match(r":alt:\s*(.*)", x))), "")
        return f"![{alt}]({argument})"
    return "\n".join(raw)


def _simple_table(lines: list[str], at: int, out: list[str]) -> int:
    """A table between rules of equals signs; its columns start where the rule's do."""
    spans = [m.span() for m in re.finditer("=+", lines[at])]
    rows: list[list[str]] = []
    rules = 1
    at += 1
    while at < len(lines) and lines[at].strip():
        if re.match(r"=+( +=+)*\s*$", lines[at]):
            rules += 1
            at += 1
            if rules == 3 or at >= len(lines) or not lines[at].strip():
                break
            continue
        cells = [lines[at][a : (spans[k + 1][0] if k + 1 < len(spans) else None)].strip() for k, (a, _) in enumerate(spans)]
        if rows and not cells[0]:
            rows[-1] = [f"{x} {y}".strip() for x, y in zip(rows[-1], cells, strict=True)]
        else:
            rows.append(cells)
        at += 1
    if rows:
        table = ["| " + " | ".join(inline(c) for c in r) + " |" for r in rows]
        out.append("\n".join([table[0], "| " + " | ".join(["---"] * len(spans)) + " |", *table[1:]]))
    return at
