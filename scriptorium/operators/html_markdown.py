"""HTML to Markdown on the standard library's tolerant tokenizer: a small tree, CSS-like selection, and a renderer.

Page text never contains markup that the tokenizer has not balanced: unclosed tags close with their parent, script and
style content is dropped as a whole, unknown elements render as their content.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset("script style noscript template svg nav footer head form button iframe".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figure figcaption footer h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# Labels of admonitions by the class that marks them.
ADMONITIONS = {
    "note": "Note", "hint": "Hint", "warning": "Warning", "tip": "Tip", "seealso": "See also", "important": "Important", "caution": "Caution",
    "attention": "Attention", "danger": "Danger", "error": "Error", "deprecated": "Deprecated", "versionadded": "Version added", "versionchanged": "Version changed",
}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    parent: Node | None = None

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def walk(self):
        """This node and all nodes below it, in document order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, without: Callable[[Node], bool] | None = None) -> str:
        out, todo = [], [self]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
            elif item.tag not in ("script", "style") and not (without and without(item)):
                todo += reversed(item.children)
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def handle_starttag(self, tag, attrs):
        while self.at.parent and tag in CLOSES.get(self.at.tag, ()):
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, parent=self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:  # an end tag that nothing opened is ignored
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse_html(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


_PART = re.compile(r"([a-zA-Z][\w-]*|\*)|\.([\w-]+)|#([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*[\"']?([^\"'\]]*)[\"']?)?\s*\]")


def matches(node: Node, simple: str) -> bool:
    """Whether node fits a compound selector of a tag, classes, an id and attributes."""
    at = 0
    while at < len(simple):
        m = _PART.match(simple, at)
        if not m:
            return False
        tag, cls, ident, attr, value = m.groups()
        fits = (not tag or tag in ("*", node.tag)) and (not cls or cls in node.classes) and (not ident or node.attrs.get("id") == ident)
        if not fits or attr and (attr not in node.attrs or value is not None and node.attrs[attr] != value):
            return False
        at = m.end()
    return node.tag != "#root"


def select(root: Node, selector: str) -> Node | None:
    """The first node, in document order, of the first alternative of a comma list that has any; steps by blanks descend."""
    for choice in selector.split(","):
        steps = choice.split()
        for node in root.walk():
            if steps and matches(node, steps[-1]):
                above, rest = node.parent, steps[:-1]
                while rest and above:
                    if matches(above, rest[-1]):
                        rest = rest[:-1]
                    above = above.parent
                if not rest:
                    return node
    return None


def permalink(node: Node) -> bool:
    """Whether node is a heading's link to itself: by its class, or a link whose text is a mark alone."""
    return "headerlink" in node.classes or node.tag == "a" and node.text().strip() in ("¶", "#")


def title_of(root: Node, main: Node | None = None) -> str:
    """The text of the first h1 without its permalink, else of <title>, cleaned."""
    for top, tag in ((main or root, "h1"), (root, "h1"), (root, "title")):
        for node in top.walk():
            if node.tag == tag and (found := clean_title(node.text(permalink))):
                return found
    return ""


def clean_title(text: str) -> str:
    """A heading as plain text: permalinks, link and code marks go, blanks shrink. A # at the end is text, as in C#."""
    text = re.sub(r"\[([^\]]*)\]\([^)]*\)", lambda m: "" if m[1] == "#" else m[1], text).replace("`", "")
    return re.sub(r"\s+", " ", text).strip().rstrip("¶").strip()


class Renderer:
    """Markdown of a subtree. link: maps the href of links, image: of images."""

    def __init__(self, link: Callable[[str], str] = str, image: Callable[[str], str] = str):
        self.link, self.image = link, image

    def document(self, node: Node) -> str:
        return re.sub(r"\n{3,}", "\n\n", "\n\n".join(self.blocks(node))).strip() + "\n"

    # Blocks

    def blocks(self, node: Node) -> list[str]:
        out: list[str] = []
        line: list[Node | str] = []

        def flush() -> None:
            if text := self.inline(line):
                out.append(text)
            line.clear()

        for child in node.children:
            if isinstance(child, Node) and (child.tag in BLOCKS or self._holds_block(child)):
                flush()
                out += self.block(child)
            else:
                line.append(child)
        flush()
        return out

    def _holds_block(self, node: Node) -> bool:
        return any(n.tag in BLOCKS for n in node.walk())

    def block(self, node: Node) -> list[str]:
        tag = node.tag
        if tag in SILENT or "headerlink" in node.classes:
            return []
        if re.fullmatch("h[1-6]", tag):
            text = self.inline(node.children)
            return [f"{'#' * int(tag[1])} {text}"] if text else []
        if tag == "pre":
            return [self.fence(node)]
        if tag in ("ul", "ol"):
            return [self.items(node, tag == "ol")]
        if tag == "dl":
            return [self.definitions(node)]
        if tag == "table":
            return [t] if (t := self.table(node)) else []
        if tag == "hr":
            return ["---"]
        if tag == "blockquote":
            return [quoted("\n\n".join(self.blocks(node)))]
        if label := self.admonition(node):
            body = [c for c in node.children if not (isinstance(c, Node) and {"admonition-title", "title"} & c.classes)]
            return [quoted(f"**{label}:**\n\n" + "\n\n".join(self.blocks(Node("div", children=body))))]
        return self.blocks(node)

    def admonition(self, node: Node) -> str | None:
        kinds = node.classes & ADMONITIONS.keys()
        if not kinds or not (node.tag in ("div", "aside", "section") or "admonition" in node.classes):
            return None
        return ADMONITIONS[min(kinds)]

    def fence(self, node: Node) -> str:
        own = [c for n in (node, node.parent, *(n for n in node.walk())) if n for c in n.classes]
        lang = next((m[1] for c in own if (m := re.fullmatch(r"(?:highlight|language|lang)-([\w+#.-]+)", c)) and m[1] not in ("default", "none", "text")), "")
        body = node.text().strip("\n")
        longest = max([2, *(len(m) for m in re.findall("`+", body))])
        ticks = "`" * (longest + 1)
        return f"{ticks}{lang}\n{body}\n{ticks}"

    def items(self, node: Node, ordered: bool) -> str:
        out = []
        for child in node.children:
            if isinstance(child, Node) and child.tag in ("ul", "ol"):
                out.append(indented(self.items(child, child.tag == "ol"), "  "))
            elif isinstance(child, Node) and child.tag == "li":
                mark = "1. " if ordered else "- "
                blocks = self.blocks(child)
                tight = len(blocks) < 2 or all(re.match(r"(-|1\.) ", b) for b in blocks[1:])
                out.append(mark + indented(("\n" if tight else "\n\n").join(blocks), " " * len(mark)).lstrip())
        return "\n".join(out)

    def definitions(self, node: Node) -> str:
        out = []
        for child in (n for n in node.walk() if n.tag in ("dt", "dd") and self._list_of(n) is node):
            text = "\n\n".join(self.blocks(child))
            if child.tag == "dt":
                out.append(("\n" if out else "") + text.replace("\n", " "))
            else:
                out.append(":   " + indented(text, "    ").lstrip())
        return "\n".join(out)

    @staticmethod
    def _list_of(node: Node) -> Node | None:
        while node and node.tag != "dl":
            node = node.parent
        return node

    def table(self, node: Node) -> str:
        rows = []
        for row in (n for n in node.walk() if n.tag == "tr"):
            cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if cells:
                rows.append([re.sub(r"\s+", " ", " ".join(self.blocks(c))).replace("|", "\\|").strip() for c in cells])
        if not rows:
            return ""
        width = max(map(len, rows))
        lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
        return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])

    # Inline

    def inline(self, items: list[Node | str]) -> str:
        text = re.sub(r"[ \t\r\f\v]*\n\s*|[ \t\r\f\v]+", lambda m: "\n" if "\n" in m[0] else " ", "".join(map(self.piece, items)))
        return text.replace("\0", "  \n").strip()

    def piece(self, item: Node | str) -> str:
        if isinstance(item, str):
            return item
        tag = item.tag
        if tag in SILENT or "headerlink" in item.classes:
            return ""
        if tag == "br":
            return "\0"
        if tag == "img":
            return f"![{item.attrs.get('alt', '')}]({self.image(item.attrs.get('src', ''))})"
        inner = "".join(map(self.piece, item.children))
        body = inner.strip()
        around = (inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]) if body else ("", inner)
        if not body:
            return inner
        if tag in ("code", "tt", "kbd", "samp"):
            plain = re.sub(r"\s+", " ", item.text()).strip()
            ticks = "`" * (1 + max([0, *(len(m) for m in re.findall("`+", plain))]))
            return f"{around[0]}{ticks}{plain}{ticks}{around[1]}"
        if tag in ("strong", "b"):
            return f"{around[0]}**{body}**{around[1]}"
        if tag in ("em", "i", "cite", "var"):
            return f"{around[0]}*{body}*{around[1]}"
        if tag == "a" and (href := item.attrs.get("href")):
            to = self.link(href)
            return around[0] + (f"<{to}>" if body == to and re.match("https?://", to) else f"[{body}]({to})") + around[1]
        return inner


def quoted(text: str) -> str:
    return "\n".join(f"> {line}" if line else ">" for line in text.split("\n"))


def indented(text: str, by: str) -> str:
    return "\n".join(by + line if line else "" for line in text.split("\n"))
