"""A small streaming reader of HTML: elements open and close, text lies between them.

It repairs what browsers repair in practice: elements whose end tag may be left out,
end tags without a start, inline elements that are never closed, scripts that hold
markup, and pages that break off.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.DOTALL
)

#: Elements of the HTML standard by how they are read.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark"
    " nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of the key closes an open element of the value.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "thead": ("tbody",),
    "tbody": ("thead", "tbody"),
    "tfoot": ("tbody",),
}
#: Elements that a start tag does not look beyond.
SCOPES = frozenset("ul ol dl table select body html article section div nav aside main".split())


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; the first of a name counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, text) in page order, where kind is open, close or text.

    ``text`` is a start tag's attributes as written, or characters with references
    decoded. Every element opened is closed. The text of raw elements is left out.
    """
    stack: list[str] = []
    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else end]
        if not token:
            # A tag that the page's end cuts off is no text.
            cut = re.search(r"<[/!?a-zA-Z][^<]*\Z", text)
            text = text[: cut.start()] if cut else text
        if text:
            yield "text", "", html.unescape(text) if "&" in text else text
        if not token:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if token[1]:
            if name in stack:
                while stack:
                    top = stack.pop()
                    yield "close", top, ""
                    if top == name:
                        break
            elif name == "p":
                yield "open", "p", ""
                yield "close", "p", ""
            continue
        if name in VOID:
            yield "open", name, token[3]
            yield "close", name, ""
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            yield "open", name, token[3]
            yield "close", name, ""
            at = closing.end() if closing else end
            continue
        if name not in INLINE:
            # A block ends an open paragraph and the inline elements in it.
            if "p" in stack:
                depth = len(stack) - 1 - stack[::-1].index("p")
                if all(s in INLINE or s == "p" for s in stack[depth:]):
                    while len(stack) > depth:
                        yield "close", stack.pop(), ""
            for other in CLOSES.get(name, ()):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth] == other:
                        while len(stack) > depth:
                            yield "close", stack.pop(), ""
                        break
                    if stack[depth] in SCOPES:
                        break
        stack.append(name)
        yield "open", name, token[3]
    while stack:
        yield "close", stack.pop(), ""
