"""Operator 4, HTML extraction with site style trees.

The pages of a host are merged into one tree of element nodes, each named by the
elements and classes that lead to it. A node's presentation is the sequence of its
child elements, its content the text directly in it. Where presentations or contents
vary from page to page a node matters; where all pages have the same it is part of
the frame. The importance of a node is the entropy of its presentations and the
mean importance of the contents below it, as in the published method: for ``m``
pages, 1 minus the mean of the base-``m`` logarithm of how many pages have the same
content. Nodes of low importance are cut out of every page of the host, with all
below them, also inside an article; the outermost article or main element and what holds
it stay. A page keeps its whole article where only headings would be left of it. Inline
elements in paragraphs, headings, list items and the like are judged with these. Elements
nested deeper than ``MAX_DEPTH`` are judged with their ancestor at that depth. What HTML itself calls navigation, headers, footers, asides, forms and
the like, and nodes with such class names, are cut out on every host; on small hosts
that is all there is to go by.

The main text is that of the article elements if any has text left, else of the main
element, else of the body. Null or empty pages have an empty text. Repeated rows are
treated alike, and equal pages of a host count once for its tree: as the row of least id and url,
null before others; rows equal in these too count each. Null urls share the
host of the empty name. Empty tables give no rows; other columns are ignored. Node
counts are added up in each batch before they are shuffled, so a host with a third of
all pages is no task's burden.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_batches, stored, text_bytes
from tripmill.llm.html_tree import INLINE, attributes, events

#: Weight of a node's own presentation falls with its number of presentations.
DECAY = 0.9
LOW = 0.2
#: A host's tree says nothing until it has been merged from so many different pages.
MIN_PAGES = 8
MAX_DEPTH = 256
#: The paths to cut are broadcast up to so many bytes of them, else joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: Elements that never hold main text.
NOISE = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input map menu meter"
    " nav noscript object progress script select style svg template textarea title video".split()
)
#: Parts of class names and ids that mark what is not main text.
NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disclaimer disqus footer login masthead menu modal nav navbar navigation newsletter notice"
    " overlay pager pagination popup promo recommended related replies reply respond search share sharing"
    " sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
    " toolbar".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: Elements whose text, with that of the inline elements in them, is judged as one.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption".split())
#: Paths of article and main elements, and of what is inside an article.
MAIN_NODE = r"/(article|main)([.][^/]*)?$"
IN_ARTICLE = r"/article([.][^/]*)?/"
_IN_MAIN = re.compile(r"/(article|main)([.][^/]*)?/")
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)

NODES = "host string, path string, kind int, value bigint, pages bigint"


def label(name: str, found: dict[str, str]) -> str:
    """An element's name in paths: with its first class, digits and slashes left out."""
    classes = found.get("class", "").split()
    return f"{name}.{re.sub('[0-9/]+', '', classes[0])}" if classes else name


def is_noise(name: str, found: dict[str, str], in_article: bool) -> bool:
    if name in NOISE or (name == "header" and not in_article):
        return True
    if not found:
        return False
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in NOISE_ROLES:
        return True
    if _HIDDEN.search(found.get("style", "")):
        return True
    if name in ("html", "body", "article", "main"):
        return False
    names = _PARTS.findall(re.sub("([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower())
    if not in_article and "header" in names:
        return True
    return not NOISE_NAMES.isdisjoint(names)


class Frame:
    """An open element while a page is read."""

    __slots__ = ("name", "path", "dropped", "scope", "children", "texts", "depth", "prose", "heading")

    def __init__(self, name, path, dropped, scope, depth, prose=False, heading=False):
        self.name, self.path, self.dropped, self.scope, self.depth = name, path, dropped, scope, depth
        self.prose, self.heading = prose, heading
        self.children, self.texts = [], []


def read(page: str, low: frozenset[str] = frozenset(), tree: list | None = None) -> str:
    """The main text of a page, without the nodes whose paths are in ``low``.

    With ``tree`` a list, it gets (path, presentation, text) of each element that is no noise.
    """
    pieces: dict[str, list[str]] = {"article": [], "main": [], "body": []}
    top = Frame("", "", False, "body", 0)
    stack = [top]
    cut_inside = more_than_headings = False
    for kind, name, text in events(page):
        here = stack[-1]
        if kind == "text":
            if not here.dropped:
                pieces[here.scope].append(text)
                if not here.heading and here.scope != "body" and not text.isspace():
                    more_than_headings = True
                if tree is not None:
                    here.texts.append(text)
        elif kind == "open":
            found = attributes(text) if text.strip(" /") else {}
            if name in ("article", "main") and here.dropped:
                # A menu or header that was never closed ends where the article begins.
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name in ("nav", "header", "head") and stack[depth].dropped:
                        for frame in stack[depth:]:
                            frame.dropped = stack[depth - 1].dropped
                        here = stack[depth - 1]
                        break
            mark = label(name, found)
            joins = name in INLINE and here.prose
            path = here.path if joins or here.depth >= MAX_DEPTH else f"{here.path}/{mark}"
            scope = here.scope
            if name == "article" or (name == "main" and scope == "body"):
                scope = name
            dropped = here.dropped or is_noise(name, found, scope == "article")
            if not dropped and path in low:
                dropped, cut_inside = True, cut_inside or here.scope != "body"
            if not dropped:
                here.children.append(mark)
                if name not in INLINE:
                    pieces[scope].append(" ")
            prose = joins or name in PROSE
            heading = here.heading or name in HEADINGS
            stack.append(Frame(name, path, dropped, scope, here.depth + 1, prose, heading))
        else:
            gone = stack.pop()
            if not gone.dropped:
                if gone.name not in INLINE:
                    pieces[gone.scope].append(" ")
                if tree is not None:
                    tree.append((gone.path, "".join(gone.children), "".join(gone.texts).split()))
    if cut_inside and not more_than_headings:
        return read(page, frozenset(path for path in low if not _IN_MAIN.search(path)))
    for scope in ("article", "main", "body"):
        words = "".join(pieces[scope]).split()
        if words or scope == "body":
            return " ".join(words)
    return ""


def hashed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host.alias("host"))


def node_counts(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, pages): on how many pages a node has a presentation (kind 0),
    or a text (kind 1)."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        counts: Counter = Counter()
        for host, page in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            tree: list = []
            read(page.decode("utf-8", "replace"), tree=tree)
            looks: dict[str, list[str]] = {}
            texts: dict[str, list[str]] = {}
            for path, look, words in tree:
                looks.setdefault(path, []).append(look)
                if words:
                    texts.setdefault(path, []).extend(words)
            counts.update((host, path, 0, hashed("|".join(found))) for path, found in looks.items())
            counts.update((host, path, 1, hashed(" ".join(found))) for path, found in texts.items())
        rows = list(zip(*counts)) or [(), (), (), ()]
        return dict(zip(("host", "path", "kind", "value"), map(list, rows))) | {"pages": list(counts.values())}

    return in_batches(pages, NODES, work)


def low_nodes(pages: DataFrame) -> DataFrame:
    """(host, low): the paths of a host that are to be cut out."""
    pages = pages.withColumn("hash", F.xxhash64("html"))
    first = pages.groupBy("host", "hash").agg(F.min(F.struct("page_id", "url")).alias("first")).alias("f")
    # Equal pages count once: only the first of them, by id and url, null before others, is read.
    same = (F.col("p.host") == F.col("f.host")) & (F.col("p.hash") == F.col("f.hash"))
    same &= F.struct("p.page_id", "p.url").eqNullSafe(F.col("f.first"))
    once = pages.alias("p").join(first, same, "left_semi")
    counts = node_counts(once.select("host", "html"))
    counts = counts.groupBy("host", "path", "kind", "value").agg(F.sum("pages").alias("c"))
    node = counts.groupBy("host", "path", "kind").agg(
        F.sum("c").alias("m"),
        F.count("*").alias("l"),
        F.sum(F.col("c") * F.log2("c")).alias("s"),
    )
    m = F.greatest(F.col("m"), F.lit(2))
    # Entropy of the presentations, and 1 minus the mean entropy of the contents, to base m: both
    # are 1 - sum(c log c) / (m log m).
    node = node.withColumn("own", 1 - F.col("s") / (m * F.log2(m)))
    node = stored(node, "style-nodes")
    ups = F.expr(
        "transform(sequence(1, size(split(path, '/')) - 1), i -> array_join(slice(split(path, '/'), 1, i + 1), '/'))"
    )
    below = node.where("kind = 1").select("host", F.explode(ups).alias("path"), "m", "own")
    content = below.groupBy("host", "path").agg(
        (F.sum(F.col("m") * F.col("own")) / F.sum("m")).alias("content")
    )
    looks = node.where("kind = 0").select("host", "path", "m", "l", F.col("own").alias("look"))
    weight = F.pow(F.lit(DECAY), F.col("l"))
    judged = looks.join(content, ["host", "path"], "left").withColumn(
        "importance",
        (1 - weight) * F.coalesce("content", F.lit(0.0)) + weight * F.greatest("look", F.coalesce("content", F.lit(0.0))),
    )
    cut = judged.where((F.col("importance") < LOW) & (F.col("m") >= MIN_PAGES) & F.col("content").isNotNull())
    cut = cut.where("size(split(path, '/')) > 3")
    # The outermost article and what holds it are never cut out; what is inside is.
    mains = looks.where(F.col("path").rlike(MAIN_NODE) & ~F.col("path").rlike(IN_ARTICLE))
    kept = mains.select("host", F.explode(ups).alias("path")).distinct()
    cut = cut.join(kept, ["host", "path"], "left_anti")
    return cut.groupBy("host").agg(F.collect_list("path").alias("low"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    pages = hosted(pages)
    low = stored(low_nodes(pages), "style-low")
    size = low.agg(F.sum(F.expr("aggregate(low, 64L, (n, path) -> n + octet_length(path) + 16)"))).first()[0]
    low = F.broadcast(low) if (size or 0) <= BROADCAST_BYTES else low
    rows = pages.join(low, "host", "left").select("page_id", "url", "html", "low")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        cuts = batch.column(3).to_pylist()
        texts = [
            read(page.decode("utf-8", "replace"), frozenset(cut or ()))
            for page, cut in zip(text_bytes(batch.column(2)), cuts)
        ]
        return {
            "page_id": batch.column(0), "url": batch.column(1), "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    return in_batches(rows, "page_id bigint, url string, text string, n_chars bigint", work)
