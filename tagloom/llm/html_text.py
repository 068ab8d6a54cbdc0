"""Main text of web pages: site templates are removed by counting element subtrees per host.

A page is read into a light tree that tolerates tags left open. Every block element's subtree (its tag, its text, its children)
is hashed; Spark counts on how many different pages of a host each subtree stands and joins the recurring ones back to their
pages, whose text is then written without them. Pages that are the same but for their address count once, so copies do not
make their own text a template.

Within the article (``article`` or ``main``) a paragraph is text even if it recurs, as licence lines and quotes do: there only
containers are counted, and never one that holds half of the article. Elements whose tag, role or class says menu, header,
footer, sidebar, notice, advert, form, script, style or comment go too, since a host of few pages has no counts to show.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored

#: A subtree is a template if it stands on at least so many different pages of a host, and on at least this share of them.
PAGES, SHARE = 5, 0.01

# Names of HTML.
_SILENT = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_DROPPED = _SILENT | {"head", "nav", "aside", "footer", "form", "button", "select", "option", "svg", "math", "object", "canvas", "audio", "video", "dialog", "menu"}
_TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "tr", "address", "summary"}
_BLOCKS = _TEXT_BLOCKS | {
    "html", "body", "head", "nav", "aside", "footer", "form", "header", "main", "article", "section", "div", "ul", "ol", "dl", "figure",
    "table", "thead", "tbody", "tfoot", "td", "th", "details", "fieldset", "hr", "hgroup", "menu", "dialog", "center", "search",
}
#: Elements that a start tag of the same kind, or of a block, closes if they are open.
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}, "body": {"head"},
}
#: Where such a search stops.
_SCOPES = {"ul", "ol", "dl", "table", "select", "body", "html"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
#: Words of a class or id that tell what an element is for.
_SIGNS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "toolbar", "pagination", "pager",
    "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay",
    "comment", "comments", "respond", "disqus", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup", "login", "form",
}

# Attribute values may hold ">"; what is not a tag is text.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Element:
    tag: str
    dropped: bool = False
    #: Texts and elements in order.
    held: list = field(default_factory=list)
    mark: int = 0
    size: int = 0


def _says_template(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name in ("class", "id") and not _SIGNS.isdisjoint(_WORD.findall(value)):
            return True
    return False


def parse(page: str) -> Element:
    """The tree of a page. Elements left open end with their parent; end tags without a start are passed over."""
    root = Element("")
    path = [root]
    at, inside = 0, 0  # inside: open articles
    raw = re.compile("")

    def close(depth: int) -> None:
        nonlocal inside
        while len(path) > depth:
            inside -= path.pop().tag in ("article", "main")

    while at < len(page):
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            path[-1].held.append(html.unescape(text))
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found[1], (found[2] or "").lower(), found[3]
        if not tag:
            continue
        if closing:
            for depth in range(len(path) - 1, 0, -1):
                if path[depth].tag == tag:
                    close(depth)
                    break
                if path[depth].tag in ("article", "main", "body") and tag not in _BLOCKS:
                    break
            continue
        if tag in _BLOCKS:
            ends = _CLOSED_BY.get(tag, set())
            for depth in range(len(path) - 1, 0, -1):
                known = path[depth].tag
                if known == "p" or known in ends:
                    close(depth)
                    if known == "p":
                        break
                elif known in _BLOCKS and (known in _SCOPES or not ends):
                    break
        element = Element(tag, _says_template(tag, attributes, inside > 0))
        path[-1].held.append(element)
        if tag in _RAW:
            raw = re.compile(f"</{re.escape(tag)}[^>]*>?", re.I)
            end = raw.search(page, at)
            at = end.end() if end else len(page)
        elif tag not in _VOID and not attributes.endswith("/"):
            path.append(element)
            inside += tag in ("article", "main")
    _measure(root)
    return root


def _children(element: Element) -> list[Element]:
    return [x for x in element.held if isinstance(x, Element)]


def _measure(root: Element) -> None:
    """Each element's hash and letters, from the leaves up."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += _children(element)
    for element in reversed(order):
        digest = xxhash.xxh3_64(element.tag.encode("utf-8", "surrogatepass"))
        for x in element.held:
            if isinstance(x, Element):
                digest.update(x.mark.to_bytes(8, "little"))
                element.size += x.size
            elif not x.isspace():
                digest.update(b"\0" + " ".join(x.split()).encode("utf-8", "surrogatepass"))
                element.size += len(x)
        element.mark = digest.intdigest()


def _article(root: Element) -> Element | None:
    """What holds the main text: the page's articles, or its main element; None if it has neither."""
    mains, articles, todo = [], [], [root]
    while todo:
        element = todo.pop()
        if element.dropped:
            continue
        if element.tag == "main" and element.size:
            mains.append(element)
        elif element.tag == "article" and element.size:
            articles.append(element)
            continue
        todo += reversed(_children(element))
    if mains:
        return Element("", held=list(mains[:1]), size=mains[0].size)
    if articles:
        return Element("", held=articles, size=sum(a.size for a in articles))
    return None


def candidates(root: Element) -> Iterator[int]:
    """The hashes of the subtrees that may be a template: blocks outside of the article, and containers within it."""
    article = _article(root)
    mains = {id(x) for x in _children(article)} if article else set()
    todo = [(root, False)]
    while todo:
        element, inside = todo.pop()
        own = id(element) in mains
        inside = inside or own
        if element.tag in _BLOCKS and element.size and not own and element.tag not in ("html", "body", "head"):
            if not inside or element.tag not in _TEXT_BLOCKS and 2 * element.size < article.size:
                yield element.mark
        todo += [(x, inside) for x in _children(element)]


def main_text(root: Element, templates: set[int]) -> str:
    """The blocks that are left, joined by two line breaks."""
    article = _article(root)
    blocks: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = " ".join("".join(held).split())
        if text:
            blocks.append(text)
        held.clear()

    # Each entry is a text, an element, or None for the end of a block.
    todo: list = [(article or root, article is not None)]
    mains = {id(x) for x in _children(article)} if article else set()
    while todo:
        x, inside = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag in ("br", "wbr"):
            held.append(" " if x.tag == "br" else "")
        else:
            counted = not article or x.tag not in _TEXT_BLOCKS and 2 * x.size < article.size
            gone = x.dropped or x.tag in _BLOCKS and id(x) not in mains and counted and x.mark in templates
            if x.tag in ("td", "th"):
                held.append(" ")
            elif x.tag in _BLOCKS:
                end()
                todo.append((None, inside))
            if not gone:
                todo += [(y, inside) for y in reversed(x.held)]
    end()
    return "\n\n".join(blocks)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page the subtrees that may be templates, each once, and a hash of the whole page."""
    for batch in batches:
        keys, hosts, whole, marks = [], [], [], []
        for key, host, page in zip(batch.column("key"), batch.column("host"), batch.column("html"), strict=True):
            root = parse(page.as_py())
            for mark in set(candidates(root)):
                keys.append(key.as_py())
                hosts.append(host.as_py())
                whole.append(_signed(root.mark))
                marks.append(_signed(mark))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((keys, hosts, whole, marks), kinds)], ["key", "host", "page", "mark"])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def templates(pages: DataFrame, least: int = PAGES, share: float = SHARE) -> DataFrame:
    """``key`` and ``marks``: of each page that has some, the subtrees that recur on its host. ``pages`` has ``key``, ``host``, ``html``.

    Counts are combined before they are shuffled, by host and subtree; a host of a third of all pages is not one task's work.
    """
    found = pages.select("key", "host", "html").mapInArrow(_subtrees, "key long, host string, page long, mark long")
    found = stored(found, "subtrees")
    different = found.select("host", "mark", "page").distinct().groupBy("host", "mark").agg(F.count("*").alias("on"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("all"))
    often = different.where(F.col("on") >= least).join(hosts, "host").where(F.col("on") >= share * F.col("all")).select("host", "mark")
    return found.join(often, ["host", "mark"]).groupBy("key").agg(F.collect_set("mark").alias("marks"))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, marks in zip(batch.column("html"), batch.column("marks"), strict=True):
            texts.append(main_text(parse(page.as_py()), {x & (1 << 64) - 1 for x in marks.as_py() or ()}))
        rest = [c for c in batch.schema.names if c not in ("html", "marks")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, "text"])


def extract(pages: DataFrame, least: int = PAGES, share: float = SHARE) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row.

    Blocks are joined by two line breaks, white space within one is a single space, character references are decoded. Null and
    empty html give an empty text; rows repeat as given; a null or odd url is of the host "". Empty input gives no rows.
    """
    given = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    given = given.withColumn("host", _host(F.col("url"))).withColumn("key", F.xxhash64("url", "html"))
    known = templates(given, least, share)
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}
    joined = given.join(known, "key", "left").select("page_id", "url", "html", "marks")
    out = joined.mapInArrow(_written, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op13_html(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
