"""Main text of web pages with site template removal.

Every page is parsed once into blocks of text; each block keeps the hashes of
the element subtrees around it.  Spark counts every subtree per host, those of
menus and footers included (once a page, combined before the shuffle, so a
dominant host costs no more than its distinct subtrees), and subtrees that recur
across many pages of a host are deleted.  What the counts leave is passed by
lists of elements and class words whose meaning is stated (navigation, forms,
adverts, comments, ...), for furniture that differs from page to page;
``lists=False`` switches them off.  Only the article itself, its paragraphs and
headings, and single items or cells of its lists and tables are exempt from the
counts: authors may repeat themselves.  A list, table, quotation or figure that
recurs whole goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MIN_PAGES = 5
MIN_SHARE = 0.2

# Fixed vocabularies of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset("head script style noscript template nav footer aside form button select textarea iframe object svg canvas audio video dialog menu title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table td th article main section div body html aside nav footer header form blockquote".split())
EXEMPT = frozenset("p h1 h2 h3 h4 h5 h6 li b i em strong a span u code td th tr tbody thead dt dd figcaption".split())
NO_TEXT = frozenset("head script style template".split())
FURNITURE = frozenset(
    "nav navbar navigation menu sidebar ad ads advert adverts advertisement advertising banner cookie cookies consent notice notices newsletter subscribe signup promo promotion sponsored popup modal overlay share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus respond footer header masthead toolbar login search widget".split()
)
LAYOUT = frozenset("sidebar header footer nav menu search widget masthead banner".split())
#: Elements whose class must name furniture as a whole word: "share-price" on a paragraph is text, "share" is not.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption figcaption blockquote pre b i em strong code u mark q cite".split())
CONTENT = frozenset("content main article entry post story body text page wrapper container layout".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/a-zA-Z][^<>]*>?|[^<]+|<", re.S)
RAW_END = {t: re.compile(rf"</{t}(?:[\s/][^>]*)?>|</{t}[\s/][^>]*\Z", re.I) for t in RAW}
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
WORD = re.compile(r"[A-Za-z][a-z]*")


def is_furniture(tag: str, attrs: str) -> bool:
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            if value.lower() in ROLES:
                return True
        elif name == "hidden":
            return True
        elif name == "aria-hidden":
            if value.lower() == "true":
                return True
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name in ("class", "id"):
            found = set(value.lower().split()) if tag in TEXTUAL else {w.lower() for w in WORD.findall(value)}
            # "content with-sidebar" or "entry-header" names a layout, not the furniture itself.
            if found & FURNITURE - (LAYOUT if found & CONTENT else frozenset()):
                return True
    return False


class _Open:
    __slots__ = ("tag", "parts", "dropped", "inside", "first", "exempt")

    def __init__(self, tag, dropped, inside, first, exempt):
        self.tag, self.dropped, self.inside, self.first, self.exempt = tag, dropped, inside, first, exempt
        self.parts = [tag.encode()]


def parse(html: str, lists: bool = True) -> tuple[list[int], list[tuple[str, list[int], bool]]]:
    """(hashes of the page's subtrees, blocks); a block is (text, hashes of the deletable subtrees around it, whether lists drop it).

    A block that lists drop in part only has the rest as its text.
    """
    stack = [_Open("#root", False, False, 0, True)]
    subtrees: set[int] = set()
    blocks: list[list] = []
    buffer: list[tuple[str, bool]] = []

    def flush() -> None:
        if buffer:
            whole = " ".join("".join(x for x, _ in buffer).split())
            if whole:
                top = stack[-1]
                for e in reversed(stack):
                    if e.tag in BLOCK or e.tag == "#root":
                        top = e
                        break
                top.parts.append(whole.encode("utf-8", "surrogatepass"))
                # Each piece was marked when it was read: an inline element may end before its block does.
                shown = " ".join("".join(x for x, dropped in buffer if not dropped).split())
                blocks.append([shown or whole, [], not shown])
            buffer.clear()

    def close() -> None:
        e = stack[-1]
        if e.tag in BLOCK:
            flush()
        stack.pop()
        if len(e.parts) > 1:
            h = xxhash.xxh64_intdigest(b"\0".join(e.parts), 1)
            stack[-1].parts.append(h.to_bytes(8, "little"))
            if not e.exempt:
                h = h - 2**64 if h >= 2**63 else h
                subtrees.add(h)
                for b in blocks[e.first :]:
                    b[1].append(h)

    at = 0
    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if html[m.start()] != "<" or m[0] == "<":
                buffer.append((m[0], stack[-1].dropped))
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    while len(stack) > i:
                        close()
                    break
                if stack[i].tag in ("article", "main", "td", "th", "table", "body") and tag not in BLOCK:
                    break
            continue
        if tag == "br" or tag == "hr" or tag == "wbr":
            if tag == "hr":
                flush()
            elif tag == "br":
                buffer.append((" ", stack[-1].dropped))
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            # The body is no markup: only its own closing tag ends it.
            if not m[3].endswith("/"):
                end = RAW_END[tag].search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in CLOSES_P or tag in SELF_CLOSING:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" and tag in CLOSES_P or stack[i].tag in SELF_CLOSING.get(tag, ()):
                    while len(stack) > i:
                        close()
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in BLOCK:
            flush()
        up = stack[-1]
        inside = up.inside or tag in ("article", "main")
        named = lists and bool(m[3].strip()) and (tag not in ("html", "body", "article", "main") or tag == "article" and up.inside) and is_furniture(tag, m[3])
        dropped = up.dropped or tag in NO_TEXT or named or lists and (tag in DROPPED or tag == "header" and not inside)
        stack.append(_Open(tag, dropped, inside, len(blocks), tag in ("html", "body", "article", "main") or inside and tag in EXEMPT and not dropped))
    flush()
    while len(stack) > 1:
        close()
    return list(subtrees), _finished(blocks)


def _finished(blocks: list[list]) -> list[tuple[str, list[int], bool]]:
    """Blocks with character references decoded and white space settled again."""
    out = []
    for text, path, listed in blocks:
        if "&" in text:
            text = " ".join(unescape(text).split())
        if text:
            out.append((text, path, listed))
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _parse(lists: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_type = pa.list_(pa.struct([("text", pa.string()), ("path", pa.list_(pa.int64())), ("listed", pa.bool_())]))
        for batch in batches:
            hosts, trees, found = [], [], []
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                subtrees, blocks = parse(html, lists)
                hosts.append(host_of(url))
                trees.append(subtrees)
                found.append([{"text": None if gone else t, "path": p, "listed": gone} for t, p, gone in blocks])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(trees, pa.list_(pa.int64())), pa.array(found, blocks_type)], names=["page_id", "url", "host", "subtrees", "blocks"]
            )

    return run


def _counted(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_pages: int, min_share: float, lists: bool) -> tuple[DataFrame, DataFrame]:
    """(parsed pages, template subtrees (host, h)); both are written tables."""
    scratch = Scratch(pages.sparkSession, "html")
    picked = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[html_col], F.lit("")).alias("html"))
    parsed = picked.mapInArrow(_parse(lists), "page_id long, url string, host string, subtrees array<long>, blocks array<struct<text:string,path:array<long>,listed:boolean>>")
    parsed = scratch.save(parsed.withColumn("uid", F.monotonically_increasing_id()), "parsed")
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    counts = parsed.select("host", F.explode("subtrees").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    return parsed, scratch.save(counts.join(sizes, "host").filter(F.col("n") >= F.col("pages") * min_share).select("host", "h"), "template")


def _dropped(paths: DataFrame, template: DataFrame) -> DataFrame:
    """uid and the template hashes around its blocks, of (uid, host, path)."""
    around = paths.select("uid", "host", F.explode(F.array_distinct(F.flatten("path"))).alias("h"))
    return around.join(template, ["host", "h"]).groupBy("uid").agg(F.collect_set("h").alias("dropped"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, lists: bool = True) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A subtree is template when it occurs on at least ``min_pages`` pages of
    its host and on ``min_share`` of them.  Null html counts as empty and
    gives the empty text; pages without a readable host share the empty host;
    repeated rows count as pages of their own and give repeated results.  An
    empty table gives an empty result; extra columns are not read.
    """
    parsed, template = _counted(pages, id_col, url_col, html_col, min_pages, min_share, lists)
    # Blocks that lists drop need no second opinion, so only the paths of the others travel.
    open_blocks = parsed.select("uid", "host", "page_id", "url", F.expr("filter(blocks, b -> not b.listed)").alias("blocks"))
    dropped = _dropped(open_blocks.select("uid", "host", F.col("blocks.path").alias("path")), template)
    bare = F.size(F.flatten("blocks.path")) == 0
    columns = ["uid", "page_id", "url", "blocks"]
    # Pages without any deletable subtree around their text, the usual case, are not shuffled.
    plain = open_blocks.filter(bare).select(*columns, F.lit(None).cast("array<long>").alias("dropped"))
    joined = open_blocks.filter(~bare).select(*columns).join(dropped, "uid", "left").select(*columns, "dropped")
    kept = F.expr("transform(filter(blocks, b -> dropped is null or not arrays_overlap(b.path, dropped)), b -> b.text)")
    return plain.union(joined).select("page_id", "url", F.array_join(kept, "\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def deletions(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, lists: bool = True) -> DataFrame:
    """Per row: page_id, its text blocks, those that the counts delete, those that the lists delete, and those that both do."""
    parsed, template = _counted(pages, id_col, url_col, html_col, min_pages, min_share, lists)
    dropped = _dropped(parsed.select("uid", "host", F.col("blocks.path").alias("path")), template)
    counted = "dropped is not null and arrays_overlap(b.path, dropped)"
    number = lambda c: F.expr(f"size(filter(blocks, b -> {c}))").cast("long")
    return parsed.join(dropped, "uid", "left").select(
        "page_id", F.size("blocks").cast("long").alias("n_blocks"), number(counted).alias("by_counts"), number("b.listed").alias("by_lists"), number(f"b.listed and {counted}").alias("by_both")
    )
