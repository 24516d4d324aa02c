"""Main text of web pages by site template removal.

Every page is parsed into an element tree; each element's subtree (tag, attributes, text, children) is hashed.  Spark counts in
how many different pages of a host a subtree occurs.  Block subtrees (CANDIDATES) that recur in SHARE of the host's different pages, and in
`min_pages` at least, are its template and are deleted, as are elements that say themselves that they are not content (navigation, footers, asides,
forms, scripts, adverts, comments).  What stays, within <article> or <main> where a page has one, is the main text.

Within <article> or <main> single paragraphs are no candidates.  Recurring paragraphs and subtrees of PROSE or more words outside links stay where they outweigh
what else the page says: then the page is a near copy of others, not their template filled anew.
Identical pages count once.  Each page is parsed once, to its texts and its candidates' hashes; the hashes are joined with the templates by
(host, hash), and come back as one list per page; no html is shuffled, nothing is broadcast, and no host is gathered in one task.

Text: character references decoded, white space inside a block made one space, blocks joined by one space.  Null html: empty text.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import meet_hot, small_batches, stage
from .urlrules import host_of

MIN_PAGES = 2
SHARE = 0.5
PROSE = 20

# Element names of the HTML standard, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas audio video select".split())
NOT_CONTENT = frozenset("head nav footer aside form button dialog menu script style noscript template iframe textarea title svg math object canvas audio video select".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: Elements that can be a site's template; bare items, cells, headings, quotations and inline elements are not, only what holds them.
CANDIDATES = frozenset("address center details dir div dl fieldset header hgroup menu ol p section table ul".split())
#: An opening tag closes these open elements, up to the given ones.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CLOSES_P = BLOCK - {"dd", "dt", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary", "html", "body", "head"}
#: Words of class and id that mark furniture: whole names, or names of these words and BOXES alone.
FURNITURE = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login share sharing social related recommended comments comment disqus respond replies reply pagination pager toolbar widget skip".split())
#: Words that only say what kind of box an element is.
BOXES = frozenset("area bar block body bottom box button buttons container content fixed group header heading inner item items left link links list main mobile module outer page panel primary right secondary section site slot sticky strip text title top unit wrap wrapper zone".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "attrs", "items", "parent", "hash")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag, self.attrs, self.items, self.parent, self.hash = tag, attrs, [], parent, 0


def parse(page: str) -> Node:
    """The element tree; text items are raw strings.  Unclosed and stray tags are taken as browsers take them, roughly."""
    root = node = Node("", {}, None)
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            node.items.append(page[at:])
            break
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        if not m.group(2):
            if m.group().startswith("<![CDATA["):
                node.items.append(_html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag = m.group(2).lower()
        if m.group(1):
            up = node
            while up.parent is not None and up.tag != tag:
                if tag not in BLOCK and up.tag in BLOCK:  # a stray inline end tag does not close a block
                    up = root
                    break
                up = up.parent
            if up.parent is not None:
                node = up.parent
            continue
        if tag in CLOSES:
            shut, stop = CLOSES[tag]
            up, last = node, None
            while up.parent is not None and up.tag not in stop:
                if up.tag in shut:
                    last = up
                up = up.parent
            node = last.parent if last is not None else node
        if tag in CLOSES_P:
            up = node
            while up.parent is not None and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        attrs = {k.lower(): _html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(m.group(3))} if "=" in m.group(3) else {}
        new = Node(tag, attrs, node)
        node.items.append(new)
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            new.items.append(page[at : stop.start() if stop else end])
            at = page.find(">", stop.end()) + 1 or end if stop else end
        elif tag not in VOID:
            node = new
    return root


def walk(root: Node) -> list[Node]:
    """Elements in document order, parents first; no recursion, so depth does not matter."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [x for x in reversed(n.items) if isinstance(x, Node)]
    return out


def hash_subtrees(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        h = xxhash.xxh3_64(n.tag)
        for k, v in sorted(n.attrs.items()):
            h.update(f"\0{k}={v}")
        for x in n.items:
            if isinstance(x, Node):
                h.update(x.hash.to_bytes(8, "little"))
            else:
                h.update("\1" + " ".join(x.split()))
        n.hash = h.intdigest()


def is_furniture(n: Node) -> bool:
    """Elements that say themselves that they are not content."""
    if n.tag in NOT_CONTENT or "hidden" in n.attrs or n.attrs.get("aria-hidden") == "true" or n.attrs.get("role", "").lower() in ROLES:
        return True
    if n.tag == "header":  # a page's header, not an article's
        return not any(a.tag == "article" for a in _ancestors(n))
    marks = f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}".lower() if n.attrs else ""
    return n.tag not in ("html", "body", "article", "main") and any(names_furniture(name) for name in marks.split())


def names_furniture(name: str) -> bool:
    """Such as sidebar, main-menu, ad_box2; not side-effects or menu-analysis."""
    words = set(_WORD.findall(name))
    return not words.isdisjoint(FURNITURE) and words <= FURNITURE | BOXES


def _ancestors(n: Node) -> Iterator[Node]:
    while n.parent is not None:
        n = n.parent
        yield n


def main_region(nodes: list[Node]) -> list[Node]:
    """<main> where it holds all top-level <article> elements, else these, else <main>, else the whole page; none within furniture."""
    found = {tag: [n for n in nodes if n.tag == tag and not any(a.tag == tag or is_furniture(a) for a in _ancestors(n)) and not is_furniture(n)] for tag in ("article", "main")}
    if found["main"] and all(any(a.tag == "main" for a in _ancestors(n)) for n in found["article"]):
        return found["main"]
    return found["article"] or nodes[:1]


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def page_parts(page: str) -> tuple[list[str], list[int], list[tuple[int, int, int, bool]]]:
    """The main region's texts without furniture, block by block, their words outside links, and the candidates: subtree hash, first text, end, whether a paragraph."""
    nodes = walk(parse(page))
    hash_subtrees(nodes)
    texts: list[str] = []
    prose: list[int] = []
    found: list[list[int]] = []
    line: list[str] = []
    plain: list[str] = []

    def close() -> None:
        text = " ".join(_html.unescape("".join(line)).split())
        if text:
            texts.append(text)
            prose.append(len(_html.unescape("".join(plain)).split()))
        line.clear()
        plain.clear()

    for r in main_region(nodes):
        marked = r.parent is not None
        todo: list = [(r, False)]
        while todo:
            x, linked = todo.pop()
            if isinstance(x, int):
                close()
                if x >= 0:
                    found[x][2] = len(texts)
            elif isinstance(x, str):
                line.append(x)
                plain.append(" " if linked else x)
            elif x is not r and is_furniture(x):
                if x.tag in BLOCK:
                    close()
                else:
                    line.append(" ")
                    plain.append(" ")
            elif x.tag == "br":
                line.append(" ")
                plain.append(" ")
            else:
                if x.tag in BLOCK:
                    close()
                    mine = -1
                    if x is not r and x.tag in CANDIDATES and not (marked and x.tag == "p"):
                        mine = len(found)
                        found.append([signed(x.hash), len(texts), 0, x.tag == "p"])
                    todo.append((mine, False))
                todo += [(y, linked or x.tag == "a") for y in reversed(x.items)]
        close()
    return texts, prose, [(h, i, j, p) for h, i, j, p in found if j > i]


def main_text(texts: list[str], prose: list[int], found: list[tuple[int, int, int, bool]], template: set[int]) -> str:
    """The texts outside template subtrees."""
    short, long, end = set(), set(), 0
    for h, i, j, p in found:  # parents first
        if i >= end and h in template:
            (long if p or sum(prose[i:j]) >= PROSE else short).update(range(i, j))
            end = j
    if sum(prose[i] for i in long) > sum(prose[i] for i in range(len(texts)) if i not in long and i not in short):
        long = set()
    return " ".join(t for i, t in enumerate(texts) if i not in long and i not in short)


def _text_batch(b: pa.RecordBatch, out: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars (code points) of every row.

    Null or repeated ids, urls and rows are kept as they are; extra columns are ignored; an empty table gives an empty result.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.withColumn("page_key", F.unhex(F.md5(F.concat_ws("\n", F.col("host"), F.col("html")))))

    own = [rows.schema["page_id"], rows.schema["url"]]
    schema = T.StructType([*own, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    parsed = T.StructType([*own, T.StructField("host", T.StringType()), T.StructField("page_key", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("parts", T.BinaryType())])

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            found = [page_parts(p) for p in b.column("html").to_pylist()]
            packed = [press.compress(json.dumps((t, w, [x[1:] for x in c]), ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")) for t, w, c in found]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("host"), b.column("page_key"), pa.array([[x[0] for x in c] for _, _, c in found], pa.list_(pa.int64())), pa.array(packed, pa.binary())], names=parsed.names)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for hashes, packed, template in zip(b.column("hashes").to_pylist(), b.column("parts").to_pylist(), b.column("template").to_pylist(), strict=True):
                t, w, spans = json.loads(press.decompress(packed).decode("utf-8", "surrogatepass"))
                out.append(main_text(t, w, [(h, *span) for h, span in zip(hashes, spans, strict=True)], set(template or ())))
            yield _text_batch(b, out)

    pages_ = stage(rows.select("page_id", "url", "html", "host", "page_key").mapInArrow(parts_of, parsed), "pages")
    parts = pages_.select("host", "page_key", F.explode("hashes").alias("hash")).distinct()
    sizes = pages_.select("host", "page_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = parts.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    often = meet_hot(often, stage(sizes, "hosts"), "host", "pages").filter(F.col("n") >= SHARE * F.col("pages"))
    template = stage(often.select(F.struct("host", "hash").alias("place"), "hash", "n"), "template")
    held = parts.select("page_key", F.struct("host", "hash").alias("place"))
    mine = meet_hot(held, template, "place", "n").groupBy("page_key").agg(F.collect_list("hash").alias("template"))  # at most a page's own elements
    small_batches(pages.sparkSession)
    joined = pages_.join(mine, "page_key", "left").select("page_id", "url", "hashes", "parts", "template")
    return joined.mapInArrow(texts, schema)
