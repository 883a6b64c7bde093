"""Main text of web pages by wrapper induction.

A page becomes a tree of labelled elements; siblings with one label are merged, so a list or a run of
paragraphs is one node. For each host, ``REFERENCES`` pages chosen by a hash of their ids are references, and
every page of the host is aligned with them by simple tree matching (the largest order-preserving
mapping of equal labels). The alignment gives the host's wrapper:

* A text that stands at a matched node of the reference and of at least ``CONSTANT`` of the host's pages is *template*.
* What varies at matched nodes is counted by slot, the path of labels. The *content slot* is found from the root down: a
  step is made to the part that holds at least ``CONTENT`` of the varying text, as long as no heading that varies is left out.

A page's text is what stands below its host's content slot and is not template. Pages with equal skeletons are copies and
count as one page, here and among the references. Elements that say by their tag, class or role that they are menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments have no text at all. Only where there is
no wrapper (a host with fewer than ``MIN_PAGES`` different pages, a page without the slot) the page's own article element, or else blocks
that are not mostly links, stand for the content slot.

Only skeletons (labels, text hashes and lengths) are joined and counted; the page text is read once more at the
end. Whole pages are parsed, broken ones as browsers would: missing end tags are closed, a tag cut off by
the end of the page is dropped.

Null and empty pages have an empty text. Null URLs and URLs without a host belong to no host, so they have no wrapper.
Rows are judged one by one; repeated rows give repeated rows; an empty table gives an
empty result. Only id, URL and html are read.
"""

from __future__ import annotations

import html as entities
import re
import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, texts, written

REFERENCES, CONSTANT, MIN_PAGES = 3, 0.9, 5
#: A part with this share of the varying text of the part around it holds the content. Slots of fewer pages than ``SLOT_PAGES`` of a host's don't count.
CONTENT, SLOT_PAGES = 0.75, 0.5
#: Deeper elements count as children of the last level, but are opened and closed like all others. More inline elements
#: than that within one block are only counted. Children lists longer than WIDE lose their order.
MAX_DEPTH, WIDE = 100, 64
#: Long text inside the article is never template.
ARTICLE_WORDS = 40

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements whose own text is a block; the content slot is never one of them.
TEXTUAL = HEADINGS | set("p pre li dt dd blockquote figcaption caption summary address td th".split())
RAW = set("script style title textarea noscript iframe template xmp noembed".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option select caption".split()
)
REGIONS = set("nav footer aside form script style noscript iframe template head select button textarea svg canvas object embed dialog menu input title math audio video datalist".split())
REGION_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
REGION_NAMES = set(
    "nav navbar navigation menu menubar sidebar footer ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments commentlist disqus replies respond "
    "toolbar widget masthead topbar".split()
)
CLOSES_P = BLOCK - {"body", "head", "html", "option", "select", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
CLOSES_SELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_STOP = re.compile(r"""[>"']""")


#: The two lowest bits of a label say what kind of element it is: one that holds others, one that holds text alone, a heading.
PART, TEXT, HEADING = 1, 2, 3


def step(label: int, above: int) -> int:
    """The path of a label below the path ``above``."""
    return zlib.crc32(label.to_bytes(4, "little"), above)


class Element:
    __slots__ = ("tag", "name", "number", "path", "parted", "parent", "region", "article", "depth", "inline", "surplus")

    def __init__(self, tag: str, label: str, parent: Element | None, region: bool, article: bool, inline: int = 0):
        if parent and parent.depth > MAX_DEPTH:
            parent = parent.parent
        self.tag, self.name, self.parent, self.region, self.article = tag, label, parent, region, article
        #: Label and path as numbers, and whether other elements with text stand in this one; known when the page has been read.
        self.number, self.path, self.parted = 0, 0, False
        self.depth = parent.depth + 1 if parent else 0
        #: Inline elements since the last block, this one included, and those that were too many to open.
        self.inline, self.surplus = inline, None


class Block:
    """Text between two block boundaries."""

    __slots__ = ("element", "parts", "region", "article", "linked", "text")

    def __init__(self, element: Element):
        self.element, self.parts, self.region, self.article, self.linked = element, [], element.region, element.article, 0


def _end_of_tag(page: str, at: int, unclosed: set[str]) -> int:
    """Place of the ``>`` that ends the tag; -1 if there is none. Quoted ones don't."""
    first = page.find(">", at)
    while True:
        m = _STOP.search(page, at)
        if not m:
            return -1
        if m.group() == ">":
            return m.start()
        close = -1 if m.group() in unclosed else page.find(m.group(), m.end())
        if close < 0:
            unclosed.add(m.group())
            return first
        at = close + 1


def _made(tag: str, attributes: str, parent: Element) -> Element:
    names: list[str] = []
    region, article = parent.region or tag in REGIONS, parent.article
    label = tag
    if attributes.strip(" /\t\r\n"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                names += re.split(r"[\s_-]+", value)
                if key == "class" and value:
                    label = f"{tag}.{re.sub(r'[0-9]+', '', value.split()[0])}" if value.split() else tag
            elif key == "role":
                region = region or value in REGION_ROLES
            elif key == "style":
                region = region or "display:none" in value.replace(" ", "")
            else:
                region = region or key == "hidden" or value == "true"
        region = region or (tag not in ("html", "body") and not REGION_NAMES.isdisjoint(names))
    if tag == "header" or "header" in names and tag not in ("html", "body"):
        region = region or not article
    article = not region and (article or tag in ("article", "main"))
    return Element(tag, label, parent, region, article, 0 if tag in BLOCK else parent.inline + 1)


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in page order."""
    root = Element("", "", None, False, False)
    stack, out = [root], []
    block = Block(root)
    at, size, unclosed = 0, len(page), set()
    #: Places of the open blocks in the stack by their tag. Only inline elements are taken out from between others, and none below a block.
    opened: dict[str, list[int]] = defaultdict(list)

    def shut(k: int) -> None:
        """Closes the element at ``k`` and all in it."""
        for e in stack[k:]:
            if e.tag in BLOCK:
                opened[e.tag].pop()
        del stack[k:]

    def last(tag: str) -> int:
        return opened[tag][-1] if opened[tag] else 0

    def cut() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                out.append(block)
        block = Block(stack[-1])

    def text(piece: str) -> None:
        if block.element.region or not piece:
            return
        top = stack[-1]
        if top.region:
            return
        piece = entities.unescape(piece) if "&" in piece else piece
        block.parts.append(piece)
        if any(e.tag == "a" for e in stack[-3:]):
            block.linked += len(piece)

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            text(page[at:])
            break
        if begin > at:
            text(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        m = _TAG.match(page, begin + 1)
        if not m:
            if page[begin + 1 : begin + 2] in ("!", "?", "/"):
                end = page.find(">", begin)
                at = size if end < 0 else end + 1
            else:
                text("<")
                at = begin + 1
            continue
        end = _end_of_tag(page, m.end(), unclosed)
        if end < 0:
            break
        tag, closing = m.group(1).lower(), page[begin + 1] == "/"
        at = end + 1
        if closing:
            if tag in BLOCK:
                if last(tag):
                    cut()
                    shut(last(tag))
                    block = Block(stack[-1])
            elif stack[-1].surplus and stack[-1].surplus[tag]:
                stack[-1].surplus[tag] -= 1
            else:
                # Inline end tags never close a block.
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        region = stack[k].region
                        del stack[k]
                        if region:
                            cut()
                        break
                    if stack[k].tag in BLOCK:
                        break
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            # Whatever is inside is no text of the page.
            at = size if not close else close.start()
            if close:
                end = page.find(">", at)
                at = size if end < 0 else end + 1
            continue
        if tag in BLOCK:
            cut()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        shut(k)
                        break
                    if stack[k].tag in BLOCK:
                        break
            if tag in CLOSES_SELF and last(tag) > max(map(last, CLOSES_SELF[tag])):
                shut(last(tag))
        elif tag == "br":
            text(" ")
        if tag not in VOID and not page.startswith("/", end - 1) or tag in BLOCK and tag != "hr":
            parent = stack[-1]
            element = _made(tag, page[m.end() : end], parent)
            if tag in BLOCK:
                opened[tag].append(len(stack))
                stack.append(element)
            elif parent.inline < MAX_DEPTH or element.region and not parent.region:
                stack.append(element)
            else:
                parent.surplus = parent.surplus or Counter()
                parent.surplus[tag] += 1
        if tag in BLOCK:
            block = Block(stack[-1])
    cut()
    settle(out)
    return out


def settle(found: list[Block]) -> None:
    """Labels and paths of the elements above the blocks."""
    for b in found:
        e = b.element
        while e.parent is not None and not e.parent.parted:
            e = e.parent
            e.parted = True
    for b in found:
        line, e = [], b.element
        while e.parent is not None and not e.number:
            line.append(e)
            e = e.parent
        for e in reversed(line):
            kind = HEADING if e.tag in HEADINGS else PART if e.parted and e.tag in BLOCK and e.tag not in TEXTUAL else TEXT
            e.number = zlib.crc32(e.name.encode()) & ~3 | kind
            e.path = step(e.number, e.parent.path)


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 0) >> 1


# A skeleton is a row for each element that leads to a block: depth, label or 0 for a text, hash and length of the text.
_NODE = struct.Struct("<BIqI")
def skeleton(found: list[Block]) -> bytes:
    """Elements above the blocks in page order, and hashes of the blocks' texts."""
    out, open_path = [], []
    for b in found:
        line, e = [], b.element
        while e.parent is not None:
            line.append(e)
            e = e.parent
        line.reverse()
        same = 0
        while same < min(len(line), len(open_path)) and line[same] is open_path[same]:
            same += 1
        out += [_NODE.pack(min(x.depth, 255), x.number, 0, 0) for x in line[same:]]
        open_path = line
        out.append(_NODE.pack(min(len(line) + 1, 255), 0, text_hash(b.text), min(len(b.text), 0xFFFFFFFF)))
    return b"".join(out)


class Tree:
    """A skeleton as a tree whose neighbours with one label are merged."""

    __slots__ = ("label", "path", "children", "texts")

    def __init__(self, label: int, path: int):
        self.label, self.path, self.children = label, path, []
        #: Length of each text by its hash.
        self.texts: dict[int, int] = {}

    @classmethod
    def of(cls, packed: bytes) -> Tree:
        root = cls(0, 0)
        stack: list[Tree] = [root]
        for depth, label, text, length in _NODE.iter_unpack(packed):
            del stack[max(depth, 1) :]
            top = stack[-1]
            if not label:
                top.texts[text] = length
                continue
            last = top.children[-1] if top.children else None
            if last is None or last.label != label:
                same = [c for c in top.children if c.label == label] if len(top.children) >= WIDE else []
                last = same[0] if same else None
                if last is None:
                    last = cls(label, step(label, top.path))
                    top.children.append(last)
            stack.append(last)
        return root


def match(a: Tree, b: Tree) -> tuple[int, list[tuple[Tree, Tree]]]:
    """Simple tree matching: the size of the largest mapping of two trees with equal roots, and its pairs."""
    m, n = len(a.children), len(b.children)
    size = [[0] * (n + 1) for _ in range(m + 1)]
    own: dict[tuple[int, int], tuple[int, list]] = {}
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            x, y = a.children[i - 1], b.children[j - 1]
            best = max(size[i - 1][j], size[i][j - 1])
            if x.label == y.label:
                own[i, j] = match(x, y)
                best = max(best, size[i - 1][j - 1] + own[i, j][0])
            size[i][j] = best
    pairs, i, j = [(a, b)], m, n
    while i and j:
        if (i, j) in own and size[i][j] == size[i - 1][j - 1] + own[i, j][0]:
            pairs += own[i, j][1]
            i, j = i - 1, j - 1
        elif size[i][j] == size[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return size[m][n] + 1, pairs


def constants(page: Tree, reference: Tree) -> set[int]:
    """Texts that both trees have at matched nodes."""
    out: set[int] = set()
    for x, y in match(page, reference)[1]:
        out |= x.texts.keys() & y.texts.keys()
    return out


def slots(page: Tree, same: set[int]) -> Iterator[tuple[int, int, int, int]]:
    """Path, parent's path, kind and varying characters of every slot of a page; ``same`` are its texts that don't vary."""
    found: dict[int, list[int]] = {}
    todo = [(page, 0)]
    while todo:
        node, above = todo.pop()
        own = found.setdefault(node.path, [above, node.label & 3, 0])
        own[2] += sum(n for t, n in node.texts.items() if t not in same)
        todo += [(c, node.path) for c in node.children]
    for path, (above, kind, n) in found.items():
        yield path, above, kind, n


def content_slot(found: list[tuple[int, int, int, int]]) -> int:
    """The path of the part that holds a host's content, from its slots; 0, the whole page, if there is no such part."""
    below: dict[int, list[int]] = defaultdict(list)
    kind, own = {}, {}
    for path, above, k, n in found:
        kind[path], own[path] = k, n
        if path != above:
            below[above].append(path)
    # Slots deeper than others come after them in a walk from the root, so sums go backwards.
    walk = [0]
    for path in walk:
        walk += below[path]
    mass, heading = {}, {}
    for path in reversed(walk):
        mass[path] = own.get(path, 0) + sum(mass[c] for c in below[path])
        heading[path] = kind.get(path) == HEADING and own[path] > 0 or any(heading[c] for c in below[path])
    at = 0
    while below[at]:
        best = max(below[at], key=lambda c: (mass[c], c))
        left_out = any(heading[c] for c in below[at] if c != best)
        if kind[best] != PART or mass[best] < CONTENT * mass[at] or not mass[best] or left_out:
            break
        at = best
    return at


def inside(b: Block, slot: int) -> bool:
    """Whether a block stands below the slot."""
    e = b.element
    while e.parent is not None:
        if e.path == slot:
            return True
        e = e.parent
    return False


def main_text(found: list[Block], template: set[int], slot: int = 0) -> str:
    """The blocks that are content, joined by spaces."""
    body = [b for b in found if not b.region]
    own = [b for b in body if inside(b, slot)] if slot else []
    if own:
        body = own
    elif any(b.article for b in body):
        body = [b for b in body if b.article]
    else:
        # Without an article, blocks that are mostly links are menus.
        body = [b for b in body if 2 * b.linked <= sum(map(len, b.parts))]
    kept = []
    for b in body:
        if not template or text_hash(b.text) not in template or (own or b.article) and b.text.count(" ") >= ARTICLE_WORDS:
            kept.append(b.text)
    return " ".join(kept)


def host(url: str):
    """The host of a URL column as an expression; empty if there is none."""
    u = F.coalesce(F.col(url), F.lit(""))
    after = F.when(u.contains("://"), F.regexp_replace(u, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    return F.lower(F.regexp_extract(after, r"^[^/?#]*", 0))


def wrappers(rows: DataFrame) -> DataFrame:
    """``host, template, slot``: hashes of the texts that are template on each host of ``id, host, html``, and its content slot."""

    def bones(b: pa.RecordBatch) -> pa.RecordBatch:
        packed = [skeleton(blocks(h)) for h in texts(b["html"])]
        return pa.RecordBatch.from_arrays([b["host"], b["rank"], pa.array(packed, pa.binary())], names=["host", "rank", "bones"])

    ranked = rows.where("host != ''").select("host", F.xxhash64("id", "html").alias("rank"), "html")
    # Copies of a page, refetched or under several URLs, are no evidence of what its host repeats.
    distinct = map_rows(ranked, bones, "host string, rank long, bones binary").groupBy("host", "bones").agg(F.min("rank").alias("rank"))
    seen = written(distinct, "page-skeletons")
    by_host = seen.groupBy("host", F.pmod("rank", F.lit(REFERENCES)).alias("k")).agg(F.count("*").alias("n"), F.min_by("bones", "rank").alias("reference"))
    hosts = by_host.groupBy("host").agg(F.sum("n").alias("pages"), F.collect_list("reference").alias("references")).where(F.col("pages") >= MIN_PAGES)
    chosen = written(hosts, "page-references")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text that a page shares with a reference (its hash), and for each of its slots."""
        known: dict[str, list[tuple[bytes, Tree]]] = {}
        for b in batches:
            out: list[tuple] = []
            for name, packed, refs in zip(b["host"].to_pylist(), b["bones"].to_pylist(), b["references"], strict=True):
                if name not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[name] = [(r, Tree.of(r)) for r in refs.as_py()]
                page = Tree.of(packed)
                same: set[int] = set()
                others: set[int] = set()
                for r, tree in known[name]:
                    shared = constants(page, tree)
                    same |= shared
                    # A reference repeats itself in full, which says nothing about what varies.
                    others |= shared if r != packed else set()
                out += [(name, t, None, None, None, None) for t in same]
                out += [(name, None, *slot) for slot in slots(page, others)]
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = (pa.string(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "text", "path", "above", "kind", "chars"])

    columns = "host string, text long, path long, above long, kind long, chars long"
    matched = seen.join(chosen.select("host", "references"), "host").select("host", "bones", "references").mapInArrow(aligned, columns)
    counted = written(matched.groupBy("host", "text", "path", "above", "kind").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")), "page-slots")
    shares = counted.join(chosen.select("host", "pages"), "host")
    constant = shares.where(F.col("text").isNotNull() & (F.col("n") >= CONSTANT * F.col("pages"))).groupBy("host").agg(F.collect_list("text").alias("template"))
    # Slots that half of the pages have are at most twice as many as a page has on average.
    common = shares.where(F.col("path").isNotNull() & (F.col("n") >= SLOT_PAGES * F.col("pages")))
    listed = common.groupBy("host").agg(F.collect_list(F.struct("path", "above", "kind", "chars")).alias("found"))

    def choose(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [content_slot([(s["path"], s["above"], s["kind"], s["chars"]) for s in some]) for some in b["found"].to_pylist()]
        return pa.RecordBatch.from_arrays([b["host"], pa.array(found, pa.int64())], names=["host", "slot"])

    return map_rows(listed, choose, "host string, slot long").join(constant, "host", "left").select("host", "template", "slot")


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` for every page."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    found = written(wrappers(rows.select("id", "host", "html")), "page-wrappers")
    joined = rows.join(found, "host", "left").select("id", "url", "html", "template", "slot")
    kind = dict(rows.dtypes)["id"]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(texts(b["html"]), b["template"].to_pylist(), b["slot"].to_pylist(), strict=True)
        out = [main_text(blocks(h), set(t or ()), s or 0) for h, t, s in found]
        return pa.RecordBatch.from_arrays([b["id"], b["url"], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["id", "url", "text", "n_chars"])

    return map_rows(joined, run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
