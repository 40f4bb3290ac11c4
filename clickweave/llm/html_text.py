"""Main text of web pages by wrapper induction.

Method. The pages of a host share a wrapper. Each page's DOM tree (block
elements, after menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments known by element, role, class or id are
cut off) is aligned with the tree of the host's reference page by simple tree
matching: the largest order-preserving matching of equally labelled nodes
under matched parents. A block's places are the slot of the reference it is
aligned with and its path of labels and orders, counted from the front and
from the back. Where a page marks its article (``article``, else ``main`` or
the role ``main``), only blocks inside it count, and its headline (``h1``, and
blocks that say the same) is never template.

Where pages mark nothing, the wrapper is told by place alone, whatever its
words: of the containers of the reference, the smallest that holds at least
``CONTENT_SHARE`` of all words of the host's different pages is where content
is, and blocks that are not in what aligns with it (menus, adverts, footers,
as a rule of varying words) are left out; headlines stay, and so does all of
a page that has nothing there. A host needs ``LEAST_PAGES`` different pages for that.

A text at a place is template on its own evidence: at least ``MIN_SHARE`` of
the host's different pages have it there, and what else these pages hold
amounts to a whole page. A page adds the share of its words that are neither
on both reference pages nor in blocks which most pages of the host have. So
two pages are enough where they differ in half of their words, and copies
and near copies of a page, which differ in few, are no evidence; but a text
that fewer than ``FEW`` pages have goes only if no page of the host is without
it. A page that deviates keeps its own block and changes nothing on the others.

Parsing takes time in proportion to the page: what is open is counted by
element, so no search for what is not there walks the stack, and elements
deeper than ``DEEPEST`` are held by the one above, as browsers do. Alignment
takes time by the product of the lengths of two lists of children that differ,
and memory by the longer one and the root of the other.

Plan: a first parse gives each page's shape, the kinds of places its texts
have. Of the pages with text in the host's commonest shape the smallest and
the largest page_id (partial aggregates) are its references, the smallest for
the alignment. Of these only the tree without texts and the common words are
kept, so that the table is small; pages meet it in a join that AQE splits for
a hot host, and are parsed again and aligned. The blocks are written; different pages are told by a hash of their
texts, counts of texts at places are exact and use partial aggregates over all
pages; the template, again a written table, is joined back and filtered in
native array functions.

Defined results: null and empty html give an empty text; a null or odd url is
the host ''; a null page_id is never a reference, and a host without any page_id has no
evidence; repeated rows are extracted each and count as one page for the evidence;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import math
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.session import staged

MIN_SHARE = 0.5
FEW = 4
CONTENT_SHARE, LEAST_PAGES = 0.6, 3
DEEPEST = 256
#: Pairs of children beyond which the table of two lists' alignment is not kept whole, but made again in parts.
MOST_PAIRS = 1 << 21
#: Weights of pairs of subtrees that are remembered.
MOST_WEIGHTS = 1 << 20
#: Evidence is summed in millionths of a page, so that sums are exact.
WHOLE_PAGE = 1_000_000

# HTML elements by kind, and the words in classes and ids that name boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CUT = frozenset("aside button canvas dialog footer form head iframe input label map menu nav noscript object option script select style svg template textarea title video audio".split())
CUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion recommended related respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Words that may stand beside those in a class or id: "sidebar-left" and "related-posts" are boilerplate, "has-sidebar" and "related-work" are not.
BESIDE_WORDS = frozenset(
    "area article articles bar bottom box container content footer form global group inner item items left line link links list main message mobile outer overlay page panel post posts primary right secondary section site slot text title top unit wrap wrapper".split()
)
#: Places of other people's texts, which may be articles of their own.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond".split())
#: Elements whose id may name boilerplate; ids of headings, paragraphs and inline elements are anchors.
HOLDERS = frozenset("article aside center dd details div dl fieldset figure footer form header li nav ol section table tbody td tr ul".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: A start tag ends an open element of these kinds, up to the element that holds them.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

# An attribute's value may be quoted; quotes elsewhere are characters as any other. No part of a tag is tried twice.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
_UNCLOSED = re.compile(r"<[a-z!?/]", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element: label, child nodes, texts directly inside, and its place among the page's nodes."""

    __slots__ = ("label", "children", "texts", "shape", "size", "place")

    def __init__(self, label: str) -> None:
        self.label, self.children, self.texts = label, [], []
        self.shape, self.size, self.place = None, 1, -1


def _named(tokens: str, in_article: bool) -> set[str]:
    """The boilerplate words of class or id tokens that consist of such words and of those that may stand beside them."""
    found = set()
    for token in tokens.split():
        words = {w.lower() for w in _WORD.findall(token)}
        if in_article:
            words.discard("header")
        if words <= CUT_WORDS | BESIDE_WORDS:
            found |= words & CUT_WORDS
    return found


def _boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether the element is cut off, whether it is so only by words that a wrapper of the article may have, and its role."""
    gone = tag in CUT or tag == "header" and not in_article
    if not attributes:
        return gone, False, ""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    if tag in ("html", "body", "article", "main") and role not in CUT_ROLES and tag != "article":
        return False, False, role
    words = _named(found.get("class", ""), in_article) | (_named(found.get("id", ""), in_article) if tag in HOLDERS else set())
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    gone = gone or role in CUT_ROLES or hidden
    return gone or bool(words), not gone and bool(words) and words.isdisjoint(COMMENT_WORDS), role


def parse(source: str) -> tuple[Node, list[str]]:
    """Tree of the block elements that remain, and the texts of its blocks in page order.

    Where words in classes and ids have cut off all articles and main parts
    that have text, the elements around them are wrappers and stay.
    """
    return parse_marked(source)[:2]


def parse_marked(source: str) -> tuple[Node, list[str], bool]:
    """``parse``, and whether the page marks an article or main part."""
    root, texts, marked, wrappers = _parse(source, frozenset())
    if wrappers and not marked:
        whole = _parse(source, wrappers)
        if whole[2]:
            return whole[:3]
    return root, texts, marked


def _parse(source: str, wrappers: frozenset[int]) -> tuple[Node, list[str], bool, frozenset[int]]:
    """Tree and texts, whether they are of an article or main part, and the starts of the elements around such parts that words cut off."""
    root = Node("")
    # open elements: tag, node that takes the text, cut off, inside an article, inside a main part, and
    # the starts of the elements around it that only words cut off, as (start, those further out) (None: cut off by others too)
    stack = [("", root, False, False, False, ())]
    open_tags: Counter = Counter()
    around: set[int] = set()
    depth = {id(root): 0}
    blocks: list[tuple[Node, str, bool, bool]] = []
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, node, _, article, main, _ = stack[-1]
                blocks.append((node, text, article, main))

    def close(i: int) -> None:
        open_tags.subtract(s[0] for s in stack[i:])
        del stack[i:]

    at, swallowed = 0, False
    last = source.rfind(">") + 1  # no tag ends beyond it
    for token in _TOKEN.finditer(source, 0, last):
        if token.start() > at and not stack[-1][2]:
            parts.append(source[at : token.start()])
        at = token.end()
        tag = token.group(3)
        if tag is None:
            if at == last:  # a comment or script without an end takes all that is left
                whole, name = token.group(), token.group(1)
                swallowed = whole.startswith("<!--") and not whole.endswith("-->") or bool(name) and not re.search(rf"</{name}\s*>\Z", whole, re.I)
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if block and not stack[-1][2]:
            flush()
        if token.group(2):
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[i][0] == tag:
                    if not stack[-1][2]:
                        flush()
                    close(i)
                    break
                if not block and stack[i][0] in BLOCK:
                    break  # an inline end tag doesn't end blocks
            continue
        if tag in VOID:
            continue
        ends = ENDS.get(tag)
        there = tag in CLOSES_P and open_tags["p"] or ends and any(open_tags[x] for x in ends[0])
        for i in range(len(stack) - 1, 0, -1) if there else ():
            if ends and stack[i][0] in ends[1]:
                break
            if ends and stack[i][0] in ends[0] or tag in CLOSES_P and stack[i][0] == "p":
                if not stack[-1][2]:
                    flush()
                close(i)
                break
        _, node, cut, article, main, by_words = stack[-1]
        gone, weak, role = _boilerplate(tag, token.group(4), article)
        if weak and token.start() in wrappers:
            gone = False
        if block and not cut and not gone and depth[id(node)] < DEEPEST:
            child = Node(tag)
            depth[id(child)] = depth[id(node)] + 1
            node.children.append(child)
            node = child
        if not cut and gone:
            flush()
        starts = tag in ("article", "main") or role == "main"
        if starts and not gone and cut and by_words and not article:
            further = by_words
            while further and further[0] not in around:
                around.add(further[0])
                further = further[1]
        if gone:
            by_words = (token.start(), by_words) if weak and by_words is not None else None
        open_tags[tag] += 1
        stack.append((tag, node, cut or gone, article or tag == "article" and not gone, main or (tag == "main" or role == "main") and not gone, by_words))
    if at < len(source) and not swallowed and not stack[-1][2]:
        unclosed = _UNCLOSED.search(source, max(at, last))
        parts.append(source[at : unclosed.start() if unclosed else len(source)])
    flush()
    marked = False
    for place in (2, 3):
        if any(b[place] for b in blocks):
            blocks, marked = [b for b in blocks if b[place]], True
            break
    for i, (node, *_) in enumerate(blocks):
        node.texts.append(i)
    _measure(root)
    return root, [b[1] for b in blocks], marked, frozenset(around)


def _measure(root: Node) -> None:
    """Shape (labels of the whole subtree), size and place of every node, without recursion."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.place = len(order)
        order.append(node)
        todo.extend(reversed(node.children))
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.children)
        node.shape = xxhash.xxh3_64_intdigest(f"{node.label}({','.join(str(c.shape) for c in node.children)})")


def matching(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of the largest matching of two trees with equally labelled roots."""
    weights: dict[tuple[int, int], int] = {}

    def align(left: list[Node], right: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
        """Best alignment of two child lists; equal shapes at both ends always match."""
        pairs, i, j = [], 0, 0
        n, m = len(left), len(right)
        while i < n and i < m and left[i].shape == right[i].shape:
            pairs.append((left[i], right[i]))
            i += 1
        while j < n - i and j < m - i and left[n - 1 - j].shape == right[m - 1 - j].shape:
            pairs.append((left[n - 1 - j], right[m - 1 - j]))
            j += 1
        total = sum(p.size for p, _ in pairs)
        left, right = left[i : n - j], right[i : m - j]
        if len(left) * len(right) > MOST_PAIRS:
            size, found = _align_long(left, right, weight)
            total += size
            pairs += found
        elif left and right:
            table = [[0] * (len(right) + 1)]
            for x in left:
                last, row = table[-1], [0]
                for k, y in enumerate(right):
                    best = last[k + 1] if last[k + 1] >= row[k] else row[k]
                    if x.label == y.label and (w := last[k] + weight(x, y)) > best:
                        best = w
                    row.append(best)
                table.append(row)
            total += table[-1][-1]
            x, y = len(left), len(right)
            while x and y:
                if table[x][y] == table[x - 1][y]:
                    x -= 1
                elif table[x][y] == table[x][y - 1]:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    pairs.append((left[x], right[y]))
        return total, pairs

    def weight(x: Node, y: Node) -> int:
        if x.shape == y.shape:
            return x.size
        if not x.children or not y.children:
            return 1
        key = (x.shape, y.shape)
        known = weights.get(key)
        if known is None:
            known = 1 + align(x.children, y.children)[0]
            if len(weights) >= MOST_WEIGHTS:
                weights.clear()
            weights[key] = known
        return known

    # a level of the tree takes four calls at most
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEEPEST))
    found, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        found.append((x, y))
        todo.extend(align(x.children, y.children)[1])
    return found


def _align_long(left: list[Node], right: list[Node], weight: Callable[[Node, Node], int]) -> tuple[int, list[tuple[Node, Node]]]:
    """The alignment that the whole table gives, of lists of any length: every so many rows are kept, and those between made again on the way back."""
    kinds: dict[tuple, int] = {}
    first: list[Node] = []
    of = np.empty(len(right), np.int32)
    for k, y in enumerate(right):
        kind = (y.label, y.shape)
        if kind not in kinds:
            kinds[kind] = len(first)
            first.append(y)
        of[k] = kinds[kind]
    by_label: dict[str, list[int]] = {}
    for i, y in enumerate(first):
        by_label.setdefault(y.label, []).append(i)

    gained: dict[tuple, np.ndarray] = {}

    def row_after(row: np.ndarray, x: Node) -> np.ndarray:
        kind = (x.label, x.shape)
        gain = gained.get(kind)
        if gain is None:
            each = np.zeros(len(first), np.int32)
            for i in by_label.get(x.label, ()):
                each[i] = weight(x, first[i])
            gain = each[of]
            if len(gained) >= MOST_PAIRS // len(right):
                gained.clear()
            gained[kind] = gain
        out = np.zeros(len(right) + 1, np.int32)
        np.maximum(row[1:], row[:-1] + gain, out=out[1:])
        return np.maximum.accumulate(out, out=out)

    step = math.isqrt(len(left)) + 1
    row = np.zeros(len(right) + 1, np.int32)
    kept = [row]
    for i, node in enumerate(left):
        row = row_after(row, node)
        if (i + 1) % step == 0:
            kept.append(row)
    total, pairs = int(row[-1]), []
    x, y = len(left), len(right)
    while x and y:
        start = (x - 1) // step * step
        rows = [kept[start // step]]
        for node in left[start:x]:
            rows.append(row_after(rows[-1], node))
        while x > start and y:
            here, above = rows[x - start], rows[x - start - 1]
            if here[y] == above[y]:
                x -= 1
            elif here[y] == here[y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                pairs.append((left[x], right[y]))
    return total, pairs


def _paths(root: Node) -> dict[int, tuple[str, str]]:
    """For each text of the tree its path of labels and orders to the root, counted from the front and from the back."""
    found, todo = {}, [(root, 0, 0)]
    while todo:
        node, front, back = todo.pop()
        n = len(node.texts)
        for i, text in enumerate(node.texts):
            found[text] = f"f{front}.{i}", f"b{back}.{n - 1 - i}"
        n = len(node.children)
        for i, child in enumerate(node.children):
            todo.append((child, xxhash.xxh3_64_intdigest(f"{front}/{child.label}{i}"), xxhash.xxh3_64_intdigest(f"{back}/{child.label}{n - 1 - i}")))
    return found


def _skeleton(root: Node) -> str:
    """A tree without its texts: label, number of texts and of child nodes of each node, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(f"{node.label},{len(node.texts)},{len(node.children)}")
        todo.extend(reversed(node.children))
    return " ".join(out)


def _tree(skeleton: str) -> Node:
    """The tree of a skeleton; its texts are numbered by node."""
    top = Node("")
    slots, todo = 0, [(top, 1)]
    for item in skeleton.split(" "):
        label, texts, children = item.split(",")
        node = Node(label)
        node.texts = list(range(slots, slots + int(texts)))
        slots += len(node.texts)
        parent, left = todo.pop()
        parent.children.append(node)
        if left > 1:
            todo.append((parent, left - 1))
        if int(children):
            todo.append((node, int(children)))
    _measure(top.children[0])
    return top.children[0]


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skeleton of each host's first reference page, and the words that both have."""
    for batch in batches:
        trees, common = [], []
        for first, last in zip(batch.column("first"), batch.column("last"), strict=True):
            root, own = parse(first.as_py() or "")
            trees.append(_skeleton(root))
            common.append(" ".join((_counts(own) & _counts(parse(last.as_py() or "")[1])).elements()))
        yield pa.record_batch([batch.column("host"), pa.array(trees, pa.string()), pa.array(common, pa.string())], names=["host", "skeleton", "common"])


def _counts(texts: list[str]) -> Counter:
    return Counter(w for text in texts for w in text.split())


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each page, a hash of each text with each of its places, and how many words are not on both references."""
    known: dict[str, tuple[Node, Counter]] = {}
    for batch in batches:
        keys, texts, sizes, novel, places_of = [], [], [], [], []
        for host, skeleton, shared, source in zip(*(batch.column(c) for c in ("host", "skeleton", "common", "html")), strict=True):
            host = host.as_py()
            if host not in known:
                if len(known) >= 64:
                    known.clear()
                known[host] = _tree(skeleton.as_py() or ",0,0"), _counts([shared.as_py() or ""])
            reference, common = known[host]
            root, found, marked = parse_marked(source.as_py() or "")
            places, pairs = _paths(root), matching(reference, root)
            for x, y in pairs:
                for slot, text in zip(x.texts, y.texts, strict=False):
                    places[text] += (f"s{slot}",)
            headlines = _headlines(root)
            if marked:
                said = {found[i] for i in headlines}
                places.update((i, ()) for i, text in enumerate(found) if text in said)
            places_of.append(None if marked or not skeleton.is_valid else _under(root, {id(y): x.place for x, y in pairs if x.children}, headlines, len(found)))
            keys.append([[xxhash.xxh3_64_intdigest(f"{place} {text}") - (1 << 63) for place in places[i]] for i, text in enumerate(found)])
            texts.append(found)
            sizes.append([len(text.split()) for text in found])
            novel.append(sum((_counts(found) - common).values()) if skeleton.is_valid else 0)
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(keys, pa.list_(pa.list_(pa.int64()))), pa.array(texts, pa.list_(pa.string())), pa.array(sizes, pa.list_(pa.int64())), pa.array(novel, pa.int64()), pa.array(places_of, pa.list_(pa.list_(pa.int32())))],
            names=["page_id", "url", "host", "keys", "texts", "sizes", "novel", "places"],
        )


def _headlines(root: Node) -> list[int]:
    """Texts of first-level headings."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.label == "h1":
            found += node.texts
        todo.extend(node.children)
    return found


def _under(root: Node, aligned: dict[int, int], headlines: list[int], n: int) -> list[list[int]]:
    """For each text the places of the reference's containers that the elements around it are aligned with (-1: a headline)."""
    out: list[list[int]] = [[] for _ in range(n)]
    todo: list[tuple[Node, list[int]]] = [(root, [])]
    while todo:
        node, above = todo.pop()
        if id(node) in aligned:
            above = [*above, aligned[id(node)]]
        for i in node.texts:
            out[i] = above
        todo.extend((child, above) for child in node.children)
    for i in headlines:
        out[i] = [*out[i], -1]
    return out


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shape of each page, the kinds of places that its texts have, and a hash of its texts; none of a page without text."""
    for batch in batches:
        shapes, pages = [], []
        for source in batch.column("html"):
            root, found = parse(source.as_py() or "")
            kinds, todo = set(), [(root, "")]
            while todo:
                node, above = todo.pop()
                kind = xxhash.xxh3_64_hexdigest(f"{above}/{node.label}")
                if node.texts:
                    kinds.add(kind)
                todo.extend((child, kind) for child in node.children)
            shapes.append(xxhash.xxh3_64_intdigest(" ".join(sorted(kinds))) - (1 << 63) if found else None)
            pages.append(xxhash.xxh3_64_intdigest("\n".join(found)) - (1 << 63))
        yield pa.record_batch([batch.column("page_id"), batch.column("host"), pa.array(shapes, pa.int64()), pa.array(pages, pa.int64())], names=["page_id", "host", "shape", "page"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, and ``n_template``, the template blocks left out."""
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    shapes = staged(pages.mapInArrow(_shapes, f"page_id {id_type}, host string, shape long, page long").where("shape is not null"), "shapes")
    # copies of a page speak once for its shape
    shapes = shapes.groupBy("host", "shape", "page").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b"))
    shapes = shapes.groupBy("host", "shape").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n")).where("a is not null")
    chosen = staged(shapes.groupBy("host").agg(F.max_by(F.struct("a", "b"), F.struct("n", "shape")).alias("of")).select("host", "of.*"), "references")
    # a repeated page_id may give several rows: the longest is the reference, by one partial aggregate
    ends = chosen.select("host", F.explode(F.array_distinct(F.array("a", "b"))).alias("page_id"))
    named = pages.select("page_id", "html", "host").join(ends, ["host", "page_id"]).join(chosen, "host")
    html = F.coalesce("html", F.lit(""))
    references = named.groupBy("host").agg(*(F.max(F.when(F.col("page_id") == F.col(end), html)).alias(name) for end, name in (("a", "first"), ("b", "last"))))
    references = staged(references.mapInArrow(_references, "host string, skeleton string, common string"), "reference-pages")
    joined = pages.join(references, "host", "left").select("page_id", "url", "html", "host", "skeleton", "common")
    blocks = staged(joined.mapInArrow(_aligned, f"page_id {id_type}, url string, host string, keys array<array<long>>, texts array<string>, sizes array<long>, novel long, places array<array<int>>"), "blocks")
    template = staged(_template(blocks).join(_content(blocks), "host", "full"), "template")
    none = F.array().cast("array<long>")
    rows = blocks.select("page_id", "url", "host", "keys", "texts", "places").join(template, "host", "left").withColumn("template", F.coalesce("template", none))
    # a page without a block in the content's place keeps all
    inside = F.when(F.exists("places", lambda p: F.array_contains(p, F.col("content"))), F.col("places"))
    rows = rows.withColumn("inside", F.coalesce(F.transform(inside, lambda p: F.array_contains(p, F.col("content")) | F.array_contains(p, F.lit(-1))), F.transform("keys", lambda k: F.lit(True))))
    kept = F.filter(F.arrays_zip("keys", "texts", "inside"), lambda b: b["inside"] & ~F.arrays_overlap("template", b["keys"]))
    text = F.array_join(F.transform(kept, lambda b: b["texts"]), " ")
    rows = rows.withColumn("text", text)
    left = F.size("texts") - F.size(kept)
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), left.cast("long").alias("n_template"))


def _content(blocks: DataFrame) -> DataFrame:
    """``host, content``: the place in the reference where pages that mark nothing have their content."""
    pages = blocks.where("places is not null and size(texts) > 0").groupBy("host", F.xxhash64("texts").alias("page")).agg(F.max(F.struct("sizes", "places")).alias("p"))
    pages = staged(pages.select("host", "p.*"), "unmarked-pages")
    zero = F.lit(0).cast("long")
    whole = pages.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.aggregate("sizes", zero, lambda a, x: a + x)).alias("words"))
    held = pages.select("host", F.explode(F.arrays_zip("sizes", "places")).alias("b")).select("host", F.explode("b.places").alias("place"), F.col("b.sizes").alias("words"))
    held = held.where("place >= 0").groupBy("host", "place").agg(F.sum("words").alias("held")).join(whole, "host")
    # two places with more than half of the words lie one in the other, the inner one behind
    found = held.where((F.col("pages") >= LEAST_PAGES) & (F.col("held") >= CONTENT_SHARE * F.col("words")))
    return found.groupBy("host").agg(F.max("place").alias("content"))


def _template(blocks: DataFrame) -> DataFrame:
    """``host, template``: the hashes of texts at places that are template."""
    whole = F.xxhash64("texts")
    pages = blocks.where(F.size("texts") > 0).groupBy("host", whole.alias("page")).agg(F.max(F.struct("novel", "sizes", "keys")).alias("p"))
    pages = staged(pages.select("host", "p.*"), "different-pages")
    each = F.explode(F.array_distinct(F.flatten("keys")))
    often = pages.select("host", each.alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where("n > 1")
    often = often.join(pages.groupBy("host").agg(F.count("*").alias("pages")), "host")
    often = often.where((F.col("n") >= MIN_SHARE * F.col("pages")) & ((F.col("n") >= FEW) | (F.col("n") == F.col("pages"))))
    often = staged(often.groupBy("host").agg(F.collect_list("key").alias("often")), "often")
    rare = F.filter(F.arrays_zip("keys", "sizes"), lambda b: ~F.arrays_overlap("often", b["keys"]))
    zero = F.lit(0).cast("long")
    total = F.aggregate("sizes", zero, lambda a, x: a + x)
    own = F.least("novel", F.aggregate(rare, zero, lambda a, b: a + b["sizes"]))
    judged = pages.join(often, "host").select("host", F.expr("array_intersect(flatten(keys), often)").alias("found"), F.floor(WHOLE_PAGE * own / total).alias("evidence"))
    judged = judged.select("host", F.explode("found").alias("key"), "evidence").groupBy("host", "key").agg(F.sum("evidence").alias("evidence"))
    return judged.where(F.col("evidence") >= WHOLE_PAGE).groupBy("host").agg(F.collect_list("key").alias("template"))
