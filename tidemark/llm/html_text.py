"""Main text of web pages by wrapper induction.

The pages of a host are aligned with one of them, its reference, by simple tree matching: of
two nodes with the same label, the children are matched in order so that as many nodes as
possible correspond.  Text that nearly all aligned pages share with the reference is template;
what varies is content.  The counts cover all pages of a host and are summed map-side, so a
host with a third of all pages is no task of its own; only the reference page and the places of
its template texts are joined back.

Of the content, the parts that pages mark as something else are left out by element, role,
class and id: menus, headers, footers, sidebars, notices, adverts, forms, comments.  Where a
page marks an article (or else a main part), only that is read.  Words of a class that tell the
page's state ("has-sidebar") are no marks, an element with most of the text stays, and marks by
class and id do not count if nothing would be left.

Defined results: null and empty pages have an empty text; pages without a host are extracted
without a wrapper; references are decoded once; white space, no-break spaces too, becomes one
space; markup cut off at the end of a page is dropped; a page that would lose all its text to
the template keeps it; repeated pages are alike; other columns are never read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored

TEMPLATE_SHARE = 0.9  # of the pages aligned with a text, those that share it
ALIGNED_SHARE = 0.5  # of a host's pages, those aligned with it
LEAST_PAGES = 5  # different pages a template is induced from
REFERENCE_CHARS = 512  # a shorter page is a reference only if all are

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*)(?:>|\Z))", re.S)
NAMED = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKEN = re.compile(r"[a-z]+")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea noscript template iframe noframes noembed xmp svg".split())
DROPPED = frozenset("nav header footer aside form menu dialog search fieldset head".split())
INLINE_DROPPED = frozenset("button select label datalist audio video canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MARKS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget widgets ad ads "
    "advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe signup share sharing social related recommended comment "
    "comments commentlist respond reply replies disqus pagination pager login search toolbar skip".split())
HEADS = frozenset("header masthead banner".split())  # inside an article these hold its title
APART = frozenset(  # marks that even most of a page's text may bear
    "nav navbar navigation menu breadcrumb breadcrumbs footer pagination pager toolbar skip cookie cookies consent gdpr "
    "comment comments commentlist respond reply replies disqus".split())
STATES = frozenset("no has with without is open closed enabled disabled".split())  # of the page: "has-sidebar"
TITLED = frozenset("post entry article story content".split())  # as these do: "post-header"
CLOSES = {  # an opening tag ends the open elements named here, up to the one that limits it
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table thead tbody tfoot"), "td": ("td th", "tr"), "th": ("td th", "tr"),
    "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tr td th", "table"),
    "thead": ("caption", "table"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
TEXT = "#"
LEFT_OUT = ("head", "marked", "apart", "drop")


class Node:
    """An element, or a text between two blocks (label ``#``)."""
    __slots__ = ("label", "drop", "children", "text", "shape", "mark", "size", "leaf", "chars")

    def __init__(self, label: str, drop: str = "", text: str = ""):
        self.label, self.drop, self.text = label, drop, text
        self.children: list[Node] = []
        self.leaf = -1


@lru_cache(65_536)
def _role(tag: str, attributes: str) -> str:
    """Why an element is no content: "" (it is), "head" (unless in an article), "marked" or "apart" (by
    class or id; see `_kept`) or "drop"."""
    why = "head" if tag == "header" else "drop" if tag in DROPPED or tag in INLINE_DROPPED else ""
    if not attributes or tag in ("html", "body"):
        return why
    tokens: set[str] = set()
    for name, *values in NAMED.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") \
                or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return "drop"
        if name == "role" and value in ROLES:
            return "head" if value == "banner" else "drop"
        if name in ("class", "id"):
            for part in value.split():
                words = TOKEN.findall(part)
                if not (STATES & set(words)):
                    tokens.update(words)
    marks = tokens & MARKS
    if tokens & TITLED:
        marks -= HEADS
    if marks and why != "drop":
        return "head" if marks <= HEADS else "apart" if marks & APART else "marked"
    return why


def parse(page: str, marks: bool = True) -> Node:
    """The block structure of a page; inline markup is folded into the texts, of marked inline
    elements only without ``marks``."""
    root = Node("html")
    stack, run, skipped, depth = [root], [], "", 0
    at, size = 0, len(page)

    def flush() -> None:
        if run:
            text = "".join(run)
            run.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                stack[-1].children.append(Node(TEXT, text=text))

    while at < size:
        found = TAG.search(page, at)
        if not found:
            break
        if found.start() > at and not skipped:
            run.append(page[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(found[1])
        if skipped and tag not in BLOCKS:
            if tag == skipped:
                depth += -1 if closing else 1
                skipped = skipped if depth else ""
            if tag not in RAW:
                continue
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag not in BLOCKS:
            if tag in ("br", "wbr", "hr", "img"):
                run.append("" if tag == "wbr" else " ")
            elif not closing and _role(tag, found[3] or found[4] or "") in (LEFT_OUT if marks else ("drop",)) and not (found[3] or "").endswith("/") \
                    and tag not in ("input", "link", "meta", "source", "embed", "area", "base", "col", "param", "track"):
                skipped, depth = tag, 1
            continue
        flush()
        skipped = ""
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].label == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1].label == "p":
            stack.pop()
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].label in limits:
                    break
                if stack[k].label in ends:
                    del stack[k:]
        if tag in ("html", "body") and len(stack) > 1 and tag == "body" and stack[-1].label == "head":
            stack.pop()
        if tag == "html":
            continue
        node = Node(tag, _role(tag, found[3] or found[4] or ""))
        stack[-1].children.append(node)
        stack.append(node)
    if at < size and not skipped:
        run.append(page[at:])
    flush()
    _measure(root)
    return root


def _measure(root: Node) -> list[Node]:
    """Sets shape, mark (shape and text) and size of every node; numbers the texts in page order."""
    leaves: list[Node] = []
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        if node.label == TEXT:
            node.leaf = len(leaves)
            leaves.append(node)
        todo.extend(reversed(node.children))
    for node in reversed(order):
        if node.label == TEXT:
            node.shape, node.mark, node.size = 1, xxhash.xxh3_64_intdigest(node.text), 1
            node.chars = len(node.text)
        else:
            node.shape = hash((node.label, *[c.shape for c in node.children]))
            node.mark = hash((node.label, *[c.mark for c in node.children]))
            node.size = 1 + sum(c.size for c in node.children)
            node.chars = 0 if node.drop == "drop" else sum(c.chars for c in node.children)
    return leaves


Known = dict[tuple[int, int], int]  # matched nodes by the shapes of two trees


def matched(a: Node, b: Node, known: Known | None = None) -> int:
    """Simple tree matching: the most nodes of two trees that correspond in order.

    Pairs of subtrees are worked off from a stack, children first, so trees may be of any depth.
    """
    known, todo = {} if known is None else known, [(a, b)]
    while todo:
        x, y = todo[-1]
        pair = (x.shape, y.shape)
        if pair not in known:
            if x.label != y.label:
                known[pair] = 0
            elif x.shape == y.shape:
                known[pair] = x.size
            else:
                left, right = ({c.shape: c for c in n.children} for n in (x, y))
                open_pairs = [(p, q) for p in left.values() for q in right.values() if (p.shape, q.shape) not in known]
                if open_pairs:
                    todo.extend(open_pairs)
                    continue
                known[pair] = 1 + _best(x.children, y.children, known)[-1][-1]
        todo.pop()
    return known[a.shape, b.shape]


def _best(left: list[Node], right: list[Node], known: Known) -> list[list[int]]:
    table = [[0] * (len(right) + 1)]
    for x in left:
        above, row = table[-1], [0]
        for j, y in enumerate(right):
            row.append(max(row[j], above[j + 1], above[j] + known[x.shape, y.shape]))
        table.append(row)
    return table


def _table(left: list[Node], right: list[Node]) -> list[list[int]]:
    """Best matches of the first i nodes of one row with the first j of the other."""
    known: Known = {}
    for x in left:
        for y in right:
            if (x.shape, y.shape) not in known:
                matched(x, y, known)
    return _best(left, right, known)


def aligned(a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
    """Pairs of texts that correspond in a largest matching of two trees.

    Equal neighbours at both ends of a row of children belong to some largest matching, so only
    what lies between goes through the table; of equally large matchings, equal texts go first.
    """
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.label == TEXT:
            yield x, y
            continue
        p, q = x.children, y.children
        low, high_p, high_q = 0, len(p), len(q)
        while low < min(high_p, high_q) and p[low].mark == q[low].mark:
            todo.append((p[low], q[low]))
            low += 1
        while low < min(high_p, high_q) and p[high_p - 1].mark == q[high_q - 1].mark:
            high_p, high_q = high_p - 1, high_q - 1
            todo.append((p[high_p], q[high_q]))
        while low < min(high_p, high_q) and p[low].shape == q[low].shape:
            todo.append((p[low], q[low]))
            low += 1
        while low < min(high_p, high_q) and p[high_p - 1].shape == q[high_q - 1].shape:
            high_p, high_q = high_p - 1, high_q - 1
            todo.append((p[high_p], q[high_q]))
        left, right = p[low:high_p], q[low:high_q]
        if not left or not right:
            continue
        table = _table(left, right)
        i, j = len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((left[i], right[j]))


def _kept(root: Node) -> set[int]:
    """Elements that stay in spite of their class and id.

    One that holds most of the page's text, unless its marks set it apart; and the largest article
    or main part, with all that holds it, if its text exceeds all unmarked text outside of it.
    """
    kept: set[int] = set()
    best: tuple[Node | None, tuple] = (None, ())
    plain = 0  # characters without a mark
    todo: list[tuple[Node, tuple, bool, bool]] = [(root, (), False, False)]
    while todo:
        node, path, marked, apart = todo.pop()
        if node.label == TEXT:
            plain += 0 if marked else node.chars
            continue
        if node.drop == "drop":
            continue
        if node.drop in ("marked", "apart"):
            path, marked = (node, path), True
            if node.drop == "marked" and 2 * node.chars > root.chars:
                kept.add(id(node))
            apart = apart or (node.drop == "apart" and node.label not in ("article", "main"))
        if node.label in ("article", "main") and not apart and (best[0] is None or node.chars > best[0].chars):
            best = node, path
        todo.extend((c, path, marked, apart) for c in node.children)
    largest, path = best
    if largest is not None and path and largest.chars > plain:
        while path:
            kept.add(id(path[0]))
            path = path[1]
    return kept


def content(root: Node) -> list[Node]:
    """Texts of the article, or else the main part, or else the page, without what is marked otherwise;
    if that leaves nothing, marks by class and id do not count."""
    kept = _kept(root)
    for wanted, marks in (("article", True), ("main", True), ("", True), ("article", False), ("main", False), ("", False)):
        found: list[Node] = []
        todo = [(root, not wanted)]
        while todo:
            node, inside = todo.pop()
            if node.label == TEXT:
                if inside:
                    found.append(node)
                continue
            if node.drop == "drop" or (node.drop == "head" and not (inside and wanted)) \
                    or (marks and node.drop in ("marked", "apart") and id(node) not in kept):
                continue
            inside = inside or node.label == wanted
            todo.extend((c, inside) for c in reversed(node.children))
        if found:
            return found
    return []


def main_text(page: str | None, reference: Node | None = None, template: frozenset[int] = frozenset()) -> str:
    """The page's content without the texts aligned with the reference's template texts."""
    if not page:
        return ""
    root = parse(page)
    texts = content(root)
    if not texts:
        root = parse(page, marks=False)
        texts = content(root)
    if reference is not None and template and texts:
        constant = {x.leaf for x, y in aligned(root, reference) if y.leaf in template and x.text == y.text}
        texts = [t for t in texts if t.leaf not in constant] or texts
    return "\n".join(t.text for t in texts)


@lru_cache(512)
def _reference(page: str) -> Node:
    return parse(page)


def _host(url: str) -> Column:
    host = F.regexp_extract(F.lower(F.col(url).cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def wrappers(pages: DataFrame) -> DataFrame:
    """Per host of (page_id, host, html): the reference page and the numbers of its template texts."""
    size = F.length("html")
    chosen = pages.filter("host IS NOT NULL AND html <> ''").groupBy("host") \
        .agg(F.min(F.struct((size < REFERENCE_CHARS).alias("short"), size.alias("size"), F.xxhash64("html").alias("at")))
             .alias("first")).select("host", "first.at", "first.size")
    chosen = stored(chosen, "references")
    picked = pages.select("host", "html").withColumns({"at": F.xxhash64("html"), "size": F.length("html")}) \
        .join(chosen, ["host", "at", "size"]).groupBy("host").agg(F.min("html").alias("reference"))
    references = stored(picked, "reference-pages")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[int]] = {}
        hosts: dict[str, list[int]] = {}
        for batch in batches:
            for host, page, other in zip(*(c.to_pylist() for c in batch.columns)):
                root, reference = parse(page), _reference(other)
                if root.mark == reference.mark:
                    continue  # a copy of the reference tells nothing
                body = hash(tuple(t.mark for t in content(root)))
                own = hosts.setdefault(host, [0, 0])
                own[0] += 1
                own[1] |= 1 << (body & 63)
                for x, y in aligned(root, reference):
                    counts = seen.setdefault((host, y.leaf), [0, 0])
                    counts[0] += 1
                    counts[1] += x.mark == y.mark
        rows = [(h, -1, n, 0, bits - (1 << 64) if bits >> 63 else bits) for h, (n, bits) in hosts.items()]
        rows += [(h, leaf, n, same, 0) for (h, leaf), (n, same) in seen.items()]
        yield pa.RecordBatch.from_pydict(
            {k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(
                (("host", pa.string()), ("leaf", pa.int32()), ("seen", pa.int64()), ("same", pa.int64()), ("bits", pa.int64())))})

    counts = pages.filter("html IS NOT NULL").select("host", "html").join(references, "host").select("host", "html", "reference") \
        .mapInArrow(compare, "host string, leaf int, seen long, same long, bits long") \
        .groupBy("host", "leaf").agg(F.sum("seen").alias("seen"), F.sum("same").alias("same"), F.bit_or("bits").alias("bits"))
    counts = stored(counts, "alignments")
    hosts = counts.filter("leaf = -1").select("host", F.col("seen").alias("pages"), F.bit_count("bits").alias("bodies"))
    constant = counts.filter("leaf >= 0").join(hosts, "host") \
        .filter((F.col("bodies") >= LEAST_PAGES) & (F.col("same") >= LEAST_PAGES)
                & (F.col("same") >= TEMPLATE_SHARE * F.col("seen")) & (F.col("seen") >= ALIGNED_SHARE * F.col("pages"))) \
        .groupBy("host").agg(F.collect_list("leaf").alias("template"))
    return stored(references.join(constant, "host", "left"), "wrappers")


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, its main text and the text's length in code points."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), _host(url).alias("host"),
                        F.col(html).cast("string").alias("html"))
    found = wrappers(rows)

    def run(batch: pa.RecordBatch) -> dict:
        texts = []
        for page, other, leaves in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            texts.append(main_text(page, _reference(other) if leaves else None, frozenset(leaves or ())))
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "reference", "template")
    schema = joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return map_batches(joined, run, schema)
