"""HTML extraction by wrapper induction.

Pages of a host that have their text in the same kind of place share a layout. From some pages of each
layout a wrapper is induced: their DOM trees, with like siblings folded into one node, are aligned by
simple tree matching and merged. The element that holds most of the text that varies from page to page
is the content; among the elements on the way to it, an article or main element is preferred. Every
page is then aligned with the wrapper of its layout, and the text of what lies at the content's place
is kept, but for elements whose tag, class or role says that they are no part of an article.

Which text is constant is counted over all pages of a layout, each different page once: a text that
stands at the same place on nearly all of them is template and goes where the content is no element
of its own but the whole page, or is not found. Within the content, and within an article or main
element, it stays, so that a paragraph that pages share is not lost. A page that its wrapper does not
fit is read by the same rules on its own.

Nothing here recurses: trees are walked with stacks of their own, so pages may be nested at any depth.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscore.llm.groups import by_group
from logscore.llm.stored import stored
from logscore.llm.words import by_run

#: Different pages of a layout whose trees are aligned.
PAGES_PER_LAYOUT = 12
#: A text is template if it stands on so many different pages of a layout, and on this share of them.
LEAST_PAGES = 3
LEAST_SHARE = 0.9
#: Share of the varying text that the content holds.
HOLDS = 0.8

# Elements by how HTML treats them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
    "ul".split()
)
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPES = frozenset("html body table td th ul ol dl article main section div aside nav".split())

#: Elements that are never article text, and classes, ids and roles that say so. A class or id counts
#: only as a whole: "no-comments" and "search-result" are something else.
NEVER = frozenset(
    "head script style noscript template iframe svg canvas object select button textarea input nav "
    "aside form footer menu dialog title xmp noembed noframes".split()
)
NEVER_NAMED = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer login menu modal nav navbar "
    "navigation newsletter notice pagination pager popup promo related search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget "
    "ad-banner ad-container ad-slot advert-box comment-form comment-list comments-area "
    "cookie-banner cookie-consent cookie-notice main-nav newsletter-signup page-footer "
    "related-posts search-form share-buttons site-footer site-nav social-share".split()
)
#: These only outside of the content: an article has a header of its own.
OUTSIDE = frozenset("header".split())
OUTSIDE_NAMED = frozenset("header masthead page-header site-header".split())
MAIN = ("article", "main")
#: No class or role makes these anything else than what they are.
KEPT = frozenset(("html", "body", *MAIN))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?|\"[^\"]*\"|'[^']*'"
)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_DIGITS = re.compile(r"[0-9]+")


@dataclass(eq=False)
class Node:
    tag: str
    names: frozenset = frozenset()
    sign: str = ""
    hidden: bool = False
    items: list = field(default_factory=list)  # texts and nodes in order
    holds_block: bool = False

    def never(self) -> bool:
        if self.tag in KEPT:
            return self.hidden and self.tag in MAIN
        return self.hidden or self.tag in NEVER or not NEVER_NAMED.isdisjoint(self.names)

    def outside(self) -> bool:
        return self.tag in OUTSIDE or not OUTSIDE_NAMED.isdisjoint(self.names)

    def in_line(self) -> bool:
        """Whether the node is part of its parent's text."""
        return self.tag in _INLINE and not self.holds_block and not self.never()


def _node(tag: str, attributes: str) -> Node:
    """A node with its whole classes, id and role; digits do not tell signs apart."""
    names, classes, hidden = set(), set(), False
    for match in _ATTRIBUTE.finditer(attributes) if attributes else ():
        name = (match[1] or "").lower()
        value = next((v for v in match.groups()[1:] if v is not None), "").lower()
        if name == "style":
            hidden |= bool(_UNSEEN.search(value))
        elif name == "hidden":
            hidden = True
        elif name in ("class", "id", "role"):
            names.update(value.split())
            if name != "id":
                classes.update(_DIGITS.sub("", value).split())
    return Node(tag, frozenset(names), f"{tag}.{' '.join(sorted(classes))}", hidden)


def parse(page: str) -> Node:
    """The tree of a page, end tags supplied where they are left out. Texts are not yet decoded."""
    root = Node("html", sign="html.")
    stack, open_, at = [root], Counter(["html"]), 0

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            open_[node.tag] -= 1
        del stack[depth:]

    def add(text: str) -> None:
        if text:
            stack[-1].items.append(text)

    while match := _TOKEN.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        if not match[2]:
            continue
        tag = match[2].lower()
        if match[1]:
            if open_[tag]:
                depth = len(stack) - 1
                while depth and stack[depth].tag != tag:
                    depth -= 1
                if depth:
                    cut(depth)
            continue
        if tag in ("html", "body") and open_[tag]:
            continue
        closes = {"p"} if tag in _CLOSES_P else set()
        closes |= _CLOSED_BY.get(tag, set())
        if any(open_[x] for x in closes):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in closes:
                    cut(depth)
                    break
                if stack[depth].tag in _SCOPES:
                    break
        made = _node(tag, match[3])
        stack[-1].items.append(made)
        if tag not in _INLINE:
            for above in reversed(stack):
                if above.tag not in _INLINE or above.holds_block:
                    break
                above.holds_block = True
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = len(page) if close < 0 else close + 1
        elif tag not in _VOID and not match[3].endswith("/"):
            stack.append(made)
            open_[tag] += 1
    add(page[at:])
    return root


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def own_parts(node: Node) -> tuple[str, list[Node]]:
    """The text of a node itself, inline elements included, and the blocks in it."""
    texts: list[str] = []
    kids: list[Node] = []
    stack = [iter(node.items)]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            texts.append(" ")
        elif isinstance(item, str):
            texts.append(item)
        elif item.in_line():
            texts.append(" ")
            stack.append(iter(item.items))
        else:
            texts.append(" ")
            kids.append(item)
    return _clean("".join(texts)), kids


@dataclass(eq=False)
class Shape:
    """A node of a folded tree: all siblings of one sign. `text` is None where it varies from page to
    page, `pages` is how many show the node."""

    sign: str
    text: str | None = ""
    chars: int = 0
    never: bool = False
    kids: list[Shape] = field(default_factory=list)
    pages: int = 1

    def order(self) -> list[Shape]:
        """All nodes, each after its parent."""
        found = [self]
        for shape in found:
            found += shape.kids
        return found


def shape_of(root: Node) -> tuple[Shape, dict[int, list[Node]], dict[int, int]]:
    """The folded tree of a page, the nodes folded into each shape, and for each block the key of its
    place and text (by `id`)."""
    top = Shape(root.sign)
    nodes: dict[int, list[Node]] = {id(top): [root]}
    keys: dict[int, int] = {}
    todo = [(root, top, b"")]
    while todo:
        node, shape, above = todo.pop()
        text, kids = own_parts(node)
        place = hashlib.blake2b(above + node.sign.encode(), digest_size=16).digest()
        if text:
            shape.text = f"{shape.text}\n{text}" if shape.text else text
            shape.chars += len(text)
            key = hashlib.blake2b(place + text.encode(errors="replace"), digest_size=8).digest()
            keys[id(node)] = int.from_bytes(key, "big", signed=True)
        by_sign = {kid.sign: kid for kid in shape.kids}
        found = []
        for kid in kids:
            like = by_sign.get(kid.sign)
            if like is None:
                like = by_sign[kid.sign] = Shape(kid.sign, never=kid.never())
                shape.kids.append(like)
            like.never &= kid.never()
            nodes.setdefault(id(like), []).append(kid)
            found.append((kid, like, place))
        todo += reversed(found)
    return top, nodes, keys


def match_trees(a: list, b: list, size) -> list[tuple[int, int]]:
    """Simple tree matching of two lists of siblings: the heaviest pairs in order.

    `size(x, y)` is the weight of a pair, 0 if it does not match.
    """
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        above, row = best[i], best[i + 1]
        for j, y in enumerate(b):
            row[j + 1] = max(row[j], above[j + 1], above[j] + size(x, y))
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def matched(a: Shape, b: Shape) -> tuple[int, dict[tuple[int, int], list[tuple[int, int]]]]:
    """How many nodes of two trees match, and for each pair of nodes the numbers of the kids that do.

    Pairs are found from the roots down and worked out from the leaves up, each once: the cost is at
    most the product of the sizes. A node matches one of the same sign.
    """
    if a.sign != b.sign:
        return 0, {}
    order = [(a, b)]
    for x, y in order:
        signs = {kid.sign: kid for kid in y.kids}
        order += ((kid, signs[kid.sign]) for kid in x.kids if kid.sign in signs)
    sizes: dict[tuple[int, int], int] = {}
    pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x, y in reversed(order):
        found = match_trees(x.kids, y.kids, lambda p, q: sizes.get((id(p), id(q)), 0))
        pairs[id(x), id(y)] = found
        sizes[id(x), id(y)] = 1 + sum(sizes[id(x.kids[i]), id(y.kids[j])] for i, j in found)
    return sizes[id(a), id(b)], pairs


def merge(a: Shape, b: Shape) -> Shape:
    """Both trees in one: pairs merged, the other nodes kept in order."""
    _, pairs = matched(a, b)

    def both(x: Shape, y: Shape) -> Shape:
        text = x.text if x.text == y.text else None
        return Shape(x.sign, text, x.chars + y.chars, x.never and y.never, [], x.pages + y.pages)

    top = both(a, b)
    todo = [(a, b, top)]
    while todo:
        x, y, made = todo.pop()
        i = j = 0
        for p, q in [*pairs[id(x), id(y)], (len(x.kids), len(y.kids))]:
            signs = {kid.sign for kid in x.kids[i:p]}
            made.kids += x.kids[i:p] + [k for k in y.kids[j:q] if k.sign not in signs]
            if p < len(x.kids):
                made.kids.append(both(x.kids[p], y.kids[q]))
                todo.append((x.kids[p], y.kids[q], made.kids[-1]))
            i, j = p + 1, q + 1
    return top


def _weights(top: Shape, varying: bool) -> dict[int, int]:
    """Characters in and below each node outside of what is never article text."""
    weights: dict[int, int] = {}
    for shape in reversed(top.order()):
        own = 0 if varying and shape.text is not None else shape.chars
        below = sum(weights[id(kid)] for kid in shape.kids)
        weights[id(shape)] = 0 if shape.never else own + below
    return weights


def _content(top: Shape) -> list[int] | None:
    """Where the content lies in a wrapper, as numbers of kids from the root; None without any
    varying text.

    From the root on the kid is entered that holds most of all varying text, as long as it has blocks
    in it. Of the nodes entered the innermost article or main element is taken, else the last one.
    """
    weights = _weights(top, varying=True)
    total, shape, path, main = weights[id(top)], top, [], None
    if not total:
        return None
    while True:
        heaviest = [(weights[id(kid)], -i) for i, kid in enumerate(shape.kids) if kid.kids]
        most, i = max(heaviest, default=(0, 0))
        if most < HOLDS * total:
            return path if main is None else main
        shape = shape.kids[-i]
        path = [*path, -i]
        if shape.sign.split(".")[0] in MAIN:
            main = path


def layout_of(top: Shape) -> str:
    """The signs on the way to where most of a page's text is, as far as an article or main."""
    weights = _weights(top, varying=False)
    signs, shape = [], top
    while shape.sign.split(".")[0] not in MAIN:
        heaviest = [(weights[id(kid)], -i) for i, kid in enumerate(shape.kids) if kid.kids]
        most, i = max(heaviest, default=(0, 0))
        if most * 2 <= weights[id(top)]:
            break
        shape = shape.kids[-i]
        signs.append(shape.sign)
    return "/".join(signs)


@dataclass
class Wrapper:
    """A merged tree, the place of the content in it, and the keys of template texts."""

    shape: Shape
    content: list[int] | None
    template: frozenset = frozenset()

    def dump(self) -> str:
        order = self.shape.order()
        number = {id(shape): i for i, shape in enumerate(order)}
        above = {id(kid): number[id(shape)] for shape in order for kid in shape.kids}
        nodes = [[shape.sign, above.get(id(shape), -1)] for shape in order]
        return json.dumps([nodes, self.content, sorted(self.template)])

    @classmethod
    def load(cls, text: str) -> Wrapper:
        nodes, content, template = json.loads(text)
        shapes = [Shape(sign) for sign, _ in nodes]
        for shape, (_, above) in zip(shapes, nodes, strict=True):
            if above >= 0:
                shapes[above].kids.append(shape)
        return cls(shapes[0], content, frozenset(template))


def is_template(times: int, pages: int) -> bool:
    return times >= LEAST_PAGES and times >= LEAST_SHARE * pages


def induce(pages: list[str]) -> Wrapper | None:
    """The wrapper of some pages of a layout. Equal pages count once."""
    different = list(dict.fromkeys(pages))
    if not different:
        return None
    merged, times = None, Counter()
    for page in different:
        shape, _, keys = shape_of(parse(page))
        times.update(set(keys.values()))
        merged = shape if merged is None else merge(merged, shape)
    template = (key for key, n in times.items() if is_template(n, len(different)))
    return Wrapper(merged, _content(merged), frozenset(template))


def _mains_of(root: Node) -> list[Node]:
    """The articles of a page that no wrapper fits: its main elements that lie in no other one."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in MAIN:
            found.append(node)
            continue
        stack += [x for x in reversed(node.items) if not isinstance(x, str) and not x.never()]
    return found


def blocks(node: Node, dropped: set[int] | None = None, whole: bool = False) -> list[str]:
    """The blocks of text of a tree. `dropped` has the nodes (by `id`) whose own text is template;
    a `whole` page also loses what has its place outside of an article."""
    result: list[str] = []
    texts: list[str] = []
    dropped = dropped or set()

    def flush() -> None:
        text = _clean("".join(texts))
        if text:
            result.append(text)
        texts.clear()

    # Within an article or main element texts stay; inline elements do not end a block.
    main = node.tag in MAIN
    stack = [(iter(node.items), not main and id(node) in dropped, main, False)]
    while stack:
        items, lost, main, inline = stack[-1]
        item = next(items, None)
        if item is None:
            stack.pop()
            if not inline:
                flush()
        elif isinstance(item, str):
            if not lost:
                texts.append(item)
        elif item.tag == "br":
            texts.append(" ")
        elif item.never() or whole and not main and item.outside():
            flush()
        elif item.tag in _INLINE:
            stack.append((iter(item.items), lost, main, True))
        else:
            flush()
            main = main or item.tag in MAIN
            stack.append((iter(item.items), not main and id(item) in dropped, main, False))
    return result


def extract(page: str, wrapper: Wrapper | None) -> str:
    """The main text of a page: blocks in page order with an empty line between."""
    root = parse(page)
    found: list[str] = []
    if wrapper is not None and wrapper.content is not None:
        shape, nodes, keys = shape_of(root)
        place = _place(shape, wrapper)
        dropped = {node for node, key in keys.items() if key in wrapper.template}
        if place is not None:
            whole = place.sign.split(".")[0] in ("html", "body")
            dropped = dropped if whole else set()
            found = [x for node in nodes[id(place)] for x in blocks(node, dropped, whole)]
        else:
            found = _by_rules(root, dropped)
    return "\n\n".join(found or _by_rules(root, set()))


def _by_rules(root: Node, dropped: set[int]) -> list[str]:
    mains = _mains_of(root)
    if mains:
        return [x for node in mains for x in blocks(node)]
    return blocks(root, dropped, whole=True)


def _place(shape: Shape, wrapper: Wrapper) -> Shape | None:
    """The node of a page's folded tree that is aligned with the wrapper's content."""
    _, pairs = matched(shape, wrapper.shape)
    other = wrapper.shape
    if not pairs:
        return None
    for number in wrapper.content:
        kids = {j: i for i, j in pairs[id(shape), id(other)]}
        if number not in kids:
            return None
        shape, other = shape.kids[kids[number]], other.kids[number]
    return shape


_OUTLINED = (
    "page_id bigint, url string, html string, layout bigint, page_hash bigint, keys array<bigint>"
)


def _hash(*texts: str) -> int:
    joined = "\0".join(texts).encode(errors="replace")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "big", signed=True)


def outlined(pages: DataFrame) -> DataFrame:
    """`page_id`, `url` and `html` of each page with its `layout` (a hash of host and layout), a hash
    of the page, and the `keys` of its texts and their places; written and read again."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[^:/?#]+://([^/?#]*)", 1))
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")
    )

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        layouts, hashes, keys = [], [], []
        for page, host in zip(run.column("html").to_pylist(), run.column("host").to_pylist(), strict=True):
            shape, _, found = shape_of(parse(page))
            layouts.append(_hash(host, layout_of(shape)))
            hashes.append(_hash(page))
            keys.append(sorted(set(found.values())))
        arrays = [run.column(c) for c in ("page_id", "url", "html")]
        arrays += [pa.array(layouts, pa.int64()), pa.array(hashes, pa.int64())]
        arrays.append(pa.array(keys, pa.list_(pa.int64())))
        names = ["page_id", "url", "html", "layout", "page_hash", "keys"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return stored(rows.mapInArrow(by_run(work, "html"), _OUTLINED), "outlines", "zstd")


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """`layout` and `wrapper` (JSON) of each layout, from the result of `outlined`.

    Trees come from `PAGES_PER_LAYOUT` different pages of a layout, those with the smallest hashes;
    template texts are counted over all of its different pages. Copies are counted once, and counts
    are added up before rows are shuffled, so a hot layout is in no one task.
    """
    different = pages.select("layout", "page_hash").distinct()
    totals = different.groupBy("layout").agg(F.count("*").alias("pages"))
    texts = pages.select("layout", "page_hash", F.explode("keys").alias("key")).distinct()
    times = texts.groupBy("layout", "key").agg(F.count("*").alias("times"))
    times = times.where(F.col("times") >= LEAST_PAGES).join(totals, "layout")
    times = times.where(F.col("times") >= LEAST_SHARE * F.col("pages"))
    # Nearly all pages have these texts, so they are hardly more than a page has.
    template = times.groupBy("layout").agg(F.collect_list("key").alias("template"))
    order = Window.partitionBy("layout").orderBy("page_hash")
    drawn = different.withColumn("n", F.row_number().over(order)).where(f"n <= {PAGES_PER_LAYOUT}")
    copies = Window.partitionBy("layout", "page_hash").orderBy("page_id")
    # Written, so that Spark knows how few they are and does not shuffle pages to meet them.
    drawn = stored(drawn.drop("n"), "drawn")
    drawn = pages.join(drawn, ["layout", "page_hash"], "left_semi")
    drawn = drawn.withColumn("n", F.row_number().over(copies)).where("n = 1")

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        found = induce(group.sort_by("page_hash").column("html").to_pylist())
        template = group.column("template")[0].as_py() or []
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([group.column("layout")[0].as_py()]),
                pa.array([Wrapper(found.shape, found.content, frozenset(template)).dump()]),
            ],
            names=["layout", "wrapper"],
        )

    chosen = drawn.select("layout", "page_hash", "html").join(template, "layout", "left")
    return by_group(chosen, ["layout"], work, "layout bigint, wrapper string")


_loaded: dict[str, Wrapper] = {}


def _wrapper(text: str | None) -> Wrapper | None:
    if text is None:
        return None
    if text not in _loaded:
        if len(_loaded) >= 256:
            _loaded.clear()
        _loaded[text] = Wrapper.load(text)
    return _loaded[text]


def extract_main_text(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Per page of `outlined`: `page_id`, `url`, `text`, `n_chars`.

    Of the pages `page_id`, `url` and `html` are read; other columns are not touched. A null or empty
    html gives an empty text; pages with a null url, or one without a host, are a host of their own.
    Repeated rows are all returned with the same text. Pages are worked on one at a time, however long
    and however deeply nested; malformed ones are read as far as a browser would. An empty table gives
    an empty result. Wrappers are one row for each layout; Spark broadcasts them while they are small
    and else splits hot layouts.
    """

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        columns = (run.column(name).to_pylist() for name in ("html", "wrapper"))
        texts = [extract(page, _wrapper(text)) for page, text in zip(*columns, strict=True)]
        arrays = [run.column("page_id"), run.column("url"), pa.array(texts, pa.string())]
        arrays.append(pa.array(map(len, texts), pa.int64()))
        return pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    joined = pages.select("page_id", "url", "html", "layout").join(wrappers, "layout", "left")
    joined = joined.select("page_id", "url", "html", "wrapper")
    schema = "page_id bigint, url string, text string, n_chars bigint"
    return joined.mapInArrow(by_run(work, "html"), schema)
