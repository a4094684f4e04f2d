"""Main text of web pages by wrapper induction.

Pages of one host come from a few templates. For each host a wrapper tree is
induced: all different block trees of its pages are aligned by simple tree
matching, about `GROUP_TREES` of them one after another and the results again in
rounds, and nodes that find no partner are put into the wrapper beside their
neighbours' partners. Every page of the host is then aligned to the wrapper, so
its blocks get slots. A text that stands in more than `CONSTANT` of the different
articles that hold its slot is template, what varies is content. These counts
cover all pages; pages with one article text count once, so copies are no template.
Templates whose blocks have the same tags at the same place share slots there.

Within the varying slots, regions that are never article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments, by
element, role, or class and id words) are left out. If a page has an article or
main element, its largest one is the text; else blocks that are mostly links go.

Character references are decoded, white space within a block becomes one space,
blocks are joined in page order by one space. Broken pages are read as browsers
do: open elements end with their parent, an unfinished tag at the end is dropped.
Null and empty pages have empty text; a null address is a host of its own.
Repeated rows get equal results, other columns are ignored, and an empty table
stays empty. Wrappers and constants of all hosts are joined to the pages: by
broadcast while small (measured), else by host with hot hosts salted.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import small_batches
from ledgermill.llm.languages import host_of
from ledgermill.scale import Scratch, attach, stage

GROUP_TREES = 32
CONSTANT = 0.6
LEAST_ARTICLES = 5  # with fewer different articles nothing can be told constant
LINK_SHARE = 0.5
MOST_SHAPES = 200_000  # remembered by a worker; more only cost time

# Elements of HTML by their role in reading a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp|svg|template"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr output q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var".split()
)
NEVER_TEXT = frozenset(
    "nav footer aside form script style button select option textarea input iframe head menu dialog canvas object "
    "audio video map datalist fieldset template".split()
)
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())
NEVER_CLASS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar comment "
    "comments reply replies respond disqus cookie cookies consent gdpr notice notices alert alerts newsletter "
    "subscribe subscription share sharing social related breadcrumb breadcrumbs menu nav navbar navigation footer "
    "header masthead popup modal overlay toolbar pagination pager widget skip signup login paywall".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dd dt".split()
)
ENDS_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
KEEPS_IN = frozenset("table ul ol dl select body html article section div".split())

_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(?:{RAW})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</(?:{RAW})(?=[\s/>])[^>]*+>|\Z)|\Z)"
    rf"|<[!?][^>]*+>?|</?([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(>?)|([^<]++|<)",
    re.S | re.I,
)
_MARKS = re.compile(r"""\b(class|id|role|itemprop|aria-hidden|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "kids", "parent", "skip", "article", "groups")

    def __init__(self, tag: str, parent: Node | None, skip: bool, article: bool):
        self.tag, self.parent, self.skip, self.article = tag, parent, skip, article
        self.kids: list[Node] = []
        self.groups: list[int] = []


def _flags(tag: str, attributes: str, parent: Node) -> tuple[bool, bool]:
    """Whether an element is never article text, and whether it is marked as the article."""
    skip, article = tag in NEVER_TEXT, tag in ("article", "main")
    inside = parent.article
    if tag == "header" and not inside:
        skip = True
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, a, b, c in _MARKS.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                if tag not in ("html", "body", "article", "main"):
                    words = {w.lower() for w in _WORDS.findall(value)}
                    skip = skip or not words.isdisjoint(NEVER_CLASS)
            elif name == "role":
                skip = skip or value.lower() in NEVER_ROLE
                article = article or value.lower() in ("main", "article")
            elif name == "itemprop":
                article = article or value == "articleBody"
            elif name == "hidden":
                skip = True
            elif name == "aria-hidden":
                skip = skip or value == "true"
            elif "display" in value and re.search(r"display\s*:\s*none", value):
                skip = True
    return skip or parent.skip, article


def parse(html: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """The tree of block elements, and the blocks of text (node, text, characters in links) that may be content."""
    root = Node("#page", None, False, False)
    node, stack = root, []  # open elements: (tag, block node or None)
    blocks: list[tuple[Node, str, int]] = []
    run: list[str] = []
    links, in_link = 0, 0

    def flush() -> None:
        nonlocal links
        if run:
            text = "".join(run)
            run.clear()
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append((node, text, links))
        links = 0

    def leave(depth: int) -> None:
        """Close open elements down to `depth` of them."""
        nonlocal node, in_link
        while len(stack) > depth:
            tag, block = stack.pop()
            if block is not None:
                flush()
                node = block.parent
            elif tag == "a":
                in_link -= 1

    for match in _TOKEN.finditer(html):
        text = match[4]
        if text is not None:
            if not node.skip:
                run.append(text)
                if in_link:
                    links += len(text)
            continue
        tag = match[1]
        if tag is None:
            continue
        if not match[3]:
            break  # an unfinished tag at the end
        tag = tag.lower()
        if match[0][1] == "/":
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    leave(depth)
                    break
            continue
        if tag in INLINE:
            if tag == "a":
                in_link += 1
            stack.append((tag, None))
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                run.append(" ")
            continue
        ends = ENDS_ITSELF.get(tag, ())
        for depth in range(len(stack) - 1, -1, -1):
            other = stack[depth][0]
            if other in ends or other == "p" and tag in ENDS_P:
                leave(depth)
                break
            if other in KEEPS_IN:
                break
        flush()
        skip, article = _flags(tag, match[2], node)
        child = Node(tag, node, skip, article or node.article)
        if not node.skip:
            node.kids.append(child)
        node = child
        stack.append((tag, child))
    leave(0)
    flush()
    return root, blocks


class Shapes:
    """Trees of tags as numbers: equal trees have one number. Equal neighbours among children count once."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, tuple[int, ...]], int] = {}
        self.of: list[tuple[str, tuple[int, ...]]] = []
        self.sizes: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}
        self.paired: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.slotted: dict[tuple[int, int], list[int]] = {}
        self.texts: dict[str, int] = {}
        self.held = 0  # about how many numbers `slotted` and `texts` hold

    def number(self, tag: str, kids: tuple[int, ...]) -> int:
        key = (tag, kids)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.of)
            self.of.append(key)
            self.sizes.append(1 + sum(self.sizes[k] for k in kids))
        return found

    def of_node(self, root: Node) -> int:
        nodes = [root]
        for node in nodes:
            nodes += node.kids
        found: dict[Node, int] = {}
        for node in reversed(nodes):  # children before their parents
            kids: list[int] = []
            node.groups.clear()
            for kid in node.kids:
                shape = found.pop(kid)
                if not kids or kids[-1] != shape:
                    kids.append(shape)
                node.groups.append(len(kids) - 1)
            found[node] = self.number(node.tag, tuple(kids))
        return found[root]

    def dump(self, shape: int) -> list:
        """Tag and depth of every node, a parent before its children."""
        out, stack = [], [(shape, 0)]
        while stack:
            at, depth = stack.pop()
            tag, kids = self.of[at]
            out += (tag, depth)
            stack += [(k, depth + 1) for k in reversed(kids)]
        return out

    def load(self, tree: list) -> int:
        """The shape of a nested list (a tag and its children), or of what `dump` gives."""
        if len(tree) == 1 or isinstance(tree[1], list):
            flat, stack = [], [(tree, 0)]
            while stack:
                at, depth = stack.pop()
                flat += (at[0], depth)
                stack += [(k, depth + 1) for k in reversed(at[1:])]
            tree = flat
        waiting: list[list[int]] = [[]]  # the children of the next node of each depth, last first
        for tag, depth in zip(reversed(tree[::2]), reversed(tree[1::2])):
            while len(waiting) < depth + 2:
                waiting.append([])
            kids = tuple(reversed(waiting[depth + 1]))
            waiting[depth + 1] = []
            waiting[depth].append(self.number(tag, kids))
        return waiting[0][0]

    def parsed(self, text: str) -> int:
        """The shape of a dumped tree in JSON; a worker reads each once."""
        found = self.texts.get(text)
        if found is None:
            found = self.texts[text] = self.load(json.loads(text))
            self.held += len(text) // 8
        return found

    def score(self, a: int, b: int) -> int:
        """Simple tree matching: the most nodes that can be paired in order, below equal roots."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self._known(x, y) is not None:
                stack.pop()
                continue
            unknown = [(i, j) for i in self.of[x][1] for j in self.of[y][1] if self._known(i, j) is None]
            if unknown:
                stack += unknown
            else:
                self.scores[x, y] = 1 + self._table(x, y)[-1][-1]
        return self._known(a, b)

    def _known(self, a: int, b: int) -> int | None:
        if a == b:
            return self.sizes[a]
        if self.of[a][0] != self.of[b][0]:
            return 0
        return self.scores.get((a, b))

    def _table(self, a: int, b: int) -> list[list[int]]:
        left, right = self.of[a][1], self.of[b][1]
        table = [[0] * (len(right) + 1)]
        for x in left:
            above, row = table[-1], [0]
            for j, y in enumerate(right):
                row.append(max(row[j], above[j + 1], above[j] + self.score(x, y)))
            table.append(row)
        return table

    def pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        """Which children of `a` and `b` a best matching pairs, in order."""
        key = (a, b)
        if key in self.paired:
            return self.paired[key]
        left, right = self.of[a][1], self.of[b][1]
        out = []
        if a == b:
            out = [(i, i) for i in range(len(left))]
        else:
            table = self._table(a, b)
            i, j = len(left), len(right)
            while i and j:
                own = self.score(left[i - 1], right[j - 1])
                if own and table[i][j] == table[i - 1][j - 1] + own:
                    i, j = i - 1, j - 1
                    out.append((i, j))
                elif table[i][j] == table[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
            out.reverse()
        self.paired[key] = out
        return out

    def merge(self, a: int, wrapper: int) -> int:
        """`wrapper` with the nodes of `a` that find no partner, beside the partners of their neighbours."""
        done: dict[tuple[int, int], int] = {}
        stack = [(a, wrapper)]
        while stack:
            own, other = stack[-1]
            if own == other or self.of[own][0] != self.of[other][0]:
                done[own, other] = other
            if (own, other) in done:
                stack.pop()
                continue
            left, right = self.of[own][1], self.of[other][1]
            pairs = self.pairs(own, other)
            waiting = [(left[x], right[y]) for x, y in pairs if (left[x], right[y]) not in done]
            if waiting:
                stack += waiting
                continue
            out: list[int] = []
            i = j = 0
            for x, y in [*pairs, (len(left), len(right))]:
                out += right[j:y]
                out += [k for k in left[i:x] if k not in out]
                if x < len(left):
                    out.append(done[left[x], right[y]])
                i, j = x + 1, y + 1
            done[own, other] = self.number(self.of[own][0], tuple(out))
        return done[a, wrapper]

    def slots(self, a: int, wrapper: int) -> list[int]:
        """For every node of `a` (a parent before its children) its partner's number in `wrapper`, or
        below -2 a number made of the tags that lead to it from the nearest node with a partner."""
        key = (a, wrapper)
        if key in self.slotted:
            return self.slotted[key]
        out = [-1] * self.sizes[a]
        stack: list[tuple[int, int, int | None, int]] = [(a, 0, wrapper, 0)]
        while stack:
            shape, at, other, slot = stack.pop()
            out[at] = slot
            if shape == other:
                out[at : at + self.sizes[shape]] = range(slot, slot + self.sizes[shape])
                continue
            partner = {} if other is None else dict(self.pairs(shape, other))
            right = () if other is None else self.of[other][1]
            starts = [slot + 1]
            for k in right:
                starts.append(starts[-1] + self.sizes[k])
            at += 1
            for i, kid in enumerate(self.of[shape][1]):
                j = partner.get(i)
                if j is None:
                    lonely = -3 - (crc32(f"{slot} {self.of[kid][0]}".encode("utf-8", "surrogatepass")) >> 2)
                    stack.append((kid, at, None, lonely))
                else:
                    stack.append((kid, at, right[j], starts[j]))
                at += self.sizes[kid]
        self.slotted[key] = out
        self.held += len(out)
        return out


_SHAPES = Shapes()


def _shapes() -> Shapes:
    global _SHAPES
    if len(_SHAPES.of) + len(_SHAPES.scores) + _SHAPES.held // 16 > MOST_SHAPES:
        _SHAPES = Shapes()
    return _SHAPES


def _node_slots(root: Node, shapes: Shapes, wrapper: int) -> dict[Node, int]:
    shape = shapes.of_node(root)
    slots = shapes.slots(shape, wrapper)
    out: dict[Node, int] = {}
    stack = [(root, shape, 0)]
    while stack:
        node, shape, at = stack.pop()
        out[node] = slots[at]
        kids = shapes.of[shape][1]
        starts = [at + 1]
        for k in kids:
            starts.append(starts[-1] + shapes.sizes[k])
        stack += [(kid, kids[group], starts[group]) for kid, group in zip(node.kids, node.groups)]
    return out


def _article(blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks of the largest marked article, or those that are not mostly links."""
    volume: Counter[Node] = Counter()
    top: dict[Node, Node] = {}
    for node, text, _ in blocks:
        if node.article:
            if node not in top:
                at, path = node, [node]
                while at not in top and at.parent is not None and at.parent.article:
                    at = at.parent
                    path.append(at)
                top.update(dict.fromkeys(path, top.get(at, at)))
            volume[top[node]] += len(text)
    if volume:
        best = max(volume.values())
        main = next(n for n, v in volume.items() if v == best)
        return [b for b in blocks if top.get(b[0]) is main]
    return [b for b in blocks if b[2] <= LINK_SHARE * len(b[1])]


def _mark(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _tree_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes = _shapes()
        found: dict[tuple[str, int], None] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            found[host, shapes.of_node(parse(html or "")[0])] = None
        trees = [json.dumps(shapes.dump(shape)) for _, shape in found]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array(trees, pa.string())], ["host", "tree"])


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for trees in batch.column("trees").to_pylist():
            shapes = _shapes()
            numbers = sorted((shapes.load(json.loads(t)) for t in sorted(trees)), key=lambda s: -shapes.sizes[s])
            wrapper = numbers[0]
            for shape in numbers[1:]:
                wrapper = shapes.merge(shape, wrapper)
            out.append(json.dumps(shapes.dump(wrapper)))
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], ["host", "tree"])


def _wrappers(trees: DataFrame, group: int, scratch: Scratch) -> DataFrame:
    """host, tree: the different trees of each host merged in groups, and the results again, until one is left."""
    level = scratch.stage(trees.distinct(), "trees")
    while True:
        counts = scratch.stage(level.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "tree-counts")
        if not counts.filter("n > 1").limit(1).count():
            return level
        part = F.pmod(F.xxhash64("tree"), F.ceil(F.col("n") / group)).cast("int")
        dealt = attach(level, counts, ["host"], spread=["tree"]).withColumn("part", part)
        grouped = dealt.groupBy("host", "part").agg(F.collect_set("tree").alias("trees"))
        level = scratch.stage(grouped.select("host", "trees").mapInArrow(_induce, "host string, tree string").distinct(), "merged")


def _slotted(html: str, wrapper: str | None) -> list[tuple[int, str]]:
    """Slot and text of every block of the article."""
    shapes = _shapes()
    root, blocks = parse(html)
    chosen = _article([b for b in blocks if not b[0].skip])
    if wrapper is None:
        return [(-1, text) for _, text, _ in chosen]
    slots = _node_slots(root, shapes, shapes.parsed(wrapper))
    return [(slots[node], text) for node, text, _ in chosen]


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, slot, text and article of every block, by hash, and with a null text the articles that
    hold a slot; once for each article of a batch."""
    for batch in batches:
        rows = set()
        hosts = batch.column("host").to_pylist()
        for host, html, wrapper in zip(hosts, batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            found = _slotted(html or "", wrapper)
            article = _mark(" ".join(t for _, t in found))
            rows.update((host, slot, None, article) for slot, _ in found)
            rows.update((host, slot, _mark(text), article) for slot, text in found)
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, kinds)], ["host", "slot", "text", "article"]
        )


def _extract(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, wrapper, constant in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "constant"))):
                fixed = {(c["slot"], c["text"]) for c in constant or ()}
                found = _slotted(html or "", wrapper if fixed else None)
                texts.append(" ".join(t for slot, t in found if not fixed or (slot, _mark(t)) not in fixed))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"],
            )

    return run


def extract_main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    group: int = GROUP_TREES, constant: float = CONSTANT, least: int = LEAST_ARTICLES,
) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn(
        "host", F.coalesce(F.concat(F.lit("="), host_of(F.col("url"))), F.lit(""))
    )
    spread = [F.col("page_id"), F.col("url")]
    trees = rows.select("host", "html").mapInArrow(_tree_of, "host string, tree string")
    with Scratch(pages.sparkSession) as scratch:
        wrappers = stage(_wrappers(trees, group, scratch).select("host", F.col("tree").alias("wrapper")), "wrappers")
    wrapped = attach(rows, wrappers, ["host"], spread=spread)
    counts = stage(
        wrapped.select("host", "html", "wrapper")
        .mapInArrow(_count_texts, "host string, slot int, text bigint, article bigint")
        .groupBy("host", "slot", "text").agg(F.count_distinct("article").alias("articles")),
        "slot-texts",
    )
    holders = counts.filter("text IS NULL").select("host", "slot", F.col("articles").alias("all"))
    common = counts.filter(F.col("text").isNotNull() & (F.col("articles") >= least)).join(holders, ["host", "slot"]).filter(
        F.col("articles") > F.col("all") * constant
    )
    constants = stage(
        common.groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("constant")), "constants"
    )  # at most slots / `constant` a host
    kind = dict(pages.dtypes)[key]
    return attach(wrapped, constants, ["host"], spread=spread).select(
        "page_id", "url", "html", "wrapper", "constant"
    ).mapInArrow(_extract(["page_id", "url"]), f"page_id {kind}, url string, text string, n_chars bigint")
