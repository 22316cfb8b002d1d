"""Main text of web pages by site style trees.

The element trees of a host's pages are merged: elements of the same path, that is, of
the same names and classes from the root down, are one node. A node whose children look
alike on all pages, and whose texts recur on many of them, says little about a page. Its
importance is an entropy: of the arrangements of its children (presentation), and of the
pages on which each text occurs (content). A page's branches of low importance are left
out, and texts that recur on more than half of the pages. Hosts with few pages borrow from the tree of all hosts.

Whether a block is in a main element moves the bar that its importance has to reach: inside
an article low importance still takes it out, beside one high importance still keeps it.
Elements such as navigation and forms are never main text, but for a form or a hidden element that
holds most of the page's text, and formulas and buttons within an article's text. Names such as a class of `sidebar`
count against a block, unless the element named holds most of the page's text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import stored
from changelake.llm.dom import BLOCK, Node, blocks, parse

#: Weight of a node's texts against its presentation.
DAMPING = 0.9
#: Pages of a host that weigh as much as the tree of all hosts.
BORROWED = 20
#: Importance that keeps a block: inside a main element, beside one, and on pages without one.
INSIDE, BESIDE, LEAST = 0.2, 0.8, 0.4
#: Part of the pages on more than which a text counts as repeated, wherever it stands.
REPEATED = 0.5
#: Pages that must hold a path or a text before what was learned outweighs its element.
SEEN = 5

#: Elements, and words of classes, ids and roles, that are never main text.
NEVER = frozenset(
    "head title script style noscript template iframe object embed svg canvas math nav footer aside form button select"
    " option optgroup textarea input label fieldset dialog menu search audio video map".split()
)
NEVER_NAMED = frozenset(
    "nav navbar navigation menu menubar footer sidebar sidenav aside widget ad ads adv advert adverts advertisement"
    " advertising adsense sponsor sponsored sponsors promo promotion promoted banner cookie cookies consent gdpr notice"
    " notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social"
    " related recommended recommendation recommendations comment comments respond reply replies disqus breadcrumb"
    " breadcrumbs pagination pager paging search searchbox login toolbar skip copyright contentinfo complementary"
    " banners tooltip dialog form hidden".split()
)
#: Of these, what no one sees, what may be a page's frame, and what may stand within a text.
UNSEEN = frozenset("head title script style noscript template iframe object embed svg canvas select textarea audio video map".split())
FRAMES = frozenset(["form", "fieldset"])
INLINE = frozenset(["math", "button"])
#: Also never main text, unless inside the article.
OUTER = frozenset(["header"])
OUTER_NAMED = frozenset("header masthead topbar".split())
MAIN = frozenset(["article", "main"])
MAIN_NAMED = frozenset(["main", "article"])
#: Words that say nothing beside another word of a name.
NEUTRAL = frozenset(
    "site page main global primary secondary left right top bottom upper lower inner outer area bar block box btn button buttons"
    " col column container content group holder icon icons inline item items link links list module panel post posts row section"
    " slot text title unit widgets wrap wrapper".split()
)
#: Share of a page's text, or of that of its main elements, above which names of an element don't count.
MOST = 0.5
#: Least weight of a text against one of full importance.
FAINT = 0.05
_WORD = re.compile(r"[a-z]{2,}")
_NUMBERS = re.compile(r"\d+")


def _hash(*parts: object) -> int:
    return int.from_bytes(blake2b(repr(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _named(node: Node, names: frozenset[str]) -> bool:
    """Whether a class, the id or the role is one of the names, alone or beside neutral words.

    Of `block__element--modifier` only the element counts.
    """
    for token in " ".join(node.attributes.get(name, "") for name in ("class", "id", "role")).lower().split():
        words = set(_WORD.findall(token.split("--")[0].split("__")[-1]))
        if words & names and words <= names | NEUTRAL:
            return True
    return False


class Tree:
    """A page's elements with their paths and kinds."""

    def __init__(self, html: str | None) -> None:
        self.root = parse(html)
        self.path: dict[int, int] = {id(self.root): 0}
        self.main: set[int] = set()
        self.never: set[int] = set()
        self.order: list[Node] = []
        stack = [self.root]
        while stack:
            node = stack.pop()
            self.order.append(node)
            children = [child for child in node.children if isinstance(child, Node)]
            for child in children:
                self._enter(child, node)
            stack += reversed(children)

    def _holds_most(self, node: Node) -> bool:
        """Whether an element holds more text than all of the page beside it."""

        def lengths(top: Node, but: Node | None = None) -> Iterator[int]:
            stack = [top]
            while stack:
                at = stack.pop()
                if at is not but and at.tag not in UNSEEN:
                    for child in at.children:
                        if isinstance(child, Node):
                            stack.append(child)
                        else:
                            yield len(child.strip())

        own, beside = sum(lengths(node)), 0
        # Most forms are small, so the first texts beside them settle it.
        for length in lengths(self.root, node):
            beside += length
            if beside >= own:
                return False
        return own > beside

    def _enter(self, node: Node, parent: Node) -> None:
        classes = _NUMBERS.sub("", " ".join(sorted(node.attributes.get("class", "").lower().split())))
        self.path[id(node)] = _hash(self.path[id(parent)], node.tag, classes, node.attributes.get("role", ""))
        inside = id(parent) in self.main
        style = node.attributes.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in node.attributes or node.attributes.get("aria-hidden") == "true" or "display:none" in style
        never = node.tag in NEVER or hidden
        if never and id(parent) not in self.never and node.tag not in UNSEEN and (hidden or node.tag in FRAMES):
            never = not self._holds_most(node)
        if inside and node.tag in INLINE and parent.tag not in NEVER and parent.tag not in MAIN and parent.tag != "div":
            never = hidden
        outer = node.tag in OUTER
        if id(parent) in self.never or never or (outer and not inside):
            self.never.add(id(node))
        elif inside or node.tag in MAIN or node.attributes.get("role") in MAIN_NAMED:
            self.main.add(id(node))

    def names(self, weight: dict[int, float]) -> tuple[set[int], set[int]]:
        """Elements that a name counts against, with all below them, and those of main elements.

        `weight` has that of each block's texts. A main element below such a name is none.
        """
        whole: dict[int, float] = {}
        inside: dict[int, float] = {}
        for node in reversed(self.order):
            own = weight.get(id(node), 0.0)
            below = [id(child) for child in node.children if isinstance(child, Node)]
            whole[id(node)] = own + sum(whole[child] for child in below)
            inside[id(node)] = (own if id(node) in self.main else 0.0) + sum(inside[child] for child in below)
        all_, all_main = MOST * whole[id(self.root)], MOST * inside[id(self.root)]
        named: set[int] = set()
        main: set[int] = set()
        for node in self.order:
            for child in node.children:
                if not isinstance(child, Node):
                    continue
                at = id(child)
                if at in self.main and (id(node) in main or id(node) not in named):
                    main.add(at)
                most = whole[at] > all_ or inside[at] > all_main
                if id(node) in named:
                    named.add(at)
                elif not most and child.tag not in ("html", "body"):
                    if child.tag not in MAIN and _named(child, NEVER_NAMED) or id(node) not in main and _named(child, OUTER_NAMED):
                        named.add(at)
                        if id(node) not in main:
                            main.discard(at)
        return named, main

    def arrangement(self, node: Node) -> int:
        """Hash of the kinds of a node's children, each run of the same kind once."""
        kinds: list[int] = []
        for child in node.children:
            kind = self.path[id(child)] if isinstance(child, Node) else 0 if child.strip() else None
            if kind is not None and (not kinds or kinds[-1] != kind):
                kinds.append(kind)
        return _hash(kinds)

    def text(self, importance: dict[int, tuple[float, float, int]], repeated: frozenset[tuple[int, int]] = frozenset()) -> str:
        """Texts of the blocks that are important enough, joined by line breaks.

        `importance` has the presentation and content of a path and the pages it was seen on,
        `repeated` the paths and hashes of repeated texts. Where nothing in the main elements
        is important, as on copies of one page, their blocks stay.
        """
        texts: dict[int, list[str]] = {}
        for block, text in blocks(self.root):
            texts.setdefault(id(block), []).append(text)
        values: dict[int, tuple[float, int]] = {}
        weight: dict[int, float] = {}
        for node in self.order:
            if id(node) in texts and id(node) not in self.never:
                path = self.path[id(node)]
                presentation, content, seen = importance.get(path, (1.0, 1.0, 0))
                value = (1 - DAMPING) * presentation + DAMPING * content
                if all((path, _hash(text)) in repeated for text in texts[id(node)]):
                    value = 0.0
                values[id(node)] = value, seen
                weight[id(node)] = max(value, FAINT) * sum(map(len, texts[id(node)]))
        named, main = self.names(weight)
        high: set[int] = set()
        # Blocks of main elements that only low importance takes out.
        low: set[int] = set()
        for block, (value, seen) in values.items():
            if block in main:
                if value >= BESIDE and seen >= SEEN or block not in named and (value >= INSIDE or seen < SEEN):
                    high.add(block)
                elif block not in named:
                    low.add(block)
            elif block not in named and (value >= BESIDE and seen >= SEEN if main else value >= LEAST):
                high.add(block)
        if not high & main:
            high |= low
            repeated = frozenset()
        holds: dict[int, bool] = {}
        for node in reversed(self.order):
            below = [holds[id(child)] for child in node.children if isinstance(child, Node) and id(child) in holds]
            if id(node) in texts:
                below.append(id(node) in high)
            if below:
                holds[id(node)] = any(below)

        def keep(node: Node) -> bool:
            # What holds no block is part of the text around it, unless it is named.
            return id(node) not in self.never and holds.get(id(node), id(node) not in named or node.tag in BLOCK)

        found = [(block, text) for block, text in blocks(self.root, keep) if id(block) in high]
        return "\n".join(text for block, text in found if not repeated or (self.path[id(block)], _hash(text)) not in repeated)


def host_of(url: str) -> Column:
    """Lower-case host of a URL, empty if it has none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and path once: arrangements and texts."""
    for batch in batches:
        hosts, pages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found: dict[tuple[int, int, bool, int], int] = {}
        for host, html in zip(hosts, pages):
            tree = Tree(html)
            page = {(host, tree.path[id(node)], False, tree.arrangement(node)) for node in tree.order}
            page |= {(host, tree.path[id(block)], True, _hash(text)) for block, text in blocks(tree.root)}
            for feature in page:
                found[feature] = found.get(feature, 0) + 1
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)] + [pa.array(found.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["host", "path", "content", "feature", "n"])


def learn(pages: DataFrame) -> DataFrame:
    """`host`, its `nodes` and its `texts`.

    Nodes are the paths that several pages share, with their presentation and content importance
    and the number of pages of all hosts; texts are the paths and hashes of repeated texts.

    `pages` has the host's hash and html. With m pages, arrangements with shares p have the
    presentation importance -sum(p log p) / log m. Texts on n pages each have the content
    importance 1 - mean(log n) / log m: 1 if every text is on one page, 0 if all are on all.
    A text is repeated if it is on more than `REPEATED` of the pages, whatever their number.
    """
    counted = stored(
        pages.mapInArrow(_features, "host long, path long, content boolean, feature long, n long")
        .groupBy("host", "path", "content", "feature")
        .agg(F.sum("n").alias("n")),
        "features",
    )
    everywhere = counted.groupBy("path", "content", "feature").agg(F.sum("n").alias("n")).withColumn("host", F.lit(None).cast("long"))

    def scale(m: Column) -> Column:
        return F.log(F.greatest(m, F.lit(2)))

    def importances(features: DataFrame) -> DataFrame:
        n, total, logs = F.col("n"), F.col("total"), F.col("logs")
        sums = features.groupBy("host", "path", "content").agg(F.sum(n).alias("total"), F.sum(n * F.log(n)).alias("logs"))
        roots = sums.filter("path = 0 and not content").select(F.col("host").alias("of"), F.col("total").alias("m"))
        sums = sums.join(roots, F.col("host").eqNullSafe(F.col("of"))).drop("of")
        presentation = F.when(F.col("m") < 2, 1.0).otherwise((F.log(total) - logs / total) / scale(F.col("m")))
        content = F.when(F.col("m") < 2, 1.0).otherwise(1 - logs / total / scale(F.col("m")))
        return sums.groupBy("host", "path").agg(
            F.max("m").alias("m"),
            F.max(F.when(~F.col("content"), total)).alias("pages"),
            F.max(F.when(~F.col("content"), presentation)).alias("presentation"),
            F.max(F.when(F.col("content"), content)).alias("content"),
        )

    whole = importances(everywhere).select("path", F.col("presentation").alias("p"), F.col("content").alias("c"), F.col("pages").alias("seen"))
    joined = importances(counted).filter("pages > 1 or m < 2").join(whole, "path")
    share = F.col("m") / (F.col("m") + BORROWED)

    def blend(own: str, other: str) -> Column:
        return F.coalesce(F.col(own) * share + F.col(other) * (1 - share), F.lit(1.0))

    nodes = F.struct("path", blend("presentation", "p").alias("presentation"), blend("content", "c").alias("content"), "seen")
    trees = joined.groupBy("host").agg(F.collect_list(nodes).alias("nodes"))

    roots = "path = 0 and not content"
    sizes = counted.filter(roots).groupBy("host").agg(F.sum("n").alias("m"))
    all_pages = everywhere.filter(roots).agg(F.sum("n").alias("all_m"))
    often = everywhere.filter(F.col("content") & (F.col("n") >= SEEN)).select("path", "feature", F.col("n").alias("all_n"))
    texts = counted.filter("content").join(often, ["path", "feature"]).join(sizes, "host").crossJoin(F.broadcast(all_pages))
    own = F.when(F.col("m") < 2, 0.0).otherwise(F.col("n") / F.col("m"))
    other = F.col("all_n") / F.col("all_m")
    texts = texts.filter(own * share + other * (1 - share) > REPEATED)
    texts = texts.groupBy("host").agg(F.collect_list(F.struct("path", F.col("feature").alias("text"))).alias("texts"))
    return stored(trees.join(texts, "host", "left"), "trees")


def extract(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of `df`: id, url, `text` (main text, blocks joined by line breaks), `n_chars`.

    A null or empty page has an empty text. Pages without a host are of one unnamed host.
    Ids may be null or repeated; other columns are not read. Nothing is cut.
    """
    pages = df.select(
        F.col(id).alias("id"), F.col(url).alias("url"), F.xxhash64(host_of(url)).alias("host"), F.col(html).alias("html")
    )
    trees = learn(pages.select("host", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                texts = []
                for html, nodes, often in zip(*(part.column(name).to_pylist() for name in ("html", "nodes", "texts"))):
                    known = {node["path"]: (node["presentation"], node["content"], node["seen"]) for node in nodes or ()}
                    repeated = frozenset((each["path"], each["text"]) for each in often or ())
                    texts.append(Tree(html).text(known, repeated))
                sizes = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], ["id", "url", "text", "n_chars"]
                )

    kind = df.schema[id].dataType.simpleString()
    rows = pages.join(trees, "host", "left").select("id", "url", "html", "nodes", "texts")
    return rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id, "url": url})
