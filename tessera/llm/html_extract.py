"""Main text of web pages with a site style tree.

Pages of a host are merged into one tree: an element is the same node on two
pages where its path of tags and class names is the same. For every node the
host's pages give two entropies: of its presentations (the sequences of child
elements) and of its content (in how many pages each text block below it
stands). Menus, notices and adverts repeat, so their importance is low; article
text differs from page to page. What a tag or class name says (nav, footer,
article) counts as prior evidence, and is all there is for a host with one
page. The pages' evidence weighs log2 of their number: over 2^6 pages can
outvote a class name or an id, over 2^16 a tag or an ARIA role. Elements below
content are shielded less (2^4), so repeated unnamed blocks in it go. Each
element is judged by itself; one seen on few pages follows the one around it.
Text of elements of low importance is removed from each page.

Pass 1 parses the pages into (node, value) counts, added up before and after
the shuffle, so that a host with a third of all pages sends each task's
distinct values only. The importance needs sums of c log c, never the values of
a host together. Only nodes whose importance contradicts their role go back to
the pages (pass 2), as a small table per host.

NULL or empty html gives an empty text. NULL urls share the host ''. Repeated
rows count as pages of their own. Broken markup is read as browsers do: open
paragraphs end at block elements, unknown end tags are ignored, unclosed
elements end with the page. Extra columns pass through in the carried struct.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import ROW

# Fixed names of HTML elements by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var math mfrac mi mn mo mover mroot mrow ms msqrt msub msubsup msup mtext munder munderover "
    "object semantics".split()
)
NOISE_TAGS = set("nav footer aside form button select dialog menu head noscript fieldset".split())
CONTENT_TAGS = {"article", "main"}
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|alert|popup|modal|newsletter|"
    r"subscribe|signup|login|search|nav\w*|menu\w*|breadcrumb\w*|sidebar|side|widget\w*|related|recommend\w*|share|"
    r"social|footer|comments?|commentlist|disqus|replies|pagination|pager|tags|skip)(?:$|[\s_-])",
    re.I,
)
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body|text)(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# Roles: by a tag or an ARIA role, by a class name or id, or taken over from the element above.
NEUTRAL, NOISE, CONTENT, NOISE_NAME, CONTENT_NAME, WITHIN_CONTENT, WITHIN_NOISE, WITHIN_NOISE_NAME = range(8)
TAKEN_OVER = (NEUTRAL, WITHIN_CONTENT, WITHIN_NOISE, WITHIN_NOISE_NAME)
REMOVED_ROLES = (NOISE, NOISE_NAME, WITHIN_NOISE, WITHIN_NOISE_NAME)
CONTENT_ROLES = (CONTENT, CONTENT_NAME, WITHIN_CONTENT)
#: importance, weight; a site's pages weigh log2 of their number, so over 2^weight of them can outvote a prior
PRIOR = {
    NEUTRAL: (0.7, 4.0),
    NOISE: (0.0, 16.0),
    CONTENT: (1.0, 16.0),
    NOISE_NAME: (0.0, 6.0),
    CONTENT_NAME: (1.0, 6.0),
    WITHIN_CONTENT: (1.0, 4.0),
    WITHIN_NOISE: (0.0, 16.0),
    WITHIN_NOISE_NAME: (0.0, 6.0),
}
ENOUGH_PAGES = 16  # for an element to differ from a removed one around it
PRESENTATION_SHARE = 0.1
LEAST_IMPORTANCE = 0.5
BROADCAST_NODES = 200_000


class Node:
    """An open element: its tag, site node, role, whether it is removed, and the site node above."""

    __slots__ = ("tag", "key", "role", "removed", "above", "children")

    def __init__(self, tag: str, key: int, role: int, removed: bool, above: int = 0):
        self.tag, self.key, self.role, self.removed, self.above, self.children = tag, key, role, removed, above, []


def role_of(tag: str, attributes: str, parent: int) -> int:
    if parent in (NOISE, WITHIN_NOISE):
        return WITHIN_NOISE
    if tag in NOISE_TAGS:
        return NOISE
    if tag == "header":
        return WITHIN_CONTENT if parent in CONTENT_ROLES else NOISE
    names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    if names.get("role", "").lower() in NOISE_ROLES:
        return NOISE
    text = f"{names.get('class', '')} {names.get('id', '')}"
    if parent in (NOISE_NAME, WITHIN_NOISE_NAME):
        return WITHIN_NOISE_NAME
    if tag not in ("html", "body") and NOISE_NAMES.search(text) and not (tag in CONTENT_TAGS):
        return NOISE_NAME
    if tag in CONTENT_TAGS or names.get("role") == "main":
        return CONTENT
    if tag not in ("html", "body") and CONTENT_NAMES.search(text):
        return CONTENT_NAME
    return WITHIN_CONTENT if parent in CONTENT_ROLES else NEUTRAL


_nodes: dict[tuple, tuple[int, int]] = {}


def node_of(parent: Node, tag: str, attributes: str) -> tuple[int, int]:
    """Site node and role of an element under ``parent``; remembered per worker."""
    at = (parent.key, parent.role, tag, attributes)
    if at not in _nodes:
        if len(_nodes) > 100_000:
            _nodes.clear()
        names = " ".join(re.sub(r"\d+", "#", m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes))
        key = xxhash.xxh64_intdigest(f"{tag} {names}", seed=parent.key)
        _nodes[at] = key, role_of(tag, attributes, parent.role)
    return _nodes[at]


def signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


class Page:
    """One parse of a page: text blocks with their node paths, and node presentations."""

    def __init__(self, source: str, host: str, decisions: dict[int, bool]):
        root = Node("", xxhash.xxh64_intdigest(host), NEUTRAL, False)
        self.stack, self.text, self.decisions = [root], [], decisions
        self.blocks: list[tuple[str, list[Node]]] = []
        self.nodes: list[Node] = []
        self.read(source)

    def read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            if m is None:
                self.text.append(source[at:])
                break
            if m.start() > at:
                self.text.append(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                at = size if end is None else source.find(">", end.start()) + 1 or size
            else:
                self.open(tag, m[3])
        self.flush()

    def flush(self) -> None:
        if self.text:
            line = " ".join(html.unescape("".join(self.text)).split())
            if line:
                self.blocks.append((line, list(self.stack)))
            self.text = []

    def open(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            return
        if tag == "br":
            self.text.append(" ")
            return
        self.flush()
        if tag in VOID:
            return
        ends = ENDS_ITSELF.get(tag)
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == "p" or ends and t in ends:
                del self.stack[i:]
                break
            if t in ("ul", "ol", "table", "dl", "select", "article", "main", "div", "section", "body"):
                break
        parent = self.stack[-1]
        key, role = node_of(parent, tag, attributes)
        parent.children.append(tag)
        unless = parent.removed if role in TAKEN_OVER else role in REMOVED_ROLES
        node = Node(tag, key, role, self.decisions.get(signed(key), unless), signed(parent.key))
        self.nodes.append(node)
        self.stack.append(node)

    def close(self, tag: str) -> None:
        if tag in INLINE:
            return
        self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def main_text(self) -> str:
        kept = [line for line, path in self.blocks if not path[-1].removed]
        if not kept:  # the tree removed all: go by names alone
            kept = [line for line, path in self.blocks if path[-1].role not in REMOVED_ROLES]
        return "\n".join(kept)


SEEN = "node long, role int, kind int, value long, n long"
PAGES, STYLE, TEXT_BLOCK = 0, 1, 2


def page_facts(page: Page) -> set[tuple[int, int, int, int]]:
    """(node, role, kind, value) once per page; the value of a node's page count is the node above it."""
    out = set()
    for node in page.nodes:
        out.add((signed(node.key), node.role, PAGES, node.above))
        if node.children:
            style = xxhash.xxh64_intdigest(",".join(node.children))
            out.add((signed(node.key), node.role, STYLE, signed(style)))
    for line, path in page.blocks:
        value = signed(xxhash.xxh64_intdigest(line))
        for node in path[1:]:
            if node.tag not in ("html", "body"):
                out.add((signed(node.key), node.role, TEXT_BLOCK, value))
    return out


def style_tree(pages: DataFrame) -> DataFrame:
    """(node, role, above, pages, importance) of every site node; ``pages`` has _host and _html."""
    names = [c.split()[0] for c in SEEN.split(", ")]

    def count(batches):
        total: Counter = Counter()
        host_of: dict = {}

        def rows():
            keys = list(zip(*total)) or [()] * 4
            columns = [pa.array(list(k), pa.int32() if i in (1, 2) else pa.int64()) for i, k in enumerate(keys)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(total.values()), pa.int64())], names)

        for b in batches:
            for host, source in zip(b.column("_host").to_pylist(), b.column("_html").to_pylist()):
                total.update(page_facts(Page(source or "", host, host_of)))
                if len(total) > 200_000:  # a bound on memory; Spark adds the parts up
                    yield rows()
                    total.clear()
        yield rows()

    seen = pages.mapInArrow(count, SEEN).groupBy("node", "role", "kind", "value").agg(F.sum("n").alias("c"))
    of = lambda kind, e: F.sum(F.when(F.col("kind") == kind, e).otherwise(0.0))
    c, clogc = F.col("c").cast("double"), F.col("c") * F.log("c")
    sums = seen.groupBy("node", "role").agg(
        F.max(F.when(F.col("kind") == PAGES, F.col("value"))).alias("above"),
        of(PAGES, c).alias("pages"),
        of(STYLE, c).alias("s"),
        of(STYLE, clogc).alias("slog"),
        of(TEXT_BLOCK, c).alias("t"),
        of(TEXT_BLOCK, clogc).alias("tlog"),
    )
    m = F.log(F.greatest("pages", F.lit(2.0)))
    style = F.when(F.col("s") > 0, (F.log("s") - F.col("slog") / F.col("s")) / m)
    content = F.when(F.col("t") > 0, 1 - F.col("tlog") / F.col("t") / m)
    mixed = PRESENTATION_SHARE * F.coalesce(style, content) + (1 - PRESENTATION_SHARE) * content
    found = F.when(F.col("t") > 0, F.least(F.greatest(mixed, F.lit(0.0)), F.lit(1.0)))
    weight = F.log2(F.greatest("pages", F.lit(1.0)))
    prior = F.lit(0.0)
    trust = F.lit(0.0)
    for role, (value, strength) in PRIOR.items():
        prior = F.when(F.col("role") == role, value).otherwise(prior)
        trust = F.when(F.col("role") == role, strength).otherwise(trust)
    importance = (prior * trust + F.coalesce(found, prior) * weight) / (trust + weight)
    return sums.select("node", "role", "above", "pages", importance.alias("importance"))


def contradicting(tree: DataFrame) -> DataFrame:
    """(node, removed) where that differs from the role, or from the element above if the role is taken over.

    An element within a removed one stays if enough pages show that it is important.
    """
    own = tree.withColumn("own", F.col("importance") <= LEAST_IMPORTANCE).checkpoint()
    above = own.select(F.col("node").alias("above"), F.col("own").alias("outer"))
    own = own.join(above, "above", "left").withColumn("outer", F.coalesce("outer", F.lit(False)))
    noise = F.col("role").isin(*REMOVED_ROLES)
    sure = (F.col("pages") >= ENOUGH_PAGES) | ~F.col("outer") & ~noise
    taken = F.col("role").isin(*TAKEN_OVER)
    removed = F.when(~taken | sure, F.col("own")).otherwise(F.col("outer"))
    unless = F.when(taken, F.col("outer")).otherwise(noise)
    return own.select("node", removed.alias("removed"), unless.alias("unless")).where("removed <> unless").drop("unless")


def extract(
    pages: DataFrame, url: str = "url", source: str = "html", carry: Sequence[str] = ("page_id", "url")
) -> DataFrame:
    """``_row`` (struct of ``carry``), ``text`` and ``n_chars`` per page."""
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW),
        F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), HOST, 1)).alias("_host"),
        F.col(f"`{source}`").cast("string").alias("_html"),
    )
    against = contradicting(style_tree(rows.select("_host", "_html"))).checkpoint()
    if against.count() > BROADCAST_NODES:
        return _extract_by_shuffle(rows, against)
    sent = pages.sparkSession.sparkContext.broadcast({r["node"]: r["removed"] for r in against.collect()})
    return _texts(rows.select(ROW, "_host", "_html"), lambda _: sent.value)


def _texts(rows: DataFrame, decisions) -> DataFrame:
    schema = T.StructType([rows.schema[ROW], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            known = b.column("_nodes").to_pylist() if "_nodes" in b.schema.names else [None] * b.num_rows
            texts = [
                Page(s or "", h, decisions(k)).main_text()
                for h, s, k in zip(b.column("_host").to_pylist(), b.column("_html").to_pylist(), known)
            ]
            sizes = [len(x) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(ROW), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)


def _extract_by_shuffle(rows: DataFrame, against: DataFrame) -> DataFrame:
    """The same beyond the broadcast bound: every page looks its own nodes up by join."""

    def own(batches):
        for b in batches:
            page, nodes = [], []
            for i, h, s in zip(*(b.column(c).to_pylist() for c in ("_page", "_host", "_html"))):
                keys = {signed(n.key) for n in Page(s or "", h, {}).nodes}
                page += [i] * len(keys)
                nodes += keys
            yield pa.RecordBatch.from_arrays([pa.array(page, pa.int64()), pa.array(nodes, pa.int64())], ["_page", "node"])

    rows = rows.withColumn("_page", F.monotonically_increasing_id()).checkpoint()
    found = rows.select("_page", "_host", "_html").mapInArrow(own, "_page long, node long").join(against, "node")
    found = found.groupBy("_page").agg(F.collect_list(F.struct("node", "removed")).alias("_nodes"))
    joined = rows.join(found, "_page", "left")
    return _texts(joined, lambda k: {x["node"]: x["removed"] for x in k or ()})
