"""Main text by wrapper induction.

Pages become trees of block elements; runs of equal siblings are one repeated
node, so a tree's *skeleton* has few nodes whatever the page's length.

1. Statistics (map, partial aggregation): for every (host, skeleton, node) the pages,
   characters, link characters and whether its text is one constant.
2. Induction: all skeletons of a host are aligned by simple tree matching and merged
   into a wrapper tree, ``FAN`` at a time: skeletons dealt by hash to partial wrappers,
   most frequent first, then partial wrappers to larger ones until one is left, so no
   task sees more of a host, however many skeletons it has.  A wrapper node with own
   text that never varies over ``CONSTANT_PAGES`` pages or more is template; so
   are slots that are mostly links and subtrees whose element or class names a
   boilerplate role.  The others are content slots.  Constancy holds within article and
   main elements as well as outside; where nothing there varies from page to page,
   the pages are copies of one, and their text is kept.
3. Extraction (map): each page is aligned with its host's wrapper, once per
   skeleton, and the blocks in content slots are joined in page order.  In a page
   with an article or main element, only those below it are content; other pages of
   the host are not touched by that.

Class words say less than elements do.  They reject no html, body or main element,
and where a page would have no article or main element left, they do not reject what
holds one.  Inside an article only whole names reject ("share", "share-buttons", but not
"share-prices"); other compounds are a hint, which the wrapper has to confirm by a slot
that is mostly links.  Links elsewhere in an article are content.

Pages of one skeleton that agree in all their content are copies of one page and count
once where a node's constancy is judged.

Every page, of any skeleton, shapes its host's wrapper and is aligned with it.  A node
that stays unaligned takes its role from its names and those of its ancestors.

White space in a block is one space.  A null or empty html, or one without content,
gives the empty text; a null or odd url belongs to the host ''.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

FAN = 64
CONSTANT_PAGES = 4
LINK_SHARE = 0.6

# --- fixed values: the elements and role names of web pages -------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe object svg math textarea select title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
BLOCKS_IN_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body main".split())
BOILERPLATE_TAGS = frozenset("head nav footer aside button menu dialog".split())
NEVER_BY_NAME = frozenset(("html", "body", "main"))
STATE_WORDS = frozenset("no not has have with without".split())  # "has-sidebar" is no sidebar
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus dialog footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion recommended related replies reply search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Levels of the tree; deeper elements lie side by side on the last.
DEEPEST = 150

#: What a compound name may add to a boilerplate word and still be a whole name.
CONTAINER_WORDS = frozenset(
    "area bar block bottom box button buttons column container content count group holder icon icons inner item items left "
    "link links list outer panel post posts right row section slot title top unit wrap wrapper".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""\"[^\"]*\"|'[^']*'|([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_NAME = re.compile(r"[a-z]+")


@dataclass
class Node:
    label: str
    children: list[Node] = field(default_factory=list)
    texts: list[tuple[int, str, int]] = field(default_factory=list)  # (order, text, characters in links)


def _names(value: str) -> set[str]:
    """The words of class names, ids or roles; "hidden" only as a whole name.  A boilerplate
    word that is one part of a compound is marked by "~"."""
    names = set()
    for token in value.lower().strip("\"'").split():
        words = _NAME.findall(token)
        if len(words) > 1 and words[0] in STATE_WORDS:
            continue
        part = not (BOILERPLATE_NAMES | CONTAINER_WORDS).issuperset(words)
        names.update(f"~{w}" if part and w in BOILERPLATE_NAMES else w
                     for w in words if w != "hidden" or token in ("hidden", "visually-hidden"))
    return names


def _label(tag: str, attributes: str) -> str:
    found: dict[str, str] = {}
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(key.lower(), value)
    names = set().union(*(_names(found.get(key, "")) for key in ("class", "id", "role")))
    return ".".join([tag, *sorted(names | ({"!hidden"} if "hidden" in found else set()))])


def parse(html: str) -> Node:
    """The tree of block elements with their own texts, in page order.  Elements nested
    deeper than ``DEEPEST`` become children of the last one that is not; no text is lost."""
    root = Node("root")
    stack, inline = [root], []
    opened: Counter = Counter()  # open elements by tag
    buffer: list[str] = []
    links = order = at = 0

    def flush() -> None:
        nonlocal links, order
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                stack[-1].texts.append((order, text, min(links, len(text))))
                order += 1
            buffer.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        buffer.append(text)
        if "a" in inline:
            links += len(" ".join(unescape(text).split()))

    def close_to(depth: int) -> None:
        flush()
        opened.subtract(node.label.split(".", 1)[0] for node in stack[depth:])
        del stack[depth:]
        inline.clear()

    while True:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not m[1] and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif tag in INLINE:
            if tag in ("br", "img", "wbr"):
                buffer.append(" " if tag == "br" else "")
            elif m[1]:
                if tag in inline:
                    inline.remove(tag)
            else:
                inline.append(tag)
        elif m[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].label.split(".", 1)[0] == tag:
                    close_to(depth)
                    break
            else:
                flush()
        else:
            if tag in BLOCKS_IN_P and stack[-1].label.split(".", 1)[0] == "p":
                close_to(len(stack) - 1)
            if tag in SELF_CLOSING:
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = stack[depth].label.split(".", 1)[0]
                    if open_tag in SELF_CLOSING[tag]:
                        close_to(depth)
                        break
                    if open_tag in SCOPES:
                        break
            if tag == "body":
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].label.split(".", 1)[0] == "head":
                        close_to(depth)
                        break
            flush()
            if tag not in VOID:
                node = Node(_label(tag, m[3]))
                stack[min(len(stack), DEEPEST) - 1].children.append(node)
                stack.append(node)
                opened[tag] += 1
    flush()
    return root


def _merge_texts(into: Node, other: Node) -> None:
    into.texts += other.texts
    for a, b in zip(into.children, other.children):
        _merge_texts(a, b)


def collapse(node: Node) -> str:
    """Merges runs of equal siblings in place; returns the skeleton."""
    parts, kept, previous = [], [], None
    for child in node.children:
        form = collapse(child)
        if form == previous:
            _merge_texts(kept[-1], child)
        else:
            kept.append(child)
            parts.append(form)
            previous = form
    node.children = kept
    return f"({node.label}{''.join(parts)})"


def preorder(node: Node) -> Iterator[Node]:
    yield node
    for child in node.children:
        yield from preorder(child)


# --- alignment -------------------------------------------------------------------------

@dataclass
class Shape:
    """A skeleton's node, or a wrapper's: label, flags and children."""
    label: str
    children: list[Shape] = field(default_factory=list)
    template: bool = False
    stats: dict = field(default_factory=dict)


def shape_of(skeleton: str) -> Shape:
    stack: list[Shape] = [Shape("")]
    for m in re.finditer(r"\(([^()]*)|\)", skeleton):
        if m[0] == ")":
            done = stack.pop()
            stack[-1].children.append(done)
        else:
            stack.append(Shape(m[1]))
    return stack[0].children[0]


def shapes(node: Shape) -> Iterator[Shape]:
    yield node
    for child in node.children:
        yield from shapes(child)


def match(a: Shape, b: Shape, memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the size of the largest order-preserving top-down
    mapping of two trees, and the mapped pairs of children of the roots."""
    key = (id(a), id(b))
    if key in memo:
        return memo[key]
    if a.label != b.label:
        return memo.setdefault(key, (0, []))
    n, m = len(a.children), len(b.children)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            w = match(a.children[i], b.children[j], memo)[0] if a.children[i].label == b.children[j].label else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w if w else 0)
    pairs, i, j = [], n, m
    while i and j:
        w = match(a.children[i - 1], b.children[j - 1], memo)[0]
        if w and best[i][j] == best[i - 1][j - 1] + w:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    memo[key] = (1 + best[n][m], pairs[::-1])
    return memo[key]


def _add_stats(into: dict, more: dict) -> None:
    for k in ("pages", "chars", "links", "votes"):
        into[k] = into.get(k, 0) + more.get(k, 0)
    into["low"] = min(into.get("low", more["low"]), more["low"]) if "low" in more else into.get("low", "~")
    into["high"] = max(into.get("high", more["high"]), more["high"]) if "high" in more else into.get("high", "")


def merge(wrapper: Shape, page: Shape, memo: dict) -> None:
    """Adds a tree to the wrapper: mapped nodes pool their statistics, the others
    become optional nodes at their place."""
    if page.stats:
        _add_stats(wrapper.stats, page.stats)
    pairs = match(wrapper, page, memo)[1]
    out, i, j = [], 0, 0
    for a, b in [*pairs, (len(wrapper.children), len(page.children))]:
        out += wrapper.children[i:a] + page.children[j:b]
        if a < len(wrapper.children):
            merge(wrapper.children[a], page.children[b], memo)
            out.append(wrapper.children[a])
        i, j = a + 1, b + 1
    wrapper.children = out


def _rejected(label: str, inside_main: bool) -> str:
    """How a label rejects what is below it: by "element", by "name" or not ("")."""
    tag, *names = label.split(".")
    if tag in BOILERPLATE_TAGS or "!hidden" in names or (tag == "header" and not inside_main):
        return "element"  # a header inside the article holds its headline
    if tag in NEVER_BY_NAME:
        return ""
    if inside_main:
        words = (BOILERPLATE_NAMES - {"header", "masthead"}).intersection(names)
    else:
        words = BOILERPLATE_NAMES.intersection(n.removeprefix("~") for n in names)
    return "name" if tag == "form" or "hidden" in names or words else ""


def _main(label: str) -> bool:
    tag, *names = label.split(".")
    return (tag in MAIN_TAGS or "main" in names) and not _rejected(label.replace("~", ""), True)


def _holds_main(node: Shape) -> bool:
    return any(_rejected(c.label, False) != "element" and (_main(c.label) or _holds_main(c)) for c in node.children)


def name_roles(root: Shape) -> tuple[list[tuple[bool, bool, bool]], bool]:
    """For each node in preorder, as names tell: whether it may be content, whether
    it lies in an article or main element, and whether a compound name in there hints at
    boilerplate; and whether only nodes in such elements are content.  An article reached
    through a layout word does not shut out the rest."""
    passed: set[int] = set()

    def walk(node: Shape, allowed: bool, inside: bool, through: bool, hinted: bool) -> None:
        if allowed:
            how = _rejected(node.label, inside)
            through = through or id(node) in passed
            if how == "name" and not inside and id(node) not in passed:
                stopped.append(node)
            allowed = not how or (how == "name" and id(node) in passed)
        hinted = hinted or (inside and "~" in node.label)
        inside = inside or (allowed and _main(node.label))
        roles.append((allowed and (inside or not through), inside, hinted))
        for child in node.children:
            walk(child, allowed, inside, through, hinted)

    while True:
        roles: list[tuple[bool, bool, bool]] = []
        stopped: list[Shape] = []
        walk(root, True, False, False, False)
        found = any(inside for _, inside, _ in roles)
        layout = {id(node) for node in stopped if _holds_main(node)}
        if found or not layout:
            return roles, found and not passed
        passed |= layout


def classify(wrapper: Shape) -> None:
    """Marks the wrapper nodes whose own text is template."""
    nodes = list(zip(shapes(wrapper), name_roles(wrapper)[0]))
    varied = {role[:2] for node, role in nodes if node.stats.get("low") != node.stats.get("high")}
    for node, (allowed, inside, hinted) in nodes:
        s = node.stats
        constant = s.get("votes", 0) >= CONSTANT_PAGES and s.get("chars", 0) > 0 and s.get("low") == s.get("high")
        linked = s.get("links", 0) > LINK_SHARE * max(1, s.get("chars", 0))
        node.template = (linked and (hinted or not inside)) or (constant and (allowed, inside) in varied)


def fold(trees: list[Shape]) -> Shape:
    """The trees merged in the given order."""
    wrapper = trees[0]
    for tree in trees[1:]:
        merge(wrapper, tree, {})
    return wrapper


def with_stats(skeleton: str, stats: list[dict]) -> Shape:
    page = shape_of(skeleton)
    varies = any(s["low"] != s["high"] for s, role in zip(stats, name_roles(page)[0]) if role[0])
    for node, s in zip(shapes(page), stats):
        node.stats = dict(s, votes=s["pages"] if varies else 1)
    return page


def induce(skeletons: list[tuple[str, list[dict]]]) -> Shape:
    """The wrapper of (skeleton, statistics by node) pairs, most frequent first."""
    wrapper = fold([with_stats(*s) for s in skeletons])
    classify(wrapper)
    return wrapper


STATS = ("pages", "chars", "links", "low", "high")
KEPT = (*STATS, "votes")


def tree_to_json(tree: Shape) -> str:
    def plain(s: Shape) -> list:
        return [s.label, [s.stats[k] for k in KEPT], [plain(c) for c in s.children]]
    return json.dumps(plain(tree), separators=(",", ":"))


def tree_from_json(text: str) -> Shape:
    def built(x: list) -> Shape:
        return Shape(x[0], [built(c) for c in x[2]], stats=dict(zip(KEPT, x[1])))
    return built(json.loads(text))


def to_json(wrapper: Shape) -> str:
    def plain(s: Shape) -> list:
        return [s.label, int(s.template), [plain(c) for c in s.children]]
    return json.dumps(plain(wrapper), separators=(",", ":"))


@lru_cache(maxsize=512)
def from_json(text: str) -> Shape:
    def built(x: list) -> Shape:
        return Shape(x[0], [built(c) for c in x[2]], bool(x[1]))
    return built(json.loads(text))


@lru_cache(maxsize=8192)
def content_nodes(skeleton: str, wrapper_json: str) -> tuple[bool, ...]:
    """For each node of a skeleton in preorder, whether it is in a content slot."""
    wrapper, page, memo = from_json(wrapper_json), shape_of(skeleton), {}

    def align(w: Shape, p: Shape) -> None:
        p.template = w.template
        for a, b in match(w, p, memo)[1]:
            align(w.children[a], p.children[b])

    if wrapper.label == page.label:
        align(wrapper, page)
    roles, regions = name_roles(page)
    return tuple(allowed and (inside or not regions) and not node.template for node, (allowed, inside, _) in zip(shapes(page), roles))


def page_text(html: str, wrapper_json: str) -> str:
    root = parse(html)
    flags = content_nodes(collapse(root), wrapper_json)
    blocks = [t for node, use in zip(preorder(root), flags) if use for t in node.texts]
    return "\n\n".join(text for _, text, _ in sorted(blocks))


# --- the jobs ----------------------------------------------------------------------------

def _stat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            root = parse(html)
            skeleton = collapse(root)
            key = hashlib.blake2b(skeleton.encode("utf-8", "replace"), digest_size=12).hexdigest()
            for i, node in enumerate(preorder(root)):
                digest = hashlib.blake2b("\n".join(t for _, t, _ in node.texts).encode("utf-8", "replace"), digest_size=8).hexdigest()
                rows.append((host, key, i, skeleton if i == 0 else None, digest, sum(len(t) for _, t, _ in node.texts),
                             sum(n for _, _, n in node.texts)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, (
                pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
            ["host", "form", "node", "skeleton", "digest", "chars", "links"])


def _fold_forms(rows: pd.DataFrame) -> pd.DataFrame:
    """The partial wrapper of the skeletons of one slot."""
    found = []
    for form, part in rows.sort_values(["form", "node"]).groupby("form", sort=True):
        found.append((-int(part["pages"].iloc[0]), form, with_stats(part["skeleton"].iloc[0], part[list(STATS)].to_dict("records"))))
    found.sort(key=lambda f: f[:2])
    return _partial(rows, -sum(f[0] for f in found), [f[2] for f in found])


def _fold_trees(rows: pd.DataFrame) -> pd.DataFrame:
    """The partial wrapper of the partial wrappers of one slot."""
    ordered = rows.sort_values(["pages", "part"], ascending=[False, True])
    return _partial(rows, int(rows["pages"].sum()), [tree_from_json(t) for t in ordered["tree"]])


def _partial(rows: pd.DataFrame, pages: int, trees: list[Shape]) -> pd.DataFrame:
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "slots": [rows["slots"].iloc[0]], "part": [rows["slot"].iloc[0]],
                         "pages": [pages], "tree": [tree_to_json(fold(trees))]})


def _wrapper_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("tree").to_pylist():
            wrapper = tree_from_json(text)
            classify(wrapper)
            found.append(to_json(wrapper))
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string())], ["host", "wrapper"])


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [page_text(h, w) if h else "" for h, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def _hosted(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one induced wrapper per host."""
    stats = _hosted(pages).select("host", "html").mapInArrow(
        _stat_batches, "host string, form string, node int, skeleton string, digest string, chars long, links long")
    stats = stored(stats.groupBy("host", "form", "node").agg(
        F.count("*").alias("pages"), F.max("skeleton").alias("skeleton"), F.sum("chars").alias("chars"),
        F.sum("links").alias("links"), F.min("digest").alias("low"), F.max("digest").alias("high")), "wrapper-stats")
    # one key column: after a join by host, a grouping by host and slot would still meet in one task
    key = F.concat_ws("\0", "slot", "host")
    slots = stats.where("node = 0").groupBy("host").agg(F.ceil(F.count("*") / FAN).cast("int").alias("slots"))
    forms = stats.join(slots, "host").withColumn("slot", F.pmod(F.xxhash64("form"), F.col("slots")).cast("int"))
    schema = "host string, slots int, part int, pages long, tree string"
    parts = stored(forms.withColumn("key", key).groupBy("key").applyInPandas(_fold_forms, schema), "wrapper-parts")
    while parts.where("slots > 1").limit(1).count():
        parts = parts.withColumn("slots", F.ceil(F.col("slots") / FAN).cast("int")).withColumn("slot", F.expr(f"part div {FAN}").cast("int"))
        parts = stored(parts.withColumn("key", key).groupBy("key").applyInPandas(_fold_trees, schema), "wrapper-parts")
    return stored(parts.select("host", "tree").mapInArrow(_wrapper_batches, "host string, wrapper string"), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, main text and its code points."""
    return _hosted(pages).join(wrappers(pages), "host").select("page_id", "url", "html", "wrapper").mapInArrow(
        _extract_batches, "page_id long, url string, text string, n_chars long")
