"""Main text of web pages by wrapper induction.

A page becomes a tree of elements. The pages of a host are told apart by layout, which is where a page's own text lies.
The trees of all pages of a layout are aligned by simple tree matching (the largest order-preserving match of children,
by dynamic programming; repeated siblings of one kind are folded into one node beforehand, and their texts count as one
text of the page). Trees are aligned in the tasks that read the pages, and the aligned trees are merged. A node whose
text is the same on all pages is template; one whose text varies is a slot. The slot that holds most of the varying
running text, outside of links and of elements that by name are not the article, is the content root of the layout; its
path is the wrapper. It never leads into a node that a page has several times, as the text lies in all of them. Every page
is read with the wrapper of its layout, whole: all text below the content root, less what is marked as something else
(menus, forms, notices, comments and so on). Text below the root is never dropped for being alike on several pages.

All pages are aligned and all are extracted. What is bounded is the tree: levels below ``DEEPEST`` count for the node
they lie in, and of more than ``WIDE`` kinds of children the rarest count for their parent; no text is lost by either,
as the wrapper then ends further up. A page whose tree lacks the wrapper's path, or has no text there, is read with the
wrapper of the page alone.

White space inside a block becomes one blank, blocks are joined in page order by one blank. Null and empty pages give
empty text; a null or odd url is a host of its own. Repeated rows are extracted alike. Extra columns are returned,
columns named like results are replaced.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import columns_of, ddl
from cladeflow.session import cut

# Levels of a page that are told apart, kinds of children of a node kept apart, texts that still count as taking turns,
# aligned trees held by a task at a time, salts of a layout.
DEEPEST, WIDE, TURNS, HELD, SALTS = 64, 64, 16, 500, 16
RESULT = ("text", "n_chars")
# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
SILENT = frozenset("script style noscript template svg math iframe object canvas head title select option button textarea input audio video map datalist".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset search".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("table ul ol dl div article section body main".split())
CONTAINERS = frozenset("div section article main table tbody tr td center header span".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|submenu|breadcrumbs?|crumbs?|sidebar|side|aside|widget|footer|foot|masthead|banner|ads?|advert\w*|sponsor\w*|promo\w*"
    r"|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|commentlist|replies|reply|respond|disqus"
    r"|pagination|pager|tags?|toolbar|skip|legal|copyright|gdpr|paywall|overlay|toc|byline-links)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "key", "aside", "children", "parent")

    def __init__(self, tag: str, key: str, aside: bool, parent: Node | None):
        self.tag, self.key, self.aside, self.parent = tag, key, aside, parent
        self.children: list[Node | str] = []


def _is_aside(tag: str, attrs: dict[str, str]) -> bool:
    if tag in ASIDE or attrs.get("role", "").lower() in _ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    return tag not in ("html", "body", "main", "article") and bool(_NAMES.search(attrs.get("class", "")) or _NAMES.search(attrs.get("id", "")))


class _Reader(HTMLParser):
    """Builds the tree; end tags may be missing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#page", "#page", False, None)

    def _close(self, tags, stop) -> None:
        node = self.at
        while node.parent is not None and node.tag not in stop:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close(("p",), SCOPES)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], ("table",) if tag in ("tr", "td", "th") else ("ul", "ol", "dl", "select"))
        known = {k: v or "" for k, v in attrs}
        aside = _is_aside(tag, known)
        if tag == "header" or _HEADER.search(known.get("class", "") + " " + known.get("id", "")):
            # inside the article it is the article's own
            node = self.at
            while node is not None and node.tag not in ("article", "main"):
                node = node.parent
            aside = aside or node is None
        name = re.sub(r"\d+", "", known.get("id", "") or known.get("class", "").split(" ")[0])
        node = Node(tag, f"{tag}.{name}" if name else tag, aside, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent
        elif tag == "p":
            self.at.children.append(Node("p", "p", False, self.at))

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.root


def read_text(node: Node) -> str:
    """Blocks below a node in page order, without what is not the article."""
    blocks: list[list[str]] = [[]]
    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            blocks.append([])
        elif isinstance(x, str):
            blocks[-1].append(x)
        elif x is node or not (x.aside or x.tag in SILENT):
            inline = x.tag in INLINE
            if not inline:
                todo.append(None)
            todo.extend(reversed(x.children))
            if not inline:
                todo.append(None)
    said = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return " ".join(b for b in said if b)


class Slot:
    """A node of the aligned tree: how many pages have it, how many siblings of its kind a page has at most, the texts
    its pages held in it (by hash, those of all siblings of a page as one), and its children."""

    __slots__ = ("key", "tag", "aside", "pages", "many", "own", "chars", "rest", "linked", "children")

    def __init__(self, node: Node | list[Node], linked: bool, depth: int = 0):
        # siblings of one kind are occurrences of one node
        nodes = node if isinstance(node, list) else [node]
        self.key, self.tag, self.aside, self.pages, self.many = _kind(nodes[0]), nodes[0].tag, nodes[0].aside, 1, len(nodes)
        self.linked = linked or self.tag == "a"
        said = [(_all_text(n) if depth == DEEPEST else "".join(c for c in n.children if isinstance(c, str))).strip() for n in nodes]
        self.chars, self.rest = sum(map(len, said)), 0
        self.own = {xxhash.xxh64_intdigest("\0".join(said).encode("utf-8", "replace")): self.chars}
        kinds: dict[str, list[Node]] = {}
        if depth < DEEPEST:
            for n in nodes:
                for child in n.children:
                    if isinstance(child, Node) and child.tag not in SILENT:
                        kinds.setdefault(_kind(child), []).append(child)
        self.children = [Slot(same, self.linked, depth + 1) for same in kinds.values()]

    def text(self) -> int:
        """Characters of varying text in all pages seen, outside of links. A few texts in turn count once each."""
        if self.linked or self.aside or (len(self.own) == 1 and self.pages > 1):
            return 0
        return self.chars if len(self.own) > TURNS else sum(self.own.values())


def _kind(node: Node) -> str:
    return node.key + "!" if node.aside else node.key


def _all_text(node: Node) -> str:
    said, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            said.append(x)
        elif x is node or not (x.aside or x.tag in SILENT):
            todo.extend(reversed(x.children))
    return " ".join(said)


def matching(a: Slot, b: Slot, memo: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Size of the largest match of two trees with equal roots, and the pairs of their matched children."""
    if a.key != b.key:
        return 0, []
    memo = {} if memo is None else memo
    if (found := memo.get((id(a), id(b)))) is not None:
        return found
    m, n = len(a.children), len(b.children)
    keys = [c.key for c in a.children]
    if keys == [c.key for c in b.children] and len(set(keys)) == m:
        found = 1 + sum(matching(x, y, memo)[0] for x, y in zip(a.children, b.children, strict=True)), [(i, i) for i in range(m)]
    else:
        best = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(m):
            for j in range(n):
                size = matching(a.children[i], b.children[j], memo)[0]
                best[i + 1][j + 1] = max(best[i + 1][j], best[i][j + 1], best[i][j] + size)
        pairs, i, j = [], m, n
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        found = best[m][n] + 1, pairs[::-1]
    memo[id(a), id(b)] = found
    return found


def align(template: Slot, page: Slot, memo: dict | None = None) -> None:
    """Add a page, or the aligned tree of other pages; nodes without partner are kept in page order."""
    memo = {} if memo is None else memo
    pairs = dict((j, i) for i, j in matching(template, page, memo)[1])
    template.pages += page.pages
    template.many = max(template.many, page.many)
    template.chars += page.chars
    template.rest += page.rest
    template.own.update(page.own)
    if len(template.own) > TURNS + 1:
        template.own = {k: template.own[k] for k in sorted(template.own)[: TURNS + 1]}
    after: list[Slot] = list(template.children)
    for j, child in enumerate(page.children):
        if j in pairs:
            align(template.children[pairs[j]], child, memo)
        else:
            before = max((pairs[k] for k in range(j) if k in pairs), default=-1)
            place = after.index(template.children[before]) + 1 if before >= 0 else 0
            after.insert(place, child)
    if len(after) > WIDE:
        # the rarest kinds count as text of no kind; no wrapper leads into it
        rare = {id(c) for c in sorted(after, key=lambda c: (c.pages, c.key))[: len(after) - WIDE // 2]}
        template.rest += sum(_weight(c) for c in after if id(c) in rare)
        after = [c for c in after if id(c) not in rare]
    template.children = after


def _weight(slot: Slot) -> int:
    return 0 if slot.aside else slot.text() + (0 if slot.linked else slot.rest) + sum(map(_weight, slot.children))


def wrapper(template: Slot) -> list[str]:
    """Keys from below the page to the content root: down while one child holds nearly all varying text.

    A child that a page has several times is no root: the text lies in all of them, and their parent holds it.
    """
    return _descend(template)[0]


def _descend(template: Slot) -> tuple[list[str], list[str]]:
    """The wrapper, and the kinds of containers that hold a fifth or more of the text below its end."""
    path, at = [], [template]
    while True:
        kinds: dict[str, list[Slot]] = {}
        for child in (c for slot in at for c in slot.children):
            kinds.setdefault(child.key, []).append(child)
        weights = {key: sum(map(_weight, same)) for key, same in kinds.items()}
        total = sum(weights.values()) + sum(slot.text() + slot.rest for slot in at)
        most, key = max(((w, k) for k, w in weights.items()), default=(0, ""))
        # an article or main is the root; below it everything belongs to the article
        if not total or at[0].tag in ("article", "main"):
            return path, []
        into = kinds.get(key, at)
        if most < 0.8 * total or into[0].tag in INLINE or into[0].tag in ("p", "br", "li", "td") or any(slot.many > 1 for slot in into):
            return path, sorted(k for k, w in weights.items() if w >= 0.2 * total and kinds[k][0].tag in CONTAINERS)
        at = into
        path.append(key)


def layout(page: Slot) -> tuple[int, list[str]]:
    """A page's layout, by where its text lies, and the wrapper of the page alone."""
    path, beside = _descend(page)
    return xxhash.xxh64_intdigest(repr((path, beside)).encode("utf-8", "replace")) - (1 << 63), path


def follow(root: Node, path: list[str]) -> Node | None:
    for key in path:
        root = next((c for c in root.children if isinstance(c, Node) and c.key == key and not c.aside), None)
        if root is None:
            return None
    return root


def extract(html: str, wrappers: dict[int, list[str]] | None) -> str:
    """wrappers: of the host, by layout."""
    if not html or not html.strip():
        return ""
    page = parse(html)
    kind, own = layout(Slot(page, False))
    path = (wrappers or {}).get(kind)
    node = follow(page, path) if path is not None else None
    if node is None or not (said := read_text(node)):
        node = follow(page, own)
        said = read_text(node if node is not None else page)
    return said


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\w+://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def learn(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """host and wrappers, a map from layout to path, of layouts whose wrapper is another than that of their pages alone.

    All pages are aligned where they are read; only the aligned trees are shuffled, and merged by salts first.
    """
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], tuple[list[str], Slot]] = {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("_html").to_pylist(), strict=True):
                if not page or not page.strip():
                    continue
                slot = Slot(parse(page), False)
                kind, own = layout(slot)
                if (host, kind) in seen:
                    align(seen[host, kind][1], slot)
                else:
                    seen[host, kind] = own, slot
                if len(seen) >= HELD:
                    yield rows(seen)
                    seen = {}
        yield rows(seen)

    def rows(seen: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([host for host, _ in seen], pa.string()),
                pa.array([kind for _, kind in seen], pa.int64()),
                pa.array([own for own, _ in seen.values()], pa.list_(pa.string())),
                pa.array([_packed(slot) for _, slot in seen.values()], pa.binary()),
            ],
            names=["host", "layout", "own", "tree"],
        )

    def merged(batches: Iterator[pa.RecordBatch]) -> tuple[list[str], Slot]:
        template = own = None
        for batch in batches:
            for path, tree in zip(batch.column("own").to_pylist(), batch.column("tree").to_pylist(), strict=True):
                slot = pickle.loads(zlib.decompress(tree))
                if template is None:
                    own, template = path, slot
                else:
                    align(template, slot)
        return own, template

    def partial(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield rows({(key[0].as_py(), key[1].as_py()): merged(batches)})

    def induce(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, template = merged(batches)
        path = wrapper(template)
        if path != own:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k.as_py()], k.type) for k in key), pa.array([path], pa.list_(pa.string()))], names=["host", "layout", "path"]
            )

    schema = "host string, layout bigint, own array<string>, tree binary"
    trees = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("_html")).mapInArrow(collect, schema)
    salted = trees.groupBy("host", "layout", F.pmod(F.xxhash64("tree"), F.lit(SALTS)).alias("salt")).applyInArrow(partial, schema)
    found = salted.groupBy("host", "layout").applyInArrow(induce, "host string, layout bigint, path array<string>")
    return found.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("layout", "path"))).alias("wrappers"))


def _packed(slot: Slot) -> bytes:
    return zlib.compress(pickle.dumps(slot, pickle.HIGHEST_PROTOCOL), 1)


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The pages without their html, with text and n_chars (code points)."""
    # written first, so that the pages are joined knowing its size
    learned = cut(learn(pages, url=url, html=html))
    fields = [f for f in pages.schema.fields if f.name not in (*RESULT, html)]
    learned = learned.select(F.col("host").alias("_known"), F.col("wrappers").alias("_wrappers"))
    both = pages.withColumn("_host", host_of(F.col(url))).join(learned, F.col("_host") == F.col("_known"), "left").select(
        *[f"`{f.name}`" for f in fields], F.col(html).alias("_html"), "_wrappers"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrappers = (dict(w) if w else None for w in batch.column("_wrappers").to_pylist())
            said = [extract(h, w) for h, w in zip(batch.column("_html").to_pylist(), wrappers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*columns_of(fields, batch), pa.array(said, pa.string()), pa.array(map(len, said), pa.int64())], names=[*(f.name for f in fields), *RESULT]
            )

    return both.mapInArrow(run, f"{ddl(fields)}, text string, n_chars bigint")
