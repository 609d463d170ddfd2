"""HTML extraction by wrapper induction over the pages of a host.

A page becomes a tree of its block elements, in which the like children of a parent (same element, classes and id but for
digits) are one node, however many they are and whatever stands between them. For every host, the trees of all its pages
are aligned by simple tree matching and folded into one wrapper tree, ``FOLD`` at a time and what they give again, so that
a host with a third of all pages is no task of its own. Nodes that fewer than ``min_pages`` pages have are left out first,
since nothing can be told of them; so a wrapper doesn't grow with names that every page makes up. As like children are
one node, a node has few partners in another tree, and matching the children of two nodes is a heaviest increasing
sequence: time and memory grow with the trees, not with their product.

Every page is then aligned to its host's wrapper, and for every wrapper node the texts of its elements are counted over the
distinct pages of the host. A text that stands in a node on most pages that have the node is constant: it is template, in
an article too. The other elements of a node that enough pages have are seen to vary and are content, unless an element
around them is by its nature none (menus, forms, asides, comments, ...). An article that a page marks is evidence where
the pages of a host are too few to tell: outside it, only blocks that are seen to vary are content. Where all is constant,
as on copies of one page, nothing is dropped.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwright.plans.staging import release, stage

#: Trees that a task folds at once, about.
FOLD = 16
#: Bytes of wrappers that are sent to every executor; above, pages and wrappers are joined by a shuffle.
BROADCAST_BYTES = 16_000_000
#: Pages that a node needs, and of those that have it, the share on which a text must stand to be template.
MIN_PAGES, AGREEMENT = 3, 0.75
#: Alignments of trees up to so many characters are kept for the next page that needs them.
CACHED_CHARS = 50_000

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
MARK = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is not markup; what they hold is not text of the page.
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp plaintext svg math canvas object select button audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: What an opening tag closes if it is still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTENT = frozenset(("article", "main"))
CHROME_TAGS = frozenset("nav aside footer form dialog menu search head fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words in class and id that name a part which is not content.
CHROME_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus respond replies social share "
    "sharing related recommended recommendations widget widgets toolbar pagination pager login signup search skip masthead topbar".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond replies".split())
#: Words that say where or how a part stands, not what it is: ``menu-left`` is a menu, ``menu-recipe`` is none.
PLACE_WORDS = frozenset(
    "site page main top bottom left right center header head foot area box block section wrapper wrap container inner outer content list item items group row col column panel bar "
    "slot unit zone primary secondary global local mobile desktop sticky fixed first last small large post posts article articles link links text title button buttons form icon icons nav the".split()
)
WORDS = re.compile(r"[a-z]+")


class Nature(NamedTuple):
    """What an element and those around it are: no content by nature; in an article; in comments; in an article that
    lies in a part which is no content by its name, such as a list of related ones."""

    chrome: bool = False
    inside: bool = False
    commentary: bool = False
    weak: bool = False


def _names(tokens: list[str], words: frozenset[str]) -> bool:
    """Whether a class or id names such a part: one of the words, and beside it only words on place."""
    return any(found & words and found <= words | PLACE_WORDS | CHROME_WORDS for t in tokens if (found := set(WORDS.findall(t))))


def _element(tag: str, attrs: str, parent_tag: str, parent: Nature) -> tuple[str, Nature]:
    """Signature and nature of an element; those of short tags are kept, as they recur."""
    return (_element_again if len(attrs) <= 200 else _element_again.__wrapped__)(tag, attrs, parent_tag, parent)


@lru_cache(maxsize=20_000)
def _element_again(tag: str, attrs: str, parent_tag: str, parent: Nature) -> tuple[str, Nature]:
    classes = ident = role = ""
    hidden = False
    if attrs and attrs.strip(" /"):
        for m in ATTRIBUTE.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "class":
                classes = value.lower()
            elif name == "id":
                ident = value.lower()
            elif name == "role":
                role = value.lower().strip()
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    if tag in ("html", "body"):  # their classes name the page
        return tag, Nature(parent.chrome or hidden, parent.inside, parent.commentary, parent.weak)
    tokens = classes.split()
    sig = tag + ("." + " ".join(sorted(re.sub(r"\d+", "0", classes).split())) if classes else "") + ("#" + re.sub(r"\d+", "0", ident) if ident else "")
    named = [*tokens, ident] if tag != "main" else []
    commentary = parent.commentary or _names(named, COMMENT_WORDS)
    own = tag in CHROME_TAGS or hidden or role in CHROME_ROLES or commentary
    own = own or tag != "article" and _names(named, CHROME_WORDS)
    header = tag == "header" or tag != "article" and any("header" in WORDS.findall(t) for t in named)
    inside = parent.inside or tag in CONTENT or role in ("main", "article")
    chrome = own or header and not parent.inside
    if inside and not parent.inside:  # the article itself
        return sig, Nature(hidden or parent.commentary or parent_tag in ("aside", "nav", "footer") or commentary, inside, commentary, parent.chrome)
    return sig, Nature(parent.chrome or chrome, inside, commentary, parent.weak)


class Tree(NamedTuple):
    """A tree in preorder: each node's signature and the place of its parent, -1 for the root."""

    sigs: list[str]
    parents: list[int]

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.sigs]
        for i, p in enumerate(self.parents):
            if p >= 0:
                out[p].append(i)
        return out

    def text(self) -> str:
        return json.dumps([self.sigs, self.parents])

    @staticmethod
    def of(text: str) -> Tree:
        return Tree(*json.loads(text))


def preorder(sigs: list[str], children: list[list[int]]) -> tuple[Tree, list[int]]:
    """The tree of nodes numbered in any way, and the place of each."""
    out, place, stack = Tree([], []), [-1] * len(sigs), [(0, -1)]
    while stack:
        node, parent = stack.pop()
        place[node] = len(out.sigs)
        out.sigs.append(sigs[node])
        out.parents.append(parent)
        stack += [(c, place[node]) for c in reversed(children[node])]
    return out, place


class Block(NamedTuple):
    """A text block: the place of its node in the tree, its text, the share of link text, its nature, its element."""

    node: int
    text: str
    links: float
    nature: Nature
    element: int


class Tokens:
    """The markup tokens of a page, of any length, in time linear in the page: what is never closed is looked for once."""

    def __init__(self, page: str):
        self.page = page
        self.absent: dict[str, int] = {}  # from where on a string is not in the page
        self.open_ended: set[int] = set()  # opening quotes from which no tag ends
        self.attributes = ""  # of the last opening tag

    def find(self, what: str, at: int) -> int:
        if at >= self.absent.get(what, len(self.page)):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.absent[what] = at
        return found

    def tag_end(self, at: int) -> int:
        """Where the '>' of a tag is, beyond quoted values; -1 if a quote is never closed."""
        seen: list[int] = []
        while m := MARK.search(self.page, at):
            if m[0] == ">":
                return m.start()
            if m.start() in self.open_ended:
                break
            seen.append(m.start())
            close = self.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.open_ended.update(seen)
        return -1

    def __call__(self, start: int) -> tuple[int, str, str] | None:
        """End, kind and value of the token at a '<': "cdata", "close", "open" or "" for others; None if it is text.

        The value of a tag is its name; ``attributes`` are those of an opening tag, none where a quote is never closed.
        """
        page = self.page
        kind = page[start + 1 : start + 2]
        if kind != "!" and kind != "?":
            return self.tag(start, kind == "/")
        if page.startswith("<!--", start):
            end = self.find("-->", start + 4)
            return (end + 3 if end >= 0 else len(page), "", "")
        if page.startswith("<![CDATA[", start):
            end = self.find("]]>", start + 9)
            return (end + 3, "cdata", page[start + 9 : end]) if end >= 0 else (len(page), "cdata", page[start + 9 :])
        end = self.find(">", start + 2)
        return (end + 1, "", "") if end >= 0 else None

    def tag(self, start: int, closing: bool) -> tuple[int, str, str] | None:
        page = self.page
        name = NAME.match(page, start + 1 + closing)
        first = self.find(">", name.end()) if name else -1
        if first < 0:
            return None
        if closing:
            return first + 1, "close", name[0]
        between = page[name.end() : first]
        if '"' not in between and "'" not in between:
            self.attributes = between
            return first + 1, "open", name[0]
        end = self.tag_end(name.end())
        self.attributes = page[name.end() : end] if end >= 0 else ""
        return (end if end >= 0 else first) + 1, "open", name[0]


def parse(page: str) -> tuple[Tree, list[Block]]:
    """The tree of block elements and the text blocks in page order."""
    sigs, children, by_sig = [""], [[]], [{}]
    stack: list[tuple[int, str, Nature, int]] = [(0, "", Nature(), 0)]
    elements = 0
    opened: Counter[str] = Counter()
    found: list[Block] = []
    buffer: list[str] = []
    in_link, link_chars = 0, 0
    at, end = 0, len(page)
    tokens = Tokens(page)

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = "".join(buffer)
            text = " ".join((html_lib.unescape(text) if "&" in text else text).split())
            if text:
                node, _, nature, element = stack[-1]
                found.append(Block(node, text, link_chars / len(text), nature, element))
            buffer.clear()
        link_chars = 0

    def add(text: str) -> None:
        nonlocal link_chars
        buffer.append(text)
        if in_link:
            link_chars += len(text)

    def shut() -> None:
        opened[stack.pop()[1]] -= 1

    while at < end:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if start > at:
            add(page[at:start])
        token = tokens(start)
        if not token:
            add("<")
            at = start + 1
            continue
        at, kind, value = token
        if kind == "cdata":
            add(html_lib.escape(value))
            continue
        if kind == "close":
            closing = value.lower()
            if closing in BLOCK:
                flush()
                if opened[closing]:
                    while stack[-1][1] != closing:
                        shut()
                    shut()
            elif closing == "a":
                in_link = max(0, in_link - 1)
            continue
        if kind != "open":
            continue
        tag, attrs = value.lower(), tokens.attributes
        if tag in RAW:
            if not attrs.endswith("/") or tag in ("script", "style"):
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                past = tokens.find(">", close.end()) if close else -1
                at = past + 1 if past >= 0 else end
        elif tag == "br" or tag == "hr":
            flush()
        elif tag in VOID:
            continue
        elif tag in BLOCK:
            flush()
            if stack[-1][1] == "p":
                shut()
            ends = CLOSES.get(tag, ())
            while stack[-1][1] in ends:
                shut()
            parent, parent_tag, nature, _ = stack[-1]
            sig, nature = _element(tag, attrs, parent_tag, nature)
            node = by_sig[parent].get(sig)
            if node is None:
                node = by_sig[parent][sig] = len(sigs)
                children[parent].append(node)
                sigs.append(sig)
                children.append([])
                by_sig.append({})
            elements += 1
            stack.append((node, tag, nature, elements))
            opened[tag] += 1
        elif tag == "a":
            in_link += 1
    flush()
    tree, place = preorder(sigs, children)
    if place != list(range(len(place))):
        found = [b._replace(node=place[b.node]) for b in found]
    return tree, found


def slots(found: list[Block]) -> list[int]:
    """For each block, the hash of the text of its element, without that of elements inside."""
    texts: dict[int, list[str]] = {}
    for b in found:
        texts.setdefault(b.element, []).append(b.text)
    hashes = {e: _hash_text("\n".join(t)) for e, t in texts.items()}
    return [hashes[b.element] for b in found]


def heaviest(pairs: list[tuple[int, int, int, int]]) -> tuple[int, list[int]]:
    """Of pairs ``(i, j, weight, name)`` the heaviest that increase in both i and j: their weight and names."""
    width = max((j for _, j, _, _ in pairs), default=0) + 2
    best: list[tuple[int, int]] = [(0, -1)] * (width + 1)  # a tree of prefix maxima: weight, last pair
    before = [-1] * len(pairs)
    top = (0, -1)
    for k in sorted(range(len(pairs)), key=lambda k: (pairs[k][0], -pairs[k][1])):
        _, j, weight, _ = pairs[k]
        most, at = (0, -1), j
        while at > 0:
            if best[at][0] > most[0]:
                most = best[at]
            at &= at - 1
        before[k] = most[1]
        total, at = (most[0] + weight, k), j + 1
        while at <= width:
            if best[at][0] < total[0]:
                best[at] = total
            at += at & -at
        if total[0] > top[0]:
            top = total
    names, k = [], top[1]
    while k >= 0:
        names.append(pairs[k][3])
        k = before[k]
    return top[0], names[::-1]


def match_trees(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Simple tree matching: the pairs of places in a largest alignment of two trees that preserves order and descent."""
    if a.sigs[0] != b.sigs[0]:
        return []
    a_children, b_children = a.children(), b.children()
    pairs, ranks, of = [(0, 0)], [(0, 0)], [[]]
    n = 0
    while n < len(pairs):  # all pairs that can be aligned: equal signatures below equal signatures
        x, y = pairs[n]
        like: dict[str, list[tuple[int, int]]] = {}
        for j, d in enumerate(b_children[y]):
            like.setdefault(b.sigs[d], []).append((j, d))
        for i, c in enumerate(a_children[x]):
            for j, d in like.get(a.sigs[c], ()):
                of[n].append(len(pairs))
                pairs.append((c, d))
                ranks.append((i, j))
                of.append([])
        n += 1
    weights, chosen = [0] * n, [[]] * n
    for k in range(n - 1, -1, -1):
        weight, chosen[k] = heaviest([(*ranks[c], weights[c], c) for c in of[k]])
        weights[k] = weight + 1
    out, todo = [], [0]
    while todo:
        k = todo.pop()
        out.append(pairs[k])
        todo += chosen[k]
    return sorted(out)


def fold(wrapper: Tree, page: Tree) -> Tree:
    """The wrapper with the page's unmatched subtrees put in behind their left neighbours."""
    to = {p: w for w, p in match_trees(wrapper, page)}
    if not to:
        return wrapper
    sigs, children, page_children = list(wrapper.sigs), wrapper.children(), page.children()
    name = dict(to)
    for p in range(len(page.sigs)):
        if p not in name:
            name[p] = len(sigs)
            sigs.append(page.sigs[p])
            children.append([])
    for p, kids in enumerate(page_children):
        if p not in to:
            children[name[p]] = [name[c] for c in kids]
            continue
        old, at, merged = children[to[p]], 0, []
        for c in kids:
            if c in to:
                behind = old.index(to[c], at) + 1
                merged += old[at:behind]
                at = behind
            else:
                merged.append(name[c])
        children[to[p]] = merged + old[at:]
    return preorder(sigs, children)[0]


def paths(tree: Tree) -> list[int]:
    """A hash of each node's signatures from the root on; like children are one node, so it names the node."""
    out: list[int] = []
    for sig, parent in zip(tree.sigs, tree.parents, strict=True):
        above = out[parent].to_bytes(8, "big", signed=True) if parent >= 0 else b""
        out.append(_hash(above + sig.encode("utf-8", "surrogatepass")))
    return out


def pruned(tree: Tree, kept: frozenset[int]) -> Tree:
    """The tree without the nodes whose path is not kept, nor what is below them; the root stays."""
    place, out = {}, Tree([], [])
    for i, (path, sig, parent) in enumerate(zip(paths(tree), tree.sigs, tree.parents, strict=True)):
        if i == 0 or parent in place and path in kept:
            place[i] = len(out.sigs)
            out.sigs.append(sig)
            out.parents.append(place[parent] if i else -1)
    return out


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def _hash_text(text: str) -> int:
    return _hash(text.encode("utf-8", "surrogatepass"))


@lru_cache(maxsize=4096)
def _aligned_again(wrapper: str, page: str) -> dict[int, int]:
    return {p: w for w, p in match_trees(Tree.of(wrapper), Tree.of(page))}


def _aligned(wrapper: str, page: Tree) -> dict[int, int]:
    """The wrapper's node for each node of a page that has one."""
    text = page.text()
    return (_aligned_again if len(wrapper) + len(text) <= CACHED_CHARS else _aligned_again.__wrapped__)(wrapper, text)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and tree of the pages, equal ones of a batch together."""
    for batch in batches:
        n = Counter((host, parse(page or "")[0].text()) for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True))
        yield pa.RecordBatch.from_pydict({"host": pa.array([h for h, _ in n], pa.string()), "tree": pa.array([t for _, t in n], pa.string()), "pages": pa.array(list(n.values()), pa.int64())})


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, found, pages = [], [], []
        for host, tree, n in zip(*(batch.column(c).to_pylist() for c in ("host", "tree", "pages")), strict=True):
            each = paths(Tree.of(tree))
            hosts += [host] * len(each)
            found += each
            pages += [n] * len(each)
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "path": pa.array(found, pa.int64()), "pages": pa.array(pages, pa.int64())})


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [pruned(Tree.of(tree), frozenset(kept or ())).text() for tree, kept in zip(*(batch.column(c).to_pylist() for c in ("tree", "kept")), strict=True)]
        yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "wrapper": pa.array(trees, pa.string())})


def _fold_all(key: tuple, trees: pd.DataFrame) -> pd.DataFrame:
    first, *rest = sorted(trees["wrapper"])
    wrapper = Tree.of(first)
    for t in rest:
        wrapper = fold(wrapper, Tree.of(t))
    return pd.DataFrame({"host": [key[0]], "wrapper": [wrapper.text()]})


def _of_host(rows: DataFrame, by_host: DataFrame, salt: str) -> DataFrame:
    """Rows with what their host has (``host, size`` and more): by broadcast while all of it is small, else by a salted join."""
    if (by_host.agg(F.sum("size")).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(by_host.drop("size")), "host", "left")
    salts = 32
    salted = by_host.drop("size").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int")).join(salted, ["host", "_salt"], "left").drop("_salt")


def induce(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, wrapper`` for every host: the trees of all its pages, without nodes of fewer than ``min_pages``, folded into one."""
    every = pages.select("host", "html").mapInArrow(_trees, "host string, tree string, pages long")
    every = stage(every.groupBy("host", "tree").agg(F.sum("pages").alias("pages")), "trees")
    often = every.mapInArrow(_paths, "host string, path long, pages long").groupBy("host", "path").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= min_pages)
    often = stage(often.groupBy("host").agg(F.collect_list("path").alias("kept"), (F.count("*") * 8).alias("size")), "tree-paths")
    trees = stage(_of_host(every.select("host", "tree"), often, "tree").select("host", "tree", "kept").mapInArrow(_pruned, "host string, wrapper string").distinct(), "trees")
    while True:
        counts = stage(trees.groupBy("host").agg(F.count("*").alias("trees")).where("trees > 1"), "tree-counts")
        if counts.isEmpty():
            return trees
        several = trees.join(counts, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("trees") / FOLD)))
        folded = several.groupBy("host", "part").applyInPandas(_fold_all, "host string, wrapper string")
        before, trees = trees, stage(folded.union(trees.join(counts, "host", "left_anti")).distinct(), "trees")
        release(before)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every page, the elements' texts by wrapper node, as hashes; text 0 says that the page has the node."""
    for batch in batches:
        hosts, nodes, texts, pages = [], [], [], []
        for host, page, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper")), strict=True):
            tree, found = parse(page or "")
            to = _aligned(wrapper, tree)
            rows = {(to[b.node], t) for b, h in zip(found, slots(found), strict=True) if b.node in to for t in (0, h)}
            hosts += [host] * len(rows)
            nodes += [n for n, _ in rows]
            texts += [t for _, t in rows]
            pages += [_hash_text(page or "")] * len(rows)
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "node": pa.array(nodes, pa.int32()), "text": pa.array(texts, pa.int64()), "page": pa.array(pages, pa.int64())})


def main_text(page: str, wrapper: str | None, constant: frozenset[tuple[int, int]] = frozenset(), known: frozenset[int] = frozenset()) -> str:
    """The main text of a page, given its host's wrapper, its constant texts (node, hash of the text) and the nodes that
    enough pages have to tell."""
    tree, found = parse(page)
    to = _aligned(wrapper, tree) if wrapper else {}
    rows = [(b, (to.get(b.node), h) in constant) for b, h in zip(found, slots(found), strict=True) if not b.nature.chrome]
    article = [b for b, _ in rows if b.nature.inside]
    if article:
        strong = any(not b.nature.weak for b in article)
        marked = [(b, t) for b, t in rows if (not b.nature.weak or not strong if b.nature.inside else to.get(b.node) in known and b.links < 0.8)]
        kept = [b.text for b, template in marked if not template]
        return "\n".join(kept or [b.text for b, _ in marked if b.nature.inside])
    kept = [b.text for b, template in rows if not template and b.links < 0.8]
    return "\n".join(kept or [b.text for b, _ in rows])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("html", "wrapper", "constant", "known"))
        texts = [main_text(h or "", w, frozenset((x["node"], x["text"]) for x in c or ()), frozenset(k or ())) for h, w, c, k in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "host": batch.column("host"),
        })


def learn(pages: DataFrame, min_pages: int = MIN_PAGES, agreement: float = AGREEMENT) -> DataFrame:
    """``host, wrapper, constant, known, size`` for every host; ``pages`` has page_id, host, html.

    ``known`` are the wrapper nodes that ``min_pages`` distinct pages or more have, ``constant`` the texts that stand on so
    many and on a share of ``agreement`` of those that have the node. Copies of a page count once.
    """
    wrappers = induce(pages, min_pages)
    sized = wrappers.withColumn("size", F.length("wrapper"))
    texts = _of_host(pages.select("page_id", "host", "html"), sized, "page_id").select("host", "html", "wrapper").mapInArrow(_texts, "host string, node int, text long, page long")
    counts = stage(texts.distinct().groupBy("host", "node", "text").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages), "node-texts")
    known = counts.where("text = 0").select("host", "node", F.col("n").alias("pages"))
    judged = counts.join(known, ["host", "node"]).where((F.col("text") == 0) | (F.col("n") >= F.col("pages") * agreement))
    labels = judged.groupBy("host").agg(F.collect_list(F.when(F.col("text") != 0, F.struct("node", "text"))).alias("constant"), F.collect_list(F.when(F.col("text") == 0, F.col("node"))).alias("known"))
    size = F.length("wrapper") + F.coalesce(F.size("constant") * 16 + F.size("known") * 4, F.lit(0))
    return stage(wrappers.join(labels, "host", "left").withColumn("size", size), "wrappers-labelled")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, host`` for every row of ``pages`` (page_id, url, html).

    Null html gives the empty text; pages without a url share one host; repeated rows are extracted alike; a page of any
    length, depth or number of blocks is read whole, in time about linear in it; blocks of equal text in one node are
    judged alike; an empty table gives an empty result; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    labelled = learn(rows)
    joined = _of_host(rows, labelled, "page_id").select("page_id", "url", "html", "host", "wrapper", "constant", "known")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long, host string")
