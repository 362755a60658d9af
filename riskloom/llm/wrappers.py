"""Main text of web pages by wrapper induction.

Pages of a host share a template. Each page becomes a tree of its blocks, in which a run of like
siblings is one repeated node. Trees of the same host are aligned by simple tree matching and merged
into one template tree, which counts for every node on how many pages it occurs, whether its text
stayed the same, how much text it held and how much of that was link text. Nodes whose text varies
are the slots; the lowest part of the tree that holds all varying text outside of navigation is where
the host keeps its articles. Texts outside of it are template and dropped, and so are texts inside that
nearly all pages of the host have; these are counted beside the tree, in bounded room.

Merging is associative up to alignment: tasks merge what they read, their templates meet in groups of
bounded size per host, and those in one per host, so that a host with a third of all pages is spread
over all tasks.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, settled, table
from riskloom.session import shuffle_partitions

# Elements without an end, with raw text, and those that stand in a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose start ends an open paragraph, and for list-like elements what they end of their kind.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre search section table ul".split()
)
ENDS_LIKE = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = frozenset("html body div section article main table ul ol dl td th li nav aside header footer form".split())
#: Elements and name parts that are never the article.
NEVER = frozenset("head nav header footer aside form button select input script style noscript template iframe svg menu dialog title".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
NEVER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|footer|header|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notice|popup|promo\w*|related|replies|responses?|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
PLACES = frozenset("article main".split())

#: Elements nested deeper than this stay texts of the node that holds them.
MOST_DEPTH = 100
#: A node with more runs of children than this keeps one child per label; if these are still more, those
#: on the fewest pages become one child per element name, and then one of any name.
MOST_CHILDREN = 32
#: A template with more nodes than this keeps fewer levels; a node at the last one has the texts below it.
MOST_NODES = 2000
#: Ends the label of a node that stands for several labels.
ANY = ".*"
#: Templates of one host that a task merges at a time.
FAN_IN = 64
#: Rules of all hosts up to this many characters are sent to every task.
BROADCAST_CHARS = 8_000_000
#: A text is template if so many pages or more were seen, this share of them has it, and it has so many
#: characters: shorter ones, such as headings and list items, are the same by chance.
CONSTANT_PAGES = 3
CONSTANT_SHARE = 0.8
CONSTANT_CHARS = 20
#: Hashes of texts that are counted for a host.
MOST_TEXTS = 4096
#: Elements that say that the article is near.
HEADED = frozenset(("h1", "main"))
#: A part with a telling name holds the articles if it has so many times the text outside of such parts.
NAMED = 2

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|</([a-zA-Z][^\s>/]*)[^>]*>|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s>/]|$)[^>]*>?", re.IGNORECASE) for name in RAW}
_SPACE = re.compile(r"\s+")
#: Numbers in class names and ids that are a page's own; shorter ones tell columns apart.
_NUMBER = re.compile(r"\d{3,}")


@dataclass(slots=True)
class Block:
    """A block element: its label, its text runs and child blocks in page order."""

    tag: str
    label: str
    never: bool = False
    parts: list = field(default_factory=list)  # str for text, Block for a child
    linked: int = 0  # characters of link text directly in it


def parse(page: str) -> Block:
    """The tree of blocks of a page; elements in a line, comments and raw elements leave no node."""
    root = Block("html", "html")
    path = [root]
    links = 0
    flat: dict[str, int] = {}  # open elements per name that are too deep for a node of their own
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            top = path[-1]
            top.parts.append(text)
            if links:
                top.linked += len(text.strip())
        if not m:
            break
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name in INLINE:
                links = max(0, links - 1) if name == "a" else links
            elif flat.get(name):
                flat[name] -= 1
                path[-1].parts.append(Block(name, name))  # only parts the texts
            else:
                _close(path, name)
                links = 0 if name not in VOID else links
        elif m[2]:
            name = m[2].lower()
            if name == "br" or name == "hr":
                path[-1].parts.append(" " if name == "br" else "")
            if name in ENDS_PARAGRAPH:
                _close_open(path, ("p",))
            if name in ENDS_LIKE:
                _close_open(path, ENDS_LIKE[name])
            if name in INLINE:
                links += name == "a"
            elif name in RAW:
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else n
            elif name not in VOID and name not in ("html", "body", "head") or name in ("body", "head") and len(path) == 1:
                if name == "body":
                    path[1:] = []
                block = _block(name, m[3])
                path[-1].parts.append(block)
                if len(path) < MOST_DEPTH:
                    path.append(block)
                else:
                    flat[name] = flat.get(name, 0) + 1
    return root


def _block(name: str, attributes: str) -> Block:
    label, never = name, name in NEVER
    if attributes and not attributes.isspace():
        found: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))
        never |= found.get("role", "").lower() in NEVER_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        classes = dict.fromkeys(_NUMBER.sub("#", x) for x in found.get("class", "").split())
        ids = dict.fromkeys(_NUMBER.sub("#", x) for x in found.get("id", "").split() if NEVER_NAMES.search(x))
        ids = [x for x in ids if x not in classes]
        label = f"{name}.{' '.join([*classes, *ids])}" if classes or ids else name
    return Block(name, label, never)


@functools.lru_cache(maxsize=100_000)
def telling(label: str, spared: frozenset[str] = frozenset()) -> frozenset[str]:
    """Class names and ids in a label that say that its node is not the article's.

    Those of ``spared`` say nothing, and what begins with one of them is told by its rest.
    """
    name, _, names = label.partition(".")
    if name in PLACES or name == "body":
        return frozenset()
    rest = lambda x: next((x[len(y) :] for y in sorted(spared, key=len, reverse=True) if x == y or x.startswith((y + "-", y + "_"))), x)
    return frozenset(x for x in names.split() if NEVER_NAMES.search(rest(x)))


def _close(path: list[Block], name: str) -> None:
    for i in range(len(path) - 1, 0, -1):
        if path[i].tag == name:
            del path[i:]
            return


def _close_open(path: list[Block], names: tuple[str, ...]) -> None:
    """End an open element of ``names``, unless a container that may hold another one lies between."""
    for i in range(len(path) - 1, 0, -1):
        if path[i].tag in names:
            del path[i:]
            if not any(b.tag in names for b in path[1:]):
                return
            return _close_open(path, names)
        if path[i].tag in SCOPES:
            return


def plain(parts: list[str]) -> str:
    """Text runs of one block: references decoded, white space turned to single spaces, trimmed."""
    return _SPACE.sub(" ", html.unescape("".join(parts))).strip()


# A template node is a list, which travels as JSON: label, pages, hash of its constant text or -1
# once it varied, characters that varied, characters in links, children.
LABEL, PAGES, SAME, VARIED, LINKED, CHILDREN = range(6)


def skeleton(block: Block) -> list:
    """The template of a single page without what is never an article's; runs of siblings with one label are one node."""
    own = "".join(p for p in block.parts if isinstance(p, str)).strip()
    children = _runs([skeleton(part) for part in block.parts if isinstance(part, Block) and not part.never])
    return [block.label, 1, zlib.crc32(own.encode("utf-8", "replace")), len(own), block.linked, children]


def _matching(a: list, b: list) -> int:
    """Simple tree matching: the most nodes that two trees have in common in order, labels agreeing."""
    if a[LABEL] != b[LABEL]:
        return 0
    return 1 + _align(a[CHILDREN], b[CHILDREN])[-1][-1]


def _align(xs: list, ys: list) -> list[list[int]]:
    """Best matching of every beginning of ``xs`` with every beginning of ``ys``."""
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs, 1):
        for j, y in enumerate(ys, 1):
            skip = max(best[i - 1][j], best[i][j - 1])
            best[i][j] = max(skip, best[i - 1][j - 1] + _matching(x, y)) if x[LABEL] == y[LABEL] else skip
    return best


def merge(a: list, b: list, along: bool = True) -> list:
    """Two templates aligned into one. ``along``: of different pages, so pages add up and texts compare."""
    xs, ys = a[CHILDREN], b[CHILDREN]
    if [x[LABEL] for x in xs] == [y[LABEL] for y in ys]:
        children = [merge(x, y, along) for x, y in zip(xs, ys, strict=True)]
    else:
        best = _align(xs, ys)
        i, j, out = len(xs), len(ys), []
        while i or j:
            if i and j and xs[i - 1][LABEL] == ys[j - 1][LABEL] and best[i][j] > max(best[i - 1][j], best[i][j - 1]):
                i, j = i - 1, j - 1
                out.append(merge(xs[i], ys[j], along))
            elif j and (not i or best[i][j - 1] >= best[i - 1][j]):
                j -= 1
                out.append(ys[j])
            else:
                i -= 1
                out.append(xs[i])
        children = _runs(out[::-1])
    same = a[SAME] if along and a[SAME] == b[SAME] else -1
    pages = a[PAGES] + b[PAGES] if along else a[PAGES]
    return [a[LABEL], pages, same, a[VARIED] + b[VARIED], a[LINKED] + b[LINKED], children]


def _runs(children: list[list]) -> list[list]:
    out: list[list] = []
    for child in children:
        if out and out[-1][LABEL] == child[LABEL]:
            out[-1] = merge(out[-1], child, along=False)
        else:
            out.append(child)
    if len(out) > MOST_CHILDREN:
        out = _folded(out, lambda c: c[LABEL])
        for name in (lambda c: _tag(c) + ANY, lambda c: "*" + ANY):
            if len(out) > MOST_CHILDREN:
                often = sorted((c for c in out if not c[LABEL].endswith(ANY)), key=lambda c: -c[PAGES])[: MOST_CHILDREN // 2]
                kept = {c[LABEL] for c in often}
                out = _folded(out, lambda c, name=name, kept=kept: c[LABEL] if c[LABEL] in kept else name(c))
    return out


def _folded(children: list[list], label: Callable[[list], str]) -> list[list]:
    """One child per ``label``."""
    by: dict[str, list] = {}
    for child in children:
        name = label(child)
        if name != child[LABEL]:
            child = [name, *child[1:]]
        if name not in by:
            by[name] = child
            continue
        a = by[name]
        pages = a[PAGES] + child[PAGES]
        by[name] = merge(a, child, along=False)
        if name.endswith(ANY):
            by[name][PAGES] = pages
    return list(by.values())


def bounded(template: list) -> list:
    """The template, or as many of its levels as have ``MOST_NODES`` nodes."""
    levels, now = [], [template]
    while now:
        levels.append(len(now))
        now = [c for node in now for c in node[CHILDREN]]
    if sum(levels) <= MOST_NODES:
        return template
    keep, total = 0, 0
    while total + levels[keep] <= MOST_NODES:
        total += levels[keep]
        keep += 1
    return _cut(template, max(keep, 1))


def _cut(node: list, levels: int) -> list:
    if levels > 1:
        return [*node[:CHILDREN], [_cut(c, levels - 1) for c in node[CHILDREN]]]
    below = [_cut(c, 1) for c in node[CHILDREN]]
    same = node[SAME] if not below else -1
    return [node[LABEL], node[PAGES], same, node[VARIED] + sum(c[VARIED] for c in below), node[LINKED] + sum(c[LINKED] for c in below), []]


def spared_names(template: list) -> frozenset[str]:
    """Telling names that a host's articles stand in, so that they tell nothing there.

    From the root, a part with a telling name is entered if it holds more than ``NAMED`` times the
    varying, unlinked text that stands outside of all such parts; a first heading or main element
    counts as four times the text.
    """
    spared: frozenset[str] = frozenset()
    while True:
        inside: dict[frozenset[str], list] = {}

        def look(node: list, names: frozenset[str], most: list) -> None:
            more = telling(node[LABEL], spared)
            if more and not names:
                names, most = more, inside.setdefault(more, [0, 1])
            most[0] += _own_slots(node)
            if _tag(node) in HEADED:
                most[1] = 4
            for c in node[CHILDREN]:
                look(c, names, most)

        outside = [0, 1]
        look(template, frozenset(), outside)
        weight, names = max(((n * k, sorted(x)) for x, (n, k) in inside.items()), default=(0, []))
        if not weight or weight <= NAMED * outside[0] * outside[1]:
            return spared
        spared |= frozenset(names)


def place_of(template: list, spared: frozenset[str] = frozenset()) -> list[str]:
    """Labels from the root to the lowest part that holds all varying, unlinked text.

    Parts with a telling name do not count. Never into a paragraph: where text lies in leaves, their
    parent is the place; nor into an article element.
    """
    path = [template[LABEL]]
    node = template
    while _tag(node) != "article" and not _own_slots(node):
        holds = [c for c in node[CHILDREN] if not telling(c[LABEL], spared) and _slots(c, spared)]
        if len(holds) != 1 or not holds[0][CHILDREN] or _tag(holds[0]) in ENDS_AT or holds[0][LABEL].endswith(ANY):
            break
        node = holds[0]
        path.append(node[LABEL])
    return path


def _tag(node: list) -> str:
    return node[LABEL].split(".")[0]


#: The article's place is above these.
ENDS_AT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure tr tbody".split())


def _own_slots(node: list) -> int:
    return max(0, node[VARIED] - node[LINKED]) if node[SAME] == -1 or node[PAGES] == 1 else 0


def _slots(node: list, spared: frozenset[str]) -> int:
    """Characters outside of links that varied over pages; all of what is on a single page counts."""
    return _own_slots(node) + sum(_slots(c, spared) for c in node[CHILDREN] if not telling(c[LABEL], spared))


# What travels beside a template: its pages, and per hash of a text on how many of them it is, at least.
# Beyond MOST_TEXTS hashes the rarest go and all lose what those had, so that a count is too low by no
# more than the number of all texts over MOST_TEXTS.


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def texts_on(block: Block) -> set[int]:
    """Hashes of the texts of a page that are long enough to be the same for a reason."""
    found = {text_hash(t) for t in _runs_of(block) if t is not None and len(t) >= CONSTANT_CHARS}
    for part in block.parts:
        if isinstance(part, Block) and not part.never:
            found |= texts_on(part)
    return found


def add_counts(into: dict[int, int], more: dict[int, int]) -> dict[int, int]:
    for k, n in more.items():
        into[k] = into.get(k, 0) + n
    if len(into) > MOST_TEXTS:
        less = sorted(into.values(), reverse=True)[MOST_TEXTS // 2]
        into = {k: n - less for k, n in into.items() if n > less}
    return into


def constants(pages: int, counts: dict[int, int]) -> list[int]:
    """Hashes of texts that nearly all of several pages have."""
    return sorted(k for k, n in counts.items() if pages >= CONSTANT_PAGES and n >= CONSTANT_SHARE * pages)


def extract(page: str, path: list[str], spared: frozenset[str] = frozenset(), constant: frozenset[int] = frozenset()) -> str:
    """The article's text: blocks in page order under ``path``, without what is never part of one.

    Texts of ``constant`` are left out, unless all long ones are of it: such a page is a copy of others. A
    page on which the path leads nowhere is read by its own tree.
    """
    root = parse(page)
    texts = [t for p in _under(root, path) for t in _texts(p, spared)]
    if not texts:
        own = skeleton(root)
        spared |= spared_names(own)
        texts = [t for p in _under(root, place_of(own, spared)) for t in _texts(p, spared)]
    if constant:
        same = [len(t) >= CONSTANT_CHARS and text_hash(t) in constant for t in texts]
        if any(len(t) >= CONSTANT_CHARS and not x for t, x in zip(texts, same, strict=True)):
            texts = [t for t, x in zip(texts, same, strict=True) if not x]
    return " ".join(texts)


def _under(block: Block, path: list[str]) -> list[Block]:
    found = [block] if path and block.label == path[0] else []
    for label in path[1:]:
        found = [c for b in found for c in b.parts if isinstance(c, Block) and c.label == label]
    return found


def _runs_of(block: Block) -> Iterator[str | None]:
    """Texts of a block itself, and None for each block inside it, in order."""
    run: list[str] = []
    for part in [*block.parts, None]:
        if isinstance(part, str):
            run.append(part)
            continue
        if run and (text := plain(run)):
            yield text
        run = []
        if part is not None:
            yield None


def _texts(block: Block, spared: frozenset[str]) -> list[str]:
    """Texts of a block and those inside it, in order."""
    out: list[str] = []
    inner = (part for part in block.parts if isinstance(part, Block))
    for text in _runs_of(block):
        if text is not None:
            out.append(text)
        elif not (part := next(inner)).never and not telling(part.label, spared):
            out += _texts(part, spared)
    return out


def _page(page: str) -> tuple[list, int, dict[int, int]]:
    root = parse(page)
    return bounded(skeleton(root)), 1, dict.fromkeys(texts_on(root), 1)


def _both(a: tuple[list, int, dict[int, int]], b: tuple[list, int, dict[int, int]]) -> tuple[list, int, dict[int, int]]:
    return bounded(merge(a[0], b[0])), a[1] + b[1], add_counts(a[2], b[2])


def _dump(kept: dict[str, tuple[list, int, dict[int, int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(kept), pa.string()),
         pa.array([json.dumps(t, separators=(",", ":")) for t, _, _ in kept.values()], pa.string()),
         pa.array([n for _, n, _ in kept.values()], pa.int64()),
         pa.array([list(c) for _, _, c in kept.values()], pa.list_(pa.int64())),
         pa.array([list(c.values()) for _, _, c in kept.values()], pa.list_(pa.int64()))],
        ["host", "tree", "pages", "texts", "counts"],
    )


def _load(batch: pa.RecordBatch) -> Iterator[tuple[str, tuple[list, int, dict[int, int]]]]:
    for h, t, n, texts, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield h, (json.loads(t), n, dict(zip(texts, counts, strict=True)))


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:  # a batch's hosts are all that is held
        kept: dict[str, tuple[list, int, dict[int, int]]] = {}
        for h, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            kept[h] = _both(kept[h], _page(p or "")) if h in kept else _page(p or "")
        yield _dump(kept)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge templates of the same host that follow each other."""
    host, whole = None, None
    for batch in batches:
        for h, one in _load(batch):
            if h == host and whole is not None:
                whole = _both(whole, one)
                continue
            if whole is not None:
                yield _dump({host: whole})
            host, whole = h, one
    if whole is not None:
        yield _dump({host: whole})


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [x for _, x in _load(batch)]
        spared = [spared_names(t) for t, _, _ in rows]
        paths = [place_of(t, x) for (t, _, _), x in zip(rows, spared, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(["\n".join(p) for p in paths], pa.string()), batch.column(2),
             pa.array([constants(n, c) for _, n, c in rows], pa.list_(pa.int64())),
             pa.array([" ".join(sorted(x)) for x in spared], pa.string())],
            ["host", "path", "pages", "constant", "spared"],
        )


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, path, pages, constant, spared): where each host keeps its articles, learned from all its pages."""
    schema = "host string, tree string, pages long, texts array<long>, counts array<long>"
    parts = map_arrow(pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("html")), _induce, schema)
    n = shuffle_partitions(pages.sparkSession)
    # A host's templates first meet in FAN_IN groups by where they come from, then all together.
    spread = parts.withColumn("part", F.pmod(F.xxhash64("tree"), F.lit(FAN_IN)))
    near = spread.repartition(n, "host", "part").sortWithinPartitions("host", "part", "tree").drop("part")
    whole = map_arrow(near, _join, schema).repartition(n, "host").sortWithinPartitions("host", "tree")
    return map_arrow(map_arrow(whole, _join, schema), _choose, "host string, path string, pages long, constant array<long>, spared string")


@functools.lru_cache(maxsize=100_000)
def _labels(path: str | None) -> list[str]:
    return path.split("\n") if path else []


@functools.lru_cache(maxsize=100_000)
def _names(spared: str | None) -> frozenset[str]:
    return frozenset((spared or "").split())


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, path) per page row; text is empty if there is no article or no html."""
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    placed = chosen.withColumn("host", host_of(F.col("url")))
    rules = settled(wrappers(placed).select("host", "path", "spared", "constant"))
    size = rules.agg(F.coalesce(F.sum(F.length("host") + F.length("path") + F.length("spared") + 8 * F.size("constant")), F.lit(0))).first()[0]
    # Rules that are measured to be small go to the pages; otherwise pages and rules meet by host, and
    # the engine splits a host that is too large for a task.
    rules = F.broadcast(rules) if size <= BROADCAST_CHARS else rules.hint("merge")
    found = placed.join(rules, "host", "left").select("page_id", "url", "html", "path", "spared", "constant")
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
            texts = [extract(p or "", _labels(path), _names(spared), frozenset(constant or ())) for p, path, spared, constant in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), batch.column(3)], ["page_id", "url", "text", "path"])

    return map_arrow(found, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, path string")


def query(spark, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
