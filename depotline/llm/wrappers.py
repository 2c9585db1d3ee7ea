"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is read as nested runs of elements. The wrapper of a host is one such nesting in which
an element may be optional or repeated and text is either fixed or a slot; it is made by
aligning one page after the other and resolving every mismatch: other text makes a slot,
an element on one side only an optional one, neighbours of one kind a repeated one, and
neighbouring runs of the same kinds a repeated group. The wrapper then says where a
host's pages keep their article.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import plain
from depotline.session import written

# Bytes of paths that are broadcast at most; beyond that, a join.
BROADCAST_BYTES = 32_000_000
# A name of an element stays in its key if at least one in so many of the host's pages has it;
# so a host has a bounded number of names, however many pages. Any other id or class is a slot, and
# so is one that fewer than LEAST_PAGES pages have, unless the host has no more pages.
NAME_SHARE, LEAST_PAGES = 50, 2
# Hosts whose wrappers one task holds before it hands them on.
HELD = 2_000
# Elements nested deeper are read as if they stood at this depth.
DEPTH = 60

# Fixed values of HTML: elements without end, inside a line, with raw content, and the elements
# that a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = "script style noscript iframe svg template textarea select object math canvas audio video"
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody"}}
# Elements and words of class, id and role that mark what is not the article.
NOT_TEXT = frozenset("nav header footer aside form button label fieldset dialog menu head title"
                     .split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar sidebars "
    "aside widget widgets cookie cookies consent notice notices alert popup modal subscribe newsletter "
    "signup login search share sharing social related recommended comment comments disqus reply "
    "replies respond form pagination pager toc skip complementary contentinfo".split())
ARTICLE = frozenset("article articlebody post entry story main content maincontent".split())
# Elements of running text: a part of a longer name, as in share-of-market, says nothing of them,
# and the search for the article does not go down into one.
RUNNING = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 li dd dt td th span a".split())
# Names that always count, since rules of this module look for them.
FIXED = MARKS | ARTICLE

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + RAW.replace(" ", "|") + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>|([^<]+|<)", re.S | re.I)
_MARK = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[^a-z0-9]+")
_NUMBER = re.compile(r"[0-9]+")


def names_of(marks: str) -> set[str]:
    """The names as keys have them: numbers are all alike, so post-123 is post and 0."""
    return {_NUMBER.sub("0", w) for w in _PART.split(marks.lower()) if w}


class Element:
    """An element with the text and the elements inside it, in order.

    Its key holds the names that are kept, and those of FIXED; all of them if `kept` is None.
    """

    __slots__ = ("tag", "key", "drop", "head", "root", "inside")

    def __init__(self, tag: str, marks: str = "", kept: frozenset[str] | None = None) -> None:
        names = {w for w in _PART.split(marks.lower()) if w}
        article = tag in ("article", "main")
        self.tag = tag
        general = {_NUMBER.sub("0", w) for w in names}
        shown = sorted(general if kept is None else general & kept | names & FIXED)
        self.key = tag + "." + ".".join(shown) if shown else tag
        tokens = set(marks.lower().split())
        # A mark counts as a whole name; as a part of one it does not where the element also names
        # itself the article, as in "content has-sidebar", or is running text.
        told = names & MARKS if not tokens & ARTICLE and tag not in RUNNING else tokens & MARKS
        told = told and not (article and not names & {"comment", "comments", "reply", "related", "ad", "sponsored"})
        self.drop = tag in NOT_TEXT or bool(told) and tag not in ("body", "html")
        # The head of an article, as "post-header", is dropped unless it holds the headline.
        self.head = (self.drop and tag not in NOT_TEXT and names & MARKS == {"header"}
                     and "header" not in tokens and bool(names & ARTICLE))
        # 2: the article itself, 1: a part that may hold it.
        self.root = 0 if self.drop else 2 if tag == "article" or "articlebody" in names else (
            1 if tag == "main" or names & ARTICLE else 0)
        self.inside: list = []


def parsed(page: str, kept: frozenset[str] | None = None) -> Element:
    """The page as nested elements. Marks inside a line count only where they rule text out."""
    top = Element("html")
    stack = [top]
    for m in _TOKEN.finditer(page):
        text = m[5]
        if text is not None:
            stack[-1].inside.append(text)
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "body") or tag in VOID:
            if tag not in INLINE and not m[2]:
                stack[-1].inside.append(None)  # ends a block
            continue
        if m[2]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                del stack[at:]
            continue
        attributes = m[4]
        marks = ""
        if attributes and "=" in attributes:
            marks = " ".join(f[1] or f[2] or f[3] for f in _MARK.findall(attributes))
        if tag in INLINE:
            if not marks or not Element(tag, marks).drop:
                continue
        else:
            ends = ENDS.get(tag, ())
            if stack[-1].tag in ends:
                stack.pop()
            elif tag not in ENDS and any(e.tag == "p" for e in stack[-3:]):
                while stack[-1].tag != "p":
                    stack.pop()
                stack.pop()
        element = Element(tag, marks, kept)
        if tag == "h1":
            for above in stack:
                above.drop = above.drop and not above.head
        stack[-1].inside.append(element)
        if len(stack) < DEPTH and not attributes.endswith("/"):
            stack.append(element)
    return top


# A wrapper's node: [key, optional, repeated, letters of text, fixed text or None for a slot,
# nodes inside]. A repeated group has the key "()".
def _node(element: Element) -> list:
    text = " ".join("".join(x for x in element.inside if isinstance(x, str)).split())
    inside = [_node(x) for x in element.inside if isinstance(x, Element) and not x.drop]
    return [element.key, False, False, len(text), text if len(text) <= 40 else None,
            _repeated(inside)]


def merged(a: list, b: list) -> list:
    """One node that matches what either matches."""
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] + b[3], a[4] if a[4] == b[4] else None,
            _aligned(a[5], b[5])]


def _repeated(nodes: list[list]) -> list[list]:
    """Neighbours of one key as a repeated node, neighbouring runs of keys as a repeated group."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            out[-1] = merged(out[-1], node)
            out[-1][2] = True
        else:
            out.append(node)
    for size in (2, 3):
        i = 0
        while i + 2 * size <= len(out):
            keys = [n[0] for n in out[i:i + size]]
            stop = i + size
            while [n[0] for n in out[stop:stop + size]] == keys:
                stop += size
            if stop > i + size and "()" not in keys:
                group = out[i:i + size]
                for k in range(i + size, stop, size):
                    group = [merged(x, y) for x, y in zip(group, out[k:k + size], strict=True)]
                out[i:stop] = [["()", False, True, 0, None, group]]
            i += 1
    return out


def _aligned(a: list[list], b: list[list]) -> list[list]:
    """Two runs of nodes as one: common keys are merged, the others become optional."""
    if [n[0] for n in a] == [n[0] for n in b]:
        return [merged(x, y) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if a[i][0] == b[j][0]
                          else max(best[i + 1][j], best[i][j + 1]))
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], True, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], True, *b[j][2:]])
            j += 1
    return _repeated(out)


def wrapper_of(page: str, kept: frozenset[str] | None = None) -> list:
    """The wrapper of a single page."""
    return _node(parsed(page, kept))


def expression(node: list) -> str:
    """The wrapper as text: (x)? optional, (x)+ repeated, #text a slot."""
    inside = " ".join(map(expression, node[5]))
    text = "" if not node[3] else f"'{node[4]}'" if node[4] else "#text"
    body = inside if node[0] == "()" else f"<{node[0]}> {text} {inside} </>".replace("  ", " ")
    return f"({body})" + "+" * node[2] + "?" * node[1] if node[1] or node[2] else body


def _kind(key: str) -> int:
    tag, _, marks = key.partition(".")
    return Element(tag, marks).root


def article_paths(wrapper: list) -> list[list[str]]:
    """Where the article stands: paths of keys below the top.

    Elements that name themselves the article; else such that may hold it; else the part that
    holds most of the text: from the top down while one element has three fifths of it.
    """
    found: dict[int, list[list[str]]] = {2: [], 1: []}

    def letters(node: list) -> int:
        return node[3] + sum(map(letters, node[5]))

    def walk(node: list, path: list[str]) -> None:
        for child in node[5]:
            inner = path if child[0] == "()" else [*path, child[0]]
            kind = _kind(child[0]) if child[0] != "()" else 0
            if kind and letters(child):
                found[kind].append(inner)
            walk(child, inner)

    walk(wrapper, [])
    for kind in (2, 1):
        if found[kind]:
            outer = {tuple(p) for p in found[kind]}
            return sorted([*p] for p in outer if not any(
                p[:n] in outer for n in range(1, len(p))))
    path: list[str] = []
    node = wrapper
    while True:
        total = letters(node)
        inner = [(letters(c), c) for g in node[5] for c in (g[5] if g[0] == "()" else [g])]
        share, child = max(inner, key=lambda x: x[0], default=(0, None))
        # A repeated element is a run of paragraphs, not a place, and so is a single one.
        if (child is None or child[2] or not total or 5 * share < 3 * total
                or child[0].partition(".")[0] in RUNNING):
            return [path]
        node = child
        path.append(child[0])


def main_text(page: str, paths: list[list[str]], kept: frozenset[str] | None = None) -> str:
    """Text of the page's elements at the paths; of the whole page where it has none of them."""
    top = parsed(page, kept)
    wanted = {tuple(p) for p in paths}
    heads = {p[:n] for p in wanted for n in range(len(p))}
    pieces: list[str] = []

    def collect(element: Element) -> None:
        pieces.append(" ")
        for x in element.inside:
            if isinstance(x, str):
                pieces.append(references.unescape(x))
            elif x is None:
                pieces.append(" ")
            elif not x.drop:
                collect(x)
            elif x.tag not in INLINE:
                pieces.append(" ")
        pieces.append(" ")

    def search(element: Element, path: tuple[str, ...]) -> bool:
        if path in wanted:
            collect(element)
            return True
        hit = False
        if path in heads:
            for x in element.inside:
                if isinstance(x, Element) and not x.drop:
                    hit = search(x, (*path, x.key)) or hit
        return hit

    if not search(top, ()):
        collect(top)
    return " ".join("".join(pieces).split())


def _host(url: str) -> Column:
    return F.lower(F.regexp_extract(plain(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _joined(rows: DataFrame, *keys: str) -> DataFrame:
    """One wrapper per key, merged from those of the rows."""
    import pandas as pd

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(set(frame["wrapper"]))
        whole = json.loads(texts[0])
        for text in texts[1:]:
            whole = merged(whole, json.loads(text))
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    return rows.groupBy(*keys).applyInPandas(work, "host string, wrapper string")


def _small(rows: DataFrame, *columns: str) -> bool:
    """Whether the columns' bytes fit a broadcast."""
    size = rows.agg(F.sum(sum((F.octet_length(plain(c)) for c in columns), F.lit(16)).cast("long"))).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def frequent_names(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, names): names of ids and classes that enough of the host's pages have, by spaces.

    Counted is by host and name, in the tasks first; what is left per host is at most NAME_SHARE
    times the names of a mean page.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([h for h, _ in held], pa.string()),
                                   pa.array([n for _, n in held], pa.string()),
                                   pa.array(list(held.values()), pa.int64())], names=["host", "name", "n"])
            held.clear()
            return out

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(),
                                  batch.column("html").to_pylist(), strict=True):
                marks = " ".join(f[1] or f[2] or f[3] for f in _MARK.findall(page))
                # The empty name counts the pages.
                held.update((host, name) for name in {"", *names_of(marks)})
                if len(held) > 100 * HELD:
                    yield handed()
        if held:
            yield handed()

    rows = pages.select(_host(url).alias("host"), plain(html).alias("html"))
    counts = (rows.mapInArrow(work, "host string, name string, n long")
              .groupBy("host", "name").agg(F.sum("n").alias("n")))
    counts = written(counts, "names")
    of = counts.filter("name = ''").select("host", F.col("n").alias("pages"))
    enough = (F.col("n") * NAME_SHARE >= F.col("pages")) & (F.col("n") >= F.least(F.lit(LEAST_PAGES), "pages"))
    found = (counts.filter("name <> ''").join(of, "host").filter(enough).groupBy("host")
             .agg(F.concat_ws(" ", F.sort_array(F.collect_list("name"))).alias("names")))
    return written(found, "names")


def wrappers(pages: DataFrame, url: str = "url", html: str = "html",
             names: DataFrame | None = None) -> DataFrame:
    """(host, wrapper as JSON) for every host, inferred from all its pages.

    `names` are the hosts' frequent names, as `frequent_names` gives them.

    Each task folds its own pages by host, so that a host with a third of all pages sends one
    wrapper per task; those are merged in two steps. Pages without a host share the empty one.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        sets: dict[str, frozenset[str]] = {}

        def handed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(held), pa.string()),
                                   pa.array(map(json.dumps, held.values()), pa.string())],
                                  names=["host", "wrapper"])
            held.clear()
            return out

        for batch in batches:
            for host, page, kept in zip(*(batch.column(n).to_pylist() for n in ("host", "html", "names")),
                                        strict=True):
                own = wrapper_of(page, _set_of(kept, sets))
                held[host] = merged(held[host], own) if host in held else own
                if len(held) > HELD:
                    yield handed()
        if held:
            yield handed()

    if names is None:
        names = frequent_names(pages, url, html)
    rows = pages.select(_host(url).alias("host"), plain(html).alias("html")).join(
        F.broadcast(names) if _small(names, "host", "names") else names, "host", "left")
    partial = rows.mapInArrow(work, "host string, wrapper string").withColumn(
        "_part", F.spark_partition_id() % 64)
    return _joined(_joined(partial, "host", "_part"), "host")


def _set_of(names: str | None, known: dict[str, frozenset[str]]) -> frozenset[str]:
    """The names as a set, remembered for a number of hosts."""
    if len(known) > HELD:
        known.clear()
    names = names or ""
    if names not in known:
        known[names] = frozenset(names.split())
    return known[names]


def extracted(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The pages with `text`, the article's text, in place of the html column.

    Character references are decoded and white space is folded; blocks are joined in page order.
    A null or empty page has an empty text. A column named text is replaced.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(article_paths(json.loads(w)))
                     for w in batch.column("wrapper").to_pylist()]
            yield pa.record_batch([batch.column("host"), pa.array(found, pa.string())],
                                  names=["_host", "_paths"])

    names = frequent_names(pages, url, html)
    known = wrappers(pages, url, html, names).mapInArrow(places, "_host string, _paths string")
    known = written(known.join(names.toDF("_host", "_names"), "_host", "left"), "wrappers")
    small = _small(known, "_host", "_paths", "_names")
    rows = pages.drop("text", "_host", "_paths", "_names").withColumn("_host", _host(url)).join(
        F.broadcast(known) if small else known, "_host", "left").drop("_host")
    schema = rows.drop("_paths", "_names", html).withColumn("text", F.lit("")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list] = {}
        sets: dict[str, frozenset[str]] = {}
        for batch in batches:
            texts = []
            for page, paths, kept in zip(*(batch.column(n).to_pylist() for n in (html, "_paths", "_names")),
                                         strict=True):
                if paths not in read:
                    read[paths] = json.loads(paths) if paths else [[]]
                texts.append(main_text(page or "", read[paths], _set_of(kept, sets)))
            own = [n for n in batch.schema.names if n not in (html, "_paths", "_names")]
            yield pa.record_batch([*(batch.column(n) for n in own), pa.array(texts, pa.string())],
                                  names=[*own, "text"])

    return rows.mapInArrow(work, schema)
