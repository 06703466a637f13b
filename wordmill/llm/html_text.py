"""Main text of web pages by wrappers that are inferred for each host without unions.

A page is a stream of tags and texts, read as a tree of its containers. The wrapper of a host is an
expression over such streams: fixed tags, text slots, optional groups and repeated groups, no
alternatives. Pages are aligned with the wrapper one by one. Where the streams differ, a run of like
elements becomes a repeated group, an element that one side lacks becomes optional, a text that
differs becomes a slot; a flow of inline and paragraph tags in irregular order is the repeated group of its
tags, each optional. Each task infers a wrapper for the hosts that it meets; a host's distinct wrappers are
aligned with each other the same way, in two rounds, so a host with a third of all pages is one
wrapper for each task by then and never its pages in one place.

In the wrapper an element is the article, boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments of readers) or neither. Aligning a page with its host's
wrapper tells which of its texts are kept: those inside the page's article; where it has none, the slots
outside boilerplate, that is without the texts that all pages of the host share. A text is shared only
where every page of the host has this very text at this place ("a" in the nodes from there up).

Boilerplate is marked by an element's name or by a whole word of its class, id or role. Never is it the page, the
article, a heading, a part of a table or an inline tag, or what holds the page or a main element. What holds the only
article of a page is none either, unless its own name says so (other than form and fieldset) or a word of readers'
comments or of related pages: the article is then a comment or a teaser.

Defined results: null and empty html, and a page without main text, give an empty text and 0
characters. A null url is a host of its own. Tags that are never closed end with what holds them.
Repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

import html
import json
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.joins import salted_lookup
from wordmill.llm.common import cut_lineage, native, slices, text_bytes

#: Containers nested deeper than this are read as the tags of a flow (but for boilerplate and the outermost article).
MAX_DEPTH = 100
#: Children of one wrapper node; beyond that, keys are coarsened to tag names and any repetition folds.
MAX_NODES = 200
#: Pages that a text must be shared by, at least, to count as the host's own.
SHARED_PAGES = 3

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe|noscript|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOXES = frozenset("""html head body main article section div nav header footer aside form ul ol dl table figure
    dialog details menu select button template svg fieldset address""".split())
_ARTICLE = frozenset(["article", "main"])
_PAGE = frozenset(["html", "body", "article", "main"])
_DROPPED = frozenset("""head nav header footer aside form dialog menu select button template svg fieldset""".split())
#: Never marked by class, id and role: the page, the article, headings, parts of tables, inline tags.
_SPARED = frozenset("""html body article main h1 h2 h3 h4 h5 h6 hgroup caption thead tbody tfoot tr td th a abbr acronym b bdi
    bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt
    u var""".split())
#: Words of class, id and role values that mark boilerplate (fixed list).
_MARKS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar header masthead footer cookie cookies consent gdpr notice
    alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended
    comment comments disqus reply replies respond toolbar pagination pager skip contentinfo complementary""".split())
#: Those of them whose articles are not the page's.
_OTHERS = frozenset("comment comments disqus reply replies respond related recommended".split())
_BREAKS = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main nav ol option p pre section summary
    table tbody td tfoot th thead title tr ul""".split())


class Box:
    """A container of a page: children are boxes and flows (lists of texts and tag names).

    Boilerplate is a box without children. ``nested`` counts the open elements inside that are no boxes:
    of boilerplate those of its name, else containers nested too deep, by name.
    """

    __slots__ = ("key", "name", "role", "items", "nested")

    def __init__(self, key: str, role: str):
        self.key, self.name, self.role, self.items, self.nested = key, key.partition(".")[0], role, [], {}


def _label(name: str, attributes: str) -> tuple[str, str]:
    """(alignment key, role) of an element: its name and the words of its class, id and role
    (of boilerplate only those that mark it)."""
    values = [(m[1] or m[2] or m[3] or "").lower() for m in _NAMES.finditer(attributes)]
    whole = {w for v in values for w in v.split()}
    marks = whole & _MARKS if name not in _SPARED else frozenset()
    if marks or name in _DROPPED:
        return ".".join([name, *sorted(marks)]), "drop"
    words = sorted({w for v in values for w in re.findall(r"[a-z]+", v)})
    return ".".join([name, *words]), "article" if name in _ARTICLE or "main" in whole and name not in _SPARED else ""


def _holders(page: str, names: set[str]) -> set[int]:
    """Where the boilerplate begins that holds an element of ``names`` and is none for that reason."""
    out: set[int] = set()
    stack: list[tuple[str, int, bool]] = []
    n_open: dict[str, int] = {}
    known = 0  # the elements below this depth are in ``out``, if they belong there
    for m in _TOKEN.finditer(page):
        name = (m[3] or "").lower()
        if not name or name in _VOID or m[4].endswith("/"):
            continue
        close = name if m[2] else "p" if name in _BREAKS and stack and stack[-1][0] == "p" else ""
        if close and n_open.get(close):
            while True:
                last = stack.pop()[0]
                n_open[last] -= 1
                if last == close:
                    break
            known = min(known, len(stack))
        if m[2]:
            continue
        if name in names:
            out.update(at for _, at, free in stack[known:] if free)
            known = len(stack)
        key, role = _label(name, m[4])
        free = role == "drop" and ("article" not in names or name in ("form", "fieldset") or
                                   name not in _DROPPED and not _OTHERS & {*key.split(".")[1:]})
        stack.append((name, m.start(), free))
        n_open[name] = n_open.get(name, 0) + 1
    return out


def parse(page: str) -> Box:
    """The tree of a page's containers; everything in a flow is ("t", text) or ("b", tag)."""
    none: frozenset[int] | set[int] = frozenset()
    for _ in range(3):  # for the page, its main element, its article
        root, lost, found = _tree(page, none)
        names = lost & {"html", "body"} or lost & {"main"} or (lost if not found else set())
        free = _holders(page, names) - none if names else set()
        if not free:
            return root
        none = none | free
    return _tree(page, none)[0]


def _tree(page: str, none: frozenset[int] | set[int]) -> tuple[Box, set[str], bool]:
    """(the tree, which of html, body, main and article are inside boilerplate, whether an article is outside).

    Elements that begin at ``none`` are no boilerplate.
    """
    lost, found, seen = set(), False, set()
    root = Box("", "")
    stack = [root]

    def flow() -> list:
        if stack[-1].role == "drop":
            return []  # nothing of it is kept
        items = stack[-1].items
        if not items or isinstance(items[-1], Box):
            items.append([])
        return items[-1]
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            flow().append(("t", page[at:m.start()]))
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue  # a comment, declaration, script or the like
        top = stack[-1]
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                box = stack[k]
                if box.nested.get(name):
                    box.nested[name] -= 1
                    del stack[k + 1:]
                elif k and box.name == name:
                    del stack[k:]
                    break
                elif k:
                    continue
                flow().append(("b", name))
                break
            continue
        if name in _BREAKS and top.name == "p":
            stack.pop()  # a block ends an open paragraph
        elif top.role == "drop":
            if name == top.name and not m[4].endswith("/"):
                top.nested[name] = top.nested.get(name, 0) + 1
            if name in _PAGE and name not in seen:
                lost.add(name)
            continue
        key, role = _label(name, m[4]) if m[4] else (name, "drop" if name in _DROPPED else "article" if name in _ARTICLE else "")
        if role == "drop" and m.start() in none:
            role = ""
        found = found or role == "article"
        if name in ("html", "body"):
            seen.add(name)
        if name not in _VOID and (name in _BOXES or role) and not m[4].endswith("/"):
            if len(stack) > MAX_DEPTH and role != "drop" and (role == "" or any(b.role == "article" for b in stack)):
                flow().append(("b", name))
                stack[-1].nested[name] = stack[-1].nested.get(name, 0) + 1
                continue
            box = Box(key, role)
            stack[-1].items.append(box)
            stack.append(box)
        elif name not in _VOID or name in _BREAKS:
            flow().append(("b", name))
    if at < len(page):
        flow().append(("t", page[at:]))
    return root, lost, found


# A wrapper node is {"k": key, "r": role, "c": children} or, for a flow, {"k": "", "tags": [...], "text": hash or None};
# both have "o" (optional), "m" (repeated) and "a" (every page has it; a flow: with this very text).

def _node(item) -> dict:
    if isinstance(item, Box):
        return {"k": item.key, "r": item.role, "o": 0, "m": 0, "a": 1, "c": _coarse(_folded([_node(i) for i in item.items]))}
    return {"k": "", "tags": sorted({x for kind, x in item if kind == "b"}), "text": _hash(item), "o": 0, "m": 0, "a": 1}


def _hash(flow: list) -> str:
    return xxhash.xxh64_hexdigest(" ".join("".join(x for kind, x in flow if kind == "t").split()))


def _partly(node: dict) -> dict:
    """A node that some pages lack, with all below it."""
    return node | {"a": 0} | ({"c": [_partly(n) for n in node["c"]]} if node["k"] else {})


def _folded(nodes: list[dict]) -> list[dict]:
    """An element like one of the last three before it folds onto that one: what lies between them is
    then a repeated sequence of optional elements. Long sequences fold onto any earlier element."""
    out: list[dict] = []
    for node in nodes:
        reach = len(out) if len(out) > MAX_NODES else min(3, len(out))
        back = next((k for k in range(1, reach + 1) if out[-k]["k"] == node["k"]), 0)
        if not back:
            out.append(node)
            continue
        out[-back] = _merged(out[-back], node, True) | {"m": 1}
        for k in range(back - 1, 0, -1):
            out[-k] = out[-k] | {"o": 1, "m": 1}
    return out


def _coarse(nodes: list[dict]) -> list[dict]:
    """A sequence with too many different keys, told apart by tag names alone."""
    if len(nodes) <= MAX_NODES:
        return nodes
    plain = [n if not n["k"] or n["r"] else n | {"k": n["k"].partition(".")[0]} for n in nodes]
    out: dict = {}
    for n in plain:
        out[n["k"]] = (_merged(out[n["k"]], n, True) if n["k"] in out else n) | {"o": 1, "m": 1}
    return list(out.values())


def _merged(a: dict, b: dict, same: bool) -> dict:
    """The expression of two aligned nodes of one key, from the ``same`` pages or from others."""
    out = {"k": a["k"], "o": a["o"] | b["o"], "m": a["m"] | b["m"], "a": a["a"] | b["a"] if same else a["a"] & b["a"]}
    if a["k"] == "":
        text = a["text"] if a["text"] == b["text"] else None
        return out | {"tags": sorted({*a["tags"], *b["tags"]}), "text": text, "a": out["a"] if text else 0}
    if same and a["a"] != b["a"]:
        a, b = (x if x["a"] else _partly(x) for x in (a, b))
    return out | {"r": a["r"], "c": aligned(a["c"], b["c"], same)}


def aligned(a: list[dict], b: list[dict], same: bool = False) -> list[dict]:
    """Aligns two sequences on their longest common subsequence of keys; what one lacks is optional,
    and other pages than those of the ``same`` ones lack it."""
    lacked = {"o": 1} if same else {"o": 1, "a": 0}
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["k"] == b[j]["k"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i]["k"] == b[j]["k"]:
            out.append(_merged(a[i], b[j], same))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(a[i] | lacked)
            i += 1
        else:
            out.append(b[j] | lacked)
            j += 1
    return _coarse(_folded(out))


class Wrapper:
    """A host's expression and the number of its pages."""

    def __init__(self, nodes: list[dict], pages: int):
        self.nodes, self.pages = nodes, pages

    def add(self, nodes: list[dict], pages: int) -> None:
        self.nodes, self.pages = aligned(self.nodes, nodes), self.pages + pages


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", (url or "").lower())
    return m[1] if m else ""


def _learned(batches):
    hosts: dict[str, Wrapper] = {}
    for batch in batches:
        for part in slices(batch, "html"):
            for url, raw in zip(part.column(0).to_pylist(), text_bytes(part, "html")):
                nodes = _coarse(_folded([_node(i) for i in parse(raw.decode("utf-8", "replace")).items]))
                host = _host(url)
                if host in hosts:
                    hosts[host].add(nodes, 1)
                else:
                    hosts[host] = Wrapper(nodes, 1)
    if hosts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(hosts)), pa.array([json.dumps(w.nodes) for w in hosts.values()]),
             pa.array([w.pages for w in hosts.values()], pa.int64())], ["host", "wrapper", "n_pages"])


def _united(group: pd.DataFrame) -> pd.DataFrame:
    own = group.sort_values("wrapper")
    out = Wrapper(json.loads(own["wrapper"].iloc[0]), int(own["n_pages"].iloc[0]))
    for nodes, pages in zip(own["wrapper"].iloc[1:], own["n_pages"].iloc[1:]):
        out.add(json.loads(nodes), int(pages))
    return pd.DataFrame({"host": own["host"].iloc[:1], "wrapper": [json.dumps(out.nodes)], "n_pages": [out.pages]})


def infer_wrappers(pages: DataFrame, spread: int = 32) -> DataFrame:
    """host, wrapper (JSON), n_pages of ``pages(url, html)``."""
    schema = "host string, wrapper string, n_pages long"
    found = native(pages, "url", "html").mapInArrow(_learned, schema)
    alike = found.groupBy("host", "wrapper").agg(F.sum("n_pages").alias("n_pages"))
    some = (alike.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(spread)))
            .groupBy("host", "part").applyInPandas(lambda g: _united(g), schema))
    return some.groupBy("host").applyInPandas(lambda g: _united(g), schema)


def _kept(box_items: list, nodes: list[dict], inside: bool, shared: bool, out: dict) -> None:
    """Aligns the items of a page with wrapper nodes; collects flows of the article and other slots.

    ``shared``: the host has pages enough, and each has all that the nodes lie in.
    """
    at = 0
    for item in box_items:
        key = item.key if isinstance(item, Box) else ""
        # elements that the page lacks are optional, a repeated one may follow itself: the next node of this key,
        # else (a repeated sequence starts anew) the first
        order = (*range(at, len(nodes)), *range(at))
        found = next((k for k in order if nodes[k]["k"] == key), None)
        if found is None and "." in key:  # a coarsened wrapper has the tag name alone
            found = next((k for k in order if nodes[k]["k"] == item.name), None)
        node = nodes[found] if found is not None else None
        at = found if found is not None else at
        if isinstance(item, Box):
            if item.role == "drop":
                continue
            out["breaks"](item.name)
            _kept(item.items, node["c"] if node else [], inside or item.role == "article", shared and bool(node and node["a"]), out)
            out["breaks"](item.name)
        elif inside:
            out["article"](item)
        else:
            out["rest"](item, bool(node and shared and node["a"] and node["text"] == _hash(item)))


def _text(flows: list) -> str:
    """Blocks of white-space-normalised text, one to a line; ("b", tag) of a block tag ends a block."""
    blocks, now = [], []
    for kind, x in [*flows, ("b", "p")]:
        if kind == "t":
            now.append(x)
        elif x in _BREAKS:
            if now and (block := " ".join(html.unescape("".join(now)).split())):
                blocks.append(block)
            now = []
    return "\n".join(blocks)


def main_text(page: str, nodes: list[dict], pages: int) -> str:
    """The main text of one page under its host's wrapper."""
    article, rest, every = [], [], []

    def breaks(name):
        tag = ("b", name)
        for flows in (article, rest, every):
            flows.append(tag)

    def other(flow, fixed):
        every.extend(flow)
        if not fixed:
            rest.extend(flow)
    _kept(parse(page).items, nodes, False, pages >= SHARED_PAGES,
          {"breaks": breaks, "article": article.extend, "rest": other})
    return _text(article) or _text(rest) or _text(every)


def _extractor(batches):
    held: dict[str, list] = {}
    for batch in batches:
        for part in slices(batch, "html"):
            texts = []
            for raw, wrapper, pages in zip(text_bytes(part, "html"), part.column(3).to_pylist(), part.column(4).to_pylist()):
                if wrapper not in held:
                    if len(held) > 2000:
                        held.clear()
                    held[wrapper] = json.loads(wrapper) if wrapper else []
                texts.append(main_text(raw.decode("utf-8", "replace"), held[wrapper], pages or 0))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages(page_id, url, html)``."""
    rows = native(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    wrappers = cut_lineage(infer_wrappers(rows))
    host = F.coalesce(F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))),
                                       r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1), F.lit(""))
    # broadcast while the wrappers' bytes are few; beyond that hosts with many pages are salted
    joined = salted_lookup(rows.withColumn("host", host), wrappers, "host", ["page_id"], freq_col="n_pages")
    return joined.select("page_id", "url", "html", "wrapper", "n_pages").mapInArrow(
        _extractor, "page_id long, url string, text string, n_chars long")
