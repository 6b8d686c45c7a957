"""HTML extraction by wrappers: union-free regular expressions inferred per host.

Every page is a stream of tags and texts. Streams of one host are aligned one after the other: where
they agree a token stays, where one has a token that the other lacks it becomes optional, where a
token or a sequence of tokens recurs it becomes a repeated group, and where texts differ they become a
slot. The result, an expression without alternatives per element, is the host's wrapper. A page is read
place by place: a line whose text is the same at one place on many pages of the host belongs to the
template and is left out; lines in slots stay.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import check_broadcast, checkpoint
from .common import bounded_batches, text_of
from .url_filter import host_of

SALTS = 64
# Bytes of all roots together that may be broadcast; beyond it pages and roots are joined.
BROADCAST_BYTES = 32 << 20
# A line is constant on this many differing pages of a host, if they are also this share of those with its place. Lines of
# lists and tables recur for other reasons, they are never constant.
CONSTANT_PAGES, CONSTANT_SHARE = 5, 0.9
ROWS = frozenset("li dt dd td th".split())
# Attributes, labels and places up to this length are remembered, as many as REMEMBERED of each; templates repeat them.
SHORT, REMEMBERED = 512, 1 << 12
# Pages with a larger share of constant text are near copies of each other; they stay whole.
COPY_SHARE = 0.9

# Elements nested deeper than this stand beside each other, in page order; real pages do not nest so deep.
MAX_DEPTH = 200
# Cells of an alignment; longer sequences are matched greedily, in one walk.
ALIGN_CELLS = 1 << 12

TAG_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
TAG_END = re.compile(r"""[>"']""")
# A whole tag whose quotes are closed; nothing is tried twice, so a tag that does not fit costs one walk.
PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
LISTS = frozenset("div section ul ol dl table header fieldset center".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An element that these tags open is closed before them, up to the nearest of the containers.
CLOSES = {t: (("p",), frozenset("article aside blockquote body div section main td th li dd form header footer nav".split())) for t in BLOCK}
CLOSES |= {
    "li": (("li",), frozenset(["ul", "ol"])), "dt": (("dt", "dd"), frozenset(["dl"])), "dd": (("dt", "dd"), frozenset(["dl"])),
    "tr": (("tr",), frozenset(["table"])), "td": (("td", "th"), frozenset(["tr", "table"])), "th": (("th",), frozenset(["tr", "table"])),
    "option": (("option",), frozenset(["select"])),
}
WATCHED = frozenset(t for targets, stop in CLOSES.values() for t in (*targets, *stop))
RAW_END = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in RAW}
# Elements that say themselves that they are no main text.
ASIDE = frozenset("nav footer aside dialog menu".split())
# Elements whose text no reader sees as part of the page.
UNREAD = frozenset("head script style title template noscript iframe object svg canvas button select textarea input".split())
# A class or id hints at boilerplate if it consists of these words, one of CLEAR at least; others only with many links.
CLEAR = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies disqus footer menu nav navbar "
    "navigation newsletter pagination popup sidebar sponsor sponsored subscribe toolbar complementary contentinfo".split()
)
HINTS = CLEAR | frozenset("banner comment comments header notice notices promo related respond share sharing social widget widgets".split())
# Readers' comments and promotions, by the whole name of a class or id; they go inside of articles too.
THREADS = frozenset("comments commentlist comment-list comments-area comments-section respond disqus_thread replies promo promos promotion".split())
SKIP_ROLES = frozenset(["banner", "navigation", "complementary", "contentinfo", "search", "form", "dialog", "alert"])


class Element:
    __slots__ = ("label", "tag", "items", "hint")

    def __init__(self, label: str, tag: str, hint: str):
        self.label, self.tag, self.hint, self.items = label, tag, hint, []


def _opened(tag: str, attributes: str) -> Element:
    read = _named_before if len(attributes) <= SHORT else _named
    label, hint = read(tag, attributes)
    return Element(label, tag, hint)


def _named(tag: str, attributes: str) -> tuple[str, str]:
    """``(label, hint)``: ``label`` is the tag with its class, id and role, without digits, which number things.

    ``hint`` is what speaks for boilerplate: the tag or role ("tag"), the name of readers' comments or promotions ("thread"),
    a clear name ("name"), a vague name ("word"), or nothing.
    """
    label, hint = tag, "tag" if tag in ("form", "header") else ""
    if attributes and "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if tag in ("html", "body", "article", "main"):
                pass
            elif m[1].lower() == "role":
                hint = "tag" if value in SKIP_ROLES else hint
            elif hint not in ("tag", "thread"):
                for name in value.split():
                    if name in THREADS:
                        hint = "thread"
                        break
                    words = {w for w in re.split(r"[^a-z]+", name) if w}
                    if words and words <= HINTS and not words.isdisjoint(CLEAR):
                        hint = "name"
                    elif not hint and not words.isdisjoint(HINTS):
                        hint = "word"
            label += f"[{m[1].lower()}={re.sub('[0-9]+', '', value)}]"
    return label, hint


_named_before = lru_cache(REMEMBERED)(_named)


def _tags(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``(start, end, slash, name, attributes)`` of all markup in page order; comments and the like have no name.

    One walk over the page, whatever is left open in it: a ``<`` that nothing closes is text, a comment that nothing
    closes goes on to the end, and after a quote that nothing closes tags end at the next ``>``.
    """
    at, end, closed = 0, len(source), {q: source.rfind(q) for q in "\"'"}
    last, loose = source.rfind(">"), -1
    while True:
        start = source.find("<", at)
        if start < 0:
            return
        if source.startswith("<!--", start):
            stop = source.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            yield start, at, "", "", ""
            continue
        if start > last:
            return
        plain = PLAIN_TAG.match(source, start) if start >= loose else None
        if plain is not None:
            at = plain.end()
            yield start, at, plain[1], plain[2].lower(), plain[3]
            continue
        name = TAG_NAME.match(source, start + 1)
        if name is None:
            if source[start + 1 : start + 2] in ("!", "?", "/"):
                at = source.find(">", start) + 1
                yield start, at, "", "", ""
            else:
                at = start + 1
            continue
        stop = name.end()
        while True:
            if start < loose:
                stop = source.find(">", stop)
                break
            m = TAG_END.search(source, stop)
            if m is None:
                stop = -1
                break
            stop = m.start()
            if m[0] == ">":
                break
            if stop >= closed[m[0]]:  # the last quote of its kind is open
                loose, stop = stop, name.end()
                continue
            stop = source.find(m[0], stop + 1) + 1
        if stop < 0:
            return  # no tag can end any more
        at = stop + 1
        yield start, at, name[1], name[2].lower(), source[name.end() : stop]


class _Open:
    """The open elements of a page, the innermost last, with what is needed to close them without searching all."""

    def __init__(self, root: Element):
        self.stack, self.count, self.watched = [root], {}, []
        self.unread = 0  # open elements below MAX_DEPTH whose text nobody reads

    def put(self, item: str | Element) -> None:
        top = self.stack[-1]
        if len(self.stack) <= MAX_DEPTH:
            top.items.append(item)
            return
        if isinstance(item, str):
            hidden = next((e for e in self.stack[MAX_DEPTH:] if e.tag in UNREAD or e.tag in ASIDE), top) if self.unread else top
            holder = Element(hidden.label, hidden.tag, hidden.hint)
            holder.items.append(item)
            item = holder
        self.stack[MAX_DEPTH - 1].items.append(item)

    def push(self, e: Element) -> None:
        if e.tag in WATCHED:
            self.watched.append(len(self.stack))
        self.count[e.tag] = self.count.get(e.tag, 0) + 1
        self.stack.append(e)
        if len(self.stack) > MAX_DEPTH:
            self.unread += e.tag in UNREAD or e.tag in ASIDE

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            e = self.stack.pop()
            self.count[e.tag] -= 1
            if len(self.stack) >= MAX_DEPTH:
                self.unread -= e.tag in UNREAD or e.tag in ASIDE
        while self.watched and self.watched[-1] >= k:
            self.watched.pop()

    def end(self, tag: str) -> None:
        if self.count.get(tag):
            k = len(self.stack) - 1
            while self.stack[k].tag != tag:
                k -= 1
            self.cut(k)

    def implied(self, tag: str) -> None:
        """Close what ``tag`` closes by opening: the nearest such element above the nearest container."""
        targets, stop = CLOSES[tag]
        for t in targets:
            if self.count.get(t):
                break
        else:
            return
        for k in reversed(self.watched):
            if self.stack[k].tag in targets:
                self.cut(k)
                return
            if self.stack[k].tag in stop:
                return


def parse(source: str) -> Element:
    """The page as nested elements and texts; end tags that are left out are implied."""
    root = Element("", "", "")
    open_, at = _Open(root), 0
    for start, end, slash, tag, attributes in _tags(source):
        if start < at:  # inside of a script or the like
            continue
        if start > at:
            open_.put(source[at:start])
        at = end
        if not tag:
            continue
        if slash:
            open_.end(tag)
            continue
        if tag in CLOSES:
            open_.implied(tag)
        element = _opened(tag, attributes)
        open_.put(element)
        if tag in RAW:
            closing = RAW_END[tag].search(source, at)
            at = closing.end() if closing else len(source)
        elif tag not in VOID and not attributes.endswith("/"):
            open_.push(element)
    if at < len(source):
        open_.put(source[at:])
    return root


# --- wrappers -----------------------------------------------------------------------------------
# {"m": [[token, mark], ...], "c": {label: wrapper}, "t": text or "*", "n": pages, "x": characters, "l": in links, "a": links}
# The mark of a token is "", "?" (optional), "+" (repeated) or "*" (both).


def _both(a: str, b: str) -> str:
    optional, repeated = {a, b} & {"?", "*"}, {a, b} & {"+", "*"}
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def _folded(tokens: list[list[str]]) -> list[list[str]]:
    """Adjacent equal tokens, then adjacent equal sequences, become one repeated token or group."""
    if len(tokens) < 2 or len({t for t, _ in tokens}) == len(tokens):
        return tokens
    for width in range(1, max(2, len(tokens) // 2 + 1)):
        out: list[list[str]] = []
        for token in tokens:
            out.append(token)
            while len(out) >= 2 * width and out[-1][0] == out[-1 - width][0] and [t for t, _ in out[-width:]] == [t for t, _ in out[-2 * width : -width]]:
                marks = [_both(a, b) for (_, a), (_, b) in zip(out[-2 * width : -width], out[-width:])]
                group = [[t, k] for (t, _), k in zip(out[-width:], marks)]
                del out[-2 * width :]
                if width == 1:
                    out.append([group[0][0], "*" if group[0][1] in ("?", "*") else "+"])
                else:
                    out.append(["(" + " ".join(t + k for t, k in group) + ")", "+"])
                    break
        tokens = out
        if width >= 8:
            break
    return tokens


def _aligned(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    """Two sequences as one: what only one of them has is optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    if n * m > ALIGN_CELLS:
        return _folded(_greedy(a, b))
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append([a[i][0], _both(a[i][1], b[j][1])])
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _both(a[i][1], "?")])
            i += 1
        else:
            out.append([b[j][0], _both(b[j][1], "?")])
            j += 1
    return _folded(out)


def _greedy(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    """An alignment in one walk: each token of ``a`` meets the next equal one of ``b`` that is not far ahead."""
    places: dict[str, list[int]] = {}
    for j, (token, _) in enumerate(b):
        places.setdefault(token, []).append(j)
    out, j, reach = [], 0, 64
    for token, mark in a:
        at = places.get(token, [])
        k = bisect.bisect_left(at, j)
        if k < len(at) and at[k] < j + reach:
            out += [[t, _both(x, "?")] for t, x in b[j : at[k]]]
            out.append([token, _both(mark, b[at[k]][1])])
            j = at[k] + 1
        else:
            out.append([token, _both(mark, "?")])
    return out + [[t, _both(x, "?")] for t, x in b[j:]]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_hash_before = lru_cache(REMEMBERED)(_hash)


def _place(path: str) -> int:
    """The hash of a place; pages of a template share their places."""
    return _hash_before(path) if len(path) <= SHORT else _hash(path)


def infer(element: Element, in_link: bool = False) -> dict:
    """The wrapper of one page: its own repeated groups, all texts as they are."""
    children: dict[str, dict] = {}
    tokens: list[list[str]] = []
    text = []
    for item in element.items:
        if isinstance(item, str):
            if item and not item.isspace():
                text.append(item)
                tokens.append(["#", ""])
            continue
        one = infer(item, in_link or item.tag == "a")
        known = children.get(item.label)
        children[item.label] = merge(known, one, 1) if known else one
        tokens.append([item.label, ""])
    own = sum(map(len, text))
    return {
        "m": _folded(tokens), "c": children, "t": _hash(" ".join("".join(text).split())) if text else None,
        "n": 1, "x": 0 if in_link else own, "l": own if in_link else 0, "a": int(element.tag == "a"),
    }


def merge(a: dict, b: dict, pages: int | None = None) -> dict:
    """Two wrappers as one. Counts add up; texts that differ become a slot."""
    children = dict(a["c"])
    for label, w in b["c"].items():
        children[label] = merge(children[label], w, pages) if label in children else w
    return {
        "m": _aligned(a["m"], b["m"]), "c": children, "t": a["t"] if a["t"] == b["t"] else "*",
        "n": pages or a["n"] + b["n"], "x": a["x"] + b["x"], "l": a["l"] + b["l"], "a": a["a"] + b["a"],
    }


def expression(wrapper: dict, label: str = "") -> str:
    """The wrapper as a regular expression over tags; ``#`` is a text slot."""
    inner = []
    for token, mark in wrapper["m"]:
        if token == "#":
            body = "#" if wrapper["t"] == "*" else "#const"
        elif token.startswith("("):
            body = token
        else:
            body = expression(wrapper["c"][token], token)
        inner.append(body + mark)
    return f"<{label}>" + " ".join(inner) + "</>" if label else " ".join(inner)


# --- boilerplate of a page ------------------------------------------------------------------------


class Masses:
    """Characters outside of links and of UNREAD and ASIDE elements, and whether an article or main is inside, per element."""

    def __init__(self, page: Element):
        self.text: dict[int, int] = {}
        self.main: set[int] = set()
        self._add(page)

    def _add(self, e: Element) -> int:
        n = 0
        for c in e.items:
            if isinstance(c, str):
                n += 0 if c.isspace() else len(c)
                continue
            below = self._add(c)
            n += 0 if c.tag in UNREAD or c.tag in ASIDE or c.tag == "a" else below
            if c.tag in ("article", "main") or id(c) in self.main:
                self.main.add(id(e))
        self.text[id(e)] = n
        return n


def linked(wrapper: dict, path: str = "") -> list[int]:
    """Hashes of the places on a host that hold mostly links, three a page at least."""
    out = []
    for label, w in wrapper["c"].items():
        tag = label.partition("[")[0]
        below = f"{path}/{label}" if tag in BLOCK else path
        if tag in LISTS and _sum(w, "l") > _sum(w, "x") and _sum(w, "a") >= 3 * w["n"]:
            out.append(_place(below))
        out += linked(w, below)
    return out


def _sum(w: dict, field: str) -> int:
    return w[field] + sum(_sum(c, field) for c in w["c"].values())


def boilerplate(page: Element, masses: Masses, root: Element, inside: bool, links: frozenset[int]):
    """A function of an element below ``root`` and its place that says whether the element is left out.

    Elements that hold an article, main, or half of the root's text stay, but for those of UNREAD and ASIDE. Inside of an
    article names count only together with many links.
    """
    most = masses.text[id(root)] / 2

    def out(e: Element, place: str) -> bool:
        if e.tag in UNREAD:
            return True
        if id(e) in masses.main:
            return False
        if e.tag in ASIDE or (inside and e.hint == "thread"):
            return True
        if 0 < most <= masses.text[id(e)]:
            return False
        if e.tag == "header" and inside:
            return False
        many = e.tag in LISTS and _place(place) in links
        return e.hint in ("tag", "thread") or (e.hint == "name" and not inside) or (many and (not inside or e.hint != ""))

    return out


def mains(page: Element, masses: Masses) -> list[Element]:
    """The outermost articles and mains but for those in boilerplate that holds less than half of the page's text."""
    found: list[Element] = []
    most = masses.text[id(page)] / 2

    def seek(e: Element) -> None:
        for c in e.items:
            if isinstance(c, str) or c.tag in UNREAD or c.tag in ASIDE:
                continue
            if c.tag in ("article", "main"):
                found.append(c)
            elif id(c) in masses.main and (c.hint in ("", "word") or masses.text[id(c)] >= most):
                seek(c)

    seek(page)
    return found


# --- reading a page -------------------------------------------------------------------------------


def _blocks(element: Element, out: list[tuple[str, list[str]]], path: str, skipped, chosen: set[int], active: bool) -> None:
    """Texts of the chosen elements by block, with the labels that lead to the block."""
    for item in element.items:
        if isinstance(item, str):
            if active:
                out[-1][1].append(item)
            continue
        taken = active or id(item) in chosen
        below = f"{path}/{item.label}" if item.tag in BLOCK else path
        if item.tag == "br" or (active and skipped(item, below)):
            out[-1][1].append(" ")
        elif item.tag in BLOCK:
            out.append((below, []))
            _blocks(item, out, below, skipped, chosen, taken)
            out.append((path, []))
        else:
            _blocks(item, out, path, skipped, chosen, taken)


def _lines(page: Element, skipped, chosen: list[Element]) -> list[tuple[str, str]]:
    """``(place, text)`` of each line of the chosen elements, in page order."""
    blocks: list[tuple[str, list[str]]] = [("", [])]
    ids = {id(e) for e in chosen}
    _blocks(page, blocks, "", skipped, ids, id(page) in ids)
    lines = ((path, " ".join(entities.unescape("".join(b)).split())) for path, b in blocks if b)
    return [(path, x) for path, x in lines if x]


def line_keys(page: Element) -> set[tuple[int, int]]:
    """``(place, place and text)`` as hashes for every line of a page; the place alone comes with itself."""
    out = set()
    for path, text in _lines(page, lambda e, _: e.tag in UNREAD, [page]):
        if path.rpartition("/")[2].partition("[")[0] in ROWS:
            continue
        place = _place(path)
        out |= {(place, place), (place, _hash(f"{path}\n{text}"))}
    return out


def extract_one(source: str, constant: frozenset[int] = frozenset(), links: frozenset[int] | None = None) -> str:
    """The main text of one page: its articles and mains, else the whole page, without constant lines and other boilerplate.

    Without ``links``, the places of links on its host, those of the page itself are taken.
    """
    page = parse(source)
    masses = Masses(page)
    links = frozenset(linked(infer(page))) if links is None else links
    lines = []
    for root in (chosen := mains(page, masses)) or [page]:
        lines += _lines(page, boilerplate(page, masses, root, bool(chosen), links), [root])
    kept = [x for path, x in lines if _hash(f"{path}\n{x}") not in constant] if constant else [x for _, x in lines]
    if sum(map(len, kept)) < (1 - COPY_SHARE) * sum(len(x) for _, x in lines):
        kept = [x for _, x in lines]
    return "\n".join(kept)


# --- on Spark -------------------------------------------------------------------------------------


def _fold(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Merge the wrappers of rows that come sorted by key, one at a time; one wrapper is held."""
    last, held = None, None
    for rows in batches:
        done = []
        for key, w in zip(zip(*[rows[k] for k in keys]), rows["wrapper"]):
            if key == last:
                held = merge(held, json.loads(w))
            else:
                if held is not None:
                    done.append((*last, json.dumps(held)))
                last, held = key, json.loads(w)
        yield pd.DataFrame(done, columns=[*keys, "wrapper"])
    if held is not None:
        yield pd.DataFrame([(*last, json.dumps(held))], columns=[*keys, "wrapper"])


def _page_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One wrapper per host and batch."""
    for rows in batches:
        mine: dict[str, dict] = {}
        for host, source in zip(rows["host"], rows["html"]):
            w = infer(parse(source))
            mine[host] = merge(mine[host], w) if host in mine else w
        salt = hash(tuple(rows["page"].head(1))) % SALTS if len(rows) else 0
        yield pd.DataFrame({"host": list(mine), "salt": salt, "wrapper": [json.dumps(w) for w in mine.values()]})


def wrappers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, wrapper)``: the wrapper of each host, from all its pages.

    A task merges its own pages first; those partial wrappers, whose size follows the templates and not
    the pages, are merged per host and salt, and then per host, in streams that hold one at a time.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("page"), host_of(F.col(url_col)).alias("host"), text_of(html_col).alias("html")
    )
    partial = rows.mapInPandas(_page_wrappers, "host string, salt int, wrapper string")
    by_salt = partial.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
    merged = by_salt.mapInPandas(lambda it: _fold(it, ["host", "salt"]), "host string, salt int, wrapper string")
    by_host = merged.select("host", "wrapper").repartition("host").sortWithinPartitions("host", "wrapper")
    return by_host.mapInPandas(lambda it: _fold(it, ["host"]), "host string, wrapper string")


def _line_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = [(h, *k, _hash(source)) for h, source in zip(rows["host"], rows["html"]) for k in line_keys(parse(source))]
        yield pd.DataFrame(out, columns=["host", "place", "line", "page"])


def constants(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, lines)``: hashes of the lines that are constant on the host, counted over all its differing pages.

    Rows of three hashes and a host are counted, no text is moved; exact copies of a page count once.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(host_of(F.col(url_col)).alias("host"), text_of(html_col).alias("html"))
    seen = rows.mapInPandas(_line_rows, "host string, place long, line long, page long").distinct()
    often = checkpoint(seen.groupBy("host", "place", "line").count().where(F.col("count") >= CONSTANT_PAGES))
    places = often.where("place = line").select("host", "place", F.col("count").alias("n"))
    lines = often.where("place != line").join(places, ["host", "place"]).where(F.col("count") >= CONSTANT_SHARE * F.col("n"))
    return lines.groupBy("host").agg(F.collect_set("line").alias("lines"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` per page: blocks of the main text, one per line, without lines constant on the host.

    Null html is empty html, whose text is empty; so is the text of pages without any outside of menus
    and the like. Time grows with a page's length, however long, deeply nested or unclosed its markup is: elements deeper than
    MAX_DEPTH stand beside each other. Pages without a url, or without a host in it, form one host. Rows that repeat an id or a
    page are each returned. An empty table gives no rows. Other columns are not read.
    """

    @F.udf("array<bigint>")
    def places(wrapper):
        return sorted(set(linked(json.loads(wrapper))))

    hosts = wrappers(pages, id_col, url_col, html_col).join(constants(pages, url_col, html_col), "host", "left")
    known = F.coalesce("lines", F.array().cast("array<bigint>")).alias("_lines")
    found = checkpoint(hosts.select(F.col("host").alias("_host"), places("wrapper").alias("_links"), known))
    size = found.agg(F.sum(F.octet_length("_host") + 8 * F.size("_links") + 8 * F.size("_lines")).alias("n")).first()["n"] or 0
    if size <= BROADCAST_BYTES:
        check_broadcast(size // 8, "boilerplate of hosts")
        found = F.broadcast(found)

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, lines, links in batches:
            yield pd.Series([extract_one(s, frozenset(map(int, c)), frozenset(map(int, k))) for s, c, k in zip(sources, lines, links)], dtype="object")

    rows = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host_of(F.col(url_col)).alias("_h"), text_of(html_col).alias("_html")
    )
    joined = rows.join(found, F.col("_h") == F.col("_host"))
    read_ = joined.select("_id", "_url", text("_html", "_lines", "_links").alias("text"))
    return read_.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
