"""Main-text extraction by union-free regular-expression inference over pages of one host.

A page becomes a well-nested stream of block-level tags (with class words) and text slots; implied end tags are
added, inline tags belong to their text, comments, scripts and styles are left out. Streams of one host are aligned
into a wrapper, level by level. Two levels with the same tags are merged place by place. Where they differ, neighbours of
one tag and structure (and runs of up to four that recur) become one repeated group, matches of a longest common
subsequence are merged further inside, and what only one side has becomes optional. The result is an expression of
tags, text slots, (...)+ and (...)? without unions.

A slot records what the alignment proves: whether it ever held different texts, and whether pages that differ somewhere
held the same one. Each task aligns the pages that it reads into one partial wrapper for each host; partial wrappers
(small, however many pages a host has) are merged in two rounds, so a hot host's pages never meet, nor its partial
wrappers in one task. Then every page is aligned with its host's wrapper once more, and each of its blocks has the slot
that it fell into:

- fixed (one text on different pages): the host's template, left out;
- varying: the page's own, kept;
- unknown (the host has one page, or only copies of one): kept, unless the page has an article or main part elsewhere.

Tags and classes decide what alignment can't. Menus, headers, footers, sidebars, adverts, forms and comments vary from
page to page too: the tags and roles for these leave a block out, and so does a slot that is mostly links. Class
and id names (by their first or last word) do so as well, but not for a block that has a content class or holds the
page's article, main part or first heading, and they never empty a page that has neither article nor main part. Inside an
article or main part a fixed text is kept: it may be an article's that was published twice.

A null html is empty; an empty page, or one without such slots, gives an empty text. Pages with a null or odd url
share the host ''. Rows that repeat an id are separate pages. Nesting may have any depth. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import html as entities
import json
import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import durable, pieces

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "html head body article aside nav header footer main section div address blockquote center dd details dialog dir dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 hgroup legend li menu ol p pre search summary table caption thead tbody tfoot tr td th ul button select option label".split()
)
#: What an opening tag ends, and where the search for it stops.
ENDS = {x: ({"p"}, BLOCK - {"p"}) for x in BLOCK - {"html", "head", "body", "option", "button", "label"}} | {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
LEFT_OUT = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "search", "head", "label"}
LEFT_OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
LEFT_OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu sidebar side footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription share sharing social related recommended comment comments respond reply replies disqus widget pagination pager login signup search toolbar legal copyright disclaimer".split()
)
CONTENT_WORDS = {"article", "post", "entry", "content", "story", "articlebody", "text"}
#: Marks that hold even around an article, main part or first heading.
FIRM_WORDS = set("nav navbar navigation menu footer header masthead comment comments respond reply replies disqus".split())
#: Marks that hold on an article itself: teasers and comments are articles too.
ARTICLE_WORDS = {"comment", "comments", "reply", "ad", "related"}
DIGITS = re.compile(r"\d+")
SPACE = re.compile(r"\s+")
#: The share of links that makes a menu.
LINKED = 0.5
#: Tasks that merge partial wrappers of one host, before one merges theirs.
SPREAD = 32


def deep() -> None:
    """Pages may nest as deep as memory allows: calls between Python functions need no C stack."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1 << 24))


class Element:
    __slots__ = ("key", "kids", "tag")

    def __init__(self, tag: str, key: str):
        self.tag, self.key, self.kids = tag, key, []


def key_of(tag: str, attributes: str) -> str:
    """Tag with its roles and its class and id names (digits, which number pages, aside)."""
    names = set()
    for name, value in ATTRIBUTE.findall(attributes):
        found = DIGITS.sub("", value.strip("\"'").lower().replace(".", "-")).split()
        names |= {f"role:{x}" for x in found} if name.lower() == "role" else {x for y in found if (x := y.strip("-_"))}
    return ".".join([tag, *sorted(names)])


def parse(source: str) -> Element:
    """Well-nested blocks of a page. A text kid is (text, characters in links)."""
    root = Element("#root", "#root")
    stack, run, linked, in_link, at = [root], [], 0, 0, 0
    open_ = Counter()

    def close(k: int) -> None:
        open_.subtract(e.tag for e in stack[k:])
        del stack[k:]

    def flush() -> None:
        nonlocal linked
        if run:
            text = SPACE.sub(" ", "".join(run)).strip()
            if text:
                stack[-1].kids.append((text, min(linked, len(text))))
            run.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = entities.unescape(text) if "&" in text else text
            run.append(text)
            if in_link:
                linked += len(text)

    find = TAG.search
    while m := find(source, at):
        add(source[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                flush()
                k = len(stack) - 1 if open_[tag] else 0
                while k and stack[k].tag != tag:
                    k -= 1
                if k:
                    close(k)
            elif tag == "a":
                in_link = 0
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at) if not m[3].endswith("/") else None
            at = end.end() if end else (at if m[3].endswith("/") else len(source))
        elif tag in VOID:
            if tag == "br":
                run.append(" ")
            elif tag == "hr":
                flush()
        elif tag in BLOCK:
            flush()
            ends, stop = ENDS.get(tag, ((), ()))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in stop:
                    break
            element = Element(tag, key_of(tag, m[3]) if "=" in m[3] else tag)
            stack[-1].kids.append(element)
            stack.append(element)
            open_[tag] += 1
        elif tag == "a":
            in_link = 1
    add(source[at:])
    flush()
    return root


# A wrapper item is [key, kids, optional, repeated, facts]. Facts of a text slot: [hash of its text (0: they differ), hash of
# its page (0: several that differ), characters, of these linked, the places of a page's own blocks in it].
TEXT = "#"


def texts_of(page: Element) -> list[str]:
    out, stack = [], [iter(page.kids)]
    while stack:
        for kid in stack[-1]:
            if isinstance(kid, tuple):
                out.append(kid[0])
            else:
                stack.append(iter(kid.kids))
                break
        else:
            stack.pop()
    return out


def items_of(page: Element) -> list:
    """A page as a wrapper."""
    texts = texts_of(page)
    name, place = xxhash.xxh64_intdigest("\n".join(texts)) >> 12 or 1, iter(range(len(texts)))

    def below(element: Element) -> list:
        out = []
        for kid in element.kids:
            if isinstance(kid, tuple):
                out.append([TEXT, [], 0, 0, [xxhash.xxh64_intdigest(kid[0]) >> 12 or 1, name, len(kid[0]), kid[1], (next(place),)]])
            else:
                out.append([kid.key, below(kid), 0, 0, None])
        return out

    return below(page)


def alike(a: list, b: list) -> bool:
    """Whether neighbours may be rounds of one group: one tag, and inside no tags that exclude the other's."""
    if a[0] != b[0]:
        return False
    x, y = {k[0] for k in a[1]}, {k[0] for k in b[1]}
    return x <= y or y <= x


def fold(items: list) -> list:
    """Neighbours that recur become one repeated item or group."""
    for period in (1, 2, 3, 4):
        out: list = []
        for item in items:
            out.append(item)
            if period == 1:
                if len(out) > 1 and alike(out[-2], item):
                    last = out.pop()
                    out[-1] = combined(out[-1], last)
                    out[-1][3] = 1
                continue
            tail = out[-period:]
            if len(tail) == period and len(out) > period:
                group = "|".join(x[0] for x in tail)
                if out[-period - 1][0] == f"({group})":
                    del out[-period:]
                    out[-1] = [out[-1][0], [combined(a, b) for a, b in zip(out[-1][1], tail, strict=True)], out[-1][2], 1, None]
                elif len(out) >= 2 * period and [x[0] for x in out[-2 * period : -period]] == [x[0] for x in tail]:
                    first = out[-2 * period : -period]
                    del out[-2 * period :]
                    out.append([f"({group})", [combined(a, b) for a, b in zip(first, tail, strict=True)], 0, 1, None])
        items = out
    return items


def combined(a: list, b: list) -> list:
    x, y = a[4], b[4]
    if x is not None:
        return [TEXT, [], a[2] | b[2], a[3] | b[3], [x[0] if x[0] == y[0] else 0, x[1] if x[1] == y[1] else 0, x[2] + y[2], x[3] + y[3], x[4] + y[4]]]
    return [a[0], align(a[1], b[1]), a[2] | b[2], a[3] | b[3], None]


def matched(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, by the longest chains of matches."""
    begin, end = 0, 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    places: dict[str, list[int]] = {}
    for j in range(len(b) - end - 1, begin - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(begin, len(a) - end):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, j, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k], chains[k] = j, link
    inner, at = [], chains[-1] if chains else None
    while at:
        inner.append(at[:2])
        at = at[2]
    return [(k, k) for k in range(begin)] + inner[::-1] + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def align(a: list, b: list) -> list:
    """Two levels as one."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [combined(x, y) for x, y in zip(a, b, strict=True)]
    a, b = fold(a), fold(b)
    out, i, j = [], 0, 0
    for k, m in [*matched([x[0] for x in a], [x[0] for x in b]), (len(a), len(b))]:
        out += [[*x[:2], 1, *x[3:]] for x in a[i:k]] + [[*x[:2], 1, *x[3:]] for x in b[j:m]]
        if k < len(a):
            out.append(combined(a[k], b[m]))
        i, j = k + 1, m + 1
    return fold(out)


def expression(items: list) -> str:
    """A wrapper as a union-free regular expression."""
    out = []
    for key, kids, optional, repeated, facts in fold(items):
        inner = "#text" if facts is not None else expression(kids) if key[0] == "(" else f"<{key}> {expression(kids)} </{key.split('.')[0]}>"
        mark = "+" * repeated + "?" * optional
        out.append(f"( {inner} ){mark}" if mark else inner)
    return " ".join(out)


def dumped(items: list) -> str:
    """A wrapper as JSON: rows of depth, key, optional, repeated, facts."""
    rows, stack = [], [iter(items)]
    while stack:
        for key, kids, optional, repeated, facts in stack[-1]:
            rows.append([len(stack), key, optional, repeated, facts and facts[:4]])
            if kids:
                stack.append(iter(kids))
                break
        else:
            stack.pop()
    return json.dumps(rows, separators=(",", ":"))


def loaded(wrapper: str) -> list:
    levels: list[list] = [[]]
    for depth, key, optional, repeated, facts in json.loads(wrapper):
        del levels[depth:]
        levels[-1].append([key, [], optional, repeated, facts and [*facts, ()]])
        levels.append(levels[-1][-1][1])
    return levels[0]


#: What a slot is.
LEFT, MARKED, TEMPLATE, UNKNOWN, OWN, ARTICLE = range(6)


def holds_main(kids: list) -> bool:
    """Whether an article, a main part or a first heading lies below."""
    stack = list(kids)
    while stack:
        key, below, *_ = stack.pop()
        if key.split(".", 1)[0] in ("article", "main", "h1"):
            return True
        stack += below
    return False


def kind_of(key: str, kids: list, outer: int) -> int:
    """What tags and classes make of a block's slots: LEFT, MARKED (by class only), ARTICLE, or UNKNOWN: alignment decides."""
    tag, *names = key.split(".")
    roles = {x[5:] for x in names if x.startswith("role:")}
    if outer == LEFT or tag in LEFT_OUT or roles & LEFT_OUT_ROLES or (tag == "header" and outer != ARTICLE):
        return LEFT
    article = tag in ("article", "main") or roles & {"article", "main"} or "articlebody" in names
    words = {w for x in names if not x.startswith("role:") for parts in (x.replace("_", "-").split("-"),) for w in (parts[0], parts[-1])}
    marks = set() if tag in ("html", "body", "main") else words & (ARTICLE_WORDS if tag == "article" else LEFT_OUT_WORDS)
    if outer == MARKED or marks and (marks & FIRM_WORDS and not CONTENT_WORDS & set(names) or tag == "article" or not (CONTENT_WORDS & set(names) or holds_main(kids))):
        return MARKED
    return ARTICLE if article else outer


def texts_in(items: list) -> dict[tuple[int, int], int]:
    """Of (path of blocks, text) of slots that hold one text: the page that has it there, or 0 for several that differ.

    Optional parts whose order the pages leave open may have two slots for one place; here these count together."""
    out: dict[tuple[int, int], int] = {}
    stack = [(x, 0) for x in items]
    while stack:
        (key, kids, _, _, facts), path = stack.pop()
        if facts is None:
            inner = path if key[0] == "(" else hash((path, key))
            stack += [(x, inner) for x in kids]
        elif facts[0]:
            name = path, facts[0]
            out[name] = facts[1] if out.get(name, facts[1]) == facts[1] else 0
    return out


def slots(items: list, known: dict[tuple[int, int], int]) -> Iterator[tuple[int, tuple[int, ...]]]:
    """What each slot of a wrapper is, and the places of the page's blocks in it. known: texts_in() of the wrapper."""
    stack = [(x, UNKNOWN, 0) for x in reversed(items)]
    while stack:
        (key, kids, _, _, facts), outer, path = stack.pop()
        if facts is None:
            inner, below = (outer, path) if key[0] == "(" else (kind_of(key, kids, outer), hash((path, key)))
            stack += [(x, inner, below) for x in reversed(kids)]
        elif facts[4]:
            text, page, size, linked, places = facts
            if outer == UNKNOWN:
                page = page and known.get((path, text), page)
                outer = LEFT if linked > LINKED * size else OWN if not text else UNKNOWN if page else TEMPLATE
            yield outer, places


def extract(page: Element, wrapper: list, known: dict[tuple[int, int], int] | None = None) -> list[str]:
    """The blocks of a page's main text, given its host's wrapper."""
    texts, kinds = texts_of(page), {}
    for kind, places in slots(align(wrapper, items_of(page)), texts_in(wrapper) if known is None else known):
        kinds |= dict.fromkeys(places, kind)
    found = set(kinds.values())
    wanted = {ARTICLE, OWN} if ARTICLE in found else {OWN, UNKNOWN}
    if not wanted & found and not has_article(page):
        wanted = {MARKED}
    return [t for k, t in enumerate(texts) if kinds[k] in wanted]


def has_article(page: Element) -> bool:
    stack = [page]
    while stack:
        element = stack.pop()
        if element.tag in ("article", "main"):
            return True
        stack += [k for k in element.kids if isinstance(k, Element)]
    return False


@functools.lru_cache(maxsize=512)
def wrapper_of(wrapper: str) -> tuple[list, dict[tuple[int, int], int]]:
    items = loaded(wrapper)
    return items, texts_in(items)


def host_of(url: str) -> Column:
    """The host of a URL column, lower-cased; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    deep()
    held: dict[str, list] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([dumped(w) for w in held.values()], pa.string())], ["host", "wrapper"])
        held.clear()
        return out

    for batch in batches:
        for part in pieces(batch, "html"):
            for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                items = items_of(parse(source or ""))
                held[host] = unplaced(align(held[host], items) if host in held else items)
                if len(held) >= 2000:
                    yield flush()
    if held:
        yield flush()


def unplaced(items: list) -> list:
    """items, without the places of a page's blocks."""
    stack = list(items)
    while stack:
        _, kids, _, _, facts = stack.pop()
        stack += kids
        if facts is not None:
            facts[4] = ()
    return items


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    deep()
    now, held = None, None
    for batch in batches:
        for host, wrapper in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            items = loaded(wrapper)
            if host == now:
                held = align(held, items)
                continue
            if now is not None:
                yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([dumped(held)])], ["host", "wrapper"])
            now, held = host, items
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([dumped(held)])], ["host", "wrapper"])


def infer(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """host and wrapper (dumped(); expression() writes it as a regular expression) of each host."""
    schema = "host string, wrapper string"
    partial = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(_partial, schema)
    for keys in (["host", F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD))], ["host"]):
        partial = partial.repartition(*keys).sortWithinPartitions("host", "wrapper").mapInArrow(_merged, schema)
    return partial


def main_text(pages: DataFrame, id_col: str, url_col: str, html_col: str, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """id, url, text and n_chars of every page. Wrappers are broadcast only if they have at most broadcast_bytes together."""
    wrappers = durable(infer(pages, url_col, html_col))
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0))).first()[0]
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    joined = rows.join(F.broadcast(wrappers) if size <= broadcast_bytes else wrappers, "host", "left").select("id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deep()
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = []
                for source, wrapper in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    texts.append("\n".join(extract(parse(source or ""), *wrapper_of(wrapper))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    url_kind = pages.schema[url_col].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, url {url_kind}, text string, n_chars long").select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
