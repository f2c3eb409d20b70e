"""Main text of web pages by wrappers inferred from the pages of a host.

A page is a tree of elements with text slots. A wrapper is a union-free regular expression over such trees: a sequence of
elements and slots, each of which may be optional or repeated, as may a group of several. A page's own tree is its first
wrapper, in which neighbours of one kind fold into a repeated one; two wrappers are aligned element by element, and where
they differ, what only one of them has becomes optional. Slots count their texts, characters and linked characters over all
pages, and keep hashes of the texts that all pages with the slot have in it: those are template. So wrappers of parts of a host's pages can be merged in any grouping: in each task, then by host and salt, then by host.
A page is read along its host's wrapper, whose slots say by their place, counts and template which texts are the article's.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import nlargest

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pieces, staged, texts

#: Bytes of all wrappers up to which they are sent to every executor; beyond that pages are joined with them by host.
BROADCAST = 64 << 20
#: Hosts whose wrappers a task holds before it writes them, and groups in which a host's wrappers are merged first.
HELD, SALTS = 2000, 16
#: Texts of the pages in them, from which a task writes the wrappers it holds, too.
HELD_TEXTS = 200_000
#: Different pages on which a text must be the same to be template, and the longest texts of a page by which pages are told apart.
SEVERAL, LONGEST = 3, 5
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements within one another that a wrapper describes; pages are read at any depth. Pairs of items aligned at a time.
DEPTH, PAIRS = 80, 250_000
#: Part of a slot's characters in links from which it is a menu, outside of the article, and of each text in a list from which the
#: list is one, within an element that is not ``article`` but named so.
LINKED, LISTED = 0.6, 0.9
LISTS = {"ul", "ol", "dl", "menu", "table"}

# Fixed names of HTML: elements without content, elements that do not break a block, elements whose text is not shown,
# elements that close an open paragraph, and those that only repeat beside their own kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
HIDDEN = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas",
          "head", "select", "audio", "video"}
OWN_KIND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
            "td": {"tr"}, "th": {"tr"}, "option": {"select"}, "p": set()}
#: Elements that are not an article's text, whatever their names.
ASIDE = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "label", "address"}
#: Whole tokens of class, id or role that say the same: such a word, also with a place before it or a part after it. Other
#: tokens that have the word in them, as ``has-sidebar`` or ``category-legal``, say nothing; there the wrapper decides.
ASIDE_WORDS = re.compile(
    r"(?:^| )(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global|post|entry|article|user|blog|footer|header)[-_])*"
    r"(?:nav|navbar|navigation|menu\w*|side-?bar|footer|masthead|ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|"
    r"notices?|alert|pop-?up|modal|overlay|share|sharing|social|related|recommend\w*|comments?|repl(?:y|ies)|disqus|respond|"
    r"breadcrumbs?|pagination|pager|subscribe|newsletter|sign-?up|login|search|toolbar|widgets?|copyright|legal|tags|"
    r"complementary|contentinfo)"
    r"(?:[-_](?:\d+|area|list|section|wrap|wrapper|container|box|bar|block|inner|body|content|links?|buttons?|form|title|items?|menu|"
    r"nav|panel|posts|articles|stories|notice|banner|consent|footer|header|thread|media|share|sharing|widgets?))*(?=$| )"
)
#: Words that say that an element is the article.
MAIN_WORDS = re.compile(r"(?:^|[-_ ])(?:article|post|entry|story|main|content)(?:-?(?:body|content|text))?(?:$|[-_ ])")
#: Elements that hold a page's text whatever their classes.
HOLDERS = {"html", "body", "main", "article"}

# A tag's attributes; a quote without its partner is a character. What is scanned as attributes is always taken, up to the page's end
# where a tag is never closed, so that no stretch of a page is scanned again for each tag in it.
_WITHIN = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<svg\b" + _WITHIN + r"(?:(?<=/)>|>.*?(?:</svg\s*+>|\Z)|\Z)"
    r"|<(script|style|textarea|noscript|template|iframe|title)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)(" + _WITHIN + r")(?:>|\Z)|((?:[^<]++|<(?![!?]|/?[a-zA-Z]))++)",
    re.S | re.I,
)
_DIGITS = re.compile(r"\d+")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Node:
    """An element with its kind, ``tag`` or ``tag.names``, or a text; ``linked`` counts characters in links.

    ``mains`` are the elements in it, and itself, that are named as the article and do not lie in a menu, footer or the like.
    """

    kind: str
    children: list[Node] = field(default_factory=list)
    text: str = ""
    linked: int = 0
    mains: int = 0


def parse(page: str) -> Node:
    """The tree of a page's elements, of any depth. Open elements end where their parent does; stray ends are ignored."""
    root = Node("")
    open_, links, mains = [root], 0, 0
    written: list[tuple[Node, list[str]]] = []  # texts, joined once at the end
    within: Counter = Counter()  # open elements by tag, and by what they are

    def close(at: int) -> None:
        for node in open_[at:]:
            tag = node.kind.partition(".")[0]
            node.mains = mains - node.mains
            within[tag] -= 1
            within["#hidden"] -= tag in HIDDEN
            within["#aside"] -= tag in ASIDE
        del open_[at:]

    for _, end, tag, rest, text in (m.groups(default="") for m in _TOKEN.finditer(page)):
        tag = tag.lower()
        if text:
            if not within["#hidden"]:
                _add_text(open_[-1], html.unescape(text), links > 0, written)
        elif not tag or tag == "math" and rest.endswith("/"):
            continue
        elif tag == "a":
            links = 0 if end else 1
        elif tag == "br":
            _add_text(open_[-1], " ", False, written)
        elif tag in INLINE or tag in VOID:
            continue
        elif end:
            if within[tag] > 0:
                close(next(i for i in range(len(open_) - 1, 0, -1) if open_[i].kind.partition(".")[0] == tag))
            links = 0
        else:
            close(_implied(open_, tag, within))
            names = " ".join(sorted({next(filter(None, g[1:]), "").lower() for g in _NAMED.findall(rest)} - {""}))
            names = _DIGITS.sub("0", names)
            node = Node(f"{tag}.{names}" if names and tag not in HIDDEN else tag, mains=mains)
            open_[-1].children.append(node)
            open_.append(node)
            within[tag] += 1
            within["#hidden"] += tag in HIDDEN
            within["#aside"] += tag in ASIDE
            mains += not within["#aside"] and _named_main(node.kind)
            links = 0
    close(0)
    for node, parts in written:
        node.text = "".join(parts)
    return root


def _add_text(parent: Node, text: str, linked: bool, written: list[tuple[Node, list[str]]]) -> None:
    last = parent.children[-1] if parent.children else None
    if last is None or last.kind != "#":
        last = Node("#")
        parent.children.append(last)
        written.append((last, []))
    written[-1][1].append(text)  # the last child of the open element, so the last text of the page
    last.linked += len(text.strip()) if linked else 0


def _implied(open_: list[Node], tag: str, within: Counter) -> int:
    """The place of the first open element that a start of ``tag`` ends, or the number of open ones."""
    if open_[-1].kind.partition(".")[0] == "p":
        return len(open_) - 1
    ended = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
    if tag in OWN_KIND and any(within[t] > 0 for t in ended):
        for i in range(len(open_) - 1, 0, -1):
            kind = open_[i].kind.partition(".")[0]
            if kind in OWN_KIND[tag]:
                break
            if kind in ended:
                return i
    return len(open_)


# --- wrappers: [kind, mark, children or counts]; mark "" for once, "?" optional, "+" repeated, "*" both ---

_MARKS = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}


def _marked(item: list, optional: bool = False, repeated: bool = False) -> list:
    return [item[0], _MARKS[optional or item[1] in "?*" and item[1] != "", repeated or item[1] in "+*" and item[1] != ""], item[2]]


def _inner(place: int, kind: str) -> int:
    """The place of an element of this kind in an element at ``place``, as a hash of the kinds on the way."""
    return xxhash.xxh64_intdigest(kind, place)


def _key(place: int, text: str) -> str:
    return f"{xxhash.xxh64_intdigest(' '.join(text.split()), place) >> 16:x}"


def _page_mark(root: Node) -> int:
    """Equal for pages that differ in small texts only."""
    found, left = [], [root]
    while left:
        for child in left.pop().children:
            if child.kind not in HIDDEN:
                left.append(child)
                found += [(len(t), t)] if (t := " ".join(child.text.split())) else []
    return xxhash.xxh64_intdigest("\n".join(t for _, t in nlargest(LONGEST, found))) >> 16


def wrapper(node: Node, depth: int = 0, place: int = 0, mark: int | None = None) -> list:
    """A page's tree as a wrapper, neighbours of one kind folded; texts of white space alone are no slots.

    What is in elements ``DEPTH`` deep is one slot of its own kind, that no text of a page is read along.
    """
    mark = _page_mark(node) if mark is None else mark
    if depth == DEPTH:
        return [node.kind, "", _deep(node, place, mark)]
    items = []
    for child in node.children:
        if child.kind == "#":
            if child.text.strip():
                items.append(["#", "", _counts(child, place, mark)])
        elif child.kind not in HIDDEN:
            items.append(wrapper(child, depth + 1, _inner(place, child.kind), mark))
    return [node.kind, "", fold(items)]


def _counts(text: Node, place: int, mark: int) -> list:
    """Texts, their characters, linked ones, and by the hashes of the texts that all pages have the least few marks of pages."""
    size = len(text.text.strip())
    return [1, size, min(size, text.linked), {_key(place, text.text): [mark]}]


def _deep(node: Node, place: int, mark: int) -> list:
    counts, left = None, [(node, place)]
    while left:
        node, place = left.pop()
        for child in node.children:
            if child.kind == "#" and child.text.strip():
                own = _counts(child, place, mark)
                counts = _added(counts, own) if counts else own
            elif child.kind != "#" and child.kind not in HIDDEN:
                left.append((child, _inner(place, child.kind)))
    return [["#deep", "", counts]] if counts else []


def _added(a: list, b: list, pages: bool = False) -> list:
    """Counts of two slots: of one place on different pages, or of two places that become one. ``a`` may change."""
    sums = [x + y for x, y in zip(a[:3], b[:3])]
    known, more = (c[3] if len(c) > 3 else {} for c in (a, b))
    if pages:
        known = {k: sorted({*known[k], *more[k]})[:SEVERAL] for k in known if k in more}
    else:
        for k, marks in more.items():
            known[k] = sorted({*known[k], *marks})[:SEVERAL] if k in known else marks
    return [*sums, known] if known else sums


def fold(items: list) -> list:
    """Neighbouring runs of the same one to three kinds become one repeated element or group."""
    for period in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(items):
            run = [x[0] for x in items[i : i + period]]
            n = 1
            while len(run) == period and [x[0] for x in items[i + n * period : i + (n + 1) * period]] == run:
                n += 1
            if n > 1 and (period == 1 or len(set(run)) > 1):
                parts = items[i : i + period]
                for k in range(1, n):
                    parts = [merge(a, b, False) for a, b in zip(parts, items[i + k * period : i + (k + 1) * period])]
                out.append(_marked(parts[0], repeated=True) if period == 1 else ["()" + "|".join(run), "+", parts])
                i += n * period
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def merge(a: list, b: list, pages: bool = True) -> list:
    """The wrapper of what either of two wrappers of one kind describes, of different pages or of neighbours that fold."""
    mark = _marked(a, "?" in (a[1], b[1]) or "*" in (a[1], b[1]), "+" in (a[1], b[1]) or "*" in (a[1], b[1]))[1]
    if a[0] in ("#", "#deep"):
        return [a[0], mark, _added(a[2], b[2], pages)]
    return [a[0], mark, fold(align(a[2], b[2], pages))]


def align(xs: list, ys: list, pages: bool = True) -> list:
    """The two sequences as one: pairs of equal kinds merged, in the order that matches most, all else optional.

    Very long sequences are cut first: at equal items from either end, at kinds that each has once, then into blocks.
    """
    if len(xs) * len(ys) <= PAIRS:
        return _align(xs, ys, pages)
    out: list = []
    most = min(len(xs), len(ys))
    head = next((i for i in range(most) if xs[i][0] != ys[i][0]), most)
    tail = next((i for i in range(most - head) if xs[-1 - i][0] != ys[-1 - i][0]), most - head)
    ends = [merge(a, b, pages) for a, b in zip(xs[len(xs) - tail :], ys[len(ys) - tail :])]
    out += [merge(a, b, pages) for a, b in zip(xs[:head], ys[:head])]
    xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    a = b = 0
    for i, j in [*_anchors(xs, ys), (len(xs), len(ys))]:
        n = 1  # blocks of the items before the anchor
        while (-(-(i - a) // n)) * (-(-(j - b) // n)) > PAIRS:
            n += 1
        for k in range(n):
            some = xs[a + (i - a) * k // n : a + (i - a) * (k + 1) // n]
            out += _align(some, ys[b + (j - b) * k // n : b + (j - b) * (k + 1) // n], pages)
        a, b = i, j
    return out + ends


def _anchors(xs: list, ys: list) -> list[tuple[int, int]]:
    """Places of kinds that are once in both, as many as are in one order."""
    once = [{x[0]: i for i, x in enumerate(s) if n[x[0]] == 1} for s in (xs, ys) for n in [Counter(x[0] for x in s)]]
    ends: list[int] = []
    last: list[tuple] = []  # of the best run of each length: its last anchor and the run before it
    for kind, i in once[0].items():
        if kind in once[1]:
            j = once[1][kind]
            at = bisect_left(ends, j)
            ends[at : at + 1] = [j]
            last[at : at + 1] = [((i, j), last[at - 1] if at else None)]
    out, run = [], last[-1] if last else None
    while run:
        out.append(run[0])
        run = run[1]
    return out[::-1]


def _align(xs: list, ys: list, pages: bool) -> list:
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs) - 1, -1, -1):
        for j in range(len(ys) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if xs[i][0] == ys[j][0] else 0)
    out, i, j = [], 0, 0
    while i < len(xs) or j < len(ys):
        if i < len(xs) and j < len(ys) and xs[i][0] == ys[j][0] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(merge(xs[i], ys[j], pages))
            i, j = i + 1, j + 1
        elif j == len(ys) or i < len(xs) and best[i][j] == best[i + 1][j]:
            out.append(_marked(xs[i], optional=True))
            i += 1
        else:
            out.append(_marked(ys[j], optional=True))
            j += 1
    return out


def _slots(item: list) -> list[list]:
    """All slots of a wrapper."""
    found, left = [], [item]
    while left:
        item = left.pop()
        if item[0] in ("#", "#deep"):
            found.append(item)
        else:
            left += item[2]
    return found


# --- reading a page along a wrapper ---


def _aside(node: Node, within: bool, mains: int) -> bool:
    """Whether an element is beside the article; a heading area inside of the article is not, nor is by its names one that holds
    all of the page's elements that are named as the article."""
    tag, _, names = node.kind.partition(".")
    if tag in ASIDE or tag == "header" and not within:
        return True
    return tag not in HOLDERS and not (node.mains and node.mains == mains) and bool(names and ASIDE_WORDS.search(names))


def _main(kind: str) -> bool:
    tag, _, names = kind.partition(".")
    return tag in ("article", "main") or tag in ("div", "section", "td") and bool(names and MAIN_WORDS.search(names))


def _named_main(kind: str) -> bool:
    """Whether an element is named as the article and as nothing beside it."""
    return _main(kind) and not ASIDE_WORDS.search(kind.partition(".")[2])


def _slot(items: list, kind: str, start: int = 0) -> tuple[list | None, int]:
    """The next item of this kind from ``start`` on, else from the front, also in groups, and its place."""
    for i in [*range(start, len(items)), *range(min(start, len(items)))]:
        if items[i][0] == kind:
            return items[i], i
        if items[i][0].startswith("()") and (found := _slot(items[i][2], kind)[0]):
            return found, i
    return None, start


def template(whole: list) -> frozenset:
    """Keys of the texts that are the same on several pages, on all that have their slot."""
    return frozenset(k for slot in _slots(whole) if len(slot[2]) > 3 for k, marks in slot[2][3].items() if len(marks) >= SEVERAL)


def extract(page: Node, whole: list, same: frozenset | None = None) -> str:
    """The article's blocks, by two line breaks: texts in the article element where the page has one, else all that are not
    beside it, each if it is not template and its slot of the wrapper is not made of links. In an ``article`` links
    drop nothing, in other elements named so lists of which all texts are links; headings in an article may be template."""
    same = template(whole) if same is None else same
    for everywhere in (False, True):
        for known in (same, frozenset()) if same else (same,):
            blocks: list[str] = []
            _read(page, whole, everywhere, known, blocks)
            if blocks:
                return "\n\n".join(blocks)
    return ""


def _read(page: Node, whole: list, everywhere: bool, same: frozenset, blocks: list[str]) -> None:
    stack: list[list] = [[iter(page.children), whole, 0, everywhere, "", False, 0, False]]
    while stack:
        children, item, at, inside, article, listed, way, kept = stack[-1]  # article: "", "named" by class, or "element"
        child = next(children, None)
        if child is None:
            stack.pop()
            continue
        if child.kind in HIDDEN or child.kind == "#" and not child.text.strip():
            continue
        place, stack[-1][2] = _slot(item[2], child.kind, at) if item else (None, 0)
        tag = child.kind.partition(".")[0]
        if child.kind == "#":
            text = " ".join(child.text.split())
            _, chars, linked = place[2][:3] if place else (1, len(text), child.linked)
            if inside and text and (article or linked <= LINKED * chars) and (not same or kept or _key(way, text) not in same):
                blocks.append(text)
        elif not _aside(child, bool(article), page.mains):
            outer = tag in LISTS and not listed
            if outer and article == "named" and _all_links(child):
                continue
            here = "element" if tag == "article" else article or ("named" if _main(child.kind) else "")
            kept = kept or bool(article) and tag in HEADINGS
            way = _inner(way, child.kind)
            stack.append([iter(child.children), place, 0, inside or bool(here), here, listed or outer and bool(article), way, kept])


def _all_links(node: Node) -> bool:
    """Whether an element has texts and all of them are links."""
    found, left = False, [node]
    while left:
        for child in left.pop().children:
            if child.kind not in HIDDEN:
                left.append(child)
                text = " ".join(child.text.split())
                found = found or bool(text)
                if child.linked < LISTED * len(text):
                    return False
    return found


# --- tables ---


def _host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return found[1].rpartition("@")[2].lower() if found else ""


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): the wrapper of each host's pages as JSON. Pages without a host are one host, that of no name."""
    rows = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("wrapper", pa.string())])

    def out(held: dict[str, list]) -> pa.RecordBatch:
        found = [json.dumps(w, separators=(",", ":")) for w in held.values()]
        salts = [zlib.crc32(w.encode()) % SALTS for w in found]
        return pa.RecordBatch.from_pydict({"host": list(held), "salt": salts, "wrapper": found}, schema=schema)

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        n_texts = 0
        for batch in pieces(batches, "html"):
            for url, page in zip(batch.column("url").to_pylist(), texts(batch.column("html"))):
                host, own = _host(url), wrapper(parse(page.decode()))
                n_texts += sum(len(slot[2][3]) for slot in _slots(own))
                held[host] = merge(held[host], own) if host in held else own
                if len(held) >= HELD or n_texts >= HELD_TEXTS:
                    yield out(held)
                    held, n_texts = {}, 0
        yield out(held)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring rows of one host and salt become one."""
        last, whole = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key, found = (row["host"], row["salt"]), json.loads(row["wrapper"])
                if key != last and last is not None:
                    yield pa.RecordBatch.from_pylist([_row(last, whole)], schema=schema)
                whole = merge(whole, found) if key == last else found
                last = key
        if last is not None:
            yield pa.RecordBatch.from_pylist([_row(last, whole)], schema=schema)

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without the texts that are not template."""
        for batch in batches:
            found = [json.loads(w) for w in batch.column("wrapper").to_pylist()]
            for slot in (x for w in found for x in _slots(w)):
                known = {k: marks for k, marks in (slot[2].pop() if len(slot[2]) > 3 else {}).items() if len(marks) >= SEVERAL}
                slot[2] += [known] if known else []
            shapes = pa.array([json.dumps(w, separators=(",", ":")) for w in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("host"), shapes], ["host", "wrapper"])

    def _row(key: tuple, whole: list) -> dict:
        return {"host": key[0], "salt": key[1], "wrapper": json.dumps(whole, separators=(",", ":"))}

    kind = "host string, salt int, wrapper string"
    parts = rows.mapInArrow(infer, kind)
    parts = parts.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(join, kind)
    parts = parts.withColumn("salt", F.lit(0)).repartition("host").sortWithinPartitions("host", "wrapper")
    return parts.mapInArrow(join, kind).mapInArrow(done, "host string, wrapper string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): the main text of every page, empty if it has none; NULL html counts as empty.

    White space within a block is one space, blocks are joined by two line breaks, character references are decoded. Pages
    are rows of their own and may repeat; other columns are not read.
    """
    found = staged(wrappers(pages, url_col, html_col), "wrappers")
    size = found.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(host, "^.*@", ""))
    found = F.broadcast(found) if size <= BROADCAST else found
    rows = rows.withColumn("host", host).join(found, "host", "left").select("id", "url", "html", "wrapper")
    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, tuple] = {}
        for batch in pieces(batches, "html"):
            out = []
            for page, shape in zip(texts(batch.column("html")), batch.column("wrapper").to_pylist()):
                if shape not in parsed:
                    if len(parsed) >= HELD:
                        parsed.clear()
                    whole = json.loads(shape) if shape else ["", "", []]
                    parsed[shape] = whole, template(whole)
                out.append(extract(parse(page.decode()), *parsed[shape]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string())], ["id", "url", "text"])

    return rows.mapInArrow(run, schema)
