"""Main text of web pages through wrappers: one union-free regular expression over tags and text for each host.

A page is read as a stream of tags and texts with implied end tags. Equal neighbours, and equal neighbouring groups, fold
into one repeated group. Aligning a page with the host's wrapper resolves each mismatch: differing texts become a
slot, tags that only one side has become an optional part, neighbours found equal become repeated. Wrappers align with each
other in the same way, so every task infers wrappers of its own pages, they are merged in two steps, and a host with a
third of all pages never meets in one task.

The wrapper then decides what belongs to the article: the article or main element, or else the element whose slots hold
the most running text; menus, forms, notices, adverts and comments go by their tags, roles and class words, and text that
is the same on all pages of a host goes unless it stands inside an article element. Class words and form elements only
make an element doubtful: one that holds the article, or most of the running text, is a wrapper of it and stays (`excused`).
"""

from __future__ import annotations

import html
import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import slices, written

SALTS = 64
"""Groups in which a host's partial wrappers are merged first."""
HOSTS_HELD = 2000
TEMPLATE_PAGES = 3
"""Pages, no two with the same texts, on which a text must be the same before it counts as the host's own."""
GROUP = 4
"""Longest repeated group of neighbours that is folded."""
DEPTH = 256
"""Levels of a tree, as in browsers."""

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed xmp template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th"),
}
SCOPES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",)}
TABLES = ("table",)
DROPPED_TAGS = frozenset("nav footer aside button select option input object video audio canvas dialog menu head meter progress datalist".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist consent
    cookie cookies copyright disqus footer form gdpr legal login masthead menu menus modal nav navbar navigation newsletter notice notices
    overlay pager pagination popup promo promos promotion promotions recommended recommendations related replies reply respond share
    sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
DOUBTFUL_TAGS = frozenset(["form"])
MAIN_WORDS = frozenset("articlebody entrycontent postcontent storybody maincontent articlecontent".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|([^<]++|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


# What an element says of itself: nothing, doubtful by a class word or as a form, doubtful by a word for comments, dropped.
KEPT, DOUBTFUL, COMMENTS, DROPPED = range(4)
MARKS = ("", "~", "?", "-")
"""First character of a part's signature."""


class Element:
    """sig: tag, role and class words; dropped: what it says of itself; text in `children` is plain strings."""

    __slots__ = ("children", "dropped", "sig", "tag")

    def __init__(self, tag: str, sig: str, dropped: int):
        self.tag, self.sig, self.dropped = tag, sig, dropped
        self.children: list = []


def _describe(tag: str, attributes: str) -> tuple[str, int]:
    """Signature of an element and whether it is to be dropped for what it says of itself."""
    dropped = DROPPED if tag in DROPPED_TAGS else DOUBTFUL if tag in DOUBTFUL_TAGS else KEPT
    if not attributes or attributes.isspace():
        return tag, dropped
    said = {}
    for name, one, two, three in ATTRIBUTE.findall(attributes):
        said.setdefault(name.lower(), one or two or three)
    role = said.get("role", "").strip().lower()
    names = f"{said.get('class', '')} {said.get('id', '')}"
    words = {w.lower() for w in WORD.findall(names)}
    if tag not in ("html", "body"):
        if role in DROPPED_ROLES or "hidden" in said or "display:none" in said.get("style", "").replace(" ", "").lower():
            dropped = DROPPED
        if words & COMMENT_WORDS:
            dropped = max(dropped, COMMENTS)
        elif tag not in ("article", "main") and words & DROPPED_WORDS:
            dropped = max(dropped, DOUBTFUL)
    joined = re.sub(r"[^a-z]+", "", names.lower()) if words else ""
    main = role == "main" or said.get("itemprop", "").lower() == "articlebody" or joined in MAIN_WORDS
    return f"{tag}{'!' if main else ''}{'.' + '.'.join(sorted(words)) if words else ''}", dropped


_SEEN: dict[tuple[str, str], tuple[str, int]] = {}


def parse(page: str) -> Element:
    """The tree of a page. Scripts, styles, titles and comments are left out; texts still hold character references.

    The tree is `DEPTH` levels deep at most, as browsers bound theirs: what lies deeper is put beside each other on the last level,
    in page order and with the marks of all elements around it, so no text is lost however deep a page is.
    """
    root = Element("", "", KEPT)
    stack = [root]
    opened: Counter[str] = Counter()  # tags on the stack: most searches for an open element end here

    def shut(depth: int) -> None:
        opened.subtract(e.tag for e in stack[depth:])
        del stack[depth:]
        if len(stack) > DEPTH:  # what follows in the element goes on in a new piece of it
            top = stack[-1]
            piece = Element(top.tag, top.sig, top.dropped)
            stack[DEPTH - 1].children.append(piece)
            stack[-1] = piece

    at, n = 0, len(page)
    match = TOKEN.match
    while at < n:
        m = match(page, at)
        at = m.end()
        kind = m.lastindex
        if kind is None:
            continue
        if kind == 6:
            stack[-1].children.append(m[6])
            continue
        if kind == 1:
            tag = m[1].lower()
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[depth].tag == tag:
                    shut(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        tag, attributes = (m[2], m[3]) if m[2] is not None else (m[4], m[5])
        tag = tag.lower()
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if tag in CLOSES_P and opened["p"] > 0:
            _close(stack, ("p",), ("button", "table", "td", "th"), shut)
        if tag in CLOSES and any(opened[t] > 0 for t in CLOSES[tag]):
            _close(stack, CLOSES[tag], SCOPES.get(tag, TABLES), shut)
        if tag == "br":
            stack[-1].children.append(" ")
            continue
        key = (tag, attributes)
        found = _SEEN.get(key)
        if found is None:
            found = _describe(tag, attributes)
            if len(_SEEN) < 50_000:
                _SEEN[key] = found
        sig, dropped = found
        if tag in VOID:
            continue
        if tag in INLINE and not dropped and tag != "a":
            child = Element(tag, "", KEPT)  # transparent
        else:
            child = Element(tag, sig, dropped)
        if len(stack) > DEPTH:
            child.dropped = max(child.dropped, stack[-1].dropped)
        stack[min(len(stack), DEPTH) - 1].children.append(child)
        stack.append(child)
        opened[tag] += 1
    return root


def _close(stack: list[Element], tags: tuple[str, ...], scopes: tuple[str, ...], shut: Callable[[int], None]) -> None:
    depth = len(stack) - 1
    while depth > 0:
        tag = stack[depth].tag
        if tag in tags:
            shut(depth)
            if len(tags) == 1:
                return
        elif tag in scopes:
            return
        depth -= 1


def clean(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def runs(element: Element) -> list:
    """The element's children as blocks: elements, and runs of text [text, characters inside links]; inline elements are part of runs."""
    out: list = []
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = clean("".join(held))
            if text:
                out.append([text, min(linked, len(text))])
            held.clear()
        linked = 0

    stack = [(iter(element.children), False)]
    while stack:
        children, inside = stack[-1]
        for child in children:
            if isinstance(child, str):
                held.append(child)
                if inside:
                    linked += len(child)
            elif child.tag in INLINE and not child.dropped:
                stack.append((iter(child.children), inside or child.tag == "a"))
                break
            else:
                flush()
                out.append(child)
        else:
            stack.pop()
    flush()
    return out


# A part of a wrapper is a list: signature, optional, repeated, pages (of a text: the least hashes of the texts of distinct
# pages, TEMPLATE_PAGES at most), hash of its text (0: a slot), characters of running text, characters in links, parts.
# Text has the signature "#", a folded group "(...)".
SIG, OPTIONAL, REPEATED, PAGES, TEXT, CHARS, LINKED, PARTS = range(8)


def wrap(element: Element) -> list:
    """The wrapper of one page."""
    pages: list[int] = []  # of all its texts; filled at the end
    texts: list[int] = []

    def part(block: Element | list) -> list:
        if isinstance(block, Element):
            return [_sig(block), 0, 0, [], 0, 0, 0, [p for p, _ in fold([part(x) for x in runs(block)])]]
        texts.append(xxhash.xxh64_intdigest(block[0].encode()) >> 12 or 1)
        return ["#", 0, 0, pages, texts[-1], len(block[0]) - block[1], block[1], []]

    whole = part(element)
    pages.append(xxhash.xxh64_intdigest(json.dumps(texts)) >> 12)
    return whole


def _sig(block: Element | list) -> str:
    return "#" if isinstance(block, list) else MARKS[block.dropped] + block.sig


def fold(parts: list) -> list[tuple[list, list[int]]]:
    """Repeated neighbours as one part. Returns each part with the numbers of the given parts that it stands for."""
    out = [(p, [i]) for i, p in enumerate(parts)]
    for size in range(1, GROUP + 1):
        i, folded = 0, []
        while i < len(out):
            sigs = [p[SIG] for p, _ in out[i : i + size]]
            j = i + size
            while len(sigs) == size and [p[SIG] for p, _ in out[j : j + size]] == sigs and (size > 1 or sigs[0][0] != "("):
                j += size
            if j == i + size or len(sigs) < size:
                folded.append(out[i])
                i += 1
                continue
            members = [out[a : a + size] for a in range(i, j, size)]
            numbers = [n for m in members for _, ns in m for n in ns]
            if size == 1:
                whole = members[0][0][0]
                for m in members[1:]:
                    whole = merge(whole, m[0][0])
                whole[REPEATED] = 1
            else:
                whole = _group([p for p, _ in members[0]])
                for m in members[1:]:
                    whole = merge(whole, _group([p for p, _ in m]))
                whole[REPEATED] = 1
            folded.append((whole, numbers))
            i = j
        out = folded
    return out


def _group(parts: list) -> list:
    return [f"({' '.join(p[SIG] for p in parts)})", 0, 0, [], 0, 0, 0, list(parts)]


def merge(a: list, b: list) -> list:
    """Align two parts of one signature."""
    pages = a[PAGES] if a[PAGES] == b[PAGES] else sorted({*a[PAGES], *b[PAGES]})[:TEMPLATE_PAGES]
    return [
        a[SIG], max(a[OPTIONAL], b[OPTIONAL]), max(a[REPEATED], b[REPEATED]), pages,
        a[TEXT] if a[TEXT] == b[TEXT] else 0, a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], _merge_lists(a[PARTS], b[PARTS]),
    ]


def pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists of signatures; of several the one that matches as soon as it can and else skips in `a`.

    A row of the table of lengths is one number with a bit for each place at which the length grows, so a row takes a few operations
    on whole numbers. Every sqrt(len(a))-th row is kept and the ones between are made again, so lists of any length are aligned alike.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    out = [(i, i) for i in range(start)]
    n, m = len(a) - start, len(b) - start
    places: dict[str, int] = {}
    for j in range(m):
        places[b[start + j]] = places.get(b[start + j], 0) | 1 << m - 1 - j
    if not any(s in places for s in a[start:]):
        return out
    full = (1 << m) - 1

    def above(row: int, i: int) -> int:
        """Row i of the table from row i + 1: bit m - 1 - j is 0 if the lists from i and j on have more in common than those from i and j + 1 on."""
        same = row & places.get(a[start + i], 0)
        return (row + same | row - same) & full if same else row

    step = math.isqrt(n) + 1
    kept, row = {n: full}, full
    for i in range(n - 1, -1, -1):
        row = above(row, i)
        if i % step == 0:
            kept[i] = row
    rows: dict[int, int] = {}

    def grown(i: int) -> int:
        """Row i with a 1 where the length grows."""
        if i > n:
            return 0
        if i not in rows:
            rows.clear()
            stop = min(n, i - i % step + step)
            rows[stop] = kept[stop]
            for k in range(stop - 1, i - 1, -1):
                rows[k] = above(rows[k + 1], k)
        return rows[i] ^ full

    i, j, here, under = 0, 0, grown(0), grown(1)
    length, below = here.bit_count(), under.bit_count()  # in common from (i, j) and from (i + 1, j) on
    here, under = (x.to_bytes(m // 8 + 1, "little") for x in (here, under))
    while length:
        at = m - 1 - j
        if a[start + i] == b[start + j]:
            out.append((start + i, start + j))
            below -= under[at >> 3] >> (at & 7) & 1
            j += 1
        elif below < length:
            length -= here[at >> 3] >> (at & 7) & 1
            below -= under[at >> 3] >> (at & 7) & 1
            j += 1
            continue
        i, length, here = i + 1, below, under
        row = grown(i + 1)
        below = (row & (1 << m - j) - 1).bit_count()
        under = row.to_bytes(m // 8 + 1, "little")
    return out


def _merge_lists(a: list, b: list) -> list:
    out, i, j = [], 0, 0

    def alone(part: list) -> list:
        return [part[SIG], 1, *part[REPEATED:]]

    for x, y in [*pairs([p[SIG] for p in a], [p[SIG] for p in b]), (len(a), len(b))]:
        out += [alone(p) for p in a[i:x]] + [alone(p) for p in b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    if len(out) < 2 or all(p[SIG] != q[SIG] for p, q in zip(out, out[1:])):
        return out
    return [p for p, _ in fold(out)]  # two optional neighbours may have become equal


def expression(part: list) -> str:
    """The wrapper as a regular expression."""
    sig = part[SIG].lstrip("~?-")
    inner = " ".join(expression(p) for p in part[PARTS])
    if part[SIG] == "#":
        body = "#SLOT" if not part[TEXT] else "#TEXT"
    else:
        body = f"({inner})" if sig.startswith("(") else f"<{sig}>{inner}</>"
    mark = "*" if part[OPTIONAL] and part[REPEATED] else "+" if part[REPEATED] else "?" if part[OPTIONAL] else ""
    return f"({body}){mark}" if mark else body


def _tag(part: list) -> str:
    return re.split(r"[.!]", part[SIG].lstrip("~?-"), maxsplit=1)[0]


def _constant(part: list) -> bool:
    """Whether a part that is text is the host's own."""
    return bool(part[TEXT]) and len(part[PAGES]) >= TEMPLATE_PAGES


def _running(part: list) -> float:
    """Characters of running text of a part that is text."""
    return 0.0 if _constant(part) else max(0.0, float(part[CHARS] - part[LINKED]))


def excused(wrapper: list) -> set[tuple[int, ...]]:
    """Paths of the doubtful parts that stay, since the article is in them.

    Such a part holds more than half of the running text of the article or main part that it stands in, or else of the page;
    or it holds an article or main part that is no repeated one, and those outside hold no more text. What is named for
    comments counts for nothing around it, unless it stays itself: if no running text is left outside, or if it has the page's
    h1 or main element, and either more text than is left outside or the only article.
    """
    out: set[tuple[int, ...]] = set()
    weights: dict[tuple[int, ...], tuple[float, float, bool, bool]] = {}

    def weigh(part: list, path: tuple[int, ...]) -> tuple[float, float, bool, bool]:
        """Running text, that of article and main parts, whether one of these is not repeated, whether there is an h1 or main."""
        sig, tag = part[SIG], _tag(part)
        if sig == "#":
            return _running(part), 0.0, False, False
        if sig.startswith("-"):
            return 0.0, 0.0, False, False
        text, semantic, single, titled = 0.0, 0.0, False, tag in ("h1", "main")
        for i, p in enumerate(part[PARTS]):
            below = weigh(p, (*path, i))
            if not p[SIG].startswith("?") or (*path, i) in out:
                text, semantic, single, titled = text + below[0], semantic + below[1], single or below[2], titled or below[3]
        if tag in ("article", "main"):
            semantic, single = text, True
        weights[path] = text, semantic, single and not part[REPEATED], titled
        return weights[path]

    def walk(part: list, path: tuple[int, ...], scope: tuple[int, ...], kind: str) -> None:
        """Excuse the parts of one kind. scope: path of the part whose text counts."""
        sig = part[SIG]
        if sig == "#" or sig.startswith("-"):
            return
        text, semantic, single, titled = weights[path]
        all_text, all_semantic, has_single, _ = weights[scope]
        if kind != "doubtful":
            if sig.startswith("?") and path not in out:
                if kind == "titled comments" and titled and (text > all_text or single and not has_single):
                    out.add(path)
                elif kind == "lone comments" and text > 0 and not all_text:
                    out.add(path)
        elif sig.startswith(("?", "~")) and path not in out:
            if sig.startswith("?") or not (text > all_text / 2 or single and semantic >= all_semantic - semantic):
                return
            out.add(path)
        if path in out and sig.startswith("?") or _tag(part) in ("article", "main"):
            scope = path
        for i, p in enumerate(part[PARTS]):
            walk(p, (*path, i), scope, kind)

    for kind in ("titled comments", "lone comments", "doubtful"):
        weigh(wrapper, ())
        walk(wrapper, (), (), kind)
    return out


def main_parts(wrapper: list, stays: set[tuple[int, ...]] | None = None) -> list[tuple[int, ...]]:
    """Paths of the parts that hold the article."""
    stays = excused(wrapper) if stays is None else stays
    articles, mains, bodies, dense = [], [], [], []

    def walk(part: list, path: tuple[int, ...]) -> tuple[float, float]:
        """Running text of the part's own blocks, and the share that its blocks give to their grandparent."""
        sig, tag = part[SIG], _tag(part)
        if sig[:1] in MARKS[1:] and path not in stays:
            return 0.0, 0.0
        if sig == "#":
            return _running(part), 0.0
        for kind, found in (("article", articles), ("main", mains)):
            if tag == kind and not any(path[: len(p)] == p for p in found):
                found.append(path)
        if "!" in sig.split(".")[0] and not any(path[: len(p)] == p for p in bodies):
            bodies.append(path)
        below = [walk(p, (*path, i)) for i, p in enumerate(part[PARTS])]
        own = sum(b[0] for p, b in zip(part[PARTS], below) if p[SIG] == "#")
        if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "dd", "") or sig.startswith("("):
            given = own + sum(b[0] for p, b in zip(part[PARTS], below) if p[SIG] != "#")
            return given, sum(b[1] for b in below)
        score = sum(b[0] for b in below) + sum(b[1] for b in below) / 2
        dense.append((score, -len(dense), path))
        return 0.0, sum(b[0] for b in below)

    walk(wrapper, ())
    for found in (articles, mains, bodies):
        if found:
            return found
    best = max(dense, default=(0.0, 0, ()))
    return [best[2]] if best[0] > 0 else [()]


def article_text(page: Element, wrapper: list, mains: list[tuple[int, ...]] | None = None, stays: set[tuple[int, ...]] | None = None) -> str:
    """The article of a page that the wrapper has been aligned with; the whole body if the page lacks the wrapper's main part.

    In the whole body a doubtful element stays as well if this page alone, taken as a wrapper, would excuse it.
    """
    stays = excused(wrapper) if stays is None else stays
    mains = main_parts(wrapper, stays) if mains is None else mains
    semantic = bool(mains) and all(_tag(_at(wrapper, p)) in ("article", "main") for p in mains)
    targets = set(mains)
    blocks: list[str] = []
    everything: list[str] = []
    doubted = False

    def walk(element: Element, part: list | None, path: tuple[int, ...] | None, inside: bool, alone: list | None, own: tuple[int, ...] | None) -> None:
        """alone, own: the element's part in the wrapper of this page alone, and its path; None while that is not asked for."""
        nonlocal doubted
        if element.dropped == DROPPED:
            return
        if element.dropped and path not in stays and (inside or own not in stays_alone):
            doubted = True
            return
        if element.tag == "header" and not inside:
            return
        children = runs(element)
        match: dict[int, tuple[list, tuple[int, ...]]] = {}
        match_alone: dict[int, tuple[list, tuple[int, ...]]] = {}
        for given, at, found in ((part, path, match), (alone, own, match_alone)):
            if given is not None:
                _match(fold([[_sig(x), 0, 0, [], 0, 0, 0, []] for x in children]), given, at, found)
        for number, child in enumerate(children):
            known, where = match.get(number, (None, None))
            now = inside or (where is not None and where in targets)
            if isinstance(child, Element):
                walk(child, known, where, now, *match_alone.get(number, (None, None)))
                continue
            if known is not None and _constant(known) and not (now and semantic):
                continue
            everything.append(child[0])
            if now:
                blocks.append(child[0])

    stays_alone: set[tuple[int, ...]] = set()
    walk(page, wrapper, (), () in targets, None, None)
    if not blocks and doubted:
        alone = wrap(page)
        stays_alone = excused(alone)
        if stays_alone:
            everything.clear()
            walk(page, wrapper, (), () in targets, alone, ())
    return " ".join(blocks if blocks else everything)


def _at(wrapper: list, path: tuple[int, ...]) -> list:
    for i in path:
        wrapper = wrapper[PARTS][i]
    return wrapper


def _match(folded: list[tuple[list, list[int]]], part: list, path: tuple[int, ...], out: dict) -> None:
    """Tell for every child of a page's element which part of the wrapper it is."""
    for i, j in pairs([p[SIG] for p, _ in folded], [p[SIG] for p in part[PARTS]]):
        numbers, known, where = folded[i][1], part[PARTS][j], (*path, j)
        if known[SIG].startswith("(") and len(known[PARTS]):
            size = len(known[PARTS])
            for k, number in enumerate(numbers):
                out[number] = (known[PARTS][k % size], (*where, k % size))
        else:
            for number in numbers:
                out[number] = (known, where)


def host(url: str = "url") -> object:
    """Lower-case host of a URL without user and port; empty where there is none."""
    name = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(name, F.lit(""))


WRAPPERS = "host_ string, salt_ int, wrapper_ string"


def _infer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def emptied() -> pa.RecordBatch:
        rows = [(h, json.dumps(w, separators=(",", ":"))) for h, w in sorted(held.items())]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([xxhash.xxh32_intdigest(r[1].encode()) % SALTS for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
            names=["host_", "salt_", "wrapper_"],
        )

    for part in slices(batches, "html_", 4 << 20):
        for name, page in zip(part.column("host_").to_pylist(), part.column("html_").to_pylist()):
            found = wrap(parse(page))
            held[name] = merge(held[name], found) if name in held else found
        if len(held) > HOSTS_HELD:
            yield emptied()
    if held:
        yield emptied()


def _merged(key: tuple, part: pa.Table) -> pa.Table:
    whole = None
    for text in sorted(part.column("wrapper_").to_pylist()):
        one = json.loads(text)
        whole = one if whole is None else merge(whole, one)
    return pa.table({
        "host_": pa.array([key[0].as_py()], pa.string()), "salt_": pa.array([0], pa.int32()), "wrapper_": pa.array([json.dumps(whole, separators=(",", ":"))], pa.string()),
    })


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host_ and wrapper_ (JSON; see `expression`), one row per host. Every page is aligned."""
    source = pages.select(host().alias("host_"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html_"))
    partial = source.mapInArrow(_infer, WRAPPERS)
    salted = partial.groupBy("host_", "salt_").applyInArrow(_merged, WRAPPERS)
    return salted.groupBy("host_").applyInArrow(_merged, WRAPPERS).select("host_", "wrapper_")


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[list, list, set]] = {}
    for part in slices(batches, "html_", 4 << 20):
        texts = []
        for page, wrapper in zip(part.column("html_").to_pylist(), part.column("wrapper_").to_pylist()):
            if wrapper not in known:
                if len(known) > 500:
                    known.clear()
                tree = json.loads(wrapper)
                stays = excused(tree)
                known[wrapper] = (tree, main_parts(tree, stays), stays)
            texts.append(article_text(parse(page), *known[wrapper]))
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_articles(pages: DataFrame) -> DataFrame:
    """The article of every page.

    pages: page_id long, url, html; other columns are ignored. Returns one row per input row: page_id, url, text (blocks in page
    order, joined by one blank), n_chars (code points). Null and empty pages have the empty text; pages whose URL is null or has
    no host are one host together. Pages with the same texts count once where a text is told to be the host's own. Markup that ends early is closed at its end. Repeated rows appear as often as they are
    given. An empty table gives no rows.
    """
    wrappers = written(infer_wrappers(pages), "wrappers")
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host().alias("host_"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html_"),
    )
    return source.join(wrappers, "host_").select("page_id", "url", "html_", "wrapper_").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
