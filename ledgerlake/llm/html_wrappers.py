"""Operator 3: main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over the tags and texts of a
host's pages, kept as a tree: an element's content is a list of groups of
elements and text slots, each group once, repeated (``+``) or optional (``?``).
Two wrappers of one host are aligned element by element: equal neighbours
become a repeated group, what only one side has becomes optional, texts that
differ become slots; a page is a wrapper without slots.  Aligning is the same
for pages and wrappers, so tasks align their own pages first and a host's
partial wrappers meet afterwards: a host with a third of all pages sends one
wrapper per task, never its pages.

The main region is chosen on the host's wrapper: its article (or main)
elements, or else the deepest element that holds most of the text, leaving out
parts that are menus, headers, footers, forms and the like by tag or by class.
Each page gives the text of its elements on the region's paths.  White space
within a block becomes one blank, blocks are joined by one blank.

Defined cases: NULL and empty pages have an empty text; NULL or odd URLs share
one nameless host; a page without its host's region is aligned with nothing but
itself; unclosed and stray tags are closed or left out, an unended comment or
script ends with the page; rows alike are each returned; an empty table gives
no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, staged
from .line_dedup import patience

# Element kinds of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe svg math".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
HOLDERS = set("article aside blockquote body div footer form header main nav section table td th ul ol dl".split())
ASIDE_TAGS = set("nav header footer aside form head button select dialog menu fieldset".split()) | RAW
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disclaimer discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter "
    "notice notices pagination pager popup promo promoted related reply replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe teaser toolbar topbar widget".split()
)

#: The content of elements nested deeper stays with the element around them, that
#: of those beside the text apart; their tags are opened and closed all the same.
MAX_DEPTH = 100

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>")
_OTHER = re.compile(r"<[!?][^<>]*>")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"[0-9]+")
_SPLIT = re.compile(r"[^a-z]+")


class Node:
    __slots__ = ("name", "label", "kids", "aside")

    def __init__(self, name: str, label: str, aside: bool):
        self.name, self.label, self.aside, self.kids = name, label, aside, []


_labels: dict[tuple[str, str], tuple[str, bool]] = {}


def label_of(name: str, attributes: str) -> tuple[str, bool]:
    """An element's label (tag and classes, without numbers), and whether it is beside the text."""
    key = (name, attributes)
    if key not in _labels:
        names = [n.lower() for _, a, b, c in _NAMES.findall(attributes) for n in (a or b or c).split()]
        names = sorted({_DIGITS.sub("", n) for n in names} - {""})
        words = {w for n in names for w in _SPLIT.split(n)}
        aside = name in ASIDE_TAGS or bool(words & ASIDE_WORDS and name not in ("html", "body", "article", "main"))
        if len(_labels) > 50_000:
            _labels.clear()
        _labels[key] = (".".join([name, *names]), aside)
    return _labels[key]


def parse(page: str) -> Node:
    """The page as a balanced tree; texts are strings among the kids."""
    root = Node("", "", False)
    stack, pos, n = [root], 0, len(page)
    open_at: dict[str, list[int]] = {}  # where in the stack each name is open

    def last(names) -> int:
        return max((open_at[x][-1] for x in names if open_at.get(x)), default=0)

    def shut_from(k: int) -> None:
        while len(stack) > k:
            deep = len(stack) > MAX_DEPTH + 1
            gone = stack.pop()
            open_at[gone.name].pop()
            if deep and gone.name in BLOCK:  # the break at its end
                stack[-1].kids.append(Node(gone.name, gone.label, False))

    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            at = n
        if at > pos:
            stack[-1].kids.append(entities.unescape(page[pos:at]))
            if at == n:
                break
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            pos = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, at) or _LOOSE.match(page, at)
        if not m:
            m = _OTHER.match(page, at)
            if m:
                pos = m.end()
            else:  # a sign, not a tag
                stack[-1].kids.append("<")
                pos = at + 1
            continue
        pos, name = m.end(), m[2].lower()
        if m[1]:
            k = last((name,))
            if k and (name in BLOCK or k > last(BLOCK)) and (name in HOLDERS or name == "html" or k >= last(HOLDERS)):
                shut_from(k)
            continue
        if name in BLOCK and name != "br":
            shut = CLOSES.get(name, set()) | {"p"}
            fence = last(HOLDERS - shut)
            while (k := last(shut)) > fence:
                shut_from(k)
                if name not in ("tr", "tbody"):
                    break
        label, aside = label_of(name, m[3])
        node = Node(name, label, aside)
        stack[-1].kids.append(node)
        if name in VOID or m[3].endswith("/"):
            continue
        if len(stack) > MAX_DEPTH and name not in RAW and (stack[-1].aside or not aside):
            # its content stays with the element around it
            node = Node(name, label, stack[-1].aside)
            node.kids = stack[-1].kids
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, pos)
            close = page.find(">", end.end()) if end else -1
            pos = n if close < 0 else close + 1
            continue
        open_at.setdefault(name, []).append(len(stack))
        stack.append(node)
    return root


# ---------------------------------------------------------------- wrappers
# element: [label, aside, text characters, groups]; text: ["#", hash or None, characters, []]
# group: [repeated, optional, [elements]]


def _same(a: list, b: list) -> bool:
    return [x[0] for x in a[2]] == [x[0] for x in b[2]]


def fold(groups: list) -> list:
    """Equal neighbours, of one group or of up to three in turn, become a repeated group."""
    out: list = []
    for g in groups:
        out.append(g)
        done = False
        while not done:
            done = True
            for k in (1, 2, 3):
                if len(out) >= 2 * k and all(_same(a, b) for a, b in zip(out[-2 * k : -k], out[-k:])):
                    pairs = list(zip(out[-2 * k : -k], out[-k:]))
                    if k > 1 and any(a[0] or b[0] or a[1] or b[1] for a, b in pairs):
                        continue
                    merged = [merge_group(a, b) for a, b in pairs]
                    if k > 1:  # the turn is one group now
                        merged = [[True, False, [e for m in merged for e in m[2]]]]
                    else:
                        # one is optional, the other is there: at least one
                        merged[0][0], merged[0][1] = True, pairs[0][0][1] and pairs[0][1][1]
                    del out[-2 * k :]
                    out.extend(merged)
                    done = k == 1
                    break
    return out


def merge_group(a: list, b: list) -> list:
    return [a[0] or b[0], a[1] or b[1], [merge(x, y) for x, y in zip(a[2], b[2])]]


def merge(a: list, b: list) -> list:
    """The wrapper of both; the labels are equal."""
    if a[0] == "#":
        return ["#", a[1] if a[1] == b[1] else None, a[2] + b[2], []]
    out, i, j = [], 0, 0
    left = [tuple(x[0] for x in g[2]) for g in a[3]]
    right = [tuple(x[0] for x in g[2]) for g in b[3]]
    for p, q in [*patience(left, right), (len(left), len(right))]:
        out += [[g[0], True, g[2]] for g in a[3][i:p]]
        out += [[g[0], True, g[2]] for g in b[3][j:q]]
        if p < len(left):
            out.append(merge_group(a[3][p], b[3][q]))
        i, j = p + 1, q + 1
    return [a[0], a[1], a[2] + b[2], fold(out)]


def wrapper(node: Node) -> list:
    """A page, or an element of it, as a wrapper."""
    groups, total = [], 0
    for kid in node.kids:
        if isinstance(kid, str):
            text = " ".join(kid.split())
            if not text:
                continue
            item = ["#", zlib.crc32(text.encode()), len(text), []]
        else:
            item = wrapper(kid)
        total += item[2]
        groups.append([False, False, [item]])
    return [node.label, node.aside, total, fold(groups)]


def pattern(w: list) -> str:
    """The wrapper as a regular expression."""
    if w[0] == "#":
        return "#text" if w[1] is None else "#same"
    inner = "".join(
        ("(" + "".join(pattern(e) for e in g[2]) + ")" + ("*" if g[0] and g[1] else "+" if g[0] else "?" if g[1] else ""))
        if g[0] or g[1]
        else "".join(pattern(e) for e in g[2])
        for g in w[3]
    )
    return f"<{w[0]}>{inner}</{w[0].split('.')[0]}>" if w[0] else inner


def _kids(w: list) -> list:
    return [e for g in w[3] for e in g[2]]


def main_weight(w: list) -> int:
    """Characters outside the parts beside the text."""
    return w[2] if w[0] == "#" else 0 if w[1] else sum(main_weight(e) for e in _kids(w))


def regions(w: list) -> list[list[str]]:
    """Label paths of the main region."""
    found: dict[str, dict[tuple, int]] = {"article": {}, "main": {}}

    def walk(e: list, path: tuple) -> None:
        if e[0] == "#" or e[1]:
            return
        name, here = e[0].split(".")[0], (*path, e[0])
        if name in found:
            found[name][here] = found[name].get(here, 0) + main_weight(e)
            if name == "article":
                return
        for kid in _kids(e):
            walk(kid, here)

    for kid in _kids(w):
        walk(kid, ())
    for name in ("article", "main"):
        most = max(found[name].values(), default=0)
        if most:
            return sorted(list(p) for p, n in found[name].items() if 3 * n >= most)
    # the deepest element with most of the text
    path: list[str] = []
    while True:
        kids: dict[str, list] = {}
        for e in _kids(w):
            if e[0] != "#" and not e[1] and e[0].split(".")[0] in HOLDERS | {"html", "body"}:
                kids[e[0]] = merge(kids[e[0]], e) if e[0] in kids else e
        best = max(kids.values(), key=main_weight, default=None)
        if best is None or 2 * main_weight(best) <= main_weight(w) or not main_weight(best):
            return [path]
        w, path = best, [*path, best[0]]


def collect(node: Node, out: list[str]) -> None:
    """Texts in page order, with a break where blocks begin or end."""
    for kid in node.kids:
        if isinstance(kid, str):
            out.append(kid)
        elif not kid.aside:
            block = kid.name in BLOCK
            if block:
                out.append("\n")
            collect(kid, out)
            if block:
                out.append("\n")


def main_text(root: Node, paths: list[list[str]]) -> str | None:
    """Text of the elements on the paths; None if the page has none of them."""
    wanted = {tuple(p) for p in paths}
    prefixes = {p[:k] for p in wanted for k in range(len(p))}
    out: list[str] = []
    hit = False

    def walk(node: Node, path: tuple) -> None:
        nonlocal hit
        if path in wanted:
            hit = True
            out.append("\n")
            collect(node, out)
            out.append("\n")
        elif path in prefixes:
            for kid in node.kids:
                if not isinstance(kid, str) and not kid.aside:
                    walk(kid, (*path, kid.label))

    walk(root, ())
    return " ".join("".join(out).split()) if hit else None


def page_text(page: str | None, paths: list[list[str]] | None) -> str:
    if not page:
        return ""
    root = parse(page)
    text = main_text(root, paths) if paths else None
    if text is None:
        text = main_text(root, regions(wrapper(root)))
    return text or ""


# ---------------------------------------------------------------- tables


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_wrappers(pages: DataFrame, most_hosts: int = 5000) -> DataFrame:
    """host, pattern, paths (JSON): the wrapper of every host, over all its pages."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("page_id").cast("long").alias("page_id"), "html")

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, tuple] = {}

        def taken():
            items = [(h, str(k), json.dumps(w)) for h, (k, w) in held.items()]
            held.clear()
            for k in range(0, len(items), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*items[k : k + 500])], ["host", "first", "wrapper"])

        for part in byte_slices(batches, "html"):
            for host, page_id, page in zip(*(part.column(k).to_pylist() for k in range(3))):
                if page:
                    w = wrapper(parse(page))
                    held[host] = (held[host][0], merge(held[host][1], w)) if host in held else (page_id, w)
                    if len(held) >= most_hosts:
                        yield from taken()
        yield from taken()

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        host, whole = None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.string()) for x in (host, pattern(whole), json.dumps(regions(whole)))], ["host", "pattern", "paths"]
            )

        for batch in batches:
            for h, _, w in zip(*(batch.column(k).to_pylist() for k in range(3))):
                w = json.loads(w)
                if h == host:
                    whole = merge(whole, w)
                else:
                    if whole is not None:
                        yield row()
                    host, whole = h, w
        if whole is not None:
            yield row()

    return (
        rows.mapInArrow(partial, "host string, first string, wrapper string")
        .repartition("host")
        .sortWithinPartitions("host", "first", "wrapper")
        .mapInArrow(join, "host string, pattern string, paths string")
    )


#: Hosts whose paths may be broadcast; beyond, the same join is shuffled.
BROADCAST_HOSTS = 100_000


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    paths = staged(host_wrappers(pages).select("host", "paths"), "op3-hosts")
    small = paths.count() <= BROADCAST_HOSTS
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(paths) if small else paths, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known: dict[str, list] = {}
        for part in byte_slices(batches, "html"):
            texts = []
            for page, spec in zip(part.column("html").to_pylist(), part.column("paths").to_pylist()):
                if spec is not None and spec not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[spec] = json.loads(spec)
                texts.append(page_text(page, known.get(spec)))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
