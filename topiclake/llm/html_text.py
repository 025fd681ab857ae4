"""Operator 9: main text of web pages, with wrappers inferred per host.

A page is a stream of tags and texts. For every host a wrapper, a union-free regular
expression over such streams, is inferred from all of its pages: equal stretches that
follow each other fold into repeated groups; then page after page is aligned with the
wrapper, where differing texts become slots, a stretch that one side repeats becomes a
repeated group, and a stretch that one side lacks becomes an optional group, or joins one that is like it. A page that
its host's wrapper matches loses the texts outside an article or main element that are
constant in the wrapper (the host's own wording); what remains, and all text of pages without or beside a wrapper, is judged
by its place: only the article (or main) element counts where there is one, and menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments go. A class, id or
role marks such a part only as a whole (``cookie-notice``, not ``related-work``), and never one that
stands around the main element or the page's principal article.

The text: character references decoded, white space inside a block as one space, trimmed,
blocks in page order, one line each. Nothing else is dropped or capped.

The wrapper of a host takes in every page with html. A text is the host's own wording when ``MIN_PAGES`` pages of
different texts have it in one place, and no page another there. Pages with one sequence of signatures differ in texts only, so
they are joined first, in any order; ``JOINED`` such sequences are then aligned one after the other, like ones
together, pages of over ``LONG_PAGE`` characters last. A host with more of them has them joined in
rounds: wrappers of ``JOINED`` each, then those wrappers, where alignment may leave two groups for one stretch. Stretches of up to ``_MAX_FOLD`` tokens fold into groups while the wrapper is
read; longer repeats become groups when pages are aligned. Streams longer than ``_MAX_ALIGN`` are aligned in pieces, cut at
signatures that each side has once. Texts of over ``_MAX_KEY`` characters stand in wrappers as digests.

Defined results: null and empty html give an empty text; a null url has the empty host;
null ids and repeated rows get a row each; an empty table gives no rows; extra columns
are ignored.

Scale: a first pass turns pages into folded streams; those of a host with equal signatures are joined in each task, so neither a hot
host nor a page with many copies is a hot group, and what is shuffled grows with the different sequences of hosts. The
wrapper of a host, which grows with them too, is held by one task. Wrappers go to the pages by broadcast when a
count proves them small, else by a join that Spark may split.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, broadcast_checked, materialise, prepare, table

MIN_PAGES = 3
JOINED = 256  # wrappers of a host that are joined at a time
HELD_NODES = 200_000  # of pages that a task joins before it writes them out
MEMO_CHARS = 8_000_000  # of wrappers that a worker keeps parsed
LONG_PAGE = 200_000  # characters; wrappers take in longer pages after all others
_MAX_FOLD = 16  # tokens of the longest stretch that is folded
LIKE = 0.5  # of the places of two optional groups: with fewer in common they stay two
_MAX_KEY = 32  # characters of the longest text that wrappers hold as it is
_MAX_ALIGN = 600  # nodes: longer stretches are cut into pieces before they are aligned

# Element names and the words in class, id and role that mark page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section
    summary table tbody td tfoot th thead title tr ul""".split())
FURNITURE = set("""nav footer aside form script style noscript template button select option textarea input iframe
    svg head title menu dialog object canvas audio video fieldset""".split())
FURNITURE_WORDS = set("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion
    menu nav navbar navigation sidebar footer header masthead cookie cookies consent notice gdpr alert popup modal
    newsletter subscribe subscription comment comments disqus reply replies respond share sharing social related
    recommended breadcrumb breadcrumbs pagination pager login signin signup search widget toolbar skip copyright
    complementary contentinfo dialog alertdialog""".split())
# words that say where or how such a part stands, not what it is
PLAIN_WORDS = set("""site page post entry article main top bottom left right primary secondary list box slot container
    wrapper wrap section block area bar link links button buttons posts articles item items inner outer unit form
    group panel module region zone the to""".split())
TITLE_WORDS = {"header", "masthead"}  # inside an article these hold its title
HOLDERS = {"form", "fieldset"}  # may stand around a whole page
PRINCIPAL_SHARE = 0.3  # of a page's text: an article with less does not make its surroundings content

_TOKEN = re.compile(r"""<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?/][^a-zA-Z][^>]*>|<![^>]*>
    |<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*+)>|(?P<text>[^<]+|<)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z]+|\d+")


def tokens(page: str):
    """``("open", name, marks, void)``, ``("close", name)`` and ``("text", raw)`` in page order."""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            return
        at = m.end()
        if m["text"]:
            yield ("text", m["text"])
        elif m["name"]:
            name = m["name"].lower()
            if m["close"]:
                yield ("close", name)
                continue
            yield ("open", name, _marks(m["attrs"]) if m["attrs"] else "", name in VOID or m["attrs"].endswith("/"))
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
                at = end.start() if end else n


def _marks(attrs: str) -> str:
    """Classes, id and role in lower case; ``hidden`` where the element says so."""
    out = []
    for k, v in _ATTR.findall(attrs):
        k, v = k.lower(), v.strip("\"'").lower()
        if k in ("class", "id", "role", "itemprop"):
            out += v.split()
        elif k == "hidden" or (k == "aria-hidden" and v == "true") or (
                k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v)):
            out.append("hidden")
    return " ".join(out)


_KNOWN_MARKS: dict[str, tuple[bool, bool]] = {}


def _is_furniture_mark(mark: str, inside: bool) -> bool:
    """Whether a class, id or role names page furniture: its words all do, but for plain ones
    (``cookie-notice``, ``post-comments``; not ``related-work`` or ``has-sidebar``)."""
    known = _KNOWN_MARKS.get(mark)
    if known is None:
        words = [w for w in _WORDS.findall(mark) if not w.isdigit()]
        named = [w for w in words if w in FURNITURE_WORDS]
        whole = bool(named) and all(w in FURNITURE_WORDS or w in PLAIN_WORDS for w in words)
        known = (whole, whole and not any(w in TITLE_WORDS for w in named))
        if len(_KNOWN_MARKS) > 100_000:
            _KNOWN_MARKS.clear()
        _KNOWN_MARKS[mark] = known
    return known[1] if inside else known[0]


def _furniture(name: str, marks: str, inside: bool, holds: bool) -> bool:
    """Whether an element is page furniture; ``inside`` an article or main element, or around
    (``holds``) the page's own."""
    if name in FURNITURE and not (holds and name in HOLDERS) or (name == "header" and not inside and not holds):
        return True
    if not marks:
        return False
    parts = marks.split()
    if "hidden" in parts:
        return True
    return not holds and name not in ("html", "body", "article", "main") and not (inside and name == "header") and any(
        _is_furniture_mark(m, inside) for m in parts)


def _is_main(name: str, marks: str) -> bool:
    return name == "main" or marks == "main"


def _is_article(name: str, marks: str) -> bool:
    return name == "article" or "articlebody" in marks


def stream(page: str) -> list[tuple]:
    """The page as (signature, raw text, region, dropped): tags without attributes' values but
    with their marks, texts as ``#``. Region 2: inside an article, 1: inside main, 0: else."""
    parent, names, marked = [0], [""], [""]  # elements in page order; 0 is the page
    items: list[tuple[str, str, int]] = []
    stack = [0]
    for t in tokens(page):
        if t[0] == "text":
            items.append(("#", t[1], stack[-1]))
        elif t[0] == "open":
            _, name, marks, void = t
            if name == "p" or name in BLOCK and name not in ("body", "html"):
                # an open paragraph ends where another block starts
                for k in range(len(stack) - 1, max(0, len(stack) - 6), -1):
                    if names[stack[k]] == "p":
                        del stack[k:]
                        break
                    if names[stack[k]] in BLOCK:
                        break
            items.append((f"<{name} {marks}", "", stack[-1]))
            if not void:
                parent.append(stack[-1])
                names.append(name)
                marked.append(marks)
                stack.append(len(parent) - 1)
        else:
            for k in range(len(stack) - 1, 0, -1):
                if names[stack[k]] == t[1]:
                    del stack[k:]
                    break
            items.append((f"</{t[1]}", "", stack[-1]))
    holds = _holders(parent, names, marked, items)
    region, dropped = [0] * len(parent), [False] * len(parent)
    for e in range(1, len(parent)):
        name, marks, r = names[e], marked[e], region[parent[e]]
        d = dropped[e] = dropped[parent[e]] or _furniture(name, marks, r > 0, holds[e])
        if not d and _is_article(name, marks):
            r = 2
        elif not d and _is_main(name, marks):
            r = max(r, 1)
        region[e] = r
    return [(sig, raw, region[e], dropped[e]) for sig, raw, e in items]


def _holders(parent: list[int], names: list[str], marked: list[str], items: list[tuple]) -> list[bool]:
    """Which elements stand around a main element or the page's principal article (the one with
    the most text, if that is a good part of the page's)."""
    holds = [False] * len(parent)
    of = [0] * len(parent)  # the outermost article around an element
    around = []
    for e in range(1, len(parent)):
        of[e] = of[parent[e]] or (e if _is_article(names[e], marked[e]) else 0)
        if _is_main(names[e], marked[e]):
            around.append(e)
    if any(of):
        size: Counter = Counter()
        for sig, raw, e in items:
            if sig == "#" and names[e] not in RAW:
                size[of[e]] += len(raw)
        article = max((e for e in size if e), key=lambda e: size[e], default=0)
        if article and size[article] >= PRINCIPAL_SHARE * sum(size.values()):
            around.append(article)
    for e in around:
        up = parent[e]
        while up and not holds[up]:
            holds[up] = True
            up = parent[up]
    return holds


def main_text(page: str | None, wrapper: list | None = None) -> str:
    return _text(stream(page), program(wrapper) if wrapper else None) if page else ""


def _text(s: list[tuple], wrapper: list[tuple] | None = None) -> str:
    constant = _run(wrapper, s) if wrapper else None
    best = max((x[2] for x in s if x[0] == "#" and not x[3] and x[1].strip()), default=0)
    blocks, line = [], []

    def end():
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for i, (sig, raw, region, dropped) in enumerate(s):
        if sig == "#":
            if not dropped and region >= best and not (region == 0 and constant and i in constant):
                line.append(raw)
        else:
            name = sig.lstrip("</").split(" ", 1)[0]
            if name in BLOCK:
                end()
            elif name == "br":
                line.append(" ")
    end()
    return "\n".join(blocks)


# --- wrappers: nodes are ["t", signature], ["c", key of a text, the pages that have it], ["s"] (slot),
# --- ["o", nodes] (optional), ["r", nodes] (repeated). Pages are known by a number of their text; of those
# --- that have a text, MIN_PAGES are enough (the smallest), so that stretches may be joined in any order.


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _key(raw: str) -> str:
    """A text as wrappers hold it: white space as one space, long ones by their digest."""
    text = " ".join(raw.split())
    return text if len(text) <= _MAX_KEY else "=" + blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _nodes(s: list[tuple], page: int = 0) -> list:
    out = []
    for sig, raw, _, _ in s:
        if sig != "#":
            out.append(["t", sig])
        elif raw.strip():
            out.append(["c", _key(raw), [page]])
    return out


def _few(a: list[int], b: list[int]) -> list[int]:
    return a if a == b else sorted({*a, *b})[:MIN_PAGES]


def _sig(node) -> str:
    kind = node[0]
    if kind == "t":
        return node[1]
    if kind in "cs":
        return "#"
    return kind + "(" + "|".join(map(_sig, node[1])) + ")"


def _balanced(sigs: list[str]) -> bool:
    depth = 0
    for s in sigs:
        if s.startswith("</"):
            depth -= 1
        elif s.startswith("<") and s[1:].split(" ", 1)[0] not in VOID:
            depth += 1
        if depth < 0:
            return False
    return depth == 0


def _merge_texts(a: list, b: list) -> list:
    """Two stretches of one signature: equal texts stay, others become slots."""
    out = []
    for x, y in zip(a, b):
        if x[0] in "or":
            out.append([x[0], _merge_texts(x[1], y[1])])
        elif x[0] == "t":
            out.append(x)
        elif x[0] == "c" and y[0] == "c" and x[1] == y[1]:
            out.append(["c", x[1], _few(x[2], y[2])])
        else:
            out.append(["s"])
    return out


def fold(nodes: list) -> list:
    """Stretches that follow each other with one signature become repeated groups."""
    sigs = [_sig(x) for x in nodes]
    for size in range(1, _MAX_FOLD + 1):
        starts = {i for i, (x, y) in enumerate(zip(sigs, sigs[size:])) if x == y and x[0] == "<" and x[1] != "/"}
        if not starts:
            continue
        out, out_sigs, i, n = [], [], 0, len(nodes)
        while i < n:
            first, j = sigs[i], i + size
            if i in starts and sigs[j:j + size] == (gs := sigs[i:j]) and _balanced(gs):
                group = nodes[i:j]
                while sigs[j:j + size] == gs:
                    group = _merge_texts(group, nodes[j:j + size])
                    j += size
                out.append(["r", group])
                out_sigs.append("r(" + "|".join(gs) + ")")
                i = j
            else:
                out.append(nodes[i])
                out_sigs.append(first)
                i += 1
        nodes, sigs = out, out_sigs
    return nodes


def _once(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the signatures that both sides have once, as the longest rising run."""
    ca, cb = Counter(a), Counter(b)
    at = {x: j for j, x in enumerate(b) if cb[x] == 1}
    pairs = [(i, at[x]) for i, x in enumerate(a) if ca[x] == 1 and x in at]
    ends, last, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(ends, j)
        back.append(last[p - 1] if p else -1)
        ends[p:p + 1], last[p:p + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (of a, of b) with equal signatures, rising: a longest run of them where both sides
    have at most ``_MAX_ALIGN`` places, else what their pieces give."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        if max(n - i, m - j) > _MAX_ALIGN:
            cuts = _once(a[i:n], b[j:m])
            out.extend((i + x, j + y) for x, y in cuts)
            # without such signatures both sides are cut in the middle
            marks = [(i + x, j + y, 1) for x, y in cuts] or [((i + n) // 2, (j + m) // 2, 0)]
            for x, y, w in marks:
                todo.append((i, x, j, y))
                i, j = x + w, y + w
            todo.append((i, n, j, m))
            continue
        best = [[0] * (m - j + 1) for _ in range(n - i + 1)]
        for x in range(n - i - 1, -1, -1):
            row, below, v = best[x], best[x + 1], a[i + x]
            for y in range(m - j - 1, -1, -1):
                row[y] = below[y + 1] + 1 if v == b[j + y] else max(below[y], row[y + 1])
        x = y = 0
        while x < n - i and y < m - j:
            if a[i + x] == b[j + y]:
                out.append((i + x, j + y))
                x, y = x + 1, y + 1
            elif best[x + 1][y] >= best[x][y + 1]:
                x += 1
            else:
                y += 1
    return sorted(out)


def _places(nodes: list) -> list[str]:
    """Signatures with their element: a text stands in the one opened last, a closing tag goes with its opening one."""
    out, stack = [], []
    for x in nodes:
        sig = _sig(x)
        if sig == "#":
            out.append(f"#{stack[-1]}" if stack else sig)
        elif x[0] != "t":
            out.append(sig)
        elif sig.startswith("</"):
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][1:].split(" ", 1)[0] == sig[2:]), None)
            out.append(sig if k is None else sig + stack[k])
            if k is not None:
                del stack[k:]
        else:
            out.append(sig)
            if sig[1:].split(" ", 1)[0] not in VOID:
                stack.append(sig)
    return out


def align(wrapper: list, page: list) -> list:
    """The wrapper generalised so that it also describes ``page`` (both folded)."""
    a, b = _places(wrapper), _places(page)
    out, i, j = [], 0, 0
    for x, y in [*_pairs(a, b), (len(a), len(b))]:
        if i < x or j < y:
            out.extend(_resolve(wrapper[i:x], page[j:y]))
        if x < len(a):
            out.extend(_merge_texts([wrapper[x]], [page[y]]))
        i, j = x + 1, y + 1
    return out


def _resolve(a: list, b: list) -> list:
    """One mismatch: what describes both sides where one has it, else optional groups; a side that is like
    an optional group of the other joins that group."""
    if a and b:
        for x, y in ((a, b), (b, a)):
            if (both := absorb(x, y)) is not None:
                return both
    out = []
    for x in (a, b):
        for group in ([x] if x and any(v[0] != "o" for v in x) else (v[1] for v in x)):
            k = _like(out, group)
            if k is None:
                out.append(["o", group])
            else:
                both = absorb(out[k][1], group)
                out[k] = ["o", fold(align(out[k][1], group)) if both is None else both]
    return out


def _like(groups: list, nodes: list) -> int | None:
    """The place of the optional group that begins alike and has the most places in common, half of both at least."""
    best, found = LIKE, None
    want, first = Counter(_places(nodes)), _sig(nodes[0])
    for k, x in enumerate(groups):
        if _sig(x[1][0]) != first:
            continue
        have = Counter(_places(x[1]))
        share = 2 * (want & have).total() / (want.total() + have.total())
        if share > best or share == best and found is None:
            best, found = share, k
    return found


def _take(wrapper: list, page: list, at: int) -> tuple[list, int] | None:
    """``wrapper`` with the texts of the nodes of ``page`` from ``at`` on, and the place after those;
    None where it doesn't describe them."""
    out, n = [], len(page)
    for x in wrapper:
        kind = x[0]
        y = page[at] if at < n else None
        if kind == "t":
            if y is None or y[0] != "t" or y[1] != x[1]:
                return None
            out.append(x)
            at += 1
        elif kind == "o":
            if y is not None and y[0] == "o":
                inner = absorb(x[1], y[1])
                if inner is not None:
                    at += 1
                out.append(x if inner is None else ["o", inner])
            else:
                got = _take(x[1], page, at) if y is not None else None
                if got is not None:
                    at = got[1]
                out.append(x if got is None else ["o", got[0]])
        elif kind == "r":
            group, rounds = x[1], 0
            while at < n:
                if page[at][0] == "r" and (inner := absorb(group, page[at][1])) is not None:
                    group, at, rounds = inner, at + 1, rounds + 1
                    continue
                got = _take(group, page, at)
                if got is None or got[1] == at:
                    break
                group, at, rounds = got[0], got[1], rounds + 1
            if not rounds:
                return None
            out.append(["r", group])
        else:
            if y is None or y[0] not in "cs":
                return None
            out.extend(_merge_texts([x], [y]))
            at += 1
    return out, at


def absorb(wrapper: list, page: list) -> list | None:
    """The wrapper with the page's texts, where it describes the page as it is; else None."""
    got = _take(wrapper, page, 0)
    return got[0] if got is not None and got[1] == len(page) else None


def join(streams) -> list | None:
    """The wrapper of folded pages, or of other wrappers, taken one after the other."""
    wrapper = None
    for s in streams:
        if wrapper is None:
            wrapper = s
        else:
            both = absorb(wrapper, s)
            wrapper = fold(align(wrapper, s)) if both is None else both
    return wrapper


def _settled(nodes: list) -> list:
    """A wrapper as pages are matched with it: texts that too few pages have are slots."""
    return [[x[0], _settled(x[1])] if x[0] in "or" else x if x[0] != "c" else
            ["c", x[1], len(x[2])] if len(x[2]) >= MIN_PAGES else ["s"] for x in nodes]


def skeleton(page: str) -> tuple[int, list]:
    """A page as evidence: the number of its sequence of signatures, and (long, wrapper, texts). The upper
    bits are those of the kinds of its tags, so that in the order of numbers like pages stand together."""
    s = stream(page)
    number = _number(_text(s))
    nodes = fold(_nodes(s, number))
    kinds = _number("|".join(sorted({x[0] for x in s}))) >> 48
    return kinds << 48 | _number("|".join(map(_sig, nodes))) & (1 << 48) - 1, [len(page) > LONG_PAGE, nodes, [number]]


def _add(found: dict, key, row: list) -> None:
    """``row`` (long, wrapper, texts) beside the others of ``found``, or with those of its sequence of signatures."""
    x = found.get(key)
    found[key] = [x[0] and row[0], _merge_texts(x[1], row[1]), _few(x[2], row[2])] if x else row


def fit(found: dict[int, list]) -> list:
    """All rows (long, wrapper, texts) of a host as one, long pages last."""
    some = [found[k] for k in sorted(found, key=lambda k: (found[k][0], k))]
    texts: list[int] = []
    for x in some:
        texts = _few(texts, x[2])
    return [all(x[0] for x in some), join(x[1] for x in some), texts]


def infer(pages: list[str]) -> list | None:
    """The wrapper of a host from its pages; None where there are too few. Pages of one
    text (copies, or one article among other adverts and menus) are one piece of evidence."""
    found: dict[int, list] = {}
    for p in pages:
        _add(found, *skeleton(p))
    _, wrapper, texts = fit(found)
    return _settled(wrapper) if len(texts) >= MIN_PAGES else None


def _starts(nodes: list) -> tuple[set, bool]:
    """The signatures that a stretch may begin with, and whether it may be empty."""
    out: set = set()
    for x in nodes:
        if x[0] not in "or":
            out.add(_sig(x))
            return out, False
        first, empty = _starts(x[1])
        out |= first
        if x[0] == "r" and not empty:
            return out, False
    return out, True


def program(wrapper: list) -> list[tuple]:
    """A wrapper as steps: (``o``, starts, the step behind), (``r`` behind its stretch, starts, its first step),
    and (kind, signature, key of a text that is the host's own)."""
    code: list = []

    def put(nodes: list) -> None:
        for x in nodes:
            if x[0] in "or":
                at = len(code)
                first, empty = _starts(x[1])
                if x[0] == "o":
                    code.append(None)
                put(x[1])
                if x[0] == "o":
                    code[at] = ("o", None if empty else first, len(code))
                else:
                    code.append(("r", None if empty else first, at))
            else:
                code.append((x[0], _sig(x), x[1] if x[0] == "c" and x[2] >= MIN_PAGES else None))

    put(wrapper)
    return code


def match(wrapper: list, s: list[tuple]) -> set[int] | None:
    """Places of the page's texts that the wrapper has as constants; None if it doesn't match."""
    return _run(program(wrapper), s)


def _run(code: list[tuple], s: list[tuple]) -> set[int] | None:
    real = [i for i, x in enumerate(s) if x[0] != "#" or x[1].strip()]
    sigs = [s[i][0] for i in real]
    n, end, step, at = len(real), len(code), 0, 0
    constant: list[int] = []
    others: list[tuple[int, int, int]] = []  # to go on with where a choice fails: (step, at, constants)
    seen: set[tuple[int, int]] = set()  # choices made: a second time they would fail again
    while True:
        if step < end:
            kind, a, b = code[step]
            if kind == "o" or kind == "r":
                skip, take = (b, step + 1) if kind == "o" else (step + 1, b)
                if at == n or a is not None and sigs[at] not in a:
                    step = skip
                    continue
                if (step, at) not in seen:
                    seen.add((step, at))
                    others.append((skip, at, len(constant)))
                    step = take
                    continue
            elif at < n and sigs[at] == a:
                if b is not None and _key(s[real[at]][1]) == b:
                    constant.append(real[at])
                step, at = step + 1, at + 1
                continue
        elif at == n:
            return set(constant)
        if not others:
            return None
        step, at, k = others.pop()
        del constant[k:]


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _packed(wrapper: list) -> bytes:
    return zlib.compress(json.dumps(wrapper, separators=(",", ":")).encode("ascii"))


def _skeletons(batches):
    """``host, k, long, wrapper, texts`` of the pages (``host, html``): those of a host with one sequence of
    signatures as one wrapper (``k``: the sequence's number), as far as a task has them at a time."""
    found: dict[tuple, list] = {}
    held = 0

    def rows():
        some = [(h, k, *v) for (h, k), v in found.items()]
        for i in range(0, len(some), ARROW_ROWS):
            host, k, long, nodes, texts = zip(*some[i:i + ARROW_ROWS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(k, pa.int64()), pa.array(long, pa.bool_()),
                 pa.array(map(json.dumps, nodes), pa.string()), pa.array(texts, pa.list_(pa.int64()))],
                names=["host", "k", "long", "wrapper", "texts"])

    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            k, row = skeleton(page)
            held += 0 if (host, k) in found else len(row[1])
            _add(found, (host, k), row)
        if held > HELD_NODES:
            yield from rows()
            found.clear()
            held = 0
    yield from rows()


def _fit(pdf: pd.DataFrame) -> list:
    """:func:`fit` of rows (k, long, wrapper, texts)."""
    found: dict[int, list] = {}
    for k, long, wrapper, texts in zip(pdf["k"], pdf["long"], pdf["wrapper"], pdf["texts"]):
        _add(found, k, [bool(long), json.loads(wrapper), [int(x) for x in texts]])
    return fit(found)


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (packed) of every host with enough pages of different texts, fitted on all of them."""
    schema = "host string, k long, long boolean, wrapper string, texts array<long>"
    some = materialise(pages.where(F.length("html") > 0).select(_host(F.col("url")).alias("host"), "html")
                       .mapInArrow(_skeletons, schema), "skeletons")

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        long, wrapper, texts = _fit(pdf)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "k": pdf["part"].iloc[:1], "long": [long],
                             "wrapper": [json.dumps(wrapper)], "texts": [texts]})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        _, wrapper, texts = _fit(pdf)
        return pd.DataFrame({"host": pdf["host"].iloc[:1],
                             "wrapper": [_packed(_settled(wrapper)) if len(texts) >= MIN_PAGES else None]})

    while True:  # a host's wrappers are joined a few at a time, until few are left
        n = some.groupBy("host").agg(F.count_distinct("k").alias("n"))
        if (n.agg(F.max("n")).first()[0] or 0) <= JOINED:
            break
        n = materialise(n, "skeleton-counts")
        some = materialise(
            some.join(broadcast_checked(n), "host").withColumn("part", F.expr(f"pmod(k, cast(ceil(n / {JOINED}) as long))"))
            .groupBy("host", "part").applyInPandas(part, schema), "joined-wrappers")
    return materialise(some.groupBy("host").applyInPandas(whole, "host string, wrapper binary")
                       .where("wrapper is not null"), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages(page_id, url, html)``."""
    prepare(pages.sparkSession)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = wrappers(pages)
    rows = (pages.withColumn("host", _host(F.col("url"))).join(broadcast_checked(found), "host", "left")
            .select("page_id", "url", "html", "wrapper"))
    schema = rows.select("page_id", "url").schema.add("text", "string")

    def run(batches):
        known: dict[bytes, list[tuple]] = {}
        size = 0
        for b in batches:
            out = []
            for page, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if w is not None and w not in known:
                    chars = zlib.decompress(w)
                    size += len(chars)
                    if size > MEMO_CHARS:
                        known.clear()
                        size = len(chars)
                    known[w] = program(json.loads(chars))
                out.append(_text(stream(page), known[w] if w is not None else None) if page else "")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return rows.mapInArrow(run, schema)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
