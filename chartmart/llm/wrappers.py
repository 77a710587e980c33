"""HTML extraction by inferring union-free regular expressions (wrappers) from pages of one host.

1. Each page becomes a tree of elements and text slots. Neighbouring siblings with the
   same tag and classes are folded into one repeated group (``x+``).
2. The trees of a host are aligned one after another: equal elements are aligned in order
   and merged, elements that only some pages have become optional (``x?``), and a text
   that is not the same everywhere opens its slot. The result is a wrapper, a
   regular expression without alternatives: sequence, repetition, option, constant, slot.
   Tasks merge the pages they read by host first, so a host that a third of all pages
   share costs each task one tree.
3. A wrapper's slots are sorted into main text and the rest: the main element (``article``,
   ``main``, or the like; else the body) without navigation, adverts, forms, comments and
   their like. A host may mix templates: each test for a main element gives its own slots,
   and each page takes the first test whose elements hold text on it (unless another's
   hold over twice as much, as beside a teaser). On a page without a main element, lists
   whose texts are links on all pages are also left out, and texts of the template: those
   that all pages of a slot hold, if at least three of these pages are different articles,
   that is, any two share less than half of the shorter one's text. Near copies so count
   as one article. All pages that hold the text are looked at: the longest counts, then the
   longest that differs from it, then the longest that differs from both; if there are no
   three, the text is kept.
4. Pages are joined to their host's wrapper (salted by page, so a large host is spread) and
   the texts of main slots are put together in page order.

Character references are decoded; white space in a block becomes one space; blocks are
trimmed and joined by one space. Inline elements do not part words, ``br`` does.

Defined cases: null or empty html gives an empty text; a page without a host belongs to
the host ''; unclosed and stray tags are tolerated, as are pages cut off anywhere (an
unclosed script, style, textarea, title or comment runs to the end; drawings, players,
frames and their like are skipped from their opening to their own closing tag, self-closed
ones are empty, and of unclosed ones only the tag is skipped); repeated rows have equal results; null ids
stay; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as _html
import json
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.session import stage

SALT = 32
_MOST_HOSTS = 5000  # trees that a task holds before it passes them on
_ARTICLES = 3  # different articles that a text must stand in to count as template
_MOST_TEXTS = 100_000  # texts whose longest page a task holds before it passes them on

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)/?>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""", re.I)
_SPACES = re.compile(r"\s+")
# Element names by their part in HTML.
_RAW = {"script", "style", "textarea", "title"}  # hold no elements; unclosed, they run to the end
_SKIPPED = {"noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video"}  # elements beside the text
_ANY_SKIPPED = re.compile(rf"<(?:{'|'.join(sorted(_SKIPPED))})\b", re.I)
_CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in (*_RAW, *_SKIPPED)}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
           "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "article", "section", "main", "div", "body", "html", "aside", "nav", "form", "blockquote"}
_BESIDE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset"}
_BESIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "menu", "nav", "navbar", "navigation",
                 "sidebar", "footer", "cookie", "cookies", "consent", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "comment", "comments",
                 "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "breadcrumb", "breadcrumbs",
                 "pagination", "pager", "widget", "login", "signup", "search", "complementary", "contentinfo", "hidden", "masthead", "topbar", "toolbar", "skip"}
_HEAD_WORDS = {"header", "banner", "masthead"}
_FURNITURE = {"area", "article", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "entry", "form", "global", "group", "icon",
              "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "page", "panel", "post", "posts", "primary", "right",
              "secondary", "section", "site", "slot", "story", "top", "unit", "wrap", "wrapper"}
_ALWAYS_BESIDE = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "head"}
_MAIN = ({"article"}, {"main"})
_MAIN_WORDS = ({"articlebody"}, {"article"}, {"main"}, {"post", "entry", "story"}, {"content"})
_TELLING = set().union(*_MAIN_WORDS)
_DEPTH = 150  # levels of a path


def _tokens(value: str) -> Iterator[tuple[str, bool]]:
    """The names in an attribute, humps as hyphens and without digits; and whether one had digits."""
    for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", value.strip("\"'")).lower().split():
        if words := re.findall(r"[a-z]+", token):
            yield "-".join(words), bool(re.search(r"\d", token))


def _is_beside(token: str) -> bool:
    """Does a name tell what stands beside the text? One of its words has to, and no other may tell of something else."""
    words = set(token.split("-"))
    return bool(words & (_BESIDE_WORDS | _HEAD_WORDS)) and words <= _BESIDE_WORDS | _HEAD_WORDS | _FURNITURE


def _label(tag: str, attributes: str) -> str:
    """Tag and names of its class and role, as the wrapper names an element.

    Of ids, and of names with digits, only those that tell something: others differ from page to page.
    """
    names = set()
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if hidden or name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            names.add("hidden")
        elif name == "itemprop":
            names.update(re.findall(r"[a-z]+", value.lower()))
        elif name != "aria-hidden":
            names.update(t for t, digits in _tokens(value) if not digits and name != "id" or _is_beside(t) or _TELLING & set(t.split("-")))
    return " ".join([tag, *sorted(names)])


def _words(label: list[str]) -> set[str]:
    return {w for token in label[1:] for w in token.split("-")}


def _past_raw(page: str, m: re.Match, tag: str) -> int:
    """Where an element that holds no elements ends, by its opening tag."""
    if m[0].endswith("/>"):
        return m.end()
    stop = _CLOSING[tag].search(page, m.end())
    return stop.end() if stop else len(page)


def _skipped(page: str) -> dict[int, int]:
    """End of each skipped element by the end of its opening tag; self-closed and unclosed ones have none.

    A closing tag belongs to the last open element of its name.
    """
    out: dict[int, int] = {}
    if not _ANY_SKIPPED.search(page):
        return out
    opened: dict[str, list[int]] = {tag: [] for tag in _SKIPPED}
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if tag in _RAW and not m[1]:
            stop = _past_raw(page, m, tag)
            # within a drawing such an element is an ordinary one, and ends with it at the latest
            ends = [end.start() for x in ("svg", "math") if opened[x] and (end := _CLOSING[x].search(page, at))]
            at = at if ends and min(ends) < stop else stop
        elif tag in _SKIPPED:
            if not m[1] and not m[0].endswith("/>"):
                opened[tag].append(at)
            elif m[1] and opened[tag]:
                out[opened[tag].pop()] = at
    return out


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, bool, tuple[int, ...]]]:
    """(path of labels, text, all of it in links, number of each element of the path) of each block, in order."""
    path: list[str] = []
    names: list[str] = []  # tags of the path
    numbers: list[int] = []
    text: list[str] = []
    linked, plain, in_link, at = 0, 0, 0, 0
    skipped = _skipped(page)

    opened: dict[str, int] = {}

    def cut(k: int) -> None:
        for tag in names[k:]:
            opened[tag] -= 1
        del path[k:], names[k:], numbers[k:]

    def end():
        nonlocal linked, plain
        whole = _SPACES.sub(" ", _html.unescape("".join(text))).strip()
        text.clear()
        kind = linked > 0 and not plain
        linked = plain = 0
        return (*_shallow(path, numbers), whole, kind) if whole else None

    def add(piece: str):
        nonlocal linked, plain
        if piece:
            text.append(piece)
            if not piece.isspace():
                linked, plain = (linked + 1, plain) if in_link else (linked, plain + 1)

    while at < len(page):
        m = _TOKEN.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _RAW:
            at = at if m[1] else _past_raw(page, m, tag)
            continue
        if tag in _SKIPPED:
            at = at if m[1] else skipped.get(at, at)
            continue
        if tag in ("br", "hr"):
            text.append(" ")
            continue
        if tag in _INLINE:
            if tag == "a":
                in_link = max(0, in_link + (-1 if m[1] else 1))
            continue
        if found := end():
            yield found[0], found[2], found[3], found[1]
        if tag in _VOID:
            continue
        in_link = 0
        if m[1]:
            for k in range(len(names) - 1, -1, -1) if tag in opened and opened[tag] else ():
                if names[k] == tag:
                    cut(k)
                    break
            continue
        if names and names[-1] == "p":  # a block ends an open paragraph
            cut(len(names) - 1)
        ends = _CLOSES.get(tag, set())
        for k in range(len(names) - 1, -1, -1) if ends else ():
            if names[k] in ends:
                cut(k)
                break
            if names[k] in _SCOPE:
                break
        path.append(_label(tag, m[3]))
        names.append(tag)
        numbers.append(at)  # where it starts
        opened[tag] = opened.get(tag, 0) + 1
    if found := end():
        yield found[0], found[2], found[3], found[1]


def _shallow(path: list[str], numbers: list[int]) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """A path of at most ``_DEPTH`` levels. Of a longer one, levels without a telling label go, the deepest first;
    if it is still longer, those in its middle."""
    if len(path) <= _DEPTH:
        return tuple(path), tuple(numbers)
    telling = [k for k, x in enumerate(path) if " " in x or x in _BESIDE or x in ("article", "main", "header", "body", "html")]
    if len(telling) > _DEPTH:
        kept = telling[: _DEPTH // 2] + telling[-(_DEPTH - _DEPTH // 2) :]
    else:
        have = set(telling)
        plain = (k for k in range(len(path)) if k not in have)
        kept = sorted([*telling, *itertools.islice(plain, _DEPTH - len(telling))])
    return tuple(path[k] for k in kept), tuple(numbers[k] for k in kept)


# A wrapper node is [label, repeated, optional, pages with it, children]; a text slot is ["#", hashes of the texts
# that all its pages hold, open: some page holds another, pages with it, [], some text is not all in links].


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def tree(page: str) -> list:
    root = ["", False, False, 1, []]
    last: tuple[int, ...] = ()
    for path, text, linked, numbers in blocks(page):
        node = root
        for depth, label in enumerate(path):
            if numbers[: depth + 1] != last[: depth + 1] or not node[4]:
                node[4].append([label, False, False, 1, []])
            node = next(x for x in reversed(node[4]) if x[0] == label)
        last = numbers
        node[4].append(["#", [_hash(text)], False, 1, [], not linked])
    return fold(root)


def fold(node: list) -> list:
    """Neighbouring siblings of one label become a repeated group."""
    out: list[list] = []
    for child in node[4]:
        fold(child)
        if out and out[-1][0] == child[0]:
            out[-1] = align(out[-1], child, False)
            if child[0] != "#":
                out[-1][1] = True
        else:
            out.append(child)
    node[4] = out
    return node


def align(a: list, b: list, pages: bool = True) -> list:
    """One node for both: equal children in order are merged, the others are optional."""
    if a[0] == "#":
        if not pages:  # two texts of one page
            return ["#", sorted({*a[1], *b[1]}), a[2] or b[2], a[3], [], a[5] or b[5]]
        return ["#", sorted({*a[1]} & {*b[1]}), a[2] or b[2] or a[1] != b[1], a[3] + b[3], [], a[5] or b[5]]
    left, right = [x[0] for x in a[4]], [x[0] for x in b[4]]
    out = []
    for kind, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [align(x, y, pages) for x, y in zip(a[4][i:j], b[4][k:m])]
        else:
            for x in a[4][i:j] + b[4][k:m]:
                x[2] = x[2] if x[0] == "#" else True
                out.append(x)
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] + b[3] if pages else a[3], out]


def _beside(label: str, inside: bool) -> bool:
    names = label.split(" ")
    if names[0] in _BESIDE or not inside and names[0] == "header":
        return True
    if names[0] in ("body", "html", "article", "main"):
        return False  # names of the whole page say nothing
    # within the text, its head is part of it
    return any(_is_beside(t) and not (inside and set(t.split("-")) & _HEAD_WORDS) for t in names[1:])


def _find(node: list, wanted, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the outermost elements that are wanted, outside of what stands beside the text."""
    out = []
    for child in node[4]:
        if child[0] == "#" or _beside(child[0], False):
            continue
        at = (*path, child[0])
        out += [at] if wanted(child[0].split(" ")) else _find(child, wanted, at)
    return out


#: What makes an element the main one, the surest first; by the label's tag and names.
_TESTS = [lambda x, s=s: x[0] in s for s in _MAIN] + [lambda x, s=s: bool(_words(x) & s) for s in _MAIN_WORDS]


def main_slots(wrapper: list) -> dict:
    """Slots of the main text: ``levels``, those below a main element by each test that finds one, in order; and
    ``body``, for pages without any, with the texts that may be template: [path, hashes]."""
    levels = []
    for test in _TESTS:
        if mains := set(_find(wrapper, test)):
            levels.append(sorted(_slots(wrapper, mains)))
    body = [[k, sorted(shared)] for k, (shared, plain) in sorted(_slots(wrapper, None).items()) if plain or not {"ul", "ol"} & {x.split(" ")[0] for x in k}]
    return {"levels": levels, "body": body}


def _slots(wrapper: list, mains: set | None) -> dict[tuple[str, ...], tuple[set[int], bool]]:
    """Slots below ``mains``, or of the body, without what stands beside the text; the texts that all pages of each
    hold, and whether some text is not all in links."""
    out: dict[tuple[str, ...], tuple[set[int], bool]] = {}

    def walk(node: list, path: tuple[str, ...], inside: bool) -> None:
        for child in node[4]:
            if child[0] == "#":
                if inside:
                    shared, plain = out.get(path, (set(), False))
                    out[path] = shared.union(child[1] if child[3] >= _ARTICLES else ()), plain or child[5]
            elif not _beside(child[0], inside and mains is not None):
                at = (*path, child[0])
                walk(child, at, inside or at in mains)

    walk(wrapper, (), mains is None)
    return out


class Slots:
    """A host's slots as ``main_slots`` gives them, and its template texts: [number of body slot, hash]."""

    def __init__(self, given: str, template: str | None):
        own = json.loads(given)
        self.levels = [set(map(tuple, x)) for x in own["levels"]]
        self.body = {tuple(path): k for k, (path, _) in enumerate(own["body"])}
        self.shared = {(k, h) for k, (_, hashes) in enumerate(own["body"]) for h in hashes}
        self.template = set(map(tuple, json.loads(template or "[]")))

    def parts(self, page: str) -> tuple[list[str] | None, list[tuple[int, str]]]:
        """Texts of the page's main element, if it has one; else [number of body slot, text] of the page.

        The first test whose elements hold text on this page decides, unless another's hold over twice as much, as
        beside a teaser. If none does, main elements count that stand in a form, or in an element whose names tell that it
        is beside the text, where that holds half of the page's text or more.
        """
        all_ = list(blocks(page))
        own = [(path, text) for path, text, _, _ in all_]
        found = [[text for path, text in own if path in level] for level in self.levels]
        sizes = [sum(map(len, x)) for x in found]
        for texts, n in zip(found, sizes):
            if n and 2 * n >= max(sizes):
                return texts, []
        if texts := _wrapped(all_):
            return texts, []
        return None, [(self.body[path], text) for path, text in own if path in self.body]


def _wrapped(own: list[tuple]) -> list[str]:
    """Texts of the main elements of a page, wherever they stand but in what is always beside the text or a small part of the page."""
    held: Counter[int] = Counter()
    for _, text, _, numbers in own:
        for number in numbers:
            held[number] += len(text)
    total = sum(len(text) for _, text, _, _ in own)
    passes = lambda label, number: label.split(" ", 1)[0] not in _ALWAYS_BESIDE and 2 * held[number] >= total
    found: list[list[str]] = []
    for test in _TESTS:
        texts = []
        for path, text, _, numbers in own:
            inside = False
            for label, number in zip(path, numbers):
                if _beside(label, inside) and (inside or not passes(label, number)):
                    break
                inside = inside or test(label.split(" "))
            else:
                if inside:
                    texts.append(text)
        found.append(texts)
    most = max(sum(map(len, x)) for x in found)
    return next((x for x in found if x and 2 * sum(map(len, x)) >= most), [])


def main_text(page: str, slots: Slots) -> str:
    """The texts of a page that stand in main slots, in page order."""
    main, body = slots.parts(page)
    return " ".join(main if main is not None else [text for k, text in body if (k, _hash(text)) not in slots.template])


def articles(pages: DataFrame) -> DataFrame:
    """``_host, digest, less, page`` of each page with texts of ``_html`` that ``slots`` of the host say may be template:
    minus its length, its texts as {hash: length}, and which of them may be template, as [number of body slot, hash]."""

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slots] = {}
        for batch in batches:
            rows = []
            for host, page, given in zip(*(batch.column(c).to_pylist() for c in ("_host", "_html", "slots"))):
                if host not in known:
                    if len(known) > _MOST_HOSTS:
                        known.clear()
                    known[host] = Slots(given, None)
                texts = [(k, _hash(text), len(text)) for k, text in known[host].parts(page)[1]]
                if shared := sorted({(k, h) for k, h, _ in texts} & known[host].shared):
                    own: Counter[int] = Counter()
                    for _, h, n in texts:
                        own[h] += n
                    whole = json.dumps([own, shared], sort_keys=True)
                    rows.append((host, hashlib.sha256(whole.encode()).hexdigest(), -own.total(), whole))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()))],
                                             ["_host", "digest", "less", "page"])

    return pages.select("_host", "_html", "slots").mapInArrow(record, "_host string, digest string, less long, page string")


def _longest(pages: DataFrame) -> DataFrame:
    """``_host, k, h, digest``: for each text that may be template the longest page with it that differs from those ``chosen``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict, dict]] = {}
        held: dict[tuple, tuple[int, str]] = {}

        def send() -> pa.RecordBatch:
            columns = list(zip(*[(*key, *page) for key, page in held.items()])) or [()] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["_host", "k", "h", "less", "digest"])

        for batch in batches:
            for host, digest, less, page, chosen in zip(*(batch.column(c).to_pylist() for c in ("_host", "digest", "less", "page", "chosen"))):
                own, shared = json.loads(page)
                if chosen is not None and host not in known:
                    if len(known) > _MOST_HOSTS:
                        known.clear()
                    found = json.loads(chosen)
                    known[host] = {(x["k"], x["h"]): x["digests"] for x in found["texts"]}, {x["digest"]: json.loads(x["page"])[0].keys() for x in found["pages"]}
                texts, others = known.get(host, ({}, {})) if chosen is not None else ({}, {})
                near: dict[str, bool] = {}  # pages that this one shares half of its text with
                for k, h in shared:
                    if chosen is not None:
                        if (k, h) not in texts:
                            continue
                        for other in texts[k, h]:
                            if other not in near:
                                near[other] = 2 * sum(own[x] for x in own.keys() & others[other]) >= -less
                        if any(near[other] for other in texts[k, h]):
                            continue
                    if (host, k, h) not in held or (less, digest) < held[host, k, h]:
                        held[host, k, h] = less, digest
            if len(held) > _MOST_TEXTS:
                yield send()
                held.clear()
        yield send()

    sent = pages.select("_host", "digest", "less", "page", "chosen").mapInArrow(find, "_host string, k long, h long, less long, digest string")
    return sent.groupBy("_host", "k", "h").agg(F.min(F.struct("less", "digest"))["digest"].alias("digest"))


def templates(pages: DataFrame, salt: int = 1) -> DataFrame:
    """``_host, template``: the texts of ``_html`` that ``slots`` of the host say may be template, and that stand in
    enough different articles. A host's pages are spread over ``salt`` parts."""
    rows = stage(articles(pages), "articles")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("digest"), F.lit(salt)).cast("int"))
    texts = stage(_longest(rows.withColumn("chosen", F.lit(None).cast("string"))).select("_host", "k", "h", F.array("digest").alias("digests")), "longest")
    for _ in range(_ARTICLES - 1):
        digests = texts.select("_host", F.explode("digests").alias("digest")).distinct()
        # no more pages of a host than its texts that may be template, times those chosen for each
        others = rows.join(digests, ["_host", "digest"], "left_semi").dropDuplicates(["_host", "digest"])
        chosen = texts.groupBy("_host").agg(F.collect_list(F.struct("k", "h", "digests")).alias("texts")).join(
            others.groupBy("_host").agg(F.collect_list(F.struct("digest", "page")).alias("pages")), "_host")
        chosen = stage(chosen.select("_host", F.to_json(F.struct("texts", "pages")).alias("chosen")), "chosen")
        spread = chosen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        found = _longest(salted.join(spread, ["_host", "_salt"]))
        texts = stage(texts.join(found, ["_host", "k", "h"]).select("_host", "k", "h", F.concat("digests", F.array("digest")).alias("digests")), "longest")
    return texts.groupBy("_host").agg(F.to_json(F.sort_array(F.collect_list(F.array("k", "h")))).alias("template"))


def expression(node: list) -> str:
    """The wrapper as text: ``label(children)``, ``+`` repeated, ``?`` optional, ``#`` open slot, ``=`` constant."""
    if node[0] == "#":
        return "#" if node[2] else "="
    return f"{node[0]}({' '.join(expression(x) for x in node[4])}){'+' if node[1] else ''}{'?' if node[2] else ''}"


def infer(pages: DataFrame) -> DataFrame:
    """``_host, expression, slots, shared``: each host's wrapper, its main slots, and whether any text may be template."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, list] = {}

        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(trees), pa.string()), pa.array([json.dumps(t) for t in trees.values()], pa.string())], ["_host", "tree"])

        for batch in batches:
            for host, page in zip(batch.column("_host").to_pylist(), batch.column("_html").to_pylist()):
                own = tree(page)
                trees[host] = align(trees[host], own) if host in trees else own
            if len(trees) >= _MOST_HOSTS:
                yield send()
                trees.clear()
        yield send()

    def finish(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for t in sorted(own["tree"]):
            whole = json.loads(t) if whole is None else align(whole, json.loads(t))
        slots = main_slots(whole)
        return pd.DataFrame({"_host": [key[0]], "expression": [expression(whole)], "slots": [json.dumps(slots)], "shared": [any(h for _, h in slots["body"])]})

    sent = pages.select("_host", "_html").mapInArrow(merge, "_host string, tree string")
    return sent.groupBy("_host").applyInPandas(finish, "_host string, expression string, slots string, shared boolean")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", salt: int = SALT) -> DataFrame:
    """``page_id, url, text`` of every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("_host"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "_html"), F.lit(salt)).cast("int"))

    def joined(hosts: DataFrame) -> DataFrame:
        return salted.join(hosts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))), ["_host", "_salt"])

    wrappers = stage(infer(rows), "wrappers").select("_host", "slots", "shared")
    hosts = wrappers.where("shared").select("_host", "slots")
    if hosts.isEmpty():
        hosts = wrappers.select("_host", "slots", F.lit(None).cast("string").alias("template"))
    else:
        hosts = wrappers.drop("shared").join(stage(templates(joined(hosts), salt), "templates"), "_host", "left")

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple, Slots] = {}
        for pages_, slots, template in batches:
            out = []
            for page, *given in zip(pages_, slots, template):
                given = tuple(given)
                if given not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[given] = Slots(*given)
                out.append(main_text(page, known[given]))
            yield pd.Series(out, dtype="object")

    # every page's host has a wrapper, as hosts are taken from all pages
    return joined(hosts).select("page_id", "url", cut("_html", "slots", "template").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
