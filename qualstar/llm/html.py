"""HTML main text by union-free wrappers per host.

*Token streams.*  A page becomes its block tags (name, id and classes with
digits blanked) and text tokens; inline markup belongs to the text around it.

*Wrappers.*  The streams of one host are aligned one after the other.  A
stretch that stands twice in a row becomes a repeated group; what only one side
has becomes optional; texts that differ become slots, texts that never do stay
literals.  The result is a regular expression without alternatives.  Groups
nest at most ``levels`` deep, a group's items lie on lower levels than itself,
and a wrapper of more than ``most_items`` items becomes one repeated group of
its different items, each optional: so alignment ends, and takes bounded time
for a page, whatever orders of blocks a host has.  Every
task aligns the distinct streams of its own pages first, so one small wrapper
per host and task is all that is shuffled, and these are aligned in two steps
(dealt out by a salt first), however many pages a host has.

*Extraction.*  The main text stands in a page's article or main elements; for
the host's pages without any, the wrapper tells the container: the smallest that
holds most of the slots' text of these pages.  A page without that container
gives all its text.  Menus, headers, footers, sidebars, notices, adverts, forms
and comments, known by tag, role or class, are left out.  What a class (or a
form) says is weighed: words of a state (``has-sidebar``, ``nav-open``) say
nothing, articles go only if their whole class is such a word, an element that
holds the only article or main of the page stays unless it is of comments, and
if nothing else is left on a page the largest such part is its text.

Outside article and main elements, literals that stand on ``literal_pages``
pages or more go too if the wrapper has no slot in the element that holds them
(its paragraphs, items and headings counted in): a heading or sentence that all
pages share stays where texts stand beside it.  Pages of the same text outside
left-out parts are copies and count as one.  A page that would have no text
without its literals keeps them.  Repeated rows each get their text.

Null and empty html give an empty text; pages without a host in their URL are
one host.  Character references are decoded, white space in a block is one
blank, blocks are joined by a line break.  The wrappers travel through Spark
and are joined with the pages by host; the texts are read twice and never
shuffled unless that join has to (Spark broadcasts the wrappers' verdicts only
below its size threshold).
"""

from __future__ import annotations

import difflib
import html as _html
import json
import pickle
import re
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin


@dataclass(frozen=True)
class HtmlParams:
    salts: int = 64
    widest_group: int = 24       # items of a repeated group, at its first level
    literal_pages: int = 3
    levels: int = 4              # of groups in groups
    most_items: int = 200        # of a wrapper, all levels together
    main_share: float = 0.7      # of the slots' text that the main container holds


_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S)
_ATTR = re.compile(r"""(?<![\w-])(id|class|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
_BREAK = frozenset(["br", "wbr"])
_VOID = frozenset("area base col embed hr img input link meta param source track".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
#: Elements whose end tag may be left out: a new one ends the one before.
_LOOSE = frozenset("p li dt dd tr td th option".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(["article", "main"])
_ASIDE = frozenset("nav footer aside button select menu dialog head".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
_FORMS = frozenset("form fieldset".split())
_ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar sidebars
 nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe
 subscription signup login share sharing social related recommended search widget widgets toolbar
 pagination pager skip""".split())
_COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies respond".split())
#: Words that make a class say how something is, not what it is.
_STATE_WORDS = frozenset("has no not with without is open opened closed enabled disabled on off layout".split())
#: Words that may stand beside one that tells what an article is.
_PLAIN_WORDS = frozenset("list item box block section area wrapper container body content card inner text".split())
#: How an element is left out: never, unless there is reason not to, always.
_KEPT, _WEAK, _STRONG = 0, 1, 2


def _words(names: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", names)]


def _class_says(token: str, whole: bool) -> int:
    """What one class or id says; ``whole``: all its words must say it."""
    words = set(_words(token))
    known = words & (_ASIDE_WORDS | _COMMENT_WORDS)
    if not known or words & _STATE_WORDS or whole and words - known - _PLAIN_WORDS:
        return _KEPT
    return _STRONG if words & _COMMENT_WORDS else _WEAK


def _label(name: str, attrs: str) -> tuple[str, int]:
    """Label of a block tag, and whether what it holds is no main text."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)} if "=" in attrs else {}
    names = " ".join(v for k, v in found.items() if k != "role").split()
    role = found.get("role", "").lower()
    main = role == "main" or name in _MAIN
    if name in _ASIDE or role in _ASIDE_ROLES:
        aside = _STRONG
    else:
        says = [_class_says(n, main) for n in names] if name not in ("html", "body") else []
        aside = max([_WEAK if name in _FORMS or role == "form" else _KEPT, *says])
    label = ".".join([name, *sorted({re.sub(r"\d+", "0", n) for n in names})])
    return label + ("=main" if main else ""), aside


def tokens(page: str | None):
    """Yields (tag label, None, ()) for block tags, with a leading slash for
    end tags, and (path, text, marks) for runs of text between them: marks are
    (depth, number of the element, aside) of the elements around that may be left out."""
    stack: list[tuple[str, str, tuple]] = []      # name, label, marks
    text: list[str] = []
    at, serial, page = 0, 0, page or ""

    def flush():
        raw = "".join(text)
        text.clear()
        clean = " ".join(_html.unescape(raw).split())
        if clean:
            yield "/".join(s[1] for s in stack), clean, stack[-1][2] if stack else ()

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            text.append(_html.escape(m[0][9:].removesuffix("]]>"), quote=False))
        if not m[2]:
            continue
        name = m[2].lower()
        if name in _RAW and not m[1]:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            text.append(" " if name in ("svg", "math") else "")
            continue
        if name in _INLINE:
            if name in _BREAK:
                text.append(" ")
            continue
        yield from flush()
        if m[1]:
            if any(s[0] == name for s in stack):
                while stack[-1][0] != name:
                    stack.pop()
                label = stack.pop()[1]
                if name not in _LOOSE:
                    yield "/" + label, None, ()
            continue
        if name in _LOOSE:
            group = ("td", "th") if name in ("td", "th") else ("dt", "dd") if name in ("dt", "dd") else (name,)
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in group or stack[k][0] not in _LOOSE | _HEADINGS), -1)
            if depth >= 0 and stack[depth][0] in group:
                del stack[depth:]
        elif stack and stack[-1][0] == "p":
            stack.pop()                      # a paragraph holds no blocks
        label, aside = _label(name, m[3])
        if name == "header":
            aside = _KEPT if any(s[1].endswith("=main") for s in stack) else _STRONG
        yield label, None, ()
        if name not in _VOID and not (m[3].rstrip().endswith("/") and name not in _LOOSE):
            serial += 1
            marks = stack[-1][2] if stack else ()
            stack.append((name, label, (*marks, (len(stack), serial, aside)) if aside else marks))
    yield from flush()


def blocks(page: str | None) -> list[tuple[str, str | None, bool]]:
    """The page's tokens, with whether a text is left out."""
    found = list(tokens(page))
    freed: set[int] = set()

    def aside(marks):
        return any(how == _STRONG or n not in freed for _, n, how in marks)

    if not any(text is not None and not marks and _in_main(path) for path, text, marks in found):
        # The page's main elements all lie in parts that may be left out: those parts are the page.
        for path, text, marks in found:
            if text is not None and marks and _in_main(path):
                depth = next(k for k, part in enumerate(path.split("/")) if part.endswith("=main"))
                around = [x for x in marks if x[0] <= depth]
                if all(how == _WEAK for _, _, how in around):
                    freed.update(n for _, n, _ in around)
    if not any(text is not None and not aside(marks) for _, text, marks in found):
        size: dict[int, int] = {}
        for _, text, marks in found:
            if text is not None and all(how == _WEAK for _, _, how in marks):
                size[marks[0][1]] = size.get(marks[0][1], 0) + len(text)
        if size:
            largest = min(size, key=lambda n: (-size[n], n))
            freed.update(n for _, text, marks in found if text is not None and marks and marks[0][1] == largest for _, n, how in marks if how == _WEAK)
    return [(path, text, text is not None and aside(marks)) for path, text, marks in found]


# A wrapper is a tuple of items (key, optional, load).  Tags have no load; a
# text's load is (its hash, or None for a slot; the smallest hashes of pages that
# have it, none for a slot; characters on pages without article or main; aside);
# that of a repeated group is the wrapper it repeats.  A group's key begins with a
# plus for its level, which is one more than the highest level in it, then has the
# key of its first item that is no group.  So items with one key are of one level,
# and whatever is done to a group's items goes on below its level.

def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


def _in_main(path: str) -> bool:
    return "=main" in path


def stream(page: str | None) -> tuple:
    """The page's own wrapper, before any alignment."""
    found = blocks(page)
    own = [(path, text) for path, text, aside in found if text is not None and not aside]
    # Pages of the same text outside asides are copies, and count as one.
    copy = _hash("\n".join(text for _, text in own))
    plain = not any(_in_main(path) for path, _ in own)
    return tuple((label, False, None) if text is None else ("#" + label, False, (_hash(text), (copy,), len(text) if plain else 0, aside))
                 for label, text, aside in found)


def _level(key: str) -> int:
    return len(key) - len(key.lstrip("+"))


def _group(body: tuple) -> tuple:
    """The repeated group of a wrapper."""
    first = body
    while first[0][0][0] == "+":
        first = first[0][2]
    return "+" * (1 + max(_level(x[0]) for x in body)) + first[0][0], False, body


def _same(a: tuple, b: tuple, p: HtmlParams) -> tuple:
    """One item for two aligned ones.  Of the pages that have a literal the
    smallest ``literal_pages`` hashes stay: enough to count so far in any order."""
    opt, x, y = a[1] or b[1], a[2], b[2]
    if x is None:
        return a[0], opt, None
    if a[0][0] == "+":
        return a[0], opt, x if x == y and not any(z[0][0] in "#+" for z in x) else _align(x, y, p, _level(a[0]) - 1)
    if x[0] is None or x[0] != y[0]:
        return a[0], opt, (None, (), x[2] + y[2], x[3])
    return a[0], opt, (x[0], x[1] if x[1] == y[1] else tuple(sorted({*x[1], *y[1]})[:p.literal_pages]), x[2] + y[2], x[3])


def _balanced(items: tuple) -> bool:
    """Whether the tags of a stretch close each other, so that it may repeat."""
    open_ = []
    for key, _, _ in items:
        if key[0] in "#+":
            continue
        if key[0] == "/":
            if not open_ or open_.pop() != key[1:]:
                return False
        elif key.split(".")[0].removesuffix("=main") not in _LOOSE | _VOID:
            open_.append(key)
    return not open_


def squash(items: tuple, p: HtmlParams = HtmlParams(), top: int | None = None) -> tuple:
    """Make repeated groups, up to level ``top``, of balanced stretches that stand twice in a row."""
    top = p.levels if top is None else top
    width = 1
    while width <= min(p.widest_group, len(items) // 2):
        keys = [x[0] for x in items]
        out, i, found = [], 0, False
        while i < len(items):
            if (keys[i][0] != "/" and keys[i:i + width] == keys[i + width:i + 2 * width] and _balanced(items[i:i + width])
                    and (width == 1 and keys[i][0] == "+" or max(map(_level, keys[i:i + width])) < top)):
                body, j = items[i:i + width], i + width
                while keys[j:j + width] == keys[i:i + width]:
                    body = tuple(_same(x, y, p) for x, y in zip(body, items[j:j + width], strict=True))
                    j += width
                out.append(body[0] if width == 1 and body[0][0][0] == "+" else _group(body))
                i, found = j, True
            else:
                out.append(items[i])
                i += 1
        items = tuple(out)
        width = 1 if found else width + 1
    return bounded(items, p, top)


def _size(items: tuple) -> int:
    return sum(1 + (_size(load) if key[0] == "+" else 0) for key, _, load in items)


def _leaves(items: tuple):
    for item in items:
        if item[0][0] == "+":
            yield from _leaves(item[2])
        else:
            yield item


def bounded(items: tuple, p: HtmlParams, top: int) -> tuple:
    """``items``, or if they are too many the repeated group of their different
    tags and texts, all optional (a plain list of them below the lowest level)."""
    if _size(items) <= p.most_items or len(items) == 1 and _size(items) <= len({x[0] for x in _leaves(items)}) + 1:
        return items
    bag: dict[str, tuple] = {}
    for item in _leaves(items):
        one = (item[0], True, item[2])
        bag[item[0]] = _same(bag[item[0]], one, p) if item[0] in bag else one
    body = tuple(bag.values())
    return (_group(body),) if top else body


def _fold(items: tuple, other: tuple, p: HtmlParams) -> tuple:
    """Take single occurrences of the other side's repeated groups as groups."""
    for key, _, body in (x for x in other if x[0][0] == "+"):
        out, i, place = [], 0, {b[0]: k for k, b in enumerate(body)}
        needed = [k for k, b in enumerate(body) if not b[1]]
        while i < len(items):
            # The longest run from i on that the body allows, in its order.
            j, last, got = i, -1, []
            while j < len(items) and place.get(items[j][0], -1) > last and not any(last < k < place[items[j][0]] for k in needed):
                last = place[items[j][0]]
                got.append(items[j])
                j += 1
            if got and not any(k > last for k in needed):
                if out and out[-1][0] == key:
                    out[-1] = (key, out[-1][1], _align(out[-1][2], tuple(got), p, _level(key) - 1))
                else:
                    out.append((key, False, tuple(got)))
                i = j
            else:
                out.append(items[i])
                i += 1
        items = tuple(out)
    return items


def _align(a: tuple, b: tuple, p: HtmlParams, top: int) -> tuple:
    a, b = _fold(a, b, p), _fold(b, a, p)
    out = []
    for op, i0, i1, j0, j1 in difflib.SequenceMatcher(None, [x[0] for x in a], [x[0] for x in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [_same(x, y, p) for x, y in zip(a[i0:i1], b[j0:j1], strict=True)]
        else:
            out += [(k, True, load) for k, _, load in (*a[i0:i1], *b[j0:j1])]
    return squash(tuple(out), p, top)


def align(a: tuple, b: tuple, p: HtmlParams = HtmlParams()) -> tuple:
    """The wrapper of everything that either wrapper describes."""
    return _align(a, b, p, p.levels) if a or b else a


def expression(wrapper: tuple) -> str:
    """The wrapper as a regular expression over tags and texts, to read."""
    def one(item):
        key, opt, load = item
        if key[0] == "+":
            return f"({expression(load)})" + ("*" if opt else "+")
        s = "#slot" if key[0] == "#" and load[0] is None else "#literal" if key[0] == "#" else f"<{key}>"
        return f"({s})?" if opt else s
    return " ".join(map(one, wrapper))


def _texts(wrapper: tuple):
    for key, _, load in wrapper:
        if key[0] == "+":
            yield from _texts(load)
        elif key[0] == "#":
            yield key[1:], load


def _holder(path: str) -> str:
    """The element around a text that is no paragraph, item, cell or heading."""
    parts = path.split("/")
    while parts and parts[-1].split(".")[0] in _LOOSE | _HEADINGS:
        parts.pop()
    return "/".join(parts)


def verdict(wrapper: tuple, p: HtmlParams) -> dict:
    """{"main": path of the container that holds the main text of the host's
    pages without article and main elements, or None; "literal": path -> hashes
    of the literals there that stand in elements without slots}."""
    found = [(path, load) for path, load in _texts(wrapper) if not load[3]]
    fixed = lambda load: load[0] is not None and len(load[1]) >= p.literal_pages
    size: dict[str, int] = {}
    slots: set[str] = set()
    for path, load in found:
        if not fixed(load):
            parts = _holder(path).split("/")
            for k in range(1, len(parts) + 1):
                c = "/".join(parts[:k])
                slots.add(c)
                if load[2] and parts[k - 1].split(".")[0] not in _LOOSE | _HEADINGS:
                    size[c] = size.get(c, 0) + load[2]
    literal: dict[str, list[int]] = {}
    for path, load in found:
        if fixed(load) and _holder(path) not in slots:
            literal.setdefault(path, []).append(load[0])
    total = sum(load[2] for _, load in found if not fixed(load))
    main = max((c for c, n in size.items() if n >= p.main_share * total), key=lambda c: (c.count("/"), c), default=None)
    return {"main": main, "literal": {path: sorted(set(hashes)) for path, hashes in sorted(literal.items())}}


def main_text(page: str | None, rule: dict | None) -> str:
    """Main text of one page by its host's verdict."""
    rule = rule or {"main": None, "literal": {}}
    every = [(path, text) for path, text, aside in blocks(page) if text is not None and not aside]
    part = [x for x in every if _in_main(x[0])]
    if not part:
        part = [x for x in every if (x[0] + "/").startswith(rule["main"] + "/")] if rule["main"] is not None else []
        own = lambda texts: [x for x in texts if x[0] not in rule["literal"] or _hash(x[1]) not in rule["literal"][x[0]]]
        # A page of literals only has them to say.
        part = own(part) or part or own(every) or every
    return "\n".join(text for _, text in part)


def host_of(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1), F.lit("")))


def _merge(wrappers: list[bytes], p: HtmlParams) -> tuple:
    out = None
    for w in sorted(wrappers):
        w = pickle.loads(w)
        out = w if out is None else align(out, w, p)
    return out


def infer(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """(host, wrapper: pickled) of every host of ``pages(host, html)``."""
    p = params
    kind = "host string, salt int, wrapper binary"

    def own(batches):
        merged: dict[str, dict[tuple, tuple]] = {}
        for pdf in batches:
            for host, page in zip(pdf.host, pdf.html, strict=True):
                w = squash(stream(page), p)
                known = merged.setdefault(host, {})
                shape = tuple(x[0] for x in w)
                # Equal outlines need no search for an alignment.
                known[shape] = tuple(_same(x, y, p) for x, y in zip(known[shape], w, strict=True)) if shape in known else w
        rows = []
        for host, known in merged.items():
            out = None
            for shape in sorted(known):
                out = known[shape] if out is None else align(out, known[shape], p)
            data = pickle.dumps(out)
            rows.append((host, xxhash.xxh32_intdigest(data) % p.salts, data))
        yield pd.DataFrame(rows, columns=["host", "salt", "wrapper"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [pdf.host.iloc[0]], "salt": [0], "wrapper": [pickle.dumps(_merge(list(pdf.wrapper), p))]})

    partial = pages.select("host", "html").mapInPandas(own, kind)
    return partial.groupBy("host", "salt").applyInPandas(join, kind).groupBy("host").applyInPandas(join, kind).select("host", "wrapper")


def extract(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``."""
    @F.pandas_udf("string")
    def judged(wrappers: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(verdict(pickle.loads(w), params)) for w in wrappers], dtype=object)

    @F.pandas_udf("string")
    def texts(htmls: pd.Series, rules: pd.Series) -> pd.Series:
        read = {r: json.loads(r) for r in rules.dropna().unique()}
        return pd.Series([main_text(h, read.get(r)) for h, r in zip(htmls, rules, strict=True)], dtype=object)

    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    rules = pin(infer(rows, params).select("host", judged("wrapper").alias("rule")), "html-rules")
    return (rows.join(rules, "host", "left").select("page_id", "url", texts("html", "rule").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
