"""Main text of web pages through inferred wrappers.

A page becomes a tree of its structural tags with text leaves. A wrapper is a
union-free regular expression over such trees: at every node a sequence of
parts, each of which may be optional, repeated, or a text slot. Wrappers of
one host are aligned child sequence by child sequence: equal neighbours fold
into a repeated group, a part that only one side has becomes optional, texts
that differ become a slot, texts that agree stay constant. A page is itself a
wrapper, so aligning is associative enough to run anywhere: every task aligns
its own pages per host, the partial wrappers meet in salted steps of
bounded groups, and a host with a third of all pages arrives as a few wrappers.

From a host's wrapper come its rules: where the main container lies (the
deepest part that holds most of the slots' text) and which constant texts are
boilerplate: those that SEEN pages of different main text hold, outside the
main container or in a container of it without any slot, and only at their own
path. Every constant carries the keys of such pages, SEEN at most. Parts whose element is ``article`` or ``main`` are the article
where the wrapper has any (single ones before repeated ones, which are teasers
of other articles); else the part with most of the slots' text is. Menus, headers, footers,
side bars, notices, adverts, forms and comments go by element, role, class
and id. Digits in class names count as one, so that numbered classes do not
make a part of their own for every page.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from heapq import nlargest
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, prepare, stored, worker_cache

SALTS = (4096, 64, 1)  # wrappers of a host meet in groups of about 64, step by step
MAX_DEPTH = 100  # deeper elements become neighbours at this depth
MAX_HOSTS = 2000  # a task emits its wrappers and starts anew beyond so many hosts
MAX_CONSTANT = 200  # longer texts are never kept as constants of a wrapper
SEEN = 3  # pages of different main text that must hold a constant; two may be copies
DOMINANT = 0.6  # share of a part's slot text that a child needs to be descended into

# fixed vocabularies
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg annotation annotation-xml textarea title head object canvas audio video select datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot munder mover munderover "
                   "mfenced mspace mstyle mpadded mphantom".split())
DROP_TAGS = frozenset("nav footer aside form button dialog menu".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
DROP_WORDS = frozenset("ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
                       "cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
                       "pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
                       "sponsor sponsored subscribe toolbar widget widgets".split())
ABOUT = frozenset("has with no without is".split())  # class names that tell what is elsewhere
WHOLE = frozenset("html body".split())  # never boilerplate
MAIN_TAGS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOW = HEADINGS | {"p", "blockquote", "pre"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table select article main section div body html nav aside footer header form".split())

# quotes delimit only values: after an equals sign; nothing is given back, so a tag costs its length
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|"
                   r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)>|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "sig", "drop", "kids")

    def __init__(self, tag: str, sig: str = "", drop: bool = False):
        self.tag, self.sig, self.drop, self.kids = tag, sig or tag, drop, []


def names_furniture(names: list[str]) -> bool:
    """Whether class or id names speak of boilerplate ("has-sidebar" and the like do not)."""
    words = [WORD.findall(n) for n in names]
    return any(w and w[0] not in ABOUT and not DROP_WORDS.isdisjoint(w) for w in words)


def describe(tag: str, attributes: str) -> tuple[str, bool]:
    """Signature of an element and whether its attributes call it boilerplate."""
    if not attributes:
        return tag, False
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "").lower().split()
    own = found.get("id", "").lower().split()
    if tag in FLOW:
        own = []  # anchors of headings and paragraphs name their own text
    elif tag == "section":
        own = [i for i in own if WORD.fullmatch(i)]  # "comments", but not the anchor "search-results"
    names += own
    classes = sorted({re.sub("[0-9]+", "0", c) for c in found.get("class", "").lower().split()})
    sig = f"{tag}.{'.'.join(classes)}" if classes else tag
    drop = names_furniture(names) or found.get("role", "").lower() in DROP_ROLES
    drop |= "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return sig, drop and tag not in WHOLE


def parse(html: str) -> Element:
    """A lenient tree of structural elements; text leaves are strings, inline tags vanish.

    Below MAX_DEPTH every text becomes an element of its own beside its
    ancestors at that depth, in page order, and boilerplate stays boilerplate.
    """
    root = Element("#root")
    stack, text, opened = [root], [], Counter()

    def flush():
        if not text:
            return
        block = " ".join("".join(text).split())
        text.clear()
        if not block:
            return
        if len(stack) <= MAX_DEPTH:
            stack[-1].kids.append(block)
            return
        leaf = Element(stack[-1].tag, stack[-1].sig, stack[-1].drop)
        leaf.kids.append(block)
        stack[MAX_DEPTH - 1].kids.append(leaf)

    def close_to(i):
        opened.subtract(e.tag for e in stack[i:])
        del stack[i:]

    at, n, lower, last_end = 0, len(html), None, html.rfind(">")
    while at < n:
        if at > last_end and html[at] == "<":  # no tag can end any more
            text.append(unescape(html[at:]))
            break
        m = TOKEN.match(html, at)
        at = m.end()
        close, tag, attributes, plain = m[1], m[2], m[3], m[4]
        if plain is not None:
            text.append(unescape(plain))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not close and not attributes.endswith("/"):
                lower = html.lower() if lower is None else lower
                if len(lower) != n:  # a character changed length
                    lower = re.sub("[A-Z]+", lambda x: x[0].lower(), html)
                end = lower.find("</" + tag, at)
                if end >= 0:
                    at = html.find(">", end) + 1 or n
                elif tag not in ("head", "object", "canvas"):  # these hold elements, which go on being read
                    at = n
            continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                text.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if close:
            if opened[tag] > 0:
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if stack[-1].tag == "p" or (stack[-1].tag in HEADINGS and tag in HEADINGS):
            close_to(len(stack) - 1)
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    close_to(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        sig, drop = describe(tag, attributes)
        element = Element(tag, sig, drop or tag in DROP_TAGS)
        if len(stack) < MAX_DEPTH:
            stack[-1].kids.append(element)
        else:
            element.drop = element.drop or (len(stack) > MAX_DEPTH and stack[-1].drop) or tag == "header"
        if not attributes.endswith("/"):
            stack.append(element)
            opened[tag] += 1
    flush()
    return root


# -- wrappers: [signature or "#", optional, repeated, parts or constant text, slot characters, keys of a constant's pages] ------


def page_key(root: Element) -> int:
    """Key of a page's main text: its three longest texts outside furniture, the shorter two without digits (copies differ in dates)."""
    texts, todo = [], [root]
    while todo:
        for k in todo.pop().kids:
            if isinstance(k, str):
                texts.append(k)
            elif not k.drop and k.tag != "header":
                todo.append(k)
    longest = nlargest(3, texts, key=lambda t: (len(t), t))
    return zlib.crc32("\n".join(longest[:1] + [re.sub("[0-9]+", "0", t) for t in longest[1:]]).encode("utf-8", "replace"))


def as_wrapper(element: Element, key: int | None = None) -> list:
    key = page_key(element) if key is None else key
    parts = [(["#", 0, 0, k, len(k), [key]] if len(k) <= MAX_CONSTANT else ["#", 0, 0, None, len(k), []]) if isinstance(k, str) else as_wrapper(k, key)
             for k in element.kids]
    return [element.sig, 0, 0, folded(parts), 0]


def folded(parts: list) -> list:
    """Runs of neighbours with one signature become a repeated group."""
    out = []
    for p in parts:
        if out and out[-1][0] == p[0]:
            out[-1] = aligned(out[-1], p)
            out[-1][2] = 1
        else:
            out.append(p)
    return out


def aligned(a: list, b: list) -> list:
    """The wrapper that covers two wrappers of one signature."""
    optional, repeated, chars = a[1] | b[1], a[2] | b[2], a[4] + b[4]
    if a[0] == "#":
        if a[3] is None or a[3] != b[3]:
            return ["#", optional, repeated, None, chars, []]
        return ["#", optional, repeated, a[3], chars, sorted({*a[5], *b[5]})[:SEEN]]
    left, right, parts = a[3], b[3], []
    i = j = 0
    matcher = SequenceMatcher(None, [p[0] for p in left], [p[0] for p in right], autojunk=False)
    for x, y, size in matcher.get_matching_blocks():
        parts += [[p[0], 1, *p[2:]] for p in left[i:x]] + [[p[0], 1, *p[2:]] for p in right[j:y]]
        parts += [aligned(left[x + k], right[y + k]) for k in range(size)]
        i, j = x + size, y + size
    return [a[0], optional, repeated, folded(parts), chars]


def slot_chars(w: list, seen: int = SEEN) -> int:
    """Characters in the slots below a part; constants of ``seen`` different pages are furniture."""
    if w[0] == "#":
        return w[4] if w[3] is None or len(w[5]) < seen else 0
    return sum(slot_chars(k, seen) for k in w[3])


def is_furniture(sig: str) -> bool:
    tag, _, classes = sig.partition(".")
    return tag not in WHOLE and (tag in DROP_TAGS or tag == "header" or names_furniture(classes.split(".")))


def main_parts(w: list, tag: str, path: tuple = ()) -> Iterator[tuple[tuple, list]]:
    """Paths and parts of the topmost parts of a tag outside furniture."""
    for k in w[3]:
        if k[0] != "#":
            own = k[0].partition(".")[0]
            if own == tag:
                if slot_chars(k) and not is_furniture(k[0]):
                    yield (*path, k[0]), k
            elif not is_furniture(k[0]) or any(True for t in MAIN_TAGS for _ in main_parts(k, t)):
                yield from main_parts(k, tag, (*path, k[0]))


def article_paths(w: list, tag: str) -> list[tuple]:
    """Paths of the article's parts: of several, one whose part repeats on pages (teasers of
    other articles) stays only if it has the most text of the host or if none is single."""
    parts: dict[tuple, list] = {}
    for path, part in main_parts(w, tag):
        held = parts.setdefault(path, [0, 0])
        held[0] += slot_chars(part)
        held[1] |= part[2]
    most = max((chars for chars, _ in parts.values()), default=0)
    single = any(not repeated for _, repeated in parts.values())
    return sorted(p for p, (chars, repeated) in parts.items() if not single or not repeated or chars == most)


def dominant_path(w: list, seen: int = SEEN) -> tuple:
    """The deepest part that holds most of the slots' text."""
    path, node = (), w
    while True:
        kids = [k for k in node[3] if k[0] != "#" and not is_furniture(k[0]) and k[0].partition(".")[0] not in FLOW]
        total = sum(slot_chars(k, seen) for k in node[3] if k[0] == "#" or not is_furniture(k[0]))
        best = max(kids, key=lambda k: slot_chars(k, seen), default=None)
        if best is None or not total or best[2] or slot_chars(best, seen) < DOMINANT * total:
            return path
        path = (*path, best[0])
        node = best


def rules_of(w: list, pages: int) -> dict:
    """Paths of the article parts by tag, the dominant path and the boilerplate of a host: constant text -> paths of its parents."""
    paths = {tag: article_paths(w, tag) for tag in MAIN_TAGS}
    dominant = dominant_path(w, SEEN if pages >= SEEN else 1)  # of fewer pages nothing is known to be different
    constants: dict[str, list[str]] = {}

    def collect(part, path, rest):
        """``rest`` is what remains of the dominant path; None lies outside."""
        for k in part[3]:
            if k[0] == "#":
                if rest != () and k[3] is not None and len(k[5]) >= SEEN:
                    constants.setdefault(k[3], []).append("/".join(path))
            elif rest == ():
                collect(k, (*path, k[0]), () if slot_chars(k) or k[0].partition(".")[0] in FLOW else None)
            else:
                collect(k, (*path, k[0]), rest[1:] if rest and k[0] == rest[0] else None)

    collect(w, (), dominant)
    return {"paths": paths, "dominant": dominant, "constants": constants}


# -- extraction --------------------------------------------------------------


def has_main(e: Element) -> bool:
    return any(not isinstance(k, str) and (k.tag in MAIN_TAGS or has_main(k)) for k in e.kids)


def at_path(e: Element, path: list[str] | tuple[str, ...]) -> list[Element]:
    """Elements of a page that a wrapper's path leads to; every level may repeat."""
    found = [e]
    for depth, sig in enumerate(path, 1):
        found = [k for f in found for k in f.kids if not isinstance(k, str) and k.sig == sig and (not k.drop or (depth < len(path) and has_main(k)))]
    return found


def blocks(e: Element, inside: bool, constants: dict, path: tuple = ()) -> Iterator[str]:
    """Text blocks below an element at a path; ``inside`` says that it is (part of) the article."""
    for k in e.kids:
        if isinstance(k, str):
            if inside or k not in constants or "/".join(path) not in constants[k]:
                yield k
        elif k.tag == "header":
            if inside:  # an article's own header: its headings are text
                yield from (b for h in k.kids if not isinstance(h, str) and h.tag in HEADINGS for b in blocks(h, True, constants, path))
        elif not k.drop or (k.tag not in DROP_TAGS and has_main(k)):
            yield from blocks(k, inside, constants, (*path, k.sig))


NO_RULES = {"paths": {tag: [] for tag in MAIN_TAGS}, "dominant": (), "constants": {}}


def extract(html: str, rules: dict) -> str:
    """Text of a page by its host's rules, blocks joined by an empty line."""
    root = parse(html)
    for tag in MAIN_TAGS:
        found = [f for path in rules["paths"][tag] for f in at_path(root, path)]
        if found:
            return "\n\n".join(b for f in found for b in blocks(f, True, {}))
    path = tuple(rules["dominant"])
    while not (nodes := at_path(root, path)):  # the deepest part of the path that the page has; the empty path is the page
        path = path[:-1]
    return "\n\n".join(b for n in nodes for b in blocks(n, False, rules["constants"], path))


def host(url: Column) -> Column:
    """Lower-cased host of a url, "" if it has none: the only place that reads hosts."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")),
                                    r"^[\s\x{85}\x{a0}\x{1c}-\x{1f}]*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


# -- DataFrames --------------------------------------------------------------

PARTIAL = "host string, wrapper string, pages long"
PARTIAL_ARROW = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("pages", pa.int64())])


def page_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) rows -> one wrapper per host of the task."""
    def rows():
        found: dict[str, list] = {}
        for batch in batches:
            for name, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = as_wrapper(parse(html or ""))
                if name in found:
                    w, n = found[name]
                    found[name] = [aligned(w, own), n + 1]
                else:
                    found[name] = [own, 1]
                if len(found) > MAX_HOSTS:
                    yield from ((h, json.dumps(w), n) for h, (w, n) in found.items())
                    found.clear()
        yield from ((h, json.dumps(w), n) for h, (w, n) in found.items())

    yield from in_batches(rows(), PARTIAL_ARROW, size_of=lambda r: len(r[1]))


def joint_wrapper(wrappers: list[str]) -> list:
    w = json.loads(wrappers[0])
    for other in wrappers[1:]:
        w = aligned(w, json.loads(other))
    return w


def merge_group(group: pa.Table) -> pa.Table:
    """Partial wrappers of one host (and salt) -> one."""
    rows = sorted(zip(group.column("wrapper").to_pylist(), group.column("pages").to_pylist()))
    return pa.table({"host": pa.array([group.column("host")[0].as_py()], pa.string()),
                     "wrapper": pa.array([json.dumps(joint_wrapper([w for w, _ in rows]))], pa.string()),
                     "pages": pa.array([sum(n for _, n in rows)], pa.int64())})


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) and pages: the wrapper inferred for each host of (url, html) rows."""
    prepare(pages.sparkSession)
    partial = pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(page_wrappers, PARTIAL)
    for salts in SALTS:
        partial = (partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
                   .groupBy("host", "salt").applyInArrow(merge_group, PARTIAL))
    return partial


def host_rules(inferred: DataFrame) -> DataFrame:
    schema = pa.schema([("rules_host", pa.string()), ("rules", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules = [json.dumps(rules_of(json.loads(w), n)) for w, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, pa.string())], schema=schema)

    return inferred.mapInArrow(task, "rules_host string, rules string")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    Null html is empty and has no text; a null url has the host "". Null and
    repeated page_ids pass through; other columns are not read; an empty
    table gives an empty result.
    """
    prepare(pages.sparkSession)
    rules = stored(host_rules(wrappers(pages)))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache("html rules", dict)
        for batch in batches:
            texts = []
            for html, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if own is not None and own not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[own] = json.loads(own)
                texts.append(extract(html or "", NO_RULES if own is None else known[own]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    joined = rows.withColumn("_host", host(F.col("url"))).join(rules, F.col("_host") == F.col("rules_host"), "left")
    return joined.select("page_id", "url", "html", "rules").mapInArrow(task, "page_id long, url string, text string, n_chars long")
