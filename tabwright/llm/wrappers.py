"""Main text of web pages by wrappers: one union-free expression per host, inferred from its pages.

A page's token stream is read as nested groups: an element is its signature (tag and telling class
words) around the stream inside. Equal neighbours fold into a repeated group; elements that come again
after others fold with them into a repeated group of optional ones, so each signature stands once in
its stream. Streams of the same host are aligned two at a time: what only one has becomes optional, what both
have in another order becomes a repeated group of optionals, and texts that differ become text slots,
while equal ones stay fixed. The result, written out by ``pattern``, has groups, ``?``, ``+`` and slots but no
alternatives. It carries how much text and linked text each of its elements held on all pages.

From the wrapper come the rules of its host: the main element is the one that a tag or class names as such,
or else the one under which most unlinked slot text gathers; menus, headers, footers, sidebars, notices,
adverts, forms and comments are left out by tag or class, as are lists that are links on nearly all
pages. Texts that are fixed on all of at least ``FIXED_PAGES`` different pages (copies of a page count as one, so a text
keeps digests of as many pages that have it) say nothing of where the main text is, but headings do; inside the main element
everything stays, however many pages say the same.

Each task aligns its own pages before anything is shuffled. Partial wrappers of a host meet in
``SALTS`` groups first and then in one, so a host with a third of all pages is a few small rows there.

Defined results: null or empty html, and pages without text, give an empty text; a url without a host
belongs to the host ""; broken markup is read as browsers would, as far as open elements are closed by
what cannot stand inside them; repeated rows are extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh3_128_hexdigest

from tabwright.llm.tokens import free_name
from tabwright.sources.durable import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 64
FIXED_PAGES = 5
LINKED = 0.8  # share of linked text from which a list is a menu
BROADCAST_BYTES = 32_000_000  # most bytes of rules in a broadcast
SLOT = "#text"

# fixed values of HTML: elements without content, with raw text, that end a paragraph, that are blocks
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript iframe svg math object textarea title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
ENDS_PARAGRAPH = BLOCKS - set("body html caption dd dt li tbody td tfoot th thead tr".split())
CLOSED_BY = {  # an open element: what may not start inside it, and where the search for it stops
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}), "th": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
    "tr": ({"tr", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
# fixed values: tags and class words of what is not the main text
LEFT_OUT_TAGS = RAW | set(
    "nav header footer aside form button select option input label fieldset dialog menu head audio video canvas".split())
LEFT_OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent "
    "notice notices alert popup modal overlay sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs "
    "header masthead footer toolbar pagination pager share sharing social related recommended newsletter subscribe signup "
    "login search comment comments reply replies respond disqus copyright".split())
NEVER_WORDS = set("ad ads advert adverts advertisement advertising sponsored promo related comment comments reply replies respond".split())
MAIN_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WHOLE_TAGS = MAIN_TAGS | HEADINGS | {"html", "body"}  # left out by the plainest words only
MAIN_WORDS = set("article content main post entry story body text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*+>?|<\?[^>]*+>?|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^<]++|<)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
BLANKS = re.compile(r"\s+")


DEEPEST = 300  # levels of elements inside each other
FAR = 1000  # open siblings of that kind among which a closing tag finds its own


class Element:
    __slots__ = ("tag", "words", "inside")

    def __init__(self, tag: str, words: frozenset[str]):
        self.tag, self.words, self.inside = tag, words, []

    @property
    def signature(self) -> str:
        return ".".join([self.tag, *sorted(self.words)])


def _class_words(attributes: str) -> frozenset[str]:
    """Class names without digits, which tell elements of a host apart, and telling words of id and role."""
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        value = unescape(m[2] or m[3] or m[4] or "").lower()
        parts = set(re.split(r"[^a-z]+", value)) & (LEFT_OUT_WORDS | MAIN_WORDS)
        names = {w for w in value.split() if w.isalpha() and len(w) <= 20} if m[1].lower() == "class" else set()
        words |= parts | names
    return frozenset(words)


def read_page(html: str) -> Element:
    """The element tree of a page: elements and texts, without comments and raw-text elements.

    What opens below ``DEEPEST`` levels becomes a sibling, as browsers do beyond a depth of their own; an empty
    element marks where a block of this kind ends. One that is left out keeps what it holds.
    """
    root = Element("", frozenset())
    open_, at = [root], 0
    deep: list[str] = []  # tags of the elements that are open as siblings only
    mark = 0  # those from here on are inside the last element that is open as such
    while match := TOKEN.match(html, at):
        at = match.end()
        closing, tag, attributes, text = match.groups()
        if text is not None:
            open_[-1].inside.append(text)
        elif tag is None:
            continue
        elif closing:
            tag = tag.lower()
            rim = len(open_) > DEEPEST + 1  # inside an element of the last level, which is left out
            near = deep[max(mark if rim else 0, len(deep) - FAR):] if deep else deep
            if rim and tag == open_[-1].tag and tag not in near:
                del open_[-1]
                continue
            if tag in near:
                while deep.pop() != tag:
                    pass
                if tag in BLOCKS:
                    open_[-1].inside.append(Element(tag, frozenset()))
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                if open_[k].tag in ("article", "table", "body") and tag not in BLOCKS:
                    break
        else:
            tag = tag.lower()
            if tag in ENDS_PARAGRAPH:
                _close(open_, {"p"}, {"table", "td", "th", "li", "div", "article", "section", "body", "button", "blockquote"})
            for name, (starts, stops) in CLOSED_BY.items():
                if tag in starts:
                    _close(open_, {name}, stops)
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            element = Element(tag, _class_words(attributes))
            open_[-1].inside.append(element)
            if len(open_) > DEEPEST and tag not in VOID and not attributes.rstrip().endswith("/") and (
                    len(open_) > DEEPEST + 1 or not _left_out(tag, element.words, False)):
                deep.append(tag)
                continue
            mark = len(deep)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                open_.append(element)
            elif tag not in VOID and tag not in BLOCKS:
                open_.append(element)
    return root


def _close(open_: list[Element], tags: set[str], stops: set[str]) -> None:
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag in tags:
            del open_[k:]
            return
        if open_[k].tag in stops:
            return


# --- wrappers: {sig: node}, node = {n: pages, text, linked, value: fixed text or null, pages: least digests of
# --- up to FIXED_PAGES different pages with the fixed text, groups, inside} -------

def _left_out(tag: str, words: set[str] | frozenset[str], holds_main: bool) -> bool:
    """True if nothing inside is main text; a frame around the main element goes by tag or the plainest words only."""
    return tag in LEFT_OUT_TAGS or bool(words & (NEVER_WORDS if tag in WHOLE_TAGS or holds_main else LEFT_OUT_WORDS))


def _fixed_value(text: str) -> str:
    """A text, or a digest of a long one, so that wrappers stay small."""
    return text if len(text) <= 80 else f"#{xxh3_128_hexdigest(text.encode('utf-8', 'surrogatepass'))}"


def _holds_main(element: Element) -> bool:
    return any(isinstance(p, Element) and (p.tag in MAIN_TAGS and not p.words & NEVER_WORDS or _holds_main(p))
               for p in element.inside)


def _wrapper_holds_main(node: dict) -> bool:
    return any(name.split(".")[0] in MAIN_TAGS and not set(name.split(".")[1:]) & NEVER_WORDS or _wrapper_holds_main(inner)
               for name, inner in node["inside"].items())


def _page_digest(element: Element) -> str:
    """Equal for pages with the same elements and texts."""
    parts: list[str] = []

    def walk(element: Element) -> None:
        for part in element.inside:
            if isinstance(part, str):
                parts.append(BLANKS.sub(" ", part))
            else:
                parts.append(f"<{part.signature}>")
                walk(part)
                parts.append("</>")

    walk(element)
    return xxh3_128_hexdigest("".join(parts).encode("utf-8", "surrogatepass"))[:16]


def fold(element: Element, linked: bool = False, page: str | None = None) -> dict:
    """The wrapper of one element's stream; ``page`` is the digest of the whole page, this one if it is not given."""
    page = page or _page_digest(element)
    linked = linked or element.tag == "a"
    order: list[list[str]] = []  # groups of signatures; more than one, or a repeated one, is a repeated group
    repeated: list[bool] = []
    inside: dict[str, dict] = {}
    total = link_total = 0
    for part in element.inside:
        if isinstance(part, str):
            text = BLANKS.sub(" ", unescape(part)).strip()
            if not text:
                continue
            name, node = SLOT, {"n": 1, "text": len(text), "linked": len(text) * linked, "value": _fixed_value(text), "pages": [page], "order": [],
                                "repeated": [], "inside": {}}
        else:
            name, node = part.signature, fold(part, linked, page)
        total, link_total = total + node["text"], link_total + node["linked"]
        if name not in inside:
            inside[name] = node
            order.append([name])
            repeated.append(False)
            continue
        inside[name] = align(inside[name], node, same_page=True)
        at = next(k for k, group in enumerate(order) if name in group)
        order[at:] = [[x for group in order[at:] for x in group]]
        repeated[at:] = [True]
    return {"n": 1, "text": total, "linked": link_total, "value": None, "pages": [], "order": order, "repeated": repeated, "inside": inside}


def align(one: dict, two: dict, same_page: bool = False) -> dict:
    """The wrapper of both streams."""
    inside = {name: dict(node) for name, node in one["inside"].items()}
    for name, node in two["inside"].items():
        inside[name] = align(inside[name], node, same_page) if name in inside else node
    order, repeated = [list(g) for g in one["order"]], list(one["repeated"])
    last = -1
    for group, again in zip(two["order"], two["repeated"]):
        places = [k for k, own in enumerate(order) if set(own) & set(group)]
        fresh = [x for x in group if not any(x in own for own in order)]
        if not places:
            last += 1
            order.insert(last, fresh)
            repeated.insert(last, again)
            continue
        low, high = min(places + ([last] if last > min(places) else [])), max(places + [max(last, 0)] if last > min(places) else places)
        merged = [x for own in order[low:high + 1] for x in own] + fresh
        again = again or any(repeated[low:high + 1]) or high > low
        order[low:high + 1], repeated[low:high + 1] = [merged], [again]
        last = low
    value = one["value"] if one["value"] == two["value"] else None
    return {
        "n": max(one["n"], two["n"]) if same_page else one["n"] + two["n"],
        "text": one["text"] + two["text"], "linked": one["linked"] + two["linked"],
        "value": value, "pages": sorted({*one["pages"], *two["pages"]})[:FIXED_PAGES] if value is not None else [],
        "order": order, "repeated": repeated, "inside": inside,
    }


def pattern(node: dict) -> str:
    """The wrapper as a union-free regular expression over tags, texts and slots."""
    parts = []
    for group, again in zip(node["order"], node["repeated"]):
        texts = []
        for name in group:
            own = node["inside"][name]
            if name == SLOT:
                text = own["value"] if own["value"] is not None else SLOT
            else:
                text = f"<{name}>" if name.split(".")[0] in VOID else f"<{name}>{pattern(own)}</{name}>"
            texts.append(f"({text})?" if own["n"] < node["n"] or len(group) > 1 else text)
        parts.append(f"({''.join(texts)})+" if again else "".join(texts))
    return "".join(parts)


def host_rules(wrapper: dict) -> dict:
    """{"main": path of the main element or null, "named": whether by tag or class, "out": paths of other elements left out}."""
    named, gathered, out = [], [], []

    def walk(node: dict, path: str, signature: str, heading: bool = False) -> int:
        tag, *words = signature.split(".")
        heading = heading or tag in HEADINGS
        if path and _left_out(tag, set(words), _wrapper_holds_main(node)):
            return 0
        if tag in ("ul", "ol", "dl", "table") and node["text"] and node["linked"] > LINKED * node["text"]:
            out.append(path)
            return 0
        own = 0
        for name, inner in node["inside"].items():
            if name == SLOT:
                if heading or inner["value"] is None or len(inner["pages"]) < FIXED_PAGES:
                    own += inner["text"] - inner["linked"]
            else:
                own += walk(inner, f"{path}/{name}", name, heading)
        if tag in MAIN_TAGS or (tag in ("div", "section", "td") and set(words) & MAIN_WORDS):
            named.append((tag in MAIN_TAGS, own, path))
        if tag in ("div", "section", "td", "body", "center", ""):
            gathered.append((own, path))
        return own

    total = walk(wrapper, "", "")
    main = None
    if any(n[0] for n in named):
        # the outermost named elements hold all there is; several at one level are all main text
        main = sorted((p for tagged, own, p in named if tagged and own), key=len)[:1]
    elif named:
        main = [max(named, key=lambda n: (n[1], -len(n[2])))[2]]
    elif total:
        # the deepest element that still gathers nearly all of the text
        main = [max((p for own, p in gathered if own >= 0.7 * total), key=lambda p: p.count("/"), default="")]
    return {"main": main[0] if main else None, "named": bool(named), "out": sorted(out)}


# --- extraction ---------------------------------------------------------------------------------

def page_text(html: str | None, rules: dict) -> str:
    """Blocks of the main element, one space for white space inside, two line feeds between them."""
    if not html:
        return ""
    blocks: list[str] = []
    line: list[str] = []
    out = set(rules["out"])

    def flush():
        text = BLANKS.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            blocks.append(text)

    def walk(element: Element, path: str, within: bool) -> None:
        for part in element.inside:
            if isinstance(part, str):
                if within:
                    line.append(unescape(part))
                continue
            own = f"{path}/{part.signature}"
            main = within or own == rules["main"] or (rules["named"] and part.tag in MAIN_TAGS)
            if part.tag == "br":
                line.append(" ")
            if _left_out(part.tag, part.words, bool(part.words) and _holds_main(part)) or own in out:
                if part.tag in BLOCKS:
                    flush()
                continue
            if part.tag in BLOCKS:
                flush()
            walk(part, own, main)
            if part.tag in BLOCKS:
                flush()

    page = read_page(html)
    walk(page, "", rules["main"] in (None, ""))
    flush()
    if not blocks and rules["main"] not in (None, ""):
        # a page that lacks its host's main element: all that is not left out
        walk(page, "", True)
        flush()
    return "\n\n".join(blocks)


# --- on Spark -----------------------------------------------------------------------------------

def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host and batch."""
    for batch in batches:
        found: dict[str, dict] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if html:
                own = fold(read_page(html))
                found[host] = align(found[host], own) if host in found else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array([json.dumps(w) for w in found.values()], pa.string())],
            names=["host", "wrapper"])


def _aligned(keys: list[str]):
    def merge(table: pa.Table) -> pa.Table:
        texts = sorted(table["wrapper"].to_pylist())
        total = json.loads(texts[0])
        for text in texts[1:]:
            total = align(total, json.loads(text))
        return table.slice(0, 1).select(keys).append_column("wrapper", pa.array([json.dumps(total)]))
    return merge


def infer_wrappers(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """(host, wrapper): the wrapper of each host as JSON."""
    parts = pages.select(F.coalesce(host, F.lit("")).alias("host"), F.col(f"`{html}`").cast("string").alias("html")) \
        .mapInArrow(_partial, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).cast("int"))
    some = salted.groupBy("host", "salt").applyInArrow(_aligned(["host"]), "host string, wrapper string")
    return some.groupBy("host").applyInArrow(_aligned(["host"]), "host string, wrapper string")


@F.arrow_udf(StringType())
def rules_of(wrappers: pa.Array) -> pa.Array:
    return pa.array([json.dumps(host_rules(json.loads(w))) for w in wrappers.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def written_out(wrappers: pa.Array) -> pa.Array:
    return pa.array([pattern(json.loads(w)) for w in wrappers.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def main_text(pages: pa.Array, rules: pa.Array) -> pa.Array:
    """The main text of each page by the rules of its host."""
    known: dict[str | None, dict] = {}
    texts = []
    for html, rule in zip(pages.to_pylist(), rules.to_pylist()):
        if rule not in known:
            known[rule] = json.loads(rule or '{"main": null, "named": false, "out": []}')
        texts.append(page_text(html, known[rule]))
    return pa.array(texts, pa.string())


def extract(pages: DataFrame, host: Column, html: str = "html", into: str = "text") -> DataFrame:
    """The pages with one more last column, their main text, under ``into`` or the next free name."""
    found = materialise(infer_wrappers(pages, host, html).select("host", rules_of(F.col("wrapper")).alias("rules")))
    small = found.agg(F.sum(F.length("host") + F.length("rules"))).first()[0] or 0
    found = found.select(F.col("host").alias("h__"), F.col("rules").alias("rules__"))
    joined = pages.join(F.broadcast(found) if small <= BROADCAST_BYTES else found, F.coalesce(host, F.lit("")) == F.col("h__"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns],
                         main_text(F.col(f"`{html}`").cast("string"), F.col("rules__")).alias(free_name(pages, into)))
