"""Tables, lists and classed elements of raw web pages, as rows.

Well-formed flat markup is cut up by native string functions. Pages on which that could differ from
the element tree (the tag nested in itself, closing tags left out, unknown character references,
broken comments) are sent to a small HTML-parser helper instead: only their text reaches Python, and
both ways give the same rows. ``tree_only`` forces the helper, for tests.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser
from operator import and_

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import list_slice

# Executors need not have this package installed: the helper below travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REST = r"""(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""  # of a tag, after its name; quoted text may hold '>'
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANY_TAG = r"""(?is)</?[a-z!](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
PLAIN_REST = r"""(?=[\s/>])(?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+"""  # the same without '<' and '>' in quotes, up to the '>'
PLAIN_TAG = rf"""(?is)</?[a-z][^\s/>]*+{PLAIN_REST}>|<!doctype[^<>]*+>"""
CLASS = (  # of an opening tag: its attributes one by one, up to the first class
    r"""(?is)^<[a-z][^\s/>]*+(?:[\s/]+(?!class[\s=/>])[^\s=/>"'<]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
    r"""[\s/]+class\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
)

# Character references resolved natively; '&' comes last.
REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&",
}
# Elements that never have content.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}


# --- native side: an item is an array of its text fields ---------------------------------------

def _visible(html: Column) -> Column:
    return F.regexp_replace(html, HIDDEN, "")


def _inner(markup: Column, tag: str) -> Column:
    return F.regexp_extract_all(markup, F.lit(rf"(?is)<{tag}{REST}(.*?)</{tag}\s*>"), 1)


def _stripped(markup: Column) -> Column:
    return F.regexp_replace(markup, ANY_TAG, "")


def _decoded(text: Column) -> Column:
    for ref, char in REFERENCES.items():
        text = F.replace(text, F.lit(ref), F.lit(char))
    return text


def _flat(visible: Column, html: Column, raw: Column, levels: list[str]) -> Column:
    """True if cutting by tags gives what the element tree gives, and all cut text can be decoded.

    No tag may hold markup in its quotes. Elements of each level (outermost first, alternatives joined by
    ``|``) may hold only those of the next, and the innermost only text and elements with only text:
    they are taken out from the inside, and then none of their tags may be left.
    """
    known = "|".join(ref[1:] for ref in REFERENCES)
    strange = rf"&(?!(?:{known}))[A-Za-z#]"
    ok = ~F.regexp_replace(html, rf"{HIDDEN}|{PLAIN_TAG}", "").rlike("<[a-zA-Z/!?]")
    own = "|".join(levels)
    rest = visible
    for level in reversed(levels):
        inline = rf"(?:<(?!(?:{own})[\s/>])([a-z][a-z0-9]*){PLAIN_REST}>[^<]*+</\2\s*>[^<]*+)*+" if level == levels[-1] else ""
        rest = F.regexp_replace(rest, rf"(?is)<({level}){PLAIN_REST}>[^<]*+{inline}</\1\s*>", "")
    ok = ok & ~rest.rlike(rf"(?i)</?(?:{own})[\s/>]")
    return ok & ~F.exists(raw, lambda item: F.exists(item, lambda t: F.coalesce(t, F.lit("")).rlike(strange)))


OPEN = "array<struct<name:string,at:int,kept:boolean>>"
SPANS = "array<struct<at:int,until:int>>"
MOST_TAGS = 5000  # of a page that is folded natively; the fold copies its state at every tag
DOCTYPE = r"(?is)<!doctype[^<>]*+>"
# elements whose text may hold tags that are none, if it does, and script or style that is not closed
TEXT_ONLY = r"(?is)<(title|textarea|xmp|iframe|noembed|noframes)[\s/>][^<]*<(?!/\1[\s/>])|</?(?:script|style|plaintext)[\s/>]"
ONE_TAG = rf"(?is)</?[a-z][^\s/>]*+{PLAIN_REST}>"


def _class_of(tag: Column) -> Column:
    return F.concat(*[F.regexp_extract(tag, CLASS, k) for k in (1, 2, 3)])


def _plain_class(tag: Column) -> Column:
    """No class is given twice or holds a character reference."""
    return ~(_class_of(tag).contains("&") | F.regexp_replace(tag, CLASS, "").rlike(r"(?i)[\s/]class[\s=/>]"))


def _classes_hold(cls: Column, name: str) -> Column:
    return (cls == name) | F.array_contains(F.split(F.trim(cls), r"\s+"), name)


def _element_spans(tags: Column) -> Column:
    """(at, until) of the kept elements in order: the places of the tag that opens each and of the one that ends it.

    One fold over the tags with the stack of open elements. A closing tag ends the nearest open element of its
    name and all inside it; one that closes nothing is skipped; what is open at the end of the page ends there.
    """
    def step(state: Column, tag: Column) -> Column:
        open_, done, at = state["open"], state["done"], state["at"]
        own = F.struct(tag["name"].alias("name"), at.alias("at"), tag["kept"].alias("kept"))
        back = F.array_position(F.reverse(F.transform(open_, lambda o: o["name"])), tag["name"]).cast("int")
        left = F.size(open_) - back
        ended = F.transform(F.filter(F.slice(open_, left + 1, back), lambda o: o["kept"]),
                            lambda o: F.struct(o["at"].alias("at"), at.alias("until")))
        closes = (tag["kind"] == "close") & (back > 0)
        alone = F.when((tag["kind"] == "alone") & tag["kept"], F.array(F.struct(at.alias("at"), at.alias("until"))))
        return F.struct(
            F.when(tag["kind"] == "open", F.concat(open_, F.array(own))).when(closes, F.slice(open_, 1, left)).otherwise(open_).cast(OPEN).alias("open"),
            F.when(closes, F.concat(done, ended)).when(alone.isNotNull(), F.concat(done, alone)).otherwise(done).cast(SPANS).alias("done"),
            (at + 1).alias("at"))

    def finish(state: Column) -> Column:
        rest = F.transform(F.filter(state["open"], lambda o: o["kept"]), lambda o: F.struct(o["at"].alias("at"), state["at"].alias("until")))
        return F.array_sort(F.concat(state["done"], rest).cast(SPANS))

    start = F.struct(F.array().cast(OPEN).alias("open"), F.array().cast(SPANS).alias("done"), F.lit(0).alias("at"))
    return F.aggregate(tags, start, step, finish)


def _nested_native(
    pages: DataFrame, tag: str, cls: str, inner: str | None, within: str | None,
) -> DataFrame:
    """``pages`` (page_id, html) with ``flat``, true where the fold gives what the element tree gives, and ``raw``, its texts."""
    known = "|".join(ref[1:] for ref in REFERENCES)
    df = pages.withColumn("visible", F.regexp_replace(_visible(F.col("html")), DOCTYPE, ""))
    df = df.withColumn("markup", F.regexp_extract_all("visible", F.lit(ONE_TAG), 0))
    ok = ~F.regexp_replace("html", rf"{HIDDEN}|{PLAIN_TAG}", "").rlike("<[a-zA-Z/!?]") & (F.size("markup") <= MOST_TAGS)
    ok = ok & ~F.col("visible").rlike(TEXT_ONLY)
    ok = ok & F.forall("markup", lambda t: (~F.lower(t).contains("class") | _plain_class(t)) & ~t.rlike(r"""=[^\s"'>]*/>$"""))
    df = df.withColumn("flat", F.coalesce(ok, F.lit(False)))
    void = "|".join(sorted(VOID))

    def told(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"(?s)^</?([a-zA-Z][^\s/>]*)", 1))
        alone = t.endswith("/>") | t.rlike(rf"(?i)^<(?:{void})[\s/>]")
        kind = F.when(t.startswith("</"), "close").when(alone, "alone").otherwise("open")
        own = F.when(F.lower(t).contains("class"), _class_of(t)).otherwise("")
        kept = (kind != "close") & ((name == tag) | (_classes_hold(own, within) if within else F.lit(False)))
        return F.struct(name.alias("name"), kind.alias("kind"), own.alias("cls"), kept.alias("kept"))

    df = df.withColumn("tags", F.when(F.col("flat"), F.transform("markup", told)))
    df = df.withColumn("spans", _element_spans(F.col("tags")))
    df = df.withColumn("elements", F.transform("spans", lambda e: F.struct(
        e["at"].alias("at"), e["until"].alias("until"), F.get("tags", e["at"])["name"].alias("name"), F.get("tags", e["at"])["cls"].alias("cls"))))
    mine = F.filter("elements", lambda e: e["name"] == tag)
    if within:
        box = F.get(F.filter("elements", lambda e: _classes_hold(e["cls"], within)), F.lit(0))
        df = df.withColumn("box", box)
        mine = F.filter("elements", lambda e: (e["name"] == tag) & (e["at"] > F.col("box.at")) & (e["at"] < F.col("box.until")))
    picked = F.filter(mine, lambda e: _classes_hold(e["cls"], cls))
    df = df.withColumn("picked", picked)
    if inner is not None:
        same = F.filter("elements", lambda x: (x["name"] == tag) & (F.get(F.split(F.trim(x["cls"]), r"\s+"), F.lit(0)) == inner))
        # a column that a lambda uses is named outside of it too, or it would be computed again for each element
        below = F.flatten(F.transform("picked", lambda e: F.filter("same", lambda x: (x["at"] > e["at"]) & (x["at"] < e["until"]))))
        df = df.withColumn("same", same).withColumn("picked", F.when(F.size("same") > 0, below))
    df = df.withColumn("chunks", F.when(F.col("flat"), F.split("visible", ONE_TAG)))
    cut = F.transform("picked", lambda e: F.slice("chunks", e["at"] + 2, e["until"] - e["at"]))
    df = df.withColumn("cut", F.when(F.size("chunks") > 0, cut))
    strange = F.exists("cut", lambda c: F.exists(c, lambda t: t.rlike(rf"&(?!(?:{known}))[A-Za-z#]")))
    texts = F.transform("cut", lambda c: F.array_join(F.transform(c, _decoded), ""))
    return df.select("page_id", "html", (F.col("flat") & ~F.coalesce(strange, F.lit(False))).alias("flat"),
                     F.transform(F.filter(texts, lambda t: t != ""), lambda t: F.array(t)).alias("raw"))


# --- tree side -------------------------------------------------------------------------------

class _Elements(HTMLParser):
    """Elements in document order; each spans a run of later elements and a run of the text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.text = ""
        self._parts: list[str] = []
        self._length = 0
        self._open: list[dict] = []
        self.feed(html)
        self.close()
        self._end(0)
        self.text = "".join(self._parts)

    def _end(self, depth: int) -> None:
        for e in self._open[depth:]:
            e["until"], e["stop"] = len(self.found), self._length
        del self._open[depth:]

    def handle_starttag(self, tag, attrs):
        e = {"tag": tag, "class": dict(attrs).get("class") or "", "at": len(self.found), "start": self._length}
        self.found.append(e)
        self._open.append(e)
        if tag in VOID:
            self._end(len(self._open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth]["tag"] == tag:
                return self._end(depth)

    def handle_data(self, data):
        if not (self._open and self._open[-1]["tag"] in ("script", "style")):
            self._parts.append(data)
            self._length += len(data)

    def below(self, e: dict | None, tag: str) -> list[dict]:
        inside = self.found if e is None else self.found[e["at"] + 1:e["until"]]
        return [x for x in inside if x["tag"] == tag]

    def content(self, e: dict) -> str:
        return self.text[e["start"]:e["stop"]]


def _has_class(e: dict, name: str) -> bool:
    return name == e["class"] or name in e["class"].split()


def _tree_table(html: str, n: int) -> list[list[str | None]]:
    page = _Elements(html)
    out = []
    for table in page.below(None, "table")[n:n + 1]:
        for row in page.below(table, "tr"):
            cells, heads = page.below(row, "td"), page.below(row, "th")
            if cells:
                out.append([page.content(heads[0]) if heads else None, page.content(cells[0])])
    return out


def _tree_list(html: str, n: int | None) -> list[list[str]]:
    page = _Elements(html)
    within = [None] if n is None else page.below(None, "ul")[n:n + 1]
    return [[page.content(e)] for one in within for e in page.below(one, "li")]


def _tree_class(html: str, tag: str, cls: str, inner: str | None, within: str | None) -> list[list[str]]:
    page = _Elements(html)
    found = page.below(None, tag)
    if within is not None:
        boxes = [e for e in page.found if _has_class(e, within)][:1]
        found = [x for box in boxes for x in page.below(box, tag)]
    out = []
    for e in found:
        if _has_class(e, cls):
            picked = [e] if inner is None else [
                x for x in page.below(e, tag) if x["class"].split()[:1] == [inner]
            ]
            out += [page.content(x) for x in picked]
    return [[t] for t in out if t != ""]


def _tree_udf(extract: Callable[[str], list[list[str | None]]]):
    @F.pandas_udf("array<array<string>>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda html: None if html is None else extract(html))
    return run


def _items(
    pages: DataFrame, html: str, key: str, levels: list[str], native: Callable[[Column], Column] | None,
    tree: Callable[[str], list[list[str | None]]], also: Callable[[Column], Column] = lambda visible: F.lit(True),
) -> DataFrame:
    """(page_id, found): the native items of flat pages and the helper's of all others.

    Each stage is a projection of its own, so that no expression is evaluated twice, and only the
    text of pages that are not flat crosses to Python.
    """
    df = pages.select(F.col(key).alias("page_id"), F.col(html).alias("html"))
    helper = _tree_udf(tree)
    if native is None:
        return df.select("page_id", helper("html").alias("found"))
    df = df.withColumn("visible", _visible(F.col("html"))).withColumn("raw", native(F.col("visible")))
    df = df.withColumn("flat", F.coalesce(_flat(F.col("visible"), F.col("html"), F.col("raw"), levels) & also(F.col("visible")), F.lit(False)))
    df = df.select("page_id", "raw", "flat", helper(F.when(~F.col("flat"), F.col("html"))).alias("tree"))
    decoded = F.transform("raw", lambda item: F.transform(item, _decoded))
    return df.select("page_id", F.when(F.col("flat"), decoded).otherwise(F.col("tree")).alias("found"))


def exploded(items: DataFrame, column: str) -> DataFrame:
    """(page_id, idx, item). The outer form keeps the optimizer from evaluating the items a second time
    in a filter on their number."""
    return items.select("page_id", F.posexplode_outer(column).alias("idx", "item")).filter(F.col("idx").isNotNull())


# --- operators -------------------------------------------------------------------------------

def table_rows(
    pages: DataFrame, n: int = 0, html: str = "html", key: str = "page_id", tree_only: bool = False
) -> DataFrame:
    """(page_id, idx, key, value): first header and first data cell of the n-th table's data rows."""
    def native(visible: Column) -> Column:
        rows = _inner(F.get(_inner(visible, "table"), F.lit(n)), "tr")
        rows = F.filter(rows, lambda r: r.rlike(r"(?i)<td[\s/>]"))
        return F.transform(rows, lambda r: F.array(*[
            _stripped(F.get(_inner(r, cell), F.lit(0))) for cell in ("th", "td")
        ]))
    found = _items(pages, html, key, ["table", "tr", "th|td"], None if tree_only else native, lambda text: _tree_table(text, n))
    return exploded(found, "found").select(
        "page_id", "idx", F.col("item")[0].alias("key"), F.col("item")[1].alias("value"),
    )


def page_lists(
    pages: DataFrame, n: int | None = None, html: str = "html", key: str = "page_id", tree_only: bool = False
) -> DataFrame:
    """(page_id, items): texts of the n-th list's items, or of all list items, as an array."""
    def native(visible: Column) -> Column:
        markup = visible if n is None else F.get(_inner(visible, "ul"), F.lit(n))
        return F.transform(_inner(markup, "li"), lambda item: F.array(_stripped(item)))
    levels = ["li"] if n is None else ["ul", "li"]
    found = _items(pages, html, key, levels, None if tree_only else native, lambda text: _tree_list(text, n))
    return found.select("page_id", F.flatten("found").alias("items"))


def list_items(pages: DataFrame, n: int | None = None, **options) -> DataFrame:
    """(page_id, idx, item): one row per list item; see ``page_lists``."""
    return exploded(page_lists(pages, n, **options), "items")


def by_class(
    pages: DataFrame, tag: str, cls: str, inner: str | None = None, within: str | None = None,
    html: str = "html", key: str = "page_id", tree_only: bool = False,
) -> DataFrame:
    """(page_id, texts): non-empty texts of the elements ``tag`` that have the class ``cls``.

    ``cls`` is one class or the whole attribute. ``inner`` takes, instead of each element, the same
    tag below it whose first class is ``inner``; ``within`` looks only inside the first element of that class. Both need
    the nesting of elements, which a native fold over the page's tags finds; only pages whose tags are odd
    themselves, or more than ``MOST_TAGS``, go to the helper.
    """
    def native(visible: Column) -> Column:
        whole = F.regexp_extract_all(visible, F.lit(rf"(?is)<{tag}{REST}.*?</{tag}\s*>"), 0)
        mine = F.filter(whole, lambda e: _classes_hold(_class_of(e), cls))
        return F.filter(F.transform(mine, lambda e: F.array(_stripped(e))), lambda item: item[0] != "")

    def plain_classes(visible: Column) -> Column:
        opened = F.regexp_extract_all(visible, F.lit(rf"(?is)<{tag}{REST}"), 0)
        return F.forall(opened, _plain_class)

    def tree(text: str) -> list[list[str | None]]:
        return _tree_class(text, tag, cls, inner, within)

    nested = inner is not None or within is not None
    if nested or tree_only:  # a page without these words has no such element: it need not be looked at
        told = [F.col(html).contains(word) | F.col(html).contains("&") for word in {*cls.split(), inner or "", within or ""} if word]
        pages = pages.withColumn(html, F.when(reduce(and_, told, F.lit(True)), F.col(html)).otherwise(F.when(F.col(html).isNotNull(), "")))
    if nested and not tree_only and tag not in ("script", "style"):
        df = _nested_native(pages.select(F.col(key).alias("page_id"), F.col(html).alias("html")), tag, cls, inner, within)
        df = df.select("page_id", "raw", "flat", _tree_udf(tree)(F.when(~F.col("flat"), F.col("html"))).alias("tree"))
        found = df.select("page_id", F.when(F.col("flat"), F.col("raw")).otherwise(F.col("tree")).alias("found"))
    else:
        found = _items(pages, html, key, [tag], None if nested or tree_only else native, tree, plain_classes)
    return found.select("page_id", F.flatten("found").alias("texts"))


def class_items(pages: DataFrame, tag: str, cls: str, **options) -> DataFrame:
    """(page_id, idx, txt): one row per element; see ``by_class``."""
    return exploded(by_class(pages, tag, cls, **options), "texts").withColumnRenamed("item", "txt")


def list_tail(lists: DataFrame, lo: int | None, hi: int | None, items: str = "items") -> DataFrame:
    """The array column cut to ``[lo:hi]``, negatives counting from the end."""
    return lists.withColumn(items, list_slice(F.col(items), lo, hi))
