"""Main text of web pages by consensus of a host's pages.

1. Each page is read as a tree, tolerant of missing ends. Elements that are menus, page
   headers, footers, side bars, notices, adverts, forms, comments or no text at all are
   marked by tag, role or class. What is left is the page's clean text. Each container
   gets a score: the harmonic mean of the share of the clean text it holds, and the share
   of its own text that is clean, where loose text and links count for less.
2. Containers are named by their path of tags and classes, with digits generalised and
   runs of one name taken together. Each page votes for its best one; Spark adds votes
   and scores up by host and path. The path of most votes wins, then that of the higher
   scores, the deeper, the first by name. A host may have several layouts: a path that two
   pages or more vote for wins as well if no other is better on half the pages that have it,
   or if it gets a tenth of its host's votes.
3. Each page is read again: clean text of the elements on one path. A page whose own best
   container is on a winning path takes that. Any other takes the one it scores best of the
   winner of most votes and those of a tenth, unless it has none of them or the score is
   below `CLEARLY_LOWER` of its own best container's; then it takes its own best.

Character references are decoded, white space becomes one space, blocks are joined by one
space in page order. Nothing else is dropped and no length is limited.

Defined cases: a null or empty html gives an empty text. A null or odd url has the empty
host, whose pages have nothing in common and take their own best containers. Every row is
extracted alone, so repeated rows repeat their result; they vote as often as they occur.
Other columns may have any name.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowmart.llm.arrow import bound_batches, text_function, unused
from flowmart.session import Scratch

# Element names of HTML, and names sites give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("body main article section div td center blockquote figure table tbody tr ul ol dl".split())
NO_TEXT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video button select option textarea "
    "input datalist form nav aside footer menu dialog title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
CLUTTER = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidenav aside widget widgets footer "
    "masthead topbar toolbar banner cookie cookies consent gdpr notice notices notification popup modal overlay "
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion newsletter "
    "subscribe subscription signup login social share sharing related recommended recommendations comment comments "
    "commentlist disqus respond reply replies discussion pagination pager search skip".split()
)
#: Words about place and form, which leave a name of clutter one.
FRAMING = frozenset(
    "area articles bar block body bottom box btn button buttons center col column container content float "
    "form global group header heading icon icons inner inline item items label left link links list main message "
    "mobile outer page pane panel post posts primary right row secondary section site slot stories sticky tab "
    "text title top unit wrap wrapper zone".split()
)
HEADERS = frozenset("header heading".split())
HEADER_OF_SITE = frozenset("site page top global main header".split())
UNLESS = frozenset("no not has with without is show hide".split())
NEVER_BY_CLASS = frozenset("html body main".split())
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
#: An end or a start of a block's inside can't close what is around these.
BARRIERS = frozenset("html body table td th article section main div ul ol dl".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.S)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
#: Blocks that hold an article's text; text of other blocks and of links counts less.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th figcaption caption article main".split())
LOOSE_WEIGHT, LINK_WEIGHT = 0.3, 0.2
#: A path of one in so many votes of its host wins; as many at most are offered to its other pages.
PART = 10
#: A page's share of its own best score below which a winner holds but a fragment of it.
CLEARLY_LOWER = 0.3
#: Longer paths go on as a checksum of their beginning.
_PATH = 200


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_clutter(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in NO_TEXT or attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True
    if tag == "header":
        return not inside_article
    if not attributes or tag in NEVER_BY_CLASS:
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = {p.lower() for p in _NAME_PARTS.findall(name) if len(p) > 1}
        if parts & UNLESS:
            continue
        # The whole name must say so: `ad-slot` does, `ad-hoc` and `related-work` are about something.
        if (parts & CLUTTER and parts <= CLUTTER | FRAMING) or (parts & HEADERS and not inside_article and parts <= HEADERS | HEADER_OF_SITE):
            return tag not in INLINE or not parts.isdisjoint(CLUTTER)
    return False


def _step(tag: str, attributes: dict[str, str]) -> str:
    names = sorted(set(attributes.get("class", "").split()))
    mark = f"#{attributes['id']}" if attributes.get("id") else ""
    return _DIGITS.sub("0", ".".join([tag, *names]) + mark)


def _path(above: str, step: str) -> str:
    if above.rpartition(">")[2] == step:
        return above
    if len(above) > _PATH:
        above = f"~{zlib.crc32(above.encode('utf-8', 'replace')):08x}"
    return f"{above}>{step}" if above else step


class _Element:
    __slots__ = ("tag", "path", "clutter", "article", "number")

    def __init__(self, tag: str, path: str, clutter: bool, article: bool, number: int):
        self.tag, self.path, self.clutter, self.article, self.number = tag, path, clutter, article, number


def read_page(page: str) -> Iterator[tuple[str, list[_Element]]]:
    """Pieces of text and the open elements around each, in page order; a block's edge is a space.

    The list is the reader's own and changes when the next piece is read.
    """
    root = _Element("#", "", False, False, 0)
    stack = [root]
    at = numbers = 0
    end = len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if not found:
            yield html.unescape(page[at:]), stack
            return
        if found.start() > at:
            yield html.unescape(page[at : found.start()]), stack
        at = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found[0].startswith("<![CDATA["):
                yield found[0][9:].removesuffix("]]>"), stack
            continue
        tag = tag.lower()
        if tag not in INLINE:
            yield " ", stack
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in BARRIERS and tag not in BARRIERS:
                    break
            continue
        for k in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[k].tag, ()):
                del stack[k:]
                break
            if stack[k].tag in BARRIERS:
                break
        if tag in VOID:
            continue
        top = stack[-1]
        attributes = _attributes(rest) if rest and not rest.isspace() else {}
        numbers += 1
        stack.append(
            _Element(
                tag,
                _path(top.path, _step(tag, attributes)) if tag in CONTAINERS or tag == "html" else top.path,
                top.clutter or _is_clutter(tag, attributes, top.article),
                top.article or tag in ("article", "main"),
                numbers,
            )
        )
        if tag in RAW:
            close = _RAW_ENDS[tag].search(page, at)
            inside = page[at : close.start() if close else end]
            yield html.unescape(inside) if tag in ("title", "textarea") else inside, stack
            at = close.start() if close else end


def _weight(stack: list[_Element]) -> float:
    """How much a piece of text speaks for the containers around it."""
    for element in reversed(stack):
        if element.tag == "a":
            return LINK_WEIGHT
        if element.tag not in INLINE:
            return 1.0 if element.tag in PROSE else LOOSE_WEIGHT
    return LOOSE_WEIGHT


def container_scores(page: str) -> dict[str, float]:
    """Score of each container path of a page."""
    clean_all = 0.0
    clean: dict[str, float] = {}
    total: dict[str, int] = {}
    for text, stack in read_page(page):
        n = sum(map(len, text.split()))
        if not n:
            continue
        good = 0.0 if stack[-1].clutter else _weight(stack)
        clean_all += n * good
        last = ""
        for element in stack:
            if element.path != last:
                last = element.path
                # A raw element's inside is code and no reader's text.
                total[last] = total.get(last, 0) + (0 if stack[-1].tag in RAW else n)
                if good:
                    clean[last] = clean.get(last, 0.0) + n * good
    return {path: 2 * n / (clean_all + max(total[path], n)) for path, n in clean.items()}


def best_container(scores: dict[str, float]) -> str:
    """Path of the highest score; of equals the deeper, then the first by name."""
    return min(scores, key=lambda p: (-scores[p], -p.count(">"), p)) if scores else ""


def main_text(page: str, path: str) -> str:
    """Clean text of the elements on `path`, outermost ones where they are nested."""
    pieces = []
    for text, stack in read_page(page):
        if not stack[-1].clutter and any(e.path == path for e in stack):
            pieces.append(text)
        elif pieces and pieces[-1] != " ":
            pieces.append(" ")
    return " ".join("".join(pieces).split())


def _scored(pages: pa.Array) -> pa.Array:
    paths, scores, best, equal, lengths = [], [], [], [], [0]
    for page in pages.to_pylist():
        found = container_scores(page or "")
        top = best_container(found)
        paths += found
        scores += found.values()
        best += [int(path == top) for path in found]
        equal += [int(score >= found[top]) for score in found.values()]
        lengths.append(len(paths))
    items = pa.StructArray.from_arrays(
        [pa.array(paths, pa.string()), pa.array(scores, pa.float64()), pa.array(best, pa.int32()), pa.array(equal, pa.int32())],
        names=["path", "score", "best", "equal"],
    )
    return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), items)


def chosen_path(scores: dict[str, float], winners: list[str]) -> str:
    """Of a page's containers the best on a winning path, or its own best if that is clearly better."""
    own = best_container(scores)
    listed = best_container({path: scores[path] for path in winners if path in scores})
    return listed if listed and scores[listed] >= CLEARLY_LOWER * scores[own] else own


def _own(pages: pa.Array) -> pa.Array:
    return pa.array([best_container(container_scores(page or "")) for page in pages.to_pylist()], pa.string())


def _extracted(pages: pa.Array, own: pa.Array, wins: pa.Array, winners: pa.Array) -> pa.Array:
    out = []
    for page, path, won, listed in zip(pages.to_pylist(), own.to_pylist(), wins.to_pylist(), winners.to_pylist(), strict=True):
        page = page or ""
        if listed and not won:
            path = chosen_path(container_scores(page), listed)
        out.append(main_text(page, path) if path or page else "")
    return pa.array(out, pa.string())


def host(url):
    """Lower-cased host of a URL column, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, path, listed): each host's winning paths, and whether all its pages may take them."""
    scored = text_function(lambda: _scored, "array<struct<path:string,score:double,best:int,equal:int>>")
    known = pages.select(host(F.col("url")).alias("host"), "html").where(F.col("host") != "")
    votes = known.select("host", F.explode(scored("html")).alias("v"))
    # Scores are added as whole numbers: sums don't depend on the order of rows.
    sums = votes.groupBy("host", F.col("v.path").alias("path")).agg(
        F.sum("v.best").alias("votes"),
        F.sum("v.equal").alias("equal"),
        F.count("*").alias("pages"),
        F.sum(F.round(F.col("v.score") * 1_000_000).cast("bigint")).alias("score"),
    )
    sums = scratch.pin(sums.where(F.col("votes") > 0), "votes")
    depth = F.size(F.split("path", ">"))
    order = F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), (-depth).alias("d"), "path")
    best = sums.groupBy("host").agg(F.min(order)["path"].alias("first"), F.sum("votes").alias("all"))
    first, part = F.col("path") == F.col("first"), PART * F.col("votes") >= F.col("all")
    layout = (F.col("votes") >= 2) & (part | (2 * F.col("equal") >= F.col("pages")))
    return sums.join(best, "host").where(first | layout).select("host", "path", (first | part).alias("listed"))


def extract(pages: DataFrame, name: str = "main_text") -> DataFrame:
    """`pages` with the main text as one more column."""
    spark = pages.sparkSession
    bound_batches(spark)
    with Scratch(spark) as scratch:
        # Written first: small tables of winners are broadcast, large ones are joined by
        # shuffles, where the pages of a host with many are split.
        names = [unused(pages, n) for n in ("_host", "_best", "_host_of_path", "_path", "_host_of_list", "_list")]
        key, best, path_key, path, list_key, listed = names
        winners = scratch.pin(winning_paths(pages, scratch), "winners")
        lists = winners.where("listed").groupBy("host").agg(F.collect_list("path").alias(listed))
        lists = scratch.pin(lists.withColumnRenamed("host", list_key), "lists")
        won = winners.select(F.col("host").alias(path_key), F.col("path").alias(path))
        own, texts = text_function(lambda: _own, "string"), text_function(lambda: _extracted, "string")
        joined = pages.withColumns({key: host(pages.url), best: own("html")})
        joined = joined.join(won, (F.col(key) == F.col(path_key)) & (F.col(best) == F.col(path)), "left")
        joined = joined.join(lists, F.col(key) == F.col(list_key), "left")
        out = joined.withColumn(name, texts("html", best, F.col(path).isNotNull(), listed)).drop(*names)
        scratch.keep("winners")
        scratch.keep("lists")
        return out
