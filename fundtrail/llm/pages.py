"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its tags (name, class, id) and its text blocks, each with
the path of elements above it. Over all pages of a host, tokens that share
their occurrence vector (how often they occur on which page) form an
equivalence class. Classes that are frequent and large enough and hold a tag
make up the host's template (text that only copies of an article share has no
tag in its class and stays); the text blocks of the template are the same
everywhere and are no content, inside the article as well as outside.

The template's elements are nested, and the one whose slots hold the article is
chosen by the text that is not of the template: the innermost element that holds
over ``SLOT_SHARE`` of it over all pages of the host. Element names are a hint:
an element for the article needs only ``HINT_SHARE``. Only text inside the
chosen element stays; slots under elements for menus, adverts, forms and the
like go. A page whose text in that element is all of the template keeps it.

Occurrence vectors are never gathered: each is a 64-bit fingerprint, the xor of
a hash of (page, count) over the pages, so classes come from two Spark
aggregates over all pages with map-side combining, however large a host is. A
page then meets its host's template in one join.

Edge cases: a null or empty page, and one without text, gives the empty text; a
null url has the empty host; pages that repeat an id are extracted one by one.
Hosts with fewer than ``MIN_PAGES`` different pages have no template, only the
element rules. Html is never cut.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.urls import with_host_and_path
from fundtrail.session import materialize

MIN_PAGES = 4
MIN_SHARE = 0.6
MIN_CLASS = 3
SLOT_SHARE = 0.5
HINT_SHARE = 0.2
#: Paths whose tokens a task remembers.
PLACES = 1 << 14

# Html element names and the usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea title".split())
DROPPED = RAW | frozenset("head nav footer aside form button select menu dialog fieldset option label".split())
MAIN = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related "
    "share sharing sidebar signup social sponsor sponsored subscribe widget".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
SAME_CLOSES = frozenset("li dt dd tr td th option thead tbody tfoot".split())
SCOPE = frozenset("ul ol dl table tr article main section div body html td th".split())

_SPLIT = re.compile(
    r"(<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>)", re.DOTALL
)
_RAW_OPEN = re.compile(r"<(script|style|noscript|template|iframe|svg|math|object|canvas|audio|video|textarea|title)\b", re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_PARTS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _raw_free(page: str) -> str:
    """The page without comments and without the insides of elements whose content is no markup."""
    out, at = [], 0
    while True:
        m = _RAW_OPEN.search(page, at)
        c = page.find("<!--", at)
        if c >= 0 and (m is None or c < m.start()):
            out.append(page[at:c])
            end = page.find("-->", c + 4)
            if end < 0:
                break
            at = end + 3
            continue
        if m is None:
            out.append(page[at:])
            break
        out.append(page[at : m.start()])
        end = re.compile(rf"</{m.group(1)}\s*>", re.I).search(page, m.end())
        if end is None:
            # never closed: an opening tag alone, unless the rest is program text
            if m.group(1).lower() in ("script", "style"):
                break
            close = page.find(">", m.end())
            at = len(page) if close < 0 else close + 1
            continue
        at = end.end()
    return "".join(out)


class _Element:
    __slots__ = ("name", "key", "dropped", "main")

    def __init__(self, name: str, key: str, dropped: bool, main: bool):
        self.name, self.key, self.dropped, self.main = name, key, dropped, main


def _open(tag: str, name: str, parent: _Element | None) -> _Element:
    labels = " ".join(x.strip("\"'") for x in _LABEL.findall(tag)).lower()
    words = set(_PARTS.findall(labels))
    inside_main = parent is not None and parent.main
    main = inside_main or name in MAIN or "main" in words or "articlebody" in words
    own = name in DROPPED or (name == "header" and not inside_main) or bool(words & FURNITURE and name not in ("body", "html", "article", "main"))
    dropped = own or (parent is not None and parent.dropped)
    key = f"{parent.key if parent else ''}>{name}.{labels}"
    return _Element(name, key, dropped, main and not dropped)


def blocks_of(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(path, text or '' for a tag, dropped, in the main element) in page order.

    Text of neighbouring inline elements is one block.
    """
    stack: list[_Element] = []
    text: list[str] = []
    at: _Element | None = None

    def flush():
        if text:
            joined = _SPACE.sub(" ", html_lib.unescape("".join(text))).strip()
            text.clear()
            if joined:
                yield (at.key if at else "", joined, bool(at and at.dropped), bool(at and at.main))

    for k, piece in enumerate(_SPLIT.split(_raw_free(page))):
        if k % 2 == 0:
            if piece:
                if not text:
                    at = next((e for e in reversed(stack) if e.name not in INLINE), None)
                    if stack and stack[-1].dropped and not (at and at.dropped):
                        at = stack[-1]
                text.append(piece)
            continue
        m = _NAME.match(piece)
        if m is None:
            continue
        name = m.group(1).lower()
        if name in INLINE:
            if name in ("br", "img", "wbr"):
                if name == "br" and text:
                    text.append(" ")
                continue
        else:
            yield from flush()
        if piece[1] == "/":
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break
                if name == "p" and stack[depth].name in SCOPE:
                    break
            continue
        if name in CLOSES_P or name in SAME_CLOSES:
            wanted = "p" if name in CLOSES_P else name
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == wanted:
                    del stack[depth:]
                    break
                if stack[depth].name in SCOPE:
                    break
        element = _open(piece, name, stack[-1] if stack else None)
        if name in INLINE:
            if element.dropped and not (stack and stack[-1].dropped):
                yield from flush()
        else:
            yield (element.key, "", element.dropped, element.main)
        if name not in VOID and not piece.endswith("/>"):
            stack.append(element)
    yield from flush()


def _token(path: str, text: str) -> int:
    """A signed 64-bit hash of a token in its place."""
    value = xxhash.xxh3_64_intdigest(f"{path}\0{text}".encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _above(path: str) -> list[str]:
    """The path and those of the elements above it, outermost first."""
    cuts = [k for k, c in enumerate(path) if c == ">"][1:]
    return [path[:k] for k in cuts] + [path] if path else []


def _places(path: str) -> tuple[int, ...]:
    """The tokens of the path's element and of those above it."""
    return tuple(_token(p, "") for p in _above(path))


def deduce_templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, tokens, slot): the text tokens of each host's template, and its element that holds the article."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a plain dict: a cached module function would have to be importable on the workers
        places: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found: dict[tuple[str, int], list] = {}
            hosts, marks, sources = (batch.column(c).to_pylist() for c in ("host", "mark", "html"))
            for host, mark, source in zip(hosts, marks, sources, strict=True):
                # times, is_text, characters of kept text (in a text, or under an element), depth, hint, elements above a text
                counts: dict[int, list] = {}
                mains: set[str] = set()
                total = 0
                for path, text, dropped, main in blocks_of(source or ""):
                    above = places.get(path)
                    if above is None:
                        if len(places) >= PLACES:
                            places.clear()
                        above = places[path] = _places(path)
                    token = _token(path, text) if text else above[-1]
                    one = counts.get(token)
                    if one is None:
                        one = counts[token] = [0, int(bool(text)), 0, len(above), 0, above if text else None]
                    one[0] += 1
                    if not text and main and path not in mains:
                        one[4] = int(not any(p in mains for p in _above(path)))
                        mains.add(path)
                    if text and not dropped:
                        one[2] += len(text)
                        total += len(text)
                        for element in above:
                            if element in counts:
                                counts[element][2] += len(text)
                counts[0] = [1, 0, total, 0, 0, None]  # every page has the token 0: the host's number of pages
                for token, (n, is_text, chars, depth, hint, under) in counts.items():
                    # the xor of a hash of (page, count)
                    print_ = hash((mark, n, 0x5BD1E995)) & 0x7FFFFFFFFFFFFFFF
                    row = found.setdefault((host, token), [0, 0, 0, is_text, 0, depth, hint, under])
                    row[0] ^= print_
                    row[1] += 1
                    row[2] += n
                    row[4] += chars
            keys, rows = list(found), list(found.values())
            yield pa.RecordBatch.from_pydict(
                {
                    "host": [k[0] for k in keys],
                    "token": pa.array([k[1] for k in keys], pa.int64()),
                    "vector": pa.array([r[0] for r in rows], pa.int64()),
                    "pages": pa.array([r[1] for r in rows], pa.int64()),
                    "times": pa.array([r[2] for r in rows], pa.int64()),
                    "is_text": pa.array([r[3] for r in rows], pa.int32()),
                    "chars": pa.array([r[4] for r in rows], pa.int64()),
                    "depth": pa.array([r[5] for r in rows], pa.int32()),
                    "hint": pa.array([r[6] for r in rows], pa.int32()),
                    "under": pa.array([r[7] for r in rows], pa.list_(pa.int64())),
                }
            )

    source = with_host_and_path(pages, url_col).select(
        "host", F.xxhash64(id_col, html_col).alias("mark"), F.col(html_col).alias("html")
    )
    least = int(MIN_PAGES * MIN_SHARE)
    counted = (
        source.mapInArrow(
            occurrences,
            "host string, token long, vector long, pages long, times long, is_text int, chars long, depth int, hint int, "
            "under array<long>",
        )
        .groupBy("host", "token")
        .agg(
            F.bit_xor("vector").alias("vector"),
            F.sum("pages").alias("pages"),
            F.sum("times").alias("times"),
            F.max("is_text").alias("is_text"),
            F.sum("chars").alias("chars"),
            F.max("depth").alias("depth"),
            F.max("hint").alias("hint"),
            F.first("under").alias("under"),
        )
        .where(f"token = 0 OR pages > {least}")
    )
    # written, as it is read three times below
    tokens = materialize(counted, "page-tokens")
    hosts = tokens.where("token = 0").select("host", F.col("pages").alias("host_pages"))
    frequent = tokens.where("token <> 0").join(hosts, "host").where(
        (F.col("host_pages") >= MIN_PAGES) & (F.col("pages") >= MIN_SHARE * F.col("host_pages"))
    )
    # equal vectors have equal page and occurrence counts too, which guards the fingerprint
    classes = frequent.groupBy("host", "vector", "pages", "times").agg(
        F.count(F.lit(1)).alias("held"), F.min("is_text").alias("texts_only")
    )
    valid = classes.where((F.col("held") >= MIN_CLASS) & (F.col("texts_only") == 0)).select("host", "vector", "pages", "times")
    template = materialize(frequent.join(valid, ["host", "vector", "pages", "times"], "left_semi"), "page-template-tokens")
    texts = template.where("is_text = 1")

    # text under each element that is not of the template
    shared = texts.select("host", F.explode("under").alias("token"), "chars").groupBy("host", "token").agg(F.sum("chars").alias("fixed"))
    fixed = texts.groupBy("host").agg(F.sum("chars").alias("all_fixed"))
    whole = tokens.where("token = 0").join(fixed, "host", "left").select(
        "host", (F.col("chars") - F.coalesce("all_fixed", F.lit(0))).alias("all_own")
    )
    elements = (
        template.where("is_text = 0")
        .join(shared, ["host", "token"], "left")
        .join(whole, "host")
        .withColumn("share", F.try_divide(F.col("chars") - F.coalesce("fixed", F.lit(0)), F.col("all_own")))
        .where((F.col("share") > SLOT_SHARE) | ((F.col("hint") == 1) & (F.col("share") >= HINT_SHARE)))
    )
    slots = elements.groupBy("host").agg(F.max(F.struct("hint", "depth", "share", "token")).alias("best")).select(
        "host", F.col("best.token").alias("slot")
    )
    return texts.groupBy("host").agg(F.collect_set("token").alias("tokens")).join(slots, "host", "full")


def _content(source: str, tokens: list[int] | None, slot: int | None) -> list[str]:
    """The text blocks of a page that are its own, given its host's template."""
    template = frozenset(tokens or ())
    kept = [b for b in blocks_of(source) if b[1] and not b[2]]

    def own(blocks: list) -> list:
        # all of the template: pages that are copies of each other
        return [b for b in blocks if _token(b[0], b[1]) not in template] or blocks

    scope = [b for b in kept if slot in _places(b[0])] if slot is not None else []
    named = [b for b in scope or kept if b[3]]
    if scope:
        found = own(scope)
        # a layout with an element for the article inside the chosen one
        hinted = own(named) if len(named) < len(scope) else found
        if sum(len(b[1]) for b in hinted) >= HINT_SHARE * sum(len(b[1]) for b in found):
            found = hinted or found
    else:
        found = own(named or kept)
    return [b[1] for b in found]


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) per row; blocks joined by an empty line."""
    # written, so that Spark knows its size: a small one is broadcast, a large one meets the pages in a shuffle
    templates = materialize(deduce_templates(pages, id_col, url_col, html_col), "page-templates")
    named = with_host_and_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "url")
    joined = named.join(templates, "host", "left").select("id", "url", "html", "tokens", "slot")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("html", "tokens", "slot")), strict=True)
            out = ["\n\n".join(_content(source or "", tokens, slot)) for source, tokens, slot in rows]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string())], ["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(extract, f"id {kind}, url string, text string").withColumnRenamed("id", id_col)
