"""Main text of web pages by site template removal.

Each page is parsed once, forgivingly. Every container element gets a hash of its subtree; Spark counts per
host on how many pages of different content a hash occurs, and subtrees that recur on many of them are deleted.
Copies of a page count as one, so no copied text is a template of its copies.
Of what is left the article is taken (else `main`, else the body), without elements that are never main text:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments.
Inside an article only sectioning containers outside the prose can be a template, lists and tables only as a whole and if
they are mostly links: paragraphs, headings, items and cells that authors repeat (a licence line, "Yes") are text and stay.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A subtree is a template if it is on at least this share of a host's pages, and on at least LEAST_PAGES.
SHARE = 0.3
LEAST_PAGES = 3

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math object textarea select option title xmp noembed noframes canvas video audio".split())
#: Elements that hold raw text: nothing in them is markup.
_OPAQUE = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Their ends are searched in the page itself: lower() moves positions where a letter becomes two.
_ENDS = {name: re.compile(f"</{name}", re.I | re.ASCII) for name in _OPAQUE}
_NEVER = _RAW | frozenset("head nav header footer aside form menu dialog button fieldset".split())
#: Of these, and of marked elements, one that encloses the main element is no reason to skip it.
_SOFT = frozenset("header form fieldset".split())
_BLOCKS = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside dialog menu".split())
#: Elements of prose: in an article neither they nor what is inside of them is a template.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd tr td th caption figure figcaption summary".split())
#: What can be a template in an article, and what can if it is mostly links.
_SECTIONS = frozenset("div section center details header".split())
_LISTS = frozenset("ul ol dl table".split())
_CLOSES_P = _BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"}
_CLOSERS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = frozenset("html body article main section div nav aside header footer form ul ol dl table blockquote td th li".split())
#: Words of a class or id that mark what is not main text. In a name of several words the last one counts, or the first if all
#: others are words of layout; a name that begins with one of _ABOUT tells whether something is there.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "header masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion "
    "related reply replies respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split()
)
_LAYOUT = frozenset(
    "area articles bar block blocks body bottom box button buttons column container content form group holder icons inner item items left link "
    "links list main message outer page pages panel placeholder popup posts primary right row secondary section site slot small stories top unit "
    "widget widgets wrap wrapper".split()
)
_ABOUT = frozenset("has no not with without".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
#: Turns the hash of a container in the main element into that of one in another article of the page.
_LESSER = 0x5DEECE66D5DEECE6


def _marks(name: str, inside: bool) -> bool:
    """Whether a class name or id is one of what is not main text; inside an article a header is its own."""
    words = [w.lower() for w in _SPLIT.split(name) if w]
    words = [w for w in words if not w.isdigit()]
    if not words or words[0] in _ABOUT:
        return False
    marks = _MARKS - {"header"} if inside else _MARKS
    return words[-1] in marks or words[0] in marks and all(w in _LAYOUT or w in _MARKS for w in words[1:])


def _marked(name: str, attrs: str, inside: bool) -> bool:
    """Whether class, id, role or style say that an element isn't main text."""
    if name in ("html", "body", "article", "main") or not attrs:
        return False
    for key, *values in _ATTR.findall(attrs):
        value, key = "".join(values), key.lower()
        if key == "class" and any(_marks(c, inside) for c in value.split()) or key == "id" and _marks(value, inside):
            return True
        if key == "role" and value.lower() in _ROLES or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "hidden":
            return True
    return "hidden" in attrs and "hidden" in _ATTR.sub(" ", attrs).lower().split()


class _Element:
    __slots__ = ("name", "skip", "soft", "main", "of", "prose", "link", "digest", "id", "size", "linked", "full")

    def __init__(self, name, skip, soft, main, of, prose, link, id_):
        self.name, self.skip, self.main, self.of, self.prose, self.link, self.id, self.size, self.linked = name, skip, main, of, prose, link, id_, 0, 0
        # the elements that alone are the reason to skip this one, None where there is a firm one; length of its whole text
        self.soft, self.full = soft, 0
        self.digest = hashlib.blake2b(name.encode(), digest_size=8)


def parse(page: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """Blocks of main text with the hashes of the containers around them, and the hashes of all containers of the page."""
    return dissect(page)[:2]


def dissect(page: str, kept: frozenset[int] = frozenset()) -> tuple[list[tuple[str, list[int]]], list[int], int]:
    """Blocks with the hashes of the containers around them, hashes of all containers that count, and a hash of the content.

    The page's main element is its longest article (else its longest `main`). What encloses it, or holds more than half of its
    text, is no template. Shorter articles (teasers) have hashes of their own: a text that is listed on many
    pages is not a template where it is the main element. The content is the text of the main element, else of the page.
    Articles less than half as long as the main element are teasers and no main text. A form, header or marked element that
    encloses the only main element of a page, or most of a page without one, counts for nothing: such elements are found on a first
    look and `kept` (by number) on a second one.
    """
    stack: list[_Element] = [_Element("#root", False, (), 0, 0, False, False, 0)]
    hidden: list[tuple[int, tuple[int, ...]]] = []  # length and reasons of the articles, else mains, that are skipped
    fulls: dict[int, int] = {}  # length of the text in elements that may be kept
    hashes: list[int] = [0]  # by element number, 0 for elements that can't be a template
    parents, owners, sizes = [0], [0], [0]  # by element number; an owner is the article or main that an element is in
    blocks: list[tuple[str, tuple[int, ...], int, int]] = []  # text, element numbers around, kind of main: 0 none, 1 main, 2 article; owner
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = _SPACE.sub(" ", "".join(buffer)).strip()
            buffer.clear()
            if text:
                blocks.append((text, tuple(e.id for e in stack), stack[-1].main, stack[-1].of))

    def close() -> None:
        e = stack.pop()
        value = int.from_bytes(e.digest.digest(), "big") >> 1
        stack[-1].digest.update(value.to_bytes(8, "big"))
        stack[-1].size += e.size
        stack[-1].full += e.full
        stack[-1].linked += e.linked
        if e.soft:
            fulls[e.id] = e.full
            if e.name in ("article", "main"):
                hidden.append((e.full, e.soft))
        sizes[e.id] = e.size
        if e.main and not e.skip:
            able = not e.prose and (e.name in _SECTIONS or e.name in _LISTS and 2 * e.linked > e.size)
        else:
            able = e.name in _BLOCKS and e.name not in ("html", "body", "article", "main")
        if able:
            hashes[e.id] = value or 1

    def text(part: str) -> None:
        top = stack[-1]
        line = _SPACE.sub(" ", part)
        top.digest.update(line.encode("utf-8", "surrogatepass"))
        n = len(line.strip())
        if top.soft is not None:
            top.full += n
        if not top.skip:
            buffer.append(html.unescape(part) if "&" in part else part)
            top.size += n
            if top.link:
                top.linked += n

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            if at < len(page):
                text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if not m[1]:
            attrs = m[3] or ""
            if name in _VOID:
                if name == "hr":
                    flush()
                elif name == "br" and not stack[-1].skip:
                    buffer.append(" ")
                continue
            if name in _BLOCKS:
                flush()
            if name in _CLOSES_P or name in _CLOSERS:
                ends = _CLOSERS.get(name, {"p"})
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in ends:
                        while len(stack) > i:
                            close()
                        if name not in ("tr", "td", "th"):
                            break
                    elif stack[i].name in _SCOPES and not (name in _CLOSERS and stack[i].name in ends):
                        break
            parent = stack[-1]
            kind = 2 if name == "article" else 1 if name == "main" else 0
            # the outermost article counts: comments are often articles inside of it
            number, soft = len(hashes), parent.soft
            firm = name in _NEVER and name not in _SOFT or name == "article" and parent.main == 2
            skip = parent.skip or firm
            if soft is None or firm:
                soft = None
            elif number not in kept and (name in _SOFT and not (name == "header" and parent.main) or _marked(name, attrs, parent.main > 0)):
                soft, skip = (*soft, number), True
            if attrs.rstrip().endswith("/") and name in _RAW:
                continue
            of = len(hashes) if kind > parent.main else parent.of
            parents.append(parent.id)
            owners.append(of)
            sizes.append(0)
            hashes.append(0)
            prose = of > 0 and of == parent.of and (parent.prose or name in _PROSE)
            stack.append(_Element(name, skip, soft, max(parent.main, kind), of, prose, parent.link or name == "a", len(hashes) - 1))
            if name in _OPAQUE:
                end = _ENDS[name].search(page, at)
                at = end.start() if end else len(page)
        else:
            if name in _BLOCKS:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    while len(stack) > i:
                        close()
                    break
                if stack[i].name in _SCOPES and name not in _SCOPES:
                    break
    flush()
    while len(stack) > 1:
        close()
    best = max((b[2] for b in blocks), default=0)
    if not best and not kept:
        root = stack[0]
        reasons = max(hidden, default=(0, ()))[1] if any(n for n, _ in hidden) else tuple(i for i, n in fulls.items() if 2 * n > root.full)
        if reasons:
            return dissect(page, frozenset(reasons))
    found = [b for b in blocks if b[2] == best]
    chosen = max(sorted({b[3] for b in found}), key=lambda i: sizes[i], default=0)
    found = [b for b in found if b[3] == chosen or 2 * sizes[b[3]] >= sizes[chosen]]
    if chosen:
        for i, of in enumerate(owners):
            if of == chosen:
                if 2 * sizes[i] > sizes[chosen]:
                    hashes[i] = 0
            elif of and hashes[i]:
                hashes[i] ^= _LESSER
        i = chosen
        while i:
            hashes[i] = 0
            i = parents[i]
    content = hashlib.blake2b("\n".join(b[0] for b in found if b[3] == chosen).encode("utf-8", "surrogatepass"), digest_size=8)
    kept = [(t, [hashes[i] for i in around if hashes[i]]) for t, around, *_ in found]
    return kept, sorted({h for h in hashes if h}), int.from_bytes(content.digest(), "big") >> 1


PARSED = "page_id long, url string, host string, blocks array<struct<text:string,around:array<long>>>, containers array<long>, content long"
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def _host(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))]))
    for b in batches:
        pages = [dissect(x or "") for x in b["html"].to_pylist()]
        yield pa.record_batch(
            [b["page_id"], b["url"], pa.array([_host(u) for u in b["url"].to_pylist()], pa.string()),
             pa.array([[{"text": t, "around": a} for t, a in p[0]] for p in pages], block), pa.array([p[1] for p in pages], pa.list_(pa.int64())),
             pa.array([p[2] for p in pages], pa.int64())],
            ["page_id", "url", "host", "blocks", "containers", "content"],
        )


def extract(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, host, text, n_removed (blocks deleted as template): one row per row of `pages`.

    Text is the blocks in page order, character references decoded, white space inside a block one space, joined by
    newlines; empty where there is none. Null html is empty, a null url is a host of its own, null ids and repeated
    rows stay, an empty table gives no row, other columns are not looked at. Counts are over all pages of a host,
    those of equal content as one, so a host with less than `least_pages` contents has no template; a host's templates are at most (containers of a page / share) hashes, so they fit one row.
    """
    parsed = written(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
        .mapInArrow(_parsed, PARSED)
    )
    sizes = parsed.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    counts = (
        parsed.select("host", "content", F.explode("containers").alias("hash")).distinct()
        .groupBy("host", "hash").agg(F.count("*").alias("n"))
    )
    templates = (
        counts.filter(F.col("n") >= least_pages).join(sizes, "host").filter(F.col("n") >= share * F.col("n_pages"))
        .groupBy(F.col("host").alias("template_host")).agg(F.collect_set("hash").alias("templates")).hint("rebalance")
    )
    # pages with no container around any block have nothing to delete and don't go to the join
    pages_of = parsed.select("page_id", "url", "host", "blocks")
    plain = F.forall("blocks", lambda b: F.size(b["around"]) == 0)
    none = F.array().cast("array<long>")
    joined = (
        pages_of.filter(~plain).join(templates, F.col("host") == F.col("template_host"), "left")
        .withColumn("templates", F.coalesce("templates", none)).drop("template_host")
        .unionByName(pages_of.filter(plain).withColumn("templates", none))
    )
    kept = F.filter("blocks", lambda b: ~F.arrays_overlap(b["around"], F.col("templates")))
    return joined.select("page_id", "url", "host", kept.alias("kept"), F.size("blocks").alias("n")).select(
        "page_id", "url", "host", F.array_join(F.transform("kept", lambda b: b["text"]), "\n").alias("text"),
        (F.col("n") - F.size("kept")).cast("long").alias("n_removed"),
    )
