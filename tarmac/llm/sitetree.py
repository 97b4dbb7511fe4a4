"""Operator 4: main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is an element path
(tags with their class words), its *styles* are the sequences of children
seen there, its *contents* the texts of its blocks.  Pages of a host with
equal blocks count once.  Importance is an
entropy with the number m of occurrences as base: the diversity of a
node's styles (presentation) and of its texts (content), 1 - sum(c/m *
log_m c) over the counts c of equal ones.  The importance of a branch
joins both: (1 - GAMMA**l) * presentation + GAMMA**l * content, with l the
mean number of children and content averaged over the branch's texts.
Branches seen often enough whose importance is low, in itself or against the
most important branch of their host, repeat on the site and are removed from
each page.

The tree is a table (host, path), built by two additions with map-side
sums, so a host with most of the pages is no larger a task than others.
Elements that HTML marks as menus, footers and the like are left out whatever
their importance.  So are those that class words or roles mark, forms, field
sets and dialogs, but only if they hold no article and at most half of the
text of the article element (of the page, outside of it), and something else
is left.  Readers' comments may hold more, if text stands before them.  An article or main element, where there is one, holds the text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise

GAMMA = 0.9
#: Importance below which a branch goes, and share of its host's highest importance below which it goes.
LOW = 0.35
LOW_SHARE = 0.6
#: Occurrences of a node on its host from which its importance counts.
SUPPORT = 20
#: Elements nested deeper take the path of their ancestor at this depth.
MAX_DEPTH = 32
#: Hosts with low branches up to so many are broadcast, more are joined by a shuffle.
BROADCAST_HOSTS = 20_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math canvas object textarea select title".split())
#: Of these, what swallows the rest of the page when it is never closed.
RAW_TO_END = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul option caption legend".split())
ENDS_ITSELF = {  # a start tag ends an open element of these, inside the given containers
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements and class words that mark what is no part of the article.
NOISE_TAGS = frozenset("head nav footer aside button menu".split())
#: Elements that may hold the article; they go as those that class words mark.
MARKED_TAGS = frozenset("form fieldset dialog".split())
NOISE_WORDS = frozenset(
    "ad ads adsense adv advert adverts advertisement advertising alert announcement banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification offcanvas overlay pager pagination popup promo promotion recommended recommendations "
    "related replies reply respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored "
    "subscribe toolbar topbar widget".split())
#: Of these, words of what readers wrote, which can be more than the article.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond responses".split())
#: The words after these in a class name say how something is laid out, not what it is.
#: Class names with these words tell a state, not what an element is (``comments-open``).
STATES = frozenset("allowed closed count disabled enabled free off on open".split())
MODIFIERS = frozenset("with without has have no not hide show".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
PLAIN = HEADINGS | frozenset("p li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""", re.S)
#: Block elements that end svg, math and select, and elements that may hold them there.
_LEAVES = re.compile(r"<(?:address|article|aside|blockquote|body|center|div|dl|footer|form|h[1-6]|header|main|menu|nav|ol|p|"
                     r"pre|section|table|ul|(foreignobject|annotation-xml|desc))(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STEP = re.compile(r"[A-Za-z]+(?:\d{1,2}(?!\d))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    path: str
    dropped: bool
    main: bool
    depth: int
    marks: tuple[int, ...] = ()
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Text blocks ``(path, text, in article)`` and elements ``(path, children)`` of a page."""

    blocks: list[tuple[str, str, bool]]
    styles: list[tuple[str, tuple[str, ...]]]
    noise: list[tuple[str, str]]


def _marking(value: str) -> list[str]:
    """Words of class names, without those after a modifier and without names of states."""
    out: list[str] = []
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if STATES.intersection(words[1:]):
            continue
        out += words[: next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))]
    return out


def _describe(tag: str, attributes: str, main: bool) -> tuple[str, bool, set[str]]:
    """Path step of an element, whether it is no part of the article, and the words that mark it as such."""
    words: list[str] = []
    marks = {tag} if tag in MARKED_TAGS else set()
    noise = tag in NOISE_TAGS or (tag == "header" and not main)
    if "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                found = _marking(value)
                words += [w.lower() for w in _STEP.findall(value)]
                if tag not in ("html", "body", *MAIN_TAGS) or "comment" in found:
                    hits = NOISE_WORDS.intersection(found)
                    marks |= hits - {"header"} if main else hits
            elif name == "role":
                if value.lower() in NOISE_ROLES and tag not in ("html", "body", *MAIN_TAGS):
                    marks.add("role")
            elif name == "style":
                noise = noise or bool(_HIDDEN.search(value))
            else:
                noise = noise or (name == "hidden" and tag != "html") or value.lower() == "true"
    return ".".join([tag, *words[:4]]), noise, marks


def parse(source: str) -> Page:
    """Blocks and elements of a page, whatever state its markup is in."""
    page = Page([], [], [])
    stack = [Element("", "", False, False, 0)]
    pieces: list[str] = []
    rows: list[tuple[str, str, bool, tuple[int, ...]]] = []  # blocks, and the marked elements around each
    comments: list[bool] = []  # of each marked element
    holds: set[int] = set()    # marked elements with an article or main element inside

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            top = next((e for e in reversed(stack) if e.tag in BLOCK), stack[0])
            if any(e.dropped for e in stack):
                page.noise.append((top.path, text))
            else:
                rows.append((top.path, text, top.main, stack[-1].marks))

    def pop() -> None:
        done = stack.pop()
        page.styles.append((done.path, tuple(done.children)))

    def close_to(index: int) -> None:
        if any(e.tag in BLOCK or e.dropped or e.marks != stack[index - 1].marks for e in stack[index:]):
            flush()
        while len(stack) > index:
            pop()

    ends: dict[str, re.Match | None] = {}  # next end tag of each raw element
    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        if m is None:
            pieces.append(entities.unescape(source[at:]))
            break
        if m.start() > at:
            pieces.append(entities.unescape(source[at: m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # end tag
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close_to(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
            continue
        if tag in RAW:
            if tag not in ends or (ends[tag] and ends[tag].start() < at):
                ends[tag] = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
            closing = ends[tag]
            if closing is None and tag in RAW_TO_END:
                break
            if closing is None or (tag in ("svg", "math") and (m[3] or m[6] or "").endswith("/")):
                continue
            if tag in ("svg", "math", "select"):
                leaves = _LEAVES.search(source, at, closing.start())
                if leaves and not leaves[1]:
                    continue
            at = closing.start()
            after = source.find(">", at)
            at = end if after < 0 else after + 1
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
            if tag in ENDS_ITSELF:
                ended, inside = ENDS_ITSELF[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ended:
                        close_to(i)
                        break
                    if stack[i].tag in inside:
                        break
            flush()
        if tag == "br" or tag == "hr":
            pieces.append(" ")
        top = stack[-1]
        if tag in VOID:
            top.children.append(tag)
            continue
        attributes = m[3] if m[2] else m[6]
        step, noise, words = _describe(tag, attributes or "", top.main)
        marks = top.marks
        if words:
            marks += (len(comments),)
            comments.append(not words.isdisjoint(COMMENT_WORDS))
        elif tag in MAIN_TAGS and not noise:
            holds.update(marks)
        if noise or words:
            flush()
        top.children.append(step)
        path = f"{top.path}/{step}" if top.depth < MAX_DEPTH else top.path
        stack.append(Element(tag, path, noise, top.main or tag in MAIN_TAGS, top.depth + 1, marks))
    close_to(1)
    flush()
    _sort_out(page, rows, comments, holds)
    return page


def _sort_out(page: Page, rows: list[tuple[str, str, bool, tuple[int, ...]]], comments: list[bool], holds: set[int]) -> None:
    """Blocks and noise of a page from its rows: which marked elements are no part of the article."""
    sizes, inside = [0] * len(comments), [0] * len(comments)
    told = [False] * len(comments)  # text other than headings stands before the element, outside of all marked ones
    paragraph, entered = False, set()
    for path, text, main, marks in rows:
        for mark in marks:
            sizes[mark] += len(text)
            inside[mark] += len(text) * main
            if mark not in entered:
                entered.add(mark)
                told[mark] = paragraph
        paragraph = paragraph or not (marks or path[path.rfind("/") + 1:].split(".")[0] in HEADINGS)
    total = sum(len(text) for _, text, _, _ in rows)
    article = sum(len(text) for _, text, main, _ in rows if main)
    plain = any(main and not marks for _, _, main, marks in rows)  # an article that no marked element holds

    def goes(i: int) -> bool:
        small = 2 * inside[i] <= article if inside[i] else 2 * sizes[i] <= total
        return (plain if i in holds else small) or (comments[i] and told[i])

    out = {i for i in range(len(comments)) if goes(i)}
    if rows and all(out.intersection(marks) for *_, marks in rows):  # nothing left
        out = {i for i in out if comments[i]} if any(not any(comments[i] for i in marks) for *_, marks in rows) else set()
    for path, text, main, marks in rows:
        if out.intersection(marks):
            page.noise.append((path, text))
        else:
            page.blocks.append((path, text, main))


def main_text(page: Page, low: frozenset[str] | set[str]) -> str:
    """Blocks of the article, without the site's low branches, joined by newlines."""
    blocks = page.blocks
    inside = [b for b in blocks if b[2]]
    if inside:
        kept = [t for path, t, _ in inside if not (low and _low_inside(path, low))]
        chosen = kept or [t for _, t, _ in inside]
    else:
        kept = [t for path, t, _ in blocks if not (low and _low_branch(path, low))]
        chosen = kept or [t for _, t, _ in blocks]
    return "\n".join(chosen)


def _branches(path: str) -> Iterator[tuple[str, str]]:
    """Paths of a block's ancestors and its own, with the tag of each."""
    at = path.find("/", 1)
    while at >= 0:
        yield path[:at], path[path.rfind("/", 0, at) + 1: at].split(".")[0]
        at = path.find("/", at + 1)
    if path:
        yield path, path[path.rfind("/") + 1:].split(".")[0]


def _low_branch(path: str, low) -> bool:
    return any(p in low and tag not in ("html", "body") for p, tag in _branches(path))


def _low_inside(path: str, low) -> bool:
    """Inside an article only boxes are removed, no paragraphs, headings, lists or tables."""
    within = False
    for p, tag in _branches(path):
        if within and tag not in PLAIN and p in low:
            return True
        within = within or tag in MAIN_TAGS
    return False


def host_of(url: str) -> Column:
    """Lower-cased host of a URL; '' for null and what has no host."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, path, m, importance`` of every branch of every host's tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, int, int], list[dict]] = {}
            for host, source in zip(batch.column(0), batch.column(1)):
                host, page = host.as_py(), parse(source.as_py())
                blocks = [(b[0], b[1]) for b in page.blocks] + page.noise
                key = (host, _hash("\n".join(f"{path}\t{text}" for path, text in blocks)),
                       _hash("\n".join(f"{path}\t{'|'.join(c)}" for path, c in page.styles)))
                if key in seen:
                    continue
                counts: Counter = Counter((path, 0, _hash("|".join(c)), len(c)) for path, c in page.styles)
                counts.update((path, 1, _hash(text), 0) for path, text in blocks)
                seen[key] = [dict(zip(("path", "kind", "feature", "children", "n"), (*k, n))) for k, n in counts.items()]
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()),
                pa.array([k[2] for k in seen], pa.int64()), pa.array(list(seen.values()), pa.list_(pa.struct([
                    ("path", pa.string()), ("kind", pa.int32()), ("feature", pa.int64()), ("children", pa.int64()),
                    ("n", pa.int64())]))),
            ], names=["host", "page", "variant", "features"])

    pages = pages.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).mapInArrow(
        run, "host string, page long, variant long, features array<struct<path:string,kind:int,feature:long,children:long,n:long>>")
    one = pages.groupBy("host", "page").agg(F.min_by("features", "variant").alias("features"))
    rows = one.select("host", F.inline("features"))
    once = rows.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"), F.max("children").alias("children"))
    n = F.col("n")
    nodes = once.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("m"), F.sum(n * F.log(n)).alias("s"), F.sum(n * F.col("children")).alias("children"))
    diversity = F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log("m"))).otherwise(1.0)
    nodes = nodes.select("host", "path", "kind", "m", diversity.alias("diversity"), (F.col("children") / F.col("m")).alias("l"))
    steps = F.split("path", "/")
    branch = F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))),
                                   lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/")))
    content = nodes.filter("kind = 1").select("host", branch.alias("path"), "m", "diversity").groupBy("host", "path").agg(
        (F.sum(F.col("m") * F.col("diversity")) / F.sum("m")).alias("content"), F.sum("m").alias("texts"))
    shown = nodes.filter("kind = 0").select("host", "path", "m", F.col("diversity").alias("presentation"), "l")
    fade = F.pow(F.lit(GAMMA), F.coalesce("l", F.lit(0.0)))
    return shown.join(content, ["host", "path"]).select(
        "host", "path", F.least("m", "texts").alias("m"),
        ((1 - fade) * F.col("presentation") + fade * F.col("content")).alias("importance"))


def low_branches(tree: DataFrame, below: float = LOW, support: int = SUPPORT, share: float = LOW_SHARE) -> DataFrame:
    """``host, low``: paths of the branches to remove, ``below`` or under a ``share`` of the host's most important one."""
    often = tree.filter(F.col("m") >= support)
    highest = often.groupBy("host").agg(F.max("importance").alias("highest"))
    bound = F.greatest(F.lit(below), F.lit(share) * F.col("highest"))
    return often.join(highest, "host").filter(F.col("importance") < bound).groupBy("host").agg(
        F.collect_set("path").alias("low"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` of every row.

    White space inside a block becomes one blank, blocks are joined by
    newlines in page order.  Null and empty pages, and pages without text
    in their article, have an empty text.  Rows may repeat or lack an id or
    a URL (such pages share the host ''); other columns are left out.
    """
    spark = pages.sparkSession
    low = materialise(spark, low_branches(style_tree(pages, url_col, html_col)), "low-branches")
    few = low.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(url_col).alias("host"))
    joined = rows.join(F.broadcast(low) if few else low, "host", "left").select("id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(parse(source.as_py()), frozenset(paths.as_py() or ()))
                     for source, paths in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return joined.mapInArrow(run, f"id {kind}, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col})
