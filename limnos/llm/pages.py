"""Main text of web pages by consensus paths of hosts.

Each page votes: its containers are scored by the text that they hold outside links, boilerplate and other containers,
and the best one's generalised path (tags with their classes, numbers replaced, list positions dropped) gets the vote.
Votes are counted for each host in Spark; the winning path is the one with most votes, then most text, then least in
order. Every page is then read again: the containers on its host's winning path give the text, without those that are
teasers beside the best one (mostly links, a linked heading, or no paragraph where the best one has some); a page
without such a container falls back to its own best one. Null html is empty and has no text.

Text inside a block has each run of white space turned into one space and is trimmed; blocks are joined by one space.
What is hidden is left out, and so are menus, headers, footers, forms and elements whose class or id names a sidebar,
a notice, adverts, reader comments or the like, of any size, as long as main text stands outside them; headings and
articles are never named so, and a heading group inside an article is part of it. Where nothing but headings and links
stands outside, the one of them with most text is part of the page, and what is in it is judged in the same way. A form or
menu (it may be unclosed) stays too if it holds more paragraph text than all that stands outside, and a named element if it
also has the page's only first heading; but not beside an article or main element with text. A class or id that only has
such a word in it lowers its container's score by LOWERED.

The work is linear in the page's length, however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnos.llm.shared import map_slices, quoted, saved
from limnos.llm.urls import split_url

_INSIDE = r"(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+"  # of a tag: only a well-formed quoted value can hold >
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?:svg|math)\b{_INSIDE}(?<=/)>"
    rf"|<(script|style|noscript|template|textarea|select|svg|math|iframe|object|title|canvas|video|audio)\b{_INSIDE}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([A-Za-z][A-Za-z0-9:-]*)({_INSIDE})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

# What tags mean.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div td body".split())
LEFT_OUT_TAGS = frozenset("nav header footer aside form button dialog menu fieldset datalist".split())
AROUND_PAGES = frozenset("nav header form fieldset menu button dialog".split())  # some pages have their main text in one of these
HEAD_TAGS = frozenset("head html base link meta".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menus breadcrumb "
    "breadcrumbs header masthead footer sidebar side aside widget widgets cookie cookies consent notice notices gdpr popup modal "
    "newsletter subscribe subscription signup login share sharing social comment comments disqus respond replies reply related recommended "
    "pagination pager toolbar toc skip copyright legal".split())
BLOCK_WORDS = frozenset("area bar block box container content inner list main outer section top bottom left right wrap wrapper".split())  # beside a name they change nothing
NEVER_NAMED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
LOWERED = 0.5
BROADCAST = 32 << 20  # most bytes of winning paths that are sent to all tasks
SALTS = 64  # parts of a host's pages, beyond that
CLOSED_BY = {  # an opening tag that ends an open one of these
    "p": frozenset("p".split()), "li": frozenset("li".split()), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()),
    "tr": frozenset("tr td th".split()), "td": frozenset("td th".split()), "th": frozenset("td th".split()), "option": frozenset("option".split()),
}
SECTIONING = frozenset("article main section div body html td table ul ol dl blockquote form nav header footer aside".split())


@dataclass(slots=True)
class Block:
    """A run of text between block boundaries, with what stands around it."""

    text: str
    linked: int
    container: int
    left_out: int
    tag: str  # p, a heading or empty

    @property
    def own(self) -> int:
        return max(0, len(self.text) - self.linked)


@dataclass(slots=True)
class Element:
    """A container, or an element that is left out as a rule; number 0 stands for the page itself."""

    parent: int
    tag: str
    name: str = ""
    has_word: bool = False
    depth: int = 0


@dataclass(slots=True)
class Page:
    blocks: list[Block] = field(default_factory=list)
    containers: list[Element] = field(default_factory=lambda: [Element(-1, "")])


def _generalised(tag: str, attributes: dict[str, str]) -> str:
    """The tag with its classes in order; digits, which number things, become 0."""
    names = sorted(set(re.sub(r"\d+", "0", attributes.get("class", "")).split()))
    return ".".join([tag, *names])


def _is_hidden(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ("html", "body", "main") or not attributes:
        return tag == "head"
    return ("hidden" in attributes.get(" bare", "").split() or attributes.get("aria-hidden") == "true"
            or bool(re.search(r"display\s*:\s*none", attributes.get("style", ""))))


def _named(tag: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether a class or id names a block that is not main text, and whether one has such a word in it."""
    if tag in NEVER_NAMED or not attributes:
        return False, False
    tokens = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", attributes.get("class", "") + " " + attributes.get("id", "")).lower().split()
    parts = [{p for p in re.split(r"[^a-z]+", t) if p} for t in tokens]
    some = [p for p in parts if not LEFT_OUT_NAMES.isdisjoint(p)]
    return any(p <= LEFT_OUT_NAMES | BLOCK_WORDS for p in some), bool(some)


def read_blocks(html: str) -> Page:
    """Blocks of main text, each with its nearest container."""
    page = Page()
    asides = [Element(-1, "")]  # elements that are left out as a rule
    stack: list[tuple[str, bool, int, int, str]] = []  # tag, whether hidden, container and aside around it, kind of block around it
    open_tags: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]  # open tags since each open sectioning element
    container = aside = hidden = 0
    kind = ""
    parts: list[str] = []
    linked = at = 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                page.blocks.append(Block(text, linked, container, aside, kind))
            parts.clear()
            linked = 0

    def close(tag: str) -> None:
        nonlocal hidden, container, aside, kind
        while stack:
            if stack[-1][0] not in INLINE:
                end_block()
            name, was_hidden, container_, aside_, kind_ = stack.pop()
            if aside_ != aside:
                end_block()
            container, aside, kind = container_, aside_, kind_
            hidden -= was_hidden
            open_tags[name] -= 1
            if name in SECTIONING:
                scopes.pop()
            else:
                scopes[-1][name] -= 1
            if name == tag:
                return

    for m in MARKUP.finditer(html):
        if m.start() > at and not hidden:
            piece = html[at : m.start()]
            parts.append(piece)
            if open_tags["a"]:
                linked += len(piece)
        at = m.end()
        tag = m[3] and m[3].lower()
        if tag is None:
            continue
        if tag not in INLINE:
            end_block()
        if m[2]:
            if open_tags[tag]:
                close(tag)
            continue
        if open_tags["head"] and tag not in HEAD_TAGS:  # a head without an end ends at what cannot stand in it
            close("head")
        if tag in VOID:
            continue
        if tag not in INLINE:  # a block ends an open paragraph and what is open in it
            ended = CLOSED_BY.get(tag, frozenset())
            if scopes[-1]["p"] or any(scopes[-1][name] for name in ended):
                close(next(s[0] for s in reversed(stack) if s[0] == "p" or s[0] in ended))
        attributes = {}
        if m[4] and m[4].strip():
            attributes = {a[1].lower(): a[2] if a[2] is not None else a[3] if a[3] is not None else a[4] for a in ATTRIBUTE.finditer(m[4])}
            attributes[" bare"] = ATTRIBUTE.sub(" ", m[4]).lower()
        is_hidden = _is_hidden(tag, attributes)
        is_named, has_word = _named(tag, attributes)
        by_tag = tag in LEFT_OUT_TAGS and not (tag == "header" and open_tags["article"])
        by_role = tag not in ("html", "body", "main") and attributes.get("role", "").lower() in LEFT_OUT_ROLES
        stack.append((tag, is_hidden, container, aside, kind))
        open_tags[tag] += 1
        if tag in SECTIONING:
            scopes.append(Counter())
        else:
            scopes[-1][tag] += 1
        if by_tag or by_role or (is_named and not (tag == "header" and open_tags["article"])):
            end_block()
            asides.append(Element(aside, tag if by_tag else ""))
            aside = len(asides) - 1
        if tag in CONTAINERS:
            page.containers.append(Element(container, tag, _generalised(tag, attributes), has_word, page.containers[container].depth + 1))
            container = len(page.containers) - 1
        if tag not in INLINE:
            kind = tag if tag == "p" or tag in HEADINGS else ""
        hidden += is_hidden
    if not hidden and at < len(html):
        parts.append(html[at:])
    end_block()
    _leave_out(page, asides)
    return page


def _leave_out(page: Page, asides: list[Element]) -> None:
    """Drop the blocks of elements that are left out, judged level by level against what stands outside them."""
    of: list[list[Block]] = [[] for _ in asides]
    inside: list[list[int]] = [[] for _ in asides]
    for b in page.blocks:
        of[b.left_out].append(b)
    for number, e in enumerate(asides[1:], 1):
        inside[e.parent].append(number)
    in_article = [False] * len(page.containers)
    for number, c in enumerate(page.containers[1:], 1):
        in_article[number] = in_article[c.parent] or c.tag in ("article", "main")
    paragraphs_only = any(b.tag == "p" and b.own for b in page.blocks)

    def prose(blocks: list[Block]) -> int:
        return sum(b.own for b in blocks if b.tag == "p" or not paragraphs_only and b.tag not in HEADINGS)

    def texts(blocks: list[Block]) -> int:
        return sum(b.own for b in blocks if b.tag not in HEADINGS)

    def titled(blocks: list[Block]) -> bool:
        return any(b.tag == "h1" for b in blocks)

    kept = {0}
    all_prose, all_texts, title, article = 0, 0, False, False

    def add(number: int) -> None:
        nonlocal all_prose, all_texts, title, article
        kept.add(number)
        all_prose += prose(of[number])
        all_texts += texts(of[number])
        title = title or titled(of[number])
        article = article or any(in_article[b.container] and b.own and b.tag not in HEADINGS for b in of[number])

    add(0)
    level = inside[0]
    while level:
        within: list[int] = []
        if not all_texts:
            best = max(level, key=lambda n: (prose(of[n]), texts(of[n]), len(inside[n]), -n))
            level = [n for n in level if n != best]
            add(best)
            within += inside[best]
        stay = [n for n in level if not article and prose(of[n]) > all_prose and (asides[n].tag in AROUND_PAGES or titled(of[n]) and not title)]
        for n in stay:
            add(n)
            within += inside[n]
        level = within
    page.blocks = [b for b in page.blocks if b.left_out in kept]


def scored(page: Page) -> list[float]:
    """Score of each container: its own text outside links, half of what each container in it has, and a bonus for meaning."""
    scores = [0.0] * len(page.containers)
    for b in page.blocks:
        scores[b.container] += max(0, len(b.text) - 2 * b.linked)
    for number in range(len(scores) - 1, 0, -1):
        scores[page.containers[number].parent] += scores[number] / 2
    return [s * {"article": 3, "main": 2}.get(c.tag, 1) * (LOWERED if c.has_word else 1) for s, c in zip(scores, page.containers)]


def names_of(page: Page, number: int) -> str:
    names = []
    while number:
        names.append(page.containers[number].name)
        number = page.containers[number].parent
    return ">".join(reversed(names))


def _inside(page: Page, chosen: set[int]) -> list[bool]:
    """Of each container, whether it is a chosen one or stands in one."""
    found = [number in chosen for number in range(len(page.containers))]
    for number, c in enumerate(page.containers[1:], 1):
        found[number] = found[number] or found[c.parent]
    return found


def blocks_in(page: Page, chosen: set[int]) -> list[Block]:
    found = _inside(page, chosen)
    return [b for b in page.blocks if found[b.container]]


def best_container(page: Page) -> int:
    """Number of the best container, the outermost and first of equal ones; 0 if none has text."""
    held = {0}
    for b in page.blocks:
        number = b.container
        while number not in held:
            held.add(number)
            number = page.containers[number].parent
    scores = scored(page)
    return max(held - {0}, key=lambda n: (scores[n], -page.containers[n].depth, -n), default=0)


def _on_path(page: Page, wanted: str) -> list[int]:
    """Containers with text on a generalised path."""
    names = wanted.split(">")
    matched = [0] + [-1] * (len(page.containers) - 1)  # names of the path that the container and those around it make up
    on = set()
    for number, c in enumerate(page.containers[1:], 1):
        k = matched[c.parent]
        if 0 <= k < len(names) and names[k] == c.name:
            matched[number] = k + 1
            if k + 1 == len(names):
                on.add(number)
    root = [0] * len(page.containers)
    for number, c in enumerate(page.containers[1:], 1):
        root[number] = number if number in on else root[c.parent]
    return sorted({root[b.container] for b in page.blocks} - {0})


def _without_teasers(page: Page, numbers: list[int]) -> set[int]:
    if len(numbers) < 2:
        return set(numbers)
    root = {n: n for n in numbers}
    blocks: dict[int, list[Block]] = {n: [] for n in numbers}
    for number, c in enumerate(page.containers[1:], 1):
        if number not in root and c.parent in root:
            root[number] = root[c.parent]
    for b in page.blocks:
        if b.container in root:
            blocks[root[b.container]].append(b)
    scores = scored(page)
    best = max(numbers, key=lambda n: (scores[n], -n))
    has_paragraph = any(b.tag == "p" for b in blocks[best])

    def like_it(n: int) -> bool:
        return (sum(b.linked for b in blocks[n]) <= sum(b.own for b in blocks[n]) and not any(b.tag in HEADINGS and not b.own for b in blocks[n])
                and (not has_paragraph or any(b.tag == "p" for b in blocks[n])))

    return {n for n in numbers if n == best or like_it(n)}


def text_on(page: Page, wanted: str | None) -> str:
    """Text of the containers on the wanted generalised path, or of the page's own best one; without containers, all text."""
    chosen = _without_teasers(page, _on_path(page, wanted)) if wanted is not None else set()
    return " ".join(b.text for b in blocks_in(page, chosen or {best_container(page)}))


def _narrow(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    return pages.select(quoted(id_column).cast("bigint").alias("page_id"), quoted(url_column).cast("string").alias("url"), quoted(html_column).cast("string").alias("html"))


def host_paths(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, path, votes): the winning path of each host. Pages without a host vote together, for the empty host."""

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            page = read_blocks(html or "")
            best = best_container(page)
            if best:
                rows.append((split_url(url)[0], names_of(page, best), sum(len(b.text) for b in blocks_in(page, {best}))))
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["host", "path", "characters"])

    votes = map_slices(_narrow(pages, id_column, url_column, html_column), vote, "host string, path string, characters bigint")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("characters").alias("characters"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("characters"), "path"))
    return counted.withColumn("rank", rank).where("rank = 1").select("host", "path", "votes")


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text and n_chars.

    Winning paths are saved first. Up to BROADCAST bytes they are sent to the pages, which then do not move; beyond that
    pages of a host are dealt out to SALTS parts, each of which has its own copy of the host's path.
    """
    narrow = _narrow(pages, id_column, url_column, html_column)
    host = F.translate(F.regexp_extract("url", "(?s)://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    winners = saved(host_paths(pages, id_column, url_column, html_column), "host-paths").select(F.col("host").alias("of_host"), "path")
    size = winners.agg(F.sum(F.octet_length("of_host") + F.octet_length("path") + 32)).first()[0] or 0
    hosted = narrow.withColumn("host", F.coalesce(host, F.lit("")))
    met = with_paths(hosted, winners, salted=size > BROADCAST)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text_on(read_blocks(h or ""), p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_slices(met, work, "page_id bigint, url string, text string, n_chars bigint")


def with_paths(hosted: DataFrame, winners: DataFrame, salted: bool) -> DataFrame:
    """Pages with the winning path of their host, null where it has none."""
    columns = ["page_id", "url", "html", "path"]
    if not salted:
        return hosted.join(F.broadcast(winners), F.col("host") == F.col("of_host"), "left").select(columns)
    copies = winners.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64("page_id", "url", F.octet_length("html")), F.lit(SALTS)).cast("int")
    return hosted.withColumn("salt", part).join(copies, (F.col("host") == F.col("of_host")) & (F.col("salt") == F.col("of_salt")), "left").select(columns)
