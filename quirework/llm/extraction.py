"""Main text of HTML pages by consensus paths per host.

Every container of a page is scored by the prose below it.  A page votes for the generalised path (tags
and classes, numbers made alike) of its best container; the votes of a host are summed in Spark, and all its pages
are extracted anew from the containers on the winning path.  A page without that path falls back to its own best.

Navigation, scripts and hidden elements are left out at once.  A form, or an element whose class or id says advert,
sidebar, comments or the like, is only suspected: it stays if it holds the page's article or most of its prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no article text, wherever they stand.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside button select textarea iframe object svg canvas dialog menu".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
#: Words at the head or tail of a class or id that make an element suspect of being no part of the article.
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner sidebar aside rail menu nav navbar navigation
    breadcrumb breadcrumbs footer foot masthead cookie cookies consent notice notices alert gdpr popup modal overlay newsletter
    subscribe subscription signup login search share sharing social related recommended recommendations comment comments
    commentlist respond reply replies disqus pagination pager toolbar widget skip hidden""".split()
)
#: Of these, the ones whose elements may well hold more prose than the article before them.
TALK_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())
#: Words that may stand beside those in a name and leave its meaning: ad-box, post-comments, sidebar-left.  With any other word a
#: name says something else: related-work, search-results, content-sidebar-wrap, has-sidebar.
LAYOUT_WORDS = frozenset(
    """box block section list wrap wrapper container area widget post posts link links inner outer unit slot top bottom left right inline item
    items panel bar button buttons form field module region holder row col column group card cards article entry page site global primary
    secondary first last sticky fixed text large small content""".split()
)
#: Of these names, the ones that authors give to parts of their articles: they count only outside the article.
AUTHOR_WORDS = frozenset("alert notice notices search skip overlay related recommended recommendations widget toolbar".split())
#: Only here is an id a name of a region; elsewhere it is an anchor.
ID_TAGS = frozenset("div ul ol dl table td center".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
CONTAINERS = frozenset("html body main article section div td center".split())
#: An open p ends where one of these begins.
ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An element ends where a sibling of its kind begins, up to the list or table around it.
SIBLINGS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: How much more the prose below a container of this kind weighs.
TAG_WEIGHT = {"html": 0.5, "body": 0.7, "article": 2.0, "main": 1.6}
GOOD_WORDS, GOOD_WEIGHT = frozenset("article content entry post story text body main".split()), 1.4
#: A deeper container with nearly the same prose wins; a link's text counts against it.
DEPTH_WEIGHT, LINK_COST = 1.02, 3
#: Beyond this depth a container gains no more weight.
DEEPEST = 20

#: Elements whose content is plain characters up to their end tag.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s/=>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class _Node:
    __slots__ = ("tag", "path", "depth", "weight", "dropped", "link", "holder", "outer", "suspect", "start", "end", "prose")

    def __init__(self, tag, path, depth, weight, dropped, link, holder, start, suspect=None) -> None:
        self.tag, self.path, self.depth, self.weight = tag, path, depth, weight
        self.dropped, self.link, self.holder, self.start = dropped, link, holder, start
        self.outer, self.suspect, self.end, self.prose = holder, suspect, None, 0


class _Suspect:
    """An element that is no part of the article by its name, unless its content speaks for it."""

    __slots__ = ("outer", "talk", "start", "prose", "dropped")

    def __init__(self, outer, talk, start) -> None:
        self.outer, self.talk, self.start, self.prose, self.dropped = outer, talk, start, 0, False


def _ends_of(names: str) -> set[str]:
    """Words of the names that consist of marking and layout words."""
    found: set[str] = set()
    for name in names.split():
        words = set(_WORD.findall(name))
        if words and words <= DROPPED_WORDS | LAYOUT_WORDS:
            found |= words & DROPPED_WORDS
    return found


class Page:
    """Blocks of text outside dropped elements, and for each container the range of blocks inside it.

    Text in suspects is kept in pieces with its suspect until the end of the page, when they are judged.
    """

    def __init__(self, html: str) -> None:
        root = _Node("", 0, 0, 0.0, False, False, None, 0)
        self.open: dict[str, list[int]] = {}  # heights of the open elements of each tag
        self.steps: dict[tuple[int, str], int] = {}  # paths, as the number of the path above and one step
        self.above: list[tuple[int, str]] = [(0, "")]
        self.stack, self.containers, self.blocks, self.pieces = [root], [], [], []
        self.suspects, self.withheld, self.heading, self.prose = [], [], None, 0
        self._read(html)
        self._close_to(1)
        self._flush()
        if self.suspects:
            self._judge()
        for node in reversed(self.containers):
            if node.outer is not None:
                node.outer.prose += node.prose

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            token = _TOKEN.search(html, at)
            if token is None:
                self._data(html[at:])
                return
            if token.start() > at:
                self._data(html[at : token.start()])
            at = token.end()
            name = token.group(2)
            if name is None:
                continue
            tag = name.lower()
            if token.group(1):
                self._end_tag(tag)
                continue
            self._start_tag(tag, token.group(3))
            if tag in RAW:
                close = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
                at = close.start() if close else size

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join([t for t, _ in self.pieces]).split())
            if text:
                self.blocks.append(self.pieces if any(s is not None for _, s in self.pieces) else text)
            self.pieces = []

    def _close_to(self, height: int) -> None:
        while len(self.stack) > height:
            node = self.stack.pop()
            self.open[node.tag].pop()
            if node.tag not in INLINE:
                self._flush()
            if node.holder is node:
                node.end = len(self.blocks)

    def _judge(self) -> None:
        """Drop the suspects that hold neither the page's article, main or title nor most of its prose, and what is in them."""
        filled = [n for n in self.containers if n.tag in ("article", "main") and n.end > n.start]
        marks = [m for tag in ("article", "main") if (m := next((n for n in filled if n.tag == tag), None))]
        held = set()
        for node in marks or [self.heading]:
            suspect = node.suspect if node is not None else None
            while suspect is not None:
                held.add(suspect)
                suspect = suspect.outer
        for suspect in reversed(self.suspects):
            if suspect.outer is not None:
                suspect.outer.prose += suspect.prose
        for s in self.suspects:
            kept = s in held or 2 * s.prose > self.prose
            if kept and s.talk and s not in held:  # long comments beside an article
                kept = all(m.start <= s.start < m.end for m in marks)
            s.dropped = not kept or (s.outer is not None and s.outer.dropped)
        blocks, moved = [], [0]
        for block in self.blocks:
            text = block if isinstance(block, str) else " ".join("".join([t for t, s in block if s is None or not s.dropped]).split())
            if text:
                blocks.append(text)
            moved.append(len(blocks))
        self.blocks = blocks
        for node in self.containers:
            node.start, node.end = moved[node.start], moved[node.end]
        self.containers = [n for n in self.containers if n.suspect is None or not n.suspect.dropped]
        for holder, suspect, prose in self.withheld:
            if not suspect.dropped:
                holder.prose += prose

    def _start_tag(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append((" ", None))
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in ENDS_P:
            self._end({"p"}, CONTAINERS | {"table", "td", "li"})
        elif tag in SIBLINGS:
            self._end(*SIBLINGS[tag])
        parent = self.stack[-1]
        if tag not in INLINE:
            self._flush()
        dropped, path, weight = parent.dropped, parent.path, 0.0
        words, classes, suspected, talk = (), "", tag == "form", False
        if tag in DROPPED:
            dropped = True
        if attributes and not dropped:
            named = {a[0].lower(): unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(attributes)}
            classes = named.get("class", "").lower()
            words = _WORD.findall(classes) + _WORD.findall(named.get("id", "").lower())
            dropped = "hidden" in named or named.get("aria-hidden") == "true"
            role = named.get("role", "").lower()
            dropped = dropped or role in DROPPED_ROLES or "display:none" in named.get("style", "").replace(" ", "")
            if tag not in ("html", "body", "article", "main"):
                ends = _ends_of(classes) | (_ends_of(named.get("id", "").lower()) if tag in ID_TAGS else set())
                if self._last(("article", "main")):
                    ends -= AUTHOR_WORDS
                suspected = suspected or role == "form" or not DROPPED_WORDS.isdisjoint(ends)
                talk = not TALK_WORDS.isdisjoint(ends)
        if tag == "header" and not self._last(("article", "main")):
            dropped = True
        holder, suspect = parent.holder, parent.suspect
        if suspected and not dropped:
            suspect = _Suspect(suspect, talk, len(self.blocks))
            self.suspects.append(suspect)
        node = _Node(tag, path, parent.depth + 1, weight, dropped, parent.link or tag == "a", holder, len(self.blocks), suspect)
        if tag == "h1" and self.heading is None and not dropped:
            self.heading = node
        if tag in CONTAINERS:
            step = tag + "".join(f".{_DIGITS.sub('0', c)}" for c in sorted(classes.split())).replace("/", "|")
            key = (0 if tag in ("html", "body") else path, step)  # these may be left out
            if key not in self.steps:
                self.steps[key] = len(self.above)
                self.above.append(key)
            node.path = self.steps[key]
            node.weight = TAG_WEIGHT.get(tag, GOOD_WEIGHT if not GOOD_WORDS.isdisjoint(words) else 1.0)
            if not dropped:
                node.holder = node
                self.containers.append(node)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)

    def _last(self, tags) -> int:
        """Height of the innermost open element of these tags; 0 if none is open."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _end(self, tags, within) -> None:
        """End the innermost open element of ``tags`` unless one of ``within`` is open inside it."""
        at = self._last(tags)
        if at and at > self._last(within - tags):
            self._close_to(at)

    def path_number(self, path: str) -> int | None:
        """Number of a path on this page."""
        number = 0
        for step in path.split("/")[1:]:
            number = self.steps.get((number, step), -1)
            if number < 0:
                return None
        return number

    def path_of(self, number: int) -> str:
        steps = []
        while number:
            number, step = self.above[number]
            steps.append(step)
        return "".join(f"/{s}" for s in reversed(steps))

    def _end_tag(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append((" ", None))
            return
        if at := self._last((tag,)):
            self._close_to(at)

    def _data(self, data: str) -> None:
        node = self.stack[-1]
        if node.dropped:
            return
        if "&" in data:
            data = unescape(data)
        suspect, size = node.suspect, len(data.strip())
        self.pieces.append((data, suspect))
        if not node.link:
            self.prose += size
            if suspect is not None:
                suspect.prose += size
        if node.holder is not None:
            prose = size - LINK_COST * size if node.link else size
            if suspect is None:
                node.holder.prose += prose
            else:
                self.withheld.append((node.holder, suspect, prose))

    def best(self) -> _Node | None:
        """The container with the highest score; of equals the first."""
        return max(self.containers, key=lambda n: n.prose * n.weight * DEPTH_WEIGHT ** min(n.depth, DEEPEST), default=None)

    def vote(self) -> tuple[str, float] | None:
        node = self.best()
        return (self.path_of(node.path), 1.0) if node is not None and node.prose > 0 else None

    def text(self, path: str | None) -> str:
        """Blocks of the outermost containers on a path, or of the page's best one, or of the page."""
        number = self.path_number(path) if path else None
        chosen = [n for n in self.containers if n.path == number and n.end > n.start] if number else []
        if not chosen and (node := self.best()) is not None and node.prose > 0:
            chosen = [node]
        ranges, last = [], 0
        for n in chosen:
            if n.start >= last:
                ranges += self.blocks[n.start : n.end]
                last = n.end
        return "\n".join(ranges if chosen else self.blocks)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tally: dict[tuple, float] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            found = Page(html.as_py() or "").vote()
            if found:
                tally[(host, found[0])] = tally.get((host, found[0]), 0) + found[1]
        rows = [(host, path, votes) for (host, path), votes in tally.items()]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64()))], ["host", "path", "votes"]
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(html.as_py() or "").text(path) for html, path in zip(batch.column("html"), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text``.

    A null or empty html gives an empty text.  Pages without a host in their url vote together.
    Equal votes are settled by the path's order.  A page takes time and memory in proportion to its length, however deep or broken.  Rows that repeat a page each vote and each come out.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string, votes double")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    winners = summed.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))
    # Stored, the paths have a known size: while they are few the optimizer sends them to the pages, and beyond that it splits a
    # host with very many pages, as any skewed side of a join.
    joined = rows.join(stored(winners), "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(_extract, "page_id long, url string, text string")


@query()
def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
