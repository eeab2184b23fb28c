"""Main text of web pages by paths that the pages of a host agree on.

A page's containers are scored by the text that stands in them outside links. The article that encloses the best one, or
else the highest container that adds more than links to it, votes for its path, the
tags and classes from the root with digits generalised, so that ``post-17`` and ``post-18`` are one class. Votes are
counted for each host in Spark, and every page of the host is extracted again from the winning path. A page that has
no such path is extracted from its own best container.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices, staged

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("body article main section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag of these ends, if open.
ENDS_P = BLOCK - {"body", "html", "caption", "option", "optgroup"}
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: What is never part of the article.
NOT_TEXT = frozenset(
    "head title script style noscript template nav footer aside button select textarea iframe object svg canvas menu dialog audio video".split()
)
BOILERPLATE = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted "
    "promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored sponsors subscribe toolbar widget".split()
)
#: Of these, the ones that name what stands beside an article; the others also name layouts that hold one.
BESIDE = frozenset(
    "comment comments consent cookie cookies disqus gdpr newsletter promo promoted promotion recommended related replies reply respond signup "
    "sponsor sponsored sponsors subscribe".split()
)
#: What follows or precedes these in a name is a property of the element, as in ``has-sidebar`` and ``ad-free``.
HAS, FREE = frozenset("has have with without no not hide".split()), frozenset("free open closed enabled disabled off".split())
#: With ``header`` in a name, the article's own.
OF_ARTICLE = frozenset("article content entry post single story".split())
#: What may stand in head; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")


def _names(text: str, article: bool) -> set[str]:
    """The words of BOILERPLATE that a class or id says the element is."""
    found: set[str] = set()
    for name in text.split():
        words = [w.lower() for w in WORD.findall(name)]
        if not words or words[-1] in FREE:
            continue
        own = article or not OF_ARTICLE.isdisjoint(words)
        for word in words:
            if word in HAS:
                break
            if word in BOILERPLATE and not (word == "header" and own):
                found.add(word)
    return found


NONE: frozenset[str] = frozenset()


class _Node:
    """An element. ``hard``: never text, with all that stands in it; ``soft``: the innermost element, itself included,
    that its form tag or role, class or id tells not to be, unless it turns out to hold the article; ``beside``: its
    name is one of BESIDE; ``article``: the outermost article or main that it stands in; ``box``: the innermost container
    or root, itself included; ``name``: its own part of the path."""

    __slots__ = ("tag", "parent", "name", "box", "hard", "soft", "beside", "holds", "chars", "article", "dropped", "link", "score")

    def __init__(self, tag: str, parent: _Node | None, attrs: dict[str, str]):
        classes = sorted({DIGITS.sub("N", c) for c in attrs.get("class", "").split()})
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        self.tag, self.parent, self.score = tag, parent, 0.0
        self.name = f"/{'.'.join([tag, *classes])}" if parent else ""
        self.box = self if tag in CONTAINER or parent is None else parent.box
        within = parent.article if parent else None
        self.article = within or (self if tag in ("article", "main") else None)
        article_header = tag == "header" and (within is not None or not OF_ARTICLE.isdisjoint(w.lower() for w in WORD.findall(names)))
        said = set() if tag in ("body", "html", "article", "main") or article_header else _names(names, within is not None)
        role = attrs.get("role")
        own = (
            tag in NOT_TEXT
            or tag == "header" and not article_header
            or role in ROLES and role != "form"
            or "hidden" in attrs
            or attrs.get("aria-hidden") == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "")
        )
        self.hard = own or (parent is not None and parent.hard)
        self.soft = self if tag == "form" or role == "form" or said else parent.soft if parent else None
        self.beside = not said.isdisjoint(BESIDE)
        self.holds, self.chars, self.dropped = NONE, 0, False
        self.link = tag == "a" or (parent is not None and parent.link)

    @property
    def path(self) -> str:
        """The names from the root to the element. Elements keep their own name only: a page may be nested very deeply."""
        names, at = [], self
        while at is not None:
            names.append(at.name)
            at = at.parent
        return "".join(reversed(names))


class Page(HTMLParser):
    """A page's text runs, each with its element and the number of its block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open = [_Node("", None, {})]
        self.nodes = self.open[:]
        self.block = 0
        self.headed = False
        self.runs: list[tuple[_Node, int, str]] = []
        self.feed(html)
        self.close()
        self._drop()

    def _drop(self) -> None:
        """Marks what is not text. A form, or an element with a word of BOILERPLATE, is text if it holds the article.

        That is: it holds main; or, where no other article has text outside such elements, it holds an article or most of
        the text, of the article that it stands in or else of the page. One that is named after what stands beside an
        article is text only with main or with all of the text.
        """
        softs = [x for x in self.nodes if x.soft is x and not x.hard]
        kept: set[int] = set()
        if softs:
            for node in self.nodes:
                if node.tag in ("article", "main") and not node.hard:
                    at = node.soft
                    while at is not None:
                        at.holds |= {node.tag}
                        at = at.parent.soft
            total, free, within = 0, False, {}
            for node, _, data in self.runs:
                if node.hard or node.link or not (n := len(data.strip())):
                    continue
                total += n
                free |= node.soft is None and node.article is not None
                if node.article is not None:
                    within[id(node.article)] = within.get(id(node.article), 0) + n
                at = node.soft
                while at is not None:
                    at.chars += n
                    at = at.parent.soft
            for x in softs:
                inside = x.article is not None
                most = within.get(id(x.article), 0) if inside else total
                if "main" in x.holds or (x.chars == most > 0 if x.beside else (inside or not free) and ("article" in x.holds or 2 * x.chars > most)):
                    kept.add(id(x))
        for node in self.nodes:
            node.dropped = node.hard or node.soft is node and id(node) not in kept or node.parent is not None and node.parent.dropped

    def _end(self, tags: tuple[str, ...], within: frozenset[str]) -> None:
        """Ends the innermost open element of ``tags`` and all inside it, unless one of ``within`` stands between."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._end(("p",), CONTAINER)
        for old in ENDS.get(tag, ()):
            self._end((old,), frozenset(("ul", "ol", "dl", "table", "select", "tr" if old in ("td", "th") and tag != "tr" else "table")))
        if tag == "head" and (self.headed or self.open[-1].tag not in ("", "html")):
            return  # there is one head, before the body
        self.headed |= tag == "head"
        if tag == "body" or self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._end(("head",), frozenset())
        if tag in BLOCK:
            self.block += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in ("html", "body") and any(x.tag == tag for x in self.open):
            return
        if tag not in VOID:
            self.open.append(_Node(tag, self.open[-1], {k: v or "" for k, v in attrs}))
            self.nodes.append(self.open[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends no element that has content

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        if tag not in ("html", "body"):
            self._end((tag,), CONTAINER - {tag} if tag not in BLOCK else frozenset())

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            del self.open[-1]
        self.runs.append((self.open[-1], self.block, data))

    def best(self) -> tuple[str, float]:
        """The path of the container with the highest score, and that score; an empty path for a page without text."""
        scored: dict[int, _Node] = {}
        for node, _, data in self.runs:
            if node.dropped or not (n := len(data.strip())):
                continue
            worth, share, at = (-float(n) if node.link else n + 10.0 * data.count(",")), 1.0, node.box
            while at is not None and share > 0.2:
                at.score += worth * share
                scored[id(at)] = at
                share *= 0.5
                at = at.parent and at.parent.box
        if not scored:
            return "", 0.0

        def rank(node: _Node) -> float:
            return node.score * (1.5 if node.tag in ("article", "main") else 1.0)

        most = max(map(rank, scored.values()))
        ties = {i for i, x in scored.items() if rank(x) == most}
        above: set[int] = set()  # of ties, an element's path comes after those it stands in
        if len(ties) > 1:
            for node in reversed(self.nodes):
                if node.parent is not None and (id(node) in ties or id(node) in above):
                    above.add(id(node.parent))
        top = max((scored[i] for i in ties - above), key=lambda x: x.path)
        return self._enclosing(top).path, max(top.score, 0.0)

    def _enclosing(self, top: _Node) -> _Node:
        """The container that the best one is a part of: the outermost article around it, or else main.

        Where there is neither, and from an article on to main, it is the highest container whose text outside the one
        below is not mostly links. ``body`` and the root hold the page's furniture too: a single word outside that is
        no heading doesn't lead there.
        """
        chain = [top]
        while (above := chain[-1].parent) is not None:
            chain.append(above)
        article = max((i for i, x in enumerate(chain) if x.tag == "article"), default=None)
        main = next((i for i, x in enumerate(chain) if x.tag == "main"), None)
        last = len(chain) - 1 if main is None else main
        if article is not None and (main is None or main < article):
            return chain[article]
        if article is None and main is not None:
            return chain[main]
        # Of each element of the chain, the characters outside and inside links, words and headings that the one below lacks.
        place = {id(x): i for i, x in enumerate(chain)}
        joins: dict[int, tuple[int, bool, bool]] = {}
        for node in self.nodes:  # the root is in the chain, and parents come first
            if id(node) in place:
                joins[id(node)] = place[id(node)], False, False
            else:
                i, heading, title = joins[id(node.parent)]
                joins[id(node)] = i, heading or node.tag in HEADINGS, title or node.tag == "h1"
        plain, linked, words, headed = ([0] * len(chain) for _ in range(4))
        for node, _, data in self.runs:
            if node.dropped or not (n := len(data.strip())):
                continue
            i, heading, title = joins[id(node)]
            link = node.link and not title
            linked[i] += n * link
            plain[i] += n * (not link)
            words[i] += len(data.split())
            headed[i] |= heading
        at = article or 0
        more = [0, 0, 0, 0]  # what stands between the container chosen so far and the one looked at
        for i in range(at + 1, last + 1):
            more = [more[0] + plain[i], more[1] + linked[i], more[2] + words[i], more[3] | headed[i]]
            whole = chain[i].tag == "body" or chain[i].parent is None
            if not (chain[i].tag in CONTAINER or whole) or not more[0] + more[1]:
                continue
            if more[1] > more[0] or whole and more[2] < 2 and not more[3]:
                break
            at, more = i, [0, 0, 0, 0]
        return chain[at]

    def text(self, path: str) -> str | None:
        """The blocks of the elements at ``path``, or None if there is no text."""
        # How much of ``path`` the names down to an element spell, -1 where they spell something else.
        spelled: dict[int, int] = {}
        inside: dict[int, bool] = {}
        for node in self.nodes:
            at = 0 if node.parent is None else spelled[id(node.parent)]
            at = at + len(node.name) if at >= 0 and path.startswith(node.name, at) else -1
            spelled[id(node)] = at
            inside[id(node)] = at == len(path) or node.parent is not None and inside[id(node.parent)]
        blocks: dict[int, list[str]] = {}
        for node, block, data in self.runs:
            if not node.dropped and inside[id(node)]:
                blocks.setdefault(block, []).append(data)
        found = [x for x in (" ".join("".join(b).split()) for b in blocks.values()) if x]
        return "\n\n".join(found) if found else None


def extracted(html: str, path: str | None) -> str:
    """The text at the host's path, or else at the page's own best container; empty if there is none."""
    page = Page(html)
    text = page.text(path) if path is not None else None
    return text if text is not None else page.text(page.best()[0]) or ""


def url_host(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_paths(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """host, path, votes, score: the path that most pages of a host vote for; ties: higher score, then the last by name."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            best = [Page(x).best() if x else ("", 0.0) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([p for p, _ in best], pa.string()), pa.array([s for _, s in best], pa.float64())],
                names=["host", "path", "score"],
            )

    votes = pages.select(F.col(host).alias("host"), F.col(html).cast("string").alias("html")).mapInArrow(vote, "host string, path string, score double")
    # Scores are whole numbers and simple fractions of them; rounding makes the sum independent of the order.
    counted = votes.filter("path <> ''").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("best")).select("host", "best.*")


def html_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``, from the whole html.

    A null or empty html gives an empty text. Pages whose url is null or has no host vote as one host. Repeated rows
    vote and return as often as they occur; other columns are ignored, whatever their names. No rows give no rows.
    The table of winning paths is written before it is joined, so Spark knows its size: it is broadcast only within
    ``spark.sql.autoBroadcastJoinThreshold``, and else both sides are shuffled and a hot host's part is split.
    """
    source = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        url_host(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"),
    )
    winners = staged(host_paths(source).select("host", "path"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [extracted(x, p) if x else "" for x, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    joined = source.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
