"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored by the text they hold. The page votes for the generalised path (tags and
classes without digits) of its best container, Spark counts the votes of each host, and every page is
extracted again from the containers on its host's winning path, or from its own best one if it has none.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.session import settle

# Element names of HTML and the words that mark what is not article text.
CONTAINERS = frozenset("body div article main section td center blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot caption tr th pre hr figure figcaption address "
    "details summary header footer nav aside form fieldset html head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg select object".split())
LEFT_OUT = frozenset("nav aside form footer button fieldset dialog menu label".split())
SEMANTIC = frozenset("article main".split())
CLOSED_BY = {"li": "ul ol".split(), "dt": ["dl"], "dd": ["dl"], "td": ["tr", "table"], "th": ["tr", "table"], "tr": ["table"]}
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent notice "
    "notices alert alerts sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist respond "
    "replies reviews reactions responses discussion disqus share sharing social related recommended newsletter subscribe signup popup "
    "modal overlay widget widgets pagination pager toolbar login search".split()
)
HEADERS = frozenset("header masthead topbar".split())
#: Words that may stand beside such a word in a name without giving it another sense.
BESIDE = HEADERS | frozenset(
    "box bar block list item items container wrapper wrap area section content inner outer left right top bottom main site page post posts "
    "article articles entry stories news global primary secondary button buttons link links icon icons form field input slot unit panel "
    "group row col column holder sticky fixed mobile desktop title text body message messages results thread".split()
)
#: Forms that say what an element has or lacks, not what it is.
HAS_OR_NOT = re.compile(r"(?<![^\s_-])(?:has|no|with|without)[_-]\S*", re.I)
NAME_PARTS = re.compile(r"[^\W\d_]+")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _left_out(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no article text by its tag or attributes, whatever it holds."""
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    return hidden or attributes.get("role") in ROLES or "display:none" in attributes.get("style", "").replace(" ", "")


def _named_boilerplate(attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a name of class or id says so: a boilerplate word, and beside it only words that leave it its sense.

    ``search-form`` and ``comments`` say it, ``search-engine`` and ``alert-system`` do not.
    """
    names = HAS_OR_NOT.sub(" ", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower()
    for name in names.split():
        parts = set(NAME_PARTS.findall(name))
        telling = parts & BOILERPLATE or (not in_article and parts & HEADERS)
        if telling and parts <= BOILERPLATE | BESIDE:
            return True
    return False


class Page:
    """Blocks of text of a page with the innermost container around each, boilerplate elements left out.

    Class and id words do not judge main elements, articles outside other articles, and what is around a main
    element or the article with the most text outside links; which one that is shows at the end of the page.
    Containers, their paths and named elements know their parents only, so work and memory grow with the
    page and not with its depth.
    """

    def __init__(self, source: str):
        self.inside: list[int] = []  # container around each container, or -1
        self.path: list[int] = []  # number of its path
        self.semantic: list[bool] = []
        self.steps: list[tuple[int, str]] = []  # path before and last name of each path
        self.numbers: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self.stack: list[tuple[str, bool, bool, int]] = []  # tag, is a container, is left out, named element around
        self.opened: Counter[str] = Counter()
        self.around: list[int] = [-1]
        self.named: list[int] = []  # named element around each element that class or id words leave out, or -1
        self.name = -1  # innermost of these open now
        self.exempt: list[int] = []  # named elements that are exempt with all around them
        self.plain = self.depth = 0  # characters outside links, open articles
        self.core: tuple[int, int] = (-1, -1)  # characters of the best article, named element around it
        self.started: list[int] = []  # characters before each open article
        self.raw: list[tuple[int, list[tuple[str, bool, int]]]] = []
        self.text: list[tuple[str, bool, int]] = []  # words, in a link, named element around
        self.out = self.links = self.articles = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = TAG.search(source, at)
            self._words(source[at : found.start() if found else len(source)])
            if not found:
                break
            at = found.end()
            name = found[2] or found[5]
            if not name:
                continue
            tag = name.lower()
            if found[1] or found[4]:
                self._close(tag)
            elif tag in RAW:
                if not (found[3] or found[6] or "").endswith("/"):
                    ending = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    at = ending.end() if ending else len(source)
            else:
                self._open(tag, found[3] or found[6] or "")
        self._flush()
        while self.stack:
            self._pop()
        self._judge()

    def _words(self, text: str) -> None:
        if text and not self.out:
            self.text.append((text, self.links > 0, self.name))
            if not self.links:
                self.plain += len(text)

    def _flush(self) -> None:
        if self.text:
            self.raw.append((self.around[-1], self.text))
            self.text = []

    def _judge(self) -> None:
        exempt = [False] * len(self.named)
        for named in (*self.exempt, self.core[1]):
            while named >= 0 and not exempt[named]:
                exempt[named] = True
                named = self.named[named]
        kept = [True] * (len(self.named) + 1)  # the last one stands for -1
        for at, around in enumerate(self.named):
            kept[at] = exempt[at] and kept[around]
        for around, parts in self.raw:
            some = [(t, linked) for t, linked, named in parts if kept[named]]
            text = " ".join(markup.unescape("".join(t for t, _ in some)).split())
            if text:
                self.blocks.append((around, text, sum(len(t) for t, linked in some if linked)))
        self.raw = []

    def _open(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._flush()
            if any(t == "p" for t, *_ in self.stack[-8:]) and tag != "html":
                self._close("p", stop=CONTAINERS)
            if tag in CLOSED_BY:
                self._close(tag, stop=CLOSED_BY[tag])
        elif tag == "br":
            self._words(" ")
        if tag in VOID or rest.endswith("/"):
            return
        attributes = _attributes(rest)
        out = self.out > 0 or _left_out(tag, attributes, self.articles > 0)
        holds = tag in CONTAINERS
        if holds:
            label = re.sub(r"\d+", "#", ".".join([tag, *sorted(attributes.get("class", "").split())]))
            parent = self.around[-1]
            step = (self.path[parent] if parent >= 0 else -1, label)
            if step not in self.numbers:
                self.numbers[step] = len(self.steps)
                self.steps.append(step)
            self.around.append(len(self.inside))
            self.inside.append(parent)
            self.path.append(self.numbers[step])
            self.semantic.append(tag in SEMANTIC)
        self.stack.append((tag, holds, out, self.name))
        self.opened[tag] += 1
        judged = tag not in ("html", "body", "main") and not (tag == "article" and not self.depth)
        if attributes and not out and judged and _named_boilerplate(attributes, self.articles > 0):
            self.named.append(self.name)
            self.name = len(self.named) - 1
        if tag == "main" and not out:
            self.exempt.append(self.name)
        if tag == "article":
            self.depth += 1
            self.started.append(self.plain)
        self.out += out
        self.links += tag == "a"
        self.articles += tag in SEMANTIC

    def _close(self, tag: str, stop=()) -> None:
        if tag in BLOCKS:
            self._flush()
        if not self.opened[tag]:
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                break
            if self.stack[depth][0] in stop:
                return
        while len(self.stack) > depth:
            self._pop()

    def _pop(self) -> None:
        tag, holds, out, self.name = self.stack.pop()
        self.opened[tag] -= 1
        if tag in BLOCKS:
            self._flush()
        if tag == "article":
            self.depth -= 1
            size = self.plain - self.started.pop()
            if not self.depth and not self.out and size > self.core[0]:
                self.core = (size, self.name)
        if holds:
            self.around.pop()
        self.out -= out
        self.links -= tag == "a"
        self.articles -= tag in SEMANTIC

    def scores(self) -> list[float]:
        """Characters outside links, halved for each container in between; articles get all of theirs."""
        halved = [0.0] * len(self.inside)
        for c, text, linked in self.blocks:
            if c >= 0:
                halved[c] += len(text) - 2.0 * linked
        whole = list(halved)
        for c in range(len(self.inside) - 1, -1, -1):  # containers come before those inside them
            if self.inside[c] >= 0:
                halved[self.inside[c]] += halved[c] / 2
                whole[self.inside[c]] += whole[c]
        return [w if s else h for h, w, s in zip(halved, whole, self.semantic)]

    def path_text(self, container: int) -> str:
        names, path = [], self.path[container]
        while path >= 0:
            path, name = self.steps[path]
            names.append(name)
        return ">".join(reversed(names))

    def _best(self) -> tuple[int, float]:
        """Number and score of the best container, the first of equal ones; -1 if none has a score above 0."""
        scores = self.scores()
        at = max(range(len(scores)), key=lambda i: (scores[i], -i), default=-1)
        return (at, scores[at]) if at >= 0 and scores[at] > 0 else (-1, 0.0)

    def best(self) -> tuple[str | None, float]:
        """Path and score of the best container."""
        at, score = self._best()
        return (self.path_text(at), score) if at >= 0 else (None, 0.0)

    def _number(self, path: str) -> int:
        """Number of a path on this page, or -1: each path continues the one before it by its last name."""
        upto: list[int] = []
        for number, (before, name) in enumerate(self.steps):
            at = 0 if before < 0 else upto[before] + 1
            fits = (before < 0 or (upto[before] >= 0 and path.startswith(">", at - 1))) and path.startswith(name, at)
            upto.append(at + len(name) if fits else -1)
            if fits and upto[-1] == len(path):
                return number
        return -1

    def _inside(self, number: int) -> str:
        """Text inside the containers of a path, in page order."""
        within = [False] * (len(self.inside) + 1)  # the last one stands for -1
        for c, (parent, path) in enumerate(zip(self.inside, self.path)):
            within[c] = path == number or within[parent]
        return "\n".join(t for c, t, _ in self.blocks if within[c])

    def extract(self, path: str | None) -> str:
        """Text inside the containers on the path, or else of the page's best container, or else all of it."""
        number = -1 if path is None else self._number(path)
        text = self._inside(number) if number >= 0 else ""
        if not text:
            best, _ = self._best()
            text = self._inside(self.path[best]) if best >= 0 else ""
        return text or "\n".join(t for _, t, _ in self.blocks)


def _vote(batches):
    for batch in batches:
        best = [Page(source.as_py()).best() for source in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([p for p, _ in best], pa.string()), pa.array([s for _, s in best], pa.float64())],
            names=["host", "path", "score"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path) with the most votes of the pages (host, html); then the highest score, then path order.

    Votes are summed in each task before the shuffle, so a host with most pages is no hot key.
    """
    votes = pages.mapInArrow(_vote, "host string, path string, score double").where(F.col("path").isNotNull())
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    best = F.min(F.struct(-F.col("votes"), -F.round("score", 3), "path"))
    return counted.groupBy("host").agg(best.alias("b")).select("host", "b.path")


def _extract(batches):
    for batch in batches:
        texts = [
            Page(source.as_py()).extract(path.as_py()) for source, path in zip(batch.column("html"), batch.column("path"))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
                batch.column("path"),
            ],
            names=["page_id", "url", "text", "n_chars", "host_path"],
        )


def extract_main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars and host_path (null if the host has none).

    Blocks are joined by one line feed; white space inside a block, line breaks included, is one space. A
    null or empty page has empty text. Equal scores go to the first container, equal votes to the higher score and then
    to path order; work grows with a page's length, however deep or unclosed its elements are. Pages without a host in their address vote together. Repeated rows get
    equal results, an empty table an empty one.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("host", host_of(F.col("url")))
    winners = settle(host_paths(rows.select("host", "html")))
    kind = rows.schema["page_id"].dataType.simpleString()
    return (
        rows.join(winners, "host", "left")
        .select("page_id", "url", "html", "path")
        .mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long, host_path string")
    )
