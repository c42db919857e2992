"""Text helpers: names, links, patterns and web-page text."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from depotlens.functions.columns import ColumnOrName, as_column

SPACE = r"\s+"


def clean_str(value: ColumnOrName, floating: bool = False) -> Column:
    """Text of a value; NULL, and NaN of a ``floating`` column, become ''."""
    subject = as_column(value)
    text = F.coalesce(subject.cast("string"), F.lit(""))
    return F.when(F.isnan(subject), F.lit("")).otherwise(text) if floating else text


def collapse_space(value: ColumnOrName) -> Column:
    return F.trim(F.regexp_replace(as_column(value), SPACE, " "))


def title_words(value: ColumnOrName) -> Column:
    """'picking_started' -> 'Picking Started'."""
    return F.initcap(F.replace(as_column(value), F.lit("_"), F.lit(" ")))


def safe_title(title: ColumnOrName, longest: int = 100) -> Column:
    """File name of a title: its letters, digits, spaces, '-' and '_', ``longest`` at most, '_' for spaces."""
    kept = F.trim(F.regexp_replace(as_column(title), r"[^\p{L}\p{N} _-]", ""))
    return F.replace(F.substring(kept, 1, longest), F.lit(" "), F.lit("_"))


def safe_file_index(index: ColumnOrName, title: ColumnOrName) -> Column:
    return F.concat(F.lpad(as_column(index).cast("string"), 3, "0"), F.lit("_"), safe_title(title), F.lit(".json"))


# What stands before a video's id in a link, and what ends the id.
VIDEO_LINKS = {"youtube.com/watch?v=": "&", "youtu.be/": "?", "youtube.com/embed/": "?"}


def video_id(url: ColumnOrName) -> Column:
    """Id of a video link in one of the known forms, else NULL."""
    link = as_column(url)
    found = (
        F.when(link.contains(marker), F.substring_index(F.split_part(link, F.lit(marker), F.lit(2)), end, 1))
        for marker, end in VIDEO_LINKS.items()
    )
    return F.coalesce(*found)


def join_segments(segments: ColumnOrName, field: str = "text") -> Column:
    return F.array_join(F.transform(as_column(segments), lambda s: s[field]), " ")


def truncate(text: ColumnOrName, length: int) -> Column:
    return F.substring(as_column(text), 1, length)


def excerpt(text: ColumnOrName, length: int = 2500) -> Column:
    subject = as_column(text)
    return F.when(F.length(subject) > length, F.concat(truncate(subject, length), F.lit("…"))).otherwise(subject)


def search_contains(value: ColumnOrName, term: str) -> Column:
    return F.lower(as_column(value)).contains(term.lower())


def nth(array: ColumnOrName, n: int) -> Column:
    """n-th element from 1, or NULL."""
    return F.try_element_at(as_column(array), F.lit(n))


# --- web pages ---------------------------------------------------------------------------

# Elements without content, and elements whose content is no text.
VOID_TAGS = frozenset(
    "area base basefont br col embed frame hr img input keygen link menuitem meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset({"script", "style"})


# Elements whose texts are paragraphs and list items of an article.
PARAGRAPH_TAGS = frozenset({"p", "h3", "h4"})
ITEM_TAGS = frozenset({"li"})


class _BlockReader(HTMLParser):
    """Texts of paragraphs and list items in document order; an unclosed element ends with its parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.begin()

    def begin(self):
        """Forget the page before."""
        self.reset()
        self.open: list[tuple[str, list[str] | None]] = []
        self.paragraphs: list[list[str]] = []
        self.items: list[list[str]] = []
        self.everything: list[str] = []
        self.hidden = 0
        self.pending: list[str] = []

    def flush(self):
        text = "".join(self.pending).strip()
        self.pending.clear()
        if not text or self.hidden:
            return
        self.everything.append(text)
        for _, texts in self.open:
            if texts is not None:
                texts.append(text)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in VOID_TAGS:
            return
        kept = self.paragraphs if tag in PARAGRAPH_TAGS else self.items if tag in ITEM_TAGS else None
        texts = None
        if kept is not None:
            texts = []
            kept.append(texts)
        self.open.append((tag, texts))
        self.hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                self.hidden -= sum(name in HIDDEN_TAGS for name, _ in self.open[place:])
                del self.open[place:]
                return


#: Pages whose texts a task holds at once; Arrow batches have thousands, of any length.
PAGES_AT_ONCE = 64


def _read_pages(pages: pa.Array) -> pa.Array:
    """Paragraphs (all text if there are none) and list items of some pages, each read once."""
    reader, paragraphs, items = _BlockReader(), [], []
    for page in pages.to_pylist():
        reader.begin()
        if page and page.strip():
            reader.feed(page)
            reader.close()
            reader.flush()
        found = [" ".join(texts) for texts in reader.paragraphs if texts]
        if not found and reader.everything:
            found = [" ".join(reader.everything)]
        paragraphs.append(found)
        items.append([" ".join(texts) for texts in reader.items if texts])
    lists = pa.list_(pa.string())
    return pa.StructArray.from_arrays([pa.array(paragraphs, lists), pa.array(items, lists)], names=["paragraphs", "items"])


def _read_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for start in range(0, len(batch), PAGES_AT_ONCE):
            yield _read_pages(batch.slice(start, PAGES_AT_ONCE))


def page_blocks(html: ColumnOrName) -> Column:
    """Struct of the non-empty paragraphs and list items of a page.

    Real pages leave elements open and use character references, which patterns cannot resolve, so
    the pages go through the standard parser, once for both lists. They stay in their Arrow batch but for a few at a time.
    """

    @F.arrow_udf("paragraphs array<string>, items array<string>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _read_batches(batches)

    return read(as_column(html))
