"""Article digest: page paragraphs, list items, topic sections and Markdown entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import ColumnOrName, as_column
from depotlens.functions.text import SPACE, excerpt, page_blocks

# The size of a digest entry, for callers that want short ones, and the shortest list item.
MOST_PARAGRAPHS = 12
MOST_BULLETS = 40
EXCERPT_LENGTH = 2500
SHORTEST_BULLET = 3

# Texts of a digest entry.
UNTITLED = "(untitled)"
BULLETS_HEADING = "**Extracted list items (candidate tips):**"
EXCERPT_HEADING = "**Summary excerpt:**"
NO_EXCERPT = "_No plain-text excerpt._"


def html_paragraphs(html: ColumnOrName, most: int | None = None) -> Column:
    """Paragraphs and sub-headings joined by blank lines, or all text when there are none."""
    return joined_paragraphs(page_blocks(html)["paragraphs"], most)


def joined_paragraphs(paragraphs: Column, most: int | None = None) -> Column:
    return F.array_join(paragraphs if most is None else F.slice(paragraphs, 1, most), "\n\n")


def ordered_dedupe(array: ColumnOrName) -> Column:
    return F.array_distinct(as_column(array))


def html_bullets(html: ColumnOrName) -> Column:
    """List items, white space collapsed, longer than two characters, first of equal ones kept."""
    return listed_bullets(page_blocks(html)["items"])


def listed_bullets(items: Column) -> Column:
    items = F.transform(items, lambda item: F.trim(F.regexp_replace(item, SPACE, " ")))
    return ordered_dedupe(F.filter(items, lambda item: F.length(item) >= SHORTEST_BULLET))


def topic_flag(
    title: ColumnOrName, tags: ColumnOrName, text: ColumnOrName, keyword: str
) -> Column:
    """Keyword in title, tags or text, whatever the case. The whole text is searched."""
    blob = F.concat_ws(" ", as_column(title), as_column(tags), as_column(text))
    return F.lower(blob).contains(keyword.lower())


def digest(
    articles: DataFrame, keyword: str, most_bullets: int | None = None, excerpt_length: int | None = None
) -> DataFrame:
    """One row per article: section, metadata, list items, omitted items, excerpt and Markdown.

    Order the rows by section (focus first) and title for a readable document. The section follows from the
    whole text; ``most_bullets`` and ``excerpt_length`` shorten what is shown.
    """
    prepared = articles.select(
        F.coalesce(F.nullif("title", F.lit("")), F.lit(UNTITLED)).alias("title"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("url", "author", "published", "reading_time")],
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        page_blocks("summary").alias("blocks"),
    )
    plain, bullets = joined_paragraphs(F.col("blocks.paragraphs")), listed_bullets(F.col("blocks.items"))
    prepared = prepared.select("*", plain.alias("plain"), bullets.alias("bullets"))
    shown = F.size("bullets") if most_bullets is None else F.least(F.size("bullets"), F.lit(most_bullets))
    focus = topic_flag("title", "tags", "plain", keyword)
    out = prepared.select(
        F.when(focus, F.lit("focus")).otherwise(F.lit("other")).alias("section"),
        "title",
        "url",
        "author",
        "published",
        "reading_time",
        F.array_join("tags", ", ").alias("tags"),
        F.slice("bullets", 1, shown).alias("bullets"),
        (F.size("bullets") - shown).cast("bigint").alias("omitted_bullets"),
        (F.col("plain") if excerpt_length is None else excerpt("plain", excerpt_length)).alias("excerpt"),
    )
    return out.withColumn("markdown", _markdown())


def _markdown() -> Column:
    def line(label: str, column: str) -> Column:
        filled = F.col(column) != ""
        return F.when(filled, F.concat(F.lit(f"- **{label}:** "), F.col(column)))

    head = F.concat_ws(
        "\n",
        F.concat(F.lit("### "), F.col("title")),
        F.lit(""),
        line("URL", "url"),
        line("Author", "author"),
        line("Published", "published"),
        line("Reading time", "reading_time"),
        line("Tags", "tags"),
    )
    more = F.when(
        F.col("omitted_bullets") > 0,
        F.concat(F.lit("\n- _… "), F.col("omitted_bullets").cast("string"), F.lit(" more list items omitted_")),
    ).otherwise(F.lit(""))
    items = F.when(
        F.size("bullets") > 0,
        F.concat(
            F.lit(BULLETS_HEADING + "\n\n"),
            F.array_join(F.transform("bullets", lambda b: F.concat(F.lit("- "), b)), "\n"),
            more,
        ),
    )
    text = F.when(F.col("excerpt") == "", F.lit(NO_EXCERPT)).otherwise(F.col("excerpt"))
    return F.concat_ws("\n\n", head, items, F.lit(EXCERPT_HEADING), text, F.lit("---"))
