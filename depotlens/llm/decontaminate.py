"""Benchmark decontamination over a distributed positional inverted index.

Items are cut into phrases (windows of consecutive words). The corpus-wide frequency of every item term
is counted, the rarest terms of each phrase are chosen, and only their postings (document, position) are
stored. A phrase is looked up from its rarest term on: each posting proposes a start, the offset-adjusted
postings of the next rarest terms must agree with it, and the words kept around the rarest posting
confirm the whole phrase. Starts that the stored terms confirm only nearly give the proximity matches.
All of it is DataFrame work.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.base import KEY, keyed, lower_ascii
from depotlens.session import settle

#: What stands between words of lower-cased text, and of text as it is.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Below so many rows of term strings (about 50 MB) a table of terms is broadcast, beyond it is shuffled.
BROADCAST_TERMS = 500_000
#: Words of a block, by which texts meet postings whose terms are too many to broadcast.
BLOCK = 512


def word_list(text: Column) -> Column:
    """Words of a text: A-Z in lower case, runs of ASCII digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def phrases_of(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = 13) -> DataFrame:
    """(item_id, phrase): each run of ``window`` words of an item, or all words of a shorter one.

    An item without words has no phrase; rows repeating an item add nothing.
    """
    words = items.select(F.col(item_id).alias("item_id"), word_list(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return words.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("phrase")
    ).distinct()


def _lower_word(word: Column) -> Column:
    """``lower_ascii`` of a single word."""
    folded = F.translate(word, ascii_uppercase, ascii_lowercase)
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(folded)


def listed(docs: DataFrame) -> DataFrame:
    """Key, doc_id and the words of each text, in the case they are written in (null for a null text)."""
    return docs.select(*KEY, "doc_id", F.array_remove(F.split("text", RAW_SEPARATORS), "").alias("w"))


def _postings(words: DataFrame, *kept: str) -> DataFrame:
    """One row per word: key, position from 0, term in lower case, and the columns ``kept``."""
    each = words.select(*KEY, *kept, F.posexplode("w").alias("pos", "word"))
    return each.select(*KEY, *kept, "pos", _lower_word(F.col("word")).alias("term"))


def _few(terms: DataFrame) -> bool:
    return terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS


def _frequencies(words: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of the distinct terms occurs; many terms meet counts, not postings."""
    each = _postings(words)
    if _few(terms):
        each = each.join(F.broadcast(terms), "term")
    counted = each.groupBy("term").agg(F.count("*").alias("n"))
    return counted.join(terms, "term", "left_semi")


def _stored(words: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """Postings of the chosen terms; those that lead a phrase keep the words around them, in the case of the text.

    Few terms are broadcast, and the words are cut from the text where the posting is found. Otherwise postings
    travel without words, and leading ones then meet the overlapping blocks of ``BLOCK`` words of their text.
    """
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    length = F.col("pos") + window - first
    if _few(chosen):
        around = F.when(F.col("leads"), F.slice("w", first + 1, length))
        found = _postings(words, "w").join(F.broadcast(chosen), "term")
        return found.select(*KEY, "term", "pos", around.alias("around"))

    def begin(block: Column) -> Column:
        return F.greatest(block * BLOCK - (window - 1), F.lit(0))

    def cut(block: Column) -> Column:
        return F.slice("w", begin(block) + 1, (block + 1) * BLOCK + (window - 1) - begin(block))

    numbers = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / BLOCK).cast("int"))
    blocks = (
        words.where(F.size("w") > 0)
        .select(*KEY, F.posexplode(F.transform(numbers, cut)).alias("block", "near"))
        .dropDuplicates([*KEY, "block"])
    )
    block = F.when(F.col("leads"), F.floor(F.col("pos") / BLOCK).cast("int"))
    found = _postings(words).join(chosen, "term").distinct().withColumn("block", block)
    around = F.slice("near", first - begin(F.col("block")) + 1, length)
    return found.join(blocks, [*KEY, "block"], "left").select(*KEY, "term", "pos", around.alias("around"))


def _rarest(phrases: DataFrame, frequency: DataFrame, depth: int) -> DataFrame:
    """(phrase, leads): up to ``depth`` (n, term, offset) of the rarest terms, rarest first.

    A phrase with a term that the corpus lacks occurs nowhere and is dropped.
    """
    spots = phrases.select("phrase").distinct().select("phrase", F.posexplode("phrase").alias("offset", "term"))
    return (
        spots.join(frequency, "term")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("leads"))
        .where(F.size("leads") == F.size("phrase"))
        .select("phrase", F.slice("leads", 1, depth).alias("leads"))
    )


def build_index(docs: DataFrame, phrases: DataFrame, depth: int = 3, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """The phrases with their rarest terms, and the stored postings of those terms.

    ``docs`` has the columns of ``keyed``. A posting of a term that leads a phrase keeps the
    ``window`` - 1 words to either side.
    """
    return index_words(settle(listed(docs), compression="zstd"), phrases, depth, window)


def index_words(words: DataFrame, phrases: DataFrame, depth: int = 3, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """``build_index`` of stored word lists (``listed``), which are read twice."""
    terms = settle(phrases.select(F.explode("phrase").alias("term")).distinct())
    plans = settle(_rarest(phrases, settle(_frequencies(words, terms)), depth))
    leading = plans.select(F.col("leads")[0]["term"].alias("term"), F.lit(True).alias("leads"))
    others = plans.select(F.explode(F.col("leads.term")).alias("term"), F.lit(False).alias("leads"))
    chosen = settle(leading.union(others).groupBy("term").agg(F.max("leads").alias("leads")))
    return plans, settle(_stored(words, chosen, window), compression="zstd")


def find_phrases(plans: DataFrame, index: DataFrame, depth: int = 3, window: int = 13) -> DataFrame:
    """(key, start, phrase) of every exact occurrence, distinct."""
    found = (
        plans.select("phrase", "leads", F.col("leads")[0]["term"].alias("term"))
        .join(index.where(F.col("around").isNotNull()), "term")
        .withColumn("start", F.col("pos") - F.col("leads")[0]["offset"])
        .where(F.col("start") >= 0)
        .select(*KEY, "start", "phrase", "leads", "pos", "around")
    )
    for which in range(1, depth):
        found = _agree(found, index, which)
    at = F.col("start") - F.greatest(F.col("pos") - (window - 2), F.lit(1)) + 2
    return (
        found.where(F.transform(F.slice("around", at, F.size("phrase")), _lower_word) == F.col("phrase"))
        .select(*KEY, "start", "phrase")
        .distinct()
    )


def _agree(found: DataFrame, index: DataFrame, which: int) -> DataFrame:
    """Starts that a posting of the next rarest term, moved by its offset, confirms."""
    longer = F.size("leads") > which
    lead = F.get("leads", F.lit(which))
    wanted = found.where(longer).withColumns({"term": lead["term"], "at": F.col("start") + lead["offset"]})
    there = index.select(*KEY, "term", F.col("pos").alias("at"))
    return wanted.join(there, [*KEY, "term", "at"], "left_semi").drop("term", "at").unionByName(found.where(~longer))


def near_terms(plans: DataFrame, index: DataFrame, slop: int, depth: int = 3) -> DataFrame:
    """(key, phrase) of proximity matches.

    The rarest term of the phrase proposes a start, and every other stored term (``depth`` at most, the rarest)
    must stand within ``slop`` words of its place after it; further words of the phrase are not asked for. An
    exact occurrence is also near, and a phrase of one word is near where it occurs.
    """
    # A start travels with the number of its phrase and the leads to be found, not with words.
    numbered = settle(plans.withColumn("number", F.monotonically_increasing_id()))
    first = F.col("leads")[0]
    starts = (
        numbered.select("number", "leads", first["term"].alias("term"), first["offset"].alias("offset"))
        .join(index.where(F.col("around").isNotNull()).drop("around"), "term")
        .select(*KEY, "number", "leads", (F.col("pos") - F.col("offset")).alias("start"))
    )
    starts = starts.select(*KEY, "number", "start", F.expr("slice(leads, 2, size(leads))").alias("leads"))
    for which in range(depth - 1):
        starts = _about(starts, index, which, slop)
    return starts.select(*KEY, "number").distinct().join(numbered.select("number", "phrase"), "number").drop("number")


def _about(starts: DataFrame, index: DataFrame, which: int, slop: int) -> DataFrame:
    """Starts with a posting of the next rarest term within ``slop`` words of its place.

    Positions are dealt into cells of 2 * slop + 1, so a place looks into two cells at most and the join stays an
    equality; it ends with the first posting found.
    """
    longer, width = F.size("leads") > which, 2 * slop + 1
    lead = F.get("leads", F.lit(which))
    wanted = starts.where(longer).withColumns({"term": lead["term"], "at": F.col("start") + lead["offset"]})
    cells = F.sequence(F.floor((F.col("at") - slop) / width), F.floor((F.col("at") + slop) / width))
    there = index.select(*KEY, "term", "pos", F.floor(F.col("pos") / width).alias("cell")).alias("there")
    wanted = wanted.withColumn("cell", F.explode(cells)).alias("wanted")
    same = [F.col(f"wanted.{c}") == F.col(f"there.{c}") for c in (*KEY, "term", "cell")]
    close = F.abs(F.col("there.pos") - F.col("wanted.at")) <= slop
    found = wanted.join(there, [*same, close], "left_semi").drop("term", "at", "cell")
    return found.unionByName(starts.where(~longer))


def _covered(spans: DataFrame) -> DataFrame:
    """(key, n_hit): words inside any span; a group holds at most one row for each word of a text."""
    longest = spans.groupBy(*KEY, "start").agg(F.max("end").alias("end"))
    merged = F.aggregate(
        F.array_sort(F.collect_list(F.struct("start", "end"))),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["upto"]), F.lit(0))).alias("n"),
            F.greatest(a["upto"], s["end"]).alias("upto"),
        ),
    )
    return longest.groupBy(*KEY).agg(merged["n"].alias("n_hit"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: int = 20,
    slop: int = 2,
) -> DataFrame:
    """How much of every document stands inside windows of the items.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated (``n_hit`` > 0 and
    ``share`` * n_hit >= n_words) and n_near, the items with a window near a place of the text (``near_terms``). A null or empty text has no words and no hits. Items of null id hit
    words but are not counted; repeated items count once. Rows that repeat a document get equal results.
    An empty table of items leaves every document clean.
    """
    rows = keyed(docs, doc_id, text)
    return judged(rows, items, item_id, item_text, window, share, slop).drop(*KEY)


def judged(
    rows: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: int = 20,
    slop: int | None = None,
) -> DataFrame:
    """The columns of ``contamination`` and the key, for rows made by ``keyed``; ``n_near`` only with a ``slop``."""
    phrases = settle(phrases_of(items, item_id, item_text, window))
    known = phrases.where(F.col("item_id").isNotNull())
    words = settle(listed(rows), compression="zstd")
    plans, index = index_words(words, phrases, window=window)
    found = settle(find_phrases(plans, index, window=window))
    spans = found.select(*KEY, "start", (F.col("start") + F.size("phrase")).alias("end")).distinct()
    named = found.select(*KEY, "phrase").distinct().join(known, "phrase")
    ids = named.select(*KEY, F.col("item_id").cast("string").alias("i")).distinct()
    items_of = ids.groupBy(*KEY).agg(F.array_sort(F.collect_list("i")).alias("ids"))
    n_words, none = F.greatest(F.size("w"), F.lit(0)).cast("bigint"), F.lit(0).cast("bigint")
    counted = words.select(*KEY, "doc_id", F.coalesce(n_words, none).alias("n_words"))
    hits = counted.join(_covered(spans).join(items_of, KEY, "left"), KEY, "left")
    n_hit = F.coalesce("n_hit", none)
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    made = [
        *KEY,
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    ]
    if slop is None:
        return hits.select(*made)
    close = near_terms(plans, index, slop).join(known, "phrase").select(*KEY, "item_id").distinct()
    close = close.groupBy(*KEY).agg(F.count("*").alias("n_near"))
    return hits.join(close, KEY, "left").select(*made, F.coalesce("n_near", none).alias("n_near"))
