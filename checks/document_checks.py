"""Checks of document and digest operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.feeds_sql import CTE, query
from depotlens.functions.columns import clip, coerce_date
from depotlens.functions.text import collapse_space, excerpt, join_segments, safe_file_index
from depotlens.operators import digest as digests
from depotlens.operators import documents
from depotlens.operators.joins import pair_docs_predictions
from depotlens.sources.schemas import DOCUMENT_FIELDS, DOCUMENT_GROUPS, DOCUMENT_HEADER

# Further pattern rules for the given texts: a mail address, a network address, a numbered mark.
EXTRA_RULES = (
    documents.PatternRule("EMAIL", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z.]+"),
    documents.PatternRule("IPV4", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    documents.PatternRule("PLUS_NUMBER", r"\+([0-9]+)", 1),
)
ALL_RULES = documents.FIELD_RULES + EXTRA_RULES

CTE["doc_pages"] = "SELECT conv_id AS doc_id, turn AS page, text FROM conversations"
CTE["doc_texts"] = "SELECT doc_id, string_agg(text, chr(10) ORDER BY page, text) AS text FROM doc_pages GROUP BY doc_id"

CTE["all_texts"] = """
SELECT 'd' || doc_id AS doc_id, text FROM documents UNION ALL SELECT 'p' || page_id, html FROM pages"""


def _all_texts(feeds):
    return feeds.table("documents").select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text").unionByName(
        feeds.table("pages").select(F.concat(F.lit("p"), "page_id").alias("doc_id"), F.col("html").alias("text"))
    )


def _hits(rule: documents.PatternRule, text: str = "text") -> str:
    found = f"regexp_extract_all({text}, '{rule.pattern}', {rule.group})"
    return f"[h for h in {found} if regexp_matches(h, '[0-9]')]" if rule.must_contain_digit else found


REGEX_FIELDS = "\nUNION ALL ".join(
    f"SELECT doc_id, '{rule.label}' AS label, CAST(pos AS BIGINT) AS pos, hits[pos] AS value FROM (SELECT doc_id, hits, "
    f"unnest(range(1, len(hits) + 1)) AS pos FROM (SELECT doc_id, {_hits(rule)} AS hits FROM all_texts))"
    for rule in ALL_RULES
)


# Pages with the labelled lines of a prescription below them, one number per page.
def _forms(feeds):
    key = F.col("page_id")
    lines = F.concat_ws(
        "\n",
        "html",
        F.concat(F.lit("Dr. Example, Prescription Number: RX"), (key + 100_000).cast("string")),
        F.concat(F.lit("Medicare "), F.lpad((key % 9000 + 1000).cast("string"), 4, "0"), F.lit(" 45670 1")),
        F.concat(F.lit("Phone 02 9876 "), F.lpad((key % 10_000).cast("string"), 4, "0"), F.lit(" or 0411222333")),
        F.concat(F.lit("AHPRA: "), (key + 500_000).cast("string")),
        F.concat(F.lit("Issued "), (key % 28 + 1).cast("string"), F.lit("/2/2024 until 1-12-2024")),
    )
    words = F.split(F.regexp_extract("url", r"://([^/]+)", 1), r"\.")
    return feeds.table("pages").select(
        key.alias("doc_id"), lines.alias("text"), words.alias("people"), F.slice(words, 2, 1).alias("organisations")
    )


CTE["forms"] = r"""
SELECT page_id AS doc_id, html || chr(10) || 'Dr. Example, Prescription Number: RX' || (page_id + 100000) || chr(10)
  || 'Medicare ' || lpad(CAST(page_id % 9000 + 1000 AS VARCHAR), 4, '0') || ' 45670 1' || chr(10)
  || 'Phone 02 9876 ' || lpad(CAST(page_id % 10000 AS VARCHAR), 4, '0') || ' or 0411222333' || chr(10)
  || 'AHPRA: ' || (page_id + 500000) || chr(10) || 'Issued ' || (page_id % 28 + 1) || '/2/2024 until 1-12-2024' AS text,
  string_split(regexp_extract(url, '://([^/]+)', 1), '.') AS people FROM pages"""

_RULE = {rule.label: rule for rule in documents.FIELD_RULES}
_FOUND = {
    "prescription_number": f"({_hits(_RULE['PRESCRIPTION_NUMBER'])})[1]",
    "prescription_date": f"({_hits(_RULE['DATE_DMY'])})[1]",
    "expiry_date": f"({_hits(_RULE['DATE_DMY'])})[2]",
    "patient_name": "people[1]",
    "patient_medicare_number": f"({_hits(_RULE['MEDICARE_NUMBER'])})[1]",
    "patient_phone": f"({_hits(_RULE['PHONE_AU'])})[1]",
    "doctor_name": "coalesce([p for p in people if p <> people[1]][1], people[2])",
    "doctor_ahpra_number": f"({_hits(_RULE['AHPRA_NUMBER'])})[1]",
    "facility_name": "people[2]",
    "facility_phone": f"({_hits(_RULE['PHONE_AU'])})[2]",
    "facility_abn": f"({_hits(_RULE['ABN'])})[1]",
}
CTE["field_table"] = (
    "SELECT doc_id, "
    + ", ".join(f"CAST({_FOUND.get(f, 'NULL')} AS VARCHAR) AS {f}" for f in DOCUMENT_FIELDS)
    + ", 'spacy_en_rules' AS extraction_method FROM forms"
)


def _fields(feeds):
    return documents.assign_fields(_forms(feeds), "people", "organisations")


def _json_of(*pairs: tuple[str, str]) -> str:
    return "json_object(" + ", ".join(f"'{name}', {value}" for name, value in pairs) + ")"


NESTED = _json_of(
    *[(name, f"coalesce({name}, '')") for name in DOCUMENT_HEADER],
    *[
        (group, _json_of(*[(m, f"coalesce({group}_{m}, '')") for m in members]))
        for group, members in DOCUMENT_GROUPS.items()
    ],
)

# --- web pages ---------------------------------------------------------------------------

# Page tokens: tags and texts in order, without scripts, styles and comments. A paragraph ends at
# its own end tag or, if it has none, with the article around it.
CTE["page_tokens"] = r"""
SELECT page_id, i, token, token LIKE '<%' AS is_tag, regexp_matches(token, '^<p[\s>]') AS opens,
  regexp_matches(token, '^</p[\s>]') AS closes, token LIKE '</article%' AS ends_article,
  replace(replace(replace(replace(regexp_replace(token, '^\s+|\s+$', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS words
FROM (SELECT page_id, tokens[i] AS token, i FROM (SELECT page_id, tokens, unnest(range(1, len(tokens) + 1)) AS i
  FROM (SELECT page_id, regexp_extract_all(regexp_replace(regexp_replace(html,
    '(?s)<script.*?</script>|<style.*?</style>', '<x>', 'g'), '(?s)<!--.*?-->', '<x>', 'g'), '<[^>]*>|[^<]+') AS tokens FROM pages)))"""
CTE["page_depths"] = """
SELECT *, sum(CASE WHEN opens THEN 1 WHEN closes THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS depth
FROM page_tokens"""
CTE["page_blocks"] = """
SELECT o.page_id, o.i AS start, coalesce(min(e.i), 1000000000) AS stop
FROM page_depths o LEFT JOIN page_depths e ON e.page_id = o.page_id AND e.i > o.i
  AND ((e.closes AND e.depth = o.depth - 1) OR e.ends_article)
WHERE o.opens GROUP BY o.page_id, o.i"""
CTE["block_texts"] = """
SELECT b.page_id, b.start, string_agg(t.words, ' ' ORDER BY t.i) AS text
FROM page_blocks b JOIN page_tokens t ON t.page_id = b.page_id AND t.i > b.start AND t.i < b.stop
WHERE NOT t.is_tag AND t.words <> '' GROUP BY b.page_id, b.start"""
CTE["page_texts"] = """
SELECT p.page_id, coalesce(d.text, a.text, '') AS plain FROM pages p
LEFT JOIN (SELECT page_id, string_agg(text, chr(10) || chr(10) ORDER BY start) AS text FROM block_texts GROUP BY page_id) d ON p.page_id = d.page_id
LEFT JOIN (SELECT page_id, string_agg(words, ' ' ORDER BY i) AS text FROM page_tokens WHERE NOT is_tag AND words <> ''
    GROUP BY page_id) a ON p.page_id = a.page_id"""
CTE["page_items"] = r"""
SELECT page_id, string_agg(item, '|' ORDER BY first) AS bullets, count(*) AS n FROM (
  SELECT page_id, item, min(i) AS first FROM (
    SELECT page_id, i, trim(regexp_replace(replace(replace(regexp_replace(items[i], '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS item
    FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS items FROM pages)))
  WHERE length(item) > 2 GROUP BY page_id, item) GROUP BY page_id"""
CTE["article_table"] = """
SELECT page_id, url, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
  regexp_extract(html, '<html lang="([a-z]+)"', 1) || ', ' || regexp_extract(url, '://([^/]+)', 1) AS tags FROM pages"""

TOPIC = "example.org"


def _digest(feeds):
    return digests.digest(feeds.articles, TOPIC).select(
        "section",
        "title",
        "url",
        "tags",
        F.array_join("bullets", "|").alias("bullets"),
        "omitted_bullets",
        "excerpt",
    )


DIGEST = f"""
SELECT CASE WHEN contains(lower(concat_ws(' ', title, replace(tags, ', ', ' '), plain)), '{TOPIC}') THEN 'focus' ELSE 'other' END AS section,
  coalesce(title, '(untitled)') AS title, url, tags, coalesce(bullets, '') AS bullets, 0::BIGINT AS omitted_bullets, plain AS excerpt
FROM article_table a JOIN page_texts t ON a.page_id = t.page_id LEFT JOIN page_items i ON a.page_id = i.page_id"""


def _reviews(feeds):
    status = F.when(F.col("toxic") == 1, "needs_attention").when(F.col("quality") == 1, "reviewed").otherwise("open")
    return feeds.table("labels").select("doc_id", status.alias("status"))


def _json_docs(feeds):
    return feeds.table("documents").select(
        "doc_id", F.to_json(F.struct(F.col("lang"), F.col("n_chars"))).alias("json")
    )


def _texts(feeds):
    docs = feeds.table("documents")
    moment = F.when(F.col("doc_id") % 3 == 0, F.lit("not a date")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    )
    return docs.select(
        "doc_id",
        collapse_space(F.regexp_replace("text", "[\\x{00a0}\\x{2000}-\\x{3000}]", "")).alias("collapsed"),
        excerpt("text", 300).alias("excerpt"),
        safe_file_index(F.col("doc_id") % 1000, "source").alias("file"),
        coerce_date(moment).alias("day"),
        clip("n_chars", 100, 5000).alias("clipped"),
        F.expr("try_cast(concat(if(doc_id % 2 = 0, 'x', ''), doc_id) AS BIGINT)").alias("number"),
        F.sqrt(F.col("n_chars")).cast("bigint").alias("root"),
    )


TEXTS = r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\x{00a0}\x{2000}-\x{3000}]', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS collapsed,
  CASE WHEN length(text) > 300 THEN left(text, 300) || '…' ELSE text END AS excerpt,
  lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '_' || source || '.json' AS file,
  CASE WHEN doc_id % 3 > 0 THEN DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) END AS day,
  CAST(greatest(least(n_chars, 5000), 100) AS DOUBLE) AS clipped,
  CASE WHEN doc_id % 2 = 1 THEN doc_id END AS number, CAST(floor(sqrt(n_chars)) AS BIGINT) AS root FROM documents"""


def _segments(feeds):
    rows = feeds.doc_pages.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("page", "text"))).alias("segments")
    )
    return rows.select("doc_id", join_segments("segments").alias("text"))


def _chosen_sources(feeds):
    """Which of extracted, annotated and generated fields each mode takes."""
    extracted = _fields(feeds)
    annotated, generated = extracted.filter("doc_id % 2 = 0"), extracted.filter("doc_id % 2 = 1")
    cases = {
        "ocr": (extracted, annotated, generated, "ocr"),
        "auto": (extracted, annotated, generated, "auto"),
        "auto without extraction": (extracted.limit(0), annotated, generated, "auto"),
        "labels": (extracted, annotated, generated, "labels"),
        "labels without annotation": (extracted, None, generated, "labels"),
    }
    parts = [
        documents.field_source_fallback(*given).select(F.lit(case).alias("case"), "doc_id") for case, given in cases.items()
    ]
    return reduce(DataFrame.unionByName, parts)


CHOSEN_SOURCES = "\nUNION ALL ".join(
    f"SELECT '{case}' AS \"case\", doc_id FROM field_table WHERE {condition}"
    for case, condition in (
        ("ocr", "true"),
        ("auto", "true"),
        ("auto without extraction", "doc_id % 2 = 0"),
        ("labels", "doc_id % 2 = 0"),
        ("labels without annotation", "doc_id % 2 = 1"),
    )
)

CHECKS = {
    "field_source_modes": (_chosen_sources, query(CHOSEN_SOURCES)),
    "text_functions": (_texts, TEXTS),
    "join_segments": (
        _segments,
        query("SELECT doc_id, string_agg(text, ' ' ORDER BY page, text) AS text FROM doc_pages GROUP BY doc_id"),
    ),
    "assemble_doc_text": (
        lambda f: documents.assemble_doc_text(f.doc_pages),
        query("SELECT * FROM doc_texts"),
    ),
    "write_ocr_json": (
        lambda f: documents.ocr_json(f.doc_pages),
        query(
            "SELECT doc_id, CAST(to_json({'doc_id': doc_id, 'pages': list({'page': page, 'text': text} ORDER BY page, text)}) "
            "AS VARCHAR) AS json FROM doc_pages GROUP BY doc_id"
        ),
    ),
    "regex_fields": (lambda f: documents.regex_fields(_all_texts(f), ALL_RULES), query(REGEX_FIELDS)),
    "regex_fields_of_forms": (
        lambda f: documents.regex_fields(_forms(f)),
        query(
            "\nUNION ALL ".join(
                f"SELECT doc_id, '{r.label}' AS label, CAST(pos AS BIGINT) AS pos, hits[pos] AS value FROM (SELECT doc_id, hits, "
                f"unnest(range(1, len(hits) + 1)) AS pos FROM (SELECT doc_id, {_hits(r)} AS hits FROM forms))"
                for r in documents.FIELD_RULES
            )
        ),
    ),
    "assign_fields": (_fields, query("SELECT * FROM field_table")),
    "nest_fields": (
        lambda f: documents.nest_fields(_fields(f)),
        query(f"SELECT doc_id, CAST({NESTED} AS VARCHAR) AS json FROM field_table"),
    ),
    "flatten_label": (
        lambda f: documents.flatten_label(documents.nest_fields(_fields(f))),
        query("SELECT doc_id, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in DOCUMENT_FIELDS) + " FROM field_table"),
    ),
    "field_source_fallback": (
        lambda f: documents.field_source_fallback(_fields(f), None, None),
        query("SELECT * EXCLUDE (extraction_method) FROM field_table"),
    ),
    "extraction_summary": (
        lambda f: documents.extraction_summary(f.doc_pages),
        query("SELECT count(DISTINCT doc_id) AS documents, count(*) AS rows FROM doc_pages"),
    ),
    "document_inventory": (
        lambda f: documents.document_inventory(
            documents=f.table("documents"),
            pages=f.doc_pages,
            fields=_fields(f),
            predictions=_fields(f).where("prescription_number <> ''"),
            annotated=f.table("labels"),
        ),
        query(
            "SELECT 'documents' AS source, count(DISTINCT doc_id) AS documents, count(*) AS rows FROM documents UNION ALL "
            "SELECT 'pages', count(DISTINCT doc_id), count(*) FROM doc_pages UNION ALL "
            "SELECT 'fields', count(DISTINCT doc_id), count(*) FROM field_table UNION ALL "
            "SELECT 'predictions', count(DISTINCT doc_id), count(*) FROM field_table WHERE prescription_number <> '' UNION ALL "
            "SELECT 'annotated', count(DISTINCT doc_id), count(*) FROM labels"
        ),
    ),
    "pair_docs_predictions": (
        lambda f: pair_docs_predictions(f.table("documents"), f.table("labels")).select("doc_id", "lang"),
        "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    ),
    "review_progress": (
        lambda f: documents.review_progress(_reviews(f)),
        "SELECT *, CAST(reviewed AS DOUBLE) / total AS progress FROM (SELECT count(CASE WHEN toxic = 1 OR quality = 1 THEN 1 END) "
        "AS reviewed, count(*) AS total FROM labels)",
    ),
    "export_annotated": (
        lambda f: documents.export_annotated(_json_docs(f)),
        "SELECT doc_id AS file, (SELECT count(*) FROM documents) AS total_files, "
        "CAST(json_object('lang', lang, 'n_chars', n_chars) AS VARCHAR) AS json FROM documents",
    ),
    "html_paragraphs": (
        lambda f: f.articles.select("page_id", digests.html_paragraphs("summary").alias("plain")),
        query("SELECT * FROM page_texts"),
    ),
    "html_bullets": (
        lambda f: f.articles.select(
            "page_id", F.explode(digests.html_bullets("summary")).alias("bullet")
        ),
        query("SELECT page_id, unnest(string_split(bullets, '|')) AS bullet FROM page_items"),
    ),
    "topic_flag": (
        lambda f: f.table("documents").select(
            "doc_id", digests.topic_flag("source", F.array("lang"), "text", "The ").alias("about")
        ),
        "SELECT doc_id, contains(lower(concat_ws(' ', source, lang, text)), 'the ') AS about FROM documents",
    ),
    "digest": (_digest, query(DIGEST)),
}
