"""Registered queries of the operators: name -> (query over (spark, folder), SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import (
    decontaminate,
    html_consensus,
    language_id,
    line_dedup,
    lm_scoring,
    minhash_join,
    piece_table,
    piece_transducer,
    prefix_trie,
    token_counts,
    topk_search,
    toxicity,
    warc_chunks,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best inner products, in 1024ths a component, of every hundredth vector with all others."""
    vectors = _table(spark, folder, "embeddings").select("vec_id", topk_search.quantised(F.col("embedding")).alias("numbers"))
    return topk_search.search(vectors.where("vec_id % 100 = 0"), vectors, k=10)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by mixture inference."""
    return language_id.identify(spark, _table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score_toxicity(spark, _table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and neural log-probability of every document."""
    return lm_scoring.score_texts(spark, _table(spark, folder, "documents"))


def op5_html_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_consensus.extract_main_text(_table(spark, folder, "pages"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without later occurrences of repeated three-line windows."""
    return line_dedup.dedup_lines(_table(spark, folder, "documents"))


def op7_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc_chunks.archive_round_trip(spark, _table(spark, folder, "pages"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and whether they decode to it."""
    return piece_transducer.encode_texts(spark, _table(spark, folder, "documents"))


def op10_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash_join.near_duplicates(_table(spark, folder, "documents"))


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark contamination of every document."""
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and its way back."""
    return piece_table.fill_in_middle(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.trie(spark, _table(spark, folder, "conversations"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document in the byte-level vocabulary."""
    return token_counts.count_tokens(spark, _table(spark, folder, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(column: str, pattern: str) -> str:
    return f"regexp_extract_all(translate({column}, '{UPPER}', '{LOWER}'), '{pattern}')"


OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce({_words_sql("text", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}, []) AS w FROM documents),
b AS (SELECT item_id, {_words_sql("text", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 12) AS p
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(s) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT len(p) AS n FROM phrases),
spots AS (
  SELECT r, s, n, list_slice(w, s, s + n - 1) AS p
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) t(s)),
hits AS (SELECT r, s, n, item_id FROM spots JOIN phrases USING (p)),
places AS (SELECT r, count(DISTINCT x) AS n_hit FROM hits, unnest(range(s, s + n)) t(x) GROUP BY r),
named AS (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits WHERE item_id IS NOT NULL),
lists AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM named GROUP BY r),
terms AS (
  SELECT p, k - 1 AS place, p[k] AS term
  FROM (SELECT DISTINCT p FROM phrases), unnest(range(1, len(p) + 1)) t(k)),
posted AS (
  SELECT r, pos - 1 AS pos, term
  FROM (SELECT r, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM d)
  WHERE term IN (SELECT term FROM terms)),
frequency AS (SELECT term, count(*) AS n FROM posted GROUP BY term),
leads AS (
  SELECT p, place, term, count(n) OVER (PARTITION BY p) AS known,
    row_number() OVER (PARTITION BY p ORDER BY n, term, place) AS k
  FROM terms LEFT JOIN frequency USING (term)),
first_leads AS (SELECT * FROM leads WHERE known = len(p) AND k <= 3),
starts AS (SELECT DISTINCT r, p, pos - place AS s FROM first_leads JOIN posted USING (term) WHERE k = 1),
close AS (
  SELECT DISTINCT starts.r, starts.p, s, k
  FROM starts JOIN first_leads l USING (p)
  JOIN posted ON posted.r = starts.r AND posted.term = l.term AND abs(posted.pos - l.place - s) <= 2),
near AS (SELECT DISTINCT r, p FROM close GROUP BY r, p, s HAVING count(*) = least(len(p), 3)),
nears AS (SELECT r, count(DISTINCT item_id) AS n_near FROM near JOIN phrases USING (p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_near, 0)::BIGINT AS n_near,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN lists USING (r) LEFT JOIN nears USING (r)
"""

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS n FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.n::DOUBLE[], c.n::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.n) = len(c.n)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM scores)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM ranked WHERE k <= 10
"""

# Holds for the given pages: one article each, blocks of p and h1, and no references but these.
OP5_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
parts AS (
  SELECT page_id, url, list_transform(string_split_regex(body, '</?(p|h1)>'), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS l
  FROM a),
plain AS (
  SELECT page_id, url, list_transform(l, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
    x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS l FROM parts),
texts AS (SELECT page_id, url, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS text FROM plain)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars, 'body>article' AS host_path FROM texts
"""

OP6_SQL = """
WITH d AS (SELECT doc_id, text, str_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, s, s + 3 AS e, l[s] AS x, l[s + 1] AS y, l[s + 2] AS z FROM d, unnest(range(1, len(l) - 1)) t(s)
  UNION ALL
  SELECT doc_id, 1, len(l) + 1, l[1], l[2], NULL FROM d WHERE len(l) < 3 AND array_to_string(l, '') <> ''),
placed AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, s) AS k FROM windows),
gone AS (SELECT DISTINCT doc_id, p FROM placed, unnest(range(s, e)) t(p) WHERE k > 1),
lists AS (SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL THEN text
       ELSE array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF NOT list_contains(gone, i)], chr(10)) END AS text
FROM d LEFT JOIN lists USING (doc_id)
"""

OP7_SQL = """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, url
FROM f
"""

OP10_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce({_words_sql("text", r"[^\x20\x09-\x0D]+")}, []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b USING (x) GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * k >= 85 * (nu.n + nv.n - k)),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least AS (SELECT u AS doc_id, min(v) AS c FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (
  SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
    ('0x' || x[17:24])::BIGINT % 100 AS h3, ('0x' || x[25:32])::BIGINT % 100 AS h4 FROM d),
f AS (
  SELECT *, least(a, b) AS p, greatest(a, b) AS m,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT *, substring(t, 1, p) AS prefix, substring(t, p + 1, m - p) AS middle, substring(t, m + 1, n - m) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""

# crc32 bit by bit: a character is mixed in, then -1 stands for each of the eight shifts.
OP12_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, role, text, md5(length(role) || ':' || role || text) AS x,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS w,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
steps AS (
  SELECT DISTINCT c, flatten([[ascii(z), -1, -1, -1, -1, -1, -1, -1, -1] FOR z IN string_split(c::VARCHAR, '')]) AS s FROM t),
h AS (
  SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, s::BIGINT[]),
    lambda a, z: CASE WHEN z >= 0 THEN xor(a, z) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h FROM steps),
turns AS (
  SELECT h.c, k, x, w FROM h JOIN t ON t.c = h.b AND k <= h.h UNION ALL SELECT h.c, k, x, w FROM h JOIN t ON t.c = h.c AND k > h.h),
paths AS (
  SELECT h.c, coalesce(list(x ORDER BY k) FILTER (x IS NOT NULL), []) AS p, list(w ORDER BY k) AS w
  FROM h LEFT JOIN turns ON turns.c = h.c GROUP BY h.c),
members AS (SELECT c, d, p[1:d] AS q, w[d] AS w, len(p) = d AS ends FROM paths, unnest(range(0, len(p) + 1)) u(d)),
nodes AS (
  SELECT d, q, min(c) AS conv_id, count(*) AS n, any_value(w) AS w,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY d, q),
children AS (SELECT q[1:d - 1] AS q, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children, CASE WHEN d > 0 THEN (nodes.n - 1) * w ELSE 0 END AS saved
  FROM nodes LEFT JOIN children USING (q)),
sums AS (
  SELECT q[1:a] AS q, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM own, unnest(range(0, d + 1)) u(a) GROUP BY 1)
SELECT own.conv_id, own.d AS depth, above.conv_id AS parent_conv_id, own.n AS n_convs, own.n_children,
  sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens, own.ends_sha256
FROM own JOIN sums USING (q) LEFT JOIN nodes above ON own.d > 0 AND above.q = own.q[1:own.d - 1]
"""

CHECKS = {
    "op1_topk_search": (op1_topk_search, OP1_SQL),
    "op2_language_id": (op2_language_id, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_lm_scoring": (op4_lm_scoring, None),
    "op5_html_consensus": (op5_html_consensus, OP5_SQL),
    "op6_line_dedup": (op6_line_dedup, OP6_SQL),
    "op7_warc_chunks": (op7_warc_chunks, OP7_SQL),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op10_minhash_join": (op10_minhash_join, OP10_SQL),
    "op9_decontaminate": (op9_decontaminate, OP9_SQL),
    "op11_fill_in_middle": (op11_fill_in_middle, OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_token_counts": (op13_token_counts, None),
}
