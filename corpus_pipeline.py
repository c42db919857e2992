"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of ``docs``. Rows of null text are rejected by the first stage as of no language, rows of null id are
kept, an empty table passes through, further columns are kept, and of rows that repeat id and text one is left
after the third stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import decontaminate, language_id, line_dedup, minhash_join, piece_transducer
from depotlens.llm.base import KEY, keyed
from depotlens.session import settle

#: A text whose main language has a smaller share of it is rejected as of no language. Short texts with a
#: licence or a passage in another language have less than half, and stay.
LEAST_SHARE = 1 / 3
#: Words of a shingle and percent of resemblance from which documents are near-duplicates; op10's query has its own.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; texts without letters and mixtures without a main language go."""
    found = language_id.identify(spark, docs, whole=True)
    known = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)
    return found.where(known).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated three-line windows.

    A document that loses every line holds nothing that an earlier one lacks, and goes. ``n_chars``, where
    there is one, follows the text.
    """
    found = line_dedup.dedup_lines(docs, whole=True).where("n_removed < n_lines or n_removed = 0")
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(made.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate component: 5-word shingles, resemblance 0.8 or more."""
    rows = keyed(docs, whole=True)
    found = minhash_join.groups(rows.drop("row"), NEAR_WIDTH, NEAR_PERCENT)
    kept = settle(found.where("chosen").groupBy(*KEY).agg(F.count("*").alias("n")))
    if kept.where("n > 1").isEmpty():
        return rows.join(kept, KEY, "left_semi").select("row.*")
    once = rows.join(kept.where("n = 1"), KEY, "left_semi").select("row")
    # Rows are ordered by their JSON text, as columns of some types have no order.
    first = F.min_by("row", F.to_json("row")).alias("row")
    repeated = rows.join(kept.where("n > 1"), KEY, "left_semi").groupBy(*KEY).agg(first)
    return once.union(repeated.select("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows do not cover to a twentieth or more."""
    rows = keyed(docs, whole=True)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = settle(decontaminate.judged(rows.drop("row"), items).where("contaminated").select(*KEY).distinct())
    return rows.join(bad, KEY, "left_anti").select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, ids_sha256 and round_trip of what is left."""
    return piece_transducer.encode_texts(spark, docs)


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Language mixtures, full-set resemblance and piece paths are beyond SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs


CHECKS = {"pipeline": (run, ORACLE_SQL)}
