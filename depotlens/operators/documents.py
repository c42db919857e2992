"""Document fields: page assembly, labelled patterns, nested and flat field forms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import count_when
from depotlens.functions.text import clean_str, nth
from depotlens.sources.schemas import (
    DOCUMENT_FIELDS,
    DOCUMENT_GROUPS,
    DOCUMENT_HEADER,
)


@dataclass(frozen=True)
class PatternRule:
    """A labelled pattern; ``group`` is the part taken, 0 for the whole hit."""

    label: str
    pattern: str
    group: int = 0
    must_contain_digit: bool = False


# The mark of rows made by rules, and the labelled patterns of prescription documents.
EXTRACTION_METHOD = "spacy_en_rules"
FIELD_RULES = (
    PatternRule("MEDICARE_NUMBER", r"\b\d{4}\s?\d{5}\s?\d?\b"),
    PatternRule("ABN", r"\b\d{2}\s?\d{3}\s?\d{3}\s?\d{3}\b"),
    PatternRule("PHONE_AU", r"\b(?:\+?61[\s-]?|0)[2-478](?:[\s-]?\d){8}\b"),
    PatternRule("AHPRA_NUMBER", r"(?i)\b(?:AHPRA|Ahpra)[\s:]*#?\s*(\d{5,12})\b", 1),
    PatternRule(
        "PRESCRIPTION_NUMBER",
        r"(?i)\b(?:Rx|RX|Prescription|Script)\s*#?\s*[:\-]?\s*([A-Z0-9\-]{4,})\b",
        1,
        must_contain_digit=True,
    ),
    PatternRule("DATE_DMY", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"),
)


def find_all(text: Column | str, rule: PatternRule, compat: bool = False) -> Column:
    """All hits of a rule in order. ``compat`` keeps hits that hold no digit as well."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    if rule.must_contain_digit and not compat:
        hits = F.filter(hits, lambda hit: hit.rlike("[0-9]"))
    return hits


def regex_fields(
    texts: DataFrame,
    rules: Sequence[PatternRule] = FIELD_RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
    compat: bool = False,
) -> DataFrame:
    """(doc_id, label, pos, value): every hit of every rule in the whole text."""
    labelled = [
        F.struct(F.lit(rule.label).alias("label"), find_all(text_column, rule, compat).alias("hits"))
        for rule in rules
    ]
    return (
        texts.select(id_column, F.explode(F.array(*labelled)).alias("rule"))
        .select(id_column, "rule.label", F.posexplode("rule.hits").alias("pos", "value"))
        .select(id_column, "label", (F.col("pos") + 1).cast("bigint").alias("pos"), "value")
    )


def assemble_doc_text(pages: DataFrame, separator: str = "\n") -> DataFrame:
    """One row per document: its page texts in page order."""
    entry = F.struct("page", F.coalesce("text", F.lit("")).alias("text"))
    return (
        pages.groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("pages"))
        .select("doc_id", F.array_join(F.col("pages.text"), separator).alias("text"))
    )


def ocr_documents(pages: DataFrame) -> DataFrame:
    """One row per document: ``pages`` as an array of (page, text) in page order."""
    entry = F.struct(F.col("page").cast("int").alias("page"), F.col("text").cast("string").alias("text"))
    return pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("pages"))


def ocr_json(pages: DataFrame) -> DataFrame:
    return ocr_documents(pages).select("doc_id", F.to_json(F.struct("doc_id", "pages")).alias("json"))


def assign_fields(
    texts: DataFrame,
    people: str | None = None,
    organisations: str | None = None,
    dates: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """One flat field row per document from pattern hits and, if given, recognised names.

    ``people``, ``organisations`` and ``dates`` name array columns of an entity recogniser; without
    them the names are NULL and dates come from the pattern.
    """
    hits = {rule.label: find_all("text", rule, compat) for rule in FIELD_RULES}
    names = F.col(people) if people else F.array().cast("array<string>")
    groups = F.col(organisations) if organisations else F.array().cast("array<string>")
    days = hits["DATE_DMY"]
    if dates:
        days = F.when(F.size(dates) > 0, F.col(dates)).otherwise(days)
    patient = nth(names, 1)
    other = F.filter(names, lambda name: name != patient)
    titled = F.lower("text").contains("dr.") | F.lower("text").contains("dr ")
    doctor = F.when(titled, F.coalesce(nth(other, 1), nth(names, 2))).otherwise(nth(names, 2))
    found = {
        "prescription_number": nth(hits["PRESCRIPTION_NUMBER"], 1),
        "prescription_date": nth(days, 1),
        "expiry_date": nth(days, 2),
        "patient_name": patient,
        "patient_medicare_number": nth(hits["MEDICARE_NUMBER"], 1),
        "patient_phone": nth(hits["PHONE_AU"], 1),
        "doctor_name": doctor,
        "doctor_ahpra_number": nth(hits["AHPRA_NUMBER"], 1),
        "facility_name": nth(groups, 1),
        "facility_phone": nth(hits["PHONE_AU"], 2),
        "facility_abn": nth(hits["ABN"], 1),
    }
    return texts.select(
        "doc_id",
        *[found.get(field, F.lit(None)).cast("string").alias(field) for field in DOCUMENT_FIELDS],
        F.lit(EXTRACTION_METHOD).alias("extraction_method"),
    )


def flatten_label(documents: DataFrame, json_column: str = "json") -> DataFrame:
    """Flat field columns of nested JSON; an absent group gives NULLs."""
    nested = documents.select("doc_id", F.try_parse_json(json_column).alias("d"))

    def value(path: str, name: str) -> Column:
        return F.try_variant_get("d", f"$.{path}", "string").alias(name)

    return nested.select(
        "doc_id",
        *[value(field, field) for field in DOCUMENT_HEADER],
        *[
            value(f"{group}.{field}", f"{group}_{field}")
            for group, fields in DOCUMENT_GROUPS.items()
            for field in fields
        ],
    )


def nested_fields(fields: DataFrame) -> Column:
    """Nested struct of a flat field row; missing values are '' and unknown columns are left out."""

    kinds = dict(fields.dtypes)

    def value(name: str) -> Column:
        return clean_str(name, kinds[name] in ("double", "float")) if name in kinds else F.lit("")

    return F.struct(
        *[value(name).alias(name) for name in DOCUMENT_HEADER],
        *[
            F.struct(*[value(f"{group}_{field}").alias(field) for field in members]).alias(group)
            for group, members in DOCUMENT_GROUPS.items()
        ],
    )


def nest_fields(fields: DataFrame) -> DataFrame:
    """(doc_id, json) of every row that has a doc_id."""
    return fields.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", F.to_json(nested_fields(fields)).alias("json")
    )


def field_source_fallback(
    extracted: DataFrame | None,
    annotated: DataFrame | None,
    generated: DataFrame | None,
    mode: str = "auto",
) -> DataFrame | None:
    """Which field table to use: extracted rows first, else annotated labels, else generated ones.

    ``ocr`` takes extracted rows only, ``labels`` never takes them.
    """
    if mode not in ("auto", "ocr", "labels"):
        raise ValueError(f"unknown mode {mode}")
    if mode != "labels" and extracted is not None and (mode == "ocr" or not extracted.isEmpty()):
        return extracted.drop("extraction_method")
    if mode == "ocr":
        return None
    return annotated if annotated is not None else generated


def extraction_summary(fields: DataFrame) -> DataFrame:
    return fields.agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("rows"))


def document_inventory(**sources: DataFrame) -> DataFrame:
    """(source, documents, rows) of each given table with a doc_id."""
    parts = [
        extraction_summary(df).select(F.lit(name).alias("source"), "documents", "rows")
        for name, df in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def review_progress(reviews: DataFrame, status: str = "status") -> DataFrame:
    """Reviewed documents (with or without an open question) over all."""
    done = count_when(F.col(status).isin("reviewed", "needs_attention"))
    total = F.count(F.lit(1))
    return reviews.agg(
        done.alias("reviewed"),
        total.alias("total"),
        F.coalesce(F.try_divide(done.cast("double"), total.cast("double")), F.lit(0.0)).alias("progress"),
    )


def export_annotated(documents: DataFrame, json_column: str = "json") -> DataFrame:
    """One JSON line per annotated document with the number of files in the package.

    The export is a dataset of lines that many tasks write, not one text on the driver.
    """
    total = documents.agg(F.count(F.lit(1)).alias("total_files"))
    return documents.select(
        F.col("doc_id").alias("file"), total.scalar().alias("total_files"), F.col(json_column).alias("json")
    )
