"""Scans: delimited, Parquet and JSON files, and tables by preference."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlens.functions.columns import coerce_date
from depotlens.sources.records import records
from depotlens.sources.schemas import ARTICLE_DDL, OCR_DDL, TABLE_DDL

log = logging.getLogger(__name__)

# Prefix of raw table names, and date columns read leniently per table.
RAW_PREFIX = "healthcare_"
LENIENT_DATES = {
    "inventory": ("expiry_date", "last_restocked", "last_movement_date", "updated_timestamp"),
    "expiry_batches": ("expiry_date",),
    "writeoff_events": ("timestamp",),
    "orders": ("order_date",),
}


# Doubled quotes inside quoted text, and spaces kept, as other tools write and read such files.
CSV_FORMAT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# No text holds this sign, so that quoted empty text stays empty and only an empty field without quotes is unknown.
NO_VALUE = "\x00"
CSV_READ = {"mode": "FAILFAST", "nullValue": NO_VALUE, "multiLine": True, **CSV_FORMAT}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system (local, HDFS or an object store)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def scan_csv(
    spark: SparkSession, path: str, schema: str | None = None, infer: bool = False, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """Delimited files with a header. A given schema avoids the extra pass that inference needs.

    Quoted text may hold line breaks: records are found by the parity of quotes (``records``), so many tasks
    read one file. Where no text holds a line break, ``multi_line=False`` saves that. Files with stray quotes in
    plain fields need ``whole_files``, one task for each. A row that cannot be read is an error.
    """
    known = schema if schema and not infer else None
    if multi_line and not whole_files:
        return _scan_records(spark, path, known)
    reader = spark.read.options(header=True, enforceSchema=False, **{**CSV_READ, "multiLine": whole_files})
    return reader.schema(known).csv(path) if known else reader.option("inferSchema", True).csv(path)


def _quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _scan_records(spark: SparkSession, path: str, schema: str | None) -> DataFrame:
    rows = records(spark, path)
    # One header a file, and few different ones.
    heads = [r["text"] for r in rows.where("head").select("text").distinct().collect()]
    titles = {
        tuple(spark.range(1).select(F.from_csv(F.lit(h), _texts(h.count(",") + 1), {**CSV_READ, "mode": "PERMISSIVE"}).alias("r")).first()["r"])
        for h in heads
    }
    names = {tuple(t for t in found if t is not None) for found in titles}
    if schema is None:
        if len(names) != 1:
            raise ValueError(f"files without one common header: {sorted(names)}")
        schema = _inferred(rows, next(iter(names)))
    fields = StructType.fromDDL(schema).fieldNames()
    for found in names:
        if [n.lower() for n in found] != [n.lower() for n in fields]:
            raise ValueError(f"header {list(found)} differs from columns {fields}")
    return rows.where("not head").select(F.from_csv("text", schema, CSV_READ).alias("r")).select("r.*")


def _texts(n: int) -> str:
    return ", ".join(f"c{i} string" for i in range(n))


# Types in the order in which they are tried, and the form that text of the type has.
INFERRED = (
    ("int", r"^[+-]?[0-9]+$"),
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}"),
    ("boolean", "(?i)^(true|false)$"),
)


def _inferred(rows: DataFrame, names: Sequence[str]) -> str:
    """Schema that reads every value: per column the first type that no value contradicts, else text; one pass."""
    values = rows.where("not head").select(F.from_csv("text", _texts(len(names)), CSV_READ).alias("r")).select("r.*")
    tests = [
        F.coalesce(F.every(F.col(f"c{i}").isNull() | (F.col(f"c{i}").rlike(form) & F.col(f"c{i}").try_cast(kind).isNotNull())), F.lit(False))
        for i in range(len(names))
        for kind, form in INFERRED
    ]
    filled = [F.count(f"c{i}") > 0 for i in range(len(names))]
    found = values.agg(F.array(*tests).alias("fits"), F.array(*filled).alias("filled")).first()
    kinds = []
    for i in range(len(names)):
        fits = found["fits"][i * len(INFERRED) : (i + 1) * len(INFERRED)]
        first = next((kind for (kind, _), fit in zip(INFERRED, fits) if fit), "string")
        kinds.append(first if found["filled"][i] else "string")
    return ", ".join(f"{_quoted_name(n)} {kind}" for n, kind in zip(names, kinds))


def scan_csv_tables(
    spark: SparkSession, folder: str, tables: Sequence[str] = tuple(TABLE_DDL), infer: bool = False
) -> dict[str, DataFrame]:
    """Every known ``<table>.csv`` of a folder; absent ones are reported, none at all is an error."""
    present = [t for t in tables if path_exists(spark, f"{folder}/{t}.csv")]
    if not present:
        raise FileNotFoundError(f"no table files in {folder}")
    missing = sorted(set(tables) - set(present))
    if missing:
        log.warning("tables not found, skipped: %s", missing)
    return {t: scan_csv(spark, f"{folder}/{t}.csv", TABLE_DDL[t], infer) for t in present}


def add_lineage(df: DataFrame, source: str, batch_id: str, clock: bool = True) -> DataFrame:
    """Mark where and when rows came in."""
    marks = {"_source": F.lit(source), "_batch_id": F.lit(batch_id)}
    if clock:
        marks = {"_ingestion_timestamp": F.current_timestamp(), **marks}
    return df.withColumns(marks)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_catalog_table(spark: SparkSession, *candidates: str) -> DataFrame | None:
    """First of the named tables that exists."""
    for name in candidates:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def coerce_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read text columns as dates or moments; what cannot be read becomes NULL."""
    kinds = dict(df.dtypes)
    present = [c for c in columns if kinds.get(c) == "string"]
    if not present:
        return df
    return df.withColumns(
        {
            c: coerce_date(c) if c.endswith("date") else F.try_to_timestamp(F.col(c))
            for c in present
        }
    )


def scan_with_fallback(
    spark: SparkSession,
    table: str,
    catalog_names: Sequence[str] = (),
    medallion_names: Sequence[str] = (),
    csv_folder: str | None = None,
) -> DataFrame | None:
    """Catalogue table, else medallion table, else file; dates are read leniently from files."""
    found = scan_catalog_table(spark, *catalog_names, *medallion_names)
    if found is None and csv_folder and path_exists(spark, f"{csv_folder}/{table}.csv"):
        lenient = LENIENT_DATES.get(table, ())
        ddl = ", ".join(
            f"{part.strip().split(' ')[0]} string" if part.strip().split(" ")[0] in lenient else part.strip()
            for part in TABLE_DDL[table].split(",")
        )
        found = scan_csv(spark, f"{csv_folder}/{table}.csv", ddl)
    return None if found is None else coerce_dates(found, LENIENT_DATES.get(table, ()))


def scan_inputs(
    spark: SparkSession, plan: Mapping[str, Mapping[str, object]]
) -> dict[str, DataFrame | None]:
    """``scan_with_fallback`` for several tables; an absent table maps to None."""
    return {table: scan_with_fallback(spark, table, **where) for table, where in plan.items()}


def scan_json_labels(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(doc_id, json) of every readable JSON text, ``doc_id`` being the file name.

    A file is one document, or one document per line with ``lines``.
    """
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    texts = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=not lines)
    return texts.select(stem.alias("doc_id"), F.col("value").alias("json")).filter(
        F.try_parse_json("json").isNotNull()
    )


def scan_json_docs(
    spark: SparkSession, path: str, schema: str = OCR_DDL, lines: bool = False
) -> DataFrame:
    """JSON documents; unreadable ones are left out; ``doc_id`` falls back to the file name."""
    fields = StructType.fromDDL(schema).fields
    parsed = scan_json_labels(spark, path, lines).withColumn("d", F.try_parse_json("json"))
    values = {f.name: F.try_variant_get("d", f"$.{f.name}", f.dataType.simpleString()) for f in fields}
    identity = F.coalesce(values.pop("doc_id"), F.col("doc_id")) if "doc_id" in values else F.col("doc_id")
    return parsed.select(identity.alias("doc_id"), *[value.alias(name) for name, value in values.items()])


def scan_article_json(spark: SparkSession, path: str) -> DataFrame:
    """Articles in file order."""
    return (
        spark.read.schema(ARTICLE_DDL)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
        .orderBy("file_name")
    )
