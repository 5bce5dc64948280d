"""File and table scans. Every schema is explicit; nothing is inferred."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import contracts

SOURCE_FILE = "__source_file"

CSV_DIALECTS = {
    # A quote inside a quoted field is doubled.
    "quoted": {"quote": '"', "escape": '"'},
    # Quote characters are data; a separator inside a field splits it.
    "raw": {"quote": "", "escape": '"'},
}


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema out of a JSON schema document, from any file system Spark can read."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} must hold exactly one schema document")
    return T.StructType.fromJson(json.loads(rows[0].value))


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_order_envelopes(
    spark: SparkSession,
    path: str,
    schema: T.StructType = contracts.SALES_ENVELOPE,
    multi_line: bool = True,
) -> DataFrame:
    """Paged JSON documents with file lineage.

    A page holds a few hundred orders, so one task per document is small. With
    `multi_line=False` (one document per text line) even a large file splits.
    """
    return with_source_file(spark.read.schema(schema).option("multiLine", multi_line).json(path))


def read_form_feed(spark: SparkSession, path: str) -> DataFrame:
    """URL-encoded records, one order per line, as `value` with file lineage."""
    return with_source_file(spark.read.option("lineSep", "\n").text(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, dialect: str = "quoted") -> DataFrame:
    """CSV with header. Columns bind by position; a malformed typed field is NULL."""
    reader = spark.read.schema(schema).options(sep=",", encoding="UTF-8", header=True, **CSV_DIALECTS[dialect])
    return reader.csv(path)


def read_tender_map(spark: SparkSession, path: str, per_country: bool) -> DataFrame:
    return read_csv(spark, path, contracts.TENDER_BY_COUNTRY if per_country else contracts.TENDER)


def read_item_map(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    configuration: str = "A",
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """Item dimension of one configuration, as Barcode, Style, Color, Size.

    Works on any source Spark reads: for `jdbc`, filter and projection are pushed
    down to the database, and partitionColumn with its bounds in `options` makes
    the read parallel; for Parquet they reach the scan. `columns` names the
    source's column for `config` and for each output column.
    """
    names = {name.lower(): name for name in ["Config", *contracts.ITEM.names]} | (columns or {})
    source = spark.read.format(fmt).options(**options).load()
    return source.filter(F.col(names["config"]) == F.lit(configuration)).select(
        *[F.col(names[name.lower()]).cast("string").alias(name) for name in contracts.ITEM.names]
    )


def read_or_empty(spark: SparkSession, reader: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """The reader's frame, or an empty one when no file matches. Other errors are raised."""
    try:
        return reader()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def has_rows(df: DataFrame) -> bool:
    """Whether any row exists; stops at the first one found."""
    return not df.isEmpty()


def inbound_glob(root: str, flow: str) -> str:
    """Path pattern of the files that belong to one flow."""
    return f"{root.rstrip('/')}/{contracts.FLOW_GLOBS[flow]}"
