"""Completeness of paged downloads, judged from the pages that have landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.nested import explode_range
from kpiloom.sources.readers import SOURCE_FILE

# Fixed value: <region>-<yyyyMMdd>-<flow>-<page>.json
PAGE_NAME = r"([^/]+)-(\d{8})-([A-Za-z]+)-(\d+)\.json$"
DOWNLOAD = ["region", "business_date", "flow"]


def landed_pages(envelopes: DataFrame) -> DataFrame:
    """One row per landed page: its place from the file name, its answer from the document.

    Land this frame before taking both reports of it: it is small, its source is not.
    """
    part = lambda i: F.regexp_extract(SOURCE_FILE, PAGE_NAME, i)
    return envelopes.select(
        part(1).alias("region"),
        F.try_to_timestamp(part(2), F.lit("yyyyMMdd")).cast("date").alias("business_date"),
        part(3).alias("flow"),
        part(4).try_cast("long").alias("page"),
        "pages",
        "success",
        "code",
    )


def _expected(landed: DataFrame) -> DataFrame:
    # A download without a page count consists of one page.
    return landed.groupBy(*DOWNLOAD).agg(F.coalesce(F.max("pages"), F.lit(1)).alias("expected_pages"))


def missing_pages(landed: DataFrame) -> DataFrame:
    """One row per page that a download announces and that has not landed."""
    announced = explode_range(_expected(landed), F.lit(1), F.col("expected_pages"), "page")
    return announced.join(landed.select(*DOWNLOAD, "page"), [*DOWNLOAD, "page"], "left_anti").select(*DOWNLOAD, "page")


def audit_pages(landed: DataFrame, ok_code: int | None = None) -> DataFrame:
    """Per download: pages announced, landed, missing, and pages with a failed answer.

    Pages are counted as rows of a two-step aggregate; a download's page numbers are
    never gathered in one place.
    """
    failed = ~F.coalesce(F.col("success"), F.lit(False))
    if ok_code is not None:
        failed = failed | ~F.coalesce(F.col("code") == F.lit(ok_code), F.lit(False))
    per_page = landed.groupBy(*DOWNLOAD, "page").agg(
        F.max("pages").alias("pages"), F.max(failed.cast("int")).alias("failed")
    )
    totals = per_page.groupBy(*DOWNLOAD).agg(
        F.coalesce(F.max("pages"), F.lit(1)).alias("expected_pages"),
        F.count(F.lit(1)).alias("landed_pages"),
        F.sum("failed").alias("failed_pages"),
    )
    missing = missing_pages(landed).groupBy(*DOWNLOAD).agg(F.count(F.lit(1)).alias("missing"))
    return totals.join(missing, DOWNLOAD, "left").select(
        *DOWNLOAD,
        "expected_pages",
        "landed_pages",
        "failed_pages",
        F.coalesce("missing", F.lit(0)).alias("missing_pages"),
    )
