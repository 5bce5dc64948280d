"""Whole jobs: inbound files -> facts -> dated exports, and the history load where a root is named.

One function per flow. A flow without files, or with files without rows, writes no file
and loads nothing; the others go on. Every fact is computed once per use of it, from
landed rows, and the date in a file's name is taken in the pass that lands it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.operators import export
from kpiloom.plans import conformed_flow, envelope_flow, feed_flow, flat_flow, history_flow
from kpiloom.plans.render import render
from kpiloom.session import remove_folder, work_folder
from kpiloom.sources import readers


@dataclass(frozen=True)
class Target:
    """Where a job's output goes: files `<prefix>_<region>_<Fact>-<date>.csv`, and history tables."""

    outbound: str
    region: str
    prefix: str
    history: str | None = None
    #: Options of `load_history`, such as source and batch.
    load: dict = field(default_factory=dict)


def _read_csv(spark: SparkSession, inbound: str, flow: str, schema, dialect: str = "quoted") -> DataFrame:
    path = readers.inbound_glob(inbound, flow)
    return readers.read_or_empty(spark, lambda: readers.read_csv(spark, path, schema, dialect), schema)


def _finish(facts: dict[str, DataFrame], target: Target, feed: str, **dates) -> dict[str, list[str]]:
    if target.history:
        history_flow.load_history(facts, target.history, **target.load)
    printed = {fact: render(df, feed, fact) for fact, df in facts.items()}
    return export.publish_facts(printed, target.outbound, target.region, target.prefix, **dates)


def _nothing(*facts: str) -> dict[str, list[str]]:
    return {fact: [] for fact in facts}


def feed_job(spark: SparkSession, inbound: str, target: Target, tender_map: DataFrame, items: DataFrame) -> dict[str, list[str]]:
    """The form feed's four facts. All files are named by the earliest order date of the feed."""
    feed = readers.read_or_empty(
        spark, lambda: readers.read_form_feed(spark, readers.inbound_glob(inbound, "form_feed")), "value string"
    )
    folder = work_folder(spark, "feed")
    try:
        orders, lines, seen = feed_flow.landed_feed(feed, folder)
        if not seen["rows"]:
            return _nothing("header", "line", "payment", "cancel")
        facts = {
            "header": feed_flow.build_header(orders),
            "line": feed_flow.build_line(lines, items),
            "payment": feed_flow.build_payment(orders, tender_map),
            "cancel": feed_flow.build_cancel(lines, items),
        }
        return _finish(facts, target, "feed", on_date=seen["day"])
    finally:
        remove_folder(spark, folder)


def flat_job(spark: SparkSession, inbound: str, target: Target, tender_map: DataFrame, items: DataFrame) -> dict[str, list[str]]:
    """The flat recovery files: sales named by their earliest order date, cancellations by theirs."""
    folder, written = work_folder(spark, "flat"), {}
    try:
        sales = _read_csv(spark, inbound, "flat_sales", contracts.FLAT_SALES, "raw")
        cancel = _read_csv(spark, inbound, "flat_cancel", contracts.FLAT_CANCEL, "raw")
        if readers.has_rows(sales):
            facts = flat_flow.sales_facts(sales, tender_map, items, f"{folder}/sales")
            written |= _finish(facts, target, "flat", one_date=True)
        else:
            written |= _nothing("header", "line", "payment")
        if readers.has_rows(cancel):
            facts = flat_flow.cancel_facts(cancel, items, f"{folder}/cancel")
            written |= _finish(facts, _again(target, "cancel"), "flat", one_date=True)
        else:
            written |= _nothing("cancel")
        return written
    finally:
        remove_folder(spark, folder)


def _again(target: Target, part: str) -> Target:
    """The target of a job's second load, which has a name of its own."""
    load = target.load
    if load.get("source") is not None:
        load = {**load, "source": f"{load['source']}/{part}"}
    return Target(target.outbound, target.region, target.prefix, target.history, load)


def envelope_job(
    spark: SparkSession, inbound: str, target: Target, tender_map: DataFrame, multi_line: bool = True
) -> dict[str, list[str]]:
    """The JSON pages: sales named by the earliest order date of the pages, else their names'; cancellations by status date."""

    def pages(flow: str, schema) -> DataFrame:
        path = readers.inbound_glob(inbound, flow)
        with_file = T.StructType([*schema.fields, T.StructField(readers.SOURCE_FILE, T.StringType())])
        return readers.read_or_empty(
            spark, lambda: readers.read_order_envelopes(spark, path, schema, multi_line), with_file
        )

    folder, written = work_folder(spark, "pages"), {}
    try:
        for flow, schema, column, build, names in (
            ("sales_envelope", contracts.SALES_ENVELOPE, "Order_Date", envelope_flow.sales_facts, ("header", "line", "payment")),
            ("cancel_envelope", contracts.CANCEL_ENVELOPE, "Status_Date", envelope_flow.cancel_facts, ("cancel",)),
        ):
            envelopes = pages(flow, schema)
            if not readers.has_rows(envelopes):
                written |= _nothing(*names)
                continue
            facts = build(envelopes, tender_map, f"{folder}/{flow}")
            day = envelope_flow.business_day(envelopes, column)
            written |= _finish(facts, target if flow == "sales_envelope" else _again(target, "cancel"), "envelope", on_date=day)
        return written
    finally:
        remove_folder(spark, folder)


def conformed_job(spark: SparkSession, inbound: str, target: Target, tender_map: DataFrame) -> dict[str, list[str]]:
    """The recovery files in fact layout, each named by its own earliest date; a missing one is skipped."""
    facts, missing = {}, []
    for fact, rows in conformed_flow.read_files(spark, inbound).items():
        if readers.has_rows(rows):
            facts[fact] = conformed_flow.build(fact, rows, tender_map)
        else:
            missing.append(fact)
    return (_finish(facts, target, "conformed") if facts else {}) | _nothing(*missing)


def window_job(spark: SparkSession, target: Target, feed: str, start: date | None = None, end: date | None = None) -> dict[str, list[str]]:
    """The export of the rows ingested from `start` to `end`, by default yesterday's, printed as the feed's facts."""
    return history_flow.export_history(
        spark, target.history, target.outbound, fact_schemas(spark, feed), target.region, target.prefix, feed, start, end
    )


def fact_schemas(spark: SparkSession, feed: str) -> dict:
    """Columns and types of a flow's four facts."""
    empty = lambda schema: spark.createDataFrame([], schema)
    tender, by_country, items = empty(contracts.TENDER), empty(contracts.TENDER_BY_COUNTRY), empty(contracts.ITEM)
    if feed == "feed":
        return feed_flow.fact_schemas(spark)
    if feed == "flat":
        sales, cancel = empty(contracts.FLAT_SALES), empty(contracts.FLAT_CANCEL)
        return {
            "header": flat_flow.build_header(sales).schema,
            "line": flat_flow.build_line(sales, items).schema,
            "payment": flat_flow.build_payment(sales, tender).schema,
            "cancel": flat_flow.build_cancel(cancel, items).schema,
        }
    if feed == "conformed":
        files = {
            "header": contracts.CONFORMED_HEADER,
            "line": contracts.CONFORMED_LINE,
            "payment": contracts.CONFORMED_PAYMENT,
            "cancel": contracts.CONFORMED_CANCEL,
        }
        return {fact: conformed_flow.build(fact, empty(schema), by_country).schema for fact, schema in files.items()}
    if feed == "envelope":
        orders = empty(contracts.SALES_ENVELOPE["orders"].dataType.elementType)
        cancelled = empty(contracts.CANCEL_ENVELOPE["orders"].dataType.elementType)
        return {
            "header": envelope_flow.build_header(orders).schema,
            "line": envelope_flow.build_line(orders).schema,
            "payment": envelope_flow.build_payment(orders, by_country).schema,
            "cancel": envelope_flow.build_cancel(cancelled, by_country).schema,
        }
    raise ValueError(f"unknown feed: {feed}")
