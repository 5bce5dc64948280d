"""Pickup of landed files: each file is processed once, then archived."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.functions.dates import UTC_PLUS_8
from kpiloom.plans import feed_flow, history_flow
from kpiloom.session import file_system, remove_folder, work_folder
from kpiloom.sources.readers import CSV_DIALECTS, SOURCE_FILE, with_source_file

_TEXT = T.StructType([T.StructField("value", T.StringType())])
_CSV = {"sep": ",", "encoding": "UTF-8", "header": "true"}

# How far a file's time stamp may lie behind the newest file's before it is left out;
# Spark's default of a week would skip recovery files that keep their old stamp.
MAX_FILE_AGE = "36500d"

# Flow -> (format, schema, options).
FLOW_SOURCES = {
    "sales_envelope": ("json", contracts.SALES_ENVELOPE, {"multiLine": "true"}),
    "cancel_envelope": ("json", contracts.CANCEL_ENVELOPE, {"multiLine": "true"}),
    "form_feed": ("text", _TEXT, {"lineSep": "\n"}),
    "flat_sales": ("csv", contracts.FLAT_SALES, {**_CSV, **CSV_DIALECTS["raw"]}),
    "flat_cancel": ("csv", contracts.FLAT_CANCEL, {**_CSV, **CSV_DIALECTS["raw"]}),
    "conformed_header": ("csv", contracts.CONFORMED_HEADER, {**_CSV, **CSV_DIALECTS["quoted"]}),
    "conformed_line": ("csv", contracts.CONFORMED_LINE, {**_CSV, **CSV_DIALECTS["quoted"]}),
    "conformed_payment": ("csv", contracts.CONFORMED_PAYMENT, {**_CSV, **CSV_DIALECTS["quoted"]}),
    "conformed_cancel": ("csv", contracts.CONFORMED_CANCEL, {**_CSV, **CSV_DIALECTS["quoted"]}),
}


def inbound_stream(
    spark: SparkSession,
    flow: str,
    inbound: str,
    archive: str | None = None,
    files_per_batch: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream over one flow's files. Files of other flows in the same folder are left alone."""
    fmt, schema, options = FLOW_SOURCES[flow]
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    reader = reader.option("pathGlobFilter", contracts.FLOW_GLOBS[flow]).option("maxFileAge", max_file_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_source_file(reader.load(inbound))


def ingest_inbound(
    spark: SparkSession,
    flow: str,
    inbound: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None],
    archive_root: str | None = None,
    files_per_batch: int | None = None,
    now: datetime | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> None:
    """Hands every file that is new since the last run to `process`, then stops.

    The checkpoint, not the folder, says what is new. After a crash the same batch
    is handed over again under the same number, so `process` must be repeatable: a history
    load named by `source=checkpoint, batch=<number>` is. With `archive_root` the files of
    a run move to `<archive>/yyyy/MM/dd` when all its batches are committed; those of a run
    that crashed stay until the next one has handed them over and ended.
    """
    notes = f"{checkpoint.rstrip('/')}/handed_over"

    def noted(batch: DataFrame, number: int) -> None:
        # Written before the work: what is noted and not done is handed over again.
        if archive_root:
            batch.select(SOURCE_FILE).distinct().write.mode("overwrite").text(f"{notes}/{number}")
        process(batch, number)

    stream = inbound_stream(spark, flow, inbound, None, files_per_batch, max_file_age)
    query = (
        stream.writeStream.foreachBatch(noted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if archive_root:
        day = (now or datetime.now(UTC_PLUS_8)).strftime("%Y/%m/%d")
        archive_files(spark, notes, f"{archive_root.rstrip('/')}/{day}")


def archive_files(spark: SparkSession, notes: str, archive: str) -> list[str]:
    """Moves the files noted below `notes` to the archive, and forgets the notes. Returns what moved.

    A file that is gone was moved before a crash. One whose name the archive has already
    gets a number.
    """
    fs, path = file_system(spark, notes)
    if not fs.exists(path(notes)):
        return []
    moved = []
    # One name per file of the run; the files themselves do not pass the driver.
    for row in spark.read.text(f"{notes}/*").distinct().toLocalIterator():
        source = path(unquote(row[0]))
        if not fs.exists(source):
            continue
        fs.mkdirs(path(archive))
        target, n = f"{archive}/{source.getName()}", 0
        while fs.exists(path(target)):
            n += 1
            target = f"{archive}/{n}-{source.getName()}"
        if not fs.rename(source, path(target)):
            raise OSError(f"cannot move {source} to {target}")
        moved.append(target)
    remove_folder(spark, notes)
    return moved


def load_feed(
    spark: SparkSession,
    inbound: str,
    checkpoint: str,
    root: str,
    tender_map: DataFrame,
    items: DataFrame,
    archive_root: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> None:
    """New files of the form feed into the history tables, each batch as a load of its own.

    A batch that comes again after a crash is known by the stream and its number: if its
    load was done, nothing changes; if not, it starts anew under the same load number.
    """

    def process(feed: DataFrame, number: int) -> None:
        folder = work_folder(spark, "feed")
        try:
            facts = feed_flow.feed_facts(feed, tender_map, items, folder)
            history_flow.load_history(facts, root, source=checkpoint, batch=number, **options)
        finally:
            remove_folder(spark, folder)

    ingest_inbound(spark, "form_feed", inbound, checkpoint, process, archive_root, files_per_batch)
