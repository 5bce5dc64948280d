"""Load of the facts into history and error tables, and export out of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.functions import dates
from kpiloom.operators import history, key_filter, ledger
from kpiloom.operators.export import publish_window
from kpiloom.operators.key_filter import MONTH
from kpiloom.operators.quality import FLAG, assign, check_mandatory
from kpiloom.plans.render import render
from kpiloom.session import folder_exists, land_observed, remove_folder, side_by_side, work_folder

DATE_KEY = "Order_Date"
#: The hashes that stand for a key, see `key_filter.key_hashes`.
_HASHES = ["key_a", "key_b"]


@dataclass(frozen=True)
class LoadCount:
    """What became of the rows of a batch; `rows` is the sum of the others but `updated`, which are among `added`."""

    rows: int
    added: int
    #: Rows added as a later version of a key.
    updated: int
    #: Valid rows of keys that the table had already, left out.
    known: int
    quarantined: int
    #: Invalid rows that are not needed: of a known or valid key, or quarantined before.
    dropped: int


def table_schema(fact: str) -> T.StructType:
    """The declared columns of a fact's table, with the check flag and those of the load."""
    return history.table_schema(checked_schema(contracts.FACT_TABLES[fact]))


def checked_schema(fact_schema: T.StructType) -> T.StructType:
    return T.StructType([*fact_schema.fields, T.StructField(FLAG, T.BooleanType())])


def _filter_path(root: str, fact: str) -> str:
    return f"{root.rstrip('/')}/_key_blocks/{fact}"


def _has_old_filters(spark: SparkSession, root: str, fact: str) -> bool:
    """The table has keys in filters of the form before (bits spread over a whole filter), which are not read."""
    return folder_exists(spark, f"{root.rstrip('/')}/_keys/{fact}")


def _filters(spark: SparkSession, root: str, fact: str, months: list[str | None]) -> DataFrame:
    """The filter rows of some months; see `key_filter`."""
    return history.read_months(spark, _filter_path(root, fact), months, key_filter.SCHEMA)


def _land_counted(df: DataFrame, folder: str) -> DataFrame | None:
    """The landed rows, or None if there are none, so that no join with them need be made."""
    rows, seen = land_observed(df, folder, rows=F.count(F.lit(1)))
    return rows if seen["rows"] else None


def _known_keys(
    batch: DataFrame, filters: DataFrame | None, root: str, fact: str, keys: list[str], months: list[str | None], folder: str, fmt: str
) -> DataFrame | None:
    """(key_a, key_b): hashes of the keys of the batch that the table has; None if it has none of them.

    By the table's own keys, only months in which a filter may hold a key of the batch are
    read, and nothing if there are none; by other keys all that can have them.
    """
    spark, hashes = batch.sparkSession, key_filter.key_hashes(keys)
    asked, wanted = batch.select(*hashes), None
    if keys == contracts.PRIMARY_KEYS[fact] and not _has_old_filters(spark, root, fact):
        maybe = None if filters is None else _land_counted(key_filter.maybe_known(batch, filters, keys), f"{folder}/maybe")
        asked = asked if maybe is None else maybe
        wanted = [] if maybe is None else [r[0] for r in maybe.select(MONTH).distinct().collect()]
    elif DATE_KEY in keys:
        wanted = months
    table = history.read_done(spark, root, fact, "history", table_schema(fact), fmt, wanted)
    if wanted == []:
        return None
    found = table.select(*hashes).join(asked, _HASHES, "left_semi").distinct()
    return _land_counted(found, f"{folder}/known")


def load_fact(
    df: DataFrame,
    root: str,
    fact: str,
    deduplicate: bool = True,
    now: datetime | str | None = None,
    keys: list[str] | None = None,
    fmt: str = "parquet",
    load: ledger.Load | None = None,
    complete: bool = False,
    on_bad_value: str = "refuse",
) -> LoadCount | None:
    """Checks, stamps and loads one fact, as a load of its own or part of `load`.

    `deduplicate` inserts new keys only; otherwise known keys get a later version, and with
    `complete` the batch's orders are replaced as a whole. The batch is cast to the declared
    table (see `assign`) and landed first; valid and invalid rows are then written by one
    job. Invalid rows are quarantined unless their key is known, valid in the batch itself,
    or the same row is quarantined already. A load that is done already is left alone.
    """
    if load is None:
        with ledger.loading(df.sparkSession, root) as load:
            return load_fact(df, root, fact, deduplicate, now, keys, fmt, load, complete, on_bad_value)
    if load.done:
        return None
    spark = df.sparkSession
    keys = list(keys or contracts.PRIMARY_KEYS[fact])
    folder = work_folder(spark, f"load-{fact}")
    try:
        checked = check_mandatory(assign(df, contracts.FACT_TABLES[fact], on_bad_value), contracts.MANDATORY[fact])
        stamped = history.with_stamp(checked, load.number, now).withColumns(
            {MONTH: history.order_month(DATE_KEY), history.COMPLETE: F.lit(complete)}
        )
        valid, rows = F.count_if(F.col(FLAG)), F.count(F.lit(1))
        batch, seen = land_observed(stamped, f"{folder}/batch", rows=rows, valid=valid)
        incoming = {r[0]: r["count"] for r in batch.groupBy(MONTH).count().collect()}
        months = list(incoming)
        filters = _filters(spark, root, fact, months)
        filters = filters if filters.inputFiles() else None
        known = _known_keys(batch, filters, root, fact, keys, months, folder, fmt)
        hashed = batch.select("*", *key_filter.key_hashes(keys))
        valid_rows = hashed.filter(F.col(FLAG))
        new = valid_rows if known is None else valid_rows.join(known, _HASHES, "left_anti")
        # Valid and invalid rows go on together, so that the batch is read once.
        if known is None or deduplicate:
            out = hashed if known is None else hashed.join(known, _HASHES, "left_anti")
            out = out.withColumn("is_known", F.lit(False))
        else:
            match = known.withColumn("met", F.lit(True))
            out = hashed.join(match, _HASHES, "left").withColumn("is_known", F.col("met").isNotNull())
            out = out.filter(F.col(FLAG) | ~F.col("is_known"))
        if seen["rows"] > seen["valid"]:
            out = _to_quarantine(out, hashed, root, fact, months, f"{folder}/quarantine", fmt)
        else:
            out = out.withColumns({history.KIND: F.lit("history"), history.DIGEST: F.lit(None).cast("string")})
        out = out.select(*batch.columns, "is_known", history.KIND, history.DIGEST)
        # The filter first: bits of rows that never come cost a look, rows without bits would come twice.
        held = {} if filters is None else key_filter.held(filters)
        _add_to_filter(new, {m: n + held.get(m, 0) for m, n in incoming.items()}, root, fact, load.number)
        kind = F.col(history.KIND)
        written = history.append_load(
            out,
            root,
            fact,
            DATE_KEY,
            fmt,
            added=F.count_if(kind == "history"),
            updated=F.count_if((kind == "history") & F.col("is_known")),
            quarantined=F.count_if(kind == "error"),
        )
    finally:
        remove_folder(spark, folder)
    n = {name: written[name] or 0 for name in written}
    return LoadCount(
        rows=seen["rows"],
        **n,
        known=seen["valid"] - n["added"],
        dropped=seen["rows"] - seen["valid"] - n["quarantined"],
    )


def _to_quarantine(
    rows: DataFrame, hashed: DataFrame, root: str, fact: str, months: list[str | None], folder: str, fmt: str
) -> DataFrame:
    """The rows with their kind, and with a digest if they are invalid.

    Without the invalid ones that are of a key valid in the batch `hashed`, or in the error table of
    their months. These are found by hashes of keys and rows; whole rows meet them only if there is any.
    """
    spark = hashed.sparkSession
    is_valid, digests = F.col(FLAG), ["digest_a", "digest_b"]

    def with_digest_hashes(rows: DataFrame) -> DataFrame:
        own = [F.xxhash64(F.lit(i), history.DIGEST).alias(name) for i, name in enumerate(digests)]
        return rows.select("*", *own)

    def without(rows: DataFrame, left_out: DataFrame, names: list[str]) -> DataFrame:
        """The rows without the invalid ones that `left_out` names; the valid ones stay where their hashes put them."""
        match = [F.col(f"row.{c}") == F.col(f"out.{c}") for c in names]
        return rows.alias("row").join(left_out.alias("out"), [*match, ~F.col(f"row.{FLAG}")], "left_anti")

    digest = F.sha2(F.to_json(F.struct(*[F.col(f.name) for f in contracts.FACT_TABLES[fact]])), 256)
    invalid, valid = hashed.filter(~is_valid), hashed.filter(is_valid).select(*_HASHES)
    both = _land_counted(invalid.select(*_HASHES).join(valid, _HASHES, "left_semi").distinct(), f"{folder}/both")
    if both is not None:
        rows = without(rows, both, _HASHES)
    rows = rows.withColumns(
        {history.KIND: F.when(is_valid, "history").otherwise("error"), history.DIGEST: F.when(~is_valid, digest)}
    )
    earlier = history.read_done(spark, root, fact, "error", table_schema(fact), fmt, months).select(history.DIGEST)
    if earlier.inputFiles():
        mine = with_digest_hashes(invalid.withColumn(history.DIGEST, digest)).select(*digests)
        again = mine.join(with_digest_hashes(earlier).select(*digests), digests, "left_semi").distinct()
        again = _land_counted(again, f"{folder}/again")
        if again is not None:
            spread = {name: F.when(is_valid, key).otherwise(F.col(name)) for name, key in zip(digests, map(F.col, _HASHES), strict=True)}
            rows = without(with_digest_hashes(rows).withColumns(spread), again, digests)
    return rows


def _add_to_filter(rows: DataFrame, sizes: dict[str | None, int], root: str, fact: str, number: int) -> None:
    """By the fact's own keys, whichever the load goes by."""
    keyed = key_filter.with_generation(rows, sizes)
    words = key_filter.words(keyed, contracts.PRIMARY_KEYS[fact]).withColumn(history.LOAD, F.lit(number).cast("long"))
    dealt = words.hint("rebalance", MONTH)
    dealt.write.mode("append").partitionBy(MONTH, history.LOAD).parquet(_filter_path(root, fact))


def load_history(
    facts: dict[str, DataFrame],
    root: str,
    deduplicate: bool = True,
    now: datetime | str | None = None,
    fmt: str = "parquet",
    source: str | None = None,
    batch: int | None = None,
    **options,
) -> dict[str, LoadCount | None]:
    """All facts as one load: its rows count once every fact is written, and never before.

    `source` and `batch` name the load; one of the same name that is done changes nothing.
    """
    if not facts:
        return {}
    spark = next(iter(facts.values())).sparkSession
    with ledger.loading(spark, root, source, batch) as load:
        # No fact reads or writes what another has.
        loads = {
            fact: partial(load_fact, df, root, fact, deduplicate, now, fmt=fmt, load=load, **options)
            for fact, df in facts.items()
        }
        return side_by_side(spark, loads)


def _set_keys(fact: str) -> list[str]:
    return contracts.ORDER_KEYS[fact]


def _as(rows: DataFrame, schema: T.StructType | None) -> DataFrame:
    """The rows in the columns and types of the flow that asks."""
    if schema is None:
        return rows
    rest = [c for c in (FLAG, history.STAMP) if c in rows.columns]
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name not in rest], *rest)


def read_history(
    spark: SparkSession,
    root: str,
    fact: str,
    fact_schema: T.StructType | None = None,
    keys: list[str] | None = None,
    kind: str = "history",
    fmt: str = "parquet",
) -> DataFrame:
    """The table as it stands now: each key's latest load, or the error rows.

    In the declared types, or those of `fact_schema`.
    """
    if kind == "history":
        own = keys or contracts.PRIMARY_KEYS[fact]
        if own == contracts.PRIMARY_KEYS[fact]:
            rows = history.read_current(spark, root, fact, table_schema(fact), own, _set_keys(fact), fmt)
        else:
            rows = history.current(history.read_done(spark, root, fact, kind, table_schema(fact), fmt), own)
    else:
        rows = history.read_done(spark, root, fact, kind, table_schema(fact), fmt)
    return _as(rows.drop(history.PARTITION, history.LOAD, MONTH, history.DIGEST, history.COMPLETE), fact_schema)


def compact_history(spark: SparkSession, root: str, facts: list[str] | None = None, fmt: str = "parquet") -> dict[str, list[str]]:
    """Writes down the current rows of the months that changed, of each fact."""
    compactions = {
        fact: partial(
            history.compact, spark, root, fact, table_schema(fact), contracts.PRIMARY_KEYS[fact], _set_keys(fact), fmt
        )
        for fact in facts or list(contracts.FACT_TABLES)
    }
    return side_by_side(spark, compactions)


def export_history(
    spark: SparkSession,
    root: str,
    outbound: str,
    schemas: dict[str, T.StructType],
    region: str,
    prefix: str,
    feed: str = "feed",
    start: date | None = None,
    end: date | None = None,
    fmt: str = "parquet",
    keys: dict[str, list[str]] | None = None,
) -> dict[str, list[str]]:
    """One export per fact of the rows ingested from `start` to `end`, by default yesterday's.

    Printed in the types of `schemas`, those of the feed. `keys` are those the facts were
    loaded with, where they are not the default ones. A fact without rows is no file.
    """
    yesterday = dates.request_window()[0].date()
    start, end = start or yesterday, end or yesterday

    def export(fact: str, schema: T.StructType) -> list[str]:
        table = history.read_done(spark, root, fact, "history", table_schema(fact), fmt)
        own = (keys or {}).get(fact) or contracts.PRIMARY_KEYS[fact]
        folder = work_folder(spark, f"window-{fact}")
        try:
            rows = _as(history.window_slice(table, own, start, end, _set_keys(fact), folder), schema)
            return publish_window(render(rows, feed, fact), outbound, fact, region, prefix, start, end)
        finally:
            remove_folder(spark, folder)

    return side_by_side(spark, {fact: partial(export, fact, schema) for fact, schema in schemas.items()})
