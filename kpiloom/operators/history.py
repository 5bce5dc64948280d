"""History and error tables of the facts.

A load appends files to partitions of its own, (kind, order month, day of the load, number
of the load), in one write for valid and invalid rows, and rewrites nothing: a reader
never sees a half-replaced file, and rows of a load that is not done (see ledger.py) are
left out by their partition. An update is a newer version of a key; `current` leaves the
versions that no later load replaced. `compact` writes these down per order month, so that
a reader need not find them again. Any appendable format works; Parquet is the default.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.dates import in_window, ingestion_ts
from kpiloom.operators import ledger
from kpiloom.operators.key_filter import MONTH
from kpiloom.session import file_system, folder_exists, land_observed, remove_folder, work_folder

STAMP = "ingestion_timestamp"
PARTITION = "ingestion_date"
LOAD = "load_number"


KIND = "kind"
#: Hash of the row, for rows of the error table.
DIGEST = "row_digest"
#: The rows of the load are all there are of their order.
COMPLETE = "complete_set"
LAYOUT = [KIND, MONTH, PARTITION, LOAD]


def table_path(root: str, fact: str, kind: str) -> str:
    """`kind` is `history` or `error`."""
    return f"{root.rstrip('/')}/{fact}/{KIND}={kind}"


def with_stamp(df: DataFrame, load: int, now: datetime | str | None = None) -> DataFrame:
    stamped = df.withColumns({STAMP: ingestion_ts(now), LOAD: F.lit(load).cast("long")})
    return stamped.withColumn(PARTITION, F.to_date(STAMP))


def order_month(date_key: str) -> Column:
    """Partition of a row: the month of its order date, null where that is no date."""
    text = F.col(date_key).cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}"), F.left(text, F.lit(7)))


def table_schema(fact_schema: T.StructType) -> T.StructType:
    """Columns of a fact that carries its check flag, and those of the load."""
    load = {
        COMPLETE: T.BooleanType(),
        DIGEST: T.StringType(),
        STAMP: T.TimestampType(),
        LOAD: T.LongType(),
        MONTH: T.StringType(),
        PARTITION: T.DateType(),
    }
    fields = [T.StructField(f.name, f.dataType) for f in fact_schema if f.name not in load]
    return T.StructType([*fields, *[T.StructField(name, kind) for name, kind in load.items()]])


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Creates the table, empty, unless its folder exists."""
    if not folder_exists(spark, path):
        append(spark.createDataFrame([], schema), path, fmt)


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Makes the table known to the session's catalog, for SQL users, who see every load that has written.

    With a metastore behind it, a query on few days or months then lists those only.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = ", ".join(LAYOUT[1:])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} PARTITIONED BY ({parts}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(schema).load(path)


def read_done(
    spark: SparkSession,
    root: str,
    fact: str,
    kind: str,
    schema: T.StructType,
    fmt: str = "parquet",
    months: Sequence[str | None] | None = None,
) -> DataFrame:
    """The rows of loads that are done, of all order months or some. The others are left out by their partition.

    Only the folders of the months are listed, however many others there are.
    """
    path = table_path(root, fact, kind)
    if months is None:
        ensure_table(spark, path, schema, fmt)
        rows = read_table(spark, path, schema, fmt)
    else:
        rows = read_months(spark, path, months, schema, fmt)
    failed = ledger.unfinished(spark, root)
    return rows.filter(~F.col(LOAD).isin(failed)) if failed else rows


def month_folder(month: str | None) -> str:
    return f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def read_months(
    spark: SparkSession, path: str, months: Sequence[str | None], schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """The partitions of some order months of the table at `path`; no rows where there are none."""
    fs, to_path = file_system(spark, path)
    there = {str(s.getPath().getName()) for s in fs.listStatus(to_path(path))} if fs.exists(to_path(path)) else set()
    folders = [f"{path}/{name}" for name in map(month_folder, months) if name in there]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(folders)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(PARTITION).save(path)


def append_load(df: DataFrame, root: str, fact: str, date_key: str, fmt: str = "parquet", **aggregates: Column) -> dict:
    """Writes the rows of a load, which carry their `kind`, in one job; a large month is many tasks'.

    Gives the values of the aggregates over the rows, taken where these are written. Columns
    that the table lacks serve the aggregates only.
    """
    own = [f.name for f in df.schema if f.name != "is_known"]
    dealt, seen = df.hint("rebalance", KIND, MONTH), Observation()
    if aggregates:
        dealt = dealt.observe(seen, *[c.alias(name) for name, c in aggregates.items()])
    sorted_rows = dealt.select(*own).sortWithinPartitions(*LAYOUT, date_key)
    sorted_rows.write.format(fmt).mode("append").partitionBy(*LAYOUT).save(f"{root.rstrip('/')}/{fact}")
    return seen.get if aggregates else {}


def near_batch(history: DataFrame, batch: DataFrame, date_key: str) -> DataFrame:
    """History rows whose date lies in the batch's date range, the only ones a key can equal.

    The bounds are two values; the filter reaches the scan and skips row groups, which
    are written in date order.
    """
    lo, hi = batch.agg(F.min(date_key), F.max(date_key)).first()
    return history.filter(F.lit(False) if lo is None else F.col(date_key).between(lo, hi))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by its other columns. Aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def _version() -> Column:
    """Load and stamp of a row, the later the greater."""
    return F.struct(LOAD, STAMP)


def _replaced(history: DataFrame, keys: Sequence[str], newest: DataFrame) -> DataFrame:
    """The rows without those of a key that `newest` (`keys`, __last) has a later version of."""
    # The hash adds nothing to the match, but keeps the join from reusing the shuffle
    # of the aggregate: AQE splits a hot key's partition only where both sides of the
    # join come straight from a shuffle of the join itself.
    digest = F.xxhash64(*keys).alias("__hash")
    old, new = history.select("*", digest, _version().alias("__version")).alias("old"), newest.select("*", digest).alias("new")
    match = [F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")) for key in [*keys, "__hash"]]
    older = F.col("old.__version") < F.col("new.__last")
    return old.join(new, [*match, older], "left_anti").drop("__hash", "__version")


def current(
    history: DataFrame, keys: Sequence[str], set_keys: Sequence[str] | None = None, folder: str | None = None
) -> DataFrame:
    """Rows that no later load has replaced.

    A later load replaces the rows of its keys; where it says that it has all rows of an
    order (`COMPLETE`), it replaces all of the order, by `set_keys`. Only keys with more
    than one load enter the join; in a table that was never updated there are none.

    With a new `folder`, which the caller removes, these keys are landed in it first: whole
    rows are then shuffled only if the keys are many, and meet no join if there are none.
    """

    def without(rows: DataFrame, by: Sequence[str], newest: DataFrame, name: str) -> DataFrame:
        if folder:
            newest, seen = land_observed(newest, f"{folder}/{name}", rows=F.count(F.lit(1)))
            if not seen["rows"]:
                return rows
        return _replaced(rows, by, newest)

    version = _version()
    loads = history.groupBy(*keys).agg(F.max(version).alias("__last"), F.min(version).alias("__first"))
    rows = without(history, keys, loads.filter(F.col("__first") < F.col("__last")).drop("__first"), "keys")
    if not set_keys or COMPLETE not in history.columns:
        return rows
    whole = history.filter(COMPLETE).groupBy(*set_keys).agg(F.max(version).alias("__last"))
    return without(rows, set_keys, whole, "sets")


def window_slice(
    history: DataFrame,
    keys: Sequence[str],
    start: date,
    end: date,
    set_keys: Sequence[str] | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Current rows ingested from `start` to `end`, both days included; `folder` as in `current`.

    Partitions before `start` are not read: a row is only ever replaced later.
    """
    since = current(history.filter(F.col(PARTITION) >= F.lit(start)), keys, set_keys, folder)
    day = since.filter(F.col(PARTITION) <= F.lit(end))
    lo, hi = F.lit(start).cast("timestamp"), F.date_add(F.lit(end), 1).cast("timestamp")
    return day.filter(in_window(F.col(STAMP), lo, hi))


def snapshot(history: DataFrame, keys: Sequence[str], target: str, fmt: str = "parquet") -> None:
    """Writes the current rows as a new table next to the history, to read or to go on with."""
    current(history, keys).write.format(fmt).partitionBy(PARTITION).save(target)


# ------------------------------------------------------------ compaction

AS_OF = "as_of"


def _written_loads(spark: SparkSession, root: str, fact: str) -> set[int]:
    """Numbers of the loads that have rows in the history table, by its folders."""
    fs, path = file_system(spark, root)
    found = fs.globStatus(path(f"{table_path(root, fact, 'history')}/{MONTH}=*/{PARTITION}=*/{LOAD}=*")) or []
    return {int(str(s.getPath().getName()).split("=")[1]) for s in found}


def _snapshot_path(root: str, fact: str) -> str:
    return f"{root.rstrip('/')}/_current/{fact}"


def _pointers(spark: SparkSession, root: str, fact: str) -> list[tuple[int, dict[str, int]]]:
    """(load, {month: as_of}) of the compactions, the latest last. An empty month stands for none."""
    fs, path = file_system(spark, root)
    found = fs.globStatus(path(f"{_snapshot_path(root, fact)}/_pointers/*")) or []
    numbers = sorted(int(str(s.getPath().getName())) for s in found)
    texts = {n: spark.read.text(f"{_snapshot_path(root, fact)}/_pointers/{n:012d}", wholetext=True).first()[0] for n in numbers[-2:]}
    return [(n, json.loads(text)) for n, text in texts.items()]


def compact(spark: SparkSession, root: str, fact: str, schema: T.StructType, keys: Sequence[str], set_keys: Sequence[str] | None = None, fmt: str = "parquet") -> list[str]:
    """Writes down the current rows of the order months that loads since the last compaction touched.

    Months are replaced by new folders and a new pointer that names them, so that a reader,
    or a compaction that fails, always has whole ones; what the pointer before the last
    named and the last does not is removed. Returns the months written.
    """
    rows = read_done(spark, root, fact, "history", schema, fmt)
    # A load that is not done may come again under its number: nothing from there on is written down.
    failed = ledger.unfinished(spark, root)
    last = rows.agg(F.max(LOAD)).first()[0] or 0
    upto = min([last, *(n - 1 for n in failed)])
    pointers = _pointers(spark, root, fact)
    since, months = pointers[-1] if pointers else (0, {})
    if upto <= since:
        return []
    new = rows.filter((F.col(LOAD) > since) & (F.col(LOAD) <= upto))
    touched = [r[0] for r in new.select(MONTH).distinct().collect()]
    target = _snapshot_path(root, fact)
    folder = work_folder(spark, f"compact-{fact}")
    try:
        versions = read_done(spark, root, fact, "history", schema, fmt, touched).filter(F.col(LOAD) <= upto)
        kept = current(versions, keys, set_keys, folder).withColumn(AS_OF, F.lit(upto).cast("long"))
        dealt = kept.hint("rebalance", MONTH)
        # What a failed compaction has left under this number is replaced.
        writer = dealt.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH, AS_OF).save(target)
    finally:
        remove_folder(spark, folder)
    fs, path = file_system(spark, root)
    now = months | {month or "": upto for month in touched}
    with_text = fs.create(path(f"{target}/_pointers/{upto:012d}"), True)
    with_text.write(bytearray(json.dumps(now).encode()))
    with_text.close()
    for _, before in pointers[:-1]:
        for month, as_of in before.items():
            if months.get(month) != as_of:
                remove_folder(spark, f"{target}/{month_folder(month or None)}/{AS_OF}={as_of}")
    return sorted(m or "" for m in touched)


def read_current(spark: SparkSession, root: str, fact: str, schema: T.StructType, keys: Sequence[str], set_keys: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows that no later load has replaced, from the last compaction and the loads since.

    Only keys of later loads are compared, and with them only what was written down.
    """
    rows = read_done(spark, root, fact, "history", schema, fmt)
    pointers = _pointers(spark, root, fact)
    if not pointers:
        return current(rows, keys, set_keys)
    upto, months = pointers[-1]
    wanted = F.lit(False)
    for month, as_of in months.items():
        wanted |= F.col(MONTH).eqNullSafe(F.lit(month or None)) & (F.col(AS_OF) == as_of)
    whole = T.StructType([*schema.fields, T.StructField(AS_OF, T.LongType())])
    base = read_table(spark, _snapshot_path(root, fact), whole, fmt).filter(wanted).drop(AS_OF)
    new = rows.filter(F.col(LOAD) > upto)
    if max(_written_loads(spark, root, fact) - set(ledger.unfinished(spark, root)), default=0) <= upto:
        return base
    version = F.max(_version()).alias("__last")
    base = _replaced(base, keys, new.groupBy(*keys).agg(version))
    if set_keys:
        base = _replaced(base, set_keys, new.filter(COMPLETE).groupBy(*set_keys).agg(version))
    return base.unionByName(current(new, keys, set_keys))
