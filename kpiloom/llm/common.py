"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import shared_folder

# Words are what stands between ASCII blanks, in every operator that counts words.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

#: Rows of a decision table up to which it is broadcast; its rows have a fixed small width.
BROADCAST_ROWS = 200_000

#: Bytes that a Python worker gets at a time, so that its memory does not follow the lengths of texts.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def release_memory() -> None:
    """Gives what this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def mapped(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """`df.mapInArrow` in batches of BATCH_BYTES, whatever the session sets; a longer row is a batch of its own.

    A worker serves task after task; what one has freed goes back to the system, not to the next.
    """

    def run(batches):
        yield from function(batches)
        release_memory()

    df.sparkSession.conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores in front where the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lookup(
    big: DataFrame, small: DataFrame, keys: Sequence[tuple[str, str]], how: str = "inner", width: Column | None = None
) -> DataFrame:
    """Joins a checkpointed table of one row per key to a large frame; nulls equal nulls.

    Up to BROADCAST_ROWS rows it is broadcast, `width` counting for a row where rows have
    arrays. Beyond, both sides are shuffled, and adaptive execution splits the partitions
    of hot keys. `keys` are pairs of a column of `big` and one of `small`, with different names.
    """
    match = [F.col(b).eqNullSafe(F.col(s)) for b, s in keys]
    rows = small.agg(F.sum(F.lit(1) if width is None else width)).first()[0] or 0
    return big.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, match, how)


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """The rows with their place in the global order, from 0; no task holds them all.

    The sort is a range shuffle; what one task numbers are the partitions, not the rows.
    """
    spot = fresh(df, "__spot")
    placed = checkpointed(df.orderBy(*order).withColumn(spot, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(spot), 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n")).collect()
    before, starts = 0, []
    for row in sorted(counts, key=lambda r: r["__part"]):
        starts.append((row["__part"], before))
        before += row["__n"]
    table = placed.sparkSession.createDataFrame(starts, "__part long, __before long")
    inside = F.col(spot).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(table), part == F.col("__part"))
        .withColumn(name, F.col("__before") + inside)
        .drop(spot, "__part", "__before")
    )


def words_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
