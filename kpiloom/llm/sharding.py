"""Consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into `cells`; a key's cell comes from its hash. Every shard stands on
the ring at `vnodes` places, and a cell belongs to the first place clockwise. A shard
takes keys until its capacity; the rest go on clockwise to the next place whose shard
is not full. With `load` 1 the capacities are the row count dealt evenly, so counts
differ by one at most; with a larger load they are load times the mean, and fewer keys
move when the number of shards changes.

Which rows of a cell go where is settled over the counts per cell, a table whose size
is a parameter and not the data's. Rows are numbered inside (cell, lane), where a lane
is a share of the rows whatever their key, so one key with a third of all rows is
numbered by `lanes` tasks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed

SHARDS = 24
VNODES = 64
CELL_BITS = 12
LANES = 64


def ring_places(shards: int, vnodes: int, cell_bits: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order."""
    places = []
    for shard in range(shards):
        for node in range(vnodes):
            digest = hashlib.md5(f"shard {shard} node {node}".encode()).digest()
            places.append((int.from_bytes(digest[:8], "big") >> (64 - cell_bits), shard))
    return sorted(places)


def capacities(rows: int, shards: int, load: float) -> list[int]:
    if load <= 1:
        return [rows // shards + (shard < rows % shards) for shard in range(shards)]
    return [int(-(-rows * load // shards))] * shards


def ring_segments(
    counts: dict[int, int], places: list[tuple[int, int]], capacity: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank, shard, slot of the first) for all rows of all cells.

    Round by round, every place of the ring takes what waits there until its shard is
    full and passes the rest on. A round passes something on only if a shard became
    full in it, so there are at most as many rounds as shards.
    """
    spots = [cell for cell, _ in places]
    waiting: list[deque] = [deque() for _ in places]
    for cell in sorted(counts):
        if counts[cell]:
            waiting[bisect_left(spots, cell) % len(places)].append((cell, 0, counts[cell]))
    used, segments = [0] * len(capacity), []
    while any(waiting):
        passed: list[deque] = [deque() for _ in places]
        for at, (_, shard) in enumerate(places):
            while waiting[at] and used[shard] < capacity[shard]:
                cell, first, end = waiting[at].popleft()
                stop = min(end, first + capacity[shard] - used[shard])
                segments.append((cell, first, stop - 1, shard, used[shard]))
                used[shard] += stop - first
                if stop < end:
                    waiting[at].appendleft((cell, stop, end))
        for at in range(len(places)):
            if waiting[at]:
                to = (at + 1) % len(places)
                while used[places[to][1]] >= capacity[places[to][1]]:
                    to = (to + 1) % len(places)
                passed[to].extend(waiting[at])
        waiting = passed
    return segments


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    vnodes: int = VNODES,
    load: float = 1.0,
    cell_bits: int = CELL_BITS,
    lanes: int = LANES,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, cell, shard, and slot, gapless in the shard.

    Keys are doc_ids; null is a key like any other, and repeated rows are rows. The size
    is the UTF-8 length of the text plus 8; a null text counts as empty. Other columns
    are not read. Empty in, empty out.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    keyed = checkpointed(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(F.col("doc_id")).alias("at"),
            F.pmod(F.monotonically_increasing_id(), F.lit(lanes)).cast("int").alias("lane"),
        ).withColumn("cell", F.expr(f"cast(shiftrightunsigned(at, {64 - cell_bits}) as int)"))
    )
    by_lane = keyed.groupBy("cell", "lane").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["cell"]: r["n"] for r in by_lane.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    segments = ring_segments(
        counts, ring_places(shards, vnodes, cell_bits), capacities(sum(counts.values()), shards, load)
    )
    routes = docs.sparkSession.createDataFrame(
        segments, "to_cell int, first long, last long, shard int, first_slot long"
    )
    # Sums over at most `lanes` rows each.
    in_cell = Window.partitionBy("cell").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_lane.withColumn("before", F.coalesce(F.sum("n").over(in_cell), F.lit(0))).drop("n")
    in_lane = Window.partitionBy("cell", "lane").orderBy("at", "doc_id", "text_crc32", "size")
    numbered = (
        keyed.withColumn("i", F.row_number().over(in_lane) - 1)
        .join(starts, ["cell", "lane"])
        .withColumn("rank", F.col("before") + F.col("i"))
    )
    meets = (F.col("cell") == F.col("to_cell")) & F.col("rank").between(F.col("first"), F.col("last"))
    return numbered.join(F.broadcast(routes), meets).select(
        "doc_id",
        "size",
        "text_crc32",
        "cell",
        "shard",
        (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot"),
    )
