"""Bloom filters of the keys in a table, one per order month, kept as rows.

A filter is a bit array cut into blocks of 256 bits, in lanes of 32 (a split block Bloom
filter): a key sets one bit per lane of one block. A row holds one block, as four 64-bit
masks, and the bits that a load has set in it, so that a load only appends and the bits of
all loads are combined when a batch is tested. A key is one row wherever keys and filters
are shuffled, not one per bit. A month begins with a filter for FIRST_KEYS keys; the keys
of a load go to the smallest filter, each twice as large as the one before, that could hold
all keys of the month, so that a key is tested in as many filters as the month's key count
has doublings, whatever the number of loads.

A key that is in no filter is new for certain, and the table need not be read for it. Of
new keys about one in a thousand per filter is taken for a known one; those are then
looked up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "order_month"
MASKS = ["mask_0", "mask_1", "mask_2", "mask_3"]
SCHEMA = f"generation int, block long, {', '.join(f'{m} long' for m in MASKS)}, {MONTH} string, load_number long"

#: Keys that a month's first filter is made for, bits per key, bits of a block, and bits that a key sets.
FIRST_KEYS, BITS_PER_KEY, BLOCK_BITS, PROBES = 1 << 16, 16, 256, 8


def _key(keys: Sequence[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])


def with_generation(rows: DataFrame, keys: dict[str | None, int]) -> DataFrame:
    """Adds the generation that takes the rows of a month, so large that it could hold all `keys` of it, known and new."""
    generation = F.lit(0)
    for month, n in keys.items():
        if n > FIRST_KEYS:
            level = ((n - 1) // FIRST_KEYS).bit_length()
            generation = F.when(F.col(MONTH).eqNullSafe(F.lit(month)), level).otherwise(generation)
    return rows.withColumn("generation", generation)


def _place(rows: DataFrame) -> DataFrame:
    """Adds the block and the masks of a row's `key_a` and `key_b` in the filter of its `generation`."""
    blocks = F.lit(FIRST_KEYS * BITS_PER_KEY // BLOCK_BITS).cast("long") * F.expr("shiftleft(1L, generation)")

    def bit(lane: int) -> str:
        return f"shiftleft(1L, {32 * (lane % 2)} + cast(shiftrightunsigned(key_b, {8 * lane}) & 31 as int))"

    masks = {name: F.expr(f"{bit(2 * i)} | {bit(2 * i + 1)}") for i, name in enumerate(MASKS)}
    return rows.withColumns({"block": F.pmod("key_a", blocks), **masks})


def _combined(rows: DataFrame) -> DataFrame:
    """The blocks with all bits that are set in them. Combined before the shuffle."""
    return rows.groupBy(MONTH, "generation", "block").agg(*[F.bit_or(m).alias(m) for m in MASKS])


def words(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filter rows of the keys of `rows`, which have a month and a `generation`."""
    return _combined(_place(rows.select(MONTH, "generation", *key_hashes(keys))))


def held(filters: DataFrame) -> dict[str | None, int]:
    """About how many keys the filters of each month hold, from the share of bits that are set."""
    bits = sum((F.bit_count(m) for m in MASKS), F.lit(0))
    set_bits = _combined(filters).groupBy(MONTH, "generation").agg(F.sum(bits).alias("n"))
    keys: dict[str | None, int] = {}
    for row in set_bits.collect():
        size = FIRST_KEYS * BITS_PER_KEY << row["generation"]
        share = min(row["n"] / size, 1 - 1 / size)
        keys[row[MONTH]] = keys.get(row[MONTH], 0) + round(-size / PROBES * math.log(1 - share))
    return keys


def maybe_known(rows: DataFrame, filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_a, key_b, order_month) of the keys of `rows` that a filter of their month may hold; see `key_hashes`."""
    generations = filters.select(F.col(MONTH).alias("of_month"), "generation").distinct()
    asked = rows.select(MONTH, *key_hashes(keys))
    # A month has as many filters as doublings of its keys.
    asked = asked.join(F.broadcast(generations), F.col(MONTH).eqNullSafe(F.col("of_month"))).drop("of_month")
    there = _combined(filters).select(
        F.col(MONTH).alias("t_month"), F.col("generation").alias("t_generation"), F.col("block").alias("t_block"),
        *[F.col(m).alias(f"t_{m}") for m in MASKS],
    )
    # Only the hashes travel; the masks follow from them where they are compared.
    asked = _place(asked).drop(*MASKS)
    place = [F.col(MONTH).eqNullSafe(F.col("t_month")), F.col("generation") == F.col("t_generation"), F.col("block") == F.col("t_block")]
    met = _place(asked.join(there, place))
    for m in MASKS:
        met = met.filter(F.col(m).bitwiseAND(F.col(f"t_{m}")) == F.col(m))
    return met.select("key_a", "key_b", MONTH).distinct()


def key_hashes(keys: Sequence[str]) -> list[Column]:
    """Two hashes that stand for a key."""
    return [_key(keys, -1).alias("key_a"), _key(keys, -2).alias("key_b")]
