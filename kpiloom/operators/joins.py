"""Joins of facts with lookups and with each other. All are equi-joins.

No join carries a broadcast hint. Spark broadcasts a side when its size, known
from the files or measured by AQE at run time, is below
`spark.sql.autoBroadcastJoinThreshold`; beyond it the join shuffles and AQE
splits the partitions of hot keys (`spark.sql.adaptive.skewJoin.enabled`), which
it can do for every join here because the fact is always the left side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.codes import tender_label
from kpiloom.functions.text import to_int

ITEM_COLUMNS = ["Style", "Color", "Size"]


def join_tender(df: DataFrame, tender_map: DataFrame, on: dict[str, str], policy: str = "null") -> DataFrame:
    """Left join that adds `TenderType`.

    `on` maps columns of `df` to columns of the map, e.g. {"Tender": "TenderID"}
    or, per country, {"Country": "Country", "Tender": "TenderID"}. A tender id
    listed twice in the map doubles its payments, as a join does.
    """
    fact, tender = df.alias("fact"), tender_map.alias("tender")
    match = [F.col(f"fact.{mine}") == F.col(f"tender.{theirs}") for mine, theirs in on.items()]
    joined = fact.join(tender, match, "left")
    return joined.select("fact.*", tender_label(F.col("tender.TenderType"), policy).alias("TenderType"))


def _spread_key(c: Column, columns: Sequence[str]) -> Column:
    """The key, or for a NULL one a text that no key is, different from row to row.

    Rows without a key match nothing; spread like this they do not meet in one task.
    """
    return F.coalesce(c, F.concat(F.lit("\0"), F.xxhash64(*columns).cast("string")))


def with_item(lines: DataFrame, items: DataFrame, trim: bool = False, salts: int = 1) -> DataFrame:
    """Left join on Barcode that adds Style, Color and Size, trimmed when asked.

    Lines without a barcode are spread over the tasks. With `salts` above 1 the lines of
    a barcode are dealt to as many tasks, at the price of as many copies of the items:
    for a dimension too large to broadcast in a session that splits no hot keys.
    """
    line = lines.withColumn("__key", _spread_key(F.col("Barcode"), lines.columns))
    item, match = items, [F.col("line.__key") == F.col("item.Barcode")]
    if salts > 1:
        line = line.withColumn("__salt", F.pmod(F.xxhash64(*lines.columns), F.lit(salts)))
        item = items.withColumn("__salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        match.append(F.col("line.__salt") == F.col("item.__salt"))
    joined = line.alias("line").join(item.alias("item"), match, "left")
    clean = F.trim if trim else (lambda c: c)
    return joined.select(*[f"line.{c}" for c in lines.columns], *[clean(F.col(f"item.{c}")).alias(c) for c in ITEM_COLUMNS])


def lines_with_header(lines: DataFrame, header: DataFrame, key: str, header_columns: Sequence[str]) -> DataFrame:
    """Inner join of lines with their (already routed) headers on the record key."""
    line, head = lines.alias("line"), header.select(key, *header_columns).alias("head")
    return line.join(head, F.col(f"line.{key}") == F.col(f"head.{key}"), "inner").select(
        "line.*", *[f"head.{c}" for c in header_columns]
    )


def cancel_match(
    header: DataFrame,
    lines: DataFrame,
    line_columns: Sequence[str],
    line_number: str = "ORDER_D_NO",
) -> DataFrame:
    """Left join of cancelled headers with lines on store, order and line number.

    The header's line number is text and is compared as integer. Repeated keys
    give one row per combination.
    """
    head, line = header.alias("head"), lines.alias("line")
    # Sorts compare the first key most, and of all three the order tells most rows apart.
    match = [
        F.col("head.Transaction_Nbr") == F.col("line.Transaction_Nbr"),
        F.col("head.eCom_Store_ID") == F.col("line.eCom_Store_ID"),
        to_int(F.col(f"head.{line_number}")) == F.col("line.Item_Seq_Number"),
    ]
    return head.join(line, match, "left").select("head.*", *[f"line.{c}" for c in line_columns])


def not_in_history(df: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the history. A key with a NULL part counts as new."""
    known = history.select(*keys)
    return df.join(known, list(keys), "left_anti")
