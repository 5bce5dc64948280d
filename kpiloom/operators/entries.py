"""Form records: URL-encoded `name=value&name=value` lines to columns.

Two equivalent routes exist.

* In place (`read_fields`, `explode_items`): names and values become two arrays
  of the same row; a field is a lookup in them and the items of an order are
  slices of the number-suffixed entries. Nothing is shuffled, so this is the
  route of the jobs.
* Over rows (`record_entries`, `pivot_header`, `pivot_lines`): one row per entry,
  then grouped back into wide rows. It costs a shuffle and is meant for entries
  that are already stored as rows.

The first occurrence of a repeated name wins on both routes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.text import (
    after_first,
    base_name,
    before_first,
    form_decode,
    seq_suffix,
    split_on,
)
from kpiloom.operators.nested import explode_range

RECORD_ID = "record_id"

# Parts of `&name=value`. The strict form also drops what follows a further `=`.
VALUE_PART = r"=[^&]*"
NAME_PART = r"&[^&=]*=?()"
STRICT_NAME_PART = r"&[^&=]*=?([^&=]*)[^&]*"
# A whole `&name`, capturing its number suffix if it has one.
NUMBERED_NAME = r"&(?:[^&]*_(\d+)(?=&|$)|[^&]*)"

# Copies of one line that may be written out by one task.
COPIES_PER_TASK = 1_000_000


# --------------------------------------------------------------- entry level


def split_pair(pair: Column) -> tuple[Column, Column]:
    """Raw name and raw value around the first `=`; the value keeps any further `=`."""
    return before_first(pair, "="), after_first(pair, "=")


def split_pair_strict(pair: Column) -> tuple[Column, Column]:
    """Parts one and two around every `=`: a value is cut at a further `=`."""
    return F.split_part(pair, F.lit("="), F.lit(1)), F.split_part(pair, F.lit("="), F.lit(2))


def explode_pairs(df: DataFrame, col: str, name: str = "pair") -> DataFrame:
    """One row per `&`-separated pair."""
    return df.select("*", F.explode(split_on(F.col(col), "&")).alias(name))


def with_record_id(df: DataFrame, text: str = "value", source: str | None = None) -> DataFrame:
    """Key per line that is the same in every run: content hash and copy number.

    Lines are counted by two hashes, so the count shuffles no texts. A line that is there
    once, as most are, gets its number where it stands; only repeated ones are grouped by
    their text, combined before the shuffle, and their copies are written out by many
    tasks. Keeps `text` and `source` only.
    """
    group = [text] + ([source] if source else [])
    rows = df.select(*group, F.xxhash64(*group).alias("__a"), F.xxhash64(F.lit(1), *group).alias("__b"))
    repeated = rows.groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    marked = rows.join(repeated, ["__a", "__b"], "left")
    digest = F.sha2(F.concat_ws("\u001f", *[F.col(c) for c in reversed(group)]), 256)

    single = marked.filter(F.col("__n").isNull()).withColumn("__copy", F.lit(1).cast("long"))
    counted = marked.filter(F.col("__n").isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("__copies"))
    copies, first = F.col("__copies"), F.col("__from")
    starts = F.sequence(F.lit(1).cast("long"), copies, F.lit(COPIES_PER_TASK).cast("long"))
    spread = counted.withColumn("__from", F.explode(starts)).repartition(*group, "__from")
    ids = explode_range(spread, first, F.least(copies, first + F.lit(COPIES_PER_TASK - 1)), "__copy")
    both = single.select(*group, "__copy").unionByName(ids.select(*group, "__copy"))
    return both.select(F.concat_ws("-", digest, F.col("__copy").cast("string")).alias(RECORD_ID), *group)


def record_entries(records: DataFrame, text: str = "value", decode_first: bool = False) -> DataFrame:
    """(record_id, pos, name, value, sequence, base): one row per entry.

    By default a record is split first and its parts decoded afterwards, so that
    an encoded `&` or `=` stays part of its value. `decode_first` decodes the
    whole line, splits then, and cuts a value at a further `=`.
    """
    line = form_decode(F.col(text)) if decode_first else F.col(text)
    # A line that cannot be decoded stays a record, with no entry to read.
    pairs = records.select(RECORD_ID, F.posexplode_outer(split_on(line, "&")).alias("pos", "pair"))
    if decode_first:
        name, value = split_pair_strict(F.col("pair"))
    else:
        name, value = map(form_decode, split_pair(F.col("pair")))
    entries = pairs.select(RECORD_ID, "pos", name.alias("name"), value.alias("value"))
    return entries.select("*", seq_suffix(F.col("name")).alias("sequence"), base_name(F.col("name")).alias("base"))


def line_entries(entries: DataFrame) -> DataFrame:
    """Entries whose name carries a number suffix."""
    return entries.filter(F.col("sequence").isNotNull())


# ------------------------------------------------------------------- pivots


def _grouped(entries: DataFrame, keys: Sequence[str], name: str, names: Sequence[str]) -> DataFrame:
    """One row per key with `found`: the entries of the asked names, by position.

    One list per key instead of a state per name: it is collected by hash, without a sort.
    A key with none of the names keeps its row.
    """
    entry = F.when(F.col(name).isin(list(names)), F.struct("pos", F.col(name).alias("name"), "value"))
    return entries.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("found"))


def _spread(grouped: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The first value of each name, as columns; absent names are NULL."""
    arrays = grouped.select(*keys, F.col("found.name").alias("__names"), F.col("found.value").alias("__values"))
    firsts = [F.get("__values", F.array_position("__names", F.lit(name)) - 1).alias(name) for name in names]
    return arrays.select(*keys, *firsts)


def pivot_header(entries: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row per record. Absent names are NULL columns."""
    return _spread(_grouped(entries, [RECORD_ID], "name", names), [RECORD_ID], names)


def pivot_lines(entries: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row per record and number suffix."""
    keys = [RECORD_ID, "sequence"]
    return _spread(_grouped(line_entries(entries), keys, "base", names), keys, names)


def pivot_lines_conditional(entries: DataFrame, names: Sequence[str]) -> DataFrame:
    """`pivot_lines` with a condition per name over the entries of a row, without the pivot operator."""
    keys = [RECORD_ID, "sequence"]

    def first(name: str) -> Column:
        return F.get(F.filter("found", lambda e: e["name"] == F.lit(name)), F.lit(0))["value"].alias(name)

    return _grouped(line_entries(entries), keys, "base", names).select(*keys, *[first(name) for name in names])


# ----------------------------------------------------------------- in place


def with_fields(
    records: DataFrame, text: str = "value", decode_first: bool = False, items: bool = False
) -> DataFrame:
    """Replaces a record's text by two arrays, `names` and `values`.

    For `explode_items`, ask for `items`: a third array holds the number suffix of
    each name, or ''.

    Values stay encoded until a field is read, as most of them never are; after
    `decode_first` they are plain, and `field` has to be told so.
    """
    line = F.concat(F.lit("&"), form_decode(F.col(text)) if decode_first else F.col(text))
    # Names and values of the whole line by one replacement each. Element 1 of both
    # arrays stands for the text in front of the first `&` and is empty.
    cut = records.select(
        *[c for c in records.columns if c != text],
        F.regexp_replace(line, VALUE_PART, "").alias("__names"),
        split_on(F.regexp_replace(line, STRICT_NAME_PART if decode_first else NAME_PART, "&$1"), "&").alias("__values"),
    )
    # Few feeds encode names at all; one look at them spares a call per name.
    encoded = F.contains("__names", F.lit("%")) | F.contains("__names", F.lit("+"))
    plain = split_on(F.col("__names"), "&")
    names = plain if decode_first else F.when(encoded, F.transform(plain, form_decode)).otherwise(plain)
    arrays = [names.alias("names"), F.col("__values").alias("values")]
    if items:
        suffixes = split_on(F.regexp_replace("__names", NUMBERED_NAME, "&$1"), "&")
        if not decode_first:
            each = F.transform(names, lambda name: F.coalesce(seq_suffix(name), F.lit("")))
            suffixes = F.when(encoded, each).otherwise(suffixes)
        arrays.append(suffixes.alias("sequences"))
    # As a generator of one row, the arrays are built once per record: a later filter
    # on a field then tests them, where a plain projection would be repeated in it.
    return cut.select(*[c for c in records.columns if c != text], F.inline(F.array(F.struct(*arrays))))


def _lookup(name: Column, decoded: bool) -> Column:
    """First value under a name, NULL when the record has no such name."""
    found = F.get("values", F.array_position("names", name) - 1)
    return found if decoded else form_decode(found)


def field(name: str, decoded: bool = False) -> Column:
    """A header field of a frame made by `with_fields`."""
    return _lookup(F.lit(name), decoded)


def explode_items(fields: DataFrame, carried: Sequence[str], outer: bool = False) -> DataFrame:
    """One row per number suffix, with that suffix's entries only, and its `place` among the record's.

    `fields` is a frame made by `with_fields(..., items=True)`. With `outer` a record
    without items has one row, whose suffix is NULL.

    The suffixed entries are sorted by suffix once, and every item is a slice
    between two neighbouring starts: the work grows with the length of the
    record, not with its square, however many items an order has.
    """

    def is_start(place: Column) -> Column:
        here, previous = F.get("__entries", place - 1), F.get("__entries", place - 2)
        return (place == 1) | (here["sequences"] != previous["sequences"])

    positions = F.sequence(F.lit(1), F.size("names")).alias("pos")
    entry = F.arrays_zip(F.col("sequences"), positions, F.col("names"), F.col("values"))
    suffixed = F.filter(entry, lambda e: e["sequences"] != F.lit(""))
    sorted_entries = fields.select(*carried, F.sort_array(suffixed).alias("__entries"))
    places = F.when(F.size("__entries") > 0, F.sequence(F.lit(1), F.size("__entries")))
    starts = sorted_entries.withColumn("__starts", F.filter(places, is_start))
    # The outer explode keeps Spark from computing the arrays once more in a filter
    # on their size; a record without items falls out at the start's own filter.
    rows = starts.select(
        *carried,
        "__entries",
        "__starts",
        F.posexplode_outer("__starts").alias("__n", "__start"),
    )
    if not outer:
        rows = rows.filter(F.col("__start").isNotNull())
    stop = F.coalesce(F.get("__starts", F.col("__n") + 1), F.size("__entries") + 1)
    items = rows.select(
        *carried,
        F.coalesce("__n", F.lit(0)).alias("place"),
        F.slice("__entries", F.col("__start"), stop - F.col("__start")).alias("__item"),
    )
    return items.select(
        *carried,
        "place",
        F.get("__item", F.lit(0))["sequences"].alias("sequence"),
        F.col("__item.names").alias("names"),
        F.col("__item.values").alias("values"),
    )


def item_field(name: str, decoded: bool = False) -> Column:
    """A field of a frame made by `explode_items`, by its name without suffix."""
    return _lookup(F.concat(F.lit(name + "_"), F.col("sequence")), decoded)
