"""Mixing of sources to target weights.

Words are added up per source. Sources share the words of the mix by weight, each up
to `cap` times what it has; what a capped source cannot take goes to the others by
their weights. A source's repetition rate is its target over its words. Every document
is taken floor(rate) times, and once more with the probability of the rate's fraction,
which a hash of the seed, the document's id and text decides, so that reruns agree.

Where a source has few documents, or a few long ones, one draw can miss its target by far.
So each source has TURNS draws, the hash turned by so many parts of the circle, all added
up in one aggregate, and takes the draw that comes nearest to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, fresh, lookup, ranked, words_count

#: By the place of the source in the order of code points, null last, and again from the start.
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
#: Draws that a source chooses from.
TURNS = 64

_EXACT = "decimal(38,0)"


def source_targets(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, share: float = 1.0) -> DataFrame:
    """One checkpointed row per source: mix_source, source_size, target.

    The targets add up to `share` (at most `cap`) times all words. The rounds that find
    the capped sources aggregate the table of sources; the driver sees two sums a round.
    Without rows or words the targets are 0.
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(
        F.coalesce(F.sum(words_count(F.col("text"))), F.lit(0)).alias("source_size")
    )
    placed = ranked(sizes, "__place", F.col("mix_source").asc_nulls_last())
    listed = F.array(*[F.lit(int(w)) for w in weights])
    table = checkpointed(
        placed.withColumn("__w", F.get(listed, F.pmod("__place", F.lit(len(weights))).cast("int")).cast("long"))
    )
    size, weight = F.col("source_size").cast(_EXACT), F.col("__w").cast(_EXACT)
    words, weighed = table.agg(F.sum(size), F.sum(weight)).first()
    total, capped, free = int(int(words or 0) * share), 0, int(weighed or 0)
    while True:
        left = F.lit(total - capped).cast(_EXACT)
        above = F.lit(free == 0) | (left * weight > size * cap * F.lit(free).cast(_EXACT))
        full, rest = table.agg(F.sum(F.when(above, size * cap)), F.sum(F.when(~above, weight))).first()
        state = int(full or 0), int(rest or 0)
        if state == (capped, free):
            break
        capped, free = state
    shared = F.lit(total - capped).cast("double") * F.col("__w") / F.lit(max(free, 1)).cast("double")
    target = F.when(above, (F.col("source_size") * cap).cast("double")).otherwise(shared)
    return checkpointed(table.select("mix_source", "source_size", target.alias("target")))


def unit_hash(seed: str, *keys: Column) -> Column:
    """Number from 0 to below 1, made of 52 bits of an MD5."""
    parts = [F.coalesce(key.cast("string"), F.lit("")) for key in keys]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _turned(unit: Column, turn: Column) -> Column:
    """The number moved on by a part of the circle; exact, as both have few binary digits."""
    moved = unit + turn.cast("double") * F.lit(1.0 / TURNS)
    return moved - F.floor(moved)


def _rates(rows: DataFrame) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.withColumn("__rate", rate).withColumn("__whole", F.floor("__rate")).withColumn("__part", F.col("__rate") - F.col("__whole"))


def nearest_turns(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The table of sources with `mix_turn`, the draw whose words come nearest to the target; of equal ones the first."""
    rows = _rates(lookup(sized.select("source", "size", "__unit"), targets, [("source", "mix_source")]))
    extra = [F.sum(F.when(_turned(F.col("__unit"), F.lit(k)) < F.col("__part"), F.col("size")).otherwise(0)) for k in range(TURNS)]
    sums = rows.groupBy("mix_source", "source_size", "target", "__whole").agg(*[x.alias(f"__{k}") for k, x in enumerate(extra)])
    wanted = F.col("target") - F.col("__whole") * F.col("source_size")
    misses = F.array(*[F.struct(F.abs(F.col(f"__{k}") - wanted).alias("miss"), F.lit(k).alias("turn")) for k in range(TURNS)])
    return checkpointed(sums.select("mix_source", "source_size", "target", F.array_min(misses)["turn"].alias("mix_turn")))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    share: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """The documents with size, source_size, target (of the source), and copies.

    Needs the columns doc_id, text, source. A null text has no words, a null source is
    a source, rows with one doc_id and text (nulls included) fare alike. Columns of these
    names that the documents already have are replaced. Empty in, empty out.
    """
    own = {"size", "source_size", "target", "copies", "mix_source", "mix_turn", "__unit", "__rate", "__whole", "__part"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in own])
    unit = unit_hash(seed, F.col("doc_id"), F.col("text"))
    sized = docs.withColumns({"size": words_count(F.col("text")), "__unit": unit})
    chosen = nearest_turns(sized, source_targets(docs, weights, cap, share))
    rows = _rates(lookup(sized, chosen, [("source", "mix_source")]))
    extra = F.when(_turned(F.col("__unit"), F.col("mix_turn")) < F.col("__part"), 1).otherwise(0)
    copies = (F.col("__whole") + extra).cast("int")
    return rows.withColumn("copies", copies).drop("mix_source", "mix_turn", "__unit", "__rate", "__whole", "__part")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as the plan says, columns unchanged."""
    planned = plan_mix(docs.select("*", F.struct(*docs.columns).alias(row := fresh(docs, "__row"))), **settings)
    copies = planned.filter(F.col("copies") > 0).select(
        row, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")
    )
    return copies.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
