"""MinHash near-dedup with sequential Bayesian verification.

Documents are sets of word shingles; two are linked when the Jaccard similarity of
their full sets reaches the threshold. Equal sets are one class from the start. A class
has a signature of HASHES MinHash values. Signatures are cut into bands; classes that
agree in a band share a bucket, and every two classes of a bucket are candidates.

A candidate's signatures are compared batch by batch. After each batch the posterior of
its similarity, given the matches so far and a uniform prior, says whether it can still
reach the threshold; where that is less likely than `miss`, the candidate is dropped.
Survivors are verified exactly, on the full sets made from the texts.

Buckets are never expanded into all pairs. In the first round each class meets one
class only, the smallest of the bucket that it shares most often. What survives the
posterior makes families, and every member of a family is compared with the family's
root, exactly, from the texts; what it lacks of the root's set and has beyond it is
kept. From these differences the exact similarity of any two members follows, so that
the members that are not linked to the root are compared, in blocks, with all others:
a block pair is one task's matrices, and what it emits is a spanning forest of the
links it found, fewer rows than members. In the second round, buckets whose members are
of several families are compared in blocks of signatures, everything outside the
largest family with everything; what survives the posterior is verified from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, fresh, lookup, mapped
from kpiloom.llm.components import components

WORDS = 5
#: Least similarity, in percent.
PERCENT = 80
HASHES = 128
#: Values per band: at similarity 0.8 a pair shares no band with a probability of 5e-8.
BAND = 4
#: Signature values compared before the posterior is looked at again.
BATCH = 32
MISS = 1e-6
#: Members of a bucket or family in one block, and of a class's partners in one verification task.
BLOCK = 1024
LANE_ROWS = 128

_U = np.uint64
_KEYED = "rid long, key_id long, key_hash long, n_shingles long, set_hash binary, signature binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles.

    Words are ASCII-lower-cased and stand between ASCII blanks; a text with fewer words
    than a shingle is one shingle, a text without words has none.
    """
    split = (text or b"").lower().split()
    if not split:
        return np.zeros(0, dtype=_U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), dtype=_U, count=len(split))
    n = min(words, len(split))
    total = np.full(len(split) - n + 1, n, dtype=_U)
    for i in range(n):
        total = _mixed(total * _U(0x9E3779B97F4A7C15) + hashes[i : len(split) - n + 1 + i])
    return np.unique(total)


@cache
def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_010)
    return rng.integers(0, 1 << 63, n, dtype=_U) * _U(2) + _U(1), rng.integers(0, 1 << 63, n, dtype=_U)


def signature(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """16 bits of each MinHash; stretches of 1,024 shingles bound the memory of long texts."""
    a, b = _family(hashes)
    low = np.full(hashes, np.iinfo(np.uint64).max, dtype=_U)
    for i in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[i : i + 1024, None] * a + b).min(axis=0))
    return _mixed(low).astype(np.uint16)


@cache
def least_matches(threshold: float, miss: float, hashes: int = HASHES, batch: int = BATCH) -> tuple[tuple[int, int], ...]:
    """(values compared, least matches): with fewer, P(similarity >= threshold) is below `miss`.

    With a uniform prior that probability is P(Bin(n + 1, threshold) <= m) for m of n matches.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        p, m = 0.0, -1
        while p < miss:
            m += 1
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def survives(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which rows of two signature matrices may reach the threshold, by sequential batches."""
    alive, matches, start = np.arange(len(left)), np.zeros(len(left), dtype=np.int32), 0
    for n, least in least_matches(threshold, miss, left.shape[1]):
        matches[alive] += (left[alive, start:n] == right[alive, start:n]).sum(axis=1)
        alive, start = alive[matches[alive] >= least], n
    return alive


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    column = batch.column("text")
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py()


def _sign(words: int):
    def run(batches):
        for batch in batches:
            sizes, sets, signatures = [], [], []
            for text in _texts(batch):
                shingles = shingle_set(text, words)
                sizes.append(len(shingles))
                sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("rid", "key_id", "key_hash")),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["rid", "key_id", "key_hash", "n_shingles", "set_hash", "signature"],
            )

    return run


def _bands(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.array(batch.column("node"), dtype=np.int64)
        rows = np.array([np.frombuffer(x.as_py(), np.uint16) for x in batch.column("signature")]).reshape(-1, HASHES)
        bands = HASHES // BAND
        key = np.ascontiguousarray(rows).view(np.uint64).reshape(-1, bands)
        key = _mixed(key + np.arange(1, bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(ids, bands))], names=["bucket", "node"]
        )


def _prune_pairs(threshold: float, miss: float):
    def run(batches):
        for batch in batches:
            left, right = (
                np.array([np.frombuffer(x.as_py(), np.uint16) for x in batch.column(c)]).reshape(-1, HASHES)
                for c in ("sig_a", "sig_b")
            )
            keep = pa.array(survives(left, right, threshold, miss))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

    return run


def _by_group(function):
    """Runs `function` over each run of rows with equal bucket, x, y; rows come sorted by them."""

    def run(batches):
        held, current = [], None
        for batch in batches:
            keys = np.stack([np.array(batch.column(c), dtype=np.int64) for c in ("bucket", "x", "y")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if end == start:
                    continue
                if (key := tuple(keys[start])) != current:
                    if held:
                        yield from function(pa.Table.from_batches(held)).to_batches()
                    held, current = [], key
                held.append(batch.slice(start, end - start))
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()

    return run


def _signatures(column) -> np.ndarray:
    return np.array([np.frombuffer(x.as_py(), np.uint16) for x in column]).reshape(-1, HASHES)


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows to compare: side 1 with side 2, or with itself if there is no side 2."""
    side = np.array(table.column("side"))
    one, two = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
    return one, two if len(two) or table.column("x")[0] != table.column("y")[0] else one


def _edges(a, b) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _prune_blocks(threshold: float, miss: float):
    """Pairs of two blocks that the posterior leaves."""

    def run(table: pa.Table) -> pa.Table:
        node, comp = np.array(table.column("node")), np.array(table.column("comp"))
        rows, (one, two) = _signatures(table.column("signature")), _sides(table)
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in one:
            other = two[comp[two] != comp[i]]
            keep = other[survives(np.broadcast_to(rows[i], (len(other), HASHES)), rows[other], threshold, miss)]
            out_a.append(np.minimum(node[keep], node[i]))
            out_b.append(np.maximum(node[keep], node[i]))
        return _edges(np.concatenate(out_a), np.concatenate(out_b))

    return run


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right, in stretches of elements."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    every = np.intersect1d(np.concatenate([*left, np.zeros(0, _U)]), np.concatenate([*right, np.zeros(0, _U)]))
    for start in range(0, len(every), 4096):
        part = every[start : start + 4096]
        sides = []
        for sets in (left, right):
            hits = np.zeros((len(sets), len(part)), dtype=np.float32)
            for i, own in enumerate(sets):
                at = np.searchsorted(part, own)
                at = at[(at < len(part)) & (part[np.minimum(at, len(part) - 1)] == own)]
                hits[i, at] = 1
            sides.append(hits)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _exact_blocks(threshold: float, miss: float, percent: int):
    """A spanning forest of the links between two blocks of a family, from the differences to its root."""

    def run(table: pa.Table) -> pa.Table:
        node, own = np.array(table.column("node")), np.array(table.column("n_own"))
        rows, (one, two) = _signatures(table.column("signature")), _sides(table)
        alive = np.zeros((len(one), len(two)), dtype=bool)
        for k, i in enumerate(one):
            alive[k, survives(np.broadcast_to(rows[i], (len(two), HASHES)), rows[two], threshold, miss)] = True
        alive &= node[one][:, None] != node[two]
        # Only rows and columns that the posterior left in some pair are looked at exactly.
        one, two = one[used := alive.any(axis=1)], two[other := alive.any(axis=0)]
        alive = alive[used][:, other]
        if not alive.size:
            return _edges([], [])
        plus, minus = (
            [np.frombuffer(x.as_py(), _U) for x in table.column(c)] for c in ("plus", "minus")
        )
        lacks = np.array([len(x) for x in minus])
        both_lack = _shared_counts([minus[i] for i in one], [minus[i] for i in two])
        both_have = _shared_counts([plus[i] for i in one], [plus[i] for i in two])
        root = table.column("n_root")[0].as_py()
        shared = root - (lacks[one][:, None] + lacks[two] - both_lack) + both_have
        linked = alive & (100 * shared >= percent * (own[one][:, None] + own[two] - shared))
        label, out_a, out_b = {int(n): int(n) for n in node}, [], []
        names = np.array([label[int(n)] for n in node])
        for k, i in enumerate(one):
            for j in two[linked[k]]:
                if names[i] != names[j]:
                    out_a.append(node[i])
                    out_b.append(node[j])
                    names[names == names[j]] = names[i]
        return _edges(out_a, out_b)

    return run


_COMPARED = "hub long, node long, linked boolean, n_root long, n_own long, plus binary, minus binary"


def _compare(words: int, percent: int, differences: bool):
    """Streams texts sorted by (hub, lane, hub first) and compares each with its hub.

    Held in memory is the set of one hub. Whole numbers are compared: 100 * shared >= percent * union.
    """

    def run(batches):
        current, held = None, None
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("hub", "lane", "node")), strict=True)
            for (hub, lane, node), text in zip(rows, _texts(batch), strict=True):
                if (hub, lane) != current:
                    current, held = (hub, lane), None
                if node == hub:
                    held = shingle_set(text, words)
                elif held is not None:
                    own = shingle_set(text, words)
                    shared = len(np.intersect1d(held, own, assume_unique=True))
                    linked = 100 * shared >= percent * (len(held) + len(own) - shared)
                    plus, minus = (
                        np.setdiff1d(x, y, assume_unique=True).tobytes() if differences else None
                        for x, y in ((own, held), (held, own))
                    )
                    out.append((hub, node, linked, len(held), len(own), plus, minus))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["hub", "node", "linked", "n_root", "n_own", "plus", "minus"],
            )

    return run


def _compared(
    docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int, differences: bool
) -> DataFrame:
    """Exact comparison of pairs (a, b), from the texts; a is the hub that its partners meet in lanes."""
    partners = pairs.groupBy(F.col("a").alias("hub")).agg(F.count(F.lit(1)).alias("n"))
    lanes = F.ceil(F.col("n") / LANE_ROWS).cast("long")
    lane = F.explode(F.sequence(F.lit(0).cast("long"), lanes - 1)).alias("lane")
    hubs = partners.select("hub", lane, F.col("hub").alias("node"))
    met = pairs.join(partners.withColumnRenamed("hub", "a"), "a")
    members = met.select(
        F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), lanes).alias("lane"), F.col("b").alias("node")
    )
    roles = hubs.unionByName(members).groupBy("node").agg(F.collect_list(F.struct("hub", "lane")).alias("roles"))
    keyed = nodes.select("node", F.col("key_id").alias("n_id"), F.col("key_hash").alias("n_hash"))
    small = checkpointed(roles.join(keyed, "node"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = lookup(texts, small, [("doc_id", "n_id"), ("h", "n_hash")], width=F.size("roles"))
    dealt = (
        found.select("node", "text", F.inline("roles"))
        .repartition("hub", "lane")
        .sortWithinPartitions("hub", "lane", (F.col("node") != F.col("hub")), "node")
    )
    return checkpointed(dealt.transform(mapped, _compare(words, percent, differences), _COMPARED))


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, head) of the buckets with several nodes; the head is the smallest."""
    buckets = nodes.select("node", "signature").transform(mapped, _bands, "bucket long, node long")
    heads = buckets.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head"))
    heads = checkpointed(heads.filter("n > 1").drop("n"))
    return checkpointed(lookup(buckets, heads, [("bucket", "of")]).drop("of"))


def _best_heads(shared: DataFrame) -> DataFrame:
    """Pairs (a, b): each node b with the head a that it shares most buckets with."""
    counted = shared.filter("node <> head").groupBy("node", "head").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("node").agg(F.max(F.struct("n", (-F.col("head")).alias("low"))).alias("best"))
    return checkpointed(best.select((-F.col("best.low")).alias("a"), F.col("node").alias("b")))


def _pruned(pairs: DataFrame, nodes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs that the posterior leaves."""
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
    signed = pairs.join(right, "b").join(left, "a")
    return checkpointed(signed.transform(mapped, _prune_pairs(threshold, miss), "a long, b long"))


def _open_buckets(shared: DataFrame, best: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, node, comp, base, rest) of the buckets in which nodes of several components are still to compare.

    `base` is the component with most nodes in the bucket, `rest` the number of nodes outside of it.
    """
    placed = shared.join(comps.select(F.col("node").alias("c_node"), "root"), F.col("node") == F.col("c_node"), "left")
    placed = placed.select("bucket", "node", F.coalesce("root", "node").alias("comp"))
    met = best.select(F.col("b").alias("m_node"), F.col("a").alias("met"))
    placed = checkpointed(placed.join(met, F.col("node") == F.col("m_node"), "left").drop("m_node"))
    by_comp = placed.groupBy("bucket", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max(F.struct("node", "met")).alias("high")
    )
    by_bucket = by_comp.groupBy(F.col("bucket").alias("of")).agg(
        F.count(F.lit(1)).alias("comps"),
        F.sum("n").alias("size"),
        F.max(F.struct("n", "comp")).alias("most"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    # Two nodes that met in the first round need not meet again.
    met_before = (F.col("size") == 2) & F.col("high.met").eqNullSafe(F.col("low"))
    still = by_bucket.filter((F.col("comps") > 1) & ~met_before).select(
        "of", F.col("most.comp").alias("base"), (F.col("size") - F.col("most.n")).alias("rest")
    )
    return checkpointed(lookup(placed.drop("met"), checkpointed(still), [("bucket", "of")]).drop("of"))


def _dealt(members: DataFrame) -> DataFrame:
    """(bucket, node, comp, x, y, side): members dealt to pairs of blocks.

    Blocks x of the rest meet each other (y >= 0) and the blocks of the base (y < 0).
    """
    blocks = F.ceil(F.col("rest") / BLOCK).cast("int")
    spot = F.xxhash64(F.col("node"), F.lit("block"))
    rest = members.filter("comp <> base").withColumn("own", F.pmod(spot, blocks).cast("int"))
    base = members.filter("comp = base")
    meets = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.struct(
            F.least(j, F.col("own")).alias("x"),
            F.greatest(j, F.col("own")).alias("y"),
            F.when(j >= F.col("own"), 1).otherwise(2).alias("side"),
        ),
    )
    sizes = base.groupBy(F.col("bucket").alias("of")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("groups"))
    sizes = checkpointed(sizes)
    base = lookup(base, sizes, [("bucket", "of")]).withColumn("y", -1 - F.pmod(spot, F.col("groups")).cast("int"))
    to_base = F.explode(F.sequence(F.lit(-1), -F.col("groups"), F.lit(-1))).alias("y")
    to_rest = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("x")
    first, second = F.lit(1).alias("side"), F.lit(2).alias("side")
    resting = lookup(rest, sizes, [("bucket", "of")])
    return (
        rest.select("bucket", "node", "comp", F.inline(meets))
        .unionByName(resting.select("bucket", "node", "comp", F.col("own").alias("x"), to_base, first))
        .unionByName(base.select("bucket", "node", "comp", to_rest, "y", second))
    )


def _in_blocks(members: DataFrame, payload: DataFrame, function) -> DataFrame:
    dealt = _dealt(members).join(payload, "node").repartition("bucket", "x", "y")
    edges = dealt.sortWithinPartitions("bucket", "x", "y").transform(mapped, _by_group(function), "a long, b long")
    return checkpointed(edges.distinct())


def near_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, miss: float = MISS
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, first, key_hash.

    component_id is the smallest doc_id (null only if there is no other) of all documents
    that links reach; `first` tells whether the row is the component's first by doc_id,
    null last, then by hash of the text. Null, empty and blank texts have no shingles and
    stand alone. Rows that agree in doc_id and text fare alike. Other columns are not
    read. Empty in, empty out.
    """
    threshold = percent / 100
    keyed = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").alias("key_id"),
        F.xxhash64("text").alias("key_hash"),
        "text",
    )
    signed = checkpointed(keyed.transform(mapped, _sign(words), _KEYED))
    order = F.struct(F.col("key_id").isNull().alias("n"), F.col("key_id").alias("id"), F.col("key_hash").alias("h"))
    # One node per set; its text is that of the row of the smallest order.
    classes = checkpointed(
        signed.filter("n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min(F.struct(order.alias("o"), "rid", "signature")).alias("best"), F.count(F.lit(1)).alias("copies"))
        .select(
            F.col("best.rid").alias("node"),
            F.col("best.o.id").alias("key_id"),
            F.col("best.o.h").alias("key_hash"),
            F.col("best.o").alias("least"),
            F.col("best.signature").alias("signature"),
            "set_hash",
            "copies",
        )
    )
    links = _links(docs, classes, words, percent, threshold, miss)
    comps = components(links)
    rooted = classes.join(comps.select(F.col("node").alias("c_node"), "root"), F.col("node") == F.col("c_node"), "left")
    rooted = rooted.select("set_hash", "least", "copies", F.coalesce("root", "node").alias("root"), "c_node")
    # Only sets with copies or links differ from their own row.
    several = checkpointed(rooted.filter((F.col("copies") > 1) | F.col("c_node").isNotNull()))
    leasts = checkpointed(several.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("first_of")))
    named = checkpointed(
        lookup(several, leasts, [("root", "r")]).select(F.col("set_hash").alias("s"), "first_of")
    )
    out = lookup(signed.filter("n_shingles > 0").drop("signature"), named, [("set_hash", "s")], how="left")
    alone = signed.filter("n_shingles = 0").select("key_id", "key_hash", "n_shingles")
    grouped = out.select(
        F.col("key_id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("s").isNull(), F.col("key_id")).otherwise(F.col("first_of.id")).alias("component_id"),
        (F.col("s").isNull() | (order == F.col("first_of"))).alias("is_first"),
        "key_hash",
    )
    single = alone.select(
        F.col("key_id").alias("doc_id"), "n_shingles", F.col("key_id").alias("component_id"), F.lit(True).alias("is_first"), "key_hash"
    )
    return grouped.unionByName(single)


def _links(
    docs: DataFrame, classes: DataFrame, words: int, percent: int, threshold: float, miss: float
) -> DataFrame:
    """Verified links between classes that connect all that are connected."""
    nodes = classes.select("node", "key_id", "key_hash", "signature")
    shared = _shared_buckets(nodes)
    best = _best_heads(shared)
    families = components(_pruned(best, nodes, threshold, miss))
    to_root = families.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    compared = _compared(docs, nodes, to_root, words, percent, differences=True)
    links = compared.filter("linked").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    # In a family, what is linked to the root is the base; the root itself has met everything.
    counts = compared.groupBy(F.col("hub").alias("of")).agg(F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("rest"))
    unlinked = checkpointed(counts.filter("rest > 0"))
    members = lookup(compared, unlinked, [("hub", "of")]).select(
        F.col("hub").alias("bucket"),
        "node",
        F.when(F.col("linked"), F.col("hub")).otherwise(F.col("node")).alias("comp"),
        F.col("hub").alias("base"),
        "rest",
    )
    payload = compared.select("node", "n_root", "n_own", "plus", "minus").join(nodes.select("node", "signature"), "node")
    inside = _in_blocks(members, payload, _exact_blocks(threshold, miss, percent))
    across = _in_blocks(
        _open_buckets(shared, best, families), nodes.select("node", "signature"), _prune_blocks(threshold, miss)
    )
    verified = _compared(docs, nodes, across, words, percent, differences=False).filter("linked")
    return (
        links.unionByName(inside).unionByName(verified.select(F.col("hub").alias("a"), F.col("node").alias("b")))
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that a link chain joins to an earlier one; columns unchanged.

    Of rows that agree in doc_id and text one stays.
    """
    gone = checkpointed(
        near_groups(docs, words, percent)
        .filter(~F.col("is_first"))
        .select(F.col("doc_id").alias("gone_id"), F.col("key_hash").alias("gone_hash"))
        .distinct()
    )
    name = fresh(docs, "__hash")
    hashed = docs.withColumn(name, F.xxhash64("text"))
    kept = lookup(hashed, gone, [("doc_id", "gone_id"), (name, "gone_hash")], how="left_anti")
    times = hashed.groupBy(F.col("doc_id").alias("of_id"), F.col(name).alias("of_hash")).agg(F.count(F.lit(1)).alias("n"))
    repeated = checkpointed(times.filter("n > 1").drop("n"))
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    keys = [("doc_id", "of_id"), (name, "of_hash")]
    single = lookup(kept, repeated, keys, how="left_anti")
    # Made one before the shuffle, so a row that fills half of the table costs a row per task.
    several = lookup(kept, repeated, keys, how="left_semi").dropDuplicates(["doc_id", name])
    return single.unionByName(several).select(*docs.columns)
