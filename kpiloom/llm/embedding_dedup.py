"""Near-duplicates among embeddings: cross-polytope hashing after fast Hadamard rotations.

A hash turns a vector by three rounds of random signs and a Hadamard transform, in
d log d steps, and takes the corner of the cross-polytope that lies nearest: the largest
coordinate and its sign. `depth` such hashes are one code; a table holds the vectors by
their code. A vector stands in its own bucket and probes those that come next, where
another corner is little further away. `depth` follows the size of the largest group, so
that buckets stay small, and the number of tables follows from the share of pairs at the
threshold that one table finds, which is measured on drawn pairs, so that at most
MISS of them are lost.

Pairs are counted, not written out. Members of a bucket meet in blocks of BLOCK; a pair
that meets in several buckets counts in the first one only, which both of its vectors
can tell from their codes. A block pair gives sums per vector and a spanning forest of
its links. Equal vectors of a group are one vector with a weight, so copies cost nothing;
n vectors that all differ and all share a bucket cost n * n / 2 products, spread over tasks.
"""

from __future__ import annotations

import itertools
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, fresh, lookup, mapped
from kpiloom.llm.components import components

COSINE = 0.93
#: Pairs at the threshold that may be lost, and the pairs drawn to measure what one table finds.
MISS, DRAWN = 1e-4, 4000
#: Buckets that a vector probes in each table, besides its own.
PROBES = 3
#: Vectors that are compared with as many others at a time.
BLOCK = 1024
#: Vectors that are hashed at a time, and pairs whose codes are compared at a time.
_ROWS, _PAIRS = 256, 1 << 16
SEED = 20


def padded(dim: int) -> int:
    return 1 << max(dim - 1, 1).bit_length()


@cache
def signs(dim: int, tables: int, depth: int) -> np.ndarray:
    """Random signs of each table, hash and round; a table's do not depend on how many there are."""
    rows = [np.random.default_rng((SEED, dim, depth, t)).integers(0, 2, (depth, 3, dim)) for t in range(tables)]
    return np.array(rows) * 2.0 - 1.0


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the last axis, whose length is a power of two."""
    d, h = x.shape[-1], 1
    while h < d:
        y = x.reshape(*x.shape[:-1], d // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x


@cache
def steps(depth: int) -> np.ndarray:
    """Which next-best corner each hash of a code takes, for the codes worth a probe; the first takes the best."""
    return np.array([s for s in itertools.product(range(PROBES + 1), repeat=depth) if sum(s) <= PROBES], dtype=np.int64)


def codes(units: np.ndarray, tables: int, depth: int, probes: int = PROBES) -> np.ndarray:
    """Of each vector and table its own code and those it probes, by how little further their corners are."""
    n, dim = units.shape
    d = padded(dim)
    x = np.zeros((n, 1, 1, d))
    x[:, 0, 0, :dim] = units
    turn = signs(d, tables, depth)
    for r in range(3):
        x = hadamard(x * turn[None, :, :, r]) / math.sqrt(d)
    size = np.abs(x)
    top = min(probes + 1, d)
    best = np.argsort(-size, axis=-1, kind="stable")[..., :top]
    height = np.take_along_axis(size, best, -1)
    corner = 2 * best + (np.take_along_axis(x, best, -1) < 0)
    choice = steps(depth)
    choice = choice[(choice < top).all(axis=1)]
    cost, code = 0.0, np.zeros(1, dtype=np.int64)
    for k in range(depth):
        cost = cost + (height[:, :, k, :1] - height[:, :, k])[:, :, choice[:, k]] ** 2
        code = code * (2 * d) + corner[:, :, k][:, :, choice[:, k]]
    order = np.argsort(cost, axis=-1, kind="stable")[..., : probes + 1]
    return np.take_along_axis(code, order, -1)


@cache
def found_by_a_table(dim: int, depth: int, cosine: float) -> float:
    """Share of drawn pairs of this cosine that one table brings together."""
    rng = np.random.default_rng(SEED)
    x, y = rng.standard_normal((2, DRAWN, max(dim, 2)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(max(1 - cosine * cosine, 0)) * y
    a, b = codes(x, 1, depth)[:, 0], codes(y, 1, depth)[:, 0]
    met = (a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)
    return float(met.mean())


def settings_for(dim: int, largest: int, cosine: float) -> tuple[int, int]:
    """Number of tables and hashes of a code, for groups of up to `largest` vectors."""
    corners = 2 * padded(dim)
    # A code is a 64-bit number.
    depth = min(max(math.ceil(math.log(max(largest, 2)) / math.log(corners)), 1), int(62 // math.log2(corners)), 6)
    while depth > 1 and found_by_a_table(dim, depth, cosine) < 0.05:
        depth -= 1
    share = min(max(found_by_a_table(dim, depth, cosine), 1e-3), 1 - 1e-9)
    return max(math.ceil(math.log(MISS) / math.log(1 - share)), 1), depth


def unit_rows(column: pa.ListArray, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    # Scaled first, so that no square overflows.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hash(tables_of: dict[int, tuple[int, int]]):
    """Codes of vectors, table after table, the own code first."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out: list = [None] * len(dims)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), _ROWS):
                    some = rows[at : at + _ROWS]
                    units = unit_rows(batch.column("vector").take(pa.array(some)), int(dim))
                    for i, own in zip(some, codes(units, *tables_of[int(dim)]), strict=True):
                        out[i] = own.ravel()
            tables = pa.array([tables_of[int(d)][0] for d in dims], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, tables, pa.array(out, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "tables", "codes"],
            )

    return run


def _counted(own: np.ndarray, i: np.ndarray, j: np.ndarray, node: np.ndarray, table: int, code: int) -> np.ndarray:
    """Which of the pairs (i, j) count in this bucket: those whose first meeting it is."""
    keep = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), _PAIRS):
        a, b = own[i[at : at + _PAIRS]], own[j[at : at + _PAIRS]]
        to_a = (a[:, : table + 1, :1] == b[:, : table + 1]).any(axis=2)
        to_b = (b[:, : table + 1, :1] == a[:, : table + 1]).any(axis=2)
        earlier = (to_a[:, :table] | to_b[:, :table]).any(axis=1)
        # In the bucket of the first; where both probe the other's, in that of the smaller number.
        low = node[i[at : at + _PAIRS]] < node[j[at : at + _PAIRS]]
        in_a = to_a[:, table] & (low | ~to_b[:, table])
        bucket = np.where(in_a, a[:, table, 0], b[:, table, 0])
        keep[at : at + _PAIRS] = ~earlier & (to_a[:, table] | to_b[:, table]) & (bucket == code)
    return keep


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of n members."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _met(group: pa.Table, cosine: float) -> pa.RecordBatch:
    """Weight of the links of each vector of a pair of blocks, and the root of its links there."""
    dim, tables = group.column("dim")[0].as_py(), group.column("tables")[0].as_py()
    first = {c: group.column(c)[0].as_py() for c in ("table", "code", "low", "high")}
    node, weight, block = (group.column(c).to_numpy() for c in ("node", "weight", "block"))
    units = unit_rows(group.column("vector").combine_chunks(), dim)
    own = group.column("codes").combine_chunks().flatten().to_numpy().reshape(len(node), tables, -1)
    left, right = np.flatnonzero(block == first["low"]), np.flatnonzero(block == first["high"])
    i, j = np.nonzero(units[left] @ units[right].T >= cosine)
    i, j = left[i], right[j]
    if first["low"] == first["high"]:
        i, j = i[i < j], j[i < j]
    counted = _counted(own, i, j, node, first["table"], first["code"])
    i, j = i[counted], j[counted]
    links = np.zeros(len(node), dtype=np.int64)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    root = forest(len(node), i, j)
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], names=["node", "links", "root"])


def _meet(cosine: float):
    """Reads pairs of blocks one after the other, as they are sorted."""
    keys = ["kind", "table", "code", "low", "high"]

    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            values = np.stack([now.column(k).to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in itertools.pairwise(cuts):
                yield _met(now.slice(a, b - a), cosine)
            rest = now.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield _met(rest, cosine)

    return run


def comparable(vector: Column, group: Column) -> Column:
    """Whether a vector links with anything: it has a group and a direction, and all components are finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(group.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector: str = "embedding", group: str = "label"
) -> DataFrame:
    """The rows with n_links (long), component_id and kept (boolean) added.

    Rows of one group are linked if the cosine of their vectors, in doubles, is at least
    `cosine`; vectors of different lengths are not compared. n_links counts the other rows
    linked, component_id is the smallest id that links reach, and a row is kept if that is
    its own. Rows that are not `comparable` (no group, no vector, no direction, a null,
    NaN or infinite component) have no links and are their own component. Null ids are
    never the smallest; a component of null ids has the id null and keeps its rows. Rows
    that share an id are rows of their own, equal vectors are linked. An empty table gives
    an empty one. Columns with the names of the three are replaced, others stay.
    """
    vectors = vectors.drop("n_links", "component_id", "kept")
    names = vectors.columns
    fit, hash_a, hash_b, kind = (fresh(vectors, c) for c in ("__fit", "__hash_a", "__hash_b", "__kind"))
    rows = vectors.withColumn(fit, comparable(F.col(vector), F.col(group)))
    body = F.when(F.col(fit), F.col(vector))
    marked = {kind: F.xxhash64(F.col(group), F.size(body)), hash_a: F.xxhash64(F.lit(1), body), hash_b: F.xxhash64(F.lit(2), body)}
    rows = rows.withColumns({c: F.when(F.col(fit), v) for c, v in marked.items()})
    # Copies are added up before the shuffle.
    nodes = (
        rows.filter(F.col(fit))
        .groupBy(F.col(kind).alias("kind"), F.col(hash_a).alias("hash_a"), F.col(hash_b).alias("hash_b"))
        .agg(F.count(F.lit(1)).alias("weight"), F.min(id_column).alias("least_id"), F.any_value(vector).alias("vector"))
    )
    nodes = checkpointed(nodes.withColumn("dim", F.size("vector")).withColumn("node", F.monotonically_increasing_id()))
    # Of lengths of vectors there are few; per length the size of its largest group.
    sizes = nodes.groupBy("dim", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()
    tables_of = {r["dim"]: settings_for(r["dim"], r["n"], cosine) for r in sizes}
    item = nodes.schema["vector"].dataType.simpleString()
    kept = f"kind long, node long, weight long, dim int, vector {item}"
    bodies = nodes.select("kind", "node", "weight", "dim", "vector")
    hashed = checkpointed(bodies.transform(mapped, _hash(tables_of), f"{kept}, tables int, codes array<long>"))
    links = checkpointed(_linked(hashed, cosine))
    roots = components(links.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    summed = links.groupBy(F.col("node").alias("l_node")).agg(F.sum("links").alias("links"))
    told = (
        nodes.select("node", "kind", "hash_a", "hash_b", "weight", "least_id")
        .join(summed, F.col("node") == F.col("l_node"), "left")
        .join(roots.select(F.col("node").alias("r_node"), "root"), F.col("node") == F.col("r_node"), "left")
        .filter("weight > 1 OR links IS NOT NULL")
        .select(
            "kind",
            "hash_a",
            "hash_b",
            "least_id",
            F.coalesce("root", "node").alias("root"),
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("sum"),
        )
    )
    told = checkpointed(told)
    named = told.groupBy(F.col("root").alias("of")).agg(F.min("least_id").alias("named"))
    told = told.join(named, F.col("root") == F.col("of")).select("kind", "hash_a", "hash_b", "sum", "named")
    told = checkpointed(told.select(*[F.col(c).alias(fresh(rows, f"__{c}_of")) for c in told.columns]))
    t_kind, t_a, t_b, t_sum, t_named = told.columns
    met = lookup(rows, told, [(kind, t_kind), (hash_a, t_a), (hash_b, t_b)], how="left")
    own = F.col(id_column)
    component = F.when(F.col(fit), F.coalesce(F.col(t_named), own)).otherwise(own)
    return met.select(
        *names,
        F.coalesce(F.when(F.col(fit), F.col(t_sum)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )


def _linked(hashed: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root): sums and spanning forests of the links of each pair of blocks."""
    width = F.expr("size(codes) div tables")
    spots = hashed.select("kind", "node", "tables", width.alias("width"), F.posexplode("codes").alias("at", "code"))
    spots = spots.select("kind", F.expr("at div width").alias("table"), "code", (F.col("at") % F.col("width") == 0).alias("own"), "node")
    # Probes meet only those whose own bucket it is.
    buckets = (
        spots.groupBy(F.col("kind").alias("b_kind"), F.col("table").alias("b_table"), F.col("code").alias("b_code"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("home"))
        .filter("n > 1 AND home")
    )
    buckets = checkpointed(buckets.select("b_kind", "b_table", "b_code", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    members = lookup(spots, buckets, [("kind", "b_kind"), ("table", "b_table"), ("code", "b_code")])
    members = members.select("kind", "table", "code", F.col("node").alias("m_node"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    payload = hashed.select("node", "weight", "dim", "tables", "vector", "codes")
    met = members.join(payload, F.col("m_node") == F.col("node")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    pair = ["kind", "table", "code", "low", "high"]
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    met = met.select(*pair, "block", "node", "weight", "dim", "tables", "vector", "codes")
    dealt = met.repartition(*[F.col(c) for c in pair]).sortWithinPartitions(*pair)
    return dealt.transform(mapped, _meet(cosine), "node long, links long, root long")
