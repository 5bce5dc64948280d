"""Prefix trie of conversations, built as a burst trie.

A conversation is a path of turns from the textless root; conversations with the same
first turns share the nodes of these. Nodes are not linked by pointers: a node is the
128-bit hash of its path, which is the exclusive or of its turns' hashes, each taken with
its depth, so that it can be added up in parts, and a node's parent is known from it.

Paths are held in segments of SEGMENT turns, so that one very long conversation is many
rows. A container holds the suffixes that segments have below a trie head, at first below
the head of the segment. Suffixes that are the same are one, with a count. A container of
more than CONTAINER suffixes bursts: each suffix moves on to the container of its next
turn, again and again until all are small, at most SEGMENT times. Then the suffixes of each
container are sorted and swept: neighbours share the nodes up to where they differ, and
the sweep holds one path. Nodes above a burst head are swept in parts that are added up.

Totals over subtrees need no walk: the smallest member of a node stands for it. From the
depth on at which a conversation first stands for its node it stands for all that follow,
so a subtree's totals are sums over its members, and a second sweep makes them.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, lookup, mapped, ranked

#: Turns of a segment, and suffixes that a container holds before it bursts.
SEGMENT, CONTAINER = 64, 4096
#: Members that end at a node, written as one piece of text on the way to their digest.
PIECE = 4096

_KEY = ["depth", "a", "b"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn_a, turn_b, n_chars): the turns of each conversation by number, null first, then role and text.

    depth counts from 1; the hash of role and text stands for the turn. A null role or
    text is empty. Rows without conv_id belong to no conversation. Rows of one number are
    turns of their own, in the order of role and text.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    placed = ranked(rows, "place", F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"))
    hashed = checkpointed(
        placed.select(
            "conv_id",
            "place",
            F.xxhash64("role", "text").alias("turn_a"),
            F.xxhash64(F.length("text"), "text", F.lit("turn"), "role").alias("turn_b"),
            F.length("text").cast("long").alias("n_chars"),
        )
    )
    firsts = checkpointed(hashed.groupBy(F.col("conv_id").alias("of")).agg(F.min("place").alias("first")))
    met = lookup(hashed, firsts, [("conv_id", "of")])
    return met.select("conv_id", (F.col("place") - F.col("first") + 1).alias("depth"), "turn_a", "turn_b", "n_chars")


def _running(batches):
    """Totals of all rows of the partition up to each row, the row itself left out."""
    a = b = chars = 0
    for batch in batches:
        out = []
        for name, add, start in (("xor_a", np.bitwise_xor, a), ("xor_b", np.bitwise_xor, b), ("chars", np.add, chars)):
            own = batch.column(name).to_numpy()
            upto = add.accumulate(np.concatenate([np.array([start], dtype=np.int64), own]))
            out.append((pa.array(upto[:-1]), int(upto[-1])))
        (at_a, a), (at_b, b), (at_chars, chars) = out
        kept = [batch.column(c) for c in ("conv_id", "segment", "xor_a", "xor_b", "chars", "part")]
        yield pa.RecordBatch.from_arrays(
            [*kept, at_a, at_b, at_chars],
            names=["conv_id", "segment", "xor_a", "xor_b", "chars", "part", "before_a", "before_b", "before_chars"],
        )


def _before(sums: DataFrame) -> DataFrame:
    """(s_id, s_segment, head_a, head_b, head_chars): what a long conversation has before each of its segments.

    A running total over the sorted segments: each task adds up its own, the driver the
    totals of the tasks. No task holds a conversation.
    """
    long = sums.filter("segment > 0").select(F.col("conv_id").alias("long_id")).distinct()
    rows = lookup(sums, checkpointed(long), [("conv_id", "long_id")]).drop("long_id")
    kind = "conv_id long, segment long, xor_a long, xor_b long, chars long, part int"
    ordered = rows.orderBy("conv_id", "segment").withColumn("part", F.spark_partition_id())
    upto = checkpointed(ordered.transform(mapped, _running, f"{kind}, before_a long, before_b long, before_chars long"))
    totals = upto.groupBy("part").agg(F.bit_xor("xor_a").alias("a"), F.bit_xor("xor_b").alias("b"), F.sum("chars").alias("c"))
    starts, a, b, chars = [], 0, 0, 0
    for row in sorted(totals.collect(), key=lambda r: r["part"]):
        starts.append((row["part"], a, b, chars))
        a, b, chars = a ^ row["a"], b ^ row["b"], chars + row["c"]
    of_part = upto.sparkSession.createDataFrame(starts, "of_part int, part_a long, part_b long, part_chars long")
    whole = upto.join(F.broadcast(of_part), F.col("part") == F.col("of_part")).select(
        "conv_id",
        "segment",
        F.col("before_a").bitwiseXOR(F.col("part_a")).alias("all_a"),
        F.col("before_b").bitwiseXOR(F.col("part_b")).alias("all_b"),
        (F.col("before_chars") + F.col("part_chars")).alias("all_chars"),
    )
    first = whole.filter("segment = 0").select(
        F.col("conv_id").alias("of"), *[F.col(f"all_{c}").alias(f"first_{c}") for c in ("a", "b", "chars")]
    )
    return lookup(whole.filter("segment > 0"), checkpointed(first), [("conv_id", "of")]).select(
        F.col("conv_id").alias("s_id"),
        F.col("segment").alias("s_segment"),
        F.col("all_a").bitwiseXOR(F.col("first_a")).alias("head_a"),
        F.col("all_b").bitwiseXOR(F.col("first_b")).alias("head_b"),
        (F.col("all_chars") - F.col("first_chars")).alias("head_chars"),
    )


def _xor_all(items: Column, field: str) -> Column:
    return F.reduce(items, F.lit(0).cast("long"), lambda x, i: x.bitwiseXOR(i[field]))


def segments(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row per conversation and segment: its turns, and the hash and characters of the path before and after it."""
    mixed = turns.select(
        "conv_id",
        F.expr(f"(depth - 1) div {SEGMENT}").alias("segment"),
        F.struct(
            "depth",
            F.xxhash64("turn_a", "depth").alias("a"),
            F.xxhash64("turn_b", "depth").alias("b"),
            F.col("n_chars").alias("chars"),
        ).alias("item"),
    )
    # A conversation without turns has a first segment too; a list leaves nulls out.
    bare = conversations.select("conv_id", F.lit(0).cast("long").alias("segment"), F.lit(None).cast(mixed.schema["item"].dataType).alias("item"))
    rows = mixed.unionByName(bare).groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list("item")).alias("items"))
    rows = checkpointed(
        rows.withColumns(
            {
                "xor_a": _xor_all(F.col("items"), "a"),
                "xor_b": _xor_all(F.col("items"), "b"),
                "chars": F.reduce("items", F.lit(0).cast("long"), lambda x, i: x + i["chars"]),
            }
        )
    )
    before = checkpointed(_before(rows.select("conv_id", "segment", "xor_a", "xor_b", "chars")))
    met = lookup(rows, before, [("conv_id", "s_id"), ("segment", "s_segment")], how="left")
    zero = F.lit(0).cast("long")
    head_a, head_b, head_chars = (F.coalesce(c, zero) for c in ("head_a", "head_b", "head_chars"))
    return met.select(
        "conv_id",
        (F.col("segment") * SEGMENT).alias("head_depth"),
        head_a.alias("head_a"),
        head_b.alias("head_b"),
        head_chars.alias("head_chars"),
        (F.col("segment") * SEGMENT + F.size("items")).alias("end_depth"),
        head_a.bitwiseXOR(F.col("xor_a")).alias("end_a"),
        head_b.bitwiseXOR(F.col("xor_b")).alias("end_b"),
        (head_chars + F.col("chars")).alias("end_chars"),
        F.transform("items", lambda i: F.struct(i["a"].alias("a"), i["b"].alias("b"))).alias("suffix"),
        F.transform("items", lambda i: i["chars"]).alias("sizes"),
    )


_PATH = ["head_depth", "head_a", "head_b", "end_depth", "end_a", "end_b"]


def contained(rows: DataFrame) -> DataFrame:
    """The distinct suffixes, each with its members' number and the container it lies in after all bursts."""
    held = checkpointed(
        rows.groupBy(*_PATH)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("least"),
            *[F.any_value(c).alias(c) for c in ("head_chars", "suffix", "sizes")],
        )
        .withColumns({"at": F.lit(0), "in_a": F.col("head_a"), "in_b": F.col("head_b")})
    )
    while True:
        place = ["head_depth", "at", "in_a", "in_b"]
        large = held.groupBy(*[F.col(c).alias(f"l_{c}") for c in place]).agg(F.count(F.lit(1)).alias("held"))
        large = checkpointed(large.filter(F.col("held") > CONTAINER).drop("held"))
        if large.isEmpty():
            return held
        met = lookup(held, large, [(c, f"l_{c}") for c in place], how="left")
        # A suffix that ends at the head stays there, alone.
        moves = F.col("l_at").isNotNull() & (F.size("suffix") > F.col("at"))
        turn = F.get("suffix", F.col("at"))
        held = checkpointed(
            met.withColumns(
                {
                    "in_a": F.when(moves, F.col("in_a").bitwiseXOR(turn["a"])).otherwise(F.col("in_a")),
                    "in_b": F.when(moves, F.col("in_b").bitwiseXOR(turn["b"])).otherwise(F.col("in_b")),
                    "at": F.when(moves, F.col("at") + 1).otherwise(F.col("at")),
                }
            ).drop(*[f"l_{c}" for c in place])
        )


class _Members:
    """First sweep: how many members a node has, the smallest, and what is known of its path."""

    fields = (("n", pa.int64()), ("least", pa.int64()), ("parent_a", pa.int64()), ("parent_b", pa.int64()), ("n_chars", pa.int64()), ("chars", pa.int64()))
    reads = ("n", "least")

    def open(self, parent: tuple[int, int], n_chars: int, chars: int) -> list:
        return [0, None, *parent, n_chars, chars]

    def add(self, node: list, depth: int, n: int, least: int) -> None:
        node[0] += n
        node[1] = least if node[1] is None else min(node[1], least)


class _Totals:
    """Second sweep: leaves and repeated characters of a node's subtree."""

    fields = (("n_leaves", pa.int64()), ("saved", pa.int64()))
    reads = ("far", "far_chars", "near_depth", "near_chars", "leaves")

    def open(self, parent: tuple[int, int], n_chars: int, chars: int) -> list:
        return [0, 0, chars - n_chars]

    def add(self, node: list, depth: int, far: int, far_chars: int, near_depth: int | None, near_chars: int | None, leaves: int) -> None:
        node[0] += leaves
        node[1] += far_chars - far * node[2]
        if near_depth is not None and near_depth > depth:
            node[1] += near_chars - node[2]


def _sweep(kind):
    """Walks sorted suffixes and closes each node when the path has left it."""
    sweep = kind()

    def run(batches):
        place, path, stack = None, [], []
        for batch in batches:
            closed: list[tuple] = []
            fixed = ("head_depth", "at", "in_a", "in_b", "head_a", "head_b", "head_chars")
            columns = [batch.column(c).to_pylist() for c in fixed]
            lists = [batch.column("suffix").to_pylist(), batch.column("sizes").to_pylist()]
            values = [batch.column(c).to_pylist() for c in sweep.reads]
            for row in zip(zip(*columns, strict=True), zip(*lists, strict=True), zip(*values, strict=True), strict=True):
                (depth, at, in_a, in_b, a, b, chars), (suffix, sizes), value = row
                turns = [(t["a"], t["b"]) for t in suffix]
                shared = 0
                if place == (depth, at, in_a, in_b):
                    while shared < min(len(turns), len(path)) and turns[shared] == path[shared]:
                        shared += 1
                    # The root, in the stack of the first segment, has no turn.
                    keep = shared + (depth == 0)
                else:
                    keep = 0
                closed += stack[keep:][::-1]
                del stack[keep:]
                place, path = (depth, at, in_a, in_b), turns
                if depth == 0 and not stack:
                    stack.append((0, 0, 0, sweep.open((0, 0), 0, 0)))
                if stack and shared:
                    a, b = stack[-1][1:3]
                    chars += sum(sizes[:shared])
                for k in range(shared, len(turns)):
                    parent, (a, b) = (a, b), (a ^ turns[k][0], b ^ turns[k][1])
                    chars += sizes[k]
                    stack.append((depth + k + 1, a, b, sweep.open(parent, sizes[k], chars)))
                for node in stack:
                    sweep.add(node[3], node[0], *value)
            if closed:
                yield _nodes(sweep, closed)
        if stack:
            yield _nodes(sweep, stack)

    return run


def _nodes(sweep, nodes: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array([n[0] for n in nodes], pa.int64()), *(pa.array([n[k] for n in nodes], pa.int64()) for k in (1, 2))]
    arrays += [pa.array([n[3][k] for n in nodes], kind) for k, (_, kind) in enumerate(sweep.fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[*_KEY, *(name for name, _ in sweep.fields)])


def swept(held: DataFrame, kind) -> DataFrame:
    """Parts of nodes, from the containers of `held`."""
    place = ["head_depth", "at", "in_a", "in_b"]
    rows = held.select(*place, "head_a", "head_b", "head_chars", "suffix", "sizes", *kind.reads)
    rows = rows.repartition(*[F.col(c) for c in place]).sortWithinPartitions(*place, "suffix")
    schema = ", ".join(f"{c} long" for c in [*_KEY, *(name for name, _ in kind.fields)])
    return rows.transform(mapped, _sweep(kind), schema)


def _pieces(batches):
    """Members of a node that follow each other, as text of bounded length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _KEY])
        ids = batch.column("conv_id").to_numpy()
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
        starts = [i for a, b in itertools.pairwise(cuts) for i in range(a, b, PIECE)]
        ends = [*starts[1:], len(ids)]
        at = np.array(starts, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(k[at]) for k in keys),
                pa.array(ids[at]),
                pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends, strict=True)], pa.string()),
            ],
            names=[*_KEY, "first", "piece"],
        )


def _digests(batches):
    """SHA-256 of each node's pieces, joined by commas, read in order."""
    key, digest = None, None

    def done(keys: list, digests: list) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in keys], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], names=["e_depth", "e_a", "e_b", "ends_sha256"])

    for batch in batches:
        keys, digests = [], []
        for *now, piece in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "piece")), strict=True):
            if now == key:
                digest.update(b",")
            else:
                if key:
                    keys.append(key)
                    digests.append(digest.hexdigest())
                key, digest = now, hashlib.sha256()
            digest.update(piece.encode())
        if keys:
            yield done(keys, digests)
    if key:
        yield done([key], [digest.hexdigest()])


def end_digests(ends: DataFrame) -> DataFrame:
    """(e_depth, e_a, e_b, ends_sha256) of each node where conversations end.

    Members are sorted and turned to text by many tasks; only the digest, which has to
    read them in order, is one task's for each node, and holds one piece at a time.
    """
    ordered = ends.select(*_KEY, "conv_id").orderBy(*_KEY, "conv_id")
    pieces = ordered.transform(mapped, _pieces, "depth long, a long, b long, first long, piece string")
    dealt = checkpointed(pieces).repartition(*[F.col(c) for c in _KEY]).sortWithinPartitions(*_KEY, "first")
    return dealt.transform(mapped, _digests, "e_depth long, e_a long, e_b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie of all conversations.

    `turns` is as from `numbered_turns`; each depth from 1 up to a conversation's length
    has one row. `conversations` adds the ids of conversations without turns. A row is a
    node: conv_id (smallest member), depth, parent_conv_id (smallest member of the parent,
    null for the root), n_convs, n_children, n_leaves, saved_tokens (over the subtree, for
    each node its members but one times the characters of its last turn) and ends_sha256
    of the ids that end there, ascending, joined by commas. No conversations, no nodes.
    """
    listed = turns.select("conv_id").distinct()
    if conversations is not None:
        listed = listed.union(conversations.filter(F.col("conv_id").isNotNull()).select("conv_id")).distinct()
    rows = checkpointed(segments(turns, listed))
    held = contained(rows)
    nodes = swept(held, _Members).groupBy(*_KEY).agg(
        F.sum("n").alias("n_convs"),
        F.min("least").alias("conv_id"),
        *[F.any_value(c).alias(c) for c in ("parent_a", "parent_b", "n_chars", "chars")],
    )
    nodes = checkpointed(nodes)
    below = nodes.filter("depth > 0")
    kids = checkpointed(
        below.groupBy((F.col("depth") - 1).alias("k_depth"), F.col("parent_a").alias("k_a"), F.col("parent_b").alias("k_b")).agg(
            F.count(F.lit(1)).alias("n_children")
        )
    )
    with_kids = lookup(nodes, kids, [("depth", "k_depth"), ("a", "k_a"), ("b", "k_b")], how="left")
    with_kids = checkpointed(with_kids.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).drop("k_depth", "k_a", "k_b"))

    # From which depth on a conversation stands for its nodes, and the characters before that.
    stands = with_kids.groupBy(F.col("conv_id").alias("r_id")).agg(
        F.min(F.struct("depth", (F.col("chars") - F.col("n_chars")).alias("chars"))).alias("from"),
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    last = rows.groupBy("conv_id").agg(
        F.max(F.struct("end_depth", "head_depth", "end_a", "end_b", "end_chars")).alias("last")
    )
    ends = checkpointed(last.join(stands, F.col("conv_id") == F.col("r_id"), "left").select(
        F.col("conv_id").alias("p_id"),
        F.coalesce(F.col("from.depth"), F.col("last.end_depth") + 1).alias("from_depth"),
        F.coalesce(F.col("from.chars"), F.col("last.end_chars")).alias("from_chars"),
        F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"),
        F.col("last.end_depth").alias("depth"),
        F.col("last.end_a").alias("a"),
        F.col("last.end_b").alias("b"),
    ))
    facts = ends.select("p_id", "from_depth", "from_chars", "leaf")
    known = lookup(rows.select("conv_id", *_PATH), facts, [("conv_id", "p_id")])
    near = F.col("from_depth") <= F.col("end_depth")
    zero = F.lit(0).cast("long")
    told = checkpointed(
        known.groupBy(*[F.col(c).alias(f"t_{c}") for c in _PATH]).agg(
            F.sum(F.when(near, zero).otherwise(1)).alias("far"),
            F.sum(F.when(near, zero).otherwise(F.col("from_chars"))).alias("far_chars"),
            # Of equal suffixes only the smallest member can stand for a node.
            F.max(F.when(near, F.col("from_depth"))).alias("near_depth"),
            F.max(F.when(near, F.col("from_chars"))).alias("near_chars"),
            F.sum("leaf").alias("leaves"),
        )
    )
    both = lookup(held, told, [(c, f"t_{c}") for c in _PATH])
    totals = swept(both, _Totals).groupBy(*[F.col(c).alias(f"s_{c}") for c in _KEY]).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    digests = checkpointed(end_digests(ends.withColumnRenamed("p_id", "conv_id")))
    parents = with_kids.select(
        (F.col("depth") + 1).alias("u_depth"), F.col("a").alias("u_a"), F.col("b").alias("u_b"), F.col("conv_id").alias("parent_conv_id")
    )
    out = lookup(with_kids, checkpointed(totals), [(c, f"s_{c}") for c in _KEY])
    out = lookup(out, parents, [("depth", "u_depth"), ("parent_a", "u_a"), ("parent_b", "u_b")], how="left")
    out = lookup(out, digests, [(c, f"e_{c}") for c in _KEY], how="left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
