"""The prefix trie against one made of Python dicts, and on odd input."""

import hashlib
import random
import zlib

import pytest

from kpiloom.llm import conversation_trie, queries
from kpiloom.llm.conversation_trie import contained, numbered_turns, prefix_trie, segments

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths_of(rows):
    paths = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            paths.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in paths.items()}


def trie_brute(paths):
    nodes = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(conv)
    kids = {}
    for node in nodes:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for node, members in nodes.items():
        cost = (len(members) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += cost
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        out.append(
            (min(members), len(node), parent, len(members), len(kids.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def made(rng, n, turns, words, longest=8):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"][:turns]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 2)))))
    return rows


@pytest.mark.parametrize(("segment", "container"), [(64, 4096), (3, 2), (1, 1), (2, 5)])
def test_segments_and_bursts(spark, monkeypatch, segment, container):
    """Small segments and containers, so that paths cross many and most containers burst."""
    monkeypatch.setattr(conversation_trie, "SEGMENT", segment)
    monkeypatch.setattr(conversation_trie, "CONTAINER", container)
    monkeypatch.setattr(conversation_trie, "PIECE", 3)
    rng = random.Random(segment)
    rows = made(rng, 60, 2, ["a", "b"])
    rows += [(100 + c, t, "user", "a" * (t + 1)) for c in range(12) for t in range(7)]
    rows += [(200, t, "user", "long") for t in range(40)] + [(201, t, "user", "long") for t in range(39)]
    rng.shuffle(rows)
    turns = numbered_turns(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(prefix_trie(turns)) == trie_brute(paths_of(rows))
    listed = turns.select("conv_id").distinct()
    held = contained(segments(turns, listed)).groupBy("head_depth", "at", "in_a", "in_b").count()
    assert held.agg({"count": "max"}).first()[0] <= max(container, 1)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "x"),
        (1, 0, "user", "x"),
        (1, None, None, None),
        (2, None, "", ""),
        (2, 5, "user", "x"),
        (2, 5, "assistant", "x"),
        (None, 0, "user", "x"),
        (None, None, None, None),
        (-3, 1, "us", "erx"),
        (-4, 1, "user", "x"),
        (7, 0, "user", "é" * 300_000),
        (8, 0, "user", "é" * 300_000),
    ]
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, depth string, place int")
    paths = paths_of(rows)
    assert rows_of(prefix_trie(numbered_turns(wide))) == trie_brute(paths)
    # Conversations without turns end at the root.
    more = spark.createDataFrame([(50,), (1,), (None,), (51,)], "conv_id long")
    assert rows_of(prefix_trie(numbered_turns(wide), more)) == trie_brute(paths | {50: [], 51: []})
    nothing = numbered_turns(wide.limit(0))
    assert prefix_trie(nothing).collect() == []
    assert rows_of(prefix_trie(nothing, more)) == trie_brute({1: [], 50: [], 51: []})


def rebuilt_brute(rows):
    paths = paths_of(rows)
    out = {}
    for c, path in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = paths.get(base, [])[:h] + path[h:]
    return out


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = made(rng, 230, 2, ["a", "b", "cc"], 7) + [(1000 + c, 0, "user", "a") for c in range(1, 20)]
    rows += [(-5, 1, "user", "a"), (-105, None, None, "b"), (300, 1, "u", None), (None, 1, "u", "x")]
    rows += [(301, t, "user", str(t)) for t in range(200)] + [(302, t, "user", str(t)) for t in range(150)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op12_conversation_trie"](spark, str(tmp_path))
    assert [t for _, t in got.dtypes[:-1]] == ["bigint"] * 7
    assert rows_of(got) == trie_brute(rebuilt_brute(rows))


def test_query_over_a_table(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = trie_brute(rebuilt_brute([tuple(r) for r in data.collect()]))
    assert rows_of(queries.QUERIES["op12_conversation_trie"](spark, "/root/testdata/sf0.01")) == want
