"""Mixing, sharding, licences and exact dedup against brute force and on odd input."""

import hashlib
import json
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.llm import exact_dedup, licenses, mixing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, s, None) for *r, s in rows], DOCS)


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, a clashing column."""
    rows = [
        (1, "a b c", "x"),
        (1, "a b c", "x"),
        (2, None, "x"),
        (3, "", None),
        (4, " \t\n", "y"),
        (None, "a b c", "y"),
        (None, None, None),
        (5, "wörd " * 40_000, "z"),
        (6, "a  b\nc", "z"),
    ]
    return frame(spark, rows).withColumn("size", F.lit("taken"))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def fill(sizes, weights, cap):
    """Shares by weight, capped, the excess shared again."""
    target, open_, left = {}, dict(enumerate(sizes)), sum(sizes)
    while True:
        total = sum(weights[i] for i in open_)
        over = [i for i, s in open_.items() if left * weights[i] > cap * s * total]
        if not over:
            break
        for i in over:
            target[i] = float(cap * open_.pop(i))
            left -= target[i]
    for i in open_:
        target[i] = left * weights[i] / total
    return target


@pytest.mark.parametrize("sizes", [[5, 100, 7, 3000, 12, 1], [0, 10], [1, 1, 1, 1000], [4]])
def test_targets(spark, sizes):
    rows = [(i, "w " * n, f"s{i:02}") for i, n in enumerate(sizes)]
    found = {r["mix_source"]: r["target"] for r in mixing.source_targets(frame(spark, rows)).collect()}
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    assert found == pytest.approx({f"s{i:02}": t for i, t in want.items()})


def test_mix(spark, odd, empty):
    plan = mixing.plan_mix(odd.drop("size"))
    assert plan.count() == 9
    assert all(r["copies"] <= 3 for r in plan.collect())
    assert {r["source"] for r in plan.filter("target > 0").collect()} <= {None, "x", "y", "z"}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    planned = {(r["doc_id"], r["source"], r["text"]): r["copies"] for r in plan.collect()}
    drawn = {}
    for r in mixed.collect():
        key = (r["doc_id"], r["source"], r["text"])
        drawn[key] = drawn.get(key, 0) + 1
        assert r["size"] == "taken"
    repeated = {(1, "x", "a b c"): 2}
    assert drawn == {k: n * repeated.get(k, 1) for k, n in planned.items() if n}
    assert mixing.mix(empty).count() == 0 and mixing.plan_mix(empty).count() == 0


def test_mix_is_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(6000)]
    plan = mixing.plan_mix(frame(spark, rows))
    sums = plan.groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.05 * r["target"] for r in sums)


@pytest.mark.parametrize(("sf", "most"), [("sf0.01", 0.1), ("sf0.1", 0.03)])
def test_sources_with_few_documents_are_near_their_targets(spark, sf, most):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "source")
    plan = mixing.plan_mix(docs)
    sums = plan.groupBy("source", "target", "source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert len(sums) >= 10
    assert all(abs(r["taken"] - r["target"]) <= most * r["target"] for r in sums)
    assert plan.agg(F.max("copies")).first()[0] <= 3


def ring_brute(keys, places, capacity, cell_bits):
    """Walks every key round by round to the first place clockwise that is not full."""
    spots = [c for c, _ in places]
    waiting = {}
    for key, cell in sorted(keys.items(), key=lambda x: x[1]):
        at = next((i for i, s in enumerate(spots) if s >= cell), 0)
        waiting.setdefault(at, []).append(key)
    used, shard_of = [0] * len(capacity), {}
    while waiting:
        passed = {}
        for at in sorted(waiting):
            shard = places[at][1]
            for key in waiting[at]:
                if used[shard] < capacity[shard]:
                    used[shard] += 1
                    shard_of[key] = shard
                else:
                    passed.setdefault(at, []).append(key)
        waiting = {}
        for at, left in passed.items():
            to = (at + 1) % len(places)
            while used[places[to][1]] >= capacity[places[to][1]]:
                to = (to + 1) % len(places)
            waiting.setdefault(to, []).extend(left)
    return used


@given(st.dictionaries(st.integers(0, 63), st.integers(0, 9), max_size=40), st.integers(1, 7))
@settings(max_examples=60, deadline=None)
def test_segments(counts, shards):
    places = sharding.ring_places(shards, 3, 6)
    capacity = sharding.capacities(sum(counts.values()), shards, 1.0)
    segments = sharding.ring_segments(counts, places, capacity)
    seen, slots = {}, {}
    for cell, first, last, shard, slot in segments:
        for rank in range(first, last + 1):
            assert (cell, rank) not in seen
            seen[cell, rank] = shard
            slots.setdefault(shard, []).append(slot + rank - first)
    assert sorted(seen) == sorted((c, i) for c, n in counts.items() for i in range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    keys = {(c, i): c for c, n in counts.items() for i in range(n)}
    assert ring_brute(keys, places, capacity, 6) == [len(slots.get(s, [])) for s in range(shards)]


def test_shards(spark, odd, empty):
    placed = sharding.assign_shards(odd, shards=4, vnodes=8).collect()
    assert len(placed) == 9
    counts = [sum(r["shard"] == s for r in placed) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(counts[s])) for s in range(4))
    assert {r["size"] for r in placed if r["doc_id"] in (2, 3)} == {8}
    assert sharding.assign_shards(empty).count() == 0


def test_one_hot_key_is_dealt_evenly(spark):
    rows = [(7 if i % 3 else i, "t", "s") for i in range(900)]
    counts = sharding.assign_shards(frame(spark, rows), shards=8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in counts) == [112] * 4 + [113] * 4


def test_loose_loads_move_few_keys(spark):
    docs = frame(spark, [(i, "t", "s") for i in range(3000)])
    old = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs, shards=10, load=1.3).collect()}
    new = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs, shards=11, load=1.3).collect()}
    assert sum(old[k] != new[k] for k in old) < 0.35 * len(old)


def test_licenses(spark, odd, empty):
    mit = licenses.TEMPLATES["MIT"][3]
    wrapped = mit.replace(", ", ",\n", 4)
    three = mit.replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    apache = licenses.TEMPLATES["Apache-2.0"][3].replace("License at ", "License at\n\n    ").replace("2.0 Unl", "2.0\n\nUnl")
    rows = [
        (1, "Prose.\nReleased under the MIT License.\nMore prose", "s"),
        (2, f"Head\n\n{wrapped}\n\nTail", "s"),
        (3, "Released under the MIT", "s"),
        (4, "released   UNDER the mit license", "s"),
        (5, "nothing of the kind stands here", "s"),
        (6, f"A library for text, with a long description of what it does.\n\n{three}\n\nHave fun with it all.", "s"),
        (7, "Released under the MIT License. See the LICENSE file for details.", "s"),
        (8, f"{'Some code stands here and there. ' * 40}\n{apache}\n{'Other code comes after it. ' * 40}", "s"),
    ]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert found[1]["first_piece"] == found[1]["last_piece"] == 1 and found[1]["dice"] == 1.0
    assert (found[1]["first_word"], found[1]["n_words"]) == (1, 5)
    assert {k: (r["license_id"], r["template"]) for k, r in found.items()} == {
        1: ("MIT", 0),
        2: ("MIT", 3),
        3: ("MIT", 0),
        4: ("MIT", 0),
        6: ("MIT", 3),
        7: ("MIT", 0),
        8: ("Apache-2.0", 3),
    }
    assert found[2]["dice"] == found[6]["dice"] == found[7]["dice"] == found[8]["dice"] == 1.0
    assert found[3]["dice"] == pytest.approx(6 / 7)
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(empty).count() == 0
    own = {"X": ["a b c"], "Y": ["a b c"]}
    assert [(r["doc_id"], r["license_id"]) for r in licenses.scan_licenses(odd, own).collect()].count((1, "X")) == 2
    with pytest.raises(ValueError):
        licenses.template_rows({"X": [" ".join(map(str, range(100_002)))]})


def test_whole_notices_keep_their_ids(spark):
    rows = [(i, f"Intro of a file.\n\n{texts[-1]}\n\nThe code.", "s") for i, texts in enumerate(licenses.TEMPLATES.values())]
    found = {}
    for r in licenses.scan_licenses(frame(spark, rows)).collect():
        found.setdefault(r["doc_id"], {})[r["dice"]] = r["license_id"]
    assert [found[i][1.0] for i in range(len(rows))] == list(licenses.TEMPLATES)


def licenses_brute(text, templates, threshold, edges):
    """Every run of pieces against every template; the best run of each piece. With `edges`, as the ends of runs ask."""
    pieces = [w for p in re.sub(r"([.!?])[ \t\r]+", "\\1\n", text or "").split("\n") if (w := re.findall("[0-9a-z]+", p.lower()))]
    first = [sum(map(len, pieces[:i])) for i in range(len(pieces) + 1)]
    flat, best = sum(pieces, []), {}

    def close(i, own):
        start = max(first[i] - 1, 0)
        n = sum(pair in own for pair in zip(flat[start : first[i + 1]], flat[start + 1 : first[i + 1] + 1], strict=False))
        return not edges or n >= len(pieces[i]) * threshold / 2

    for a in range(len(pieces)):
        for b in range(a, len(pieces)):
            words = sum(pieces[a : b + 1], [])
            grams = Counter(zip(words, words[1:], strict=False))
            for name, texts in templates.items():
                for number, template in enumerate(texts):
                    own = Counter(zip(template.split(), template.split()[1:], strict=False))
                    dice = 2.0 * (grams & own).total() / max(grams.total() + own.total(), 1)
                    if dice >= threshold and close(a, own) and close(b, own):
                        run = (-dice, first[a], first[b + 1] - 1, name, number, a, b)
                        for i in range(a, b + 1):
                            best[i] = min(best.get(i, run), run)
    return sorted({(r[5], r[6], r[1], r[2] - r[1] + 1, r[3], r[4], -r[0]) for r in best.values()})


def test_licenses_against_every_run(spark):
    templates = {"X": ["a b c d", "a b a b a c"], "Y": ["b c d a", "c d c d a b c d a a"]}
    draw = random.Random(5)
    marks = [" ", " ", " ", " ", "\n", ". ", "\n\n", "; "]
    texts = ["".join(draw.choice("abcde") + draw.choice(marks) for _ in range(draw.randint(0, 40))) for _ in range(120)]
    texts += ["a b. c d\n" * 30, "a\nb\nc\nd\n" * 12, None, "a"]
    found = {}
    for r in licenses.scan_licenses(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), templates, 0.8).collect():
        found.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, text in enumerate(texts):
        assert sorted(found.get(i, [])) == licenses_brute(text, templates, 0.8, True), text
        # What no other run that overlaps it beats is found whatever its ends are.
        every = licenses_brute(text, templates, 0.8, False)
        top = {w for w in every if not any(v[-1] >= w[-1] and v != w and v[0] <= w[1] and w[0] <= v[1] for v in every)}
        assert top <= set(found.get(i, [])), text


def test_neighbours_have_their_own_id(spark):
    lines = {
        "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
        "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
        "CC-BY-NC-SA-4.0": "This work is licensed under CC BY-NC-SA 4.0.",
        "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    }
    rows = [(i, text, "s") for i, text in enumerate(lines.values())]
    found = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert found == dict(enumerate(lines))


def test_license_values_are_sql(spark):
    assert licenses.template_values({"X": ["it is"]}) == "('X', 0, 1, 'it is', 1)"
    assert json.dumps(licenses.TEMPLATES)


def groups_brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault("".join((text or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})), []).append(i)
    want = []
    for body, members in groups.items():
        order = sorted(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            sha = hashlib.sha256(body.encode()).hexdigest()
            want.append((rows[i][0], rows[order[0]][0], len(members), sha))
    return sorted(want, key=str)


TEXTS = st.sampled_from(["", "a", "b", " a", "a \n", "ab", "a b", "\x0b", "é", "é é", None, "x" * 150_000, "x" * 149_999 + "y"])


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), TEXTS), max_size=12))
@settings(max_examples=2, deadline=None)
def test_exact_groups(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Weak hashes collide, so that the comparison of the texts decides.
    for moduli in (exact_dedup.MODULI, ((3, 2), (3, 2))):
        found = exact_dedup.exact_groups(docs, moduli).collect()
        got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str)
        assert got == groups_brute(rows)
        kept = [r["text_sha256"] for r in found if r["kept"]]
        assert sorted(kept) == sorted({r["text_sha256"] for r in found})


def test_chunk_hashes_compose():
    hashes = exact_dedup.ChunkHash()
    data = bytes(range(256)) * 300
    left, right = hashes.of(data[:50_000]), hashes.of(data[50_000:])
    whole = hashes.join(left, right, len(data) - 50_000)
    parts = [data[i : i + 1000] for i in range(0, len(data), 1000)]
    done = (0, 0)
    for part in parts:
        done = hashes.join(done, hashes.of(part), len(part))
    assert whole == done
    assert hashes.of(b"\0") != hashes.of(b"\0\0")
