"""Near-duplicates among embeddings against all pairs, and on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import embedding_dedup, queries
from kpiloom.llm.embedding_dedup import codes, forest, found_by_a_table, hadamard, near_vectors, settings_for, signs

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.93):
    """All pairs of one label, then components by walking the links."""
    fit = [v is not None and g is not None and all(x is not None and np.isfinite(x) for x in v) and any(v or []) for _, v, g in rows]
    links = [set() for _ in rows]
    for i, (_, v, g) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if fit[i] and fit[j] and g == rows[j][2] and len(v) == len(w):
                x, y = (np.array(u) / np.abs(u).max() for u in (v, w))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, members = [i], {i}
        while todo:
            new = links[todo.pop()] - members
            members |= new
            todo += new
        seen |= members
        least = min((rows[m][0] for m in members if rows[m][0] is not None), default=None)
        for m in members:
            out[m] = (rows[m][0], len(links[m]), least, rows[m][0] == least)
    return sorted(out, key=str)


def found(spark, rows, **options):
    out = near_vectors(spark.createDataFrame(rows, SCHEMA), **options)
    assert out.columns[-3:] == ["n_links", "component_id", "kept"]
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)


def clusters(rng, dim, sizes, spread, first=0, label=1):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        for _ in range(size):
            v = centre + spread * rng.standard_normal(dim) * rng.random()
            rows.append((first + len(rows), v.tolist(), label))
    return rows


def test_transform():
    x = np.random.default_rng(0).standard_normal((3, 8))
    full = np.array([[1.0]])
    while len(full) < 8:
        full = np.block([[full, full], [full, -full]])
    assert np.allclose(hadamard(x), x @ full)
    assert (signs(8, 2, 1) == signs(8, 5, 1)[:2]).all()


def test_codes_start_with_their_own_and_differ():
    x = np.random.default_rng(1).standard_normal((50, 16))
    found = codes(x, 4, 2)
    assert found.shape == (50, 4, 1 + embedding_dedup.PROBES)
    assert all(len(set(row)) == len(row) for row in found.reshape(-1, found.shape[-1]).tolist())
    assert (found == codes(3 * x, 4, 2)).all()


def test_tables_follow_the_share_that_one_finds():
    for dim, largest in ((4, 10), (64, 5_000), (64, 10**6)):
        tables, depth = settings_for(dim, largest, 0.93)
        assert (1 - found_by_a_table(dim, depth, 0.93)) ** tables <= embedding_dedup.MISS * 1.0001
    assert settings_for(64, 10**6, 0.93)[1] > settings_for(64, 1_000, 0.93)[1]


def test_forest():
    assert forest(6, np.array([4, 2, 4]), np.array([5, 3, 3])).tolist() == [0, 1, 2, 2, 2, 2]


@pytest.mark.parametrize("block", [4, 1024])
def test_chains_and_groups(spark, monkeypatch, block):
    """Groups with links near the threshold, copies, and one group in many blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = clusters(rng, 12, [40, 9, 5, 2, 1, 1, 1], 0.5)
    rows += clusters(rng, 12, [10, 3], 0.6, 100, 2)
    # Multiples and copies; the same vectors under another label; a chain of small turns.
    rows += [(200 + i, [2 * x for x in rows[i][1]], 1) for i in range(5)]
    rows += [(300 + i, rows[i][1], 1) for i in range(5)] + [(400 + i, rows[i][1], 3) for i in range(5)]
    chain = [[float(np.cos(0.2 * k)), float(np.sin(0.2 * k))] + [0.0] * 10 for k in range(12)]
    rows += [(500 + k, v, 4) for k, v in enumerate(chain)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 0.5]
    rows = [
        (5, v, 1),
        (5, v, 1),
        (None, v, 1),
        (3, [2.0, 4.0, 1.0], 1),
        (7, [1e300, 2e300, 5e299], 1),
        (8, [1e-310, 2e-310, 5e-311], 1),
        (9, v, None),
        (10, None, 1),
        (11, [], 1),
        (12, [0.0, 0.0, 0.0], 1),
        (12, [-0.0, 0.0, 0.0], 1),
        (13, [1.0, None, 0.5], 1),
        (14, [float("nan"), 2.0, 0.5], 1),
        (15, [float("inf"), 2.0, 0.5], 1),
        (16, [1.0, 2.0], 1),
        (17, [1.0], 1),
        (18, [3.0], 1),
        (19, [-3.0], 1),
        (None, [0.0, 0.0, 1.0], 9),
        (None, [0.0, 0.0, 1.0], 9),
    ]
    want = brute(rows)
    # Of the component without an id the rows are kept.
    want = sorted(((a, n, c, a == c) for a, n, c, _ in want), key=str)
    assert found(spark, rows) == want
    assert found(spark, []) == []
    extra = spark.createDataFrame([(1, v, 1, "x", 2, 3)], f"{SCHEMA}, n_links string, node int, `__kind` int")
    out = near_vectors(extra)
    assert out.columns == ["vec_id", "embedding", "label", "node", "__kind", "n_links", "component_id", "kept"]
    assert out.first()[3:] == (2, 3, 0, 1, True)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_against_all_pairs(spark, sf):
    """Near copies of the given vectors, made at cosines around the threshold, are found in the share asked for."""
    folder = f"/root/testdata/{sf}"
    got = queries.QUERIES["op13_embedding_neighbours"](spark, folder).collect()
    data = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = {i: 0 for i in (r.vec_id for r in data)}
    for label in {r.label for r in data}:
        own = [r for r in data if r.label == label]
        x = np.array([r.embedding for r in own], dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for r, n in zip(own, ((x @ x.T) >= 0.93).sum(axis=1) - 1, strict=True):
            want[r.vec_id] = int(n)
    assert {r.vec_id: r.n_links for r in got} == want and len(got) == len(data)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(7)
    rows, n, cosine = [], 1500, 0.9305
    x, y = rng.standard_normal((2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(2 * i, x[i].tolist(), 1) for i in range(n)] + [(2 * i + 1, y[i].tolist(), 1) for i in range(n)]
    out = near_vectors(spark.createDataFrame(rows, SCHEMA))
    linked = out.filter("n_links = 1 AND component_id = vec_id - vec_id % 2").count()
    assert linked >= 2 * n * 0.995
    assert out.agg(F.max("n_links")).first()[0] == 1
