"""Periodic runs against a search over all periods, and on odd input."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import periodic, queries
from kpiloom.llm.periodic import SquareCatcher, find_runs, word_runs


def runs_brute(words, min_words=6, min_periods=4):
    """For each period, the maximal stretches that keep it; the smallest period of a stretch is the run's."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(min_words, min_periods * p):
                found.setdefault((start, i + p), p)
    return sorted((a, b - a, p) for (a, b), p in found.items())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(2, 5))
def test_few_words(words, periods):
    assert word_runs(words, 2, periods) == runs_brute(words, 2, periods)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=20), st.integers(1, 9), st.integers(0, 9)), max_size=6)
)
def test_powers(parts):
    words = [w for root, times, more in parts for w in (root * (times + 1))[: len(root) * times + more]]
    assert word_runs(words, 2, 2) == runs_brute(words, 2, 2)
    assert word_runs(words) == runs_brute(words)


def test_words_of_self_similar_texts():
    a, b = [0], [0, 1]
    for _ in range(10):
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(600)]
    for words in (b, thue, [0] * 300, ([0] * 16 + [1] * 16) * 5, ([0] * 31 + [1]) * 4, [0, 1] * 100 + [2] + [0, 1] * 100):
        assert word_runs(words, 2, 2) == runs_brute(words, 2, 2)


@pytest.mark.parametrize("portion", [1, 2, 7, 64])
def test_portions_make_no_difference(portion):
    rng = random.Random(portion)
    for _ in range(60):
        root = [rng.randrange(3) for _ in range(rng.randint(1, 25))]
        words = [rng.randrange(3) for _ in range(rng.randint(0, 20))] + root * rng.randint(1, 6) + root[: rng.randint(0, len(root))]
        words = np.array(words + [rng.randrange(3) for _ in range(10)])
        catcher = SquareCatcher(1)
        for at in range(0, len(words), portion):
            catcher.append(words[at : at + portion])
            # After every portion the runs are those of the words so far.
            if at % 5 == 0:
                assert catcher.runs(2) == runs_brute(words[: at + portion].tolist(), 2, 2)
        assert catcher.runs(2) == runs_brute(words.tolist(), 2, 2)


def test_long_period_over_portions():
    rng = random.Random(1)
    root = [rng.randrange(1000) for _ in range(40_001)]
    words = [-1] * 5 + root * 5 + root[:77]
    assert word_runs(words) == [(5, len(words) - 5, len(root))]


def collapsed_brute(words, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def test_odd_rows(spark):
    rows = [
        (1, "a b a b a b a b c", "x"),
        (1, "a b a b a b a b c", "x"),
        (2, None, None),
        (3, "", "y"),
        (4, " \t\n", "y"),
        (None, "z z z z z z", None),
        (5, "x\xa0y x\xa0y x\xa0y x\xa0y x\xa0y x\xa0y", "no break in words"),
        (6, "wörd " * 200_000, "long"),
        (7, "x" * 100_000, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = find_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    for r in out.collect():
        words = split(r.text)
        runs = [tuple(x) for x in r.runs]
        assert r.n_words == len(words)
        assert runs == ([(0, 200_000, 1)] if r.doc_id == 6 else runs_brute(words))
        assert r.collapsed == collapsed_brute(words, runs)
    assert find_runs(docs.limit(0)).collect() == []


def digest_brute(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return {
        "doc_id": doc_id,
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": sha("".join(f"{a},{n},{p}\n" for a, n, p in runs)),
        "collapsed_sha256": sha(collapsed_brute(words, runs)),
    }


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(i, rng.choice([None, "", " ", "a a a a a a b b b b b b b", "\n".join(["x y  z\t"] * 9)])) for i in range(300, 400)]
    rows += [(None, "a b a b a b a b"), (7, "a"), (-5, "q q q q q q q")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == list(digest_brute(0, ""))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [digest_brute(*r) for r in rows]
    assert sorted((r.asDict() for r in got.collect()), key=str) == sorted(want, key=str)
