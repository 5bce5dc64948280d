"""Line dedup, near-dedup, fingerprints, BPE, toxicity and WARC against brute force and on odd input."""

import hashlib
import random
import tracemalloc
from collections import defaultdict
from itertools import islice

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpiloom.llm import bpe, fingerprints, line_dedup, near_dedup, toxicity, warc
from kpiloom.llm.components import components
from kpiloom.session import work_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (1, "a b c"),
    (1, "a b c"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (None, "a b c"),
    (None, None),
    (5, "wörd " * 30_000),
    (6, "x" * 5_000),
    (7, "a<|endoftext|>b  c\n\n d ͸ՠ\U000323b0 é"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


# --- line dedup ---


def lines_brute(rows, min_words):
    """Deletes a line if it lies in a run that also stands at an earlier place; compares all places."""
    docs = []
    for doc_id, text in rows:
        lines = line_dedup.cut_lines(text or "")
        worded = [i for i, x in enumerate(lines) if x.split()]
        docs.append((doc_id, lines, worded, [tuple(lines[i].split()) for i in worded]))
    out = []
    for n, (doc_id, lines, worded, own) in enumerate(docs):
        gone = set()
        for m in range(n + 1):
            other = docs[m][3]
            for p in range(len(own)):
                for q in range(len(other) if m < n else p):
                    size = 0
                    while p + size < len(own) and q + size < len(other) and own[p + size] == other[q + size]:
                        size += 1
                    if size and sum(map(len, own[p : p + size])) >= min_words:
                        gone.update(range(worded[p], worded[p + size - 1] + 1))
        out.append((doc_id, "".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return out


@given(st.lists(st.lists(st.sampled_from(["a b", "c", "d e f", "", "g. h", "i"]), max_size=9), max_size=6))
@settings(max_examples=5, deadline=None)
def test_lines(spark, drawn):
    rows = [(i, "\n".join(x)) for i, x in enumerate(drawn)]
    found = sorted((r["doc_id"], r["text"], r["dropped_lines"]) for r in line_dedup.dedup_lines(frame(spark, rows), 5).collect())
    assert found == lines_brute(rows, 5)


def test_passage_inside_a_line_and_odd_rows(spark):
    rng = random.Random(1)
    passage = ". ".join(prose(rng, 12).capitalize() for _ in range(5)) + "."
    rows = [(1, f"Own start. {passage}\nMore"), (2, f"Another line. {passage} And on"), (3, prose(rng, 60))]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert found[1]["text"] == rows[0][1] and found[3]["text"] == rows[2][1]
    assert found[2]["text"] == "Another line. And on" and found[2]["dropped_words"] == 60
    odd = frame(spark, ODD).withColumn("__hash", F.lit(1)).withColumn("dropped_lines", F.lit(9))
    out = line_dedup.dedup_lines(odd)
    assert out.columns == ["doc_id", "text", "__hash", "dropped_lines", "dropped_words"]
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, frame(spark, ODD).collect()))
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def words_brute(rows, min_words):
    """Marks every word of a run of `min_words` words that also stands at an earlier place; compares all places."""
    docs = [(text or "").split() for _, text in rows]
    out = []
    for n, own in enumerate(docs):
        gone = set()
        for m in range(n + 1):
            other = docs[m]
            for p in range(len(own)):
                for q in range(len(other) if m < n else p):
                    size = 0
                    while p + size < len(own) and q + size < len(other) and own[p + size] == other[q + size]:
                        size += 1
                    if size >= min_words:
                        gone.update(range(p, p + size))
        out.append([w for i, w in enumerate(own) if i not in gone])
    return out


def test_passages_cut_anywhere(spark):
    """Copies that start and end inside lines and sentences, in texts with and without sentence ends."""
    rng = random.Random(23)
    for stop in (". ", " ", ".) ", "\n", "。 "):
        passages = [stop.join(prose(rng, 9) for _ in range(6)).split(" ") for _ in range(3)]
        rows = []
        for i in range(8):
            parts = []
            for passage in rng.sample(passages, 2):
                a, b = rng.randrange(4), rng.randrange(4)
                parts += [prose(rng, 7) + stop + prose(rng, 3), " ".join(passage[a : len(passage) - b])]
            rows.append((i, " ".join([*parts, prose(rng, 4)])))
        found = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, rows), 40).collect()}
        kept = words_brute(rows, 40)
        assert [found[i]["text"].split() for i, _ in rows] == kept
        assert [found[i]["dropped_words"] for i, _ in rows] == [len(t.split()) - len(k) for (_, t), k in zip(rows, kept, strict=True)]
        assert sum(r["dropped_words"] for r in found.values()) > 300


@given(st.text(alphabet="ab .!?\n\t", max_size=40))
def test_lines_are_the_text(text):
    assert "".join(line_dedup.cut_lines(text)) == text


# --- near-dedup ---


def near_brute(rows, words, percent):
    sets = []
    for _, text in rows:
        split = (text or "").encode().lower().split()
        sets.append({tuple(split[i : i + words]) for i in range(max(1, len(split) - words + 1))} if split else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = "z" + str(rng.random())
    return " ".join(words)


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 85, 1024), (5, 80, 2)])
def test_near(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "LANE_ROWS", 3)
    rng = random.Random(words)
    rows = list(ODD)
    for family in range(6):
        base = prose(rng, 120)
        rows += [(100 * family + 50 + i, edited(rng, base, rng.randint(0, 6))) for i in range(14)]
    rng.shuffle(rows)
    docs = frame(spark, rows).withColumn("node", F.lit(3))
    found = near_dedup.near_groups(docs, words, percent)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)
    assert got == near_brute(rows, words, percent)
    kept = near_dedup.drop_near_duplicates(docs, words, percent)
    ids = {r["doc_id"] for r in kept.collect()}
    empties = {2, 3, 4, None}
    assert ids - empties == {c for _, n, c in got if n} and kept.columns == docs.columns


def test_repeated_rows_leave_one(spark):
    rng = random.Random(2)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, a)] * 5 + [(2, b), (2, b), (3, a), (4, None), (4, None), (4, ""), (None, b), (None, b)]
    found = near_dedup.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, a), (2, b), (4, None), (4, "")], key=str)


def test_near_empty(spark):
    assert near_dedup.near_groups(frame(spark, [])).count() == 0
    assert near_dedup.near_groups(frame(spark, [(1, None), (2, "")])).count() == 2


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
@settings(max_examples=2, deadline=None)
def test_components(spark, edges):
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r["node"], r["root"]) for r in found) == sorted((n, find(n)) for n in parent)


def test_posterior_bounds():
    bounds = near_dedup.least_matches(0.85, 1e-6)
    assert [n for n, _ in bounds] == [32, 64, 96, 128]
    assert all(0 < m < 0.85 * n for n, m in bounds)


# --- fingerprints ---


def test_compare_next(spark):
    rng = random.Random(3)
    words = ["the", "of", "and", "house", "tree", "river", "stone", "cloud", "é"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)] + [(41, None)]
    found = {r["doc_id"]: r for r in fingerprints.compare_next(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(found) == len(rows)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[: len(text) - n] + after[:n]
        sets = [set(fingerprints.spot_signatures(t).tolist()) for t in (text, changed, after)]
        like = [1.0 if not sets[0] | s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        r = found[doc_id]
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest() and r["n_chars"] == len(text)
        assert [r["near_edited"], r["near_next"]] == pytest.approx(like)


def test_one_common_word_does_not_stand_for_a_text():
    rng = random.Random(4)
    text = ["x" + w for w in prose(rng, 90).split()]
    whole = fingerprints.spot_signatures(" ".join([*text[:10], "de", *text[10:]]))
    edited_text = fingerprints.spot_signatures(" ".join([*text[:10], "de", *text[10:60], *("y" + w for w in text[60:])]))
    assert len(whole) > 60 and 0.3 < fingerprints.likeness(whole, edited_text) < 0.8


def test_compare_next_odd(spark):
    out = fingerprints.compare_next(frame(spark, ODD).withColumn("key", F.lit(1))).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(d) for d, _ in ODD)
    assert fingerprints.compare_next(frame(spark, [])).count() == 0
    single = fingerprints.compare_next(frame(spark, [(9, "the old house stands")])).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0


def test_similar(spark):
    rng = random.Random(5)
    words = ["the", "of", "and", "in", *[prose(rng, 1) + str(i) for i in range(300)]]
    rows = []
    for family in range(8):
        base = " ".join(rng.choice(words[:4]) if rng.random() < 0.3 else rng.choice(words) for _ in range(200))
        rows += [(10 * family + i, edited(rng, base, 4 * i)) for i in range(5)]
    asked = [r for r in rows if r[0] % 20 == 0]
    found = fingerprints.similar(frame(spark, asked), frame(spark, rows), 70).collect()
    sets = {d: set(fingerprints.spot_signatures(t).tolist()) for d, t in rows}
    want = {(q, d) for q, _ in asked for d, _ in rows if len(sets[q] & sets[d]) >= 0.7 * len(sets[q] | sets[d])}
    assert {(r["query_id"], r["doc_id"]) for r in found} == want and len(want) > len(asked)


# --- BPE ---


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 200)
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(7)
    letters = "ab \n\t'sé1²ß中  ͸ՠ\U000323b0!?<|"
    rows = ODD + [(100 + i, "".join(rng.choice(letters) for _ in range(60))) for i in range(60)]
    found = bpe.round_trip(frame(spark, rows), PATH).collect()
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[doc_id].append((ids, tokenizer.decode(ids, skip_special_tokens=False)))
    got = defaultdict(list)
    for r in found:
        got[r["doc_id"]].append((r["ids"], r["decoded"]))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["n_tokens"] == len(r["ids"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert bpe.round_trip(frame(spark, []), PATH).count() == 0


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(65_000, 66_000), st.integers(0, 2**32 - 1))))
@settings(max_examples=100, deadline=None)
def test_packed_codes(numbers):
    codes = np.array(numbers, dtype=np.uint32)
    assert bpe._unpack_codes(bpe._pack_codes(codes)).tolist() == numbers


def test_decode(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(1, [40, 50256, 13]), (1, [40, 50256, 13]), (2, []), (None, None), (3, [250, 250])]
    encoded = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = sorted(((r["doc_id"], r["text"]) for r in bpe.decode(encoded, PATH).collect()), key=str)
    want = [(d, None if i is None else tokenizer.decode(i, skip_special_tokens=False)) for d, i in rows]
    assert found == sorted(want, key=str)


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_a_closed_chunk_is_not_copied():
    """Counts and buckets of 1,000,000 words, 100,000 of them distinct, took 15 MB on top of the chunk, now 5."""
    chunk, words = bpe._Chunk(0), [f" w{i}" for i in range(100_000)]
    rng = np.random.default_rng(1)
    for i in range(200):
        chunk.add(i, [words[k] for k in rng.integers(0, len(words), 5000)], 1)
    distinct = len(chunk.codes)
    tracemalloc.start()
    try:
        listed = sum(len(bpe._unpack_words(row["words"])) for row in islice(chunk.rows(), bpe.BUCKETS))
        assert listed == distinct and tracemalloc.get_traced_memory()[1] < 9e6
    finally:
        tracemalloc.stop()


def test_joining_back_holds_no_object_per_word():
    """100,000 words and 200 documents of 5,000 in one row took 32 MB to get ready and a batch of 19 MB, now 5 and 4."""
    words, rng = [f" w{i}" for i in range(100_000)], np.random.default_rng(1)
    definition = bpe.read_tokenizer(PATH)
    tokenizer, _ = bpe._loaded(definition)
    ids = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    pieces = bpe.piece_strings(definition)
    picks = [rng.integers(0, len(words), 5000).astype(np.uint32) for _ in range(200)]
    sizes, codes = bpe._pack(np.array([len(p) for p in picks])), bpe._pack_codes(np.concatenate(picks))
    part = np.arange(len(words)), np.array([len(x) for x in ids], np.uint32), np.array([i for x in ids for i in x], np.uint32)
    held, found = bpe._Dictionary(), []
    tracemalloc.start()
    try:
        held.parts.append(part)
        held.ready()
        assert tracemalloc.get_traced_memory()[1] < 9e6
    finally:
        tracemalloc.stop()
    for batch in bpe._documents(held, {"doc_ids": list(range(200)), "sizes": sizes, "codes": codes}, pieces, True):
        assert batch.nbytes < bpe.BATCH_BYTES + 1e6
        found += batch.select(["ids", "decoded"]).to_pylist()
    want = [[i for k in own.tolist() for i in ids[k]] for own in picks]
    assert [r["ids"] for r in found] == want
    assert [r["decoded"] for r in found] == ["".join(words[k] for k in own.tolist()) for own in picks]


# --- toxicity ---


def test_toxicity(spark):
    rng = random.Random(11)
    stems, rows, labels = ["grumbleton", "snarfle"], [], []
    for i in range(500):
        words = prose(rng, rng.randint(20, 150)).split()
        toxic = rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(stems) + rng.choice(["s", "ed", "x", "q", ""])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = frame(spark, rows + [r for r in ODD if r[0] is None or r[0] > 500]).withColumn("toxic_score", F.lit("x"))
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    scored = toxicity.score(docs, toxicity.learn(docs, known))
    truth = {d: t for d, _, t in labels}
    held = scored.filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert all(0 <= r["toxic_score"] <= 1 for r in held)
    right = [(r["toxic_score"] >= 0.5) == truth[r["doc_id"]] for r in held if r["doc_id"] is not None]
    assert sum(right) >= 0.95 * len(right)
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_toxicity_of_few_labels():
    """Words of a dozen toxic documents carry weight, and so do their misspellings."""
    rng = random.Random(5)
    sample = []
    for i in range(200):
        words = prose(rng, 30).split()
        if i % 14 == 1:
            words[rng.randrange(len(words))] = "snarfled"
        sample.append((i, int(i % 14 == 1), [" ".join(words[s : s + 3]) for s in range(28)]))
    model = toxicity.train(sample, 0.07)
    bad, misspelt, good = model.odds(["snarfled", "snarrfled", prose(rng, 30)], {})
    assert bad > good + 1 and misspelt > good


def test_training_keeps_words_and_grams_packed():
    """57,600 distinct words of some 40 n-grams each: lists of them took 180 MB, arrays and the model's tables 85."""
    sides = ["toxic", "clean"]
    sample = [
        (i, i % 2, [" ".join(f"{sides[i % 2]}word{i}x{j}y{k}" for k in range(3)) for j in range(160)]) for i in range(120)
    ]
    tracemalloc.start()
    try:
        toxicity.train(sample, 0.5, steps=2)
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()


def test_sums_go_block_by_block(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    rng = np.random.default_rng(3)
    index, weights = rng.integers(0, 9, 100).astype(np.int32), rng.normal(size=100)
    found = toxicity._summed(index, lambda part: weights[part], 12)
    assert found.tolist() == np.bincount(index, weights, 12).tolist()


def test_training_sample_is_one_row_per_document(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", {0: 3, 1: 2})
    rows = [(1, "same text here")] * 40 + [(1, f"other text {i}") for i in range(40)] + [(i, f"text {i}") for i in range(2, 9)]
    known = spark.createDataFrame([(i, int(i % 2)) for i in range(1, 400)] + [(1, 1)], "doc_id long, toxic int")
    found = toxicity.training_sample(frame(spark, rows), known)
    assert [t for _, t, _ in sorted(found, key=lambda r: r[1])] == [0, 0, 0, 1, 1]
    assert len({d for d, _, _ in found}) == 5


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, ODD)
    assert toxicity.drop_toxic(docs, none).count() == len(ODD)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs, one).count() == len(ODD)
    assert toxicity.drop_toxic(frame(spark, []), none).count() == 0


# --- WARC ---


def test_warc(spark):
    fake = "WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    rows = [
        (1, "http://a/ b\r\n", "<p>one</p>"),
        (2, None, "<p>one</p>"),
        (2, None, "<p>one</p>"),
        (3, "u", None),
        (4, "u", ""),
        (None, "u", "<p>one</p>"),
        (5, "u", f"before {fake} WARC/1.0\r\nnothing{fake}"),
        (6, "u", fake * 50),
        (7, "u", "é\r\n\r\n" * 20_000),
        (8, "u", "WARC/1.0\r\n"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit(1))
    folder = work_folder(spark, "warc")
    warc.write_warc(pages.repartition(2), folder)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        # Splits of a few hundred bytes cut headers and payloads anywhere.
        for split in (old, "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            found = warc.read_warc(spark, folder).collect()
            first = {"<p>one</p>": 1, "": 3}
            want = []
            for page_id, _, html in rows:
                data = (html or "").encode()
                refers = first.get(html or "")
                revisit = refers is not None and page_id != refers
                want.append(
                    (page_id, len(data), warc.sha1_text(data), "revisit" if revisit else "response", refers if revisit else None)
                )
            got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found]
            assert sorted(got, key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_warc_empty(spark):
    folder = work_folder(spark, "warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_warc(spark, folder).count() == 0
