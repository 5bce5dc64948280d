"""Exact dedup by composable polynomial fingerprints and chunkwise comparison.

A text is normalised by deleting ASCII blanks, in UTF-8. Its fingerprint is its length
and two polynomial hashes of its bytes. The hash of a text is composed from the hashes
of its chunks: H(ab) = H(a) * B^len(b) + H(b), so the chunks of a huge text are hashed
by many tasks and only their hashes meet. Texts whose fingerprints agree are compared
chunk by chunk with the row that would stay: the chunks of a group are dealt out by
(fingerprint, chunk, lane), stream through a task in that order, and only the current
chunk of the staying row is held. Rows that differ in spite of their fingerprint form
new groups and are compared again, until none differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import BLANKS, checkpointed, lookup, mapped

CHUNK = 1 << 16
#: Primes and bases of the two hashes.
MODULI = ((2_147_483_647, 1_315_423_911), (2_147_483_629, 388_276_013))
#: Rows of a group that one task compares.
LANE_ROWS = 128

_HASHED = "doc_id long, n_chars long, n_bytes long, h1 long, h2 long, text_sha256 string"
_PRINT = ["n_bytes", "h1", "h2"]


def _powers(modulus: int, base: int, n: int) -> np.ndarray:
    """base^(n-1) .. base^0, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), modulus))
        out = np.concatenate([out, out * step % np.uint64(modulus)])
    return out[:n][::-1].copy()


class ChunkHash:
    """Polynomial hashes of byte chunks, and their composition."""

    def __init__(self, moduli=MODULI, chunk: int = CHUNK):
        self.moduli, self.chunk = moduli, chunk
        self.powers = [_powers(m, b, chunk) for m, b in moduli]

    def of(self, data: bytes) -> tuple[int, ...]:
        """Of one chunk. Byte values count from 1, so that leading zeros matter."""
        x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        # Products stay below 2^40 and a chunk has at most 2^16 of them.
        return tuple(
            int((x * p[len(p) - len(x) :]).sum() % np.uint64(m))
            for p, (m, _) in zip(self.powers, self.moduli, strict=True)
        )

    def join(self, left: tuple[int, ...], right: tuple[int, ...], right_len: int) -> tuple[int, ...]:
        return tuple(
            (a * pow(b, right_len, m) + c) % m for a, c, (m, b) in zip(left, right, self.moduli, strict=True)
        )


def normalised(text: str | bytes | None) -> bytes:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(None, BLANKS.encode())


def _texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 of a string column, without making Python strings."""
    column = batch.column(name)
    large = pa.types.is_large_string(column.type)
    for value in column.cast(pa.large_binary() if large else pa.binary()):
        yield value.as_py() or b""


def _whole(moduli) -> Callable:
    def run(batches):
        hashes = ChunkHash(moduli)
        for batch in batches:
            out = []
            for data in map(normalised, _texts(batch)):
                out.append((len(data), *hashes.of(data), hashlib.sha256(data).hexdigest()))
            n, h1, h2, sha = map(list, zip(*out, strict=True)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_chars"),
                    pa.array(n, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                names=["doc_id", "n_chars", "n_bytes", "h1", "h2", "text_sha256"],
            )

    return run


def _cut(batches):
    """Chunks of the normalised texts, one row each; all carry what is known of the whole text."""
    for batch in batches:
        known = {c: batch.column(c).to_pylist() for c in ("long_id", "doc_id", "n_chars")}
        for i, data in enumerate(map(normalised, _texts(batch))):
            sha = hashlib.sha256(data).hexdigest()
            pieces = [data[k : k + CHUNK] for k in range(0, len(data), CHUNK)] or [b""]
            for first in range(0, len(pieces), 64):
                part = pieces[first : first + 64]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([known["long_id"][i]] * n, pa.int64()),
                        pa.array([known["doc_id"][i]] * n, pa.int64()),
                        pa.array([known["n_chars"][i]] * n, pa.int64()),
                        pa.array([sha] * n, pa.string()),
                        pa.array(range(first, first + n), pa.int32()),
                        pa.array(part, pa.binary()),
                    ],
                    names=["long_id", "doc_id", "n_chars", "text_sha256", "chunk_no", "chunk"],
                )


def _hash_chunks(moduli) -> Callable:
    def run(batches):
        hashes = ChunkHash(moduli)
        for batch in batches:
            data = [x.as_py() for x in batch.column("chunk")]
            found = [hashes.of(x) for x in data]
            kept = ["long_id", "doc_id", "n_chars", "text_sha256", "chunk_no"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([len(x) for x in data], pa.int64()),
                    pa.array([h[0] for h in found], pa.int64()),
                    pa.array([h[1] for h in found], pa.int64()),
                ],
                names=[*kept, "n", "h1", "h2"],
            )

    return run


def _composed(moduli) -> tuple[Column, Column, Column]:
    """Length and hashes of a text from its chunks in order; the products stay exact as decimals."""
    chunks = F.array_sort(F.collect_list(F.struct("chunk_no", "n", "h1", "h2")))
    wide = "decimal(38,0)"

    def fold(name: str, modulus: int, base: int) -> Column:
        # All chunks but the last are full, so that two shifts occur: a chunk's, and the last one's.
        full = pow(base, CHUNK, modulus)

        def power(n: Column) -> Column:
            """base^n by the bits of n, n below 2^17."""
            out = F.lit(1).cast(wide)
            for bit in range(17):
                factor = F.when(n.bitwiseAND(F.lit(1 << bit)) != 0, pow(base, 1 << bit, modulus)).otherwise(1)
                out = (out * factor.cast(wide) % F.lit(modulus).cast(wide)).cast(wide)
            return out

        def step(acc: Column, c: Column) -> Column:
            shift = F.when(c["n"] == CHUNK, F.lit(full).cast(wide)).otherwise(power(c["n"]))
            return ((acc * shift + c[name]) % F.lit(modulus).cast(wide)).cast(wide)

        return F.aggregate(chunks, F.lit(0).cast(wide), step).cast("long")

    (m1, b1), (m2, b2) = moduli
    return F.sum("n").alias("n_bytes"), fold("h1", m1, b1).alias("h1"), fold("h2", m2, b2).alias("h2")


def fingerprints(docs: DataFrame, moduli=MODULI) -> DataFrame:
    """Per row: doc_id, n_chars (code points), n_bytes, h1, h2, text_sha256 (of the normalised text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), text.alias("text"))
    short = rows.filter(F.octet_length("text") <= CHUNK).transform(mapped, _whole(moduli), _HASHED)
    owner = "long_id long, doc_id long, n_chars long, text_sha256 string, chunk_no int"
    pieces = (
        rows.filter(F.octet_length("text") > CHUNK)
        .withColumn("long_id", F.monotonically_increasing_id())
        .transform(mapped, _cut, f"{owner}, chunk binary")
    )
    hashed = pieces.repartition("long_id", "chunk_no").transform(
        mapped,
        _hash_chunks(moduli), f"{owner}, n long, h1 long, h2 long"
    )
    known = [F.max(c).alias(c) for c in ("doc_id", "n_chars", "text_sha256")]
    long = hashed.groupBy("long_id").agg(*known, *_composed(moduli))
    columns = ["doc_id", "n_chars", "n_bytes", "h1", "h2", "text_sha256"]
    return short.select(columns).unionByName(long.select(columns))


def _compare(batches):
    """Streams chunks sorted by (group, chunk, lane, staying row first); yields the rows that differ."""
    current, held = None, b""
    for batch in batches:
        out = []
        rows = zip(
            *(batch.column(c).to_pylist() for c in ("g", "chunk_no", "lane", "stays", "doc_id", "sha")), strict=True
        )
        for i, (g, no, lane, stays, doc_id, sha) in enumerate(rows):
            chunk = batch.column("chunk")[i]
            if (g, no, lane) != current:
                current, held = (g, no, lane), chunk.as_py() if stays else None
            elif not stays and chunk.as_py() != held:
                out.append((g, doc_id, sha))
            # A row without a counterpart is longer than the staying one; lengths agree, so there is none.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.string()),
            ],
            names=["g", "doc_id", "sha"],
        )


def _cut_members(batches):
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("g", "lanes", "lane", "stays", "doc_id", "sha")}
        for i, data in enumerate(map(normalised, _texts(batch))):
            own = range(columns["lanes"][i]) if columns["stays"][i] else [columns["lane"][i]]
            pieces = [data[k : k + CHUNK] for k in range(0, len(data), CHUNK)] or [b""]
            for no, piece in enumerate(pieces):
                for start in range(0, len(own), 64):
                    part = own[start : start + 64]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([columns["g"][i]] * n, pa.int64()),
                            pa.array([no] * n, pa.int32()),
                            pa.array(list(part), pa.int64()),
                            pa.array([columns["stays"][i]] * n, pa.bool_()),
                            pa.array([columns["doc_id"][i]] * n, pa.int64()),
                            pa.array([columns["sha"][i]] * n, pa.string()),
                            pa.array([piece] * n, pa.binary()),
                        ],
                        names=["g", "chunk_no", "lane", "stays", "doc_id", "sha", "chunk"],
                    )


def exact_groups(docs: DataFrame, moduli=MODULI) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when their normalised texts are; null counts as empty, so all empty
    texts are one group. Of equal texts the row with most code points stays, then the
    smallest doc_id (null last), then any one of rows that agree in both. Other columns
    are not read; an empty table gives none.
    """
    prints = checkpointed(fingerprints(docs, moduli).withColumn("rid", F.monotonically_increasing_id()))
    open_rows, done = prints, None
    while True:
        # The best of a group: most code points, smallest doc_id, null last.
        order = F.struct(
            (-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "text_sha256", "rid"
        )
        groups = checkpointed(
            open_rows.groupBy(*_PRINT)
            .agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("best"))
            .filter("size > 1")
            .select(
                F.monotonically_increasing_id().alias("g"),
                *[F.col(c).alias(f"g_{c}") for c in _PRINT],
                "size",
                F.col("best.doc_id").alias("best_id"),
                F.col("best.text_sha256").alias("keep_sha"),
                F.col("best.rid").alias("best_rid"),
            )
        )
        grouped = F.col("g").isNotNull()
        placed = (
            lookup(open_rows, groups, [(c, f"g_{c}") for c in _PRINT], how="left")
            .withColumn("keep_id", F.when(grouped, F.col("best_id")).otherwise(F.col("doc_id")))
            .withColumn("keep_rid", F.when(grouped, F.col("best_rid")).otherwise(F.col("rid")))
        )
        differing = checkpointed(_differing(docs, placed).toDF("d_g", "d_id", "d_sha"))
        match = (
            (F.col("g") == F.col("d_g"))
            & F.col("doc_id").eqNullSafe(F.col("d_id"))
            & (F.col("text_sha256") == F.col("d_sha"))
        )
        none_left = differing.isEmpty()
        equal = placed if none_left else placed.join(differing, match, "left_anti")
        done = equal if done is None else done.unionByName(equal)
        if none_left:
            break
        open_rows = checkpointed(placed.join(differing, match, "left_semi").select(prints.columns))
    # Counted once more, as rows may have left a group.
    sizes = done.groupBy(F.col("keep_rid").alias("of_rid")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return lookup(done, checkpointed(sizes), [("keep_rid", "of_rid")], how="left").select(
        "doc_id",
        "keep_id",
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def _differing(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """(g, doc_id, sha) of the rows of groups whose text is not that of the staying row."""
    members = placed.filter("g is not null").select(
        "g", "size", F.col("doc_id").alias("m_id"), F.col("text_sha256").alias("m_sha"), "keep_id", "keep_sha"
    )
    # One entry per different (doc_id, text) of a group: repeated rows need one comparison.
    members = checkpointed(members.distinct())
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).withColumn(
        "sha", F.sha2(F.translate(F.col("text"), BLANKS, ""), 256)
    )
    met = lookup(texts, members, [("doc_id", "m_id"), ("sha", "m_sha")])
    lanes = F.ceil(F.col("size") / LANE_ROWS).cast("long")
    chunks = met.select(
        "g",
        lanes.alias("lanes"),
        F.pmod(F.xxhash64("doc_id"), lanes).alias("lane"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha"))).alias("stays"),
        "doc_id",
        "sha",
        "text",
    ).transform(
        mapped,
        _cut_members, "g long, chunk_no int, lane long, stays boolean, doc_id long, sha string, chunk binary"
    )
    order = ["g", "chunk_no", "lane", F.col("stays").desc()]
    dealt = chunks.repartition("g", "chunk_no", "lane").sortWithinPartitions(*order)
    return dealt.transform(mapped, _compare, "g long, doc_id long, sha string").distinct()
