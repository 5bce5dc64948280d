"""BPE encoding and decoding by a table of distinct words.

A byte-level BPE encodes the words of a text one by one, so a word has the same ids
wherever it stands. Texts are split in their tasks; a task codes the words of a chunk of
documents by a dictionary of the chunk, and keeps the documents as positions in it. The
dictionaries' words are dealt to buckets by hash, where each distinct word of a stretch of
chunks is encoded once. The ids go back to the chunks, are joined to the positions, and a document's ids
are those of its words in turn.

Decoding joins ids to pieces: the table of the vocabulary, whose size is checked, is
broadcast, and the ids of a document meet it where its words are joined back: its text is
the pieces of its ids in turn. `decode` does the same for any ids, a row per position.

What travels between the steps is packed: positions and ids as compressed planes of
bytes, words as compressed lists. What a task holds of a chunk's words and of the
vocabulary to join them back are flat arrays, no object per word.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpiloom.llm.common import BATCH_BYTES, checkpointed, mapped, release_memory

#: Characters of text that make a chunk; its dictionary and positions are held by a task.
CHUNK_BYTES = 36 << 20
#: Documents whose positions travel together.
GROUP = 1024
#: Parts of the word table of a stretch of input partitions, so that tasks grow in number and not in size;
#: a bucket's distinct words are held by a task, up to HELD_WORDS.
BUCKETS = 64
STRETCH = 128
HELD_WORDS = 500_000
#: Words that the tokenizer is given at a time; its results are objects of some KB each.
ENCODED_WORDS = 1024
#: Stretches that are strung together at a time; each byte takes an index of 8.
STRUNG = 1 << 16
#: Entries of a vocabulary up to which its table is broadcast.
MAX_VOCABULARY = 1_000_000

# Fixed value: the word pattern of byte-level BPE.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def read_tokenizer(path: str) -> str:
    """The tokenizer's definition; only byte-level BPE without a normaliser is supported."""
    text = Path(path).read_text(encoding="utf-8")
    spec = json.loads(text)
    split = spec["pre_tokenizer"] or {}
    if (
        spec["normalizer"] is not None
        or spec["model"]["type"] != "BPE"
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
    ):
        raise ValueError(f"not a byte-level BPE: {path}")
    return text


@cache
def _loaded(definition: str) -> tuple[Tokenizer, regex.Pattern | None]:
    """The tokenizer, and the pattern of its added tokens."""
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    # What building it took is more than the tokenizer.
    release_memory()
    return tokenizer, regex.compile("|".join(map(regex.escape, added))) if added else None


def split_words(text: str, definition: str) -> list[str]:
    """The words of a text, blanks included; joined they are the text."""
    tokenizer, added = _loaded(definition)
    # The pattern's tables know letters that the tokenizer's do not: those are not assigned here either.
    if any(unicodedata.category(c) == "Cn" for c in set(text) if c > "Ԁ"):
        own = tokenizer.pre_tokenizer.pre_tokenize_str

        def split(part: str) -> list[str]:
            return [part[a:b] for _, (a, b) in own(part)]
    else:
        split = WORD.findall
    if added is None or not added.search(text):
        return split(text)
    out, at = [], 0
    for match in added.finditer(text):
        out += [*split(text[at : match.start()]), match.group()]
        at = match.end()
    return out + split(text[at:])


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_table(definition: str) -> dict[int, bytes]:
    """The bytes of every id of the vocabulary."""
    spec, alphabet = json.loads(definition), byte_alphabet()
    rows = {i: bytes(alphabet[c] for c in piece) for piece, i in spec["model"]["vocab"].items()}
    rows |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of {len(rows)} entries")
    return rows


class _Strings:
    """Byte strings by number, end to end in one array."""

    def __init__(self, strings: dict[int, bytes]):
        listed = [strings.get(i, b"") for i in range(max(strings, default=-1) + 1)]
        self.flat = np.frombuffer(b"".join(listed), np.uint8)
        self.sizes = np.array([len(x) for x in listed], np.uint32)
        self.starts = self.sizes.cumsum(dtype=np.int64) - self.sizes

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return _strung(self.flat, self.starts, self.sizes, numbers)


def _strung(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The picked stretches of `flat`, end to end."""
    parts = [flat[:0]]
    for at in range(0, len(picks), STRUNG):
        own = picks[at : at + STRUNG]
        long = sizes[own].astype(np.int64)
        ends = long.cumsum()
        parts.append(flat[np.repeat(starts[own] - ends + long, long) + np.arange(ends[-1])])
    return parts[-1] if len(parts) < 3 else np.concatenate(parts)


def piece_strings(definition: str) -> tuple[_Strings, _Strings]:
    """The bytes of every id of the vocabulary, and its decimal behind a comma."""
    rows = piece_table(definition)
    if max(rows, default=0) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary with id {max(rows)}")
    return _Strings(rows), _Strings({i: f",{i}".encode() for i in rows})


def vocabulary(spark: SparkSession, definition: str) -> DataFrame:
    """(id, piece): the bytes of every id."""
    rows = sorted(piece_table(definition).items())
    return spark.createDataFrame([(i, bytearray(b)) for i, b in rows], "id int, piece binary")


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, as compressed planes of bytes."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(planes).view("<u4").ravel()


def _pack_codes(codes: np.ndarray) -> bytes:
    """Codes by falling frequency: upper bytes, and the lower ones of frequent and of other words apart."""
    high, low = codes >> 8, codes.astype(np.uint8)
    often, rare = high == 0, high >= 255
    planes = [np.minimum(high, 255).astype(np.uint8), low[often], low[~often]]
    parts = [*(zstandard.compress(plane.tobytes(), 1) for plane in planes), _pack(high[rare])]
    return np.array([len(part) for part in parts], "<u4").tobytes() + b"".join(parts)


def _unpack_codes(blob: bytes) -> np.ndarray:
    ends = 16 + np.frombuffer(blob, "<u4", 4).cumsum()
    parts = [blob[start:end] for start, end in zip([16, *ends[:-1]], ends, strict=True)]
    upper, frequent, others = (np.frombuffer(zstandard.decompress(part), np.uint8) for part in parts[:3])
    codes = upper.astype(np.uint32)
    codes[upper == 255] = _unpack(parts[3])
    codes <<= 8
    low = np.empty(len(codes), np.uint8)
    low[upper == 0], low[upper > 0] = frequent, others
    codes |= low
    return codes


def _pack_words(words: list[str]) -> bytes:
    return zstandard.compress(json.dumps(words, ensure_ascii=False).encode(), 3)


def _unpack_words(blob: bytes) -> list[str]:
    return json.loads(zstandard.decompress(blob))


_SPLIT = "kind int, chunk long, seq int, doc_ids array<long>, sizes blob, codes binary, words binary".replace("blob", "binary")
_SPLIT_TYPES = pa.schema(
    [
        ("kind", pa.int32()),
        ("chunk", pa.int64()),
        ("seq", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("codes", pa.binary()),
        ("words", pa.binary()),
    ]
)
POSITIONS, WORDS_OF_CHUNK = 2, 0


class _Chunk:
    """Documents of a task until they make a chunk."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.codes: dict[str, int] = {}
        self.docs: list[tuple[int | None, np.ndarray]] = []

    def add(self, doc_id: int | None, words: list[str], size: int) -> None:
        codes = self.codes
        found = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.uint32)
        self.docs.append((doc_id, found))
        self.bytes += size

    def rows(self) -> Iterator[dict]:
        # The dictionary is given up for a list; counts and buckets are taken document by document and bucket by bucket.
        words, self.codes = list(self.codes), {}
        # Frequent words get small codes, which compress well.
        used = np.zeros(len(words), dtype=np.int64)
        for _, found in self.docs:
            np.add.at(used, found.astype(np.intp), 1)
        order = np.argsort(-used, kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        bucket_of = np.fromiter((zlib.crc32(word.encode()) % BUCKETS for word in words), np.int32, len(words))[order]
        for bucket in np.unique(bucket_of).tolist():
            codes = np.flatnonzero(bucket_of == bucket)
            yield {
                "kind": WORDS_OF_CHUNK,
                "chunk": self.number,
                "seq": bucket,
                "codes": _pack(np.diff(codes, prepend=0)),
                "words": _pack_words([words[code] for code in order[codes]]),
            }
        del words
        for seq, first in enumerate(range(0, len(self.docs), GROUP)):
            part = self.docs[first : first + GROUP]
            yield {
                "kind": POSITIONS,
                "chunk": self.number,
                "seq": seq,
                "doc_ids": [d for d, _ in part],
                "sizes": _pack(np.array([len(x) for _, x in part])),
                "codes": _pack_codes(np.concatenate([rank[x] for _, x in part])),
            }


def _split(definition):
    def run(batches):
        base, seq = TaskContext.get().partitionId() << 32, 0
        chunk = _Chunk(base)

        def closed() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in chunk.rows():
                rows.append(row)
                if len(rows) == 64:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SPLIT_TYPES)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SPLIT_TYPES)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                chunk.add(doc_id, split_words(text, definition.value), len(text))
                if chunk.bytes >= CHUNK_BYTES:
                    yield from closed()
                    seq += 1
                    chunk = _Chunk(base + seq)
            # What splitting took lies between the positions, which stay.
            release_memory()
        if chunk.docs:
            yield from closed()

    return run


_IDS = "chunk long, seq int, codes binary, sizes binary, ids binary"


def _encode(definition):
    """Ids of the words of a bucket; rows come sorted by bucket, whose distinct words are encoded once."""

    def run(batches):
        tokenizer, _ = _loaded(definition.value)
        bucket, known = None, {}  # ids as packed integers of 32 bits
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["seq"] != bucket or len(known) > HELD_WORDS:
                    bucket, known = row["seq"], {}
                words = _unpack_words(row["words"])
                new = [w for w in words if w not in known]
                for at in range(0, len(new), ENCODED_WORDS):
                    part = new[at : at + ENCODED_WORDS]
                    for word, found in zip(part, tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                        known[word] = array("I", found.ids).tobytes()
                ids = [known[w] for w in words]
                rows.append(
                    {
                        "chunk": row["chunk"],
                        "seq": row["seq"],
                        "codes": row["codes"],
                        "sizes": _pack(np.array([len(x) // 4 for x in ids])),
                        "ids": _pack(np.frombuffer(b"".join(ids), np.uint32)),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_IDS_TYPES)

    return run


_IDS_TYPES = pa.schema(
    [
        ("chunk", pa.int64()),
        ("seq", pa.int32()),
        ("codes", pa.binary()),
        ("sizes", pa.binary()),
        ("ids", pa.binary()),
    ]
)


class _Dictionary:
    """Ids of a chunk's words, by code."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids, self.sizes, self.starts = (np.zeros(0, kind) for kind in (np.uint32, np.uint32, np.int64))

    def ready(self) -> None:
        codes, sizes, self.ids = (np.concatenate(column) for column in zip(*self.parts, strict=True))
        self.parts = []
        self.sizes, self.starts = np.zeros(len(codes), np.uint32), np.zeros(len(codes), np.int64)
        self.sizes[codes], self.starts[codes] = sizes, sizes.cumsum(dtype=np.int64) - sizes

    def ids_of(self, codes: np.ndarray) -> np.ndarray:
        return _strung(self.ids, self.starts, self.sizes, codes)


def _join_back(pieces, full: bool):
    """Streams (ids, positions) of chunk after chunk; one chunk's dictionary is held."""

    def run(batches):
        chunk, held, open_ = None, _Dictionary(), True
        for batch in batches:
            columns = {c: batch.column(c) for c in ("kind", "chunk", "doc_ids", "sizes", "codes", "ids")}
            for i in range(batch.num_rows):
                value = {c: x[i].as_py() for c, x in columns.items()}
                if value["chunk"] != chunk:
                    chunk, held, open_ = value["chunk"], _Dictionary(), True
                if value["kind"] == WORDS_OF_CHUNK:
                    codes = _unpack(value["codes"]).cumsum()
                    held.parts.append((codes, _unpack(value["sizes"]), _unpack(value["ids"])))
                else:
                    if open_:
                        open_ = False
                        if held.parts:
                            held.ready()
                    yield from _documents(held, value, pieces.value, full)

    return run


def _documents(held: _Dictionary, row: dict, pieces: tuple[_Strings, _Strings], full: bool) -> Iterator[pa.RecordBatch]:
    """The documents of a row; ids and texts in batches of BATCH_BYTES, a longer document in one of its own."""
    texts, decimals = pieces
    sizes, codes = _unpack(row["sizes"]).astype(np.int64), _unpack_codes(row["codes"])
    ends = sizes.cumsum()
    found, ready = [], 0
    for doc_id, start, end in zip(row["doc_ids"], (ends - sizes).tolist(), ends.tolist(), strict=True):
        ids = held.ids_of(codes[start:end])
        sha = hashlib.sha256(decimals.of(ids)[1:]).hexdigest()
        decoded = texts.of(ids).tobytes().decode("utf-8", "replace")
        found.append((doc_id, len(ids), sha, hashlib.sha256(decoded.encode()).hexdigest(), *((ids, decoded) if full else ())))
        ready += ids.nbytes + len(decoded) if full else 0
        if ready >= BATCH_BYTES:
            yield _batch(found)
            found, ready = [], 0
    if found:
        yield _batch(found)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    doc_ids, n_tokens, shas, decoded_shas, *more = zip(*found, strict=True)
    arrays = [
        pa.array(doc_ids, pa.int64()),
        pa.array(n_tokens, pa.int64()),
        pa.array(shas, pa.string()),
        pa.array(decoded_shas, pa.string()),
    ]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if more:
        ids, texts = more
        offsets = np.cumsum([0, *n_tokens]).astype(np.int32)
        arrays += [pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32)), pa.array(texts, pa.string())]
        names += ["ids", "decoded"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def round_trip(docs: DataFrame, path: str, full: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, and with `full` also ids and decoded.

    The ids are those of the tokenizer without added special tokens; special tokens that
    stand in a text are taken as such. Null counts as empty and has no ids. Repeated rows
    repeat. Other columns are not read. Empty in, empty out.
    """
    spark = docs.sparkSession
    text = read_tokenizer(path)
    definition = spark.sparkContext.broadcast(text)
    pieces = spark.sparkContext.broadcast(piece_strings(text))
    split = checkpointed(docs.select("doc_id", "text").transform(mapped, _split(definition), _SPLIT))
    words = split.filter(F.col("kind") == WORDS_OF_CHUNK).select("chunk", "seq", "codes", "words")
    stretch = F.floor(F.shiftright("chunk", 32) / STRETCH)
    encoded = words.repartition("seq", stretch).sortWithinPartitions("seq", "chunk").transform(mapped, _encode(definition), _IDS)
    positions = split.filter(F.col("kind") == POSITIONS).select("kind", "chunk", "seq", "doc_ids", "sizes", "codes")
    parts = encoded.withColumn("kind", F.lit(WORDS_OF_CHUNK)).unionByName(positions, allowMissingColumns=True)
    dealt = parts.repartition("chunk").sortWithinPartitions("chunk", "kind", "seq")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return dealt.transform(mapped, _join_back(pieces, full), schema + (", ids array<int>, decoded string" if full else ""))


def _joined(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            None if pieces is None else b"".join(p["piece"] for p in pieces).decode("utf-8", "replace")
            for pieces in batch.column("pieces").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
        )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with doc_id and ids, by a join of every position with the vocabulary.

    Bytes that are no UTF-8 become replacement characters. Null ids give a null text; an
    id outside the vocabulary raises an error.
    """
    pieces = vocabulary(encoded.sparkSession, read_tokenizer(path))
    rows = encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
    each = rows.select("row", "doc_id", F.col("ids").isNull().alias("none"), F.posexplode_outer("ids").alias("pos", "id"))
    joined = each.join(F.broadcast(pieces), "id", "left").withColumn(
        "piece",
        F.when(F.col("id").isNotNull() & F.col("piece").isNull(), F.raise_error(F.lit("id outside the vocabulary")).cast("binary"))
        .otherwise(F.col("piece")),
    )
    whole = joined.groupBy("row", "doc_id", "none").agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))).alias("all")
    )
    named = whole.select("doc_id", F.when(~F.col("none"), F.col("all")).alias("pieces"))
    return named.transform(mapped, _joined, "doc_id long, text string")
