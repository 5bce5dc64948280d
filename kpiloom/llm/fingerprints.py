"""SpotSigs fingerprints: chains of content words that follow common words.

Every occurrence of a common word (an anchor) is a spot; the spot and the next CHAIN
words that are no anchors make a signature. The distinct signatures of a text are its
fingerprint, and two texts are as alike as the Jaccard similarity of these sets. Spots
sit in running prose, so boilerplate without function words leaves few.

Sets can only reach a similarity t if their sizes differ by a factor of 1/t at most.
`similar` therefore partitions sets by size, in steps of 1/t, looks only into the own
and the neighbouring partitions, and there only for sets that share one of their rarest
signatures, before the sets themselves are compared.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, mapped

CHAIN = 2
#: Stretches of more words than this without an anchor add their chains of words.
STRETCH = 20
THRESHOLD = 80
#: Keys that are sampled to cut the order of documents into ranges, per range.
SAMPLED = 20

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "auf das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au avec dans de des du elle est et la le les par pas pour que qui sur un une "
    "al con del el en es las los para por se su una y".split()
)
_ANCHOR_BYTES = frozenset(w.encode() for w in ANCHORS)
# Lower case, and blanks for the ASCII characters that are no letters or digits.
_PLAIN = bytes(
    c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def spot_signatures(text: str) -> np.ndarray:
    """Sorted 32-bit hashes of the distinct signatures.

    A stretch of more than STRETCH words without an anchor adds its chains of CHAIN + 1
    words, so that a few common words do not stand for a text of code or of another
    language. A text without a complete spot is its chains of CHAIN + 1 words, or all its
    words as one chain if they are fewer; a text without words has none.
    """
    words = text.encode().translate(_PLAIN).split()
    if not words:
        return np.zeros(0, dtype=np.uint32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=_U, count=len(words))
    anchor = np.fromiter((w in _ANCHOR_BYTES for w in words), dtype=bool, count=len(words))
    content, spots = hashes[~anchor], np.flatnonzero(anchor)
    # How many content words stand before a spot is where its chain starts.
    start = spots - np.arange(len(spots))
    full = start + CHAIN <= len(content)
    if full.any():
        total, start = hashes[spots[full]], start[full]
        for i in range(CHAIN):
            total = _mixed(total * _U(0x9E3779B97F4A7C15) + content[start + i])
        gaps = np.diff(spots, prepend=-1, append=len(words)) - 1
        gap = np.repeat(np.arange(len(gaps)), gaps)
        start = np.flatnonzero((gap[CHAIN:] == gap[:-CHAIN]) & (gaps[gap[:-CHAIN]] > STRETCH))
        chain = np.zeros(len(start), dtype=_U)
        for i in range(CHAIN + 1):
            chain = _mixed(chain * _U(0x9E3779B97F4A7C15) + content[start + i])
        total = np.concatenate([total, chain])
    else:
        n = min(CHAIN + 1, len(words))
        total = np.zeros(len(words) - n + 1, dtype=_U)
        for i in range(n):
            total = _mixed(total * _U(0x9E3779B97F4A7C15) + hashes[i : len(words) - n + 1 + i])
    return np.unique((total >> _U(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity; 0 without a look at the sets where their sizes cannot reach `least`."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (small + large - shared)


def printed(signatures: np.ndarray) -> str:
    """Number of signatures, and the signatures in base 64."""
    return f"{len(signatures)}:{base64.b64encode(signatures.astype('<u4').tobytes()).decode()}"


def _order() -> Column:
    """Descending doc_id, null last, then hash of the text; the complement turns the order of longs around."""
    return F.struct(
        F.col("doc_id").isNull().alias("n"),
        F.bitwise_not(F.col("doc_id")).alias("o"),
        F.xxhash64("text").alias("h"),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """The documents dealt to ranges of their order, each range with the first row of the next as a guest.

    Columns: spot (number of the range), guest, key, doc_id, text; rows are sorted by
    the first three within a partition. The cuts come from a sample of keys that is
    bounded by the number of partitions; what is collected besides is a key per range.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _order())
    ranges = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 512)
    sample = keyed.select("key").orderBy(F.xxhash64("key.o", "key.h"), "key").limit(SAMPLED * ranges).collect()
    found = sorted({(r["key"]["n"], r["key"]["o"] or 0, r["key"]["h"]): r["key"] for r in sample}.items())
    cuts = [found[i * len(found) // ranges][1].asDict() for i in range(1, ranges)] if found else []
    listed = F.from_json(F.lit(json.dumps(cuts)), "array<struct<n:boolean,o:bigint,h:bigint>>")
    placed = keyed.withColumn("spot", F.size(F.filter(listed, lambda c: c <= F.col("key"))).cast("int"))
    firsts = sorted(placed.groupBy("spot").agg(F.min("key").alias("key")).collect(), key=lambda r: r["spot"])
    # The first row of a range also visits the range before it, that of the first range the last one.
    visits = [(r["spot"], tuple(r["key"]), firsts[i - 1]["spot"]) for i, r in enumerate(firsts)]
    table = spark.createDataFrame(visits, "at int, first struct<n:boolean,o:bigint,h:bigint>, visit int")
    met = placed.join(F.broadcast(table), F.col("spot") == F.col("at"))
    at_home = F.struct(F.col("spot").alias("spot"), F.lit(False).alias("guest"))
    places = F.when(F.col("key") == F.col("first"), F.array(at_home, F.struct(F.col("visit").alias("spot"), F.lit(True).alias("guest"))))
    dealt = met.select("doc_id", "text", "key", F.inline(places.otherwise(F.array(at_home))))
    return dealt.repartition("spot").sortWithinPartitions("spot", "guest", "key")


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
OUT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The text with its last third, rounded down, replaced by the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compared(batches) -> Iterator[pa.RecordBatch]:
    """Streams rows in order; a row waits for the one after it, and only the two are held."""
    waiting, spot = None, None

    def finished(row, after):
        doc_id, text, own = row
        changed = edited(text, after[1])
        other = spot_signatures(changed)
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": printed(own),
            "edited_fingerprint": printed(other),
            "near_edited": likeness(own, other),
            "near_next": likeness(own, after[2]),
        }

    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("spot", "guest", "doc_id", "text")), strict=True)
        for here, guest, doc_id, text in rows:
            if here != spot:
                spot, waiting = here, None
            if guest and waiting is None:
                continue
            row = doc_id, text, spot_signatures(text)
            if waiting is not None:
                out.append(finished(waiting, row))
            waiting = None if guest else row
        yield pa.RecordBatch.from_pylist(out, schema=_OUT)


def compare_next(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of the text and of its edited form, and how alike they and the next row's are.

    The next row is that of the next smaller doc_id (null last; rows with one doc_id by
    hash of the text), after the last the first; a single row is its own next. Null
    counts as an empty text, which is like another empty text (1) and unlike any other
    (0). Rows that agree in doc_id and text stand next to each other. Other columns are
    not read. Empty in, empty out.
    """
    return with_next(docs).select("spot", "guest", "doc_id", "text").transform(mapped, _compared, OUT_SCHEMA)


def _fingerprinted(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [spot_signatures(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("doc_id"), pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
            names=["node", "doc_id", "spots"],
        )


def similar(queries: DataFrame, docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """(query_id, doc_id, likeness) of the documents that are at least `percent` like a query.

    `queries` is a stated set of rows, compared with all of `docs`. Both have doc_id and
    text. A set's prefix are its rarest signatures, so many that two similar sets share
    one at least; its candidates are the sets with a common prefix signature in its own
    size partition or the next ones. Texts without signatures match nothing.
    """
    step, t = math.log(100 / percent), percent / 100
    kind = "node long, doc_id long, spots array<long>"

    def sets(df: DataFrame) -> DataFrame:
        rows = df.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text")
        return checkpointed(rows.transform(mapped, _fingerprinted, kind).filter(F.size("spots") > 0))

    def size_part(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / F.lit(step) + F.lit(1e-9)).cast("int")

    asked, known = sets(queries), sets(docs)
    counts = known.select(F.explode("spots").alias("spot")).groupBy("spot").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(df: DataFrame) -> DataFrame:
        each = df.select("node", F.size("spots").alias("size"), F.explode("spots").alias("spot"))
        ranked = each.join(counts, "spot", "left").select(
            "node", "size", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "spot").alias("s")
        )
        sorted_spots = ranked.groupBy("node", "size").agg(F.array_sort(F.collect_list("s")).alias("all"))
        kept = F.col("size") - F.ceil(F.col("size") * t - 1e-9).cast("int") + 1
        return sorted_spots.select("node", "size", F.explode(F.slice("all", F.lit(1), kept)).alias("s")).select(
            "node", size_part(F.col("size")).alias("part"), F.col("s.spot").alias("spot")
        )

    near = F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part")
    left = prefixes(asked).select(F.col("node").alias("q"), near, "spot")
    candidates = left.join(prefixes(known), ["part", "spot"]).select("q", "node").distinct()
    shared = F.size(F.array_intersect("q_spots", "spots"))
    like = shared / (F.size("q_spots") + F.size("spots") - shared)
    q = asked.select(F.col("node").alias("q"), F.col("doc_id").alias("query_id"), F.col("spots").alias("q_spots"))
    both = candidates.join(q, "q").join(known, "node")
    sizes_fit = F.least(F.size("q_spots"), F.size("spots")) >= t * F.greatest(F.size("q_spots"), F.size("spots")) - 1e-9
    return (
        both.filter(sizes_fit)
        .withColumn("likeness", like)
        .filter(F.col("likeness") >= t - 1e-12)
        .select("query_id", "doc_id", "likeness")
    )
