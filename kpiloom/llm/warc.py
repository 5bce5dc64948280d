"""WARC archives: parallel writing, and reading with verified record boundaries.

Writing: a record is one row of text whose line end is the empty lines after a record,
so Spark's own text writer makes the archives on any file system. Of records with equal
payloads the one with the smallest page id is a response, the others are revisits that
refer to it and carry no payload of their own.

Reading: the archives are split at any byte. A task cuts its split at the magic that
starts a record, wherever it occurs, and emits each candidate with the offset of its
successor, as header and Content-Length give it. Within a split the chain is followed in
the task, so that a candidate points out of its split; across splits the pointers are
doubled from the file's start until no new offset is reached. Only candidates on that
chain are records: magic inside a payload is on no chain. A payload with such magic in
it spans several pieces, which are put together again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, lookup, mapped

MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
#: Payloads below this are always responses.
LEAST_BYTES = 0

# The alphabets of base 32, as numbers and as text.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 bits, ten hex digits, are eight characters."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", page_id.cast("string"), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, left out where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def classify(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The columns page_id, url and html, with payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload. A null page id counts as the largest. Rows that
    agree in page id and payload are the same page and get the same record type.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    sized = pages.select(
        "page_id",
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    # A minimum per payload is combined before the shuffle; only payloads of several pages are kept.
    groups = (
        sized.groupBy(F.col("payload_digest").alias("g_digest"), F.col("payload_bytes").alias("g_bytes"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter((F.col("n") > 1) & (F.col("g_bytes") >= least_bytes))
        .drop("n")
    )
    keys = [("payload_digest", "g_digest"), ("payload_bytes", "g_bytes")]
    met = lookup(sized, checkpointed(groups), keys, how="left")
    revisit = F.col("g_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return met.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first_id"))
    )


def write_warc(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> None:
    """Writes one record per page below `folder`, a new folder; one archive per task."""
    rows = classify(pages, least_bytes)
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    digest = F.col("payload_digest")
    # Blanks and controls in an address would break the header line.
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), digest)),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), digest))),
        _line("WARC-Profile", F.when(revisit, F.lit(_REVISIT))),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page", F.col("refers_to").cast("string")),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", RECORD_END).text(folder)


_PIECE = (
    "file string, block long, rel long, size long, is_head boolean, next_rel long, exit_rel long, head_len long, "
    "content_len long, whole boolean, page_id long, record_type string, refers_to long, digest string, "
    "payload_len long, read_digest string"
)
_NAMES = [part.split()[0] for part in _PIECE.split(", ")]
_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_TYPES = pa.schema([(part.split()[0], _ARROW[part.split()[1]]) for part in _PIECE.split(", ")])


def parse_head(piece: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of a record's header, and its fields; None if it is none. `piece` starts after the magic."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdecimal():
        return None
    return end + 4, fields


def _number(text: str | None) -> int | None:
    try:
        return None if text is None else int(text)
    except ValueError:
        return None


def _candidates(batches) -> Iterator[pa.RecordBatch]:
    """Candidates of the splits, in the order of the bytes. A split's narrow rows are held to its end."""
    magic = len(MAGIC)
    split, rows, at = None, [], 0

    def finished() -> pa.RecordBatch:
        # Followed from the last candidate to the first, each takes over its successor's way out.
        exits: dict[int, int] = {}
        for row in reversed(rows):
            if row["is_head"]:
                row["exit_rel"] = exits.get(row["next_rel"], row["next_rel"])
                exits[row["rel"]] = row["exit_rel"]
        return pa.RecordBatch.from_pylist(rows, schema=_TYPES)

    for batch in batches:
        values, files, blocks = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            value, here = values[i].as_py(), (files[i].as_py(), blocks[i].as_py())
            first = here != split
            if first:
                if rows:
                    yield finished()
                split, rows, at = here, [], 0
            row = dict.fromkeys(_NAMES) | {"file": here[0], "block": here[1], "rel": at, "is_head": False}
            if first and here[1] == 0:
                # What stands before the first magic of a file.
                row["size"] = len(value)
            else:
                row["size"] = len(value) + magic
                if (parsed := parse_head(value)) is not None:
                    head, fields = parsed
                    n = int(fields["content-length"])
                    payload = value[head : head + n]
                    digest = fields.get("warc-payload-digest")
                    row |= {
                        "is_head": True,
                        "head_len": magic + head,
                        "content_len": n,
                        "next_rel": at + magic + head + n + len(RECORD_END),
                        "whole": len(payload) == n,
                        "page_id": _number(fields.get("x-page-id")),
                        "record_type": fields.get("warc-type"),
                        "refers_to": _number(fields.get("x-refers-to-page")),
                        "digest": None if digest is None else digest.removeprefix("sha1:"),
                        "payload_len": _number(fields.get("x-payload-length")),
                        "read_digest": sha1_text(payload) if len(payload) == n else None,
                    }
            rows.append(row)
            at += row["size"]
    if rows:
        yield finished()


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes between magic and magic, with file and start of the split."""
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    return raw.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Checkpointed pieces with `off`, and `next` and `exit` where they start like a record."""
    found = checkpointed(_pieces(spark, folder).transform(mapped, _candidates, _PIECE))
    # A file has as many splits as its size over the split size.
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = F.expr(
        "coalesce(sum(bytes) over (partition by file order by block rows between unbounded preceding and 1 preceding), 0)"
    )
    bases = sizes.select("file", "block", before.alias("base"))
    return checkpointed(
        found.join(bases, ["file", "block"])
        .withColumn("off", F.col("base") + F.col("rel"))
        .withColumn("next", F.col("base") + F.col("next_rel"))
        .withColumn("exit", F.col("base") + F.col("exit_rel"))
    )


def reachable_entries(found: DataFrame) -> DataFrame:
    """(file, off) of the candidates at which the chain from a file's start enters a split.

    Pointer jumping: each round doubles the length of the pointers, so the rounds are the
    logarithm of the splits of a file.
    """
    jumps = found.filter("is_head").select("file", "off", F.col("exit").alias("to"))
    reached = jumps.filter(F.col("off") == 0).select("file", "off")
    known = reached.count()
    # Only offsets that are candidates matter.
    places = jumps.select("file", F.col("off").alias("to"))
    jumps = checkpointed(jumps.join(places, ["file", "to"]))
    while True:
        next_reached = reached.join(jumps, ["file", "off"]).select("file", F.col("to").alias("off"))
        reached = checkpointed(reached.unionByName(next_reached).distinct())
        count = reached.count()
        if count == known:
            return reached
        known = count
        second = jumps.select("file", F.col("off").alias("to"), F.col("to").alias("far"))
        jumps = checkpointed(
            jumps.join(second, ["file", "to"]).select("file", "off", F.col("far").alias("to"))
        )


def _mark(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Follows the chain through one split from where it enters."""
    order = table.sort_by("off")
    offs, nexts = order.column("off").to_pylist(), order.column("next").to_pylist()
    heads, entries = order.column("is_head").to_pylist(), order.column("entry").to_pylist()
    wanted = next((o for o, e in zip(offs, entries, strict=True) if e), None)
    keep = []
    for off, after, head in zip(offs, nexts, heads, strict=True):
        on = head and wanted is not None and off == wanted
        keep.append(bool(on))
        if on:
            wanted = after
    return order.append_column("record", pa.array(keep, pa.bool_())).select(["file", "off", "record"])


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, file, off, next.

    Length and digest of a response are those of the bytes read; a revisit has those of
    the payload it refers to, from its header. A truncated record at the end of a file is
    left out, as are bytes that are on no chain. An empty folder of archives gives none.
    """
    found = candidates(spark, folder)
    entries = reachable_entries(found).withColumn("entry", F.lit(True))
    narrow = found.join(entries, ["file", "off"], "left").select(
        "file", "block", "off", "next", "is_head", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    marked = narrow.groupBy("file", "block").applyInArrow(_mark, "file string, off long, record boolean")
    on_chain = checkpointed(found.join(marked.filter("record").select("file", "off"), ["file", "off"]))
    done = on_chain.filter("whole")
    parts = on_chain.filter(~F.col("whole"))
    if not parts.isEmpty():
        done = done.unionByName(_assembled(spark, folder, found, on_chain, parts).select(done.columns))
    own = F.col("record_type") != "revisit"
    return done.select(
        "page_id",
        F.when(own, F.col("content_len")).otherwise(F.col("payload_len")).alias("payload_bytes"),
        F.when(own, F.col("read_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "file",
        "off",
        "next",
    )


def _owned(found: DataFrame, on_chain: DataFrame, parts: DataFrame) -> DataFrame:
    """(file, block, rel, owner): the pieces of the records that span several.

    A piece belongs to the last record that starts before it; looked up within the files
    that have such records, over narrow rows.
    """
    files = parts.select("file").distinct()
    starts = on_chain.select("file", F.col("off").alias("start"), F.col("off"))
    flagged = found.join(files, "file", "left_semi").join(starts, ["file", "off"], "left")
    owner = F.expr("last(start, true) over (partition by file order by off)")
    owned = flagged.select("file", "block", "rel", "off", owner.alias("owner"))
    return owned.join(parts.select("file", F.col("off").alias("owner")), ["file", "owner"], "left_semi")


def _with_offsets(batches) -> Iterator[pa.RecordBatch]:
    magic, split, at = MAGIC.encode(), None, 0
    for batch in batches:
        files, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        rels, values = [], []
        for i, here in enumerate(zip(files, blocks, strict=True)):
            first = here != split
            split, at = (here, 0) if first else (split, at)
            value = batch.column(0)[i].as_py()
            value = value if first and here[1] == 0 else magic + value
            rels.append(at)
            values.append(value)
            at += len(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(rels, pa.int64()), pa.array(values, pa.binary())],
            names=["p_file", "p_block", "p_rel", "bytes"],
        )


def _digest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Digest of one record put together from its pieces."""
    order = table.sort_by("off")
    head, n = order.column("head_len")[0].as_py(), order.column("content_len")[0].as_py()
    data = b"".join(x.as_py() for x in order.column("bytes"))[head : head + n]
    digest = sha1_text(data) if len(data) == n else None
    return pa.table(
        {
            "file": pa.array([key[0].as_py()], pa.string()),
            "off": pa.array([key[1].as_py()], pa.int64()),
            "read": pa.array([digest], pa.string()),
        }
    )


def _assembled(
    spark: SparkSession, folder: str, found: DataFrame, on_chain: DataFrame, parts: DataFrame
) -> DataFrame:
    """The records whose payload holds magic, with the digest of the whole payload."""
    owned = checkpointed(_owned(found, on_chain, parts))
    pieces = _pieces(spark, folder).transform(mapped, _with_offsets, "p_file string, p_block long, p_rel long, bytes binary")
    keys = [("p_file", "file"), ("p_block", "block"), ("p_rel", "rel")]
    met = lookup(pieces, owned, keys)
    sized = parts.select("file", F.col("off").alias("owner"), "head_len", "content_len")
    read = (
        met.drop("p_file", "p_block", "p_rel")
        .join(sized, ["file", "owner"])
        .groupBy("file", "owner")
        .applyInArrow(_digest, "file string, off long, read string")
    )
    joined = parts.drop("read_digest").join(read, ["file", "off"])
    return joined.filter(F.col("read").isNotNull()).withColumnRenamed("read", "read_digest")
