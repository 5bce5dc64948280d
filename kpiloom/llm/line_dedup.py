"""Line dedup by winnowing over hashes of word chains.

A repeated run is a run of consecutive words, of `min_words` or more, that occurs
earlier: in a document before it (by doc_id, null last, then by hash of the text) or
further up in the same one. It may start and end anywhere, also inside a line or a
sentence; blanks and line ends between words do not count. Every word of a repeated run
that is not its first occurrence goes, and with whole lines their ends. One word over
and over within one line is no passage and stays.

A line ends at a line feed, or after a sentence end that blanks follow, as extracted
text often lost its line feeds.

Winnowing: a seed is a chain of SEED_WORDS words, or fewer with a smaller `min_words`. A
window is `min_words` words; the smallest seed hash inside it is its fingerprint. Two
copies of a run hold the same windows and so select the same fingerprints, wherever the
lines around them begin: what no other place selected too is in no repeated run. (Hashes
of whole lines would miss runs that start and end inside lines.)

Fingerprints that several places selected are joined back to their documents, and
neighbouring windows of one fingerprint are a group there. Matches are extended both ways
group by group: a group that occurs whole in an earlier place goes whole, which costs one
row for all of its windows; only where the words around a fingerprint differ, at the ends
of runs, its windows are compared one by one. First occurrences are kept per group and
window, never pairs, so a passage in a third of all documents costs rows per document.
Texts that are equal are read once; the later ones go whole.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed, fresh, lookup, mapped
from kpiloom.session import land, remove_folder, work_folder

MIN_WORDS = 50
#: What ends a line: a line feed, or blanks after a sentence end.
LINE_END = re.compile(r"\n|[.!?][ \t]+\n?")
#: Words as str.split() has them.
WORDS = re.compile(r"\S+")
#: Words of a seed, at most.
SEED_WORDS = 16
#: Bytes of text whose words are hashed at a time.
BLOCK = 1 << 18
#: Blanks between words that are not ASCII ones, as str.split() has them.
OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Odd numbers: the base of the hash of neighbours, and what spreads it.
BASES = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)

_SEEDS = "key_id long, key_hash long, prints array<long>, places array<int>"
_U = np.uint64


def cut_lines(text: str) -> list[str]:
    """The lines with their ends; joined they are the text."""
    cuts = [0, *[m.end() for m in LINE_END.finditer(text)]]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _encoded(text: str | None) -> bytes:
    """The text as UTF-8, with ASCII blanks between words only."""
    text = text or ""
    return (" ".join(text.split()) if OTHER_BLANKS.search(text) else text).encode("utf-8", "surrogatepass")


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of encoded text, block by block.

    A word's hash is a difference of running sums over its bytes, turned back to the power
    at its first byte, and spread.
    """
    hashes, firsts, at = [np.zeros(0, dtype=_U)], [np.zeros(0, dtype=np.int64)], 0
    while at < len(data):
        size = BLOCK
        while True:
            block = np.frombuffer(data, np.uint8, min(size, len(data) - at), at)
            space = _SPACES[block]
            if at + len(block) == len(data):
                break
            last = int(space[::-1].argmax())
            if space[len(space) - 1 - last]:
                block, space = block[: len(block) - last], space[: len(space) - last]
                break
            size *= 2
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        power, back = _powers(len(block))
        sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum((block.astype(_U) + _U(1)) * power)])
        x = (sums[end] - sums[start]) * back[start]
        for m in BASES:
            x = (x ^ (x >> _U(31))) * _U(m)
        hashes.append(x ^ (x >> _U(32)))
        firsts.append(start + at)
        at += len(block)
    return np.concatenate(hashes), np.concatenate(firsts)


_known_powers = [np.zeros(0, dtype=_U), np.zeros(0, dtype=_U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base from 0, and of its inverse; those of a usual block are kept."""
    if n > len(_known_powers[0]):
        size, inverse = max(n, BLOCK), pow(BASES[0], -1, 1 << 64)
        made = [np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, b, dtype=_U)])) for b in (BASES[0], inverse)]
        if n > BLOCK:
            return made[0][:n], made[1][:n]
        _known_powers[:] = made
    return _known_powers[0][:n], _known_powers[1][:n]


def word_hashes(text: str | None) -> np.ndarray:
    return hashed_words(_encoded(text))[0]


def rolled(x: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of each `size` neighbours, from hashes of 1, 2, 4, ... neighbours."""
    out, done, block, width = x[:0], 0, x, 1
    while True:
        if size & width:
            n = max(len(x) - done - width + 1, 0)
            shift = _U(pow(base, done, 1 << 64))
            out = block[done : done + n] * shift + out[:n] if done else block
            done += width
        if done == size:
            return out
        n = max(len(x) - 2 * width + 1, 0)
        block = block[:n] + block[width : width + n] * _U(pow(base, width, 1 << 64))
        width *= 2


def slid(pick: np.ufunc, x: np.ndarray, size: int) -> np.ndarray:
    """The least or greatest (`pick`) of each `size` neighbours."""
    width = 1
    table = x
    while 2 * width <= size:
        table = pick(table[:-width], table[width:]) if len(table) > width else table[:0]
        width *= 2
    rest = size - width
    return pick(table[:-rest], table[rest:]) if rest and len(table) > rest else table[: 0 if rest else None]


def seeds(hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds at each word, and the smallest of each window of `min_words` words."""
    size = min(SEED_WORDS, min_words)
    x = rolled(hashes, size, BASES[0])
    x = (x ^ (x >> _U(32))) * _U(BASES[1])
    x = ((x ^ (x >> _U(29))) >> _U(1)).astype(np.int64)
    return x, slid(np.minimum, x, min_words - size + 1)


def selected_seeds(hashes: np.ndarray, sizes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, seed hash) of the places that windows select, of texts of `sizes` words one after the other."""
    own, least = seeds(hashes, min_words)
    if not len(least):
        return np.zeros(0, dtype=np.int64), least
    ends = sizes.cumsum()
    # Windows over the end of a text are none.
    start = np.arange(len(least))
    text = np.searchsorted(ends, start, side="right")
    least = np.where(start + min_words <= ends[text], least, -1)
    # A place is selected if the greatest of the minima of the windows around it is its own hash.
    reach = min_words - min(SEED_WORDS, min_words) + 1
    edge = np.full(reach - 1, -1)
    place = np.flatnonzero(slid(np.maximum, np.concatenate([edge, least, edge]), reach) == own)
    return np.searchsorted(ends, place, side="right"), own[place]


def _portions(batch: pa.RecordBatch):
    """Neighbouring rows with BLOCK bytes of text or a little more, and their encoded texts."""
    start, texts, size = 0, [], 0
    for i, text in enumerate(batch.column("text")):
        texts.append(_encoded(text.as_py()))
        size += len(texts[-1])
        if size >= BLOCK:
            yield batch.slice(start, i + 1 - start), texts
            start, texts, size = i + 1, [], 0
    if texts:
        yield batch.slice(start), texts


def _read_seeds(min_words: int):
    """The seeds that windows of a text select, and in how many of its places each."""

    def run(batches):
        for rows, texts in chain.from_iterable(map(_portions, batches)):
            hashes, firsts = hashed_words(b"\n".join(texts))
            ends = np.cumsum([len(text) + 1 for text in texts])
            sizes = np.diff(np.searchsorted(firsts, ends), prepend=0)
            text, found = selected_seeds(hashes, sizes, min_words)
            order = np.lexsort((found, text))
            text, found = text[order], found[order]
            new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])])) if len(text) else text
            ends = pa.array(np.searchsorted(text[new], np.arange(len(sizes) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key_id"),
                    rows.column("key_hash"),
                    pa.ListArray.from_arrays(ends, pa.array(found[new])),
                    pa.ListArray.from_arrays(ends, pa.array(np.diff(np.append(new, len(text))).astype(np.int32))),
                ],
                names=["key_id", "key_hash", "prints", "places"],
            )

    return run


def line_ends(text: str) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Ends of all lines, first and end character of each word, number of the line of each word."""
    ends = np.array([m.end() for m in LINE_END.finditer(text)] + [len(text)], dtype=np.int64)
    words = [m.span() for m in WORDS.finditer(text)]
    return ends, words, np.searchsorted(ends, np.array([a for a, _ in words], dtype=np.int64), side="right")


def filler_windows(text: str, hashes: np.ndarray, min_words: int) -> np.ndarray:
    """Which windows are one word over and over within one line."""
    n = max(len(hashes) - min_words + 1, 0)
    same = np.concatenate([[0], (hashes[1:] == hashes[:-1]).cumsum()])
    filler = same[min_words - 1 : min_words - 1 + n] - same[:n] == min_words - 1
    if min_words == 1:
        return np.zeros(n, dtype=bool)
    if filler.any():
        line = line_ends(text)[2]
        filler &= line[:n] == line[min_words - 1 : min_words - 1 + n]
    return filler


def _groups(min_words: int):
    """The windows of matched fingerprints, by their content, as groups of neighbours with one fingerprint."""

    def run(batches):
        reach = min_words - min(SEED_WORDS, min_words) + 1
        for batch in batches:
            index, prints, firsts, windows, ends = [], [], [], [], [np.zeros(1, dtype=np.int64)]
            texts, matched = batch.column("text").to_pylist(), _lists(batch.column("matched"))
            for i, (text, some) in enumerate(zip(texts, matched, strict=True)):
                hashes = word_hashes(text)
                least = seeds(hashes, min_words)[1]
                at = np.flatnonzero(np.isin(least, some) & ~filler_windows(text, hashes, min_words))
                if not len(at):
                    continue
                # A group is as long as windows around one place can be, so its first and last window overlap.
                new = np.concatenate([[True], (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]])])
                start = np.flatnonzero(new)
                inside = np.arange(len(at)) - np.repeat(start, np.diff([*start, len(at)]))
                start = np.flatnonzero(inside % reach == 0)
                index.append(np.full(len(start), i))
                prints.append(least[at[start]])
                firsts.append(at[start])
                windows.append(rolled(hashes, min_words, BASES[0])[at].view(np.int64))
                ends.append(ends[-1][-1] + np.append(start[1:], len(at)))
            if not index:
                continue
            own = pa.array(np.concatenate(index))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key_id").take(own),
                    batch.column("key_hash").take(own),
                    pa.array(np.concatenate(prints)),
                    pa.array(np.concatenate(firsts).astype(np.int32)),
                    pa.ListArray.from_arrays(np.concatenate(ends).astype(np.int32), np.concatenate(windows)),
                ],
                names=["key_id", "key_hash", "print", "first_word", "windows"],
            )

    return run


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy().cumsum()
    return np.split(values, ends[:-1])


def _place(prefix: str = "") -> Column:
    """Order of positions: doc_id, null last, then hash of the text, then word."""
    return F.struct(
        F.col(f"{prefix}key_id").isNull().alias("a"),
        F.col(f"{prefix}key_id").alias("b"),
        F.col(f"{prefix}key_hash").alias("c"),
        F.col(f"{prefix}first_word").alias("d"),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("key_id"),
        F.xxhash64("text").alias("key_hash"),
        F.xxhash64(F.lit(1), "text").alias("key_more"),
        "text",
    ).filter(F.length("text") > 0)


def _order(key: str) -> Column:
    return F.struct(F.col(key).isNull().alias("a"), F.col(key).alias("b"))


def equal_texts(docs: DataFrame) -> DataFrame:
    """(of_hash, of_more, first): each text that several rows have, and the first of their ids."""
    keyed = _keyed(docs)
    same = keyed.groupBy(F.col("key_hash").alias("of_hash"), F.col("key_more").alias("of_more"))
    return same.agg(F.count(F.lit(1)).alias("n"), F.min(_order("key_id")).alias("first")).filter("n > 1").drop("n")


_SAME_TEXT = [("key_hash", "of_hash"), ("key_more", "of_more")]


def repeated_words(docs: DataFrame, copies: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key_id, key_hash, runs): per document with repeated runs, (first word, windows) of the windows that go.

    Rows that agree in doc_id and text are one document here. Of `copies`, from
    `equal_texts`, only the first document is read.
    """
    spark = docs.sparkSession
    keyed = lookup(_keyed(docs), copies, _SAME_TEXT, how="left")
    keyed = keyed.filter(F.col("first").isNull() | (_order("key_id") <= F.col("first"))).select("key_id", "key_hash", "text")
    read = keyed.transform(mapped, _read_seeds(min_words), _SEEDS)
    seeds_folder, groups_folder = work_folder(spark, "seeds"), work_folder(spark, "groups")
    read = land(read, seeds_folder)
    chosen = read.select("key_id", "key_hash", F.inline(F.arrays_zip("prints", "places"))).withColumnsRenamed(
        {"prints": "print"}
    )
    # Added up before the shuffle; only fingerprints of several places go on.
    shared = chosen.groupBy(F.col("print").alias("shared")).agg(F.sum("places").alias("n")).filter("n > 1")
    matches = _joined(chosen, shared.select("shared"), [("print", "shared")], "inner")
    by_doc = checkpointed(
        matches.groupBy(F.col("key_id").alias("m_id"), F.col("key_hash").alias("m_hash")).agg(
            F.collect_set("print").alias("matched")
        )
    )
    remove_folder(spark, seeds_folder)
    around = _with_lists(keyed, by_doc, [("key_id", "m_id"), ("key_hash", "m_hash")])
    kind = "key_id long, key_hash long, print long, first_word int, windows array<long>"
    groups = land(around.select("key_id", "key_hash", "text", "matched").transform(mapped, _groups(min_words), kind), groups_folder)
    # The first and the last window of a group hold all its words.
    told = {"size": F.size("windows"), "head": F.get("windows", F.lit(0)), "tail": F.element_at("windows", -1)}
    groups = groups.withColumns(told)
    keys = ["print", "size", "head", "tail"]
    met = _first_places(groups, keys)
    whole = F.col("origin").isNotNull() & (_place() > F.col("origin"))
    gone = met.filter(whole).select("key_id", "key_hash", "first_word", "size")
    rest = met.filter(~whole).select("key_id", "key_hash", "print", "first_word", F.posexplode("windows").alias("at", "window"))
    rest = rest.withColumn("first_word", F.col("first_word") + F.col("at"))
    later = _first_places(rest, ["print", "window"]).filter(_place() > F.col("origin"))
    gone = gone.unionByName(later.select("key_id", "key_hash", "first_word", F.lit(1).alias("size")))
    runs = gone.groupBy("key_id", "key_hash").agg(F.collect_list(F.struct("first_word", "size")).alias("runs"))
    runs = checkpointed(runs)
    remove_folder(spark, groups_folder)
    return runs


def _with_lists(rows: DataFrame, lists: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """The rows that have a list, with it, by a shuffle at every size. Texts of rows without one are not shuffled."""
    have = lists.select(*[F.col(k).alias(f"{k}_of") for _, k in keys])
    some = lookup(rows, have, [(a, f"{b}_of") for a, b in keys], how="left_semi")
    return some.join(lists.hint("merge"), [F.col(a).eqNullSafe(F.col(b)) for a, b in keys])


def _first_places(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with `origin`, the first place of what several rows share; null for the others."""
    firsts = rows.groupBy(*[F.col(k).alias(f"of_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.min(_place()).alias("origin")
    )
    firsts = checkpointed(firsts.filter("n > 1").drop("n"))
    return _joined(rows, firsts, [(k, f"of_{k}") for k in keys], "left").drop(*[f"of_{k}" for k in keys])


def _joined(rows: DataFrame, firsts: DataFrame, keys: list[tuple[str, str]], how: str) -> DataFrame:
    """A join with a table that grows with the rows, so both sides are shuffled whatever their size."""
    return rows.join(firsts.hint("merge"), [F.col(a) == F.col(b) for a, b in keys], how)


def cut_windows(text: str, starts: np.ndarray, min_words: int) -> tuple[str, int, int]:
    """The text without the windows that start at these words, and the number of whole lines and of words that went.

    Blanks between two words go with a window that holds both. A run that starts a line
    takes what stands before its first word there, one that ends it the line's end, or
    else the blanks behind it; where the head of its first line stays, so does the end.
    """
    ends, words, line = line_ends(text)

    def covered(size: int) -> np.ndarray:
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        steps[starts] = 1
        np.subtract.at(steps, starts + size, 1)
        return steps.cumsum()[:-1] > 0

    gone, joined = covered(min_words), covered(min_words - 1)
    joined[:-1] |= gone[:-1] & gone[1:] & (line[:-1] == line[1:])
    opens = np.flatnonzero(gone & ~np.concatenate([[False], joined[:-1]]))
    closes = np.flatnonzero(gone & ~joined)
    out, at, lines = [], 0, 0
    for first, last in zip(opens, closes, strict=True):
        heads = first == 0 or line[first - 1] != line[first]
        tails = last + 1 == len(words) or line[last + 1] != line[last]
        begin = (int(ends[line[first] - 1]) if line[first] else 0) if heads else words[first][0]
        end = words[last][1] if tails else words[last + 1][0]
        if heads and tails:
            end = int(ends[line[last]])
        lines += int(line[last] - line[first]) + 1 - (not heads) - (not tails and (heads or line[last] > line[first]))
        out.append(text[at:begin])
        at = end
    return "".join([*out, text[at:]]), lines, int(gone.sum())


def cut_copy(text: str, min_words: int) -> tuple[str, int, int]:
    """`cut_windows` for a text that occurs whole in an earlier document."""
    words = text.split()
    if len(words) < min_words:
        return text, 0, 0
    hashes = word_hashes(text)
    filler = filler_windows(text, hashes, min_words)
    if filler.any() or text[0].isspace() or text[-1].isspace():
        return cut_windows(text, np.flatnonzero(~filler), min_words)
    return "", len(cut_lines(text)), len(words)


def _cut_runs(text_at: int, runs_at: int, kept: int, min_words: int):
    """Rewrites the text without its runs; adds counts of the lines and words that went."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(i) for i in range(kept)]
            out, lines, words = [], [], []
            for text, runs in zip(columns[text_at], batch.column(runs_at), strict=True):
                text = text.as_py()
                if runs.is_valid:
                    first, size = (runs.values.field(k).to_numpy().astype(np.int64) for k in ("first_word", "size"))
                    starts = np.repeat(first - size.cumsum() + size, size) + np.arange(size.sum())
                    done = cut_windows(text, starts, min_words)
                else:
                    done = cut_copy(text, min_words)
                for column, value in zip((out, lines, words), done, strict=True):
                    column.append(value)
            columns[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines, pa.int32()), pa.array(words, pa.int32())],
                names=[*batch.schema.names[:kept], "dropped_lines", "dropped_words"],
            )

    return run


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later repeated runs cut out of `text`, and two counts added.

    dropped_lines counts whole lines that went, dropped_words all words. Needs doc_id and
    text; columns with the names of the counts are replaced, others stay. Null and empty
    texts stay as they are. Rows that agree in doc_id and text are one document and keep
    the same words. Empty in, empty out.
    """
    docs = docs.drop("dropped_lines", "dropped_words")
    names = docs.columns
    copies = checkpointed(equal_texts(docs))
    runs = repeated_words(docs, copies, min_words)
    text_hash, text_more = fresh(docs, "__hash"), fresh(docs, "__more")
    hashed = docs.withColumns({text_hash: F.xxhash64("text"), text_more: F.xxhash64(F.lit(1), "text")})
    copies = copies.select(*[F.col(c).alias(fresh(hashed, f"__{c}")) for c in copies.columns])
    of_hash, of_more, first = copies.columns
    met = lookup(hashed, copies, [(text_hash, of_hash), (text_more, of_more)], how="left")
    copy = fresh(met, "__copy")
    met = met.withColumn(copy, F.col(first).isNotNull() & (_order("doc_id") > F.col(first)))
    small = runs.select(
        F.col("key_id").alias(fresh(met, "__id")),
        F.col("key_hash").alias(fresh(met, "__key")),
        F.col("runs").alias(fresh(met, "__runs")),
    )
    key_id, key_hash, key_runs = small.columns
    keys = [("doc_id", key_id), (text_hash, key_hash)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    counted = f"{schema}, dropped_lines int, dropped_words int"
    cut = _cut_runs(names.index("text"), len(names), len(names), min_words)
    # Three kinds of rows: copies, texts with runs, and the others, which go on as they are.
    whole = met.filter(copy).withColumn(key_runs, F.lit(None).cast(small.schema[key_runs].dataType))
    partly = _with_lists(met.filter(~F.col(copy)), small, keys)
    done = [x.select(*names, key_runs).transform(mapped, cut, counted) for x in (whole, partly)]
    rest = lookup(met.filter(~F.col(copy)), small.select(key_id, key_hash), keys, how="left_anti")
    none = F.lit(0).cast("int")
    rest = rest.select(*names, none.alias("dropped_lines"), none.alias("dropped_words"))
    return rest.unionByName(done[0]).unionByName(done[1])
