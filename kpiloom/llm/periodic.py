"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch of words with smallest period q (words q apart are identical) that no
neighbouring word extends keeping that period. A square is a stretch of two periods; a
run of two periods and more is a union of squares of one period.

Catching: whenever an aligned block of 2**k words is complete, a catcher is set for it.
It waits for the block's content to come back as the end of the text, 2 to 4 block
lengths after the block began, and so answers for the periods from 2 * 2**k up to
4 * 2**k: the first half of a square of such a period holds a whole aligned block. At any
time two catchers per level are awake, so an appended word costs two comparisons of
suffixes per level, by hashes that are sums and so cost the same at each length. What is
caught is compared word by word both ways into a stretch, which stays open while appended
words go on with it; a stretch of two periods is reported, and squares of one period that
overlap are one stretch. A block that comes back inside a run of a period up to its own
length tells nothing new, as its distance is a multiple of that period there.

Words are appended in portions, and the comparisons of a portion are made together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.common import mapped

MIN_WORDS = 6
MIN_PERIODS = 4
#: Words that are appended at a time.
PORTION = 1 << 16

RUNS = "array<struct<start: long, length: long, period: long>>"
_U = np.uint64
#: Odd numbers: base of the suffix hashes and multipliers that spread the word numbers.
_BASE, _MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_powers = np.ones(1, dtype=_U)


def powers(n: int) -> np.ndarray:
    """The powers of the base below n, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, dtype=_U), np.cumprod(np.full(2 * n, _BASE, dtype=_U))])
    return _powers


class SquareCatcher:
    """Takes words as numbers, portion by portion, and knows the runs of two periods and more."""

    def __init__(self, size: int = 1024):
        self.n = 0
        self.words = np.empty(size, dtype=np.int64)
        self.sums = np.zeros(size + 1, dtype=_U)
        #: Per period the stretches [start, end) in order; the words of one are those of a period before.
        self.stretches: dict[int, list[list[int]]] = {}
        self.open: list[tuple[int, list[int]]] = []

    def append(self, words: np.ndarray) -> None:
        old, n = self.n, self.n + len(words)
        if not len(words):
            return
        if n > len(self.words):
            room = max(n, 2 * len(self.words))
            self.words = np.concatenate([self.words[:old], np.empty(room - old, dtype=np.int64)])
            self.sums = np.concatenate([self.sums[: old + 1], np.zeros(room - old, dtype=_U)])
        self.words[old:n] = words
        x = words.astype(_U) + _U(1)
        for m in _MIX:
            x = (x ^ (x >> _U(29))) * _U(m)
        self.sums[old + 1 : n + 1] = self.sums[old] + np.cumsum(x * powers(n)[old:n])
        self.n = n
        for period, stretch in self.open:
            stretch[1] = self._forward(stretch[1], period)
        self.open = [(p, s) for p, s in self.open if s[1] == n]
        first = max(old, 1)
        self._meet(np.flatnonzero(self.words[first:n] == self.words[first - 1 : n - 1]) + first - 1, 1, 1)
        block = 1
        while 3 * block <= n:
            self._catch(block, max(old - block + 1, 2 * block), n - block + 1)
            block *= 2

    def runs(self, least: int = 2) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period, of the runs of `least` periods and more so far."""
        found: dict[tuple[int, int], int] = {}
        for period in sorted(self.stretches):
            for start, end in self.stretches[period]:
                # Of the periods of one stretch the smallest is the run's.
                if end - start >= 2 * period:
                    found.setdefault((start, end), period)
        return sorted((a, b - a, p) for (a, b), p in found.items() if b - a >= least * p)

    def _same(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether `size` words from a and from b, behind it, have one hash."""
        sums = self.sums
        return (sums[a + size] - sums[a]) * _powers[b - a] == sums[b + size] - sums[b]

    def _catch(self, block: int, first: int, last: int) -> None:
        """Compares the suffixes of a block's length that start in [first, last) with the blocks awake."""
        if first >= last:
            return
        here = np.arange(first, last)
        own = self.sums[here + block] - self.sums[here]
        began = here // block
        for back in (2, 3):
            at = (began - back) * block
            start = max(int(np.searchsorted(at, 0)), 0)
            a, b = at[start:], here[start:]
            hit = (self.sums[a + block] - self.sums[a]) * _powers[b - a] == own[start:]
            if hit.any():
                a, b = a[hit], b[hit]
                # A square goes on for half a block on one side at least.
                half = max(block // 2, 1)
                goes = b + block + half > self.n
                inside = a >= half
                goes[inside] |= self._same(a[inside] - half, b[inside] - half, half)
                rest = ~goes
                goes[rest] |= self._same(a[rest] + block, b[rest] + block, half)
                self._meet(a[goes], b[goes] - a[goes], block)

    def _meet(self, at: np.ndarray, distance: np.ndarray | int, block: int) -> None:
        """Makes the stretches around blocks that came back."""
        distance = np.broadcast_to(distance, at.shape)
        known = sorted((s, e) for p, of in self.stretches.items() if p <= block for s, e in of if e - s >= 2 * p)
        if known and block > 1 or known and len(at) and distance[0] > 1:
            starts, ends = np.array(known).T
            ends = np.maximum.accumulate(ends)
            place = np.searchsorted(starts, at, side="right") - 1
            new = (place < 0) | (ends[place] < at + distance + block)
            at, distance = at[new], distance[new]
        order = np.lexsort((at, distance))
        for a, p in zip(at[order].tolist(), distance[order].tolist(), strict=True):
            of = self.stretches.setdefault(p, [])
            if of and of[-1][0] <= a < of[-1][1] - p:
                continue
            if self.words[a] != self.words[a + p]:
                continue
            stretch = [self._backward(a, p), self._forward(a + p, p)]
            if stretch[1] == self.n:
                self.open.append((p, stretch))
            elif stretch[1] - stretch[0] < 2 * p:
                continue
            of.append(stretch)

    def _forward(self, end: int, period: int) -> int:
        """Where the words from `end` on stop being those of a period before."""
        step = 16
        while end < self.n:
            step = min(2 * step, self.n - end)
            differ = self.words[end : end + step] != self.words[end - period : end - period + step]
            k = int(differ.argmax())
            if differ[k]:
                return end + k
            end += step
        return end

    def _backward(self, start: int, period: int) -> int:
        step = 16
        while start > 0:
            step = min(2 * step, start)
            differ = self.words[start - step : start] != self.words[start + period - step : start + period]
            k = int(differ[::-1].argmax())
            if differ[len(differ) - 1 - k]:
                return start - k
            start -= step
        return start


def numbered(words: list) -> np.ndarray:
    """A number for each word, the same for the same words."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def word_runs(words: list, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start, then period."""
    numbers = numbered(words)
    catcher = SquareCatcher(len(numbers))
    for at in range(0, len(numbers), PORTION):
        catcher.append(numbers[at : at + PORTION])
    return [r for r in catcher.runs(max(min_periods, 2)) if r[1] >= min_words]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(steps.cumsum()[:-1] == 0).tolist()])


def _find(text_at: int, kept: list[int], min_words: int, min_periods: int):
    def run(batches):
        for batch in batches:
            counts, found, texts = [], [], []
            for text in batch.column(text_at):
                # Bytes split at the ASCII blanks and at nothing else.
                words = (text.as_py() or "").encode().split()
                runs = word_runs(words, min_words, min_periods)
                counts.append(len(words))
                found.append([{"start": a, "length": n, "period": p} for a, n, p in runs])
                texts.append(collapsed(words, runs).decode())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in kept),
                    pa.array(counts, pa.int64()),
                    pa.array(found, kind),
                    pa.array(texts, pa.string()),
                ],
                names=[*(batch.schema.names[i] for i in kept), "n_words", "runs", "collapsed"],
            )

    return run


def find_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, keep_text: bool = True
) -> DataFrame:
    """The documents with n_words, their runs, and the text with each run cut to its first period.

    A run has at least `min_words` words and `min_periods` periods, of which 2 is the
    least. `runs` is sorted by start, then period; words are numbered from 0. Needs a
    column text; a null or empty one has no words and collapses to the empty text. Rows
    stay rows: repeats and ties are not touched, an empty table gives an empty one.
    Columns called n_words, runs or collapsed are replaced, others stay; without
    `keep_text` the text goes. Each document is read on its own and once, in memory that
    follows its length.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    kept = [f for f in docs.schema if keep_text or f.name.lower() != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = ", ".join(filter(None, [schema, f"n_words long, runs {RUNS}, collapsed string"]))
    at = next(i for i, name in enumerate(docs.columns) if name.lower() == "text")
    places = [docs.columns.index(f.name) for f in kept]
    return docs.transform(mapped, _find(at, places, min_words, min_periods), schema)
