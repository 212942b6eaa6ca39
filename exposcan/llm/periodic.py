"""Stretches of text that repeat themselves at once: runs of words with a period.

Online dyadic square catching. Words are appended in portions of any size. Once a block of ``2^k`` words is
complete (blocks start every half block), a catcher is set on it: it compares the block with the suffixes of that length that end at the
words appended next, up to a distance of ``2^k``. The first that is equal, ``q`` words on, makes a square of period
``q``: block and copy overlap or touch. Each level keeps only periods over ``2^(k-1)``; shorter ones are caught
a level below. A square inside a run that is known already merges into it; another one opens a run, which is extended to the left
by comparing words backwards and to the right as far as the text goes, and further with each portion.

Why nothing is lost: a run of period ``q`` and length ``4 q`` or more holds a whole block of its level together with the copy, as
blocks start every half block and ``2^k < 2 q``. The next equal suffix of a block in it stands exactly ``q`` words on, since
its period is the smallest one. Why nothing false is found: a shorter period would have given a nearer equal suffix.

A level has ``n / 2^(k-1)`` catchers of at most ``2^k`` comparisons each, so a text of ``n`` words takes
``2 n`` comparisons a level. All catchers of a level advance together; suffixes are compared by hash, runs by their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposcan.llm.hashing import _STEP, mixed

#: A run has this many words at least, and this many periods.
LEAST = 6
TIMES = 4
#: Words appended at a time.
PORTION = 1 << 16
#: Comparisons made at a time.
CELLS = 1 << 18


class SquareCatcher:
    """The runs of a growing sequence of whole numbers from 0."""

    def __init__(self, least: int = LEAST, times: int = TIMES):
        if times < 4:
            raise ValueError("blocks find runs of four periods and more")
        self.least, self.times = least, times
        self.n = 0
        self._words = np.empty(0, np.int64)
        self._hashes: list[np.ndarray] = []
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []  # starts of blocks, distances compared
        self._set: list[int] = []  # start of the next block to complete
        self._runs: list[list[int]] = []  # start, end, period
        self._latest: dict[int, list[int]] = {}
        self._open: list[list[int]] = []

    def append(self, words: np.ndarray) -> None:
        self._words = np.concatenate([self._words, words])
        self.n = n = len(self._words)
        growing = []
        for run in self._open:
            run[1] += self._equal_after(run[1] - run[2], run[1])
            if run[1] == n:
                growing.append(run)
        self._open = growing
        level = 0
        while self.times * ((1 << level >> 1) + 1) <= n:
            self._hash(level)
            for start, period in self._caught(level):
                self._merge(start, period, 1 << level)
            level += 1

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period."""
        found = [(a, z - a, q) for a, z, q in self._runs if z - a >= max(self.least, self.times * q)]
        return sorted(found, key=lambda r: (r[0], r[2]))

    def _hash(self, level: int) -> None:
        """Hashes of all suffixes of ``2^level`` words that have ended since."""
        if level == len(self._hashes):
            self._hashes.append(np.empty(0, np.uint64))
            self._waiting.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            self._set.append(0)
        done, size = self._hashes[level], 1 << level
        if level == 0:
            new = mixed(self._words[len(done):].astype(np.uint64))
        else:
            below, half = self._hashes[level - 1], size >> 1
            new = mixed(below[len(done):self.n - size + 1] * _STEP + below[len(done) + half:self.n - half + 1])
        self._hashes[level] = np.concatenate([done, new])

    def _caught(self, level: int):
        """Blocks whose next equal suffix has come, and its distance where that belongs to this level."""
        size, half = 1 << level, max(1, 1 << level >> 1)
        complete = np.arange(self._set[level], self.n - size + 1, half)
        self._set[level] += half * len(complete)
        starts = np.concatenate([self._waiting[level][0], complete])
        reached = np.concatenate([self._waiting[level][1], np.zeros(len(complete), np.int64)])
        limit = np.minimum(size, self.n - size - starts)
        found = np.zeros(len(starts), np.int64)
        hashes, count = self._hashes[level], limit - reached
        total = np.cumsum(count)
        cuts = np.searchsorted(total, np.arange(CELLS, total[-1] + CELLS, CELLS), side="left") + 1 if len(total) else []
        low = 0
        for high in np.unique(np.minimum(cuts, len(starts))).tolist() if len(total) else []:
            here, many = slice(low, high), count[low:high]
            row = np.repeat(np.arange(low, high), many)
            distance = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(reached[here], many) + 1
            equal = np.flatnonzero(hashes[starts[row] + distance] == hashes[starts[row]])
            first = equal[np.r_[True, row[equal][1:] != row[equal][:-1]][:len(equal)]]
            found[row[first]] = distance[first]
            low = high
        wait = (found == 0) & (limit < size)
        self._waiting[level] = (starts[wait], limit[wait])
        hit = np.flatnonzero((found > size >> 1) & (found <= size))
        return zip(starts[hit].tolist(), found[hit].tolist())

    def _merge(self, start: int, period: int, size: int) -> None:
        known = self._latest.get(period)
        if known and known[0] <= start and start + size + period <= known[1]:
            return
        words = self._words
        if not np.array_equal(words[start:start + size], words[start + period:start + period + size]):
            return
        end = start + size + period
        run = [start - self._equal_before(start, start + period), end + self._equal_after(end - period, end), period]
        self._runs.append(run)
        self._latest[period] = run
        if run[1] == self.n:
            self._open.append(run)

    def _equal_after(self, one: int, other: int) -> int:
        words, count, step = self._words, 0, 16
        while other + count < self.n:
            x, y = words[other + count:other + count + step], words[one + count:one + count + step]
            differs = np.flatnonzero(x != y[:len(x)])
            if len(differs):
                return count + int(differs[0])
            count, step = count + len(x), step * 2
        return count

    def _equal_before(self, one: int, other: int) -> int:
        words, count, step = self._words, 0, 16
        while one - count > 0:
            take = min(step, one - count)
            x, y = words[one - count - take:one - count], words[other - count - take:other - count]
            differs = np.flatnonzero(x != y)
            if len(differs):
                return count + take - 1 - int(differs[-1])
            count, step = count + take, step * 2
        return count


def runs_of(words: list[bytes], least: int = LEAST, times: int = TIMES, portion: int = PORTION) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text, by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    catcher = SquareCatcher(least, times)
    for at in range(0, len(ids), portion):
        catcher.append(ids[at:at + portion])
    return catcher.runs()


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods, as an exact fraction; of equals the first, then that of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay, joined by blanks, when of each run only the first period does."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _struct(run):
    return run and dict(zip(("start", "length", "period"), run))


def _detected(least: int, times: int):
    def detect(batches):
        for batch in batches:
            counts, found, best, kept = [], [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or b"").split()
                runs = runs_of(words, least, times)
                counts.append(len(words))
                found.append([_struct(r) for r in runs])
                best.append(_struct(strongest(runs)))
                kept.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "runs", "strongest", "kept"],
            )

    return detect


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs``, ``strongest`` and ``kept`` of every row of ``docs`` (doc_id, text).

    Words are what stands between blanks, tabs and line ends, compared as they are, byte by byte. A run is a stretch whose
    words are those ``period`` places on, with no smaller such period, of ``least`` words and ``times`` periods at least, which
    cannot be extended. Runs may overlap. ``kept`` is the text, words joined by one blank, without what
    runs hold after their first period.

    Null and empty texts have no words and no runs. Each row is looked at by itself, so repeated rows and ids get a row each. Other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    run = "struct<start: long, length: long, period: long>"
    found = rows.mapInArrow(_detected(least, times), f"doc_id long, n_words long, runs array<{run}>, strongest {run}, kept binary")
    return found.withColumn("kept", F.col("kept").cast("string"))
