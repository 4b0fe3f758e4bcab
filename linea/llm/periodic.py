"""Periodic runs of words by online dyadic square catching.

Words are appended to a stream. A catcher is a completed block of ``b = 2^k``
words that starts at a multiple of ``b``; it watches for its own recurrence at
a distance q of 2b - 1 to 4b - 2 words. Any run of such a period (two periods
or more) holds a whole block in one period, so some catcher sees it, and each
appended word meets just two catchers a level. A recurrence opens a comparison
of the stream with itself q words back: it is carried to the left as far as it
agrees, each appended word advances it, and a word that differs closes it. A
comparison that spans 2q words or more has caught squares of period q, all
within one run; squares of several periods over the same stretch merge into the
run of the smallest.

:class:`Catchers` takes words one by one or in slabs of any size, with the same
result; a slab's words are handled together with numpy. Blocks are compared by
64-bit hashes built by doubling, so a recurrence is never missed; every run is
verified word by word, and hashes are dealt anew if one fails.

Work is O(n log n), memory eight bytes a word and level. Documents of a task
form streams of ``SLAB`` words or one document, with a word of its own after each
document, so no period crosses a document's end.

Edge cases: null or empty text has no words, no runs and an empty collapsed
text. Very long texts are a stream of their own, appended slab by slab. Repeated
rows are handled one by one; an empty table gives an empty result. Other columns
pass through, except those named like the added ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words appended at a time, and least words of a stream before it is closed.
SLAB = 1 << 16
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(ids: np.ndarray, salt: int) -> np.ndarray:
    x = ids.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class Catchers:
    """Runs of an appended stream of word ids: (start, end, period) with end - start >= 2 * period."""

    def __init__(self, max_period: int | None = None, salt: int = 0):
        self.max_period, self.salt = max_period, salt
        self.n = 0
        self.words = np.empty(0, np.int64)
        self.hashes: list[np.ndarray] = []  # level k: hash of the block at each position
        self.full: list[int] = []  # blocks of each level that are complete
        # 3 mod 4: factors of two build up as slowly as can be
        self.factors = np.random.default_rng(salt).integers(0, 2**62, 64, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
        self.open_period = np.empty(0, np.int64)  # open comparisons, by period
        self.open_start = np.empty(0, np.int64)
        self.caught: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period

    def append(self, ids: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(ids)
        self.words = self._grown(self.words, old, self.n)
        self.words[old:self.n] = ids
        self._hash(old)
        self._advance(old)
        for level in range(len(self.hashes)):
            if (2 << level) - 1 <= (self.max_period or self.n):
                self._catch(level, old)

    @staticmethod
    def _grown(array: np.ndarray, used: int, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        wide = np.empty(max(need, 2 * used), array.dtype)
        wide[:used] = array[:used]
        return wide

    def _hash(self, old: int) -> None:
        """Hashes of the blocks that the appended words complete."""
        level = 0
        while 1 << level <= self.n and (level == 0 or (1 << level) <= (self.max_period or self.n)):
            if level == len(self.hashes):
                self.hashes.append(np.empty(0, np.uint64))
                self.full.append(0)
            done, size = self.full[level], self.n - (1 << level) + 1
            self.hashes[level] = self._grown(self.hashes[level], done, size)
            if level == 0:
                self.hashes[0][done:size] = _mixed(self.words[done:size], self.salt)
            else:
                lower, half = self.hashes[level - 1], 1 << (level - 1)
                self.hashes[level][done:size] = lower[done:size] * self.factors[level] + lower[done + half:size + half]
            self.full[level] = size
            level += 1

    def _agree(self, at: np.ndarray, period: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) equal those ``period`` back."""
        at, total = at.copy(), np.zeros(len(at), np.int64)
        level = len(self.hashes) - 1
        while level >= 0:
            size, h = 1 << level, self.hashes[level]
            first = at if forward else at - size
            fits = (first - period >= 0) & (first + size <= self.n)
            where = np.flatnonzero(fits)
            same = where[h[first[where]] == h[first[where] - period[where]]]
            at[same] += size if forward else -size
            total[same] += size
            if level < len(self.hashes) - 1 or not len(same):  # the widest step is taken as often as it fits
                level -= 1
        return total

    def _advance(self, old: int) -> None:
        """Open comparisons meet the appended words; the first one that differs closes them."""
        if not len(self.open_period):
            return
        more = self._agree(np.full(len(self.open_period), old), self.open_period, True)
        going = old + more == self.n
        self._report(self.open_start[~going], old + more[~going], self.open_period[~going])
        self.open_start, self.open_period = self.open_start[going], self.open_period[going]

    def _catch(self, level: int, old: int) -> None:
        """Blocks that the appended words complete meet the two live catchers of their level."""
        b, h = 1 << level, self.hashes[level]
        begin, end = max(0, old - b + 1), self.n - b + 1
        for distance in (2 * b - 1, 3 * b - 1):  # least distance of the newest live catcher, and of the one before
            low = max(begin, distance)
            if low >= end:
                continue
            # the catcher of position j is the block at or below j - distance
            block0 = (low - distance) // b * b
            watched = np.repeat(h[block0:end - distance:b], b)[low - distance - block0:][:end - low]
            same = h[low:end] == watched
            first = same.copy()
            first[b:] &= ~same[:-b]  # the block before recurs at the same distance: one comparison
            if not first.any():
                continue
            j = low + np.flatnonzero(first)
            block = (j - distance) // b * b
            period = j - block
            if self.max_period is not None:
                block, period = block[period <= self.max_period], period[period <= self.max_period]
            if len(self.open_period):
                at = np.minimum(np.searchsorted(self.open_period, period), len(self.open_period) - 1)
                known = (self.open_period[at] == period) & (self.open_start[at] <= block)
                block, period = block[~known], period[~known]
            start = block - self._agree(block + period, period, False)
            stop = block + period + b
            stop += self._agree(stop, period, True)
            going = stop == self.n
            self._report(start[~going], stop[~going], period[~going])
            periods, which = np.unique(np.concatenate([self.open_period, period[going]]), return_index=True)
            self.open_start = np.concatenate([self.open_start, start[going]])[which]
            self.open_period = periods

    def _report(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Squares of one stretch merge into its run of the smallest period."""
        square = end - start >= 2 * period
        for s, e, q in zip(start[square].tolist(), end[square].tolist(), period[square].tolist(), strict=True):
            if q < self.caught.get((s, e), q + 1):
                self.caught[s, e] = q

    def runs(self, least: int = 2) -> list[tuple[int, int, int]]:
        """Runs of ``least`` words or more of what has been appended, by start, then period."""
        now = dict(self.caught)
        for s, q in zip(self.open_start.tolist(), self.open_period.tolist(), strict=True):
            if self.n - s >= 2 * q and q < now.get((s, self.n), q + 1):
                now[s, self.n] = q
        return sorted(((s, e, q) for (s, e), q in now.items() if e - s >= least), key=lambda r: (r[0], r[2]))

    def holds(self, run: tuple[int, int, int]) -> bool:
        """Whether a run's words, and those that stop it, are as told."""
        s, e, q = run
        w = self.words
        return (np.array_equal(w[s:e - q], w[s + q:e]) and (s == 0 or w[s - 1] != w[s - 1 + q])
                and (e == self.n or w[e] != w[e - q]))


def find(ids: np.ndarray, least: int = 12, max_period: int | None = None, slab: int = SLAB) -> list[tuple[int, int, int]]:
    """Verified runs (start, end, period) of a stream of word ids."""
    for salt in count():
        catchers = Catchers(max_period, salt)
        for at in range(0, len(ids), slab):
            catchers.append(ids[at:at + slab])
        found = catchers.runs(least)
        if all(catchers.holds(r) for r in found):
            return found
    raise AssertionError


def runs_of(documents: list[list[bytes]], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document's words; documents share one stream."""
    index: dict[bytes, int] = {}
    longest = max(map(len, documents), default=0)
    ids = np.full(sum(map(len, documents)) + len(documents), -1, np.int64)
    begins, at = [], 0
    for number, words in enumerate(documents):
        begins.append(at)
        ids[at:at + len(words)] = np.fromiter(map(index.setdefault, words, count(at)), np.int64, len(words))
        at += len(words) + 1
        ids[at - 1] = -1 - number  # ends the document: equal to no other word
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if longest >= least:
        places = np.asarray(begins)
        for s, e, q in find(ids, least, longest // 2):
            d = int(np.searchsorted(places, s, "right")) - 1
            out[d].append((s - begins[d], e - s, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside all runs and those of each run's first period, joined by one space."""
    if runs:
        kept = bytearray(b"\1") * len(words)
        for start, length, period in runs:
            kept[start + period:start + length] = bytes(length - period)
        words = [w for w, k in zip(words, kept, strict=True) if k]
    return b" ".join(words)


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
ADDED = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def detect(docs: DataFrame, text: str = "text", least: int = 12) -> DataFrame:
    """``docs`` without its text, with n_words, runs (by start, then period) and the collapsed text.

    A run is a stretch of ``max(least, 2 * period)`` words or more that no
    neighbouring word extends, told with its smallest period. Collapsing keeps
    a run's first period.
    """
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(ADDED)
    rest = [c for c in docs.columns if c != text and c not in added.names]
    schema = StructType([docs.schema[c] for c in rest] + list(added))

    def told(rows: pa.RecordBatch, documents: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(documents, least)
        columns = [pa.array(map(len, documents), pa.int64(), size=len(documents)),
                   pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], RUN),
                   pa.array([collapsed(w, r) for w, r in zip(documents, found, strict=True)], pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], *columns], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin, documents, held = batch.column(batch.num_columns - 1), 0, [], 0
            for i in range(batch.num_rows):
                # bytes split at exactly space and \x09-\x0D
                documents.append((texts[i].as_py() or b"").split())
                held += len(documents[-1])
                if held >= SLAB or i + 1 == batch.num_rows:
                    yield told(batch.slice(begin, i + 1 - begin), documents)
                    begin, documents, held = i + 1, [], 0

    return docs.select(*rest, F.encode(text, "UTF-8").alias("__words")).mapInArrow(run, schema)
