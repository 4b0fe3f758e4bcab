"""Counts of a corpus's n-grams from windows of its lines.

A position's window is its token and the next ones, up to the end of the line.
Each n-gram is a window's first n tokens, so the windows of ``most`` tokens hold
the n-grams of every lower order too: a task numbers the windows of a piece of
its lines in arrays and sends each different one once, and the orders are
counted by cutting the last token off, one after the other.

:func:`gram_counts` counts n-grams that are wanted as such. A task deals the
different ones of a piece to many parts by their hash and sends each part one
compressed row of them; a part counts its rows' n-grams in arrays. With a
:class:`Known` set of the (n-1)-grams only those n-grams are sent that begin and
end with one (and a few more that share its bits: the caller joins to be exact).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.functions.text import cut_ws  # by name: a module that a closure names is sent whole, with its UDFs
from linea.operators.bleu import line_partitions

#: About the most tokens whose windows are numbered together (a longer line is numbered whole).
TOKENS = 1 << 20


def different(tokens: pa.ListArray, most: int) -> pa.RecordBatch:
    """``head, last, words, times`` of the different windows of these lines."""
    sizes = tokens.value_lengths().fill_null(0).to_numpy()
    told = tokens.flatten().dictionary_encode()
    code, ends = told.indices.to_numpy().astype(np.int64), np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(code))
    gram = code
    for n in range(1, most):  # a window is a number: that of its first n words and its next word (0: none)
        there = at + n < ends
        following = np.where(there, code[np.where(there, at + n, 0)] + 1, 0)
        gram = pd.factorize(gram * (len(told.dictionary) + 1) + following)[0]
    first = np.flatnonzero(~pd.Series(gram).duplicated().to_numpy())
    times = np.bincount(gram)[gram[first]]
    word = lambda n: told.dictionary.take(pa.array(code[np.minimum(first + n, len(code) - 1)], mask=first + n >= ends[first]))
    head = pc.binary_join_element_wise(*[word(n) for n in range(max(1, most - 1))], " ", null_handling="skip")
    last = word(most - 1) if most > 1 else pa.nulls(len(first), pa.string())
    words = np.minimum(ends[first] - first, most).astype(np.int32)
    return pa.RecordBatch.from_arrays([head, last, pa.array(words), pa.array(times)], ["head", "last", "words", "times"])


def sent(df: DataFrame, tokens: str) -> Column:
    """The column of tokens as workers get it: arrays without nulls, or texts, which :func:`lists` cuts there."""
    return F.col(tokens) if dict(df.dtypes)[tokens] == "string" else F.array_compact(tokens)


def lists(column: pa.Array) -> pa.ListArray:
    """The tokens of the lines of :func:`sent`."""
    return cut_ws(column) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.ListArray]:
    """The lines of many batches in pieces of about ``TOKENS`` tokens, a line at least."""
    held, size = [], 0
    for batch in batches:
        lines = lists(batch.column(0))
        ends = np.cumsum(lines.value_lengths().fill_null(0).to_numpy())
        at, done = 0, 0
        while at < len(lines):
            to = int(np.searchsorted(ends, done + TOKENS - size, "right"))
            if to <= at and not held:
                to = at + 1
            if to > at:
                held.append(lines[at:to])
                size, at, done = size + int(ends[to - 1]) - done, to, int(ends[to - 1])
            if at < len(lines):
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def windows(df: DataFrame, most: int, tokens: str = "tokens") -> DataFrame:
    """``head, last, words, times``: windows of up to ``most`` tokens that hold no blank.

    ``last`` is the window's token ``most`` (null: the line ends before) and
    ``head`` the tokens before it. A window has a row for each piece it is in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _pieces(batches):
            if len(lines.flatten()):
                yield different(lines, most)

    return df.select(F.array_compact(tokens).alias("t")).mapInArrow(run, "head string, last string, words int, times bigint")


def order_counts(df: DataFrame, most: int = 4, tokens: str = "tokens") -> DataFrame:
    """``n, n_grams, distinct_grams`` of each order up to ``most`` that occurs.

    Windows are dealt by their head: those of ``most`` and ``most - 1`` tokens
    are told apart where they lie, and each lower order meets the different
    n-grams of the order above, with the numbers counted so far.
    """
    w = windows(df, most, tokens)
    w = w.repartition(line_partitions(w), "head").groupBy("head", "last").agg(F.max("words").alias("words"), F.sum("times").alias("times"))
    told: list[str] = []
    for n in range(most, 0, -1):  # a row of a different window of up to n tokens
        whole = F.col("words") == n
        sums = [F.sum(F.when(whole, F.col("times"))).alias(f"all_{n}"), F.sum(whole.cast("bigint")).alias(f"different_{n}"),
                *[F.sum(c).alias(c) for c in told]]
        told += [f"all_{n}", f"different_{n}"]
        if n > 1:
            shorter = F.col("head") if n == most else F.substring_index("head", " ", n - 1)
            w = w.groupBy(shorter.alias("head")).agg(F.max(F.least("words", F.lit(n - 1))).alias("words"), F.sum("times").alias("times"), *sums)
    rows = [F.struct(F.lit(n).alias("n"), F.col(f"all_{n}").alias("n_grams"), F.col(f"different_{n}").alias("distinct_grams")) for n in range(1, most + 1)]
    return w.agg(*sums).select(F.inline(F.array(*rows))).where(F.col("n_grams") > 0)


# --- n-grams by parts ----------------------------------------------------------

#: Most parts that n-grams are dealt to for their memory (more shuffle partitions make more).
PARTS = 1024
#: Bits of a part of a :class:`Known` set, bits for each of its members, and the most bits in all (64 MB).
SLOT, EACH, MOST_BITS = 1 << 23, 16, 1 << 29


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.empty(0, np.uint64)


def joined(before: np.ndarray | None, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams, from those of their first n - 1 words (None: there are none) and their last words."""
    return _mixed(words if before is None else before + words)


class Known:
    """A set of n-grams as bits: it holds all its members, and others by chance."""

    def __init__(self, bits: Broadcast, size: int):
        self.bits, self.size = bits, size

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.size - 1)
        return (self.bits.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def known(grams: DataFrame, column: str = "phrase") -> Known:
    """The set of the n-grams in ``column``, their words joined by blanks. The driver gets its bits, at most ``MOST_BITS``."""
    size = min(MOST_BITS, 1 << max(16, (EACH * grams.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column(0), " ")
            told = words.flatten().dictionary_encode()
            code, ends = word_hashes(told.dictionary)[told.indices.to_numpy()], np.cumsum(words.value_lengths().to_numpy())
            first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            hashes = joined(None, code[first])
            for n in range(1, int((ends - first).max(initial=0))):
                long = first + n < ends
                hashes[long] = joined(hashes[long], code[first[long] + n])
            at = (hashes & np.uint64(size - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // SLOT), pa.array(at % SLOT)], ["slot", "at"])

    def packed(rows: pa.Table) -> pa.Table:
        held = np.zeros(min(size, SLOT), bool)
        held[rows["at"].to_numpy()] = True
        return pa.table({"slot": [rows["slot"][0].as_py()], "bits": [np.packbits(held, bitorder="little").tobytes()]})

    rows = grams.select(column).mapInArrow(run, "slot bigint, at bigint").groupBy("slot").applyInArrow(packed, "slot bigint, bits binary")
    bits = np.zeros(size // 8, np.uint8)
    for row in rows.toLocalIterator():
        part = np.frombuffer(row.bits, np.uint8)
        bits[row.slot * (SLOT // 8):][:len(part)] = part
    return Known(grams.sparkSession.sparkContext.broadcast(bits), size)


def _told(tokens: pa.ListArray, orders: tuple[int, ...], before: Known | None, parts: int) -> pa.RecordBatch:
    """``part, n, size, data``: the different n-grams of these lines, a compressed row for each part and order that has some."""
    sizes = tokens.value_lengths().fill_null(0).to_numpy()
    told = tokens.flatten().dictionary_encode()
    words, kinds = told.dictionary, len(told.dictionary)
    code, ends = told.indices.to_numpy().astype(np.int64), np.repeat(np.cumsum(sizes), sizes)
    hashed, out = word_hashes(words), []
    for n in orders:
        at = np.flatnonzero(np.arange(len(code)) + n <= ends)
        hashes = joined(None, hashed[code])  # of the n-gram that starts here, and of the (n-1)-gram before
        if before is None:
            hashes = hashes[at]
            for j in range(1, n):
                hashes = joined(hashes, hashed[code[at + j]])
        else:
            for j in range(1, n - 1):
                hashes = joined(hashes, hashed[code[np.minimum(np.arange(len(code)) + j, len(code) - 1)]])
            held = before.holds(hashes)
            at = at[held[at]]
            at = at[held[at + 1]]
            hashes = joined(hashes[at], hashed[code[at + n - 1]])
        if not len(at):
            continue
        gram = code[at]
        for j in range(1, n):
            gram = pd.factorize(gram * kinds + code[at + j])[0]
        first = np.flatnonzero(~pd.Series(gram).duplicated().to_numpy())
        times = np.bincount(gram)[gram[first]]
        part = (hashes[first] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part * kinds + code[at[first]], kind="stable")  # equal first words side by side
        first, times, part = at[first][order], times[order], part[order]
        text = words.take(pa.array(code[first]))
        if n > 1:
            text = pc.binary_join_element_wise(text, *[words.take(pa.array(code[first + j])) for j in range(1, n)], " ")
        lengths = pc.binary_length(text).to_numpy()
        data, stop = memoryview(text.buffers()[2] or b""), np.concatenate([[0], np.cumsum(lengths)])
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, z in zip(cuts, cuts[1:], strict=False):
            numbers = [x.astype(np.min_scalar_type(int(x.max()))) for x in (times[a:z], lengths[a:z])]
            raw = np.array([z - a, *[x.itemsize for x in numbers]], np.int32).tobytes() + b"".join(x.tobytes() for x in numbers) + bytes(data[stop[a]:stop[z]])
            out.append((int(part[a]), n, len(raw), pa.compress(raw, "zstd", asbytes=True)))
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                                      ["part", "n", "size", "data"])


def _untold(size: int, data: bytes) -> tuple[np.ndarray, pa.Array]:
    """(times, n-grams) of a compressed row."""
    raw = pa.decompress(data, size, "zstd")
    rows, *widths = np.frombuffer(raw, np.int32, 3).tolist()
    times = np.frombuffer(raw, f"u{widths[0]}", rows, 12).astype(np.int64)
    lengths = np.frombuffer(raw, f"u{widths[1]}", rows, 12 + rows * widths[0])
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return times, pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(ends), raw.slice(12 + rows * sum(widths))])


def gram_counts(df: DataFrame, orders: tuple[int, ...], tokens: str = "tokens", least: int = 1, before: Known | None = None) -> DataFrame:
    """``gram, n, cnt``: the n-grams of the ``orders`` (words joined by blanks; they hold none) that occur ``least`` times.

    ``tokens`` are arrays, or texts whose tokens are those of ``split_ws``. Single tokens are all kept. ``before``: only n-grams that begin and end with an (n-1)-gram it holds are counted.
    """
    conf = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    parts = max(conf, min(PARTS, 16 * conf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _pieces(batches):
            yield _told(lines, orders, before, parts)

    def counted(rows: pa.Table) -> pa.Table:
        out = []
        for n in orders:
            mine = rows.filter(pc.equal(rows["n"], n))
            if len(mine):
                times, grams = zip(*map(_untold, mine["size"].to_pylist(), mine["data"].to_pylist()), strict=True)
                told = pa.chunked_array(grams).combine_chunks().dictionary_encode()
                counts = np.bincount(told.indices.to_numpy(), np.concatenate(times), len(told.dictionary)).astype(np.int64)
                full = counts >= (least if n > 1 else 1)
                kept = told.dictionary.filter(pa.array(full)).cast(pa.string())
                out.append(pa.table([kept, pa.repeat(pa.scalar(n, pa.int32()), len(kept)), pa.array(counts[full])], ["gram", "n", "cnt"]))
        return pa.concat_tables(out)

    rows = df.select(sent(df, tokens).alias("t")).mapInArrow(run, "part bigint, n int, size bigint, data binary")
    return rows.repartition(line_partitions(rows), "part").groupBy("part").applyInArrow(counted, "gram string, n int, cnt bigint")
