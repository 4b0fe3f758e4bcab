"""Paired bootstrap significance tests (E11, E12) over additive line statistics.

Every metric here is a function of *sums* of per-line statistics (BLEU: 10
counts; accuracy: matches; Pearson: centred moments), so a resample never
re-scores text: it sums the statistics of the drawn lines.

The draws are a multinomial split. Lines 0..n-1 lie in ``R = 2^k`` ranges of
``S = ceil(n / R)`` places (``S <= SPAN``; the last ranges may end in empty
places), and up to ``2^FOLD`` neighbouring ranges are a part. Plan::

    range(B) --deal: fair binomials down the upper levels of a tree--> (b, part, count), B x parts rows
    stats    --part = n div (S 2^FOLD)--> at most S 2^FOLD rows a part
    both meet by part: a part goes on down its own levels, and each of its ranges
       draws its places next to its statistics
       --> B rows of partial sums a part --> summed in the task --> exchange --> one row a sample

A fair binomial is the number of ones in as many random bits. A draw that hits
an empty place is drawn again from all lines: about one in S draws at most. Only
the last ranges have such places, so these draws are made where the counts are
dealt, and a part gets its own beside its count. So every draw is uniform over the
lines, and no relation of ``B x m`` or ``B x R`` rows is made.

Random words come from a counter-based mixer of 64-bit integers, so results are
reproducible, independent of partitions, and the same numbers come out of the
SQL twin. ``stats`` needs a dense 0-based ``n`` (see
:func:`linea.operators.positional.dense_index`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SEED = 12345
#: Most lines of a range.
SPAN = 4096
#: Increment and multipliers of the 64-bit mixer (splitmix64).
STEP, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: Samples or words handled together in a task: what a core's cache holds.
CHUNK, WORDS = 256, 1 << 16
#: Samples whose places are drawn together, and whose weights meet the statistics together.
DRAWN, MET = 8, 64
#: Levels of the tree within a part, and levels above the parts that are dealt in any case (for their number).
FOLD, LEAST = 4, 7


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def stream_key(seed: int, b: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Key of the random words of sample ``b`` at a node of the split (1 is the root, 2i and 2i + 1 are below i)."""
    step = np.uint64(STEP)
    return mix(mix(np.uint64(seed) + (b.astype(np.uint64) + np.uint64(1)) * step) + node.astype(np.uint64) * step)


def layout(n: int, span: int = SPAN) -> tuple[int, int]:
    """(levels k, places S of a range) for n lines."""
    k = max(0, (max(n, 1) - 1) // span).bit_length() if n > span else 0
    return k, -(-n // (1 << k))


def split(seed: int, samples: np.ndarray, m: int | np.ndarray, k: int, node: int = 1) -> np.ndarray:
    """Draws of each range below ``node`` (columns) for each sample (rows): m fair choices of a side, k times over."""
    counts = np.full(len(samples), m, np.int64).reshape(-1, 1)
    for level in range(k):
        nodes = (node << level) + np.arange(1 << level)
        keys = stream_key(seed, np.repeat(samples, len(nodes)), np.tile(nodes, len(samples)))
        left = _ones(keys, counts.ravel()).reshape(counts.shape)
        counts = np.stack([left, counts - left], 2).reshape(len(samples), -1)
    return counts


def _ones(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Ones among the first ``bits`` random bits of each key, a row of words a key, about WORDS words at a time."""
    out, words = np.zeros(len(keys), np.int64), (bits + 63) // 64
    rows = max(1, WORDS // max(1, int(words.max(initial=0))))
    for at in range(0, len(keys), rows):
        part = slice(at, at + rows)
        least, most = int(words[part].min()) - 1, int(words[part].max())
        for first in range(0, most, WORDS):
            count = np.arange(first, min(first + WORDS, most))
            drawn = mix(keys[part, None] + (count + 1).astype(np.uint64) * np.uint64(STEP))
            ends = slice(max(0, least - first), None)  # from here on a row's words may be cut or over
            spare = 64 - (bits[part, None] - 64 * count[ends])
            drawn[:, ends] = np.where(spare < 64, drawn[:, ends] >> np.clip(spare, 0, 63).astype(np.uint64), np.uint64(0))
            out[part] += np.bitwise_count(drawn).sum(1, dtype=np.int64)
    return out


def places(seed: int, b: int, node: int, count: int, size: int, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places drawn in a range of ``size`` places of which ``rows`` hold a line, lines drawn anew from all n)."""
    _, drawn, _, anew = many_places(seed, np.array([b]), node, np.array([count]), size, rows, n)
    return drawn, anew


def many_places(seed: int, b: np.ndarray, node: int, counts: np.ndarray, size: int, rows: int,
                n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The draws of several samples in one range: (position in ``b``, place) of each, (position, line) of those drawn anew.

    Two draws a word, from its upper and its lower half.
    """
    count = (counts + 1) // 2
    which = np.repeat(np.arange(len(b)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    words = mix(stream_key(seed, b, np.array([node]))[which] + (at + 1).astype(np.uint64) * np.uint64(STEP))
    halves = np.stack([words >> np.uint64(32), words & np.uint64(0xFFFFFFFF)], 1).ravel()
    drawn = ((halves * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
    owner, kept = np.repeat(which, 2), np.ones(len(drawn), bool)
    kept[2 * np.cumsum(count)[counts % 2 == 1] - 1] = False  # an odd number of draws leaves its last half
    if rows == size:
        return owner[kept], drawn[kept], np.empty(0, np.int64), np.empty(0, np.int64)
    empty = np.flatnonzero(kept & (drawn >= rows))
    anew = mix(words[empty // 2] + (empty % 2 + 1).astype(np.uint64) * np.uint64(STEP))
    kept &= drawn < rows
    return owner[kept], drawn[kept], owner[empty], _below(anew, n)


def _below(x: np.ndarray, n: int) -> np.ndarray:
    """``x * n >> 64``, by the 32-bit halves of ``x``."""
    if n >> 32:
        return np.array([(int(v) * n) >> 64 for v in x], np.int64)
    low = (x & np.uint64(0xFFFFFFFF)) * np.uint64(n) >> np.uint64(32)
    return ((x >> np.uint64(32)) * np.uint64(n) + low >> np.uint64(32)).astype(np.int64)


def hits(seed: int, b: np.ndarray, node: int, counts: np.ndarray, size: int, owner: np.ndarray, more: np.ndarray,
         kind=np.float64) -> Iterator[tuple[slice, np.ndarray]]:
    """How often each sample draws each place of a range, ``MET`` samples at a time: (samples, samples x places).

    The draws are those of :func:`many_places`, in any order. ``more`` are further places, of the samples at the
    positions ``owner`` (sorted).
    """
    keys, half = stream_key(seed, b, np.array([node])), np.uint64(0xFFFFFFFF)
    out = np.empty((MET, size), kind)
    step = max(1, min(DRAWN, WORDS // max(1, int(counts.max(initial=0)))))
    for first in range(0, len(b), MET):
        last = min(first + MET, len(b))
        for at in range(first, last, step):
            c = counts[at:min(at + step, last)]
            k, words = len(c), int(c.max() + 1) // 2
            a, z = np.searchsorted(owner, [at, at + k])
            flat = np.empty(2 * k * words + z - a, np.uint64)
            flat[2 * k * words:] = (owner[a:z] - at) * size + more[a:z]
            both = flat[:2 * k * words].reshape(2, k, words)  # upper halves, lower halves
            x, y = both
            np.add(keys[at:at + k, None], np.arange(1, words + 1, dtype=np.uint64) * np.uint64(STEP), out=x)
            for shift, factor in ((30, MIX_A), (27, MIX_B)):  # mix, in place
                np.right_shift(x, np.uint64(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                np.multiply(x, np.uint64(factor), out=x)
            np.right_shift(x, np.uint64(31), out=y)
            np.bitwise_xor(x, y, out=x)
            np.bitwise_and(x, half, out=y)
            np.right_shift(x, np.uint64(32), out=x)
            np.multiply(both, np.uint64(size), out=both)
            np.right_shift(both, np.uint64(32), out=both)
            np.add(both, (np.arange(k) * size).astype(np.uint64)[:, None], out=both)
            for i, count in enumerate(c.tolist()):  # a row's words beyond its draws
                x[i, (count + 1) // 2:] = k * size
                y[i, count // 2:] = k * size
            out[at - first:at - first + k] = np.bincount(flat.view(np.int64), minlength=k * size + 1)[:-1].reshape(k, size)
        yield slice(first, last), out[:last - first]


def pieces(counts: np.ndarray, many: int) -> Iterator[slice]:
    """Stretches of at most ``CHUNK`` samples with at most ``many`` draws in all (or one sample)."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + many, "right"))
        to = min(max(at + 1, to), at + CHUNK, len(counts))
        yield slice(at, to)
        at = to


def deal(spark: SparkSession, n: int, samples: int, m: int, seed: int = DEFAULT_SEED, span: int = SPAN) -> DataFrame:
    """``b, r, count``: how many of sample b's m draws fall into range r (ranges without a draw are left out)."""
    k, _ = layout(n, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy()
            for part in pieces(np.full(len(every), 1 << k), WORDS):  # as many counts at once as words
                b = every[part]
                counts = split(seed, b, m, k)
                i, r = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(b[i]), pa.array(r), pa.array(counts[i, r])], ["b", "r", "count"])

    return spark.range(0, samples, 1, max(1, spark.sparkContext.defaultParallelism)).mapInArrow(run, "b bigint, r bigint, count bigint")


def deal_parts(spark: SparkSession, n: int, samples: int, m: int, top: int, seed: int = DEFAULT_SEED, span: int = SPAN) -> DataFrame:
    """``part, b, count, anew``: as :func:`deal` for the 2^top parts, with the lines of a part (from its first) that sample b draws anew."""
    k, size = layout(n, span)
    low = k - top

    def again(b: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in b, line) of the draws that hit an empty place: all lie in the last ranges."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if n < size << k:
            for part in range(n // size >> low, 1 << top):
                below = split(seed, b, counts[:, part], low, (1 << top) + part)
                for r in range(max(n // size, part << low), (part + 1) << low):
                    here = below[:, r - (part << low)]
                    for piece in pieces(here, WORDS):
                        empty, lines = many_places(seed, b[piece], (1 << k) + r, here[piece], size, max(0, n - r * size), n)[2:]
                        found.append((empty + piece.start, lines))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy()
            for piece in pieces(np.full(len(every), 1 << top), WORDS):
                b = every[piece]
                counts = split(seed, b, m, top)
                owner, lines = again(b, counts)
                key = (owner << top) + lines // (size << low)
                order = np.argsort(key, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=counts.size))])
                anew = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((lines % (size << low))[order], pa.int32()))
                out = pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(1 << top), len(b))), pa.array(np.repeat(b, 1 << top)),
                                                  pa.array(counts.ravel()), anew], ["part", "b", "count", "anew"])
                yield out.filter(pa.array((counts.ravel() > 0) | (np.diff(ends) > 0)))

    return spark.range(0, samples, 1, max(1, spark.sparkContext.defaultParallelism)).mapInArrow(
        run, "part bigint, b bigint, count bigint, anew array<int>")


def draws(spark: SparkSession, n: int, samples: int, m: int, seed: int = DEFAULT_SEED, span: int = SPAN) -> DataFrame:
    """``b, idx``: the draws themselves, one row each. For tests and looks at single samples: nothing here builds on it."""
    k, size = layout(n, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, r, count in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                drawn, anew = places(seed, b, (1 << k) + r, count, size, max(0, min(size, n - r * size)), n)
                idx = np.concatenate([drawn + r * size, anew])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(idx), b)), pa.array(idx)], ["b", "idx"])

    return deal(spark, n, samples, m, seed, span).mapInArrow(run, "b bigint, idx bigint")


def resample_sums(stats: DataFrame, cols: list[str], samples: int, m: int | None = None,
                  seed: int = DEFAULT_SEED, n: int | None = None, index: str = "n",
                  include_full: bool = False, span: int = SPAN) -> DataFrame:
    """``b`` and the sum of each statistic column over the lines drawn for sample b.

    ``include_full`` adds sample ``b = -1`` holding every line once (the
    full-corpus score). Sums of integers are exact up to 2^53.
    """
    spark = stats.sparkSession
    n = n if n is not None else stats.count()
    if n == 0:
        raise ValueError("bootstrap over an empty input")
    m = m if m is not None else n
    k, size = layout(n, span)
    top = max(k - FOLD, min(k, LEAST))
    low, wide = k - top, size << (k - top)
    whole = [c for c in cols if dict(stats.dtypes)[c] in ("tinyint", "smallint", "int", "bigint")]
    held = stats.select(F.col(index).alias("idx"), *cols)
    schema = "b bigint, " + ", ".join(f"`{c}` double" for c in cols)

    def drawn(dealt: pa.Table, lines: pa.Table) -> pa.Table:
        """A part's sums of each sample."""
        b, counts = dealt["b"].to_numpy(), dealt["count"].to_numpy()
        sums = np.zeros((len(b), len(cols)))
        if len(b):
            part = dealt["part"][0].as_py()
            values = np.zeros((max(0, min(wide, n - part * wide)), len(cols)))
            at = lines["idx"].to_numpy() - part * wide
            for j, c in enumerate(cols):
                values[at, j] = lines[c].to_numpy()
            lists = dealt["anew"].combine_chunks()
            owner, anew = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy().astype(np.int64)
            below = split(seed, b, counts, low, (1 << top) + part)
            for i in range(1 << low):
                held_here = values[i * size:(i + 1) * size]
                if not len(held_here):
                    continue  # empty places only
                mine = anew // size == i
                more = np.bincount(owner[mine], minlength=len(b))
                # whole numbers that stay below 2^24 are exact in single precision
                short = float(np.abs(held_here).max()) * int((below[:, i] + more).max()) < 1 << 24 and not np.any(held_here % 1)
                kind = np.float32 if short else np.float64
                held_here = held_here.astype(kind)
                for some, weights in hits(seed, b, (1 << k) + (part << low) + i, below[:, i], size, owner[mine], anew[mine] % size, kind):
                    sums[some] += weights[:, :len(held_here)] @ held_here
        return pa.Table.from_arrays([pa.array(b), *(pa.array(sums[:, j]) for j in range(len(cols)))], ["b", *cols])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 4 * spark.sparkContext.defaultParallelism)
    tasks = min(tasks, 1 << top)  # the work of a part is its draws, not its bytes: AQE must not put parts together
    dealt = deal_parts(spark, n, samples, m, top, seed, span).repartition(tasks, "part")
    by_part = held.withColumn("part", F.floor(F.col("idx") / wide).cast("bigint")).repartition(tasks, "part")
    rows = dealt.groupBy("part").cogroup(by_part.groupBy("part")).applyInArrow(drawn, schema)
    doubles = [F.col(c).cast("double").alias(c) for c in cols]
    if include_full:
        rows = rows.unionByName(held.select(F.lit(-1).cast("bigint").alias("b"), *doubles))
    sums = rows.groupBy("b").agg(*[F.sum(c).alias(c) for c in cols])
    return sums.select("b", *[F.round(c).cast("bigint").alias(c) if c in whole else F.col(c) for c in cols])


def compare_bleu(stats_a: DataFrame, stats_b: DataFrame, score, samples: int = 1000,
                 m: int | None = None, seed: int = DEFAULT_SEED, index: str = "n",
                 line: str = "line_id", stat_cols: list[str] | None = None) -> DataFrame:
    """Paired bootstrap of two systems scored from summed statistics.

    ``score(prefix)`` builds the corpus score from columns ``prefix + stat``.
    One output row: full-corpus scores, delta, the three tallies and the two
    confidences (count / samples).
    """
    cols = stat_cols
    both = stats_a.select(line, index, *[F.col(c).alias("a_" + c) for c in cols]).join(
        stats_b.select(line, *[F.col(c).alias("b_" + c) for c in cols]), line)
    return compare_paired(both, score, samples, m, seed, index, cols)


def compare_paired(both: DataFrame, score, samples: int = 1000, m: int | None = None,
                   seed: int = DEFAULT_SEED, index: str = "n", stat_cols: list[str] | None = None) -> DataFrame:
    """E11 on one table holding both systems' statistics as ``a_<stat>``, ``b_<stat>``."""
    allc = ["a_" + c for c in stat_cols] + ["b_" + c for c in stat_cols]
    sums = resample_sums(both, allc, samples, m, seed, None, index, include_full=True)
    per = sums.select("b", score("a_").alias("sa"), score("b_").alias("sb"))
    rs = F.col("b") >= 0
    sa, sb = F.col("sa"), F.col("sb")
    t = per.agg(
        F.max(F.when(~rs, sa)).alias("baseline"), F.max(F.when(~rs, sb)).alias("new"),
        F.sum(F.when(rs & (sb > sa), 1).otherwise(0)).cast("bigint").alias("new_better"),
        F.sum(F.when(rs & (sa > sb), 1).otherwise(0)).cast("bigint").alias("baseline_better"),
        F.sum(F.when(rs & ~((sa > sb) | (sb > sa)).eqNullSafe(True), 1).otherwise(0))
        .cast("bigint").alias("num_equal"))
    return t.select(
        F.round("baseline", 6).alias("baseline_bleu"), F.round("new", 6).alias("new_bleu"),
        F.round(F.col("new") - F.col("baseline"), 6).alias("delta"),
        F.lit(samples).cast("bigint").alias("num_samples"),
        "baseline_better", "num_equal", "new_better",
        F.round(F.col("baseline_better") / samples, 6).alias("baseline_conf"),
        F.round(F.col("new_better") / samples, 6).alias("new_conf"))


def report(sums: DataFrame, s1: Column, s2: Column, samples: int, digits: int = 6) -> DataFrame:
    """E12 summary over per-sample scores: win ratios, p-value, mean, median and
    the 95% interval ``sorted[int(.025B)]``, ``sorted[int(.975B)]`` (0-based).

    Holds at most B scores per system in one group: bounded by the parameter B.
    """
    per = sums.select(s1.alias("s1"), s2.alias("s2"))
    lo, hi = int(samples * 0.025) + 1, int(samples * 0.975) + 1
    a = per.agg(
        (F.sum(F.when(F.col("s1") > F.col("s2"), 1).otherwise(0)) / samples).alias("win_sys1"),
        (F.sum(F.when(F.col("s2") > F.col("s1"), 1).otherwise(0)) / samples).alias("win_sys2"),
        F.avg("s1").alias("sys1_mean"), F.median("s1").alias("sys1_median"),
        F.element_at(F.sort_array(F.collect_list("s1")), lo).alias("sys1_lo"),
        F.element_at(F.sort_array(F.collect_list("s1")), hi).alias("sys1_hi"),
        F.avg("s2").alias("sys2_mean"), F.median("s2").alias("sys2_median"),
        F.element_at(F.sort_array(F.collect_list("s2")), lo).alias("sys2_lo"),
        F.element_at(F.sort_array(F.collect_list("s2")), hi).alias("sys2_hi"))
    tie = 1 - F.col("win_sys1") - F.col("win_sys2")
    p = F.when(F.col("win_sys1") > F.col("win_sys2"), 1 - F.col("win_sys1")) \
        .when(F.col("win_sys2") > F.col("win_sys1"), 1 - F.col("win_sys2"))
    r = lambda c: F.round(c, digits)
    return a.select(r(F.col("win_sys1")).alias("win_sys1"), r(F.col("win_sys2")).alias("win_sys2"),
                    r(tie).alias("win_tie"), r(p).alias("p_value"),
                    *[r(F.col(f"{s}_{k}")).alias(f"{s}_{k}")
                      for s in ("sys1", "sys2") for k in ("mean", "median", "lo", "hi")])
