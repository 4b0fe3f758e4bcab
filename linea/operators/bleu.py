"""Corpus BLEU and its per-sentence sufficient statistics.

Plan shape (``sentence_stats`` / ``corpus_totals``)::

    lines --clipped n-gram counts of a line, batch by batch (no shuffle)
          --> one row of 10 numbers a line --> partial sums --> one row a group

A line's n-grams never leave its task: they are numbered and counted in arrays
of a batch (:func:`ngram_counts`), so nothing grows with the n-grams but time.

Input is wide: one row per line with ``hyp`` tokens and ``refs`` (an array
of token arrays, one per reference).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAT_COLS = ([f"correct_{n}_grams" for n in range(1, 5)]
             + [f"total_{n}_grams" for n in range(1, 5)]
             + ["translation_length", "reference_length"])


def closest_ref_length(hyp_len: Column, refs: Column, ties: str = "first") -> Column:
    """Closest reference length; ties go to the first reference or the shorter one."""
    return _closest(hyp_len, F.transform(refs, F.size), ties)


def _closest(hyp_len: Column, lengths: Column, ties: str) -> Column:
    if ties == "first":
        cand = F.transform(lengths, lambda r, i: F.named_struct(
            F.lit("d"), F.abs(hyp_len - r), F.lit("i"), i, F.lit("l"), r))
    elif ties == "shorter":
        cand = F.transform(lengths, lambda r: F.named_struct(
            F.lit("d"), F.abs(hyp_len - r), F.lit("l"), r))
    else:
        raise ValueError(ties)
    return F.coalesce(F.array_min(cand)["l"], F.lit(0)).cast("bigint")


def line_partitions(df: DataFrame) -> int:
    """Partitions for the line shuffle: an explicit count (AQE does not coalesce
    it). The shuffled text is small next to the n-gram work that follows it, so
    byte-based coalescing would starve that work of tasks; use the configured
    shuffle partitions, but at least four tasks per core for load balance over
    lines of uneven length."""
    spark = df.sparkSession
    conf = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(conf, 4 * spark.sparkContext.defaultParallelism)


#: Characters whose n-grams are numbered together: the tables of a part stay in a core's cache.
PART = 1 << 19


def ngram_counts(sides: pa.ListArray, systems: int) -> np.ndarray:
    """Clipped and all n-grams of each line: lines x systems x (4 correct, 4 total).

    A line's ``sides`` are space-joined tokens: one of each system, then the
    references. An empty token (two blanks) breaks an n-gram.
    """
    texts, offsets = sides.flatten(), sides.value_lengths().fill_null(0).to_numpy()
    ends = np.cumsum(offsets)
    size = np.concatenate([[0], np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())])[ends]
    out, at = np.empty((len(sides), systems, 8), np.int64), 0
    while at < len(sides):  # lines of PART bytes, one line at least
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PART, "right")))
        first = ends[at - 1] if at else 0
        out[at:to] = _part_counts(texts[first:ends[to - 1]], offsets[at:to], systems)
        at = to
    return out


def _part_counts(texts: pa.Array, lengths: np.ndarray, systems: int) -> np.ndarray:
    words = pc.split_pattern(texts.fill_null(""), " ")
    told = words.flatten().dictionary_encode()
    code, text = told.indices.to_numpy(), np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
    full = code != told.dictionary.index("").as_py()
    run = np.cumsum(~full) + text  # a new run at an empty token and at a new text
    return _numbered(code[full].astype(np.int64), text[full], run[full], len(told.dictionary), lengths, systems)


def _numbered(code: np.ndarray, text: np.ndarray, run: np.ndarray, kinds: int, lengths: np.ndarray, systems: int) -> np.ndarray:
    """The counts of tokens that are numbers below ``kinds``: ``text`` numbers the sides of all lines, n-grams lie within a ``run``."""
    lines = len(lengths)
    line = np.repeat(np.arange(lines), lengths)
    side = np.arange(len(line)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out, start, gram = np.zeros((lines, systems, 8), np.int64), np.arange(len(code)), line[text]
    for n in range(4):  # an n-gram is a number: that of its first n - 1 words (a line's own) and its last word
        if n:
            whole = run[start] == run[np.minimum(start + n, len(run) - 1)]
            whole &= start + n < len(run)
            start, gram = start[whole], gram[whole]
        gram, grams = pd.factorize(gram * kinds + code[start + n])
        of, at = line[text[start]], side[text[start]]
        home, clip = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        home[gram] = of
        for k in range(systems, int(at.max(initial=0)) + 1):
            clip = np.maximum(clip, np.bincount(gram[at == k], minlength=len(grams)))
        for s in range(systems):
            mine = at == s
            out[:, s, n] = np.bincount(home, np.minimum(np.bincount(gram[mine], minlength=len(grams)), clip), lines)
            out[:, s, 4 + n] = np.bincount(of[mine], minlength=lines)
    return out


#: About the most tokens whose n-grams are numbered together where texts are cut here (:func:`cut_counts`).
TOKENS = 1 << 16


def cut_counts(sides: pa.ListArray, systems: int, cut) -> tuple[np.ndarray, np.ndarray]:
    """(:func:`ngram_counts`, tokens of each side) of texts that ``cut`` cuts (:class:`linea.functions.text.Cut`)."""
    offsets = sides.value_lengths().fill_null(0).to_numpy()
    code, sizes, kinds = cut.numbered(sides.flatten())
    stop, lines = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([[0], np.cumsum(offsets)])
    ends = stop[lines]  # tokens up to each line
    out, at = np.empty((len(sides), systems, 8), np.int64), 0
    while at < len(sides):  # lines of TOKENS tokens, one line at least
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOKENS, "right")) - 1)
        text = np.repeat(np.arange(lines[to] - lines[at]), sizes[lines[at]:lines[to]])
        out[at:to] = _numbered(code[ends[at]:ends[to]], text, text, kinds, offsets[at:to], systems)
        at = to
    return out, sizes


def _counts(sides: Column, systems: int = 1) -> Column:
    """``array<bigint>``: the eight counts of each system in turn (:func:`ngram_counts`)."""
    def run(sides: pa.Array) -> pa.Array:
        flat = ngram_counts(sides, systems)
        ends = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * (8 * systems), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(flat.ravel(), pa.int64()))

    return F.arrow_udf(run, "array<bigint>")(sides)


def _cut_counts(sides: Column, systems: int, cut) -> Column:
    """``array<bigint>``: as :func:`_counts`, then the number of tokens of each side."""
    def run(sides: pa.Array) -> pa.Array:
        counts, sizes = cut_counts(sides, systems, cut)
        ends = np.cumsum(sides.value_lengths().fill_null(0).to_numpy())
        flat = np.insert(sizes, np.repeat(np.concatenate([[0], ends[:-1]]), 8 * systems) if len(ends) else [], counts.ravel())
        stops = np.concatenate([[0], ends + 8 * systems * np.arange(1, len(ends) + 1)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(stops), pa.array(flat, pa.int64()))

    return F.arrow_udf(run, "array<bigint>")(sides)


def _declared(refs: str, limit: int | None) -> Column:
    """``refs``, raising for a line with more references than the caller declared."""
    if not limit:
        return F.col(refs)
    err = F.raise_error(F.concat(F.lit(f"more than {limit} reference(s) on a line: "), F.size(refs).cast("string")))
    return F.when(F.size(refs) > limit, err).otherwise(F.col(refs)).alias(refs)


def _line_stats(df: DataFrame, keys: list[str], hyps: list[str], refs: str, ties: str, n_refs: int | None,
                prefixes: tuple[str, ...] = ("",), cut=None) -> DataFrame:
    """``keys`` and the statistics of each of the ``hyps``, row by row; the references are cut and counted once.

    With ``cut`` the sides are texts, which it cuts where they are counted.
    """
    base = df.select(*keys, *hyps, _declared(refs, n_refs))
    at = lambda i: F.get("__c", F.lit(i))
    if cut is not None:
        many = len(hyps)
        sides = F.concat(F.array(*[F.col(h) for h in hyps]), F.coalesce(F.col(refs), F.array().cast("array<string>")))
        c = base.select(*keys, _cut_counts(sides, many, cut).alias("__c"))
        lengths = F.slice("__c", 9 * many + 1, F.greatest(F.size("__c") - 9 * many, F.lit(0)))
        return c.select(*keys, *[col for i, name in enumerate(prefixes) for col in (
            *[at(8 * i + j).alias(name + STAT_COLS[j]) for j in range(8)], at(8 * many + i).alias(name + STAT_COLS[8]),
            _closest(at(8 * many + i), lengths, ties).alias(name + STAT_COLS[9]))])
    text = lambda c: F.coalesce(F.array_join(c, " "), F.lit(""))
    refs_text = F.coalesce(F.transform(F.col(refs), text), F.array().cast("array<string>"))
    lengths = []
    for name, h in zip(prefixes, hyps, strict=True):
        hl = F.size(F.col(h)).cast("bigint")
        lengths += [F.coalesce(hl, F.lit(0).cast("bigint")).alias(f"{name}translation_length"),
                    closest_ref_length(hl, F.col(refs), ties).alias(f"{name}reference_length")]
    sides = F.concat(F.array(*[text(F.col(h)) for h in hyps]), refs_text)
    c = base.select(*keys, *lengths, _counts(sides, len(hyps)).alias("__c"))
    return c.select(*keys, *[col for i, name in enumerate(prefixes) for col in (
        *[at(8 * i + j).alias(name + STAT_COLS[j]) for j in range(8)], *[F.col(name + x) for x in STAT_COLS[8:]])])


def sentence_stats(df: DataFrame, line: str = "line_id", hyp: str = "hyp", refs: str = "refs",
                   ties: str = "first", keys: list[str] | None = None,
                   multi_ref: bool = True, n_refs: int | None = None) -> DataFrame:
    """Per-line sufficient statistics (10 BIGINT columns).

    ``multi_ref=False`` declares exactly one reference per line and
    ``n_refs`` an upper bound on the number of references (the number of
    reference files). A line with more references than declared raises.
    """
    return _line_stats(df, [*(keys or []), line], [hyp], refs, ties, n_refs if multi_ref else 1)


def corpus_totals(df: DataFrame, line: str = "line_id", hyp: str = "hyp", refs: str = "refs",
                  ties: str = "first", keys: list[str] | None = None,
                  multi_ref: bool = True, n_refs: int | None = None) -> DataFrame:
    """Summed statistics per ``keys`` group (global when no keys)."""
    return _summed(_line_stats(df, [*(keys or []), line], [hyp], refs, ties, n_refs if multi_ref else 1), keys)


def _summed(stats: DataFrame, keys: list[str] | None) -> DataFrame:
    """:func:`sum_stats`, zero instead of null where there is no line."""
    total = sum_stats(stats, keys)
    return total.select(*(keys or []), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in STAT_COLS])


def sum_stats(stats: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    aggs = [F.sum(c).cast("bigint").alias(c) for c in STAT_COLS]
    return stats.groupBy(*keys).agg(*aggs) if keys else stats.agg(*aggs)


# --- many systems against the same references ---------------------------------

def many_totals(hyps: DataFrame, refs: DataFrame, systems: list, system: str = "system", hyp: str = "hyp", ref: str = "ref",
                line: str = "line_id", keys: list[str] | None = None) -> DataFrame:
    """Summed statistics per ``keys`` and system, the references cut and counted once.

    ``hyps``: ``keys, line, system, hyp`` (tokens); ``refs``: ``keys, line,
    ref`` (tokens). Both sides meet in one shuffle by line; a line becomes one
    row with its reference and a text of each of the ``systems``, so all clips
    read the same reference counts. A line that a system or the references
    lack, or hold twice, raises.
    """
    keys, many = keys or [], len(systems)
    index = F.array_position(F.array(*[F.lit(x) for x in systems]), F.col(system)).cast("int") - 1
    side = lambda df, k, c: df.select(*keys, line, k.alias("side"), F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias("len"),
                                      F.coalesce(F.array_join(c, " "), F.lit("")).alias("s"))
    both = side(hyps, index, hyp).unionByName(side(refs, F.lit(many), ref))
    both = both.repartition(line_partitions(both), *keys, line)
    of = lambda k, c: F.max(F.when(F.col("side") == k, F.col(c)))
    lines = both.groupBy(*keys, line).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[of(k, "s") for k in range(many + 1)]).alias("sides"),
        F.array(*[of(k, "len") for k in range(many + 1)]).alias("lens"))
    uneven = (F.col("rows") != many + 1) | F.exists("sides", lambda s: s.isNull())
    err = F.raise_error(F.concat(F.lit("hypotheses and references differ at line "), F.col(line).cast("string")))
    counts = lines.select(*keys, "lens", _counts(F.when(uneven, err).otherwise(F.col("sides")), many).alias("c"))
    one = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), *[F.get("c", F.lit(8 * k + j)).alias(STAT_COLS[j]) for j in range(8)],
                                      F.get("lens", F.lit(k)).alias("translation_length"),
                                      F.get("lens", F.lit(many)).alias("reference_length")) for k in range(many)]))
    sums = sum_stats(counts.select(*keys, one), [*keys, "k"])
    name = F.array(*[F.lit(x) for x in systems])
    return sums.select(*keys, F.get(name, F.col("k")).alias(system), *STAT_COLS)


# --- finalisation (E3, E4, E8, E10) -----------------------------------------

def _safe_log(x: Column) -> Column:
    # log of 0 contributes -9999999999, which makes the geometric mean 0;
    # an undefined precision (no n-grams of that order) stays NULL.
    return F.when(x > 0, F.ln(x)).when(x.isNotNull(), F.lit(-9999999999.0))


def _bp(hl: Column, rl: Column) -> Column:
    return F.when(hl >= rl, F.lit(1.0)).otherwise(F.exp(1 - F.try_divide(rl, hl)))


def bleu_plain(sums: DataFrame, keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Plain corpus BLEU (0–100). A precision with no n-grams is NULL."""
    keys = keys or []
    hl, rl = F.col("translation_length"), F.col("reference_length")
    p = [F.try_divide(F.col(f"correct_{k}_grams").cast("double"), F.col(f"total_{k}_grams")) for k in range(1, 5)]
    bp = _bp(hl, rl)
    logs = sum((_safe_log(x) for x in p), F.lit(0.0))
    bleu = bp * F.exp(logs / 4)
    return sums.select(*keys,
                       F.round(100 * bleu, digits).alias("bleu"),
                       *[F.round(100 * p[k], digits).alias(f"p{k + 1}") for k in range(4)],
                       F.round(bp, digits).alias("bp"),
                       F.round(F.try_divide(hl.cast("double"), rl), digits).alias("ratio"),
                       hl.alias("hyp_len"), rl.alias("ref_len"))


def bleu_detok(sums: DataFrame, keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """The detokenised variant's finalisation (precision 0 when no n-grams;
    all-zero result when the reference length is 0; BP 0 for an empty hypothesis)."""
    keys = keys or []
    hl, rl = F.col("translation_length"), F.col("reference_length")
    p = [F.coalesce(F.try_divide(F.col(f"correct_{k}_grams").cast("double"), F.col(f"total_{k}_grams")),
                    F.lit(0.0)) for k in range(1, 5)]
    bp = F.when(hl >= rl, F.lit(1.0)).when(hl == 0, F.lit(0.0)).otherwise(F.exp(1 - rl / hl))
    logs = sum((_safe_log(x) for x in p), F.lit(0.0))
    zero = rl == 0
    bleu = F.when(zero, 0.0).otherwise(bp * F.exp(logs / 4))
    return sums.select(*keys,
                       F.round(100 * bleu, digits).alias("bleu"),
                       *[F.round(F.when(zero, 0.0).otherwise(100 * p[k]), digits).alias(f"p{k + 1}")
                         for k in range(4)],
                       F.round(F.when(zero, 0.0).otherwise(bp), digits).alias("bp"),
                       F.round(F.when(zero, 0.0).otherwise(hl / rl), digits).alias("ratio"),
                       hl.alias("hyp_len"), rl.alias("ref_len"))


def bleu_score_expr(prefix: str = "", smooth: str = "none", scale: float = 100.0) -> Column:
    """Corpus BLEU from summed statistic columns as one expression.

    ``smooth='none'``: precision 0 when nothing matches (score 0);
    ``'exp'``: exponential smoothing (each order with no match halves the
    pseudo-precision 1/total); ``'zero_if_any'``: 0 when any precision is 0.
    """
    c = [F.col(f"{prefix}correct_{k}_grams") for k in range(1, 5)]
    t = [F.col(f"{prefix}total_{k}_grams") for k in range(1, 5)]
    hl, rl = F.col(f"{prefix}translation_length"), F.col(f"{prefix}reference_length")
    bp = F.when(hl >= rl, F.lit(1.0)).when(hl == 0, F.lit(0.0)).otherwise(F.exp(1 - rl / hl))
    if smooth == "exp":
        # number of zero-match orders up to and including k (only orders with n-grams)
        p = []
        for k in range(4):
            zeros_upto = sum(((c[j] == 0) & (t[j] > 0)).cast("int") for j in range(k + 1))
            p.append(F.when(t[k] == 0, F.lit(0.0))
                     .when(c[k] == 0, 1.0 / (F.pow(F.lit(2.0), zeros_upto) * t[k]))
                     .otherwise(c[k] / t[k]))
        # orders after the first empty one are not scored (their precision stays 0)
    else:
        p = [F.coalesce(F.try_divide(c[k].cast("double"), t[k]), F.lit(0.0)) for k in range(4)]
    logs = sum((_safe_log(x) for x in p), F.lit(0.0))
    score = bp * F.exp(logs / 4)
    if smooth == "zero_if_any":
        score = F.when(F.greatest(*[(x == 0).cast("int") for x in p]) == 1, 0.0).otherwise(score)
    return scale * score


# --- length buckets (E5) ------------------------------------------------------

def bleu_by_length(line_stats: DataFrame, width: int, digits: int = 6) -> DataFrame:
    """E5: BLEU per bucket of reference length, with the global brevity penalty.

    ``line_stats`` has the 10 statistic columns plus ``bucket`` (last
    reference's length div ``width``) and ``max_bucket_ref`` (the largest bucket
    of any reference of that line). Bucket 0 is never counted; rows run from
    ``int(1/width)`` to the largest bucket; a row is blank (NULLs) unless its
    4-gram total and 4-gram matches are both non-zero.

    All aggregation is partial + final on a handful of bucket keys; the
    per-bucket table has at most (max length / width) rows.
    """
    start = int(1 / width)
    per = line_stats.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("max_bucket_ref").alias("mb"),
        *[F.sum(c).alias(c) for c in STAT_COLS])
    g = per.agg(F.sum("translation_length").alias("hl"), F.sum("reference_length").alias("rl"),
                F.max("mb").alias("mb"))
    seq = F.when(F.col("mb") >= start, F.sequence(F.lit(start), F.col("mb").cast("int"))) \
        .otherwise(F.array().cast("array<int>"))
    rows = g.select(F.explode(seq).alias("bucket"), _bp(F.col("hl"), F.col("rl")).alias("gbp"))
    p = [F.col(f"correct_{k}_grams") / F.col(f"total_{k}_grams") for k in range(1, 5)]
    logs = sum((_safe_log(x) for x in p), F.lit(0.0))
    show = (F.col("total_4_grams") > 0) & (F.col("correct_4_grams") > 0)
    label = (F.col("bucket").cast("string") if width == 1 else
             F.concat((F.col("bucket") * width + 1).cast("string"), F.lit("-"),
                      ((F.col("bucket") + 1) * width).cast("string")))
    out = rows.join(per.where(F.col("bucket") != 0).drop("mb"), "bucket", "left")
    return out.select(
        F.col("bucket").cast("bigint").alias("bucket"), label.alias("label"),
        F.when(show, F.col("n_lines")).cast("bigint").alias("n_lines"),
        F.when(show, F.round(100 * F.col("gbp") * F.exp(logs / 4), digits)).alias("bleu"))


# --- two systems against the same references in one pass ---------------------

def paired_sentence_stats(df: DataFrame, line: str = "line_id", hyp_a: str = "hyp_a", hyp_b: str = "hyp_b",
                          refs: str = "refs", ties: str = "first", n_refs: int | None = 1, cut=None) -> DataFrame:
    """E1 for two systems sharing references: ``line, a_<stat>…, b_<stat>…``.

    Reference n-grams are cut and counted once and both clips read the same
    counts. ``n_refs`` is the number of references (None: any number). With
    ``cut`` the sides are texts, which it cuts (else arrays of tokens).
    """
    return _line_stats(df, [line], [hyp_a, hyp_b], refs, ties, n_refs, ("a_", "b_"), cut)
