"""Truecasing model (M1) and its application (M2).

Training counts surface forms per lower-cased word over tokens that are not
sentence-initial; the model keeps, per lower-cased word, the commonest form
(ties: the smaller form). Application re-cases sentence-initial tokens to the
best form, keeps known surface forms, and maps other unknown forms to the
best form of their lower-cased word. Our documented rules; no byte parity with
any external tool is claimed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.functions.text import DELAYED_START, SENTENCE_END, _shifted
from linea.operators.positional import lookup_join


def sentence_start_flags(tokens: Column) -> Column:
    """array<boolean>: token starts a sentence (first token, or after a
    sentence-final token, allowing one delaying token in between)."""
    end = F.array(*[F.lit(x) for x in SENTENCE_END])
    delayed = F.array(*[F.lit(x) for x in DELAYED_START])
    z = F.arrays_zip(tokens.alias("x"), _shifted(tokens, 1).alias("p1"), _shifted(tokens, 2).alias("p2"))

    def flag(e, i):
        first = (i == 0) | F.array_contains(end, e["p1"])
        after_delay = F.array_contains(delayed, e["p1"]) & ((i == 1) | F.array_contains(end, e["p2"]))
        return F.coalesce(~F.array_contains(delayed, e["x"]) & (first | after_delay), F.lit(False))
    return F.transform(z, flag)


def _positions(df: DataFrame, line: str, tokens: str) -> DataFrame:
    """Token rows; a line without tokens keeps one row with a NULL token."""
    t = df.select(line, F.col(tokens).alias("__t"))
    t = t.select(line, F.arrays_zip(F.col("__t").alias("w"), sentence_start_flags(F.col("__t")).alias("st"))
                 .alias("__z"))
    return t.select(line, F.posexplode_outer("__z").alias("pos", "__e")) \
        .select(line, "pos", F.col("__e.w").alias("w"), F.col("__e.st").alias("start"))


def surface_forms(df: DataFrame, line: str = "line_id", tokens: str = "tokens") -> DataFrame:
    """``lc, w, cnt``: non-initial surface forms; the model and the known forms both come from it."""
    p = _positions(df, line, tokens).where(~F.col("start") & (F.col("w") != ""))
    return p.groupBy(F.lower("w").alias("lc"), "w").agg(F.count(F.lit(1)).alias("cnt"))


def train(df: DataFrame, line: str = "line_id", tokens: str = "tokens") -> DataFrame:
    """M1: ``lc, best, best_count, total`` per lower-cased word (non-initial tokens only)."""
    return best_forms(surface_forms(df, line, tokens))


def best_forms(forms: DataFrame) -> DataFrame:
    """The model of a table of surface forms: the commonest form per lower-cased word."""
    return forms.groupBy("lc").agg(
        F.min_by("w", F.struct(-F.col("cnt"), F.col("w"))).alias("best"),
        F.max("cnt").alias("best_count"), F.sum("cnt").alias("total"))


def known_forms(df: DataFrame, line: str = "line_id", tokens: str = "tokens") -> DataFrame:
    """Surface forms seen (non-initially) in training: ``w``."""
    p = _positions(df, line, tokens).where(~F.col("start") & (F.col("w") != ""))
    return p.select("w").distinct()


#: About the most tokens of the lines that meet their words' forms together.
TOKENS = 2_000_000


def _different(lines: DataFrame) -> DataFrame:
    """``part, w``: the different words of each part (a part's words may come in several batches)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, size = None, [], 0

        def told():
            words = pa.chunked_array(seen, pa.string()).unique().drop_null()
            return pa.RecordBatch.from_arrays([pa.repeat(part, len(words)), words], ["part", "w"])

        for batch in batches:
            of, tokens = batch.column(0), batch.column(1)
            cuts = np.flatnonzero(np.diff(of.to_numpy(), prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:], strict=False):
                if seen and (of[a] != part or size > TOKENS):
                    yield told()
                    seen, size = [], 0
                part = of[a]
                seen.append(tokens[a:b].flatten().unique())
                size += len(seen[-1])
        if seen:
            yield told()

    return lines.select("part", "tokens").mapInArrow(run, "part bigint, w string")


def _recased(lines: pa.Table, forms: pa.Table) -> pa.Table:
    """The lines of a part; ``forms`` holds those of its words that change at a start or inside."""
    tokens, flags = lines["tokens"].combine_chunks(), lines["start"].combine_chunks()
    flat = tokens.flatten().dictionary_encode()
    words = flat.dictionary
    at = pc.index_in(words, value_set=forms["w"])
    start, inside = (pc.coalesce(forms[c].combine_chunks().take(at), words).take(flat.indices) for c in ("at_start", "inside"))
    ends = np.concatenate([[0], np.cumsum(tokens.value_lengths().fill_null(0).to_numpy())])
    cased = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.if_else(flags.flatten(), start, inside))
    return pa.table([lines["line"], cased], ["line", "tokens"])


def apply(df: DataFrame, model: DataFrame, known: DataFrame, line: str = "line_id",
          tokens: str = "tokens") -> DataFrame:
    """M2: ``line, tokens`` re-cased.

    Lines are dealt to parts of about ``TOKENS`` tokens, and a part's different
    words (not its tokens) meet the model and the known forms by value. The
    words that change come back to their part, whose lines take them in arrays.
    """
    n = df.agg(F.sum(F.greatest(F.size(tokens), F.lit(0)))).first()[0] or 0
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-n // TOKENS))
    lines = df.select(F.pmod(F.xxhash64(line), F.lit(n)).alias("part"), F.col(line).alias("line"), F.col(tokens).alias("tokens"))
    lines = lines.repartition(n, "part").sortWithinPartitions("part")
    words = _different(lines).withColumn("lc", F.lower("w"))
    words = lookup_join(words, model.select("lc", "best"), "lc")
    words = lookup_join(words, known.select("w", F.lit(True).alias("is_known")), "w")
    best = F.coalesce("best", "w")
    forms = words.select("part", "w", best.alias("at_start"), F.when(F.col("is_known"), F.col("w")).otherwise(best).alias("inside"))
    forms = forms.where((F.col("at_start") != F.col("w")) | (F.col("inside") != F.col("w"))).distinct()
    out = f"line {df.schema[line].dataType.simpleString()}, tokens array<string>"
    flagged = lines.withColumn("start", sentence_start_flags(F.col("tokens")))  # of tokens that are cut already
    cased = flagged.groupBy("part").cogroup(forms.groupBy("part")).applyInArrow(_recased, out)
    return cased.select(F.col("line").alias(line), F.col("tokens").alias(tokens))
