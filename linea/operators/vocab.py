"""Token dictionary (M7) and id encoding with out-of-vocabulary rate (M8).

Ids follow the usual NMT dictionary layout: four reserved symbols, then tokens
by frequency (ties by token). Encoding is one token stream joined to the
dictionary (broadcast only after a size check) and regrouped by line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linea.operators.positional import lookup_join, ordered_index

# Reserved symbols and their ids.
SPECIALS = [("<s>", 0), ("<pad>", 1), ("</s>", 2), ("<unk>", 3)]
BOS, PAD, EOS, UNK = 0, 1, 2, 3


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``token, cnt``: how often each token occurs."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def build_dictionary(df: DataFrame, tokens: str = "tokens", min_count: int = 1,
                     pad_to_multiple: int = 1) -> DataFrame:
    """M7: ``token, cnt, id``. With ``pad_to_multiple > 1`` filler symbols
    ``madeupwordNNNN`` (count 0) round the size up to a multiple."""
    return dictionary_of(token_counts(df, tokens), min_count, pad_to_multiple)


def dictionary_of(counts: DataFrame, min_count: int = 1, pad_to_multiple: int = 1) -> DataFrame:
    """M7 of a count table ``token, cnt`` (of one corpus, or merged ones)."""
    spark = counts.sparkSession
    # ranked by range (sampled, then dealt) and counted: the corpus is read once
    counts = counts.where(F.col("cnt") >= min_count).checkpoint(eager=True)
    ranked = ordered_index(counts, [F.col("cnt").desc(), F.col("token").asc()], "rank")
    words = ranked.select("token", "cnt", (F.col("rank") + len(SPECIALS)).alias("id"))
    specials = spark.createDataFrame([(s, 1, i) for s, i in SPECIALS], "token string, cnt long, id long")
    out = specials.unionByName(words)
    if pad_to_multiple > 1:
        size = len(SPECIALS) + counts.count()
        extra = (-size) % pad_to_multiple
        if extra:
            pad = spark.range(extra).select(F.format_string("madeupword%04d", F.col("id")).alias("token"),
                                            F.lit(0).cast("long").alias("cnt"),
                                            (F.col("id") + size).alias("id"))
            out = out.unionByName(pad)
    return out


def encode(df: DataFrame, dictionary: DataFrame, line: str = "line_id", tokens: str = "tokens",
           append_eos: bool = True) -> DataFrame:
    """M8: ``line, ids`` (unknown -> <unk>, </s> appended) and ``n_unk`` per line."""
    # null tokens: a line without tokens
    t = df.select(line, F.coalesce(tokens, F.array().cast("array<string>")).alias(tokens)).repartition(line)
    p = t.select(line, F.posexplode(tokens).alias("pos", "token"))
    d = dictionary.select("token", F.col("id").cast("int").alias("id"))
    j = lookup_join(p, d, "token")
    g = j.groupBy(line).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(UNK)).alias("id")))).alias("__s"),
        F.sum(F.col("id").isNull().cast("int")).alias("n_unk"))
    ids = F.transform("__s", lambda s: s["id"])
    if append_eos:
        ids = F.concat(ids, F.array(F.lit(EOS)))
    # lines with no tokens still get an (EOS-only) encoding
    empty = t.where(F.size(tokens) == 0).select(
        line, (F.array(F.lit(EOS)) if append_eos else F.array().cast("array<int>")).alias("ids"),
        F.lit(0).cast("long").alias("n_unk"))
    return g.select(line, ids.alias("ids"), F.col("n_unk").cast("long").alias("n_unk")).unionByName(empty)


def oov_rate(encoded: DataFrame, digits: int = 6) -> DataFrame:
    """``n_tokens, n_unk, oov_rate`` of an encoding (one aggregate; </s> not counted)."""
    n_tok = F.sum(F.size("ids") - 1)
    t = encoded.agg(n_tok.cast("bigint").alias("n_tokens"), F.sum("n_unk").cast("bigint").alias("n_unk"))
    return t.select("n_tokens", "n_unk",
                    F.round(F.try_divide(F.col("n_unk").cast("double"), F.col("n_tokens")), digits).alias("oov_rate"))
