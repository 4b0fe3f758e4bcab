"""Parallel-corpus fixtures derived deterministically from the driver tables.

The driver tables hold no parallel corpus, so sentence pairs, decoder logs,
label files and word alignments are derived by pure functions of the table
rows. The same derivations are written as SQL in
:mod:`linea.plans.oracle`, so every query can be checked against DuckDB.
All derivations are row-local (no shuffle) unless stated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linea.operators.positional import dense_index
from linea.sources.tables import table  # noqa: F401  (re-exported)

# Fixed values used to derive alignment-test sentences.
ALIGN_VOCAB = ["the", "house", ".", ",", "is", "big", "(", ")", "a", "!", "small", ";"]
SENT_LEN = 7
#: About the most links of a task.
LINKS = 200_000


def seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document text split into lines: ``doc_id, lang, seg_no, line_id, text``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return (d.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("seg_no", "text"))
            .where(F.col("text") != "")
            .select("doc_id", "lang", F.col("seg_no").cast("bigint").alias("seg_no"),
                    _packed("doc_id", "seg_no", 100000).alias("line_id"), "text"))


def _packed(a: str, b: str, size: int):
    """``a * size + b``; a ``b`` that does not fit raises instead of meeting the next ``a``."""
    err = F.raise_error(F.concat(F.lit(f"{b} reaches {size} in {a} "), F.col(a).cast("string")))
    return F.col(a) * size + F.when(F.col(b) < size, F.col(b)).otherwise(err)


def _words(c="text"):
    return F.split(F.col(c), " ")


def _system(words, line_id, drop_mod, drop_rem, unk_mod, unk_rem):
    t = F.transform(words, lambda x, i: F.when((i + line_id) % unk_mod == unk_rem, F.lit("unk"))
                    .otherwise(x))
    f = F.filter(t, lambda x, i: (i + line_id) % drop_mod != drop_rem)
    return F.array_join(f, " ")


def pair(spark, sf_dir, system: int = 1) -> DataFrame:
    """``line_id, lang, hyp, ref``: ref = the line, hyp = a degraded copy."""
    s = seg(spark, sf_dir)
    lid = F.col("line_id")
    if system == 1:
        hyp = _system(_words(), lid, 7, 3, 11, 5)
    else:
        hyp = _system(_words(), lid, 5, 2, 13, 4)
    return s.select("line_id", "lang", hyp.alias("hyp"), F.col("text").alias("ref"))


def multi_ref(spark, sf_dir) -> DataFrame:
    """Long form ``line_id, hyp, ref_id, ref`` with two references per line."""
    p = pair(spark, sf_dir).withColumn("__w", _words("ref"))
    r1 = F.array_join(F.filter("__w", lambda x, i: (i + F.col("line_id")) % 5 != 1), " ")
    return p.select("line_id", "hyp", F.inline(F.array(
        F.struct(F.lit(0).alias("ref_id"), F.col("ref").alias("ref")),
        F.struct(F.lit(1).alias("ref_id"), r1.alias("ref")))))


def _inject_marks(words, line_id):
    """Re-join words, turning some blanks into ``@@ `` and some into ``_``."""
    head = F.slice(words, 1, F.size(words) - 1)
    t = F.transform(head, lambda x, i: F.concat(x, F.when((i + line_id) % 5 == 0, F.lit("@@ "))
                                                .when((i + line_id) % 6 == 1, F.lit("_"))
                                                .otherwise(F.lit(" "))))
    return F.concat(F.array_join(t, ""), F.element_at(words, -1))


def decoder_log(spark, sf_dir) -> DataFrame:
    """Decoder output log ``line``: S/H/P rows per input; two inputs per line.

    Input id ``2*line_id`` is the e2v direction (hypothesis = Vietnamese side,
    here the system-1 hypothesis), ``2*line_id+1`` the v2e direction
    (hypothesis = the reference line); both carry injected subword marks.
    """
    p = pair(spark, sf_dir)
    lid = F.col("line_id")
    vi = _inject_marks(_words("hyp"), lid)
    en = _inject_marks(_words("ref"), lid + 1)
    score = F.concat(F.lit("-0."), F.lpad((lid % 1000).cast("string"), 3, "0"))

    def rows(i, hyp, src):
        sid = i.cast("string")
        return [F.concat(F.lit("S-"), sid, F.lit("\t"), src),
                F.concat(F.lit("H-"), sid, F.lit("\t"), score, F.lit("\t"), hyp),
                F.concat(F.lit("P-"), sid, F.lit("\t"), score)]

    return p.select(F.explode(F.array(*rows(lid * 2, vi, F.col("ref")),
                                      *rows(lid * 2 + 1, en, F.col("hyp")))).alias("line"))


def gold(spark, sf_dir) -> DataFrame:
    """Label files ``n, gold, sys1, sys2`` (strings) from ``labels``."""
    lab = table(spark, sf_dir, "labels")
    q = F.col("quality")
    out = lab.select("doc_id",
                     q.cast("string").alias("gold"),
                     F.when(F.col("doc_id") % 5 == 0, 1 - q).otherwise(q).cast("string").alias("sys1"),
                     F.when(F.col("doc_id") % 7 == 0, 1 - q).otherwise(q).cast("string").alias("sys2"))
    return dense_index(out, "doc_id", "n").drop("doc_id")


def scores(spark, sf_dir) -> DataFrame:
    """Score files ``n, gold, sys1, sys2`` (doubles) from ``orders``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    g = F.col("o_totalprice")
    k = F.col("o_orderkey")
    out = o.select("o_orderkey", g.alias("gold"),
                   (g + (k % 17 - 8) * 1000.0).alias("sys1"),
                   (g + (k % 29 - 14) * 3000.0).alias("sys2"))
    return dense_index(out, "o_orderkey", "n").drop("o_orderkey")


def _deals(li: DataFrame) -> int:
    """Partitions that hold about ``LINKS`` rows of ``lineitem`` each (its rows are counted in the files' footers)."""
    return max(int(li.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-li.count() // LINKS))


def links(spark, sf_dir) -> DataFrame:
    """Word alignments ``sent_id, src, tgt, h, s, p`` (flags 0/1) from ``lineitem``."""
    # dealt by sentence once: every grouping of links below keeps that partitioning, so a task holds LINKS links whatever their number
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    li = li.repartition(_deals(li), "l_orderkey")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    s = (ls == "F").cast("int")
    return (li.select(F.col("l_orderkey").alias("sent_id"),
                      (F.col("l_linenumber") - 1).alias("src"),
                      (F.col("l_partkey") % SENT_LEN).cast("int").alias("tgt"),
                      (rf != "A").cast("int").alias("h"), s.alias("s"),
                      ((ls == "F") | (rf == "N")).cast("int").alias("p"))
            .groupBy("sent_id", "src", "tgt")
            .agg(F.max("h").alias("h"), F.max("s").alias("s"), F.max("p").alias("p")))


def alignment_lines(spark, sf_dir) -> DataFrame:
    """Alignment files as text, one line per sentence: ``sent_id, ref_line, hyp_line``.

    Reference links are written ``a-b`` (sure) or ``apb`` (possible only);
    hypothesis links ``a-b``. Order inside a line is irrelevant (sets).
    """
    l = links(spark, sf_dir)
    ref_tok = F.when(F.col("s") == 1, F.concat_ws("-", "src", "tgt")) \
        .when(F.col("p") == 1, F.concat_ws("p", "src", "tgt"))
    hyp_tok = F.when(F.col("h") == 1, F.concat_ws("-", "src", "tgt"))
    return (l.groupBy("sent_id")
            .agg(F.concat_ws(" ", F.collect_list(ref_tok)).alias("ref_line"),
                 F.concat_ws(" ", F.collect_list(hyp_tok)).alias("hyp_line")))


def _align_word(key, i, mult, step):
    vocab = F.array(*[F.lit(x) for x in ALIGN_VOCAB])
    return F.element_at(vocab, ((key * mult + i * step) % len(ALIGN_VOCAB) + 1).cast("int"))


def align_sentences(spark, sf_dir) -> DataFrame:
    """Source/target token arrays per alignment sentence (one per order with line items)."""
    o = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sent_id"))
    o = o.repartition(_deals(o), "sent_id").distinct()
    idx = F.sequence(F.lit(0), F.lit(SENT_LEN - 1))
    k = F.col("sent_id")
    return o.select("sent_id",
                    F.transform(idx, lambda i: _align_word(k, i, 3, 1)).alias("src_words"),
                    F.transform(idx, lambda i: _align_word(k, i, 5, 2)).alias("tgt_words"))


def turns(spark, sf_dir) -> DataFrame:
    """Line pairs ``conv_id, k, src, tgt`` of conversations, holding every turn once.

    A pair is a turn of the system or user and the assistant turn right after
    it; a side without a turn (a system turn before the user's, an assistant
    turn after another) is the empty line.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text",
                                                     (F.coalesce("role", F.lit("")) == "assistant").alias("reply"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    opens = ~F.col("reply") | F.coalesce(F.lag("reply").over(w), F.lit(True))
    c = c.withColumn("__opens", opens.cast("int")).withColumn("k", (F.sum("__opens").over(w) - 1).cast("bigint"))
    return c.groupBy("conv_id", "k").agg(
        F.coalesce(F.max(F.when(~F.col("reply"), F.col("text"))), F.lit("")).alias("src"),
        F.coalesce(F.max(F.when(F.col("reply"), F.col("text"))), F.lit("")).alias("tgt"))


def marked(spark, sf_dir) -> DataFrame:
    """Lines with injected subword marks (``@@ ``) and compound joins (``_``)."""
    s = seg(spark, sf_dir)
    return s.select("line_id", "lang", _inject_marks(_words(), F.col("line_id")).alias("text"))


def padded(spark, sf_dir) -> DataFrame:
    """Lines with leading/trailing blanks on every third line (tokeniser edge cases)."""
    s = seg(spark, sf_dir)
    t = F.when(F.col("line_id") % 3 == 0, F.concat(F.lit(" "), F.col("text"), F.lit("  "))) \
        .otherwise(F.col("text"))
    return s.select("line_id", "lang", t.alias("text"))


def numbered(spark, sf_dir) -> DataFrame:
    """Lines with a dense 0-based ``line_no`` in ``line_id`` order."""
    return dense_index(seg(spark, sf_dir), "line_id", "line_no")


def parallel(spark, sf_dir) -> DataFrame:
    """Bound parallel corpus ``line_no, en, vi, syn_en, syn_vi`` from conversation turns.

    en = user turn, vi = assistant reply; the synthetic sides stand for
    back-translations (lower-cased copies).
    """
    t = turns(spark, sf_dir).withColumn("__key", _packed("conv_id", "k", 1000))
    t = dense_index(t, "__key", "line_no")
    return t.select("line_no", F.col("src").alias("en"), F.col("tgt").alias("vi"),
                    F.lower("src").alias("syn_en"), F.lower("tgt").alias("syn_vi"))


def parallel_split(spark, sf_dir, split: str) -> DataFrame:
    """The parallel corpus of one split (conv_id % 10: 0 valid, 1 test, else train)."""
    t = turns(spark, sf_dir)
    code = F.col("conv_id") % 10
    name = F.when(code == 0, "valid").when(code == 1, "test").otherwise("train")
    t = t.where(name == split).withColumn("__key", _packed("conv_id", "k", 1000))
    t = dense_index(t, "__key", "line_no")
    return t.select("line_no", F.col("src").alias("en"), F.col("tgt").alias("vi"),
                    F.lower("src").alias("syn_en"), F.lower("tgt").alias("syn_vi"))


def decoder_log_uni(spark, sf_dir) -> DataFrame:
    """Unidirectional decoder log: S/H/P rows with id = line_id, Vietnamese hypotheses."""
    p = pair(spark, sf_dir)
    lid = F.col("line_id")
    vi = _inject_marks(_words("hyp"), lid)
    score = F.concat(F.lit("-0."), F.lpad((lid % 1000).cast("string"), 3, "0"))
    sid = lid.cast("string")
    return p.select(F.explode(F.array(
        F.concat(F.lit("S-"), sid, F.lit("\t"), F.col("ref")),
        F.concat(F.lit("H-"), sid, F.lit("\t"), score, F.lit("\t"), vi),
        F.concat(F.lit("P-"), sid, F.lit("\t"), score))).alias("line"))


def sweep_hyps(spark, sf_dir) -> DataFrame:
    """Validation outputs of checkpoints 21-30: ``checkpoint, direction, line_id, hyp``.

    Later checkpoints drop fewer words (drop modulus = checkpoint - 15)."""
    s = seg(spark, sf_dir).select("line_id", "lang", "text",
                                  F.explode(F.sequence(F.lit(21), F.lit(30))).alias("checkpoint"))
    hyp = _system(_words(), F.col("line_id"), F.col("checkpoint") - 15, 3, 11, 5)
    direction = F.when(F.col("lang") == "en", F.lit("en>vi")).otherwise(F.lit("vi>en"))
    return s.select("checkpoint", direction.alias("direction"), "line_id", hyp.alias("hyp"))


def sweep_refs(spark, sf_dir) -> DataFrame:
    """Validation references of the sweep: ``direction, line_id, ref``."""
    direction = F.when(F.col("lang") == "en", F.lit("en>vi")).otherwise(F.lit("vi>en"))
    return seg(spark, sf_dir).select(direction.alias("direction"), "line_id", F.col("text").alias("ref"))


def eval_refs(spark, sf_dir) -> DataFrame:
    """References per hypothesis language for the bidirectional log: ``sent_id, lang, ref``."""
    p = pair(spark, sf_dir)
    return p.select(F.col("line_id").alias("sent_id"), F.inline(F.array(
        F.struct(F.lit("vi").alias("lang"), F.col("ref").alias("ref")),
        F.struct(F.lit("en").alias("lang"), F.col("hyp").alias("ref")))))


def translation_data(spark, sf_dir) -> DataFrame:
    """Subword-marked training text per language: ``sent_id, lang, ref``."""
    p = pair(spark, sf_dir)
    lid = F.col("line_id")
    return p.select(F.col("line_id").alias("sent_id"), F.inline(F.array(
        F.struct(F.lit("vi").alias("lang"), _inject_marks(_words("ref"), lid + 2).alias("ref")),
        F.struct(F.lit("en").alias("lang"), _inject_marks(_words("hyp"), lid + 3).alias("ref")))))


def pair_ab(spark, sf_dir) -> DataFrame:
    """Both systems' hypotheses with the shared reference: ``line_id, lang, hyp_a, hyp_b, ref``."""
    s = seg(spark, sf_dir)
    lid = F.col("line_id")
    return s.select("line_id", "lang", _system(_words(), lid, 7, 3, 11, 5).alias("hyp_a"),
                    _system(_words(), lid, 5, 2, 13, 4).alias("hyp_b"), F.col("text").alias("ref"))
