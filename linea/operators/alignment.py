"""Word-alignment analytics.

Links are rows ``sent_id, src, tgt`` (sets per sentence: duplicates collapse by
grouping). Corpus-level precision/recall/AER are sums of per-link flags from a
full outer join of hypothesis and reference links on ``(sent_id, src, tgt)``.
Per-target-position facts (A7/A8) come from one ``groupBy(sent_id, tgt)`` and
a ``lag`` over ``Window.partitionBy(sent_id)``: a window partition is one
sentence, so it is bounded by the sentence length, never by the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linea.functions.text import PUNCTUATION_MARKS

LINK_RE = r"^(\d+)([-p])(\d+)$"
KEYS = ["sent_id", "src", "tgt"]


def parse_links(df: DataFrame, line: str, key: str = "sent_id", reverse: bool = False,
                one_indexed: bool = False, carry: list[str] | None = None) -> DataFrame:
    """``'a-b'`` (sure) / ``'apb'`` (possible) tokens -> ``key, src, tgt, kind``.

    ``one_indexed`` shifts both indices down by one, then ``reverse`` swaps them.
    Tokens that are not links raise (as the reference's assertion does).
    ``carry``: columns to take along.
    """
    tok = df.select(F.col(key).alias("sent_id"), *(carry or []),
                    F.explode(F.split(F.col(line), r"\s+")).alias("tok")) \
        .where(F.col("tok") != "")
    a = F.regexp_extract("tok", LINK_RE, 1)
    kind = F.regexp_extract("tok", LINK_RE, 2)
    b = F.regexp_extract("tok", LINK_RE, 3)
    bad = F.raise_error(F.concat(F.lit("bad alignment link: "), F.col("tok")))
    a = F.when(a == "", bad).otherwise(a).cast("int")
    b = b.cast("int")
    if one_indexed:
        a, b = a - 1, b - 1
    if reverse:
        a, b = b, a
    return tok.select("sent_id", *(carry or []), a.alias("src"), b.alias("tgt"), kind.alias("kind"))


def reference_sets(links: DataFrame, all_sure: bool = False, ignore_possible: bool = False) -> DataFrame:
    """A2: ``sent_id, src, tgt, s, p`` — S gets sure links (all if ``all_sure``);
    P gets sure links plus possible links unless ``ignore_possible``."""
    sure = F.col("kind") == "-"
    s = (sure | F.lit(all_sure)).cast("int")
    p = (sure | F.lit(not ignore_possible)).cast("int")
    return links.groupBy(*KEYS).agg(F.max(s).alias("s"), F.max(p).alias("p")) \
        .where((F.col("s") == 1) | (F.col("p") == 1))


def hypothesis_set(links: DataFrame) -> DataFrame:
    return links.select(*KEYS).distinct()


def alignment_flags(df: DataFrame, ref: str = "ref_line", hyp: str = "hyp_line", key: str = "sent_id",
                    all_sure: bool = False, ignore_possible: bool = False) -> DataFrame:
    """A1 + A2 + C8 from both lines of a sentence at once: ``sent_id, src, tgt, a, s, p``.

    Both lines are parsed in one pass and reduced by one aggregation, which
    needs no exchange if ``df`` is partitioned by ``key``.
    """
    sides = F.inline(F.array(F.struct(F.lit(1).alias("__a"), F.col(hyp).alias("__line")),
                             F.struct(F.lit(0).alias("__a"), F.col(ref).alias("__line"))))
    rows = df.select(F.col(key).alias("sent_id"), sides)
    links = parse_links(rows, "__line", carry=["__a"])
    given = F.col("__a") == 0
    sure = F.col("kind") == "-"
    flags = links.groupBy(*KEYS).agg(
        F.max("__a").alias("a"), F.max((given & (sure | F.lit(all_sure))).cast("int")).alias("s"),
        F.max((given & (sure | F.lit(not ignore_possible))).cast("int")).alias("p"))
    return flags.where((F.col("a") == 1) | (F.col("s") == 1) | (F.col("p") == 1))


def clean_flags(flags: DataFrame, sentences: DataFrame) -> DataFrame:
    """F3 on flags: hypothesis links between a punctuation mark and a different word lose their
    ``a``; ``a_raw`` keeps them, for the number of links as read."""
    marks = F.array(*[F.lit(x) for x in PUNCTUATION_MARKS])
    hyp = F.col("a") == 1
    w = with_words(flags.where(hyp), sentences).unionByName(
        flags.where(~hyp).withColumns({"src_word": F.lit(None).cast("string"), "tgt_word": F.lit(None).cast("string")}))
    punct = F.array_contains(marks, F.col("src_word")) | F.array_contains(marks, F.col("tgt_word"))
    drop = F.coalesce(punct & (F.col("src_word") != F.col("tgt_word")), F.lit(False))
    return w.select(*KEYS, F.when(drop, 0).otherwise(F.col("a")).alias("a"), F.col("a").alias("a_raw"), "s", "p")


def clean_punctuation(hyp: DataFrame, sentences: DataFrame) -> DataFrame:
    """drop links where either word is a punctuation mark and the two words differ.

    ``sentences``: ``sent_id, src_words, tgt_words``. Adds ``src_word, tgt_word``.
    """
    marks = F.array(*[F.lit(x) for x in PUNCTUATION_MARKS])
    w = with_words(hyp, sentences)
    punct = F.array_contains(marks, F.col("src_word")) | F.array_contains(marks, F.col("tgt_word"))
    return w.where(~(punct & (F.col("src_word") != F.col("tgt_word"))))


def with_words(hyp: DataFrame, sentences: DataFrame) -> DataFrame:
    """Attach the linked words; a link of a sentence without words, or an index outside its sentence, raises."""
    j = hyp.join(sentences.withColumn("__known", F.lit(True)), "sent_id", "left")
    unknown = F.raise_error(F.concat(F.lit("alignment links of a sentence without words: "), F.col("sent_id").cast("string")))
    j = j.where(F.when(F.col("__known").isNull(), unknown.cast("boolean")).otherwise(F.lit(True)))
    oob = (F.col("src") >= F.size("src_words")) | (F.col("tgt") >= F.size("tgt_words")) | \
        (F.col("src") < 0) | (F.col("tgt") < 0)
    err = F.raise_error(F.concat(F.lit("alignment link out of range in sentence "), F.col("sent_id").cast("string")))
    return j.select(*hyp.columns,
                    F.when(oob, err).otherwise(F.get("src_words", F.col("src"))).alias("src_word"),
                    F.get("tgt_words", F.col("tgt")).alias("tgt_word"))


def link_flags(hyp: DataFrame, ref: DataFrame) -> DataFrame:
    """``sent_id, src, tgt, a, s, p`` over the union of hypothesis and reference links."""
    h = hyp.select(*KEYS, F.lit(1).alias("a"))
    j = h.join(ref.select(*KEYS, "s", "p"), KEYS, "full_outer")
    return j.select(*KEYS, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("a", "s", "p")])


def aer_metrics(flags: DataFrame, alpha: float = -1.0, digits: int = 6) -> DataFrame:
    """A3/A4: precision = |A∩P|/|A|, recall = |A∩S|/|S|,
    AER = 1 - (|A∩P| + |A∩S|)/(|A| + |S|); F-measure 1/(α/P + (1-α)/R) (0 if α < 0).
    ``n_links`` counts the hypothesis links as read, before any cleaning."""
    a, s, p = F.col("a"), F.col("s"), F.col("p")
    raw = F.col("a_raw") if "a_raw" in flags.columns else a
    t = flags.agg(F.sum(raw).alias("n_raw"), F.sum(a).alias("n_a"), F.sum(s).alias("n_s"),
                  F.sum(a * p).alias("n_ap"), F.sum(a * s).alias("n_as"))
    prec = F.try_divide(F.col("n_ap").cast("double"), F.col("n_a"))
    rec = F.try_divide(F.col("n_as").cast("double"), F.col("n_s"))
    aer = 1.0 - F.try_divide((F.col("n_ap") + F.col("n_as")).cast("double"), F.col("n_a") + F.col("n_s"))
    if alpha < 0:
        f = F.lit(0.0)
    else:
        f = F.try_divide(F.lit(1.0), F.try_divide(F.lit(alpha), prec) + F.try_divide(F.lit(1.0 - alpha), rec))
    return t.select(F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                    F.round(aer, digits).alias("aer"), F.round(f, digits).alias("f_measure"),
                    F.col("n_raw").cast("bigint").alias("n_links"))


def alignment_errors(hyp_words: DataFrame, ref: DataFrame, k: int = 10) -> DataFrame:
    """A5: the k most common ``(src_word, tgt_word)`` of hypothesis links not in P.

    Ties are broken by the words (ascending). A top-k over a grouped count:
    Spark plans it as TakeOrderedAndProject (partial top-k per partition).
    """
    poss = ref.where(F.col("p") == 1).select(*KEYS)
    err = hyp_words.join(poss, KEYS, "left_anti")
    return (err.groupBy("src_word", "tgt_word").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.col("cnt").desc(), "src_word", "tgt_word").limit(k))


def coverage(hyp: DataFrame, sentences: DataFrame, digits: int = 6) -> DataFrame:
    """Distinct aligned source (target) positions / max(1, total words).

    Positions are told apart sentence by sentence, where the links lie; one row
    a sentence and the sentence lengths are unioned into one frame of sums.
    """
    links = hyp.groupBy("sent_id").agg(F.size(F.collect_set("src")).alias("n_src"), F.size(F.collect_set("tgt")).alias("n_tgt"))
    links = links.select("n_src", "n_tgt", F.lit(0).alias("w_src"), F.lit(0).alias("w_tgt"))
    sent = sentences.select(F.lit(0).alias("n_src"), F.lit(0).alias("n_tgt"), F.size("src_words").alias("w_src"), F.size("tgt_words").alias("w_tgt"))
    t = links.unionByName(sent).agg(*[F.sum(c).alias(c) for c in ("n_src", "n_tgt", "w_src", "w_tgt")])
    return t.select(
        F.round(F.col("n_src") / F.greatest(F.col("w_src"), F.lit(1)), digits).alias("source_coverage"),
        F.round(F.col("n_tgt") / F.greatest(F.col("w_tgt"), F.lit(1)), digits).alias("target_coverage"))


def jumps(hyp: DataFrame) -> DataFrame:
    """Internal jumps (target positions whose source set is not contiguous)
    and external jumps (adjacent aligned target positions t, t+1 where none of
    m-1, m, m+1 is aligned to t+1, m = smallest source of t)."""
    g = hyp.groupBy("sent_id", "tgt").agg(F.min("src").alias("lo"), F.max("src").alias("hi"),
                                          F.count(F.lit(1)).alias("cnt"), F.collect_set("src").alias("srcs"))
    w = Window.partitionBy("sent_id").orderBy("tgt")
    prev_t, prev_lo = F.lag("tgt").over(w), F.lag("lo").over(w)
    j = g.select("*", prev_t.alias("pt"), prev_lo.alias("plo"))
    internal = ((F.col("cnt") > 1) & (F.col("hi") - F.col("lo") + 1 != F.col("cnt"))).cast("int")
    near = F.array(F.col("plo") - 1, F.col("plo"), F.col("plo") + 1)
    external = ((F.col("pt") == F.col("tgt") - 1) & ~F.arrays_overlap(near, F.col("srcs"))).cast("int")
    return j.agg(F.sum(internal).cast("bigint").alias("internal_jumps"),
                 F.sum(F.coalesce(external, F.lit(0))).cast("bigint").alias("external_jumps"))
