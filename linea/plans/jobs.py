"""Named end-to-end jobs: evaluation pipelines (E13-E16) and preparation.

A job is a function from DataFrames to a DataFrame; it composes operators
lazily so Catalyst sees one plan (one action at the end), except where a
model (truecase map, merges, dictionary) must be learned first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.operators import bleu as B
from linea.operators import compose as C
from linea.operators import collocations as CO
from linea.operators import subword as SW
from linea.operators import truecase as TC
from linea.operators import vocab as V
from linea.sources.text import bind_strict, parse_decoder_log

DIRECTION = {"vi": "en>vi", "en": "vi>en"}


def _direction(lang_col: str = "lang"):
    return F.when(F.col(lang_col) == "vi", F.lit(DIRECTION["vi"])).otherwise(F.lit(DIRECTION["en"]))


def postprocess(c) -> F.Column:
    """Model output back to plain text: subwords joined, detruecased, compounds split."""
    return T.join_compounds(T.detruecase(T.join_subwords(c)))


def _bleu_rows(hyp_ref: DataFrame, keys: list[str]) -> DataFrame:
    toks = hyp_ref.select(*keys, "line_id", T.split_ws("hyp").alias("hyp"),
                          F.array(T.split_space("ref")).alias("refs"))
    return B.bleu_plain(B.corpus_totals(toks, keys=keys, multi_ref=False), keys=keys)


def evaluate_bidirectional(log: DataFrame, refs: DataFrame) -> DataFrame:
    """Decoder log of a bidirectional model -> BLEU per direction.

    ``refs``: ``sent_id, lang, ref`` (reference of the hypothesis language).
    Pipeline: S6 -> F2 -> T7 -> T9 -> T8 -> E1/E3, grouped by direction.
    """
    routed = C.route_by_parity(parse_decoder_log(log))
    hyps = routed.select("sent_id", "lang", T.join_compounds(T.detruecase("text")).alias("hyp"))
    pairs = bind_strict(hyps, refs, ["sent_id", "lang"], "hypotheses and references").select(
        _direction().alias("direction"), F.col("sent_id").alias("line_id"), "hyp", "ref")
    return _bleu_rows(pairs, ["direction"])


def evaluate_unidirectional(log: DataFrame, refs: DataFrame) -> DataFrame:
    """As E14 without parity routing; ``refs``: ``sent_id, ref``."""
    hyps = parse_decoder_log(log).select(F.col("id").alias("sent_id"), postprocess("text").alias("hyp"))
    pairs = bind_strict(hyps, refs, ["sent_id"], "hypotheses and references").select(F.col("sent_id").alias("line_id"), "hyp", "ref")
    return _bleu_rows(pairs, [])


def checkpoint_sweep(hyps: DataFrame, refs: DataFrame, checkpoints: list[int] | None = None) -> DataFrame:
    """Validation BLEU per (checkpoint, direction); ``is_best`` marks the best
    checkpoint of each direction.

    ``hyps``: ``checkpoint, direction, line_id, hyp``; ``refs``: ``direction,
    line_id, ref``, read and cut once for all checkpoints (found in ``hyps``
    unless given).
    """
    if checkpoints is None:
        checkpoints = [r[0] for r in hyps.select("checkpoint").distinct().orderBy("checkpoint").collect()]
    toks = hyps.select("checkpoint", "direction", "line_id", T.split_ws("hyp").alias("hyp"))
    sums = B.many_totals(toks, refs.select("direction", "line_id", T.split_space("ref").alias("ref")), checkpoints,
                         system="checkpoint", keys=["direction"])
    res = B.bleu_plain(sums, keys=["checkpoint", "direction"])
    # at most (#checkpoints x #directions) rows: a window over them is tiny
    best = F.max("bleu").over(Window.partitionBy("direction"))
    return res.withColumn("is_best", F.col("bleu") == best)


def backtranslation_quality(syn: DataFrame, ref_sub: DataFrame) -> DataFrame:
    """Quality of synthetic data per language.

    ``syn``: ``sent_id, lang, syn`` (the collected synthetic side);
    ``ref_sub``: ``sent_id, lang, ref`` (subword-marked training text). The
    reference is un-subworded (T7) and, for Vietnamese, compounds are split (T8).
    Output per language: BLEU columns plus exact-match counts.
    """
    r = F.when(F.col("lang") == "vi", T.join_compounds(T.join_subwords("ref"))).otherwise(T.join_subwords("ref"))
    pairs = bind_strict(syn, ref_sub.select("sent_id", "lang", r.alias("ref")), ["sent_id", "lang"],
                        "synthetic lines and references") \
        .select("lang", F.col("sent_id").alias("line_id"), F.col("syn").alias("hyp"), "ref")
    bleu = _bleu_rows(pairs, ["lang"])
    em = pairs.groupBy("lang").agg(F.sum((F.col("hyp") == F.col("ref")).cast("bigint")).alias("matches"),
                                   F.count(F.lit(1)).alias("lines"))
    em = em.select("lang", "matches", "lines",
                   F.round(F.try_divide(100 * F.col("matches"), F.col("lines")), 2).alias("accuracy"))
    return bleu.join(em, "lang")




# ---------------------------------------------------------------------------
# Preparation jobs
# ---------------------------------------------------------------------------
# ``corpus`` is the long line table ``split, lang, line_no, text``.
# Stage outputs that later steps reuse (several actions: model counts,
# learning rounds) are checkpointed into the session's checkpoint folder, as
# the stage directories of the original preparation scripts.

def tokenize_corpus(corpus: DataFrame, vi_lexicon: DataFrame | None = None,
                    normalize_form: str = "NFKD") -> DataFrame:
    """T1 then T3 (English) / T4 (Vietnamese): adds ``tokens``.

    The Vietnamese compound lexicon is mined on the training split unless given.
    """
    norm = corpus.withColumn("text", T.unicode_normalize("text", normalize_form))
    # each line is tokenised once, by the rules of its language
    rules = F.when(F.col("lang") == "vi", T.tokenize_13a("text")).otherwise(T.tokenize_en("text"))
    tok = norm.withColumn("tokens", F.filter(F.split(rules, " "), lambda x: x != "")).checkpoint(eager=True)
    en = tok.where(F.col("lang") != "vi")
    vi = tok.where(F.col("lang") == "vi").withColumn("__id", F.concat_ws(":", "split", "line_no"))
    if vi_lexicon is None:
        vi_lexicon = CO.mine(vi.where(F.col("split") == "train"), "tokens")
    seg = CO.segment(vi.select("__id", "tokens"), vi_lexicon, line="__id")
    vi = vi.drop("tokens").join(seg.select("__id", F.split("text", " ").alias("tokens")), "__id", "left") \
        .withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>"))).drop("__id")
    return en.unionByName(vi).checkpoint(eager=True)


def truecase_corpus(tok: DataFrame) -> DataFrame:
    """M1 on the training split of each language, M2 on every split."""
    out = None
    for lang in [r[0] for r in tok.select("lang").distinct().collect()]:
        part = tok.where(F.col("lang") == lang).withColumn("__id", F.concat_ws(":", "split", "line_no"))
        train = part.where(F.col("split") == "train")
        forms = TC.surface_forms(train, "__id").checkpoint(eager=True)
        cased = TC.apply(part.select("__id", "tokens"), TC.best_forms(forms), forms.select("w"), line="__id")
        res = part.drop("tokens").join(cased, "__id", "left").drop("__id") \
            .withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
        out = res if out is None else out.unionByName(res)
    return out.withColumn("text", F.array_join("tokens", " ")).drop("tokens").checkpoint(eager=True)


def _pairs(cased: DataFrame, split: str, src: str = "en", tgt: str = "vi") -> DataFrame:
    a = cased.where((F.col("split") == split) & (F.col("lang") == src)).select("line_no", F.col("text").alias(src))
    b = cased.where((F.col("split") == split) & (F.col("lang") == tgt)).select("line_no", F.col("text").alias(tgt))
    return bind_strict(a, b, ["line_no"], f"{split}: {src} and {tgt}")


def _segmented(sets: DataFrame, merges, types: DataFrame | None = None) -> DataFrame:
    """Both sides of a training set in subwords (M6); ``types``: the learner's word types, if it ran here."""
    known = None if types is None else SW.subwords(types)
    sub = SW.segment(sets, {"src": "src", "tgt": "tgt"}, merges, known)
    return sub.select("split", "line_no", "src", "tgt")


def _side_vocab(sub: DataFrame, side: str) -> DataFrame:
    """Subword vocabulary of one side of the training split: ``token, cnt`` (one vocabulary file a side)."""
    return (sub.where(F.col("split") == "train").select(F.explode(F.split(side, " ")).alias("token"))
            .where(F.col("token") != "").groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))


def prepare_bidirectional(corpus: DataFrame, step: int = 0, prev: DataFrame | None = None,
                          synthetic: DataFrame | None = None, merges=None, dictionary: DataFrame | None = None,
                          num_merges: int = 5000) -> dict:
    """One step of the bidirectional back-translation preparation.

    Step 0 zips en/vi into alternating src/tgt lines (C3); step k > 0 interleaves
    the synthetic lines ``synthetic(line_no, syn_en, syn_vi)`` around step k-1's
    training set ``prev(split, line_no, src, tgt)`` (C4) and carries valid/test
    over (C5). Joint subword codes are learned once (M4) unless ``merges`` are
    given, applied to both sides (M6); sources are tagged (C6) and a joint
    dictionary built (M7) from the training split unless given; both sides are
    encoded (M8). ``src_vocab`` and ``tgt_vocab`` are the subword vocabularies
    of the two sides of the training split. Sides of unequal length raise.
    """
    cased = truecase_corpus(tokenize_corpus(corpus))
    if step == 0:
        sets = None
        for split in ("train", "valid", "test"):
            st = C.build_bidirectional(_pairs(cased, split)).withColumn("split", F.lit(split))
            sets = st if sets is None else sets.unionByName(st)
    else:
        par = bind_strict(_pairs(cased, "train"), synthetic, ["line_no"], "genuine and synthetic lines")
        train = C.build_step(step, par, prev.where(F.col("split") == "train").drop("split"))
        sets = C.carry_forward(train, prev)
    sets = sets.checkpoint(eager=True)
    types = None
    if merges is None:
        both = sets.where(F.col("split") == "train").select(F.split("src", " ").alias("tokens")).unionByName(
            sets.where(F.col("split") == "train").select(F.split("tgt", " ").alias("tokens")))
        merges, types = SW.learn_types(SW.word_types(both), num_merges)
    sub = _segmented(sets, merges, types).checkpoint(eager=True)
    tagged = None
    for split in ("train", "valid", "test"):
        part = C.tag_directions(sub.where(F.col("split") == split), step, split, text="src")
        tagged = part if tagged is None else tagged.unionByName(part)
    tagged = tagged.checkpoint(eager=True)
    toks = tagged.select("split", "line_no", F.split("src", " ").alias("src_t"), F.split("tgt", " ").alias("tgt_t"))
    if dictionary is None:
        seen = toks.where(F.col("split") == "train")
        dictionary = V.build_dictionary(
            seen.select(F.col("src_t").alias("tokens")).unionByName(seen.select(F.col("tgt_t").alias("tokens"))),
            pad_to_multiple=8)
    key = F.concat_ws(":", "split", "line_no")
    src_ids = V.encode(toks.select(key.alias("__rid"), F.col("src_t").alias("tokens")), dictionary, line="__rid")
    tgt_ids = V.encode(toks.select(key.alias("__rid"), F.col("tgt_t").alias("tokens")), dictionary, line="__rid")
    encoded = src_ids.select("__rid", F.col("ids").alias("src_ids")).join(
        tgt_ids.select("__rid", F.col("ids").alias("tgt_ids")), "__rid").withColumnRenamed("__rid", "key")
    return {"sets": sets, "subword": tagged, "merges": merges, "dictionary": dictionary, "encoded": encoded,
            "src_vocab": _side_vocab(sub, "src"), "tgt_vocab": _side_vocab(sub, "tgt")}


def prepare_unidirectional(corpus: DataFrame, src: str, tgt: str, merges, src_dict: DataFrame,
                           tgt_dict: DataFrame | None = None, cased: DataFrame | None = None) -> dict:
    """One direction, no interleaving or tags; reuses the given subword
    codes and dictionaries (the joint ones, or those of step k for fine-tuning).
    ``cased`` is the corpus already tokenised and truecased, if the caller has it."""
    cased = truecase_corpus(tokenize_corpus(corpus)) if cased is None else cased
    sets = None
    for split in ("train", "valid", "test"):
        p = _pairs(cased, split, src, tgt).select("line_no", F.col(src).alias("src"), F.col(tgt).alias("tgt"))
        p = p.withColumn("split", F.lit(split))
        sets = p if sets is None else sets.unionByName(p)
    sub = _segmented(sets, merges).checkpoint(eager=True)
    key = F.concat_ws(":", "split", "line_no")
    s_ids = V.encode(sub.select(key.alias("__rid"), F.split("src", " ").alias("tokens")), src_dict, line="__rid")
    t_ids = V.encode(sub.select(key.alias("__rid"), F.split("tgt", " ").alias("tokens")), tgt_dict or src_dict,
                     line="__rid")
    encoded = s_ids.select("__rid", F.col("ids").alias("src_ids")).join(
        t_ids.select("__rid", F.col("ids").alias("tgt_ids")), "__rid").withColumnRenamed("__rid", "key")
    return {"sets": sets, "subword": sub, "encoded": encoded}


def prepare_independent(corpus: DataFrame, src: str, tgt: str, num_merges: int = 5000) -> dict:
    """One direction with its own subword codes and separate dictionaries."""
    cased = truecase_corpus(tokenize_corpus(corpus))
    train = _pairs(cased, "train", src, tgt)
    both = train.select(F.split(src, " ").alias("tokens")).unionByName(train.select(F.split(tgt, " ").alias("tokens")))
    merges, types = SW.learn_types(SW.word_types(both), num_merges)
    sub = _segmented(train.select(F.lit("train").alias("split"), "line_no", F.col(src).alias("src"),
                                  F.col(tgt).alias("tgt")), merges, types).checkpoint(eager=True)
    src_dict = V.build_dictionary(sub.select(F.split("src", " ").alias("tokens")), pad_to_multiple=8)
    tgt_dict = V.build_dictionary(sub.select(F.split("tgt", " ").alias("tokens")), pad_to_multiple=8)
    out = prepare_unidirectional(corpus, src, tgt, merges, src_dict, tgt_dict, cased)
    out.update({"merges": merges, "src_dict": src_dict, "tgt_dict": tgt_dict,
                "src_vocab": _side_vocab(sub, "src"), "tgt_vocab": _side_vocab(sub, "tgt")})
    return out


def prepare_finetune(corpus: DataFrame, src: str, tgt: str, merges, step_dicts: tuple) -> dict:
    """Fine-tuning data for one direction with the dictionaries of step k."""
    return prepare_unidirectional(corpus, src, tgt, merges, step_dicts[0], step_dicts[1])


def prepare_translation_input(cased: DataFrame, merges) -> DataFrame:
    """P5: step-0 truecased lines segmented with the joint codes and tagged by
    language (<e2v> for English sources, <v2e> for Vietnamese)."""
    tag = F.when(F.col("lang") == "en", F.lit(T.TAG_E2V)).otherwise(F.lit(T.TAG_V2E))
    sub = SW.segment(cased, {"text": "text"}, merges)
    return sub.select("split", "lang", "line_no", T.tag_constant("text", tag).alias("text"))
