"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL twins.

Each query reads the driver tables through the fixture derivations in
:mod:`linea.sources.fixtures` and runs one or more operators over the whole
tables. ``SQL[name]`` is the DuckDB oracle for ``QUERIES[name]``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.operators import alignment as AL
from linea.operators import bleu as B
from linea.operators import bootstrap as BS
from linea.operators import collocations as CO
from linea.operators import compose as C
from linea.operators import metrics as M
from linea.operators import ngrams as NG
from linea.operators import subword as SW
from linea.operators import truecase as TC
from linea.operators import vocab as V
from linea.operators.positional import dense_index
from linea.plans import jobs as J
from linea.plans import oracle as O
from linea.plans.prepare import SPLITS, Preparation
from linea.session import ensure_checkpoint_dir
from linea.sources import fixtures as FX
from linea.sources import text as S
from linea.sources.sinks import append_result, write_lines
from linea.sources.stages import Stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# BLEU (E1-E5)
# ---------------------------------------------------------------------------

def _plain_tokens(p: DataFrame, *keys: str) -> DataFrame:
    return p.select(*keys, "line_id", T.split_ws("hyp").alias("hyp"),
                    F.array(T.split_space("ref")).alias("refs"))


_PLAIN_TOK = ("toks AS (SELECT line_id, lang, " + O.split_ws("hyp") + " AS h, ["
              + O.split_space("ref") + "] AS refs FROM pair)")


@register("bleu_corpus", O.with_ctes("pair", extra=[_PLAIN_TOK] + O.stats_sql("toks", ""))
          + O.bleu_plain_select(f"(SELECT {O.STAT_SUMS} FROM st)"))
def bleu_corpus(spark, sf):
    toks = _plain_tokens(FX.pair(spark, sf))
    return B.bleu_plain(B.corpus_totals(toks, multi_ref=False))


@register("bleu_by_lang", O.with_ctes("pair", extra=[_PLAIN_TOK] + O.stats_sql("toks", "lang"))
          + O.bleu_plain_select(f"(SELECT lang, {O.STAT_SUMS} FROM st GROUP BY lang)", "lang"))
def bleu_by_lang(spark, sf):
    toks = _plain_tokens(FX.pair(spark, sf), "lang")
    return B.bleu_plain(B.corpus_totals(toks, keys=["lang"], multi_ref=False), keys=["lang"])


@register("bleu_sentence_stats", O.with_ctes("pair", extra=[_PLAIN_TOK] + O.stats_sql("toks", ""))
          + "SELECT line_id, " + ", ".join(B.STAT_COLS) + " FROM st")
def bleu_sentence_stats(spark, sf):
    toks = _plain_tokens(FX.pair(spark, sf))
    return B.sentence_stats(toks, multi_ref=False)


def _multi_tokens(spark, sf, hyp_tok=T.split_ws, ref_tok=T.split_space) -> DataFrame:
    m = FX.multi_ref(spark, sf)
    # texts travel, tokens are cut once they are together; dealt by line first: the grouping's two halves sort in one place
    m = m.repartition(B.line_partitions(m), "line_id")
    g = S.group_references(m, "line_id", "ref_id", "ref", carry={"hyp": F.col("hyp")})
    return g.select("line_id", hyp_tok(F.col("hyp")).alias("hyp"), F.transform("refs", ref_tok).alias("refs"))


MULTI_REFS = 2   # reference files per line in the multi-reference fixture
_MULTI_TOK = ("toks AS (SELECT line_id, " + O.split_ws("any_value(hyp)") + " AS h, list("
              + O.split_space("ref") + " ORDER BY ref_id) AS refs FROM multi_ref GROUP BY line_id)")


@register("bleu_multi_ref", O.with_ctes("multi_ref", extra=[_MULTI_TOK] + O.stats_sql("toks", ""))
          + O.bleu_plain_select(f"(SELECT {O.STAT_SUMS} FROM st)"))
def bleu_multi_ref(spark, sf):
    """S3 + E1/E2/E3: two references per line, first reference wins length ties."""
    return B.bleu_plain(B.corpus_totals(_multi_tokens(spark, sf), n_refs=MULTI_REFS))


def _detok_tokens(p: DataFrame, lowercase: bool) -> DataFrame:
    hyp = F.replace(F.col("hyp"), F.lit("&"), F.lit("&amp;"))   # entities decoded by the tokenizer
    if lowercase:
        h = T.tokenize_13a(T.lowercase(hyp))
        r = T.lowercase(T.tokenize_13a(F.col("ref")))
    else:
        h, r = T.tokenize_13a(hyp), T.tokenize_13a(F.col("ref"))
    nonempty = lambda c: F.array_remove(F.split(c, " "), "")
    return p.select("line_id", nonempty(h).alias("hyp"), F.array(nonempty(r)).alias("refs"))


def _detok_sql(lowercase: bool) -> str:
    hyp = "replace(hyp, '&', '&amp;')"
    if lowercase:
        h, r = O.tok13a(f"lower({hyp})"), f"lower({O.tok13a('ref')})"
    else:
        h, r = O.tok13a(hyp), O.tok13a("ref")
    toks = (f"toks AS (SELECT line_id, {O.split_sp_nonempty(h)} AS h, "
            f"[{O.split_sp_nonempty(r)}] AS refs FROM pair)")
    return (O.with_ctes("pair", extra=[toks] + O.stats_sql("toks", "", ties="shorter"))
            + O.bleu_detok_select(f"(SELECT {O.STAT_SUMS} FROM st)"))


@register("bleu_detok", _detok_sql(False))
def bleu_detok(spark, sf):
    """T2 + E1 + E4: detokenised BLEU with the 13a tokenizer, shorter ref wins ties."""
    toks = _detok_tokens(FX.pair(spark, sf), lowercase=False)
    return B.bleu_detok(B.corpus_totals(toks, ties="shorter", multi_ref=False))


@register("bleu_detok_lc", _detok_sql(True))
def bleu_detok_lc(spark, sf):
    """Hypothesis lower-cased before tokenisation, references after."""
    toks = _detok_tokens(FX.pair(spark, sf), lowercase=True)
    return B.bleu_detok(B.corpus_totals(toks, ties="shorter", multi_ref=False))


LENGTH_WIDTH = 10


def _bucket_sql(w: int) -> str:
    tok = ("toks AS (SELECT line_id, " + O.split_ws("any_value(hyp)") + " AS h, list("
           + O.split_space("ref") + " ORDER BY ref_id) AS refs FROM multi_ref GROUP BY line_id)")
    bk = (f"bk AS (SELECT line_id, (len(refs[len(refs)]) // {w})::BIGINT AS bucket, "
          f"list_max(list_transform(refs, lambda r: len(r) // {w}))::BIGINT AS mb FROM toks)")
    per = (f"per AS (SELECT bucket, count(*) AS n_lines, {O.STAT_SUMS} FROM st JOIN bk USING (line_id) "
           f"GROUP BY bucket)")
    g = (f"g AS (SELECT sum(translation_length) AS hl, sum(reference_length) AS rl, "
         f"(SELECT max(mb) FROM bk) AS mb FROM st)")
    start = int(1 / w)
    p = [f"(correct_{j}_grams::DOUBLE / total_{j}_grams)" for j in range(1, 5)]
    logs = "(0.0 + " + " + ".join(O._slog(x) for x in p) + ")"
    gbp = "(CASE WHEN hl >= rl THEN 1.0 ELSE exp(1 - rl::DOUBLE / hl) END)"
    show = "(total_4_grams > 0 AND correct_4_grams > 0)"
    label = ("b::VARCHAR" if w == 1 else f"((b * {w} + 1)::VARCHAR || '-' || ((b + 1) * {w})::VARCHAR)")
    return (O.with_ctes("multi_ref", extra=[tok] + O.stats_sql("toks", "") + [bk, per, g])
            + f"SELECT b::BIGINT AS bucket, {label} AS label, "
              f"CASE WHEN {show} THEN n_lines END::BIGINT AS n_lines, "
              f"CASE WHEN {show} THEN round(100 * {gbp} * exp({logs} / 4), 6) END AS bleu "
              f"FROM (SELECT unnest(generate_series({start}, mb)) AS b, hl, rl FROM g) s "
              f"LEFT JOIN (SELECT * FROM per WHERE bucket <> 0) p ON p.bucket = s.b")


@register("bleu_by_length", _bucket_sql(LENGTH_WIDTH))
def bleu_by_length(spark, sf, width: int = LENGTH_WIDTH):
    """E5: BLEU per reference-length bucket (last reference decides the bucket)."""
    toks = _multi_tokens(spark, sf)
    toks = toks.select("*", (F.size(F.element_at("refs", -1)) / width).cast("bigint").alias("bucket"),
                       F.array_max(F.transform("refs", lambda r: (F.size(r) / width).cast("bigint")))
                       .alias("max_bucket_ref"))
    st = B.sentence_stats(toks, keys=["bucket", "max_bucket_ref"], n_refs=MULTI_REFS)
    return B.bleu_by_length(st, width)


# ---------------------------------------------------------------------------
# Row-level text functions (T1-T14), decoder logs (S6, F1, F2, C7), E6
# ---------------------------------------------------------------------------

@register("join_subwords", O.with_ctes("marked") + f"SELECT line_id, {O.join_subwords('text')} AS text FROM marked")
def join_subwords(spark, sf):
    """Remove subword continuation marks."""
    return FX.marked(spark, sf).select("line_id", T.join_subwords("text").alias("text"))


@register("join_compounds", O.with_ctes("marked") + "SELECT line_id, replace(text, '_', ' ') AS text FROM marked")
def join_compounds(spark, sf):
    """Every underscore becomes a blank."""
    return FX.marked(spark, sf).select("line_id", T.join_compounds("text").alias("text"))


@register("detruecase", O.with_ctes("seg")
          + f"SELECT line_id, {O.detruecase(O.tok13a('lower(text)'))} AS text FROM seg")
def detruecase(spark, sf):
    """Sentence-initial upper-casing of tokenised, lower-cased lines."""
    s = FX.seg(spark, sf).select("line_id", T.tokenize_13a(F.lower("text")).alias("t"))
    return s.select("line_id", T.detruecase("t").alias("text"))


@register("tokenize_13a", O.with_ctes("seg") + f"SELECT line_id, {O.tok13a('text')} AS text FROM seg")
def tokenize_13a(spark, sf):
    """13a tokenisation of every line."""
    return FX.seg(spark, sf).select("line_id", T.tokenize_13a("text").alias("text"))


@register("tokenize_en", O.with_ctes("seg")
          + f"SELECT line_id, {O.tokenize_en('text')} AS text FROM seg WHERE lang = 'en'")
def tokenize_en(spark, sf):
    """English tokenisation (13a + clitics) of the English lines."""
    return (FX.seg(spark, sf).where(F.col("lang") == "en")
            .select("line_id", T.tokenize_en("text").alias("text")))


@register("split_lengths", O.with_ctes("padded")
          + f"SELECT line_id, len({O.split_ws('text')})::BIGINT AS n_ws, "
            f"len({O.split_space('text')})::BIGINT AS n_space, "
            f"len(list_filter(regexp_split_to_array(regexp_replace(text, '^{O.UWS_SQL}+|{O.UWS_SQL}+$', '', 'g'), "
            f"'{O.UWS_SQL}+'), lambda x: x <> ''))::BIGINT AS n_eval FROM padded")
def split_lengths(spark, sf):
    """Token counts under the three splitting rules."""
    p = FX.padded(spark, sf)
    return p.select("line_id", F.size(T.split_ws("text")).cast("bigint").alias("n_ws"),
                    F.size(T.split_space("text")).cast("bigint").alias("n_space"),
                    F.size(T.eval_preproc("text", "bleu")).cast("bigint").alias("n_eval"))


@register("ngram_counts", O.with_ctes("seg", extra=[
    "toks AS (SELECT line_id, " + O.split_ws("text") + " AS h FROM seg)",
    f"g AS ({O.ngram_rows('toks', 'h', 'line_id')})"])
    + "SELECT n, count(*)::BIGINT AS n_grams, count(DISTINCT gram)::BIGINT AS distinct_grams FROM g GROUP BY n")
def ngram_counts(spark, sf):
    """N-gram occurrences and distinct n-grams per order over the corpus."""
    return NG.order_counts(FX.seg(spark, sf).select(T.split_ws("text").alias("tokens")))


@register("nfkd_strip", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def nfkd_strip(spark, sf):
    """NFKD, then combining marks removed (oracled form of the normaliser)."""
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", T.strip_marks(T.unicode_normalize("text", "NFKD")).alias("text"))


@register("nfkd")
def nfkd(spark, sf):
    """Raw NFKD of every document (no SQL twin: DuckDB lacks NFKD)."""
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", T.unicode_normalize("text", "NFKD").alias("text"))


@register("decoder_log_parse", O.with_ctes("parsed_log") + "SELECT id, score, text FROM parsed_log")
def decoder_log_parse(spark, sf):
    """Hypothesis rows of the decoder log, keyed by input id."""
    return S.parse_decoder_log(FX.decoder_log(spark, sf))


@register("parity_route", O.with_ctes("parsed_log")
          + "SELECT id // 2 AS sent_id, CASE WHEN id % 2 = 0 THEN 'vi' ELSE 'en' END AS lang, "
            f"{O.join_subwords('text')} AS text FROM parsed_log")
def parity_route(spark, sf):
    """F2 + T7: even ids are Vietnamese outputs, odd ids English; sentence = id div 2."""
    return C.route_by_parity(S.parse_decoder_log(FX.decoder_log(spark, sf)))


@register("collect_synthetic", O.with_ctes("parsed_log")
          + f"SELECT id, CASE WHEN id % 2 = 0 THEN 'vi' ELSE 'en' END AS lang, {O.join_subwords('text')} AS tok, "
            f"CASE WHEN id % 2 = 0 THEN replace({O.join_subwords('text')}, '_', ' ') ELSE {O.join_subwords('text')} END AS syn "
            "FROM parsed_log")
def collect_synthetic(spark, sf):
    """Both synthetic sides of a back-translation step (tok -> syn): even ids Vietnamese, odd ids English."""
    log = S.parse_decoder_log(FX.decoder_log(spark, sf))
    sides = [C.collect_synthetic(log.where(F.col("id") % 2 == r), lang).withColumn("lang", F.lit(lang))
             for r, lang in enumerate(("vi", "en"))]
    return sides[0].unionByName(sides[1])


@register("block_route", O.with_ctes("parsed_log")
          + "SELECT id // 4 * 2 + id % 2 AS sent_id, CASE WHEN id % 4 < 2 THEN 'vi' ELSE 'en' END AS lang, "
            f"{O.join_subwords('text')} AS text FROM parsed_log")
def block_route(spark, sf):
    """outputs in blocks of four lines (a step-1 run): two Vietnamese, then two English."""
    return C.route_by_parity(S.parse_decoder_log(FX.decoder_log(spark, sf)), block=4)


@register("exact_match", O.with_ctes("pair")
          + "SELECT count(*) FILTER (WHERE hyp = ref)::BIGINT AS matches, count(*)::BIGINT AS lines, "
            "round(100 * count(*) FILTER (WHERE hyp = ref) / count(*), 2) AS accuracy FROM pair")
def exact_match(spark, sf):
    """Share of identical lines between two positionally bound files."""
    return M.exact_match(FX.pair(spark, sf), "hyp", "ref")


# ---------------------------------------------------------------------------
# Composition of training sets (C1-C6), tags
# ---------------------------------------------------------------------------

def _steps(spark, sf, k_max: int, par: DataFrame | None = None) -> list[DataFrame]:
    # the bound corpus is read by every union branch of every step: materialise it once
    par = (par if par is not None else FX.parallel(spark, sf)).checkpoint(eager=True)
    steps = [C.build_bidirectional(par)]
    for k in range(1, k_max + 1):
        steps.append(C.build_step(k, par, steps[-1]))
    return steps


for _k in range(3):
    def _make(k):
        def q(spark, sf):
            return _steps(spark, sf, k)[k]
        q.__doc__ = f"C1/C3/C4: training set of back-translation step {k} (stride {k})."
        q.__name__ = f"interleave_step{k}"
        return q
    register(f"interleave_step{_k}", O.with_ctes("par", extra=O.step_ctes(_k))
             + f"SELECT line_no, src, tgt FROM step{_k}")(_make(_k))


@register("concat_all", O.with_ctes("par", "numbered")
          + "SELECT line_no, en AS text FROM par UNION ALL "
            "SELECT line_no + (SELECT count(*) FROM par), vi FROM par UNION ALL "
            "SELECT line_no + 2 * (SELECT count(*) FROM par), text FROM numbered")
def concat_all(spark, sf):
    """A, then b, then the previous lines, renumbered."""
    par = FX.parallel(spark, sf).checkpoint(eager=True)
    return C.concat_all([par.select("line_no", F.col("en").alias("text")),
                         par.select("line_no", F.col("vi").alias("text")),
                         FX.numbered(spark, sf).select("line_no", "text")])


@register("carry_forward", O.with_ctes("par_split", extra=O.step_ctes(1, "par_split", where="split = 'train'"))
          + "SELECT 'train' AS split, line_no, src, tgt FROM step1 UNION ALL "
            "SELECT split, line_no * 2, en, vi FROM par_split WHERE split <> 'train' UNION ALL "
            "SELECT split, line_no * 2 + 1, vi, en FROM par_split WHERE split <> 'train'")
def carry_forward(spark, sf):
    """Step 1 = rebuilt train split + valid/test carried over from step 0."""
    prev = None
    pars = {split: FX.parallel_split(spark, sf, split).checkpoint(eager=True) for split in ("train", "valid", "test")}
    for split in ("train", "valid", "test"):
        s0 = C.build_bidirectional(pars[split]).withColumn("split", F.lit(split))
        prev = s0 if prev is None else prev.unionByName(s0)
    train_par = pars["train"]
    new_train = C.build_step(1, train_par, prev.where(F.col("split") == "train").drop("split"))
    return C.carry_forward(new_train, prev)


@register("tag_constant", O.with_ctes("seg")
          + "SELECT line_id, CASE WHEN lang = 'en' THEN '<e2v>' ELSE '<v2e>' END || ' ' || text AS text FROM seg")
def tag_constant(spark, sf):
    """Constant direction tag by language of the source line."""
    s = FX.seg(spark, sf)
    tag = F.when(F.col("lang") == "en", F.lit(T.TAG_E2V)).otherwise(F.lit(T.TAG_V2E))
    return s.select("line_id", T.tag_constant("text", tag).alias("text"))


@register("tag_cyclic", O.with_ctes("numbered")
          + "SELECT line_no, CASE WHEN line_no % 3 + 1 <= 1 THEN '<e2v>' ELSE '<v2e>' END || ' ' || text AS text "
            "FROM numbered")
def tag_cyclic(spark, sf):
    """Cycle of 3 lines: first tagged <e2v>, next two <v2e>."""
    return C.tag_cyclic(FX.numbered(spark, sf).select("line_no", "text"), 1, T.TAG_E2V, 3, T.TAG_V2E)


@register("tag_directions", O.with_ctes("par", extra=O.step_ctes(1))
          + "SELECT line_no, CASE WHEN line_no % 4 < 2 THEN '<e2v>' ELSE '<v2e>' END || ' ' || src AS src, tgt "
            "FROM step1")
def tag_directions(spark, sf):
    """Step-1 train sources tagged in blocks of 2(k+1) = 4 lines."""
    return C.tag_directions(_steps(spark, sf, 1)[1], 1, "train", text="src")


# ---------------------------------------------------------------------------
# Metrics (E7-E10) and paired bootstrap
# ---------------------------------------------------------------------------
BOOT_SEED = BS.DEFAULT_SEED
BOOT_SAMPLES = 1000  # E11
REPORT_SAMPLES = 10_000  # E12
BOOT_RATIO = 0.5


def _eval_tok(c):
    return T.eval_preproc(c, "bleu")


def _detok13a_tok(c):
    return F.array_remove(F.split(T.tokenize_13a(T.strip_unicode(c)), " "), "")


def _line_stats(spark, sf, system: int, tok, ties: str) -> DataFrame:
    p = FX.pair(spark, sf, system)
    t = p.select("line_id", tok(F.col("hyp")).alias("hyp"), F.array(tok(F.col("ref"))).alias("refs"))
    return B.sentence_stats(t, ties=ties, multi_ref=False)


def _paired_stats(spark, sf, rules: str, ties: str) -> DataFrame:
    """``n`` and both systems' per-line statistics from one pass over the shared references.

    The statistics are computed row by row, once, and written to the checkpoint
    folder: numbering and every resample read them there, not the texts.
    """
    t = FX.pair_ab(spark, sf).select("line_id", "hyp_a", "hyp_b", F.array("ref").alias("refs"))
    stats = B.paired_sentence_stats(t, ties=ties, n_refs=1, cut=T.Cut(rules)).checkpoint(eager=True)
    return dense_index(stats, "line_id", "n").drop("line_id")


def _sql_eval_tok(c):
    return f"list_filter(regexp_split_to_array({O.strip_sql(c)}, '{O.UWS_SQL}+'), lambda x: x <> '')"


def _sql_detok_tok(c):
    return O.split_sp_nonempty(O.tok13a(O.strip_sql(c)))


def _sql_two_systems(tok, ties: str) -> list[str]:
    out = [f"ta AS (SELECT line_id, {tok('hyp')} AS h, [{tok('ref')}] AS refs FROM pair)",
           f"tb AS (SELECT line_id, {tok('hyp')} AS h, [{tok('ref')}] AS refs FROM pair_b)"]
    out += O.stats_sql("ta", "", ties, name="sa") + O.stats_sql("tb", "", ties, name="sb")
    cols = ", ".join([f"sa.{c} AS a_{c}" for c in B.STAT_COLS] + [f"sb.{c} AS b_{c}" for c in B.STAT_COLS])
    out.append(f"both_ AS (SELECT (row_number() OVER (ORDER BY line_id) - 1)::BIGINT AS n, {cols} "
               f"FROM sa JOIN sb USING (line_id))")
    return out


def _sql_sums(cols: list[str]) -> str:
    return ("sums AS (SELECT b, " + ", ".join(f"sum({c}) AS {c}" for c in cols)
            + " FROM dr JOIN both_ ON both_.n = dr.idx GROUP BY b)")


_AB = ["a_" + c for c in B.STAT_COLS] + ["b_" + c for c in B.STAT_COLS]


def _compare_sql() -> str:
    ctes = _sql_two_systems(_sql_eval_tok, "first") + [
        O.draws_sql("both_", BOOT_SAMPLES, None, BOOT_SEED, True), _sql_sums(_AB),
        f"per AS (SELECT b, {O.score_sql('a_')} AS sa, {O.score_sql('b_')} AS sb FROM sums)"]
    return (O.with_ctes("pair", "pair_b", extra=ctes)
            + "SELECT round(max(sa) FILTER (WHERE b < 0), 6) AS baseline_bleu, "
              "round(max(sb) FILTER (WHERE b < 0), 6) AS new_bleu, "
              "round(max(sb) FILTER (WHERE b < 0) - max(sa) FILTER (WHERE b < 0), 6) AS delta, "
              f"{BOOT_SAMPLES}::BIGINT AS num_samples, "
              "count(*) FILTER (WHERE b >= 0 AND sa > sb)::BIGINT AS baseline_better, "
              "count(*) FILTER (WHERE b >= 0 AND NOT coalesce(sa > sb OR sb > sa, false))::BIGINT AS num_equal, "
              "count(*) FILTER (WHERE b >= 0 AND sb > sa)::BIGINT AS new_better, "
              f"round(count(*) FILTER (WHERE b >= 0 AND sa > sb) / {BOOT_SAMPLES}, 6) AS baseline_conf, "
              f"round(count(*) FILTER (WHERE b >= 0 AND sb > sa) / {BOOT_SAMPLES}, 6) AS new_conf FROM per")


@register("bootstrap_bleu", _compare_sql())
def bootstrap_bleu(spark, sf):
    """Paired bootstrap (B=1000, m=n) of two systems' BLEU from sufficient statistics."""
    both = _paired_stats(spark, sf, "bleu", "first")
    return BS.compare_paired(both, lambda pre: B.bleu_score_expr(pre, "none", 100.0),
                             samples=BOOT_SAMPLES, seed=BOOT_SEED, stat_cols=B.STAT_COLS)


def _report_sql(src_ctes: list[str], src: str, cols: list[str], s1: str, s2: str) -> str:
    lo, hi = int(REPORT_SAMPLES * 0.025) + 1, int(REPORT_SAMPLES * 0.975) + 1
    ctes = src_ctes + [O.draws_sql(src, REPORT_SAMPLES, BOOT_RATIO, BOOT_SEED, False),
                       "sums AS (SELECT b, " + ", ".join(f"sum({c}) AS {c}" for c in cols)
                       + f" FROM dr JOIN {src} ON {src}.n = dr.idx GROUP BY b)",
                       f"per AS (SELECT b, {s1} AS s1, {s2} AS s2 FROM sums, "
                       f"(SELECT floor(count(*) * {BOOT_RATIO})::BIGINT AS m FROM {src}) mm)",
                       f"w AS (SELECT count(*) FILTER (WHERE s1 > s2) / {REPORT_SAMPLES} AS w1, "
                       f"count(*) FILTER (WHERE s2 > s1) / {REPORT_SAMPLES} AS w2, "
                       + ", ".join(f"avg({s}) AS {s}_mean, median({s}) AS {s}_median, "
                                   f"list_sort(list({s}))[{lo}] AS {s}_lo, list_sort(list({s}))[{hi}] AS {s}_hi"
                                   for s in ("s1", "s2")) + " FROM per)"]
    return ("WITH " + ",\n".join(ctes) + "\n"
            + "SELECT round(w1, 6) AS win_sys1, round(w2, 6) AS win_sys2, round(1 - w1 - w2, 6) AS win_tie, "
              "round(CASE WHEN w1 > w2 THEN 1 - w1 WHEN w2 > w1 THEN 1 - w2 END, 6) AS p_value, "
            + ", ".join(f"round({s}_{k}, 6) AS sys{s[1]}_{k}" for s in ("s1", "s2")
                        for k in ("mean", "median", "lo", "hi")) + " FROM w")


def _with_body(names: list[str], extra: list[str]) -> list[str]:
    sql = O.with_ctes(*names, extra=extra)
    return [sql[len("WITH "):].rstrip("\n")]


def _report_bleu(spark, sf, rules, ties, smooth):
    both = _paired_stats(spark, sf, rules, ties)
    n = both.count()
    m = int(n * BOOT_RATIO)
    sums = BS.resample_sums(both, _AB, REPORT_SAMPLES, m, BOOT_SEED, n)
    return BS.report(sums, B.bleu_score_expr("a_", smooth, 1.0), B.bleu_score_expr("b_", smooth, 1.0),
                     REPORT_SAMPLES)


@register("bootstrap_bleu01", _report_sql(
    _with_body(["pair", "pair_b"], _sql_two_systems(_sql_eval_tok, "shorter")), "both_", _AB,
    O.score_sql("a_", "zero_if_any", 1.0), O.score_sql("b_", "zero_if_any", 1.0)))
def bootstrap_bleu01(spark, sf):
    """E12 (bleu): token BLEU 0-1 per resample of half the lines, B=10,000."""
    return _report_bleu(spark, sf, "bleu", "shorter", "zero_if_any")


@register("bootstrap_bleu_detok", _report_sql(
    _with_body(["pair", "pair_b"], _sql_two_systems(_sql_detok_tok, "shorter")), "both_", _AB,
    O.score_sql("a_", "exp", 1.0), O.score_sql("b_", "exp", 1.0)))
def bootstrap_bleu_detok(spark, sf):
    """E12 (bleu_detok): 13a-tokenised BLEU with exponential smoothing, 0-1."""
    return _report_bleu(spark, sf, "13a", "shorter", "exp")


_ACC_COLS = ["m1", "m2"]


@register("bootstrap_acc", _report_sql(
    _with_body(["gold"], [f"acc AS (SELECT n, ({O.strip_sql('gold')} = {O.strip_sql('sys1')})::INT::DOUBLE AS m1, "
                          f"({O.strip_sql('gold')} = {O.strip_sql('sys2')})::INT::DOUBLE AS m2 FROM gold)"]),
    "acc", _ACC_COLS, "m1 / m", "m2 / m"))
def bootstrap_acc(spark, sf):
    """E12 (acc): accuracy of two label files per resample of half the lines."""
    g = FX.gold(spark, sf)
    st = g.select("n", M.accuracy_stat("gold", "sys1").alias("m1"), M.accuracy_stat("gold", "sys2").alias("m2"))
    n = st.count()
    m = int(n * BOOT_RATIO)
    sums = BS.resample_sums(st, _ACC_COLS, REPORT_SAMPLES, m, BOOT_SEED, n)
    return BS.report(sums, F.col("m1") / m, F.col("m2") / m, REPORT_SAMPLES)


_P_COLS = [f"{s}{k}" for s in ("qa_", "qb_") for k in ("x", "y", "xx", "yy", "xy")]


def _pearson_sql(pre):
    return (f"(({pre}xy * m - {pre}x * {pre}y) / "
            f"CASE WHEN (m * {pre}xx - {pre}x * {pre}x) * (m * {pre}yy - {pre}y * {pre}y) = 0 THEN NULL "
            f"ELSE sqrt((m * {pre}xx - {pre}x * {pre}x) * (m * {pre}yy - {pre}y * {pre}y)) END)")


@register("bootstrap_pearson", _report_sql(
    _with_body(["scores"], [
        "mo AS (SELECT avg(gold) AS mg, avg(sys1) AS m1, avg(sys2) AS m2 FROM scores)",
        "pm AS (SELECT n, gold - mg AS qa_x, sys1 - m1 AS qa_y, (gold - mg) * (gold - mg) AS qa_xx, "
        "(sys1 - m1) * (sys1 - m1) AS qa_yy, (gold - mg) * (sys1 - m1) AS qa_xy, gold - mg AS qb_x, "
        "sys2 - m2 AS qb_y, (gold - mg) * (gold - mg) AS qb_xx, (sys2 - m2) * (sys2 - m2) AS qb_yy, "
        "(gold - mg) * (sys2 - m2) AS qb_xy FROM scores, mo)"]),
    "pm", _P_COLS, _pearson_sql("qa_"), _pearson_sql("qb_")))
def bootstrap_pearson(spark, sf):
    """E12 (pearson): correlation with the gold scores per resample of half the lines."""
    s = FX.scores(spark, sf).checkpoint(eager=True)
    mean = s.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in ("gold", "sys1", "sys2")]).first()
    g, one, two = [F.col(c) - F.lit(mean[c]) for c in ("gold", "sys1", "sys2")]
    st = s.select("n", *[v.alias(p + k) for p, y in (("qa_", one), ("qb_", two))
                         for k, v in (("x", g), ("y", y), ("xx", g * g), ("yy", y * y), ("xy", g * y))])
    n = mean["n"]
    m = int(n * BOOT_RATIO)
    sums = BS.resample_sums(st, _P_COLS, REPORT_SAMPLES, m, BOOT_SEED, n)
    pear = lambda p: M.pearson_from_sums(F.lit(float(m)), *[F.col(p + k) for k in ("x", "y", "xx", "yy", "xy")])
    return BS.report(sums, pear("qa_"), pear("qb_"), REPORT_SAMPLES)


@register("metric_accuracy", O.with_ctes("gold")
          + f"SELECT round(avg(({O.strip_sql('gold')} = {O.strip_sql('sys1')})::INT::DOUBLE), 6) AS accuracy FROM gold")
def metric_accuracy(spark, sf):
    """Accuracy of system 1 labels."""
    return M.accuracy(FX.gold(spark, sf), "gold", "sys1").select(F.round("accuracy", 6).alias("accuracy"))


@register("metric_pearson", O.with_ctes("scores")
          + "SELECT round(covar_pop(gold, sys1) / sqrt(var_pop(gold) * var_pop(sys1)), 6) AS pearson FROM scores")
def metric_pearson(spark, sf):
    """Pearson correlation of system 1 scores with the gold scores."""
    return M.pearson(FX.scores(spark, sf), "gold", "sys1").select(F.round("pearson", 6).alias("pearson"))


def _metric_bleu_sql(tok, ties, smooth):
    ctes = [f"ta AS (SELECT line_id, {tok('hyp')} AS h, [{tok('ref')}] AS refs FROM pair)"] \
        + O.stats_sql("ta", "", ties, name="sa")
    return (O.with_ctes("pair", extra=ctes)
            + f"SELECT round({O.score_sql('', smooth, 1.0)}, 6) AS bleu FROM (SELECT {O.STAT_SUMS} FROM sa)")


@register("metric_bleu01", _metric_bleu_sql(_sql_eval_tok, "shorter", "zero_if_any"))
def metric_bleu01(spark, sf):
    """Token corpus BLEU on the 0-1 scale (0 when a precision is 0)."""
    st = B.sum_stats(_line_stats(spark, sf, 1, _eval_tok, "shorter"))
    return st.select(F.round(B.bleu_score_expr("", "zero_if_any", 1.0), 6).alias("bleu"))


@register("metric_bleu_detok01", _metric_bleu_sql(_sql_detok_tok, "shorter", "exp"))
def metric_bleu_detok01(spark, sf):
    """13a-tokenised corpus BLEU with exponential smoothing, 0-1."""
    st = B.sum_stats(_line_stats(spark, sf, 1, _detok13a_tok, "shorter"))
    return st.select(F.round(B.bleu_score_expr("", "exp", 1.0), 6).alias("bleu"))


# ---------------------------------------------------------------------------
# Evaluation pipelines
# ---------------------------------------------------------------------------

def _bleu_sql_by(names: list[str], pre_ctes: list[str], src: str, keys: str) -> str:
    return (O.with_ctes(*names, extra=pre_ctes + [O.plain_tok_cte(src, keys)] + O.stats_sql("toks", keys))
            + O.bleu_plain_select(f"(SELECT {keys + ', ' if keys else ''}{O.STAT_SUMS} FROM st"
                                  f"{' GROUP BY ' + keys if keys else ''})", keys))


_SWEEP_SQL = ("WITH r AS (" + _bleu_sql_by(["sweep_hyps"], [], "sweep_hyps", "checkpoint, direction")
              + ") SELECT *, bleu = max(bleu) OVER (PARTITION BY direction) AS is_best FROM r")


@register("checkpoint_sweep", _SWEEP_SQL)
def checkpoint_sweep(spark, sf):
    """Validation BLEU of checkpoints 21-30 in both directions; best flagged."""
    return J.checkpoint_sweep(FX.sweep_hyps(spark, sf), FX.sweep_refs(spark, sf), list(range(21, 31)))


@register("eval_bidirectional", _bleu_sql_by(
    ["parsed_log", "eval_refs"],
    ["hr AS (SELECT CASE WHEN id % 2 = 0 THEN 'en>vi' ELSE 'vi>en' END AS direction, id // 2 AS line_id, "
     f"replace({O.detruecase(O.join_subwords('text'))}, '_', ' ') AS hyp, r.ref FROM parsed_log "
     "JOIN eval_refs r ON r.sent_id = id // 2 AND r.lang = CASE WHEN id % 2 = 0 THEN 'vi' ELSE 'en' END)"],
    "hr", "direction"))
def eval_bidirectional(spark, sf):
    """S6 -> F2 -> T7 -> T9 -> T8 -> BLEU per direction of a bidirectional run."""
    return J.evaluate_bidirectional(FX.decoder_log(spark, sf), FX.eval_refs(spark, sf))


@register("eval_unidirectional", _bleu_sql_by(
    ["decoder_log_uni"],
    ["pl AS (SELECT regexp_extract(string_split(line, chr(9))[1], '^H-(\\d+)$', 1)::BIGINT AS id, "
     "coalesce(string_split(line, chr(9))[3], '') AS text FROM decoder_log_uni WHERE starts_with(line, 'H'))",
     f"hr AS (SELECT id AS line_id, {O.postprocess('text')} AS hyp, p.ref FROM pl JOIN pair p ON p.line_id = pl.id)"],
    "hr", ""))
def eval_unidirectional(spark, sf):
    """The same pipeline for a one-direction run (no parity routing)."""
    refs = FX.pair(spark, sf).select(F.col("line_id").alias("sent_id"), "ref")
    return J.evaluate_unidirectional(FX.decoder_log_uni(spark, sf), refs)


_BT_PRE = [
    "syn AS (SELECT id // 2 AS sent_id, CASE WHEN id % 2 = 0 THEN 'vi' ELSE 'en' END AS lang, "
    f"CASE WHEN id % 2 = 0 THEN replace({O.join_subwords('text')}, '_', ' ') ELSE {O.join_subwords('text')} END "
    "AS syn FROM parsed_log)",
    "hr AS (SELECT s.lang, s.sent_id AS line_id, s.syn AS hyp, "
    f"CASE WHEN t.lang = 'vi' THEN replace({O.join_subwords('t.ref')}, '_', ' ') ELSE {O.join_subwords('t.ref')} END "
    "AS ref FROM syn s JOIN translation_data t ON t.sent_id = s.sent_id AND t.lang = s.lang)"]

_BT_SQL = ("WITH b AS (" + _bleu_sql_by(["parsed_log", "translation_data"], _BT_PRE, "hr", "lang") + "), "
           "e AS (" + O.with_ctes("parsed_log", "translation_data", extra=_BT_PRE)
           + "SELECT lang, count(*) FILTER (WHERE hyp = ref)::BIGINT AS matches, count(*)::BIGINT AS lines, "
             "round(100 * count(*) FILTER (WHERE hyp = ref) / count(*), 2) AS accuracy FROM hr GROUP BY lang) "
           "SELECT * FROM b JOIN e USING (lang)")


@register("backtranslation_quality", _BT_SQL)
def backtranslation_quality(spark, sf):
    """BLEU and exact match of the collected synthetic sides against the training text."""
    log = S.parse_decoder_log(FX.decoder_log(spark, sf))
    vi = C.collect_synthetic(log.where(F.col("id") % 2 == 0), "vi")
    en = C.collect_synthetic(log.where(F.col("id") % 2 == 1), "en")
    syn = vi.select((F.col("id") / 2).cast("bigint").alias("sent_id"), F.lit("vi").alias("lang"), "syn") \
        .unionByName(en.select(((F.col("id") - 1) / 2).cast("bigint").alias("sent_id"),
                               F.lit("en").alias("lang"), "syn"))
    return J.backtranslation_quality(syn, FX.translation_data(spark, sf))


# ---------------------------------------------------------------------------
# Word alignment
# ---------------------------------------------------------------------------

def _align_inputs(spark, sf, all_sure=False, ignore_possible=False):
    lines = FX.alignment_lines(spark, sf)
    ref = AL.reference_sets(AL.parse_links(lines, "ref_line"), all_sure, ignore_possible)
    hyp = AL.hypothesis_set(AL.parse_links(lines, "hyp_line"))
    return hyp, ref


def _aer_sql(alpha=-1.0, clean=False, all_sure=False, ignore_possible=False):
    names = ["parsed_links"] + (["hwords"] if clean else [])
    extra = [O.rsets_sql(all_sure, ignore_possible)]
    hyp = "hset"
    if clean:
        extra.append(f"hclean AS (SELECT sent_id, src, tgt FROM hwords WHERE NOT ((list_contains({O.PUNCT_SQL}, "
                     f"src_word) OR list_contains({O.PUNCT_SQL}, tgt_word)) AND src_word <> tgt_word))")
        hyp = "hclean"
    return O.with_ctes(*names, extra=extra) + O.aer_select(hyp, alpha, "hset")


@register("aer", _aer_sql())
def aer(spark, sf):
    """Alignment error rate, precision, recall from link files."""
    return AL.aer_metrics(AL.alignment_flags(FX.alignment_lines(spark, sf)))


@register("aer_f", _aer_sql(alpha=0.5))
def aer_f(spark, sf):
    """A4: with the F-measure at alpha = 0.5."""
    return AL.aer_metrics(AL.alignment_flags(FX.alignment_lines(spark, sf)), alpha=0.5)


@register("aer_all_sure", _aer_sql(all_sure=True, ignore_possible=True))
def aer_all_sure(spark, sf):
    """A2: all reference links sure and possible links ignored (S is then not within P)."""
    flags = AL.alignment_flags(FX.alignment_lines(spark, sf), all_sure=True, ignore_possible=True)
    return AL.aer_metrics(flags)


@register("aer_clean", _aer_sql(clean=True))
def aer_clean(spark, sf):
    """AER after dropping punctuation links between different words."""
    flags = AL.alignment_flags(FX.alignment_lines(spark, sf))
    return AL.aer_metrics(AL.clean_flags(flags, FX.align_sentences(spark, sf)))


@register("align_errors_topk", O.with_ctes("hwords", extra=[O.rsets_sql()])
          + "SELECT src_word, tgt_word, count(*) AS cnt FROM hwords h WHERE NOT EXISTS (SELECT 1 FROM rsets r "
            "WHERE r.p = 1 AND r.sent_id = h.sent_id AND r.src = h.src AND r.tgt = h.tgt) "
            "GROUP BY ALL ORDER BY cnt DESC, src_word, tgt_word LIMIT 10")
def align_errors_topk(spark, sf):
    """A5: the ten most common (source word, target word) pairs among links outside P."""
    hyp, ref = _align_inputs(spark, sf)
    return AL.alignment_errors(AL.with_words(hyp, FX.align_sentences(spark, sf)), ref, 10)


@register("align_coverage", O.with_ctes("parsed_links", "align_sentences")
          + "SELECT round((SELECT count(*) FROM (SELECT DISTINCT sent_id, src FROM hset)) / "
            "greatest((SELECT sum(len(src_words)) FROM align_sentences), 1), 6) AS source_coverage, "
            "round((SELECT count(*) FROM (SELECT DISTINCT sent_id, tgt FROM hset)) / "
            "greatest((SELECT sum(len(tgt_words)) FROM align_sentences), 1), 6) AS target_coverage")
def align_coverage(spark, sf):
    """Share of source/target words that carry a hypothesis link."""
    hyp, _ = _align_inputs(spark, sf)
    return AL.coverage(hyp, FX.align_sentences(spark, sf))


@register("align_jumps", O.with_ctes("parsed_links", extra=[
    "g AS (SELECT sent_id, tgt, min(src) AS lo, max(src) AS hi, count(*) AS cnt, list(src) AS srcs "
    "FROM hset GROUP BY ALL)",
    "j AS (SELECT *, lag(tgt) OVER (PARTITION BY sent_id ORDER BY tgt) AS pt, "
    "lag(lo) OVER (PARTITION BY sent_id ORDER BY tgt) AS plo FROM g)"])
    + "SELECT sum(CASE WHEN cnt > 1 AND hi - lo + 1 <> cnt THEN 1 ELSE 0 END)::BIGINT AS internal_jumps, "
      "sum(CASE WHEN pt = tgt - 1 AND NOT list_has_any([plo - 1, plo, plo + 1], srcs) THEN 1 ELSE 0 END)::BIGINT "
      "AS external_jumps FROM j")
def align_jumps(spark, sf):
    """Internal and external jumps of the hypothesis alignment."""
    hyp, _ = _align_inputs(spark, sf)
    return AL.jumps(hyp)


# ---------------------------------------------------------------------------
# Text models: truecasing (M1/M2), dictionary (M7/M8), subwords (M3-M6), T4
# ---------------------------------------------------------------------------

def _tc_tokens(spark, sf) -> DataFrame:
    s = FX.seg(spark, sf)
    return s.select("line_id", F.array_remove(F.split(T.tokenize_13a("text"), " "), "").alias("tokens"))


_TC_BASE = [f"tct AS (SELECT line_id, {O.nonempty_13a('text')} AS w FROM seg)", O.tc_positions_cte("tct"),
            "tcm AS (SELECT lower(w) AS lc, first(w ORDER BY cnt DESC, w ASC) AS best, max(cnt) AS best_count, "
            "sum(cnt)::BIGINT AS total FROM (SELECT w, count(*) AS cnt FROM tcp WHERE NOT start AND w <> '' "
            "GROUP BY w) GROUP BY lower(w))"]


@register("truecase_model", O.with_ctes("seg", extra=_TC_BASE) + "SELECT lc, best, best_count, total FROM tcm")
def truecase_model(spark, sf):
    """M1: commonest surface form per lower-cased word (non-initial tokens)."""
    return TC.train(_tc_tokens(spark, sf))


@register("truecase_apply", O.with_ctes("seg", extra=_TC_BASE + [
    "known AS (SELECT DISTINCT w FROM tcp WHERE NOT start AND w <> '')"])
    + "SELECT line_id, list(CASE WHEN start AND m.best IS NOT NULL THEN m.best WHEN k.w IS NOT NULL THEN p.w "
      "WHEN m.best IS NOT NULL THEN m.best ELSE p.w END ORDER BY pos) AS tokens "
      "FROM tcp p LEFT JOIN tcm m ON m.lc = lower(p.w) LEFT JOIN known k ON k.w = p.w GROUP BY line_id "
      "UNION ALL SELECT line_id, []::VARCHAR[] FROM tct WHERE len(w) = 0")
def truecase_apply(spark, sf):
    """M2: the model applied to every line (sentence starts re-cased)."""
    toks = _tc_tokens(spark, sf)
    forms = TC.surface_forms(toks).checkpoint(eager=True)  # counted once for the model and the known forms
    return TC.apply(toks, TC.best_forms(forms), forms.select("w"))


def _dict_tokens(spark, sf) -> DataFrame:
    return FX.seg(spark, sf).select("line_id", T.split_ws("text").alias("tokens"))


_DICT_CTES = [
    f"dtok AS (SELECT line_id, {O.split_ws('text')} AS tokens FROM seg)",
    "dcnt AS (SELECT t AS token, count(*) AS cnt FROM (SELECT unnest(tokens) AS t FROM dtok) GROUP BY t)",
    "dwords AS (SELECT token, cnt, (row_number() OVER (ORDER BY cnt DESC, token ASC) + 3)::BIGINT AS id FROM dcnt)",
    "dsize AS (SELECT count(*) + 4 AS size FROM dcnt)",
    "dict AS (SELECT * FROM (VALUES ('<s>', 1, 0), ('<pad>', 1, 1), ('</s>', 1, 2), ('<unk>', 1, 3)) "
    "v(token, cnt, id) UNION ALL SELECT token, cnt, id FROM dwords UNION ALL "
    "SELECT printf('madeupword%04d', i), 0, size + i FROM dsize, range((8 - size % 8) % 8) t(i))"]


@register("dictionary", O.with_ctes("seg", extra=_DICT_CTES)
          + "SELECT token, cnt::BIGINT AS cnt, id::BIGINT AS id FROM dict")
def dictionary(spark, sf):
    """M7: token -> id by frequency, four reserved ids, padded to a multiple of 8."""
    return V.build_dictionary(_dict_tokens(spark, sf), pad_to_multiple=8)


_ENC_CTES = _DICT_CTES + [
    f"btok AS (SELECT item_id, {O.split_ws('text')} AS tokens FROM benchmark)",
    "bpos AS (SELECT item_id, unnest(generate_series(1, len(tokens))) AS pos, tokens FROM btok)",
    "enc AS (SELECT item_id, list(coalesce(d.id, 3)::INTEGER ORDER BY pos) || [2] AS ids, "
    "count(*) FILTER (WHERE d.id IS NULL)::BIGINT AS n_unk FROM bpos LEFT JOIN dict d ON d.token = tokens[pos] "
    "GROUP BY item_id UNION ALL SELECT item_id, [2], 0 FROM btok WHERE len(tokens) = 0)"]


def _encoded(spark, sf):
    d = V.build_dictionary(_dict_tokens(spark, sf), pad_to_multiple=8)
    b = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("line_id"),
                                                T.split_ws("text").alias("tokens"))
    return V.encode(b, d).withColumnRenamed("line_id", "item_id")


@register("encode_ids", O.with_ctes("seg", extra=_ENC_CTES) + "SELECT item_id, ids, n_unk FROM enc")
def encode_ids(spark, sf):
    """M8: benchmark items encoded with the corpus dictionary (unknown -> 3, </s> = 2 appended)."""
    return _encoded(spark, sf)


@register("oov_rate", O.with_ctes("seg", extra=_ENC_CTES)
          + "SELECT sum(len(ids) - 1)::BIGINT AS n_tokens, sum(n_unk)::BIGINT AS n_unk, "
            "round(sum(n_unk)::DOUBLE / sum(len(ids) - 1), 6) AS oov_rate FROM enc")
def oov_rate(spark, sf):
    """M8: out-of-vocabulary rate of the benchmark items under the corpus dictionary."""
    return V.oov_rate(_encoded(spark, sf))


COLLOC_MIN_COUNT, COLLOC_MIN_PMI = 5, 3.0


def _texts(spark, sf) -> DataFrame:
    """Lines whose tokens (those of ``split_ws``) are cut where they are counted and matched."""
    return FX.seg(spark, sf).select("line_id", F.col("text").alias("tokens"))


_COLLOC_CTES = [
    f"ct AS (SELECT line_id, {O.split_ws('text')} AS w FROM seg)",
    "bi AS (SELECT w[i] AS w1, w[i + 1] AS w2, count(*) AS cnt FROM "
    "(SELECT w, unnest(generate_series(1, len(w) - 1)) AS i FROM ct) GROUP BY ALL)",
    "uni AS (SELECT t AS w, count(*) AS c FROM (SELECT unnest(w) AS t FROM ct) GROUP BY t)",
    "nn AS (SELECT sum(c) AS n FROM uni)"]
_COLLOC_SELECT = ("SELECT w1, w2, cnt, round(ln(cnt * n::DOUBLE / (u1.c * u2.c)), 6) AS pmi FROM bi "
                  "JOIN uni u1 ON u1.w = w1 JOIN uni u2 ON u2.w = w2, nn "
                  f"WHERE cnt >= {COLLOC_MIN_COUNT} AND ln(cnt * n::DOUBLE / (u1.c * u2.c)) >= {COLLOC_MIN_PMI}")


@register("collocations", O.with_ctes("seg", extra=_COLLOC_CTES) + _COLLOC_SELECT)
def collocations(spark, sf):
    """T4 (mining): adjacent-token collocations by count and PMI."""
    return CO.mine(_texts(spark, sf), min_count=COLLOC_MIN_COUNT, min_pmi=COLLOC_MIN_PMI)


@register("segment_compounds", O.with_ctes("seg", extra=_COLLOC_CTES + [
    f"lex AS ({_COLLOC_SELECT})",
    "p AS (SELECT line_id, i AS pos, w[i] AS w, w[i + 1] AS nxt FROM "
    "(SELECT line_id, w, unnest(generate_series(1, len(w))) AS i FROM ct))",
    "q AS (SELECT p.*, lex.w1 IS NOT NULL AS m FROM p LEFT JOIN lex ON lex.w1 = p.w AND lex.w2 = p.nxt)",
    "r AS (SELECT *, max(CASE WHEN m THEN 0 ELSE pos END) OVER (PARTITION BY line_id ORDER BY pos) AS before FROM q)",
    "t AS (SELECT *, m AND (pos - before) % 2 = 1 AS take FROM r)",
    "u AS (SELECT *, coalesce(lag(take) OVER (PARTITION BY line_id ORDER BY pos), false) AS taken FROM t)"])
    + "SELECT line_id, string_agg(CASE WHEN take THEN w || '_' || nxt ELSE w END, ' ' ORDER BY pos) AS text "
      "FROM u WHERE NOT taken GROUP BY line_id UNION ALL SELECT line_id, '' FROM ct WHERE len(w) = 0")
def segment_compounds(spark, sf):
    """T4 (matching): lexicon pairs joined with '_' greedily left to right."""
    toks = _texts(spark, sf)
    lex = CO.mine(toks, min_count=COLLOC_MIN_COUNT, min_pmi=COLLOC_MIN_PMI)
    return CO.segment(toks, lex)


PHRASE_WORDS = 4


def _phrase_ctes() -> list[str]:
    """The lexicon grown a word at a time: ``p<n>`` are the phrases of n words."""
    out = [f"ct AS (SELECT line_id, {O.split_ws('text')} AS w FROM seg)",
           "uni AS (SELECT t AS w, count(*) AS c FROM (SELECT unnest(w) AS t FROM ct) GROUP BY t)",
           "nn AS (SELECT sum(c) AS n FROM uni)"]
    for n in range(2, PHRASE_WORDS + 1):
        grams = (f"SELECT array_to_string(w[i:i + {n - 1}], ' ') AS phrase, w[i:i + {n - 1}] AS ws FROM "
                 f"(SELECT w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM ct)")
        kept = "" if n == 2 else (f" WHERE array_to_string(ws[1:{n - 1}], ' ') IN (SELECT phrase FROM p{n - 1}) "
                                  f"AND array_to_string(ws[2:{n}], ' ') IN (SELECT phrase FROM p{n - 1})")
        out.append(f"g{n} AS (SELECT phrase, ws, count(*) AS cnt FROM ({grams}){kept} GROUP BY ALL HAVING count(*) >= {COLLOC_MIN_COUNT})")
        out.append(f"p{n} AS (SELECT phrase, {n} AS words, cnt, pmi FROM (SELECT phrase, cnt, (ln(cnt) + {n - 1} * ln(any_value(n)::DOUBLE) - sum(ln(c))) / {n - 1} AS pmi "
                   f"FROM (SELECT phrase, cnt, unnest(ws) AS w FROM g{n}) JOIN uni USING (w), nn GROUP BY phrase, cnt) WHERE pmi >= {COLLOC_MIN_PMI})")
    out.append("phrases AS (" + " UNION ALL ".join(f"SELECT phrase, words, cnt, round(pmi, 6) AS pmi FROM p{n}" for n in range(2, PHRASE_WORDS + 1)) + ")")
    return out


def _phrases(spark, sf):
    toks = _texts(spark, sf)
    return toks, CO.mine_phrases(toks, min_count=COLLOC_MIN_COUNT, min_pmi=COLLOC_MIN_PMI, max_words=PHRASE_WORDS)


@register("phrase_lexicon", O.with_ctes("seg", extra=_phrase_ctes()) + "SELECT phrase, words::INTEGER AS words, cnt, pmi FROM phrases")
def phrase_lexicon(spark, sf):
    """T4 (mining): compounds of two to four words by count and PMI."""
    return _phrases(spark, sf)[1]


@register("segment_phrases", O.with_ctes("seg", extra=_phrase_ctes() + [
    "tok AS (SELECT line_id, w, unnest(generate_series(1, len(w))) AS i FROM ct)",
    "hit AS (SELECT line_id, i, max(words) AS words FROM (SELECT line_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM tok, "
    f"range(2, {PHRASE_WORDS + 1}) t(n) WHERE i + n - 1 <= len(w)) JOIN phrases USING (phrase) GROUP BY line_id, i)",
    "step AS (SELECT a.line_id, a.i, coalesce(h.words, 1) AS words, array_to_string(w[a.i:a.i + coalesce(h.words, 1) - 1], '_') AS piece "
    "FROM tok a LEFT JOIN hit h ON h.line_id = a.line_id AND h.i = a.i)",
    "walk AS (SELECT line_id, i, words, piece FROM step WHERE i = 1 UNION ALL "
    "SELECT s.line_id, s.i, s.words, s.piece FROM walk k JOIN step s ON s.line_id = k.line_id AND s.i = k.i + k.words)"])
    .replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT line_id, string_agg(piece, ' ' ORDER BY i) AS text FROM walk GROUP BY line_id "
      "UNION ALL SELECT line_id, '' FROM ct WHERE len(w) = 0")
def segment_phrases(spark, sf):
    """T4 (matching): compounds of two to four words joined with '_', the longest match first."""
    toks, lexicon = _phrases(spark, sf)
    return CO.segment_phrases(toks, lexicon.select("phrase", (F.col("pmi") * (F.col("words") - 1)).alias("score")))


_BPE_TYPES = ("bt AS (SELECT word, count(*) AS freq FROM (SELECT unnest(" + O.split_ws("text")
              + ") AS word FROM seg) WHERE word <> '' GROUP BY word)")


@register("bpe_pair_stats", O.with_ctes("seg", extra=[
    _BPE_TYPES,
    "bs AS (SELECT freq, string_split(word, '')[1:len(string_split(word, '')) - 1] || "
    "[string_split(word, '')[len(string_split(word, ''))] || '</w>'] AS s FROM bt)"])
    + "SELECT s[i] AS a, s[i + 1] AS b, sum(freq)::BIGINT AS cnt FROM "
      "(SELECT freq, s, unnest(generate_series(1, len(s) - 1)) AS i FROM bs) GROUP BY ALL")
def bpe_pair_stats(spark, sf):
    """M3: adjacent symbol pair counts over the corpus word types (before any merge)."""
    return SW.pair_stats(SW.word_types(_dict_tokens(spark, sf)))


#: Merges of the registered queries, as the preparation scripts learn them, and of those with a SQL twin.
BPE_MERGES, BPE_TWIN_MERGES = 5000, 100


def _bpe_ctes(n: int) -> list[str]:
    """One merge at a time, written out: ``m<i>`` is the i-th merge, ``t<i>`` the word types after it.

    Symbols are kept between blanks, two blanks between neighbours, so that a
    plain replacement merges left to right without overlaps.
    """
    chars = "string_split(word, '')"
    out = [_BPE_TYPES, f"t0 AS MATERIALIZED (SELECT word, freq, ' ' || array_to_string({chars}[1:len({chars}) - 1] || "
                       f"[{chars}[len({chars})] || '</w>'], '  ') || ' ' AS s FROM bt)"]
    for i in range(1, n + 1):
        out.append(f"m{i} AS MATERIALIZED (SELECT a, b, sum(freq)::BIGINT AS cnt FROM (SELECT freq, l[j] AS a, l[j + 1] AS b FROM "
                   f"(SELECT freq, l, unnest(generate_series(1, len(l) - 1)) AS j FROM "
                   f"(SELECT freq, string_split(s[2:-2], '  ') AS l FROM t{i - 1}))) GROUP BY a, b "
                   "ORDER BY cnt DESC, a DESC, b DESC LIMIT 1)")
        out.append(f"t{i} AS MATERIALIZED (SELECT word, freq, replace(s, ' ' || a || '  ' || b || ' ', ' ' || a || b || ' ') AS s "
                   f"FROM t{i - 1}, m{i})")
    # subwords of a word: all but the last are marked, and the end-of-word marker goes
    out.append(f"subs AS (SELECT word, freq, string_split(replace(left(s, length(s) - 5)[2:], '  ', '@@  '), '  ') AS l FROM t{n})")
    return out


def _bpe_learned(spark, sf, n):
    return SW.learn_types(SW.word_types(_dict_tokens(spark, sf)), n)


def _bpe_applied(spark, sf, n):
    merges, types = _bpe_learned(spark, sf, n)
    lines = FX.seg(spark, sf).select("line_id", F.array_join(T.split_ws("text"), " ").alias("text"))
    return SW.segment(lines, {"text": "sub"}, merges, SW.subwords(types))


@register("bpe_merges")
def bpe_merges(spark, sf):
    """M4: 5,000 joint merges in learning order (SQL is too slow for as many; see ``bpe_merges_100`` and the tests)."""
    return SW.merges_frame(spark, _bpe_learned(spark, sf, BPE_MERGES)[0])


@register("bpe_segment")
def bpe_segment(spark, sf):
    """M6: every line in subwords of 5,000 learned merges."""
    return _bpe_applied(spark, sf, BPE_MERGES).select("line_id", "sub")


@register("bpe_vocab")
def bpe_vocab(spark, sf):
    """M5: subword frequency list of the corpus under 5,000 learned merges, counted over its word types."""
    return SW.type_vocabulary(_bpe_learned(spark, sf, BPE_MERGES)[1])


@register("bpe_roundtrip", O.with_ctes("seg") + f"SELECT line_id, array_to_string({O.split_ws('text')}, ' ') AS text FROM seg")
def bpe_roundtrip(spark, sf):
    """M6 + T7: the text that joining the subwords of 5,000 merges gives back (the twin has the words as they were)."""
    return _bpe_applied(spark, sf, BPE_MERGES).select("line_id", T.join_subwords("sub").alias("text"))


@register("bpe_merges_100", O.with_ctes("seg", extra=_bpe_ctes(BPE_TWIN_MERGES))
          + " UNION ALL ".join(f"SELECT {i - 1}::INTEGER AS rank, a, b, cnt FROM m{i}" for i in range(1, BPE_TWIN_MERGES + 1)))
def bpe_merges_100(spark, sf):
    """M4: the first 100 joint merges (the twin merges one pair at a time)."""
    return SW.merges_frame(spark, _bpe_learned(spark, sf, BPE_TWIN_MERGES)[0])


@register("bpe_segment_100", O.with_ctes("seg", extra=_bpe_ctes(BPE_TWIN_MERGES) + [
    f"bl AS (SELECT line_id, {O.split_ws('text')} AS w FROM seg)",
    "bp AS (SELECT line_id, w[i] AS word, i FROM (SELECT line_id, w, unnest(generate_series(1, len(w))) AS i FROM bl))"])
    + "SELECT line_id, string_agg(array_to_string(l, ' '), ' ' ORDER BY i) AS sub FROM bp JOIN subs USING (word) GROUP BY line_id "
      "UNION ALL SELECT line_id, '' FROM bl WHERE len(w) = 0")
def bpe_segment_100(spark, sf):
    """M6: every line in subwords of 100 learned merges."""
    return _bpe_applied(spark, sf, BPE_TWIN_MERGES).select("line_id", "sub")


@register("bpe_vocab_100", O.with_ctes("seg", extra=_bpe_ctes(BPE_TWIN_MERGES))
          + "SELECT token, sum(freq)::BIGINT AS cnt FROM (SELECT freq, unnest(l) AS token FROM subs) GROUP BY token")
def bpe_vocab_100(spark, sf):
    """M5: subword frequency list of the corpus under 100 learned merges."""
    return SW.type_vocabulary(_bpe_learned(spark, sf, BPE_TWIN_MERGES)[1])


# ---------------------------------------------------------------------------
# Preparation job (P1) and the file operators
# ---------------------------------------------------------------------------

def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


def _preparation(spark, sf) -> Preparation:
    parts = [FX.parallel_split(spark, sf, split).select(F.lit(split).alias("split"), "line_no", F.explode(F.create_map(
        F.lit("en"), F.col("en"), F.lit("vi"), F.col("vi"))).alias("lang", "text")) for split in SPLITS]
    corpus = parts[0].unionByName(parts[1]).unionByName(parts[2]).checkpoint(eager=True)
    # NFC: what the twin can write
    return Preparation(Stages(spark, _scratch(spark)), corpus, normalize_form="NFC", num_merges=BPE_MERGES)


def _prepare_sql(step: int) -> str:
    """Tokenised, joined, truecased and composed, one relation a stage."""
    en, vi = (O.split_sp_nonempty(O.tokenize_en("nfc_normalize(en)")), O.split_sp_nonempty(O.tok13a("nfc_normalize(vi)")))
    line = "split, line_no"
    extra = [
        f"ct AS (SELECT split, line_no, {vi} AS w FROM par_split)",
        "bi AS (SELECT w[i] AS w1, w[i + 1] AS w2, count(*) AS cnt FROM (SELECT w, unnest(generate_series(1, len(w) - 1)) AS i "
        "FROM ct WHERE split = 'train') GROUP BY ALL)",
        "uni AS (SELECT t AS w, count(*) AS c FROM (SELECT unnest(w) AS t FROM ct WHERE split = 'train') GROUP BY t)",
        "nn AS (SELECT sum(c) AS n FROM uni)", f"lex AS ({_COLLOC_SELECT})",
        f"p AS (SELECT {line}, i AS pos, w[i] AS w, w[i + 1] AS nxt FROM (SELECT {line}, w, unnest(generate_series(1, len(w))) AS i FROM ct))",
        "q AS (SELECT p.*, lex.w1 IS NOT NULL AS m FROM p LEFT JOIN lex ON lex.w1 = p.w AND lex.w2 = p.nxt)",
        f"r AS (SELECT *, max(CASE WHEN m THEN 0 ELSE pos END) OVER (PARTITION BY {line} ORDER BY pos) AS before FROM q)",
        "t AS (SELECT *, m AND (pos - before) % 2 = 1 AS take FROM r)",
        f"u AS (SELECT *, coalesce(lag(take) OVER (PARTITION BY {line} ORDER BY pos), false) AS taken FROM t)",
        f"vw AS (SELECT {line}, list(CASE WHEN take THEN w || '_' || nxt ELSE w END ORDER BY pos) AS w FROM u WHERE NOT taken GROUP BY {line})",
        f"cw AS (SELECT 'en' AS lang, {line}, {en} AS w FROM par_split UNION ALL "
        "SELECT 'vi', c.split, c.line_no, coalesce(v.w, []::VARCHAR[]) FROM ct c LEFT JOIN vw v USING (split, line_no))",
        f"pos AS (SELECT lang, {line}, i - 1 AS pos, w[i] AS w, {O.start_flag_sql('w', 'i')} AS start FROM "
        f"(SELECT lang, {line}, w, unnest(generate_series(1, len(w))) AS i FROM cw))",
        "frm AS (SELECT lang, lower(w) AS lc, w, count(*) AS cnt FROM pos WHERE split = 'train' AND NOT start AND w <> '' GROUP BY ALL)",
        "tcm AS (SELECT lang, lc, first(w ORDER BY cnt DESC, w ASC) AS best FROM frm GROUP BY lang, lc)",
        "cased AS (SELECT x.lang, split, line_no, string_agg(CASE WHEN start AND m.best IS NOT NULL THEN m.best WHEN k.w IS NOT NULL THEN x.w "
        "WHEN m.best IS NOT NULL THEN m.best ELSE x.w END, ' ' ORDER BY pos) AS text FROM pos x LEFT JOIN tcm m ON m.lang = x.lang AND m.lc = lower(x.w) "
        "LEFT JOIN frm k ON k.lang = x.lang AND k.w = x.w GROUP BY x.lang, split, line_no)",
        f"cpar AS (SELECT b.split, b.line_no, coalesce(e.text, '') AS en, coalesce(v.text, '') AS vi, syn_en, syn_vi FROM par_split b "
        "LEFT JOIN cased e ON e.lang = 'en' AND e.split = b.split AND e.line_no = b.line_no "
        "LEFT JOIN cased v ON v.lang = 'vi' AND v.split = b.split AND v.line_no = b.line_no)",
        "set0 AS (SELECT split, line_no * 2 AS line_no, en AS src, vi AS tgt FROM cpar UNION ALL SELECT split, line_no * 2 + 1, vi, en FROM cpar)",
        "set1 AS (SELECT split, line_no * 4 AS line_no, syn_en AS src, vi AS tgt FROM cpar WHERE split = 'train' UNION ALL "
        "SELECT split, line_no * 4 + 2, syn_vi, en FROM cpar WHERE split = 'train' UNION ALL "
        "SELECT split, line_no * 2 + 1, src, tgt FROM set0 WHERE split = 'train' UNION ALL SELECT * FROM set0 WHERE split <> 'train')"]
    return O.with_ctes("par_split", extra=extra) + f"SELECT split, line_no, src, tgt FROM set{step}"


@register("prepare_step0", _prepare_sql(0))
def prepare_step0(spark, sf):
    """P1, step 0 as stages: normalised, tokenised, compounds joined, truecased, composed."""
    return _preparation(spark, sf).all_sets()


@register("prepare_step1", _prepare_sql(1))
def prepare_step1(spark, sf):
    """P1, step 1 as stages: synthetic and genuine lines around step 0's training set; valid and test carried over."""
    p = _preparation(spark, sf)
    p.all_sets()
    return p.all_sets(1, FX.parallel_split(spark, sf, "train").select("line_no", "syn_en", "syn_vi"))


@register("prepare_encoded")
def prepare_encoded(spark, sf):
    """P1, step 0 to its end: 5,000 joint merges, subwords, tags, joint dictionary, ids (no SQL twin: see the merges)."""
    p = _preparation(spark, sf)
    parts = [p.encoded(s).frame.select(F.lit(s).alias("split"), "line_no", "src_ids", "tgt_ids") for s in SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("lines_roundtrip", O.with_ctes("numbered") + "SELECT line_no, text FROM numbered")
def lines_roundtrip(spark, sf):
    """S7 + S1: the corpus written as ordered text files and read back with its line numbers."""
    path = _scratch(spark)
    write_lines(FX.numbered(spark, sf), path)
    files = sorted(r[0] for r in spark.read.text(path).select(F.col("_metadata.file_path")).distinct().collect())
    return S.read_lines(spark, files)


@register("stage_switch", O.with_ctes("seg") + "SELECT line_id, lang, text FROM seg")
def stage_switch(spark, sf):
    """A stage written twice, first in part; readers follow the newest marker."""
    stages, lines = Stages(spark, _scratch(spark)), FX.seg(spark, sf).select("line_id", "lang", "text")
    stages.write("lines", lines.where("lang = 'en'"))
    stages.write("lines", lines, bucket_by=("line_id",))
    stages.clean("lines")
    return stages.read("lines")


@register("results_by_run", O.with_ctes("seg")
          + "SELECT r.run, lang AS direction, 'lines' AS metric, count(*)::DOUBLE * max(r.k) AS value FROM seg, (VALUES ('a', 1), ('b', 2)) r(run, k) GROUP BY r.run, lang")
def results_by_run(spark, sf):
    """Results of two runs, the first one appended twice."""
    path = _scratch(spark)
    counts = FX.seg(spark, sf).groupBy(F.col("lang").alias("direction")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    for run, k in (("a", 3), ("b", 2), ("a", 1)):
        append_result(counts.withColumn("value", F.col("value") * k).withColumn("metric", F.lit("lines")), path, run=run)
    return spark.read.parquet(path).select("run", "direction", "metric", "value")


@register("parallel_join", O.with_ctes("numbered", "pair", extra=[
    "np AS (SELECT (row_number() OVER (ORDER BY line_id) - 1)::BIGINT AS line_no, hyp FROM pair)"])
    + "SELECT line_no, n.text AS en, np.hyp AS vi FROM numbered n FULL OUTER JOIN np USING (line_no)")
def parallel_join(spark, sf):
    """Two line files bound by position (strict equal-length check)."""
    en = FX.numbered(spark, sf).select("line_no", "text")
    vi = dense_index(FX.pair(spark, sf), "line_id", "line_no").select("line_no", F.col("hyp").alias("text"))
    return S.read_parallel({"en": en, "vi": vi})


SPLIT_MAP = {"src0": "train", "src1": "valid", "src2": "test"}


@register("split_assign", "SELECT doc_id, source, CASE source WHEN 'src0' THEN 'train' WHEN 'src1' THEN 'valid' "
                          "WHEN 'src2' THEN 'test' END AS split FROM documents")
def split_assign(spark, sf):
    """Source file name -> split."""
    d = FX.table(spark, sf, "documents").select("doc_id", "source")
    return S.assign_split(d, "source", SPLIT_MAP)
