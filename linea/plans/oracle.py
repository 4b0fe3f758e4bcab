"""The fixture derivations and metric formulas written as DuckDB SQL.

These strings are the independent oracle: each registered query has a SQL
twin built from the CTE snippets below. They mirror
:mod:`linea.sources.fixtures` and the operator semantics, written from the
specification rather than from the Spark code (lists are 1-based here).
"""

from __future__ import annotations

from linea.operators import bootstrap as BS

# Fixed value: the blank and the punctuation signs that the 13a rules isolate.
PUNCT_SIGNS = r"""[ !"#$%&()*+/:;<=>?@\[\\\]^_`{|}~]"""

CTE = {}

CTE["seg"] = """seg AS (
  SELECT doc_id, lang, seg_no, doc_id * 100000 + seg_no AS line_id, text FROM (
    SELECT doc_id, lang, (generate_subscripts(p, 1) - 1)::BIGINT AS seg_no, unnest(p) AS text
    FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS p FROM documents))
  WHERE text <> '')"""


def _system(drop_mod, drop_rem, unk_mod, unk_rem, words="string_split(text, ' ')"):
    return (f"array_to_string(list_filter(list_transform({words}, lambda x, i: "
            f"CASE WHEN (i - 1 + line_id) % {unk_mod} = {unk_rem} THEN 'unk' ELSE x END), "
            f"lambda x, i: (i - 1 + line_id) % {drop_mod} <> {drop_rem}), ' ')")


CTE["pair"] = f"""pair AS (
  SELECT line_id, lang, {_system(7, 3, 11, 5)} AS hyp, text AS ref FROM seg)"""

CTE["pair_b"] = f"""pair_b AS (
  SELECT line_id, lang, {_system(5, 2, 13, 4)} AS hyp, text AS ref FROM seg)"""

CTE["multi_ref"] = """multi_ref AS (
  SELECT line_id, hyp, 0 AS ref_id, ref FROM pair
  UNION ALL
  SELECT line_id, hyp, 1 AS ref_id,
         array_to_string(list_filter(string_split(ref, ' '), lambda x, i: (i - 1 + line_id) % 5 <> 1), ' ') AS ref
  FROM pair)"""

DEPS = {
    "seg": [], "pair": ["seg"], "pair_b": ["seg"], "multi_ref": ["pair"],
}


def split_ws(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '')"


def split_space(c: str) -> str:
    return (f"CASE WHEN rtrim({c}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({c}, ' '), ' ') END")


def ngram_rows(src: str, tok: str, keys: str) -> str:
    """SELECT producing ``keys, n, gram`` for all 1..4-grams of list column ``tok``."""
    return (f"SELECT {keys}, n, unnest(list_transform(generate_series(1, len({tok}) - n + 1), "
            f"lambda s: array_to_string({tok}[s:s + n - 1], ' '))) AS gram "
            f"FROM {src} CROSS JOIN (VALUES (1), (2), (3), (4)) v(n) WHERE len({tok}) >= n")


def with_ctes(*names: str, extra: list[str] | None = None) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    parts = [CTE[n] for n in order] + (extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


def stats_sql(tok_src: str, keys: str, ties: str = "first", name: str = "st") -> list[str]:
    """CTEs computing per-line statistics from ``tok_src`` (``keys, line_id, h, refs``).

    ``refs`` is a list of token lists; closest length: first reference (or the
    shorter one) wins ties. Produces CTE ``name`` with ``keys, line_id`` and the
    10 statistic columns; helper CTEs are prefixed with ``name``.
    """
    k = f"{keys}, line_id" if keys else "line_id"
    x = name + "_"
    lens_ref = ("{'d': abs(len(h) - len(r)), 'i': i, 'l': len(r)}" if ties == "first"
                else "{'d': abs(len(h) - len(r)), 'l': len(r)}")
    return [
        f"{x}hg AS ({ngram_rows(tok_src, 'h', k)})",
        f"{x}rtok AS (SELECT {k}, r_i, refs[r_i] AS r FROM {tok_src}, "
        f"LATERAL (SELECT unnest(generate_series(1, len(refs))) AS r_i))",
        f"{x}rg AS ({ngram_rows(x + 'rtok', 'r', k + ', r_i')})",
        f"{x}hc AS (SELECT {k}, n, gram, count(*) AS c FROM {x}hg GROUP BY ALL)",
        f"{x}rc1 AS (SELECT {k}, r_i, n, gram, count(*) AS c FROM {x}rg GROUP BY ALL)",
        f"{x}rc AS (SELECT {k}, n, gram, max(c) AS c FROM {x}rc1 GROUP BY ALL)",
        f"{x}cl AS (SELECT {', '.join('hc.' + c.strip() for c in k.split(','))}, hc.n, "
        f"least(hc.c, coalesce(rc.c, 0)) AS correct, hc.c AS total "
        f"FROM {x}hc hc LEFT JOIN {x}rc rc USING ({k}, n, gram))",
        f"{x}cls AS (SELECT {k}, " + ", ".join(
            [f"sum(CASE WHEN n = {j} THEN correct ELSE 0 END)::BIGINT AS correct_{j}_grams" for j in range(1, 5)]
            + [f"sum(CASE WHEN n = {j} THEN total ELSE 0 END)::BIGINT AS total_{j}_grams" for j in range(1, 5)])
        + f" FROM {x}cl GROUP BY ALL)",
        f"{x}lens AS (SELECT {k}, len(h)::BIGINT AS translation_length, "
        f"coalesce(list_sort(list_transform(refs, lambda r, i: {lens_ref}))[1].l, 0)::BIGINT AS reference_length "
        f"FROM {tok_src})",
        f"{name} AS (SELECT lens.*, " + ", ".join(
            [f"coalesce(cls.correct_{j}_grams, 0)::BIGINT AS correct_{j}_grams" for j in range(1, 5)]
            + [f"coalesce(cls.total_{j}_grams, 0)::BIGINT AS total_{j}_grams" for j in range(1, 5)])
        + f" FROM {x}lens lens LEFT JOIN {x}cls cls USING ({k}))",
    ]


STAT_SUMS = ", ".join(
    [f"sum(correct_{j}_grams)::BIGINT AS correct_{j}_grams" for j in range(1, 5)]
    + [f"sum(total_{j}_grams)::BIGINT AS total_{j}_grams" for j in range(1, 5)]
    + ["sum(translation_length)::BIGINT AS translation_length",
       "sum(reference_length)::BIGINT AS reference_length"])


def _slog(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN ln({x}) WHEN {x} IS NOT NULL THEN -9999999999.0 END)"


def bleu_plain_select(src: str, keys: str = "") -> str:
    p = [f"(CASE WHEN total_{j}_grams = 0 THEN NULL ELSE correct_{j}_grams::DOUBLE / total_{j}_grams END)"
         for j in range(1, 5)]
    bp = ("(CASE WHEN translation_length >= reference_length THEN 1.0 "
          "ELSE exp(1 - (CASE WHEN translation_length = 0 THEN NULL "
          "ELSE reference_length::DOUBLE / translation_length END)) END)")
    logs = "(0.0 + " + " + ".join(_slog(x) for x in p) + ")"
    kk = f"{keys}, " if keys else ""
    return (f"SELECT {kk}round(100 * {bp} * exp({logs} / 4), 6) AS bleu, "
            + ", ".join(f"round(100 * {p[j]}, 6) AS p{j + 1}" for j in range(4))
            + f", round({bp}, 6) AS bp, "
            f"round(CASE WHEN reference_length = 0 THEN NULL ELSE translation_length::DOUBLE / reference_length END, 6)"
            f" AS ratio, translation_length AS hyp_len, reference_length AS ref_len FROM {src}")


def bleu_detok_select(src: str, keys: str = "") -> str:
    p = [f"coalesce(CASE WHEN total_{j}_grams = 0 THEN NULL ELSE correct_{j}_grams::DOUBLE / total_{j}_grams END, 0.0)"
         for j in range(1, 5)]
    bp = ("(CASE WHEN translation_length >= reference_length THEN 1.0 WHEN translation_length = 0 THEN 0.0 "
          "ELSE exp(1 - reference_length / translation_length) END)")
    logs = "(0.0 + " + " + ".join(_slog(x) for x in p) + ")"
    z = "reference_length = 0"
    kk = f"{keys}, " if keys else ""
    return (f"SELECT {kk}round(CASE WHEN {z} THEN 0.0 ELSE {bp} * exp({logs} / 4) END * 100, 6) AS bleu, "
            + ", ".join(f"round(CASE WHEN {z} THEN 0.0 ELSE 100 * {p[j]} END, 6) AS p{j + 1}" for j in range(4))
            + f", round(CASE WHEN {z} THEN 0.0 ELSE {bp} END, 6) AS bp, "
            f"round(CASE WHEN {z} THEN 0.0 ELSE translation_length / reference_length END, 6) AS ratio, "
            f"translation_length AS hyp_len, reference_length AS ref_len FROM {src}")


UWS_SQL = "[\\t\\n\\x0B\\f\\r\\x{85}\\p{Z}]"


def tok13a(c: str) -> str:
    t = f"replace(replace(replace({c}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for ent, ch in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = f"replace({t}, '{ent}', '{ch}')"
    t = f"(' ' || {t} || ' ')"
    t = f"regexp_replace({t}, '({PUNCT_SIGNS})', ' \\1 ', 'g')"
    t = f"regexp_replace({t}, '([^0-9])([\\.,])', '\\1 \\2 ', 'g')"
    t = f"regexp_replace({t}, '([\\.,])([^0-9])', ' \\1 \\2', 'g')"
    t = f"regexp_replace({t}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    t = f"regexp_replace({t}, '{UWS_SQL}+', ' ', 'g')"
    return f"regexp_replace({t}, '^ | $', '', 'g')"


def split_sp_nonempty(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda x: x <> '')"


def inject_sql(words: str, off: str) -> str:
    """Separators after every word but the last (linear: the lambda never
    refers back to the whole list)."""
    return (f"array_to_string(list_transform({words}[1:len({words}) - 1], lambda x, i: x || CASE "
            f"WHEN (i - 1 + {off}) % 5 = 0 THEN '@@ ' WHEN (i - 1 + {off}) % 6 = 1 THEN '_' ELSE ' ' END), '') "
            f"|| {words}[len({words})]")


CTE["marked"] = f"""marked AS (
  SELECT line_id, lang, {inject_sql("string_split(text, ' ')", "line_id")} AS text FROM seg)"""
CTE["padded"] = """padded AS (
  SELECT line_id, lang, CASE WHEN line_id % 3 = 0 THEN ' ' || text || '  ' ELSE text END AS text FROM seg)"""
CTE["numbered"] = """numbered AS (
  SELECT *, (row_number() OVER (ORDER BY line_id) - 1)::BIGINT AS line_no FROM seg)"""
CTE["decoder_log"] = f"""decoder_log AS (
  SELECT unnest([
    'S-' || (line_id * 2)::VARCHAR || chr(9) || ref,
    'H-' || (line_id * 2)::VARCHAR || chr(9) || sc || chr(9) || vi,
    'P-' || (line_id * 2)::VARCHAR || chr(9) || sc,
    'S-' || (line_id * 2 + 1)::VARCHAR || chr(9) || hyp,
    'H-' || (line_id * 2 + 1)::VARCHAR || chr(9) || sc || chr(9) || en,
    'P-' || (line_id * 2 + 1)::VARCHAR || chr(9) || sc]) AS line
  FROM (SELECT line_id, hyp, ref, '-0.' || lpad((line_id % 1000)::VARCHAR, 3, '0') AS sc,
               {inject_sql("string_split(hyp, ' ')", "line_id")} AS vi,
               {inject_sql("string_split(ref, ' ')", "(line_id + 1)")} AS en FROM pair))"""
CTE["parsed_log"] = """parsed_log AS (
  SELECT regexp_extract(string_split(line, chr(9))[1], '^H-(\\d+)$', 1)::BIGINT AS id,
         string_split(line, chr(9))[2]::DOUBLE AS score,
         coalesce(string_split(line, chr(9))[3], '') AS text
  FROM decoder_log WHERE starts_with(line, 'H'))"""
DEPS.update({"marked": ["seg"], "padded": ["seg"], "numbered": ["seg"], "decoder_log": ["pair"],
             "parsed_log": ["decoder_log"]})

SENT_END_SQL = "['.', ':', '?', '!']"
DELAYED_SQL = "['(', '[', '\"', '''', '&apos;', '&quot;', '&#91;', '&#93;']"


def join_subwords(c: str) -> str:
    return f"regexp_replace({c}, '(@@ )|(@@ ?$)', '', 'g')"


def detruecase(c: str) -> str:
    """Shifted copies of the token list zipped together: the lambda reads only
    the element and its two predecessors (linear in the line length)."""
    w = f"string_split({c}, ' ')"
    z = (f"list_zip({w}, [NULL::VARCHAR] || {w}[1:len({w}) - 1], "
         f"[NULL::VARCHAR, NULL::VARCHAR] || {w}[1:len({w}) - 2], true)")
    x, p1, p2 = "struct_extract_at(e, 1)", "struct_extract_at(e, 2)", "struct_extract_at(e, 3)"
    cond = (f"NOT list_contains({DELAYED_SQL}, {x}) AND ((i = 1 OR list_contains({SENT_END_SQL}, {p1})) "
            f"OR (list_contains({DELAYED_SQL}, {p1}) AND (i = 2 OR list_contains({SENT_END_SQL}, {p2}))))")
    return (f"array_to_string(list_transform({z}, lambda e, i: CASE WHEN {cond} "
            f"THEN upper({x}[1]) || {x}[2:] ELSE {x} END), ' ')")


def tokenize_en(c: str) -> str:
    t = tok13a(c)
    t = f"regexp_replace({t}, '([A-Za-z])n''t([^A-Za-z0-9_]|$)', '\\1 n''t\\2', 'g')"
    return f"regexp_replace({t}, '([A-Za-z])''(s|m|d|ll|re|ve)([^A-Za-z0-9_]|$)', '\\1 ''\\2\\3', 'g')"


CTE["turns"] = """turns AS (
  SELECT conv_id, k, coalesce(max(text) FILTER (WHERE NOT reply), '') AS src,
         coalesce(max(text) FILTER (WHERE reply), '') AS tgt
  FROM (SELECT *, (sum(CASE WHEN NOT reply OR coalesce(before, true) THEN 1 ELSE 0 END)
                   OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS k
        FROM (SELECT conv_id, turn, text, coalesce(role, '') = 'assistant' AS reply,
                     lag(coalesce(role, '') = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn) AS before
              FROM conversations))
  GROUP BY conv_id, k)"""
CTE["par"] = """par AS (
  SELECT (row_number() OVER (ORDER BY conv_id * 1000 + k) - 1)::BIGINT AS line_no,
         src AS en, tgt AS vi, lower(src) AS syn_en, lower(tgt) AS syn_vi FROM turns)"""
CTE["par_split"] = """par_split AS (
  SELECT split, (row_number() OVER (PARTITION BY split ORDER BY conv_id * 1000 + k) - 1)::BIGINT AS line_no,
         src AS en, tgt AS vi, lower(src) AS syn_en, lower(tgt) AS syn_vi
  FROM (SELECT *, CASE WHEN conv_id % 10 = 0 THEN 'valid' WHEN conv_id % 10 = 1 THEN 'test' ELSE 'train' END
        AS split FROM turns))"""
DEPS.update({"turns": [], "par": ["turns"], "par_split": ["turns"]})


def step_ctes(k_max: int, par: str = "par", prefix: str = "step", where: str = "") -> list[str]:
    """CTEs ``step0 … step{k_max}`` of the bidirectional/back-translation sets."""
    w0 = f" WHERE {where}" if where else ""
    out = [f"{prefix}0 AS (SELECT line_no * 2 AS line_no, en AS src, vi AS tgt FROM {par}{w0} "
           f"UNION ALL SELECT line_no * 2 + 1, vi, en FROM {par}{w0})"]
    for k in range(1, k_max + 1):
        w = 2 * (k + 1)
        out.append(
            f"{prefix}{k} AS (SELECT line_no * {w} AS line_no, syn_en AS src, vi AS tgt FROM {par}{w0} "
            f"UNION ALL SELECT line_no * {w} + {k + 1}, syn_vi, en FROM {par}{w0} "
            f"UNION ALL SELECT (line_no // {2 * k}) * {w} + CASE WHEN line_no % {2 * k} < {k} "
            f"THEN line_no % {2 * k} + 1 ELSE line_no % {2 * k} + 2 END, src, tgt FROM {prefix}{k - 1} "
            f"WHERE line_no < {2 * k} * (SELECT count(*) FROM {par}{w0}))")
    return out


def score_sql(prefix: str = "", smooth: str = "none", scale: float = 100.0) -> str:
    """SQL twin of :func:`linea.operators.bleu.bleu_score_expr`."""
    c = [f"{prefix}correct_{k}_grams" for k in range(1, 5)]
    t = [f"{prefix}total_{k}_grams" for k in range(1, 5)]
    hl, rl = f"{prefix}translation_length", f"{prefix}reference_length"
    bp = f"(CASE WHEN {hl} >= {rl} THEN 1.0 WHEN {hl} = 0 THEN 0.0 ELSE exp(1 - {rl} / {hl}) END)"
    if smooth == "exp":
        p = []
        for k in range(4):
            zeros = " + ".join(f"(CASE WHEN {c[j]} = 0 AND {t[j]} > 0 THEN 1 ELSE 0 END)" for j in range(k + 1))
            p.append(f"(CASE WHEN {t[k]} = 0 THEN 0.0 WHEN {c[k]} = 0 THEN 1.0 / (pow(2.0, {zeros}) * {t[k]}) "
                     f"ELSE {c[k]} / {t[k]} END)")
    else:
        p = [f"coalesce(CASE WHEN {t[k]} = 0 THEN NULL ELSE {c[k]}::DOUBLE / {t[k]} END, 0.0)" for k in range(4)]
    logs = "(0.0 + " + " + ".join(_slog(x) for x in p) + ")"
    score = f"({bp} * exp({logs} / 4))"
    if smooth == "zero_if_any":
        score = f"(CASE WHEN greatest({', '.join(f'({x} = 0)::INT' for x in p)}) = 1 THEN 0.0 ELSE {score} END)"
    return f"({scale} * {score})"


def _mixed(x: str, out: str) -> str:
    """Select items that mix the 64-bit word ``x`` into ``out``."""
    low = "18446744073709551615::UHUGEINT"

    def times(v, shift, k):
        return f"((xor({v}, {v} >> {shift}))::UHUGEINT * {k}::UHUGEINT & {low})::UBIGINT"

    return (f"{times(x, 30, BS.MIX_A)} AS {out}_a, {times(f'{out}_a', 27, BS.MIX_B)} AS {out}_b, "
            f"xor({out}_b, {out}_b >> 31) AS {out}")


def _stepped(base: str, count: str) -> str:
    return f"(({base}::UHUGEINT + {count}::UHUGEINT * {BS.STEP}::UHUGEINT) & 18446744073709551615::UHUGEINT)::UBIGINT"


def _keyed(src: str, seed: int, node: str) -> str:
    """``src`` with the key of its random words."""
    return (f"SELECT *, {_stepped(str(seed), '(b + 1)')} AS k0, {_mixed('k0', 'k1')}, {_stepped('k1', node)} AS k2, "
            f"{_mixed('k2', 'key')} FROM {src}")


def draws_sql(src: str, samples: int, ratio: float | None, seed: int, include_full: bool, levels: int = 8) -> str:
    """CTE ``dr`` (b, idx): the draws of :mod:`linea.operators.bootstrap` over the dense index of ``src``.

    The split is written out for ``levels`` levels (4,096 x 2^levels lines at most; more raise an error).
    """
    m = "nn" if ratio is None else f"floor(nn * {ratio})::BIGINT"
    out = [f"shape0 AS (SELECT nn, {m} AS m, CASE WHEN nn <= {BS.SPAN} THEN 0 ELSE ceil(log2(((nn - 1) // {BS.SPAN} + 1)::DOUBLE))::BIGINT END "
           f"AS levels FROM (SELECT count(*) AS nn FROM {src}))",
           f"shape AS (SELECT *, CASE WHEN levels > {levels} THEN error('too many lines for the twin') ELSE (nn + (1 << levels) - 1) // (1 << levels) END "
           "AS size FROM shape0)",
           f"s0 AS (SELECT b::BIGINT AS b, 0::BIGINT AS r, m AS c FROM range({samples}) t(b), shape)"]
    for i in range(levels):
        word = _stepped("key", "(w + 1)")
        out += [f"sw{i} AS ({_keyed(f'(SELECT b, r, c, unnest(range((c + 63) // 64)) AS w FROM s{i}, shape WHERE levels > {i})', seed, f'({1 << i} + r)')})",
                f"so{i} AS (SELECT b, r, sum(bit_count(word >> greatest(64 * (w + 1) - c, 0)::UBIGINT))::BIGINT AS ones FROM "
                f"(SELECT b, r, c, w, {word} AS w0, {_mixed('w0', 'word')} FROM sw{i}) GROUP BY b, r)",
                f"s{i + 1} AS (SELECT b, CASE WHEN levels > {i} THEN 2 * r + side ELSE r END AS r, CASE WHEN levels <= {i} THEN c WHEN side = 0 "
                f"THEN ones ELSE c - ones END AS c FROM s{i} LEFT JOIN so{i} USING (b, r), shape, (VALUES (0), (1)) v(side) "
                f"WHERE c > 0 AND (levels > {i} OR side = 0))"]
    pairs = f"(SELECT b, r, c, unnest(range((c + 1) // 2)) AS w FROM s{levels})"
    out += [f"dw AS ({_keyed(pairs.replace('SELECT b, r, c,', 'SELECT b, r, c, levels, size, nn,').replace(f's{levels}', f's{levels}, shape'), seed, '((1 << levels) + r)')})",
            f"dx AS (SELECT b, r, c, w, size, nn, {_stepped('key', '(w + 1)')} AS w0, {_mixed('w0', 'word')} FROM dw)",
            "dh AS (SELECT b, r, size, nn, word, side, ((CASE side WHEN 0 THEN word >> 32 ELSE word & 4294967295::UBIGINT END)::UHUGEINT "
            "* size::UHUGEINT >> 32)::BIGINT + r * size AS line FROM dx, (VALUES (0), (1)) v(side) WHERE 2 * w + side < c)",
            f"da AS (SELECT b, nn, {_stepped('word', '(side + 1)')} AS a0, {_mixed('a0', 'anew')} FROM dh WHERE line >= nn)",
            # the upper 64 bits of a product, from its two 32-bit halves (nn is below 2^32)
            "dr AS (SELECT b, line AS idx FROM dh WHERE line < nn UNION ALL SELECT b, ((((anew >> 32)::UHUGEINT * nn::UHUGEINT) + "
            "(((anew & 4294967295::UBIGINT)::UHUGEINT * nn::UHUGEINT) >> 32)) >> 32)::BIGINT AS idx FROM da"
            + (f" UNION ALL SELECT -1 AS b, unnest(range(nn)) AS idx FROM shape" if include_full else "") + ")"]
    return ",\n".join(out)


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{UWS_SQL}+|{UWS_SQL}+$', '', 'g')"


CTE["gold"] = """gold AS (
  SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS n, quality::VARCHAR AS gold,
         (CASE WHEN doc_id % 5 = 0 THEN 1 - quality ELSE quality END)::VARCHAR AS sys1,
         (CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END)::VARCHAR AS sys2 FROM labels)"""
CTE["scores"] = """scores AS (
  SELECT (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS n, o_totalprice AS gold,
         o_totalprice + (o_orderkey % 17 - 8) * 1000.0 AS sys1,
         o_totalprice + (o_orderkey % 29 - 14) * 3000.0 AS sys2 FROM orders)"""
DEPS.update({"gold": [], "scores": []})


CTE["decoder_log_uni"] = f"""decoder_log_uni AS (
  SELECT unnest([
    'S-' || line_id::VARCHAR || chr(9) || ref,
    'H-' || line_id::VARCHAR || chr(9) || sc || chr(9) || vi,
    'P-' || line_id::VARCHAR || chr(9) || sc]) AS line
  FROM (SELECT line_id, ref, '-0.' || lpad((line_id % 1000)::VARCHAR, 3, '0') AS sc,
               {inject_sql("string_split(hyp, ' ')", "line_id")} AS vi FROM pair))"""
CTE["sweep_hyps"] = f"""sweep_hyps AS (
  SELECT checkpoint, CASE WHEN lang = 'en' THEN 'en>vi' ELSE 'vi>en' END AS direction, line_id,
         {_system("(checkpoint - 15)", 3, 11, 5)} AS hyp, text AS ref
  FROM seg CROSS JOIN (SELECT unnest(generate_series(21, 30)) AS checkpoint) c)"""
CTE["eval_refs"] = """eval_refs AS (
  SELECT line_id AS sent_id, 'vi' AS lang, ref FROM pair UNION ALL
  SELECT line_id AS sent_id, 'en' AS lang, hyp AS ref FROM pair)"""
CTE["translation_data"] = f"""translation_data AS (
  SELECT line_id AS sent_id, 'vi' AS lang, {inject_sql("string_split(ref, ' ')", "(line_id + 2)")} AS ref FROM pair
  UNION ALL
  SELECT line_id AS sent_id, 'en' AS lang, {inject_sql("string_split(hyp, ' ')", "(line_id + 3)")} AS ref FROM pair)"""
DEPS.update({"decoder_log_uni": ["pair"], "sweep_hyps": ["seg"], "eval_refs": ["pair"],
             "translation_data": ["pair"]})


def postprocess(c: str) -> str:
    return f"replace({detruecase(join_subwords(c))}, '_', ' ')"


def plain_tok_cte(src: str, keys: str) -> str:
    k = f"{keys}, " if keys else ""
    return f"toks AS (SELECT {k}line_id, {split_ws('hyp')} AS h, [{split_space('ref')}] AS refs FROM {src})"


ALIGN_VOCAB_SQL = "['the', 'house', '.', ',', 'is', 'big', '(', ')', 'a', '!', 'small', ';']"
CTE["links"] = """links AS (
  SELECT l_orderkey AS sent_id, l_linenumber - 1 AS src, (l_partkey % 7)::INT AS tgt,
         max((l_returnflag <> 'A')::INT) AS h, max((l_linestatus = 'F')::INT) AS s,
         max((l_linestatus = 'F' OR l_returnflag = 'N')::INT) AS p
  FROM lineitem GROUP BY ALL)"""
CTE["alignment_lines"] = """alignment_lines AS (
  SELECT sent_id,
         coalesce(string_agg(CASE WHEN s = 1 THEN src || '-' || tgt WHEN p = 1 THEN src || 'p' || tgt END, ' '), '')
           AS ref_line,
         coalesce(string_agg(CASE WHEN h = 1 THEN src || '-' || tgt END, ' '), '') AS hyp_line
  FROM links GROUP BY sent_id)"""
CTE["align_sentences"] = f"""align_sentences AS (
  SELECT sent_id,
         list_transform(range(7), lambda i: {ALIGN_VOCAB_SQL}[((sent_id * 3 + i) % 12) + 1]) AS src_words,
         list_transform(range(7), lambda i: {ALIGN_VOCAB_SQL}[((sent_id * 5 + i * 2) % 12) + 1]) AS tgt_words
  FROM (SELECT DISTINCT l_orderkey AS sent_id FROM lineitem))"""
_LRE = "'^(\\d+)([-p])(\\d+)$'"
CTE["parsed_links"] = f"""rparsed AS (
  SELECT sent_id, regexp_extract(tok, {_LRE}, 1)::INT AS src, regexp_extract(tok, {_LRE}, 3)::INT AS tgt,
         regexp_extract(tok, {_LRE}, 2) AS kind
  FROM (SELECT sent_id, unnest(regexp_split_to_array(ref_line, '\\s+')) AS tok FROM alignment_lines) WHERE tok <> ''),
hset AS (
  SELECT DISTINCT sent_id, regexp_extract(tok, {_LRE}, 1)::INT AS src, regexp_extract(tok, {_LRE}, 3)::INT AS tgt
  FROM (SELECT sent_id, unnest(regexp_split_to_array(hyp_line, '\\s+')) AS tok FROM alignment_lines) WHERE tok <> '')"""
CTE["hwords"] = """hwords AS (
  SELECT h.sent_id, h.src, h.tgt, s.src_words[h.src + 1] AS src_word, s.tgt_words[h.tgt + 1] AS tgt_word
  FROM hset h JOIN align_sentences s USING (sent_id))"""
DEPS.update({"links": [], "alignment_lines": ["links"], "align_sentences": [],
             "parsed_links": ["alignment_lines"], "hwords": ["parsed_links", "align_sentences"]})


def rsets_sql(all_sure: bool = False, ignore_possible: bool = False) -> str:
    s = "1" if all_sure else "(kind = '-')::INT"
    p = "(kind = '-')::INT" if ignore_possible else "1"
    return (f"rsets AS (SELECT * FROM (SELECT sent_id, src, tgt, max({s}) AS s, max({p}) AS p FROM rparsed "
            f"GROUP BY ALL) WHERE s = 1 OR p = 1)")


def aer_select(hyp: str, alpha: float = -1.0, raw: str | None = None) -> str:
    flags = (f"(SELECT coalesce(h.a, 0) AS a, coalesce(r.s, 0) AS s, coalesce(r.p, 0) AS p FROM "
             f"(SELECT sent_id, src, tgt, 1 AS a FROM {hyp}) h FULL OUTER JOIN rsets r USING (sent_id, src, tgt))")
    t = (f"(SELECT sum(a) AS n_a, sum(s) AS n_s, sum(a * p) AS n_ap, sum(a * s) AS n_as FROM {flags})")
    prec = "(CASE WHEN n_a = 0 THEN NULL ELSE n_ap::DOUBLE / n_a END)"
    rec = "(CASE WHEN n_s = 0 THEN NULL ELSE n_as::DOUBLE / n_s END)"
    f = "0.0::DOUBLE" if alpha < 0 else f"1.0 / ({alpha} / {prec} + {1.0 - alpha} / {rec})"
    return (f"SELECT round({prec}, 6) AS precision, round({rec}, 6) AS recall, "
            f"round(1.0 - (n_ap + n_as)::DOUBLE / (n_a + n_s), 6) AS aer, round({f}, 6) AS f_measure, "
            f"(SELECT count(*) FROM {raw or hyp})::BIGINT AS n_links FROM {t}")


PUNCT_SQL = "['.', ',', '!', '?', ';', ':', '(', ')']"


END_SQL, DEL_SQL = SENT_END_SQL, DELAYED_SQL


def start_flag_sql(w: str, i: str) -> str:
    """Sentence-start flag of token ``w[i]`` (1-based i), as in the truecaser."""
    return (f"coalesce(NOT list_contains({DEL_SQL}, {w}[{i}]) AND ({i} = 1 OR (({i} > 1 AND "
            f"list_contains({END_SQL}, {w}[{i} - 1])) OR (({i} > 1 AND list_contains({DEL_SQL}, {w}[{i} - 1])) "
            f"AND ({i} = 2 OR ({i} > 2 AND list_contains({END_SQL}, {w}[{i} - 2])))))), false)")


def tc_positions_cte(src: str) -> str:
    return (f"tcp AS (SELECT line_id, i - 1 AS pos, w[i] AS w, {start_flag_sql('w', 'i')} AS start FROM "
            f"(SELECT line_id, w, unnest(generate_series(1, len(w))) AS i FROM {src}))")


def nonempty_13a(c: str) -> str:
    return split_sp_nonempty(tok13a(c))
