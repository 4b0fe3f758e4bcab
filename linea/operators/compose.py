"""Positional composition of training sets (C1-C7), direction tags, parity routing.

All operators here are narrow: output positions are computed arithmetically
from the input ``line_no`` and the pieces are combined with ``unionByName``.
No join and no shuffle is needed to interleave, concatenate or tag; the only
actions are the line counts the reference checks (equal sizes, enough
previous lines).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linea.functions import text as T


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def interleave(a: DataFrame, b: DataFrame, prev: DataFrame | None, stride: int,
               n: int | None = None, key: str = "line_no") -> DataFrame:
    """For each i: a[i], ``stride`` lines of prev, b[i], the next ``stride`` lines of prev.

    ``a``, ``b`` and ``prev`` carry ``key`` (dense, 0-based) and the same payload
    columns. Block i owns positions ``[i*w, (i+1)*w)`` with ``w = 2*(stride+1)``.
    Previous lines beyond ``2*stride*len(a)`` are ignored (as in the reference).
    """
    s = stride
    w = 2 * (s + 1)
    if n is None:
        n = a.count()
        nb = b.count()
        if n != nb:
            raise ValueError(f"interleave: a has {n} lines, b has {nb}")
    payload = [c for c in a.columns if c != key]
    parts = [a.select((F.col(key) * w).alias(key), *payload),
             b.select((F.col(key) * w + s + 1).alias(key), *payload)]
    if s > 0:
        if prev is None:
            raise ValueError("interleave: stride > 0 needs previous lines")
        need = 2 * s * n
        have = prev.count()
        if have < need:
            raise ValueError(f"interleave: previous data has {have} lines, needs {need}")
        q = F.col(key)
        i = F.floor(q / (2 * s))
        r = F.pmod(q, F.lit(2 * s))
        pos = i * w + F.when(r < s, r + 1).otherwise(r + 2)
        parts.append(prev.where(q < need).select(pos.cast("bigint").alias(key), *payload))
    return _union(parts)


def concat_all(frames: list[DataFrame], key: str = "line_no") -> DataFrame:
    """Frames one after another, line numbers offset by the preceding sizes."""
    out, off = [], 0
    for i, f in enumerate(frames):
        out.append(f.select((F.col(key) + F.lit(off)).alias(key), *[c for c in f.columns if c != key]))
        if i + 1 < len(frames):  # nothing follows the last frame
            off += f.count()
    return _union(out)


def build_bidirectional(par: DataFrame, en: str = "en", vi: str = "vi", key: str = "line_no") -> DataFrame:
    """Step 0 of the bidirectional set from a bound parallel table.

    src = en0, vi0, en1, vi1, …; tgt = vi0, en0, vi1, en1, … (interleave with
    stride 0 on both sides, zipped on the output position: no join needed).
    """
    return par.select(F.inline(F.array(
        F.struct((F.col(key) * 2).alias(key), F.col(en).alias("src"), F.col(vi).alias("tgt")),
        F.struct((F.col(key) * 2 + 1).alias(key), F.col(vi).alias("src"), F.col(en).alias("tgt")))))


def build_step(k: int, par: DataFrame, prev: DataFrame, key: str = "line_no",
               syn_en: str = "syn_en", syn_vi: str = "syn_vi",
               gen_en: str = "en", gen_vi: str = "vi") -> DataFrame:
    """C4: training set of back-translation step k > 0.

    Sources interleave the synthetic English/Vietnamese lines with stride k
    around step k-1's sources; targets interleave the genuine Vietnamese/English
    lines around step k-1's targets. ``par`` binds (by position) the synthetic
    and genuine sides; ``prev`` is step k-1 as ``key, src, tgt``.
    """
    a = par.select(key, F.col(syn_en).alias("src"), F.col(gen_vi).alias("tgt"))
    b = par.select(key, F.col(syn_vi).alias("src"), F.col(gen_en).alias("tgt"))
    return interleave(a, b, prev.select(key, "src", "tgt"), k)


def carry_forward(new_train: DataFrame, prev: DataFrame, split: str = "split") -> DataFrame:
    """A new step = its rebuilt train split plus valid/test of the previous step."""
    return new_train.withColumn(split, F.lit("train")).unionByName(prev.where(F.col(split) != "train"))


def tag_cyclic(df: DataFrame, p1: int, tag1: str, p2: int, tag2: str,
               text: str = "text", key: str = "line_no") -> DataFrame:
    """Prefix tags in a cycle; lines outside both ranges are dropped."""
    tag = T.cyclic_tag(F.col(key), p1, tag1, p2, tag2)
    return df.withColumn("__tag", tag).where(F.col("__tag").isNotNull()) \
        .withColumn(text, F.concat_ws(" ", "__tag", text)).drop("__tag")


def tag_directions(df: DataFrame, k: int, split: str, text: str = "src", key: str = "line_no") -> DataFrame:
    """Train blocks of 2(k+1) lines (k+1 e2v then k+1 v2e); valid/test alternate."""
    if split == "train":
        return tag_cyclic(df, k + 1, T.TAG_E2V, 2 * (k + 1), T.TAG_V2E, text, key)
    return tag_cyclic(df, 1, T.TAG_E2V, 2, T.TAG_V2E, text, key)


def route_by_parity(log: DataFrame, id_col: str = "id", block: int = 2) -> DataFrame:
    """F2 + T7: outputs of a bidirectional run back to (sentence, language).

    A block of ``block`` outputs holds the Vietnamese outputs (e2v) of block/2
    sentences, then the English outputs (v2e) of the same sentences; with
    blocks of two, even ids are Vietnamese and odd ids English.
    """
    if block < 2 or block % 2:
        raise ValueError("block must be even")
    i, half = F.col(id_col), block // 2
    place = F.pmod(i, F.lit(block))
    return log.select((F.floor(i / block) * half + F.pmod(place, F.lit(half))).cast("bigint").alias("sent_id"),
                      F.when(place < half, F.lit("vi")).otherwise(F.lit("en")).alias("lang"),
                      T.join_subwords("text").alias("text"))


def collect_synthetic(log: DataFrame, tgt_lang: str, id_col: str = "id") -> DataFrame:
    """Decoder outputs -> ``tok`` (subwords joined) and ``syn`` (compounds
    split for Vietnamese, unchanged for English)."""
    tok = T.join_subwords("text")
    syn = T.join_compounds(tok) if tgt_lang == "vi" else tok
    return log.select(id_col, tok.alias("tok"), syn.alias("syn"))
