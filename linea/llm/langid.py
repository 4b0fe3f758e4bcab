"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, everything but letters becomes a space, and its
character 2-, 3- and 4-grams are hashed into ``buckets`` rows of an embedding
matrix. The average of those rows goes through a linear softmax. Embeddings
and softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of the different pieces of labelled texts (``max_chars`` in all,
spread evenly over the languages, but a least number of pieces for each); a held-back part of the sample calibrates the softmax temperature
and the rejection threshold. Prediction reads every whole text inside Arrow
tasks: the embedding and softmax matrices are multiplied once, so a text costs
one gather of ``classes`` numbers per n-gram. A text is rejected when its best
probability is lower, or fewer of its n-grams were met in training, than in
(almost) all pieces not trained on. Both limits go by the length of the text,
the second also by its predicted language, and keys with digits inside don't
count for it if other words are there; pieces joined from two languages count
for the first, so that texts mixing two learned languages stay.

Edge cases: null text or a text without letters is rejected as ``und`` with
score 0. Rows with null language are never learned from. No labelled row at
all: everything is ``und``, and only texts without letters are rejected. Repeated rows are predicted one by one. Columns
that the operator does not use, whatever their names, pass through unchanged
(the three output columns replace same-named ones).
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
ORDERS = (2, 3, 4)
#: Letters and gaps of the texts that rejection limits are taken for: a text goes by the last that it reaches.
LENGTHS = (16, 32, 64, 128, 256)
#: Share of pieces that the limits leave out.
LOWEST = 0.001
#: The coverage limit allows so many times the unknown n-grams of the worst other piece, and this share at least (a new name);
#: the probability limit is a part of that of the worst other piece.
UNKNOWN_TIMES, SPARED, PART = 2.0, 0.05, 0.9
#: Multipliers of the n-gram hash (odd, one per position).
MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
#: Length of an embedding's step against the softmax's.
EMBED_RATE = 20.0
OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                    T.StructField("accepted", T.BooleanType())])
WORD = re.compile(r"[^\W_]+")
_LETTERS: dict[int, np.ndarray] = {}


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; runs of non-letters become one 0."""
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=np.uint32)
        table[:0x40000] = [c if chr(c).isalpha() else 0 for c in range(0x40000)]
        _LETTERS[0] = table
    codes = _LETTERS[0][np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = codes != 0
    keep[1:] |= keep[:-1]
    keep[0] = True
    return codes[keep]


def ngram_ids(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every 2-, 3- and 4-gram (``buckets`` is a power of two)."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    out, h = [], codes * np.uint32(MIX[0])
    for n in ORDERS:
        if len(codes) < n:
            break
        h = (h[:-1] ^ codes[n - 1:]) * np.uint32(MIX[n - 1])
        h ^= h >> np.uint32(15)
        out.append(h >> shift)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def pieces(docs: DataFrame, text: str, lang: str, chunk: int, seed: int) -> DataFrame:
    """(l, t, h in 0..1): the labelled texts cut into pieces of ``chunk`` characters, those with letters."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))  # linear in the text
    rows = rows.select(F.col(lang).alias("l"), F.explode(cut).alias("t")).where(F.col("t").rlike(r"(?s)\p{L}.*?\p{L}"))
    return rows.withColumn("h", F.pmod(F.xxhash64("t", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40)))


def sampled(docs: DataFrame, text: str, lang: str, max_chars: int, seed: int, chunk: int = 300, least: int = 200) -> DataFrame | None:
    """(l, t): different pieces of labelled texts, ``max_chars`` characters at most and the same share of each language; None: no piece.

    A language keeps ``least`` pieces (all it has, if fewer) even where its share holds fewer.
    """
    every = pieces(docs, text, lang, chunk, seed)
    # different pieces of each language, by length within a factor of 2: some rows per language
    sizes = (every.groupBy("l", F.floor(F.log2(F.length("t"))).alias("k"))
             .agg(F.approx_count_distinct("t").alias("n"), F.avg(F.length("t")).alias("size")).collect())
    if not sizes:
        return None
    number, chars = {}, {}
    for r in sizes:
        number[r["l"]] = number.get(r["l"], 0) + r["n"]
        chars[r["l"]] = chars.get(r["l"], 0) + r["n"] * r["size"]
    share = max_chars / len(number)
    # pieces go by their hash alone: a rerun or another partitioning takes the same ones. About twice as many as
    # are kept pass here, so that the shuffle is small
    rate = {x: min(1.0, 2 * (share / chars[x] + least / number[x])) for x in number}
    limits = F.create_map(*[F.lit(x) for kv in rate.items() for x in kv])
    some = every.where(F.col("h") < limits[F.col("l")]).distinct()
    order = Window.partitionBy("l").orderBy("h", "t")
    kept = some.withColumn("i", F.row_number().over(order)).withColumn("upto", F.sum(F.length("t")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return kept.where((F.col("upto") <= share) | (F.col("i") <= least)).select("l", "t")


def sample(docs: DataFrame, text: str, lang: str, max_chars: int, seed: int, chunk: int = 300, least: int = 200) -> list[tuple[str, str]]:
    """The pieces of :func:`sampled`, sorted."""
    kept = sampled(docs, text, lang, max_chars, seed, chunk, least)
    return [] if kept is None else sorted((r["l"], r["t"]) for r in kept.collect())


class Model:
    """Classes, the folded (embedding x softmax) table, temperature and thresholds.

    ``table`` has a last column that is 1 for n-grams met in training: its
    mean over a text is the text's coverage.
    """

    def __init__(self, classes: list[str], table: np.ndarray, bias: np.ndarray):
        self.classes, self.table, self.bias = classes, table, bias
        self.temperature = 1.0
        self.reject, self.cover = np.zeros(len(LENGTHS)), np.zeros((len(LENGTHS), len(classes)))

    def means(self, ids: np.ndarray) -> tuple[np.ndarray, float]:
        """Logits and coverage of a text's n-grams."""
        if len(ids) > 4 * len(self.table):
            total = np.bincount(ids, minlength=len(self.table)).astype(np.float64) @ self.table
        else:
            total = self.table[ids].sum(axis=0)
        return total[:-1] / len(ids) + self.bias, total[-1] / len(ids)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        codes = letter_codes(text or "")
        if not self.classes or not codes.any():
            return UNKNOWN, 0.0, bool(codes.any())
        z, cover = self.means(ngram_ids(codes, len(self.table)))
        p = softmax(z[None, :] / self.temperature)[0]
        k = int(p.argmax())
        at = np.searchsorted(LENGTHS, len(codes), side="right") - 1
        keep = at < 0 or p[k] >= self.reject[at] and (cover >= self.cover[at, k] or self.known(text, k))
        return self.classes[k], float(min(1.0, p[k])), bool(keep)

    def known(self, text: str, k: int) -> bool:
        """Whether the words without digits are covered as class ``k`` is."""
        codes = letter_codes(WORD.sub(lambda m: m[0] if m[0].isalpha() else " ", text))
        at = np.searchsorted(LENGTHS, len(codes), side="right") - 1
        return at >= 0 and self.means(ngram_ids(codes, len(self.table)))[1] >= self.cover[at, k]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, str]], buckets: int = 1 << 17, dim: int = 16, epochs: int = 2,
        chunk: int = 300, rate: float = 4.0, least_steps: int = 400, seed: int = 7) -> Model:
    """Train on (language, text) rows; whole texts are cut into pieces of ``chunk`` characters.

    ``epochs`` is the number of passes; small samples are passed until there are ``least_steps`` steps.
    """
    classes = sorted({lang for lang, _ in rows})
    empty = Model(classes, np.zeros((buckets, len(classes) + 1)), np.zeros(len(classes)))
    bags, labels, texts = [], [], []
    for lang, text in rows:
        codes = letter_codes(text)
        for at in range(0, len(codes), chunk):
            piece = codes[at:at + chunk]
            if np.count_nonzero(piece) >= 2:
                bags.append(np.unique(ngram_ids(piece, buckets), return_counts=True))
                labels.append(classes.index(lang))
                texts.append(piece)
    if not bags:
        return empty
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    y = np.asarray(labels)
    held = order[: len(bags) // 5]
    train = order[len(bags) // 5:]
    emb = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    out = np.zeros((dim, len(classes)))
    bias = np.zeros(len(classes))
    batch, done = 32, 0
    epochs = max(epochs, -(-least_steps * batch // max(1, len(train))))
    steps = epochs * -(-len(train) // batch)
    for _ in range(epochs):
        for at in range(0, len(train), batch):
            pick = train[at:at + batch]
            ids = np.concatenate([bags[i][0] for i in pick])
            sizes = np.array([len(bags[i][0]) for i in pick])
            weight = np.concatenate([bags[i][1] / bags[i][1].sum() for i in pick])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(emb[ids] * weight[:, None], starts, axis=0)
            grad = softmax(mean @ out + bias)
            grad[np.arange(len(pick)), y[pick]] -= 1
            grad /= len(pick)
            lr = rate * (1 - done / steps)
            back = grad @ out.T
            out -= lr * mean.T @ grad
            bias -= lr * grad.sum(axis=0)
            # an n-gram holds a small share of its piece, so embeddings take longer steps than the softmax
            np.add.at(emb, ids, -lr * EMBED_RATE * np.repeat(back, sizes, axis=0) * weight[:, None])
            done += 1
    holders = np.zeros(buckets, dtype=np.int64)  # pieces of the training part that hold an n-gram
    for i in train:
        holders[bags[i][0]] += 1
    model = Model(classes, np.hstack([emb @ out, (holders > 0)[:, None]]), bias)
    check = held if len(held) else train
    means = np.stack([(bags[i][1] / bags[i][1].sum()) @ model.table[bags[i][0]] for i in check])
    model.temperature = calibrate(means[:, :-1] + bias, y[check])
    own = np.zeros(len(bags), dtype=np.int64)
    own[train] = 1
    limits(model, texts, y, own, holders, check, rng)
    return model


def lowest(values: np.ndarray) -> float:
    """What all values but the lowest ``LOWEST`` reach."""
    return float(np.quantile(values, LOWEST)) if len(values) else 0.0


def limits(model: Model, texts: list[np.ndarray], y: np.ndarray, own: np.ndarray, holders: np.ndarray, check: np.ndarray, rng) -> None:
    """Set the rejection limits from starts of pieces, a row of limits for each length.

    Coverage of a piece counts n-grams that training pieces other than itself
    hold (``own``: 1 for pieces of the training part), so that few pieces give
    low limits. Probabilities are those of ``check``, and of pairs of them from
    two languages joined at even lengths.
    """
    for row, size in enumerate(LENGTHS):
        ids = {i: ngram_ids(texts[i][:size], len(model.table)) for i in range(len(texts)) if len(texts[i]) >= size}
        cover = {i: float(np.mean(holders[g] > own[i])) for i, g in ids.items()}
        low = np.array([lowest(np.array([c for i, c in cover.items() if y[i] == k])) for k in range(len(model.classes))])
        model.cover[row] = 1 - np.clip(UNKNOWN_TIMES * (1 - low), SPARED, 1)
        pure = [i for i in check if i in ids]
        z = np.array([model.means(ids[i])[0] for i in pure]).reshape(len(pure), len(model.classes))
        other = rng.permutation(len(pure))
        two = y[pure] != y[np.array(pure, dtype=np.int64)[other]]
        p = softmax(z / model.temperature)
        best = p.max(axis=1)[p.argmax(axis=1) == y[pure]]
        mixed = softmax((z + z[other])[two] / 2 / model.temperature).max(axis=1) if two.any() else np.zeros(0)
        model.reject[row] = PART * lowest(np.concatenate([best, mixed]))


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least negative log likelihood on a fixed grid."""
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_chars: int = 2_000_000, seed: int = 7) -> Model:
    """Fit a model on a bounded sample (``max_chars`` characters) of the labelled texts of ``docs``.

    One task fits it and only the finished numbers reach the driver, whose memory does not hold the sample's n-grams.
    """
    kept = sampled(docs, text, lang, max_chars, seed)
    if kept is None:
        return fit([], seed=seed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = fit(sorted(row for f in frames for row in zip(f["l"], f["t"], strict=True)), seed=seed)
        yield pd.DataFrame({"model": [pickle.dumps((m.classes, m.table, m.bias, m.temperature, m.reject, m.cover))]})

    classes, table, bias, *limits = pickle.loads(kept.repartition(1).mapInPandas(run, "model binary").first()["model"])
    model = Model(classes, table, bias)
    model.temperature, model.reject, model.cover = limits
    return model


def predictor(model: Model, text: Column) -> Column:
    """Struct column (lang_pred, score, accepted) for a text column."""
    shared = model

    @F.pandas_udf(OUT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.predict(t) for t in texts], columns=OUT.names)

    return predict.asNondeterministic()(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted`` (false: rejected)."""
    got = docs.withColumn("__langid", predictor(model, F.col(text)))
    return got.withColumns({c: F.col(f"__langid.{c}") for c in OUT.names}).drop("__langid")
