"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, applies NFKC, drops zero-width marks, maps homoglyphs to
Latin letters and substituted digits and signs to the letters they stand for
(numbers, and signs that end a word, stay out), joins the look-alikes i and l, and turns everything but
letters into single spaces.

The lexicon is learned from labelled rows. Entries are folded words and word
prefixes; an entry's weight is its log odds between toxic and clean rows, kept
if it is over-represented ``least_ratio`` times and its likelihood-ratio
statistic outweighs the number of entries tested. An entry's evidence counts
different neighbours, not rows, so that the rare words of one much copied
document don't become entries. Exception phrases are word pairs around an
entry that clean rows use and toxic ones don't (more can be given); a match
inside one doesn't count.

A text's density is the sum of the weights of its matches (the heaviest for
each word) over its words. The score is density / (density + middle), with the
middle chosen on the labelled rows to part toxic from clean best.

At most about ``max_rows`` labelled rows are learned from, chosen by a hash;
each step aggregates them in Spark, and only the lexicon reaches the driver.

Edge cases: null or empty text has score 0. Rows without a label are not
learned from; without a toxic or a clean row the lexicon is empty and all
scores are 0. Repeated rows are scored one by one. Very long texts are read
whole. Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import materialise

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁӏԛԝαβεικνορτυχ", "abekmhopctyxijsdiqwabeiknoptux", strict=True))
#: Digits and signs that stand for letters; l, 1, ! and | join i.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}
INVISIBLE = dict.fromkeys("\u00ad\u200b\u200c\u200d\u2060\ufeff")
PREFIXES = (4, 5, 6)
_ODD = re.compile(f"[{''.join(HOMOGLYPHS | INVISIBLE)}]")
_PLAIN = str.maketrans(HOMOGLYPHS | INVISIBLE)
_NUMBER = re.compile(r"(?<!\w)[\d!|@$.,:/-]+(?!\w)")
_SIGN = re.compile(r"[!|@$]+(?!\w)")
_OTHER = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Folded words with a space before, between and after them."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
        if _ODD.search(t):
            t = t.translate(_PLAIN)
    t = _SIGN.sub(" ", _NUMBER.sub(" ", t))
    for sign, letter in SUBSTITUTES.items():
        t = t.replace(sign, letter)
    return f" {_OTHER.sub(' ', t).strip()} "


class Lexicon:
    """Entries (pattern with its leading space -> weight), exception phrases and the middle density."""

    def __init__(self, entries: dict[str, float], exceptions: list[str] | None = None, middle: float = 1.0):
        self.entries, self.exceptions, self.middle = entries, sorted(set(exceptions or [])), middle
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}  # built anew where it is used

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for pattern in self.exceptions:
                a.add_word(pattern, (len(pattern), None))
            for pattern, weight in self.entries.items():
                a.add_word(pattern, (len(pattern), weight))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> dict[int, float]:
        """Weight of each matched word by its position, without those inside an exception phrase."""
        if not self.entries:
            return {}
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton().iter(folded):
            at = end - size + 1
            if weight is None:
                spared.append((at, end))
            elif weight > found.get(at, 0.0):
                found[at] = weight
        for begin, end in spared:
            for at in [a for a in found if begin <= a < end]:
                del found[at]
        return found

    def density(self, text: str | None) -> float:
        folded = fold(text)
        words = folded.count(" ") - 1
        return sum(self.matches(folded).values()) / words if words > 0 else 0.0

    def score(self, text: str | None) -> float:
        d = self.density(text)
        return d / (d + self.middle) if d > 0 else 0.0


def features(words: list[str]) -> set[tuple[str, int]]:
    """(entry, bit) of the words: whole words and prefixes, the bit standing for the word's neighbours."""
    out = set()
    for i, w in enumerate(words):
        bit = hash_bit((words[i - 1] if i else "") + " " + (words[i + 1] if i + 1 < len(words) else ""))
        out.add((f" {w} ", bit))
        for n in PREFIXES:
            if len(w) >= n:
                out.add((f" {w[:n]}", bit))
    return out


def hash_bit(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) & 63


def _tally(rows: DataFrame) -> DataFrame:
    """(entry, toxic, n, bits): rows and neighbour bitmap of each entry per label, summed within tasks first."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 500):
                n: dict[tuple[str, int], int] = {}
                bits: dict[tuple[str, int], int] = {}
                part = f.iloc[at:at + 500]
                for text, toxic in zip(part["text"], part["toxic"], strict=True):
                    seen = set()
                    for entry, bit in features(fold(text).split()):
                        key = (entry, toxic)
                        bits[key] = bits.get(key, 0) | 1 << bit
                        if entry not in seen:
                            seen.add(entry)
                            n[key] = n.get(key, 0) + 1
                yield pd.DataFrame({"entry": [k[0] for k in n], "toxic": [k[1] for k in n], "n": list(n.values()),
                                    "bits": np.array([bits[k] for k in n], dtype=np.uint64).view(np.int64)})

    parts = rows.mapInPandas(run, "entry string, toxic int, n bigint, bits bigint")
    return parts.groupBy("entry", "toxic").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))


def _sample(labelled: DataFrame, text: str, label: str, max_rows: int, seed: int) -> DataFrame:
    rows = labelled.where(F.col(label).isNotNull()).select(F.col(text).alias("text"), (F.col(label) > 0).cast("int").alias("toxic"))
    count = rows.count()
    part = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return materialise(rows.where(part < F.lit(max_rows / max(count, 1))))


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic", max_rows: int = 20_000, least_ratio: float = 8.0,
          exceptions: tuple[str, ...] = (), seed: int = 5) -> Lexicon:
    """Learn the lexicon, its exception phrases and the middle from rows of (text, label)."""
    rows = _sample(labelled, text, label, max_rows, seed)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = [fold(x) for x in exceptions]
    if len(sizes) < 2:
        return Lexicon({}, given)
    weights = _weights(rows, sizes, least_ratio)
    lexicon = Lexicon(weights, given)
    if weights:
        lexicon = Lexicon(weights, given + _mined_exceptions(rows, lexicon))
        lexicon.middle = _middle(rows, lexicon)
    return lexicon


def _weights(rows: DataFrame, sizes: dict[int, int], least_ratio: float) -> dict[str, float]:
    toxic, clean = float(sizes[1]), float(sizes[0])
    # rows that an entry can speak for: no more than its different neighbours (linear counting of 64 bits)
    near = -64 * F.log(F.greatest(1 - F.bit_count("bits") / F.lit(64.0), F.lit(1e-9)))
    side = lambda k: F.coalesce(F.max(F.when(F.col("toxic") == k, F.when(F.bit_count("bits") < 64, F.least(
        F.col("n").cast("double"), near)).otherwise(F.col("n").cast("double")))), F.lit(0.0))
    pairs = materialise(_tally(rows).groupBy("entry").agg(side(1).alias("t"), side(0).alias("c")).where("t >= 2"))
    tested = max(1, pairs.count())
    t, c = F.col("t"), F.col("c")
    ratio = ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1))
    share = toxic / (toxic + clean)
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    g = 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share)))
    chosen = pairs.where((ratio >= least_ratio) & (g >= 2 * float(np.log(tested)))).select("entry", F.log(ratio).alias("w"))
    return {r["entry"]: min(8.0, r["w"]) for r in chosen.orderBy("entry").collect()}


def _mined_exceptions(rows: DataFrame, lexicon: Lexicon, least: int = 3) -> list[str]:
    """Word pairs around an entry in at least ``least`` clean rows and no toxic row."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for text, toxic in zip(f["text"], f["toxic"], strict=True):
                folded, pairs = fold(text), set()
                for at in lexicon.matches(folded):
                    end = folded.index(" ", at + 1)
                    if end + 1 < len(folded):
                        pairs.add(folded[at:folded.index(" ", end + 1) + 1])
                    if at:
                        pairs.add(folded[folded.rindex(" ", 0, at):end + 1])
                out += [(p, toxic) for p in pairs]
            yield pd.DataFrame(out, columns=["pair", "toxic"]).astype({"toxic": "int32"})

    pairs = rows.mapInPandas(run, "pair string, toxic int").groupBy("pair").agg(
        F.sum(F.lit(1) - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
    return [r["pair"] for r in pairs.where((F.col("clean") >= least) & (F.col("toxic") == 0)).select("pair").collect()]


def _middle(rows: DataFrame, lexicon: Lexicon) -> float:
    """Density that parts toxic from clean best (true minus false positive rate), between the two nearest bins."""
    density = F.pandas_udf(lambda s: pd.Series([lexicon.density(t) for t in s], dtype="float64"), "double")
    step = 20.0  # bins of 1/20 in the density's logarithm: a few hundred rows reach the driver
    bins = (rows.select("toxic", density.asNondeterministic()("text").alias("d")).where("d > 0")
            .groupBy(F.floor(F.log("d") * step).alias("bin")).agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
            .orderBy("bin").collect())
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    t = c = 0
    best, middle = -1.0, 1.0
    for i in range(len(bins) - 1, -1, -1):
        t, c = t + bins[i]["t"], c + bins[i]["n"] - bins[i]["t"]
        gain = t / sizes[1] - c / sizes[0]
        if gain > best:
            below = bins[i - 1]["bin"] + 1 if i else bins[i]["bin"] - 2 * step * np.log(2)
            best, middle = gain, float(np.exp((bins[i]["bin"] + below) / 2 / step))
    return middle


def scores(lexicon: Lexicon, text: Column) -> Column:
    """Score column (0 to 1) of a text column."""

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return toxicity.asNondeterministic()(text)
