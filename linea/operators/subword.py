"""Joint subword (BPE) learning and application (M3-M6).

Learning (M4) works on the word-type table ``word, freq, syms`` (symbols
space-joined; the last symbol carries the end-of-word marker) and equals
one-merge-at-a-time learning. Ranking ties: higher count first, then the larger
pair (as the reference tool's ``max`` over ``(count, pair)``).

Merges are learned in *windows*, from the current best count down to a
threshold. Pairs below the threshold at a window's start stay below it: a merge
only creates pairs whose count is bounded by a pair it replaces. So words fall
apart at those cold pairs, and what is left, the different *hot segments* with
their summed frequencies, decides all merges of the window:

1. pair counts (M3) over the word types; the window's threshold is set just
   above the first pair beyond the ``hot`` best ones (a bounded list);
2. hot segments: cut in the tasks that hold the types, summed by a
   ``groupBy``. More than ``window`` of them: a narrower window;
3. one task holds the segments (at most ``window``) with an incremental index:
   pair counts, and pair -> segments. A merge touches only the segments that
   hold its pair and adds and subtracts their pairs;
4. the window's merges are replayed on the word types, where they lie.

A merge whose product is a symbol already (the same string by another way)
would let counts of cold pairs add up; it ends the window and is made by itself
on the types. Where even the best pair's segments are too many, a round merges
the pairs that provably come next (:func:`choose_batch`) on the types.

Application (M6) is row-local: a task replays the merges on the different words
of its lines, and keeps a bounded number of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# End-of-word marker and continuation mark.
EOW = "</w>"
SEP = "@@"


def word_types(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``word, freq, syms``: word-type counts with initial character symbols."""
    w = df.select(F.explode(tokens).alias("word")).where(F.col("word") != "")
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    chars = F.regexp_extract_all(F.col("word"), F.lit("(?s)."), 0)
    syms = F.concat(F.slice(chars, 1, F.size(chars) - 1),
                    F.array(F.concat(F.element_at(chars, -1), F.lit(EOW))))
    return counts.select("word", "freq", F.array_join(syms, " ").alias("syms"))


def pair_stats(types: DataFrame) -> DataFrame:
    """M3: ``a, b, cnt`` — adjacent symbol pairs weighted by word frequency.

    One JVM regex pass extracts the overlapping ``"a b"`` pairs (a match at
    every symbol start), then a partial + final hash aggregate sums them.
    """
    p = types.select("freq", F.explode(F.regexp_extract_all("syms", F.lit(r"(?<!\S)(?=(\S+ \S+))"), 1))
                     .alias("p"))
    g = p.groupBy("p").agg(F.sum("freq").alias("cnt"))
    return g.select(F.substring_index("p", " ", 1).alias("a"), F.substring_index("p", " ", -1).alias("b"), "cnt")


def choose_batch(top: list[tuple[str, str, int]], min_count: int = 2) -> list[tuple[str, str, int]]:
    """Merges that one-at-a-time learning would pick next, from the ranked top list."""
    top = [t for t in top if t[2] >= min_count]
    if not top:
        return []
    batch, used = [top[0]], {top[0][0], top[0][1]}
    cut = None
    for a, b, c in top[1:]:
        if a in used or b in used or a == b:
            cut = c
            break
        batch.append((a, b, c))
        used |= {a, b}
    if cut is None:
        cut = top[-1][2]  # pairs beyond the list may conflict: they count at most this
        if len(batch) > 1 and batch[-1] == top[-1]:
            batch = batch[:-1]
    return [batch[0]] + [t for t in batch[1:] if t[2] > cut]


#: Most hot segments that one task learns from; most pairs of a window's list.
WINDOW, HOT_PAIRS = 200_000, 1 << 16


def hot_segments(syms: list[str], hot: set[tuple[str, str]]) -> list[list[str]]:
    """The stretches of symbols whose neighbouring pairs are all hot (two symbols or more)."""
    out, begin = [], 0
    for i in range(1, len(syms) + 1):
        if i == len(syms) or (syms[i - 1], syms[i]) not in hot:
            if i - begin > 1:
                out.append(syms[begin:i])
            begin = i
    return out


def merge_pair(syms: list[str], a: str, b: str) -> list[str]:
    """``syms`` with the pair merged, left to right without overlaps."""
    out, i, n = [], 0, len(syms)
    while i < n:
        if i < n - 1 and syms[i] == a and syms[i + 1] == b:
            out.append(a + b)
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


def _falling(pair: tuple[str, str]) -> tuple:
    """A key whose ascending order is the descending order of pairs."""
    return tuple(tuple(-ord(c) for c in s) + (1,) for s in pair)


def is_symbol(product: str, products: set[str]) -> bool:
    """Whether a merge's product may be a symbol already: made before, or a first symbol of some word."""
    return product in products or len(product) == 1 or (len(product) == 1 + len(EOW) and product.endswith(EOW))


class PairIndex:
    """Pair counts and pair -> segments, kept up to date merge by merge."""

    def __init__(self, segments: list[tuple[list[str], int]], least: int):
        self.syms = [s for s, _ in segments]
        self.freq = [f for _, f in segments]
        self.least = least
        self.count: dict[tuple[str, str], int] = {}
        self.where: dict[tuple[str, str], set[int]] = {}
        for i in range(len(segments)):
            self._add(i)
        self.heap = [(-c, _falling(p), p) for p, c in self.count.items() if c >= least]
        heapq.heapify(self.heap)

    def _add(self, i: int) -> set[tuple[str, str]]:
        s, f = self.syms[i], self.freq[i]
        pairs = list(zip(s, s[1:], strict=False))
        for p in pairs:
            self.count[p] = self.count.get(p, 0) + f
            self.where.setdefault(p, set()).add(i)
        return set(pairs)

    def _subtract(self, i: int) -> None:
        s, f = self.syms[i], self.freq[i]
        for p in zip(s, s[1:], strict=False):
            self.count[p] -= f
            self.where[p].discard(i)

    def best(self) -> tuple[str, str, int] | None:
        """The pair of the highest count, the larger one of equals, if it is not below the threshold."""
        while self.heap:
            minus, key, p = self.heap[0]
            now = self.count[p]
            if now == -minus:
                return p[0], p[1], now
            heapq.heappop(self.heap)  # told before a merge took some
            if self.least <= now < -minus:
                heapq.heappush(self.heap, (-now, key, p))
        return None

    def merge(self, a: str, b: str) -> None:
        changed: set[tuple[str, str]] = set()
        for i in list(self.where[a, b]):
            self._subtract(i)
            self.syms[i] = merge_pair(self.syms[i], a, b)
            changed |= {p for p in self._add(i) if p[0] == a + b or p[1] == a + b}
        for p in changed:
            if self.count[p] >= self.least:
                heapq.heappush(self.heap, (-self.count[p], _falling(p), p))


def learn_window(segments: list[tuple[list[str], int]], least: int, most: int, products: set[str]) -> list[tuple[str, str, int]]:
    """The next merges with counts of ``least`` or more, ``most`` at most, up to one whose product is a symbol already."""
    index, out, known = PairIndex(segments, least), [], set(products)
    while len(out) < most and (best := index.best()) is not None:
        a, b, count = best
        if is_symbol(a + b, known):
            break
        out.append((a, b, count))
        known.add(a + b)
        index.merge(a, b)
    return out


def replay(syms: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Ranked merges on one word's symbols, lowest rank first."""
    while len(syms) > 1:
        found = [(ranks[p], p) for p in zip(syms, syms[1:], strict=False) if p in ranks]
        if not found:
            break
        syms = merge_pair(syms, *min(found)[1])
    return syms


def _segments(types: DataFrame, hot: set[tuple[str, str]]) -> DataFrame:
    """``seg, freq``: the different hot segments of the word types."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segs, freqs = [], []
            for syms, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for s in hot_segments(syms.split(" "), hot):
                    segs.append(" ".join(s))
                    freqs.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(segs, pa.string()), pa.array(freqs, pa.int64())], ["seg", "freq"])

    found = types.select("syms", F.col("freq").cast("bigint").alias("freq")).mapInArrow(cut, "seg string, freq bigint")
    return found.groupBy("seg").agg(F.sum("freq").alias("freq"))


def _learned(segments: DataFrame, least: int, most: int, products: set[str]) -> list[tuple[str, str, int]]:
    """The window's merges, learned in one task from at most ``WINDOW`` segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(s.split(" "), f) for batch in batches for s, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        merges = learn_window(held, least, most, products)
        yield pa.RecordBatch.from_arrays([pa.array([m[j] for m in merges], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64()))]
                                         + [pa.array(range(len(merges)), pa.int64())], ["a", "b", "cnt", "n"])

    rows = segments.coalesce(1).mapInArrow(run, "a string, b string, cnt bigint, n bigint").collect()
    return [(r["a"], r["b"], r["cnt"]) for r in sorted(rows, key=lambda r: r["n"])]


def _replayed(types: DataFrame, merges: list[tuple[str, str, int]]) -> DataFrame:
    """The word types after ``merges``, without a shuffle."""
    ranks = {(a, b): i for i, (a, b, _) in enumerate(merges)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            syms = [" ".join(replay(s.split(" "), ranks)) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(syms, pa.string())], ["word", "freq", "syms"])

    return types.select("word", "freq", "syms").mapInArrow(run, "word string, freq bigint, syms string")


def learn_types(types: DataFrame, num_merges: int, min_count: int = 2, top_k: int = 256, checkpoint_every: int = 1,
                window: int = WINDOW) -> tuple[list[tuple[str, str, int]], DataFrame]:
    """M4: up to ``num_merges`` merges ``(a, b, count)`` in learning order, and the word types in the merged symbols.

    ``top_k`` is the first window's number of pairs; later ones grow fourfold
    while their segments are few, and shrink where they exceed ``window``. The
    types are checkpointed every ``checkpoint_every`` windows and cached between.
    """
    merges: list[tuple[str, str, int]] = []
    cur = types.select("word", F.col("freq").cast("bigint").alias("freq"), "syms").checkpoint(eager=True)
    hot_pairs, rounds, alone, held = top_k, 0, False, []
    ranking = [F.col("cnt").desc(), F.col("a").desc(), F.col("b").desc()]
    while len(merges) < num_merges:
        pairs = pair_stats(cur).where(F.col("cnt") >= min_count).cache()
        new: list[tuple[str, str, int]] = []
        narrowed = False
        while not new:
            top = [(r["a"], r["b"], int(r["cnt"])) for r in pairs.orderBy(*ranking).limit(hot_pairs + 1).collect()]
            if not top:
                break
            least = top[-1][2] + 1 if len(top) > hot_pairs else min_count
            hot = {(a, b) for a, b, c in top if c >= least}
            products = {a + b for a, b, _ in merges}
            segments = None
            if hot and not alone:
                segments = _segments(cur, hot).cache()
                size = segments.count()
                if size <= window:
                    new = _learned(segments, least, num_merges - len(merges), products)
                    alone = not new  # the next merge makes a symbol that is there already
                    hot_pairs = min(hot_pairs * 4, HOT_PAIRS) if size < window // 4 else hot_pairs
                segments.unpersist()
                if new or (size <= window and not alone):
                    continue
            if not alone and hot_pairs > 1 and hot:  # too many segments
                hot_pairs, narrowed = max(1, hot_pairs // 4), True
                continue
            if not alone and not hot and not narrowed and hot_pairs < HOT_PAIRS:  # all of one count
                hot_pairs = min(hot_pairs * 4, HOT_PAIRS)
                continue
            new = top[:1] if alone else _distinct_products(choose_batch(top, min_count), products)
            new, alone = new[: num_merges - len(merges)], False
        pairs.unpersist()
        if not new:
            break
        merges.extend(new)
        rounds += 1
        nxt = _replayed(cur, new)
        if rounds % checkpoint_every == 0:
            cur = nxt.checkpoint(eager=True)
            for frame in held:
                frame.unpersist()
            held = []
        else:
            cur = nxt.cache()
            held.append(cur)
    if held:
        cur = cur.checkpoint(eager=True)
        for frame in held:
            frame.unpersist()
    return merges, cur


def _distinct_products(batch: list[tuple[str, str, int]], products: set[str]) -> list[tuple[str, str, int]]:
    """The batch up to a merge whose product is a symbol already (the first merge always stays)."""
    known, out = set(products), []
    for a, b, c in batch:
        if out and is_symbol(a + b, known):
            break
        out.append((a, b, c))
        known.add(a + b)
    return out


def learn(types: DataFrame, num_merges: int, min_count: int = 2, top_k: int = 256, checkpoint_every: int = 1,
          window: int = WINDOW) -> list[tuple[str, str, int]]:
    """M4: the merges alone (see :func:`learn_types`)."""
    return learn_types(types, num_merges, min_count, top_k, checkpoint_every, window)[0]


def merges_frame(spark, merges: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(merges)],
                                 "rank int, a string, b string, cnt long")


def encode_word(word: str, ranks: dict) -> list[str]:
    """Greedy application of ranked merges to one word (lowest rank first)."""
    if not word:
        return []
    syms = replay(list(word[:-1]) + [word[-1] + EOW], ranks)
    if syms[-1] == EOW:
        syms = syms[:-1]
    elif syms[-1].endswith(EOW):
        syms[-1] = syms[-1][: -len(EOW)]
    return syms


_MEMO: dict = {}
_MEMO_LIMIT = 1 << 18


def _segment_word(w: str, ranks: dict, key: int) -> str:
    """Per-worker memo of segmented words (bounded; cleared when full)."""
    memo = _MEMO.get(key)
    if memo is None or len(memo) > _MEMO_LIMIT:
        _MEMO.clear()  # one merge list at a time
        memo = _MEMO[key] = {}
    out = memo.get(w)
    if out is None:
        out = memo[w] = (SEP + " ").join(encode_word(w, ranks))
    return out


def apply_udf(spark, merges: list[tuple[str, str, int]]):
    """M6 as a column function: line text -> subword-segmented text."""
    bc = spark.sparkContext.broadcast({(a, b): i for i, (a, b, _) in enumerate(merges)})
    key = hash(tuple(merges))

    @F.pandas_udf(StringType())
    def bpe(lines: pd.Series) -> pd.Series:
        ranks = bc.value
        return lines.map(lambda s: None if s is None else
                         " ".join(_segment_word(w, ranks, key) for w in s.split(" ") if w != ""))
    return bpe


def subwords(types: DataFrame) -> DataFrame:
    """``word, freq, sub``: learned word types as text, all subwords but the last marked, without the end-of-word marker."""
    body = F.substring(F.col("syms"), F.lit(1), F.length("syms") - len(EOW))
    return types.select("word", "freq", F.replace(body, F.lit(" "), F.lit(SEP + " ")).alias("sub"))


def segment_words(words: DataFrame, merges: list[tuple[str, str, int]]) -> DataFrame:
    """``word, sub`` of the different words of ``words`` by replaying the merges, once a word."""
    ranks = {(a, b): i for i, (a, b, _) in enumerate(merges)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            subs = [(SEP + " ").join(encode_word(w, ranks)) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(subs, pa.string())], ["word", "sub"])

    return words.select("word").distinct().mapInArrow(run, "word string, sub string")


def replay_in_order(syms: list[str], ranks: dict[tuple[str, str], list[int]]) -> list[str]:
    """The merges one after the other on one word's symbols, as learning made them (a pair may have been merged twice)."""
    last = -1
    while len(syms) > 1:
        found = [(r, p) for p in zip(syms, syms[1:], strict=False) for r in ranks.get(p, ()) if r > last]
        if not found:
            break
        last, pair = min(found)
        syms = merge_pair(syms, *pair)
    return syms


#: Characters of lines that are cut together; most words whose subwords a task keeps.
PART, KEPT = 1 << 22, 1 << 18


def segmenter(merges: list[tuple[str, str, int]]):
    """M6 as a column function: a line's words in subwords, its different words replayed once as long as a task keeps them."""
    ranks: dict[tuple[str, str], list[int]] = {}
    for i, (a, b, _) in enumerate(merges):
        ranks.setdefault((a, b), []).append(i)
    kept: dict[str, str] = {}

    def cut(word: str) -> str:
        body = " ".join(replay_in_order([*word[:-1], word[-1] + EOW], ranks))[: -len(EOW)]
        return body.replace(" ", SEP + " ")

    def part(texts: pa.Array) -> pa.Array:
        words = pc.split_pattern(texts, " ")
        told = words.flatten().dictionary_encode()
        subs = []
        for word in told.dictionary.to_pylist():
            sub = kept.get(word)
            if sub is None and word:
                if len(kept) >= KEPT:
                    kept.clear()
                sub = kept[word] = cut(word)
            subs.append(sub)  # none of an empty word
        line = np.repeat(np.arange(len(texts)), words.value_lengths().fill_null(0).to_numpy())
        out = pa.array(subs, pa.string()).take(told.indices)
        full = out.is_valid()
        ends = np.concatenate([[0], np.cumsum(np.bincount(line[full.to_numpy(zero_copy_only=False)], minlength=len(texts)))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), out.filter(full))
        return pc.if_else(texts.is_valid(), pc.binary_join(lists, " "), pa.scalar(None, pa.string()))

    def run(texts: pa.Array) -> pa.Array:
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
        parts, at = [pa.array([], pa.string())], 0
        while at < len(texts):  # lines of PART bytes, one line at least
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, "right")))
            parts.append(part(texts[at:to]))
            at = to
        return pa.concat_arrays(parts)

    return F.arrow_udf(run, "string")


def segment(df: DataFrame, text: dict[str, str], merges: list[tuple[str, str, int]], known: DataFrame | None = None) -> DataFrame:
    """M6: ``df`` with each text column of ``text`` (input -> output name) in subwords, words parted by one space.

    Row-local: only the merges travel, whatever the number of word types or
    lines, and replaying them in order gives what the learner keeps
    (``known``), so that table need not meet the lines. Null stays null, empty
    stays empty.
    """
    bpe = segmenter(merges)
    kept = [c for c in df.columns if c not in text.values()]
    return df.select(*kept, *[bpe(F.col(source)).alias(name) for source, name in text.items()])


def type_vocabulary(types: DataFrame) -> DataFrame:
    """M5 of the learner's own corpus, counted over its word types: ``token, cnt``."""
    return (subwords(types).select(F.explode(F.split("sub", " ")).alias("token"), "freq").where(F.col("token") != "")
            .groupBy("token").agg(F.sum("freq").alias("cnt")))


def vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """M5: subword frequency list ``token, cnt`` of segmented text."""
    return (df.select(F.explode(F.split(F.col(text), " ")).alias("token")).where(F.col("token") != "")
            .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))
