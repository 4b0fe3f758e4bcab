"""Compound segmentation re-aimed as a Spark job (T4).

Mining: adjacent-token pairs and single tokens are counted over the corpus
and scored by pointwise mutual information; pairs with enough support and
PMI form the lexicon. Matching: greedy, left to right, non-overlapping —
within a run of consecutive lexicon pairs every other pair (from the run's
start) is joined with ``_`` (the inverse of T8): phrases of two words.

Compounds of any length (:func:`mine_phrases`, :func:`segment_phrases`): the
lexicon grows a word at a time, from n-grams whose first and last n-1 words are
in it; a piece of lines sends each of these once with its count, and no others. For
matching, each task gets the phrases if they are few enough to be held, and lines
stay where they lie. Otherwise lines are dealt to parts; the different pairs of
neighbours of a part (not its tokens) meet the phrases that begin so, which come
back to the part; a set of bits keeps most pairs that begin no phrase from
travelling. Positions walk the prefix tree: a position stays in the walk only
while its words are a prefix of some phrase. The matches of a line are a lattice
over its positions; its path takes the longest match first, or the highest sum
of scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linea.operators.ngrams import Known, gram_counts, joined, known, lists, sent, word_hashes
from linea.operators.positional import lookup_join


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``w, c``: how often each token occurs."""
    return df.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c"))


def pair_counts(df: DataFrame, tokens: str = "tokens", min_count: int = 1) -> DataFrame:
    """``w1, w2, cnt``: how often each pair of neighbours occurs, if ``min_count`` times."""
    return _as_pairs(gram_counts(df, (2,), tokens, min_count))


def _as_pairs(grams: DataFrame) -> DataFrame:
    cut = F.instr("gram", " ")  # tokens hold no blank
    return grams.select(F.expr("substring_index(gram, ' ', 1)").alias("w1"), F.col("gram").substr(cut + 1, F.length("gram")).alias("w2"), "cnt")


def lexicon(pairs: DataFrame, uni: DataFrame, min_count: int = 5, min_pmi: float = 3.0, digits: int = 6) -> DataFrame:
    """The lexicon of counted pairs and tokens (of one corpus, or merged ones)."""
    bi = pairs.where(F.col("cnt") >= min_count)
    uni = uni.checkpoint(eager=True)
    n = uni.agg(F.sum("c")).first()[0] or 0
    j = lookup_join(bi, uni.select(F.col("w").alias("w1"), F.col("c").alias("c1")), "w1", "inner")
    j = lookup_join(j, uni.select(F.col("w").alias("w2"), F.col("c").alias("c2")), "w2", "inner")
    pmi = F.log(F.col("cnt") * F.lit(float(n)) / (F.col("c1") * F.col("c2")))
    return j.where(pmi >= F.lit(float(min_pmi))).select("w1", "w2", "cnt", F.round(pmi, digits).alias("pmi"))


def mine(df: DataFrame, tokens: str = "tokens", min_count: int = 5, min_pmi: float = 3.0,
         digits: int = 6) -> DataFrame:
    """``w1, w2, cnt, pmi`` with ``cnt >= min_count`` and ``pmi >= min_pmi``;
    pmi = ln(cnt * N / (c(w1) * c(w2))), N = number of tokens."""
    both = gram_counts(df, (1, 2), tokens, min_count).checkpoint(eager=True)  # tokens and pairs in one pass
    uni = both.where("n = 1").select(F.col("gram").alias("w"), F.col("cnt").alias("c"))
    return lexicon(_as_pairs(both.where("n = 2")), uni, min_count, min_pmi, digits)


def segment(df: DataFrame, lexicon: DataFrame, line: str = "line_id", tokens: str = "tokens") -> DataFrame:
    """``line, text``: lexicon pairs joined by ``_``, greedily left to right: phrases of two words, the first at each free position."""
    pairs = lexicon.select(F.concat_ws(" ", "w1", "w2").alias("phrase"), F.lit(1.0).alias("score"))
    return segment_phrases(df, pairs, line, tokens)


def mine_phrases(df: DataFrame, tokens: str = "tokens", min_count: int = 5, min_pmi: float = 3.0, max_words: int = 4,
                 digits: int = 6) -> DataFrame:
    """``phrase, words, cnt, pmi`` of compounds of 2 to ``max_words`` words.

    A phrase of n words is kept if it occurs ``min_count`` times, its first and
    last n-1 words are kept phrases, and ``pmi = ln(cnt * N^(n-1) / prod c(w))
    / (n-1) >= min_pmi``. Tokens hold no blank; texts are cut as ``split_ws`` does.
    """
    lines = df.select(F.col(tokens).alias("tokens"))
    both = gram_counts(lines, (1, 2), least=min_count).checkpoint(eager=True)  # tokens and pairs in one pass
    uni = both.where("n = 1").select(F.col("gram").alias("w"), F.col("cnt").alias("c"))
    total = float(uni.agg(F.sum("c")).first()[0] or 1)
    found, last = None, None
    for n in range(2, max_words + 1):
        counts = both.where("n = 2").select(F.col("gram").alias("phrase"), "cnt")
        if last is not None:  # only what begins and ends with a phrase is counted, and only that may continue
            counts = gram_counts(lines, (n,), least=min_count, before=known(last)).select(F.col("gram").alias("phrase"), "cnt").checkpoint(eager=True)
            kept = last.select(F.col("phrase").alias("head"))
            counts = counts.withColumn("head", F.substring_index("phrase", " ", n - 1)).withColumn("tail", F.expr("substring(phrase, locate(' ', phrase) + 1)"))
            counts = lookup_join(lookup_join(counts, kept, "head", "left_semi"), kept.withColumnRenamed("head", "tail"), "tail", "left_semi")
        words = counts.select("phrase", "cnt", F.explode(F.split("phrase", " ")).alias("w"))
        logs = lookup_join(words, uni, "w", "inner").groupBy("phrase", "cnt").agg(F.sum(F.ln("c")).alias("logs"))
        pmi = (F.ln("cnt") + F.lit(n - 1) * F.ln(F.lit(total)) - F.col("logs")) / (n - 1)
        last = logs.where(pmi >= F.lit(float(min_pmi))).select("phrase", F.lit(n).alias("words"), "cnt", F.round(pmi, digits).alias("pmi"))
        last = last.checkpoint(eager=True)
        if found is not None and not last.take(1):
            break
        found = last if found is None else found.unionByName(last)
    return found


#: About the most tokens of the lines that meet their phrases together.
TOKENS = 2_000_000


def _pairs(lines: DataFrame, begins: Known | None = None) -> DataFrame:
    """``part, pair``: the different pairs of neighbours of each part (sorted by part), of those that ``begins`` holds."""
    def told(part: int, held: list[pa.ListArray]) -> pa.RecordBatch:
        tokens = pa.concat_arrays(held)
        sizes, words = tokens.value_lengths().fill_null(0).to_numpy(), tokens.flatten().dictionary_encode()
        code, kinds = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        at = np.flatnonzero(np.arange(len(code)) + 1 < np.repeat(np.cumsum(sizes), sizes))
        if begins is not None:
            hashed = word_hashes(words.dictionary)
            at = at[begins.holds(joined(joined(None, hashed[code[at]]), hashed[code[at + 1]]))]
        both = pd.unique(code[at] * kinds + code[at + 1])
        pair = pc.binary_join_element_wise(*[words.dictionary.take(pa.array(x)) for x in (both // max(kinds, 1), both % max(kinds, 1))], " ")
        return pa.RecordBatch.from_arrays([pa.repeat(part, len(pair)), pair], ["part", "pair"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            of, tokens = batch.column("part").to_numpy(), lists(batch.column("tokens"))
            cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and of[a] != part:
                    yield told(part, held)
                    held = []
                part = int(of[a])
                held.append(tokens[a:b])
        if held:
            yield told(part, held)

    # all columns: the lines that the phrases come back to are then the same exchange
    return lines.mapInArrow(run, "part bigint, pair string")


class Tree:
    """The prefix tree of phrases, in arrays: a prefix of n words is a number, found by that of its first n - 1 words and its last word."""

    def __init__(self, phrases: pa.Array, scores: np.ndarray):
        cut = pc.split_pattern(phrases, " ")
        size = cut.value_lengths().to_numpy()
        first = np.cumsum(size) - size
        told = cut.flatten().dictionary_encode()
        self.words, of = told.dictionary, told.indices.to_numpy().astype(np.int64)
        here, self.levels = np.flatnonzero(size > 0), []
        node = of[first[here]]
        for n in range(2, int(size.max(initial=1)) + 1):
            long = size[here] >= n
            here, node = here[long], node[long]
            keys, node = np.unique(node * len(self.words) + of[first[here] + n - 1], return_inverse=True)
            best, own = np.full(len(keys), -np.inf), np.zeros(len(keys), bool)
            end = size[here] == n
            np.maximum.at(best, node[end], scores[here[end]])
            own[node[end]] = True
            self.levels.append((keys, best, own))

    def matches(self, code: np.ndarray, ends: np.ndarray, words: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For 2, 3, … words: the positions where a phrase of so many starts, and its score.

        ``code`` numbers each position's token among ``words``, ``ends`` is the end of its line.
        """
        if not self.levels:
            return []
        code = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)[code]
        at = np.flatnonzero(code >= 0)
        place, out = code[at], []
        for n, (keys, best, own) in enumerate(self.levels, 2):
            inside = at + n - 1 < ends[at]
            at, place = at[inside], place[inside]
            following = code[at + n - 1]
            key = place * len(self.words) + following
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            met = (keys[place] == key) & (following >= 0)
            at, place = at[met], place[met]
            out.append((at[own[place]], best[place[own[place]]]))
        return out


def _longest(matches: list, tokens: int) -> np.ndarray:
    """How many words the piece of each position has that a path of longest matches takes; 1 elsewhere."""
    most, taken = np.ones(tokens, np.int64), np.ones(tokens, np.int64)
    for n, (at, _) in enumerate(matches, 2):
        most[at] = n
    starts = np.flatnonzero(most > 1)
    free, kept = 0, []
    for a, n in zip(starts.tolist(), most[starts].tolist(), strict=True):
        if a >= free:
            kept.append(a)
            free = a + n
    taken[kept] = most[kept]
    return taken


def _best(matches: list, ends: np.ndarray) -> np.ndarray:
    """As :func:`_longest`, for the path of the highest sum of scores (longer phrases of equals)."""
    options: dict[int, list] = {}
    for n, (at, score) in enumerate(matches, 2):
        for a, s in zip(at.tolist(), score.tolist(), strict=True):
            options.setdefault(a, []).append((n, s))
    taken, end = np.ones(len(ends), np.int64), ends.tolist()
    sums, words = [0.0] * (len(end) + 1), [1] * len(end)
    after = lambda a, n: sums[a + n] if a + n < end[a] else 0.0  # noqa: E731  (a line's end, not the next line's start)
    for a in range(len(end) - 1, -1, -1):
        sums[a], words[a] = max([(after(a, 1), 1), *[(s + after(a, n), n) for n, s in options.get(a, [])]])
    a = 0
    while a < len(end):
        taken[a] = words[a]
        a += words[a]
    return taken


def _joined(tokens: pa.ListArray, tree: Tree, mode: str) -> pa.Array:
    """The text of each line, the phrases of its path joined."""
    sizes = tokens.value_lengths().fill_null(0).to_numpy()
    stop = np.cumsum(sizes)
    told = tokens.flatten().dictionary_encode()
    ends = np.repeat(stop, sizes)
    matches = tree.matches(told.indices.to_numpy().astype(np.int64), ends, told.dictionary)
    taken = _longest(matches, len(ends)) if mode == "longest" else _best(matches, ends)
    before = np.ones(len(ends), np.int8)  # what stands before a token: nothing, a blank or "_"
    before[(stop - sizes)[sizes > 0]] = 0
    starts = np.flatnonzero(taken > 1)
    for n in range(1, int(taken.max(initial=1))):
        before[starts[taken[starts] > n] + n] = 2
    pieces = pc.binary_join_element_wise(pa.array(["", " ", "_"]).take(pa.array(before)), tokens.flatten(), "")
    whole = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]), pa.int32()), pieces)
    return pc.binary_join(whole, "")


def _glued(mode: str):
    def run(lines: pa.Table, phrases: pa.Table) -> pa.Table:
        tree = Tree(phrases["phrase"].combine_chunks(), phrases["score"].to_numpy())
        return pa.table([lines["line"], _joined(lists(lines["tokens"].combine_chunks()), tree, mode)], ["line", "text"])

    return run


#: The most phrases, and bytes of them, that each task holds as a tree.
HELD, HELD_BYTES = 2_000_000, 48 << 20


def _held(lines: DataFrame, lexicon: DataFrame, mode: str, out: str) -> DataFrame:
    """Lines meet a lexicon that a task can hold where they lie."""
    rows = lexicon.toArrow()
    sent = lines.sparkSession.sparkContext.broadcast((rows["phrase"].combine_chunks(), rows["score"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            if len(batch):
                tree = tree or Tree(*sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("line"), _joined(lists(batch.column("tokens")), tree, mode)], ["line", "text"])

    return lines.mapInArrow(run, out)


def segment_phrases(df: DataFrame, lexicon: DataFrame, line: str = "line_id", tokens: str = "tokens", mode: str = "longest") -> DataFrame:
    """``line, text``: phrases of ``lexicon`` (``phrase, score``) joined by ``_``.

    ``longest``: left to right, the longest phrase at each free position.
    ``best``: the path of the highest sum of scores (longer phrases of equals).
    Lines without tokens stay, as empty text. ``tokens`` may be texts: they are cut as ``split_ws`` does.
    """
    if mode not in ("longest", "best"):
        raise ValueError(mode)
    lines = df.select(F.col(line).alias("line"), sent(df, tokens).alias("tokens"))
    out = f"line {df.schema[line].dataType.simpleString()}, text string"
    lexicon = lexicon.where("score is not null").select("phrase", F.col("score").cast("double").alias("score")).checkpoint(eager=True)
    rows, used = lexicon.agg(F.count(F.lit(1)), F.sum(F.octet_length("phrase") + 8)).first()
    if rows <= HELD and (used or 0) <= HELD_BYTES:
        glued = _held(lines, lexicon, mode, out)
    else:
        text = dict(lines.dtypes)["tokens"] == "string"  # six bytes a token, about
        n = lines.agg(F.sum(F.octet_length("tokens") / 6 if text else F.greatest(F.size("tokens"), F.lit(0)))).first()[0] or 0
        n = int(n)
        n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-n // TOKENS))
        lines = lines.withColumn("part", F.pmod(F.xxhash64("line"), F.lit(n))).repartition(n, "part").sortWithinPartitions("part")
        begin = lexicon.select(F.substring_index("phrase", " ", 2).alias("pair"), "phrase", "score")
        phrases = lookup_join(_pairs(lines, known(begin.select("pair").distinct(), "pair")), begin, "pair", "inner").select("part", "phrase", "score")
        glued = lines.groupBy("part").cogroup(phrases.groupBy("part")).applyInArrow(_glued(mode), out)
    return glued.select(F.col("line").alias(line), "text")
