"""Batched BPE learning equals one-merge-at-a-time learning; apply round-trips."""
import random
import re
from collections import Counter

from linea.operators import subword as SW


def py_learn(vocab, n, min_count=2):
    words = {tuple(w[:-1]) + (w[-1] + "</w>",): c for w, c in vocab.items()}
    merges = []
    for _ in range(n):
        stats = Counter()
        for syms, c in words.items():
            for a, b in zip(syms, syms[1:]):
                stats[(a, b)] += c
        if not stats:
            break
        best = max(stats, key=lambda p: (stats[p], p))
        if stats[best] < min_count:
            break
        merges.append((best[0], best[1], stats[best]))
        pat = re.compile(r"(?<!\S)" + re.escape(" ".join(best)) + r"(?!\S)")
        words = {tuple(pat.sub("".join(best), " ".join(s)).split(" ")): c for s, c in words.items()}
    return merges


def test_batched_learning_equals_sequential(spark):
    rnd = random.Random(5)
    alphabet = "abcde"
    for trial in range(3):
        vocab = Counter("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(150))
        df = spark.createDataFrame([([w] * 1,) for w in vocab.elements()], "tokens array<string>")
        got = SW.learn(SW.word_types(df), 25, checkpoint_every=4)
        assert got == py_learn(vocab, 25), trial


def test_choose_batch_rules():
    top = [("a", "b", 10), ("c", "d", 9), ("e", "f", 8), ("b", "x", 7), ("g", "h", 6)]
    assert SW.choose_batch(top) == [("a", "b", 10), ("c", "d", 9), ("e", "f", 8)]
    top = [("a", "b", 10), ("c", "d", 7), ("b", "x", 7)]
    assert SW.choose_batch(top) == [("a", "b", 10)]
    assert SW.choose_batch([("a", "b", 1)]) == []


def test_encode_word_roundtrip():
    merges = [("t", "h", 9), ("th", "e</w>", 8), ("a", "n", 5)]
    ranks = {(a, b): i for i, (a, b, _) in enumerate(merges)}
    assert SW.encode_word("the", ranks) == ["the"]
    assert SW.encode_word("than", ranks) == ["th", "a", "n"]  # final n carries the end marker
    for w in ["banana", "the", "x", "thethe"]:
        assert "".join(SW.encode_word(w, ranks)) == w


def test_apply_udf_roundtrip(spark):
    from pyspark.sql import functions as F
    from linea.functions import text as T
    merges = [("t", "h", 9), ("th", "e</w>", 8), ("a", "n", 5)]
    df = spark.createDataFrame([("the banana than",), ("",)], "s string")
    out = [r[0] for r in df.select(SW.apply_udf(spark, merges)("s")).collect()]
    assert out[0] == "the b@@ an@@ an@@ a th@@ a@@ n"
    back = [r[0] for r in df.select(T.join_subwords(SW.apply_udf(spark, merges)("s"))).collect()]
    assert back == ["the banana than", ""]
    assert F is not None


def vocab_frame(spark, vocab):
    return SW.word_types(spark.createDataFrame([(w.split(" "),) for w in vocab.elements()], "tokens array<string>"))


def test_windows_of_any_size_equal_sequential(spark):
    rnd = random.Random(11)
    vocab = Counter("".join(rnd.choice("abcab") for _ in range(rnd.randint(1, 9))) for _ in range(250))
    want = py_learn(vocab, 60)
    types = vocab_frame(spark, vocab)
    for window, top_k, n in ((200_000, 256, 60), (200_000, 3, 60), (25, 8, 12), (1, 4, 6)):
        assert SW.learn(types, n, top_k=top_k, window=window) == want[:n], (window, top_k)


def test_products_that_are_symbols_already(spark):
    # the letters of the end marker merge to the last symbol of other words
    vocab = Counter({"a</w>kk": 30, "xa</w>kk": 9, "ca": 12, "xca": 11, "xa": 25, "k</w>": 6, "aaaa": 4, "aaaaaaa": 3})
    want = py_learn(vocab, 40)
    assert want == SW.learn(vocab_frame(spark, vocab), 40)
    assert "a</w>" in [a + b for a, b, _ in want]


def test_hot_segments_and_index():
    assert SW.hot_segments(list("abcde"), {("a", "b"), ("d", "e")}) == [["a", "b"], ["d", "e"]]
    assert SW.hot_segments(list("abc"), set()) == []
    index = SW.PairIndex([(list("ababx"), 2), (list("aaa"), 3)], 1)
    assert index.best() == ("a", "a", 6)
    index.merge("a", "a")
    assert index.count[("aa", "a")] == 3 and index.best() == ("a", "b", 4)
    index.merge("a", "b")
    assert index.best() == ("aa", "a", 3) and index.where[("ab", "ab")] == {0}


def test_segment_relation_equals_replay(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcd</w>@é𝄞") for _ in range(rnd.randint(1, 12))) for _ in range(80)]
    vocab = Counter(rnd.choice(words) for _ in range(600))
    merges, types = SW.learn_types(vocab_frame(spark, vocab), 30)
    ranks = {(a, b): i for i, (a, b, _) in enumerate(merges)}
    lines = [" ".join(rnd.choice(words + ["new", "abab"]) for _ in range(rnd.randint(0, 9))) for _ in range(50)] + [None, "  ", lines_twice := "abab new", lines_twice]
    df = spark.createDataFrame([(i, t, t and t[::-1]) for i, t in enumerate(lines)], "id int, a string, b string")
    want = {i: tuple(None if x is None else " ".join("@@ ".join(SW.encode_word(w, ranks)) for w in x.split(" ") if w)
                     for x in (t, t and t[::-1])) for i, t in enumerate(lines)}
    for known in (None, SW.subwords(types)):
        out = SW.segment(df, {"a": "sub_a", "b": "b"}, merges, known)
        assert {r.id: (r.sub_a, r.b) for r in out.collect()} == want
        assert out.columns == ["id", "a", "sub_a", "b"]
    subs = Counter()
    for w, n in vocab.items():
        subs.update({s: n * c for s, c in Counter("@@ ".join(SW.encode_word(w, ranks)).split(" ")).items()})
    assert {r.token: r.cnt for r in SW.type_vocabulary(types).collect()} == subs


def test_segment_stays_with_its_lines(spark):
    rnd = random.Random(5)
    merges = [("a", "b", 9), ("ab", "a", 8), ("b", "a", 7), ("a", "ba", 6), ("a", "b", 5), ("c", "c</w>", 4)]  # one pair is merged twice
    lines = [" ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(0, 6))) for _ in range(60)] + [None, " a  cc ", ""]

    def one_by_one(word):
        syms = [*word[:-1], word[-1] + SW.EOW]
        for a, b, _ in merges:
            syms = SW.merge_pair(syms, a, b)
        return " ".join(syms)[: -len(SW.EOW)].replace(" ", "@@ ")

    df = spark.createDataFrame(list(enumerate(lines)), "id int, t string")
    out = SW.segment(df, {"t": "s"}, merges)
    want = {i: None if t is None else " ".join(one_by_one(w) for w in t.split(" ") if w) for i, t in enumerate(lines)}
    assert {r.id: r.s for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan  # no row a token, none leaves its task
