"""Compounds of any length: mining and the lattice against plain searches."""
import itertools
import math
import random
from collections import Counter

import pytest

from linea.operators import collocations as CO


def plain_lexicon(lines, min_count, min_pmi, most):
    uni = Counter(w for line in lines for w in line)
    total = sum(uni.values())
    out, last = {}, None
    for n in range(2, most + 1):
        grams = Counter(tuple(line[i:i + n]) for line in lines for i in range(len(line) - n + 1))
        level = {}
        for g, c in grams.items():
            pmi = (math.log(c) + (n - 1) * math.log(total) - sum(math.log(uni[w]) for w in g)) / (n - 1)
            if c >= min_count and pmi >= min_pmi and (last is None or (g[:-1] in last and g[1:] in last)):
                level[g] = (c, round(pmi, 6))
        out |= level
        last = level
    return {" ".join(g): v for g, v in out.items()}


def corpus(seed):
    rnd = random.Random(seed)
    fixed = [["thành", "phố", "hồ", "chí", "minh"], ["việt", "nam"], ["xã", "hội", "chủ"], ["hồ", "chí"]]
    out = []
    for _ in range(60):
        line = []
        for _ in range(rnd.randint(0, 6)):
            line += rnd.choice(fixed) if rnd.random() < 0.4 else [rnd.choice("abcdefgh")]
        out.append(line)
    return out


def test_mined_phrases_equal_plain_count(spark):
    lines = corpus(1)
    df = spark.createDataFrame([(x,) for x in lines], "tokens array<string>")
    for most in (2, 3, 5):
        got = {r.phrase: (r.cnt, r.pmi) for r in CO.mine_phrases(df, min_count=3, min_pmi=0.5, max_words=most).collect()}
        want = plain_lexicon(lines, 3, 0.5, most)
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in got)
    assert "thành phố hồ chí minh" in got


def paths(n, edges):
    """All segmentations of n tokens: lists of (start, words)."""
    if n == 0:
        return [[]]
    out = []
    for words in [1] + [w for s, w in edges if s + w == n]:
        out += [p + [(n - words, words)] for p in paths(n - words, edges)]
    return out


@pytest.mark.parametrize("mode", ["longest", "best"])
def test_lattice_equals_all_paths(spark, mode):
    rnd = random.Random(6)
    vocabulary = ["a", "b", "c", "é"]
    phrases = {" ".join(g): float(rnd.randint(1, 9)) for n in (2, 3, 4) for g in itertools.product(vocabulary, repeat=n) if rnd.random() < 0.15}
    phrases["a b c é a"] = 40.0  # its prefixes need not be phrases
    lines = [[rnd.choice(vocabulary) for _ in range(rnd.randint(0, 9))] for _ in range(60)] + [["x"], ["a", "b", "c", "é", "a"], []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(999, None)], "line_id int, tokens array<string>")
    lexicon = spark.createDataFrame(list(phrases.items()), "phrase string, score double")
    got = {r.line_id: r.text for r in CO.segment_phrases(df, lexicon, mode=mode).collect()}
    assert got.pop(999) == ""
    for i, line in enumerate(lines):
        edges = [(s, n) for n in range(2, 6) for s in range(len(line) - n + 1) if " ".join(line[s:s + n]) in phrases]
        if mode == "longest":
            want, at = [], 0
            while at < len(line):
                n = max([w for s, w in edges if s == at], default=1)
                want.append("_".join(line[at:at + n]))
                at += n
            assert got[i] == " ".join(want), line
        else:
            value = lambda p: sum(phrases.get(" ".join(line[s:s + n]), 0.0) for s, n in p)
            cut = got[i].split(" ") if line else []
            assert [w for piece in cut for w in piece.split("_")] == line
            assert all("_" not in piece or piece.replace("_", " ") in phrases for piece in cut)
            score = sum(phrases[piece.replace("_", " ")] for piece in cut if "_" in piece)
            assert score == max(map(value, paths(len(line), edges))), line


def test_empty_lexicon_and_corpus(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "line_id int, tokens array<string>")
    none = spark.createDataFrame([], "phrase string, score double")
    assert {r.line_id: r.text for r in CO.segment_phrases(df, none).collect()} == {1: "a b", 2: ""}
    assert CO.mine_phrases(df.limit(0)).count() == 0


def test_phrases_meet_a_parts_pairs_not_its_tokens(spark, monkeypatch):
    # each token was a row that was written, joined and shuffled
    lexicon = spark.createDataFrame([("a b", 1.0), ("b c d", 5.0), ("b z", 9.0)], "phrase string, score double")
    df = spark.createDataFrame([(i, ["a", "b", "c", "d"] * 20) for i in range(30)] + [(99, [])], "line_id int, tokens array<string>")
    monkeypatch.setattr(CO, "TOKENS", 100)  # many parts
    parts = df.selectExpr("cast(line_id % 3 as bigint) as part", "tokens").coalesce(1).sortWithinPartitions("part")
    pairs = [tuple(r) for r in CO._pairs(parts).collect()]
    assert sorted(pairs) == sorted((p, x) for p in range(3) for x in ("a b", "b c", "c d", "d a"))
    out = CO.segment_phrases(df, lexicon)
    got = {r.line_id: r.text for r in out.collect()}
    assert got == {i: " ".join(["a_b c d"] * 20) for i in range(30)} | {99: ""}
    best = {r.line_id: r.text for r in CO.segment_phrases(df, lexicon, mode="best").collect()}
    assert best == {i: " ".join(["a b_c_d"] * 20) for i in range(30)} | {99: ""}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "posexplode" not in plan


def plain_pairs(line, pairs):
    out, at = [], 0
    while at < len(line):
        n = 2 if tuple(line[at:at + 2]) in pairs else 1
        out.append("_".join(line[at:at + n]))
        at += n
    return " ".join(out)


@pytest.mark.parametrize("held", [True, False])
def test_matching_needs_no_row_of_a_token(spark, monkeypatch, held):
    # a row of each token went through windows by line; and lines were shuffled for any lexicon
    if not held:
        monkeypatch.setattr(CO, "HELD", 0)
    rnd = random.Random(9)
    lines = [[rnd.choice(["a", "b", "c", "é", "zz"]) for _ in range(rnd.randint(0, 12))] for _ in range(80)] + [["a"] * 7, []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(999, None)], "line_id int, tokens array<string>")
    pairs = {("a", "a"), ("b", "c"), ("c", "b"), ("é", "zz"), ("zz", "y")}
    out = CO.segment(df, spark.createDataFrame(list(pairs), "w1 string, w2 string"))
    assert {r.line_id: r.text for r in out.collect()} == {i: plain_pairs(x, pairs) for i, x in enumerate(lines)} | {999: ""}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and ("Exchange" in plan) != held
    lexicon = spark.createDataFrame([("a a", 1.0), ("a a a b", 5.0), ("b c é", 2.0), ("x y", None)], "phrase string, score double")
    for mode in ("longest", "best"):
        held_text = {r.line_id: r.text for r in CO.segment_phrases(df, lexicon, mode=mode).collect()}
        monkeypatch.setattr(CO, "HELD", 0 if held else 10)
        assert held_text == {r.line_id: r.text for r in CO.segment_phrases(df, lexicon, mode=mode).collect()}
        monkeypatch.setattr(CO, "HELD", 10 if held else 0)


@pytest.mark.parametrize("held", [True, False])
def test_texts_give_what_arrays_give(spark, monkeypatch, held):
    # tokens were cut in the JVM and sent to a worker as an array of strings, once for each order
    if not held:
        monkeypatch.setattr(CO, "HELD", 0)
    rnd = random.Random(7)
    lines = corpus(3) + [[]]
    texts = [(i, rnd.choice(["", " ", "\t"]) + rnd.choice([" ", "  ", "\n"]).join(x)) for i, x in enumerate(lines)] + [(999, None)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(999, None)], "line_id int, tokens array<string>")
    text = spark.createDataFrame(texts, "line_id int, tokens string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    phrases = CO.mine_phrases(df, min_count=3, min_pmi=0.5, max_words=3)
    assert rows(phrases) == rows(CO.mine_phrases(text, min_count=3, min_pmi=0.5, max_words=3)) != []
    lexicon = phrases.selectExpr("phrase", "pmi * (words - 1) as score")
    assert rows(CO.segment_phrases(df, lexicon)) == rows(CO.segment_phrases(text, lexicon))


def test_only_pairs_that_begin_a_phrase_travel(spark):
    # every different pair of a part was sent to meet the phrases
    begins = CO.known(spark.createDataFrame([("a b",), ("d a",)], "pair string"), "pair")
    parts = spark.createDataFrame([(i % 2, " ".join(["a", "b", "c", "d"] * 5)) for i in range(6)], "part long, tokens string")
    pairs = [tuple(r) for r in CO._pairs(parts.coalesce(1).sortWithinPartitions("part"), begins).collect()]
    assert sorted(pairs) == [(0, "a b"), (0, "d a"), (1, "a b"), (1, "d a")]
