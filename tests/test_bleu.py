"""BLEU statistics against a brute-force per-line implementation."""
import math
from collections import Counter

from pyspark.sql import functions as F

from linea.functions import text as T
from linea.operators import bleu as B


def py_stats(hyp, refs, ties="first"):
    h = hyp.split()
    hc = Counter(tuple(h[i:i + n]) for n in range(1, 5) for i in range(len(h) - n + 1))
    mx = Counter()
    lens = []
    for r in refs:
        rt = [] if r.rstrip(" ") == "" else r.rstrip(" ").split(" ")
        lens.append(len(rt))
        rc = Counter(tuple(rt[i:i + n]) for n in range(1, 5) for i in range(len(rt) - n + 1))
        for g, c in rc.items():
            mx[g] = max(mx[g], c)
    correct, total = [0] * 4, [0] * 4
    for g, c in hc.items():
        total[len(g) - 1] += c
        correct[len(g) - 1] += min(c, mx[g])
    best = None
    for length in lens:
        d = abs(len(h) - length)
        if best is None or d < best[0] or (ties == "shorter" and d == best[0] and length < best[1]):
            best = (d, length)
    return correct + total + [len(h), best[1] if best else 0]


def py_bleu(st):
    c, t, hl, rl = st[:4], st[4:8], st[8], st[9]
    bp = 1.0 if hl >= rl else math.exp(1 - rl / hl)
    logs = sum(math.log(c[k] / t[k]) if c[k] else -9999999999 for k in range(4))
    return 100 * bp * math.exp(logs / 4)


LINES = [("the cat sat on the mat", ["the cat sat on a mat", "a cat sat on the mat"]),
         ("the the the the", ["the cat", "the the cat the"]),
         ("", ["something here"]),
         ("one two three four five", ["one two three four five six", "one two three four"]),
         ("a b c d e f g", [" a b  c d e f g "]),
         ("x y z", ["x y", "x y z w"])]


def frame(spark):
    rows = [(i, h, refs) for i, (h, refs) in enumerate(LINES)]
    df = spark.createDataFrame(rows, "line_id long, hyp string, refs array<string>")
    return df.select("line_id", T.split_ws("hyp").alias("hyp"),
                     F.transform("refs", lambda r: T.split_space(r)).alias("refs"))


def test_sentence_stats_brute_force(spark):
    for ties in ("first", "shorter"):
        got = {r["line_id"]: [r[c] for c in B.STAT_COLS]
               for r in B.sentence_stats(frame(spark), ties=ties).collect()}
        for i, (h, refs) in enumerate(LINES):
            assert got[i] == py_stats(h, refs, ties), (i, ties)


def test_corpus_bleu_and_identity(spark):
    sums = [sum(x) for x in zip(*[py_stats(h, r) for h, r in LINES])]
    got = B.bleu_plain(B.corpus_totals(frame(spark))).first()
    assert abs(got["bleu"] - round(py_bleu(sums), 6)) < 1e-6
    assert got["hyp_len"] == sums[8] and got["ref_len"] == sums[9]
    same = spark.createDataFrame([(1, "a b c d e"), (2, "f g h i")], "line_id long, t string")
    same = same.select("line_id", T.split_ws("t").alias("hyp"), F.array(T.split_space("t")).alias("refs"))
    assert B.bleu_plain(B.corpus_totals(same, multi_ref=False)).first()["bleu"] == 100.0


def test_partition_invariance(spark):
    df = frame(spark)
    a = B.sentence_stats(df.repartition(1)).orderBy("line_id").collect()
    b = B.sentence_stats(df.repartition(5)).orderBy("line_id").collect()
    assert a == b


def test_detok_finalisation_edge_cases(spark):
    zero = spark.createDataFrame([tuple([0] * 10)], ", ".join(f"{c} long" for c in B.STAT_COLS))
    r = B.bleu_detok(zero).first()
    assert r["bleu"] == 0.0 and r["bp"] == 0.0
    plain = B.bleu_plain(zero).first()
    assert plain["bleu"] is None and plain["p1"] is None


def test_known_reference_count_path_equals_two_level(spark):
    df = frame(spark)
    for ties in ("first", "shorter"):
        a = B.sentence_stats(df, ties=ties).orderBy("line_id").collect()
        b = B.sentence_stats(df, ties=ties, n_refs=2).orderBy("line_id").collect()
        assert a == b


def test_paired_stats_equal_separate(spark):
    rows = [(i, h, h.replace("the", "a"), refs) for i, (h, refs) in enumerate(LINES)]
    df = spark.createDataFrame(rows, "line_id long, a string, b string, refs array<string>")
    df = df.select("line_id", T.split_ws("a").alias("hyp_a"), T.split_ws("b").alias("hyp_b"),
                   F.transform("refs", lambda r: T.split_space(r)).alias("refs"))
    for n_refs in (None, 2):
        got = {r.line_id: r for r in B.paired_sentence_stats(df, n_refs=n_refs).collect()}
        for side, col in (("a", "hyp_a"), ("b", "hyp_b")):
            sep = {r.line_id: r for r in B.sentence_stats(df.select("line_id", F.col(col).alias("hyp"), "refs"))
                   .collect()}
            for i in sep:
                assert [got[i][f"{side}_{c}"] for c in B.STAT_COLS] == [sep[i][c] for c in B.STAT_COLS]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ngrams_of_a_line_stay_in_its_task(spark):
    # one row a line from the cut to the sums: n-grams as rows were shuffled, sorted and spilled
    df = frame(spark).repartition(3)
    for out in (B.corpus_totals(df), B.sentence_stats(df, n_refs=2), B.paired_sentence_stats(df.withColumn("hyp_a", F.col("hyp"))
                .withColumn("hyp_b", F.col("hyp")), n_refs=None)):
        assert "Generate" not in _plan(out) and _plan(out).count("hashpartitioning") == 0


def test_batches_in_parts_count_as_brute_force():
    import random

    import numpy as np
    import pyarrow as pa
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["a", "b", "c", "", "é"]) for _ in range(rng.randrange(12)))
    lines = [[text() for _ in range(2 + rng.randrange(3))] for _ in range(60)]  # two systems, 0 to 2 references

    def grams(s, n):
        runs, out = [[]], Counter()
        for w in s.split(" "):
            if w == "":
                runs.append([])
            else:
                runs[-1].append(w)
        for r in runs:
            out.update(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
        return out

    want = np.array([[[sum(min(c, max([grams(r, n)[g] for r in line[2:]], default=0)) for g, c in grams(line[s], n).items())
                       for n in range(1, 5)] + [sum(grams(line[s], n).values()) for n in range(1, 5)] for s in range(2)] for line in lines])
    held, B.PART = B.PART, 50
    try:
        for part in (1, 50, held):
            B.PART = part
            assert (B.ngram_counts(pa.array(lines, pa.list_(pa.string())), 2) == want).all()
            assert (B.ngram_counts(pa.array([["x"], *lines], pa.list_(pa.string()))[1:], 2) == want).all()
    finally:
        B.PART = held
    assert B.ngram_counts(pa.array([], pa.list_(pa.string())), 1).shape == (0, 1, 8)
    assert (B.ngram_counts(pa.array([["", ""], [""], [None, "a"]], pa.list_(pa.string())), 1) == 0).all()


def test_no_lines_sum_to_zero(spark):
    got = B.corpus_totals(frame(spark).where("false")).first()
    assert list(got) == [0] * 10


def test_statistics_of_texts_cut_where_they_are_counted(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from linea.functions import text as T
    monkeypatch.setattr(B, "TOKENS", 20)  # many parts
    rnd = random.Random(5)
    side = lambda: " ".join(rnd.choice(["a", "b", "c.", "d,e", "f-1", "", "\t"]) for _ in range(rnd.randint(0, 12)))
    rows = [(i, side(), side(), [side() for _ in range(rnd.randint(1, 3))]) for i in range(300)] + [(300, None, "a", ["a b"])]
    df = spark.createDataFrame(rows, "line_id int, hyp_a string, hyp_b string, refs array<string>")
    for ties in ("first", "shorter"):
        cut = lambda c: T.eval_preproc(c, "bleu")
        arrays = df.select("line_id", cut("hyp_a").alias("hyp_a"), cut("hyp_b").alias("hyp_b"), F.transform("refs", cut).alias("refs"))
        want = B.paired_sentence_stats(arrays, ties=ties, n_refs=3)
        got = B.paired_sentence_stats(df, ties=ties, n_refs=3, cut=T.Cut("bleu"))
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
