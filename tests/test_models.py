"""Truecasing, dictionary/encoding and compound segmentation on micro data."""
from pyspark.sql import functions as F

from linea.operators import collocations as CO
from linea.operators import truecase as TC
from linea.operators import vocab as V


def toks(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, t string")
    return df.select("line_id", F.split("t", " ").alias("tokens"))


def test_truecase_train_and_apply(spark):
    t = toks(spark, ["The house is big .", "In the house .", "the house of Paris .", "So Paris is big ."])
    model = {r.lc: r.best for r in TC.train(t).collect()}
    assert model["the"] == "the" and model["paris"] == "Paris" and model["house"] == "house"
    out = {r.line_id: " ".join(r.tokens) for r in TC.apply(t, TC.train(t), TC.known_forms(t)).collect()}
    assert out[0].startswith("the house")      # sentence start re-cased to the best form
    assert out[1].startswith("In the")         # unknown-as-initial word with no model entry stays


def test_dictionary_and_encode(spark):
    t = toks(spark, ["a b a c", "a b"])
    d = {r.token: r.id for r in V.build_dictionary(t, pad_to_multiple=8).collect()}
    assert d["<s>"] == 0 and d["<unk>"] == 3 and d["a"] == 4 and d["b"] == 5 and d["c"] == 6
    assert len(d) == 8 and "madeupword0000" in d
    enc = V.encode(toks(spark, ["a z c", ""]), V.build_dictionary(t)).orderBy("line_id").collect()
    assert enc[0].ids == [4, 3, 6, 2] and enc[0].n_unk == 1
    rate = V.oov_rate(V.encode(toks(spark, ["a z c"]), V.build_dictionary(t))).first()
    assert rate.n_tokens == 3 and rate.n_unk == 1


def test_segment_greedy_left_to_right(spark):
    t = toks(spark, ["new york new york city", "a b c"])
    lex = spark.createDataFrame([("new", "york"), ("york", "new"), ("york", "city")], "w1 string, w2 string")
    out = {r.line_id: r.text for r in CO.segment(t, lex).collect()}
    assert out[0] == "new_york new_york city"
    assert out[1] == "a b c"


def test_lines_without_tokens_stay(spark):
    t = spark.createDataFrame([(0, ["the", "house"]), (1, []), (2, ["The", "end"])], "line_id long, tokens array<string>")
    cased = {r.line_id: r.tokens for r in TC.apply(t, TC.train(t), TC.known_forms(t)).collect()}
    assert cased[1] == [] and set(cased) == {0, 1, 2}
    lex = spark.createDataFrame([("the", "house")], "w1 string, w2 string")
    assert {r.line_id: r.text for r in CO.segment(t, lex).collect()} == {0: "the_house", 1: "", 2: "The end"}


def test_truecasing_meets_words_by_parts(spark, monkeypatch):
    import random
    monkeypatch.setattr(TC, "TOKENS", 40)
    rnd = random.Random(4)
    words = ["the", "The", "THE", "paris", "Paris", "ünder", "Ünder", ".", "?", '"', "New", "x", "", None]
    lines = [(i, [rnd.choice(words) for _ in range(rnd.randint(0, 12))]) for i in range(300)] + [(300, None), (301, [])]
    df = spark.createDataFrame(lines, "line_id long, tokens array<string>")
    train = df.where("line_id % 3 = 0")
    model, known = TC.train(train), TC.known_forms(train)
    best, seen = {r.lc: r.best for r in model.collect()}, {r.w for r in known.collect()}
    flags = {r.line_id: r.f for r in df.select("line_id", TC.sentence_start_flags(F.col("tokens")).alias("f")).collect()}

    def case(w, start):
        b = best.get(w.lower()) if w is not None else None
        return w if b is None or (not start and w in seen) else b

    out = TC.apply(df, model, known)
    assert {r.line_id: r.tokens for r in out.collect()} == {
        i: [case(w, f) for w, f in zip(t or [], flags[i] or [], strict=True)] for i, t in lines}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row a token
