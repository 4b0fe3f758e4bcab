import random

import pytest
from pyspark.sql import functions as F

from linea.llm import toxicity

CALM = "the of and river stone light paper green walk house table seven".split()


def docs_of(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = [rng.choice(CALM) + rng.choice(["", "", "er", "ing"]) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Grumbold", "flarnish"]))
        elif i % 5 == 1:
            at = rng.randrange(len(words))
            words[at:at] = ["saint", "grumbold"]
        if i == 7 or i == 10:
            words += ["uniqueword"]
        rows.append((i, " ".join(words), int(toxic), "x"))
    rows += [(n, None, 1, "x"), (n + 1, "", 0, "x"), (n + 2, "unlabelled", None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")


@pytest.fixture(scope="module")
def lexicon(spark):
    return toxicity.learn(docs_of(spark), least_ratio=2.0)


def test_folding():
    assert toxicity.fold("GRUMB0LD, grumЬоld! gr​umbold 2024 $tupid idiot!!") == " grumboid grumьoid grumboid stupid idiot "
    assert toxicity.fold(None) == "  " and toxicity.fold(" 12 ") == "  "


def test_lexicon_and_exceptions(lexicon):
    assert {" grumboid ", " fiarnish "} <= set(lexicon.entries)
    assert " uniqueword " not in lexicon.entries
    assert " saint grumboid " in lexicon.exceptions


def test_scores(lexicon):
    calm = " ".join(CALM)
    assert lexicon.score(None) == lexicon.score("") == lexicon.score(calm) == 0.0
    assert lexicon.score(f"{calm} saint grumbold {calm}") == 0.0
    for word in ["grumbold", "GRUMB0LD", "grumвold".replace("в", "b"), "flаrnish", "flarn1sh"]:
        assert lexicon.score(f"{calm} {word} is {word}") >= 0.5, word
    long = (calm + " ") * 3000
    assert lexicon.score(long + "grumbold") < 0.5  # normalised by length
    assert lexicon.score((calm + " flarnish grumbold ") * 3000) >= 0.5


def test_query_shape_in_spark(spark, lexicon):
    docs = docs_of(spark)
    got = docs.withColumn("score", toxicity.scores(lexicon, docs["text"])).collect()
    right = sum((r.score >= 0.5) == bool(r.toxic) for r in got if r.toxic is not None and r.text)
    assert right / sum(1 for r in got if r.toxic is not None and r.text) > 0.97


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, 30)
    assert toxicity.learn(docs.where("toxic = 0")).score("grumbold") == 0.0
    assert toxicity.learn(docs.limit(0)).entries == {}


def test_matches_equal_a_plain_scan():
    rnd = random.Random(4)
    for _ in range(300):
        make = lambda most: "".join(rnd.choice("ab ") for _ in range(rnd.randint(1, most)))
        entries = {" " + make(4).strip(): rnd.choice([0.5, 1.0, 2.0]) for _ in range(4)} | {" " + make(3).strip() + " ": 3.0}
        entries = {e: w for e, w in entries.items() if e.strip()}
        exceptions = [f" {make(5).strip()} "] if rnd.random() < 0.5 else []
        exceptions = [e for e in exceptions if e.strip() and e not in entries]
        text = toxicity.fold(make(30))
        want = {}
        for e, w in entries.items():
            for at in range(len(text)):
                if text.startswith(e, at):
                    want[at] = max(want.get(at, 0.0), w)
        for e in exceptions:
            for at in range(len(text)):
                if text.startswith(e, at):
                    want = {a: w for a, w in want.items() if not at <= a < at + len(e) - 1}
        assert toxicity.Lexicon(entries, exceptions).matches(text) == want, (entries, exceptions, text)


def test_scoring_empty_repeated_and_clashing(spark):
    lexicon = toxicity.Lexicon({" bad": 2.0}, [toxicity.fold("bad luck")])
    rows = [(1, "a bad thing", 0.5), (1, "a bad thing", 0.5), (2, "bad luck", 0.1), (3, None, None), (4, "", 0.0), (5, "b4d " * 9, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = df.select("doc_id", toxicity.scores(lexicon, F.col("text")).alias("s")).collect()
    assert [(r.doc_id, r.s > 0) for r in got] == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, True)]
    assert df.limit(0).select(toxicity.scores(lexicon, F.col("text"))).count() == 0
