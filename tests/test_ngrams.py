"""Corpus n-gram counts against a plain count."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linea.operators import ngrams as NG
from linea.plans.queries import QUERIES
from tests.conftest import SF0001


@pytest.mark.parametrize("most", [1, 2, 4])
def test_order_counts_equal_plain_count(spark, most, monkeypatch):
    rnd = random.Random(4)
    lines = [[rnd.choice(["a", "b", "é", "dd"]) for _ in range(rnd.choice([0, 1, 2, 3, 9, 30]))] for _ in range(80)]
    grams = {n: Counter(tuple(x[i:i + n]) for x in lines for i in range(len(x) - n + 1)) for n in range(1, most + 1)}
    df = spark.createDataFrame([(x,) for x in [*lines, None]], "tokens array<string>").repartition(3)
    for piece in (1, 40, NG.TOKENS):
        monkeypatch.setattr(NG, "TOKENS", piece)
        got = {r.n: (r.n_grams, r.distinct_grams) for r in NG.order_counts(df, most).collect()}
        assert got == {n: (sum(c.values()), len(c)) for n, c in grams.items()}


def test_an_order_that_never_occurs_has_no_row(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],), ([],)], "tokens array<string>")
    assert sorted(map(tuple, NG.order_counts(df).collect())) == [(1, 3, 2), (2, 1, 1)]
    assert NG.order_counts(df.limit(0)).count() == 0


def test_a_repeated_window_is_sent_once_a_piece(spark):
    # a row of every n-gram was made, shuffled and spilled
    df = spark.createDataFrame([(["a"] * 50,)] * 40, "tokens array<string>").coalesce(1)
    rows = {(r.head, r["last"], r.words, r.times) for r in NG.windows(df, 4).collect()}
    assert rows == {("a", None, 1, 40), ("a a", None, 2, 40), ("a a a", None, 3, 40), ("a a a", "a", 4, 1880)}
    plan = QUERIES["ngram_counts"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Generate") == 2  # lines of documents, rows of the result


def test_gram_counts_send_only_what_continues_a_known_gram(spark, monkeypatch):
    # all windows of four tokens were joined with the phrases, and shuffled for it where the phrases were many
    rnd = random.Random(2)
    words = ["a", "b", "cé", "d\te", "中", "f" * 300]
    lines = [[rnd.choice(words) for _ in range(rnd.randint(0, 9))] for _ in range(200)] + [["only"], None]
    df = spark.createDataFrame([(x,) for x in lines], "tokens array<string>").repartition(3)
    every = {n: Counter(" ".join(x[i:i + n]) for x in lines if x for i in range(len(x) - n + 1)) for n in (1, 2, 3)}
    monkeypatch.setattr(NG, "TOKENS", 50)  # many pieces
    got = {(r.gram, r.n): r.cnt for r in NG.gram_counts(df, (1, 2), least=30).collect()}
    assert got == {(g, 1): c for g, c in every[1].items()} | {(g, 2): c for g, c in every[2].items() if c >= 30}
    some = [(g,) for g in every[2] if "中" not in g]
    held = NG.known(spark.createDataFrame(some, "phrase string"))
    got = {r.gram: r.cnt for r in NG.gram_counts(df, (3,), before=held).collect()}
    assert got == {g: c for g, c in every[3].items() if "中" not in g}  # so few members share no bits
    sent = NG._told(pa.array(lines[:100], pa.list_(pa.string())), (3,), held, 4).to_pylist()
    assert sum(len(NG._untold(r["size"], r["data"])[1]) for r in sent) == len({
        " ".join(x[i:i + 3]) for x in lines[:100] for i in range(len(x) - 2) if "中" not in x[i:i + 3]})
    assert {r["part"] for r in sent} <= set(range(4)) and held.size % 8 == 0 and np.unpackbits(held.bits.value).sum() <= len(some)
