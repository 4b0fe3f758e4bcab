"""No line is lost without a word: null tokens, links without words, sides of unequal length."""
import pytest
from pyspark.sql import functions as F

from linea.operators import alignment as A
from linea.operators import vocab as V
from linea.sources.text import bind_strict


def test_encode_keeps_lines_without_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "x", None]), (2, []), (3, None)], "line_id int, tokens array<string>")
    d = spark.createDataFrame([("a", 1, 4)], "token string, cnt long, id long")
    got = {r.line_id: (r.ids, r.n_unk) for r in V.encode(df, d).collect()}
    assert got == {1: ([4, 3, 3, 2], 2), 2: ([2], 0), 3: ([2], 0)}
    assert {r.line_id: r.ids for r in V.encode(df, d, append_eos=False).collect()}[3] == []


def test_links_of_a_sentence_without_words_raise(spark):
    hyp = spark.createDataFrame([(1, 0, 0), (2, 0, 0)], "sent_id int, src int, tgt int")
    words = spark.createDataFrame([(1, ["a"], ["b"])], "sent_id int, src_words array<string>, tgt_words array<string>")
    assert A.with_words(hyp.where("sent_id = 1"), words).count() == 1
    for read in (lambda d: d.count(), lambda d: d.select("src").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="without words: 2"):
            read(A.with_words(hyp, words))


@pytest.mark.parametrize("swap", [False, True])
def test_unequal_sides_raise_whatever_is_read(spark, swap):
    a = spark.createDataFrame([(0, "a"), (1, "b")], "line_no int, en string")
    b = spark.createDataFrame([(0, "x")], "line_no int, vi string")
    sides = (b, a) if swap else (a, b)
    out = bind_strict(*sides, ["line_no"], "sides")
    for read in (lambda d: d.count(), lambda d: d.select("line_no").collect(), lambda d: d.agg(F.max("en")).collect(),
                 lambda d: d.collect()):
        with pytest.raises(Exception, match="only on the (first|second) side at 1"):
            read(out)
    assert bind_strict(*[s.where("line_no = 0") for s in sides], ["line_no"], "sides").count() == 1
