"""Row-level text functions against plain-Python statements of the same rules."""
import unicodedata

from pyspark.sql import functions as F

from linea.functions import text as T


def col_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


TOKENISED = {
    "Hello, world.": "Hello , world .", "It's 3.14 and 1,000 - 5-6 items!": "It's 3.14 and 1,000 - 5 - 6 items !",
    "&quot;quoted&quot; &amp; <b>": '" quoted " & < b >', "a  b\tc": "a b c", "": "", "x-\ny": "xy", "(a)[b]{c}": "( a ) [ b ] { c }",
    "tail.": "tail .", "ends with 9.": "ends with 9 .", "déjà vu: ok?": "déjà vu : ok ?", "no<skipped>thing\nhere": "nothing here",
}


def test_tokenize_13a_by_hand(spark):
    assert col_values(spark, list(TOKENISED), T.tokenize_13a) == list(TOKENISED.values())


def test_split_ws_and_split_space(spark):
    vals = [" a  b ", "", "a b", "  ", "a\tb"]
    assert col_values(spark, vals, T.split_ws) == [["a", "b"], [], ["a", "b"], [], ["a", "b"]]
    # Perl split / /: leading and inner empties kept, trailing removed
    assert col_values(spark, vals, T.split_space) == [["", "a", "", "b"], [], ["a", "b"], [], ["a\tb"]]


def test_join_subwords_and_compounds(spark):
    vals = ["new@@ york is big", "end@@", "end@@ ", "mid@@word", "a_b c"]
    assert col_values(spark, vals, T.join_subwords) == ["newyork is big", "end", "end", "mid@@word", "a_b c"]
    assert col_values(spark, ["a_b c_d"], T.join_compounds) == ["a b c d"]


def test_detruecase(spark):
    vals = ["hello world . this is ( it ) ! ok", "( quoted start", "a : b"]
    assert col_values(spark, vals, T.detruecase) == [
        "Hello world . This is ( it ) ! Ok", "( Quoted start", "A : B"]


def test_unicode_normalize(spark):
    vals = ["ﬁ ①", "Ｆｕｌｌ", "Việt Nam", None]
    out = col_values(spark, vals, lambda c: T.unicode_normalize(c, "NFKD"))
    assert out == [None if v is None else unicodedata.normalize("NFKD", v) for v in vals]


def test_strip_unicode_and_eval_preproc(spark):
    vals = ["  a b \n", "x"]
    assert col_values(spark, vals, T.strip_unicode) == ["a b", "x"]
    assert col_values(spark, vals, lambda c: T.eval_preproc(c, "bleu")) == [["a", "b"], ["x"]]


def test_ngrams(spark):
    vals = ["a b c", "a", ""]
    toks = lambda c: T.split_ws(c)
    assert col_values(spark, vals, lambda c: T.ngrams(toks(c), 2)) == [["a b", "b c"], [], []]
    assert col_values(spark, vals, lambda c: T.ngrams(toks(c), 3)) == [["a b c"], [], []]


def test_cyclic_tag_by_hand(spark):
    """The cycle has p2 lines (one at least): the first p1 take A, those up to p2 take B."""
    want = {(1, 2): "ABABABAB", (2, 4): "AABBAABB", (1, 3): "ABBABBAB", (0, 0): "--------", (1, 0): "AAAAAAAA", (3, 2): "AAAAAAAA"}
    df = spark.range(8).withColumnRenamed("id", "line_no")
    for (p1, p2), tags in want.items():
        got = [r[0] or "-" for r in df.orderBy("line_no").select(T.cyclic_tag(F.col("line_no"), p1, "A", p2, "B")).collect()]
        assert "".join(got) == tags, (p1, p2)


def test_eval_preproc_pearson(spark):
    assert col_values(spark, [" 1.5\n", "-2", "3e2"], lambda c: T.eval_preproc(c, "pearson")) == [1.5, -2.0, 300.0]



def test_join_subwords_by_plain_replacement(spark):
    import re
    cases = ["", "@@", "@@ ", "a@@ b", "a@@", "a@@ ", "@@@ @", "@@@", "a@@ @@ b@@", "x @@ y", "@ @", "@@ @@", "a@@@@ b", "é@@ ß@@"]
    df = spark.createDataFrame([(c,) for c in [*cases, None]], "t string").select("t", T.join_subwords("t").alias("j"))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.t: r.j for r in df.collect()} == {None: None} | {c: re.sub(r"(@@ )|(@@ ?\Z)", "", c) for c in cases}


def test_log_fields_by_their_tabs(spark):
    from linea.sources.text import parse_decoder_log
    lines = ["H-1\t-0.5\ta b", "H-2\t-0.5", "H-3", "H-4\t-0.5\t", "H-5\t-0.25\tx\ty", "S-6\ta", "H-7\t-1.0\t\tz", "P-1\t-0.5"]
    out = parse_decoder_log(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(1, -0.5, "a b"), (2, -0.5, ""), (3, None, ""), (4, -0.5, ""), (5, -0.25, "x"), (7, -1.0, "")]


def test_detruecase_cuts_at_sentences(spark):
    """The rule token by token gives the same, and no array of tokens with their neighbours is built."""
    import random

    def by_token(line):
        w = line.split(" ")
        out = []
        for i, x in enumerate(w):
            p1, p2 = (w[i - 1] if i else None), (w[i - 2] if i > 1 else None)
            at_start = i == 0 or p1 in T.SENTENCE_END
            after_delay = p1 in T.DELAYED_START and (i == 1 or p2 in T.SENTENCE_END)
            starts = x not in T.DELAYED_START and (at_start or after_delay)
            out.append(x[:1].upper() + x[1:] if starts else x)
        return " ".join(out)

    rnd = random.Random(7)
    kinds = [*T.SENTENCE_END, *T.DELAYED_START, "", "a", "bc", "é", "ßa", "ﬁn", "a.", ".b", "\n", "\td", "😀x", "A"]
    lines = ["", " ", ".", ". ", " .", "( ", "(", "( (", ". ( a", ". ( ( a", "( . a", ". . a", ".  a", "(a b", "! \" a"]
    lines += [" ".join(rnd.choice(kinds) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    assert col_values(spark, lines, T.detruecase) == [by_token(x) for x in lines]
    assert col_values(spark, [None, "a"], T.detruecase) == [None, "A"]
    plan = spark.createDataFrame([("a",)], "t string").select(T.detruecase("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan


def test_split_space_long_run_of_blanks(spark):
    """Blanks inside a line cost their number, not its square (the pattern `` +$`` looks at a run's rest again from each blank)."""
    import time
    df = spark.range(1).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit(" "), 300_000), F.lit("b  ")).alias("t"))
    df = df.select(F.size(T.split_space("t")).alias("n"))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
    start = time.monotonic()
    assert df.first().n == 300_001
    assert time.monotonic() - start < 20


def test_cut_equals_the_rules_on_whole_texts(spark):
    # the rules' patterns were applied to each text; now to the different pieces of a batch
    import random

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    every = pa.array([chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000])
    assert set(every.filter(pc.match_substring_regex(every, T.UWS)).to_pylist()) == set(T.UWS_CHARACTERS)
    rnd = random.Random(3)
    bits = ["a", "b", " ", "  ", ".", ",", "..", "1", "23", "-", "-\n", "\n", "&quot;", "&amp;", "amp;", "<skipped>", "<skip", "ped>", "'", "é",
            " ", "\xa0", "\t", "\x85", "\x1c", "(", "中"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    detok = F.array_remove(F.split(T.tokenize_13a(T.strip_unicode("t")), " "), "")
    for rules, tokens in (("bleu", T.eval_preproc("t", "bleu")), ("13a", detok)):
        want = [r.x or [] for r in df.select("i", tokens.alias("x")).orderBy("i").collect()]
        code, sizes, kinds = T.Cut(rules).numbered(pa.array(texts))
        assert sizes.tolist() == [len(x) for x in want]
        names = dict(zip(code.tolist(), [w for x in want for w in x], strict=True))
        assert [names[c] for c in code.tolist()] == [w for x in want for w in x]
        assert len(set(names.values())) == len(names) <= kinds
        assert np.all(code < kinds)


def test_cut_ws_equals_split_ws(spark):
    import random

    import pyarrow as pa
    rnd = random.Random(4)
    bits = ["a", "é", " ", "  ", "\t", "\n", "\r", "\f", "\x0b", "\x85", "\xa0", "\x1c", "bb"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(2000)] + [None, "", " ", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = [r.x or [] for r in df.select("i", T.split_ws("t").alias("x")).orderBy("i").collect()]
    assert T.cut_ws(pa.array(texts)).to_pylist() == want
    assert T.cut_ws(pa.array(["a b", "c"])).to_pylist() == [["a", "b"], ["c"]] and T.cut_ws(pa.array([], pa.string())).to_pylist() == []
