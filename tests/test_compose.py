"""Composition operators on hand-made lines."""
from linea.operators import compose as C


def lines(spark, prefix, n):
    return spark.createDataFrame([(i, f"{prefix}{i}") for i in range(n)], "line_no long, text string")


def test_interleave_by_hand(spark):
    a, b, prev = lines(spark, "a", 2), lines(spark, "b", 2), lines(spark, "p", 9)
    want = {0: "a0 b0 a1 b1", 1: "a0 p0 b0 p1 a1 p2 b1 p3", 2: "a0 p0 p1 b0 p2 p3 a1 p4 p5 b1 p6 p7"}
    for stride, text in want.items():
        got = C.interleave(a, b, prev, stride).orderBy("line_no").collect()
        assert [r.text for r in got] == text.split() and [r.line_no for r in got] == list(range(len(got)))


def test_interleave_rejects_short_prev(spark):
    import pytest
    with pytest.raises(ValueError):
        C.interleave(lines(spark, "a", 3), lines(spark, "b", 3), lines(spark, "p", 5), 1)


def test_concat_all(spark):
    got = [r.text for r in C.concat_all([lines(spark, "a", 2), lines(spark, "b", 1), lines(spark, "c", 2)])
           .orderBy("line_no").collect()]
    assert got == ["a0", "a1", "b0", "c0", "c1"]


def test_bidirectional_and_routing_roundtrip(spark):
    par = spark.createDataFrame([(i, f"en{i}", f"vi{i}") for i in range(4)], "line_no long, en string, vi string")
    st = C.build_bidirectional(par).orderBy("line_no").collect()
    assert [r.src for r in st] == ["en0", "vi0", "en1", "vi1", "en2", "vi2", "en3", "vi3"]
    assert [r.tgt for r in st] == ["vi0", "en0", "vi1", "en1", "vi2", "en2", "vi3", "en3"]
    # decoder output ids follow the input order: even ids translate English -> Vietnamese
    log = spark.createDataFrame([(r.line_no, r.tgt) for r in st], "id long, text string")
    routed = {(r.sent_id, r.lang): r.text for r in C.route_by_parity(log).collect()}
    assert routed[(2, "vi")] == "vi2" and routed[(2, "en")] == "en2"


def test_block_routing(spark):
    """A step-1 run: blocks of two Vietnamese, then two English outputs."""
    log = spark.createDataFrame([(i, t) for i, t in enumerate("v0 v1 e0 e1 v2 v3 e2 e3".split())], "id long, text string")
    got = {(r.sent_id, r.lang): r.text for r in C.route_by_parity(log, block=4).collect()}
    assert got == {(i, lang): f"{lang[0]}{i}" for i in range(4) for lang in ("vi", "en")}


def test_tag_directions_blocks(spark):
    df = lines(spark, "x", 8).withColumnRenamed("text", "src")
    got = [r.src.split()[0] for r in C.tag_directions(df, 1, "train").orderBy("line_no").collect()]
    assert got == ["<e2v>", "<e2v>", "<v2e>", "<v2e>"] * 2
