"""Alignment analytics: golden values and hand-made cases."""
from pyspark.sql import functions as F

from linea.operators import alignment as AL


def sets_to_links(spark, sets):
    rows = [(0, s, t) for t, srcs in enumerate(sets) for s in srcs]
    return spark.createDataFrame(rows, "sent_id long, src int, tgt int")


def test_doctest_goldens(spark):
    def jumps(sets):
        r = AL.jumps(sets_to_links(spark, sets)).first()
        return r["internal_jumps"] or 0, r["external_jumps"] or 0
    assert jumps([{1, 2, 4}, {42}])[0] == 1
    assert jumps([{1, 2, 3, 4}])[0] == 0
    assert jumps([set(), {1, 2, 4}, {2}, {4}, set()])[1] == 1


def test_jumps_by_hand(spark):
    """(sentence as source sets per target position, internal jumps, external jumps)."""
    cases = [([{0}, {1}, {2}], 0, 0), ([{0, 2}, {1}], 1, 0), ([{0, 1}, {4}], 0, 1), ([{3}, {1}, {2}], 0, 1),
             ([{0}, set(), {5}], 0, 0), ([{2, 5}, {0, 6}, {3}], 2, 2), ([{2, 3}, {3, 7}], 1, 0), ([set(), set()], 0, 0)]
    rows = [(i, s, t) for i, (al, _, _) in enumerate(cases) for t, srcs in enumerate(al) for s in srcs]
    df = spark.createDataFrame(rows, "sent_id long, src int, tgt int")
    r = AL.jumps(df).first()
    assert r["internal_jumps"] == sum(c[1] for c in cases)
    assert r["external_jumps"] == sum(c[2] for c in cases)
    for i, (_, internal, external) in enumerate(cases[:-1]):
        one = AL.jumps(df.where(F.col("sent_id") == i)).first()
        assert (one["internal_jumps"], one["external_jumps"]) == (internal, external), i


def test_flags_from_both_lines(spark):
    df = spark.createDataFrame([(0, "0-0 1p1 2-2", "0-0 1-1 2-1 0-0"), (1, "0-1 1p0", "1-0"), (2, "", "0-0"), (3, None, "")],
                               "sent_id long, ref_line string, hyp_line string")
    got = sorted(tuple(r) for r in AL.alignment_flags(df).collect())
    assert got == [(0, 0, 0, 1, 1, 1), (0, 1, 1, 1, 0, 1), (0, 2, 1, 1, 0, 0), (0, 2, 2, 0, 1, 1),
                   (1, 0, 1, 0, 1, 1), (1, 1, 0, 1, 0, 1), (2, 0, 0, 1, 0, 0)]
    sure = {(r.sent_id, r.src, r.tgt): (r.s, r.p) for r in AL.alignment_flags(df, all_sure=True, ignore_possible=True).collect()}
    assert sure[(0, 1, 1)] == (1, 0) and sure[(0, 0, 0)] == (1, 1)


def test_clean_flags_keep_the_raw_count(spark):
    sent = spark.createDataFrame([(0, ["a", ",", "."], ["x", ",", "y"])], "sent_id long, src_words array<string>, tgt_words array<string>")
    flags = spark.createDataFrame([(0, 0, 0, 1, 1, 1), (0, 1, 2, 1, 0, 0), (0, 2, 0, 0, 1, 1)],
                                  "sent_id long, src int, tgt int, a int, s int, p int")
    m = AL.aer_metrics(AL.clean_flags(flags, sent)).first()
    assert m["n_links"] == 2 and m["precision"] == 1.0 and m["recall"] == 0.5


def test_parse_and_aer(spark):
    ref = spark.createDataFrame([(0, "0-0 1p1 2-2"), (1, "0-1 1p0")], "sent_id long, line string")
    hyp = spark.createDataFrame([(0, "0-0 1-1 2-1 0-0"), (1, "1-0")], "sent_id long, line string")
    r = AL.reference_sets(AL.parse_links(ref, "line"))
    h = AL.hypothesis_set(AL.parse_links(hyp, "line"))
    m = AL.aer_metrics(AL.link_flags(h, r), alpha=0.5).first()
    # A = {(0,0,0),(0,1,1),(0,2,1),(1,1,0)}, S = {(0,0,0),(0,2,2),(1,0,1)}, P = S + {(0,1,1),(1,1,0)}
    assert m["n_links"] == 4
    assert abs(m["precision"] - 3 / 4) < 1e-6 and abs(m["recall"] - 1 / 3) < 1e-6
    assert abs(m["aer"] - (1 - (3 + 1) / (4 + 3))) < 1e-6
    assert abs(m["f_measure"] - round(1 / (0.5 / 0.75 + 0.5 / (1 / 3)), 6)) < 1e-6


def test_one_indexed_and_reverse(spark):
    df = spark.createDataFrame([(0, "1-2 3p4")], "sent_id long, line string")
    got = sorted(tuple(r) for r in AL.parse_links(df, "line", one_indexed=True, reverse=True)
                 .select("src", "tgt", "kind").collect())
    assert got == [(1, 0, "-"), (3, 2, "p")]


def test_all_sure_ignore_possible(spark):
    df = spark.createDataFrame([(0, "0-0 1p1")], "sent_id long, line string")
    r = {(x.src, x.tgt): (x.s, x.p) for x in AL.reference_sets(AL.parse_links(df, "line"), True, True).collect()}
    assert r == {(0, 0): (1, 1), (1, 1): (1, 0)}


def test_clean_punctuation(spark):
    sent = spark.createDataFrame([(0, ["a", ",", "."], ["x", ",", "y"])],
                                 "sent_id long, src_words array<string>, tgt_words array<string>")
    h = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 1, 2), (0, 2, 0)], "sent_id long, src int, tgt int")
    kept = sorted((r.src, r.tgt) for r in AL.clean_punctuation(h, sent).collect())
    assert kept == [(0, 0), (1, 1)]


def test_tasks_hold_a_bounded_number_of_links(spark, monkeypatch):
    from linea.sources import fixtures as FX
    from tests.conftest import SF0001
    rows = FX.table(spark, SF0001, "lineitem").count()
    before = sorted(map(tuple, FX.links(spark, SF0001).collect()))
    monkeypatch.setattr(FX, "LINKS", 500)
    for frame in (FX.links(spark, SF0001), FX.align_sentences(spark, SF0001)):
        assert frame.rdd.getNumPartitions() >= rows // 500 > 4
    assert sorted(map(tuple, FX.links(spark, SF0001).collect())) == before


def test_coverage_counts_positions_where_the_links_lie(spark):
    # two distinct counts over all links expand and shuffle every link twice
    hyp = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 2, 1), (2, 0, 0)], "sent_id long, src int, tgt int").repartition(2, "sent_id")
    sent = spark.createDataFrame([(1, ["a", "b", "c"], ["x", "y"]), (2, ["a"], ["x", "y"]), (3, ["a"], [])],
                                 "sent_id long, src_words array<string>, tgt_words array<string>")
    out = AL.coverage(hyp, sent)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("hashpartitioning") == 1
    assert tuple(out.first()) == (0.6, 0.75)
    assert tuple(AL.coverage(hyp.where("false"), sent).first()) == (0.0, 0.0)
