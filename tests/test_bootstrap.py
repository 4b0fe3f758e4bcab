"""Bootstrap: deterministic draws, identical systems tie, dense numbering."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from linea.operators import bleu as B
from linea.operators import bootstrap as BS
from linea.operators.positional import dense_index, ordered_index


def test_dense_index_equals_row_number(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * 13 % 10007).alias("k")).distinct()
    got = dense_index(df, "k", "n", buckets=6).select("k", "n")
    exp = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("n"))
    assert got.exceptAll(exp).count() == 0 and got.count() == df.count()


def test_ordered_index_multi_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "t string, c long")
    got = [r.t for r in ordered_index(df, [F.col("c").desc(), F.col("t")], "r", 3).orderBy("r").collect()]
    assert got == ["c", "a", "b", "d"]


def test_draws_deterministic_and_in_range(spark):
    a = BS.draws(spark, 17, 5, 9, seed=3).collect()
    b = BS.draws(spark, 17, 5, 9, seed=3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(0 <= r.idx < 17 for r in a) and len(a) == 45


def test_identical_systems_all_ties(spark):
    cols = B.STAT_COLS
    rows = [(i, i, 3 + i % 2, 2, 1, 0, 5, 4, 3, 2, 5, 6) for i in range(30)]
    st = spark.createDataFrame(rows, "line_id long, n long, " + ", ".join(f"{c} long" for c in cols))
    out = BS.compare_bleu(st, st, lambda p: B.bleu_score_expr(p, "none"), samples=50, stat_cols=cols).first()
    assert out.num_equal == 50 and out.new_better == 0 and out.baseline_better == 0
    assert out.delta == 0.0


def test_layout():
    for n in (1, 7, 4096, 4097, 8192, 8193, 100_000):
        k, size = BS.layout(n)
        assert size <= BS.SPAN and size << k >= n and (k == 0 or n > BS.SPAN << (k - 1)), n
    assert BS.layout(10, 3) == (2, 3)


def test_split_is_a_fair_multinomial():
    import numpy as np
    counts = BS.split(7, np.arange(3000), 1001, 3)
    assert counts.shape == (3000, 8) and (counts.sum(1) == 1001).all() and (counts >= 0).all()
    p = 1 / 8
    assert abs(counts.mean(0) - 1001 * p).max() < 4 * (1001 * p * (1 - p) / 3000) ** 0.5
    assert abs(counts.var(0) / (1001 * p * (1 - p)) - 1).max() < 0.15
    # pieces of a large node are the same bits
    old, BS.WORDS = BS.WORDS, 3
    try:
        assert (BS.split(7, np.arange(20), 1001, 3) == counts[:20]).all()
    finally:
        BS.WORDS = old


def test_draws_are_uniform_over_lines(spark):
    import numpy as np
    rows = BS.draws(spark, 13, 400, 50, seed=5, span=3).collect()  # 8 ranges of 2 places, 3 of 16 empty
    hits = np.bincount([r.idx for r in rows], minlength=13)
    assert len(rows) == 400 * 50 and len(hits) == 13
    expect = 400 * 50 / 13
    assert ((hits - expect) ** 2 / expect).sum() < 35  # chi-squared, 12 degrees of freedom


def test_sums_equal_the_draws(spark):
    import numpy as np
    rnd = np.random.default_rng(1)
    rows = [(i, int(rnd.integers(0, 1000)), float(rnd.normal())) for i in range(101)]
    st = spark.createDataFrame(rows, "n long, x long, y double").repartition(3)
    for span in (4096, 8):
        drawn = BS.draws(spark, 101, 6, 77, seed=9, span=span)
        want = {r.b: (r.x, r.y) for r in drawn.join(st, F.col("idx") == F.col("n")).groupBy("b").agg(
            F.sum("x").alias("x"), F.sum("y").alias("y")).collect()}
        got = {r.b: (r.x, r.y) for r in BS.resample_sums(st, ["x", "y"], 6, 77, 9, include_full=True, span=span).collect()}
        assert got.pop(-1)[0] == sum(x for _, x, _ in rows)
        assert set(got) == set(want)
        assert all(got[b][0] == want[b][0] and abs(got[b][1] - want[b][1]) < 1e-9 for b in got)
        assert sum(r["count"] for r in BS.deal(spark, 101, 6, 77, seed=9, span=span).collect()) == 6 * 77


def test_draws_of_many_samples_are_those_of_each(monkeypatch):
    import numpy as np
    b, counts = np.array([3, 4, 9, 11]), np.array([5, 0, 8, 1])
    for rows in (7, 4):  # a full range, and one with empty places
        owner, hit, empty, anew = BS.many_places(1, b, 6, counts, 7, rows, 40)
        for i in range(len(b)):
            one, more = BS.places(1, int(b[i]), 6, int(counts[i]), 7, rows, 40)
            assert hit[owner == i].tolist() == one.tolist() and anew[empty == i].tolist() == more.tolist()
            assert len(one) + len(more) == counts[i]
    # what is held at once is bounded by draws, not by samples
    monkeypatch.setattr(BS, "CHUNK", 3)
    parts = list(BS.pieces(np.array([4, 4, 1, 1, 1, 1, 50, 2]), 10))
    assert [(p.start, p.stop) for p in parts] == [(0, 3), (3, 6), (6, 7), (7, 8)]


def test_parts_draw_what_ranges_draw(spark, monkeypatch):
    # each draw made anew was a Python pair in the task of the last range, and each sample had a row of sums a range
    monkeypatch.setattr(BS, "FOLD", 2)
    monkeypatch.setattr(BS, "LEAST", 1)
    st = spark.createDataFrame([(i, i * i) for i in range(101)], "n long, x long")
    drawn = BS.draws(spark, 101, 40, 77, seed=9, span=8).collect()  # 16 ranges of 7 places, 11 of 112 empty
    want = {b: sum(r.idx ** 2 for r in drawn if r.b == b) for b in range(40)}
    out = BS.resample_sums(st, ["x"], 40, 77, 9, n=101, span=8)
    assert {r.b: r.x for r in out.collect()} == want
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()  # no second look for draws made anew
    rows = BS.deal_parts(spark, 101, 40, 77, 2, seed=9, span=8).collect()
    assert len(rows) <= 40 * 4 and {r.part for r in rows} == set(range(4))
    assert sum(r["count"] for r in rows) == 40 * 77 and sum(len(r.anew) for r in rows) > 0


def test_hits_are_the_places_drawn():
    import numpy as np
    b, counts = np.arange(150), np.random.default_rng(0).integers(0, 90, 150)
    owner, place = BS.many_places(3, b, 21, counts, 13, 13, 500)[:2]
    want = np.bincount(owner * 13 + place, minlength=150 * 13).reshape(150, 13)
    np.add.at(want, ([4, 4, 149], [2, 2, 12]), 1)
    for kind in (np.float32, np.float64):
        got = [(some, x.copy()) for some, x in BS.hits(3, b, 21, counts, 13, np.array([4, 4, 149]), np.array([2, 2, 12]), kind)]
        assert (np.concatenate([x for _, x in got]) == want).all() and got[-1][0].stop == 150
    big = np.array([0, 7, (1 << 63) + 12345, (1 << 64) - 1], np.uint64)
    for n in (1, 40, (1 << 32) - 1, 1 << 33):
        assert BS._below(big, n).tolist() == [int(x) * n >> 64 for x in big]
