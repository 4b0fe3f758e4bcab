import pytest

from linea.llm import mixing

WORDS = [("b", 10), ("b", 200), ("a", 1), (None, 7), (None, 50), ("c", 30), ("d", 400), ("d", 400), ("é", 0), ("z", 3)]


def fill(sizes, weights, share, cap):
    """Clamp, redistribute, repeat."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
            open_.remove(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def docs_of(spark, rows):
    return spark.createDataFrame([(i, " ".join(["w"] * n) if n else None, s, 9) for i, (s, n) in enumerate(rows)],
                                 "doc_id long, text string, source string, size int")


@pytest.mark.parametrize("rows", [WORDS, WORDS * 30, [("only", 10)], [("a", 0)], [("a", 100), ("b", 1)]])
def test_targets_and_taken(spark, rows):
    docs = docs_of(spark, rows).drop("size")
    measured = mixing.measure(docs)
    got = mixing.allot(measured, mixing.plan(measured)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = fill(sizes, (5, 2, 1), 1.5, 2.0)
    taken = {}
    for r in got:
        assert r.size == rows[r.doc_id][1] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.allot(measured, mixing.plan(measured.repartition(5))).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows_hold_the_taken_words(spark):
    docs = docs_of(spark, WORDS * 3)
    rows = mixing.mix(docs).collect()
    measured = mixing.measure(docs.drop("size"))
    want = {r.doc_id: r.taken for r in mixing.allot(measured, mixing.plan(measured)).collect() if r.taken}
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + len((r.text or "").split())
        assert r["size"] == 9
    assert got == want


def test_empty_table(spark):
    docs = docs_of(spark, WORDS).limit(0).drop("size")
    measured = mixing.measure(docs)
    assert mixing.allot(measured, mixing.plan(measured)).count() == 0
    assert mixing.mix(docs).count() == 0
