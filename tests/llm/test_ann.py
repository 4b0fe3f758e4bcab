import numpy as np
import pytest

from linea.llm import ann


def rows_of(spark, vectors, ids=None):
    rows = [(int(i), None if v is None else [float(x) if x is not None else None for x in v], 7)
            for i, v in zip(ids if ids is not None else range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def exact(ids, x, q, k):
    s = x @ x[q]
    order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
    return [(int(ids[i]), s[i]) for i in order]


@pytest.mark.parametrize("block", [4096, 16])
def test_recall_and_scores(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((8, 24))[rng.integers(0, 8, 400)] + 0.5 * rng.standard_normal((400, 24))
    x = (x * rng.uniform(0.5, 2, (400, 1))).astype(np.float32)
    x[100:130] = x[100] * 9 / np.linalg.norm(x[100])  # many long equal vectors: ties go to the smaller id
    df = rows_of(spark, x)
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=10).collect()
    x = x.astype(np.float64)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(range(0, 400, 20))
    hits = []
    for q, rows in found.items():
        want = exact(np.arange(400), x, q, 10)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == 10 and q not in dict(rows)
        assert all(abs(s - x[v] @ x[q]) < 1e-9 for v, s in rows)
        hits.append(len({v for v, _ in rows} & {v for v, _ in want}) / 10)
    assert np.mean(hits) >= 0.95
    assert [v for v, _ in found[100]] == list(range(101, 111))


def test_edge_cases(spark):
    good = np.eye(4)
    df = rows_of(spark, [*good, None, [], [0, 0, 0, 0], [1, None, 0, 0], [1, float("nan"), 0, 0], [1, float("inf"), 0, 0], [1, 1], good[0]],
                 [0, 1, 2, 3, 20, 40, 60, 80, 100, 120, 140, 0])
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
    assert {r.query_id for r in got} == {0}
    assert sorted(r.vec_id for r in got) == [1, 2, 3]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_visits_follow_the_estimate():
    h = ann.Hashes(6, 1.0, 3, 4, 1.5, 81, 1)
    v = np.random.default_rng(2).standard_normal((5, 6))
    at = h.places(v, query=True)
    keys = h.visits(v)
    assert (keys[..., 0] == h.key(np.floor(at))).all()  # the own bucket first
    assert all(len(set(k)) == 81 for k in keys.reshape(-1, 81).tolist())


def test_one_long_vector_hides_no_other(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((2000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[777] *= 100
    x = x.astype(np.float32)
    df = rows_of(spark, x)
    got = ann.search(df, df.where("vec_id % 40 = 0"), k=20).collect()
    x = x.astype(np.float64)
    hits = []
    for q in range(0, 2000, 40):
        found = {r.vec_id for r in got if r.query_id == q}
        assert len(found) == 20
        hits.append(len(found & {v for v, _ in exact(np.arange(2000), x, q, 20)}) / 20)
    assert np.mean(hits) >= 0.9


def test_queries_that_find_too_little_look_further(spark):
    x = np.random.default_rng(12).standard_normal((600, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = rows_of(spark, x)
    got = ann.search(df, df.where("vec_id % 100 = 0"), k=25, tables=1, probes=1, width=0.2).collect()
    assert {q: sorted(r.rank for r in got if r.query_id == q) for q in range(0, 600, 100)} == {
        q: list(range(1, 26)) for q in range(0, 600, 100)}
    x = x.astype(np.float64)
    for q in range(0, 600, 100):  # their buckets hold next to nothing, so they meet every vector
        assert {r.vec_id for r in got if r.query_id == q} == {v for v, _ in exact(np.arange(600), x, q, 25)}


def test_repeated_ids_take_one_place(spark):
    x = np.random.default_rng(13).standard_normal((300, 8))
    df = rows_of(spark, [*x, *(x[1] * s for s in (0.9, 0.8, 0.7))], [*range(300), 1, 1, 1])
    got = ann.search(df, df.where("vec_id = 0"), k=299).collect()
    assert sorted(r.vec_id for r in got) == list(range(1, 300))
