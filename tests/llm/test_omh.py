import hashlib
import random

import pytest
from pyspark.sql import functions as F

from linea.llm import omh


def numbers(spark, texts, **settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [list(r[0]) for r in df.orderBy("i").select(omh.fingerprint(F.col("t"), **settings)).collect()]


def test_numbered_pairs_match_brute_force(spark):
    texts = ["a b a b a b", "one", "x x x x x x x", "p q r s t u", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(omh.kmers(F.col("t"), 2).alias("k"), omh.numbered(omh.kmers(F.col("t"), 2)).alias("n")).collect()
    assert [len(r.k) for r in rows] == [5, 1, 6, 5, 0]
    for r in rows:
        seen, pairs = {}, set()
        for at, h in enumerate(r.k):
            seen[h >> 30] = seen.get(h >> 30, -1) + 1
            pairs.add((h >> 30, seen[h >> 30], at))
        want = {}
        if pairs:
            q = spark.createDataFrame(list(pairs), "h long, o int, p long")
            want = {x.p: x.v >> 30 for x in q.select("p", F.xxhash64("h", "o").alias("v")).collect()}
        assert {x & (1 << 30) - 1: x >> 30 for x in r.n} == want
        assert list(r.n) == sorted(r.n)


def test_signature_matches_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 3, 9, 40, 400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    pairs = omh.numbered(omh.kmers(F.col("t"), 2))
    for r in df.select(pairs.alias("p"), omh.signature(pairs, 8, 2).alias("s")).collect():
        p = list(r.p)
        for b, got in zip(range(-4, 4), r.s, strict=True):
            at = next((i for i, x in enumerate(p) if x >> 61 >= b), 0)
            took = sorted((p[(at + j) % len(p)] for j in range(min(2, len(p)))), key=lambda x: x & (1 << 30) - 1)
            want = spark.range(1).select(F.xxhash64(F.array(*[F.lit(x >> 30).cast("bigint") for x in took]))).first()[0] >> 32
            assert got == want


def test_order_and_edits_matter(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    other = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    a, near, swapped, far, again = numbers(spark, [" ".join(words), " ".join(words[:390] + other[:10]),
                                                   " ".join(words[200:] + words[:200]), " ".join(other), " ".join(words)])
    same = lambda x, y: sum(p == q for p, q in zip(x, y, strict=True)) / len(x)
    assert a == again and same(a, near) > 0.7 and same(a, far) < 0.1
    assert same(a, near) > same(a, swapped) > same(a, far)


@pytest.mark.parametrize("n", [1, 2, 7])
def test_edited_texts(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, "".join(rng.choice("ab cdé😀 \n") for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(n)]
    if n == 7:
        rows[2] = (rows[2][0], None)
        rows += [rows[4], rows[4]]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n string").repartition(3)
    got = omh.edited(docs).collect()
    assert len(got) == len(rows)
    ring = sorted({(i, t or "") for i, t in rows})
    for r in got:
        own = next(t for i, t in ring if i == r.id)
        following = ring[(ring.index((r.id, own)) + 1) % len(ring)][1]
        m = len(own) // 4
        assert r.text == own and r.n == len(own)
        want = own[:len(own) - m] + following[:m]
        assert hashlib.sha256(r.edited.encode()).digest() == hashlib.sha256(want.encode()).digest()
        assert list(r.next_fp) == next(list(x.fp) for x in got if x.text == following)


def test_told_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), (" \n ",)], "t string")
    got = [r[0] for r in df.select(omh.told(omh.fingerprint(F.col("t")))).collect()]
    assert got == ["0" * 256] * 3
    assert omh.edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0
