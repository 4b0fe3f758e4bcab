import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from linea.llm import simhash

WS = " \t\n\x0b\x0c\r"


def brute(text, k=4):
    """Bit by bit, from the definition."""
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WS:
        t = t.replace(c, " ")
    words = [w for w in t.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, max_bits):
    """Smallest position reachable over links of at most max_bits."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= max_bits and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_fingerprint():
    for t in [None, "", " \n", "one", "A b C", "a  B\tc\nd e", "x\xa0y z w v Ä ä", "w " * 5000, "Σ É 😀 a b c"]:
        assert simhash.fingerprint(t) == (brute(t) ^ (1 << 63)) - (1 << 63), t


@pytest.mark.parametrize("cell", [2048, 8])
def test_links_find_every_class(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(2)
    prints = {0}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 4, 5])))
            prints.add(base)
    centre = rng.getrandbits(64)  # a dense group, larger than a small cell
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    prints = sorted(prints)
    df = spark.createDataFrame([((p ^ (1 << 63)) - (1 << 63),) for p in prints], "fp bigint").repartition(3)
    want = classes(prints, 4)
    got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in simhash.components(simhash.links(df)).collect()}
    got |= {r: r for r in got.values()}
    for i, p in enumerate(prints):
        mates = {q for j, q in enumerate(prints) if want[j] == want[i]}
        if len(mates) == 1:
            assert p not in got
        else:
            assert {q for q in mates if got[q] == got[p]} == mates
            assert {q for q in got if got[q] == got[p]} == mates


def docs_of(spark):
    rows = [(5, "the quick brown fox jumps over the lazy dog " * 5, "s"), (3, "THE quick brown fox jumps over the lazy dog " * 5, "t"),
            (9, None, "a"), (8, "", "b"), (None, " \t", "c"), (1, "some other words that stand alone here", "d"),
            (1, "some other words that stand alone here", "d"), (2, "x " * 30000, "e"), (None, "never seen before in this test at all", "f")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, fp string")


def test_cluster_edge_cases(spark):
    rows = simhash.cluster(docs_of(spark)).collect()
    got = sorted(str((r.doc_id, r.component_id)) for r in rows)
    assert got == sorted(map(str, [(5, 3), (3, 3), (9, 8), (8, 8), (None, 8), (1, 1), (1, 1), (2, 2), (None, None)]))
    assert all(r.fingerprint == 0 for r in rows if r.component_id == 8)


def test_deduplicate_keeps_one_of_each(spark):
    rows = simhash.deduplicate(docs_of(spark)).collect()
    assert sorted(str((r.doc_id, r.fp)) for r in rows) == sorted(map(str, [(3, "t"), (8, "b"), (1, "d"), (2, "e"), (None, "f")]))


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = docs.collect()
    prints = [brute(r.text) for r in rows]
    root = classes(prints, 4)
    got = {r.doc_id: r for r in simhash.cluster(docs).collect()}
    for r, p, k in zip(rows, prints, root, strict=True):
        assert got[r.doc_id].fingerprint & (1 << 64) - 1 == p and got[r.doc_id].component_id == rows[k].doc_id


def test_embedding_is_a_lower_bound(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64) << np.uint64(1)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    table = simhash._manhattan_table()
    assert (simhash._manhattan(simhash._embed_np(a), simhash._embed_np(b), table) <= np.bitwise_count(a ^ b)).all()
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp bigint")
    got = [r[0] for r in df.select(simhash.embed(F.col("fp"))).collect()]
    assert got == simhash._embed_np(a).view(np.int64).tolist()


def test_empty_table(spark):
    assert simhash.cluster(docs_of(spark).limit(0)).count() == 0
    assert simhash.deduplicate(docs_of(spark).limit(0)).count() == 0


def test_thermometer_is_the_manhattan_distance():
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 1 << 64, (2, 5000), dtype=np.uint64)
    table = simhash._manhattan_table()
    want = simhash._manhattan(simhash._embed_np(a), simhash._embed_np(b), table)
    assert (np.bitwise_count(simhash._thermometer(a) ^ simhash._thermometer(b)) == want).all()


def test_join_split_meets_hot_and_rare_keys(spark, monkeypatch):
    from linea.llm import common

    rows = [(k, i) for k, n in ((1, 500), (2, 30), (3, 1), (4, 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, x int")
    table = df.groupBy("k").agg(F.max("x").alias("top"), F.count(F.lit(1)).alias("n"))
    want = sorted((k, x, dict((k, n - 1) for k, n in ((1, 500), (2, 30), (3, 1), (4, 7)))[k]) for k, x in rows)
    for hot in (1, 3, 100, 10_000):
        monkeypatch.setattr(common, "HOT", hot)
        assert sorted(tuple(r) for r in common.join_split(df, table, "k", len(rows)).select("k", "x", "top").collect()) == want


def test_components_of_a_large_star(spark):
    edges = [(i, 0) for i in range(1, 400)] + [(1000 + i, 1000 + i + 1) for i in range(40)] + [(399, 2000), (2000, 2001)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in [*range(1, 400), 2000, 2001]} | {1000 + i: 1000 for i in range(1, 41)}
    assert {k: v for k, v in got.items() if k != v} == want
