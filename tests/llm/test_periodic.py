"""Periodic runs against a plain search, appended word by word and in slabs."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from linea.llm import periodic as P
from linea.llm.queries import op12_periodic_runs


def plain(words, least=12):
    """Every (start, length, smallest period) by comparing words at every distance."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        s = None
        for i in range(q, n + 1):
            if i < n and words[i] == words[i - q]:
                s = i - q if s is None else s
            elif s is not None:
                if i - s >= max(least, 2 * q):
                    best.setdefault((s, i), q)
                s = None
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def streams(seed, many):
    rnd = random.Random(seed)
    for _ in range(many):
        kind = rnd.random()
        w = [rnd.choice("abcd"[:rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 60))]
        if kind < 0.5:
            unit = [rnd.choice("abcde") for _ in range(rnd.randint(1, 25))]
            w += (unit * 5)[:rnd.randint(0, 90)] + [rnd.choice("ab") for _ in range(rnd.randint(0, 9))]
        yield w


@pytest.mark.parametrize("least", [2, 12])
def test_runs_equal_plain_search(least):
    docs = list(streams(least, 250))
    found = P.runs_of([[x.encode() for x in d] for d in docs], least)
    assert found == [plain(d, least) for d in docs]


def test_fibonacci_and_one_word():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    for w in (list(b), ["x"] * 500, list("ab" * 300), list("abc" * 100 + "abd" * 100)):
        assert P.runs_of([[x.encode() for x in w]], 2) == [plain(w, 2)]


def test_appending_word_by_word_is_the_same():
    for w in streams(9, 40):
        ids = np.array([ord(x) for x in w], np.int64)
        want = [(s, s + n, q) for s, n, q in plain(w, 2)]
        assert P.find(ids, 2, slab=1) == want
        assert P.find(ids, 2, slab=7) == want
        online = P.Catchers()
        for i, x in enumerate(ids):
            online.append(np.array([x]))
            if i % 5 == 0:
                assert online.runs(4) == [(s, s + n, q) for s, n, q in plain(w[:i + 1], 4)]


def test_two_live_catchers_see_every_period():
    for q in range(1, 200):
        w = [f"w{i}" for i in range(q)] * 2
        assert P.runs_of([[b"y"] * 3 + [x.encode() for x in w] + [b"z"]], 2 * q)[0][-1] == (3, 2 * q, q)


def test_long_stream_over_slabs():
    rnd = np.random.default_rng(1)
    unit = rnd.integers(0, 10**9, 90_000)
    ids = np.concatenate([rnd.integers(0, 10**9, 1000), np.tile(unit, 3)[:250_000], rnd.integers(0, 10**9, 50)])
    assert P.find(ids) == [(1000, 251_000, 90_000)]
    assert P.find(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def damaged(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_plain_search(spark, tmp_path):
    rnd = random.Random(2)
    words = ["été", "a", "b\x1c", "c d", "𝄞", "."]
    rows = [(i, " \t".join(rnd.choice(words[:rnd.randint(1, 6)]) for _ in range(rnd.randint(0, 80)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, "a " * 40), (5, rows[5][1]), (5, "b " * 13)]
    spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, runs string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t in rows:
        w = damaged(i, t)
        runs = plain(w)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                     hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sum(r[1] > 0 for r in got) > 20


def test_empty_table(spark):
    assert P.detect(spark.createDataFrame([], "doc_id long, text string")).count() == 0
