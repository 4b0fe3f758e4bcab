"""Line deduplication against a plain count, over several batches and compactions."""
import hashlib
import random
import re

import duckdb
import pytest

from linea.llm import line_dedup as L
from linea.llm.queries import SQL, op13_line_dedup

WS = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=40, min_docs=5):
    """(id, text) -> (id, n_lines, n_dropped, kept) of each row."""
    def key(line):
        return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), line.strip(WS))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-9**20 if i is None else i)
    drop = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if drop.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def made(seed, n):
    rnd = random.Random(seed)
    pool = ["Common line number %d that is long enough to count, é%s" % (k, "x" * k) for k in range(12)]
    pool += ["Short %d" % k for k in range(4)] + ["é" * 39, "é" * 40, "𝄞" * 20, "\x85" + "y" * 40, "\x1cy" * 21, "Ä" * 41, "ä" * 41]
    rows = []
    for i in range(n):
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 6))] + ["own line of document %d, not found anywhere else" % i] * rnd.randint(0, 2)
        rows.append((i * 3, "\n".join(rnd.choice(["", " ", "\t", "\r"]) + (x.upper() if x.isascii() and rnd.random() < 0.2 else x) + rnd.choice(["", " \x0b", "\r"]) for x in lines)))
    return rows + [(None, "\n".join(pool)), (None, pool[0]), (1, ""), (2, None), (7, pool[1] + "\n" + pool[1]), (7, pool[2])]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_equals_plain_count(spark, batches):
    rows = made(batches, 60)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, kept string, n_lines int").repartition(3)
    got = sorted((tuple(r) for r in L.drop_repeated(df, batches=batches).select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 20


def test_runs_compact_and_keep_counts(spark):
    from linea.session import ensure_checkpoint_dir

    runs = L.LineRuns(spark, f"{ensure_checkpoint_dir(spark)}/test-runs", 3)
    want = {}
    for batch in range(7):  # falling documents
        pairs = [(bytes([k]), 100 - 10 * batch - d) for d in range(5) for k in range(20) if (k * 7 + batch * 3 + d) % 4 == 0]
        for k, d in pairs:
            want.setdefault(k, set()).add(d)
        runs.add(spark.createDataFrame(pairs + pairs[:3], "key binary, doc long"))
        assert [len(level) for level in runs.levels] == [int(b) for b in reversed(f"{batch + 1:b}")] + [0] * (len(runs.levels) - len(f"{batch + 1:b}"))
    got = {bytes(r.key): (r.docs, r.keeper) for r in runs.table().collect()}
    assert got == {k: (len(v), max(v)) for k, v in want.items()}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_join_without_shuffling_them(spark):
    from linea.session import ensure_checkpoint_dir

    runs = L.LineRuns(spark, f"{ensure_checkpoint_dir(spark)}/test-plan", 4)
    pairs = spark.createDataFrame([(b"a", 1), (b"b", 2)], "key binary, doc long")
    runs.add(pairs)
    a = spark.table(runs.levels[0][0])
    plan = runs._merged(a, spark.table(runs.levels[0][0]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()


def test_query_and_its_sql(spark, tmp_path):
    rows = [r for r in made(8, 80) if r[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_line_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in plain(rows)), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(SQL["op13_line_dedup"]).fetchall(), key=str) == got


def test_empty_and_no_long_line(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert L.drop_repeated(empty).count() == 0
    df = spark.createDataFrame([(i, "a\nb") for i in range(9)], "doc_id int, text string")
    assert {tuple(r[1:]) for r in L.drop_repeated(df).collect()} == {(2, 0, "a\nb")}
