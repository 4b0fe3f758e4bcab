"""Conversation repair against a plain dynamic programme, whole and in blocks."""
import hashlib
import itertools
import random
import re

import pytest

from linea.llm import conversations as C
from linea.llm.queries import op11_conversation_repair

PATTERN = re.compile(r"(s?(ua)+)?")


def plain(rows, at_end=True):
    """Cheapest, least audit by a table over rows, trying up to three inserts before each."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    ways = {0: (0, "")}

    def inserted(ways):
        out = {}
        for q, (c, a) in ways.items():
            for k in range(4):
                p = q
                for _ in range(k):
                    p = 3 if p == 2 else 2
                out[p] = min(out.get(p, (9**9, "")), (c + 2 * k, a + "I" * k))
        return out

    for symbol in rows:
        after = {}

        def put(q, c, a):
            after[q] = min(after.get(q, (9**9, "")), (c, a))

        for q, (c, a) in inserted(ways).items():
            put(q, c + 3, a + "D")
            if symbol != "x":
                low = {"_": "-"}.get(symbol, symbol.lower())
                more = int(low != symbol)
                put(3 if q == 2 else 2, c + 2 + more, a + "R")
                if (q, low) in step:
                    put(step[q, low], c + more, a + "K")
        ways = after
    return min(v for q, v in inserted(ways).items() if q in (0, 3))


def test_solve_equals_plain_search():
    for n in range(4):
        for rows in itertools.product("xsua-SUA_", repeat=n):
            assert C.solve("".join(rows)) == plain(rows), rows
    rnd = random.Random(3)
    for _ in range(400):
        rows = "".join(rnd.choice("xsuuaa-SUA_") for _ in range(rnd.randint(4, 40)))
        assert C.solve(rows) == plain(rows), rows


def test_combined_blocks_equal_the_whole():
    rnd = random.Random(4)
    for _ in range(60):
        rows = "".join(rnd.choice("xsuuaa-SUA_") for _ in range(rnd.randint(1, 30)))
        cuts = [rows[i:i + 4] for i in range(0, len(rows), 4)]
        found = [[(i, o, *w) for i in range(4) for o in range(4) if (w := C.solve(c, i, (o,), False))] for c in cuts]
        tables = [C._ranked(e) for e in found]
        pairs = [C._combined(tables[i:i + 2]) for i in range(0, len(tables), 2)]
        root = C._combined(pairs)
        cost, _, o = min((e["cost"] + 2 * len(C.CLOSING[e["o"]]), e["rank"], e["o"]) for e in root if e["i"] == 0)
        audit = ""
        for e, (i, to, _) in zip(found, C._route(tables, o)[0][1], strict=True):
            audit += next(a for p, q, _, a in e if (p, q) == (i, to))
        assert (cost, audit + C.CLOSING[o]) == plain(rows), rows


def expected(rows):
    """The whole contract for one conversation's rows (turn, role, text), by the plain search."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    seen, faults, symbols = set(), [], ""
    for _, _, r, x in rows:
        chars = re.findall(r"[^\x20\x09-\x0D]", x)
        f = "b" if not chars else "d" if (r, x) in seen else "t" if chars[-1] not in ".!?" else ""
        seen.add((r, x))
        faults.append(f)
        low = r[:1] if r[:1] in ("s", "u", "a") else "-"
        symbols += "x" if f in ("b", "d") else low.translate(str.maketrans("sua-", "SUA_")) if f else low
    cost, audit = plain(symbols)
    out, at, initials = [], 0, ""
    for e in audit:
        if e == "D":
            at += 1
            continue
        name = "assistant" if initials[-1:] == "u" else "user"
        role, text = {"K": rows[at][2:], "R": (name, rows[at][3])}[e] if e in "KR" else (name, "")
        initials += role[:1]
        out.append(f"{role}:{text}")
        at += e != "I"
    assert PATTERN.fullmatch(initials)
    turns = [t for known, t, _, _ in rows if known]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def made(seed, convs, most):
    rnd = random.Random(seed)
    out = []
    for c in convs:
        for _ in range(rnd.randint(0, most) if c != 7 else 5 * most):
            out.append((c, rnd.choice([None, *range(60)]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]),
                        rnd.choice(["Hi.", "What?", "no end", "", " \t", None, "é ü!", "x" * 50, "Word %d." % rnd.randint(0, 99), "cut %d" % rnd.randint(0, 9)])))
    return out


@pytest.mark.parametrize("block, fan", [(256, 256), (4, 2), (3, 64)])
def test_repair_equals_plain_search(spark, block, fan):
    rows = made(1, [1, 2, 7, None, 9], 12)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).selectExpr("*", "1 as k", "2 as pos", "3 as c")
    found = C.repair(df, block=block, fan=fan)
    got = {r[0]: tuple(r[1:]) for r in found.summary.collect()}
    want = {c: expected([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want
    lines = {}
    for r in sorted(found.lines.collect(), key=lambda r: r.line):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in lines.items()} == {
        c: v[-1] for c, v in want.items() if v[-1] != hashlib.sha256(b"").hexdigest()}


def test_all_deleted_long_conversation(spark):
    df = spark.createDataFrame([(1, None, "user", " ")] * 9 + [(2, 1, "user", "Hi.")] * 9, "conv_id long, turn long, role string, text string")
    for block in (256, 4):
        got = {r.conv_id: tuple(r[1:]) for r in C.repair(df, block=block).summary.collect()}
        assert got[1] == expected([(None, "user", " ")] * 9)
        assert got[2] == expected([(1, "user", "Hi.")] * 9)


def test_empty_table_and_strings(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    found = C.repair(df)
    assert found.summary.count() == 0 and found.lines.count() == 0
    df = spark.createDataFrame([("a", 1, "user", "Long. " * 400_000)], "conv_id string, turn int, role string, text string")
    assert C.repair(df).summary.first().audit == "KI"  # beyond block_bytes: by blocks


def test_query_on_a_table(spark, tmp_path):
    import zlib

    rows = made(5, [*range(12), None], 9) + [(40, t, "user", "x.") for t in range(200) if zlib.crc32(f"40:{t}".encode()) % 20 == 0]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    hurt = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", " " if text is None else text)}.get(code, text)
        hurt[c] += [(t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    got = {r.conv_id: tuple(r[1:]) for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: expected(v) for c, v in hurt.items()}
    assert got[40] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
