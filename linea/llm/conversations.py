"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation's rows are edited so that their role initials read
``(s?(ua)+)?``. A lattice node is (rows consumed, state); the states are those
of that pattern: 0 nothing yet, 1 after the system row, 2 after a user row, 3
after an assistant row. Edges and costs: K keep 0, R re-role to user or
assistant 2, D delete 3 (the only edge of blank and duplicate rows), I insert
an empty user or assistant row 2; K and R of a truncated row cost 1 more.

:func:`solve` runs a forward and a reverse heap until their least keys exceed
the best meeting, so every crossing of least cost is known, and takes the least
of the concatenated audits (the edits' initials). Two facts make that the least
audit of all: an audit leads to one node only, and no audit of a node is a
prefix of another one of the same cost.

A conversation of at most ``block`` rows and ``block_bytes`` of text is solved
in one piece. A longer one is cut into blocks of ``block`` rows: rows get their
global position from a range partitioning, each block is solved from every
state to every state, and the blocks' 4 x 4 tables are combined in a tree of
``fan`` children a node, up for the costs and down for the states at the
blocks' ends. So no task holds a long conversation. Only what is one value by
its meaning is made in one task: the audit string, and the hash of the repaired
conversation, which streams over its rows and holds one at a time.

Edge cases: null role or text is one space; null turns come first; rows of one
turn are ordered by role, then text (code points); a null conversation id is a
conversation. Rows whose ``present`` is false only let their conversation
exist: without other rows it has zeros, an empty audit and the hash of the empty
string. Repeated rows are duplicates. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import materialise
from linea.operators.positional import lookup_join, ordered_index

WHITE = " \t\n\x0b\x0c\r"
#: State after a row of that initial; state after an inserted or re-roled row.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
LEGAL = ("su", "ua", "au")
#: Rows that close a conversation after its last row, by state.
CLOSING = ("", "II", "I", "")
KEEP_COST, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1


class Repair(NamedTuple):
    """``summary``: a row per conversation; ``lines``: (conversation, line, role, text) of the repaired ones."""

    summary: DataFrame
    lines: DataFrame


def _row_edges(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of one row.

    A symbol is ``x`` (must go) or the role's initial, ``-`` for any other
    than s, u and a, in capitals (``_``) for a truncated row.
    """
    if symbol == "x":
        return [("D", DELETE, state)]
    initial = "-" if symbol == "_" else symbol.lower()
    more = TRUNCATED * (symbol != initial)
    out = [("D", DELETE, state), ("R", REROLE + more, TURN[state])]
    if initial in KEEP[state]:
        out.append(("K", KEEP_COST + more, KEEP[state][initial]))
    return out


@lru_cache(maxsize=1 << 15)
def solve(rows: str, entry: int = 0, exits: tuple[int, ...] = (0, 3), closing: bool = True) -> tuple[int, str] | None:
    """Least cost and least audit from ``entry`` before the rows to one of ``exits`` behind them.

    Without ``closing`` nothing is inserted behind the last row.
    """
    n = len(rows)
    edges = [[_row_edges(s, q) for q in range(4)] for s in rows]

    def onward(at: int, q: int) -> list[tuple[str, int, tuple[int, int]]]:
        out = [(label, cost, (at + 1, to)) for label, cost, to in edges[at][q]] if at < n else []
        if at < n or closing:
            out.append(("I", INSERT, (at, TURN[q])))
        return out

    def backward(at: int, q: int) -> list[tuple[str, int, tuple[int, int]]]:
        out = [(label, cost, (at - 1, was)) for was in range(4) for label, cost, to in edges[at - 1][was] if to == q] if at else []
        if at < n or closing:
            out += [("I", INSERT, (at, was)) for was in range(4) if TURN[was] == q]
        return out

    # keys (cost, rows consumed on that side, node): a node is popped after every node before it on a cheapest path
    ahead: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    behind: dict[tuple[int, int], tuple[int, str]] = {(n, q): (0, "") for q in exits}
    heaps = [[(0, 0, (0, entry))], [(0, 0, (n, q)) for q in sorted(exits)]]
    done: list[set] = [set(), set()]
    best: int | None = None
    while all(heaps) and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, _, node = heapq.heappop(heaps[side])
        if node in done[side]:
            continue
        done[side].add(node)
        mine, other = (ahead, behind) if side == 0 else (behind, ahead)
        audit = mine[node][1]
        if node in other and (best is None or cost + other[node][0] < best):
            best = cost + other[node][0]
        for label, step, to in (onward if side == 0 else backward)(*node):
            found = (cost + step, audit + label if side == 0 else label + audit)
            if to not in mine or found < mine[to]:
                mine[to] = found
                heapq.heappush(heaps[side], (found[0], to[0] if side == 0 else n - to[0], to))
    if best is None:
        return None
    settled = done[1].union((n, q) for q in exits)
    crossings = []
    for node in done[0]:
        cost, audit = ahead[node]
        if node in settled and cost + behind[node][0] == best:
            crossings.append(audit + behind[node][1])
        crossings += [audit + label + behind[to][1] for label, step, to in onward(*node)
                      if to in settled and cost + step + behind[to][0] == best]
    return best, min(crossings)


def repaired(audit: str, roles: list[str], state: int = 0) -> list[tuple[int, str]]:
    """(row number, role) of the lines that an audit leaves; row -1: inserted."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        state = KEEP[state][roles[at][:1]] if edit == "K" else TURN[state]
        out.append((-1 if edit == "I" else at, roles[at] if edit == "K" else ROLE[state]))
        at += edit != "I"
    return out


def _symbol(initial: str, forced: bool, truncated: bool) -> str:
    if forced:
        return "x"
    if initial not in ("s", "u", "a"):
        return "_" if truncated else "-"
    return initial.upper() if truncated else initial


def _mend(held: list[dict]) -> dict:
    """Counts, cost, audit and lines of one whole conversation."""
    rows = sorted(((h["t"] is not None, h["t"] or 0, h["r"], h["x"]) for h in held))
    seen: set[tuple[str, str]] = set()
    counts, symbols = {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, _, role, text in rows:
        body = text.rstrip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols.append(_symbol(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = solve("".join(symbols))
    turns = [t for known, t, _, _ in rows if known]
    roles = [r for _, _, r, _ in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **counts,
            "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False)),
            "cost": cost, "audit": audit,
            "lines": [(role, rows[at][3] if at >= 0 else "") for at, role in repaired(audit, roles)]}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SUMMARY = ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _told(lines: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in lines).encode("utf-8", "surrogatepass")


def _short(groups: DataFrame, kind: str) -> Repair:
    """Conversations held whole: (c, rows)."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_mend(held) for held in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("c"), *[pa.array([d[c] for d in done], pa.int64()) for c in COUNTS],
                 pa.array([d["audit"] for d in done], pa.string()),
                 pa.array([hashlib.sha256(_told(d["lines"])).hexdigest() for d in done], pa.string())],
                ["c", *COUNTS, "audit", "repaired_sha256"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, j, *line) for i, held in enumerate(batch.column("rows").to_pylist())
                   for j, line in enumerate(_mend(held)["lines"])]
            at, number, role, text = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("c").take(pa.array(at, pa.int64())), pa.array(number, pa.int64()), pa.array(role, pa.string()),
                 pa.array(text, pa.string())], ["c", "line", "role", "text"])

    return Repair(groups.mapInArrow(summaries, f"c {kind}, {SUMMARY}"),
                  groups.mapInArrow(lines, f"c {kind}, line bigint, role string, text string"))


# --- conversations in blocks ------------------------------------------------

TABLE = "array<struct<i: int, o: int, cost: bigint, rank: int>>"


def _ranked(entries: list[tuple[int, int, int, object]]) -> list[dict]:
    """(entry, exit, cost, anything that orders an entry's audits) as table rows."""
    out = []
    for i in range(4):
        mine = sorted((e for e in entries if e[0] == i), key=lambda e: e[3])
        out += [{"i": i, "o": o, "cost": cost, "rank": rank} for rank, (_, o, cost, _) in enumerate(mine)]
    return out


def _route(children: list[list[dict]], goal: int) -> dict[int, tuple[int, list[tuple[int, int, int]]]]:
    """entry -> (cost, (entry, exit, rank) of each child) of the cheapest, least way to state ``goal``."""
    ways: dict[int, tuple[int, list]] = {goal: (0, [])}
    for table in reversed(children):
        step: dict[int, tuple] = {}
        for e in table:
            if e["o"] in ways:
                key = (e["cost"] + ways[e["o"]][0], e["rank"], e["o"])
                if e["i"] not in step or key < step[e["i"]]:
                    step[e["i"]] = key
        ways = {i: (cost, [(i, o, rank), *ways[o][1]]) for i, (cost, rank, o) in step.items()}
    return ways


def _combined(children: list[list[dict]]) -> list[dict]:
    return _ranked([(i, o, cost, [rank for _, _, rank in way])
                    for o in range(4) for i, (cost, way) in _route(children, o).items()])


def _each(frame: DataFrame, schema: str, body) -> DataFrame:
    """Rows of ``frame`` through ``body(dict) -> list of tuples``."""
    names = [part.strip().split(" ")[0].rstrip(":") for part in schema.split(";")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [dict(zip(names, made, strict=True)) for row in batch.to_pylist() for made in body(row)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = schema.replace(";", ",")
    target = to_arrow_schema(StructType.fromDDL(ddl))
    return frame.mapInArrow(run, ddl)


def _long(rows: DataFrame, block: int, fan: int) -> Repair:
    """Conversations in blocks: rows (k, c, t, r, x) of those only."""
    held = ordered_index(rows.withColumn("m", F.monotonically_increasing_id()),
                         [F.col("k"), F.col("t").asc_nulls_first(), F.col("r"), F.col("x"), F.col("m")], "pos").drop("m")
    held = materialise(held.withColumn("b", F.floor(F.col("pos") / block).cast("bigint")))
    same = F.sha2(F.concat_ws(":", F.length("r"), "r", "x"), 256)
    first = held.groupBy("k", same.alias("same")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    body = F.rtrim("x", F.lit(WHITE))
    slim = held.select("k", "b", "pos", F.substring("r", 1, 1).alias("ini"), (body == "").alias("blank"),
                       (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    slim = slim.join(first, "pos", "left").withColumn("again", F.col("first").isNull())
    slim = slim.withColumn("fault", F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate")
                           .when(F.col("cut"), "truncated").otherwise(""))
    initial = F.when(F.col("ini").isin("s", "u", "a"), F.col("ini")).otherwise("-")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.translate(initial, "sua-", "SUA_")).otherwise(initial))
    slim = materialise(slim.select("k", "b", "pos", "ini", "fault", symbol.alias("symbol")))

    # a row's position in its block is its place in the sorted list: at most ``block`` rows
    listed = F.array_sort(F.collect_list(F.struct("pos", "symbol", "ini")))
    blocks = slim.groupBy("k", "b").agg(listed.alias("rows"))

    def solved(row: dict) -> list[tuple]:
        symbols = "".join(r["symbol"] for r in row["rows"])
        found = [(i, o, solve(symbols, i, (o,), False)) for i in range(4) for o in range(4)]
        entries = [(i, o, *way) for i, o, way in found if way is not None]
        return [(row["k"], row["b"], _ranked(entries), [{"i": i, "o": o, "audit": a} for i, o, _, a in entries],
                 [r["pos"] for r in row["rows"]], [r["ini"] for r in row["rows"]])]

    blocks = materialise(_each(blocks, f"k string; b bigint; table {TABLE}; audits array<struct<i: int, o: int, audit: string>>; "
                                       "at array<bigint>; ini array<string>", solved))
    levels = [blocks.select("k", "b", "table")]
    while (levels[-1].groupBy("k").count().agg(F.max("count")).first()[0] or 0) > 1:  # one number
        listed = F.array_sort(F.collect_list(F.struct("b", "table")))
        groups = levels[-1].groupBy("k", F.floor(F.col("b") / fan).cast("bigint").alias("p")).agg(listed.alias("children"))
        up = _each(groups, f"k string; b bigint; table {TABLE}",
                   lambda row: [(row["k"], row["p"], _combined([c["table"] for c in row["children"]]))])
        levels[-1] = groups  # the way down needs the children
        levels.append(materialise(up))

    def chosen(row: dict) -> list[tuple]:
        cost, _, o = min((e["cost"] + INSERT * len(CLOSING[e["o"]]), e["rank"], e["o"]) for e in row["table"] if e["i"] == 0)
        return [(row["k"], row["b"], 0, o, cost, CLOSING[o])]

    roots = materialise(_each(levels[-1], "k string; b bigint; i int; o int; cost bigint; closing string", chosen))
    ways = roots.select("k", F.col("b").alias("p"), "i", "o")
    for groups in reversed(levels[:-1]):
        ways = _each(groups.join(ways, ["k", "p"]), "k string; p bigint; i int; o int",
                     lambda row: [(row["k"], c["b"], i, o) for c, (i, o, _) in
                                  zip(row["children"], _route([c["table"] for c in row["children"]], row["o"])[row["i"]][1], strict=True)])
    taken = F.filter("audits", lambda e: (e["i"] == F.col("i")) & (e["o"] == F.col("o")))[0]["audit"]
    pieces = materialise(blocks.join(ways.withColumnRenamed("p", "b"), ["k", "b"])
                         .select("k", "b", "i", "at", "ini", taken.alias("audit")))

    def acts(row: dict) -> list[tuple]:
        out, before = [], []
        edits = iter(repaired(row["audit"], row["ini"], row["i"]))
        at = 0
        for edit in row["audit"]:
            if edit == "I":
                before.append(next(edits)[1])
                continue
            out.append((row["at"][at], before, next(edits)[1] if edit in "KR" else None, edit == "K"))
            before, at = [], at + 1
        return out

    done = _each(pieces, "pos bigint; before array<string>; role string; keep boolean", acts)
    # role null: deleted; the row that closes a conversation comes last
    kept = held.select("k", "pos", "r", "x").join(done, "pos").select(
        "k", "pos", "before", F.when(F.col("keep"), F.col("r")).otherwise(F.col("role")).alias("role"), F.col("x").alias("text"))
    ends = roots.where("closing <> ''").select(
        "k", F.lit((1 << 63) - 1).alias("pos"),
        F.when(F.col("closing") == "II", F.array(F.lit("user"), F.lit("assistant"))).otherwise(F.array(F.lit("assistant"))).alias("before"),
        F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    ordered = kept.unionByName(ends).repartition("k").sortWithinPartitions("k", "pos")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from ((row["k"], role, "") for role in row["before"])
                if row["role"] is not None:
                    yield row["k"], row["role"], row["text"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for key, role, text in stream(batches):
            if key != now:
                out += [(now, state.hexdigest())] if state else []
                now, state = key, hashlib.sha256()
                state.update(_told([(role, text)]))
            else:
                state.update(b"\n" + _told([(role, text)]))
        out += [(now, state.hexdigest())] if state else []
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.string()) for j in range(2)], ["k", "repaired_sha256"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number = None, 0
        for batch in batches:
            out = []
            for key, role, text in stream([batch]):
                now, number = key, number + 1 if key == now else 0
                out.append((key, number, role, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], ["k", "line", "role", "text"])

    turns = held.groupBy("k", "t").agg(F.first("c").alias("c"))
    span = F.max("t") - F.min("t") + 1 - F.count("t")
    gaps = turns.groupBy("k").agg(F.first("c").alias("c"), F.coalesce(span, F.lit(0)).alias("gaps"))
    follows = slim.select("k", (F.col("pos") - 1).alias("pos"), F.col("ini").alias("then"))
    pairs = slim.select("k", "pos", "ini").join(follows, ["k", "pos"])
    illegal = pairs.groupBy("k").agg(F.sum((~F.concat("ini", "then").isin(*LEGAL)).cast("bigint")).alias("illegal"))
    faults = slim.groupBy("k").agg(*[F.sum((F.col("fault") == f).cast("bigint")).alias(f) for f in ("blank", "duplicate", "truncated")])
    # the audit is one value by contract
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "audit"))), lambda p: p["audit"]), "")
    audits = (pieces.groupBy("k").agg(audit.alias("audit")).join(roots.select("k", "cost", "closing"), "k")
              .select("k", "cost", F.concat("audit", "closing").alias("audit")))
    # a conversation whose rows are all deleted has no line to hash
    hashes = ordered.mapInArrow(digests, "k string, repaired_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = gaps.join(faults, "k").join(illegal, "k", "left").join(audits, "k").join(hashes, "k", "left").fillna(0, ["illegal"])
    whole = whole.select("c", *COUNTS, "audit", F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
    told = ordered.mapInArrow(lines, "k string, line bigint, role string, text string")
    return Repair(whole, told.join(gaps.select("k", "c"), "k").select("c", "line", "role", "text"))


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None, block: int = 256, block_bytes: int = 1 << 20, fan: int = 256) -> Repair:
    """Faults, least cost, least audit and repaired lines of every conversation.

    ``summary``: conversation id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256 (of ``role:text`` lines joined by newlines).
    """
    kind = dict(rows.dtypes)[conv_id]
    c = F.col(conv_id)
    rows = rows.select(c.alias("c"), F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")).alias("k"),
                       F.col(turn).cast("bigint").alias("t"), F.coalesce(F.col(role), F.lit(" ")).alias("r"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("x"), (F.lit(True) if present is None else present).alias("here"))
    here = F.col("here")
    sizes = rows.groupBy("k").agg(F.count(F.when(here, 1)).alias("n"), F.sum(F.when(here, F.octet_length("x")).cast("bigint")).alias("bytes"))
    large = materialise(sizes.where((F.col("n") > block) | (F.col("bytes") > block_bytes)).select("k"))
    some = bool(large.take(1))
    small = lookup_join(rows, large, "k", "left_anti") if some else rows
    held = F.collect_list(F.when(here, F.struct("t", "r", "x")))  # nulls are left out
    out = _short(small.groupBy("k").agg(F.first("c").alias("c"), held.alias("rows")).select("c", "rows"), kind)
    if some:
        more = _long(lookup_join(rows.where("here").drop("here"), large, "k", "left_semi"), block, fan)
        out = Repair(out.summary.unionByName(more.summary), out.lines.unionByName(more.lines))
    return Repair(*[frame.withColumnRenamed("c", conv_id) for frame in out])
