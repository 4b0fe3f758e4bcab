"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: 64 bits, bit i set if it is set in over half of the XXH64 hashes
of a text's word shingles. To find fingerprints at ``max_bits`` or fewer
differing bits, every distinct fingerprint is mapped to the vector of bit
counts of its 2-bit segments (32 coordinates of 0..2). The Manhattan distance
of two vectors is a lower bound of the Hamming distance, so a range-join of
radius ``max_bits`` under it loses nothing. The range-join runs on grids: the
coordinates are dealt to ``bands`` bands; vectors at distance ``max_bits`` or
less are equal in at least ``bands - max_bits`` of them, hence share the cell
of one of the C(bands, max_bits) grids made of that many bands. Cells are
shuffled as (grid, cell, fingerprint), pairs in a cell pass the Manhattan
bound, then the exact bit test.

Hot groups: exact copies fall together before the join (one row per distinct
fingerprint). A cell of up to ``CELL`` fingerprints is examined in one numpy
call and yields a spanning star per connected part, never all pairs; larger
cells are cut into blocks, and every pair of blocks is its own group, so any
number of tasks share them. Components are found by alternating star
contraction with checkpoints.

Edge cases: null or empty text (no words) has fingerprint zero, linked like
any other; fewer words than ``k`` give one shingle of all words. Null ids are
kept; a component's id is its smallest non-null id (null if there is none).
Repeated rows share a component. Empty tables give an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import join_split, materialise

#: Largest cell that one group examines; larger ones are split into blocks.
CELL = 2048
#: Cells up to this size report their verified pairs, larger ones a spanning star.
PAIRS = 12
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, k: int = 4) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    if len(words) < k:
        spans = [(0, len(joined))]
    else:
        spans = [(a, b - 1) for a, b in zip(starts, ends[k - 1:], strict=False)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype="<u8", count=len(spans))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        block = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, k: int = 4) -> Column:
    """Signed 64-bit SimHash of a text column."""

    @F.pandas_udf("bigint")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, k) for t in texts], dtype="int64")

    return simhash.asNondeterministic()(text)


def embed(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, packed in two bits each."""
    low = F.lit(0x5555555555555555)
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return F.shiftleft(a.bitwiseAND(b), 1).bitwiseOR(a.bitwiseXOR(b))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grids(max_bits: int, bands: int) -> list[int]:
    """Bit masks of the packed embedding, one per grid, in a fixed order."""
    cuts = [32 * i // bands for i in range(bands + 1)]
    band = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(band, bands - max_bits)]


def _embed_np(fp: np.ndarray) -> np.ndarray:
    low = np.uint64(0x5555555555555555)
    return (fp & low) + ((fp >> np.uint64(1)) & low)


def _manhattan_table() -> np.ndarray:
    """Distance of two bytes of four packed coordinates."""
    x = np.arange(256)
    parts = np.stack([(x >> s) & 3 for s in (0, 2, 4, 6)]).astype(np.int16)
    return np.abs(parts[:, :, None] - parts[:, None, :]).sum(axis=0).astype(np.uint8)


def _manhattan(a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
    pa, pb = a.view(np.uint8).reshape(-1, 8), b.view(np.uint8).reshape(-1, 8)
    return table[pa, pb].sum(axis=1, dtype=np.int64)


def _thermometer(fp: np.ndarray) -> np.ndarray:
    """The bit counts with as many ones as they tell: the Manhattan distance is the number of differing bits."""
    low = np.uint64(0x5555555555555555)
    a, b = fp & low, (fp >> np.uint64(1)) & low
    return (a | b) | ((a & b) << np.uint64(1))


def _stars(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of one cell (``right``: links between two blocks of it).

    Breadth-first over the not yet reached fingerprints: those whose Manhattan
    distance, the lower bound, is small enough are verified bit by bit. Every
    comparison is one vector operation and nothing is kept for all pairs.
    """
    nodes = left if right is None else np.concatenate([left, right])
    side = np.zeros(len(nodes), np.int8)
    if right is not None:
        side[len(left):] = 1
    bound = _thermometer(nodes)
    rest = np.arange(len(nodes))
    out_a, out_b = [], []
    while len(rest):
        root, rest = rest[0], rest[1:]
        front, members = [root], []
        while front and len(rest):
            at = front.pop()
            maybe = np.bitwise_count(bound[rest] ^ bound[at]) <= max_bits
            if right is not None:
                maybe &= side[rest] != side[at]
            near = np.flatnonzero(maybe)
            near = near[np.bitwise_count(nodes[rest[near]] ^ nodes[at]) <= max_bits]
            if len(near):
                hit = rest[near]
                members.extend(hit.tolist())
                front.extend(hit.tolist())
                rest = np.delete(rest, near)
        if members:
            out_a.append(nodes[np.asarray(members)])
            out_b.append(np.full(len(members), nodes[root]))
    if not out_a:
        none = np.zeros(0, np.uint64)
        return none, none
    return np.concatenate(out_a), np.concatenate(out_b)


def _cells(max_bits: int, masks: list[int]):
    """mapInPandas over (grid, cell, fp) sorted by (grid, cell): links and the rows of oversized cells."""
    mask = np.array(masks, dtype=np.uint64)

    def first_grid(ea: np.ndarray, eb: np.ndarray, grid: np.ndarray) -> np.ndarray:
        """Whether no earlier grid holds the pair too, so that it is told once."""
        diff, found = ea ^ eb, np.zeros(len(ea), bool)
        for g, m in enumerate(mask):
            found |= (grid > g) & ((diff & m) == 0)
        return ~found

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _manhattan_table()
        held: list[np.ndarray] = []  # the last cell so far: its rows may go on in the next frame
        held_rows, held_key, large = 0, None, False

        def frame(a, b, kind, grid=0, cell=0):
            return pd.DataFrame({"a": np.asarray(a).view(np.int64), "b": np.asarray(b).view(np.int64),
                                 "grid": np.full(len(a), grid, np.int32), "cell": np.full(len(a), cell, np.int64),
                                 "large": np.full(len(a), kind, bool)})

        def close():
            if held_key is None or large:
                return
            fp = np.concatenate(held)
            if len(fp) > 1:
                a, b = _stars(fp, None, max_bits)
                if len(a):
                    yield frame(a, b, False)

        for f in frames:
            if not len(f):
                continue
            grid, cell = f["grid"].to_numpy(), f["cell"].to_numpy()
            fp = f["fp"].to_numpy().view(np.uint64)
            new = np.ones(len(f), bool)
            new[1:] = (grid[1:] != grid[:-1]) | (cell[1:] != cell[:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(f))
            # first and last cell of a frame go through `held`, those between are whole
            edge = {0, len(begin) - 1}
            inner = np.ones(len(begin), bool)
            inner[list(edge)] = False
            sizes = end - begin
            small = inner & (sizes <= PAIRS)
            pairs_a, pairs_b = [], []
            for d in range(1, PAIRS):
                runs = np.flatnonzero(small & (sizes > d))
                if not len(runs):
                    break
                reach = sizes[runs] - d
                left = np.repeat(begin[runs] - np.concatenate(([0], np.cumsum(reach)[:-1])), reach) + np.arange(reach.sum())
                ea, eb = _embed_np(fp[left]), _embed_np(fp[left + d])
                near = _manhattan(ea, eb, table) <= max_bits
                near &= np.bitwise_count(fp[left] ^ fp[left + d]) <= max_bits
                left, ea, eb = left[near], ea[near], eb[near]
                left = left[first_grid(ea, eb, grid[left])]
                pairs_a.append(fp[left])
                pairs_b.append(fp[left + d])
            if pairs_a:
                yield frame(np.concatenate(pairs_a), np.concatenate(pairs_b), False)
            for r in np.flatnonzero(inner & (sizes > PAIRS)):
                one = fp[begin[r]:end[r]]
                if len(one) > CELL:
                    yield frame(one, one, True, grid[begin[r]], cell[begin[r]])
                else:
                    a, b = _stars(one, None, max_bits)
                    if len(a):
                        yield frame(a, b, False)
            for r in sorted(edge):
                key, one = (grid[begin[r]], cell[begin[r]]), fp[begin[r]:end[r]]
                if key != held_key:
                    yield from close()
                    held, held_rows, held_key, large = [], 0, key, False
                held_rows += len(one)
                if large:
                    yield frame(one, one, True, *key)
                elif held_rows > CELL:
                    large = True
                    every = np.concatenate([*held, one])
                    held = []
                    yield frame(every, every, True, *key)
                else:
                    held.append(one)
        yield from close()

    return run


def _block_links(large: DataFrame, max_bits: int) -> DataFrame:
    """Links inside oversized cells: every pair of blocks is one group of at most about 2 x CELL rows."""
    sizes = large.groupBy("grid", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL / 2)).cast("int").alias("n"))
    rows = (large.join(sizes, ["grid", "cell"])
            .withColumn("block", F.pmod(F.xxhash64("a", F.lit(5)), F.col("n")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("grid", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", F.col("a").alias("fp")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        if i == j:
            a, b = _stars(fp, None, max_bits)
        else:
            a, b = _stars(fp[pdf["block"] == i], fp[pdf["block"] == j], max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return rows.groupBy("grid", "cell", "i", "j").applyInPandas(run, "a bigint, b bigint")


def links(fps: DataFrame, max_bits: int = 4, bands: int = 8) -> DataFrame:
    """Links (a, b) whose transitive closure is that of all pairs at ``max_bits`` or fewer bits.

    ``fps`` has one row per distinct fingerprint in column ``fp``.
    """
    if not 0 <= max_bits < bands <= 32:
        raise ValueError("max_bits must be below bands, and bands at most 32")
    masks = grids(max_bits, bands)
    cells = F.array(*[F.struct(F.lit(g).alias("grid"), F.col("e").bitwiseAND(F.lit(_signed(m))).alias("cell"))
                      for g, m in enumerate(masks)])
    # (cells are 64-bit: their shuffle partition count follows the session)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (fps.select("fp", embed(F.col("fp")).alias("e")).select("fp", F.explode(cells).alias("c"))
            .select("c.grid", "c.cell", "fp").repartition(n, "grid", "cell").sortWithinPartitions("grid", "cell"))
    found = materialise(rows.mapInPandas(_cells(max_bits, masks),
                                         "a bigint, b bigint, grid int, cell bigint, large boolean"))
    out = found.where(~F.col("large")).select("a", "b")
    large = found.where("large").select("grid", "cell", "a")
    if not large.isEmpty():
        out = out.unionByName(_block_links(large, max_bits))
    return out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots: the smallest node of each component.

    Alternating large-star and small-star steps; each step sends a node's
    neighbours to the smallest of them, so edges never multiply.
    """

    def star(directed: DataFrame, rows: int) -> DataFrame:
        least = directed.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        return join_split(directed, least, "u", rows)

    def digest(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = materialise(edges)
    mark = digest(now)
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (star(both, 2 * mark[0]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        # a large-star step leaves edges to a smaller node, as the small-star step wants them
        small = star(large, 2 * mark[0])
        both_ends = small.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                                                   F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = materialise(both_ends.select("e.a", "e.b").where("a != b").distinct())
        if (seen := digest(after)) == mark:
            break
        now, mark = after, seen
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _rooted(prints: DataFrame, max_bits: int, bands: int) -> DataFrame:
    """``prints`` (id, fp, ...) with the root fingerprint and smallest id of each component."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct.select("fp"), max_bits, bands))
    member = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    told = join_split(member, named, "root", distinct.count()).select("fp", "root", "component_id")
    return prints.join(told, "fp")


def cluster(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4, max_bits: int = 4,
            bands: int = 8) -> DataFrame:
    """(``id_col``, fingerprint bigint, component_id) for every row of ``docs``."""
    prints = materialise(docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text), k).alias("fp")))
    return _rooted(prints, max_bits, bands).select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4, max_bits: int = 4,
                bands: int = 8) -> DataFrame:
    """One row of each component: its smallest id (nulls last), equal ids by a hash of the text, equal rows once."""
    mark = F.xxhash64(F.col(text), F.lit(11))
    prints = materialise(docs.select(F.col(id_col).alias("id"), mark.alias("mark"), fingerprints(F.col(text), k).alias("fp")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first")
    kept = _rooted(prints, max_bits, bands).groupBy("root").agg(first).select("first.id", "first.mark")
    copies = prints.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m"))
    kept = copies.join(kept.select(F.col("id").alias("i"), F.col("mark").alias("m")), same, "left_semi")
    kept = materialise(kept.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("copies").alias("__copies")))
    rows = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (mark == F.col("__mark")))
    once = rows.where("__copies = 1").select(*docs.columns)
    if kept.where("__copies > 1").isEmpty():
        return once
    repeated = rows.where("__copies > 1").dropDuplicates(["__id", "__mark"]).select(*docs.columns)
    return once.unionByName(repeated)
