"""Approximate nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

Vectors are dealt to classes of length (a factor of 2 wide). A class is scaled
by its own longest vector and given one more coordinate that makes all lengths
1, so that the largest inner product of a class is the least distance, and a
long vector leaves the others where they are. A class of at most ``SMALL``
vectors is not hashed: every query meets all of it. ``tables`` hash functions of ``projections`` Gaussian (2-stable)
projections, cut into slots of ``width``, deal every vector to one bucket a
table and class. A query visits, in each table, its own bucket and the ``probes`` - 1
perturbed ones most likely to hold its neighbours: perturbations move
projections by one slot, and are tried in order of the summed squares of the
distances to the slots' borders, in every class. Candidates of all tables are scored exactly
on the original vectors in double precision, and merged. Queries that hold
fewer than ``k`` candidates then visit ``WIDEN`` times as many buckets, and at
last meet every vector.

Every vector is indexed. A bucket of more than ``BLOCK`` vectors, or visited
by more than ``BLOCK`` queries, is cut into blocks by hash; every pair of a
block of vectors and one of queries is a group of its own, so no group grows
with a hot bucket and none is capped. A group yields each query's best ``k``.

Edge cases: vectors that are null, empty, zero, of another length than most,
or that hold null or non-finite components take no part, neither as queries
nor as candidates. Ties go to the smaller id. A repeated id is a candidate
for each of its rows; one row per (query, id) is returned, with its best
score. Fewer than ``k`` other vectors: all of them. Empty tables give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linea.llm.common import materialise

#: Most vectors, and most queries, that one group compares.
BLOCK = 4096
#: Most vectors of a class of length that is compared whole.
SMALL = 256
#: How many times as many buckets a query visits that found too little.
WIDEN = 8


class Hashes:
    """Projections of all tables, drawn from one seed; the last input coordinate is the added one.

    ``longest``: length that a vector is scaled by.
    """

    def __init__(self, dim: int, longest: float, tables: int, projections: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((tables, projections, dim + 1))
        self.b = rng.uniform(0, width, (tables, projections))
        self.width, self.longest, self.probes = width, longest, min(probes, 3 ** projections)
        self.moves = np.array(list(product((0, -1, 1), repeat=projections)))

    def places(self, v: np.ndarray, query: bool, longest: np.ndarray | None = None) -> np.ndarray:
        """Slot coordinates (rows, tables, projections) as fractions; ``longest`` of each row's class, else one for all."""
        size = np.sqrt((v * v).sum(axis=1))
        if query:
            x, rest = v / size[:, None], np.zeros(len(v))
        else:
            longest = np.full(len(v), self.longest) if longest is None else longest
            x = v / longest[:, None]
            rest = np.sqrt(np.maximum(0.0, 1 - (size / longest) ** 2))
        wide = np.hstack([x, rest[:, None]])
        return (np.einsum("nd,tpd->ntp", wide, self.a) + self.b) / self.width

    def key(self, slots: np.ndarray) -> np.ndarray:
        """One number of a bucket's slots. Should two buckets share it, they are searched together."""
        out = np.zeros(slots.shape[:-1], dtype=np.int64)
        for p in range(slots.shape[-1]):
            out = out * np.int64(1023) + slots[..., p].astype(np.int64)
        return out

    def visits(self, v: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Bucket keys (rows, tables, probes) in estimated order of success, or those from ``start`` to ``stop``."""
        at = self.places(v, query=True)
        slot = np.floor(at)
        low = at - slot
        cost = np.where(self.moves == -1, low[..., None, :] ** 2, np.where(self.moves == 1, (1 - low[..., None, :]) ** 2, 0.0))
        order = np.argsort(cost.sum(axis=-1), axis=-1, kind="stable")[..., start:self.probes if stop is None else stop]
        return self.key(slot[..., None, :] + self.moves[order])


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("v") == (most[0]["d"] if most else 0))


def _hashed(rows: DataFrame, keys) -> DataFrame:
    """(t, c, bucket, id, v binary): a row for each table, or for each visit of a query (``keys`` of a batch)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 256):
                part = f.iloc[at:at + 256]
                v = np.stack(part["v"].to_numpy())
                found = keys(v, part["c"].to_numpy())
                n, tables, each = found.shape
                raw = np.array([x.tobytes() for x in v], dtype=object)
                yield pd.DataFrame({"t": np.tile(np.repeat(np.arange(tables, dtype=np.int32), each), n),
                                    "c": np.repeat(part["c"].to_numpy(), tables * each), "bucket": found.reshape(-1),
                                    "id": np.repeat(part["id"].to_numpy(), tables * each), "v": np.repeat(raw, tables * each)})

    return rows.mapInPandas(run, "t int, c int, bucket bigint, id bigint, v binary")


def _whole(rows: DataFrame) -> DataFrame:
    """The same columns: all rows in one bucket of no table."""
    raw = F.pandas_udf(lambda s: s.map(lambda x: x.astype(np.float64).tobytes()), "binary")
    return rows.select(F.lit(-1).alias("t"), F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("bucket"),
                       F.col("id").cast("bigint").alias("id"), raw("v").alias("v"))


def best(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` largest inner products among ``v``, ties to the smaller id, without itself."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    repeated, ids = len(starts) < len(ids), ids[starts]
    out = []
    for at in range(0, len(q), 256):
        # one fixed order of summation for every pair: equal vectors score equal wherever they are compared
        score = np.einsum("qd,nd->qn", q[at:at + 256], v)
        if repeated:
            score = np.maximum.reduceat(score, starts, axis=1)
        score[query_ids[at:at + 256, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            edge = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            edge = np.full(len(score), -np.inf)
        row, col = np.nonzero((score >= edge[:, None]) & (score > -np.inf))
        s = score[row, col]
        sort = np.lexsort((ids[col], -s, row))
        row, col, s = row[sort], col[sort], s[sort]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, int)
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        keep = place < k
        out.append(pd.DataFrame({"query_id": query_ids[at:at + 256][row[keep]], "vec_id": ids[col[keep]], "score": s[keep]}))
    return pd.concat(out)


def _compared(vectors: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best of each group of the buckets that queries visit."""
    def blocks(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))).cast("int").alias(name))

    # a visit goes to the bucket of every class
    visits = visits.drop("c")
    sizes = blocks(vectors, ["t", "c", "bucket"], "nv").join(blocks(visits, ["t", "bucket"], "nq"), ["t", "bucket"])
    own = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = vectors.join(sizes, ["t", "c", "bucket"]).withColumn("i", own("nv", 1)).withColumn("j", every("nq"))
    right = visits.join(sizes, ["t", "bucket"]).withColumn("j", own("nq", 2)).withColumn("i", every("nv"))
    both = left.select("t", "c", "bucket", "i", "j", "id", "v", F.lit(False).alias("q")).unionByName(
        right.select("t", "c", "bucket", "i", "j", "id", "v", F.lit(True).alias("q")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        v = np.frombuffer(b"".join(group["v"]), dtype=np.float64).reshape(len(group), -1)
        q, ids = group["q"].to_numpy(), group["id"].to_numpy()
        if not q.any() or q.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return best(ids[q], v[q], ids[~q], v[~q], k)

    return both.groupBy("t", "c", "bucket", "i", "j").applyInPandas(run, "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best; a vector found in several tables, or in several rows, takes one place."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 20,
           tables: int = 5, projections: int = 6, width: float = 2.0, probes: int = 80, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found among ``rows``, never itself."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    # borders between powers of 2, so that unit vectors share a class
    index = usable(rows, id_col, vector).withColumn("length", length).withColumn(
        "c", F.coalesce(F.floor(F.log2("length") + 0.5), F.lit(-9999)).cast("int"))
    classes = index.groupBy("c").agg(F.max(F.size("v")).alias("dim"), F.max("length").alias("longest"),
                                     F.count(F.lit(1)).alias("n")).collect()  # a row per class of length
    dim = max((r["dim"] for r in classes), default=1)
    longest = {r["c"]: r["longest"] or 1.0 for r in classes if r["n"] > SMALL}
    hashes = Hashes(dim, 1.0, tables, projections, width, probes, seed)
    asked = usable(queries, id_col, vector).where(F.size("v") == dim).withColumn("c", F.lit(0))
    hashed = F.col("c").isin(list(longest))

    def bucket(v: np.ndarray, c: np.ndarray) -> np.ndarray:
        return hashes.key(np.floor(hashes.places(v, False, np.array([longest[x] for x in c]))))[..., None]

    def meet(who: DataFrame, start: int, stop: int) -> DataFrame:
        return _compared(vectors, materialise(_hashed(who, lambda v, c: hashes.visits(v, start, stop))), k)

    found = _compared(_whole(index.where(~hashed)), _whole(asked), k)
    if not longest:
        return _ranked(found, k)
    vectors = materialise(_hashed(index.where(hashed).select("id", "v", "c"), bucket))
    got = materialise(_ranked(found.unionByName(meet(asked, 0, hashes.probes)), k))
    end = min(len(hashes.moves), WIDEN * hashes.probes)
    for wider in (lambda who: meet(who, hashes.probes, end), lambda who: _compared(_whole(index), _whole(who), k)):
        enough = got.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        hungry = materialise(asked.join(enough, asked["id"] == enough["query_id"], "left_anti"))
        if hungry.isEmpty():
            break
        got = materialise(_ranked(got.drop("rank").unionByName(wider(hungry)), k))
    return got
