"""Positional identity: dense 0-based line numbers without a global window.

Every multi-file operator of the reference zips files by line position, so a
stable, dense ``line_no`` is assigned once and carried as an ordinary column.
``row_number() OVER (ORDER BY k)`` would pull the whole corpus into one task;
instead the key range is cut into quantile buckets (a deterministic function
of the key), rows are numbered inside their bucket, and a tiny table of
per-bucket offsets (one row per bucket, so its size is bounded by the bucket
count, not by the data) is broadcast back.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _bucket_count(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, n)


def dense_index(df: DataFrame, key: str, out: str = "line_no",
                buckets: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of the unique numeric ``key``.

    Equals ``row_number() OVER (ORDER BY key) - 1``.
    """
    nb = buckets or _bucket_count(df)
    probs = [i / nb for i in range(1, nb)]
    bounds = sorted(set(df.approxQuantile(key, probs, 0.001))) if probs else []
    splits = [float("-inf")] + [float(b) for b in bounds] + [float("inf")]
    kd = f"__{out}_kd"
    bk = f"__{out}_bucket"
    bucketed = Bucketizer(splits=splits, inputCol=kd, outputCol=bk, handleInvalid="keep") \
        .transform(df.withColumn(kd, F.col(key).cast("double"))).drop(kd)
    offsets = (bucketed.groupBy(bk).agg(F.count(F.lit(1)).alias("__cnt"))
               .withColumn("__off", F.sum("__cnt").over(
                   Window.orderBy(bk).rowsBetween(Window.unboundedPreceding, -1)))
               .select(bk, F.coalesce("__off", F.lit(0)).alias("__off")))
    w = Window.partitionBy(bk).orderBy(F.col(key))
    return (bucketed.withColumn("__rn", F.row_number().over(w))
            .join(F.broadcast(offsets), bk)
            .withColumn(out, (F.col("__off") + F.col("__rn") - 1).cast("bigint"))
            .drop(bk, "__rn", "__off"))


def require_same_count(a: DataFrame, b: DataFrame, what: str = "inputs") -> int:
    """Strict size check used by all zip-by-position operators."""
    na, nb = a.count(), b.count()
    if na != nb:
        raise ValueError(f"{what}: line counts differ ({na} vs {nb})")
    return na


def ordered_index(df: DataFrame, order: list, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``order`` (any sort keys).

    The frame is range-partitioned and sorted, then written to the session's
    checkpoint folder so its partitioning is fixed; a row's position is its
    offset inside its partition (from ``monotonically_increasing_id``) plus the
    sizes of the earlier partitions (one row per partition, broadcast).
    """
    n = partitions or _bucket_count(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    t = ranged.select("*", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid"))
    sizes = (t.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__m0"))
             .withColumn("__off", F.coalesce(F.sum("__cnt").over(
                 Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select("__pid", "__m0", "__off"))
    return (t.join(F.broadcast(sizes), "__pid")
            .withColumn(out, (F.col("__off") + F.col("__mid") - F.col("__m0")).cast("bigint"))
            .drop("__pid", "__mid", "__m0", "__off"))


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                broadcast_rows: int = 2_000_000, broadcast_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Join a model table (vocabulary, dictionary) into a token stream.

    The model is broadcast only after its row count and the bytes of its values
    are checked against ``broadcast_rows`` and ``broadcast_bytes``; beyond that the join shuffles on the key and AQE's skew
    handling splits hot keys (frequent words) of the token side. The model is
    materialised once (checkpoint) so that the size check and the join do not
    both recompute it.
    """
    small = small.checkpoint(eager=True)
    size = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in small.columns)
    rows, used = small.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    if rows <= broadcast_rows and (used or 0) <= broadcast_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
