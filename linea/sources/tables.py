"""Access to the driver's parquet tables (one file per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan whose rows lie in fewer tasks than the cluster has cores.

    A row group is read by one task, however many byte ranges its file is cut
    into, which would leave every row-local step before the first shuffle
    serial. So the rows of each partition are counted (no column is read: the
    counts are in the files' footers), and a scan is dealt anew if it has fewer
    partitions than cores or one holds more than twice its share. Large inputs
    of many files or row groups pass through unchanged. Round-robin
    repartitioning is deterministic on retry (rows are sorted before
    distribution), so a lost executor recomputes the same partitions.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts < target:
        return df.repartition(target)
    if parts < MANY * target:
        held = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        most, rows = held.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) * target > 2 * (rows or 0):
            return df.repartition(4 * target)
    return df


#: Partitions a core from which a scan counts as spread.
MANY = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return ensure_parallelism(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
