"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linea.session import ensure_checkpoint_dir

#: White space of the size and shingle contracts: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, with at least as many scan tasks as cores.

    The file system is left to Spark (any URI works). Spreading reads is left
    out for inputs that already split.
    """
    ensure_checkpoint_dir(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    target = spark.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Catalyst inlines a projected array into a lambda that mentions it, which
    would evaluate it for every element; a lambda variable is bound once.
    """
    return F.transform(F.array(value), body).getItem(0)


def remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Keys with more than this part of all rows are hot: there are at most as many.
HOT = 10_000


def join_split(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which holds each key of them once with its number of rows, ``n``.

    ``total`` is the number of rows, or more. Rows of keys with more than
    1/``HOT`` of that meet their broadcast part of ``table`` (at most ``HOT``
    rows) where they lie; only the others are shuffled by key.
    """
    hot = F.broadcast(table.where(F.col("n") > total / HOT))
    rest = rows.join(hot.select(key), key, "left_anti").join(table.where(F.col("n") <= total / HOT), key)
    return rows.join(hot, key).unionByName(rest).drop("n")
