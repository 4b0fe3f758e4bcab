"""Sinks: ordered text files, stage tables, appended result logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["model", "checkpoint", "split", "direction", "metric", "value"]


def write_lines(df: DataFrame, path: str, order: str = "line_no", text: str = "text",
                partitions: int | None = None) -> None:
    """One line per row, part files in ``order`` (range-partitioned, sorted)."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    (df.repartitionByRange(n, order).sortWithinPartitions(order)
       .select(text).write.mode("overwrite").option("lineSep", "\n").text(path))


def save_stage(df: DataFrame, path: str, partition_by=("split", "lang")) -> None:
    """Stage directory replaced on each run, partitioned for pruning."""
    cols = [c for c in partition_by if c in df.columns]
    w = df.write.mode("overwrite")
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)


def append_result(df: DataFrame, path: str, run: str | None = None) -> None:
    """Append metric rows ``model, checkpoint, split, direction, metric, value``.

    With ``run`` the rows are keyed by it: a rerun replaces its own rows and
    adds nothing twice (the log is then partitioned by ``run``; keep to one way
    for one log).
    """
    missing = [c for c in RESULT_COLS if c not in df.columns]
    out = df
    for c in missing:
        out = out.withColumn(c, F.lit(None).cast("string"))
    out = out.select(*[F.col(c).cast("double" if c == "value" else "string") for c in RESULT_COLS])
    if run is None:
        out.write.mode("append").parquet(path)
    else:
        (out.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run").parquet(path))
