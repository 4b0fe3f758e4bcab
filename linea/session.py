"""Spark session helpers.

Library code never creates its own session on a cluster; these helpers are for
tests, ``bench.py`` and command-line use. ``ensure_checkpoint_dir`` reads the
shared folder the cluster configures. Without one it raises, except on a
single-machine master (``local``, ``local[...]``), where a scratch folder is
as good: on a cluster each machine would write to its own disk.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints whose frame is gone are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Model tables (merges, dictionaries, truecase maps) are broadcast only
    # behind an explicit size check; keep Spark's own threshold modest.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "linea", memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; a scratch one is set only if unset and the master is local.

    Also ships this package's functions by value, so that executors need not
    have it installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules["linea"])
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share: "
                           f"master {sc.master} has no checkpoint folder")
    path = tempfile.mkdtemp(prefix="linea-ckpt-", dir=os.environ.get("LINEA_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path
