"""Stage tables with a manifest: built once, resumed after a failure, rebuilt when an input changed.

A stage's data is written beside what is there; then one marker is created that
names it, with the fingerprint of all it was made from. Readers follow the
newest whole marker, so a writer that dies midway leaves the old stage. A stage
whose fingerprint is the marker's is read, not computed.

Stages may be bucketed and sorted by their line keys: sides and steps bound by
those keys then meet without a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Stage(NamedTuple):
    name: str
    fingerprint: str
    frame: DataFrame


def fingerprint(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def content_fingerprints(df: DataFrame, keys: list[str]) -> dict[tuple, str]:
    """A fingerprint of the rows of each group of ``keys`` (few groups), whatever their order: one aggregation."""
    row = F.xxhash64(*[c for c in df.columns if c not in keys])
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).collect()
    return {tuple(r[k] for k in keys): fingerprint(r["n"], str(r["s"]), r["x"]) for r in rows}


class Stages:
    """Stages below a shared folder. ``built`` lists what was computed here."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.built: list[str] = []
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def _markers(self, name: str) -> list[tuple[int, str]]:
        """(number, path) of the stage's markers, newest first."""
        fs, p = self._fs(f"{self.folder}/{name}/markers")
        if not fs.exists(p):
            return []
        paths = [f.getPath() for f in fs.listStatus(p)]
        return sorted(((int(x.getName().split(".")[0]), x.toString()) for x in paths if x.getName().endswith(".json")), reverse=True)

    def _newest(self, name: str) -> dict | None:
        """The newest marker that is whole."""
        for _, path in self._markers(name):
            try:
                return json.loads("\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect()))
            except json.JSONDecodeError:  # its writer died
                continue
        return None

    def _commit(self, name: str, told: dict) -> None:
        """Create the next marker; a number that another writer took first raises."""
        number = max([n for n, _ in self._markers(name)], default=-1) + 1
        fs, p = self._fs(f"{self.folder}/{name}/markers/{number:08d}.json")
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()

    def _read(self, told: dict) -> DataFrame:
        if not told["bucket_by"]:
            return self.spark.read.schema(StructType.fromJson(told["schema"])).parquet(told["path"])
        table = f"stage_{told['id']}"
        if not self.spark.catalog.tableExists(table):
            columns = StructType.fromJson(told["schema"]).toDDL()
            keys = ", ".join(f"`{k}`" for k in told["bucket_by"])
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                           f"INTO {told['buckets']} BUCKETS LOCATION '{told['path']}'")
        return self.spark.table(table)

    def read(self, name: str) -> DataFrame:
        """The stage as its newest marker tells."""
        told = self._newest(name)
        if told is None:
            raise FileNotFoundError(f"no stage {name} below {self.folder}")
        return self._read(told)

    def write(self, name: str, df: DataFrame, made_from: str = "", bucket_by: tuple[str, ...] = (), buckets: int | None = None) -> Stage:
        """Write beside, then switch by one marker."""
        ident = uuid.uuid4().hex
        path = f"{self.folder}/{name}/data-{ident}"
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        if bucket_by:
            (df.repartition(buckets, *bucket_by).write.format("parquet").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
             .option("path", path).saveAsTable(f"stage_{ident}"))
            schema = self.spark.table(f"stage_{ident}").schema
        else:
            df.write.parquet(path)
            schema = df.schema
        told = {"id": ident, "path": path, "made_from": made_from, "bucket_by": list(bucket_by), "buckets": buckets,
                "schema": json.loads(schema.json())}
        self._commit(name, told)
        self.built.append(name)
        return Stage(name, made_from, self._read(told))

    def stage(self, name: str, inputs: list, build: Callable[[], DataFrame], bucket_by: tuple[str, ...] = (),
              buckets: int | None = None, once: bool = False) -> Stage:
        """The stage made from ``inputs`` (stages or other values): read if its marker names the same, else built.

        ``once``: what is there stays, whatever it was made from (codes that later steps reuse).
        """
        made_from = fingerprint(name, bucket_by, [i.fingerprint if isinstance(i, Stage) else i for i in inputs])
        told = self._newest(name)
        if told is not None and (once or told["made_from"] == made_from):
            return Stage(name, told["made_from"], self._read(told))
        return self.write(name, build(), made_from, bucket_by, buckets)

    def clean(self, name: str) -> None:
        """Remove the stage's data and markers that its newest marker has replaced (no reader may still use them)."""
        told = self._newest(name)
        if told is None:
            return
        fs, p = self._fs(f"{self.folder}/{name}")
        for f in fs.listStatus(p):
            own = f.getPath().getName()
            if own.startswith("data-") and own != f"data-{told['id']}":
                self.spark.sql(f"DROP TABLE IF EXISTS stage_{own[len('data-'):]}")
                fs.delete(f.getPath(), True)
        for _, path in self._markers(name)[1:]:
            fs.delete(self._fs(path)[1], False)
