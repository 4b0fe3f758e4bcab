"""Line deduplication over levelled sorted runs of line hashes.

A line's key is its text without white space at both ends, A-Z lower-cased; its
hash has 128 bits. :class:`LineRuns` holds what has been seen as runs: tables of
(key, docs, keeper), one row a key, bucketed and sorted by key in the shared
folder. Documents come in batches, largest ids first. A batch's own keys are
counted, merge-anti-joined with every run (a key that no run holds gets the
batch's largest document as its keeper; the others have their keeper already)
and added as a run of level 0. Two runs of a level are compacted to one of the
next by a merging full join, so n batches leave at most log2(n) + 1 runs, and
each key is rewritten as often at most. Runs share their buckets, so neither
join shuffles them.

Keys of at least ``min_chars`` code points in at least ``min_docs`` documents
then lose all their lines outside their keeper. Occurrences (key, document) are
written once and met with these keys: keys with more than 1/``HOT`` of all
occurrences are broadcast (at most ``HOT`` of them can exist), so none of their
occurrences is shuffled by key; the others meet in a sorted join.

Edge cases: null or empty text is one empty line. Rows with one id are one
document: their keys count once, and all of them keep the keeper's lines. Rows
without an id are one document, before all others. Lines repeated within a
document are kept or dropped together. Very long texts are handled whole, an
empty table gives an empty result. Other columns pass through, except those
named like the added ones, which are replaced.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linea.llm.common import materialise
from linea.session import ensure_checkpoint_dir

#: Keys with more than this part of all occurrences are hot: there are at most as many.
HOT = 10_000
#: Documents for each bucket of a run.
BUCKET_DOCS = 1_000_000
NO_ID = -(1 << 63)
#: Rows of a batch that are Python objects at a time.
SLICE = 512


def line_key(line: bytes) -> bytes:
    """The line without space and \\x09-\\x0D at both ends, A-Z lower-cased (what bytes methods do)."""
    return line.strip().lower()


def hashed(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars


def occurrences(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """(key, doc): hashes of the long lines of each row, once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                keys, places = [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    found = {k for line in t.split(b"\n") if long_enough(k := line_key(line), min_chars)}
                    keys += map(hashed, found)
                    places += [i] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part.column(0).take(pa.array(places, pa.int64()))], ["key", "doc"])

    return (docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("t"))
            .mapInArrow(run, "key binary, doc bigint"))


class LineRuns:
    """Runs (key, docs, keeper) in levels: ``levels[i]`` holds at most one run between batches."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        """``rows`` (one a key, already dealt by key into as many partitions as buckets) as a run."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.select("key", "docs", "keeper").write.format("parquet").bucketBy(self.buckets, "key").sortBy("key")
         .option("path", f"{self.folder}/{name}").saveAsTable(name))
        self.written += 1
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one; a key has its keeper in one of them at most."""
        docs = F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))
        return (a.alias("a").join(b.alias("b").hint("merge"), F.col("a.key") == F.col("b.key"), "full_outer")
                .select(F.coalesce("a.key", "b.key").alias("key"), docs.alias("docs"), F.coalesce("a.keeper", "b.keeper").alias("keeper")))

    def add(self, batch: DataFrame) -> None:
        """Count the keys of a batch of occurrences (key, doc) and add them; call with falling documents."""
        own = batch.groupBy("key").agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("last")).repartition(self.buckets, "key")
        for i, name in enumerate(n for level in self.levels for n in level):
            own = own.join(self.spark.table(name).select("key", F.lit(True).alias(f"in{i}")).hint("merge"), "key", "left")
        seen = [F.col(c) for c in own.columns if c.startswith("in")]
        unseen = F.coalesce(*seen).isNull() if seen else F.lit(True)
        self._write(own.withColumn("keeper", F.when(unseen, F.col("last"))), 0)
        self.compact()

    def compact(self, whole: bool = False) -> None:
        """Two runs of a level become one of the next; ``whole``: all runs become one."""
        level = 0
        while level < len(self.levels):
            names = self.levels[level]
            if whole and names and any(self.levels[level + 1:]):
                names.append(next(above for above in self.levels[level + 1:] if above).pop())
            if len(names) > 1:
                a, b = names
                self.levels[level] = []
                self._write(self._merged(self.spark.table(a), self.spark.table(b)), level + 1)
                self._drop(a)
                self._drop(b)
            level += 1

    def table(self) -> DataFrame:
        """All keys, after a whole compaction."""
        self.compact(whole=True)
        return self.spark.table(next(n for level in self.levels for n in level))

    def close(self) -> None:
        for level in self.levels:
            while level:
                self._drop(level.pop())


def in_batches(docs: DataFrame, id_col: str, batches: int) -> list[float]:
    """Falling bounds that cut the ids into ``batches`` parts of about the same size."""
    parts = [i / batches for i in range(1, batches)]
    return sorted(set(docs.select(F.col(id_col).cast("double")).approxQuantile(id_col, parts, 0.01)), reverse=True) if parts else []


def repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5,
             batches: int = 4) -> tuple[DataFrame, DataFrame]:
    """(keys, drops): the keys (key, docs, keeper) to drop outside their keeper, and (doc, key) that lose lines."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
    bounds = in_batches(docs, id_col, batches)
    number = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        number = F.when(F.col("doc") > bounds[i], i).otherwise(number)
    occurrences(docs, id_col, text, min_chars).withColumn("batch", number).write.partitionBy("batch").parquet(f"{folder}/occurrences")
    held = spark.read.schema("key binary, doc bigint, batch int").parquet(f"{folder}/occurrences")
    runs = LineRuns(spark, folder, max(spark.sparkContext.defaultParallelism, docs.count() // BUCKET_DOCS))
    for i in range(len(bounds) + 1):
        runs.add(held.where(F.col("batch") == i).select("key", "doc"))
    keys = materialise(runs.table().where(F.col("docs") >= min_docs))
    runs.close()
    pairs = held.select("key", "doc")
    hot = F.broadcast(keys.where(F.col("docs") > pairs.count() / HOT))
    rest = pairs.join(hot.select("key"), "key", "left_anti").join(keys.hint("merge"), "key")
    drops = pairs.join(hot, "key").unionByName(rest).where(F.col("doc") != F.col("keeper"))
    return keys, drops.select("doc", "key").distinct()


ADDED = "n_lines bigint, n_dropped bigint, kept string"


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5,
                  batches: int = 4) -> DataFrame:
    """``docs`` without its text, with n_lines, n_dropped and the kept lines."""
    _, drops = repeated(docs, id_col, text, min_chars, min_docs, batches)
    lost = drops.groupBy("doc").agg(F.collect_list("key").alias("__lost"))  # at most the document's lines
    added = StructType.fromDDL(ADDED)
    rest = [c for c in docs.columns if c != text and c not in added.names]
    schema = StructType([docs.schema[c] for c in rest] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lines, dropped, kept = [], [], []
                for t, gone in zip(part.column(len(rest)).to_pylist(), part.column(len(rest) + 1).to_pylist(), strict=True):
                    split = t.split(b"\n")
                    lines.append(len(split))
                    if gone:
                        out = set(gone)
                        left = [x for x in split if not (long_enough(k := line_key(x), min_chars) and hashed(k) in out)]
                        dropped.append(len(split) - len(left))
                        t = b"\n".join(left)
                    else:
                        dropped.append(0)
                    kept.append(t)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(rest)], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], schema.names)

    rows = docs.select(*rest, F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("__text"),
                       F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("__doc"))
    met = rows.join(lost.withColumnRenamed("doc", "__doc"), "__doc", "left")
    return met.select(*rest, "__text", "__lost").mapInArrow(run, schema)
