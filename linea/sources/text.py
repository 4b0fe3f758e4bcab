"""Line-oriented sources: corpus files, parallel binding, references, decoder logs.

``read_lines`` assigns the stable 0-based ``line_no`` that every positional
operator keys on. It needs no shuffle of the text: rows of one file split are
contiguous inside one scan partition, so within a split
``monotonically_increasing_id()`` is consecutive and
``line_no = mid - min(mid of the split) + rows in earlier splits of the file``.
The per-split table has one row per file split, so broadcasting it is bounded
by the number of splits, never by the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linea.operators.positional import require_same_count

# File-name convention for splits (raw name -> split).
SPLIT_NAMES = {"train": "train", "tst2012": "valid", "tst2013": "test"}


def read_lines(spark: SparkSession, paths, corpus: str | None = None, split: str | None = None,
               lang: str | None = None, line_sep: str | None = "\n") -> DataFrame:
    """UTF-8 text lines with a dense 0-based ``line_no`` per file.

    Several paths are numbered consecutively in the given order.
    ``line_sep='\\n'`` breaks lines on LF only (``\\r`` stays in the text).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    raw = reader.text(paths).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("__f"),
        F.col("_metadata.file_block_start").alias("__b"),
        F.monotonically_increasing_id().alias("__mid"))
    order = F.create_map(*[x for i, p in enumerate(paths) for x in (F.lit(_norm_path(p)), F.lit(i))])
    blocks = (raw.groupBy("__f", "__b").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
              .withColumn("__fo", F.coalesce(order[F.regexp_replace("__f", "^file:", "")], F.lit(0)))
              .withColumn("__off", F.coalesce(F.sum("__n").over(
                  Window.orderBy("__fo", "__f", "__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("__f", "__b", "__m0", "__off"))
    out = (raw.join(F.broadcast(blocks), ["__f", "__b"])
           .select((F.col("__mid") - F.col("__m0") + F.col("__off")).cast("bigint").alias("line_no"), "text"))
    for name, val in (("lang", lang), ("split", split), ("corpus", corpus)):
        if val is not None:
            out = out.select(F.lit(val).alias(name), *out.columns)
    return out


def _statuses(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path as Spark tells it, bytes, time of change) of each file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        s = p.getFileSystem(conf).getFileStatus(p)
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return out


INDEX = "file string, bytes bigint, modified bigint, lines bigint"


def line_counts(spark: SparkSession, paths: list[str], index: str) -> list[tuple[str, int]]:
    """(file, lines) of each path in order; files that ``index`` does not know as they are now are counted and added to it."""
    now = _statuses(spark, paths)
    known = {}
    if _exists(spark, index):
        names = [f for f, _, _ in now]
        rows = spark.read.schema(INDEX).parquet(index).where(F.col("file").isin(names)).collect()  # a row for each file asked for
        known = {(r["file"], r["bytes"], r["modified"]): r["lines"] for r in rows}
    new = [(p, s) for p, s in zip(paths, now, strict=True) if s not in known]
    if new:
        raw = spark.read.option("lineSep", "\n").text([p for p, _ in new])
        counted = dict(raw.groupBy(_local(F.col("_metadata.file_path"))).count().collect())
        fresh = {s: counted.get(_plain_path(s[0]), 0) for _, s in new}
        spark.createDataFrame([(*s, n) for s, n in fresh.items()], INDEX).coalesce(1).write.mode("append").parquet(index)
        known |= fresh
    return [(s[0], known[s]) for s in now]


def _plain_path(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _local(path):
    """A file's name without the scheme of local files, as :func:`_plain_path`."""
    return F.regexp_replace(path, "^file:/+", "/")


def read_whole_files(spark: SparkSession, paths, index: str) -> DataFrame:
    """S1 for files that are not split (gz and the like): ``line_no, text`` in one read of each.

    ``index`` is a table of line counts kept beside the files: with the counts
    known, a file's lines are numbered while they are read, in the one task
    that reads it. Files are numbered consecutively in the given order.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    whole = (".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")
    if split := [p for p in paths if not p.endswith(whole)]:
        raise ValueError(f"files that Spark may split: {split}")
    begin, at = {}, 0
    for file, lines in line_counts(spark, paths, index):
        begin[_plain_path(file)] = at
        at += lines

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            told = batch.column(0).dictionary_encode()
            codes, numbers = told.indices.to_numpy(), np.empty(batch.num_rows, np.int64)
            for code, file in enumerate(told.dictionary.to_pylist()):
                here = np.flatnonzero(codes == code)
                start = seen.get(file, begin[file])
                numbers[here] = start + np.arange(len(here))
                seen[file] = start + len(here)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), batch.column(1)], ["line_no", "text"])

    raw = spark.read.option("lineSep", "\n").text(paths).select(_local(F.col("_metadata.file_path")).alias("f"), "value")
    return raw.mapInArrow(number, "line_no bigint, text string")


def _norm_path(p: str) -> str:
    p = p[len("file:"):] if p.startswith("file:") else p
    return p if p.startswith("/") or "://" in p else __import__("os").path.abspath(p)


def read_parallel(sides: dict[str, DataFrame], strict: bool = True, key: str = "line_no") -> DataFrame:
    """Bind N line tables by position; one column per role.

    ``strict`` checks that all sides have the same number of lines (the
    reference's size check) and raises otherwise.
    """
    roles = list(sides)
    first = sides[roles[0]]
    if strict:
        for r in roles[1:]:
            require_same_count(first, sides[r], f"{roles[0]} vs {r}")
    out = first.select(key, F.col("text").alias(roles[0]))
    for r in roles[1:]:
        out = out.join(sides[r].select(key, F.col("text").alias(r)), key, "full_outer")
    return out


def bind_strict(a: DataFrame, b: DataFrame, on: list[str], what: str) -> DataFrame:
    """Join two sides line by line; a line that only one side has raises (a strict count check by key).

    It raises whatever columns are read. A filter put on the result that such a
    line cannot pass may remove it first.
    """
    j = a.withColumn("__a", F.lit(True)).join(b.withColumn("__b", F.lit(True)), on, "full_outer")
    at = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in on])
    side = F.when(F.col("__a").isNull(), F.lit(" only on the second side at ")).otherwise(F.lit(" only on the first side at "))
    err = F.raise_error(F.concat(F.lit(what + ": line"), side, at)).cast("boolean")
    # a filter: it runs whatever columns are read, or none
    whole = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return j.where(F.when(whole, F.lit(True)).otherwise(err)).drop("__a", "__b")


def group_references(df: DataFrame, line: str = "line_id", ref_id: str = "ref_id",
                     ref: str = "ref", tokenizer=None, carry: dict | None = None) -> DataFrame:
    """S3 (table form): long ``line, ref_id, ref`` -> ``line, refs`` ordered by ref_id.

    One shuffle on ``line``; each group holds the references of one line.
    ``carry`` maps output names to columns that depend only on the line (for
    example the hypothesis), taken along without a second pass or a join.
    """
    tok = tokenizer(F.col(ref)) if tokenizer else F.col(ref)
    extra = [F.max(c).alias(name) for name, c in (carry or {}).items()]
    return (df.groupBy(line)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(ref_id).alias("i"), tok.alias("r")))).alias("__rs"),
                 *extra)
            .select(line, *(carry or {}).keys(), F.transform("__rs", lambda s: s["r"]).alias("refs")))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def reference_paths(spark: SparkSession, stem: str, detok: bool = False, extra=()) -> list[str]:
    """S3: ``stem0, stem1, …`` while they exist, then ``stem``; the detokenised
    variant falls back to ``stem.ref0…`` and appends explicit extra files."""
    if detok and not _exists(spark, stem) and not _exists(spark, stem + "0") and _exists(spark, stem + ".ref0"):
        stem = stem + ".ref"
    out, i = [], 0
    while _exists(spark, f"{stem}{i}"):
        out.append(f"{stem}{i}")
        i += 1
    if _exists(spark, stem):
        out.append(stem)
    out += [p for p in extra if _exists(spark, p)]
    if not out:
        raise FileNotFoundError(f"no reference translations at {stem}")
    return out


def read_references(spark: SparkSession, stem: str, detok: bool = False, extra=()) -> DataFrame:
    """S3: all reference files of a stem as ``line_no, refs`` (gz read natively).

    Files of unequal length raise: every line needs a reference from each file."""
    parts = [read_lines(spark, p).withColumn("ref_id", F.lit(i))
             for i, p in enumerate(reference_paths(spark, stem, detok, extra))]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    grouped = group_references(long, "line_no", "ref_id", "text")
    err = F.raise_error(F.concat(F.lit(f"not all of the {len(parts)} reference files hold line "), F.col("line_no").cast("string")))
    return grouped.withColumn("refs", F.when(F.size("refs") == len(parts), F.col("refs")).otherwise(err))


def assign_split(df: DataFrame, source_col: str = "source", mapping: dict | None = None) -> DataFrame:
    """Raw file name -> train/valid/test (unknown names -> NULL)."""
    mapping = mapping or SPLIT_NAMES
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("split", m[F.col(source_col)])


def parse_decoder_log(df: DataFrame, line: str = "line") -> DataFrame:
    """S6 + F1: hypothesis rows (``H-<id>``) of a decoder log -> ``id, score, text``.

    Keeps lines starting with ``H`` and takes the third TAB field; keyed by the
    id after ``H-`` rather than by row order.
    """
    c = F.col(line)
    # the first three fields by the places of their TABs: the line is not cut into an array
    field = lambda n: F.substring_index(F.substring_index(c, "\t", n), "\t", -1)
    fewer = lambda n: F.octet_length(F.substring_index(c, "\t", n - 1)) == F.octet_length(c)
    return (df.where(c.startswith("H"))
            .select(F.regexp_extract(F.substring_index(c, "\t", 1), r"^H-(\d+)$", 1).cast("bigint").alias("id"),
                    F.when(~fewer(2), field(2)).cast("double").alias("score"),
                    F.when(fewer(3), "").otherwise(field(3)).alias("text")))
