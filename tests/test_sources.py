"""Line numbering across file splits, ordered writes, references, decoder logs."""
import os
import tempfile

from pyspark.sql import functions as F

from linea.sources import sinks
from linea.sources import text as S


def test_read_lines_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="linea-test-")
    p = os.path.join(d, "corpus.txt")
    lines = [f"line {i} " + "x" * (i % 37) for i in range(20000)]
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        df = S.read_lines(spark, p, split="train", lang="en")
        assert df.rdd.getNumPartitions() > 3
        got = {r.line_no: r.text for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == dict(enumerate(lines))


def test_write_lines_keeps_order(spark):
    d = tempfile.mkdtemp(prefix="linea-test-")
    df = spark.range(1000).select(F.col("id").alias("line_no"), F.col("id").cast("string").alias("text"))
    sinks.write_lines(df.repartition(7), os.path.join(d, "out"), partitions=4)
    parts = sorted(x for x in os.listdir(os.path.join(d, "out")) if x.startswith("part-"))
    text = "".join(open(os.path.join(d, "out", x)).read() for x in parts)
    assert text.splitlines() == [str(i) for i in range(1000)]


def test_reference_stem_listing(spark):
    d = tempfile.mkdtemp(prefix="linea-test-")
    for name, content in (("ref0", "a\nb\n"), ("ref1", "c\nd\n"), ("ref", "e\nf\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(content)
    stem = os.path.join(d, "ref")
    assert [os.path.basename(x) for x in S.reference_paths(spark, stem)] == ["ref0", "ref1", "ref"]
    refs = {r.line_no: r.refs for r in S.read_references(spark, stem).collect()}
    assert refs == {0: ["a", "c", "e"], 1: ["b", "d", "f"]}


def test_parse_decoder_log(spark):
    df = spark.createDataFrame([("S-1\tsrc",), ("H-1\t-0.5\thello world",), ("P-1\t-0.1",), ("H-0\t-1.0\t",)],
                               "line string")
    got = sorted((r.id, r.score, r.text) for r in S.parse_decoder_log(df).collect())
    assert got == [(0, -1.0, ""), (1, -0.5, "hello world")]


def test_read_parallel_strict(spark):
    import pytest
    a = spark.createDataFrame([(0, "x"), (1, "y")], "line_no long, text string")
    b = spark.createDataFrame([(0, "u")], "line_no long, text string")
    with pytest.raises(ValueError):
        S.read_parallel({"a": a, "b": b})


def test_save_stage_and_append_result(spark):
    d = tempfile.mkdtemp(prefix="linea-test-")
    df = spark.createDataFrame([("train", "en", 0, "x")], "split string, lang string, line_no long, text string")
    sinks.save_stage(df, os.path.join(d, "stage"))
    sinks.save_stage(df, os.path.join(d, "stage"))
    assert spark.read.parquet(os.path.join(d, "stage")).count() == 1
    res = spark.createDataFrame([("m", "21", "valid", "en>vi", "bleu", 12.5)],
                                "model string, checkpoint string, split string, direction string, metric string, value double")
    sinks.append_result(res, os.path.join(d, "res"))
    sinks.append_result(res, os.path.join(d, "res"))
    assert spark.read.parquet(os.path.join(d, "res")).count() == 2


def test_reference_files_gz_detok_and_unequal(spark):
    import gzip

    import pytest
    d = tempfile.mkdtemp(prefix="linea-test-")
    for name, content in (("x.ref0.gz", None), ("t.ref0", "a\nb\n"), ("t.ref1", "c\nd\n"), ("extra", "e\nf\n"), ("u0", "a\nb\n"), ("u1", "c\n")):
        if content is None:
            with gzip.open(os.path.join(d, "g0.gz"), "wt") as f:
                f.write("p\nq\n")
        else:
            with open(os.path.join(d, name), "w") as f:
                f.write(content)
    refs = S.read_references(spark, os.path.join(d, "t"), detok=True, extra=[os.path.join(d, "extra")])
    assert {r.line_no: r.refs for r in refs.collect()} == {0: ["a", "c", "e"], 1: ["b", "d", "f"]}
    assert [r.text for r in S.read_lines(spark, os.path.join(d, "g0.gz")).orderBy("line_no").collect()] == ["p", "q"]
    with pytest.raises(Exception, match="reference files hold line 1"):
        S.read_references(spark, os.path.join(d, "u")).collect()


def test_bind_strict(spark):
    import pytest
    a = spark.createDataFrame([(0, "x"), (1, "y")], "k long, a string")
    b = spark.createDataFrame([(0, "u"), (1, "v")], "k long, b string")
    assert sorted(tuple(r) for r in S.bind_strict(a, b, ["k"], "sides").collect()) == [(0, "x", "u"), (1, "y", "v")]
    for left, right, side in ((a, b.where("k = 0"), "first"), (a.where("k = 0"), b, "second")):
        with pytest.raises(Exception, match=f"sides: line only on the {side} side at 1"):
            S.bind_strict(left, right, ["k"], "sides").collect()


def test_checkpoint_folder_must_be_shared():
    import pytest

    from linea.session import ensure_checkpoint_dir

    class Unset:
        def isDefined(self):
            return False

    class Session:
        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                @staticmethod
                def sc():
                    return type("C", (), {"getCheckpointDir": lambda self: Unset()})()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_conversation_turns_are_all_kept(spark):
    from linea.sources import fixtures as FX

    from .conftest import SF0001
    turns = spark.read.parquet(f"{SF0001}/conversations.parquet")
    pairs = FX.turns(spark, SF0001)
    held = pairs.select(F.explode(F.array("src", "tgt")).alias("t")).where("t != ''")
    assert sorted(r.t for r in held.collect()) == sorted(r.text for r in turns.where("text != ''").collect())
    assert pairs.count() == pairs.select("conv_id", "k").distinct().count()
    assert {r.role for r in turns.select("role").distinct().collect()} >= {"user", "assistant"}


def test_one_row_group_is_dealt_to_all_cores(spark):
    from linea.sources.tables import table
    from tests.conftest import SF0001
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")  # the file's one row group in one of several ranges
    try:
        raw = spark.read.parquet(f"{SF0001}/documents.parquet")
        assert raw.rdd.getNumPartitions() >= 4 and sum(1 for n in raw.rdd.glom().map(len).collect() if n) == 1
        dealt = table(spark, SF0001, "documents")
        sizes = dealt.rdd.glom().map(len).collect()
        assert sum(sizes) == raw.count() and max(sizes) * 4 <= 2 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
