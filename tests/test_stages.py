"""Stages: resume, rebuild what changed, commit by one marker, binding without a shuffle."""
import re

import pytest
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.plans.prepare import LANGS, SPLITS, Preparation
from linea.session import ensure_checkpoint_dir
from linea.sources.sinks import append_result
from linea.sources.stages import Stages


@pytest.fixture()
def folder(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    return f"file://{tmp_path}/stages"


def corpus(spark, changed=""):
    text = {"train": ["The house is big .", "the big house .", "A house , the house ."] * 3, "valid": ["The small house ." + changed, ""], "test": ["is it ?"]}
    rows = [(s, lang, i, t if lang == "en" else t.replace("house", "nhà cửa")) for s in SPLITS for lang in LANGS for i, t in enumerate(text[s])]
    return spark.createDataFrame(rows, "split string, lang string, line_no long, text string")


def everything(stages, c, step=0, syn=None):
    p = Preparation(stages, c, normalize_form="NFC", num_merges=12)
    return {s: p.encoded(s, step, syn).frame for s in SPLITS}, p


def test_second_run_computes_nothing_and_a_changed_split_its_own_stages(spark, folder):
    first = Stages(spark, folder)
    encoded, p = everything(first, corpus(spark))
    assert encoded["train"].count() == 18 and encoded["valid"].count() == 4
    want = sorted(map(str, encoded["train"].collect()))
    # ids -> subwords -> tagged lines -> the composed set
    words = {r.id: r.token for r in p.dictionary().frame.collect()}
    sets = {r.line_no: r for r in p.sets("train").frame.collect()}
    for r in encoded["train"].collect():
        assert r.src_ids[-1] == 2
        src = " ".join(words[i] for i in r.src_ids[:-1])
        assert re.sub("@@( |$)", "", src.split(" ", 1)[1]) == sets[r.line_no].src
        assert src.split(" ")[0] == (T.TAG_E2V, T.TAG_V2E)[r.line_no % 2]

    again = Stages(spark, folder)
    encoded, _ = everything(again, corpus(spark).repartition(5))
    assert again.built == [] and sorted(map(str, encoded["train"].collect())) == want

    third = Stages(spark, folder)
    encoded, _ = everything(third, corpus(spark, changed=" New ."))
    assert third.built and all("valid" in name for name in third.built), third.built
    assert sorted(map(str, encoded["train"].collect())) == want

    # step 1 learns nothing anew, and binds step 0's lines
    syn = spark.createDataFrame([(i, f"syn en {i}", f"syn vi {i}") for i in range(9)], "line_no long, syn_en string, syn_vi string")
    fourth = Stages(spark, folder)
    encoded, p = everything(fourth, corpus(spark, changed=" New ."), 1, syn)
    assert encoded["train"].count() == 36 and not [n for n in fourth.built if not n.startswith("step1/")]
    lines = {r.line_no: (r.src, r.tgt) for r in p.sets("train", 1, syn).frame.collect()}
    zero = {r.line_no: (r.src, r.tgt) for r in p.sets("train").frame.collect()}
    assert lines[0] == ("syn en 0", zero[0][1]) and lines[1] == zero[0] and lines[2] == ("syn vi 0", zero[1][1]) and lines[3] == zero[1]
    assert p.translation_input("en", "test").frame.first().text.startswith(T.TAG_E2V)


def test_binding_stored_sides_needs_no_shuffle(spark, folder):
    p = Preparation(Stages(spark, folder), corpus(spark), normalize_form="NFC")
    plan = p.pairs("train")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan


def test_a_writer_that_dies_leaves_the_old_stage(spark, folder):
    stages = Stages(spark, folder)
    stages.write("t", spark.range(3).toDF("x"))
    dying = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        stages.write("t", dying)
    assert stages.read("t").count() == 3
    # a marker of which only a part was written
    fs, path = stages._fs(f"{folder}/t/markers/00000001.json")
    out = fs.create(path, False)
    out.write(bytearray(b'{"id": "a'))
    out.close()
    assert Stages(spark, folder).read("t").count() == 3
    stages.write("t", spark.range(7).toDF("x"), bucket_by=("x",), buckets=2)
    assert Stages(spark, folder).read("t").count() == 7
    stages.clean("t")
    assert Stages(spark, folder).read("t").count() == 7 and len(stages._markers("t")) == 1
    with pytest.raises(FileNotFoundError):
        stages.read("nothing")


def test_append_result_is_keyed_by_run(spark, tmp_path):
    path = f"file://{tmp_path}/results"
    row = lambda v: spark.createDataFrame([("m", "21", float(v))], "model string, checkpoint string, value double")
    append_result(row(1), path, run="a")
    append_result(row(2), path, run="b")
    append_result(row(3), path, run="a")  # the rerun replaces its own rows
    assert sorted((r.run, r.value) for r in spark.read.parquet(path).collect()) == [("a", 3.0), ("b", 2.0)]
