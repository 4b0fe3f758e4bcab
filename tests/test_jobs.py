"""Preparation jobs end to end on a small parallel corpus (conversation turns)."""
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.plans import jobs as J
from linea.sources import fixtures as FX

from .conftest import SF0001


def corpus(spark):
    out = None
    for split in ("train", "valid", "test"):
        p = FX.parallel_split(spark, SF0001, split)
        long = p.select(F.lit(split).alias("split"), F.lit("en").alias("lang"), "line_no",
                        F.col("en").alias("text")).unionByName(
            p.select(F.lit(split).alias("split"), F.lit("vi").alias("lang"), "line_no", F.col("vi").alias("text")))
        out = long if out is None else out.unionByName(long)
    return out


def test_prepare_bidirectional_step0_and_1(spark):
    c = corpus(spark)
    r0 = J.prepare_bidirectional(c, step=0, num_merges=20)
    sets, sub, enc = r0["sets"], r0["subword"], r0["encoded"]
    n_pairs = c.where(F.col("lang") == "en").count()
    assert sets.count() == 2 * n_pairs == enc.count()
    # tags alternate on every split at step 0; subwords join back to the composed text
    tags = sub.select(F.split("src", " ")[0].alias("t"), (F.col("line_no") % 2).alias("par")).distinct().collect()
    assert {(r.t, r.par) for r in tags} == {("<e2v>", 0), ("<v2e>", 1)}
    back = sub.select("split", "line_no", T.join_subwords(F.expr("substring(src, 7)")).alias("s")) \
        .join(sets.select("split", "line_no", F.col("src").alias("orig")), ["split", "line_no"])
    assert back.where(F.col("s") != F.col("orig")).count() == 0
    assert enc.where(F.element_at("src_ids", -1) != 2).count() == 0
    # step 1 reuses the codes and the dictionary, and carries valid/test over
    syn = FX.parallel_split(spark, SF0001, "train").select("line_no", "syn_en", "syn_vi")
    r1 = J.prepare_bidirectional(c, step=1, prev=sets, synthetic=syn, merges=r0["merges"],
                                 dictionary=r0["dictionary"])
    s1 = r1["sets"]
    n_train = c.where((F.col("lang") == "en") & (F.col("split") == "train")).count()
    assert s1.where(F.col("split") == "train").count() == 4 * n_train
    assert s1.where(F.col("split") != "train").count() == sets.where(F.col("split") != "train").count()


def test_dictionary_and_vocabularies_come_from_the_training_split(spark):
    rows = [(split, lang, 0, "word ." if split == "train" else "word quiz .") for split in ("train", "valid", "test") for lang in ("en", "vi")]
    c = spark.createDataFrame(rows, "split string, lang string, line_no long, text string")
    r = J.prepare_bidirectional(c, num_merges=0)
    assert r["dictionary"].where("token = '<e2v>'").first().cnt == 1
    for table in ("dictionary", "src_vocab", "tgt_vocab"):
        tokens = [x.token for x in r[table].collect()]
        assert "." in tokens and not any("q" in t for t in tokens)
    assert r["encoded"].count() == 6


def test_unequal_sides_raise(spark):
    import pytest
    rows = [("train", "en", 0, "a b"), ("train", "en", 1, "c d"), ("train", "vi", 0, "x y")]
    c = spark.createDataFrame(rows, "split string, lang string, line_no long, text string")
    with pytest.raises(Exception, match="only on the first side at 1"):
        J.prepare_bidirectional(c, num_merges=0)
    whole = spark.createDataFrame([*rows, ("train", "vi", 1, "z w")], c.schema)
    sets = spark.createDataFrame([("train", i, "s", "t") for i in range(4)], "split string, line_no long, src string, tgt string")
    syn = spark.createDataFrame([(0, "a", "x")], "line_no long, syn_en string, syn_vi string")
    with pytest.raises(Exception, match="genuine and synthetic lines: line only on the first side at 1"):
        J.prepare_bidirectional(whole, step=1, prev=sets, synthetic=syn, merges=[])


def test_missing_hypothesis_raises(spark):
    import pytest
    log = spark.createDataFrame([("H-0\t-0.1\ta b c d e",)], "line string")
    refs = spark.createDataFrame([(0, "a b c d e"), (1, "f g")], "sent_id long, ref string")
    assert J.evaluate_unidirectional(log, refs.where("sent_id = 0")).first() is not None
    with pytest.raises(Exception, match="only on the second side at 1"):
        J.evaluate_unidirectional(log, refs).collect()


def test_too_many_references_raise(spark):
    import pytest

    from linea.operators import bleu as B
    df = spark.createDataFrame([(0, ["a"], [["b"], ["c"], ["a"]])], "line_id long, hyp array<string>, refs array<array<string>>")
    assert B.sentence_stats(df).first().correct_1_grams == 1
    assert B.sentence_stats(df, n_refs=3).first().correct_1_grams == 1
    for given in ({"n_refs": 2}, {"multi_ref": False}):
        with pytest.raises(Exception, match="reference"):
            B.sentence_stats(df, **given).collect()


def _one_direction(spark):
    rows = [(split, lang, i, f"{lang} words number {i} of {split} .") for split in ("train", "valid", "test")
            for lang in ("en", "vi") for i in range(3)]
    return spark.createDataFrame(rows, "split string, lang string, line_no long, text string")


def test_prepare_unidirectional_and_finetune(spark):
    c = _one_direction(spark)
    r0 = J.prepare_bidirectional(c, num_merges=15)
    for out in (J.prepare_unidirectional(c, "en", "vi", r0["merges"], r0["dictionary"]),
                J.prepare_finetune(c, "en", "vi", r0["merges"], (r0["dictionary"], r0["dictionary"]))):
        ids = {r.token: r.id for r in r0["dictionary"].collect()}
        sub = {f"{r.split}:{r.line_no}": (r.src, r.tgt) for r in out["subword"].collect()}
        rows = out["encoded"].collect()
        assert len(rows) == 9 and {r.key for r in rows} == set(sub)
        for r in rows:
            for side, got in zip(sub[r.key], (r.src_ids, r.tgt_ids)):
                assert got == [ids.get(t, 3) for t in side.split(" ")] + [2]
        text = {f"{r.split}:{r.line_no}": r.src for r in out["sets"].collect()}
        assert {k: v[0].replace("@@ ", "") for k, v in sub.items()} == text


def test_prepare_independent(spark):
    out = J.prepare_independent(_one_direction(spark), "vi", "en", num_merges=10)
    src = {r.token for r in out["src_dict"].collect()}
    tgt = {r.token for r in out["tgt_dict"].collect()}
    assert src != tgt and out["encoded"].count() == 9 and len(out["merges"]) == 10
    assert {r.token for r in out["src_vocab"].collect()} <= src and {r.token for r in out["tgt_vocab"].collect()} <= tgt


def test_prepare_translation_input(spark):
    c = corpus(spark).where(F.col("split") == "valid")
    out = J.prepare_translation_input(c, [("t", "h", 5)]).collect()
    assert all(r.text.startswith("<e2v> " if r.lang == "en" else "<v2e> ") for r in out)
