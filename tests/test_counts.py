"""Count tables of parts merge to the count table of all lines."""
import pytest

from linea.operators import collocations as CO
from linea.operators import counts as N
from linea.operators import truecase as TC
from linea.operators import vocab as V
from linea.plans.prepare import Preparation
from linea.session import ensure_checkpoint_dir
from linea.sources.stages import Stages

from .test_stages import corpus


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_merged_tables_equal_a_full_count(spark):
    lines = [(i, t.split()) for i, t in enumerate(["New York is big", "the New York Times", "Is it big ?", "", "new . New York"] * 4)]
    df = spark.createDataFrame(lines, "line_id long, tokens array<string>")
    parts = [df.where(f"line_id % 3 = {k}") for k in range(3)]
    for count, name in ((TC.surface_forms, "cnt"), (V.token_counts, "cnt"), (CO.token_counts, "c"), (CO.pair_counts, "cnt")):
        both = N.merged([count(p) for p in parts], name)
        assert rows(both) == rows(count(df))
        assert rows(N.without(both, count(parts[1]), name)) == rows(count(df.where("line_id % 3 <> 1")))
    full = [N.merged([f(p) for p in parts], c) for f, c in ((CO.pair_counts, "cnt"), (CO.token_counts, "c"))]
    assert rows(CO.lexicon(*full, min_count=3, min_pmi=0.5)) == rows(CO.mine(df, min_count=3, min_pmi=0.5))
    assert rows(V.dictionary_of(N.merged([V.token_counts(p) for p in parts]))) == rows(V.build_dictionary(df))
    assert rows(TC.best_forms(N.merged([TC.surface_forms(p) for p in parts]))) == rows(TC.train(df))
    with pytest.raises(Exception, match="not in the table"):
        N.without(V.token_counts(parts[0]), V.token_counts(df)).collect()


def test_steps_count_their_own_lines(spark, tmp_path):
    from pyspark.sql import functions as F

    ensure_checkpoint_dir(spark)
    p = Preparation(Stages(spark, f"file://{tmp_path}/s"), corpus(spark), normalize_form="NFC")
    syn = spark.createDataFrame([(i, f"syn en {i}", f"syn vi {i}") for i in range(9)], "line_no long, syn_en string, syn_vi string")
    p.step_counts(0)
    for step in (1, 2):
        counts = p.step_counts(step, syn).frame
        sets = p.sets("train", step, syn).frame
        both = sets.select(F.explode(F.array("src", "tgt")).alias("s")).select(F.split("s", " ").alias("tokens"))
        assert sets.count() == 18 * (step + 1)
        assert rows(counts) == rows(V.token_counts(both))
        assert sets.where(F.pmod("line_no", F.lit(step + 1)) == 0).count() == 18  # what the step read
