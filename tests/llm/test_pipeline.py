import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from linea.llm import simhash
from linea.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept.append(docs.collect())
    source = spark.read.parquet(f"{SF}/documents.parquet").collect()
    language, unique, clean, mixed = kept
    assert len(language) == len(source)  # every document here is in a learned language
    prints = [simhash.fingerprint(r.text) & (1 << 64) - 1 for r in unique]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    gone = {r.doc_id for r in language} - {r.doc_id for r in unique}
    alike = {r.doc_id: simhash.fingerprint(r.text) for r in language}
    assert all(any(k != g and ((alike[g] ^ alike[k]) & (1 << 64) - 1).bit_count() <= 4 for k in alike) for g in gone)
    assert len(clean) == len(unique)
    assert sum(r.text.count("[SECRET]") for r in clean) == sum(r.text.count("token = \"") for r in unique)
    assert all(r.n_chars == len(r.text) for r in [*clean, *mixed])
    before = {r.doc_id: len(r.text.split()) for r in clean}
    taken = sum(len(r.text.split()) for r in mixed)
    assert abs(taken - 1.5 * sum(before.values())) <= len({r.source for r in clean}) + 1
    pieces = corpus_pipeline.pack(spark, docs, SF).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [t.encode(r.text, add_special_tokens=False).ids + [1] for r in mixed]
    held = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset))])
    assert sorted(held.tolist()) == sorted(x for i in ids for x in i)


def test_run_on_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", None, None, 0), (None, "some words", "en", None, 10),
            (3, "other words here", "en", "b", 16), (3, "other words here", "en", "b", 16), (4, "x " * 20000, None, "b", 40000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {None, 3, 4} and got
    empty = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_queries_are_named_and_run(spark):
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14)) and set(SQL) <= set(QUERIES)
    assert QUERIES["op1_toxicity"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
