import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linea.llm import packing

TEXTS = ["Hello, World! it's 2024", None, "", "a" * 300, "Σίσυφος ΟΔΟΣ İstanbul", "x<|ENDOFTEXT|>y <|endoftext|> z", "tab\tnew\nline\x1cfs\x85nel",
         "the quick brown fox " * 900, "ünïcode café naïve ß 你好 😀", "the quick brown fox " * 900, "_under_score__ 3.14 ²³"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("window", [7, 64, 2048])
def test_pieces_rebuild_the_documents(spark, tokenizer, window):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 1)], "doc_id long, text string, start int").repartition(3)
    rows = packing.pack(docs, window=window).collect()
    want = sorted([(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in enumerate(TEXTS)]
                  + [(0, tokenizer.encode(TEXTS[0], add_special_tokens=False).ids + [1])])
    by_place = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    got, at = [], 0
    for r in by_place:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.sequence_id * window + r.offset == at
        if r.start == 0:
            got.append((r.doc_id, []))
        assert got[-1][0] == r.doc_id and len(got[-1][1]) == r.start
        got[-1][1].extend(ids)
        at += r.length
    assert sorted(got) == want
    assert all(r.doc_tokens == len(dict(want)[r.doc_id]) for r in rows)
    last = max(r.sequence_id for r in rows)
    rest = at - last * window
    for r in rows:
        assert r.sequence_tokens == (rest if r.sequence_id == last else window)
    assert {r.padded_to for r in rows if r.sequence_id == last} == {rest if rest & (rest - 1) == 0 else window}
    packed = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(docs, window=window)).collect()}
    whole = b"".join(packed[k] for k in sorted(packed))
    assert zlib.crc32(whole) == zlib.crc32(b"".join(bytes(r.ids) for r in by_place))


def test_words_equal_the_tokenizer_on_the_table(spark, tokenizer):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode([t or "" for t in texts])]
    assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_stay_exact_beside_nulls(spark):
    big = (1 << 62) + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c"), (-big, None)], "doc_id long, text string").coalesce(1)
    assert sorted(str(r.doc_id) for r in packing.pack(docs).collect()) == sorted([str(big), str(-big), "None"])


def test_forgetting_words(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBER", 3)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    for t in ["a b c d e", "a don't x", "we'll_see 12ab, ~~", "a b"] * 2:
        assert np.frombuffer(encoder.encode([t, "a"])[0], encoder.dtype).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
