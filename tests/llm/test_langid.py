import os
import random

import numpy as np
import pytest

from linea.llm import langid

SYLLABLES = {"aa": "ka to mi re su".split(), "bb": "xö ül schä eng ber".split(), "cc": "ción los ñas que rr".split()}


def text(lang, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return langid.fit([(lang, text(lang, 200, rng)) for lang in SYLLABLES for _ in range(30)])


def test_held_out_accuracy(model):
    rng = random.Random(2)
    for lang in SYLLABLES:
        got = [model.predict(text(lang, 30, rng)) for _ in range(50)]
        assert sum(g[0] == lang and g[2] for g in got) >= 49
        assert all(0 <= g[1] <= 1 for g in got)


def test_rejection(model):
    for t in [None, "", "123 456 !!!", "\n\t", "😀"]:
        assert model.predict(t) == ("und", 0.0, False)
    assert not model.predict("Привет как дела сегодня хорошо погода")[2]
    assert model.predict("mika " * 20000)[0] == "aa"


def test_training_and_prediction_in_spark(spark):
    rng = random.Random(3)
    rows = [(i, text(lang, 60, rng), lang, "keep") for i, lang in enumerate(list(SYLLABLES) * 20)]
    rows += [(100, None, "aa", "x"), (101, "mika toresu", None, "y"), (101, "mika toresu", None, "y"), (102, "", "bb", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    m = langid.train(docs)
    assert m.classes == ["aa", "bb", "cc"]
    got = langid.identify(docs, m).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred == ("und" if not r.text else "aa" if r.doc_id == 101 else r.lang)
        assert isinstance(r.score, float)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "mika", None), (2, None, "aa")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score, r.accepted) for r in langid.identify(docs, langid.train(docs)).collect()}
    assert got == {1: ("und", 0.0, True), 2: ("und", 0.0, False)}
    assert langid.identify(docs.limit(0), langid.train(docs.limit(0))).count() == 0


def test_a_language_in_one_long_document_is_learned(spark):
    rng = random.Random(4)
    long = text("cc", 60000, rng)
    for doc in range(4):  # whole texts picked by their hash would miss most of these
        rows = [(text(lang, 60, rng), lang) for lang in ("aa", "bb") for _ in range(40)] + [(f"{doc} " + long, "cc")]
        got = langid.sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 300_000, 7)
        assert {lang for lang, _ in got} == {"aa", "bb", "cc"}
        assert 90_000 <= sum(len(t) for lang, t in got if lang == "cc") <= 100_000
        assert all(len(t) <= 300 for _, t in got)


def test_sample_is_bounded_whatever_repeats(spark):
    rng = random.Random(5)
    huge = text("aa", 60000, rng)
    rows = [(huge, "aa")] * 40 + [(text("aa", 40, rng), "aa") for _ in range(40)] + [(text("bb", 40, rng), "bb") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for seed in range(4):
        got = langid.sample(docs, "text", "lang", 240_000, seed)
        assert sum(len(t) for _, t in got) <= 240_000 and len(set(got)) == len(got)
        assert sum(lang == "aa" for lang, _ in got) >= 30 and sum(lang == "bb" for lang, _ in got) >= 30
    assert sorted(langid.sample(docs.repartition(3), "text", "lang", 240_000, 3)) == got


ITALIAN = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Quanto a dir qual era "
           "questa selva selvaggia e aspra e forte che nel pensier rinova la paura. Tanto amara che poco più morte.")


def test_rejects_unlearned_languages_of_the_same_script(model):
    rng = random.Random(6)
    finnish = "Mieleni minun tekevi, aivoni ajattelevi lähteäni laulamahan, saa'ani sanelemahan, sukuvirttä suoltamahan, lajivirttä laulamahan."
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=300))
    for t in (ITALIAN, finnish, noise, ITALIAN * 100):
        assert not model.predict(t)[2]


def test_keeps_mixed_and_short_texts_and_those_with_keys(model):
    rng = random.Random(7)
    kept = []
    for i in range(150):
        one, two = rng.sample(list(SYLLABLES), 2)
        kept.append(model.predict(text(one, 20, rng) + " " + text(two, 20, rng))[2])
        kept.append(model.predict(text(one, 3, rng))[2])
        kept.append(model.predict(f'"{rng.getrandbits(160):040x}" {text(one, 12, rng)}')[2])
    assert sum(kept) >= 0.98 * len(kept)


def test_unlearned_latin_script_is_rejected_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = langid.train(docs)
    got = langid.identify(docs, m)
    assert got.where("not accepted").count() <= 0.002 * docs.count()
    assert not m.predict(ITALIAN)[2] and not m.predict("".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz     ", k=300)))[2]


def test_the_driver_does_not_fit(spark, monkeypatch):
    here, fit = os.getpid(), langid.fit
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = fit(langid.sample(docs, "text", "lang", 2_000_000, 7), seed=7)

    def elsewhere(rows, **kw):
        assert os.getpid() != here, "the sample's n-grams are held by the driver"
        return fit(rows, **kw)

    monkeypatch.setattr(langid, "fit", elsewhere)
    got = langid.train(docs)
    assert got.classes == want.classes and got.temperature == want.temperature
    for name in ("table", "bias", "reject", "cover"):
        np.testing.assert_allclose(getattr(got, name), getattr(want, name), rtol=1e-9, atol=1e-12)
