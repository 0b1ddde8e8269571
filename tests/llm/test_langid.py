import zlib

import numpy as np

from millrace.llm import langid
from millrace.llm.queries import op2_language

EN = "the quick brown fox jumps over the lazy dog and then the other dog sleeps in the house near the river with all of them "
DE = "der schnelle braune fuchs springt über den faulen hund und dann schläft der andere hund im haus an dem fluss mit allen "
ROWS = [(i, (EN if i % 2 else DE) * 3, "en" if i % 2 else "de", "x") for i in range(60)]
SCHEMA = "doc_id long, text string, lang string, score string"


def test_mixture_and_letters(spark):
    model = langid.train(spark.createDataFrame(ROWS, SCHEMA))
    assert model.languages == ["de", "en"]
    assert model.predict(EN)[0] == "en" and model.predict(DE)[0] == "de"
    assert set(model.mixture(EN * 5)) == {"en"}
    both = model.mixture(EN * 6 + DE * 2)
    assert set(both) == {"en", "de"} and 0.6 < both["en"] < 0.9
    for text in (None, "", "  ", "123 !? 😀\n", "\x00"):
        assert model.predict(text) == ("und", 0.0)
    for text in ("a", "漢字", "é" * 100_000):
        lang, score = model.predict(text)
        assert lang in ("de", "en") and 0 <= score <= 1


def test_trigrams_are_of_letters_and_blanks():
    assert (langid.trigrams("Ab, 12 c") == langid.trigrams("aB c")).all()
    assert len(langid.trigrams("ab")) == 3


def test_query_semantics(spark):
    rows = [*ROWS, (1000, None, "en", ""), (1001, "", None, ""), (1002, EN, None, ""), (None, DE, "de", ""), (1000, EN, "en", "")]
    got = langid.predictions(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1


def test_nothing_learned(spark):
    unlabelled = spark.createDataFrame([(1, EN, None, "")], SCHEMA)
    assert [tuple(r)[2:] for r in langid.predictions(unlabelled).collect()] == [("und", 0.0)]
    assert langid.predictions(unlabelled.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = op2_language(spark, sf).filter("held_out").collect()
    assert len(got) > 250
    assert np.mean([r.lang_pred == want[r.doc_id] for r in got]) > 0.95
