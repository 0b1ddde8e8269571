import zlib

import numpy as np

from millrace.llm import toxicity
from millrace.llm.queries import op7_toxicity

CLEAN = "a pleasant walk along the quiet river with good friends and plenty of food for everyone at the table "
RUDE = CLEAN[:50] + "you horrible grumbleface "
DOCS = [(i, (RUDE if i % 3 == 0 else CLEAN[i % 7 :]) * (1 + i % 20), 1) for i in range(90)]
LABELS = [(i, int(i % 3 == 0), 1) for i in range(90)]


def frames(spark, docs=DOCS, labels=LABELS):
    return spark.createDataFrame(docs, "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, toxic int, text int")


def test_scores(spark):
    model = toxicity.train(*frames(spark))
    assert model.score(RUDE) > 0.5 > model.score(CLEAN)
    assert model.score(CLEAN * 500 + RUDE * 16 + CLEAN * 500) > 0.5 > model.score(CLEAN * 1000)
    for text in (None, "", "x", "漢字😀", "\n" * 2000):
        assert 0 <= model.score(text) <= 1


def test_windows_cover_the_text():
    text = "".join(chr(97 + i % 26) for i in range(1234))
    parts = toxicity.windows(text, 100)
    assert parts[0] + "".join(p[toxicity.BLOCK :] for p in parts[1:]) == text
    assert len(toxicity.windows(text * 100, 8)) == 8
    assert toxicity.windows("", 8) == [""]


def test_query_semantics(spark):
    docs = [*DOCS, (500, None, 1), (500, None, 1), (None, RUDE, 1), (501, "", 1)]
    labels = [*LABELS, (500, None, 1), (None, 1, 1), (501, 7, 1), (0, 1, 1)]
    got = toxicity.predictions(*frames(spark, docs, labels)).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_one_class_and_nothing(spark):
    got = toxicity.predictions(*frames(spark, DOCS, [(1, 0, 1), (2, 0, 1)])).collect()
    assert len({round(r.score, 6) for r in got}) == 1 and got[0].score < 0.5
    empty = toxicity.predictions(*(f.limit(0) for f in frames(spark)))
    assert empty.collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    want = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in op7_toxicity(spark, sf).filter("held_out").collect() if r.doc_id in want]
    toxic = np.array([want[r.doc_id] for r in got])
    said = np.array([r.predicted for r in got])
    assert len(got) > 500
    assert said[toxic == 1].mean() > 0.85 and said[toxic == 0].mean() < 0.02
