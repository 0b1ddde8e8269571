import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffix_dedup as sd
from millrace.llm.queries import op3_suffix_dedup

N = sd.LENGTH


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in texts:
        for k in range(len(b) - N + 1):
            w = b[k : k + N]
            if w not in least or (sd.LAST if i is None else i) < least[w]:
                least[w] = sd.LAST if i is None else i
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - N + 1):
            if least[b[k : k + N]] < (sd.LAST if i is None else i):
                gone[k : k + N] = b"\x01" * N
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def corpus(seed, n, letters="abcdefgé"):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(rng.choice([30, 48, 49, 50, 51, 52, 75, 200, 500])) for _ in range(12)] + ["ab" * 60, "a" * 130, "abc" * 40]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else word(rng.randint(0, 120)) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.3:
            p = rng.choice(passages)
            a = rng.randint(0, len(p))
            parts.insert(0, p[a : a + rng.randint(0, 120)])
        texts.append("".join(parts))
    return texts + rng.sample(texts, n // 5)


@pytest.mark.parametrize(("seed", "chunk", "piece"), [(1, 4 << 20, 2 << 20), (2, 600, 2 << 20), (3, 2500, 97)])
def test_against_brute_force(spark, monkeypatch, seed, chunk, piece):
    monkeypatch.setattr(sd.runs, "__defaults__", (sd.LENGTH, sd.GRAM, piece))
    texts = corpus(seed, 150)
    rows = [(i * 37 % 1013, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, texts[0]), (-5, texts[3]), (-5, texts[3]), (-5, None), (2000, ""), (2001, "a" * 49)]
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, kept binary").repartition(4)
    whole = sd.deduplicated
    monkeypatch.setattr(sd, "deduplicated", lambda d: whole(d, chunk))
    assert got(sd.summary(df)) == brute(rows)


def test_buckets_are_those_of_windows():
    rng = np.random.default_rng(0)
    for letters in (1, 2, 3, 20):
        data = rng.integers(97, 97 + letters, 4000).astype(np.uint8)
        data[1000:1300] = data[2000:2300]
        starts = np.sort(rng.choice(len(data) - N + 1, 1500, replace=False))
        bucket = sd.refined(data, starts)
        windows = [data[s : s + N].tobytes() for s in starts]
        assert len(set(zip(windows, bucket.tolist()))) == len(set(windows)) == len(set(bucket.tolist()))


def test_cleaned_keeps_columns(spark):
    long = "".join(chr(97 + k * k % 23) for k in range(200))
    df = spark.createDataFrame([(1, long, "s", 200), (2, "é" + long + "xé", "t", 203), (3, None, None, 0), (4, "short", "u", 5)], "doc_id long, text string, chunk string, n_chars long")
    out = sd.cleaned(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.select("doc_id", "n_chars", "chunk").collect()) == [(1, 200, "s"), (2, 3, "t"), (3, None, None), (4, 5, "u")]
    assert out.filter("doc_id = 2").first().text == "éxé"


def test_empty_table(spark):
    assert sd.summary(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op3_suffix_dedup(spark, sf)) == brute(rows)
