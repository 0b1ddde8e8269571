import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import fingerprint as fp
from millrace.llm import shingles
from millrace.llm.common import ascii_words
from millrace.llm.queries import op1_fingerprint


def sets(text, width=5):
    w = ascii_words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(["ab", "Cd", "é", " ", "\n", "\t ", "x", "漢"]) for _ in range(rng.choice([0, 1, 5, 40, 700]))) for _ in range(n)]


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_hashes_are_those_of_words(monkeypatch, piece):
    monkeypatch.setattr(shingles, "PIECE", piece)
    texts = [*random_texts(200, 1), None, " ", "a" * 300, "a" * 300 + " b", ""]
    data, offsets = shingles.buffer_of(pa.array(texts).slice(3))
    hashes, at = shingles.words(data, offsets)
    words = [ascii_words(t) for t in texts[3:]]
    assert [b - a for a, b in zip(at, at[1:])] == list(map(len, words))
    flat = [w for ws in words for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_sets_have_the_right_sizes():
    texts = random_texts(200, 2)
    for width in (1, 3, 5):
        assert [len(s) for s in shingles.shingle_sets(pa.array(texts), width)] == [len(sets(t, width)) for t in texts]


def test_estimates():
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64))
    a, b = np.sort(x[:12_000]), np.sort(x[6_000:])
    sa, sb = fp.sketch(np.sort(rng.permutation(a))), fp.sketch(b)
    assert len(fp.packed(sa)) <= 4 * fp.K * 6 / 3 + 4 and (fp.unpacked(fp.packed(sa)) == sa).all()
    p = rng.permutation(x)
    a, b = np.sort(p[:12_000]), np.sort(p[6_000:])
    sa, sb = fp.sketch(a), fp.sketch(b)
    assert abs(fp.resemblance(sa, sb) - 0.3) < 0.1
    assert abs(fp.containment(sa, sb) - 0.5) < 0.15
    assert abs(fp.distinct(sa) / 12_000 - 1) < 0.25
    assert (fp.merged(sa, sb) == fp.sketch(x)).all()


def test_merged_by(spark):
    texts = [t for t in random_texts(50, 3)]
    df = fp.fingerprints(spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "k long, text string"), k=16)
    for r in fp.merged_by(df, "k", k=16).collect():
        own = [fp.sketch(s, 16) for s in shingles.shingle_sets(pa.array(texts[int(r.k) :: 3]), 5)]
        assert (fp.unpacked(r.fingerprint) == np.unique(np.concatenate(own))[:16]).all()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    return {r[0]: (r[1] or "", order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)}


def check(rows, got, tolerance):
    want = brute(rows)
    assert len(got) == len(rows)
    same = {}
    for r in got:
        text, following = want[r.doc_id]
        changed = fp.edited(text, following)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert abs(r.near_edited - jaccard(sets(text), sets(changed))) <= tolerance
        assert abs(r.near_next - jaccard(sets(text), sets(following))) <= tolerance


@pytest.mark.parametrize("per_bucket", [1, 3, 2000])
def test_small_texts_exactly(spark, monkeypatch, per_bucket):
    rows = [(i * 3 - 50, t) for i, t in enumerate(random_texts(40, 4))] + [(None, "no id at all here now"), (1000, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, bucket string")
    whole = fp.with_next
    monkeypatch.setattr(fp, "with_next", lambda d: whole(d, per_bucket))
    check(rows, fp.compared(df).collect(), 0)


def test_one_and_no_row(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert fp.compared(df).first().near_next == 1
    assert fp.compared(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "x")], "doc_id long, text string")
    assert fp.compared(twice).count() == 3


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, op1_fingerprint(spark, sf).collect(), 0.16)
