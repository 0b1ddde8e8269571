import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.queries import op4_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n  \t x", "a" * 3000, "don't we'll THEY'RE", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "ñandú über 漢字 かな 😀👍🏽  　z\x1c\x1f\x85 q",
    "1234567890 3.14e-10 ½ ²", "\x00\x01﻿", "    indented\n    code  \n", "'s 's' 'S", "é ​‍  \U000e0001",
]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def check(rows, texts, reference):
    for r in rows:
        ids = reference.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_texts(spark, reference):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("abcdeéñ '’ \n\t1290.,!—漢😀") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    texts += [" ".join("".join(rng.choice("thineraouds") for _ in range(rng.randint(1, 14))) for _ in range(200)) for _ in range(50)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = bpe.digests(df, PATH).collect()
    assert len(rows) == len(texts)
    check(rows, texts, reference)


def test_all_tokens_of_the_vocabulary(reference):
    own = bpe.TrieEncoder(PATH, remembered=1000)
    texts = [b.decode() for b in own.vocabulary.bytes_of.values() if b.isascii()][:20000]
    assert [list(x) for x in own.encode_batch(texts)] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_long_text_and_small_memory(reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    own = bpe.TrieEncoder(PATH, remembered=5)
    for text in (ODD[8] * 20 + "<|endoftext|>" + "b" * 100, "one two three " * 40):
        assert list(own.encode_batch([text])[0]) == reference.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_query_on_the_small_tables(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    check(rows, texts, reference)
