import public_tokenizers
import pytest
from test_mixing import wanted
from test_parity_join import brute as groups
from test_suffix_dedup import N
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.common import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        done = stage(spark, docs, SF)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert done.columns == docs.columns
        done.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_languages_keep_texts(stages):
    before, after = {r.doc_id: r for r in stages[0]}, {r.doc_id: r for r in stages[1]}
    assert all(before[i].text == r.text for i, r in after.items())
    assert all(not any(c.isalpha() for c in before[i].text or "") or i in after for i in before) or len(after) > 0.9 * len(before)
    assert sum(r.lang == before[i].lang for i, r in after.items()) > 0.9 * len(after)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    assert sorted(r.doc_id for r in stages[2]) == sorted({c for _, _, c in groups(rows, 5, 80)})


def test_repeats_are_cut(stages):
    least, want = {}, {}
    for r in sorted(stages[2], key=lambda r: r.doc_id):
        b = (r.text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - N + 1):
            if least.setdefault(b[k : k + N], r.doc_id) < r.doc_id:
                gone[k : k + N] = b"\x01" * N
        if text := bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"):
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in stages[3]} == want


def test_mix_meets_its_targets(stages):
    sizes, took, most = {}, {}, {}
    for r in stages[3]:
        n = len(WORD.findall(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        most[r.source] = max(most.get(r.source, 0), n)
    for r in stages[4]:
        took[r.source] = took.get(r.source, 0) + len(WORD.findall(r.text))
    for source, target in wanted(sizes).items():
        assert abs(took.get(source, 0) - target) <= most[source]


def test_tokens(stages):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        assert r.decodes and r.ids == own.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_and_empty_documents(spark, tmp_path, stages):
    assert corpus_pipeline.run(spark, SF).count() == len(stages[5])
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
