from millrace.llm import license_scan as ls
from millrace.llm.queries import op9_licenses


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def brute(text, threshold=ls.THRESHOLD):
    passages = [(p, "line") for p in (text or "").split("\n")]
    if "\n" in (text or ""):
        passages.append((text, "document"))
        passages += [(p, "paragraph") for p in ls.re.split(r"\n\s*\n", text) if "\n" in p]
    hits = [(-dice(ls.bigrams(p), ls.bigrams(t)), name, scope) for p, scope in passages for name, t in ls.TEMPLATES if dice(ls.bigrams(p), ls.bigrams(t)) >= threshold]
    return (min(hits)[1], -min(hits)[0]) if hits else (None, 0.0)


def test_passages():
    own = ls.Scanner()
    mit = dict(ls.TEMPLATES)["MIT"]
    assert own.scan("some prose\nReleased under the MIT License.\nmore prose here")[:3] == ("MIT", 1.0, "line")
    assert own.scan("Copyright (c) 2020 A. Nobody\n" + mit.replace(", ", ",\n"))[:1] == ("MIT",)
    assert own.scan("Intro text stands first\n\n" + mit.replace(": ", ":\n") + "\n\nAnd more.")[2] == "paragraph"
    assert own.scan("released UNDER the mit-license")[0] == "MIT"
    assert own.scan("This is about the MIT campus and other things that have no licence at all.")[0] is None
    for text in (None, "", "\n\n", "x", "漢字 " * 3000, "word " * 100_000):
        assert own.scan(text) == (None, 0.0, None, 0)


def test_pruning_loses_nothing():
    own = ls.Scanner()
    for name, text in ls.TEMPLATES:
        words = text.split()
        for cut in range(0, len(words), max(1, len(words) // 12)):
            passage = " ".join(words[:cut] + ["other"] + words[cut + 1 :])
            assert own.scan(passage)[:2] == brute(passage)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_licenses(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.license, r.score) == brute(texts[r.doc_id])
    assert sum(r.license is not None for r in rows) > 5


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "Licensed under CC BY-NC 4.0.", "b"), (1, "Licensed under CC BY-NC 4.0.", "b"), (None, "", "c")], "doc_id long, text string, license string")
    assert sorted(str(r.license) for r in ls.scanned(df).collect()) == ["CC-BY-NC-4.0", "CC-BY-NC-4.0", "None", "None"]
    assert ls.scanned(df.limit(0)).collect() == []
