from millrace.llm import toxicity


def test_training_sees_every_window(spark, monkeypatch):
    long = "a quiet walk along the river " * 1000
    docs = [(i, long[: 300 * 37] + f"odd passage {i} " + long, i % 2) for i in range(6)]
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda documents, prior: seen.extend(documents))
    toxicity.train(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"), spark.createDataFrame([(i, t) for i, _, t in docs], "doc_id long, toxic int"))
    assert len(seen) == 6
    for (parts, toxic), (i, text, want) in zip(seen, docs):
        assert toxic == want and parts[0] + "".join(p[toxicity.BLOCK :] for p in parts[1:]) == text and any(f"odd passage {i}" in p for p in parts)
