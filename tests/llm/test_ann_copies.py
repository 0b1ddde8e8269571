import numpy as np

from millrace.llm import ann


def test_copies_of_a_vector_take_one_place():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((900, 16))
    vectors[::3] = vectors[0]
    queries = np.concatenate([vectors[1:40], vectors[:1] + 0.1 * rng.standard_normal((20, 16))])
    for rows in ann.Block(vectors).candidates(queries):
        assert len(np.unique(vectors[rows], axis=0)) >= 0.25 * 900


def test_only_copies():
    vectors = np.ones((300, 8))
    assert [len(r) for r in ann.Block(vectors).candidates(vectors[:2])] == [300, 300]
