import random
from collections import Counter, defaultdict

import pytest

from millrace.llm import mixing
from millrace.llm.common import WORD
from millrace.llm.queries import op5_mixing


def wanted(sizes):
    """Targets by resharing again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    open_, left = set(order), 1.5 * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if target[s] + share[s] >= 2 * sizes[s]]
        if not over:
            for s in open_:
                target[s] += share[s]
            break
        for s in over:
            left -= 2 * sizes[s]
            target[s] = 2.0 * sizes[s]
            open_.discard(s)
    return target


def check(docs, got, near):
    sizes = [len(WORD.findall(t or "")) for _, _, t in docs]
    by_source = Counter()
    for (_, s, _), n in zip(docs, sizes):
        by_source[s] += n
    target = wanted(by_source)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d[0], n) for d, n in zip(docs, sizes))
    source_of = defaultdict(set)
    for d in docs:
        source_of[d[0]].add(d[1])
    took = Counter()
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        assert r.source_size in {by_source[s] for s in source_of[r.doc_id]}
        assert any(abs(r.target - target[s]) < 1e-6 * max(1, target[s]) for s in source_of[r.doc_id])
        if len(source_of[r.doc_id]) == 1:
            took[next(iter(source_of[r.doc_id]))] += r.taken
    for s, n in took.items():
        assert abs(n - target[s]) <= near(s, target[s]), (s, n, target[s])


def texts(n, seed):
    rng = random.Random(seed)
    return ["w " * rng.choice([0, 1, 3, 10, 50, 51, 400]) for _ in range(n)]


@pytest.mark.parametrize("group", [5, 60, 4000])
def test_many_levels(spark, monkeypatch, group):
    docs = [(i, ("hot" if i % 3 else f"s{i % 5}") if i % 11 else None, t) for i, t in enumerate(texts(3000, 1))]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, text string, size int")
    whole = mixing.mixed
    monkeypatch.setattr(mixing, "mixed", lambda d: whole(d, group=group))
    first = mixing.taken(df).collect()
    check(docs, first, lambda s, t: 201)  # the open documents at most
    assert sorted(first) == sorted(mixing.taken(df.repartition(13)).collect())


def test_odd_rows(spark):
    docs = [(1, "a", None), (2, "a", ""), (3, "", "x y"), (None, "b", "one two three"), (4, None, "w " * 1000), (5, None, "w"), (5, None, "w"), (5, "a", "w"), (6, "é", "  \x1c  "), (7, "Z", "  ")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    check(docs, mixing.taken(df).collect(), lambda s, t: 1001)
    assert mixing.taken(df.limit(0)).collect() == []
    only_empty = mixing.taken(df.filter("doc_id = 2")).collect()
    assert [(r.size, r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)]


def test_flight_keeps_both_totals():
    rng = random.Random(3)
    for _ in range(200):
        units = [[rng.choice([0.25, 0.5, rng.random()]), float(rng.choice([0, 1, 5, rng.randint(0, 99)])), float(rng.randint(1, 2))] for _ in range(rng.randint(0, 40))]
        before = [sum(u[0] * u[k] for u in units) for k in (1, 2)]
        mixing.flown(units, rng)
        assert all(abs(b - sum(u[0] * u[k] for u in units)) < 1e-6 for b, k in zip(before, (1, 2)))
        assert sum(0 < u[0] < 1 for u in units) <= 2


def test_mix_repeats_rows(spark):
    docs = [(i, "s", t, "keep") for i, t in enumerate(texts(300, 2))]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, __x string")
    out = mixing.mix(df)
    assert out.columns == df.columns
    copies = Counter(r.doc_id for r in out.collect())
    assert copies == Counter({r.doc_id: r.copies for r in mixing.mixed(df).collect() if r.copies})


def test_mix_of_whole_and_split_shares(spark):
    docs = [(i if i % 50 else None, ("hot" if i % 3 else "few") if i % 7 else None, t, 1) for i, t in enumerate(texts(300, 4))]
    docs += [(900, "none", "", 2), (901, "none", None, 2), (1, "hot", "again", 3), (1, "hot", "again", 3)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, of int")
    units = mixing.mixed(df).collect()
    assert {r.copies for r in units if r.source == "few"} == {2} and len({r.copies for r in units if r.source == "hot"}) == 2
    want = Counter()
    for r in units:
        want[(r.doc_id, r.source, r.size)] = r.copies
    each = [(d, s, len(WORD.findall(t or ""))) for d, s, t, _ in docs]
    assert Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in mixing.mix(df).collect()) == Counter(k for k in each for _ in range(want[k]))
    assert mixing.mix(df.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(docs, op5_mixing(spark, sf).collect(), lambda s, t: 0.005 * t + 20)
