import random

import numpy as np
import pytest

from millrace.llm import parity_join as pj
from millrace.llm.common import ascii_words, components
from millrace.llm.queries import op10_parity_join


def shingles(text, width):
    w = ascii_words(text)
    return ({tuple(w)} if len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}) if w else set()


def brute(rows, width, percent):
    sets = [shingles(t, width) if i is not None else set() for i, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by_shingle = {}
    for k, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    pairs = {}
    for ks in by_shingle.values():
        for a in range(len(ks)):
            for b in range(a):
                pairs[ks[b], ks[a]] = pairs.get((ks[b], ks[a]), 0) + 1
    for (a, b), same in pairs.items():
        if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
            up[root(a)] = root(b)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[root(k)] = min(smallest.get(root(k), i), i)
    return sorted(((i, len(shingles(t, width)), None if i is None else smallest[root(k)]) for k, (i, t) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed, bases, copies, change):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(4))
    texts = []
    for _ in range(bases):
        base = [word() for _ in range(rng.choice([1, 2, 4, 9, 12, 25, 60, 300]))]
        for _ in range(rng.randint(1, copies)):
            t = [w if rng.random() > change * rng.random() else word() for w in base]
            if rng.random() < 0.2:
                t = t[: int(len(t) * (0.85 + 0.15 * rng.random()))]
            texts.append(" ".join(t))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize(("bases", "copies", "change", "block"), [(60, 12, 0.08, 4096), (4, 120, 0.05, 4096), (2, 90, 0.06, 16)])
def test_against_brute_force(spark, width, percent, bases, copies, change, block):
    texts = corpus(bases, bases, copies, change)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, key int").repartition(5)
    assert got(pj.joined(df, width, percent, block)) == brute(rows, width, percent)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (9, "a B"), (5, "x"), (6, "x"), (6, "y"), (None, "a b"), (None, None), (7, long), (8, long + " end"), (8, "x"), (10, "漢 字 か な"), (11, "漢 字 か な"), (12, "İ x y z"), (13, "i̇ x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(pj.joined(df, 3, 90)) == brute(rows, 3, 90)
    assert pj.joined(df.limit(0), 3, 90).collect() == []


def test_one_of_each(spark):
    rows = [(i, t) for i, t in enumerate(corpus(9, 20, 6, 0.02))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    out = pj.one_of_each(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {c for _, _, c in brute(rows, 5, 80)}


def test_bound_is_never_too_small():
    for percent in (80, 90, 95):
        for a in range(1, 60):
            for b in range(a, 60):
                apart = [a + b - 2 * same for same in range(a + 1) if 100 * same >= percent * (a + b - same)]
                assert max(apart, default=-1) <= pj.most_apart(a + b, percent)
                if apart and a != b:
                    band = int(np.searchsorted(pj.BANDS, b, "right")) - 1
                    assert pj.plan(band, percent)[0] > max(apart) + pj.plan(band, percent)[1]


def test_components(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(300)] + [(rng.randint(400, 800), rng.randint(400, 800)) for _ in range(250)] + [(900, 900), (1000, 1001), (1001, 1000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    up = {}
    for _ in range(400):
        for a, b in links:
            m = min(up.get(a, a), up.get(b, b))
            up[a] = up[b] = m
    assert found == {k: v for k, v in up.items() if k != 900}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op10_parity_join(spark, sf)) == brute(rows, 3, 90)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_agrees_with_brute_force(sf):
    import duckdb

    from millrace.llm.queries import ORACLES

    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    rows = c.sql("SELECT doc_id, text FROM documents").fetchall()
    found = c.sql(ORACLES["op10_parity_join"])
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(found.fetchall(), key=str) == brute(rows, 3, 90)
