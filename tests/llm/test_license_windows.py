import random

from millrace.llm import license_scan as ls

TEXTS = dict(ls.WHOLE)
PROSE = "some words about gardens and rivers that nobody has licensed under anything yet. "


def test_across_breaks_and_inside_lines(spark):
    bsd2 = ls.WHOLE[0][1].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ").replace(" THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS")
    bsd3 = TEXTS["BSD-3-Clause"].replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ")
    apache = next(t for n, t in ls.TEMPLATES if n == "Apache-2.0" and len(t) > 100).replace(" You may obtain", "\n\nYou may obtain").replace(" Unless", "\n\nUnless")
    want = [(bsd2, "BSD-2-Clause"), (PROSE * 9 + bsd2 + PROSE, "BSD-2-Clause"), (PROSE + bsd3 + "\n" + PROSE, "BSD-3-Clause"), (PROSE + "\n" + apache, "Apache-2.0")]
    want += [("This page was last changed in May. Released under the MIT License.", "MIT"), (PROSE * 300, None)]
    want += [(PROSE * 20 + TEXTS[n] + PROSE * 20, n) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "MIT")]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {r.doc_id: (r.window_license, r.window_score > 0.99) for r in ls.scanned(df).collect()}
    assert [got[k] for k in range(len(want))] == [(n, n is not None) for _, n in want]


def test_no_window_is_better():
    rng = random.Random(4)
    templates = [("a", "one two three four five six seven eight nine ten"), ("b", "six seven six one two two two")]
    own = ls.Windows(templates)
    words = "one two three four five six seven eight nine ten other".split()
    for _ in range(300):
        text = " ".join(rng.choice(words) if rng.random() < 0.2 else words[(k + _) % 11] for k in range(rng.randrange(1, 40)))
        parts = text.split()
        best = {}
        for i in range(len(parts)):
            for j in range(i + 2, len(parts) + 1):
                for name, t in templates:
                    a, b = ls.bigrams(" ".join(parts[i:j])), ls.bigrams(t)
                    best[name] = max(best.get(name, 0.0), 2 * len(a & b) / (len(a) + len(b)))
        reach = {n: s for n, s in best.items() if s >= ls.THRESHOLD}
        name, score = own.best(text)
        assert (name is None) == (not reach) and (name is None or score == reach[name])


def test_long_repeats_and_nothing():
    own = ls.Windows()
    for text in (None, "", "x", "word " * 100_000, "licensed under the " * 30_000):
        assert own.best(text) == (None, 0.0)
    assert own.best("under the MIT and released Licence. " * 2_000 + "Released under the MIT License")[0] == "MIT"
