from collections import Counter

from millrace.llm import mixing


def test_units_that_bitmaps_cannot_tell_apart(spark):
    """Units of one id and source differ in size only, so both bitmaps hold them; the mix is still what was drawn."""
    rows = [(k % 3 if k % 5 else None, source, "w " * (k + 1)) for source in ("a", "b", None) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    drawn = mixing.mixed(df).collect()
    want = Counter({(r.doc_id, r.source, r.size): r.copies * r.times for r in drawn if r.copies})
    assert len({r.copies for r in drawn}) > 1
    assert Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.mix(df).collect()) == want
