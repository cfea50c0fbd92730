"""The near-duplicate stage on rows that share an id or have none."""

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(word, n=40):
    return " ".join(f"{word}{chr(97 + i % 26)}{i}" for i in range(n))


def test_rows_are_judged_one_by_one(spark):
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("c")),  # only the copy goes
            (5, text("d")), (None, text("d")), (None, text("d") + " more"),  # copies of a document with an id
            (7, text("e")), (7, text("f")), (7, text("f")),  # one id, unlike texts
            (9, text("g")), (8, text("g") + " more"), (8, text("h")),  # 8 stays for 9, and its other row too
            (11, text("i")), (12, text("j")), (3, text("b"))]  # an id goes before none
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    got = P.near_copies(spark, df, "")
    assert got.columns == df.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.select("doc_id", "text").collect()), key=key) == [
        (3, text("b")), (5, text("d")), (7, text("e")), (7, text("f")), (8, text("g") + " more"), (8, text("h")),
        (11, text("i")), (12, text("j")), (None, text("a")), (None, text("c"))]
