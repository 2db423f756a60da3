from zlib import crc32


from drumlin.llm import langid
from drumlin.llm.common import table
from tests.llm.frames import docs, rows

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    frame = table(spark, SF_DIR, "documents")
    found = langid.predictions(frame).join(frame.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(found) == frame.count()
    for r in found:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    judged = [r for r in found if r.held_out and r.lang and any(map(str.isalpha, r.text or ""))]
    assert sum(r.lang_pred == r.lang for r in judged) >= 0.98 * len(judged) > 0


def test_backoff_by_hand():
    import pandas as pd

    counts = [("x", 0, "ab", 3), ("y", 0, "cd", 1), ("x", 1, "a", 3), ("y", 1, "c", 9), ("x", 2, "^a", 3), ("y", 2, "^c", 1)]
    model = langid.fit(pd.DataFrame(counts, columns=["lang", "n", "gram", "count"]), 2)
    scorer = langid.Scorer(model)
    assert scorer.predict("ab")[0] == "x" and scorer.predict("CD")[0] == "y"
    # Unseen: the pair ^a is known, so single letters are not asked.
    assert scorer.predict("azc")[0] == "x"
    # No pair is known, the letter c is.
    assert scorer.predict("zcz")[0] == "y"
    assert scorer.predict("zzz") == ("x", 0.5)  # nothing is known: a tie
    assert scorer.predict("12 ²") == scorer.predict("") == ("und", 0.0)


def test_edge_cases(spark):
    for frame in (docs(spark), docs(spark, extra=True)):
        found = langid.predictions(frame).collect()
        assert len(found) == len(rows())
        by = {r.doc_id: r for r in found}
        assert {i for i in by if by[i].lang_pred == "und"} == {3, 4, 5, 9}
        assert by[6].lang_pred == "de" and by[8].lang_pred == "en"
    assert langid.predictions(docs(spark, empty=True)).count() == 0
    unlabelled = docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.predictions(unlabelled).collect()} == {"und"}


def test_other_columns_stay(spark):
    model = langid.train(docs(spark))
    found = langid.identify(docs(spark, extra=True), model)
    assert set(found.columns) == set(docs(spark, extra=True).columns)
    assert dict(found.dtypes)["score"] == "double"


def test_memory_is_bounded(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(langid, "MEMO", 2)
    scorer = langid.Scorer(langid.fit(pd.DataFrame([("x", 0, "ab", 3), ("x", 1, "a", 3)], columns=["lang", "n", "gram", "count"]), 1))
    for text in ("q w e r t y", "ab z", "u i o p ab"):
        assert scorer.predict(text)[0] == "x"
    assert len(scorer.rows) <= 1 + 2 + 6


