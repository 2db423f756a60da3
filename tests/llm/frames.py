"""Small tables with every awkward case."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "score string, lang_pred long, spans string, ids string, epoch string, severity string, node string, kept string"


def rows():
    plain = "the quick brown fox jumps over the lazy dog and then it sleeps for a while under the tree"
    german = "der schnelle braune fuchs springt über den faulen hund und schläft dann unter dem baum"
    found = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (5, " \n\t ", "de", "b"),
        (6, german, "de", "b"),
        (7, german + " mail me at x.y@example.com or +1 (212) 555-0100", "de", None),
        (8, (plain + " ") * 3000, None, "a"),
        (9, "!!! 123 ... ???", "en", "b"),
        (None, "a row without an id but with words enough to count as a document", "en", "a"),
        (10, "one two three", "en", "b"),
    ]
    return [(*x, len(x[1]) if x[1] else 0) for x in found]


def docs(spark, extra=False, empty=False):
    frame = spark.createDataFrame([] if empty else rows(), DOCS)
    if extra:
        for name, kind in (c.split() for c in EXTRA.split(", ")):
            frame = frame.selectExpr("*", f"cast(null as {kind}) as {name}")
    return frame


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
