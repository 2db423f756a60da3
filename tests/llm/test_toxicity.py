import random

import numpy as np

from drumlin.llm import toxicity
from drumlin.llm.common import table
from tests.llm.frames import docs, rows

SF_DIR = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_gradients_lower_the_loss_and_grades_are_ordered():
    random.seed(1)
    n, words = 300, 12
    grades = np.array([i % 4 for i in range(n)])
    r, c = [], []
    for i, g in enumerate(grades):
        for w in {*random.sample(range(4, words), 3), *range(g)}:
            r.append(i)
            c.append(w)
    w, cuts = toxicity.fit(np.array(r), np.array(c), grades, words)
    assert (np.diff(cuts) > 0).all()
    model = toxicity.Model({f"w{i}": x for i, x in enumerate(w)}, cuts)
    z = np.bincount(r, weights=w[c], minlength=n)
    severity = (1 / (1 + np.exp(cuts - z[:, None]))).sum(axis=1)
    means = [severity[grades == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5
    assert model.severity("") == 0


def test_held_out(spark):
    """Learns from even documents; odd labelled ones are told apart."""
    frame, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    model = toxicity.train(frame, labels.where("doc_id % 2 = 0"))
    odd = frame.join(labels.where("doc_id % 2 = 1"), "doc_id").select("doc_id", "text", labels.toxic.alias("truth"))
    found = toxicity.score(odd, model).collect()
    bad = [r for r in found if r.truth == 1]
    clean = [r for r in found if r.truth == 0]
    assert sum(r.toxic for r in bad) >= 0.85 * len(bad) > 0
    assert sum(r.toxic for r in clean) <= 0.02 * len(clean)


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, 0), (6, 0, 0), (7, 0, None), (None, 1, 1)], LABELS)
    for frame in (docs(spark), docs(spark, extra=True)):
        found = toxicity.registered(frame, labels).collect()
        assert len(found) == len(rows())
        assert all(0 <= r.severity <= 3 for r in found)
        assert [r.severity for r in found if r.doc_id in (3, 4, 5)] == [0, 0, 0]
    assert toxicity.registered(docs(spark, empty=True), labels).count() == 0
    none = toxicity.registered(docs(spark), spark.createDataFrame([], LABELS)).collect()
    assert len(none) == len(rows()) and not any(r.toxic for r in none)
    scored = toxicity.score(docs(spark, extra=True), toxicity.Model({}, np.zeros(0)))
    assert set(scored.columns) == set(docs(spark, extra=True).columns) | {"toxic"}
