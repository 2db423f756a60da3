from collections import Counter, defaultdict

from pyspark.sql import functions as F

from drumlin.llm import mixing
from tests.llm.frames import docs


def corpus(spark, sizes):
    """sizes: (domain, lang, source) to number of documents of 10 tokens."""
    rows, n = [], 0
    for (domain, lang, source), count in sizes.items():
        for _ in range(count):
            rows.append((n, "x" * 40, lang, source, domain))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")


def mixed(frame, budget, epochs=2, domain_weight=None):
    weights = {"domain": domain_weight if domain_weight is not None else F.lit(1), "lang": F.lit(1), "source": F.lit(1)}
    found = mixing.mix(
        frame.drop("domain"), domain=F.element_at(F.split("source", "-"), 1), weights=weights, budget=F.expr(str(budget)), epochs=epochs
    )
    return found.collect()


SIZES = {("a", "en", "a-1"): 100, ("a", "en", "a-2"): 10, ("a", "de", "a-3"): 100, ("b", "en", "b-1"): 300}


def test_shortage_goes_to_siblings_first(spark):
    rows = mixed(corpus(spark, SIZES), 4000, epochs=1)
    n = Counter(r.source for r in rows)
    # a and b get 2000 each. en and de of a get 1000 each; a-2 of en holds 100, a-1 gets the 900 left.
    assert n["a-2"] == 10 and n["a-1"] == 90 and n["a-3"] == 100 and n["b-1"] == 200


def test_then_to_the_ancestors_children(spark):
    rows = mixed(corpus(spark, SIZES), 5000, epochs=1)
    n = Counter(r.source for r in rows)
    # a holds 2100 of its 2500; b takes the rest.
    assert n["a-1"] == 100 and n["a-2"] == 10 and n["a-3"] == 100 and n["b-1"] == 290


def test_epochs(spark):
    rows = mixed(corpus(spark, SIZES), 6000, epochs=2, domain_weight=F.when(F.col("domain") == "a", 3).otherwise(1))
    seen = defaultdict(Counter)
    for r in rows:
        seen[r.source][r.epoch] += 1
        assert r.epoch in (0, 1)
    assert seen["a-2"] == {0: 10, 1: 10}  # read in both epochs
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    again = mixed(corpus(spark, SIZES), 6000, epochs=2, domain_weight=F.when(F.col("domain") == "a", 3).otherwise(1))
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_all_is_drawn_if_the_budget_allows(spark):
    rows = mixed(corpus(spark, SIZES), 10**9, epochs=2)
    assert len(rows) == 2 * sum(SIZES.values())


def test_edge_cases(spark):
    found = mixing.registered(docs(spark, extra=True)).collect()
    assert {len(r) for r in found} == {len(docs(spark, extra=True).columns)}
    assert any(r.source is None for r in found)
    assert mixing.registered(docs(spark, empty=True)).count() == 0
    wordless = docs(spark).where("doc_id in (3, 4)")
    assert mixing.registered(wordless).count() == 0


def test_no_python(spark):
    text = mixing.registered(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
