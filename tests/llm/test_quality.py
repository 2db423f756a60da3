import random
from collections import Counter

import numpy as np

from drumlin.llm import quality
from drumlin.llm.common import table
from tests.llm.frames import docs, rows

SF_DIR = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if twice[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_counts(spark):
    random.seed(4)
    texts = ["", " ", "a b c d e a b c d e", "x\n\nx\nx \n", "é\xa0ü #*", "\x1c a\x0bb"]
    texts += [" ".join(random.choice("abc") for _ in range(random.randrange(40))) for _ in range(60)]
    found = quality._stats(texts)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r) for r in found[names].itertuples(index=False)] == [brute(t) for t in texts]


def test_whole_table(spark):
    frame = table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in frame.collect()}
    found = quality.verdicts(frame).collect()
    assert len(found) == len(texts)
    for r in found:
        n, chars, symbols, lines, repeats = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.base_failed and r.kept)


def test_half_leaves_outliers_out():
    rng = np.random.default_rng(0)
    clean = rng.normal(0, 1, (300, quality.FEATURES))
    bad = rng.normal(9, 0.5, (90, quality.FEATURES))
    at = quality.half(np.vstack([clean, bad]))
    assert len(at) >= 195 and at.max() < 300


def test_outliers_are_found_whatever_the_shards(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 0.3, (900, quality.FEATURES)), rng.normal(6, 0.3, (100, quality.FEATURES))])
    rows_ = [(i, "en", "hot" if i % 10 else f"s{i % 3}", [float(v) for v in row]) for i, row in enumerate(x)]
    stats = spark.createDataFrame(rows_, "doc_id long, lang string, source string, vector array<double>")
    for shard_rows in (150, 100_000):
        found = {r.doc_id: r.outlier for r in quality.outliers(stats, shard_rows=shard_rows, least=30).collect()}
        assert len(found) == 1000
        assert all(found[i] for i in range(900, 1000)) and sum(found[i] for i in range(900)) == 0


def test_cutoff_is_a_chi_square_quantile():
    assert abs(quality.CUTOFF - 22.4577) < 1e-3
    assert abs(quality.chi2_quantile(0.5, 6) - 5.3481) < 1e-3 and quality.consistency(1.0) == 1
    assert abs(quality.small_sample(10**6) - 1) < 1e-3
    few = np.random.default_rng(3).normal(0, 1, (100_000, 21, quality.FEATURES))
    d = few[:, 20] - few[:, :20].mean(axis=1)
    spread = few[:, :20] - few[:, :20].mean(axis=1, keepdims=True)
    cov = np.einsum("kij,kil->kjl", spread, spread) / 19
    far = np.einsum("ki,ki->k", d, np.linalg.solve(cov, d[..., None])[..., 0]) > 26
    assert abs(far.mean() - quality.hotelling_above(26.0, 20)) < 0.002
    x = np.random.default_rng(2).normal(0, 1, (40_000, quality.FEATURES))
    near = x[np.argsort((x**2).sum(axis=1))[:20_000]]
    assert np.allclose(near.var(axis=0) * quality.consistency(0.5), 1, atol=0.04)


def test_junk_goes_and_clean_texts_stay(spark):
    """In every language and source alike, whatever their sizes."""
    rng = random.Random(7)
    words = [[c + "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 9))) for _ in range(400)] for c in "dem"]
    given, junk = [], set()
    for n, (lang, source) in enumerate([("de", "a")] * 150 + [("en", "a")] * 600 + [("en", "b")] * 90 + [("es", "c")] * 40 + [("es", "d")] * 40):
        own = words[("de", "en", "es").index(lang)]
        some = [rng.choice(own) for _ in range(rng.randrange(40, 300))]
        text = ". ".join(" ".join(some[i : i + 9]) for i in range(0, len(some), 9))
        if n % 15 == 4:
            junk.add(n)
            plain = len(some) * 3 // 10
            text = " ".join(some[:plain]) + " " + " | ".join(some[plain:])
        given.append((n, text, lang, source))
    found = quality.verdicts(spark.createDataFrame(given, "doc_id long, text string, lang string, source string")).collect()
    assert len(found) == len(given) and not any(r.base_failed for r in found)
    assert {r.doc_id for r in found if not r.kept} == junk


def test_edge_cases(spark):
    for frame in (docs(spark), docs(spark, extra=True)):
        found = quality.verdicts(frame).collect()
        assert len(found) == len(rows())
        by = {r.doc_id: r for r in found}
        assert by[3].base_failed and by[4].base_failed and by[8].base_failed and by[1].kept  # too few rows to judge
    assert quality.verdicts(docs(spark, empty=True)).count() == 0
