"""Collocations against plain counting, and the trie against a dictionary."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from drumlin.llm import collocations
from tests.llm.frames import DOCS, docs, plain, rows

WORDS = ["new", "york", "city", "of", "the", "hall", "é", "New"]


def counts(found):
    """Occurrences of phrases of 1 to 5 words by language."""
    out = defaultdict(Counter)
    for text, lang in found:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    out[lang or "und"][tuple(words[i : i + k])] += 1
    return out


def brute(found, least, best):
    out = []
    for lang, f in counts(found).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scores = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in candidates.items()
            )
            if not inside:
                score, cut = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scores.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def made(seed, texts):
    random = np.random.default_rng(seed)
    found = []
    for i in range(texts):
        words = random.choice(WORDS, size=random.integers(0, 60), p=[0.25, 0.2, 0.1, 0.15, 0.1, 0.1, 0.05, 0.05])
        gaps = random.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "], size=len(words), p=[0.8, 0.03, 0.03, 0.04, 0.03, 0.03, 0.02, 0.02])
        found.append(("".join(w + g for w, g in zip(words, gaps, strict=True)), [None, "en", "de"][i % 3]))
    return found + [("New York City Hall. " * 200, "en"), (None, "fr"), ("", "fr"), ("  x y z", "fr")]


@pytest.mark.parametrize("sizes", [collocations.Sizes(), collocations.Sizes(3, 40, 64)])
def test_against_plain_counting(spark, sizes):
    """With small sizes containers burst, subtrees are spilled, and the filter is nearly full."""
    found = made(4, 60)
    frame = spark.createDataFrame([(i, *x) for i, x in enumerate(found)], "doc_id long, text string, lang string").repartition(3)
    for least, best in ((5, 2000), (12, 7)):
        got = collocations.collocations(frame, least=least, best=best, sizes=sizes).collect()
        assert sorted(map(tuple, got)) == brute(found, least, best)


def test_trie_counts_like_a_dictionary():
    random = np.random.default_rng(1)
    words = np.array([f"w{i}".encode() for i in range(12)], object)
    for k in (1, 2, 3, 5):
        trie, want, got = collocations.HatTrie(k, 4), Counter(), Counter()
        for _ in range(6):
            part = np.unique(random.integers(0, 12, size=(300, k)), axis=0)
            n = random.integers(1, 9, size=len(part))
            trie.add(part, n, words)
            for row, c in zip(part.tolist(), n.tolist(), strict=True):
                want[b" ".join(words[row])] += c
            for run in trie.spill(50, hot=frozenset([b"w3"])):
                unpack(run, got)
            assert trie.size <= 50
        for run in trie.spill(0):
            unpack(run, got)
        assert got == want and not trie.size and not trie.root


def unpack(run, got):
    for prefix, _, rests, counts, _ in run.itertuples(index=False):
        rests = rests.split(b"\n")
        assert rests == sorted(rests) and len(rests) == len(counts)
        for rest, f in zip(rests, counts.tolist(), strict=True):
            got[prefix + b" " + rest if prefix else rest] += f


def test_long_text_is_cut_between_pieces():
    text = "a b c. " * 40 + "d " * 60 + "; e f"
    seen = Counter()
    for codes, words in collocations.coded([text, "", "x y"], 50):
        parts, part = [], []
        for c in codes.tolist():
            if c < 0:
                parts.append(part)
                part = []
            else:
                part.append(words[c].decode())
        for p in [*parts, part]:
            seen[" ".join(p)] += bool(p)
    assert +seen == Counter({"a b c": 40, " ".join(["d"] * 60): 1, "e f": 1, "x y": 1})


def test_exact_beyond_64_bits(spark):
    """1000 * a * n of numbers near 10 ** 12."""
    big = 10**12
    found = spark.createDataFrame(
        [("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big + 1), ("en", 2, "a b", big + 7)], "lang string, k int, phrase string, f long"
    )
    totals = spark.createDataFrame([("en", 7 * big + 3)], "lang string, n long")
    row = collocations.scored(found, totals).first()
    assert row.score == 1000 * (big + 7) * (7 * big + 3) // (3 * big * (2 * big + 1))


def test_edge_cases(spark):
    text = [(r[1], r[2]) for r in rows()]
    for frame in (docs(spark), docs(spark, extra=True).selectExpr("*", "1 as n", "2 as f", "3 as phrase", "4 as prefix")):
        got = collocations.collocations(frame, least=20)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(text, 20, 2000)
    assert plain(collocations.registered(docs(spark, empty=True))) == []
    assert plain(collocations.registered(spark.createDataFrame([(1, None, None, None, 0), (2, " .\n", "en", None, 0)], DOCS))) == []
