"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades run from 0 (clean) to 3. For thresholds t1 < t2 < t3, P(grade >= k) = sigmoid(w.x - tk): the
weights are shared, only the thresholds differ. x marks which words a text holds, and which beginnings of
words it holds once, twice or three times at least, as far as they are in a vocabulary. The result is the expected severity, the sum of these three probabilities.

The labels only say toxic or not. Toxic training texts are graded 1 to 3 by thirds of the number of
marker features in them, markers being those that most surely go with the toxic label. The model
is fitted on a sample of about ``rows_per_class`` labelled documents a class (a documented bound);
vocabulary and weights are bounded by ``vocabulary``.

Results for edge cases: null text or one without a word has severity 0 and is not toxic; with no
labelled documents of both classes everything has severity 0; of repeated labels of a document
toxic wins, null labels and ids teach nothing; repeated rows get a result each; other columns are
kept, but for those named like a result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.llm.common import staged, strings

WORD = re.compile(r"[^\W\d_]+")
GRADES = 3
#: Lengths of the beginnings of words, and how often they are counted.
LENGTHS = (5, 6, 7)
TIMES = 3
#: Words a worker remembers.
MEMO = 200_000


def beginnings(word: str) -> list[str]:
    return [word[:n] + "*" for n in LENGTHS if len(word) >= n]


def features(text: str) -> set[str]:
    """The text's words, and beginnings of words with how often (up to ``TIMES``) they occur."""
    words = Counter(WORD.findall(text.lower()))
    begun: Counter = Counter()
    for w, n in words.items():
        for p in beginnings(w):
            begun[p] += n
    return words.keys() | {f"{p}{k}" for p, n in begun.items() for k in range(1, min(n, TIMES) + 1)}


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray  # rising

    def __post_init__(self) -> None:
        self.begun = {x[:-1] for x in self.weights if x[-2:-1] == "*"}
        self.memo: dict[str, tuple[float, list[str]]] = {}

    def of(self, word: str) -> tuple[float, list[str]]:
        """A word's own weight, and its beginnings that have one."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = self.memo[word] = (self.weights.get(word, 0.0), [p for p in beginnings(word) if p in self.begun])
        return found

    def severity(self, text: str) -> float:
        words = Counter(WORD.findall(text.lower()))
        if not len(self.thresholds) or not words:
            return 0.0
        memo, parts, begun = self.memo, [], Counter()
        for w, n in words.items():
            weight, heads = memo.get(w) or self.of(w)
            if weight:
                parts.append(weight)
            for p in heads:
                begun[p] += n
        parts += [self.weights.get(f"{p}{k}", 0.0) for p, n in begun.items() for k in range(1, min(n, TIMES) + 1)]
        z = math.fsum(parts)
        return float((1 / (1 + np.exp(np.clip(self.thresholds - z, -50, 50)))).sum())


def fit(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_words: int, *, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the mean log loss. rows, columns: places of the ones in x."""
    n = len(grades)
    w, raw = np.zeros(n_words), np.array([2.0, 0.0, 0.0])  # raw: first threshold, logs of the gaps
    params = [w, raw]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=w[columns], minlength=n)
        cuts = raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])
        above = 1 / (1 + np.exp(-(z[:, None] - cuts)))  # P(grade >= k), k = 1, 2, 3
        edge = np.column_stack([np.ones(n), above, np.zeros(n)])
        slope = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        at = np.arange(n)
        p = np.maximum(edge[at, grades] - edge[at, grades + 1], 1e-9)
        dz = -(slope[at, grades] - slope[at, grades + 1]) / p / n
        dcut = np.zeros((n, GRADES + 2))
        dcut[at, grades] += slope[at, grades] / p / n
        dcut[at, grades + 1] -= slope[at, grades + 1] / p / n
        g = dcut[:, 1:-1].sum(axis=0)
        gaps = np.exp(raw[1:])
        grads = [np.bincount(columns, weights=dz[rows], minlength=n_words) + ridge * w, np.array([g.sum(), gaps[0] * g[1:].sum(), gaps[1] * g[2]])]
        for i, (param, grad) in enumerate(zip(params, grads, strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad**2
            param -= 0.05 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def train(docs: DataFrame, labels: DataFrame, *, rows_per_class: int = 2500, vocabulary: int = 4000, seed: int = 5) -> Model:
    marked = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in marked.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, np.zeros(0))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    share = F.when(F.col("toxic") == 1, rows_per_class / sizes[1]).otherwise(2 * rows_per_class / sizes[0])
    sample = marked.where("toxic in (0, 1)").where(drawn < share)  # bounded by rows_per_class

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "words": [sorted(features(x)) for x in strings(batch["text"])]})

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text").dropDuplicates()
    held = staged(texts.mapInPandas(cut, "toxic int, words array<string>"), "toxic-sample")
    counts = held.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    totals = held.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("a"), F.count("*").alias("n")).first()
    if not totals["a"] or totals["a"] == totals["n"]:
        return Model({}, np.zeros(0))
    odds = F.log((F.col("a") + 0.5) / (totals["a"] + 1)) - F.log((F.col("b") + 0.5) / (totals["n"] - totals["a"] + 1))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    chosen = (
        counts.where("a + b >= 3").withColumn("sure", F.round(sure, 9)).orderBy(F.desc(F.abs("sure")), "word").limit(vocabulary)
        .select("word", "sure").collect()
    )
    index = {r["word"]: i for i, r in enumerate(chosen)}
    surest = max((r["sure"] for r in chosen), default=0.0)
    marker = np.array([r["sure"] > max(3.0, surest / 3) for r in chosen], bool)
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [[sent.value[w] for w in words if w in sent.value] for words in batch["words"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "at": at})

    x = held.mapInPandas(places, "toxic int, at array<int>").toPandas()
    x = x.assign(key=[tuple(a) for a in x["at"]]).sort_values(["toxic", "key"], kind="stable")
    rows = np.repeat(np.arange(len(x)), [len(a) for a in x["at"]])
    columns = np.concatenate([np.zeros(0, np.int64), *x["at"]]).astype(np.int64)
    hits = np.bincount(rows, weights=marker[columns].astype(float), minlength=len(x))
    toxic = x["toxic"].to_numpy() == 1
    thirds = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + (hits > thirds[0]) + (hits > thirds[1]), 0)
    w, thresholds = fit(rows, columns, grades, len(index))
    return Model({word: float(w[i]) for word, i in index.items() if w[i]}, thresholds)


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows with ``severity`` (0 to 3, expected grade) and ``toxic`` (a grade of 1 or more is likelier than not)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("severity", "toxic")]
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["severity"] = [sent.value.severity(x) for x in strings(batch[text])]
            yield batch

    found = docs.select(*[F.col(f"`{c}`") for c in keep]).mapInPandas(
        run, T.StructType([*fields, T.StructField("severity", T.DoubleType())])
    )
    return found.withColumn("toxic", F.col("severity") >= 0.5)


def registered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", "severity", "toxic")
