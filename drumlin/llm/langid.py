"""Language identification by word-first backoff.

A known word adds its log frequency in each language. An unseen word falls back to its character
n-grams, longest first: the first length of which the model knows any n-gram gives the mean of
their log frequencies, so that one word has one vote. Words are runs of letters, in lower case.

The model is fitted on a sample of labelled rows of about ``docs_per_lang`` documents a language
(a documented bound, which also bounds what reaches the driver); languages are taken to be a small
set of labels. Prediction reads the text alone, whole.

Results for edge cases: a text that is null or has no letter gets ``und`` with score 0, as does
every text if nothing could be learned; ties go to the first language by name; repeated rows get a
result each; other columns are kept, but for those named like a result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.llm.common import give_back, strings

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Unseen words a worker remembers.
MEMO = 100_000
SMOOTHING = 0.5


def words(text: str) -> list[str]:
    """Runs of letters; none if there are just numerals that aren't digits."""
    found = WORD.findall(text.lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Languages, the row of each word (order 0) and n-gram by order, and a row of log frequencies each."""

    langs: list[str]
    rows: list[dict[str, int]]
    logs: np.ndarray
    longest: int


def fit(counts: pd.DataFrame, longest: int) -> Model:
    """counts: lang, n (0: word), gram, count."""
    langs = sorted(set(counts["lang"]))
    keys = counts[["n", "gram"]].drop_duplicates().sort_values(["n", "gram"])
    rows: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    for i, (n, gram) in enumerate(zip(keys["n"].tolist(), keys["gram"].tolist(), strict=True)):
        rows[n][gram] = i
    table = np.zeros((len(keys), len(langs)))
    at = [rows[n][gram] for n, gram in zip(counts["n"].tolist(), counts["gram"].tolist(), strict=True)]
    table[at, [langs.index(x) for x in counts["lang"]]] = counts["count"]
    order = keys["n"].to_numpy()
    for n in set(order.tolist()):
        part = table[order == n] + SMOOTHING
        table[order == n] = np.log(part / part.sum(axis=0))
    return Model(langs, rows, table.astype(np.float32), longest)


def train(docs: DataFrame, *, docs_per_lang: int = 800, longest: int = 4, seed: int = 7) -> Model:
    """The model of the rows' ``text`` and ``lang``; rows without either teach nothing."""
    labelled = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg((docs_per_lang / F.count("*")).alias("_share"))
    drawn = F.pmod(F.xxhash64("doc_id", "lang", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    sample = labelled.join(F.broadcast(sizes), "lang").where(drawn < F.col("_share"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found.setdefault(lang, Counter()).update(words(text))
        for lang, seen in found.items():
            total = Counter({(0, w): c for w, c in seen.items()})
            for w, c in seen.items():
                for n in range(1, longest + 1):
                    for g in grams(w, n):
                        total[n, g] += c
            yield pd.DataFrame(
                [(lang, n, g, c) for (n, g), c in total.items()], columns=["lang", "n", "gram", "count"]
            )

    counts = sample.select("lang", "text").mapInPandas(count, "lang string, n int, gram string, count long")
    return fit(counts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count")).toPandas(), longest)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known = model.rows[0]
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}  # of unseen words
        self.logs = self.model.logs
        self.size = len(self.logs)

    def unseen(self, word: str) -> np.ndarray:
        for n in range(self.model.longest, 0, -1):
            at = [i for g in grams(word, n) if (i := self.model.rows[n].get(g)) is not None]
            if at:
                return self.model.logs[at].mean(axis=0)
        return np.zeros(len(self.model.langs), np.float32)

    def learn(self, new: set[str]) -> None:
        if self.size + len(new) > len(self.logs):
            more = max(len(new), len(self.logs) // 2)
            self.logs = np.concatenate([self.logs, np.zeros((more, len(self.model.langs)), np.float32)])
        for word in new:
            self.logs[self.size] = self.unseen(word)
            self.rows[word] = self.size
            self.size += 1

    def predict(self, text: str) -> tuple[str, float]:
        found = words(text)
        if not found or not self.model.langs:
            return UNKNOWN, 0.0
        known, rows = self.known, self.rows
        new = {w for w in found if w not in known and w not in rows}
        if new:
            if len(rows) + len(new) > MEMO:
                self.forget()
                rows = self.rows
                new = {w for w in found if w not in known}
            self.learn(new)
        at = [known[w] if w in known else rows[w] for w in found]
        sums = self.logs[at].sum(axis=0, dtype=np.float64)
        best = int(sums.argmax())
        return self.model.langs[best], float(1 / np.exp(sums - sums[best]).sum())


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` (0 to 1: the best language's posterior)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = [docs.schema[c] for c in keep]
    results = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [scorer.predict(x) for x in strings(batch[text])]
            batch["lang_pred"] = [x for x, _ in found]
            batch["score"] = [x for _, x in found]
            yield batch
        del scorer
        give_back()

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInPandas(run, T.StructType(fields + results))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the model may not learn from a document; false for a null id, which isn't learnt from either."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))
    return F.coalesce(rest == 1, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document; learns from those not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()).where("doc_id is not null"))
    found = identify(docs.select("doc_id", "text").withColumn("held_out", held_out()), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
