"""Quality rules: base counts of a text, and robust multivariate outliers per language and source.

Each document becomes a vector of transformed counts. The minimum-covariance-determinant estimate
of a (language, source) group gives its centre and spread; documents with a large Mahalanobis
distance, above the 0.999 quantile of chi-square, are rejected. A group is dealt to shards of bounded size by a hash, as nested fast-MCD
does: each shard finds the half of its rows with the smallest determinant by concentration steps
from several starts, and the moments of these halves, which just add up, make the group's estimate.
So every row takes part, and a group with a third of all rows is many tasks.

Results for edge cases: null text has no words and fails the base rules; null languages and
sources are groups of their own; groups with fewer than ``least`` rows pool their language, and
where that is too small too, nothing is rejected; repeated rows count each; tables may be empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.llm.common import chunks, staged, strings

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
FEATURES = 6
#: Least spread of each feature, so that groups in which nearly all rows agree reject no small change:
#: its square is added once to each covariance.
FLOOR = np.array([0.6, 0.08, 0.06, 0.12, 0.12, 0.08])
STAT_COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, vector array<double>"


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def _codes(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def _repeats(words: list[list[bytes]]) -> np.ndarray:
    """Words in windows of five that occur twice or more in the same text, for each text."""
    sizes = np.array([len(x) for x in words], np.int64)
    total = np.zeros(len(words), np.int64)
    n = int(sizes.sum())
    if n < WINDOW:
        return total
    ids = _codes(np.array([w for x in words for w in x], dtype=object))
    doc = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    start = np.flatnonzero(np.arange(n) + WINDOW <= ends)
    if not len(start):
        return total
    # Windows as numbers: pairs of words, pairs of pairs, then the fifth word and the text.
    v = int(ids.max()) + 1
    pair = _codes(ids[:-1] * v + ids[1:])
    four = _codes(pair[:-2] * (int(pair.max()) + 1) + pair[2:])
    five = _codes(four[start] * v + ids[start + 4])
    own = five * len(words) + doc[start]
    twice = pd.Series(own).duplicated(keep=False).to_numpy()
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start[twice], 1)
    np.add.at(edge, start[twice] + WINDOW, -1)
    np.add.at(total, doc[np.cumsum(edge[:-1]) > 0], 1)
    return total


def _stats(texts: list[str]) -> pd.DataFrame:
    words = [x.encode("utf-8", "surrogatepass").split() for x in texts]
    n = np.array([len(x) for x in words], np.int64)
    chars = np.array([len(x) - sum(map(x.count, SPACES)) for x in texts], np.int64)
    symbols = np.array([sum(map(x.count, SYMBOLS)) for x in texts], np.int64)
    lines = np.array([_dup_lines(x) for x in texts], np.int64)
    repeats = _repeats(words)
    some = np.maximum(n, 1)
    vector = np.column_stack([
        np.log1p(n),
        np.log1p(chars / some),
        np.sqrt(symbols / np.maximum(chars, 1)),
        np.sqrt(np.minimum(lines / np.array([x.count("\n") + 1 for x in texts]), 1)),
        np.sqrt(repeats / some),
        np.sqrt(np.array([sum(map(x.count, "!?|=_/\\")) for x in texts]) / np.maximum(chars, 1)),
    ])
    return pd.DataFrame(
        {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeats, "vector": list(vector)}
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts and vector of each document's whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = strings(batch.pop("text"))
            for start, end in chunks(texts):
                yield pd.concat([batch[start:end].reset_index(drop=True), _stats(texts[start:end])], axis=1)

    columns = docs.select("doc_id", "lang", "source", "text")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns.schema if f.name != "text")
    return columns.mapInPandas(run, f"{kept}, {STAT_COLUMNS}")


def half(rows: np.ndarray, *, starts: int = 4, steps: int = 12, seed: int = 1) -> np.ndarray:
    """Which rows make up the half with the smallest covariance determinant found."""
    n, p = rows.shape
    h = (n + p + 1) // 2
    rng = np.random.default_rng(seed)
    centre = np.median(rows, axis=0)
    scale = np.maximum(np.median(np.abs(rows - centre), axis=0) * 1.4826, FLOOR)
    firsts = [np.argsort((((rows - centre) / scale) ** 2).sum(axis=1), kind="stable")[:h]]
    firsts += [rng.choice(n, p + 1, replace=False) for _ in range(starts) if n > p + 1]
    best, least = firsts[0], np.inf
    for at in firsts:
        for _ in range(steps):
            mean, cov = _moments(rows[at])
            new = np.sort(np.argsort(distances(rows, mean, cov), kind="stable")[:h])
            if len(new) == len(at) and (new == at).all():
                break
            at = new
        size = np.linalg.slogdet(_moments(rows[at])[1])[1]
        if size < least - 1e-9:
            best, least = at, size
    return best


def _moments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = rows.mean(axis=0)
    return mean, (rows - mean).T @ (rows - mean) / len(rows) + np.diag(FLOOR**2)


def distances(rows: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """Squared Mahalanobis distances."""
    d = rows - mean
    return np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d)


def chi2_above(x: float, degrees: int) -> float:
    """Share of a chi-square distribution above x; its degrees are even."""
    return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))


def hotelling_above(x: float, n: int) -> float:
    """Share of normal rows whose squared distance is above x if mean and covariance come from n other rows."""
    y, a = 1 / (1 + x * n / ((n + 1) * (n - 1))), (n - FEATURES) / 2
    return y**a * sum(math.prod((a + k) / (k + 1) for k in range(i)) * (1 - y) ** i for i in range(FEATURES // 2))


def _exceeded(share: float, above: Callable[[float], float]) -> float:
    low, high = 0.0, 1e9
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > share else (low, middle)
    return high


def chi2_quantile(share: float, degrees: int) -> float:
    return _exceeded(1 - share, lambda x: chi2_above(x, degrees))


def consistency(share: float) -> float:
    """How much narrower than all rows the covariance of that share of them is, the nearest ones, if they are normal."""
    return share / (1 - chi2_above(chi2_quantile(share, FEATURES), FEATURES + 2)) if share < 1 else 1.0


#: Squared distance that one in a thousand normal rows exceeds.
CUTOFF = chi2_quantile(0.999, FEATURES)


def small_sample(n: int) -> float:
    """How much farther that distance is where mean and covariance come from n rows only."""
    return _exceeded(0.001, lambda x: hotelling_above(x, max(n, FEATURES + 1))) / CUTOFF


def outliers(stats: DataFrame, *, cutoff: float = CUTOFF, least: int = 60, shard_rows: int = 4000) -> DataFrame:
    """The rows with ``distance`` (squared, robust; null in groups too small to judge) and
    ``outlier``: distance above ``cutoff``. Needs lang, source, vector and an id doc_id."""
    # Small groups pool their language: their group is null within it.
    sizes = (
        stats.groupBy("lang", "source")
        .agg(F.count("*").alias("_n"))
        .withColumn("_group", F.when(F.col("_n") >= least, F.struct("source")))
    )
    shards = sizes.groupBy(F.col("lang").alias("_l"), F.col("_group").alias("_g")).agg(
        F.ceil(F.sum("_n") / shard_rows).cast("int").alias("_shards")
    )
    plan = staged(
        sizes.join(shards, F.col("lang").eqNullSafe(F.col("_l")) & F.col("_group").eqNullSafe(F.col("_g"))).select(
            F.col("lang").alias("_l"), F.col("source").alias("_s"), "_group", "_shards"
        ),
        "mcd-groups",
    )
    dealt = (
        stats.join(plan, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
        .drop("_l", "_s")
        .withColumn("_shard", F.pmod(F.xxhash64("doc_id", "source", "vector", F.lit(3)), F.col("_shards")).cast("int"))
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.array(rows["vector"].tolist(), dtype=float)
        if len(x) < 2 * (FEATURES + 1):  # too few to find a half among: counted whole
            at = np.arange(len(x))
        else:
            x = x[np.lexsort(x.T)]  # the order rows arrive in doesn't matter
            at = half(x)
        y = x[at]
        return pd.DataFrame(
            {"n": [len(x)], "h": [len(y)], "s": [y.sum(axis=0)], "ss": [(y.T @ y).ravel()]}
        ).assign(lang=rows["lang"].iloc[0], _src=rows["source"].iloc[0], _pooled=bool(rows["_pooled"].iloc[0]))

    lang_type, source_type = (stats.schema[c].dataType.simpleString() for c in ("lang", "source"))
    halves = dealt.select("lang", "source", F.isnull("_group").alias("_pooled"), "_group", "_shard", "vector").groupBy("lang", "_group", "_shard").applyInPandas(
        fit,
        f"n long, h long, s array<double>, ss array<double>, lang {lang_type}, _src {source_type}, _pooled boolean",
    )
    halves = halves.withColumn("_group", F.when(~F.col("_pooled"), F.struct(F.col("_src").alias("source"))))
    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(FEATURES)]
    squares = [F.sum(F.col("ss")[i]).alias(f"ss{i}") for i in range(FEATURES * FEATURES)]
    models = staged(
        halves.groupBy("lang", "_group")
        .agg(F.sum("n").alias("n"), F.sum("h").alias("h"), *sums, *squares)
        .where(F.col("n") >= least)
        .select(
            "lang",
            "_group",
            "n",
            "h",
            F.array(*[F.col(f"s{i}") for i in range(FEATURES)]).alias("s"),
            F.array(*[F.col(f"ss{i}") for i in range(FEATURES * FEATURES)]).alias("ss"),
        ),
        "mcd-models",
    )
    models = models.withColumnRenamed("lang", "_l").withColumnRenamed("_group", "_g")
    judged = dealt.join(models, F.col("lang").eqNullSafe(F.col("_l")) & F.col("_group").eqNullSafe(F.col("_g")), "left")
    keep = stats.columns

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inverses: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            found = np.full(len(batch), np.nan)
            for i, (v, h, n, s, ss) in enumerate(zip(*[batch[c] for c in ("vector", "h", "n", "s", "ss")], strict=True)):
                if s is None:
                    continue
                key = np.asarray(s).tobytes()
                if key not in inverses:
                    mean = np.asarray(s) / h
                    cov = np.asarray(ss).reshape(FEATURES, FEATURES) / h - np.outer(mean, mean)
                    cov = cov * consistency(h / n) * small_sample(h) + np.diag(FLOOR**2)
                    inverses[key] = mean, np.linalg.inv(cov)
                mean, inverse = inverses[key]
                d = np.asarray(v) - mean
                found[i] = d @ inverse @ d
            batch["distance"] = found
            yield batch[[*keep, "distance"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema) + ", distance double"
    measured = judged.select(*keep, "h", "n", "s", "ss").mapInPandas(measure, schema)
    return measured.select(
        *keep, F.nanvl("distance", F.lit(None).cast("double")).alias("distance")
    ).withColumn("outlier", F.coalesce(F.col("distance") > cutoff, F.lit(False)))


def verdicts(docs: DataFrame) -> DataFrame:
    """Base counts and rules of each document, and whether it is kept."""
    stats = staged(statistics(docs), "quality-stats")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        outliers(stats)
        .withColumn("base_failed", failed)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & ~F.col("outlier")).alias("kept"), "distance",
        )
    )
