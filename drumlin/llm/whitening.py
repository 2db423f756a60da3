"""Embedding whitening by weighted covariance of distinct vectors.

Entries become integers, x = floor(scale * c) + shift, so equal vectors are equal exactly. Equal
x-vectors are grouped, with a count each; counts (or ones) are the fit weights. Sums are integers;
the covariance is a weighted product of the vectors, centred first. Its eigenvectors whiten every
distinct vector once, and the rows get the result of their vector by a join. Everything that grows
with the rows stays in Spark: the driver sees sums and products of the dimensions only, which are
added up by Spark, and one error bound.

Results for edge cases: a row whose vector is null, or holds an entry that is null, not finite or of
2^53 / scale or more (its x would not be exact) takes no part; vectors of each length are a fit of
their own; repeated rows, and rows without an id, get a result each; components whose eigenvalue is
rounding noise (equal vectors, fewer vectors than dimensions) do not exist, so that empty vectors
and a single vector have none; no rows give no rows; a deviation of 2^63 or more is null. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drumlin.llm.common import staged

SCALE, SHIFT = 64, 1_000_000
#: Entries of all vectors handled at once.
BLOCK = 1 << 20
COUNTS, ONES = "counts", "ones"


def _exact(vector: Column) -> Column:
    def fine(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float(2**53 // SCALE)), F.lit(False))

    return vector.isNotNull() & F.forall(vector, fine)


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def keyed(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part, with ``x`` and its two hashes ``h1`` and ``h2``, 128 bits together."""
    rows = vectors.where(_exact(F.col(vector))).withColumn("x", integers(F.col(vector)))
    return rows.withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(13), "x")})


def distinct(rows: DataFrame, weights: str = COUNTS) -> DataFrame:
    """h1, h2, x, size and fit weight w of each distinct vector; counts combine before the shuffle."""
    weight = F.col("n") if weights == COUNTS else F.lit(1).cast("long")
    return rows.groupBy("x").agg(F.count("*").alias("n")).select(
        F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(13), "x").alias("h2"), "x", weight.alias("w"), F.size("x").alias("dim")
    )


def _blocks(batches: Iterator[pd.DataFrame], column: str = "x") -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """Rows of one length with their vectors as a matrix, a bounded number of entries at a time."""
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            if not dim:
                continue
            step = max(1, BLOCK // int(dim))
            for start in range(0, len(rows), step):
                part = rows.iloc[start : start + step]
                yield int(dim), part, np.stack(part[column].to_numpy())


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: dict[int, list] = {}
    for dim, rows, x in _blocks(batches):
        w = rows["w"].to_numpy()
        total = int(w.sum())
        if float(np.abs(x).max()) * total >= 2**62:
            x, w = x.astype(object), w.astype(object)
        old = found.get(dim, [0, [0] * dim])
        found[dim] = [old[0] + total, [a + int(b) for a, b in zip(old[1], w @ x, strict=True)]]
    for dim, (n, sums) in found.items():
        yield pd.DataFrame({"dim": dim, "i": range(dim), "n": Decimal(n), "s": list(map(Decimal, sums))})


def _product_rows(found: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    for dim, product in found.items():
        i, j = np.triu_indices(len(product))
        yield pd.DataFrame({"dim": dim, "i": i, "j": j, "v": product[i, j]})


def _symmetric(rows: pd.DataFrame, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[rows["i"], rows["j"]] = out[rows["j"], rows["i"]] = rows["v"]
    return out


@dataclass(frozen=True)
class Fit:
    """Of vectors of one length: how many, their sums, and the directions that whiten (rows)."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    explained: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: both are taken from whole numbers near the mean."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s - self.n * int(c) for s, c in zip(self.sums, near, strict=True)]
        x = x - near
        if self.n * (float(np.abs(x).max()) + 1) >= 2**62:
            return x.astype(object) * self.n - np.array(rest, object)
        return x * self.n - np.array(rest, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def _squares(deviations: np.ndarray) -> pd.api.extensions.ExtensionArray:
    """Sums of squares, exact; null past 64 bits."""
    if deviations.dtype != object and float(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1] >= 2**62:
        deviations = deviations.astype(object)
    sums = (deviations * deviations).sum(axis=1).tolist()
    return pd.array([x if x < 2**63 else None for x in sums], dtype="Int64")


def directions(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors over the roots of their eigenvalues, by falling eigenvalue, the largest entry
    positive; and each eigenvalue's share of all."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1].T
    real = values > max(values.max(initial=0), 0) * len(values) * np.finfo(float).eps * 8
    values, vectors = values[real][:most], vectors[real][:most]
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]) if len(vectors) else np.zeros(0)
    return vectors * (sign / np.sqrt(values))[:, None], values / np.trace(covariance)


def fit(vectors: DataFrame, components: int = 32) -> dict[int, Fit]:
    """A fit for each length of ``distinct`` vectors. What reaches the driver is a few numbers for each
    dimension and pair of dimensions."""
    sums = (
        vectors.select("dim", "x", "w")
        .mapInPandas(_sums, "dim int, i int, n decimal(38,0), s decimal(38,0)")
        .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        .orderBy("dim", "i").toPandas()
    )
    centres = {
        int(dim): Fit(int(rows["n"].iloc[0]), tuple(map(int, rows["s"])), np.zeros((0, dim)), np.zeros(0))
        for dim, rows in sums.groupby("dim")
    }

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for dim, rows, x in _blocks(batches):
            y = centres[dim].centred(x)
            found[dim] = found.get(dim, 0) + y.T @ (y * rows["w"].to_numpy(np.float64)[:, None])
        yield from _product_rows(found)

    moments = (
        vectors.select("dim", "x", "w").mapInPandas(products, "dim int, i int, j int, v double")
        .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    )
    fits = {}
    for dim, centre in centres.items():
        covariance = _symmetric(moments[moments["dim"] == dim], dim) / centre.n
        fits[dim] = Fit(centre.n, centre.sums, *directions(covariance, components))
    return fits


def whiten(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """h1, h2, dim, n, w, deviation and z, the whitened vector, of each distinct vector that has components."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, rows, x in _blocks(batches):
            fitted = fits[dim]
            if not len(fitted.directions):
                continue
            off = fitted.deviations(x)
            z = (off / fitted.n).astype(np.float64) @ fitted.directions.T
            yield rows[["h1", "h2", "dim", "w"]].assign(n=fitted.n, deviation=_squares(off), z=list(z))

    return vectors.mapInPandas(run, "h1 long, h2 long, dim int, w long, n long, deviation long, z array<double>")


def identity_errors(whitened: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Of each length: the largest absolute entry of the whitened vectors' covariance minus the identity.

    They are centred: their weighted mean is a multiple of the sum of n * x - S, which is 0.
    """

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for dim, rows, z in _blocks(batches, "z"):
            found[dim] = found.get(dim, 0) + z.T @ (z * rows["w"].to_numpy(np.float64)[:, None])
        yield from _product_rows(found)

    moments = (
        whitened.select("dim", "w", "z").mapInPandas(products, "dim int, i int, j int, v double")
        .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    )
    errors = {}
    for dim, rows in moments.groupby("dim"):
        k = len(fits[int(dim)].directions)
        errors[int(dim)] = float(np.abs(_symmetric(rows, k) / fits[int(dim)].n - np.eye(k)).max())
    return errors


def _by_length(values: dict[int, object], kind: str) -> Column:
    """A literal for each length of vectors."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.col("dim")) if pairs else F.lit(None).cast(kind)


def whitened(vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding",
             weights: str = COUNTS, components: int = 32) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error of each row and component."""
    rows = keyed(vectors.select(id_column, vector), vector).select(id_column, "h1", "h2")
    groups = staged(distinct(keyed(vectors.select(vector), vector), weights), "whiten-distinct")
    fits = fit(groups, components)
    done = staged(whiten(groups, fits), "whiten-vectors")
    errors = identity_errors(done, fits)
    shares = {dim: F.array(*map(F.lit, f.explained.tolist())) for dim, f in fits.items() if len(f.explained)}
    pairs = [x for dim, share in shares.items() for x in (F.lit(dim), share)]
    share = F.element_at(F.create_map(*pairs), F.col("dim")) if pairs else F.lit(None).cast("array<double>")
    # Rows of a frequent vector meet the single row of that vector: a skewed partition can be split.
    both = rows.join(done, ["h1", "h2"])
    return both.select(
        id_column, "n", "deviation", share.alias("_share"), _by_length(errors, "double").alias("identity_error"), F.posexplode("z")
    ).select(
        id_column,
        (F.col("pos") + 1).alias("component"),
        "n",
        "deviation",
        F.col("col").alias("whitened"),
        F.get("_share", F.col("pos")).alias("explained"),
        "identity_error",
    )


def registered(embeddings: DataFrame) -> DataFrame:
    return whitened(embeddings)
