"""Embedding whitening by a covariance that weights each distinct vector with its multiplicity.

1. Vectors are taken to the integer grid ``x = floor(GRID * c) + OFFSET``; equal x are one
   row with their count (partial sums before the shuffle, so copies cost next to nothing).
2. Sums of the weighted x are exact integers. Each task then multiplies its centred distinct
   vectors, scaled by the root of the weight, in one matrix product; the products are added up
   row by row of the covariance.
3. The covariance (dimension squared numbers, whatever the table's size) is decomposed once.
   Each distinct vector is projected once, and the rows take their results back by a join.
   At most ``HOT_SHARE`` vectors can stand for over 1 / ``HOT_SHARE`` of the rows each; these
   are joined by broadcast, all others by a shuffle, so no task holds a very common vector's rows.

The weight of a distinct vector is its count, or one with ``weight="one"``.

Defined results: rows whose vector is null, empty, or holds nulls or non-finite entries go. The commonest
length is the dimension (of equally common ones the greatest); vectors of another length are of
another space and go too. Grid values stay within ``EXTREME``. Components without variance (eigenvalue
under the rounding error of the largest) have null ``whitened``. ``deviation`` is a decimal, null over 38
digits. Repeated rows stay, null ids too; an empty table gives an empty one; input columns called like a
result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_path

GRID = 1024
OFFSET = 100_000
EXTREME = float(1 << 52)
COMPONENTS = 8
HOT_SHARE = 256
OUTPUTS = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def grid(vector: Column) -> Column:
    """The integer vector, null where an entry is null or not finite."""
    c = lambda v: v.cast("double")
    sound = ~F.exists(vector, lambda v: v.isNull() | F.isnan(c(v)) | (F.abs(c(v)) == float("inf")))
    x = F.transform(vector, lambda v: F.floor(F.greatest(F.least(c(v) * GRID, F.lit(EXTREME)), F.lit(-EXTREME))) + OFFSET)
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & sound, x)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def exact_sum(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Weighted column sums; as Python integers where a long could overflow."""
    if float(np.abs(values).max(initial=0)) * float(weights.sum(dtype=np.float64)) < 2.0**62:
        return weights @ values
    return weights.astype(object) @ values.astype(object)


@dataclass
class Fit:
    """What whitening needs: weight total and exact sums of x, eigenvalues (falling) and unit eigenvectors (columns), trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts are taken off as integers first."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)^2, exact."""
        far = self.n * float(np.abs(x).max(initial=0)) + max(abs(s) for s in self.sums)
        if far < 2.0**62:
            d = self.n * x - np.array(self.sums, np.int64)
            if float(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
                return (d * d).sum(axis=1).tolist()
            d = d.astype(object)
        else:
            d = self.n * x.astype(object) - np.array(self.sums, object)
        return (d * d).sum(axis=1).tolist()


def _sum_rows(vectors: DataFrame, weighted: bool) -> tuple[int, list[int]]:
    """(n, S) of the distinct vectors: a partial sum for each task, added as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            w = np.asarray(b.column(1)) if weighted else np.ones(b.num_rows, np.int64)
            part = exact_sum(w, matrix(b.column(0))).astype(object)
            total, n = part if total is None else total + part, n + int(w.sum())
        if total is not None:
            texts = [str(n), *map(str, total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int32()), pa.array(texts)], names=["i", "v"])

    parts = vectors.select("x", "count").mapInArrow(run, "i int, v string")
    sums = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}  # dimension + 1 rows
    return sums.pop(0, 0), [sums[i] for i in sorted(sums)]


def _covariance(vectors: DataFrame, fit: Fit, weighted: bool) -> np.ndarray:
    """The centred covariance: a matrix product for each task, whose rows are added up."""
    d = len(fit.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                c = fit.centred(matrix(b.column(0)))
                if weighted:
                    c *= np.sqrt(np.asarray(b.column(1)))[:, None]
                total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    parts = vectors.select("x", "count").mapInArrow(run, "i int, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # dimension squared
    out = np.zeros((d, d))
    for r in cells:
        out[r.i, r.j] = r.v
    return (out + out.T) / (2 * fit.n)


def fit_whitening(vectors: DataFrame, weight: str = "count") -> Fit | None:
    """From distinct vectors (x, count); None for an empty table."""
    weighted = weight == "count"
    n, sums = _sum_rows(vectors, weighted)
    if not n:
        return None
    fit = Fit(n, sums, np.empty(0), np.empty(0), 0.0)
    v = _covariance(vectors, fit, weighted)
    values, columns = np.linalg.eigh(v)
    return Fit(n, sums, values[::-1], columns[:, ::-1], float(np.trace(v)))


def project(vectors: DataFrame, fit: Fit, components: int = COMPONENTS) -> DataFrame:
    """Adds ``deviation`` (decimal) and ``w`` (a double a component) to the distinct vectors."""
    k = min(components, len(fit.values))
    least = max(float(fit.values[0]), 0.0) * len(fit.values) * np.finfo(float).eps
    sound = fit.values[:k] > least
    scaled = fit.vectors[:, :k] / np.sqrt(np.where(sound, fit.values[:k], 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(0))
            w = fit.centred(x) @ scaled
            flat = pa.array(w.reshape(-1), mask=np.tile(~sound, len(w)))
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k), pa.int32()), flat)
            exact = pa.array([str(d) if d < 10**38 else None for d in fit.deviation(x)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), exact, whitened], names=["x", "count", "deviation", "w"])

    out = vectors.select("x", "count").mapInArrow(run, "x array<long>, count long, deviation string, w array<double>")
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(projected: DataFrame, fit: Fit, k: int, weight: str = "count") -> float | None:
    """Largest absolute entry of the covariance of ``w`` minus the identity, over components with variance."""
    c = F.col("count") if weight == "count" else F.lit(1)
    w = [F.col("w")[i] for i in range(k)]
    means = projected.agg(*[(F.sum(c * x) / fit.n).alias(f"m{i}") for i, x in enumerate(w)]).first()
    pairs = [(i, j) for i in range(k) if means[i] is not None for j in range(i, k) if means[j] is not None]
    if not pairs:
        return None
    centred = [x - F.lit(means[i]) for i, x in enumerate(w)]
    cells = projected.agg(*[(F.sum(c * centred[i] * centred[j]) / fit.n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(cells, pairs))


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, weight: str = "count") -> DataFrame:
    """A row for each remaining row of the table and component: its columns but the vector, and ``OUTPUTS``."""
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c.lower() not in {vector.lower(), *OUTPUTS}]
    held = F.struct(F.lit(True).alias("vr_in"), *[F.col(f"`{c}`") for c in keep])
    packed = rows.select(held.alias("row"), grid(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    counted = packed.groupBy("x").agg(F.count("*").alias("count"))
    path = shared_path(spark, "distinct-vectors")
    counted.write.parquet(path)
    vectors = spark.read.parquet(path)
    size = vectors.groupBy(F.size("x").alias("d")).agg(F.sum("count").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if size is not None:
        vectors, packed = vectors.where(F.size("x") == size.d), packed.where(F.size("x") == size.d)
    fit = fit_whitening(vectors, weight)
    if fit is None:
        fit = Fit(1, [0], np.zeros(1), np.eye(1), 0.0)
    k = min(components, len(fit.values))
    path = shared_path(spark, "whitened-vectors")
    project(vectors, fit, components).write.parquet(path)
    done = spark.read.parquet(path)
    error = identity_error(done, fit, k, weight)
    shares = [float(max(v, 0.0)) / fit.trace if fit.trace > 0 else None for v in fit.values[:k]]
    total = done.agg(F.sum("count")).first()[0] or 0
    common = F.col("count") * HOT_SHARE > total  # under HOT_SHARE rows
    hot = F.broadcast(done.where(common))
    one = packed.join(hot, "x").unionByName(packed.join(F.broadcast(done.where(common).select("x")), "x", "left_anti").join(done.where(~common), "x"))
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    each = one.select("row", "deviation", F.posexplode("w").alias("i", "whitened"))
    return each.select(
        *[F.col(f"row.`{c}`").alias(c) for c in keep],
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("i")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
