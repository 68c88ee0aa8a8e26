"""Whitening of embeddings by shifted CholeskyQR.

Centred rows are never gathered: a pass over them gives a Gram matrix, each task sending one d x d matrix. The first is shifted
before it is factored, so that rows of any condition have a Cholesky factor R1; in the next passes tasks divide their rows by the
factors so far through triangular solves, and what Gram matrix comes of it is factored again, until the rows are orthogonal. The
factors compose to the R of the rows' QR decomposition, whose singular vectors are the components, and whose squared singular
values over n their variances: the condition of the covariance, the square of that of the rows, never enters.

Vectors are fixed-point numbers (`fixed_point`), so that counts, sums and means are exact and don't depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

#: Largest number that a fixed-point entry may have; beyond it sums might not be exact.
MOST = 1 << 40
_UNIT = 2.0**-53


def finite_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector isn't null and has no null, infinite or NaN entries."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.where(F.col(vector).isNotNull()).where(~bad)


def fixed_point(vector: str, scale: float, offset: int) -> F.Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))


def _matrix(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    """Rows of a list column of numbers, short ones filled up with zeros."""
    col = batch.column(column)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(col.value_lengths())
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _summed(rows: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of what `of` makes of a batch (rows x dims numbers); tasks add up first, then one row an entry is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch, "x", dims))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    sums = rows.select("x").mapInArrow(run, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(max((r["at"] for r in sums), default=-1) + 1, np.int64 if kind == "long" else float)
    for r in sums:  # as many rows as the matrix has entries, whatever the rows
        out[r["at"]] = r["value"]
    return out


@dataclass
class Whitening:
    """n rows with sums = n * floor + rest, 0 <= rest < n; unit components in rows, their variances, and the variance in all."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact sum over dimensions of (n * x - sum)^2, for each row."""
        d = x - self.floor
        if not d.size:
            return np.zeros(len(x), np.int64)
        widest = (int(np.abs(d).max()) + 1) * self.n
        if widest**2 * d.shape[1] < 1 << 62:
            return ((self.n * d - self.rest) ** 2).sum(1)
        wide = ((self.n * d.astype(object) - self.rest.astype(object)) ** 2).sum(1)
        if max(wide) >= 1 << 63:
            raise OverflowError("a deviation is too large for a long")
        return wide.astype(np.int64)


def solve_rows(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q r = x for an upper triangular r, column by column."""
    q = np.array(x, float, order="F")
    for j in range(r.shape[1]):
        q[:, j] -= q[:, :j] @ r[:j, j]
        q[:, j] /= r[j, j]
    return q


def _shifted(gram: np.ndarray, rows: int) -> np.ndarray:
    d = len(gram)
    shift = 11.0 * (rows * d + d * (d + 1)) * _UNIT * np.trace(gram)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def fit_whitening(rows: DataFrame, components: int = 8, passes: int = 6) -> Whitening:
    """Whitening of all rows(x array<long>); rows must be a written table, which is read once a pass, three or four times as a rule.

    Components are ordered by falling variance; directions without variance (below 1e-12 of the largest deviation) are none. The
    largest entry of each is positive. Vectors of different lengths are filled up with zeros. Without rows, or with equal ones,
    there are no components."""
    first = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims"), F.max(F.expr("aggregate(x, 0L, (m, v) -> greatest(m, abs(v)))")).alias("most")).first()
    n, dims = first["n"], first["dims"] or 0
    if not n or not dims:
        return Whitening(n, *np.zeros((2, dims), np.int64), np.zeros((0, dims)), np.zeros(0), 0.0)
    if first["most"] > MOST:
        raise ValueError(f"an entry of {first['most']} is too large for exact sums; use a smaller scale")
    sums = _summed(rows, dims, lambda x: x.sum(0), "long")
    model = Whitening(n, sums // n, sums % n, np.zeros((0, dims)), np.zeros(0), 0.0)
    factors: list[np.ndarray] = []

    def gram() -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            q = model.centred(x)
            for r in factors:
                q = solve_rows(q, r)
            return q.T @ q

        return _summed(rows, dims, of, "double").reshape(dims, dims)

    g = gram()
    model.total = float(np.trace(g)) / n
    if model.total == 0:
        return model
    factors.append(_shifted(g, n))
    for _ in range(passes - 1):
        g = gram()
        if np.abs(g - np.eye(dims)).max() < 1e-13 * dims:
            break
        try:
            r = np.linalg.cholesky(g).T
            if r.diagonal().min() < 1e-6 * r.diagonal().max():
                raise np.linalg.LinAlgError
        except np.linalg.LinAlgError:  # directions without variance, or nearly
            r = _shifted(g, n)
        factors.append(r)
    else:
        g = gram()
    # What the last pass left of the rows isn't orthogonal in directions without variance; its root closes the product.
    values, vectors = np.linalg.eigh(g)
    r = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, sigma, found = np.linalg.svd(r)
    found = found[: min(components, int((sigma > 1e-12 * sigma[0]).sum()))]
    signs = np.sign(found[np.arange(len(found)), np.abs(found).argmax(1)])
    model.components, model.variances = found * signs[:, None], sigma[: len(found)] ** 2 / n
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured over all rows; 0 without components."""
    k = len(model.components)
    if not k:
        return 0.0

    def of(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.vstack([w.sum(0), w.T @ w])

    found = _summed(rows, model.components.shape[1], of, "double").reshape(k + 1, k) / model.n
    return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """rows with deviation (exact) and whitened, an entry a component; other columns are kept, those of these names replaced."""
    names = [c for c in rows.columns if c not in ("deviation", "whitened")]
    dims = len(model.floor)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # dims x components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            x = _matrix(batch, "x", dims)
            w = m.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(m.deviations(x)), lists], names=[*names, "deviation", "whitened"])

    plain = rows.select(*names)
    schema = plain.withColumns({"deviation": F.lit(0).cast("long"), "whitened": F.array().cast("array<double>")}).schema
    return plain.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = finite_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    rows = cut(vectors.select("vec_id", fixed_point("embedding", 1024.0, 100_000).alias("x")), "whitening-rows")
    model = fit_whitening(rows)
    error = identity_error(rows, model)
    explained = F.element_at(F.array(*(F.lit(float(v) / model.total) for v in model.variances)), F.col("component"))
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    out = out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened")
    return out.withColumns({"explained": explained if len(model.variances) else F.lit(0.0), "identity_error": F.lit(error)})
