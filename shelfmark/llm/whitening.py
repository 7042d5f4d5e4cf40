"""Whitening of embeddings: projections on the covariance's eigenvectors, each of unit variance.

Sums are exact integers, so that the mean is; the covariance is summed in tasks, about that mean,
and only it and the sums (as large as the dimension and its square, whatever the number of rows)
come to the driver, where ``eigen`` solves it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eigen import eigenpairs
from .vectors import finite_vectors, floored

SCALE = 64
#: A share of the largest eigenvalue below which a direction has no variance.
FLAT = 1e-12


@dataclass
class Whitener:
    """``n`` vectors, ``sums`` of their floored entries, falling eigenvalues and their vectors as columns."""

    scale: int
    n: int
    sums: np.ndarray
    lowest: np.ndarray
    highest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    def rises(self, m: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers; an offset common to all entries is in neither."""
        most = max((max(abs(self.n * lo - s), abs(self.n * hi - s)) for s, lo, hi in zip(self.sums.tolist(), self.lowest.tolist(), self.highest.tolist(), strict=True)), default=0)
        if max(most**2 * self.dims, self.n * most) < 1 << 62:
            return self.n * m - self.sums.astype(np.int64)
        return self.n * m.astype(object) - self.sums

    def centred(self, m: np.ndarray) -> np.ndarray:
        return (self.rises(m) / self.n).astype(np.float64)

    def project(self, m: np.ndarray) -> np.ndarray:
        """Whitened values; NaN in directions without variance."""
        live = self.values > FLAT * max(self.values.max(initial=0), 0)
        root = np.sqrt(np.where(live, self.values, np.nan))
        return self.centred(m) @ self.vectors / root


def _sums(clean: DataFrame, scale: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of vectors, and by dimension the exact sum, the least and the largest entry)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = floored(b.column("v"), scale)
            if len(m):
                low, high = (f(m, axis=0) if m.shape[1] else [] for f in (np.min, np.max))
                # a row without a dimension of its own tells the number of vectors, even if all are empty
                cols = ([-1, *range(m.shape[1])], [len(m)] * (m.shape[1] + 1), [0, *m.sum(axis=0)], [0, *low], [0, *high])
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in cols], ["dim", "n", "s", "low", "high"])

    parts = clean.select("v").mapInArrow(per_batch, "dim long, n long, s long, low long, high long")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    n = rows[0]["n"] if rows else 0
    full = lambda r, f, k: f(r[k], 0) if r["n"] < n else r[k]  # noqa: E731  vectors without the dimension have a zero there
    return n, np.array([int(r["s"]) for r in rows[1:]], object), np.array([full(r, min, "low") for r in rows[1:]], object), np.array([full(r, max, "high") for r in rows[1:]], object)


def covariance(clean: DataFrame, scale: int, dims: int, columns: Callable[[np.ndarray], np.ndarray], width: int, n: int) -> np.ndarray:
    """The covariance (divisor ``n``) of ``columns(m)``, which are centred before they are multiplied.

    What rounding has left of the mean is summed beside the products and taken off. Each task sends
    ``width`` rows of its own sums; a row of the matrix is added up in one group, of as many rows as
    there are tasks.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, seen = np.zeros((width + 1, width)), 0
        for b in batches:
            y = columns(floored(b.column("v"), scale, dims))
            gram[:width] += y.T @ y
            gram[width] += y.sum(axis=0)
            seen += len(y)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array(gram.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        rows = np.stack([r.values.to_numpy() for r in table.column("row")])
        return pa.table({"i": table.column("i")[:1], "row": pa.array([np.sort(rows, axis=0).sum(axis=0).tolist()], pa.list_(pa.float64()))})

    got = dict(clean.select("v").mapInArrow(per_task, "i long, row array<double>").groupBy("i").applyInArrow(add, "i long, row array<double>").collect())
    full = np.array([got[i] for i in range(width + 1)])
    return full[:width] / n - np.outer(full[width], full[width]) / n**2


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 32, scale: int = SCALE, id_col: str | None = None) -> Whitener:
    """A whitener of all vectors that are neither null nor hold nulls or non-finite entries.

    Shorter vectors count as padded with zeros. Ties between eigenvalues leave any basis of their
    space. No vectors give a whitener without components; more components than dimensions are as many as those.
    """
    clean = finite_vectors(vectors, id_col or vector_col, vector_col)
    n, sums, low, high = _sums(clean, scale)
    dims, none = len(sums), np.zeros(0)
    model = Whitener(scale, n, sums, low, high, none, np.zeros((dims, 0)), 0.0)
    if not n or not dims:
        return model
    v = covariance(clean, scale, dims, model.centred, dims, n)
    values, x = eigenpairs((v + v.T) / 2)
    keep = slice(None, -components - 1 if components < dims else None, -1)
    model.values, model.vectors, model.total = np.maximum(values[keep], 0).astype(np.float64), x[:, keep].astype(np.float64), float(np.trace(v))
    return model


def identity_error(vectors: DataFrame, model: Whitener, vector_col: str = "embedding", id_col: str | None = None) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over directions with variance."""
    live = np.flatnonzero(model.values > FLAT * max(model.values.max(initial=0), 0))
    if not len(live):
        return 0.0
    clean = finite_vectors(vectors, id_col or vector_col, vector_col)
    v = covariance(clean, model.scale, model.dims, lambda m: model.project(m)[:, live], len(live), model.n)
    return float(np.abs(v - np.eye(len(live))).max())


def transform(vectors: DataFrame, model: Whitener, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened array<double>): the squared distance from the mean times n squared, exact, and the whitened vector.

    Vectors that are null or hold nulls or non-finite entries have no row; repeated rows are whitened each; an entry
    of ``whitened`` is null where the direction has no variance; dimensions that the fit did not have count for nothing.
    A deviation that no long holds is an error.
    """
    clean = finite_vectors(vectors, id_col, vector_col)
    kind = clean.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = floored(b.column("v"), model.scale)
            m = np.pad(m, ((0, 0), (0, max(0, model.dims - m.shape[1]))))[:, : model.dims]
            rises, z = model.rises(m), model.project(m)
            flat = pa.array(z.ravel(), mask=np.isnan(z).ravel())
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * z.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array((rises * rises).sum(axis=1) if m.shape[1] else [0] * len(m), pa.int64()), whitened], ["id", "deviation", "whitened"])

    return clean.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>").withColumnRenamed("id", id_col)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every vector and component.

    Fits on all vectors, measures the whitened covariance, then writes the rows. An empty table, or one
    without a whole vector, gives no rows; columns of other names do not matter.
    """
    model = fit(vectors, vector_col, components, scale, id_col)
    error = identity_error(vectors, model, vector_col, id_col)
    rows = transform(vectors, model, id_col, vector_col)
    share = F.array(*[F.lit(float(e / model.total) if model.total else 0.0) for e in model.values]).cast("array<double>")
    rows = rows.select(id_col, "deviation", F.posexplode(F.arrays_zip(F.col("whitened"), share.alias("explained"))).alias("at", "one"))
    return rows.select(id_col, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("one.whitened").alias("whitened"), F.col("one.explained").alias("explained"), F.lit(error).alias("identity_error"))
