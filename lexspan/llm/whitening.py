"""Whitening of embeddings by TSQR: a tall, skinny QR over partitions, without a covariance matrix.

Numbers become integers, so that sums over any number of rows are exact and rows are centred
by them without rounding twice. Each partition takes the QR factorisation of its centred
rows, batch by batch, and keeps R; R factors are stacked and factorised again in a tree of
sixteen a node, and the singular values and right vectors of the last R are those of the
whole table. Right vectors over singular values whiten; no covariance is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, unused

#: A number c becomes floor(SCALE * c) + SHIFT. Vectors with a number of LARGEST or more count as not finite.
SCALE, SHIFT, LARGEST = 1024, 100_000, 2.0**30
#: Partial results that one task merges; rows factorised at once; a singular value is zero below this share of the largest.
FAN_IN, ROWS, RANK = 16, 4096, 1e-12


@dataclass(frozen=True)
class Whitening:
    """n rows fitted, exact sums a dimension, and for each component its vector, eigenvalue and share of the trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray  # a column a component
    eigenvalues: np.ndarray
    explained: np.ndarray

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, in Python's integers where 64 bits don't hold it."""
        fits = self.n * (int(np.abs(x).max(initial=0)) + 1) < 2**62
        return self.n * (x if fits else x.astype(object)) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(np.float64)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums) ** 2 of each row, exactly; None beyond 64 bits."""
        apart = self.apart(x)
        largest = int(np.abs(apart).max(initial=0))
        if largest**2 * apart.shape[1] < 2**63:
            return (apart * apart).sum(1).tolist()
        exact = [sum(v * v for v in row) for row in apart.tolist()]
        return [v if v < 2**63 else None for v in exact]


def _sound(vector: str) -> F.Column:
    """Whether a vector is neither null nor empty, and all its numbers are there, finite and not too large."""
    v = F.col(vector)
    fits = lambda c: F.coalesce((F.abs(c.cast("double")) < LARGEST) & ~F.isnan(c.cast("double")), F.lit(False))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, fits)


def _numbers(column: pa.Array, dim: int) -> np.ndarray:
    """The integers of a column of vectors, a row each."""
    flat = column.flatten().cast(pa.float64()).to_numpy().reshape(-1, dim)
    return np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _partial(rows: DataFrame, vector: str, dim: int, add: Callable[[np.ndarray | None, np.ndarray], np.ndarray]) -> DataFrame:
    """part, value: what `add` made of all vectors of each partition, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                made = add(made, _numbers(batch.column(0).slice(low, ROWS), dim))
        if made is not None:
            yield pa.record_batch([pa.array([made.tobytes()], pa.binary())], names=["value"])

    made = rows.select(vector).mapInArrow(run, "value binary")
    return made.select(F.spark_partition_id().cast("long").alias("part"), "value")


def tree_merge(partials: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One value of all partial ones (part, value), merged sixteen at a time in the order of their parts; None without any.

    Only the last value reaches the driver; every level is kept, so that a lost executor
    costs a few merges, and has a sixteenth of the rows of the one before.
    """

    def run(table: pa.Table) -> pa.Table:
        own = table.sort_by("part")
        return pa.table({"part": pa.array([own["part"][0].as_py() // FAN_IN], pa.int64()), "value": pa.array([merge(own["value"].to_pylist())], pa.binary())})

    partials = durable(partials)
    while (top := partials.agg(F.max("part")).first()[0] or 0) > 0:
        partials = durable(partials.groupBy(F.floor(F.col("part") / FAN_IN).alias("node")).applyInArrow(run, "part long, value binary").coalesce(max(1, top // FAN_IN // FAN_IN)))
    last = partials.first()
    return None if last is None else last["value"]


def _add_sums(made: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    """Rows, and the sum of each dimension."""
    own = np.r_[len(x), x.sum(0)]
    return own if made is None else made + own


def _summed(values: list[bytes], kind: type) -> bytes:
    return np.sum([np.frombuffer(v, kind) for v in values], axis=0, dtype=kind).tobytes()


def fit(df: DataFrame, vector: str = "embedding", components: int = 8) -> Whitening | None:
    """The whitening of all sound vectors; None without any.

    Vectors that are null or empty, or hold a null, a number that isn't finite or one of
    2 ** 30 or more (sums have 64 bits), aren't fitted; nor are those of another length than most have (of equal
    numbers the greater length). Equal vectors and repeated rows count as often as they
    come. Components whose eigenvalue is zero can't be whitened and are left out, so there
    are fewer where vectors span less. Other columns aren't read.
    """
    rows = _rows(df, vector)
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return None
    dim = lengths["dim"]
    own = rows.where(F.size("vector") == dim)
    totals = np.frombuffer(tree_merge(_partial(own, "vector", dim, _add_sums), lambda values: _summed(values, np.int64)), np.int64)
    n, sums = int(totals[0]), totals[1:]
    model = Whitening(n, sums, np.eye(dim), np.ones(dim), np.ones(dim))

    def add(made: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        centred = model.centred(x)
        return np.linalg.qr(centred if made is None else np.vstack([made, centred]), mode="r")

    def merge(values: list[bytes]) -> bytes:
        return np.linalg.qr(np.vstack([np.frombuffer(v).reshape(-1, dim) for v in values]), mode="r").tobytes()

    r = np.frombuffer(tree_merge(_partial(own, "vector", dim, add), merge)).reshape(-1, dim)
    _, singular, right = np.linalg.svd(r, full_matrices=False)
    eigenvalues = singular**2 / n
    kept = min(components, int((singular > RANK * max(singular.max(initial=0), 1e-300)).sum()) if singular.max(initial=0) > 0 else 0)
    vectors = right[:kept].T
    # Either sign will do; the largest entry is positive, so that a run agrees with the next.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(kept)] < 0, -1.0, 1.0)
    trace = eigenvalues.sum()
    return Whitening(n, sums, vectors, eigenvalues[:kept], eigenvalues[:kept] / (trace if trace > 0 else 1.0))


def _rows(df: DataFrame, vector: str) -> DataFrame:
    return df.where(_sound(vector)).select(F.col(vector).alias("vector"))


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over all fitted rows."""
    k = len(model.eigenvalues)

    def add(made: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        own = np.r_[w.sum(0), (w.T @ w).ravel()]
        return own if made is None else made + own

    dim = len(model.sums)
    partial = _partial(_rows(df, vector).where(F.size("vector") == dim), "vector", dim, add)
    sums = np.frombuffer(tree_merge(partial, lambda values: _summed(values, np.float64)))
    # Whitened vectors are centred, so that taking their mean out changes rounding only.
    mean, products = sums[:k] / model.n, sums[k:].reshape(k, k) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding", whitened: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The rows of `df` with a vector that `fit` takes, with all their columns, `whitened` (an array of a double a component) and `deviation`.

    deviation is the sum over dimensions of (n * x - sum) ** 2, exact, null beyond 64 bits.
    Columns that already have one of the two names are replaced. Rows with equal vectors
    get equal numbers. No model: no rows. Nothing is shuffled.
    """
    kept = [c for c in df.columns if c.lower() not in (whitened.lower(), deviation.lower())]
    schema = T.StructType([*df.select(*[df[c] for c in kept]).schema.fields, T.StructField(whitened, T.ArrayType(T.DoubleType())), T.StructField(deviation, T.LongType())])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, k = len(model.sums), len(model.eigenvalues)
    hidden = unused("__vector", df.columns)
    sound = df.where(_sound(vector) & (F.size(vector) == dim)).withColumn(hidden, F.col(vector)).select(*[df[c] for c in kept], hidden)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                x = _numbers(part.column(len(kept)), dim)
                flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, model.project(x).ravel())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], flat, pa.array(model.deviations(x), pa.int64())], names=schema.names)

    return sound.mapInArrow(run, schema)
