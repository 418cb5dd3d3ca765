"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers x = floor(64 c) + 1000000; each distinct vector of these counts once
in the fit.

1. Sums of each dimension are exact whole numbers. A vector is centred by subtracting the whole part
   of the mean exactly and then its fraction, so nothing is lost to the size of the numbers.
2. Scatter. Each task adds the products of its centred vectors; the sums of tasks are added in two
   steps, in blocks of rows of the matrix, so a task holds a block of many tasks, never all of all.
3. Pivoted Cholesky of the scatter: its rows, in an order that takes the largest remaining diagonal
   first, are those of a lower triangular factor L. It stops where what is left is rounding.
4. One-sided Jacobi on L: pairs of its columns are rotated until all are orthogonal. Squared lengths
   of the columns are the eigenvalues of the scatter, the columns over their lengths its components.
5. Vectors are projected on components and divided by root eigenvalues; the covariance of the result
   over the fit list is computed from the result itself and compared with the identity.

Steps 3 and 4 run on the driver on a matrix of dimension x dimension numbers, whatever the number of
vectors (2 MB at 512 dimensions, 134 MB at 4096).

Defined results: a vector that is null or holds a null, a non-finite entry, or one of 2^46 or more (of
which 64 c has no exact fraction left) is dropped. The fit takes vectors of the most frequent length
(of equally frequent ones the longer); others have no components and no rows. Rows with a null or
repeated vec_id are whitened each. Where the vectors span fewer dimensions than components are asked
for, there are only as many; a single distinct vector has none. An empty table gives no rows. A
deviation beyond the range of long is null in the query and exact in ``whitened``. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**46
COMPONENTS = 16
#: Entries of a partial sum that are added as one array (1 MB).
BLOCK = 1 << 17
SWEEPS = 60
EPS = np.finfo(np.float64).eps


def whole(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the vectors without null, non-finite or too large entries."""
    rows = common.clean_columns(vectors, {"vec_id": "long", "embedding": "array<double>"})
    usable = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    x = F.transform("embedding", lambda c: F.floor(SCALE * c) + F.lit(SHIFT))
    return rows.where(F.col("embedding").isNotNull() & usable).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Centre(NamedTuple):
    """The mean of n vectors: whole part and, exactly, remainder / n of each dimension."""

    n: int
    whole: np.ndarray
    remainder: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.remainder / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S) squared, exactly."""
        y, kind = x - self.whole, pa.decimal128(38, 0)
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if x.shape[1] * most * most < 2**63:
            d = self.n * y - self.remainder
            return pa.array((d * d).sum(axis=1)).cast(kind)
        d = self.n * y.astype(object) - self.remainder.astype(object)
        return pa.array([Decimal(int(v)) for v in (d * d).sum(axis=1)], kind)


def centre(fit: DataFrame, dimensions: int) -> Centre:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in rows:
            x = _matrix(batch.column("x"))
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & (1 << 26) - 1).sum(axis=0)
        if n:
            totals = [Decimal((int(h) << 26) + int(w)) for h, w in zip(high, low, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([n] * dimensions, pa.int64()), "at": pa.array(range(dimensions), pa.int32()),
                 "s": pa.array(totals, pa.decimal128(38, 0))}
            )

    parts = fit.mapInArrow(run, "n long, at int, s decimal(38,0)")
    sums = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    n = sums[0]["n"]
    mean = [divmod(int(r["s"]), n) for r in sums]
    return Centre(n, np.array([m for m, _ in mean], np.int64), np.array([r for _, r in mean], np.int64))


def summed(fit: DataFrame, shape: tuple[int, ...], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of what ``of`` makes of a batch of them, an array of this shape."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in rows:
            total += of(_matrix(batch.column("x")))
        flat, part = total.ravel(), TaskContext.get().partitionId()
        for k in range(0, len(flat), BLOCK):
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array([str(k)]), "part": pa.array([part], pa.int32()), "data": pa.array([flat[k : k + BLOCK].tobytes()])}
            )

    out = np.zeros(int(np.prod(shape)))
    for r in common.added(fit.mapInArrow(run, "key string, part int, data binary")).collect():
        block = np.frombuffer(r["data"])
        out[int(r["key"]) : int(r["key"]) + len(block)] = block
    return out.reshape(shape)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L and the order of rows with a[order][:, order] = L L', the columns of L only as many as a's rank."""
    d = len(a)
    left, order, factor = np.diag(a).copy(), np.arange(d), np.zeros((d, d))
    least = d * EPS * left.max(initial=0)
    for k in range(d):
        j = k + int(np.argmax(left[k:]))
        if not left[j] > least:
            return factor[:, :k], order
        for rows in (left, order, factor):
            rows[[k, j]] = rows[[j, k]]
        factor[k, k] = np.sqrt(left[k])
        below = a[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n numbers, in rounds of disjoint pairs (as a tournament is drawn)."""
    ring = [*range(n), *([-1] if n % 2 else [])]
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(p, q) for p, q in zip(ring[:half], ring[:half - 1 : -1], strict=True) if p >= 0 and q >= 0]
        if pairs:
            yield tuple(np.array(side, np.int64) for side in zip(*pairs, strict=True))
        ring = [ring[0], ring[-1], *ring[1:-1]]


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The factor times the rotation that makes its columns orthogonal, longest first."""
    c = np.ascontiguousarray(factor.T)
    for _ in range(SWEEPS if len(c) > 1 else 0):
        worst = 0.0
        for p, q in rounds(len(c)):
            a, b, both = (c[p] ** 2).sum(axis=1), (c[q] ** 2).sum(axis=1), (c[p] * c[q]).sum(axis=1)
            angle = np.abs(both) / np.sqrt(a * b)
            worst = max(worst, angle.max())
            turn = angle > EPS
            p, q, a, b, both = p[turn], q[turn], a[turn], b[turn], both[turn]
            zeta = (b - a) / (2 * both)
            tangent = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = (1 / np.hypot(1, tangent))[:, None]
            sine = cosine * tangent[:, None]
            c[p], c[q] = cosine * c[p] - sine * c[q], sine * c[p] + cosine * c[q]
        if worst <= len(c) * EPS:
            break
    return c[np.argsort(-(c**2).sum(axis=1), kind="stable")].T


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of the scatter that aren't rounding, falling, and its unit eigenvectors as
    columns. The largest entry of each is positive."""
    factor, order = pivoted_cholesky(scatter)
    columns = orthogonal_columns(factor)
    length = np.sqrt((columns**2).sum(axis=0))
    out = np.empty_like(columns)
    out[order] = columns / length
    at = np.abs(out).argmax(axis=0)
    return length**2, out * np.sign(out[at, np.arange(len(at))])


class Whitening(NamedTuple):
    """A fitted model: how to centre, the map to whitened values, and how good it is."""

    centre: Centre
    map: np.ndarray
    explained: np.ndarray
    identity_error: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.centre.of(x) @ self.map


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors x; None if there is none."""
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    common_size = sizes.first()
    if common_size is None or common_size["d"] == 0:
        return None
    d = common_size["d"]
    fit = common.stored(rows.where(F.size("x") == d).select("x").distinct())
    mean = centre(fit, d)

    def products(z: np.ndarray) -> np.ndarray:
        return z.T @ z

    scatter = summed(fit, (d, d), lambda x: products(mean.of(x)))
    values, vectors = principal(scatter)
    k = min(components, len(values))
    model = Whitening(mean, vectors[:, :k] / np.sqrt(values[:k] / mean.n), values[:k] / np.trace(scatter), 0.0)
    if not k:
        return model
    middle = summed(fit, (k,), lambda x: model.of(x).sum(axis=0)) / mean.n
    covariance = summed(fit, (k, k), lambda x: products(model.of(x) - middle)) / mean.n
    return model._replace(identity_error=float(np.abs(covariance - np.eye(k)).max()))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation decimal(38,0) and whitened array<double> of the vectors x of the model's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            values = model.of(x)
            ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "deviation": model.centre.deviations(x),
                    "whitened": pa.ListArray.from_arrays(ends, values.ravel()),
                }
            )

    rows = rows.where(F.size("x") == len(model.centre.whole))
    return rows.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings on up to 16 whitened components."""
    rows = common.stored(whole(common.read_table(spark, sf_dir, "embeddings")))
    model = fitted(rows)
    if model is None or not len(model.explained):
        return spark.createDataFrame([], OUT)
    each = whitened(rows, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.centre.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.get(F.array(*[F.lit(float(e)) for e in model.explained]), "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
